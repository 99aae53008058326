"""Candidate box pairs by a scale-bucketed spatial grid (equi-joins only).

IoU >= t > 0 implies the smaller area is at least t times the larger one, so
boxes only pair with boxes of nearby scale.  Each right-side box is registered
in the grid cells it covers at its own scale level ``L = floor(log2(sqrt(area)
/ cell))`` (cell size ``cell * 2^L``); boxes of the other side probe their own
and coarser levels.  Two boxes that overlap share a cell of the coarser one's
level, so every pair with IoU >= t is produced; the caller applies the exact
IoU test.  Cells per box grow with its aspect ratio, not with the group size.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxwise.functions.geometry import area


def _level(cell: float):
    a = F.greatest(area(""), F.lit(1e-12))
    return F.greatest(F.lit(0), F.floor(F.log2(F.sqrt(a) / F.lit(float(cell))))).cast("int")


def _cells(df: DataFrame, level_col: str, cell: float, keep: list) -> DataFrame:
    size = F.lit(float(cell)) * F.pow(F.lit(2.0), F.col(level_col))
    xs = F.sequence(F.floor(F.col("x1") / size).cast("long"), F.floor(F.col("x2") / size).cast("long"))
    ys = F.sequence(F.floor(F.col("y1") / size).cast("long"), F.floor(F.col("y2") / size).cast("long"))
    d = df.select(*keep, F.col(level_col).alias("lvl"), F.explode(xs).alias("cx"), ys.alias("_ys"))
    return d.select(*keep, "lvl", "cx", F.explode("_ys").alias("cy"))


def own_cells(df: DataFrame, cell: float, keep: Sequence[str]) -> DataFrame:
    """``keep, lvl, cx, cy``: the cells each box covers at its own scale."""
    return _cells(df.withColumn("_l", _level(cell)), "_l", cell, list(keep))


def grid_pairs(left: DataFrame, right: DataFrame, *, keys: Sequence[str], left_id: str, right_id: str,
               thr: float, cell: float) -> DataFrame:
    """``keys, left_id, right_id`` for every left/right pair of a key group that
    could have IoU >= ``thr`` (a superset; exact test left to the caller).

    Each side probes its own and coarser levels of the other, where a box covers a
    few cells.  A positive ``thr`` bounds how much coarser a partner can be; with
    ``thr`` 0 every coarser level present is probed."""
    keys = list(keys)
    if thr > 0:
        span = max(1, math.ceil(-math.log2(thr) / 2) + 1)
    else:
        span = int(left.select(_level(cell).alias("l")).unionByName(right.select(_level(cell).alias("l")))
                   .agg(F.max("l")).first()[0] or 0)

    def own(df, ident):
        return own_cells(df, cell, keys + [ident])

    def coarser(df, ident, first):
        p = df.withColumn("_l0", _level(cell)).withColumn(
            "_l", F.explode(F.sequence(F.col("_l0") + first, F.col("_l0") + max(span, first))))
        return _cells(p, "_l", cell, keys + [ident])

    on = keys + ["lvl", "cx", "cy"]
    up = coarser(left, left_id, 0).join(own(right, right_id).hint("merge"), on)
    pairs = up.select(*keys, left_id, right_id)
    if span:
        down = own(left, left_id).join(coarser(right, right_id, 1).hint("merge"), on)
        pairs = pairs.unionByName(down.select(*keys, left_id, right_id))
    return pairs.distinct()


def cell_size(df: DataFrame, prefix: str = "") -> float:
    """Median box side: the cell of level 0, whatever the boxes' unit."""
    side = df.where(area(prefix) > 0).agg(F.percentile_approx(F.sqrt(area(prefix)), 0.5)).first()[0]
    return float(side or 1.0)
