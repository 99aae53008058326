"""Detection post-processing: score filter, per-image top-k, size filter, NMS.

Contract K1 (greedy NMS): inside each ``(image_id, category_id)`` group (or
``image_id`` when class-agnostic) detections are visited by ``score DESC,
det_id ASC``; a detection is kept iff no *kept* earlier detection overlaps it
with ``IoU > thr`` (strict, tested as ``inter > thr * union``).  The greedy walk
is a higher-order ``aggregate`` over the group's sorted array, so it stays in
the JVM with no Python.  Group size is bounded by the detector's per-image
output; :func:`postprocess` applies the ``nms_pre`` top-k (with Spark's
map-side ``WindowGroupLimit``) before any group is formed.  A standalone
:func:`nms` sends groups above ``NMS_MAX_GROUP`` rows to
:func:`nms_distributed` (exact, front by front against the boxes already kept).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxwise.functions.geometry import iou_above
from boxwise.plans.ranking import ranked
from boxwise.plans.spatial import cell_size, grid_pairs, own_cells
from boxwise.session import default_parallelism, materialize, partitions_for, scratch_path

BOX = ["x1", "y1", "x2", "y2"]


def confidence_filter(det: DataFrame, thr: float = 0.1, *, strict: bool = True) -> DataFrame:
    """Keep detections with ``score > thr`` (``>=`` when not strict)."""
    s = F.col("score")
    return det.where(s > thr if strict else s >= thr)


def min_box_filter(det: DataFrame, min_size: float = 0.0) -> DataFrame:
    """Keep boxes whose width and height both exceed ``min_size``."""
    return det.where(((F.col("x2") - F.col("x1")) > min_size) & ((F.col("y2") - F.col("y1")) > min_size))


# an image with more detections is cut in several tasks before it meets in one
TOPK_HOT = 1_000_000
TOPK_SALTS = 64


def image_partitions(det: DataFrame, by=("image_id",)) -> tuple[int, int]:
    """(partitions in which a task holds a bounded number of rows, rows of the largest image)."""
    n = det.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    rows, largest = n.agg(F.sum("n"), F.max("n")).first()
    return partitions_for(det.sparkSession, rows or 0), largest or 0


def topk_per_image(det: DataFrame, k: int, *, by=("image_id",), partitions: int | None = None,
                   hot_rows: int = TOPK_HOT) -> DataFrame:
    """Best ``k`` detections per image by ``score DESC, det_id``.

    Spark plans this as ``WindowGroupLimit`` on both sides of the shuffle: every
    map task keeps only its local top ``k`` per image, so even an image holding
    a large share of all detections sends at most ``k`` rows per task.

    Both sides sort all that a task holds.  A table too large for the session's shuffle
    partitions is dealt by image into more (``partitions``; counted where None), and then an image of over
    ``hot_rows`` detections is first cut to its best ``k`` in ``TOPK_SALTS`` parts.  Where ``partitions``
    is given, images must be bounded; 0 leaves the rows where they are.
    """
    order = [F.col("score").desc(), F.col("det_id")]

    def best(d, keys):
        w = Window.partitionBy(*keys).orderBy(*order)
        return d.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= k).drop("_rk")

    largest = 0
    if partitions is None:
        partitions, largest = image_partitions(det, by)
    if partitions <= default_parallelism(det.sparkSession):
        return best(det, by)
    if largest > hot_rows:
        det = det.withColumn("_salt", F.pmod(F.xxhash64("det_id"), F.lit(TOPK_SALTS)))
        det = best(det.repartition(partitions, *by, "_salt"), [*by, "_salt"]).drop("_salt")
    return best(det.repartition(partitions, *by), by)


# groups up to this size are walked as one array (the walk is quadratic in the
# boxes kept); larger ones go through conflict pairs
NMS_MAX_GROUP = 2000
# conflict pairs one task resolves for a group at a time
EDGES_PER_GROUP = 1_000_000


def nms(det: DataFrame, *, iou_thr: float, class_agnostic: bool = False,
        max_group: int | None = NMS_MAX_GROUP) -> DataFrame:
    """Greedy non-maximum suppression (contract K1); returns the kept rows.

    Groups of at most ``max_group`` detections are walked as one sorted array;
    larger (hot) groups are resolved exactly by :func:`nms_distributed`, so
    no group's boxes are compared all with all in one task and nothing is cut.
    """
    grp = ["image_id"] if class_agnostic else ["image_id", "category_id"]
    if max_group is None:
        return _nms_arrays(det, iou_thr, grp)
    hot = materialize(det.groupBy(*grp).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > max_group).select(*grp),
                      "nms-hot")
    if hot.isEmpty():
        return _nms_arrays(det, iou_thr, grp)
    cold = _nms_arrays(det.join(hot, grp, "left_anti"), iou_thr, grp)
    warm = nms_distributed(det.join(hot, grp, "left_semi"), iou_thr=iou_thr, group=grp)
    return cold.unionByName(warm.select(*cold.columns))


def _nms_arrays(det: DataFrame, iou_thr: float, grp: list) -> DataFrame:
    rest = [c for c in det.columns if c not in grp and c not in ("det_id", "score", *BOX)]
    item = F.struct((-F.col("score")).alias("ns"), F.col("det_id"), *[F.col(c) for c in BOX],
                    F.col("score"), *[F.col(c) for c in rest])
    g = det.groupBy(*grp).agg(F.sort_array(F.collect_list(item)).alias("ds"))
    empty = F.filter("ds", lambda d: F.lit(False))
    kept = F.aggregate(
        "ds", empty,
        lambda acc, d: F.when(F.exists(acc, lambda k: iou_above(k, d, iou_thr)), acc)
                        .otherwise(F.concat(acc, F.array(d))))
    out = g.select(*grp, F.explode(kept).alias("d"))
    return out.select("d.det_id", *grp, *[F.col(f"d.{c}") for c in BOX], "d.score",
                      *[F.col(f"d.{c}") for c in rest])


def _overlapping(early: DataFrame, late: DataFrame, thr: float, grp: list, cell: float) -> DataFrame:
    """Pairs ``(a, b)`` of ranks of one group, ``a`` of ``early`` before ``b`` of ``late``,
    with IoU > ``thr``."""
    left = early.select(*grp, F.col("rk").alias("a"), *BOX)
    right = late.select(*grp, F.col("rk").alias("b"), *BOX)
    cand = grid_pairs(left, right, keys=grp, left_id="a", right_id="b", thr=thr, cell=cell).where("a < b")
    wide = right.select(*grp, "b", *[F.col(c).alias(f"b{c}") for c in BOX])
    return (cand.join(left.hint("merge"), grp + ["a"]).join(wide.hint("merge"), grp + ["b"])
            .where(iou_above("", "b", thr)).select(*grp, "a", "b"))


def _greedy(grp: list):
    """Ranks that the greedy walk suppresses, from a group's conflict pairs."""
    def walk(pdf):
        a, b = pdf["a"].to_numpy(), pdf["b"].to_numpy()
        order = np.argsort(a, kind="stable")
        a, b = a[order], b[order]
        nodes = np.unique(np.concatenate([a, b]))
        a, b = np.searchsorted(nodes, a), np.searchsorted(nodes, b)
        gone = np.zeros(len(nodes), bool)
        first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
        for low, high in zip(first, np.append(first[1:], len(a))):
            if not gone[a[low]]:
                gone[b[low:high]] = True
        out = pd.DataFrame({"rk": nodes[gone]})
        for c in grp:
            out[c] = pdf[c].iloc[0]
        return out[[*grp, "rk"]]
    return walk


def _front(undecided: DataFrame, pairs: int, grp: list, cell: float) -> DataFrame:
    """``grp, _until``: each group's front is its undecided ranks below ``_until``, the
    longest of fractions 1, 1/4, 1/16 ... of its rank span in which boxes that share a
    grid cell make at most ``pairs`` pairs; the front always holds the best box.  Only
    counts per cell are shuffled, summed map-side, so a crowded cell costs no more than others."""
    span = undecided.groupBy(*grp).agg(F.min("rk").alias("_low"), F.max("rk").alias("_high"))
    span = materialize(span, "nms-span")
    levels = max(1, math.ceil(math.log((span.agg(F.max(F.col("_high") - F.col("_low"))).first()[0] or 0) + 1, 4)) + 1)

    def until(j):
        return F.col("_low") + F.ceil((F.col("_high") - F.col("_low") + 1) / F.lit(4 ** j))

    cells = own_cells(undecided, cell, [*grp, "rk"]).join(span.hint("merge"), grp)
    held = cells.groupBy(*grp, "lvl", "cx", "cy").agg(*[F.sum((F.col("rk") < until(j)).cast("bigint")).alias(f"c{j}")
                                                        for j in range(levels)])
    made = held.groupBy(*grp).agg(*[F.sum(F.expr(f"c{j} * (c{j} - 1.0) / 2")).alias(f"p{j}") for j in range(levels)])
    last = F.col("_low") + 1
    for j in reversed(range(levels)):
        last = F.when(F.col(f"p{j}") <= pairs, F.greatest(until(j), F.col("_low") + 1)).otherwise(last)
    return materialize(made.join(span.hint("merge"), grp).select(*grp, last.alias("_until")), "nms-front")


def nms_distributed(det: DataFrame, *, iou_thr: float, group=("image_id", "category_id"),
                    cell: float | None = None, edges_per_group: int = EDGES_PER_GROUP) -> DataFrame:
    """Exact greedy NMS for large groups, decided front by front.

    Boxes are ranked inside each group (distributed ranking).  A round takes each
    group's front, its best undecided boxes up to about ``edges_per_group`` pairs, finds the
    conflicts in it by a scale-bucketed grid, and one walk over them decides it.  Then
    every box behind the front meets the boxes just kept, cell by cell: kept boxes
    overlap little, so a cell holds few of them, and boxes that one of them suppresses are
    gone before they make pairs among themselves.  So a heap of near-identical boxes
    costs work in proportion to its size.  Rounds end when nothing is undecided; each decides
    at least the best box of every group, and in general a front.  What is undecided is
    stored after each round, so the plan does not grow.
    """
    grp = list(group)
    spark = det.sparkSession
    r = ranked(det, [F.col("score").desc(), F.col("det_id")], group=grp, name="rk")
    narrow = r.select(*grp, "rk", *BOX)
    cell = cell or cell_size(r)
    root, k = scratch_path(spark, "nms-kept"), 0
    schema = T.StructType([*[r.schema[c] for c in grp], T.StructField("rk", T.LongType())])
    undecided = narrow
    while k == 0 or not undecided.isEmpty():
        split = undecided.join(_front(undecided, edges_per_group, grp, cell).hint("merge"), grp)
        split = materialize(split.select(*grp, "rk", *BOX, (F.col("rk") < F.col("_until")).alias("front")), "nms-split")
        front, rest = split.where("front").drop("front"), split.where("NOT front").drop("front")
        gone = _overlapping(front, front, iou_thr, grp, cell).groupBy(*grp).applyInPandas(_greedy(grp), schema)
        front.join(gone.hint("merge"), grp + ["rk"], "left_anti").write.parquet(f"{root}/round={k}")
        kept = spark.read.schema(front.schema).parquet(f"{root}/round={k}")
        hit = _overlapping(kept, rest, iou_thr, grp, cell).select(*grp, F.col("b").alias("rk")).distinct()
        undecided = materialize(rest.join(hit.hint("merge"), grp + ["rk"], "left_anti"), "nms-undecided")
        k += 1
    kept = spark.read.schema(narrow.schema).parquet(*[f"{root}/round={i}" for i in range(k)]).select(*grp, "rk")
    return r.join(kept.hint("merge"), grp + ["rk"]).select(*det.columns)


def postprocess(det: DataFrame, *, score_thr: float = 0.001, nms_pre: int = 30000, min_size: float = 0.0,
                iou_thr: float = 0.65, max_per_img: int = 300) -> DataFrame:
    """score filter -> pre-NMS top-k per image -> size filter -> class-wise NMS -> top-k."""
    scored = confidence_filter(det, score_thr)
    partitions, largest = image_partitions(scored)
    return (scored
               # an image too large to be dealt to one task takes the path that counts by itself
               .transform(lambda d: topk_per_image(d, nms_pre, partitions=partitions if largest <= TOPK_HOT else None))
               .transform(lambda d: min_box_filter(d, min_size))
               # where nms_pre already bounds every group, no hot-group check is needed
               .transform(lambda d: nms(d, iou_thr=iou_thr, max_group=None if nms_pre <= NMS_MAX_GROUP else NMS_MAX_GROUP))
               .transform(lambda d: topk_per_image(d, max_per_img, partitions=partitions)))


# ------------------------------------------------------------------ oracle ---

def nms_oracle_ctes(src: str, thr: float, *, prefix: str = "n", group=("image_id", "category_id")) -> str:
    """DuckDB recursive CTEs computing greedy NMS over ``src``; the kept rows
    are in ``{prefix}_kept`` (same columns as ``src``)."""
    g = ", ".join(group)
    on = " AND ".join(f"d.{c} = r.{c}" for c in group)
    inter = ("greatest(0.0, least(k.x2, d.x2) - greatest(k.x1, d.x1)) * "
             "greatest(0.0, least(k.y2, d.y2) - greatest(k.y1, d.y1))")
    p = prefix
    return f"""
{p}_d AS (SELECT *, (x2 - x1) * (y2 - y1) AS area,
              row_number() OVER (PARTITION BY {g} ORDER BY score DESC, det_id) AS rn FROM {src}),
{p}_r AS (
  SELECT {g}, rn, [{{'det_id': det_id, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2, 'area': area}}] AS kept
  FROM {p}_d WHERE rn = 1
  UNION ALL
  SELECT {", ".join("r." + c for c in group)}, d.rn,
         CASE WHEN len(list_filter(r.kept, lambda k: {inter} > {float(thr)!r} * (k.area + d.area - {inter}))) > 0
              THEN r.kept
              ELSE list_append(r.kept, {{'det_id': d.det_id, 'x1': d.x1, 'y1': d.y1, 'x2': d.x2, 'y2': d.y2, 'area': d.area}}) END
  FROM {p}_r r JOIN {p}_d d ON {on} AND d.rn = r.rn + 1),
{p}_last AS (SELECT {g}, max(rn) AS rn FROM {p}_d GROUP BY {g}),
{p}_ids AS (SELECT unnest(r.kept).det_id AS det_id FROM {p}_r r JOIN {p}_last l USING ({g}, rn)),
{p}_kept AS (SELECT s.* FROM {src} s WHERE s.det_id IN (SELECT det_id FROM {p}_ids))"""
