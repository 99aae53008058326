"""Prefix scan with vector state over range-partitioned, sorted rows.

Some results need, at each row, running sums of many counters over all rows before it in
an order: a precision curve needs dozens.  Window functions would carry every counter as a
column of every row.  Here the counters exist in numpy batches only:

1. rows are range-partitioned and sorted (``ranking.segmented``); a *segment* is a
   group's part of a range partition;
2. a pass over the stored rows sums the counters of each segment, batch by batch;
3. an exclusive prefix over the segment table gives each segment the totals before it;
4. a pass over the rows in order replays each segment in batches, from those totals on.

Memory in a task is a batch's counters, whatever the size of a segment or a group; the
segment table has (partitions + groups) rows.
"""

from __future__ import annotations

import json
from typing import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _runs(batch: pa.RecordBatch, keys: Sequence[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """(key, rows) of the consecutive runs of equal keys in a batch."""
    cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
    change = np.zeros(batch.num_rows, bool)
    change[:1] = True
    for c in cols:
        change[1:] |= c[1:] != c[:-1]
    edges = np.append(np.flatnonzero(change), batch.num_rows)
    for low, high in zip(edges, edges[1:]):
        yield tuple(c[low] for c in cols), batch.slice(low, high - low)


def totals_before(segments: DataFrame, group: str, counters: Callable[[pa.RecordBatch], np.ndarray],
                  columns: Sequence[str]) -> DataFrame:
    """``_pid, group, before``: the sums of ``counters`` (rows x width, of ``columns``) over the
    group's rows in earlier range partitions."""
    schema = f"_pid bigint, `{group}` {segments.schema[group].dataType.simpleString()}, totals array<bigint>"

    def task(batches):
        now, total = None, None

        def row():
            return pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int64()), pa.array([now[1]]), pa.array(
                [total.tolist()], pa.list_(pa.int64()))], names=["_pid", group, "totals"])

        for batch in batches:
            for key, run in _runs(batch, ["_pid", group]):
                add = counters(run).sum(0)
                if key == now:
                    total = total + add
                else:
                    if now is not None:
                        yield row()
                    now, total = key, add
        if now is not None:
            yield row()

    # a stored partition may be read by several tasks: their sums meet by key
    parts = segments.select("_pid", group, *columns).mapInArrow(task, schema)
    w = Window.partitionBy(group, "c").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return (parts.select("_pid", group, F.posexplode("totals").alias("c", "v"))
            .groupBy("_pid", group, "c").agg(F.sum("v").alias("v"))
            .withColumn("v", F.coalesce(F.sum("v").over(w), F.lit(0)))
            .groupBy("_pid", group).agg(F.array_sort(F.collect_list(F.struct("c", "v"))).alias("before"))
            .select("_pid", group, F.col("before.v").alias("before")))


def replayed(segments: DataFrame, heads: DataFrame, group: str, columns: Sequence[str], begin: Callable, step: Callable,
             end: Callable, schema: str, *, partitions: int | None = None) -> DataFrame:
    """Rows of the segments in order, segment by segment: ``begin(head)`` makes a segment's
    state from its row of ``heads`` (``_pid, group`` and more, as a dict), ``step(state, rows)`` takes its
    rows batch by batch, ``end(state)`` gives the columns of its result.  Segments without a
    head are passed over.  ``partitions``: the range partitions of ``segments``, each of which one
    task then takes (else as many as the session has, by hash)."""
    # as text: a column of arrays that are null in nearly every row is slow to transfer
    head = F.to_json(F.struct(*[c for c in heads.columns if c not in ("_pid", group)])).alias("_head")
    rows = segments.select("_pid", group, F.col("_i"), *columns)
    marked = heads.select("_pid", group, F.lit(-1).cast("bigint").alias("_i"), head)
    both = rows.unionByName(marked, allowMissingColumns=True)
    # a segment is at most one range partition, and its head sorts before its rows
    dealt = both.repartitionById(partitions, F.col("_pid").cast("int")) if partitions else both.repartition("_pid", group)
    ordered = dealt.sortWithinPartitions("_pid", group, "_i")

    def task(batches):
        now, state = None, None
        for batch in batches:
            for key, run in _runs(batch, ["_pid", group]):
                if key != now:
                    if state is not None:
                        yield end(state)
                    now, state = key, None
                if run.column("_i")[0].as_py() == -1:
                    state = begin({"_pid": int(key[0]), group: key[1].item() if hasattr(key[1], "item") else key[1],
                                   **json.loads(run.column("_head")[0].as_py())})
                    run = run.slice(1)
                if state is not None and run.num_rows:
                    step(state, run)
        if state is not None:
            yield end(state)

    return ordered.mapInArrow(task, schema)
