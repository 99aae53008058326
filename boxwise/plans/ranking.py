"""Positions in a total order without moving a group into one task.

``row_number()`` over an unpartitioned (or few-key) window sends every row of
the group through one task.  ``ranked`` instead

1. range-partitions the rows on ``group + order`` (balanced by sampling, and
   split *inside* a hot group because the order columns are part of the key),
2. sorts inside each partition and numbers rows with
   ``monotonically_increasing_id`` (partition id in the upper bits, local index
   in the lower 33 bits),
3. counts rows per ``(partition, group)`` segment - at most
   ``partitions + groups`` rows - and turns the counts into offsets with a
   window over that small table,
4. joins the offsets back.  The segment table is stored and counted: up to
   ``BROADCAST_SEGMENTS`` rows it is broadcast, a larger one (many groups) takes a
   merge join.

``as_of`` finds, by the same segments, the last write before each read of a group.

The numbered rows are written as Parquet under the shared ``spark.checkpoint.dir``
(``session.materialize``) before the two uses: range bounds come from a sample,
and a second evaluation over a re-run upstream shuffle could draw other bounds
and number rows differently.  The written copy also cuts the lineage, so a lost
executor does not re-run the upstream plan, and the order is evaluated once.
Rank narrow tables (ids and order keys), then join wide payloads to the positions.

There is one path for every size: no probe decides it, and no group meets one
task.  Use ``group`` for a bounded number of groups (categories x thresholds,
splits, streams); for many small groups call a plain window directly.  The order
must be total (end it with a unique id) so positions are stable when a task is
retried.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxwise.session import default_parallelism, materialize

_LOW = (1 << 33) - 1
BROADCAST_SEGMENTS = 500_000       # rows of some tens of bytes: about 50 MB at most


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def segmented(df: DataFrame, order: Sequence, *, group: Sequence[str] = (), partitions: int | None = None,
              keep: Sequence[str] | None = None, codec: str | None = None) -> DataFrame:
    """The rows in total order, written once: ``_pid`` numbers the range partition,
    ``_i`` the row inside it.  ``keep`` names the columns to write, where the order's are not needed."""
    n = partitions or default_parallelism(df.sparkSession)
    keys = [F.col(g) for g in group] + [_col(o) for o in order]
    r = (df.repartitionByRange(n, *keys)
           .sortWithinPartitions(*keys)
           .withColumn("_mid", F.monotonically_increasing_id()))
    r = (r.withColumn("_pid", F.shiftright("_mid", 33))
          .withColumn("_i", F.col("_mid").bitwiseAND(F.lit(_LOW)))
          .drop("_mid"))
    if keep is not None:
        r = r.select("_pid", "_i", *keep)
    r = materialize(r, "ranked", codec)
    return r


def ranked(df: DataFrame, order: Sequence, *, group: Sequence[str] = (), name: str = "pos",
           partitions: int | None = None, sums: Sequence[str] = ()) -> DataFrame:
    """Add ``name``: the 0-based position of each row inside ``group`` in ``order``,
    and ``<c>_cum`` (running sum, current row included) for each column in ``sums``."""
    group, sums = list(group), list(sums)
    r = segmented(df, order, group=group, partitions=partitions)
    seg = r.groupBy("_pid", *group).agg(F.min("_i").alias("_first"), F.count(F.lit(1)).alias("_n"),
                                        *[F.sum(c).alias(f"_t{c}") for c in sums])
    w = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1) \
        if group else Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    seg = seg.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    if sums:
        seg = seg.withColumns({f"_o{c}": F.coalesce(F.sum(f"_t{c}").over(w), F.lit(0)) for c in sums}) \
            .drop(*[f"_t{c}" for c in sums])
    out = _with_segments(r, seg, group)
    out = out.withColumn(name, F.col("_off") + F.col("_i") - F.col("_first"))
    if sums:
        # running sums inside each (range partition, group) segment: every
        # segment is at most one range partition, so this window is balanced
        loc = Window.partitionBy("_pid", *group).orderBy("_i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = out.withColumns({f"{c}_cum": F.col(f"_o{c}") + F.sum(c).over(loc) for c in sums})
    return out.drop("_pid", "_i", "_first", "_off", *[f"_o{c}" for c in sums])


def _with_segments(r: DataFrame, seg: DataFrame, group: Sequence[str]) -> DataFrame:
    """Rows with the columns of their segment (``_pid`` and ``group``)."""
    seg = seg.select([F.col(c).alias(f"_s{c}") if c in ("_pid", *group) else F.col(c) for c in seg.columns])
    seg = materialize(seg, "segments")
    seg = F.broadcast(seg) if seg.count() <= BROADCAST_SEGMENTS else seg.hint("merge")
    conds = [F.col(c).eqNullSafe(F.col(f"_s{c}")) for c in ("_pid", *group)]
    return r.join(seg, reduce(lambda a, b: a & b, conds), "inner").drop(*[f"_s{c}" for c in ("_pid", *group)])


def as_of(reads: DataFrame, writes: DataFrame, *, group: Sequence[str], order: str, value: str,
          partitions: int | None = None) -> DataFrame:
    """``reads`` with ``value``: that of the last of ``writes`` in the same ``group`` whose
    ``order`` is not behind the read's; reads before every write of their group get null.
    Writes of a group must differ in ``order``.

    Reads and writes are range-partitioned together, so a group with many rows is split;
    the last write of each segment is carried to the segments behind it through the
    segment table, and a read looks no further back than its own segment's start."""
    group = list(group)
    both = (writes.select(*group, order, F.struct(value).alias("_v")).withColumn("_read", F.lit(False))
            .unionByName(reads.withColumn("_read", F.lit(True)), allowMissingColumns=True))
    r = segmented(both, [order, "_read"], group=group, partitions=partitions)
    seg = r.groupBy("_pid", *group).agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col("_i"))).alias("_last"))
    behind = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    seg = seg.select("_pid", *group, F.last("_last", ignorenulls=True).over(behind).alias("_carried"))
    inside = Window.partitionBy("_pid", *group).orderBy("_i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = r.withColumn("_v", F.last("_v", ignorenulls=True).over(inside)).where("_read")
    out = _with_segments(local, seg, group)
    return out.select(*reads.columns, F.coalesce("_v", "_carried")[value].alias(value))
