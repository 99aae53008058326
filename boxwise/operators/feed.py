"""Feeding a trainer: reproducible epoch order, partitioning and batches.

Contract K5: key ``md5(seed:epoch:id)`` (ties by id) gives the global position
``pos``; the sample space is cut evenly into ``num_canonical_nodes`` ranges
(``floor(pos * ncn / N)``); canonical node ``c`` runs on physical node
``c % nodes``; inside a canonical node the ``j``-th sample goes to device
``j % ranks`` and loader worker ``(j // ranks) % workers``; each (node, rank,
worker) stream is cut into batches of ``batch_size``.  All positions come from
the distributed ranking, never from a single-task window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxwise.functions.draws import DEFAULT_SEED, order_key
from boxwise.plans.ranking import ranked
from boxwise.session import materialize


def epoch_order(df: DataFrame, *, seed: int = DEFAULT_SEED, epoch: int = 0, shuffle: bool = True,
                block_size: int | None = None, id_col: str = "image_id") -> DataFrame:
    """Add ``pos``.  With ``block_size`` the shuffle stays inside blocks of that
    many samples (in id order)."""
    if not shuffle:
        return ranked(df, [id_col])
    d = df.withColumn("_k", order_key(id_col, seed, epoch))
    if block_size:
        d = ranked(d, [id_col], name="_nat").withColumn("_blk", F.floor(F.col("_nat") / block_size))
        return ranked(d, ["_blk", "_k", id_col]).drop("_k", "_nat", "_blk")
    return ranked(d, ["_k", id_col]).drop("_k")


def _canonical(d: DataFrame, n: int, ncn: int) -> DataFrame:
    """Add ``canonical_node`` and ``_j``, the place in it, by arithmetic on ``pos``."""
    return (d.withColumn("canonical_node", F.floor(F.col("pos") * ncn / F.lit(n)).cast("bigint"))
             .withColumn("_j", F.col("pos") - F.expr(f"(canonical_node * {n} + {ncn - 1}) div {ncn}")))


def _canonical_sizes(spark, n: int, ncn: int) -> DataFrame:
    """``_c, _size`` of every canonical node."""
    return spark.range(ncn).select(F.col("id").alias("_c"), F.expr(
        f"((id + 1) * {n} + {ncn - 1}) div {ncn} - (id * {n} + {ncn - 1}) div {ncn}").alias("_size"))


def _held(sizes: DataFrame, *, nodes: int, lanes: int) -> DataFrame:
    """``_c, _q, _held, _before``: samples of canonical node ``_c`` in lane ``_q``, and those of
    the canonical nodes before it in the same stream (a table of canonical nodes x lanes)."""
    before = Window.partitionBy("_node", "_q").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    return (sizes.select("_c", "_size", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(lanes - 1).cast("bigint"))).alias("_q"))
            .withColumn("_node", F.col("_c") % nodes)
            .withColumn("_held", F.greatest(F.lit(0), F.expr(f"(_size - _q + {lanes - 1}) div {lanes}")))
            .select("_c", "_q", "_held", F.coalesce(F.sum("_held").over(before), F.lit(0)).alias("_before")))


def _deal(d: DataFrame, sizes: DataFrame, *, nodes: int, ranks: int, workers: int) -> DataFrame:
    """Add ``node, rank, worker, idx`` to rows with ``canonical_node`` and the place ``_j`` in
    it.  The place in a stream needs no second ranking: the samples of earlier canonical
    nodes of the same node are counted by arithmetic."""
    lanes = ranks * workers
    d = (d.withColumn("node", (F.col("canonical_node") % nodes).cast("int"))
          .withColumn("rank", (F.col("_j") % ranks).cast("int"))
          .withColumn("worker", (F.floor(F.col("_j") / ranks) % workers).cast("int")))
    held = _held(sizes, nodes=nodes, lanes=lanes).select("_c", "_q", "_before")
    return (d.join(held, (F.col("canonical_node") == F.col("_c")) & (F.col("_j") % lanes == F.col("_q")))
             .withColumn("idx", (F.col("_before") + F.expr(f"_j div {lanes}")).cast("bigint"))
             .drop("_j", "_c", "_before", "_q"))


def epoch_plan(df: DataFrame, *, seed: int = DEFAULT_SEED, epoch: int = 0, nodes: int = 1, ranks: int = 1,
               workers: int = 1, batch_size: int = 2, drop_last: bool = False,
               num_canonical_nodes: int | None = None, shuffle: bool = True,
               block_size: int | None = None, id_col: str = "image_id") -> DataFrame:
    """Per sample: ``pos, canonical_node, node, rank, worker, idx, batch_id``."""
    d = epoch_order(df, seed=seed, epoch=epoch, shuffle=shuffle, block_size=block_size, id_col=id_col)
    n = d.count()  # one scalar, of the stored positions; the plan depends on the dataset length
    ncn = num_canonical_nodes or 64 * nodes
    d = _deal(_canonical(d, n, ncn), _canonical_sizes(df.sparkSession, n, ncn), nodes=nodes, ranks=ranks, workers=workers)
    d = d.withColumn("batch_id", F.floor(F.col("idx") / batch_size).cast("bigint"))
    if drop_last:
        full = d.groupBy("node", "rank", "worker").agg(F.floor(F.count(F.lit(1)) / batch_size).alias("_full"))
        d = d.join(full, ["node", "rank", "worker"]).where(F.col("batch_id") < F.col("_full")).drop("_full")
    return d


def resume_epoch(plan: DataFrame, consumed, *, nodes: int, ranks: int, workers: int, new_nodes: int, new_ranks: int,
                 new_workers: int, batch_size: int) -> DataFrame:
    """The rest of an interrupted epoch on another cluster shape, exact to the sample.

    ``plan``: an epoch plan (or what this function returned) for ``nodes`` x ``ranks`` x
    ``workers`` streams; ``consumed``: the samples every stream has read, one number or a
    table ``node, rank, worker, consumed`` (streams not named have read none).  What remains
    of a canonical node keeps its order and is dealt again over the new streams, so
    samples keep their canonical node and none is read twice or lost.

    Nothing is ranked again: in a canonical node lane ``q`` has read a known prefix of its
    samples, so the remaining ones before a sample are counted by arithmetic over the lanes.
    """
    lanes = ranks * workers
    sizes = materialize(plan.groupBy(F.col("canonical_node").alias("_c")).agg(F.count(F.lit(1)).alias("_size")), "resume-sizes")
    if isinstance(consumed, DataFrame):
        read = consumed.select((F.col("node")).alias("_node"), (F.col("rank") + F.col("worker") * ranks).alias("_lane"),
                               F.col("consumed").alias("_read"))
        held = _held(sizes, nodes=nodes, lanes=lanes)
        held = held.join(read, (held._c % nodes == read._node) & (held._q == read._lane), "left") \
            .withColumn("_read", F.coalesce("_read", F.lit(0)))
    else:
        held = _held(sizes, nodes=nodes, lanes=lanes).withColumn("_read", F.lit(int(consumed)))
    # what each lane has read of the canonical node: a prefix of its samples there
    held = held.withColumn("_used", F.greatest(F.lit(0), F.least("_held", F.col("_read") - F.col("_before"))))
    used = held.groupBy("_c").agg(F.array_sort(F.collect_list(F.struct("_q", "_before", "_used"))).alias("_lanes"))
    used = materialize(used.select("_c", F.col("_lanes._before").alias("_before"), F.col("_lanes._used").alias("_used")),
                       "resume-used")
    q = F.col("rank") + F.col("worker") * ranks
    d = plan.join(used, F.col("canonical_node") == F.col("_c")).withColumn("_q", q.cast("int"))
    d = d.withColumn("_k", F.col("idx") - F.get("_before", F.col("_q"))).where(F.col("_k") >= F.get("_used", F.col("_q")))
    d = d.withColumn("_j", F.expr("aggregate(transform(_used, (u, p) -> greatest(0L, _k + if(p < _q, 1L, 0L) - u)), 0L, "
                                  "(s, x) -> s + x)"))
    left = sizes.join(used, "_c").select("_c", F.expr("_size - aggregate(_used, 0L, (s, x) -> s + x)").alias("_size"))
    kept = [c for c in plan.columns if c not in ("node", "rank", "worker", "idx", "batch_id")]
    d = _deal(d.select(*kept, "_j"), left, nodes=new_nodes, ranks=new_ranks, workers=new_workers)
    return d.withColumn("batch_id", F.floor(F.col("idx") / batch_size).cast("bigint"))


def shard_epoch_plan(samples: DataFrame, *, seed: int = DEFAULT_SEED, epoch: int = 0, nodes: int = 1, ranks: int = 1,
                     workers: int = 1, batch_size: int = 2, num_canonical_nodes: int | None = None, block_size: int = 1 << 18,
                     id_col: str = "sample_id", shard_col: str = "shard", order_col: str = "pos") -> DataFrame:
    """Epoch plan that keeps a worker to few shards at a time: shards are shuffled
    (``md5(seed:epoch:shard)``), their samples follow in stored order and are cut evenly into
    canonical nodes, and inside a canonical node samples are shuffled within spans of
    ``block_size``.  A worker then holds open the shards of a span (and of the next,
    while it crosses), where the global order has all of them open.  ``pos`` is the
    place in the epoch; the rest as in :func:`epoch_plan`."""
    ncn = num_canonical_nodes or 64 * nodes
    sizes = samples.groupBy(shard_col).agg(F.count(F.lit(1)).alias("_n")).withColumn("_k", order_key(shard_col, seed, epoch))
    ahead = ranked(sizes, ["_k", shard_col], name="_r", sums=["_n"]).select(
        F.col(shard_col).alias("_shard"), (F.col("_n_cum") - F.col("_n")).alias("_ahead"))
    n = samples.count()
    inside = Window.partitionBy(shard_col).orderBy(order_col, id_col)       # a shard is bounded by its size limit
    d = samples.withColumn("_o", F.row_number().over(inside) - 1).join(ahead, F.col(shard_col) == F.col("_shard"))
    d = _canonical(d.withColumn("pos", F.col("_ahead") + F.col("_o")).drop("_o", "_shard", "_ahead"), n, ncn)
    span = Window.partitionBy("canonical_node", "_span").orderBy("_k", id_col)   # bounded by block_size
    d = (d.withColumn("_span", F.expr(f"_j div {block_size}")).withColumn("_k", order_key(id_col, seed, epoch))
          .withColumn("_first", F.col("pos") - F.col("_j"))
          .withColumn("_j", F.col("_span") * block_size + F.row_number().over(span) - 1)
          .withColumn("pos", F.col("_first") + F.col("_j")).drop("_span", "_k", "_first"))
    d = _deal(d, _canonical_sizes(samples.sparkSession, n, ncn), nodes=nodes, ranks=ranks, workers=workers)
    return d.withColumn("batch_id", F.floor(F.col("idx") / batch_size).cast("bigint"))


def open_shards(plan: DataFrame, *, shard_col: str = "shard") -> DataFrame:
    """``node, rank, worker, shards, most_open``: how many shards each stream reads, and the
    most it has open at a time (a shard is open from its first sample to its last)."""
    stream = ["node", "rank", "worker"]
    spans = plan.groupBy(*stream, shard_col).agg(F.min("idx").alias("a"), F.max("idx").alias("b"))
    steps = spans.select(*stream, F.explode(F.array(F.struct(F.col("a").alias("at"), F.lit(1).alias("step")),
                                                    F.struct((F.col("b") + 1).alias("at"), F.lit(-1).alias("step")))).alias("s"))
    moves = steps.groupBy(*stream, "s.at").agg(F.sum("s.step").alias("step"))
    sofar = Window.partitionBy(*stream).orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    most = moves.withColumn("open", F.sum("step").over(sofar)).groupBy(*stream).agg(F.max("open").alias("most_open"))
    return spans.groupBy(*stream).agg(F.count(F.lit(1)).alias("shards")).join(most, stream)


def aspect_ratio_batches(images: DataFrame, *, batch_size: int, order_col: str = "pos") -> DataFrame:
    """Batches that hold one orientation only (bucket 0: width < height)."""
    d = images.withColumn("bucket", F.when(F.col("width") < F.col("height"), 0).otherwise(1))
    d = ranked(d, [order_col], group=["bucket"], name="_r")
    return d.withColumn("batch_id", F.floor(F.col("_r") / batch_size).cast("bigint")).drop("_r")


def first_batch(df: DataFrame, batch_size: int, *, order_col: str | list = "pos") -> DataFrame:
    """Take one batch and stop (a distributed top-k: per-task limit, then merge)."""
    return df.orderBy(*([order_col] if isinstance(order_col, str) else order_col)).limit(batch_size)


def epoch_sample(df: DataFrame, epoch_size: int, *, order_col: str = "pos") -> DataFrame:
    """Draw ``epoch_size`` samples in permuted order: whole passes, then the
    first ``epoch_size % N`` samples.  Each row is repeated by a generator."""
    n = df.count()
    reps, rem = divmod(int(epoch_size), n) if n else (0, 0)
    copies = F.lit(reps) + F.when(F.col(order_col) < rem, 1).otherwise(0)
    d = df.withColumn("_c", copies).where(F.col("_c") > 0)
    d = d.withColumn("rep", F.explode(F.sequence(F.lit(0), F.col("_c") - 1))).drop("_c")
    return d.withColumn("sample_idx", F.col("rep") * n + F.col(order_col))


def collate_batches(df: DataFrame, *, batch_cols=("batch_id",), order_col: str = "idx", cols=None) -> DataFrame:
    """One row per batch with its samples in order (groups of ``batch_size``)."""
    cols = cols or [c for c in df.columns if c not in batch_cols]
    item = F.struct(F.col(order_col).alias("_o"), *[F.col(c) for c in cols if c != order_col])
    return df.groupBy(*batch_cols).agg(F.sort_array(F.collect_list(item)).alias("samples"))
