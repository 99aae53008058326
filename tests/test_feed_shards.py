"""Epoch plans, batches and size-limited shards."""
import pytest

from pyspark.sql import functions as F

from boxwise import fixtures as fx
from boxwise.operators import dataset as ds
from boxwise.operators import feed as fd
from boxwise.plans import shards as sh
from boxwise.session import scratch_path


def _samples(spark, sf):
    return fx.images(spark, sf).select(F.col("id").alias("image_id"), "width", "height")


def test_epoch_plan_covers_every_sample_once(spark, sf):
    s = _samples(spark, sf)
    p = fd.epoch_plan(s, nodes=2, ranks=2, workers=2, batch_size=8)
    assert p.count() == s.count() == p.select("image_id").distinct().count()
    sizes = p.groupBy("node", "rank", "worker", "batch_id").count()
    assert sizes.agg(F.max("count")).first()[0] <= 8
    dl = fd.epoch_plan(s, nodes=2, ranks=2, workers=2, batch_size=8, drop_last=True)
    assert dl.groupBy("node", "rank", "worker", "batch_id").count().where("count <> 8").count() == 0
    # another epoch gives another order, the same seed and epoch the same one
    a = {r["image_id"]: r["pos"] for r in fd.epoch_order(s, epoch=1).collect()}
    b = {r["image_id"]: r["pos"] for r in fd.epoch_order(s, epoch=1).collect()}
    c = {r["image_id"]: r["pos"] for r in fd.epoch_order(s, epoch=2).collect()}
    assert a == b and a != c


def test_aspect_batches_hold_one_orientation(spark, sf):
    b = fd.aspect_ratio_batches(ds.shuffle_samples(_samples(spark, sf)), batch_size=4)
    assert b.groupBy("bucket", "batch_id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] <= 4
    bad = b.where(((F.col("width") < F.col("height")) & (F.col("bucket") != 0)) |
                  ((F.col("width") >= F.col("height")) & (F.col("bucket") != 1)))
    assert bad.count() == 0


def test_epoch_sample_sizes(spark, sf):
    s = ds.shuffle_samples(_samples(spark, sf))
    n = s.count()
    for size in (100, n + 37):
        e = fd.epoch_sample(s, size)
        assert e.count() == size
        assert e.select("sample_idx").distinct().count() == size


def _greedy(sizes, limit):
    out, cur, used = [], 0, 0
    for x in sizes:
        if used > 0 and used + x > limit:
            cur, used = cur + 1, 0
        used += x
        out.append(cur)
    return out


def test_shard_plan_greedy_and_limits(spark, sf):
    docs = fx.documents(spark, sf)
    limit = 65536
    plan = sh.shard_plan(docs, size_limit=limit, lanes=1)
    rows = sorted(plan.where("split = 'train'").collect(), key=lambda r: r["pos"])
    assert [r["shard"] for r in rows] == _greedy([r["nbytes"] for r in rows], limit)
    multi = sh.shard_plan(docs, size_limit=limit, lanes=3)
    assert multi.count() == docs.count() == multi.select("sample_id").distinct().count()
    per = multi.groupBy("split", "shard").agg(F.sum("nbytes").alias("b"), F.count("*").alias("n"))
    assert per.where("b > 65536 AND n > 1").count() == 0


def test_write_validate_and_tamper(spark, sf):
    root = scratch_path(spark, "test-shards")
    man = sh.write_shards(fx.documents(spark, sf), root, size_limit=65536, shards_per_lane=4)
    rows = man.collect()
    assert sum(r["n_samples"] for r in rows) == fx.documents(spark, sf).count()
    assert sh.validate_hashes(spark, root, man).count() == 0
    assert sh.read_split(spark, root, "val").count() == fx.documents(spark, sf).where("split = 'val'").count()
    import os
    victim = os.path.join(root.replace("file:", ""), rows[0]["rel_path"])
    crc = os.path.join(os.path.dirname(victim), "." + os.path.basename(victim) + ".crc")
    if os.path.exists(crc):  # the local filesystem would refuse the read itself
        os.remove(crc)
    with open(victim, "ab") as f:
        f.write(b"x")
    assert sh.validate_hashes(spark, root, man).count() == 1
    # a moved copy is judged by the same manifest: only the changed shard differs
    from boxwise.sinks.files import copy_tree
    moved = scratch_path(spark, "test-moved")
    copy_tree(spark, root, moved)
    assert [r["rel_path"] for r in sh.validate_hashes(spark, moved, man).collect()] == [rows[0]["rel_path"]]


@pytest.mark.parametrize("old,new", [((1, 2, 2), (3, 1, 3)), ((2, 2, 1), (1, 4, 2)), ((3, 1, 2), (2, 3, 1))])
def test_resumption_reads_each_sample_once(spark, old, new):
    n = 1203
    shape = dict(zip(("nodes", "ranks", "workers"), old))
    plan = fd.epoch_plan(spark.range(n).withColumnRenamed("id", "image_id"), batch_size=4, num_canonical_nodes=6, **shape)
    rows = [r.asDict() for r in plan.collect()]
    streams = sorted({(r["node"], r["rank"], r["worker"]) for r in rows})
    read = {s: 7 * i + 5 for i, s in enumerate(streams)}
    table = spark.createDataFrame([(*s, c) for s, c in list(read.items())[1:]], "node int, rank int, worker int, consumed bigint")
    read[streams[0]] = 0                                     # not named: nothing read
    again = dict(zip(("new_nodes", "new_ranks", "new_workers"), new))
    for consumed, of in ((table, read), (37, dict.fromkeys(streams, 37)), (0, dict.fromkeys(streams, 0)), (n, dict.fromkeys(streams, n))):
        left = [r.asDict() for r in fd.resume_epoch(plan, consumed, **shape, **again, batch_size=5).collect()]
        gone = {r["image_id"] for r in rows if r["idx"] < of[r["node"], r["rank"], r["worker"]]}
        assert sorted([r["image_id"] for r in left] + list(gone)) == list(range(n))
        by = {}
        for r in sorted(left, key=lambda r: r["pos"]):
            assert r["node"] == r["canonical_node"] % new[0]
            by.setdefault(r["canonical_node"], []).append(r)
        for c in by.values():                                # the rest of a canonical node keeps its order
            assert [(r["rank"], r["worker"]) for r in c] == [(j % new[1], j // new[1] % new[2]) for j in range(len(c))]
        stream = {}
        for r in sorted(left, key=lambda r: (r["canonical_node"], r["pos"])):
            s = stream.setdefault((r["node"], r["rank"], r["worker"]), [])
            assert r["idx"] == len(s) and r["batch_id"] == len(s) // 5
            s.append(r)
    # interrupted again, on the second shape
    first = fd.resume_epoch(plan, 37, **shape, **again, batch_size=5)
    second = fd.resume_epoch(first, 20, **dict(zip(("nodes", "ranks", "workers"), new)), new_nodes=1, new_ranks=1, new_workers=1, batch_size=2)
    seen = [r["image_id"] for r in rows if r["idx"] < 37] + [r.image_id for r in first.where("idx < 20").collect()]
    rest = second.orderBy("idx").collect()
    assert [r.idx for r in rest] == list(range(len(rest))) and sorted(seen + [r.image_id for r in rest]) == list(range(n))


def test_shard_aware_order_opens_few_shards(spark):
    """Spans bound the shards a worker has open; the global order opens them all."""
    n, per = 4000, 25
    samples = spark.range(n).selectExpr("id AS sample_id", f"id div {per} AS shard", f"id % {per} AS pos")
    shape = dict(ranks=2, workers=2, batch_size=8, num_canonical_nodes=2)
    plan = fd.shard_epoch_plan(samples, block_size=100, **shape)
    rows = plan.collect()
    assert sorted(r.pos for r in rows) == list(range(n)) and len({r.sample_id for r in rows}) == n
    spans = {}
    for r in rows:
        spans.setdefault((r.canonical_node, r.pos % (n // 2) // 100), set()).add(r.shard)
    most = max(len(s) for s in spans.values())
    assert most <= 100 // per + 1
    open_ = fd.open_shards(plan).collect()
    assert len(open_) == 4 and all(r.most_open <= 2 * most for r in open_)
    # against a plain count at every step
    for o in open_:
        mine = sorted((r.idx, r.shard) for r in rows if (r.node, r.rank, r.worker) == (o.node, o.rank, o.worker))
        ends = {}
        for i, s in mine:
            ends[s] = (ends.get(s, (i, i))[0], i)
        assert o.shards == len(ends)
        assert o.most_open == max(sum(a <= i <= b for a, b in ends.values()) for i, _ in mine)
    other = fd.epoch_plan(samples.drop("pos"), id_col="sample_id", **shape)
    assert min(r.most_open for r in fd.open_shards(other).collect()) > 10 * most
    again = {r.sample_id: r.pos for r in fd.shard_epoch_plan(samples.repartition(7), block_size=100, **shape).collect()}
    assert again == {r.sample_id: r.pos for r in rows}
    assert again != {r.sample_id: r.pos for r in fd.shard_epoch_plan(samples, block_size=100, epoch=1, **shape).collect()}


def test_validate_hashes_lists_and_hashes_once(spark, sf, monkeypatch):
    """The manifest is stored, and made of shards listed by the caller."""
    from boxwise import registry as r
    made, listed = [], []
    manifest, counts = sh.shard_manifest, sh.shard_counts
    monkeypatch.setattr(sh, "shard_manifest", lambda *a: made.append(a) or manifest(*a))
    monkeypatch.setattr(sh, "shard_counts", lambda *a: listed.append(len(a) > 2 and a[2] is not None) or counts(*a))
    stored = []
    keep = r.materialize
    monkeypatch.setattr(r, "materialize", lambda df, name: stored.append(name) or keep(df, name))
    assert sorted(x.issue for x in r.QUERIES["validate_hashes"](spark, sf).collect()) == ["changed", "missing"]
    assert stored == ["manifest"] and len(made) == 2 and listed == [False, True]
