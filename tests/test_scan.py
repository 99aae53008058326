"""Prefix scan with vector state, as-of lookups, parallel packing: against plain loops."""
import random
import resource
from functools import partial

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from boxwise.operators import evaluate as ev
from boxwise.plans import shards as sh
from boxwise.plans.ranking import as_of, segmented
from boxwise.plans.scan import replayed, totals_before


@pytest.mark.parametrize("partitions", [1, 9])
def test_replayed_sums_equal_a_loop(spark, partitions):
    def _two(rows: pa.RecordBatch) -> np.ndarray:
        v = rows.column("v").to_numpy()
        return np.stack([v, v * v], 1)

    class _Running:
        def __init__(self, head):
            self.g, self.run, self.out = head["g"], np.array(head["before"]), []

        def step(self, rows):
            run = np.cumsum(_two(rows), 0) + self.run
            self.run = run[-1]
            self.out += list(zip(rows.column("id").to_pylist(), *run.T.tolist()))

        def end(self):
            ids, a, b = zip(*self.out)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                              names=["id", "a", "b"])

    d = spark.range(3000).selectExpr("id", "id % 7 * (id % 2) AS g", "id * 7919 % 1009 AS k", "id % 13 AS v")
    seg = segmented(d, ["k", "id"], group=["g"], partitions=partitions)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        heads = totals_before(seg, "g", _two, ["v"])
        got = {r.id: (r.a, r.b) for r in replayed(seg, heads, "g", ["id", "v"], _Running, _Running.step, _Running.end,
                                                  "id bigint, a bigint, b bigint").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    sums = {}
    for i in sorted(range(3000), key=lambda i: (i * 7919 % 1009, i)):
        g, v = i % 7 * (i % 2), i % 13
        a, b = sums.get(g, (0, 0))
        sums[g] = a + v, b + v * v
        assert got[i] == sums[g]
    assert len(got) == 3000


def test_curve_of_one_large_segment_in_bounded_memory(spark):
    """Five million detections of one category in one segment: the counters of all of them
    would take 84 * 8 bytes each, 3.4 GB; a worker gets 1.5 GB of address space above what
    it has."""
    n = 5_000_000
    seg = spark.range(0, n, 1, 1).selectExpr("0L AS _pid", "id AS _i", "1L AS category_id", "cast(id % 20000 AS double) AS size",
                                             *[f"{'id % 1024' if k == 'tp' else '0L'} AS {k}_{name}" for name, _, _ in ev.AREA_RANGES
                                               for k in ("tp", "ig")])
    names = [f"{k}_{name}" for name, _, _ in ev.AREA_RANGES for k in ("tp", "ig")]
    heads = spark.createDataFrame([(0, 1, [0] * 84, [n] * 4)], "_pid bigint, category_id bigint, before array<bigint>, npig array<bigint>")

    class Bounded(ev._Bands):
        def __init__(self, *args):
            now = int(open("/proc/self/statm").read().split()[0]) * resource.getpagesize()
            resource.setrlimit(resource.RLIMIT_AS, (now + (1500 << 20), resource.RLIM_INFINITY))
            super().__init__(*args)

        def rows(self):
            resource.setrlimit(resource.RLIMIT_AS, (resource.RLIM_INFINITY, resource.RLIM_INFINITY))
            return super().rows()

    got = replayed(seg, heads, "category_id", ["size", *names], partial(Bounded, ev.IOU_THRS, ev.AREA_RANGES), Bounded.step,
                   Bounded.rows, "area string, category_id bigint, iou_thr double, b int, mp double")
    top = got.where("area = 'all' AND iou_thr = 0.5").agg(F.max("b"), F.max("mp")).first()
    assert top[0] == 50 and 0.5 <= top[1] <= 1.0


def test_as_of_equals_a_loop(spark):
    rng = random.Random(2)
    writes = [(g, o, f"{g}.{o}" if rng.random() < 0.9 else None) for g in (None, 1, 2) for o in rng.sample(range(400), 120)]
    reads = [(rng.choice([None, 1, 1, 1, 2, 3]), rng.randrange(400), i) for i in range(1500)]
    w = spark.createDataFrame(writes, "g int, o int, v string")
    r = spark.createDataFrame(reads, "g int, o int, i int")
    for n in (1, 13):
        got = {x.i: x.v for x in as_of(r, w, group=["g"], order="o", value="v", partitions=n).collect()}
        assert len(got) == len(reads)
        for g, o, i in reads:
            before = [(p, v) for h, p, v in writes if h == g and p <= o]
            assert got[i] == (max(before)[1] if before else None)


def plain(sizes, limit):
    out, shard, used = [], 0, 0
    for s in sizes:
        if used > 0 and used + s > limit:
            shard, used = shard + 1, 0
        used += s
        out.append(shard)
    return out


def test_ranges_compose_to_the_plain_loop():
    rng = random.Random(1)
    for _ in range(3000):
        limit, n = rng.choice([1, 5, 10, 30]), rng.randint(1, 25)
        sizes = np.array([rng.choice([0, 0, 1, 2, 3, 5, 8, 12, 40]) for _ in range(n)])
        cuts = sorted(rng.sample(range(1, n), min(n - 1, rng.randint(0, 5))))
        used, shards, got = 0, 0, []
        for a, b in zip([0, *cuts], [*cuts, n]):
            x = sh.Range(sizes[a:b], limit)
            mark = np.zeros(b - a, int)
            mark[x.starts(used)] = 1
            got += (np.cumsum(mark) + shards).tolist()
            more, used = sh.after(used, limit, x.total, x.first_start(0), *x.jumps())
            shards += more
        assert got == plain(sizes, limit)


def test_one_lane_of_a_million_samples(spark):
    """A sequential writer's shards, packed in ranges."""
    n = 1_000_000
    d = spark.range(n).selectExpr("id AS sample_id", "'val' AS split", "CASE WHEN id % 1000 = 0 THEN 90000L ELSE id * 7919 % 2003 END AS nbytes")
    plan = sh.shard_plan(d, size_limit=1 << 16, lanes=1)
    got = plan.orderBy("pos").select("nbytes", "shard").toPandas()
    assert len(got) == n and got["shard"].tolist() == plain(got["nbytes"].tolist(), 1 << 16)


def test_no_task_holds_more_than_its_range(spark):
    d = spark.range(20_000).selectExpr("id AS pos", "0 AS lane", "'a' AS split", "id % 50 AS nbytes")
    got = sh.packed(d, size_limit=400, partitions=25)
    assert [r.shard for r in got.orderBy("pos").collect()] == plain([i % 50 for i in range(20_000)], 400)
    plan = got._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan and "cogroup" in plan.lower()
