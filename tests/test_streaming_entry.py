"""Streaming validation, metric smoothing and the driver contract."""

from pyspark.sql import functions as F

from boxwise import fixtures as fx
from boxwise.operators import metrics as mt
from boxwise.session import scratch_path
from boxwise.streaming import shards as ssh


def test_stream_validate_totals(spark, sf):
    root = scratch_path(spark, "t-ann")
    fx.annotations(spark, sf).repartition(4, "image_id").write.parquet(root)
    out, ck = scratch_path(spark, "t-out"), scratch_path(spark, "t-ck")
    q = ssh.stream_validate(ssh.stream_shards(spark, root, spark.read.parquet(root).schema, max_files=1),
                            fx.images(spark, sf), fx.categories(spark, sf), out, ck)
    q.processAllAvailable()
    q.stop()
    r = spark.read.parquet(out).agg(F.sum("n_rows"), F.sum("n_orphans"), F.sum("n_unknown"), F.count("*")).first()
    assert tuple(r)[:3] == (6000, 113, 222)
    assert r[3] == 4  # one micro-batch per file


def test_smooth_metrics_matches_window(spark):
    log = spark.range(1, 131).select(F.lit("r").alias("run"), F.lit("loss").alias("metric"),
                                     F.col("id").alias("iter"), (F.col("id") * 1.0).alias("value"))
    got = {r["iter"]: r["value"] for r in mt.smooth_metrics(log, window=50, every=50).collect()}
    assert got == {50: 25.5, 100: 75.5}
    got2 = {r["iter"]: r["value"] for r in mt.smooth_metrics(log, window=30, every=20).collect()}
    assert got2 == {20: 10.5, 40: 25.5, 60: 45.5, 80: 65.5, 100: 85.5, 120: 105.5}


def test_entry_contract(spark):
    import __spark_entry__ as e
    assert e.entry(spark).count() == 57
    assert set(e.oracle_sql()) <= set(e.queries())
    assert len(e.queries()) >= 80


def test_identity_holds_through_a_restart(spark):
    """Duplicates and split samples that only show against shards read before a restart."""
    root, out, ck = (scratch_path(spark, n) for n in ("t-id-in", "t-id-out", "t-id-ck"))
    schema = "id bigint, image_id bigint"

    def put(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(root)

    def run():
        q = ssh.stream_identity(ssh.stream_shards(spark, root, schema, max_files=1), out, ck)
        q.processAllAvailable()
        q.stop()

    put([(1, 10), (2, 10), (3, 20)])
    put([(4, 30), (5, 30), (5, 30)])
    run()
    assert {(r.kind, r.key, r.n) for r in ssh.findings(spark, out).collect()} == {("record", "5", 2)}
    put([(3, 20), (6, 40), (7, 10)])
    run()
    got = {(r.kind, r.key): r for r in ssh.findings(spark, out).collect()}
    assert {k: r.n for k, r in got.items()} == {("record", "5"): 2, ("record", "3"): 2, ("sample", "20"): 2, ("sample", "10"): 3}
    assert all((r.first_shard != r.last_shard) == (r.key != "5") for r in got.values())


def test_trailing_mean_of_late_files(spark):
    """Files in any order give the batch's trailing means."""
    from boxwise.streaming import metrics as smx
    root, out, ck = (scratch_path(spark, n) for n in ("t-sm-in", "t-sm-out", "t-sm-ck"))
    rows = spark.range(1, 241).selectExpr("concat('r', id % 2) AS run", "'loss' AS metric", "(id + 1) div 2 AS iter",
                                          "cast(id * 7919 % 101 AS double) AS value")
    for k in (3, 0, 4, 1, 2):
        rows.where(f"iter % 5 = {k}").coalesce(1).write.mode("append").parquet(root)
    src = spark.readStream.schema(spark.read.parquet(root).schema).option("maxFilesPerTrigger", 1).parquet(root)
    q = smx.start_metrics(smx.stream_smooth(src, window=30, every=20), out, ck)
    q.processAllAvailable()
    q.stop()
    want = {(r.run, r.iter): r.value for r in mt.smooth_metrics(rows, window=30, every=20).collect()}
    assert len(want) == 12 and {(r.run, r.iter): r.value for r in smx.smoothed(spark, out).collect()} == want


def test_stream_shards_are_bounded(spark, sf):
    """More rows make more shards, not larger ones, so a micro-batch does not grow with the table."""
    from boxwise import registry as r
    n = fx.annotations(spark, sf).count()
    few, many = (spark.read.parquet(r._annotation_shards(spark, sf, *a)) for a in ((), (300,)))
    assert len(few.inputFiles()) == 8 and len(many.inputFiles()) == -(-n // 300)
    assert few.count() == many.count() == n
