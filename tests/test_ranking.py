"""The distributed ranking must equal a single-task row_number."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from boxwise.plans.ranking import ranked


def _data(spark):
    return (spark.range(0, 5000)
            .withColumn("g", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.when(F.col("id") % 7 == 0, "b").otherwise("c")))
            .withColumn("score", (F.col("id") * 7919 % 101).cast("double") / 100))


def test_global_position(spark):
    d = _data(spark)
    r = ranked(d, [F.col("score").desc(), "id"])
    ref = d.withColumn("p2", F.row_number().over(Window.orderBy(F.col("score").desc(), "id")) - 1)
    assert r.join(ref, "id").where("pos <> p2").count() == 0
    assert r.count() == 5000
    # no data row passes a single-partition exchange: only the segment table does
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SinglePartition") <= 1 and "GlobalLimit" not in plan


def test_grouped_position_and_partition_count(spark):
    d = _data(spark)
    ref = d.withColumn("p2", F.row_number().over(Window.partitionBy("g").orderBy(F.col("score").desc(), "id")) - 1)
    for n in (1, 16):
        r = ranked(d, [F.col("score").desc(), "id"], group=["g"], partitions=n)
        assert r.join(ref.select("id", "p2"), "id").where("pos <> p2").count() == 0


def test_running_sums(spark):
    d = _data(spark).withColumn("flag", (F.col("id") % 4 == 0).cast("int"))
    w = Window.partitionBy("g").orderBy(F.col("score").desc(), "id").rowsBetween(Window.unboundedPreceding, 0)
    ref = d.withColumn("c2", F.sum("flag").over(w)).select("id", "c2")
    for n in (1, 7, 40):
        r = ranked(d, [F.col("score").desc(), "id"], group=["g"], sums=["flag"], partitions=n)
        assert r.join(ref, "id").where("flag_cum <> c2").count() == 0
