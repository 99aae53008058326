"""Metric-log stream: count and mean per run, metric and block of iterations, and the
trailing mean.

A stateful streaming aggregation in update mode: each micro-batch emits only
the blocks it changed; ``foreachBatch`` appends them with the batch id and the
latest version of each block is the current value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stream_metrics(log_stream: DataFrame, *, every: int = 50) -> DataFrame:
    blk = F.floor((F.col("iter") - 1) / every).alias("block")
    return log_stream.groupBy("run", "metric", blk).agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"))


def stream_smooth(log_stream: DataFrame, *, window: int = 50, every: int = 50) -> DataFrame:
    """The trailing mean of ``operators.metrics.smooth_metrics`` on a stream: ``run, metric,
    iter, n, value, reached``.

    A row counts for the report points whose window holds it, so the state is a count and a
    sum for each report point and the order in which files and rows arrive does not
    matter: a late row corrects the points it belongs to.  ``reached`` tells whether the
    point's own row has come; points behind the last row of a run have not been."""
    first = (F.ceil(F.col("iter") / every) * every).cast("bigint")
    last = (F.col("iter") + (window - 1)).cast("bigint")
    points = log_stream.where(first <= last).select("run", "metric", "value", F.col("iter").alias("_t"), F.explode(
        F.sequence(first, last, F.lit(every).cast("bigint"))).alias("iter"))
    return points.groupBy("run", "metric", "iter").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("value"), F.max(F.col("_t") == F.col("iter")).alias("reached"))


def smoothed(spark: SparkSession, out: str, *, digits: int = 6) -> DataFrame:
    """``run, metric, iter, value`` of the report points reached so far."""
    d = latest(spark, out, keys=("run", "metric", "iter")).where("reached")
    return d.select("run", "metric", "iter", F.round("value", digits).alias("value"))


def start_metrics(agg: DataFrame, out: str, checkpoint: str):
    def each(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite") \
             .parquet(f"{out}/batch={batch_id}")
    return agg.writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", checkpoint).start()


def latest(spark: SparkSession, out: str, keys=("run", "metric", "block")) -> DataFrame:
    """Current value per key: the version written by the latest batch."""
    d = spark.read.parquet(out)
    cols = [c for c in d.columns if c not in (*keys, "batch_id", "batch")]
    g = d.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.col("batch_id")).alias("v"))
    return g.select(*keys, *[F.col(f"v.{c}").alias(c) for c in cols])
