"""Training-log metrics: windowed mean emitted every ``every`` iterations.

The value at iteration ``e`` (a multiple of ``every``) is the mean of the last
``window`` logged values (``e - window < iter <= e``).  Each row is copied to
the emission points whose window holds it (a generator), then a grouped mean
with map-side combine does the rest - no window function over a run.
Iterations come from the distributed ranking of ``(ts, event_id)`` per run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxwise.plans.ranking import ranked


def iterations(log: DataFrame, *, group=("run", "metric"), order=("ts", "event_id")) -> DataFrame:
    """Add ``iter`` (1-based) per run and metric in log order."""
    return ranked(log, list(order), group=list(group), name="_p").withColumn("iter", F.col("_p") + 1).drop("_p")


def smooth_metrics(log: DataFrame, *, window: int = 50, every: int = 50, digits: int = 6) -> DataFrame:
    """``run, metric, iter, value`` at every ``every``-th iteration."""
    d = log if "iter" in log.columns else iterations(log)
    first = F.ceil(F.col("iter") / every) * every
    last = F.col("iter") + (window - 1)
    d = d.where(first <= last).select("run", "metric", "iter", "value",
                                      F.explode(F.sequence(first.cast("bigint"), last.cast("bigint"),
                                                           F.lit(every).cast("bigint"))).alias("e"))
    g = d.groupBy("run", "metric", "e").agg(F.avg("value").alias("value"), F.max("iter").alias("_m"))
    return g.where(F.col("_m") == F.col("e")).select("run", "metric", F.col("e").alias("iter"),
                                                     F.round("value", digits).alias("value"))
