"""Read shards progressively and validate them as they arrive.

``stream_shards`` is a file stream over a shard directory (``maxFilesPerTrigger``
bounds each micro-batch).  ``stream_validate`` joins each batch with the static
image and category tables (stream-static anti joins) and appends per-batch
counts through ``foreachBatch``; the batch id makes a replay after a failure
overwrite, not duplicate, its own output.

``stream_identity`` checks what only shows across shards: a record that comes twice, and
a sample whose records are spread over several shards.  It is a stateful aggregation over
two kinds of keys without expiry, kept on disk by the RocksDB provider, so it holds
through micro-batches and restarts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from boxwise.streaming.metrics import latest

# disk-backed state; a commit writes its changes only
STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

REPORT_SCHEMA = "batch_id long, n_rows long, n_orphans long, n_unknown long"


def stream_shards(spark: SparkSession, root: str, schema: StructType | str, *, max_files: int = 1) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
                 .option("recursiveFileLookup", "true").parquet(root))


def validation_counts(batch: DataFrame, images: DataFrame, categories: DataFrame) -> DataFrame:
    """One row: rows, orphan annotations, unknown categories of a batch."""
    b = batch.select("image_id", "category_id")
    orphan = b.join(images.select(F.col("id").alias("image_id")), "image_id", "left_anti") \
              .select(F.lit(0).alias("r"), F.lit(1).alias("o"), F.lit(0).alias("u"))
    unknown = b.join(categories.select(F.col("id").alias("category_id")), "category_id", "left_anti") \
               .select(F.lit(0).alias("r"), F.lit(0).alias("o"), F.lit(1).alias("u"))
    rows = b.select(F.lit(1).alias("r"), F.lit(0).alias("o"), F.lit(0).alias("u"))
    return rows.unionByName(orphan).unionByName(unknown).agg(
        F.sum("r").cast("bigint").alias("n_rows"), F.sum("o").cast("bigint").alias("n_orphans"),
        F.sum("u").cast("bigint").alias("n_unknown"))


def stream_validate(stream: DataFrame, images: DataFrame, categories: DataFrame, out: str, checkpoint: str):
    """Start the validation query; per-batch reports land in ``out/batch_id=<n>``."""
    def each(batch: DataFrame, batch_id: int) -> None:
        rep = validation_counts(batch, images, categories).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        rep.select("batch_id", "n_rows", "n_orphans", "n_unknown").write.mode("overwrite") \
           .parquet(f"{out}/batch_id={batch_id}")
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).start()


def identity_state(stream: DataFrame, *, record_col: str = "id", sample_col: str = "image_id") -> DataFrame:
    """``kind, key, n, first_shard, last_shard`` of a stream of records read from shard files:
    for every record id and every sample id how many records came, and the smallest and
    largest file they came from.  Counts meet map-side, so a sample with many records is
    one row per task."""
    marked = stream.select(F.col("_metadata.file_path").alias("shard"), F.explode(F.array(
        F.struct(F.lit("record").alias("kind"), F.col(record_col).cast("string").alias("key")),
        F.struct(F.lit("sample").alias("kind"), F.col(sample_col).cast("string").alias("key")))).alias("k"))
    return marked.groupBy("k.kind", "k.key").agg(F.count(F.lit(1)).alias("n"), F.min("shard").alias("first_shard"),
                                                F.max("shard").alias("last_shard"))


def stream_identity(stream: DataFrame, out: str, checkpoint: str, *, record_col: str = "id", sample_col: str = "image_id"):
    """Start the check; keys that changed in a batch land in ``out/batch=<n>``.  Started
    again with the same ``checkpoint`` it goes on where it was."""
    spark = stream.sparkSession
    saved = {k: spark.conf.get(k, None) for k in STATE}

    def each(batch: DataFrame, batch_id: int) -> None:
        # only keys with a finding are reported; a key's finding never goes away again
        bad = batch.where("(kind = 'record' AND n > 1) OR (kind = 'sample' AND first_shard <> last_shard)")
        bad.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    try:
        for k, v in STATE.items():
            spark.conf.set(k, v)
        state = identity_state(stream, record_col=record_col, sample_col=sample_col)
        return state.writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", checkpoint).start()
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def findings(spark: SparkSession, out: str) -> DataFrame:
    """``kind, key, n, first_shard, last_shard``: records that came more than once and samples
    spread over shards, as of the last batch."""
    return latest(spark, out, keys=("kind", "key")).select("kind", "key", "n", "first_shard", "last_shard")
