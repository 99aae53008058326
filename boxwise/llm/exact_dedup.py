"""Exact dedup: stateful streaming aggregation over content digests.

A Structured Streaming query groups rows by (SHA-256, byte length) without
watermark, so its keyed state never expires; the RocksDB provider keeps it on
disk.  Per digest the state holds the stable identifier (largest id), the
content locator (file of that row; file and id find the bytes again) and the
group's size.  Map-side partial aggregation meets hot digests before the shuffle.
Each micro-batch writes the digests it changed to the shared folder, keyed by
batch id, so a replayed batch overwrites its own output.

Hits are checked on full bytes: each row of a group larger than one is compared
with the located content of its group.  Rows that differ in spite of equal
digests form classes by their whole text.

Defined results: null text counts as empty; null ids sort below all others and
equal ids in one group count as separate rows; of rows tied for the largest id any
one's content is compared; very long texts are compared whole, in the JVM; an empty
table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxwise.llm.common import store
from boxwise.session import materialize, scratch_path

# disk-backed state; many partitions hold little each, so no file space is
# allocated ahead and a commit writes its changes only
STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, t, file, digest, n_bytes) of a file scan, batch or streaming."""
    return (df.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t"),
                      F.col("_metadata.file_path").alias("file"))
            .withColumns({"digest": F.sha2(F.col("t").cast("binary"), 256), "n_bytes": F.octet_length("t")}))


def stream_digests(spark: SparkSession, path: str, schema, *, id_col: str = "doc_id", text_col: str = "text",
                   max_bytes_per_trigger: int = 256 << 30, checkpoint: str | None = None) -> DataFrame:
    """Run the streaming aggregation over the Parquet files under ``path`` and
    return (digest, n_bytes, keep_id, locator, group_size).  A caller that keeps
    ``checkpoint`` can call again when files were added: the state goes on."""
    root = checkpoint or scratch_path(spark, "exact-dedup")
    saved = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        # a glob lets the file source take a single file as well as a folder
        src = (spark.readStream.schema(schema).option("maxBytesPerTrigger", str(max_bytes_per_trigger))
               .parquet(f"{path[:-1]}[{path[-1]}]"))
        state = (_keyed(src, id_col, text_col).drop("t").groupBy("digest", "n_bytes")
                 .agg(F.max(F.struct("doc_id", "file")).alias("top"), F.count("*").alias("group_size")))

        def put(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{root}/changed/batch={batch_id}")

        (state.writeStream.outputMode("update").option("checkpointLocation", f"{root}/state")
         .trigger(availableNow=True).foreachBatch(put).start().awaitTermination())
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    id_type = schema[id_col].dataType.simpleString()
    written = (f"digest string, n_bytes int, top struct<doc_id:{id_type},file:string>, group_size bigint, batch bigint")
    try:
        changed = spark.read.schema(written).parquet(f"{root}/changed")
    except AnalysisException:            # no micro-batch ran: the source has no rows
        changed = spark.createDataFrame([], written)
    # the state of a digest is what its last change wrote
    last = changed.groupBy("digest", "n_bytes").agg(F.max_by(F.struct("top", "group_size"), "batch").alias("v"))
    return last.select("digest", "n_bytes", F.col("v.top.doc_id").alias("keep_id"),
                       F.col("v.top.file").alias("locator"), F.col("v.group_size").alias("group_size"))


def classify(spark: SparkSession, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of the Parquet table at ``path``: doc_id, digest, keep_id,
    group_size, kept."""
    scan = spark.read.parquet(path)
    groups = materialize(stream_digests(spark, path, scan.schema, id_col=id_col, text_col=text_col)
                         .filter("group_size > 1"), "exact-groups")
    rows = _keyed(scan, id_col, text_col)
    keys = ["digest", "n_bytes"]
    # hits: rows of groups larger than one, with their whole text
    hits = store(rows.join(groups.hint("merge"), keys), "exact-hits")
    # stored, like the classes below: AQE splits a hot key only where the other side of its
    # join is a plain shuffle, not an aggregate
    content = store(hits.filter("doc_id <=> keep_id AND file = locator").dropDuplicates(keys)
                    .select(*keys, F.col("t").alias("located")), "exact-content")
    checked = materialize(
        hits.join(content.hint("merge"), keys)
        .select("doc_id", *keys, F.when(F.col("t") != F.col("located"), F.col("t")).alias("other")), "exact-checked")
    classes = materialize(checked.groupBy(*keys, "other").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")),
                          "exact-classes")
    c = classes.select(*[F.col(x).alias(f"_{x}") for x in classes.columns])
    same = ((F.col("digest") == F.col("_digest")) & (F.col("n_bytes") == F.col("_n_bytes"))
            & F.col("other").eqNullSafe(F.col("_other")))
    many = checked.join(c.hint("merge"), same).select(
        "doc_id", "digest", F.col("_keep_id").alias("keep_id"), F.col("_group_size").alias("group_size"))
    one = (rows.drop("t", "file").join(groups.select(*keys).hint("merge"), keys, "left_anti")
           .select("doc_id", "digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size")))
    return many.unionByName(one).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def deduplicate(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` without the rows whose text another row keeps; all columns stay.
    Rows equal in id and text are one document and leave one row."""
    spark = df.sparkSession
    path = scratch_path(spark, "exact-input")
    (df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
     .write.option("compression", "zstd").parquet(path))
    gone = classify(spark, path).filter("NOT kept").select(
        F.col("doc_id").alias("_gone_id"), F.col("digest").alias("_gone_digest"))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    wide = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
                     F.col(f"`{id_col}`").alias("_id"), F.sha2(text.cast("binary"), 256).alias("_digest"))
    left = wide.join(gone, F.col("_id").eqNullSafe(F.col("_gone_id")) & (F.col("_digest") == F.col("_gone_digest")),
                     "left_anti")
    return left.dropDuplicates(["_id", "_digest"]).select(*[F.col(f"row.`{c}`").alias(c) for c in df.columns])
