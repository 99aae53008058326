"""Stand-in detection tables built from the read-only test tables.

The definitions follow ``FIXTURES.md``: categories come from ``nation``, images
from ``orders``, annotations from ``lineitem`` and detections are two jittered
copies of every annotation.  The DataFrame builders below and the SQL text in
``FIXTURE_CTES`` (used by the DuckDB oracle) describe the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boxwise.session import default_parallelism, partitions_for, scratch_path, shuffles_dropped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_MATERIALIZED: dict[tuple, str] = {}


def materialized(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """Derive a stand-in view once per application and table directory, write
    it as Parquet under the shared checkpoint folder and read it from there
    (the "convert once, then work from Parquet" rule for derived inputs)."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    path = _MATERIALIZED.get(key)
    if path is None:
        path = scratch_path(spark, f"view-{name}")
        with shuffles_dropped(spark):
            build().write.parquet(path)
        _MATERIALIZED[key] = path
    return spark.read.parquet(path)


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id BIGINT, name STRING``; every nation."""
    n = table(spark, sf_dir, "nation")
    return (n.select((F.col("n_nationkey") * 4 + 1).cast("bigint").alias("id"),
                     F.col("n_name").alias("name")))


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, file_name, width, height, split``; every order."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return (o.select(k.alias("id"),
                     F.concat(F.lpad(k.cast("string"), 12, "0"), F.lit(".jpg")).alias("file_name"),
                     (F.lit(20) + (k * 37) % 620).cast("int").alias("width"),
                     (F.lit(20) + (k * 53) % 460).cast("int").alias("height"),
                     F.when(k % 25 == 0, "val").otherwise("train").alias("split")))


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, image_id, category_id, x, y, w, h, iscrowd`` (COCO ``[x,y,w,h]`` boxes),
    materialized once (see :func:`materialized`)."""
    return materialized(spark, sf_dir, "annotations", lambda: build_annotations(spark, sf_dir))


def build_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The annotation view from ``lineitem``.

    ``(l_orderkey, l_linenumber)`` is not unique, so the id uses a row number
    inside the order; the window is partitioned by order key (at most a few
    dozen lines each), so it never gathers a large group.  A table too large for the session's
    shuffle partitions is dealt into more, so that no sort outgrows its task.  Lines of every 50th
    order point to an image that does not exist, and one category in 26 is unknown.
    """
    li = table(spark, sf_dir, "lineitem")
    n = partitions_for(spark, li.count())
    if n > default_parallelism(spark):
        li = li.repartition(n, "l_orderkey")
    w = Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    pk = F.col("l_partkey")
    return li.select(
        (F.col("l_orderkey") * 100 + F.row_number().over(w)).alias("id"),
        F.when(F.col("l_orderkey") % 50 == 7, -F.col("l_orderkey")).otherwise(F.col("l_orderkey")).alias("image_id"),
        (((pk + F.col("l_linenumber")) % 26) * 4 + 1).cast("bigint").alias("category_id"),
        ((pk % 97) * 4).cast("double") + F.lit(0.25),
        ((pk % 61) * 4).cast("double") + F.lit(0.5),
        F.col("l_quantity") * 4,
        F.col("l_quantity") * 2 + ((pk % 5) * 8).cast("double"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 7), 1)
         .otherwise(0).alias("iscrowd"),
    ).toDF("id", "image_id", "category_id", "x", "y", "w", "h", "iscrowd")


def detections_from(ann: DataFrame) -> DataFrame:
    """Two jittered copies of every annotation; every 11th has a wrong class.

    The copies come from a generator (``explode``), not a join.
    """
    i = F.col("id")
    k = F.col("k")
    dx = (i % 5 - 2 + k).cast("double")
    dy = (i % 3 - 1).cast("double")
    return (ann.withColumn("k", F.explode(F.array(F.lit(0), F.lit(1))))
               .select((i * 10 + k).alias("det_id"), "image_id",
                       F.when(i % 11 == 0, F.col("category_id") + 4)
                        .otherwise(F.col("category_id")).alias("category_id"),
                       (F.col("x") + dx).alias("x1"),
                       (F.col("y") + dy).alias("y1"),
                       (F.col("x") + dx + F.col("w")).alias("x2"),
                       (F.col("y") + dy + F.col("h")).alias("y2"),
                       (((i * 7919 + k * 389) % 1000).cast("double") / F.lit(1000.0)).alias("score")))


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The copies are made where the stored annotations are read, not stored once more."""
    return detections_from(annotations(spark, sf_dir))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard payload stand-in: ``sample_id, split, payload, nbytes``."""
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("sample_id"),
                    F.when(F.col("doc_id") % 25 == 0, "val").otherwise("train").alias("split"),
                    F.col("text").alias("payload"),
                    F.octet_length("text").cast("bigint").alias("nbytes"))


def metric_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric-log stand-in from ``events``: ``run, metric, ts, event_id, value``."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_type").alias("run"), F.lit("loss").alias("metric"),
                    "ts", "event_id", "value")


def as_xyxy(ann: DataFrame) -> DataFrame:
    """Annotation boxes as corners, keeping ``iscrowd``."""
    return ann.select("id", "image_id", "category_id",
                      F.col("x").alias("x1"), F.col("y").alias("y1"),
                      (F.col("x") + F.col("w")).alias("x2"),
                      (F.col("y") + F.col("h")).alias("y2"), "iscrowd")


# SQL text of the same views, for the DuckDB oracle (fixed values: these must
# produce exactly the rows of the builders above).
FIXTURE_CTES = """
categories AS (
  SELECT CAST(n_nationkey*4+1 AS BIGINT) AS id, n_name AS name FROM nation),
images AS (
  SELECT o_orderkey AS id, CONCAT(LPAD(CAST(o_orderkey AS VARCHAR),12,'0'),'.jpg') AS file_name,
         CAST(20+(o_orderkey*37)%620 AS INT) AS width, CAST(20+(o_orderkey*53)%460 AS INT) AS height,
         CASE WHEN o_orderkey%25=0 THEN 'val' ELSE 'train' END AS split
  FROM orders),
annotations AS (
  SELECT l_orderkey*100 + ROW_NUMBER() OVER (PARTITION BY l_orderkey
           ORDER BY l_linenumber,l_partkey,l_suppkey,l_extendedprice,l_shipdate) AS id,
         CASE WHEN l_orderkey%50 = 7 THEN -l_orderkey ELSE l_orderkey END AS image_id,
         CAST(((l_partkey+l_linenumber)%26)*4+1 AS BIGINT) AS category_id,
         CAST((l_partkey%97)*4 AS DOUBLE)+CAST(0.25 AS DOUBLE) AS x,
         CAST((l_partkey%61)*4 AS DOUBLE)+CAST(0.5 AS DOUBLE) AS y,
         l_quantity*4 AS w, l_quantity*2+CAST((l_partkey%5)*8 AS DOUBLE) AS h,
         CASE WHEN l_returnflag='R' AND l_linenumber=7 THEN 1 ELSE 0 END AS iscrowd
  FROM lineitem),
detections AS (
  SELECT id*10+k AS det_id, image_id,
         CASE WHEN id%11=0 THEN category_id+4 ELSE category_id END AS category_id,
         x+CAST(id%5-2+k AS DOUBLE) AS x1, y+CAST(id%3-1 AS DOUBLE) AS y1,
         x+CAST(id%5-2+k AS DOUBLE)+w AS x2, y+CAST(id%3-1 AS DOUBLE)+h AS y2,
         CAST((id*7919+k*389)%1000 AS DOUBLE)/CAST(1000 AS DOUBLE) AS score
  FROM annotations CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 AS k) kk),
documents_s AS (
  SELECT doc_id AS sample_id, CASE WHEN doc_id%25=0 THEN 'val' ELSE 'train' END AS split,
         text AS payload, CAST(strlen(text) AS BIGINT) AS nbytes
  FROM documents),
ann_xyxy AS (
  SELECT id, image_id, category_id, x AS x1, y AS y1, x+w AS x2, y+h AS y2, iscrowd FROM annotations)
"""


def with_fixtures(body: str, *, recursive: bool = False, extra_ctes: str = "") -> str:
    """Prefix an oracle query with the fixture CTEs."""
    head = "WITH RECURSIVE " if recursive else "WITH "
    ctes = FIXTURE_CTES.strip()
    if extra_ctes.strip():
        ctes = ctes + ",\n" + extra_ctes.strip()
    return f"{head}{ctes}\n{body.strip()}"
