"""Exploration and data-quality checks on images / annotations / categories.

All checks are joins or aggregations keyed by image or category id, so they
shuffle on those keys only (or broadcast the category table when Spark's
size-checked auto-broadcast picks it).  Orphans and unknown categories are
reported as rows instead of failing the whole job with a lookup error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ANNOTATION_COLUMNS = ["id", "image_id", "category_id", "x", "y", "w", "h", "iscrowd"]

# fixed values: expected sample counts per split (COCO 2017, empty images dropped)
COCO_EXPECTED_SAMPLES = {"train": 117266, "val": 4952}


def prune_annotation_columns(ann: DataFrame) -> DataFrame:
    """Keep ``id, image_id, category_id, bbox (x,y,w,h), iscrowd``; drop
    segmentation / area.  With a Parquet source the pruning reaches the scan."""
    return ann.select(*[c for c in ANNOTATION_COLUMNS if c in ann.columns])


def images_left_annotations(images: DataFrame, ann: DataFrame) -> DataFrame:
    """``images LEFT JOIN annotations ON images.id = annotations.image_id``.

    Both sides carry an ``id``; the image id is kept as ``img_id`` and the
    annotation id as ``ann_id`` so no column is ambiguous.
    """
    a = ann.select(F.col("id").alias("ann_id"), F.col("image_id"),
                   *[c for c in ann.columns if c not in ("id", "image_id")])
    i = images.withColumnRenamed("id", "img_id")
    j = i.join(a, i.img_id == a.image_id, "left")
    return j.drop("image_id")


def null_boxes(df: DataFrame, box_col: str = "x") -> DataFrame:
    """Rows whose box is NULL (the literal ``WHERE bbox IS NULL`` filter)."""
    return df.where(F.col(box_col).isNull())


def images_without_boxes(images: DataFrame, ann: DataFrame) -> DataFrame:
    """Images with no annotation.  Written as an anti join: Catalyst does not
    rewrite ``LEFT JOIN ... WHERE right IS NULL`` into one."""
    return images.join(ann.select(F.col("image_id").alias("id")), "id", "left_anti")


def count_rows(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def orphan_annotations(ann: DataFrame, images: DataFrame) -> DataFrame:
    """Annotations whose image does not exist."""
    return ann.join(images.select(F.col("id").alias("image_id")), "image_id", "left_anti") \
              .select(*ann.columns)


def unknown_categories(ann: DataFrame, categories: DataFrame) -> DataFrame:
    """Annotations whose category is not defined (the category table is small
    and is broadcast by Spark's size-checked auto-broadcast)."""
    return ann.join(categories.select(F.col("id").alias("category_id")), "category_id", "left_anti") \
              .select(*ann.columns)


def drop_empty_images(images: DataFrame, ann: DataFrame) -> DataFrame:
    """Keep images with at least one box (semi join, no duplication)."""
    return images.join(ann.select(F.col("image_id").alias("id")), "id", "left_semi")


def duplicate_images(images: DataFrame) -> DataFrame:
    """Image ids that occur more than once (partial aggregation before the shuffle)."""
    return images.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def min_size_images(images: DataFrame, min_size: int = 32) -> DataFrame:
    """Images whose shorter side is at least ``min_size``."""
    return images.where(F.least("width", "height") >= min_size)


def expect_counts(images: DataFrame, ann: DataFrame, expected: dict[str, int]) -> DataFrame:
    """Samples (images with >=1 box) per split against the expected numbers."""
    spark = images.sparkSession
    got = drop_empty_images(images, ann).groupBy("split").agg(F.count(F.lit(1)).alias("n_samples"))
    exp = spark.createDataFrame([(k, int(v)) for k, v in expected.items()], "split string, expected bigint")
    return (exp.join(got, "split", "left")
               .select("split", F.coalesce("n_samples", F.lit(0)).alias("n_samples"), "expected")
               .withColumn("ok", F.col("n_samples") == F.col("expected")))


def check_counts(report: DataFrame) -> None:
    """Raise like the converter does when a split's sample count is off."""
    bad = report.where(~F.col("ok")).collect()  # one row per split: bounded
    if bad:
        r = bad[0]
        raise ValueError(f"split {r['split']}: {r['n_samples']} samples, {r['expected']} expected")


def check_unique_images(images: DataFrame) -> None:
    if duplicate_images(images).limit(1).count():
        raise ValueError("an image id occurs in more than one record")


def label_count(categories: DataFrame, images: DataFrame, ann: DataFrame) -> DataFrame:
    """Number of labels including background, and the dataset length.

    Two single-row aggregates combined by a union + aggregate (no cross join).
    """
    cats = categories.select(F.lit(1).alias("c"), F.lit(0).alias("s"))
    samples = drop_empty_images(images, ann).select(F.lit(0).alias("c"), F.lit(1).alias("s"))
    return cats.unionByName(samples).agg(
        (F.coalesce(F.sum("c"), F.lit(0)) + 1).cast("bigint").alias("n_labels"),
        F.coalesce(F.sum("s"), F.lit(0)).cast("bigint").alias("n_samples"))


def split_summary(images: DataFrame, ann: DataFrame) -> DataFrame:
    """Per split: images, samples (images with boxes) and boxes.

    Boxes are counted per image first (partial aggregation), so only one row
    per image reaches the join.
    """
    per_image = ann.groupBy("image_id").agg(F.count(F.lit(1)).alias("nb"))
    j = images.join(per_image, images.id == per_image.image_id, "left")
    return j.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_images"),
        F.count("nb").alias("n_samples"),
        F.coalesce(F.sum("nb"), F.lit(0)).cast("bigint").alias("n_boxes"))


def image_lookup(ann: DataFrame, image_id: int) -> DataFrame:
    """Rows of one image (pushed down to the Parquet scan as a filter)."""
    return ann.where(F.col("image_id") == F.lit(image_id))


def collect_boxes(ann: DataFrame, image_id: int):
    """Bring one image's boxes to the driver (bounded by that image's boxes)."""
    return image_lookup(ann, image_id).select("x", "y", "w", "h").toPandas()
