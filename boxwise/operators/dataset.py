"""Training-set construction: labels, box conversion, paths, grouping, order.

The flow of the converter (label map -> checks -> grouping -> empty drop ->
count check -> shuffle -> shards) is rebuilt as joins and aggregations keyed by
image id; image bytes are never part of these plans (they are joined in the
final write only).
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxwise.functions import paths
from boxwise.functions.draws import DEFAULT_SEED, order_key
from boxwise.functions.geometry import round_half_even
from boxwise.plans.ranking import ranked


# --- labels -----------------------------------------------------------------

def dense_labels(categories: DataFrame, *, order: str = "id") -> DataFrame:
    """Category id -> dense label 1..N in file order, 0 = background.

    ``label`` counts from 1 (background 0); ``label0`` counts from 0 for a head
    with ``num_classes = N`` (background gets -1).  For a JSON source pass the
    array position as ``order``.
    """
    r = ranked(categories.select(F.col("id").alias("category_id"), "name", F.col(order).alias("_o")),
               ["_o", "category_id"], name="_p")
    lab = r.select((F.col("_p") + 1).cast("bigint").alias("label"), "category_id", "name")
    bg = categories.sparkSession.createDataFrame(
        [(0, None, "background")], "label bigint, category_id bigint, name string")
    return lab.unionByName(bg).withColumn("label0", F.col("label") - 1)


def attach_labels(ann: DataFrame, labels: DataFrame, *, on_unknown: str = "drop") -> DataFrame:
    """Join the dense label; ``on_unknown='raise'`` fails like the converter's
    lookup would when a category is undefined."""
    lab = labels.where(F.col("label") > 0).select(
        "category_id", F.col("label").alias("label_bg1"), "label0", F.col("name").alias("category"))
    if on_unknown == "raise":
        missing = ann.join(lab, "category_id", "left_anti").limit(1).collect()
        if missing:
            raise KeyError(missing[0]["category_id"])
    return ann.join(lab, "category_id", "inner")


# --- box conversion -----------------------------------------------------------

def xywh_to_xyxy(ann: DataFrame) -> DataFrame:
    """``[x, y, w, h]`` -> ``(l, t, r, b)``."""
    keep = [c for c in ann.columns if c not in ("x", "y", "w", "h")]
    return ann.select(*keep, F.col("x").alias("x1"), F.col("y").alias("y1"),
                      (F.col("x") + F.col("w")).alias("x2"), (F.col("y") + F.col("h")).alias("y2"))


def normalize_boxes(ann_xyxy: DataFrame, images: DataFrame) -> DataFrame:
    """Divide corners by the image width / height (joined by image id)."""
    im = images.select(F.col("id").alias("image_id"), "width", "height")
    j = ann_xyxy.join(im, "image_id")
    return j.select("id", "image_id",
                    (F.col("x1") / F.col("width")).alias("nx1"), (F.col("y1") / F.col("height")).alias("ny1"),
                    (F.col("x2") / F.col("width")).alias("nx2"), (F.col("y2") / F.col("height")).alias("ny2"))


def cast_boxes(df: DataFrame, *, box_cols=("x1", "y1", "x2", "y2"), label_col: str | None = "label_bg1") -> DataFrame:
    """Boxes to float32, labels to int64, as the stored sample declares."""
    out = df
    for c in box_cols:
        out = out.withColumn(c, F.col(c).cast("float"))
    if label_col and label_col in df.columns:
        out = out.withColumn(label_col, F.col(label_col).cast("bigint"))
    return out


def round_boxes(ann: DataFrame) -> DataFrame:
    """``int(round(v))`` per coordinate: half to even, like Python."""
    return ann.select("id", "image_id", *[round_half_even(F.col(c)).alias(f"{c}_r") for c in ("x", "y", "w", "h")])


def draw_rects(ann: DataFrame) -> DataFrame:
    """Rectangle corners to draw: ``(x, y, x+w, y+h)`` from the rounded values
    (the size is not used as a corner)."""
    r = round_boxes(ann)
    return r.select("id", "image_id", F.col("x_r").alias("left"), F.col("y_r").alias("top"),
                    (F.col("x_r") + F.col("w_r")).alias("right"), (F.col("y_r") + F.col("h_r")).alias("bottom"))


# --- paths --------------------------------------------------------------------

def resolve_image_path(images: DataFrame, root: str, prefix: str | Column | None = None) -> DataFrame:
    """``path = join(root, prefix, file_name)``; ``prefix`` may be a column
    (e.g. ``split || '2017'``).  Slashes are normalised; an absolute file name wins."""
    if prefix is None:
        base: str | Column = root
    elif isinstance(prefix, str):
        base = paths.join_literal(root, prefix)
    else:
        base = paths.join_path(root, prefix)
    return images.withColumn("path", paths.join_path(base, F.col("file_name")))


def rebase_paths(df: DataFrame, old_root: str, new_root: str, *, col: str = "path") -> DataFrame:
    """Point paths under ``old_root`` at ``new_root`` (others stay)."""
    old = old_root.rstrip("/") + "/"
    new = new_root.rstrip("/") + "/"
    c = F.col(col)
    return df.withColumn(col, F.when(c.startswith(old),
                                     F.concat(F.lit(new), F.substring(c, len(old) + 1, 1 << 30)))
                          .otherwise(c))


def suffix_filter(df: DataFrame, suffixes, *, col: str = "path") -> DataFrame:
    return df.where(paths.ends_with_any(F.col(col), suffixes))


# --- grouping -----------------------------------------------------------------

BOX_STRUCT = ["id", "x1", "y1", "x2", "y2", "label"]


def group_samples(images: DataFrame, ann: DataFrame, labels: DataFrame, *,
                  drop_empty: bool = True, drop_crowd: bool = False, split: str | None = None) -> DataFrame:
    """One row per image: ``image_id, file_name, split, htot, wtot, boxes``.

    ``boxes`` is ``array<struct<id, x1, y1, x2, y2, label>>`` in file (annotation
    id) order; ``collect_list`` alone has no defined order, hence the sort.
    Annotations of missing images or unknown categories are left out (see the
    quality checks).  The grouping key is the image, so a group is one image's
    boxes and the aggregate is partial (map-side) before the shuffle.  ``split``
    names the split when ``images`` carries none.
    """
    if split is not None:
        images = images.withColumn("split", F.lit(split))
    a = ann.where(F.col("iscrowd") == 0) if drop_crowd else ann
    lab = labels.where(F.col("label") > 0).select("category_id", "label")
    a = xywh_to_xyxy(a).join(lab, "category_id")
    grouped = a.groupBy("image_id").agg(
        F.sort_array(F.collect_list(F.struct(*[F.col(c) for c in BOX_STRUCT]))).alias("boxes"))
    im = images.select(F.col("id").alias("image_id"), "file_name", "split",
                       F.col("height").alias("htot"), F.col("width").alias("wtot"))
    j = im.join(grouped, "image_id", "inner" if drop_empty else "left")
    if not drop_empty:
        j = j.withColumn("boxes", F.coalesce("boxes", F.array().cast(grouped.schema["boxes"].dataType)))
    return j


def sample_arrays(samples: DataFrame) -> DataFrame:
    """The stored sample layout: ``bbox_sizes`` float32 ``[n, 4]``, ``bbox_labels`` int64."""
    return samples.withColumn(
        "bbox_sizes", F.transform("boxes", lambda b: F.array(*[b[c].cast("float") for c in ("x1", "y1", "x2", "y2")]))
    ).withColumn("bbox_labels", F.transform("boxes", lambda b: b["label"].cast("bigint")))


def summarize_samples(samples: DataFrame) -> DataFrame:
    """Scalar view of grouped samples (box ids and labels in stored order)."""
    return samples.select(
        "image_id", "split", "htot", "wtot",
        F.size("boxes").cast("bigint").alias("n_boxes"),
        F.array_join(F.transform("boxes", lambda b: b["id"].cast("string")), ",").alias("box_ids"),
        F.array_join(F.transform("boxes", lambda b: b["label"].cast("string")), ",").alias("labels"),
        F.aggregate("boxes", F.lit(0.0),
                    lambda acc, b: acc + (b["x2"] - b["x1"]) * (b["y2"] - b["y1"])).alias("area_sum"))


# --- order ----------------------------------------------------------------------

def shuffle_samples(df: DataFrame, *, seed: int = DEFAULT_SEED, epoch: int | None = None,
                    id_col: str = "image_id", shuffle: bool = True, name: str = "pos") -> DataFrame:
    """Seeded permutation: position by ``md5(seed[:epoch]:id)``, ties by id;
    ``shuffle=False`` keeps id order.  Positions are computed with the
    distributed ranking (no single-task window)."""
    if shuffle:
        d = df.withColumn("_k", order_key(id_col, seed, epoch))
        return ranked(d, ["_k", id_col], name=name).drop("_k")
    return ranked(df, [id_col], name=name)


def split_order_key(id_col: str = "image_id", *, seed: int = DEFAULT_SEED, shuffled=("train",)) -> Column:
    """Order key per split: md5 for shuffled splits, zero-padded id otherwise."""
    ident = F.col(id_col)
    return F.when(F.col("split").isin(*shuffled), order_key(ident, seed)) \
            .otherwise(F.lpad(ident.cast("string"), 20, "0"))


def union_splits(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Process several splits as one DataFrame with a ``split`` column."""
    out = None
    for split, df in frames.items():
        d = df.withColumn("split", F.lit(split)) if "split" not in df.columns else df
        out = d if out is None else out.unionByName(d)
    return out


def order_splits(samples: DataFrame, *, seed: int = DEFAULT_SEED, shuffled=("train",),
                 id_col: str = "image_id") -> DataFrame:
    """Position inside each split: shuffled for train, file (id) order for val."""
    d = samples.withColumn("_k", split_order_key(id_col, seed=seed, shuffled=shuffled))
    return ranked(d, ["_k", id_col], group=["split"]).drop("_k")


# --- sample layout for the reader ------------------------------------------------

def format_sample(samples: DataFrame) -> DataFrame:
    """Reader layout: ``img_id, img_shape (h, w), instances {bbox, bbox_label}``."""
    return samples.select(
        F.col("image_id").alias("img_id"),
        F.struct(F.col("htot").alias("h"), F.col("wtot").alias("w")).alias("img_shape"),
        F.struct(
            F.transform("boxes", lambda b: F.array(*[b[c].cast("float") for c in ("x1", "y1", "x2", "y2")])).alias("bbox"),
            F.transform("boxes", lambda b: b["label"].cast("bigint")).alias("bbox_label")).alias("instances"))


META_KEYS = ("img_id", "img_path", "ori_shape", "img_shape", "scale_factor", "flip", "flip_direction")


def pack_meta(df: DataFrame, keys=META_KEYS) -> DataFrame:
    """Keep only the meta keys a packed sample carries (missing keys are skipped;
    tuple-valued keys may be stored as several ``<key>_*`` columns)."""
    cols = [c for c in df.columns if c in keys or any(c.startswith(k + "_") for k in keys)]
    return df.select(*cols)
