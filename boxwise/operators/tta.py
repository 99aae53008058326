"""Test-time augmentation: variants per image, inverse box transform, merge.

Variants are a generator over a literal array (``explode``), not a join, and a
detection carries its variant's parameters, so undoing one joins nothing.  Each
variant resizes keep-ratio to its scale (``scale_x = new_w / w``), optionally
flips horizontally inside the resized image and pads.  Detections made in a
variant's frame are mapped back by un-flipping in the resized frame and
dividing by the scale factors, unioned over variants, and merged by class-wise
NMS (IoU 0.6) and a per-image top-k (100).
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxwise.operators.postprocess import nms, topk_per_image

# fixed values: TTA scales (w, h), flip choices and pad size
TTA_SCALES = ((640, 640), (320, 320), (960, 960))
TTA_FLIPS = (True, False)
TTA_PAD = (960, 960)


def _each_variant(d: DataFrame, scales: Sequence, flips: Sequence) -> DataFrame:
    """Every row with ``ori_w, ori_h`` once per variant, with ``variant, flip, img_w,
    img_h, scale_x, scale_y``: a generator, no join."""
    vs = [(i * len(flips) + j, s[0], s[1], f) for i, s in enumerate(scales) for j, f in enumerate(flips)]
    arr = F.array(*[F.struct(F.lit(v).alias("variant"), F.lit(float(max(sw, sh))).alias("le"),
                             F.lit(float(min(sw, sh))).alias("se"), F.lit(f).alias("flip")) for v, sw, sh, f in vs])
    cols = d.columns
    d = d.select("*", F.explode(arr).alias("_v"))
    s = F.least(F.col("_v.le") / F.greatest("ori_w", "ori_h"), F.col("_v.se") / F.least("ori_w", "ori_h"))
    d = d.select(*cols, F.col("_v.variant").alias("variant"), F.col("_v.flip").alias("flip"),
                 F.floor(F.col("ori_w") * s + 0.5).cast("int").alias("img_w"),
                 F.floor(F.col("ori_h") * s + 0.5).cast("int").alias("img_h"))
    return (d.withColumn("scale_x", F.col("img_w") / F.col("ori_w"))
             .withColumn("scale_y", F.col("img_h") / F.col("ori_h")))


def _canvas(images: DataFrame) -> DataFrame:
    return images.select(F.col("id").alias("image_id"), F.col("width").alias("ori_w"), F.col("height").alias("ori_h"))


def tta_variants(images: DataFrame, scales: Sequence = TTA_SCALES, flips: Sequence = TTA_FLIPS,
                 pad=TTA_PAD) -> DataFrame:
    """One row per (image, variant) with the meta the inverse transform needs."""
    return (_each_variant(_canvas(images), scales, flips)
            .select("image_id", "variant", "ori_w", "ori_h", "flip", "img_w", "img_h", "scale_x", "scale_y")
            .withColumn("pad_w", F.greatest(F.col("img_w"), F.lit(pad[0])))
            .withColumn("pad_h", F.greatest(F.col("img_h"), F.lit(pad[1])))
            .withColumn("flip_direction", F.when(F.col("flip"), F.lit("horizontal")).otherwise(F.lit("none"))))


META = ("img_w", "scale_x", "scale_y", "flip")


def to_variant_frame(det: DataFrame, images: DataFrame, scales: Sequence = TTA_SCALES, flips: Sequence = TTA_FLIPS) -> DataFrame:
    """Forward map of original-frame boxes into each variant frame (used to replay or
    simulate per-variant predictions).  A detection meets its image once; its variants
    are generated from that row and carry the parameters that undo them (``META``).
    ``images`` may also be a table of ``tta_variants``, which is then joined."""
    if "variant" in images.columns:
        j = det.join(images.select("image_id", "variant", *META), "image_id")
    else:
        # the merge join leaves all rows of an image in one task, variants too: merging them needs no further shuffle
        j = _each_variant(det.join(_canvas(images).hint("merge"), "image_id"), scales, flips)
    x1, x2 = F.col("x1") * F.col("scale_x"), F.col("x2") * F.col("scale_x")
    return j.select((F.col("det_id") * 8 + F.col("variant")).alias("det_id"), "image_id", "variant", "category_id",
                    F.when(F.col("flip"), F.col("img_w") - x2).otherwise(x1).alias("x1"),
                    (F.col("y1") * F.col("scale_y")).alias("y1"),
                    F.when(F.col("flip"), F.col("img_w") - x1).otherwise(x2).alias("x2"),
                    (F.col("y2") * F.col("scale_y")).alias("y2"), "score", *META)


def undo_variant(det_v: DataFrame, variants: DataFrame | None = None) -> DataFrame:
    """Map variant-frame boxes back to the original image, by the parameters they carry
    (``META``), or else by those of ``variants``."""
    j = det_v
    if variants is not None:
        j = det_v.drop(*META).join(variants.select("image_id", "variant", *META), ["image_id", "variant"])
    ux1 = F.when(F.col("flip"), F.col("img_w") - F.col("x2")).otherwise(F.col("x1"))
    ux2 = F.when(F.col("flip"), F.col("img_w") - F.col("x1")).otherwise(F.col("x2"))
    return j.select("det_id", "image_id", "variant", "category_id",
                    (ux1 / F.col("scale_x")).alias("x1"), (F.col("y1") / F.col("scale_y")).alias("y1"),
                    (ux2 / F.col("scale_x")).alias("x2"), (F.col("y2") / F.col("scale_y")).alias("y2"), "score")


def union_variants(frames: Sequence[DataFrame]) -> DataFrame:
    """Merge per-variant detection tables (by column name).  Where the variants
    are rows of one table, ``undo_variant`` over its ``variant`` column gives the
    same union in one pass."""
    return reduce(DataFrame.unionByName, frames)


def tta_merge(det_v: DataFrame, variants: DataFrame | None = None, *, iou_thr: float = 0.6, max_per_img: int = 100) -> DataFrame:
    """Undo each variant, union, class-wise NMS, best ``max_per_img`` per image.

    The merged detections are not stored, which would lose their placement by image and shuffle
    every variant twice: NMS computes them twice (group-size check, then the suppression
    itself), each time from one shuffle of the detections before they are multiplied.  The
    top-k takes them where they are, which counting them would compute once more."""
    return topk_per_image(nms(undo_variant(det_v, variants).drop("variant"), iou_thr=iou_thr), max_per_img, partitions=0)
