"""Box-geometry augmentation properties."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from boxwise import fixtures as fx
from boxwise.operators import augment as ag
from boxwise.operators import feed as fd
from boxwise.operators import tta


def _frame(spark, sf):
    b = fx.as_xyxy(fx.annotations(spark, sf)).select("image_id", F.col("id").alias("box_id"), "category_id",
                                                    "x1", "y1", "x2", "y2")
    return ag.frame(fx.images(spark, sf), b)


def test_flip_twice_is_identity(spark, sf):
    f = _frame(spark, sf)
    back = ag.random_flip(ag.random_flip(f, 1.0), 1.0)
    diff = f.alias("a").join(back.alias("b"), "box_id").where(
        (F.col("a.x1") != F.col("b.x1")) | (F.col("a.x2") != F.col("b.x2")))
    assert diff.count() == 0


def test_resize_crop_pad_geometry(spark, sf):
    f = _frame(spark, sf)
    r = ag.resize_keep_ratio(f, (640, 640))
    assert r.where("greatest(w, h) > 640").count() == 0
    c = ag.random_crop(ag.random_resize(f, scale=(1280, 1280)), (640, 640))
    assert c.where("x1 < 0 OR y1 < 0 OR x2 > w OR y2 > h OR x2 <= x1 OR y2 <= y1 OR w > 640 OR h > 640").count() == 0
    p = ag.pad(c, (640, 640))
    assert p.where("w < 640 OR h < 640").count() == 0


def test_cache_partners_and_mosaic(spark, sf):
    s = fx.images(spark, sf).select(F.col("id").alias("image_id"))
    plan = fd.epoch_plan(s, ranks=2, workers=2, batch_size=4)
    part = ag.sample_cache_partners(plan, cache=10, k=3, min_cache=5)
    idx = plan.select("image_id", "idx", "node", "rank", "worker")
    j = (part.join(idx, "image_id")
             .join(idx.select(F.col("image_id").alias("partner_id"), F.col("idx").alias("pidx"),
                              F.col("node").alias("pn"), F.col("rank").alias("pr"), F.col("worker").alias("pw")), "partner_id"))
    assert j.where("pidx > idx OR pidx <= idx - 10 OR pn <> node OR pr <> rank OR pw <> worker").count() == 0
    m = ag.mosaic_compose(ag.frame(fx.images(spark, sf)), _frame(spark, sf).drop("w", "h"), part)
    assert m.where("x1 < 0 OR y1 < 0 OR x2 > 1280 OR y2 > 1280 OR x2 <= x1 OR y2 <= y1").count() == 0
    assert m.count() > 0


def test_tta_inverse_returns_original_boxes(spark, sf):
    det = fx.detections(spark, sf).where("score > 0.5")
    v = tta.tta_variants(fx.images(spark, sf))
    assert v.count() == 6 * fx.images(spark, sf).count()
    back = tta.undo_variant(tta.to_variant_frame(det, v), v)
    j = back.join(det.select(F.col("det_id").alias("o"), F.col("x1").alias("ox1"), F.col("x2").alias("ox2")),
                  F.floor(F.col("det_id") / 8) == F.col("o"))
    assert j.where("abs(x1 - ox1) > 1e-6 OR abs(x2 - ox2) > 1e-6").count() == 0


def test_every_planned_sample_passes_the_mosaic(spark, sf):
    """A sample with boxes in the image is there before the crop, mixed or not."""
    fb = _frame(spark, sf)
    inside = fb.where("x1 < w AND y1 < h AND x2 > 0 AND y2 > 0")
    plan = fd.epoch_plan(inside.select("image_id").distinct(), ranks=2, workers=2)
    part = ag.sample_cache_partners(plan, cache=40, k=3, min_cache=5)
    out = ag.mosaic_compose(ag.frame(fx.images(spark, sf)), inside.drop("w", "h"), part, samples=plan)
    assert plan.join(part.select("image_id").distinct(), "image_id", "left_anti").count() > 0
    unmixed = out.join(part.select("image_id").distinct(), "image_id", "left_anti")
    assert unmixed.where("tile <> 0 OR src_id <> image_id").count() == 0
    alone = plan.join(part.select("image_id").distinct(), "image_id", "left_anti").select("image_id")
    assert alone.join(out, "image_id", "left_anti").count() == 0


def test_stage_two_and_tiny_settings(spark, sf):
    b = fx.as_xyxy(fx.annotations(spark, sf)).select("image_id", F.col("id").alias("box_id"), "category_id",
                                                    "x1", "y1", "x2", "y2")
    plan = fd.epoch_plan(b.select("image_id").distinct())
    two = ag.augment_plan(fx.images(spark, sf), b, plan, epoch=280)
    assert "tile" not in two.columns and two.where("w < 640 OR h < 640").count() == 0
    few = ag.augment_plan(fx.images(spark, sf), b, plan, epoch=0, mixup_prob=0.0)
    many = ag.augment_plan(fx.images(spark, sf), b, plan, epoch=0, mixup_prob=1.0)
    assert 0 < few.count() < many.count()


def test_random_eviction_equals_a_cache(spark):
    """Partners from a cache that evicts at random, against a plain cache replayed with the same draws."""
    import hashlib

    def u(ident, op):
        return int(hashlib.md5(f"9176:{op}:0:{ident}".encode()).hexdigest()[:8], 16) / 2 ** 32

    plan = fd.epoch_plan(spark.range(700).withColumnRenamed("id", "image_id"), ranks=2, workers=1, batch_size=4)
    for cache, k, least in ((1, 1, 1), (7, 3, 5), (40, 3, 5)):
        got = {(r.image_id, r.slot): r.partner_id for r in ag.sample_cache_partners(
            plan, cache=cache, k=k, min_cache=least, random_pop=True).collect()}
        want, held = {}, {}
        for r in sorted(plan.collect(), key=lambda r: r.idx):
            places = held.setdefault((r.node, r.rank, r.worker), [])
            if len(places) < cache:
                places.append(r.image_id)
            else:
                goes = int(u(r.image_id, "mosaic_evict") * (cache + 1))
                if goes < cache:                             # else the new sample itself goes
                    places[goes] = r.image_id
            for slot in range(1, k + 1) if len(places) >= least else ():
                want[r.image_id, slot] = places[int(u(f"{r.image_id}:{slot}", "mosaic_partner") * len(places))]
        assert got == want


def test_merging_variants_shuffles_by_image_only(spark, sf):
    """Detections are placed by image before they are multiplied; the variants are not shuffled again."""
    det = fx.detections(spark, sf).where("score > 0.5")
    plan = tta.tta_merge(tta.to_variant_frame(det, fx.images(spark, sf)))._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2 and not any("category_id" in line.split("ENSURE")[0] for line in exchanges)


def test_augment_plan_runs_its_chain_once(spark, sf):
    images, ann = fx.images(spark, sf), fx.as_xyxy(fx.annotations(spark, sf))
    boxes = ann.select("image_id", F.col("id").alias("box_id"), "x1", "y1", "x2", "y2")
    plan = images.selectExpr("id % 4 AS node", "0 AS rank", "0 AS worker", "id AS image_id").withColumn(
        "idx", F.row_number().over(Window.partitionBy("node").orderBy("image_id")).cast("long") - 1)
    out = ag.augment_plan(images, boxes, plan, epoch=0, **ag.TINY)._jdf.queryExecution().optimizedPlan().toString()
    assert "mixup" in out and "random_resize" not in out and "mosaic" not in out
