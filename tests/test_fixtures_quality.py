"""Known answers of the stand-in views (FIXTURES.md) and the quality checks."""

import pytest
from pyspark.sql import functions as F

from boxwise import fixtures as fx
from boxwise.operators import dataset as ds
from boxwise.operators import postprocess as pp
from boxwise.operators import quality as q


def test_known_counts(spark, sf):
    im, ann, cats = fx.images(spark, sf), fx.annotations(spark, sf), fx.categories(spark, sf)
    assert im.count() == 1500
    assert ann.count() == 6000
    assert fx.detections(spark, sf).count() == 12000
    assert cats.count() == 25
    assert q.images_without_boxes(im, ann).count() == 57
    assert q.orphan_annotations(ann, im).count() == 113
    assert q.unknown_categories(ann, cats).count() == 222
    assert im.count() - q.min_size_images(im, 32).count() == 67
    assert ann.where("iscrowd = 1").count() == 319
    assert pp.confidence_filter(fx.detections(spark, sf), 0.1).count() == 10765
    got = {r["split"]: r["n"] for r in im.groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert got == {"train": 1440, "val": 60}


def test_first_ids_by_seeded_order(spark, sf):
    im = fx.images(spark, sf).select(F.col("id").alias("image_id"))
    first = ds.shuffle_samples(im, seed=9176).where("pos < 5").orderBy("pos").collect()
    assert [r["image_id"] for r in first] == [897, 795, 285, 1077, 879]


def test_left_join_count_equals_anti_join(spark, sf):
    im, ann = fx.images(spark, sf), fx.annotations(spark, sf)
    lj = q.null_boxes(q.images_left_annotations(im, ann)).count()
    assert lj == q.count_rows(q.images_without_boxes(im, ann)).first()["n"] == 57


def test_duplicate_image_raises(spark):
    im = spark.createDataFrame([(1, "a.jpg", 10, 10, "train"), (1, "b.jpg", 10, 10, "train")],
                               "id long, file_name string, width int, height int, split string")
    assert q.duplicate_images(im).count() == 1
    with pytest.raises(ValueError, match="more than one record"):
        q.check_unique_images(im)


def test_expect_counts_raises(spark, sf):
    rep = q.expect_counts(fx.images(spark, sf), fx.annotations(spark, sf), {"train": 1, "val": 2})
    with pytest.raises(ValueError, match="expected"):
        q.check_counts(rep)


def test_unknown_category_raises_on_request(spark, sf):
    labels = ds.dense_labels(fx.categories(spark, sf))
    with pytest.raises(KeyError):
        ds.attach_labels(fx.annotations(spark, sf), labels, on_unknown="raise")


def test_null_bbox_and_empty_categories(spark):
    ann = spark.createDataFrame([(1, 10, 1, None, None, None, None, 0)],
                                "id long, image_id long, category_id long, x double, y double, w double, h double, iscrowd int")
    assert q.null_boxes(ann).count() == 1
    cats = spark.createDataFrame([], "id long, name string")
    lab = ds.dense_labels(cats).collect()
    assert [(r["label"], r["name"]) for r in lab] == [(0, "background")]
    assert q.label_count(cats, spark.createDataFrame([], "id long, split string"), ann).first()["n_labels"] == 1


def test_dense_labels_order_and_background(spark, sf):
    lab = ds.dense_labels(fx.categories(spark, sf)).orderBy("label").collect()
    assert lab[0]["label"] == 0 and lab[0]["label0"] == -1
    ids = [r["category_id"] for r in lab[1:]]
    assert ids == sorted(ids) and [r["label"] for r in lab[1:]] == list(range(1, 26))


def test_round_half_even(spark):
    df = spark.createDataFrame([(1, 1, 0.5, 1.5, 2.5, -0.5)], "id long, image_id long, x double, y double, w double, h double")
    r = ds.round_boxes(df).first()
    assert (r["x_r"], r["y_r"], r["w_r"], r["h_r"]) == (round(0.5), round(1.5), round(2.5), round(-0.5))


def test_group_samples_order_and_drop_empty(spark, sf):
    im, ann = fx.images(spark, sf), fx.annotations(spark, sf)
    s = ds.group_samples(im, ann, ds.dense_labels(fx.categories(spark, sf)))
    rows = s.collect()
    assert all(len(r["boxes"]) > 0 for r in rows)
    for r in rows[:50]:
        ids = [b["id"] for b in r["boxes"]]
        assert ids == sorted(ids)


def test_path_join_rule():
    from boxwise.functions.paths import join_literal
    assert join_literal("/data/coco/", "train2017") == "/data/coco/train2017"
    assert join_literal("/data/coco", "/abs/x") == "/abs/x"
    assert join_literal("", "a", "", "b") == "a/b"


def test_detections_are_not_stored_again(spark, sf):
    """The copies are made from the stored annotations; only these are on disk."""
    from boxwise.session import checkpoint_root, local_path
    got = fx.detections(spark, sf)
    assert got.count() == 2 * fx.annotations(spark, sf).count()
    assert not any(key[2] == "detections" for key in fx._MATERIALIZED)
    import os
    assert not [f for f in os.listdir(local_path(checkpoint_root(spark))) if f.startswith("view-detections")]


def test_lines_are_dealt_into_partitions_of_bounded_size(spark, sf, monkeypatch):
    from boxwise import session
    few = fx.build_annotations(spark, sf)
    monkeypatch.setattr(session.partitions_for, "__defaults__", (100,))
    many = fx.build_annotations(spark, sf)
    assert many.select(F.spark_partition_id().alias("p")).distinct().count() > 8
    assert many.exceptAll(few).isEmpty() and few.exceptAll(many).isEmpty()
