"""Plan-level checks of the scale claims (no data volume needed)."""

import glob

from boxwise import fixtures as fx
from boxwise.session import scratch_path
from boxwise.sinks import coco_json as cj_out
from boxwise.sources import coco_json as cj


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_topk_limits_before_the_shuffle(spark, sf):
    import __spark_entry__ as e
    plan = _plan(e.queries()["topk_per_image"](spark, sf))
    assert "WindowGroupLimit" in plan and "Partial" in plan and "Final" in plan


def test_lookup_filter_reaches_the_scan(spark, sf):
    import __spark_entry__ as e
    plan = _plan(e.queries()["image_lookup"](spark, sf))
    assert "PushedFilters: [IsNotNull(image_id), EqualTo(image_id," in plan


def test_no_cartesian_or_nested_loop_joins(spark, sf):
    import __spark_entry__ as e
    q = e.queries()
    for name in ("images_without_boxes", "group_samples", "nms", "postprocess", "iou_join", "tta_variants",
                 "coco_match", "label_count", "split_summary", "drop_empty_images", "random_crop"):
        plan = _plan(q[name](spark, sf))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_coco_documents_follow_the_data(spark, sf):
    root = scratch_path(spark, "t-coco")
    im = fx.images(spark, sf)
    cj_out.write_coco_json(im, fx.annotations(spark, sf), fx.categories(spark, sf), root, images_per_doc=500)
    parts = glob.glob(root.replace("file:", "") + "/part=*")
    assert len(parts) == 3  # ceil(1500 / 500)
    images, ann, cats = cj.read_coco_json(spark, root)
    assert images.count() == 1500 and ann.count() == 6000 and cats.count() == 25


def test_partitions_follow_the_rows(spark):
    from boxwise.session import PARTITION_ROWS, partitions_for
    assert partitions_for(spark, 0) == 8
    assert partitions_for(spark, 100 * PARTITION_ROWS + 1) == 101


def test_iou_join_moves_boxes_once(spark, sf):
    """One shuffle of each side and its images, none between the rank and the pairs."""
    import __spark_entry__ as e
    plan = e.queries()["iou_join"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(image_id") + plan.count("hashpartitioning(id") <= 4
    assert "hashpartitioning(image_id#" in plan and ", category_id#" not in "".join(
        line for line in plan.splitlines() if "hashpartitioning" in line)
