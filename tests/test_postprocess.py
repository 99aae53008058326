"""NMS (contract K1), top-k and the composed post-processing."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from boxwise import fixtures as fx
from boxwise.operators import postprocess as pp

SCHEMA = "det_id long, image_id long, category_id long, x1 double, y1 double, x2 double, y2 double, score double"


def _iou(a, b):
    iw = max(0.0, min(a[2], b[2]) - max(a[0], b[0]))
    ih = max(0.0, min(a[3], b[3]) - max(a[1], b[1]))
    inter = iw * ih
    return inter, (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - inter


def greedy_nms(rows, thr, agnostic=False):
    groups = {}
    for r in rows:
        key = (r["image_id"],) if agnostic else (r["image_id"], r["category_id"])
        groups.setdefault(key, []).append(r)
    kept = set()
    for g in groups.values():
        g.sort(key=lambda r: (-r["score"], r["det_id"]))
        ks = []
        for r in g:
            box = (r["x1"], r["y1"], r["x2"], r["y2"])
            if not any(i > thr * u for i, u in (_iou(box, k) for k in ks)):
                ks.append(box)
                kept.add(r["det_id"])
    return kept


def test_hand_made_cases(spark):
    rows = [
        (1, 1, 1, 0, 0, 10, 10, 0.9),   # kept
        (2, 1, 1, 0, 0, 10, 10, 0.8),   # identical -> suppressed
        (3, 1, 1, 20, 20, 30, 30, 0.7),  # disjoint -> kept
        (4, 1, 1, 10, 0, 20, 10, 0.95),  # touching box 1 (IoU 0) -> kept
        (5, 1, 1, 1, 1, 9, 9, 0.5),     # nested in 1: IoU 0.64 > 0.5 -> suppressed
        (6, 1, 2, 0, 0, 10, 10, 0.6),   # other class -> kept
        (7, 1, 1, 30, 30, 40, 40, 0.3), (8, 1, 1, 30, 30, 40, 40, 0.3),  # tie: lower det_id wins
    ]
    rows = [r[:3] + tuple(float(v) for v in r[3:]) for r in rows]
    det = spark.createDataFrame(rows, SCHEMA)
    kept = {r["det_id"] for r in pp.nms(det, iou_thr=0.5).collect()}
    assert kept == {1, 3, 4, 6, 7}
    agn = {r["det_id"] for r in pp.nms(det, iou_thr=0.5, class_agnostic=True).collect()}
    assert agn == {1, 3, 4, 7}


def test_matches_python_loop_and_is_idempotent(spark, sf):
    det = pp.confidence_filter(fx.detections(spark, sf), 0.1)
    rows = [r.asDict() for r in det.collect()]
    kept = pp.nms(det, iou_thr=0.5)
    ids = {r["det_id"] for r in kept.collect()}
    assert ids == greedy_nms(rows, 0.5)
    again = {r["det_id"] for r in pp.nms(kept, iou_thr=0.5).collect()}
    assert again == ids
    # kept boxes of one group overlap by at most the threshold
    ks = [r.asDict() for r in kept.collect()]
    by = {}
    for r in ks:
        by.setdefault((r["image_id"], r["category_id"]), []).append((r["x1"], r["y1"], r["x2"], r["y2"]))
    for boxes in by.values():
        for i in range(len(boxes)):
            for j in range(i + 1, len(boxes)):
                inter, uni = _iou(boxes[i], boxes[j])
                assert not inter > 0.5 * uni


def test_topk_and_postprocess(spark, sf):
    det = fx.detections(spark, sf)
    top = pp.topk_per_image(det, 3)
    assert top.groupBy("image_id").count().agg(F.max("count")).first()[0] <= 3
    out = pp.postprocess(det, max_per_img=5)
    assert out.groupBy("image_id").count().agg(F.max("count")).first()[0] <= 5
    assert out.where("score <= 0.001").count() == 0


def test_distributed_path_equals_greedy(spark, sf):
    det = pp.confidence_filter(fx.detections(spark, sf), 0.1)
    rows = [r.asDict() for r in det.collect()]
    want = greedy_nms(rows, 0.5, agnostic=True)
    # class-agnostic groups are whole images; max_group=5 sends the larger ones
    # through the conflict pairs, the rest through the array walk
    got = {r["det_id"] for r in pp.nms(det, iou_thr=0.5, class_agnostic=True, max_group=5).collect()}
    assert got == want


def test_distributed_one_hot_group(spark):
    # one dense group: overlapping chains, nested boxes, ties, boxes of many scales
    import random
    rnd = random.Random(7)
    rows = []
    for i in range(400):
        s = rnd.choice([4, 8, 16, 64, 200])
        x, y = rnd.uniform(0, 300), rnd.uniform(0, 300)
        rows.append((i, 1, 1, x, y, x + s * rnd.uniform(0.5, 2), y + s * rnd.uniform(0.5, 2), float(rnd.randint(0, 20))))
    det = spark.createDataFrame(rows, SCHEMA)
    want = greedy_nms([r.asDict() for r in det.collect()], 0.3)
    for edges in (10 ** 6, 50):
        got = {r["det_id"] for r in pp.nms_distributed(det, iou_thr=0.3, edges_per_group=edges).collect()}
        assert got == want


def test_long_chain_and_ids_unique_per_image_only(spark):
    # a chain of boxes, each overlapping the next; the same ids in two images
    rows = [(i, im, 1, 10.0 * i, 0.0, 10.0 * i + 18, 10.0, 1.0 - i / 1000) for im in (1, 2) for i in range(200)]
    rows += [(i, 3, 1, float(j), 0.0, float(j) + 0.5, 0.5, 0.5) for i, j in enumerate(range(0, 400, 2))]
    det = spark.createDataFrame(rows, SCHEMA)
    got = {(r["image_id"], r["det_id"]) for r in pp.nms_distributed(det, iou_thr=0.2).collect()}
    assert got == {(im, i) for im in (1, 2) for i in range(0, 200, 2)} | {(3, i) for i in range(200)}
    # thinned by rounds first
    short = det.where("image_id < 3 AND det_id < 16")
    got = {(r["image_id"], r["det_id"]) for r in pp.nms_distributed(short, iou_thr=0.2, edges_per_group=9).collect()}
    assert got == {(im, i) for im in (1, 2) for i in range(0, 16, 2)}


def test_threshold_zero_meets_any_scale(spark):
    det = spark.createDataFrame([(1, 1, 1, 0.0, 0.0, 1.0, 1.0, 0.9), (2, 1, 1, 0.0, 0.0, 5000.0, 5000.0, 0.8),
                                 (3, 1, 1, 9000.0, 9000.0, 9001.0, 9001.0, 0.1)], SCHEMA)
    assert {r["det_id"] for r in pp.nms_distributed(det, iou_thr=0.0).collect()} == {1, 3}


def test_thirty_thousand_disjoint_boxes(spark):
    n = 30_000
    det = spark.range(n).selectExpr("id AS det_id", "1L AS image_id", "1L AS category_id",
                                    "0.001D * (id % 200) AS x1", "0.001D * (id div 200) AS y1",
                                    "0.001D * (id % 200) + 0.0009 AS x2", "0.001D * (id div 200) + 0.0009 AS y2",
                                    "(id * 7919 % 30011) / 30011D AS score")
    assert pp.nms(det, iou_thr=0.5).count() == n


def test_near_identical_boxes_against_kept_ones(spark):
    """A heap of near-identical boxes: equal to the plain loop, and fast at any size."""
    import random
    import time
    rnd = random.Random(3)

    def box(i, spots):
        x, y = 1000.0 * rnd.randrange(spots) + rnd.uniform(0, 6), rnd.uniform(0, 6)
        return (i, 1, 1, x, y, x + 60 + rnd.uniform(0, 6), y + 60, rnd.random())

    det = spark.createDataFrame([box(i, 3) for i in range(5000)], SCHEMA)
    want = greedy_nms([r.asDict() for r in det.collect()], 0.65)
    for edges in (10 ** 6, 20_000):
        assert {r["det_id"] for r in pp.nms_distributed(det, iou_thr=0.65, edges_per_group=edges).collect()} == want
    n = 200_000
    heap = spark.range(n).selectExpr("id AS det_id", "1L AS image_id", "1L AS category_id", "id * 7919 % 1009 / 500D AS x1",
                                     "id * 104729 % 1013 / 500D AS y1", "100 + id * 7919 % 1009 / 500D AS x2",
                                     "100 + id * 104729 % 1013 / 500D AS y2", "(id * 7919 % 200003) / 200003D AS score")
    start = time.time()
    kept = pp.nms(heap, iou_thr=0.5).collect()
    assert time.time() - start < 60
    best = max((i * 7919 % 200003, -i) for i in range(n))
    assert [r.det_id for r in kept] == [-best[1]]


def test_topk_of_more_rows_than_a_task_should_sort(spark, monkeypatch):
    """Dealt into more partitions than the session's, a hot image cut in parts first: the same rows."""
    from boxwise import session
    monkeypatch.setattr(session.partitions_for, "__defaults__", (100,))
    det = spark.range(3000).select(F.col("id").alias("det_id"), F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 300).cast("bigint")
                                   .alias("image_id"), ((F.col("id") * 7919) % 50 / 50.0).alias("score"))
    w = Window.partitionBy("image_id").orderBy(F.col("score").desc(), "det_id")
    want = {r.det_id for r in det.withColumn("rk", F.row_number().over(w)).where("rk <= 5").collect()}
    assert pp.image_partitions(det) == (30, 1510)
    for kw in ({}, {"hot_rows": 1000}, {"partitions": 0}, {"partitions": 30}):
        assert {r.det_id for r in pp.topk_per_image(det, 5, **kw).collect()} == want
    held = pp.topk_per_image(det, 5).withColumn("p", F.spark_partition_id()).select("p").distinct().count()
    assert held > 8
