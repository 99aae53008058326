"""COCO-style evaluation against a plain-Python implementation of contract K3."""

from pyspark.sql import functions as F

from boxwise import fixtures as fx
from boxwise.operators import evaluate as ev


def _iou(d, g, crowd):
    iw = max(0.0, min(d["x2"], g["x2"]) - max(d["x1"], g["x1"]))
    ih = max(0.0, min(d["y2"], g["y2"]) - max(d["y1"], g["y1"]))
    inter = iw * ih
    da = (d["x2"] - d["x1"]) * (d["y2"] - d["y1"])
    ga = (g["x2"] - g["x1"]) * (g["y2"] - g["y1"])
    uni = da if crowd else da + ga - inter
    return inter / uni if uni > 0 else 0.0


def brute_ap(dets, gts, thrs):
    npig = {}
    for g in gts:
        if g["iscrowd"] == 0:
            npig[g["category_id"]] = npig.get(g["category_id"], 0) + 1
    by_dt, by_gt = {}, {}
    for d in dets:
        by_dt.setdefault((d["image_id"], d["category_id"]), []).append(d)
    for g in gts:
        by_gt.setdefault((g["image_id"], g["category_id"]), []).append(g)
    out = {}
    for t in thrs:
        status = {}
        for key, ds in by_dt.items():
            gs = by_gt.get(key, [])
            matched = set()
            for d in sorted(ds, key=lambda r: (-r["score"], r["det_id"])):
                nc = [(_iou(d, g, False), g["id"]) for g in gs if g["iscrowd"] == 0 and g["id"] not in matched]
                nc = [c for c in nc if c[0] >= t and c[0] > 0]
                if nc:
                    matched.add(max(nc)[1])
                    status[d["det_id"]] = "tp"
                    continue
                cr = [c for c in ((_iou(d, g, True), g["id"]) for g in gs if g["iscrowd"] == 1) if c[0] >= t and c[0] > 0]
                status[d["det_id"]] = "ign" if cr else "fp"
        for c, n in npig.items():
            rows = sorted((d for d in dets if d["category_id"] == c and status[d["det_id"]] != "ign"),
                          key=lambda r: (-r["score"], r["det_id"]))
            tp = fp = 0
            curve = []
            for d in rows:
                tp += status[d["det_id"]] == "tp"
                fp += status[d["det_id"]] == "fp"
                curve.append((tp, tp / (tp + fp)))
            q = []
            for i in range(101):
                ks = [k for k, (tpk, _) in enumerate(curve) if tpk * 100 >= i * n]
                q.append(max(p for _, p in curve[ks[0]:]) if ks else 0.0)
            out[(t, c)] = sum(q) / 101
    return out


def test_ap_matches_brute_force(spark, sf):
    det, gt = fx.detections(spark, sf), fx.as_xyxy(fx.annotations(spark, sf))
    im, ca = fx.images(spark, sf), fx.categories(spark, sf)
    d, g = ev.eval_sets(det, gt, im, ca)
    want = brute_ap([r.asDict() for r in d.collect()], [r.asDict() for r in g.collect()], ev.IOU_THRS)
    got = {(r["iou_thr"], r["category_id"]): r["value"]
           for r in ev.coco_ap(det, gt, im, ca).where("metric = 'AP' AND iou_thr > 0").collect()}
    assert set(got) == set(want)
    for k, v in want.items():
        assert abs(got[k] - v) < 1e-6, k


def test_perfect_predictions_give_one(spark, sf):
    gt = fx.as_xyxy(fx.annotations(spark, sf))
    det = gt.where("iscrowd = 0").select(F.col("id").alias("det_id"), "image_id", "category_id", "x1", "y1", "x2", "y2",
                                         (F.lit(1.0) - (F.col("id") % 97) / 1000.0).alias("score"))
    ap = ev.coco_ap(det, gt, fx.images(spark, sf), fx.categories(spark, sf))
    assert ap.where("metric = 'mAP'").agg(F.min("value")).first()[0] == 1.0
    ar = ev.coco_ar(det, gt, fx.images(spark, sf), fx.categories(spark, sf))
    assert ar.where("metric = 'AR@100' AND category_id = -1").first()["value"] == 1.0


def test_crowd_match_is_ignored(spark):
    gt = spark.createDataFrame([(1, 1, 1, 0.0, 0.0, 10.0, 10.0, 0), (2, 1, 1, 50.0, 50.0, 90.0, 90.0, 1)],
                               "id long, image_id long, category_id long, x1 double, y1 double, x2 double, y2 double, iscrowd int")
    det = spark.createDataFrame([(10, 1, 1, 0.0, 0.0, 10.0, 10.0, 0.5), (11, 1, 1, 60.0, 60.0, 70.0, 70.0, 0.9)],
                                "det_id long, image_id long, category_id long, x1 double, y1 double, x2 double, y2 double, score double")
    im = spark.createDataFrame([(1, 100, 100)], "id long, width int, height int")
    ca = spark.createDataFrame([(1, "a")], "id long, name string")
    ap = ev.coco_ap(det, gt, im, ca).where("metric = 'mAP' AND iou_thr = -1").first()["value"]
    assert ap == 1.0  # the crowd hit (score 0.9) is not a false positive
    vals = [r["value"] for r in ev.coco_ap(det, gt, im, ca).collect()]
    assert all(0.0 <= v <= 1.0 for v in vals)


def test_hot_keys_take_the_spatial_grid(spark, sf):
    det, gt = fx.detections(spark, sf), fx.as_xyxy(fx.annotations(spark, sf))
    d, g = ev.eval_sets(det, gt, fx.images(spark, sf), fx.categories(spark, sf))
    cols = ["det_id", "ann_id", "iou"]
    plain = {tuple(r) for r in ev.iou_join(d, g).where("iou >= 0.5").select(*cols).collect()}
    grid = {tuple(r) for r in ev.iou_join(d, g, min_iou=0.5, hot_truths=0).select(*cols).collect()}
    assert grid == plain and len(plain) > 1000


def test_masks_come_with_the_detections(spark):
    """Every detection is walked and stored once with its masks: the rows that joining them back by id gives,
    with ids that repeat or are missing, and through the grid too.  No pair is dealt by (image, category)."""
    import random
    r = random.Random(5)
    gt, det = [], []
    for i in range(300):
        x, y, w, h = r.uniform(0, 60), r.uniform(0, 60), r.choice([5, 20, 120]), r.choice([5, 20, 120])
        gt.append((i, r.randrange(6), r.randrange(3), x, y, x + w, y + h, int(r.random() < .1)))
        for k in range(r.randrange(4)):
            a, b = r.uniform(-3, 3), r.uniform(-3, 3)
            det.append((None if r.random() < .05 else (10 * i + k) // 2, *gt[-1][1:3], x + a, y + b, x + w + a, y + h + b, r.choice([.1, .2, .3])))
    det += det[::9] + [(5000 + i, i % 8, i % 4, 1e4, 1e4, 1e4 + 5, 1e4 + 5, r.random()) for i in range(40)]
    corners = "long, image_id long, category_id long, x1 double, y1 double, x2 double, y2 double, "
    gt = spark.createDataFrame(gt, f"id {corners} iscrowd int")
    apart = spark.createDataFrame([(i, *x[1:]) for i, x in enumerate(det)], f"det_id {corners} score double")
    det = spark.createDataFrame(det, f"det_id {corners} score double")
    im, ca = spark.range(6), spark.range(3)
    d, g = ev.eval_sets(det, gt, im, ca)
    pairs = ev.iou_join(d, g, min_iou=0.5)
    names = ev._mask_names(ev.AREA_RANGES)
    want = d.withColumn("size", ev.area("")).join(ev.match_masks(pairs), [*ev.KEY, "det_id"], "left") \
        .select(*ev.KEY, "det_id", "score", "size", *[F.coalesce(c, F.lit(0)).alias(c) for c in names])
    got, _, m = ev.evaluate_inputs(det, gt, im, ca)
    as_rows = lambda f: sorted((tuple(x) for x in f.select(*want.columns).collect()), key=str)
    assert as_rows(got) == as_rows(want) and 0 < m.count() < got.count()
    sized = ev.eval_sets(apart, gt, im, ca)[0].withColumn("size", ev.area(""))
    plan, grid = (ev.match_masks(ev.iou_join(sized, g, min_iou=0.5, hot_truths=n, keep=["rk", "size"]), keep=["score", "rk", "size"])
                  for n in (10_000, 12))
    assert as_rows(grid) == as_rows(plan)
    shuffles = [line for line in plan._jdf.queryExecution().executedPlan().toString().splitlines() if "hashpartitioning" in line]
    assert shuffles and not any(", category_id#" in line for line in shuffles)


def test_curve_stores_a_few_longs_a_detection(spark, sf, monkeypatch):
    """Sorted and stored for the curve: no mask column, no box, no id."""
    kept = []
    monkeypatch.setattr(ev, "segmented", lambda *a, **kw: kept.append(plain(*a, **kw)) or kept[-1])
    from boxwise.plans.ranking import segmented as plain
    d, g, m = ev.evaluate_inputs(fx.detections(spark, sf), fx.as_xyxy(fx.annotations(spark, sf)), fx.images(spark, sf), fx.categories(spark, sf))
    curve = ev.pr_curve(d, m, ev.npig(g))
    assert kept[0].columns == ["_pid", "_i", "category_id", "c0", "c1"] and kept[0].count() == d.count()
    boxes = ev.eval_sets(fx.detections(spark, sf), g, fx.images(spark, sf), fx.categories(spark, sf))[0]
    joined = ev.pr_curve(boxes, m, ev.npig(g))                # boxes and masks apart: the same curve
    assert curve.exceptAll(joined).isEmpty() and joined.exceptAll(curve).isEmpty() and curve.count() > 0


def test_unknown_area_counts_in_every_range(spark):
    """A detection without a full box is a false positive of every range, as in the SQL."""
    corners = "long, image_id long, category_id long, x1 double, y1 double, x2 double, y2 double, "
    gt = spark.createDataFrame([(1, 0, 0, 0.0, 0.0, 10.0, 10.0, 0)], f"id {corners} iscrowd int")
    det = spark.createDataFrame([(1, 0, 0, 0.0, 0.0, 10.0, 10.0, 0.5), (2, 0, 0, 0.0, 0.0, None, 5.0, 0.9)], f"det_id {corners} score double")
    d, g, m = ev.evaluate_inputs(det, gt, spark.range(1), spark.range(1))
    assert {(r.area, r.precision) for r in ev.pr_curve(d, m, ev.npig(g)).collect()} == {("all", 0.5), ("small", 0.5)}
