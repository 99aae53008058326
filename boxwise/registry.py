"""Registered queries (Spark) and their DuckDB oracle SQL.

Every query reads the test tables under ``sf_dir`` (through the stand-in views
of ``boxwise.fixtures``) and runs over the whole tables.  Column names are
aliased identically on both sides.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boxwise import fixtures as fx
from boxwise.functions.draws import order_key
from boxwise.operators import dataset as ds
from boxwise.operators import quality as q

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


W = fx.with_fixtures

# ----------------------------------------------------------------- quality ---


@register("table_scan", W("SELECT * FROM annotations"))
def _table_scan(spark, d):
    fx.annotations(spark, d).createOrReplaceTempView("bw_annotations")
    return spark.table("bw_annotations")


@register("prune_annotation_columns",
          W("SELECT id, image_id, category_id, x, y, w, h, iscrowd FROM annotations"))
def _prune(spark, d):
    return q.prune_annotation_columns(fx.annotations(spark, d))


@register("images_left_annotations", W("""
SELECT i.id AS img_id, i.file_name, i.width, i.height, i.split, a.id AS ann_id,
       a.category_id, a.x, a.y, a.w, a.h, a.iscrowd
FROM images i LEFT JOIN annotations a ON i.id = a.image_id"""))
def _d1(spark, d):
    return q.images_left_annotations(fx.images(spark, d), fx.annotations(spark, d))


@register("null_boxes", W("""
SELECT i.id AS img_id, i.file_name, i.width, i.height, i.split, a.id AS ann_id,
       a.category_id, a.x, a.y, a.w, a.h, a.iscrowd
FROM images i LEFT JOIN annotations a ON i.id = a.image_id WHERE a.x IS NULL"""))
def _c8(spark, d):
    return q.null_boxes(q.images_left_annotations(fx.images(spark, d), fx.annotations(spark, d)))


@register("images_without_boxes", W("""
SELECT i.* FROM images i WHERE NOT EXISTS (SELECT 1 FROM annotations a WHERE a.image_id = i.id)"""))
def _d2(spark, d):
    return q.images_without_boxes(fx.images(spark, d), fx.annotations(spark, d))


@register("count_rows", W("""
SELECT count(*) AS n FROM images i LEFT JOIN annotations a ON i.id = a.image_id WHERE a.x IS NULL"""))
def _e1(spark, d):
    return q.count_rows(q.images_without_boxes(fx.images(spark, d), fx.annotations(spark, d)))


@register("orphan_annotations", W("""
SELECT a.* FROM annotations a WHERE a.image_id NOT IN (SELECT id FROM images)"""))
def _d3(spark, d):
    return q.orphan_annotations(fx.annotations(spark, d), fx.images(spark, d))


@register("unknown_categories", W("""
SELECT a.* FROM annotations a WHERE a.category_id NOT IN (SELECT id FROM categories)"""))
def _d4(spark, d):
    return q.unknown_categories(fx.annotations(spark, d), fx.categories(spark, d))


@register("drop_empty_images", W("""
SELECT i.* FROM images i WHERE i.id IN (SELECT image_id FROM annotations)"""))
def _d5(spark, d):
    return q.drop_empty_images(fx.images(spark, d), fx.annotations(spark, d))


@register("duplicate_images", W("""
SELECT id, count(*) AS n FROM (SELECT id FROM images UNION ALL SELECT id FROM images WHERE split = 'val') t
GROUP BY id HAVING count(*) > 1"""))
def _e3(spark, d):
    # the validation images are listed a second time, as by two overlapping documents
    im = fx.images(spark, d)
    return q.duplicate_images(im.unionByName(im.where("split = 'val'")))


@register("expect_counts", W("""
SELECT e.split, coalesce(g.n, 0) AS n_samples, e.expected, coalesce(g.n, 0) = e.expected AS ok
FROM (VALUES ('train', CAST(117266 AS BIGINT)), ('val', CAST(4952 AS BIGINT)),
             ('test', CAST(0 AS BIGINT))) e(split, expected)
LEFT JOIN (SELECT split, count(*) AS n FROM images WHERE id IN (SELECT image_id FROM annotations)
           GROUP BY split) g ON e.split = g.split"""))
def _e4(spark, d):
    return q.expect_counts(fx.images(spark, d), fx.annotations(spark, d), {**q.COCO_EXPECTED_SAMPLES, "test": 0})


@register("label_count", W("""
SELECT (SELECT count(*) FROM categories) + 1 AS n_labels,
       (SELECT count(*) FROM images WHERE id IN (SELECT image_id FROM annotations)) AS n_samples"""))
def _e5(spark, d):
    return q.label_count(fx.categories(spark, d), fx.images(spark, d), fx.annotations(spark, d))


@register("split_summary", W("""
SELECT i.split, count(*) AS n_images, count(nb) AS n_samples, CAST(coalesce(sum(nb), 0) AS BIGINT) AS n_boxes
FROM images i LEFT JOIN (SELECT image_id, count(*) AS nb FROM annotations GROUP BY image_id) a
  ON i.id = a.image_id GROUP BY i.split"""))
def _e6(spark, d):
    return q.split_summary(fx.images(spark, d), fx.annotations(spark, d))


@register("min_size_images", W("SELECT * FROM images WHERE least(width, height) >= 32"))
def _c12(spark, d):
    return q.min_size_images(fx.images(spark, d), 32)


# lookup key: an image id taken from the reference notebook's example, scaled to
# the fixture id range (the feature is a single-image lookup)
LOOKUP_IMAGE_ID = 4587


@register("image_lookup", W(f"SELECT * FROM annotations WHERE image_id = {LOOKUP_IMAGE_ID}"))
def _c7(spark, d):
    return q.image_lookup(fx.annotations(spark, d), LOOKUP_IMAGE_ID)


@register("collect_boxes", W(f"SELECT x, y, w, h FROM annotations WHERE image_id = {LOOKUP_IMAGE_ID}"))
def _b9(spark, d):
    return q.image_lookup(fx.annotations(spark, d), LOOKUP_IMAGE_ID).select("x", "y", "w", "h")

# ----------------------------------------------------------------- dataset ---

LAB_CTE = "lab AS (SELECT id AS category_id, name, row_number() OVER (ORDER BY id) AS label FROM categories)"


@register("dense_labels", W("""
SELECT CAST(label AS BIGINT) AS label, category_id, name, CAST(label - 1 AS BIGINT) AS label0 FROM lab
UNION ALL SELECT CAST(0 AS BIGINT), CAST(NULL AS BIGINT), 'background', CAST(-1 AS BIGINT)""", extra_ctes=LAB_CTE))
def _f1(spark, d):
    return ds.dense_labels(fx.categories(spark, d))


@register("attach_labels", W("""
SELECT a.category_id, a.id, a.image_id, a.x, a.y, a.w, a.h, a.iscrowd,
       CAST(l.label AS BIGINT) AS label_bg1, CAST(l.label - 1 AS BIGINT) AS label0, l.name AS category
FROM annotations a JOIN lab l ON a.category_id = l.category_id""", extra_ctes=LAB_CTE))
def _d6(spark, d):
    return ds.attach_labels(fx.annotations(spark, d), ds.dense_labels(fx.categories(spark, d)))


@register("xywh_to_xyxy", W("SELECT id, image_id, category_id, iscrowd, x1, y1, x2, y2 FROM ann_xyxy"))
def _c2(spark, d):
    return ds.xywh_to_xyxy(fx.annotations(spark, d))


@register("normalize_boxes", W("""
SELECT a.id, a.image_id, a.x1 / i.width AS nx1, a.y1 / i.height AS ny1, a.x2 / i.width AS nx2, a.y2 / i.height AS ny2
FROM ann_xyxy a JOIN images i ON a.image_id = i.id"""))
def _c3(spark, d):
    return ds.normalize_boxes(ds.xywh_to_xyxy(fx.annotations(spark, d)), fx.images(spark, d))


@register("cast_boxes", W("""
SELECT a.category_id, a.id, a.image_id, a.iscrowd, CAST(a.x1 AS FLOAT) AS x1, CAST(a.y1 AS FLOAT) AS y1,
       CAST(a.x2 AS FLOAT) AS x2, CAST(a.y2 AS FLOAT) AS y2, CAST(l.label AS BIGINT) AS label_bg1,
       CAST(l.label - 1 AS BIGINT) AS label0, l.name AS category
FROM ann_xyxy a JOIN lab l ON a.category_id = l.category_id""", extra_ctes=LAB_CTE))
def _c4(spark, d):
    lab = ds.attach_labels(ds.xywh_to_xyxy(fx.annotations(spark, d)), ds.dense_labels(fx.categories(spark, d)))
    return ds.cast_boxes(lab)


# fixed parameters of the path queries (any root works; these mirror a mounted dataset)
DATA_ROOT = "/data/coco/"
NEW_ROOT = "/mnt/datasets/coco"


@register("resolve_image_path", W(f"""
SELECT *, CASE WHEN starts_with(file_name, '/') THEN file_name
               ELSE '{DATA_ROOT.rstrip('/')}/' || split || '2017/' || file_name END AS path FROM images"""))
def _c5(spark, d):
    return ds.resolve_image_path(fx.images(spark, d), DATA_ROOT, F.concat(F.col("split"), F.lit("2017")))


@register("rebase_paths", W(f"""
SELECT id, file_name, width, height, split,
       '{NEW_ROOT}/' || split || '2017/' || file_name AS path FROM images"""))
def _c6(spark, d):
    p = ds.resolve_image_path(fx.images(spark, d), DATA_ROOT, F.concat(F.col("split"), F.lit("2017")))
    return ds.rebase_paths(p, DATA_ROOT, NEW_ROOT)


@register("round_boxes", W("""
SELECT id, image_id, CAST(round_even(x, 0) AS INTEGER) AS x_r, CAST(round_even(y, 0) AS INTEGER) AS y_r,
       CAST(round_even(w, 0) AS INTEGER) AS w_r, CAST(round_even(h, 0) AS INTEGER) AS h_r FROM annotations"""))
def _c9(spark, d):
    return ds.round_boxes(fx.annotations(spark, d))


@register("draw_rects", W("""
SELECT id, image_id, CAST(round_even(x, 0) AS INTEGER) AS "left", CAST(round_even(y, 0) AS INTEGER) AS top,
       CAST(round_even(x, 0) AS INTEGER) + CAST(round_even(w, 0) AS INTEGER) AS "right",
       CAST(round_even(y, 0) AS INTEGER) + CAST(round_even(h, 0) AS INTEGER) AS bottom FROM annotations"""))
def _c10(spark, d):
    return ds.draw_rects(fx.annotations(spark, d))


# fixed parameters: web-page suffixes the suffix filter looks for
PAGE_SUFFIXES = (".html", "/")


@register("suffix_filter", """
SELECT page_id, url AS path FROM pages WHERE ends_with(url, '.html') OR ends_with(url, '/')""")
def _c14(spark, d):
    p = fx.table(spark, d, "pages").select("page_id", F.col("url").alias("path"))
    return ds.suffix_filter(p, PAGE_SUFFIXES)


GROUP_SQL = """
b AS (SELECT a.id, a.image_id, l.label, a.w * a.h AS area FROM annotations a JOIN lab l ON a.category_id = l.category_id),
g AS (SELECT i.id AS image_id, i.split, i.height AS htot, i.width AS wtot, CAST(count(*) AS BIGINT) AS n_boxes,
             string_agg(CAST(b.id AS VARCHAR), ',' ORDER BY b.id) AS box_ids,
             string_agg(CAST(b.label AS VARCHAR), ',' ORDER BY b.id) AS labels, sum(b.area) AS area_sum
      FROM images i JOIN b ON b.image_id = i.id GROUP BY i.id, i.split, i.height, i.width)"""


@register("group_samples", W("SELECT * FROM g", extra_ctes=LAB_CTE + "," + GROUP_SQL))
def _e2(spark, d):
    s = ds.group_samples(fx.images(spark, d), fx.annotations(spark, d), ds.dense_labels(fx.categories(spark, d)))
    return ds.summarize_samples(s)


@register("shuffle_samples", W("""
SELECT id AS image_id, row_number() OVER (ORDER BY md5('9176:' || CAST(id AS VARCHAR)), id) - 1 AS pos
FROM images WHERE id IN (SELECT image_id FROM annotations)"""))
def _g1(spark, d):
    im = q.drop_empty_images(fx.images(spark, d), fx.annotations(spark, d)).select(F.col("id").alias("image_id"))
    return ds.shuffle_samples(im, seed=9176)


@register("union_splits", W("""
SELECT image_id, split, n_boxes, row_number() OVER (PARTITION BY split ORDER BY
         CASE WHEN split = 'train' THEN md5('9176:' || CAST(image_id AS VARCHAR))
              ELSE lpad(CAST(image_id AS VARCHAR), 20, '0') END, image_id) - 1 AS pos
FROM g""", extra_ctes=LAB_CTE + "," + GROUP_SQL))
def _g4(spark, d):
    # all splits are grouped in one pass, with the split as a column of the images
    im, ann = fx.images(spark, d), fx.annotations(spark, d)
    s = ds.summarize_samples(ds.group_samples(im, ann, ds.dense_labels(fx.categories(spark, d))))
    return ds.order_splits(s.select("image_id", "n_boxes").join(
        im.select(F.col("id").alias("image_id"), "split").hint("merge"), "image_id"))


@register("format_sample", W("""
SELECT i.id AS img_id, i.height AS h, i.width AS w, CAST(count(*) AS BIGINT) AS n_boxes,
       sum(a.x + a.y + (a.x + a.w) + (a.y + a.h)) AS coord_sum,
       string_agg(CAST(l.label AS VARCHAR), ',' ORDER BY a.id) AS labels
FROM images i JOIN annotations a ON a.image_id = i.id JOIN lab l ON a.category_id = l.category_id
GROUP BY i.id, i.height, i.width""", extra_ctes=LAB_CTE))
def _c15(spark, d):
    s = ds.group_samples(fx.images(spark, d), fx.annotations(spark, d), ds.dense_labels(fx.categories(spark, d)))
    f = ds.format_sample(s)
    # scalar view of the nested reader layout (box coordinates summed exactly, labels in order)
    return f.select("img_id", F.col("img_shape.h").alias("h"), F.col("img_shape.w").alias("w"),
                    F.size("instances.bbox").cast("bigint").alias("n_boxes"),
                    F.aggregate("instances.bbox", F.lit(0.0),
                                lambda acc, b: acc + b[0] + b[1] + b[2] + b[3]).alias("coord_sum"),
                    F.array_join(F.col("instances.bbox_label").cast("array<string>"), ",").alias("labels"))

# ------------------------------------------------------------- postprocess ---

from boxwise.operators import postprocess as pp  # noqa: E402

DET_COLS = "det_id, image_id, category_id, x1, y1, x2, y2, score"
# fixed parameters: confidence cut of the inference notebook, the model's own score threshold, model-level NMS
# thresholds (test 0.65, TTA 0.6), and per-image limits of the model config
CONF_THR = 0.1
MODEL_THR = 0.001
NMS_THR = 0.5
TOPK = 10


@register("confidence_filter", W(f"SELECT {DET_COLS} FROM detections WHERE score > {CONF_THR}"))
def _c11(spark, d):
    return pp.confidence_filter(fx.detections(spark, d), CONF_THR)


@register("min_box_filter", W(f"SELECT {DET_COLS} FROM detections WHERE x2 - x1 > 32 AND y2 - y1 > 32"))
def _c13(spark, d):
    return pp.min_box_filter(fx.detections(spark, d), 32.0)


@register("topk_per_image", W(f"""
SELECT {DET_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY score DESC, det_id) AS rk
                        FROM detections) t WHERE rk <= {TOPK}"""))
def _f4(spark, d):
    return pp.topk_per_image(fx.detections(spark, d), TOPK)


@register("nms", W(f"SELECT {DET_COLS} FROM n_kept", recursive=True, extra_ctes=f"""
src AS (SELECT {DET_COLS} FROM detections WHERE score > {CONF_THR}),
""" + pp.nms_oracle_ctes("src", NMS_THR).strip()))
def _i2(spark, d):
    return pp.nms(pp.confidence_filter(fx.detections(spark, d), CONF_THR), iou_thr=NMS_THR)


@register("postprocess", W(f"""
SELECT {DET_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY score DESC, det_id) AS rk
                        FROM n_kept) t WHERE rk <= 300""", recursive=True, extra_ctes=f"""
pre AS (SELECT {DET_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY score DESC, det_id) AS rk
        FROM detections WHERE score > 0.001) t WHERE rk <= 30000 AND x2 - x1 > 0 AND y2 - y1 > 0),
""" + pp.nms_oracle_ctes("pre", 0.65).strip()))
def _i3(spark, d):
    return pp.postprocess(fx.detections(spark, d))

# ---------------------------------------------------------------- evaluate ---

from boxwise.operators import evaluate as ev  # noqa: E402

THR_LIST = "[" + ", ".join(repr(t) for t in ev.IOU_THRS) + "]"
_INTER = ("greatest(0.0, least(d.x2, g.x2) - greatest(d.x1, g.x1)) * "
          "greatest(0.0, least(d.y2, g.y2) - greatest(d.y1, g.y1))")
_NC = "list_filter(s.cands, lambda c: c.ign = 0 AND NOT list_contains(m.matched, c.ann_id))"
_CR = "list_filter(s.cands, lambda c: c.ign = 1 AND (c.iscrowd = 1 OR NOT list_contains(m.matched, c.ann_id)))"


def _best(lst: str) -> str:
    return f"list_sort(list_transform({lst}, lambda c: {{'iou': c.iou, 'ann_id': c.ann_id}}), 'DESC')[1].ann_id"


EVAL_CTES = f"""
ev_g AS (SELECT * FROM ann_xyxy WHERE image_id IN (SELECT id FROM images) AND category_id IN (SELECT id FROM categories)),
ev_d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY image_id, category_id ORDER BY score DESC, det_id) AS rk
         FROM detections WHERE image_id IN (SELECT id FROM images) AND category_id IN (SELECT id FROM categories)) t
         WHERE rk <= 100),
thr AS (SELECT CAST(unnest({THR_LIST}) AS DOUBLE) AS t),
pairs AS (SELECT d.det_id, g.id AS ann_id, d.image_id, d.category_id, g.iscrowd, d.score, {_INTER} AS inter,
                 (d.x2 - d.x1) * (d.y2 - d.y1) AS da, (g.x2 - g.x1) * (g.y2 - g.y1) AS ga
          FROM ev_d d JOIN ev_g g ON d.image_id = g.image_id AND d.category_id = g.category_id),
iou AS (SELECT det_id, ann_id, image_id, category_id, iscrowd, score, ga,
               CASE WHEN (CASE WHEN iscrowd = 1 THEN da ELSE da + ga - inter END) > 0
                    THEN inter / (CASE WHEN iscrowd = 1 THEN da ELSE da + ga - inter END) ELSE 0.0 END AS iou
        FROM pairs WHERE inter > 0),
rng AS (SELECT * FROM (VALUES {", ".join(f"('{n}', {lo!r}::DOUBLE, {hi!r}::DOUBLE)" for n, lo, hi in ev.AREA_RANGES)}) v(area, lo, hi)),
cands AS (SELECT i.image_id, i.category_id, r.area, t.t, i.det_id, i.score,
                 list({{'iscrowd': i.iscrowd, 'ign': CASE WHEN i.iscrowd = 1 OR i.ga < r.lo OR i.ga > r.hi THEN 1 ELSE 0 END,
                       'iou': i.iou, 'ann_id': i.ann_id}}) AS cands
          FROM iou i JOIN thr t ON i.iou >= t.t CROSS JOIN rng r GROUP BY ALL),
seq AS (SELECT *, row_number() OVER (PARTITION BY image_id, category_id, area, t ORDER BY score DESC, det_id) AS rn FROM cands),
m AS (
  SELECT DISTINCT image_id, category_id, area, t, 0 AS rn, CAST([] AS BIGINT[]) AS matched,
         CAST(NULL AS BIGINT) AS det_id, CAST(NULL AS BIGINT) AS ann_id, CAST(NULL AS INTEGER) AS crowd FROM seq
  UNION ALL
  SELECT s.image_id, s.category_id, s.area, s.t, s.rn,
         CASE WHEN len({_NC}) > 0 THEN list_append(m.matched, {_best(_NC)})
              WHEN len({_CR}) > 0 THEN list_append(m.matched, {_best(_CR)}) ELSE m.matched END,
         s.det_id,
         CASE WHEN len({_NC}) > 0 THEN {_best(_NC)} WHEN len({_CR}) > 0 THEN {_best(_CR)} END,
         CASE WHEN len({_NC}) > 0 THEN 0 WHEN len({_CR}) > 0 THEN 1 END
  FROM m JOIN seq s ON s.image_id = m.image_id AND s.category_id = m.category_id AND s.area = m.area AND s.t = m.t
       AND s.rn = m.rn + 1),
res AS (SELECT det_id, area, t, ann_id, crowd FROM m WHERE rn > 0 AND crowd IS NOT NULL),
st AS (SELECT d.det_id, d.image_id, d.category_id, g.area, t.t, d.score, d.rk,
              CASE WHEN r.crowd IS NULL AND ((d.x2 - d.x1) * (d.y2 - d.y1) < g.lo OR (d.x2 - d.x1) * (d.y2 - d.y1) > g.hi)
                   THEN 1 ELSE r.crowd END AS crowd
       FROM ev_d d CROSS JOIN thr t CROSS JOIN rng g LEFT JOIN res r ON r.det_id = d.det_id AND r.t = t.t AND r.area = g.area),
ni AS (SELECT *, row_number() OVER (PARTITION BY category_id, area, t ORDER BY score DESC, image_id, det_id) AS k
       FROM st WHERE crowd IS NULL OR crowd = 0),
tpr AS (SELECT *, row_number() OVER (PARTITION BY category_id, area, t ORDER BY score DESC, image_id, det_id) AS mm
        FROM ni WHERE crowd = 0),
npig AS (SELECT category_id, area, count(*) AS npig FROM ev_g e JOIN rng g
         ON (e.x2 - e.x1) * (e.y2 - e.y1) BETWEEN g.lo AND g.hi WHERE iscrowd = 0 GROUP BY category_id, area),
band AS (SELECT tpr.category_id, tpr.area, tpr.t, least(100, (100 * mm) // npig) AS b, max(mm / k) AS mp
         FROM tpr JOIN npig USING (category_id, area) GROUP BY ALL),
pr AS (SELECT c.category_id, c.area, t.t AS iou_thr, r.i AS recall_idx, coalesce(max(b.mp), 0.0) AS precision
       FROM npig c CROSS JOIN thr t CROSS JOIN (SELECT range AS i FROM range(0, 101)) r
       LEFT JOIN band b ON b.category_id = c.category_id AND b.area = c.area AND b.t = t.t AND b.b >= r.i GROUP BY ALL),
ap AS (SELECT category_id, area, iou_thr, sum(precision) / 101.0 AS ap FROM pr GROUP BY ALL),
hit AS (SELECT category_id, area, t, rk, count(*) AS n FROM st WHERE crowd = 0 GROUP BY ALL),
rec AS (SELECT c.category_id, c.area, t.t, md.n AS max_det, c.npig, coalesce(sum(h.n), 0) AS tp
        FROM npig c CROSS JOIN thr t JOIN (SELECT unnest([100, 1, 10]) AS n) md ON c.area = 'all' OR md.n = 100
        LEFT JOIN hit h ON h.category_id = c.category_id AND h.area = c.area AND h.t = t.t AND h.rk <= md.n GROUP BY ALL),
rc AS (SELECT category_id, area, max_det, sum(tp) / (any_value(npig) * 10) AS recall FROM rec GROUP BY category_id, area, max_det)"""


def _eval_inputs(spark, d):
    return (fx.detections(spark, d), fx.as_xyxy(fx.annotations(spark, d)),
            fx.images(spark, d), fx.categories(spark, d))


@register("iou_join", W("SELECT det_id, ann_id, iou FROM iou", extra_ctes=EVAL_CTES, recursive=True))
def _d9(spark, d):
    det, gt, im, ca = _eval_inputs(spark, d)
    dd, gg = ev.eval_sets(det, gt, im, ca)
    return ev.iou_join(dd, gg).select("det_id", "ann_id", "iou")


@register("coco_match", W("SELECT det_id, t AS iou_thr, ann_id, crowd FROM res WHERE area = 'all'", extra_ctes=EVAL_CTES, recursive=True))
def _k3(spark, d):
    det, gt, im, ca = _eval_inputs(spark, d)
    dd, gg = ev.eval_sets(det, gt, im, ca)
    return ev.match(ev.iou_join(dd, gg).where(F.col("iou") >= 0.5))


@register("pr_curve", W("SELECT category_id, iou_thr, CAST(recall_idx AS INTEGER) AS recall_idx, precision, area FROM pr",
                        extra_ctes=EVAL_CTES, recursive=True))
def _f6(spark, d):
    det, gt, im, ca = _eval_inputs(spark, d)
    dd, g, m = ev.evaluate_inputs(det, gt, im, ca)
    return ev.pr_curve(dd, m, ev.npig(g))


@register("coco_ap", W("""
SELECT 'AP' AS metric, iou_thr, category_id, round(ap, 6) AS value FROM ap WHERE area = 'all'
UNION ALL SELECT 'AP', CAST(-1 AS DOUBLE), category_id, round(avg(ap), 6) FROM ap WHERE area = 'all' GROUP BY category_id
UNION ALL SELECT CASE WHEN area = 'all' THEN 'mAP' ELSE 'mAP_' || area END, CAST(-1 AS DOUBLE), CAST(-1 AS BIGINT), round(avg(ap), 6)
          FROM ap GROUP BY area
UNION ALL SELECT 'mAP', iou_thr, CAST(-1 AS BIGINT), round(avg(ap), 6) FROM ap
          WHERE area = 'all' AND iou_thr IN (0.5, 0.75) GROUP BY iou_thr""",
                       extra_ctes=EVAL_CTES, recursive=True))
def _e7(spark, d):
    return ev.coco_ap(*_eval_inputs(spark, d))


@register("coco_ar", W("""
SELECT 'AR@' || CAST(max_det AS VARCHAR) AS metric, CAST(-1 AS DOUBLE) AS iou_thr, category_id, round(recall, 6) AS value
FROM rc WHERE area = 'all'
UNION ALL SELECT CASE WHEN area = 'all' THEN 'AR@' || CAST(max_det AS VARCHAR) ELSE 'AR_' || area END, CAST(-1 AS DOUBLE),
                 CAST(-1 AS BIGINT), round(avg(recall), 6) FROM rc GROUP BY area, max_det""",
                       extra_ctes=EVAL_CTES, recursive=True))
def _e8(spark, d):
    return ev.coco_ar(*_eval_inputs(spark, d))

# -------------------------------------------------------------------- feed ---

from boxwise.operators import feed as fd  # noqa: E402
from boxwise.plans import shards as sh  # noqa: E402
from boxwise.sinks import files as fo  # noqa: E402
from boxwise.session import materialize, scratch_path  # noqa: E402

SAMPLES_CTE = "smp AS (SELECT id AS image_id FROM images WHERE id IN (SELECT image_id FROM annotations))"
# fixed parameters of the feeding queries: one node with 2 devices and 2 loader
# workers each, batch 32, default canonical nodes (64 per node), seed 9176
PLAN = dict(seed=9176, epoch=0, nodes=1, ranks=2, workers=2, batch_size=32)


def _samples(spark, d):
    return q.drop_empty_images(fx.images(spark, d), fx.annotations(spark, d)).select(F.col("id").alias("image_id"))


EPOCH_CTES = SAMPLES_CTE + """,
ep AS (SELECT image_id, row_number() OVER (ORDER BY md5('9176:0:' || CAST(image_id AS VARCHAR)), image_id) - 1 AS pos,
              count(*) OVER () AS n FROM smp),
ec AS (SELECT *, CAST(floor(pos * 64 / n) AS BIGINT) AS canonical_node FROM ep),
ej AS (SELECT *, pos - (canonical_node * n + 63) // 64 AS j FROM ec),
ea AS (SELECT image_id, pos, canonical_node, CAST(canonical_node % 1 AS INTEGER) AS node,
              CAST(j % 2 AS INTEGER) AS rank, CAST(floor(j / 2) % 2 AS INTEGER) AS worker FROM ej),
eb AS (SELECT *, row_number() OVER (PARTITION BY node, rank, worker ORDER BY pos) - 1 AS idx FROM ea)"""


# the same epoch, interrupted after 5 batches of every stream and resumed on 3 nodes
RESUMED = dict(new_nodes=3, new_ranks=1, new_workers=3, batch_size=16)


@register("resume_epoch", W("""
SELECT image_id, pos, canonical_node, node, rank, worker, idx, idx // 16 AS batch_id
FROM (SELECT *, row_number() OVER (PARTITION BY node, rank, worker ORDER BY canonical_node, j) - 1 AS idx
      FROM (SELECT image_id, pos, canonical_node, j, CAST(canonical_node % 3 AS INTEGER) AS node, CAST(0 AS INTEGER) AS rank,
                   CAST(j % 3 AS INTEGER) AS worker
            FROM (SELECT *, row_number() OVER (PARTITION BY canonical_node ORDER BY pos) - 1 AS j
                  FROM eb WHERE idx >= 5 * 32) a) b) c""", extra_ctes=EPOCH_CTES))
def _resume(spark, d):
    p = fd.epoch_plan(_samples(spark, d), **PLAN)
    old = {k: PLAN[k] for k in ("nodes", "ranks", "workers")}
    return fd.resume_epoch(p, 5 * PLAN["batch_size"], **old, **RESUMED)


@register("epoch_plan", W("SELECT *, idx // 32 AS batch_id FROM eb", extra_ctes=EPOCH_CTES))
def _f3(spark, d):
    return fd.epoch_plan(_samples(spark, d), **PLAN)


@register("collate_batches", W("""
SELECT node, rank, worker, idx // 32 AS batch_id, CAST(count(*) AS BIGINT) AS n,
       string_agg(CAST(image_id AS VARCHAR), ',' ORDER BY idx) AS image_ids
FROM eb GROUP BY ALL""", extra_ctes=EPOCH_CTES))
def _m4(spark, d):
    p = fd.epoch_plan(_samples(spark, d), **PLAN)
    b = fd.collate_batches(p, batch_cols=("node", "rank", "worker", "batch_id"), cols=["idx", "image_id"])
    return b.select("node", "rank", "worker", "batch_id", F.size("samples").cast("bigint").alias("n"),
                    F.array_join(F.transform("samples", lambda x: x["image_id"].cast("string")), ",").alias("image_ids"))


SHUF_CTE = """
sp0 AS (SELECT i.id AS image_id, i.width, i.height,
               row_number() OVER (ORDER BY md5('9176:' || CAST(i.id AS VARCHAR)), i.id) - 1 AS pos FROM images i)"""


@register("aspect_ratio_batches", W("""
SELECT image_id, bucket, (row_number() OVER (PARTITION BY bucket ORDER BY pos) - 1) // 2 AS batch_id
FROM (SELECT *, CASE WHEN width < height THEN 0 ELSE 1 END AS bucket FROM sp0) t""", extra_ctes=SHUF_CTE))
def _f2(spark, d):
    im = fx.images(spark, d).select(F.col("id").alias("image_id"), "width", "height")
    return fd.aspect_ratio_batches(ds.shuffle_samples(im), batch_size=2).select("image_id", "bucket", "batch_id")


@register("first_batch", W("SELECT image_id, pos FROM sp0 ORDER BY pos LIMIT 32", extra_ctes=SHUF_CTE))
def _g2(spark, d):
    # a top-k of the shuffle key: the other images are never ranked
    im = fx.images(spark, d).select(F.col("id").alias("image_id"))
    first = fd.first_batch(im.withColumn("_k", order_key("image_id", 9176)), 32, order_col=["_k", "image_id"])
    w = Window.orderBy("_k", "image_id")
    return first.withColumn("pos", F.row_number().over(w).cast("bigint") - 1).select("image_id", "pos")


EPOCH_SIZE = 20000


@register("epoch_sample", W(f"""
SELECT p.image_id, p.pos, r.rep, r.rep * p.n + p.pos AS sample_idx
FROM (SELECT image_id, pos, count(*) OVER () AS n FROM sp0) p
JOIN (SELECT range AS rep FROM range(0, 1000)) r
  ON r.rep < {EPOCH_SIZE} // p.n + CASE WHEN p.pos < {EPOCH_SIZE} % p.n THEN 1 ELSE 0 END""", extra_ctes=SHUF_CTE))
def _g3(spark, d):
    im = fx.images(spark, d).select(F.col("id").alias("image_id"))
    out = fd.epoch_sample(ds.shuffle_samples(im), EPOCH_SIZE)
    return out.select("image_id", "pos", F.col("rep").cast("bigint").alias("rep"), "sample_idx")


# ------------------------------------------------------------------ shards ---

# fixed parameters: the payload stand-in is small, so the limit is 64 KiB
# (not the 32 MiB default) and a lane holds 8 shards' worth of bytes
SHARD_LIMIT = 65536
SHARDS_PER_LANE = 8

SHARD_CTES = f"""
so AS (SELECT sample_id, split, nbytes, row_number() OVER (PARTITION BY split ORDER BY
              CASE WHEN split = 'train' THEN md5('9176:' || CAST(sample_id AS VARCHAR))
                   ELSE lpad(CAST(sample_id AS VARCHAR), 20, '0') END, sample_id) - 1 AS pos FROM documents_s),
nl AS (SELECT greatest(1, CAST(ceil(sum(nbytes) / {SHARD_LIMIT * SHARDS_PER_LANE}) AS BIGINT)) AS lanes FROM documents_s),
sl AS (SELECT so.*, CAST(pos % lanes AS INTEGER) AS lane, lanes,
              row_number() OVER (PARTITION BY split, pos % lanes ORDER BY pos) AS rn FROM so, nl),
spk AS (
  SELECT split, lane, rn, sample_id, pos, nbytes, lanes, CAST(0 AS BIGINT) AS cur, nbytes AS used FROM sl WHERE rn = 1
  UNION ALL
  SELECT l.split, l.lane, l.rn, l.sample_id, l.pos, l.nbytes, l.lanes,
         CASE WHEN k.used > 0 AND k.used + l.nbytes > {SHARD_LIMIT} THEN k.cur + 1 ELSE k.cur END,
         CASE WHEN k.used > 0 AND k.used + l.nbytes > {SHARD_LIMIT} THEN l.nbytes ELSE k.used + l.nbytes END
  FROM spk k JOIN sl l ON l.split = k.split AND l.lane = k.lane AND l.rn = k.rn + 1),
plan AS (SELECT sample_id, split, lane, pos, nbytes, cur * lanes + lane AS shard FROM spk)"""


def _write(spark, d, codec=None):
    root = scratch_path(spark, "shards")
    sh.write_shards(fx.documents(spark, d), root, size_limit=SHARD_LIMIT,
                    shards_per_lane=SHARDS_PER_LANE, codec=codec)
    return root


@register("shard_plan", W("SELECT * FROM plan", recursive=True, extra_ctes=SHARD_CTES))
def _k4(spark, d):
    return sh.shard_plan(fx.documents(spark, d), size_limit=SHARD_LIMIT, shards_per_lane=SHARDS_PER_LANE)


# shard-aware order of the training split: spans of 64 samples, 4 canonical nodes
SHARD_EPOCH = dict(ranks=2, workers=2, batch_size=8, num_canonical_nodes=4, block_size=64)
SHARD_EPOCH_CTES = SHARD_CTES + """,
tr AS (SELECT sample_id, shard, pos, nbytes FROM plan WHERE split = 'train'),
sk AS (SELECT shard, sum(n) OVER (ORDER BY md5('9176:0:' || CAST(shard AS VARCHAR)), shard) - n AS ahead
       FROM (SELECT shard, count(*) AS n FROM tr GROUP BY shard) g),
sp AS (SELECT tr.*, ahead + row_number() OVER (PARTITION BY tr.shard ORDER BY pos, sample_id) - 1 AS p, count(*) OVER () AS n
       FROM tr JOIN sk ON sk.shard = tr.shard),
scn AS (SELECT *, CAST(floor(p * 4 / n) AS BIGINT) AS canonical_node FROM sp),
sj0 AS (SELECT *, CAST((canonical_node * n + 3) // 4 AS BIGINT) AS first FROM scn),
sj AS (SELECT *, (p - first) // 64 * 64 + row_number() OVER (PARTITION BY canonical_node, (p - first) // 64
              ORDER BY md5('9176:0:' || CAST(sample_id AS VARCHAR)), sample_id) - 1 AS j FROM sj0),
sq AS (SELECT sample_id, shard, nbytes, CAST(first + j AS BIGINT) AS pos, canonical_node, CAST(0 AS INTEGER) AS node,
              CAST(j % 2 AS INTEGER) AS rank, CAST(floor(j / 2) % 2 AS INTEGER) AS worker, j FROM sj),
se AS (SELECT *, row_number() OVER (PARTITION BY node, rank, worker ORDER BY canonical_node, j) - 1 AS idx FROM sq)"""


def _shard_epoch(spark, d):
    p = sh.shard_plan(fx.documents(spark, d), size_limit=SHARD_LIMIT, shards_per_lane=SHARDS_PER_LANE)
    return fd.shard_epoch_plan(p.where("split = 'train'").select("sample_id", "shard", "pos", "nbytes"), **SHARD_EPOCH)


@register("shard_epoch_plan", W("""
SELECT sample_id, shard, nbytes, pos, canonical_node, node, rank, worker, idx, idx // 8 AS batch_id FROM se""",
                                recursive=True, extra_ctes=SHARD_EPOCH_CTES))
def _k5_shards(spark, d):
    return _shard_epoch(spark, d)


@register("open_shards", W("""
SELECT g.node, g.rank, g.worker, g.shards, o.most_open
FROM (SELECT node, rank, worker, count(DISTINCT shard) AS shards FROM se GROUP BY node, rank, worker) g
JOIN (SELECT node, rank, worker, max(held) AS most_open
      FROM (SELECT x.node, x.rank, x.worker, x.idx, count(*) AS held
            FROM se x JOIN (SELECT node, rank, worker, shard, min(idx) AS a, max(idx) AS b FROM se GROUP BY ALL) i
            ON i.node = x.node AND i.rank = x.rank AND i.worker = x.worker AND x.idx BETWEEN i.a AND i.b
            GROUP BY x.node, x.rank, x.worker, x.idx) c GROUP BY node, rank, worker) o
ON o.node = g.node AND o.rank = g.rank AND o.worker = g.worker""", recursive=True, extra_ctes=SHARD_EPOCH_CTES))
def _k5_open(spark, d):
    return fd.open_shards(_shard_epoch(spark, d))


SHARD_COUNT_SQL = W("""
SELECT split, shard, count(*) AS n_samples, CAST(sum(nbytes) AS BIGINT) AS n_bytes FROM plan GROUP BY split, shard""",
                    recursive=True, extra_ctes=SHARD_CTES)


@register("write_shards", SHARD_COUNT_SQL)
def _b3(spark, d):
    return sh.shard_counts(spark, _write(spark, d))


@register("write_compressed", SHARD_COUNT_SQL)
def _b6(spark, d):
    return sh.shard_counts(spark, _write(spark, d, codec="zstd"))


@register("shard_manifest", SHARD_COUNT_SQL)
def _b4(spark, d):
    m = sh.shard_manifest(spark, _write(spark, d))
    return m.where("length(sha1) = 40 AND length(xxh64) = 16 AND file_bytes > 0").select("split", "shard", "n_samples", "n_bytes")


@register("read_split", W("SELECT sample_id, shard, pos, nbytes FROM plan WHERE split = 'val'",
                          recursive=True, extra_ctes=SHARD_CTES))
def _a7(spark, d):
    return sh.read_split(spark, _write(spark, d), "val").select("sample_id", "shard", "pos", "nbytes")


@register("validate_hashes", W("""
SELECT split, shard, 'changed' AS issue FROM plan WHERE sample_id = (SELECT min(sample_id) FROM plan WHERE split = 'train')
UNION ALL SELECT split, shard, 'missing' FROM plan WHERE sample_id = (SELECT min(sample_id) FROM plan WHERE split = 'val')""",
                               recursive=True, extra_ctes=SHARD_CTES))
def _b5(spark, d):
    """A copy of the shards at another root, with the shard of the first training
    sample changed and that of the first validation sample left out."""
    root, moved = _write(spark, d), scratch_path(spark, "moved")
    # the folders are listed once, and the files hashed once, for all that is made of them
    shards = spark.read.parquet(root)
    manifest = materialize(sh.shard_manifest(spark, root, shards), "manifest")
    first = shards.groupBy("split").agg(F.min_by("shard", "sample_id").alias("shard")).collect()
    at = {r["split"]: f"split={r['split']}/shard={r['shard']}/" for r in first}
    fo.copy_tree(spark, root, moved)
    name = F.col("rel_path")
    picked = manifest.where(name.startswith(at["train"])).select(F.concat(F.lit(moved + "/"), name).alias("path"),
                                                                  F.lit("changed").alias("content"))
    fo.put_files(picked)
    # the left-out shard: validated under a manifest row that no file of this name has
    manifest = manifest.withColumn("rel_path", F.when(name.startswith(at["val"]), F.concat(name, F.lit(".gone")))
                                   .otherwise(name))
    bad = sh.validate_hashes(spark, moved, manifest)
    return bad.where("sha1 IS NOT NULL").select("split", "shard", F.when(F.col("sha1_now").isNull(), F.lit("missing"))
                                                .otherwise(F.lit("changed")).alias("issue"))

# ----------------------------------------------------------------- augment ---

from boxwise.functions.draws import uniform_sql  # noqa: E402
from boxwise.operators import augment as ag  # noqa: E402


def _aug_frame(spark, d):
    b = fx.as_xyxy(fx.annotations(spark, d)).select("image_id", F.col("id").alias("box_id"), "category_id",
                                                   "x1", "y1", "x2", "y2")
    return ag.frame(fx.images(spark, d), b)


FRAME_CTE = """
fr AS (SELECT a.image_id, a.id AS box_id, a.category_id, a.x1, a.y1, a.x2, a.y2, i.width AS w, i.height AS h
       FROM ann_xyxy a JOIN images i ON a.image_id = i.id)"""


def _clip(c: str, lim: str) -> str:
    return f"least(greatest({c}, 0.0), CAST({lim} AS DOUBLE))"


def _resize_sql(src: str, name: str, long_e: str, short_e: str, keep: str = "image_id, box_id, category_id") -> str:
    """Keep-ratio resize of frame ``src`` (edges are SQL expressions)."""
    return f"""
{name}_a AS (SELECT *, least({long_e} / greatest(w, h), {short_e} / least(w, h)) AS s_ FROM {src}),
{name}_b AS (SELECT *, CAST(floor(w * s_ + 0.5) AS INTEGER) AS nw_, CAST(floor(h * s_ + 0.5) AS INTEGER) AS nh_ FROM {name}_a),
{name} AS (SELECT {keep}, nw_ AS w, nh_ AS h,
           {_clip('x1 * (nw_ / w)', 'nw_')} AS x1, {_clip('y1 * (nh_ / h)', 'nh_')} AS y1,
           {_clip('x2 * (nw_ / w)', 'nw_')} AS x2, {_clip('y2 * (nh_ / h)', 'nh_')} AS y2 FROM {name}_b)"""


RR_R = f"(0.1 + {uniform_sql('image_id', 'random_resize')} * {2.0 - 0.1!r})"
RR_CTES = f"""
rr0 AS (SELECT *, floor(1280.0 * {RR_R}) AS tl_ FROM fr),""" + _resize_sql("rr0", "rr", "tl_", "tl_")

_OX = f"floor({uniform_sql('image_id', 'random_crop', salt='x')} * (greatest(w - 640, 0) + 1))"
_OY = f"floor({uniform_sql('image_id', 'random_crop', salt='y')} * (greatest(h - 640, 0) + 1))"
RC_CTES = RR_CTES + f""",
rc0 AS (SELECT *, {_OX} AS ox_, {_OY} AS oy_, least(w, 640) AS nw_, least(h, 640) AS nh_ FROM rr),
rc AS (SELECT * FROM (SELECT image_id, box_id, category_id, nw_ AS w, nh_ AS h,
              {_clip('x1 - ox_', 'nw_')} AS x1, {_clip('y1 - oy_', 'nh_')} AS y1,
              {_clip('x2 - ox_', 'nw_')} AS x2, {_clip('y2 - oy_', 'nh_')} AS y2 FROM rc0) t WHERE x2 > x1 AND y2 > y1)"""

AUG_COLS = "image_id, box_id, category_id, w, h, x1, y1, x2, y2"


@register("resize_keep_ratio", W(f"SELECT {AUG_COLS} FROM rs",
                                 extra_ctes=FRAME_CTE + "," + _resize_sql("fr", "rs", "640.0", "640.0")))
def _j1(spark, d):
    return ag.resize_keep_ratio(_aug_frame(spark, d), (640, 640))


@register("random_resize", W(f"SELECT {AUG_COLS} FROM rr", extra_ctes=FRAME_CTE + "," + RR_CTES))
def _j2(spark, d):
    return ag.random_resize(_aug_frame(spark, d), scale=(1280, 1280), ratio_range=(0.1, 2.0))


@register("random_crop", W(f"SELECT {AUG_COLS} FROM rc", extra_ctes=FRAME_CTE + "," + RC_CTES))
def _j3(spark, d):
    x = ag.random_resize(_aug_frame(spark, d), scale=(1280, 1280), ratio_range=(0.1, 2.0))
    return ag.random_crop(x, (640, 640))


_FLIP = f"{uniform_sql('image_id', 'random_flip')} < 0.5"


@register("random_flip", W(f"""
SELECT image_id, box_id, category_id, w, h, CASE WHEN {_FLIP} THEN w - x2 ELSE x1 END AS x1, y1,
       CASE WHEN {_FLIP} THEN w - x1 ELSE x2 END AS x2, y2 FROM fr""", extra_ctes=FRAME_CTE))
def _j4(spark, d):
    return ag.random_flip(_aug_frame(spark, d), 0.5)


@register("pad", W(f"""
SELECT image_id, box_id, category_id, greatest(w, 640) AS w, greatest(h, 640) AS h, x1, y1, x2, y2 FROM rc""",
                   extra_ctes=FRAME_CTE + "," + RC_CTES))
def _j5(spark, d):
    x = ag.random_crop(ag.random_resize(_aug_frame(spark, d), scale=(1280, 1280), ratio_range=(0.1, 2.0)), (640, 640))
    return ag.pad(x, (640, 640))


def partner_sql(*, cache: int, k: int, min_cache: int, op: str, random_pop: bool) -> str:
    """SQL of :func:`augment.sample_cache_partners` over the epoch plan ``eb``."""
    u = uniform_sql("CAST(image_id AS VARCHAR) || ':' || CAST(slot AS VARCHAR)", f"{op}_partner")
    slots = ", ".join(str(i) for i in range(1, k + 1))
    if random_pop:
        return f"""
SELECT r.image_id, CAST(r.slot AS INTEGER) AS slot, w.image_id AS partner_id
FROM (SELECT *, floor({u} * c) AS place
      FROM (SELECT node, rank, worker, idx, image_id, least({cache}, idx + 1) AS c FROM eb
            WHERE least({cache}, idx + 1) >= {min_cache}) cp
      CROSS JOIN (SELECT unnest([{slots}]) AS slot) s) r
ASOF JOIN (SELECT node, rank, worker, idx, image_id, CASE WHEN idx < {cache} THEN idx
             ELSE floor({uniform_sql('image_id', f'{op}_evict')} * {cache + 1}) END AS place FROM eb) w
ON w.node = r.node AND w.rank = r.rank AND w.worker = r.worker AND w.place = r.place AND r.idx >= w.idx"""
    return f"""
SELECT cu.image_id, CAST(cu.slot AS INTEGER) AS slot, e.image_id AS partner_id
FROM (SELECT *, idx - c + 1 + floor({u} * c) AS pidx
      FROM (SELECT node, rank, worker, idx, image_id, least({cache}, idx + 1) AS c FROM eb
            WHERE least({cache}, idx + 1) >= {min_cache}) cp
      CROSS JOIN (SELECT unnest([{slots}]) AS slot) s) cu
JOIN eb e ON e.node = cu.node AND e.rank = cu.rank AND e.worker = cu.worker AND e.idx = cu.pidx"""


# fixed parameters: mosaic takes 3 partners and needs more than 4 cached images, mixup 1
# and at least 2; the large models cache 40 and 20 and evict at random, the tiny ones
# 20 and 10 and drop the oldest
LARGE_MOSAIC = dict(cache=40, k=3, min_cache=5, op="mosaic", random_pop=True)
LARGE_MIXUP = dict(cache=20, k=1, min_cache=2, op="mixup", random_pop=True)
TINY_MOSAIC = dict(cache=20, k=3, min_cache=5, op="mosaic", random_pop=False)
TINY_MIXUP = dict(cache=10, k=1, min_cache=2, op="mixup", random_pop=False)


@register("sample_cache_partners", W(partner_sql(**LARGE_MOSAIC), extra_ctes=EPOCH_CTES))
def _f7(spark, d):
    p = fd.epoch_plan(_samples(spark, d), **PLAN)
    return ag.sample_cache_partners(p, **LARGE_MOSAIC)


@register("sample_cache_partners_tiny", W(partner_sql(**TINY_MOSAIC), extra_ctes=EPOCH_CTES))
def _f7_tiny(spark, d):
    p = fd.epoch_plan(_samples(spark, d), **PLAN)
    return ag.sample_cache_partners(p, **TINY_MOSAIC)


def _u(op, salt, ident="image_id"):
    return uniform_sql(ident, op, salt=salt)


def mosaic_ctes(cache: dict) -> str:
    return EPOCH_CTES + "," + FRAME_CTE + f""",
mpart AS ({partner_sql(**cache)}),
mfull AS (SELECT image_id FROM mpart WHERE slot BETWEEN 1 AND 3 GROUP BY image_id HAVING count(*) = 3),
mtiles AS (SELECT image_id, 0 AS tile, image_id AS src_id FROM mfull
           UNION ALL SELECT image_id, slot, partner_id FROM mpart
           WHERE slot BETWEEN 1 AND 3 AND image_id IN (SELECT image_id FROM mfull)),
mt AS (SELECT t.*, i.width AS sw, i.height AS sh,
              floor((0.5 + {_u('mosaic', 'cx')} * 1.0) * 640) AS cx, floor((0.5 + {_u('mosaic', 'cy')} * 1.0) * 640) AS cy,
              least(640.0 / i.height, 640.0 / i.width) AS r
       FROM mtiles t JOIN images i ON i.id = t.src_id),
mt2 AS (SELECT *, floor(sw * r) AS tw, floor(sh * r) AS th FROM mt),
mt3 AS (SELECT *, CASE WHEN tile IN (0, 2) THEN greatest(cx - tw, 0) ELSE cx END AS px1,
                  CASE WHEN tile IN (0, 1) THEN greatest(cy - th, 0) ELSE cy END AS py1,
                  CASE WHEN tile IN (0, 2) THEN cx ELSE least(cx + tw, 1280) END AS px2,
                  CASE WHEN tile IN (0, 1) THEN cy ELSE least(cy + th, 1280) END AS py2 FROM mt2),
mt4 AS (SELECT image_id, tile, src_id, r,
               px1 - CASE WHEN tile IN (0, 2) THEN tw - (px2 - px1) ELSE 0 END AS padw,
               py1 - CASE WHEN tile IN (0, 1) THEN th - (py2 - py1) ELSE 0 END AS padh FROM mt3),
mb AS (SELECT t.image_id, t.tile, t.src_id, f.box_id, f.category_id, 1280 AS w, 1280 AS h,
              {_clip('f.x1 * t.r + t.padw', '1280')} AS x1, {_clip('f.y1 * t.r + t.padh', '1280')} AS y1,
              {_clip('f.x2 * t.r + t.padw', '1280')} AS x2, {_clip('f.y2 * t.r + t.padh', '1280')} AS y2
       FROM mt4 t JOIN fr f ON f.image_id = t.src_id),
mos AS (SELECT * FROM mb WHERE x2 > x1 AND y2 > y1
        UNION ALL SELECT f.image_id, 0, f.image_id, f.box_id, f.category_id, f.w, f.h, f.x1, f.y1, f.x2, f.y2
        FROM fr f JOIN eb ON eb.image_id = f.image_id
        WHERE f.image_id NOT IN (SELECT image_id FROM mfull))"""


MIXUP_CTES = EPOCH_CTES + "," + FRAME_CTE + f""",
xpart AS ({partner_sql(**LARGE_MIXUP)}),
xp AS (SELECT p.image_id, p.partner_id AS src, t.tw, t.th
       FROM xpart p JOIN (SELECT DISTINCT image_id, w AS tw, h AS th FROM fr) t ON t.image_id = p.image_id
       WHERE p.slot = 1 AND {_u('mixup', 'p', 'p.image_id')} < 1.0),
xj AS (SELECT p.image_id, p.tw, p.th, f.box_id, f.category_id, f.x1, f.y1, f.x2, f.y2,
              least(640.0 / f.h, 640.0 / f.w) * (1.0 + {_u('mixup', 'jit', 'p.image_id')} * 0.0) AS r,
              {_u('mixup', 'flip', 'p.image_id')} > 0.5 AS flip,
              floor({_u('mixup', 'x', 'p.image_id')} * greatest(640 - p.tw, 0)) AS ox,
              floor({_u('mixup', 'y', 'p.image_id')} * greatest(640 - p.th, 0)) AS oy
       FROM xp p JOIN fr f ON f.image_id = p.src),
xm AS (SELECT image_id, box_id, category_id, tw AS w, th AS h,
              (CASE WHEN flip THEN 640.0 - x2 * r ELSE x1 * r END) - ox AS x1, y1 * r - oy AS y1,
              (CASE WHEN flip THEN 640.0 - x1 * r ELSE x2 * r END) - ox AS x2, y2 * r - oy AS y2 FROM xj),
xc AS (SELECT image_id, box_id, category_id, w, h, {_clip('x1', 'w')} AS x1, {_clip('y1', 'h')} AS y1,
              {_clip('x2', 'w')} AS x2, {_clip('y2', 'h')} AS y2 FROM xm)"""


@register("mosaic_compose", W("SELECT * FROM mos", extra_ctes=mosaic_ctes(LARGE_MOSAIC)))
def _j6(spark, d):
    p = fd.epoch_plan(_samples(spark, d), **PLAN)
    mp = ag.sample_cache_partners(p, **LARGE_MOSAIC)
    fb = _aug_frame(spark, d)
    return ag.mosaic_compose(ag.frame(fx.images(spark, d)), fb.drop("w", "h"), mp, samples=p)


@register("mixup_compose", W(f"""
SELECT {AUG_COLS} FROM fr UNION ALL SELECT {AUG_COLS} FROM xc WHERE x2 > x1 AND y2 > y1""", extra_ctes=MIXUP_CTES))
def _j7(spark, d):
    p = fd.epoch_plan(_samples(spark, d), **PLAN)
    xp = ag.sample_cache_partners(p, **LARGE_MIXUP)
    fb = _aug_frame(spark, d)
    return ag.mixup_compose(fb, fb, xp)


def _augment(spark, d, **options):
    p = fd.epoch_plan(_samples(spark, d), **PLAN)
    b = fx.as_xyxy(fx.annotations(spark, d)).select("image_id", F.col("id").alias("box_id"), "category_id",
                                                   "x1", "y1", "x2", "y2")
    return ag.augment_plan(fx.images(spark, d), b, p, **options)


@register("augment_plan")
def _j8(spark, d):
    return _augment(spark, d, epoch=0)


@register("augment_plan_tiny")
def _j8_tiny(spark, d):
    return _augment(spark, d, epoch=0, **ag.TINY)


@register("augment_plan_stage2")
def _j8_stage2(spark, d):
    return _augment(spark, d, epoch=280)

# --------------------------------------------------------------------- tta ---

from boxwise.operators import tta  # noqa: E402

_VROWS = ", ".join(f"({i * 2 + j}, {float(max(s))!r}, {float(min(s))!r}, {str(f).upper()})"
                   for i, s in enumerate(tta.TTA_SCALES) for j, f in enumerate(tta.TTA_FLIPS))
TTA_CTES = f"""
vv AS (SELECT * FROM (VALUES {_VROWS}) v(variant, le, se, flip)),
va AS (SELECT i.id AS image_id, CAST(v.variant AS INTEGER) AS variant, i.width AS ori_w, i.height AS ori_h, v.flip,
              least(v.le / greatest(i.width, i.height), v.se / least(i.width, i.height)) AS s_
       FROM images i CROSS JOIN vv v),
vb AS (SELECT *, CAST(floor(ori_w * s_ + 0.5) AS INTEGER) AS img_w, CAST(floor(ori_h * s_ + 0.5) AS INTEGER) AS img_h FROM va),
variants AS (SELECT image_id, variant, ori_w, ori_h, flip, img_w, img_h, img_w / ori_w AS scale_x, img_h / ori_h AS scale_y,
                    greatest(img_w, 960) AS pad_w, greatest(img_h, 960) AS pad_h,
                    CASE WHEN flip THEN 'horizontal' ELSE 'none' END AS flip_direction FROM vb),
dv AS (SELECT d.det_id * 8 + v.variant AS det_id, d.image_id, v.variant, d.category_id,
              CASE WHEN v.flip THEN v.img_w - d.x2 * v.scale_x ELSE d.x1 * v.scale_x END AS x1, d.y1 * v.scale_y AS y1,
              CASE WHEN v.flip THEN v.img_w - d.x1 * v.scale_x ELSE d.x2 * v.scale_x END AS x2, d.y2 * v.scale_y AS y2, d.score
       FROM detections d JOIN variants v ON d.image_id = v.image_id WHERE d.score > {MODEL_THR}),
ub AS (SELECT d.det_id, d.image_id, d.variant, d.category_id,
              (CASE WHEN v.flip THEN v.img_w - d.x2 ELSE d.x1 END) / v.scale_x AS x1, d.y1 / v.scale_y AS y1,
              (CASE WHEN v.flip THEN v.img_w - d.x1 ELSE d.x2 END) / v.scale_x AS x2, d.y2 / v.scale_y AS y2, d.score
       FROM dv d JOIN variants v ON d.image_id = v.image_id AND d.variant = v.variant),
ubm AS (SELECT {DET_COLS} FROM ub)"""


def _in_variants(spark, d):
    return tta.to_variant_frame(pp.confidence_filter(fx.detections(spark, d), MODEL_THR), fx.images(spark, d))


@register("tta_variants", W("SELECT * FROM variants", extra_ctes=TTA_CTES))
def _d10(spark, d):
    return tta.tta_variants(fx.images(spark, d))


@register("pack_meta", W("""
SELECT image_id AS img_id, ori_h AS ori_shape_h, ori_w AS ori_shape_w, img_h AS img_shape_h, img_w AS img_shape_w,
       scale_x AS scale_factor_x, scale_y AS scale_factor_y, flip, flip_direction FROM variants""", extra_ctes=TTA_CTES))
def _c16(spark, d):
    v = tta.tta_variants(fx.images(spark, d))
    m = v.select(F.col("image_id").alias("img_id"), F.col("ori_h").alias("ori_shape_h"), F.col("ori_w").alias("ori_shape_w"),
                 F.col("img_h").alias("img_shape_h"), F.col("img_w").alias("img_shape_w"),
                 F.col("scale_x").alias("scale_factor_x"), F.col("scale_y").alias("scale_factor_y"),
                 "flip", "flip_direction", "pad_w", "variant")
    return ds.pack_meta(m)


@register("union_variants", W("SELECT * FROM ub", extra_ctes=TTA_CTES))
def _g5(spark, d):
    return tta.undo_variant(_in_variants(spark, d))


@register("tta_merge", W(f"""
SELECT {DET_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY score DESC, det_id) AS rk
                        FROM t_kept) t WHERE rk <= 100""", recursive=True,
                         extra_ctes=TTA_CTES + ",\n" + pp.nms_oracle_ctes("ubm", 0.6, prefix="t").strip()))
def _i4(spark, d):
    return tta.tta_merge(_in_variants(spark, d))

# ------------------------------------------------------------------- files ---

from boxwise.sinks import coco_json as cj_out  # noqa: E402
from boxwise.sinks import tables as tb  # noqa: E402
from boxwise.sources import coco_json as cj  # noqa: E402
from boxwise.sources import files as fi  # noqa: E402


def _tree_rows(spark, d, root: str):
    """Rows (path, content) of an image-file tree: ``<split>2017/<name>`` for every
    image with the text of a document as content (every 89th empty), copies in a
    hidden ``.thumbs`` directory (every 101st) and hidden files (every 103rd)."""
    im, docs = fx.images(spark, d), fx.table(spark, d, "documents")
    n = docs.count()
    i = F.col("id")
    sd = F.concat(F.lit(root + "/"), F.col("split"), F.lit("2017/"))
    bodies = docs.select(F.col("doc_id").alias("_doc"), F.coalesce("text", F.lit("")).alias("body"))
    main = (im.withColumn("_doc", i % F.lit(max(n, 1))).join(bodies.hint("merge"), "_doc", "left")
            .select(F.concat(sd, F.col("file_name")).alias("path"),
                    F.when(i % 89 == 0, F.lit("")).otherwise(F.coalesce("body", F.lit(""))).alias("content")))
    thumbs = im.where(i % 101 == 0).select(F.concat(sd, F.lit(".thumbs/"), F.col("file_name")).alias("path"),
                                           F.concat(F.lit("thumb:"), i.cast("string")).alias("content"))
    hidden = im.where(i % 103 == 0).select(F.concat(sd, F.lit("."), F.col("file_name")).alias("path"),
                                           F.lit("hidden").alias("content"))
    return main.unionByName(thumbs).unionByName(hidden)


def _tree(spark, d) -> str:
    """The tree's root, written once per application and table directory."""
    key = (spark.sparkContext.applicationId, d.rstrip("/"), "tree")
    if key not in fx._MATERIALIZED:
        root = scratch_path(spark, "tree")
        fo.put_files(_tree_rows(spark, d, root))
        fx._MATERIALIZED[key] = root
    return fx._MATERIALIZED[key]


TREE_CTES = """
tmain AS (SELECT i.id, i.split || '2017/' || i.file_name AS rel_path,
                 CASE WHEN i.id % 89 = 0 THEN '' ELSE coalesce(b.text, '') END AS content, i.file_name, i.split
          FROM images i LEFT JOIN documents b ON b.doc_id = i.id % (SELECT count(*) FROM documents)),
tthumb AS (SELECT id, split || '2017/.thumbs/' || file_name AS rel_path, 'thumb:' || CAST(id AS VARCHAR) AS content,
                  file_name, split FROM images WHERE id % 101 = 0),
thid AS (SELECT id, split || '2017/.' || file_name AS rel_path, 'hidden' AS content, file_name, split
         FROM images WHERE id % 103 = 0),
tall AS (SELECT * FROM tmain UNION ALL SELECT * FROM tthumb UNION ALL SELECT * FROM thid)"""


def _rel(col: str, root: str):
    from boxwise.sources.fsutil import strip_file_scheme
    r = strip_file_scheme(root)
    return F.regexp_replace(F.substring(F.regexp_replace(F.col(col), "^file:(//)?", ""), len(r) + 1, 1 << 30), "^/+", "")


@register("put_files", W("SELECT rel_path, CAST(strlen(content) AS BIGINT) AS nbytes FROM tall", extra_ctes=TREE_CTES))
def _b7(spark, d):
    root = scratch_path(spark, "put")
    out = fo.put_files(_tree_rows(spark, d, root))
    return out.select(_rel("path", root).alias("rel_path"), "nbytes")


@register("list_files", W("""
SELECT rel_path, false AS is_dir FROM tmain UNION ALL SELECT rel_path, false FROM tthumb
UNION ALL SELECT DISTINCT split || '2017', true FROM tall
UNION ALL SELECT DISTINCT split || '2017/.thumbs', true FROM tthumb""", extra_ctes=TREE_CTES))
def _a4(spark, d):
    return fi.list_files(spark, _tree(spark, d), recursive=True).select("rel_path", "is_dir")


@register("list_prefix", W("""
SELECT substr(rel_path, 11) AS rel_path, CAST(strlen(content) AS BIGINT) AS length FROM tall WHERE split = 'train'""",
                          extra_ctes=TREE_CTES))
def _a5(spark, d):
    return fi.list_prefix(spark, _tree(spark, d), "train2017").select("rel_path", "length")


@register("scan_images", W("""
SELECT rel_path, CAST(strlen(content) AS BIGINT) AS length FROM tmain
UNION ALL SELECT rel_path, CAST(strlen(content) AS BIGINT) FROM tthumb""", extra_ctes=TREE_CTES))
def _a2(spark, d):
    return fi.scan_images(spark, _tree(spark, d)).select("rel_path", "length")


@register("read_text_files", W("""
SELECT rel_path, content AS text FROM tmain UNION ALL SELECT rel_path, content FROM tthumb""", extra_ctes=TREE_CTES))
def _a3(spark, d):
    return fi.read_text_files(spark, _tree(spark, d)).select("rel_path", "text")


@register("attach_image_bytes", W("""
SELECT i.id AS image_id, CAST(strlen(t.content) AS BIGINT) AS length, md5(t.content) AS md5
FROM images i JOIN tmain t ON t.id = i.id""", extra_ctes=TREE_CTES))
def _d7(spark, d):
    root = _tree(spark, d)
    im = ds.resolve_image_path(fx.images(spark, d), root, F.concat(F.col("split"), F.lit("2017")))
    j = fi.attach_image_bytes(im, fi.list_files(spark, root, list_dir=False, suffix=fi.IMAGE_SUFFIXES, recursive=True))
    return j.select(F.col("id").alias("image_id"), "length", F.md5("content").alias("md5"))


@register("empty_or_missing_files", W("""
SELECT file_name || CASE WHEN id % 97 = 0 THEN '.lost' ELSE '' END AS file_name,
       CASE WHEN id % 97 = 0 THEN 'missing' ELSE 'empty' END AS issue FROM tmain WHERE id % 97 = 0 OR content = ''""",
                                     extra_ctes=TREE_CTES))
def _d8(spark, d):
    root = _tree(spark, d)
    # every 97th record names a file that nobody wrote
    im = fx.images(spark, d).withColumn("file_name", F.when(
        F.col("id") % 97 == 0, F.concat("file_name", F.lit(".lost"))).otherwise(F.col("file_name")))
    im = ds.resolve_image_path(im, root, F.concat(F.col("split"), F.lit("2017")))
    return fi.empty_or_missing_files(im, fi.list_files(spark, root, list_dir=False, recursive=True))


@register("copy_tree", W("SELECT rel_path, CAST(strlen(content) AS BIGINT) AS nbytes, 'ok' AS status FROM tall",
                        extra_ctes=TREE_CTES))
def _b8(spark, d):
    root = _tree(spark, d)
    return fo.copy_tree(spark, root, scratch_path(spark, "copy"))


ANN_COLS = "id, image_id, category_id, x, y, w, h, iscrowd"


def _coco_document(spark, d) -> str:
    """All annotations as one document (several where they are many), written once per application
    and table directory."""
    key = (spark.sparkContext.applicationId, d.rstrip("/"), "coco-document")
    if key not in fx._MATERIALIZED:
        root = scratch_path(spark, "coco-document")
        cj_out.write_document(fx.images(spark, d), fx.annotations(spark, d), fx.categories(spark, d), root)
        fx._MATERIALIZED[key] = root
    return fx._MATERIALIZED[key]


# documents may be small here: ranges fitted to their length, not 32 MiB
COCO_RANGE = None


@register("read_coco_json", W(f"SELECT {ANN_COLS} FROM annotations"))
def _a1(spark, d):
    return cj.read_coco_json(spark, _coco_document(spark, d), range_bytes=COCO_RANGE)[1]


@register("read_coco_json_images", W("SELECT id, file_name, height, width FROM images"))
def _a1_images(spark, d):
    return cj.read_coco_json(spark, _coco_document(spark, d), range_bytes=COCO_RANGE)[0]


@register("read_coco_json_categories", W("""
SELECT id, name, CAST(row_number() OVER (ORDER BY id) - 1 AS INTEGER) AS pos FROM categories"""))
def _a1_categories(spark, d):
    return cj.read_coco_json(spark, _coco_document(spark, d), range_bytes=COCO_RANGE)[2]


@register("convert_dataset", W("""
SELECT i.id AS img_id, i.split, i.height AS htot, i.width AS wtot, CAST(count(*) AS BIGINT) AS n_boxes,
       sum(a.x + a.y + (a.x + a.w) + (a.y + a.h)) AS coord_sum,
       string_agg(CAST(l.label AS VARCHAR), ',' ORDER BY a.id) AS labels, md5(any_value(t.content)) AS md5
FROM images i JOIN annotations a ON a.image_id = i.id JOIN lab l ON a.category_id = l.category_id
JOIN tmain t ON t.id = i.id GROUP BY i.id, i.split, i.height, i.width""", extra_ctes=LAB_CTE + "," + TREE_CTES))
def _convert(spark, d):
    from boxwise.plans.convert import convert_dataset
    tree, out = _tree(spark, d), scratch_path(spark, "converted")
    im, ann = fx.images(spark, d), fx.annotations(spark, d)
    inputs = {}
    for split in ("train", "val"):
        part, docs = im.where(F.col("split") == split), scratch_path(spark, f"instances-{split}")
        own = ann.join(part.select(F.col("id").alias("image_id")).hint("merge"), "image_id", "left_semi")
        if split == "train":             # orphans come with the training documents
            own = own.unionByName(ann.join(im.select(F.col("id").alias("image_id")).hint("merge"), "image_id", "left_anti"))
        cj_out.write_coco_json(part, own, fx.categories(spark, d), docs, images_per_doc=1000)
        inputs[split] = (docs, f"{tree}/{split}2017")
    convert_dataset(spark, inputs, out, size_limit=1 << 20, shards_per_lane=SHARDS_PER_LANE)
    return spark.read.parquet(out).select(
        "img_id", "split", "htot", "wtot", F.size("bbox_labels").cast("bigint").alias("n_boxes"),
        F.aggregate("bbox_sizes", F.lit(0.0), lambda acc, b: acc + b[0] + b[1] + b[2] + b[3]).alias("coord_sum"),
        F.array_join(F.col("bbox_labels").cast("array<string>"), ",").alias("labels"), F.md5("image").alias("md5"))


@register("save_table", W(f"SELECT {ANN_COLS} FROM annotations"))
def _b1(spark, d):
    tb.ensure_schema(spark, "boxwise_db")
    name = "boxwise_db.bbox_annotations_" + scratch_path(spark, "t").rsplit("-", 1)[1]
    path = scratch_path(spark, "table")
    tb.save_table(fx.annotations(spark, d), name, path=path)
    rows = tb.table_scan(spark, name).select(*ANN_COLS.split(", ")).count()
    spark.sql("DROP DATABASE boxwise_db CASCADE")        # the table is external: its files stay
    back = spark.read.parquet(path).select(*ANN_COLS.split(", "))
    assert rows == back.count()
    return back

# --------------------------------------------------------- scoring and UDFs ---

import pandas as pd  # noqa: E402

from boxwise.operators import metrics as mt  # noqa: E402
from boxwise.operators import score as sc  # noqa: E402
from boxwise.streaming import metrics as smx  # noqa: E402
from boxwise.streaming import shards as ssh  # noqa: E402

@register("batch_score", W("""
SELECT det_id, image_id, category_id, round(x1, 6) AS x1, round(y1, 6) AS y1, round(x1 + w * sx, 6) AS x2,
       round(y1 + h * sy, 6) AS y2, round(1 / (1 + sqrt(gap) / 100), 6) AS score
FROM (SELECT *, x * sx AS x1, y * sy AS y1
      FROM (SELECT id * 10 + row_number() OVER (PARTITION BY id ORDER BY gap, category_id) - 1 AS det_id, id AS image_id, m.*,
                   iw / width AS sx, ih / height AS sy,
                   row_number() OVER (PARTITION BY id ORDER BY gap, category_id) AS r
            FROM (SELECT i.id, i.width AS iw, i.height AS ih, p.*,
                         (i.width - p.width) * (i.width - p.width) + (i.height - p.height) * (i.height - p.height) AS gap
                  FROM images i CROSS JOIN proto p) m) n WHERE r <= 2) o""", extra_ctes="""
proto AS (SELECT a.category_id, avg(i.width) AS width, avg(i.height) AS height, avg(a.x) AS x, avg(a.y) AS y, avg(a.w) AS w, avg(a.h) AS h
          FROM annotations a JOIN images i ON i.id = a.image_id
          WHERE a.category_id IN (SELECT id FROM categories) GROUP BY a.category_id)"""))
def _i1(spark, d):
    path = scratch_path(spark, "detector")
    images = fx.images(spark, d)
    sc.save_weights(sc.fit_prototypes(images, fx.annotations(spark, d), fx.categories(spark, d)), path)
    found = sc.batch_score(images, sc.PrototypeLoader(path), sc.predict_prototypes, sc.DETECTIONS, key=path)
    return found.select("det_id", "image_id", "category_id", *[F.round(c, 6).alias(c) for c in ("x1", "y1", "x2", "y2", "score")])


def xyxy_pandas(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"id": pdf["id"], "image_id": pdf["image_id"], "category_id": pdf["category_id"],
                         "x1": pdf["x"], "y1": pdf["y"], "x2": pdf["x"] + pdf["w"], "y2": pdf["y"] + pdf["h"],
                         "iscrowd": pdf["iscrowd"]})


@register("sample_transform", W("SELECT * FROM ann_xyxy"))
def _m1(spark, d):
    return sc.sample_transform(fx.annotations(spark, d), xyxy_pandas,
                               "id long, image_id long, category_id long, x1 double, y1 double, x2 double, "
                               "y2 double, iscrowd int")


@sc.requires("x1", "y1", "x2", "y2")
def with_area(df):
    return df.withColumn("area", (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1")))


@register("compose_transforms", W("""
SELECT id, image_id, category_id, iscrowd, x1, y1, x2, y2, (x2 - x1) * (y2 - y1) AS area FROM ann_xyxy WHERE iscrowd = 0"""))
def _m2(spark, d):
    chain = sc.compose(ds.xywh_to_xyxy, lambda x: x.where(F.col("iscrowd") == 0), with_area)
    return chain(fx.annotations(spark, d))


@register("smooth_metrics", """
WITH it AS (SELECT run, metric, value, row_number() OVER (PARTITION BY run, metric ORDER BY ts, event_id) AS iter
            FROM (SELECT event_type AS run, 'loss' AS metric, ts, event_id, value FROM events) e),
sm AS (SELECT run, metric, iter, avg(value) OVER (PARTITION BY run, metric ORDER BY iter
                                                 ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS v FROM it)
SELECT run, metric, iter, round(v, 6) AS value FROM sm WHERE iter % 50 = 0""")
def _f5(spark, d):
    return mt.smooth_metrics(fx.metric_log(spark, d), window=50, every=50)


# --------------------------------------------------------------- streaming ---

def _run_stream(q):
    try:
        q.processAllAvailable()
    finally:
        q.stop()


# rows of a shard and bytes of a row group: a micro-batch and the tasks that read it stay bounded
# however large the table is
STREAM_SHARD_ROWS = 2_000_000
STREAM_GROUP_BYTES = 8 << 20


def _annotation_shards(spark, d, shard_rows: int = STREAM_SHARD_ROWS) -> str:
    root = scratch_path(spark, "ann_shards")
    ann = fx.annotations(spark, d)
    ann.repartition(max(8, -(-ann.count() // shard_rows)), "image_id") \
        .write.option("parquet.block.size", STREAM_GROUP_BYTES).parquet(root)
    return root


@register("stream_shards", W(f"SELECT {ANN_COLS} FROM annotations"))
def _a8(spark, d):
    root = _annotation_shards(spark, d)
    schema = spark.read.parquet(root).schema
    out, ck = scratch_path(spark, "stream_out"), scratch_path(spark, "stream_ck")
    q = ssh.stream_shards(spark, root, schema, max_files=1).writeStream.format("parquet") \
        .option("path", out).option("checkpointLocation", ck).start()
    _run_stream(q)
    return spark.read.parquet(out).select(*ANN_COLS.split(", "))


def _late_shards(spark, d) -> str:
    """The annotation shards and one more that repeats every 997th annotation."""
    root = _annotation_shards(spark, d)
    fx.annotations(spark, d).where("id % 997 = 0").repartition(1).write.mode("append").parquet(root)
    return root


@register("stream_validate", W("""
SELECT CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(*) FILTER (WHERE image_id NOT IN (SELECT id FROM images)) AS BIGINT) AS n_orphans,
       CAST(count(*) FILTER (WHERE category_id NOT IN (SELECT id FROM categories)) AS BIGINT) AS n_unknown,
       CAST(count(*) FILTER (WHERE again) AS BIGINT) AS n_duplicates,
       CAST(count(DISTINCT image_id) FILTER (WHERE again) AS BIGINT) AS n_split
FROM (SELECT *, false AS again FROM annotations UNION ALL SELECT *, true FROM annotations WHERE id % 997 = 0) a"""))
def _l1(spark, d):
    root = _late_shards(spark, d)
    schema = spark.read.parquet(root).schema
    out, ck, found, ck2 = (scratch_path(spark, n) for n in ("validate_out", "validate_ck", "identity_out", "identity_ck"))
    _run_stream(ssh.stream_validate(ssh.stream_shards(spark, root, schema, max_files=3),
                                    fx.images(spark, d), fx.categories(spark, d), out, ck))
    _run_stream(ssh.stream_identity(ssh.stream_shards(spark, root, schema, max_files=3), found, ck2))
    counts = spark.read.parquet(out).agg(*[F.sum(c).cast("bigint").alias(c) for c in ("n_rows", "n_orphans", "n_unknown")])
    bad = ssh.findings(spark, found).agg(*[F.count_if(F.col("kind") == k).alias(n) for k, n in (
        ("record", "n_duplicates"), ("sample", "n_split"))])
    return counts.withColumns({n: bad.select(n).scalar() for n in ("n_duplicates", "n_split")})


@register("stream_smooth_metrics", """
WITH it AS (SELECT run, metric, value, row_number() OVER (PARTITION BY run, metric ORDER BY ts, event_id) AS iter
            FROM (SELECT event_type AS run, 'loss' AS metric, ts, event_id, value FROM events) e),
sm AS (SELECT run, metric, iter, avg(value) OVER (PARTITION BY run, metric ORDER BY iter
                                                 ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS v FROM it)
SELECT run, metric, iter, round(v, 6) AS value FROM sm WHERE iter % 20 = 0""")
def _l2_smooth(spark, d):
    root = scratch_path(spark, "metric_log")
    # files in an order that has nothing to do with the iterations
    mt.iterations(fx.metric_log(spark, d)).repartition(6, F.xxhash64("event_id")).write.parquet(root)
    schema = spark.read.parquet(root).schema
    out, ck = scratch_path(spark, "smooth_out"), scratch_path(spark, "smooth_ck")
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(root)
    _run_stream(smx.start_metrics(smx.stream_smooth(src, window=50, every=20), out, ck))
    return smx.smoothed(spark, out)


@register("stream_metrics", """
WITH it AS (SELECT run, metric, value, row_number() OVER (PARTITION BY run, metric ORDER BY ts, event_id) AS iter
            FROM (SELECT event_type AS run, 'loss' AS metric, ts, event_id, value FROM events) e)
SELECT run, metric, CAST(floor((iter - 1) / 50) AS BIGINT) AS block, count(*) AS n, round(avg(value), 6) AS mean
FROM it GROUP BY ALL""")
def _l2(spark, d):
    root = scratch_path(spark, "metric_log")
    mt.iterations(fx.metric_log(spark, d)).repartition(6).write.parquet(root)
    schema = spark.read.parquet(root).schema
    out, ck = scratch_path(spark, "metrics_out"), scratch_path(spark, "metrics_ck")
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(root)
    _run_stream(smx.start_metrics(smx.stream_metrics(src, every=50), out, ck))
    r = smx.latest(spark, out)
    return r.select("run", "metric", "block", "n", F.round("mean", 6).alias("mean"))


# --------------------------------------------------- augment_plan oracle (J8) ---

def _rr_sql(src, name, keep, scale, ratio=(0.1, 2.0), epoch=0):
    u = uniform_sql('image_id', 'random_resize', epoch=epoch)
    r = f"({ratio[0]!r} + {u} * {ratio[1] - ratio[0]!r})"
    return f"{name}_0 AS (SELECT *, floor({float(scale)!r} * {r}) AS tl_ FROM {src})," + \
        _resize_sql(f"{name}_0", name, "tl_", "tl_", keep)


def _rc_sql(src, name, keep, epoch=0):
    ox, oy = (f"floor({uniform_sql('image_id', 'random_crop', salt=a, epoch=epoch)} * (greatest({e} - 640, 0) + 1))"
              for a, e in (("x", "w"), ("y", "h")))
    return f"""
{name}_0 AS (SELECT *, {ox} AS ox_, {oy} AS oy_, least(w, 640) AS nw_, least(h, 640) AS nh_ FROM {src}),
{name} AS (SELECT * FROM (SELECT {keep}, nw_ AS w, nh_ AS h,
              {_clip('x1 - ox_', 'nw_')} AS x1, {_clip('y1 - oy_', 'nh_')} AS y1,
              {_clip('x2 - ox_', 'nw_')} AS x2, {_clip('y2 - oy_', 'nh_')} AS y2 FROM {name}_0) t
           WHERE x2 > x1 AND y2 > y1)"""


_KEEP = "image_id, tile, src_id, box_id, category_id"


def _augment_sql(mosaic, mixup, ratio, mixup_prob):
    return mosaic_ctes(mosaic) + "," + _rr_sql("mos", "ar", _KEEP, 1280, ratio) + "," + _rc_sql("ar", "ac", _KEEP) + f""",
af AS (SELECT {_KEEP}, w, h, CASE WHEN {_FLIP} THEN w - x2 ELSE x1 END AS x1, y1,
              CASE WHEN {_FLIP} THEN w - x1 ELSE x2 END AS x2, y2 FROM ac),
ap AS (SELECT {_KEEP}, greatest(w, 640) AS w, greatest(h, 640) AS h, x1, y1, x2, y2 FROM af),
ypart AS ({partner_sql(**mixup)}),
yp AS (SELECT p.image_id, p.partner_id AS src, t.tw, t.th
       FROM ypart p JOIN (SELECT DISTINCT image_id, w AS tw, h AS th FROM ap) t ON t.image_id = p.image_id
       WHERE p.slot = 1 AND {_u('mixup', 'p', 'p.image_id')} < {mixup_prob!r}),
yj AS (SELECT p.image_id, p.tw, p.th, f.tile, f.src_id, f.box_id, f.category_id, f.x1, f.y1, f.x2, f.y2,
              least(640.0 / f.h, 640.0 / f.w) * (1.0 + {_u('mixup', 'jit', 'p.image_id')} * 0.0) AS r,
              {_u('mixup', 'flip', 'p.image_id')} > 0.5 AS flip,
              floor({_u('mixup', 'x', 'p.image_id')} * greatest(640 - p.tw, 0)) AS ox,
              floor({_u('mixup', 'y', 'p.image_id')} * greatest(640 - p.th, 0)) AS oy
       FROM yp p JOIN ap f ON f.image_id = p.src),
ym AS (SELECT {_KEEP}, tw AS w, th AS h,
              (CASE WHEN flip THEN 640.0 - x2 * r ELSE x1 * r END) - ox AS x1, y1 * r - oy AS y1,
              (CASE WHEN flip THEN 640.0 - x1 * r ELSE x2 * r END) - ox AS x2, y2 * r - oy AS y2 FROM yj),
yc AS (SELECT {_KEEP}, w, h, {_clip('x1', 'w')} AS x1, {_clip('y1', 'h')} AS y1,
              {_clip('x2', 'w')} AS x2, {_clip('y2', 'h')} AS y2 FROM ym)"""


for _name, *_settings in (("augment_plan", LARGE_MOSAIC, LARGE_MIXUP, (0.1, 2.0), 1.0),
                          ("augment_plan_tiny", TINY_MOSAIC, TINY_MIXUP, (0.5, 2.0), 0.5)):
    ORACLE[_name] = W(f"""
SELECT {_KEEP}, w, h, x1, y1, x2, y2 FROM ap
UNION ALL SELECT {_KEEP}, w, h, x1, y1, x2, y2 FROM yc WHERE x2 > x1 AND y2 > y1""",
                      extra_ctes=_augment_sql(*_settings))

_K2 = "image_id, box_id, category_id"
_FLIP2 = f"{uniform_sql('image_id', 'random_flip', epoch=280)} < 0.5"
ORACLE["augment_plan_stage2"] = W(f"""
SELECT {_K2}, greatest(w, 640) AS w, greatest(h, 640) AS h, CASE WHEN {_FLIP2} THEN w - x2 ELSE x1 END AS x1, y1,
       CASE WHEN {_FLIP2} THEN w - x1 ELSE x2 END AS x2, y2 FROM bc""",
                                  extra_ctes=FRAME_CTE + "," + _rr_sql("fr", "br", _K2, 640, epoch=280) + ","
                                  + _rc_sql("br", "bc", _K2, epoch=280))
