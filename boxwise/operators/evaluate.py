"""COCO-style box evaluation (contract K3; Lin et al. 2014), as Spark jobs.

Steps
1. ``eval_sets``: ground truth and detections restricted to known images and
   categories; detections cut to the best ``max_det`` per (image, category).
2. ``iou_join``: join on ``(image_id, category_id)`` with the IoU as an
   expression (crowd truths use the detection area as the union).  Both sets lie by
   image since ``eval_sets``, so the join moves neither again.  A pair
   group is bounded by ``max_det`` times that image's truths of the class;
   keys with very many truths pair through a scale-bucketed spatial grid.  For the
   curve it is an outer join: detections without a pair stay in, so one walk gives every
   detection its masks and nothing is joined back.
3. ``match``: per (image, category) the detections, by ``score DESC,
   det_id``, take for every threshold t and area range the best-IoU unmatched truth
   with ``IoU >= t`` that counts (ties: the later truth); failing that, a truth that
   is ignored (a crowd, or one whose area is outside the range) makes the detection
   *ignored*; otherwise it is a false positive, or ignored where its own area is
   outside the range.  Pairs are sorted by key inside each partition, where the join left
   them, and walked as a stream, one group at a time; a detection's results are two bit
   masks over the thresholds per area range.
4. ``pr_curve``: precision sampled at 101 recall points, monotone from the
   right.  Detections are range-partitioned by category and score
   (``plans.ranking.segmented``: a category holding most detections is still spread
   over all tasks), with their masks packed in a few longs; every segment carries the running counts of all thresholds and
   ranges on from the segments before it.  Precision at the m-th true positive
   is ``m / k``; the envelope only needs the maximum per *recall band*
   ``b = floor(100 m / npig)``, an aggregation with map-side combine, followed by a
   suffix maximum over at most 101 bands.  Recall point ``i`` is reached when
   ``100 * tp >= i * npig`` (exact integer test, where the reference library
   compares against float ``linspace``).
5. ``coco_ap`` / ``coco_ar`` aggregate the curve and the per-threshold recall, also
   by area range.  Categories without a counting truth are left out of the means.
   A truth's area is its ``area`` column (segmentation area), where it has none
   that of its box.
"""

from __future__ import annotations

from bisect import bisect_left
from functools import partial
from typing import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxwise.functions.geometry import area, intersection
from boxwise.operators.postprocess import topk_per_image
from boxwise.plans.ranking import segmented
from boxwise.plans.scan import replayed, totals_before
from boxwise.plans.spatial import cell_size, grid_pairs
from boxwise.session import materialize, partitions_for, ship_package

# fixed values: IoU thresholds .50:.05:.95 and detections-per-image limits
IOU_THRS = (0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95)
MAX_DETS = (1, 10, 100)
N_RECALL = 101
# fixed values: area ranges (both bounds included)
AREA_RANGES = (("all", 0.0, 1e10), ("small", 0.0, 1024.0), ("medium", 1024.0, 9216.0), ("large", 9216.0, 1e10))


def eval_sets(det: DataFrame, gt_xyxy: DataFrame, images: DataFrame, categories: DataFrame, *,
              max_det: int = 100) -> tuple[DataFrame, DataFrame]:
    """Ground truth and detections on known images and categories; detections
    keep their rank ``rk`` inside (image, category), cut at ``max_det``.

    Both are dealt by image once, into partitions of bounded size: the image filter, the
    rank and :func:`iou_join` all take them as they lie, and no sort outgrows its task."""
    ca = categories.select(F.col("id").alias("category_id"))
    n = partitions_for(det.sparkSession, max(det.count(), gt_xyxy.count()))

    # the merge join deals the boxes as the images are dealt
    im = images.select(F.col("id").alias("image_id")).repartition(n, "image_id").hint("merge")

    def known(rows):
        return rows.join(ca, "category_id", "left_semi").join(im, "image_id", "left_semi")

    gt, d = known(gt_xyxy), known(det)
    w = Window.partitionBy("image_id", "category_id").orderBy(F.col("score").desc(), F.col("det_id"))
    d = d.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= max_det)
    return d, gt


# truths per (image, class) above which the IoU join pairs boxes through a
# spatial grid instead of pairing every detection of the key with every truth
HOT_TRUTHS = 100_000


def _truth_area(gt: DataFrame):
    return F.col("area") if "area" in gt.columns else area("")


def _iou_of_pair():
    """(intersection, IoU) of a detection and a truth (``g`` columns)."""
    inter = intersection("", "g")
    da, ga = area(""), area("g")
    uni = F.when(F.col("iscrowd") == 1, da).otherwise(da + ga - inter)
    return inter, F.when(uni > 0, inter / uni).otherwise(F.lit(0.0))


PAIR_COLS = ("det_id", "ann_id", "image_id", "category_id", "iscrowd", "score", "gt_area")


def _pair_iou(j: DataFrame, keep=()) -> DataFrame:
    inter, iou = _iou_of_pair()
    return j.withColumn("inter", inter).where(F.col("inter") > 0).select(*PAIR_COLS, iou.alias("iou"), *keep)


def iou_join(det: DataFrame, gt_xyxy: DataFrame, *, min_iou: float | None = None,
             hot_truths: int | None = HOT_TRUTHS, keep: Sequence[str] | None = None) -> DataFrame:
    """Detection x truth pairs of the same image and category with ``inter > 0``
    (and ``iou >= min_iou`` when given).

    With ``min_iou``, an (image, class) with more than ``hot_truths`` truths
    pairs its non-crowd truths through the scale-bucketed grid
    (:mod:`boxwise.plans.spatial`) instead of with every detection of the key.
    Crowd truths keep the plain join, since their IoU uses the detection area.

    With ``keep`` (columns of ``det`` to carry along) a detection that has no pair is a row too,
    with ``iou`` -1 and zeros for the truth.
    """
    key = ["image_id", "category_id"]
    more, outer = list(keep or ()), keep is not None
    g = gt_xyxy.select(F.col("id").alias("ann_id"), "image_id", "category_id",
                       *[F.col(c).alias(f"g{c}") for c in ("x1", "y1", "x2", "y2")], "iscrowd",
                       _truth_area(gt_xyxy).alias("gt_area"))
    dsel = det.select("det_id", "image_id", "category_id", "x1", "y1", "x2", "y2", "score", *more)

    def plain(dd, gg, outer=False):
        # both sides grow with the data: always a merge join (a compressed-file
        # size estimate is no bound on the in-memory size of either side).  The key is the image,
        # by which they lie already, and the category a condition: as a second key it would
        # shuffle and sort both once more.  An image's truths are met by the best detections
        # of each of its categories, so by at most that many times more.
        gg = gg.withColumnsRenamed({"image_id": "gimage", "category_id": "gcategory"}).hint("merge")
        on = (F.col("image_id") == F.col("gimage")) & F.col("category_id").between(F.col("gcategory"), F.col("gcategory"))
        if not outer:
            return _pair_iou(dd.join(gg, on), more)
        inter, iou = _iou_of_pair()
        on = on & (inter > 0) if min_iou is None else on & (inter > 0) & (iou >= min_iou)
        j = dd.join(gg.withColumn("_met", F.lit(True)), on, "left")
        return j.select(*[c if c not in NO_TRUTH else F.when(F.col("_met"), F.col(c)).otherwise(F.lit(NO_TRUTH[c])).alias(c)
                          for c in PAIR_COLS], F.when(F.col("_met"), iou).otherwise(F.lit(-1.0)).alias("iou"), *more)

    if min_iou is None or hot_truths is None:
        return plain(dsel, g, outer)
    hot = g.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_truths).select(*key)
    hot = materialize(hot, "iou-hot")
    if hot.isEmpty():
        return plain(dsel, g, True) if outer else plain(dsel, g).where(F.col("iou") >= min_iou)
    if outer:                                        # read by several joins, which must see the same ranks
        dsel = materialize(dsel, "iou-dets")
    cold = plain(dsel.join(hot, key, "left_anti"), g.join(hot, key, "left_anti"))
    hd, hg = dsel.join(hot, key, "left_semi"), g.join(hot, key, "left_semi")
    crowd = plain(hd, hg.where(F.col("iscrowd") == 1))
    nc = hg.where(F.col("iscrowd") == 0)
    cell = cell_size(nc, "g")
    cand = grid_pairs(hd.select(*key, "det_id", "x1", "y1", "x2", "y2"),
                      nc.select(*key, "ann_id", *[F.col(f"g{c}").alias(c) for c in ("x1", "y1", "x2", "y2")]),
                      keys=key, left_id="det_id", right_id="ann_id", thr=min_iou, cell=cell)
    spatial = _pair_iou(cand.join(hd.hint("merge"), key + ["det_id"]).join(nc.hint("merge"), key + ["ann_id"]), more)
    pairs = cold.unionByName(crowd).unionByName(spatial).where(F.col("iou") >= min_iou)
    if not outer:
        return pairs
    # one more row a detection: an IoU of -1 comes last and is no candidate
    return pairs.unionByName(dsel.withColumns({c: F.lit(v) for c, v in NO_TRUTH.items()} | {"iou": F.lit(-1.0)})
                             .select(*pairs.columns))


NO_TRUTH = {"ann_id": 0, "iscrowd": 0, "gt_area": 0.0}


KEY = ["image_id", "category_id"]


def _groups(batches):
    """Tables of complete (image, category) groups out of sorted batches, with where each group starts."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in KEY]
        new = np.zeros(batch.num_rows, bool)
        new[0] = bool(held) and last != tuple(k[0] for k in keys)
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
        last, at = tuple(k[-1] for k in keys), np.flatnonzero(new)
        if len(at):
            held.append(batch.slice(0, at[-1]))
            yield _started(held)
            held = []
        held.append(batch.slice(at[-1] if len(at) else 0))
    if held:
        yield _started(held)


def _started(held: list) -> tuple[pa.Table, np.ndarray]:
    t = pa.Table.from_batches(held).combine_chunks()
    new = np.zeros(t.num_rows, bool)
    new[:1] = True
    for c in KEY:
        k = t[c].to_numpy()
        new[1:] |= k[1:] != k[:-1]
    return t, new


def _match_group(dets: list, thrs, lo: float, hi: float) -> list:
    """(bits of the thresholds, detection index, row of the truth, ignored) of one group and range.
    ``dets``: per detection its candidates (iou, truth, crowd, area, row), best first.  Thresholds
    that the same candidates reach give the same matching, so they are walked together."""
    ious, alike, out = sorted([c[0] for cands in dets for c in cands]), {}, []
    for i, t in enumerate(thrs):
        below = bisect_left(ious, t)
        if below < len(ious):
            alike.setdefault(below, [t, 0])[1] |= 1 << i
    for t, bits in alike.values():
        taken = set()
        for k, cands in enumerate(dets):
            best = spare = None
            for iou, ann, crowd, size, row in cands:
                if iou < t:
                    break
                if not crowd and lo <= size <= hi:
                    if ann not in taken:
                        best = ann, row
                        break
                elif spare is None and (crowd or ann not in taken):
                    spare = ann, row
            found = best or spare
            if found is not None:
                taken.add(found[0])
                out.append((bits, k, found[1], int(best is None)))
    return out


def _matched(t: pa.Table, new: np.ndarray, thrs, ranges):
    """``starts, results``: the first row of each detection (rows of a group that follow one another with
    one id; without an id each row is one) and by range (bits of the thresholds, detection, row of the truth, ignored)."""
    ids = t["det_id"]
    first = new.copy()
    k = ids.fill_null(0).to_numpy()
    first[1:] |= k[1:] != k[:-1]
    if ids.null_count:
        first |= ~ids.is_valid().to_numpy()
    starts = np.flatnonzero(first)
    iou = t["iou"].to_numpy()
    cand = np.flatnonzero(iou >= min(thrs))          # best first: what a detection has stands at its start
    ann = t["ann_id"].take(pa.array(cand)).to_pylist()
    if None in ann:                                  # truths without an id are not told apart by it
        ann = [object() if a is None else a for a in ann]
    size = t["gt_area"].to_numpy()[cand]
    inside = np.stack([(size >= lo) & (size <= hi) for _, lo, hi in ranges], 1) if len(cand) else None
    group, det = (np.cumsum(new) - 1)[cand], (np.cumsum(first) - 1)[cand]
    rows = list(zip(iou[cand].tolist(), ann, t["iscrowd"].to_numpy()[cand].tolist(), size.tolist(), cand.tolist()))
    det = det.tolist()
    results = [[] for _ in ranges]
    edges = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(cand)] if len(cand) else []
    for a, b in zip(edges, edges[1:]):
        own, dets = [], []
        for d, c in zip(det[a:b], rows[a:b]):
            if not own or own[-1] != d:
                own.append(d)
                dets.append([])
            dets[-1].append(c)
        known = {}
        for r, (_, lo, hi) in enumerate(ranges):
            of = inside[a:b, r].tobytes()
            if of not in known:
                known[of] = [(bits, own[j], row, ignored) for bits, j, row, ignored in _match_group(dets, thrs, lo, hi)]
            results[r] += known[of]
    return starts, results


MATCH_SCHEMA = T.StructType([T.StructField("det_id", T.LongType()), T.StructField("iou_thr", T.DoubleType()),
                             T.StructField("ann_id", T.LongType()), T.StructField("crowd", T.IntegerType())])


def _match_rows(thrs, batches):
    for t, new in _groups(batches):
        starts, (found,) = _matched(t, new, thrs, AREA_RANGES[:1])
        bits, k, row, ignored = np.array(found, np.int64).reshape(-1, 4).T
        at, i = np.nonzero((bits[:, None] >> np.arange(len(thrs))) & 1)
        yield from pa.table([t["det_id"].take(pa.array(starts[k[at]])), pa.array(np.array(thrs, float)[i]), t["ann_id"].take(pa.array(row[at])),
                             pa.array(ignored[at].astype(np.int32))], names=[f.name for f in MATCH_SCHEMA.fields]).to_batches(50_000)


def _mask_names(ranges) -> list[str]:
    return [f"{kind}_{name}" for name, _, _ in ranges for kind in ("tp", "ig")]


def _mask_rows(thrs, ranges, keep, batches):
    for t, new in _groups(batches):
        starts, results = _matched(t, new, thrs, ranges)
        bits = np.zeros((2 * len(ranges), len(starts) + 1), np.int32)   # the last one: nothing matched
        for r, found in enumerate(results):
            of, k, _, ignored = np.array(found, np.int64).reshape(-1, 4).T
            np.add.at(bits, (2 * r + ignored, k), of.astype(np.int32))   # a threshold comes once a detection
        if keep:
            rows, of = _own_rows(t, new, starts, bits)
        else:
            of = np.flatnonzero(bits.any(0))
            rows = starts[of]
        own = t.select([*KEY, "det_id", *keep]).take(pa.array(rows))
        yield from pa.table([*own.columns, *[pa.array(b[of]) for b in bits]], names=[*own.column_names, *_mask_names(ranges)]).to_batches(50_000)


def _own_rows(t: pa.Table, new: np.ndarray, starts: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, place in ``bits``) for every detection of the table, told apart by ``rk``: each has the masks of
    its id in its group, as a join on it gives them, where an id repeats or is missing too."""
    rk, ids = t["rk"].to_numpy(), t["det_id"]
    first = np.zeros(t.num_rows, bool)
    first[starts] = True
    group = np.cumsum(new) - 1
    lone = not ids.null_count and not (~first[1:] & (rk[1:] != rk[:-1])).any()
    if lone and not pd.DataFrame({"g": group[starts], "d": ids.to_numpy()[starts]}).duplicated().any():
        return starts, np.arange(len(starts))
    ids, hit, masks, seen, rows, of = ids.to_pylist(), bits.any(0), {}, set(), [], []
    for k, at in enumerate(starts.tolist()):
        if hit[k] and ids[at] is not None:
            masks.setdefault((group[at], ids[at]), []).append(k)
    for at, key in enumerate(zip(group.tolist(), rk.tolist())):
        if key not in seen:
            seen.add(key)
            for k in masks.get((key[0], ids[at]), [len(starts)]):
                rows.append(at)
                of.append(k)
    return np.array(rows, np.int64), np.array(of, np.int64)


def _walked(pairs: DataFrame, run, schema, keep=()) -> DataFrame:
    ship_package(pairs.sparkSession)
    p = pairs.withColumn("ns", -F.col("score")).select(*KEY, "ns", "det_id", "iou", "ann_id", "iscrowd", "gt_area", *keep)
    # the window asks that a task has a group's rows: pairs that lie by image stay, others are dealt by key
    order = ["ns", "det_id", F.desc("iou"), F.desc("ann_id")]
    p = p.withColumn("_n", F.row_number().over(Window.partitionBy(*KEY).orderBy(*order))).sortWithinPartitions(*KEY, *order)
    return p.mapInArrow(run, schema)


def match(pairs: DataFrame, thrs=IOU_THRS) -> DataFrame:
    """Greedy matching; returns ``det_id, iou_thr, ann_id, crowd`` for every
    detection that matched something (``crowd = 1``: ignored detection)."""
    return _walked(pairs, partial(_match_rows, tuple(thrs)), MATCH_SCHEMA)


def match_masks(pairs: DataFrame, thrs=IOU_THRS, ranges=AREA_RANGES, *, keep: Sequence[str] = ()) -> DataFrame:
    """The same matching for every area range, one row per matched detection:
    ``tp_<range>`` and ``ig_<range>`` have bit ``i`` set where the detection is a
    true positive, or ignored, at the i-th threshold.  With ``keep`` (columns of the pairs, ``rk``
    among them) every detection of the pairs has a row, with these columns, matched or not."""
    kept = [T.StructField(c, pairs.schema[c].dataType) for c in keep]
    schema = T.StructType([*[T.StructField(c, T.LongType()) for c in (*KEY, "det_id")], *kept,
                           *[T.StructField(c, T.IntegerType()) for c in _mask_names(ranges)]])
    return _walked(pairs, partial(_mask_rows, tuple(thrs), tuple(ranges), tuple(keep)), schema, keep)


def npig(gt: DataFrame, ranges=AREA_RANGES) -> DataFrame:
    """Counting truths per area range and category (only those that have some)."""
    size = _truth_area(gt)
    g = gt.where(F.col("iscrowd") == 0).select("category_id", F.explode(F.array(*[
        F.when(size.between(lo, hi), F.lit(name)) for name, lo, hi in ranges])).alias("area")).where("area IS NOT NULL")
    return g.groupBy("area", "category_id").agg(F.count(F.lit(1)).alias("npig"))


def _packed(n_thrs: int, ranges) -> list:
    """``c0, c1, ...``: whether the area is in each range and the range's two masks, packed in as few longs as hold
    them.  A detection whose area is not known lies in every range."""
    width = 2 * n_thrs + 1
    each, out = 63 // width, []
    for at in range(0, len(ranges), each):
        code = F.lit(0).cast("bigint")
        for k, (name, lo, hi) in enumerate(ranges[at:at + each]):
            inside = F.coalesce(F.col("size").between(lo, hi), F.lit(True)).cast("bigint")
            tp, ig = (F.col(f"{kind}_{name}").cast("bigint") for kind in ("tp", "ig"))
            code = code.bitwiseOR(F.shiftleft(inside.bitwiseOR(F.shiftleft(tp, 1)).bitwiseOR(F.shiftleft(ig, 1 + n_thrs)), k * width))
        out.append(code.alias(f"c{len(out)}"))
    return out


def _states(n_thrs: int, ranges, rows: pa.RecordBatch):
    """By range: whether the area lies in it, and the masks; packed (:func:`_packed`) or as columns."""
    if "c0" not in rows.schema.names:
        size = rows.column("size").to_numpy()
        for name, lo, hi in ranges:
            yield ((size >= lo) & (size <= hi)).astype(np.int64), *(
                rows.column(f"{kind}_{name}").to_numpy().astype(np.int64) for kind in ("tp", "ig"))
        return
    width, ones = 2 * n_thrs + 1, (1 << n_thrs) - 1
    each = 63 // width
    for r in range(len(ranges)):
        code = rows.column(f"c{r // each}").to_numpy() >> (r % each * width)
        yield code & 1, (code >> 1) & ones, (code >> (1 + n_thrs)) & ones


def _counters(n_thrs: int, ranges, rows: pa.RecordBatch) -> np.ndarray:
    """Per detection and range: counts by its area, then by threshold true positive
    and correction of the count of detections.  A counter's values lie side by side."""
    bits, out = np.arange(n_thrs)[:, None], []
    for inside, tp, ig in _states(n_thrs, ranges, rows):
        tp, ig = (tp >> bits) & 1, (ig >> bits) & 1
        out += [inside[None], tp, tp * (1 - inside) - ig * inside]
    return np.concatenate(out).T


class _Bands:
    """Best precision by recall band of one segment: its counters run on from the
    totals before it, batch by batch."""

    def __init__(self, thrs, ranges, head):
        self.thrs, self.ranges, self.category, self.npig = thrs, ranges, head["category_id"], head["npig"]
        self.run = np.array(head["before"], np.int64)
        self.best = np.zeros((len(ranges), len(thrs), N_RECALL))

    def step(self, rows: pa.RecordBatch) -> None:
        n_thrs = len(self.thrs)
        own = _counters(n_thrs, self.ranges, rows).T
        run = np.cumsum(own, 1) + self.run[:, None]
        self.run = run[:, -1].copy()
        for r, n in enumerate(self.npig):
            at = r * (1 + 2 * n_thrs)
            for i in range(n_thrs if n else 0):
                hit = np.flatnonzero(own[at + 1 + i])
                if not len(hit):
                    continue
                m = run[at + 1 + i, hit]
                band = np.minimum(N_RECALL - 1, m * (N_RECALL - 1) // n)
                first = np.flatnonzero(np.diff(band, prepend=-1))     # bands rise with m
                top = np.maximum.reduceat(m / (run[at, hit] + run[at + 1 + n_thrs + i, hit]), first)
                self.best[r, i, band[first]] = np.maximum(self.best[r, i, band[first]], top)

    def rows(self) -> pa.RecordBatch:
        r, i, b = np.nonzero(self.best)
        return pa.RecordBatch.from_arrays(
            [pa.array([self.ranges[k][0] for k in r], pa.string()), pa.array([self.category] * len(r), pa.int64()),
             pa.array([float(self.thrs[k]) for k in i], pa.float64()), pa.array(b, pa.int32()), pa.array(self.best[r, i, b])],
            names=["area", "category_id", "iou_thr", "b", "mp"])


def pr_curve(det_top: DataFrame, masks: DataFrame | None, n_pos: DataFrame, thrs=IOU_THRS, ranges=AREA_RANGES) -> DataFrame:
    """``area, category_id, iou_thr, recall_idx (0..100), precision`` (101-point curve).

    ``det_top`` are boxes, joined to their ``masks``, or detections that carry their ``size`` and masks
    (:func:`evaluate_inputs`), which nothing need be joined to.

    At a true positive, ``m`` is the running count of true positives and ``k`` that
    of all detections that count: those whose area is in the range, less ignored
    ones among them, plus true positives outside it.  Detections are range-partitioned
    by category and score (``segmented``) and scanned with all counters as state
    (``plans.scan``): a hot category is spread over tasks, and a task holds the counters
    of one batch.
    """
    ship_package(det_top.sparkSession)
    order = [F.col("score").desc(), F.col("image_id"), F.col("det_id")]
    n, names, d = partitions_for(det_top.sparkSession, det_top.count()), _mask_names(ranges), det_top
    if names[0] not in d.columns:
        d = d.select(*KEY, "det_id", "score", area("").alias("size")).join(masks.hint("merge"), [*KEY, "det_id"], "left")
        d = d.select(*KEY, "det_id", "score", "size", *[F.coalesce(c, F.lit(0)).alias(c) for c in names])
    # the order's columns and a few longs are all that is sorted, the longs all that is stored
    d = d.select(*KEY, "det_id", "score", *_packed(len(thrs), ranges))
    codes = [c for c in d.columns if c not in (*KEY, "det_id", "score")]
    seg = segmented(d, order, group=["category_id"], partitions=n, keep=["category_id", *codes], codec="zstd")
    before = totals_before(seg, "category_id", partial(_counters, len(thrs), tuple(ranges)), codes)
    wide = n_pos.groupBy("category_id").agg(F.array(*[
        F.coalesce(F.max(F.when(F.col("area") == name, F.col("npig"))), F.lit(0)) for name, _, _ in ranges]).alias("npig"))
    parts = replayed(seg, before.join(wide, "category_id"), "category_id", codes,
                     partial(_Bands, tuple(thrs), tuple(ranges)), _Bands.step, _Bands.rows,
                     "area string, category_id bigint, iou_thr double, b int, mp double", partitions=n)
    key = ["area", "category_id", "iou_thr"]
    bands = parts.groupBy(*key, "b").agg(F.max("mp").alias("mp"))
    w_suffix = Window.partitionBy(*key).orderBy(F.col("b").desc()).rowsBetween(Window.unboundedPreceding, 0)
    w_prev = Window.partitionBy(*key).orderBy("b")
    bands = (bands.withColumn("s", F.max("mp").over(w_suffix))
                  .withColumn("p", F.coalesce(F.lag("b").over(w_prev), F.lit(-1))))
    covered = bands.select(*key, F.explode(F.sequence(F.col("p") + 1, F.col("b"))).alias("recall_idx"),
                           F.col("s").alias("precision"))
    # recall points past the last band (or every point, without true positives) get 0
    top = bands.groupBy(*key).agg(F.max("b").alias("mb"))
    base = n_pos.select("area", "category_id").withColumn("iou_thr", F.explode(F.array(*[F.lit(float(t)) for t in thrs])))
    tail = (base.join(top, key, "left")
                .withColumn("mb", F.coalesce("mb", F.lit(-1)))
                .where(F.col("mb") < N_RECALL - 1)
                .select(*key, F.explode(F.sequence(F.col("mb") + 1, F.lit(N_RECALL - 1))).alias("recall_idx"),
                        F.lit(0.0).alias("precision")))
    return covered.unionByName(tail)


def evaluate_inputs(det: DataFrame, gt_xyxy: DataFrame, images: DataFrame, categories: DataFrame, *,
                    max_det: int = 100, thrs=IOU_THRS, ranges=AREA_RANGES):
    """``(detections, truths, match masks)``.  The evaluated detections (best
    ``max_det`` per image and category) are matched where they lie by image and written once, as Parquet
    in the shared checkpoint folder: ``image_id, category_id, det_id, score, rk, size`` (the box's area) and
    the masks.  The third is a view of the matched ones.  ``coco_ap`` and ``coco_ar`` both take the
    triple as ``evaluated``, so one matching serves both."""
    d, g = eval_sets(det, gt_xyxy, images, categories, max_det=max_det)
    pairs = iou_join(d.withColumn("size", area("")), g, min_iou=min(thrs), keep=["rk", "size"])
    d = materialize(match_masks(pairs, thrs, ranges, keep=["score", "rk", "size"]), "eval-dets", "zstd")
    names = _mask_names(ranges)
    return d, g, d.select(*KEY, "det_id", *names).where(" OR ".join(f"`{c}` <> 0" for c in names))


def coco_ap(det: DataFrame = None, gt_xyxy: DataFrame = None, images: DataFrame = None, categories: DataFrame = None, *,
            thrs=IOU_THRS, max_det: int = 100, digits: int = 6, ranges=AREA_RANGES, evaluated=None) -> DataFrame:
    """Long table ``metric, iou_thr, category_id, value``.

    ``AP`` per (threshold, category); ``AP`` with ``iou_thr = -1`` per category
    (mean over thresholds); ``mAP`` with ``category_id = -1`` for all
    thresholds (``iou_thr = -1``), 0.5 and 0.75; ``mAP_small``, ``mAP_medium`` and
    ``mAP_large`` over all thresholds.
    """
    d, g, m = evaluated or evaluate_inputs(det, gt_xyxy, images, categories, max_det=max_det, thrs=thrs, ranges=ranges)
    ap = pr_curve(d, m, npig(g, ranges), thrs, ranges).groupBy("area", "category_id", "iou_thr").agg(
        (F.sum("precision") / F.lit(float(N_RECALL))).alias("ap"))
    # every summary in one pass: (threshold, category), category, all, threshold - by area range
    t, c, a = F.col("iou_thr"), F.col("category_id"), F.col("area")
    sets = ap.groupingSets([[a, t, c], [a, c], [a], [a, t]], a, t, c).agg(
        F.avg("ap").alias("value"), F.grouping_id().alias("_g"))
    g = F.col("_g")  # bit 1: threshold rolled up, bit 0: category rolled up
    out = sets.where(((a == "all") & ((g != 1) | t.isin(0.5, 0.75))) | ((a != "all") & (g == 3))).select(
        F.when(a != "all", F.concat(F.lit("mAP_"), a)).when(g.isin(0, 2), F.lit("AP")).otherwise(F.lit("mAP")).alias("metric"),
        F.coalesce(t, F.lit(-1.0)).alias("iou_thr"),
        F.coalesce(c, F.lit(-1).cast("bigint")).alias("category_id"), "value")
    return out.withColumn("value", F.round("value", digits))


def coco_ar(det: DataFrame = None, gt_xyxy: DataFrame = None, images: DataFrame = None, categories: DataFrame = None, *,
            thrs=IOU_THRS, max_dets=(100, 1, 10), digits: int = 6, ranges=AREA_RANGES, evaluated=None) -> DataFrame:
    """Average recall for each detections-per-image limit: ``metric = AR@n``,
    per category (mean over thresholds) and overall (``category_id = -1``);
    ``AR_small``, ``AR_medium`` and ``AR_large`` overall at the largest limit.

    Greedy matching of a score-sorted prefix does not depend on later
    detections, so one matching at the largest limit serves every limit.
    """
    d, g, m = evaluated or evaluate_inputs(det, gt_xyxy, images, categories, max_det=max(max_dets), thrs=thrs, ranges=ranges)
    hits = d if set(_mask_names(ranges)) <= set(d.columns) else m.join(d.select(*KEY, "det_id", "rk").hint("merge"), [*KEY, "det_id"])
    wanted = [(ranges[0][0], n) for n in max_dets] + [(name, max(max_dets)) for name, _, _ in ranges[1:]]
    # true positives of all thresholds together: the mean over thresholds needs their sum only
    counts = [F.sum(F.when(F.col("rk") <= n, F.bit_count(F.col(f"tp_{name}"))).otherwise(0)).alias(f"n{i}")
              for i, (name, n) in enumerate(wanted)]
    per = hits.groupBy("category_id").agg(*counts).select("category_id", F.explode(F.array(*[F.struct(
        F.lit(name).alias("area"), F.lit(n).alias("max_det"), F.col(f"n{i}").alias("hits"))
        for i, (name, n) in enumerate(wanted)])).alias("x")).select("category_id", "x.*")
    base = npig(g, ranges).join(hits.sparkSession.createDataFrame(wanted, "area string, max_det int"), "area")
    rec = base.join(per, ["area", "category_id", "max_det"], "left").withColumn(
        "recall", F.coalesce("hits", F.lit(0)) / (F.col("npig") * len(thrs)))
    whole = F.col("area") == ranges[0][0]
    metric = F.when(whole, F.concat(F.lit("AR@"), F.col("max_det").cast("string"))).otherwise(F.concat(F.lit("AR_"), F.col("area")))
    per_c = rec.where(whole).select(metric.alias("metric"), F.lit(-1.0).alias("iou_thr"), "category_id", F.col("recall").alias("value"))
    overall = rec.groupBy("area", "max_det").agg(F.avg("recall").alias("value")).select(
        metric.alias("metric"), F.lit(-1.0).alias("iou_thr"), F.lit(-1).cast("bigint").alias("category_id"), "value")
    return per_c.unionByName(overall).withColumn("value", F.round("value", digits))
