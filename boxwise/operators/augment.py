"""Box-geometry augmentation planned as tables (no pixels).

The reference only names these transforms and their parameters; the meaning
below is our contract (K6 draws, K7 boxes), following the published
descriptions of keep-ratio resize, random crop / flip / pad, mosaic (YOLOv4)
and mixup (Zhang et al. 2018).

A *frame* is a DataFrame with ``image_id, w, h`` (canvas) and, for box rows,
``x1, y1, x2, y2``.  Every per-image random number is a function of
``(seed, op, epoch, image_id)``, so each box row computes its own image's
parameters: single-image transforms are plain projections (no shuffle, no
join).  Mosaic and mixup join partner boxes by image id (one shuffle each).

Box rule (K7): boxes are clipped to the canvas; transforms that cut the canvas
(crop, mosaic, mixup) then drop boxes with non-positive width or height.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxwise.functions.draws import DEFAULT_SEED, coin, uniform, uniform_range
from boxwise.plans.ranking import as_of
from boxwise.session import materialize

BOX = ("x1", "y1", "x2", "y2")


def frame(images: DataFrame, boxes: DataFrame | None = None) -> DataFrame:
    """Canvas rows (``images``: ``id, width, height``) or box rows joined to
    their canvas (``boxes``: ``image_id`` + corners + any payload)."""
    cv = images.select(F.col("id").alias("image_id"), F.col("width").alias("w"), F.col("height").alias("h"))
    if boxes is None:
        return cv
    return boxes.join(cv, "image_id")


def _has_boxes(df: DataFrame) -> bool:
    return all(c in df.columns for c in BOX)


def _apply(df: DataFrame, *, w: Column, h: Column, boxes: dict | None = None, drop_invalid: bool = False,
           clip: bool = True) -> DataFrame:
    """Project the new canvas and corners at once (all from the old values)."""
    new = {"w": w, "h": h}
    if boxes and _has_boxes(df):
        new.update(boxes)
    out = df.select(*[new.get(c, F.col(c)).alias(c) for c in df.columns])
    if _has_boxes(out) and clip:
        out = out.select(*[(F.least(F.greatest(F.col(c), F.lit(0.0)), F.col("w" if c in ("x1", "x2") else "h")
                                     .cast("double")).alias(c) if c in BOX else F.col(c)) for c in out.columns])
    if _has_boxes(out) and drop_invalid:
        out = _keep(out, (F.col("x2") > F.col("x1")) & (F.col("y2") > F.col("y1")))
    return out


def _keep(df: DataFrame, cond: Column) -> DataFrame:
    """Drop rows failing ``cond`` with a generator instead of a Filter: a Filter
    would be pushed below the projections and inline their (md5-heavy)
    expressions into the join condition; a generator stays where it is."""
    one = F.when(cond, F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>"))
    return df.select("*", F.explode(one).alias("_keep")).drop("_keep")


def _with_params(df: DataFrame, **params: Column) -> DataFrame:
    """Per-image parameters as columns, computed once per row: Catalyst does
    not inline a non-trivial expression that is used several times."""
    return df.select("*", *[v.alias(k) for k, v in params.items()])


def _resize_to(df: DataFrame, long_edge: Column, short_edge: Column) -> DataFrame:
    cols = df.columns
    d = _with_params(df, _s=F.least(long_edge / F.greatest("w", "h"), short_edge / F.least("w", "h")))
    d = _with_params(d, _nw=F.floor(F.col("w") * F.col("_s") + 0.5).cast("int"),
                     _nh=F.floor(F.col("h") * F.col("_s") + 0.5).cast("int"))
    sx, sy = F.col("_nw") / F.col("w"), F.col("_nh") / F.col("h")
    d = _apply(d, w=F.col("_nw"), h=F.col("_nh"), boxes={"x1": F.col("x1") * sx, "y1": F.col("y1") * sy,
                                                          "x2": F.col("x2") * sx, "y2": F.col("y2") * sy})
    return d.select(*cols)


def resize_keep_ratio(df: DataFrame, scale=(640, 640)) -> DataFrame:
    """Largest size with the aspect ratio kept that fits ``scale`` (long edge to
    ``max(scale)``, short edge to ``min(scale)``); ``int(v * s + 0.5)`` sizes;
    boxes scale by ``new / old`` per axis and are clipped."""
    return _resize_to(df, F.lit(float(max(scale))), F.lit(float(min(scale))))


def random_resize(df: DataFrame, *, scale=(1280, 1280), ratio_range=(0.1, 2.0), seed: int = DEFAULT_SEED,
                  epoch: int = 0) -> DataFrame:
    """``ratio ~ U(ratio_range)``; target ``(int(sw * ratio), int(sh * ratio))``; then keep-ratio resize."""
    cols = df.columns
    d = _with_params(df, _r=uniform_range(uniform("image_id", "random_resize", seed=seed, epoch=epoch), *ratio_range))
    d = _with_params(d, _tw=F.floor(F.lit(float(scale[0])) * F.col("_r")), _th=F.floor(F.lit(float(scale[1])) * F.col("_r")))
    out = _resize_to(d, F.greatest("_tw", "_th").cast("double"), F.least("_tw", "_th").cast("double"))
    return out.select(*cols)


def random_crop(df: DataFrame, crop_size=(640, 640), *, seed: int = DEFAULT_SEED, epoch: int = 0) -> DataFrame:
    """Offsets ``floor(u * (margin + 1))`` with ``margin = max(size - crop, 0)``;
    boxes shift, clip, and empty ones are dropped."""
    cw, ch = crop_size
    cols = df.columns
    d = _with_params(df, _ox=F.floor(uniform("image_id", "random_crop", seed=seed, epoch=epoch, salt="x")
                                     * (F.greatest(F.col("w") - cw, F.lit(0)) + 1)),
                     _oy=F.floor(uniform("image_id", "random_crop", seed=seed, epoch=epoch, salt="y")
                                 * (F.greatest(F.col("h") - ch, F.lit(0)) + 1)))
    ox, oy = F.col("_ox"), F.col("_oy")
    out = _apply(d, w=F.least(F.col("w"), F.lit(cw)), h=F.least(F.col("h"), F.lit(ch)),
                 boxes={"x1": F.col("x1") - ox, "y1": F.col("y1") - oy, "x2": F.col("x2") - ox, "y2": F.col("y2") - oy},
                 drop_invalid=True)
    return out.select(*cols)


def flip_boxes(df: DataFrame, flipped: Column) -> DataFrame:
    return _apply(df, w=F.col("w"), h=F.col("h"), clip=False,
                  boxes={"x1": F.when(flipped, F.col("w") - F.col("x2")).otherwise(F.col("x1")),
                         "x2": F.when(flipped, F.col("w") - F.col("x1")).otherwise(F.col("x2")),
                         "y1": F.col("y1"), "y2": F.col("y2")})


def random_flip(df: DataFrame, prob: float = 0.5, *, seed: int = DEFAULT_SEED, epoch: int = 0) -> DataFrame:
    """Horizontal flip when ``u < prob``: ``x1' = W - x2``, ``x2' = W - x1``."""
    d = _with_params(df, _f=coin(uniform("image_id", "random_flip", seed=seed, epoch=epoch), prob))
    return flip_boxes(d, F.col("_f")).drop("_f")


def pad(df: DataFrame, size=(640, 640)) -> DataFrame:
    """Grow the canvas to at least ``size`` (bottom/right); boxes unchanged."""
    return _apply(df, w=F.greatest(F.col("w"), F.lit(size[0])), h=F.greatest(F.col("h"), F.lit(size[1])), clip=False)


# ------------------------------------------------------------ cache partners --

def sample_cache_partners(plan: DataFrame, *, cache: int, k: int, min_cache: int, stream=("node", "rank", "worker"),
                          random_pop: bool = False, seed: int = DEFAULT_SEED, epoch: int = 0,
                          op: str = "mosaic") -> DataFrame:
    """Partners drawn from a loader's cache of recent samples, the current one included.

    At stream index ``i`` the cache holds ``c = min(cache, i + 1)`` samples.  When
    ``c >= min_cache`` each slot ``j < k`` picks place ``floor(u_j * c)`` of it; otherwise the
    sample is not mixed.  Returns ``image_id, slot, partner_id``.

    Oldest out (``random_pop=False``): the places hold samples ``i-c+1 .. i``, and partners
    are found by an equi-join on ``(stream, idx)``.

    Random eviction (``random_pop=True``): sample ``i < cache`` fills place ``i``; a later one
    draws one of the ``cache + 1`` samples at hand to go, ``floor(u * (cache + 1))``: an old
    one gives it its place, the last number stands for itself.  A place then holds the
    last sample that drew it, which an as-of lookup finds for all steps at once: no
    stream is replayed, and a stream with many samples is split over tasks.
    """
    c = F.least(F.lit(cache), F.col("idx") + 1)
    d = plan.select(*stream, "idx", "image_id", c.alias("_c")).where(F.col("_c") >= min_cache)
    d = d.withColumn("slot", F.explode(F.sequence(F.lit(1), F.lit(k))))
    u = uniform(F.concat_ws(":", F.col("image_id").cast("string"), F.col("slot").cast("string")),
                f"{op}_partner", seed=seed, epoch=epoch)
    place = F.floor(u * F.col("_c"))
    if random_pop:
        drawn = F.floor(uniform("image_id", f"{op}_evict", seed=seed, epoch=epoch) * (cache + 1))
        writes = plan.select(*stream, "idx", F.when(F.col("idx") < cache, F.col("idx")).otherwise(drawn).alias("_place"),
                             F.col("image_id").alias("partner_id")).where(F.col("_place") < cache)
        reads = d.select(*stream, place.alias("_place"), "idx", "image_id", "slot")
        found = as_of(reads, writes, group=[*stream, "_place"], order="idx", value="partner_id")
        return found.select("image_id", F.col("slot").cast("int").alias("slot"), "partner_id")
    d = d.withColumn("_pidx", F.col("idx") - F.col("_c") + 1 + place)
    src = plan.select(*stream, F.col("idx").alias("_pidx"), F.col("image_id").alias("partner_id"))
    # both sides are as large as the plan: a shuffle join, never a broadcast
    return d.join(src.hint("merge"), [*stream, "_pidx"]).select("image_id", F.col("slot").cast("int").alias("slot"),
                                                                "partner_id")


# ------------------------------------------------------------------ mosaic --

def mosaic_compose(canvas: DataFrame, boxes: DataFrame, partners: DataFrame, *, samples: DataFrame | None = None, img_scale=(640, 640),
                   center_ratio_range=(0.5, 1.5), seed: int = DEFAULT_SEED, epoch: int = 0) -> DataFrame:
    """Four images on a ``2W x 2H`` canvas around a random centre.

    Tile 0 is the image itself, tiles 1-3 are its partners (slots 1-3).  Each
    tile image is resized by ``r = min(H / h, W / w)`` to ``(int(w r), int(h r))``
    and pasted into its quadrant (top-left, top-right, bottom-left,
    bottom-right) touching the centre; the part outside the canvas is cut.
    Boxes scale by ``r``, shift by the paste offset, are clipped to the whole
    canvas and empty ones dropped.  ``canvas``: ``image_id, w, h``; ``boxes``:
    box rows with ``image_id``; returns box rows (``tile``, ``src_id`` added)
    on the mosaic canvas.  An image of ``samples`` (``image_id``) without three
    partners is not mixed and passes as it is, on its own canvas, as tile 0.
    """
    W, H = img_scale
    tiles = partners.where(F.col("slot").between(1, 3)).select("image_id", F.col("slot").alias("tile"),
                                                             F.col("partner_id").alias("src_id"))
    full = tiles.groupBy("image_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == 3).select("image_id")
    tiles = full.select("image_id", F.lit(0).alias("tile"), F.col("image_id").alias("src_id")) \
                .unionByName(tiles.join(full, "image_id", "left_semi"))
    src = canvas.select(F.col("image_id").alias("src_id"), F.col("w").alias("sw"), F.col("h").alias("sh"))
    t = tiles.join(src, "src_id")
    cx = F.floor(uniform_range(uniform("image_id", "mosaic", seed=seed, epoch=epoch, salt="cx"), *center_ratio_range) * W)
    cy = F.floor(uniform_range(uniform("image_id", "mosaic", seed=seed, epoch=epoch, salt="cy"), *center_ratio_range) * H)
    r = F.least(F.lit(float(H)) / F.col("sh"), F.lit(float(W)) / F.col("sw"))
    t = t.withColumn("cx", cx).withColumn("cy", cy).withColumn("r", r) \
         .withColumn("tw", F.floor(F.col("sw") * F.col("r"))).withColumn("th", F.floor(F.col("sh") * F.col("r")))
    left = F.col("tile").isin(0, 2)
    top = F.col("tile").isin(0, 1)
    # paste rectangle on the canvas and matching crop origin inside the tile
    px1 = F.when(left, F.greatest(F.col("cx") - F.col("tw"), F.lit(0))).otherwise(F.col("cx"))
    py1 = F.when(top, F.greatest(F.col("cy") - F.col("th"), F.lit(0))).otherwise(F.col("cy"))
    px2 = F.when(left, F.col("cx")).otherwise(F.least(F.col("cx") + F.col("tw"), F.lit(2 * W)))
    py2 = F.when(top, F.col("cy")).otherwise(F.least(F.col("cy") + F.col("th"), F.lit(2 * H)))
    cx1 = F.when(left, F.col("tw") - (px2 - px1)).otherwise(F.lit(0))
    cy1 = F.when(top, F.col("th") - (py2 - py1)).otherwise(F.lit(0))
    t = t.withColumn("padw", px1 - cx1).withColumn("padh", py1 - cy1)
    b = boxes.withColumnRenamed("image_id", "src_id")
    j = t.select("image_id", "tile", "src_id", "r", "padw", "padh").join(b.hint("merge"), "src_id")
    out = j.select("image_id", "tile", "src_id", *[c for c in b.columns if c not in ("src_id", *BOX, "w", "h")],
                   (F.col("x1") * F.col("r") + F.col("padw")).alias("x1"), (F.col("y1") * F.col("r") + F.col("padh")).alias("y1"),
                   (F.col("x2") * F.col("r") + F.col("padw")).alias("x2"), (F.col("y2") * F.col("r") + F.col("padh")).alias("y2"),
                   F.lit(2 * W).alias("w"), F.lit(2 * H).alias("h"))
    out = _apply(out, w=F.col("w"), h=F.col("h"), boxes={}, drop_invalid=True)
    if samples is None:
        return out
    alone = samples.select("image_id").join(full.hint("merge"), "image_id", "left_anti")
    own = (boxes.join(alone.hint("merge"), "image_id").join(canvas.select("image_id", "w", "h").hint("merge"), "image_id")
           .withColumns({"tile": F.lit(0), "src_id": F.col("image_id")}))
    return out.unionByName(own.select(*out.columns))


# ------------------------------------------------------------------- mixup --

def mixup_compose(target: DataFrame, pool: DataFrame, partners: DataFrame, *, img_scale=(640, 640),
                  ratio_range=(1.0, 1.0), flip_ratio: float = 0.5, prob: float = 1.0,
                  seed: int = DEFAULT_SEED, epoch: int = 0) -> DataFrame:
    """Blend a cached partner's boxes into the target frame.

    ``target``: box rows of the images being built (``image_id, w, h`` +
    corners); ``pool``: frames the partners come from (same layout, canvas
    taken from its rows); ``partners``: slot-1 partner per image.  When
    ``u < prob`` the partner is resized by ``r = min(H/h, W/w) * jit`` (``jit ~
    U(ratio_range)``), placed top-left on a ``W x H`` canvas, flipped there when
    ``u > flip_ratio``, and cut to the target canvas at offsets ``floor(u *
    (max(target, W) - target))``; its boxes follow, are clipped and empty ones
    dropped, then join the target's own boxes.
    """
    W, H = img_scale
    p = partners.where(F.col("slot") == 1).select("image_id", F.col("partner_id").alias("_src"))
    mix = coin(uniform("image_id", "mixup", seed=seed, epoch=epoch, salt="p"), prob)
    tcv = target.select("image_id", F.col("w").alias("tw"), F.col("h").alias("th")).dropDuplicates(["image_id"])
    p = p.join(tcv, "image_id").where(mix)
    jit = uniform_range(uniform("image_id", "mixup", seed=seed, epoch=epoch, salt="jit"), *ratio_range)
    flip = uniform("image_id", "mixup", seed=seed, epoch=epoch, salt="flip") > F.lit(float(flip_ratio))
    payload = [c for c in target.columns if c not in ("image_id", *BOX, "w", "h")]
    src = pool.select(F.col("image_id").alias("_src"), *payload, *BOX, "w", "h")
    j = p.join(src.hint("merge"), "_src")
    r = F.least(F.lit(float(H)) / F.col("h"), F.lit(float(W)) / F.col("w")) * jit
    ox = F.floor(uniform("image_id", "mixup", seed=seed, epoch=epoch, salt="x")
                 * F.greatest(F.lit(W) - F.col("tw"), F.lit(0)))
    oy = F.floor(uniform("image_id", "mixup", seed=seed, epoch=epoch, salt="y")
                 * F.greatest(F.lit(H) - F.col("th"), F.lit(0)))
    x1, x2 = F.col("x1") * r, F.col("x2") * r
    fx1 = F.when(flip, F.lit(float(W)) - x2).otherwise(x1)
    fx2 = F.when(flip, F.lit(float(W)) - x1).otherwise(x2)
    moved = j.select("image_id", *payload,
                     (fx1 - ox).alias("x1"), (F.col("y1") * r - oy).alias("y1"),
                     (fx2 - ox).alias("x2"), (F.col("y2") * r - oy).alias("y2"),
                     F.col("tw").alias("w"), F.col("th").alias("h"))
    moved = _apply(moved.select(*target.columns), w=F.col("w"), h=F.col("h"), boxes={}, drop_invalid=True)
    return target.unionByName(moved)


# -------------------------------------------------------------- stage plan --

# fixed values: settings of the tiny models; their caches drop the oldest sample
TINY = {"mosaic_cache": 20, "mixup_cache": 10, "random_pop": False, "ratio_range": (0.5, 2.0), "mixup_prob": 0.5}


def augment_plan(images: DataFrame, boxes: DataFrame, plan: DataFrame, *, epoch: int, switch_epoch: int = 280,
                 seed: int = DEFAULT_SEED, mosaic_cache: int = 40, mixup_cache: int = 20,
                 random_pop: bool = True, scale=(640, 640), ratio_range=(0.1, 2.0), mixup_prob: float = 1.0) -> DataFrame:
    """The training chain for one epoch, chosen by epoch (stage 2 from ``switch_epoch``).

    Stage 1: mosaic -> random resize (2x scale, ``ratio_range``) -> crop -> flip
    -> pad -> mixup (``mixup_prob``) with a cached, already-augmented partner; a
    sample without mosaic partners goes on unmixed.  Stage 2: random resize
    (scale, ``ratio_range``) -> crop -> flip -> pad.  The defaults are the settings
    of the large models, whose caches evict at random (``random_pop``, unset there); the
    tiny ones use ``TINY``.
    ``boxes``: box rows ``image_id, box_id, x1..y2, label``; ``plan``: the epoch
    plan (stream, idx).
    """
    cv = frame(images)
    fb = frame(images, boxes)
    if epoch >= switch_epoch:
        x = random_resize(fb, scale=scale, ratio_range=ratio_range, seed=seed, epoch=epoch)
        x = random_crop(x, scale, seed=seed, epoch=epoch)
        return pad(random_flip(x, 0.5, seed=seed, epoch=epoch), scale)
    mp = sample_cache_partners(plan, cache=mosaic_cache, k=3, min_cache=5, random_pop=random_pop, seed=seed, epoch=epoch,
                               op="mosaic")
    # the composers read partners and frames several times: each is stored, so its chain runs once
    mp = materialize(mp, "augment-mosaic-partners")
    x = mosaic_compose(cv, fb.drop("w", "h"), mp, samples=plan, img_scale=scale, seed=seed, epoch=epoch)
    x = random_resize(x, scale=(2 * scale[0], 2 * scale[1]), ratio_range=ratio_range, seed=seed, epoch=epoch)
    x = random_crop(x, scale, seed=seed, epoch=epoch)
    x = materialize(pad(random_flip(x, 0.5, seed=seed, epoch=epoch), scale), "augment-frames")
    xp = sample_cache_partners(plan, cache=mixup_cache, k=1, min_cache=2, random_pop=random_pop, seed=seed, epoch=epoch,
                               op="mixup")
    return mixup_compose(x, x, xp, img_scale=scale, prob=mixup_prob, seed=seed, epoch=epoch)
