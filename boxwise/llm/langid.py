"""Language ID: a byte convolutional network trained in numpy.

Network: byte embeddings, filters of several widths over consecutive bytes, ReLU,
max pooling over a window of fixed length, one linear layer, softmax.  Windows are
batched; a text is cut into consecutive windows that cover all of it, and its
language is the argmax of the length-weighted mean of its windows' log
probabilities.  Training draws a bounded sample of labelled rows
(``per_language`` texts a language, by a hash order) and a bounded number of
windows of each; prediction reads whole texts.

Defined results: null text or a text without a letter gets ``und`` with score 0;
repeated rows get equal answers; without any labelled row every text is ``und``;
an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxwise.llm.bpe import text_runs
from boxwise.llm.common import releasing_batches

WINDOW = 256
WIDTHS = (2, 3, 4)
EMBED, FILTERS = 8, 16
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    embed: np.ndarray                  # 256 x EMBED
    filters: list[np.ndarray]          # per width: (width * EMBED) x FILTERS
    bias: list[np.ndarray]
    out: np.ndarray                    # (widths * FILTERS) x languages
    out_bias: np.ndarray


def windows(data: bytes, length: int = WINDOW) -> np.ndarray:
    """All of ``data`` as rows of ``length`` bytes; the last row ends with spaces."""
    n = max(1, -(-len(data) // length))
    return np.frombuffer(data.ljust(n * length, b" "), np.uint8).reshape(n, length)


def _pooled(m: Model, x: np.ndarray, with_argmax: bool = False):
    """Max-pooled filter responses of the windows ``x`` (n x length)."""
    n, length = x.shape
    e = m.embed[x].reshape(n, length * EMBED)
    stride = e.strides
    pooled, where = [], []
    for w, f, b in zip(WIDTHS, m.filters, m.bias):
        cols = np.lib.stride_tricks.as_strided(e, (n, length - w + 1, w * EMBED),
                                               (stride[0], EMBED * stride[1], stride[1]))
        h = cols.reshape(n * (length - w + 1), w * EMBED) @ f
        h = h.reshape(n, length - w + 1, -1)
        if with_argmax:
            where.append(h.argmax(1))
        pooled.append(h.max(1) + b)
    p = np.concatenate(pooled, 1)
    return (p, where, e) if with_argmax else p


def _pooled_at_once(m: Model, x: np.ndarray) -> np.ndarray:
    """``_pooled`` with one product for all widths: narrower filters get zero
    weights behind them, and spaces follow each window; their responses there
    are left out of the maximum."""
    n, length = x.shape
    most = max(WIDTHS)
    joint = np.zeros((most * EMBED, FILTERS * len(WIDTHS)), "f4")
    for j, (w, f) in enumerate(zip(WIDTHS, m.filters)):
        joint[:w * EMBED, j * FILTERS:(j + 1) * FILTERS] = f
    padded = np.concatenate([x, np.full((n, most - 1), 32, np.uint8)], 1)
    e = m.embed[padded].reshape(n, -1)
    s = e.strides
    cols = np.lib.stride_tricks.as_strided(e, (n, length, most * EMBED), (s[0], EMBED * s[1], s[1]))
    h = (cols.reshape(n * length, -1) @ joint).reshape(n, length, -1)
    inner = length - most + 1
    p = h[:, :inner].max(1)
    for j, w in enumerate(WIDTHS):
        if w < most:
            at = slice(j * FILTERS, (j + 1) * FILTERS)
            p[:, at] = np.maximum(p[:, at], h[:, inner:length - w + 1, at].max(1))
    return p + np.concatenate(m.bias)


def log_probabilities(m: Model, x: np.ndarray) -> np.ndarray:
    z = np.maximum(_pooled_at_once(m, x), 0) @ m.out + m.out_bias
    z -= z.max(1, keepdims=True)
    return z - np.log(np.exp(z).sum(1, keepdims=True))


def train(x: np.ndarray, y: np.ndarray, languages: list[str], *, epochs: int = 6, batch: int = 128,
          rate: float = 0.004, seed: int = 7) -> Model:
    """Adam on the cross entropy of windows ``x`` with language indexes ``y``."""
    rng = np.random.default_rng(seed)
    k = len(languages)
    m = Model(languages, rng.normal(0, 0.5, (256, EMBED)).astype("f4"),
              [rng.normal(0, (2 / (w * EMBED)) ** 0.5, (w * EMBED, FILTERS)).astype("f4") for w in WIDTHS],
              [np.zeros(FILTERS, "f4") for _ in WIDTHS],
              rng.normal(0, (1 / (len(WIDTHS) * FILTERS)) ** 0.5, (len(WIDTHS) * FILTERS, k)).astype("f4"),
              np.zeros(k, "f4"))
    params = [m.embed, *m.filters, *m.bias, m.out, m.out_bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    weight = (len(y) / (k * np.maximum(np.bincount(y, minlength=k), 1)))[y].astype("f4")
    t = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for low in range(0, len(y), batch):
            at = order[low:low + batch]
            xb, yb = x[at], y[at]
            n = len(at)
            p, where, e = _pooled(m, xb, True)
            h = np.maximum(p, 0)
            z = h @ m.out + m.out_bias
            z = np.exp(z - z.max(1, keepdims=True))
            z /= z.sum(1, keepdims=True)
            z[np.arange(n), yb] -= 1
            z *= weight[at][:, None] / n
            grads_out, grads_bias = h.T @ z, z.sum(0)
            dp = (z @ m.out.T) * (p > 0)
            d_embed = np.zeros_like(m.embed)
            d_filters, d_bias = [], []
            rows = np.arange(n)[:, None]
            for j, w in enumerate(WIDTHS):
                d = dp[:, j * FILTERS:(j + 1) * FILTERS]                      # n x FILTERS
                pos = where[j][:, :, None] + np.arange(w)                     # n x FILTERS x w
                by = xb[rows[:, :, None], pos]
                emb = m.embed[by].reshape(n, FILTERS, w * EMBED)
                d_filters.append(np.einsum("nf,nfe->ef", d, emb))
                d_bias.append(d.sum(0))
                back = (d[:, :, None] * m.filters[j].T[None]).reshape(n, FILTERS, w, EMBED)
                np.add.at(d_embed, by, back)
            t += 1
            for i, (q, g) in enumerate(zip(params, [d_embed, *d_filters, *d_bias, grads_out, grads_bias])):
                first[i] += 0.1 * (g - first[i])
                second[i] += 0.001 * (g * g - second[i])
                q -= rate * (first[i] / (1 - 0.9 ** t)) / (np.sqrt(second[i] / (1 - 0.999 ** t)) + 1e-8)
    return m


def _least_hashes(rows: DataFrame, per_language: int) -> dict[str, int]:
    """For each language the ``per_language``-th least distinct hash of its texts (the largest,
    where there are fewer).  Hashes are spread evenly, so a bound taken from a language's count
    leaves about twice as many; copies may leave too few, then the bound is raised.  No task
    sees a whole language."""
    todo = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    tops, share = {}, 2
    while todo:
        below = F.lit(False)
        for lang, n in todo.items():
            bound = min((1 << 63) - 1, -(1 << 63) + (1 << 64) * share * per_language // n)
            below = below | ((F.col("lang") == lang) & (F.col("h") <= bound))
        found = {}
        for r in rows.filter(below).select("lang", "h").distinct().collect():
            found.setdefault(r.lang, []).append(r.h)
        for lang in [x for x, n in todo.items() if len(found.get(x, ())) >= per_language or share * per_language >= n]:
            tops[lang] = sorted(found[lang])[:per_language][-1]
            del todo[lang]
        share *= 8
    return tops


def fit(labelled: DataFrame, *, text_col: str = "text", lang_col: str = "lang", per_language: int = 400,
        windows_per_text: int = 6, seed: int = 7) -> Model:
    """Fit on a bounded sample: ``per_language`` texts of each language (a hash
    order of the text decides, so the sample doesn't depend on ids or files) and
    ``windows_per_text`` evenly spread windows of each."""
    rows = labelled.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang")) \
        .filter("lang IS NOT NULL AND text RLIKE '\\\\p{L}'")
    rows = rows.withColumn("h", F.xxhash64("text"))
    tops = _least_hashes(rows, per_language)
    if not tops:
        return None
    low = F.lit(False)
    for lang, top in tops.items():
        low = low | ((F.col("lang") == lang) & (F.col("h") <= top))
    length = F.length("text")
    picks = F.transform(F.sequence(F.lit(0), F.lit(windows_per_text - 1)), lambda i: F.substring(
        F.col("text"), (i * length / windows_per_text).cast("int") + 1, F.lit(WINDOW)))
    got = rows.filter(low).dropDuplicates(["lang", "h"]).select("lang", picks.alias("w")).collect()
    languages = sorted(tops)
    x, y = [], []
    for r in sorted(got, key=lambda r: (r.lang, r.w)):
        for w in dict.fromkeys(r.w):
            x.append(w.encode()[:WINDOW].ljust(WINDOW, b" "))
            y.append(languages.index(r.lang))
    x = np.frombuffer(b"".join(x), np.uint8).reshape(len(x), WINDOW)
    return train(x, np.array(y), languages, seed=seed)


def predict_texts(m: Model, texts: list[str], group: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """(language index, score) of whole texts; windows go through in groups."""
    data = [t.encode() for t in texts]
    rows = [windows(d) for d in data]
    counts = np.array([len(r) for r in rows])
    x = np.concatenate(rows)
    share = np.full(len(x), WINDOW, "f4")
    share[np.cumsum(counts) - 1] = np.maximum([len(d) - (n - 1) * WINDOW for d, n in zip(data, counts)], 1)
    lp = np.concatenate([log_probabilities(m, x[i:i + group]) for i in range(0, len(x), group)])
    sums = np.add.reduceat(lp * share[:, None], np.cumsum(counts) - counts, axis=0)
    mean = sums / np.add.reduceat(share, np.cumsum(counts) - counts)[:, None]
    p = np.exp(mean - mean.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    return p.argmax(1), p.max(1)


def predict(df: DataFrame, model: Model | None, *, text_col: str = "text", carry: list[str] | None = None,
            pred_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """``carry`` columns of ``df`` (all by default) plus the predicted language and its score,
    which take the place of columns of these names.  The model (some kilobytes) travels
    with the task."""
    new = {pred_col.lower(), score_col.lower()}
    carry = [c for c in (df.columns if carry is None else carry) if c.lower() not in new]
    held = df.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"),
                     F.when(F.col(f"`{text_col}`").rlike(r"\p{L}"), F.col(f"`{text_col}`")).alias("text"))

    def task(batches):
        for batch in batches:
            name, score = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            for low, _, texts in text_runs(pc.fill_null(batch.column("text"), "")) if model is not None else ():
                at = [i for i, t in enumerate(texts) if t]
                if at:
                    best, p = predict_texts(model, [texts[i] for i in at])
                    for i, b, s in zip(at, best, p):
                        name[low + i], score[low + i] = model.languages[b], float(s)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(name), pa.array(score)],
                                             names=["row", "lang_pred", "score"])

    schema = T.StructType([held.schema["row"], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    out = held.mapInArrow(releasing_batches(task), schema)
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in carry], F.col("lang_pred").alias(pred_col),
                      F.col("score").alias(score_col))
