"""Quality classifier: Bradley-Terry ranking of documents.

Each preference pair sets a text labelled good against one labelled bad; a linear
worth function is learnt by logistic loss on the difference of their features.
The worth's quantile among the training texts that equals the share of bad ones
becomes the threshold, and the score is a logistic curve of the worth that takes
the value ``cut`` there.  Features are whole-text statistics of bytes, words and
lines, computed batch-wise in numpy.

Training uses at most ``max_texts`` labelled texts.  Defined results: null counts as
empty text, and an empty text gets a score like any other; very long texts are read
whole, one run of about a megabyte or one text at a time; repeated rows get equal scores,
and scores may tie; labels tied in the sample's order follow by id and label; without
labels of both kinds every score is 0.5; an empty table gives an empty result; extra
columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxwise.llm.bpe import text_runs

GROUPS = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789",
          "space": b" \t\r\x0b\x0c", "line": b"\n", "stop": b".", "comma": b",;:", "mark": b"!?", "pipe": b"|",
          "symbol": b"#*$%&<>", "markup": b"{}[]()=/\\_@~^+-", "quote": b"\"'`"}
NAMES = [*GROUPS, "other", "log_words", "word_length", "new_words", "new_lines", "line_words", "new_pairs"]


def _group_of_byte() -> np.ndarray:
    table = np.full(256, len(GROUPS), np.uint8)
    for i, chars in enumerate(GROUPS.values()):
        table[list(chars)] = i
    return table


_TABLE = _group_of_byte()


def features(texts: list[str]) -> np.ndarray:
    """One row per text: shares of byte groups, lengths, and the shares of words,
    word pairs and lines that are new when they occur."""
    out = np.zeros((len(texts), len(NAMES)))
    for i, t in enumerate(texts):
        b = np.frombuffer(t.encode(), np.uint8)
        k = len(GROUPS) + 1
        words, lines = t.split(), [x for x in t.split("\n") if x.strip()]
        n = max(1, len(words))
        out[i, :k] = np.sqrt(np.bincount(_TABLE[b], minlength=k) / max(1, len(b)))
        out[i, k:] = (np.log1p(len(words)), np.log1p(len(b) / n), len(set(words)) / n ** 0.9,
                      len(set(lines)) / max(1, len(lines)), np.log1p(n / max(1, len(lines))),
                      len(set(zip(words, words[1:]))) / max(1, n - 1))
    return out


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    shift: float = 0.0
    slope: float = 1.0

    def worth(self, x: np.ndarray) -> np.ndarray:
        return _expand((x - self.mean) / self.scale) @ self.weight

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.worth(x) + self.shift, -50, 50)))


def _expand(z: np.ndarray) -> np.ndarray:
    """Standardised features, clipped, with their squares."""
    z = np.clip(z, -6, 6)
    return np.concatenate([z, z * z - 1], 1)


def train(x: np.ndarray, y: np.ndarray, *, cut: float = 0.3, pairs: int = 40_000, epochs: int = 300,
          penalty: float = 1e-3, seed: int = 11) -> Model:
    """Logistic loss on feature differences of ``pairs`` good-bad pairs."""
    rng = np.random.default_rng(seed)
    m = Model(x.mean(0), x.std(0) + 1e-6, np.zeros(2 * x.shape[1]))
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return m
    z = _expand((x - m.mean) / m.scale)
    first, second = np.zeros_like(m.weight), np.zeros_like(m.weight)
    for t in range(1, epochs + 1):
        d = z[rng.choice(good, pairs // 40)] - z[rng.choice(bad, pairs // 40)]
        p = 1 / (1 + np.exp(np.clip(d @ m.weight, -50, 50)))          # of the wrong order
        g = -(d * p[:, None]).mean(0) + penalty * m.weight
        first += 0.1 * (g - first)
        second += 0.001 * (g * g - second)
        m.weight -= 0.05 * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.999 ** t)) + 1e-8)
    worth = m.worth(x)
    threshold = np.quantile(worth, (y == 0).mean())
    spread = max(worth.std(), 1e-6)
    m.slope = 4 / spread
    m.shift = float(np.log(cut / (1 - cut)) - m.slope * threshold)
    return m


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", max_texts: int = 8_000, cut: float = 0.3, seed: int = 11) -> Model:
    """Fit on at most ``max_texts`` labelled texts: so many rows of ``labels`` (a
    hash order of the id decides) find their texts, which leave the join as
    features only."""
    wanted = (labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("y"))
              .filter("y IN (0, 1)").orderBy(F.xxhash64("id"), "id", "y").limit(max_texts))
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    # the sample has at most max_texts rows of two numbers, so it can be broadcast
    found = _featured(texts.join(F.broadcast(wanted), "id"), ["y"])
    got = found.orderBy("x", "y").limit(max_texts).collect()
    if not got:
        return Model(np.zeros(len(NAMES)), np.ones(len(NAMES)), np.zeros(2 * len(NAMES)))
    x = np.array([np.frombuffer(r.x, "f8") for r in got])
    return train(x, np.array([r.y for r in got]), cut=cut, seed=seed)


def _featured(df: DataFrame, carry: list[str]) -> DataFrame:
    def task(batches):
        for b in batches:
            for low, high, texts in text_runs(b.column("text")):
                x = features(texts)
                yield pa.RecordBatch.from_arrays([*[b.column(c).slice(low, high - low) for c in carry],
                                                  pa.array([r.tobytes() for r in x], pa.binary())], names=[*carry, "x"])
    src = df.select(*carry, "text")
    return src.mapInArrow(task, T.StructType([*[src.schema[c] for c in carry], T.StructField("x", T.BinaryType())]))


def score(df: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", cut: float = 0.3) -> DataFrame:
    """(id, score, predicted) of every row, by its whole text."""
    src = df.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))

    def task(batches):
        for b in batches:
            for low, high, texts in text_runs(b.column("text")):
                s = model.score(features(texts))
                yield pa.RecordBatch.from_arrays([b.column("id").slice(low, high - low), pa.array(s, pa.float64()),
                                                  pa.array((s >= cut).astype("i4"))], names=["id", "score", "predicted"])

    return src.mapInArrow(task, T.StructType([src.schema["id"], T.StructField("score", T.DoubleType()),
                                              T.StructField("predicted", T.IntegerType())]))
