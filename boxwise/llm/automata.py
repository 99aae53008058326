"""Substring dedup by suffix automata of reference shards.

A window is ``window`` consecutive words of one document.  Every word covered by a
window whose words also stand in a document with a smaller id is removed; windows are
judged on the input.

 1. Seeds.  Of the word n-grams inside a window the one with the least hash stands for it,
    so equal windows have equal seeds.  Consecutive windows with one seed are a unit, and
    a document lists (seed, unit hash, place) of its units: about one for every twenty
    words.  An aggregation by seed finds those of two documents or more; the rest of
    the corpus needs no further look.
 2. Owners.  Where all units of a seed are equal, their owner is the smallest id
    among them.  Where they differ, their windows are told apart by 128-bit hashes and
    each window's owner is the smallest id that has it.
 3. Shards.  The windows a document owns are reference text; it is dealt by owner into
    shards of about ``shard_words`` words.  The windows a document shares with a smaller
    owner are dealt to the owner's shard.  A shard with much to match is cut into chunks,
    and its references go to each of them, so neither a popular passage nor a large group of
    copies meets in one task.
 4. Automata.  A task builds the suffix automaton of its shard's references, over words,
    with the smallest id that has each state's strings.  The dealt windows stream
    through it for matching statistics: where the longest match behind a word has ``window``
    words or more, the state of its last ``window`` words tells the smallest id, and
    if that is below the document's own the span is removed.  Automata hold at most
    ``automaton_words`` words; a shard with more references builds them in turn.

Hashes only choose what meets; what is removed follows from the words themselves.  Two
different windows with equal 128-bit hashes could hide a repeat; nothing else can.

Defined results: null text has no words; documents shorter than a window stay whole;
null ids have no order, so these rows stay whole and are no reference; rows with equal
id don't remove words from each other, and rows equal in id and text get equal answers;
a document that repeats itself stays whole; very long texts are cut into pieces that
overlap by a window; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxwise.llm import bpe
from boxwise.llm.common import store
from boxwise.session import materialize

WINDOW = 50
GRAM = 11                                             # words of a seed
LONGEST_UNIT = 64                                     # windows
ROWS = 50_000                                         # rows of a result batch
PIECE = 4096                                          # windows of a dealt stretch
SEPARATOR = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])

U = np.uint64
BYTE_BASE, WORD_BASE, SECOND_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F


# ------------------------------------------------------------------- hashes ---

def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64 bits."""
    x = (x ^ (x >> U(31))) * U(0x7FB5D329728EA185)
    x = (x ^ (x >> U(27))) * U(0x81DADEF4BC2DD44D)
    return x ^ (x >> U(33))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^0..base^n and their inverses modulo 2^64."""
    got = _POWERS.get(base)
    if got is None or len(got[0]) <= n:
        size = max(n + 1, 1 << 16)
        up, down = np.full(size, base, U), np.full(size, pow(base, -1, 1 << 64), U)
        up[0] = down[0] = 1
        got = _POWERS[base] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return got


class Rolling:
    """Hashes of any stretch of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray, base: int):
        up, self.down = _powers(base, len(values))
        self.sums = np.concatenate([np.zeros(1, U), np.cumsum(values * up[:len(values)], dtype=U)])

    def of(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[high] - self.sums[low]) * self.down[low] + (high - low).astype(U) * U(BYTE_BASE))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word of the texts in order, number of words of each text)."""
    parts = [t.encode() for t in texts]
    data = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
    gap = SEPARATOR[data]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if not gap[0]:
        edge = np.concatenate([[0], edge])
    low, high = edge[0::2], edge[1::2]
    stops = np.cumsum([len(p) + 1 for p in parts])
    counts = np.diff(np.concatenate([[0], np.searchsorted(low, stops)]))
    return Rolling(data.astype(U) + U(1), BYTE_BASE).of(low, high), counts


def _least(x: np.ndarray, w: int) -> np.ndarray:
    """Least of each ``w`` consecutive values."""
    n = len(x) - w + 1
    full = np.concatenate([x, np.full(-len(x) % w, np.iinfo(U).max, U)]).reshape(-1, w)
    ahead = np.minimum.accumulate(full, 1).ravel()
    back = np.minimum.accumulate(full[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1:w - 1 + n])


def units(hashes: np.ndarray, counts: np.ndarray, window: int, gram: int):
    """(document, seed, unit hash, first window inside the document, windows) of all
    units of consecutive documents."""
    n = len(hashes)
    if n < window:
        return [np.zeros(0, np.int64)] * 5
    words = Rolling(hashes, WORD_BASE)
    at = np.arange(n - gram + 1)
    seed = _least(words.of(at, at + gram), window - gram + 1)
    doc = np.repeat(np.arange(len(counts)), counts)
    whole = doc[:n - window + 1] == doc[window - 1:]
    change = np.ones(len(seed), bool)
    change[1:] = (seed[1:] != seed[:-1]) | (doc[1:len(seed)] != doc[:len(seed) - 1]) | (whole[1:] != whole[:-1])
    begin = np.flatnonzero(change)
    place = np.arange(len(seed)) - np.repeat(begin, np.diff(np.concatenate([begin, [len(seed)]])))
    low = np.flatnonzero((place % LONGEST_UNIT == 0))
    size = np.diff(np.concatenate([low, [len(seed)]]))
    low, size = low[whole[low]], size[whole[low]]
    first = np.cumsum(counts) - counts
    return doc[low], seed[low], words.of(low, low + size + window - 1), low - first[doc[low]], size


# ---------------------------------------------------------------- automaton ---

class Automaton:
    """Suffix automaton of several word sequences; ``least`` is the smallest id among
    the documents that have a state's strings."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.least = [-1], [0], [None]

    def _state(self, length: int, step: dict, link: int) -> int:
        self.next.append(step)
        self.length.append(length)
        self.link.append(link)
        self.least.append(None)
        return len(self.length) - 1

    def _split(self, p: int, word, q: int) -> int:
        """The state of the strings of ``q`` that are no longer than those of ``p`` and the word."""
        if self.length[p] + 1 == self.length[q]:
            return q
        short = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = short
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = short
            p = self.link[p]
        return short

    def add(self, words: list, doc) -> None:
        step, link, least = self.next, self.link, self.least
        last = 0
        for word in words:
            q = step[last].get(word)
            if q is not None:
                last = self._split(last, word, q)
            else:
                new = self._state(self.length[last] + 1, {}, 0)
                p = last
                while p >= 0 and word not in step[p]:
                    step[p][word] = new
                    p = link[p]
                if p >= 0:
                    link[new] = self._split(p, word, step[p][word])
                last = new
            if least[last] is None or doc < least[last]:
                least[last] = doc

    def close(self) -> None:
        """Ids reach the shorter strings; call it once, after the last sequence."""
        least, link = self.least, self.link
        for v in sorted(range(1, len(link)), key=self.length.__getitem__, reverse=True):
            p = link[v]
            if p > 0 and least[v] is not None and (least[p] is None or least[v] < least[p]):
                least[p] = least[v]

    def matches(self, words: list, doc, window: int) -> list[int]:
        """Ends (last word's place) of the windows that a document smaller than ``doc`` has."""
        step, link, length, least = self.next, self.link, self.length, self.least
        out, v, size = [], 0, 0
        for i, word in enumerate(words):
            to = step[v].get(word)
            while to is None and v:
                v = link[v]
                size = length[v]
                to = step[v].get(word)
            if to is None:
                continue
            v, size = to, size + 1
            if size >= window:
                while length[link[v]] >= window:     # a shorter match that still has the window
                    v = link[v]
                    size = length[v]
                if least[v] < doc:
                    out.append(i)
        return out


# ------------------------------------------------------------ the Spark job ---

KEY = ["doc_id", "h"]


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")) \
        .withColumn("h", F.xxhash64("text"))


def _lists(values: np.ndarray, counts: np.ndarray, kind) -> pa.Array:
    edges = np.concatenate([[0], np.cumsum(counts)])
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(values.astype(kind)))


def _profiles(src: DataFrame, window: int, gram: int) -> DataFrame:
    """(doc_id, h, n_words, digest of the words joined by spaces, seeds, unit hashes,
    places); a place is 256 * first window + windows."""
    schema = T.StructType([src.schema["doc_id"], T.StructField("h", T.LongType()), T.StructField("n_words", T.LongType()),
                           T.StructField("digest", T.StringType()), T.StructField("seed", T.ArrayType(T.LongType())),
                           T.StructField("unit", T.ArrayType(T.LongType())), T.StructField("place", T.ArrayType(T.LongType()))])

    def task(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            for low, high, texts in bpe.text_runs(batch.column("text")):
                hashes, counts = word_hashes(texts)
                doc, seed, unit, first, size = units(hashes, counts, window, gram)
                ordered = ids.slice(low, high - low)
                real = np.array(ordered.is_valid())[doc] if len(doc) else np.zeros(0, bool)
                per_doc = np.bincount(doc[real], minlength=len(texts))
                digests = [hashlib.sha256(b" ".join(t.encode().split())).hexdigest() for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [ordered, batch.column("h").slice(low, high - low), pa.array(counts, pa.int64()), pa.array(digests),
                     _lists(seed[real].view(np.int64), per_doc, np.int64), _lists(unit[real].view(np.int64), per_doc, np.int64),
                     _lists((first * 256 + size)[real], per_doc, np.int64)], names=schema.names)

    return src.select("doc_id", "h", "text").mapInArrow(task, schema)


def _opened(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the place, window) of every window of the places."""
    n = places & 255
    row = np.repeat(np.arange(len(places)), n)
    return row, (places >> 8)[row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)


def _flat(lists: pa.Array, *fields: str):
    """(edges, values) of a list column, or (edges, values of each field); null lists are empty."""
    edge = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))])
    flat = lists.flatten()
    return edge, *((flat.field(f).to_numpy(zero_copy_only=False) for f in fields) if fields else
                   [flat.to_numpy(zero_copy_only=False)])


def _window_rows(held: DataFrame, window: int) -> DataFrame:
    """(w1, w2, doc_id, h, at) of the windows in units that differ from others of their seed."""
    schema = T.StructType([T.StructField("w1", T.LongType()), T.StructField("w2", T.LongType()), held.schema["doc_id"],
                           T.StructField("h", T.LongType()), T.StructField("at", T.LongType())])

    def task(batches):
        for batch in batches:
            for low, high, texts in bpe.text_runs(batch.column("text")):
                unsure = batch.column("unsure").slice(low, high - low)
                hashes, counts = word_hashes(texts)
                edge, place = _flat(unsure)
                # a row that stands twice has its units twice
                doc, place = np.unique(np.stack([np.repeat(np.arange(len(texts)), np.diff(edge)), place]), axis=1)
                row, at = _opened(place)
                row = doc[row]
                start = (np.cumsum(counts) - counts)[row] + at
                w1 = Rolling(hashes, WORD_BASE).of(start, start + window)
                w2 = Rolling(_mixed(hashes ^ U(SECOND_BASE)), SECOND_BASE).of(start, start + window)
                for k in range(0, len(row), ROWS):
                    part = slice(k, k + ROWS)
                    take = pa.array(low + row[part])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(w1[part].view(np.int64)), pa.array(w2[part].view(np.int64)), batch.column("doc_id").take(take),
                         batch.column("h").take(take), pa.array(at[part], pa.int64())], names=schema.names)

    return held.filter("size(unsure) > 0").select(*KEY, "text", "unsure").mapInArrow(task, schema)


def _stretches(held: DataFrame, window: int) -> DataFrame:
    """(owner, doc_id, h, start, n_words, words): consecutive windows with one owner, cut to
    at most ``PIECE`` windows.  A document's own windows are reference text."""
    schema = T.StructType([T.StructField("owner", held.schema["doc_id"].dataType), held.schema["doc_id"],
                           T.StructField("h", T.LongType()), T.StructField("start", T.LongType()),
                           T.StructField("n_words", T.LongType()), T.StructField("words", T.StringType())])

    def task(batches):
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for low, high, texts in bpe.text_runs(batch.column("text")):
                part = batch.slice(low, high - low)
                ids, hs = part.column("doc_id").to_pylist(), part.column("h").to_pylist()
                sure_edge, place, sure_owner = _flat(part.column("sure"), "place", "owner")
                edge, at, owner = _flat(part.column("windows"), "at", "owner")
                rows = []
                for i, text in enumerate(texts):
                    own = slice(sure_edge[i], sure_edge[i + 1])
                    row, where = _opened(place[own])
                    where = np.concatenate([where, at[edge[i]:edge[i + 1]]])
                    who = np.concatenate([sure_owner[own][row], owner[edge[i]:edge[i + 1]]])
                    if not len(where):
                        continue
                    where, first = np.unique(where, return_index=True)
                    who = who[first]
                    cut = np.flatnonzero(np.concatenate([[True], (np.diff(where) != 1) | (who[1:] != who[:-1])]))
                    words = text.encode().split()
                    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(where)]):
                        for c in range(a, b, PIECE):
                            start, stop = int(where[c]), int(where[min(b, c + PIECE) - 1]) + window
                            rows.append((who[c], ids[i], hs[i], start, stop - start, b" ".join(words[start:stop]).decode()))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), (
                        id_type, id_type, pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=schema.names)

    return held.select(*KEY, "text", "sure", "windows").mapInArrow(task, schema)


def _dealt(stretches: DataFrame, shard_words: int, chunk_words: int) -> DataFrame:
    """Stretches with (shard, chunk); references stand in every chunk of their shard."""
    reference = F.col("owner") == F.col("doc_id")
    total = stretches.filter(reference).agg(F.sum("n_words")).first()[0] or 0
    shards = -(-total // shard_words) or 1
    s = stretches.withColumn("shard", F.pmod(F.xxhash64("owner"), F.lit(shards)))
    chunks = materialize(s.filter(~reference).groupBy("shard").agg(F.ceil(F.sum("n_words") / chunk_words).alias("chunks")),
                         "automata-chunks").withColumnRenamed("shard", "_shard")
    s = s.join(chunks.hint("merge"), F.col("shard") == F.col("_shard")).drop("_shard")
    return s.select("shard", F.explode(F.when(reference, F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("doc_id", "h", "start"), F.col("chunks"))))).alias("chunk"),
        "owner", *KEY, "start", "words")


def _matched(dealt: DataFrame, window: int, automaton_words: int) -> DataFrame:
    """(doc_id, h, low, high): spans of words to remove, end exclusive."""
    schema = T.StructType([dealt.schema["doc_id"], T.StructField("h", T.LongType()), T.StructField("low", T.LongType()),
                           T.StructField("high", T.LongType())])

    def spans(ends, start):
        low = high = None
        for e in ends:
            a, b = start + e - window + 1, start + e + 1
            if high is not None and a <= high:
                high = b
            else:
                if high is not None:
                    yield low, high
                low, high = a, b
        if high is not None:
            yield low, high

    def task(table):
        owner, doc, h, start = (table.column(n).to_pylist() for n in ("owner", "doc_id", "h", "start"))
        words = table.column("words")
        reference = [i for i in range(len(doc)) if owner[i] == doc[i]]
        stream = [i for i in range(len(doc)) if owner[i] != doc[i]]
        rows = []

        def run(automaton):
            automaton.close()
            for i in stream:
                ends = automaton.matches(words[i].as_py().split(" "), doc[i], window)
                rows.extend((doc[i], h[i], a, b) for a, b in spans(ends, start[i]))

        automaton, held = Automaton(), 0
        for i in reference if stream else []:
            text = words[i].as_py().split(" ")
            if held and held + len(text) > automaton_words:
                run(automaton)
                automaton, held = Automaton(), 0
            automaton.add(text, doc[i])
            held += len(text)
        if held:
            run(automaton)
        kinds = (table.schema.field("doc_id").type, pa.int64(), pa.int64(), pa.int64())
        cols = list(zip(*rows)) if rows else [[]] * 4
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=schema.names)

    return dealt.groupBy("shard", "chunk").applyInArrow(task, schema)


def _cleaned(held: DataFrame) -> DataFrame:
    """(doc_id, h, n_words, n_removed, spans, kept) of documents with spans."""
    span = T.ArrayType(T.StructType([T.StructField("low", T.LongType()), T.StructField("high", T.LongType())]))
    schema = T.StructType([held.schema["doc_id"], T.StructField("h", T.LongType()), T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("spans", span),
                           T.StructField("kept", T.StringType())])

    def task(batches):
        for batch in batches:
            found = batch.column("found").to_pylist()
            for low, high, texts in bpe.text_runs(batch.column("text")):
                n_words, n_removed, spans, kept = [], [], [], []
                for i, text in enumerate(texts, low):
                    words, merged = text.encode().split(), []
                    for a, b in sorted((x["low"], x["high"]) for x in found[i]):
                        if merged and a <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], b)
                        else:
                            merged.append([a, b])
                    rest, at = [], 0
                    for a, b in merged:
                        rest += words[at:a]
                        at = b
                    rest += words[at:]
                    n_words.append(len(words))
                    n_removed.append(len(words) - len(rest))
                    spans.append([{"low": a, "high": b} for a, b in merged])
                    kept.append(b" ".join(rest).decode())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).slice(low, high - low) for k in KEY] + [pa.array(n_words, pa.int64()), pa.array(
                        n_removed, pa.int64()), pa.array(spans, pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))),
                        pa.array(kept, pa.string())], names=schema.names)

    return held.select(*KEY, "text", "found").mapInArrow(task, schema)


def _joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Both on the row key; rows without an id have no part in it."""
    r = right.withColumnsRenamed({k: f"_{k}" for k in KEY})
    out = left.join(r.hint("merge"), (F.col("doc_id") == F.col("_doc_id")) & (F.col("h") == F.col("_h")), how)
    return out.drop("_doc_id", "_h")


def repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM,
            shard_words: int = 200_000, chunk_words: int = 1_000_000, automaton_words: int = 300_000) -> DataFrame:
    """One row per document: doc_id, h (xxhash64 of its text), n_words, n_removed, spans
    (of words, end exclusive), kept_sha256 (of the kept words joined by spaces) and kept,
    the kept text where words were removed (else null)."""
    src = _source(docs, id_col, text_col)
    profiles = store(_profiles(src, window, min(gram, window)), "automata-profiles")
    seeds = profiles.select(F.explode(F.arrays_zip("seed", "unit")).alias("x"), "doc_id").select("x.seed", "x.unit", "doc_id")
    shared = materialize(seeds.groupBy("seed").agg(
        F.min("doc_id").alias("owner"), F.max("doc_id").alias("top"), F.min("unit").alias("a"), F.max("unit").alias("b"))
        .filter("owner < top").select("seed", "owner", F.expr("a = b").alias("sure")), "automata-seeds")
    placed = profiles.select(F.explode(F.arrays_zip("seed", "place")).alias("x"), *KEY).select("x.seed", "x.place", *KEY)
    marks = placed.join(shared.hint("merge"), "seed").groupBy(*KEY).agg(
        F.collect_list(F.when(F.col("sure"), F.struct("place", "owner"))).alias("sure"),
        F.collect_list(F.when(~F.col("sure"), F.col("place"))).alias("unsure"))
    held = store(_joined(src, marks, "inner"), "automata-held")

    rows = store(_window_rows(held, window), "automata-windows")
    owned = materialize(rows.groupBy("w1", "w2").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("top"))
                        .filter("owner < top").drop("top"), "automata-owners")
    windows = rows.join(owned.hint("merge"), ["w1", "w2"]).groupBy(*KEY).agg(
        F.collect_list(F.struct("at", "owner")).alias("windows"))
    stretches = store(_stretches(_joined(held.drop("unsure"), windows, "left"), window), "automata-stretches")

    spans = _matched(_dealt(stretches, shard_words, chunk_words), window, automaton_words)
    found = materialize(spans.groupBy(*KEY).agg(F.collect_set(F.struct("low", "high")).alias("found")), "automata-spans")
    changed = _cleaned(_joined(held.select(*KEY, "text"), found, "inner"))
    span = "array<struct<low:bigint,high:bigint>>"
    whole = _joined(profiles, found.select(*KEY), "left_anti").select(
        *KEY, "n_words", F.lit(0).cast("bigint").alias("n_removed"), F.expr(f"cast(array() AS {span})").alias("spans"),
        F.col("digest").alias("kept_sha256"), F.lit(None).cast("string").alias("kept"))
    return changed.select(*KEY, "n_words", "n_removed", "spans", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
                          "kept").unionByName(whole)


def strip(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with repeated words taken out of the text; texts without any stay as they
    are.  All rows and columns stay."""
    cols = docs.columns
    gone = repeats(docs, id_col=id_col, text_col=text_col, **options).filter("n_removed > 0") \
        .select(*KEY, "kept").dropDuplicates(KEY)
    wide = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"), F.col(f"`{id_col}`").alias("doc_id"),
                       F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("h"))
    both = _joined(wide, gone, "left")
    return both.select(*[(F.coalesce("kept", F.col(f"row.`{c}`")) if c == text_col else F.col(f"row.`{c}`")).alias(c)
                         for c in cols])
