"""Ids of the tokenizers library, with equal slices merged once.

The library's vocabularies split a text by a pattern before their merges, so the
ids of a text are those of its slices in order.  Slices come from the vectorised
pre-tokenisation of ``bpe``; the distinct new slices of a run of texts are merged side by
side in numpy, in the library's order of merges, and kept.  A text whose normalisation could reach across
slices or differ from Python's (not in NFC, a capital dotted I, unassigned code points)
goes through the library whole.
"""

from __future__ import annotations

import hashlib
import os
import unicodedata
from array import array
from functools import lru_cache

import numpy as np

from boxwise.llm import bpe, merging

CACHE_BITS = 20                    # of the table of kept slices in a worker, about 30 MB
CACHE_ENTRIES = 400_000

# classes and states of the word vocabulary's pattern:
# 's|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+ on lower-cased text
END, LETTER, NUMBER, OTHER, QUOTE2, QUOTE3, SPACE = range(7)
START, IN_L, IN_O, IN_S, NEED1, NEED2 = range(6)


def _word_automaton():
    step = np.zeros((6, 7), np.uint8)
    begin = np.ones((6, 7), bool)
    for s in range(6):
        step[s] = [START, IN_L, START, IN_O, NEED1, NEED2, IN_S]
    begin[IN_L, LETTER] = begin[IN_O, OTHER] = begin[IN_S, SPACE] = False
    for c in (QUOTE2, QUOTE3):
        step[IN_O, c], begin[IN_O, c] = IN_O, False
    step[NEED2, LETTER], step[NEED1, LETTER] = NEED1, START
    begin[NEED2, LETTER] = begin[NEED1, LETTER] = False
    return step, begin


_WORD: list = []


@lru_cache(maxsize=1)
def _word_classes() -> np.ndarray:
    """The class of every code point; lower case doesn't change it."""
    table = bpe._class_table().copy()
    table[table == bpe.INNER] = SPACE
    return table


@lru_cache(maxsize=1)
def _lower_case() -> tuple[np.ndarray, np.ndarray]:
    """(lower case of every code point, whether it may differ in the library: capital dotted I,
    whose lower case is two code points, and code points that Python's tables don't assign)."""
    lower, unsure = np.arange(bpe.SENTINEL + 1, dtype=np.uint32), np.zeros(bpe.SENTINEL + 1, bool)
    # the planes above hold no letters with case
    known = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x20000)])
    every = [chr(c) for c in known.tolist()]
    unsure[known[np.array([unicodedata.category(c) == "Cn" for c in every])]] = True
    unsure[0x130] = True
    every[0x130] = "i"
    # each on a line of its own, so that no letter's lower case depends on its neighbours
    lower[known] = np.frombuffer("\n".join(every).lower().encode("utf-32-le"), np.uint32)[::2]
    return lower, unsure


def _code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points with a SENTINEL behind each text, places of these)."""
    cps = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le"), np.uint32).copy()
    stops = np.cumsum([len(t) + 1 for t in texts]) - 1
    cps[stops] = bpe.SENTINEL
    return cps, stops


def odd_texts(texts: list[str]) -> list[int]:
    """Texts whose normalisation is left to the library."""
    cps, stops = _code_points(texts)
    unsure = np.unique(np.searchsorted(stops, np.flatnonzero(_lower_case()[1].take(cps.astype(np.intp), mode="clip"))))
    return sorted({*unsure.tolist(), *(i for i, t in enumerate(texts) if not unicodedata.is_normalized("NFC", t))})


def word_slices(texts: list[str]):
    """As ``bpe.slices``, for the word vocabulary; white space is dropped and letters are
    lower-cased."""
    if not _WORD:
        _WORD.append(bpe.monoid(*_word_automaton()))
    cps, stops = _code_points(texts)
    at = cps.astype(np.intp)
    cps, c = _lower_case()[0].take(at, mode="clip"), _word_classes().take(at, mode="clip")
    q = np.flatnonzero(cps[:-1] == 0x27)
    if len(q):
        a, b = cps[q + 1] | 0x20, cps[np.minimum(q + 2, len(cps) - 1)] | 0x20
        a[cps[q + 1] > 0x7F] = b[cps[np.minimum(q + 2, len(cps) - 1)] > 0x7F] = 0
        two = np.isin(a, [ord(x) for x in "stmd"])
        three = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        c[q[two]], c[q[three]] = QUOTE2, QUOTE3
    starts = bpe.begins_at(c, *_WORD[0])
    at = bpe.byte_positions(cps, stops)
    edges = np.flatnonzero(starts)
    kind = c[edges]
    real = (kind != END) & (kind != SPACE)
    text_of = np.cumsum(kind == END) - (kind == END)
    counts = np.bincount(text_of[real], minlength=len(texts))
    keep = np.flatnonzero(real)
    cps[stops] = 0x0A
    return cps.tobytes().decode("utf-32-le").encode(), at[edges[keep]], at[edges[keep + 1]], counts


class Library:
    """A vocabulary file of the tokenizers library.

    The new ones of a run's distinct slices are merged side by side (``merging``) and kept for
    later runs; a full cache starts anew.  Slices of many bytes go through the library."""

    def __init__(self, content: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.encode_special_tokens = True
        self.lower = self.tokenizer.normalizer is not None
        self.slices = word_slices if self.lower else bpe.slices
        self.merger = merging.Merger(content)
        self.forget()

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def merged(self, buf: bytes, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids per slice) of slices of ``buf``."""
        if len(self.ends) > CACHE_ENTRIES:
            self.forget()
        length = ends - begins
        short, long = np.flatnonzero(length <= 24), np.flatnonzero(length > 24)
        index = np.empty(len(begins), np.int64)
        keys = merging.Keys.of(buf, begins[short], ends[short])
        first, group = keys.distinct()
        keys = keys.take(first)
        number = self.numbers.find(keys)
        new = np.flatnonzero(number < 0)
        if len(new):
            at, known = short[first[new]], len(self.ends) - 1
            self.numbers.add(keys.take(new), known)
            number[new] = np.arange(known, known + len(new))
            self._keep(*self.merger.encode(np.frombuffer(buf, np.uint8), begins[at], ends[at]))
        index[short] = number[group]
        if len(long):
            index[long] = self._long([buf[a:b] for a, b in zip(begins[long].tolist(), ends[long].tolist())])
        flat, edge = np.frombuffer(self.ids, np.uint32), np.frombuffer(self.ends, np.int64)
        low = edge[index]
        per_slice = edge[index + 1] - low
        stop = np.cumsum(per_slice)
        where = np.repeat(low - (stop - per_slice), per_slice) + np.arange(int(stop[-1]) if len(stop) else 0)
        return flat[where], per_slice

    def forget(self) -> None:
        self.numbers, self.known = merging.Numbers(CACHE_BITS), {}
        self.ids, self.ends = array("I"), array("q", [0])

    def _long(self, keys: list[bytes]) -> list[int]:
        """Numbers of slices of more than 24 bytes; the library encodes new ones."""
        new = [k for k in dict.fromkeys(keys) if k not in self.known]
        for low in range(0, len(new), 20_000):
            part = new[low:low + 20_000]
            first = len(self.ends) - 1
            self.known.update(zip(part, range(first, first + len(part))))
            got = self.whole([k.decode() for k in part])
            self._keep(np.concatenate([np.array(x, np.uint32) for x in got]), np.array([len(x) for x in got]))
        return [self.known[k] for k in keys]

    def _keep(self, ids: np.ndarray, count: np.ndarray) -> None:
        self.ends.frombytes((self.ends[-1] + np.cumsum(count)).astype(np.int64).tobytes())
        self.ids.frombytes(ids.astype(np.uint32).tobytes())

    def encode(self, texts: list[str]):
        """(ids of all texts, number of ids per text)."""
        odd = odd_texts(texts) if self.lower else []
        plain = texts
        if odd:
            plain = list(texts)
            for i in odd:
                plain[i] = ""
        buf, begins, ends, counts = self.slices(plain)
        ids, per_slice = self.merged(buf, begins, ends)
        edge = np.concatenate([[0], np.cumsum(per_slice)])
        per_text = np.diff(edge[np.concatenate([[0], np.cumsum(counts)])])
        if odd:
            parts = np.split(ids, np.cumsum(per_text)[:-1])
            for i, got in zip(odd, self.whole([texts[i] for i in odd])):
                parts[i] = np.array(got, np.uint32)
            ids, per_text = np.concatenate(parts), np.array([len(p) for p in parts])
        return ids, per_text


_LOADED: dict[str, Library] = {}


def loaded(content: str) -> Library:
    """One Library per vocabulary and Python worker."""
    key = hashlib.sha256(content.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Library(content)
    return _LOADED[key]


def append_end(ids: np.ndarray, per_text: np.ndarray, end_id: int):
    """``end_id`` behind the ids of every text."""
    out = np.full(len(ids) + len(per_text), end_id, np.uint32)
    body = np.ones(len(out), bool)
    body[np.cumsum(per_text + 1) - 1] = False
    out[body] = ids
    return out, per_text + 1
