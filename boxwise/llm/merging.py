"""Byte-pair merges of many slices side by side.

The distinct slices of a run of texts are found by scattering them into a table of hash
slots: of the slices of a slot the last one written stays, the others compare all their
bytes with it, and those that differ go on with other bits of the hash.  So equal
slices are grouped exactly, without sorting.  Slices of earlier runs are found by all
their bytes in an open-addressing table.

Distinct slices of similar length make a matrix of symbols.  A round finds every row's
pair of least rank (the leftmost of equals), merges it in all rows at once, closes the
gap and looks up the two new pairs in an open-addressing table; rows without a pair
to merge leave the matrix.  That is the library's order of merges, slice by slice.
"""

from __future__ import annotations

import json

import numpy as np

U = np.uint64
KIND = np.uint16                                      # of symbols and ranks: narrow rows are fast to shift
NONE = KIND(0xFFFF)                                  # no rank, no symbol
SLOT_BITS = 19                                       # of the pair table: 50,000 pairs fill a tenth
WIDTHS = (2, 4, 8, 12, 16, 24, 32, 64)               # columns of the matrices; longer slices are merged by the caller
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], U)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself
    where it is printable in Latin-1, else the next code point from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


class Merger:
    """Merges of a byte-level BPE vocabulary file."""

    def __init__(self, content: str):
        model = json.loads(content)["model"]
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        symbols = byte_symbols()
        if max(max(vocab.values()), len(model["merges"])) >= NONE:
            raise ValueError(f"more than {NONE} symbols or merges")
        self.inner = np.array([vocab[s] for s in symbols], KIND)
        self.final = np.array([vocab[s + suffix] for s in symbols], KIND)
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        left, right = (np.array([vocab[p[k]] for p in pairs], np.int64) for k in (0, 1))
        self.made = np.array([vocab[a + b] for a, b in pairs], KIND)
        self.keys = np.full(1 << SLOT_BITS, np.iinfo(np.int64).max, np.int64)
        self.rank = np.full(1 << SLOT_BITS, NONE, KIND)
        key, todo = (left << 32) | right, np.arange(len(pairs))
        slot = self._slot(key)
        while len(todo):                             # all pairs probe on until each has a slot of its own
            free = todo[self.rank[slot[todo]] == NONE]
            self.rank[slot[free]] = free             # of several the last one stays
            self.keys[slot[free]] = key[free]
            todo = todo[self.rank[slot[todo]] != todo]
            slot[todo] = (slot[todo] + 1) & ((1 << SLOT_BITS) - 1)
            # pairs stand once in a vocabulary, so a taken slot is another pair's

    @staticmethod
    def _slot(key: np.ndarray) -> np.ndarray:
        return ((key.astype(U) * U(FACTORS[0])) >> U(64 - SLOT_BITS)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NONE`` where there is none (also beside a missing symbol)."""
        key = (left.astype(np.int64) << 32) | right
        slot = self._slot(key)
        found = self.keys[slot]
        out = np.where(found == key, self.rank[slot], NONE)
        todo = np.flatnonzero((found != key) & (self.rank[slot] != NONE))
        while len(todo):                             # another pair's slot: the next one
            slot[todo] = (slot[todo] + 1) & ((1 << SLOT_BITS) - 1)
            at = slot[todo]
            hit = self.keys[at] == key[todo]
            out[todo[hit]] = self.rank[at[hit]]
            todo = todo[~hit & (self.rank[at] != NONE)]
        return out

    def matrix(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids) of rows of symbols, ``NONE`` behind their end; ids of a row at its left."""
        n, width = symbols.shape
        done = np.full((n, width), NONE, KIND)
        row, s = np.arange(n), symbols
        r = self.ranks(s[:, :-1].ravel(), s[:, 1:].ravel()).reshape(n, width - 1)
        cols = np.arange(width)
        while len(row):
            j = r.argmin(1)
            at = np.arange(len(row))
            best = r[at, j]
            over = best == NONE
            if over.any():
                done[row[over]] = s[over]
                keep = ~over
                row, s, r, j, best = row[keep], s[keep], r[keep], j[keep], best[keep]
                at = at[:len(row)]
                if not len(row):
                    break
            behind = cols[None, :-1] > j[:, None]
            s[at, j] = self.made[best]
            s[:, :-1] = np.where(behind, s[:, 1:], s[:, :-1])
            s[:, -1] = NONE
            if width > 2:
                r[:, :-1] = np.where(behind[:, :-1], r[:, 1:], r[:, :-1])
            r[:, -1] = NONE
            # the pairs on both sides of the merged symbol
            inside = j < width - 1
            r[at[inside], j[inside]] = self.ranks(s[at[inside], j[inside]], s[at[inside], j[inside] + 1])
            later = np.flatnonzero(j > 0)
            r[later, j[later] - 1] = self.ranks(s[later, j[later] - 1], s[later, j[later]])
        return done, (done != NONE).sum(1)

    def encode(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids per slice) of slices of 1 to ``WIDTHS[-1]`` bytes of ``data``."""
        length = ends - begins
        count = np.ones(len(begins), np.int64)
        parts = []                                   # (slices, ids side by side, counts)
        low = 1
        one = np.flatnonzero(length == 1)
        parts.append((one, self.final[data[begins[one]]], np.ones(len(one), np.int64)))
        for width in WIDTHS:
            some = np.flatnonzero((length > low) & (length <= width))
            low = width
            if not len(some):
                continue
            at = begins[some, None] + np.arange(width)
            held = np.arange(width) < length[some, None]
            raw = data[np.minimum(at, len(data) - 1)]
            symbols = np.where(held, self.inner[raw], NONE)
            symbols[np.arange(len(some)), length[some] - 1] = self.final[raw[np.arange(len(some)), length[some] - 1]]
            ids, n = self.matrix(symbols)
            count[some] = n
            parts.append((some, ids[ids != NONE], n))
        stop = np.cumsum(count)
        out = np.empty(int(stop[-1]) if len(stop) else 0, np.uint32)
        for some, ids, n in parts:
            where = np.repeat((stop - count)[some] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            out[where] = ids
        return out, count


class Keys:
    """Slices of at most 24 bytes of a buffer as three words, a length and a hash each."""

    def __init__(self, words: list[np.ndarray], length: np.ndarray, mix: np.ndarray):
        self.words, self.length, self.mix = words, length, mix

    @classmethod
    def of(cls, buf: bytes, begins: np.ndarray, ends: np.ndarray) -> "Keys":
        n, length = len(begins), ends - begins
        raw = np.frombuffer(buf + bytes(32), np.uint8)
        eight = np.lib.stride_tricks.as_strided(raw, (len(raw) - 7, 8), (1, 1))
        words = [eight[begins].view("<u8").ravel() & MASK[np.minimum(length, 8)]]
        for k in (8, 16):
            some = np.flatnonzero(length > k)
            w = np.zeros(n, U)
            w[some] = eight[begins[some] + k].view("<u8").ravel() & MASK[np.minimum(length[some] - k, 8)]
            words.append(w)
        mix = length.astype(U) * U(FACTORS[3])
        for w, f in zip(words, FACTORS):
            mix = (mix ^ w) * U(f)
            mix ^= mix >> U(29)
        return cls(words, length, mix)

    def __len__(self) -> int:
        return len(self.length)

    def take(self, at: np.ndarray) -> "Keys":
        return Keys([w[at] for w in self.words], self.length[at], self.mix[at])

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """(first of each group of equal slices, group of every slice)."""
        n = len(self)
        head, mix = np.empty(n, np.int64), self.mix.copy()
        todo, bits = np.arange(n), max(8, int(n).bit_length() + 1)
        table = np.empty(1 << bits, np.int64)
        while len(todo):
            slot = (mix[todo] >> U(64 - bits)).astype(np.int64)
            table[slot] = todo
            top = table[slot]
            same = self.length[todo] == self.length[top]
            for w in self.words:
                same &= w[todo] == w[top]
            head[todo[same]] = top[same]
            todo = todo[~same]
            mix[todo] *= U(FACTORS[1])               # other bits decide the next slot
            mix[todo] ^= mix[todo] >> U(31)
        first = np.flatnonzero(head == np.arange(n))
        number = np.empty(n, np.int64)
        number[first] = np.arange(len(first))
        return first, number[head]


def distinct(buf: bytes, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first of each group of equal slices, group of every slice) of slices of at most 24
    bytes of ``buf``."""
    return Keys.of(buf, begins, ends).distinct()


class Numbers:
    """Numbers of slices, kept in an open-addressing table that compares all their bytes."""

    def __init__(self, bits: int):
        self.bits, size = bits, 1 << bits
        self.words, self.length = [np.zeros(size, U) for _ in range(3)], np.zeros(size, np.uint8)
        self.number = np.full(size, -1, np.int32)

    def find(self, keys: Keys) -> np.ndarray:
        """The number of each slice, -1 where it has none."""
        out, todo = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        slot = (keys.mix >> U(64 - self.bits)).astype(np.int64)
        while len(todo):
            at = slot[todo]
            number = self.number[at]
            same = (number >= 0) & (self.length[at] == keys.length[todo])
            for w, own in zip(self.words, keys.words):
                same &= w[at] == own[todo]
            out[todo[same]] = number[same]
            todo = todo[~same & (number >= 0)]       # another slice's slot: the next one
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
        return out

    def add(self, keys: Keys, first: int) -> None:
        """Number distinct new slices from ``first`` on."""
        todo = np.arange(len(keys))
        slot = (keys.mix >> U(64 - self.bits)).astype(np.int64)
        while len(todo):
            free = todo[self.number[slot[todo]] < 0]
            self.number[slot[free]] = free + first   # of several the last one stays
            won = free[self.number[slot[free]] == free + first]
            for w, own in zip(self.words, keys.words):
                w[slot[won]] = own[won]
            self.length[slot[won]] = keys.length[won]
            todo = todo[self.number[slot[todo]] != todo + first]
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
