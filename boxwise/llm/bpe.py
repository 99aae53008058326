"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

A batch of texts becomes one array of code points.  A table gives each code
point its class; the look-ahead the pattern needs (the letters after an
apostrophe, the last character of a white-space run) is folded into the class.
A small automaton over these classes knows where a match begins.  Its
transition functions are closed under composition, so a class string is a
product in a finite monoid and all states come from an associative scan: blocks
are scanned side by side with one table look-up a character, block products are
scanned the same way.  The slices between boundaries feed pair merging, cached
per slice.  Every token's byte offset is kept, which lets a decoder place the
bytes of any token range without the tokens before it.

The pattern is the split pattern of the rank files:
``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``

Defined results: null or empty text has no token; any other text round-trips;
rows are encoded one by one, so repeated rows get equal ids; empty tables give
empty results; extra columns are not read.  A batch is worked on in runs of
about RUN_BYTES; one text is never split.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

RUN_BYTES = 1 << 20
CACHE_ENTRIES = 400_000           # cached slices per worker; a full cache starts anew
SENTINEL = 0x110000                # stands between two texts

# code point classes
END, LETTER, NUMBER, OTHER, QUOTE2, QUOTE3, JOIN, LAST, INNER = range(9)
# automaton states: what has just been read
START, IN_L, IN_N, IN_O, JOINED, IN_S, NEED1, NEED2 = range(8)

# The code points of the Unicode property White_Space.
WHITE_SPACE = [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F,
               0x3000]


def _automaton():
    """next state and "a match begins here", both by (state, class)."""
    step = np.zeros((8, 9), np.uint8)
    begin = np.ones((8, 9), bool)
    for s in range(8):
        step[s] = [START, IN_L, IN_N, IN_O, NEED1, NEED2, JOINED, START, IN_S]
    for c, own in ((LETTER, IN_L), (NUMBER, IN_N), (OTHER, IN_O)):
        begin[own, c] = begin[JOINED, c] = False
    for c in (QUOTE2, QUOTE3):              # inside a run of other characters it is one of them
        for s in (IN_O, JOINED):
            step[s, c], begin[s, c] = IN_O, False
    begin[IN_S, INNER] = False
    step[NEED2, LETTER], step[NEED1, LETTER] = NEED1, START
    begin[NEED2, LETTER] = begin[NEED1, LETTER] = False
    return step, begin


@lru_cache(maxsize=1)
def _monoid():
    return monoid(*_automaton())


def monoid(step: np.ndarray, begin: np.ndarray):
    """(element of each class, composition table, action on states, begin table)."""
    states, n_classes = step.shape
    elements = {tuple(range(states)): 0}
    gens = [tuple(int(x) for x in step[:, c]) for c in range(n_classes)]
    queue = list(elements)
    while queue:
        f = queue.pop()
        for g in gens:
            h = tuple(g[x] for x in f)
            if h not in elements:
                elements[h] = len(elements)
                queue.append(h)
    act = np.array(list(elements), np.uint8)
    m = len(act)
    table = np.empty((m, m), np.uint16)
    for i in range(m):
        composed = act[:, act[i]]            # row j: element i first, then element j
        table[i] = [elements[tuple(int(x) for x in row)] for row in composed]
    of_class = np.array([elements[g] for g in gens], np.uint16)
    return of_class, table, act, begin


def begins_at(c: np.ndarray, of_class, table, act, begin) -> np.ndarray:
    """Whether a match begins at each of the classes ``c``: by the product before it and its class."""
    by_product = np.ascontiguousarray(begin[act[:, START]]).ravel()
    return by_product.take(scan(of_class.take(c, mode="clip"), table) * np.uint16(begin.shape[1]) + c, mode="clip")


def scan(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Exclusive products of the monoid elements ``x`` (element 0 is the identity)."""
    n, m = len(x), len(table)
    flat = table.ravel()
    if n <= 64:
        out, acc = np.zeros(n, np.uint16), 0
        for i in range(n):
            out[i] = acc
            acc = table[acc, x[i]]
        return out
    width = 64
    blocks = -(-n // width)
    lanes = np.zeros(blocks * width, np.uint16)
    lanes[:n] = x
    lanes = np.ascontiguousarray(lanes.reshape(blocks, width).T)
    out = np.zeros((width + 1, blocks), np.uint16)
    at = np.empty(blocks, np.intp)
    for j in range(width):                                  # "clip": take without a buffer; all places exist
        np.multiply(out[j], m, out=at)
        at += lanes[j]
        np.take(flat, at, out=out[j + 1], mode="clip")
    before = scan(out[width], table)                       # product of all earlier blocks
    full = flat.take(before.astype(np.intp)[None, :] * m + out[:width], mode="clip")
    return np.ascontiguousarray(full.T).ravel()[:n]


@lru_cache(maxsize=1)
def _class_table() -> np.ndarray:
    import regex
    table = np.full(SENTINEL + 1, OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, SENTINEL)]))
    for pattern, c in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER)):
        for hit in regex.finditer(pattern, every):
            a, b = hit.span()
            table[a + (0x800 if a >= 0xD800 else 0):b + (0x800 if b > 0xD800 else 0)] = c
    table[WHITE_SPACE] = INNER
    table[SENTINEL] = END
    return table


def classes(cps: np.ndarray) -> np.ndarray:
    """Classes of a code point array that ends with SENTINEL."""
    c = _class_table().take(cps.astype(np.intp), mode="clip")
    space = c == INNER
    last = space[:-1] & ~space[1:] & (c[1:] != END)
    at = np.flatnonzero(last)
    c[at] = np.where(cps[at] == 0x20, JOIN, LAST)
    q = np.flatnonzero(cps[:-1] == 0x27)
    if len(q):
        a, b = cps[q + 1], cps[np.minimum(q + 2, len(cps) - 1)]
        two = np.isin(a, [ord(x) for x in "stmd"])
        three = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        c[q[two]] = QUOTE2
        c[q[three]] = QUOTE3
    return c


def byte_positions(cps: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Byte position of every code point in UTF-8, and the end."""
    size = np.ones(len(cps), np.uint8)
    for low in (0x80, 0x800, 0x10000):
        more = cps >= low
        if low > 0x80 and np.count_nonzero(more) == len(stops):
            break                                           # the sentinels only
        size += more
    size[stops] = 1
    at = np.zeros(len(cps) + 1, np.int64 if len(cps) >= 1 << 29 else np.int32)
    np.cumsum(size, out=at[1:])
    return at


def slices(texts: list[str]):
    """(bytes, begins, ends, number of slices per text): the matches of all texts
    as byte ranges of one buffer."""
    joined = "\n".join(texts) + "\n"
    cps = np.frombuffer(joined.encode("utf-32-le"), np.uint32).copy()
    stops = np.cumsum([len(t) + 1 for t in texts]) - 1
    cps[stops] = SENTINEL
    c = classes(cps)
    starts = begins_at(c, *_monoid())
    at = byte_positions(cps, stops)
    edges = np.flatnonzero(starts)                          # sentinels included: they end the last slice
    is_end = c[edges] == END
    begins = at[edges[:-1]][~is_end[:-1]]
    ends = at[edges[1:]][~is_end[:-1]]
    counts = np.diff(np.flatnonzero(is_end), prepend=-1) - 1
    return joined.encode(), begins, ends, counts


class SliceCache:
    """slice -> its ids, in flat arrays; a full cache starts anew.

    Slices of up to eight bytes, most of all, are gathered as 64-bit integers and
    looked up once for each distinct one of a run; longer ones as bytes."""

    def __init__(self, entries: int = CACHE_ENTRIES):
        self.entries = entries
        self.reset()

    def __len__(self) -> int:
        return len(self.ends) - 1

    def reset(self) -> None:
        self.short: dict[int, int] = {}
        self.long: dict[bytes, int] = {}
        self.ids, self.ends = array("I"), array("q", [0])

    def ids_of(self, pieces: list[bytes]):
        """The ids of each of some new slices."""
        raise NotImplementedError

    def _find(self, known: dict, keys: list, as_bytes) -> np.ndarray:
        got = np.fromiter(map(known.get, keys, repeat(-1)), np.int64, len(keys))
        missing = np.flatnonzero(got < 0)
        if len(missing):
            at = missing.tolist()
            new = list(dict.fromkeys([keys[i] for i in at]))
            for key, ids in zip(new, self.ids_of([as_bytes(k) for k in new])):
                known[key] = len(self.ends) - 1
                self.ids.extend(ids)
                self.ends.append(len(self.ids))
            got[missing] = [known[keys[i]] for i in at]
        return got

    def index(self, buf: bytes, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The cache index of every slice of ``buf``."""
        if len(self) > self.entries:
            self.reset()
        out, length = np.empty(len(begins), np.int64), ends - begins
        # zero bytes fill up short slices, so texts that hold some take the other way
        short = length <= 8 if b"\0" not in buf else np.zeros(len(begins), bool)
        at = np.flatnonzero(short)
        raw = np.frombuffer(buf + bytes(8), np.uint8)
        eight = np.lib.stride_tricks.as_strided(raw, (len(raw) - 7, 8), (1, 1))
        words = eight[begins[at]].view("<u8").ravel() & EIGHT[length[at]]
        distinct, inverse = np.unique(words, return_inverse=True)
        out[at] = self._find(self.short, distinct.tolist(), lambda k: k.to_bytes(8, "little").rstrip(b"\0"))[inverse]
        at = np.flatnonzero(~short)
        out[at] = self._find(self.long, [buf[a:b] for a, b in zip(begins[at].tolist(), ends[at].tolist())], bytes)
        return out

    def expand(self, index: np.ndarray):
        """(ids, number of ids per slice) of the slices ``index``."""
        flat, edges = np.array(self.ids, np.uint32), np.array(self.ends, np.int64)
        low, count = edges[index], edges[index + 1] - edges[index]
        stop = np.cumsum(count)
        where = np.repeat(low - (stop - count), count) + np.arange(stop[-1] if len(stop) else 0)
        return flat[where], count


#: Masks of the low 0 to 8 bytes.
EIGHT = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


class Merges(SliceCache):
    """Slices are merged by a rank file on first use."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks
        self.byte = [bytes([i]) for i in range(256)]
        self.vocab = [b""] * (max(ranks.values()) + 1)
        for k, v in ranks.items():
            self.vocab[v] = k
        self.lengths = np.array([len(v) for v in self.vocab], np.int64)

    def ids_of(self, pieces: list[bytes]):
        return map(self.merge, pieces)

    def merge(self, piece: bytes) -> list[int]:
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        if len(piece) > 200:
            return self._merge_long(piece)
        parts = [self.byte[b] for b in piece]
        get = ranks.get
        pair = [get(a + b, 1 << 30) for a, b in zip(parts, parts[1:])]
        while pair:
            best = min(pair)
            if best == 1 << 30:
                break
            i = pair.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pair[i]
            if i:
                pair[i - 1] = get(parts[i - 1] + parts[i], 1 << 30)
            if i < len(pair):
                pair[i] = get(parts[i] + parts[i + 1], 1 << 30)
        return [ranks[p] for p in parts]

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same merges with a heap: n log n for very long slices."""
        ranks, n = self.ranks, len(piece)
        end = list(range(1, n + 1))                         # end of the part that begins at i; 0: merged away
        prev = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            mid = end[i]
            if not mid or mid >= n or end[mid] != stop:
                continue
            end[i], end[mid] = stop, 0
            if stop < n:
                prev[stop] = i
                if (r := ranks.get(piece[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (p := prev[i]) >= 0 and (r := ranks.get(piece[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:end[i]]])
            i = end[i]
        return out


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


_LOADED: dict[str, Merges] = {}


def loaded(data: bytes) -> Merges:
    """One Merges per rank file and Python worker."""
    key = hashlib.sha256(data).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Merges(parse_ranks(data))
    return _LOADED[key]


def text_runs(column: pa.Array, size: int = RUN_BYTES):
    """(low, high, texts) of consecutive rows with about ``size`` bytes of text, so
    that only one run of a batch exists as Python strings at a time."""
    edges = np.concatenate([[0], np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))])
    low, n = 0, len(column)
    while low < n:
        high = min(n, max(low + 1, int(np.searchsorted(edges, edges[low] + size, side="right")) - 1))
        yield low, high, column.slice(low, high - low).to_pylist()
        low = high


def encode_texts(m: Merges, texts: list[str]):
    """(ids, byte offsets within the text, ids per text) of a run of texts."""
    buf, begins, ends, counts = slices(texts)
    ids, per_slice = m.expand(m.index(buf, begins, ends))
    edge = np.concatenate([[0], np.cumsum(per_slice)])
    per_text = np.diff(edge[np.concatenate([[0], np.cumsum(counts)])])
    length = m.lengths[ids]
    offset = np.cumsum(length) - length
    first = np.concatenate([[0], np.cumsum(per_text)])[:-1]
    bytes_before = np.concatenate([offset, [offset[-1] + length[-1] if len(offset) else 0]])[first]
    return ids, offset - np.repeat(bytes_before, per_text), per_text


def _binary(values: np.ndarray, counts: np.ndarray, width: int) -> pa.Array:
    edges = np.concatenate([[0], np.cumsum(counts)]) * width
    return pa.Array.from_buffers(pa.large_binary(), len(counts),
                                 [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(values.tobytes())])


def _small(a: pa.Array) -> pa.Array:
    return a.cast(pa.binary())


def encode(df: DataFrame, ranks: bytes, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, offsets): ids as little-endian unsigned 32-bit integers, offsets
    the byte position of each id in the text, in the same form.  ``ranks`` is the
    content of a rank file (about a megabyte, a fixed size)."""
    data = df.sparkSession.sparkContext.broadcast(ranks)
    src = df.selectExpr(f"`{id_col}` AS id", f"coalesce(`{text_col}`, '') AS text")

    def task(batches):
        m = loaded(data.value)
        for batch in batches:
            for low, high, texts in text_runs(batch.column("text")):
                ids, offsets, per_text = encode_texts(m, texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(low, high - low),
                     _small(_binary(ids.astype("<u4"), per_text, 4)),
                     _small(_binary(offsets.astype("<u4"), per_text, 4))], names=["id", "ids", "offsets"])

    schema = T.StructType([T.StructField("id", src.schema["id"].dataType), T.StructField("ids", T.BinaryType()),
                           T.StructField("offsets", T.BinaryType())])
    return src.mapInArrow(task, schema)


def decode_ids(m: Merges, ids: np.ndarray, offsets: np.ndarray) -> bytes:
    """Bytes of consecutive tokens; ``offsets`` place them, whatever came before."""
    if not len(ids):
        return b""
    out = b"".join(map(m.vocab.__getitem__, ids.tolist()))
    if len(out) != int(offsets[-1]) - int(offsets[0]) + len(m.vocab[ids[-1]]):
        raise ValueError("offsets do not fit the ids")
    return out


def decode(df: DataFrame, ranks: bytes) -> DataFrame:
    """Add ``decoded`` (bytes) to the rows of ``encode``."""
    data = df.sparkSession.sparkContext.broadcast(ranks)

    def task(batches):
        m = loaded(data.value)
        for batch in batches:
            out = [decode_ids(m, np.frombuffer(i.as_buffer(), "<u4"), np.frombuffer(o.as_buffer(), "<u4"))
                   for i, o in zip(batch.column("ids"), batch.column("offsets"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())],
                                             names=[*batch.schema.names, "decoded"])

    return df.mapInArrow(task, T.StructType([*df.schema.fields, T.StructField("decoded", T.BinaryType())]))
