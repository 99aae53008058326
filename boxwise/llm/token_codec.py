"""Token-id files: an adaptive context-mixing range coder.

A block holds up to ``LANES * STEPS`` consecutive ids, cut into lanes of equal length
that are coded side by side in numpy: at each step one id of every lane, all lanes
sharing one model that learns after the step.  Blocks start with a fresh model and
carry checksums of their payload and of their ids, so each can be decoded alone.

Model: a hashed order-2 table and an order-1 table each predict the next id with a
confidence.  Each table's hit statistics, by confidence, give frequencies for the
three events "order-2 prediction", "order-1 prediction", "other"; the two estimates
are mixed with a weight that follows their success.  Other ids are coded by
adaptive order-0 frequencies.  All arithmetic is on integers, so every machine
decodes alike.  The range coder works on 48 bits and renormalises by 16.

File: blocks, then the index of documents (ids as text, token counts), then its
length.  Files are written for consecutive ranges of the document id in ascending
order; the start of a document is the number of ids before it over all files.

Defined results: null text counts as empty and has its end id alone; rows with
equal id follow in the order of a hash of their text; null ids come first; an empty table
gives no file and no row; extra columns are not read.
"""

from __future__ import annotations

import json
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxwise.llm import bpe, tokens
from boxwise.session import materialize, scratch_path
from boxwise.sources.fsutil import resolve

LANES, STEPS = 4096, 512
CONTEXTS = 1 << 18                 # entries of the order-2 table
EVENT_BITS = 12                    # events are coded in 4096ths
GAIN = 24                          # order-0 count of one occurrence
LEARN = 65_536                     # ids between two renewals of the order-0 frequencies
HEAD = struct.Struct("<4sIIIIIII")  # mark, ids, lanes, steps, alphabet, payload bytes, crc of payload, crc of ids
MARK, TAIL = b"TKB1", b"TKIX"
U = np.uint64
TOP, LOW32 = U(48), U(0xFFFFFFFF)
FLOOR, W16 = U(1 << 32), U(16)


class _Model:
    """What encoder and decoder both know before a step."""

    def __init__(self, alphabet: int, lanes: int, searched: bool = False):
        self.searched = searched                                   # whether ids are looked up by their frequency range
        # an entry is 8 * predicted id + confidence
        self.order1, self.order2 = np.zeros(alphabet, np.int32), np.zeros(CONTEXTS, np.int32)
        self.seen = np.ones((8, 2, 8, 3), np.int64)                # events by order-2 confidence, agreement, order-1 confidence
        self.weight = 1 << 15                                      # of the order-2 estimate, in 65536ths
        self.count = np.ones(alphabet, np.int64)
        self.fresh: list[np.ndarray] = []
        self.fresh_events: list[np.ndarray] = []
        self.held = self.total = 0
        self.prev = np.zeros(lanes, np.int64)
        self.hash = np.zeros(lanes, np.int64)
        self._renew()

    def _renew(self):
        """Frequencies from all counts so far."""
        if self.fresh:
            self.count += GAIN * np.bincount(np.concatenate(self.fresh), minlength=len(self.count))
            if self.count.sum() > 1 << 23:
                self.count = (self.count + 1) >> 1
            new = np.bincount(np.concatenate(self.fresh_events), minlength=384).reshape(self.seen.shape)
            # the weight moves to the share of the events that the order-2 estimate explains
            w = self.weight
            share = (w * self.by2 << 16) // (w * self.by2 + ((1 << 16) - w) * self.by1)
            self.weight = min(65_000, max(536, w + ((int((share * new).sum()) // max(1, int(new.sum())) - w) >> 1)))
            self.seen += new
            self.total += self.held
            self.fresh, self.fresh_events, self.held = [], [], 0
        size = (1 << EVENT_BITS) - 3
        n2, n1 = self.seen.sum((1, 2), keepdims=True), self.seen.sum(0, keepdims=True)
        self.by2 = 1 + n2 * size // n2.sum(-1, keepdims=True) + 0 * self.seen
        self.by1 = 1 + n1 * size // n1.sum(-1, keepdims=True) + 0 * self.seen
        mixed = np.maximum((self.weight * self.by2 + ((1 << 16) - self.weight) * self.by1) >> 16, 1).reshape(128, 3)
        self.first, self.second = mixed[:, 0].copy(), mixed[:, 0] + mixed[:, 1]
        self.freq = np.stack([self.first, mixed[:, 1], (1 << EVENT_BITS) - self.second], 1).ravel().astype(U)
        self.start = np.stack([0 * self.first, self.first, self.second], 1).ravel().astype(U)
        self.cum = np.zeros(len(self.count) + 1, np.int32)
        np.cumsum(self.count, out=self.cum[1:])
        self.count_u, self.cum_u = self.count.astype(U), self.cum.astype(U)
        if self.searched:
            # the id at the start of each of some 16,384 to 32,768 equal parts of the range
            self.part = max(0, int(self.cum[-1]).bit_length() - 15)
            behind = (self.cum[1:-1] + ((1 << self.part) - 1)) >> self.part
            self.jump = np.cumsum(np.bincount(behind, minlength=(int(self.cum[-1]) >> self.part) + 2), dtype=np.int32)

    def find(self, v: np.ndarray) -> np.ndarray:
        """The ids whose order-0 ranges hold ``v``: most are alone in their part of the
        range, the others are searched between the ids at its ends."""
        part = v >> self.part
        low, high = self.jump.take(part), self.jump.take(part + 1)
        todo = np.flatnonzero(low < high)
        while len(todo):
            a, b = low[todo], high[todo]
            mid = (a + b + 1) >> 1
            up = self.cum.take(mid) <= v[todo]
            low[todo], high[todo] = np.where(up, mid, a), np.where(up, b, mid - 1)
            todo = todo[low[todo] < high[todo]]
        return low

    def predict(self):
        """Both predictions and the context of the events, by lane."""
        self.v2, self.v1 = self.order2.take(self.hash), self.order1.take(self.prev)
        self.p2, self.p1 = self.v2 >> 3, self.v1 >> 3
        self.context = ((self.v2 & 7) << 4) + ((self.p1 == self.p2) << 3) + (self.v1 & 7)

    def learn(self, x: np.ndarray, event: np.ndarray, others: np.ndarray):
        """All lanes' ids and events of the step, and the ids no prediction had."""
        for table, key, v, p in ((self.order2, self.hash, self.v2, self.p2), (self.order1, self.prev, self.v1, self.p1)):
            c = v & 7
            # of lanes with equal keys the last one counts
            table[key] = np.where(p == x, v + (c < 7), np.where(c > 0, v - 1, x << 3))
        wide = x.astype(np.int64)
        self.hash = ((wide * 0x9E3779B1 + self.prev * 0x85EBCA6B) >> 9) & (CONTEXTS - 1)
        self.prev = wide
        self.fresh.append(others)
        self.fresh_events.append(self.context * 3 + event)
        self.held += len(x)
        if self.held >= min(LEARN, max(32, self.total >> 2)):
            self._renew()


def _shape(n: int) -> tuple[int, int]:
    lanes = max(1, min(LANES, -(-n // (STEPS // 4))))
    return lanes, -(-n // lanes)


def encode_block(ids: np.ndarray) -> bytes:
    """One block of at most LANES * STEPS ids."""
    n, alphabet = len(ids), int(ids.max()) + 1 if len(ids) else 1
    lanes, steps = _shape(n)
    grid = np.zeros(lanes * steps, np.int32)
    grid[:n] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    m = _Model(alphabet, lanes)
    low, size = np.zeros(lanes, U), np.full(lanes, (1 << 48) - 1, U)
    out, pos = np.zeros((lanes, 3 * steps + 6), np.uint16), np.zeros(lanes, np.int64)

    def carry(at):
        over = at[low[at] >> TOP != 0]
        if len(over):
            low[over] &= U((1 << 48) - 1)
            p = pos[over] - 1
            while len(over):
                out[over, p] += np.uint16(1)
                again = out[over, p] == 0
                over, p = over[again], p[again] - 1

    def shift():
        at = np.flatnonzero(size < FLOOR)
        while len(at):
            out[at, pos[at]] = low[at] >> U(32)
            pos[at] += 1
            low[at] = (low[at] & LOW32) << W16
            size[at] <<= W16
            at = at[size[at] < FLOOR]

    every = np.arange(lanes)
    for x in grid:
        m.predict()
        event = np.where(x == m.p2, 0, np.where(x == m.p1, 1, 2))
        at3 = m.context * 3 + event
        unit = size >> U(EVENT_BITS)
        low += unit * m.start.take(at3)
        size = unit * m.freq.take(at3)
        carry(every)
        shift()
        at = np.flatnonzero(event == 2)
        others = x[at]
        if len(at):
            unit = size[at] // U(m.cum[-1])
            low[at] += unit * m.cum_u.take(others)
            size[at] = unit * m.count_u.take(others)
            carry(at)
            shift()
        m.learn(x, event, others)
    for _ in range(3):
        out[every, pos] = low >> U(32)
        pos += 1
        low = (low & LOW32) << W16
    words = out[np.arange(out.shape[1])[None, :] < pos[:, None]]
    payload = pos.astype("<u2").tobytes() + words.astype("<u2").tobytes()
    return HEAD.pack(MARK, n, lanes, steps, alphabet, len(payload), zlib.crc32(payload),
                     zlib.crc32(ids.astype("<u4").tobytes())) + payload


def decode_block(data: bytes) -> np.ndarray:
    """The ids of one block; ValueError if a checksum does not fit."""
    mark, n, lanes, steps, alphabet, size_bytes, crc_payload, crc_ids = HEAD.unpack_from(data)
    payload = data[HEAD.size:HEAD.size + size_bytes]
    if mark != MARK or len(payload) != size_bytes or zlib.crc32(payload) != crc_payload:
        raise ValueError("damaged block")
    count = np.frombuffer(payload, "<u2", lanes).astype(np.int64)
    words = np.concatenate([np.frombuffer(payload, "<u2", offset=2 * lanes), np.zeros(4, "<u2")]).astype(U)
    at_word = np.cumsum(count) - count
    m = _Model(alphabet, lanes, searched=True)
    size = np.full(lanes, (1 << 48) - 1, U)
    code = (words[at_word] << U(32)) | (words[at_word + 1] << W16) | words[at_word + 2]
    at_word += 3
    out = np.zeros((steps, lanes), np.int32)

    def shift():
        at = np.flatnonzero(size < FLOOR)
        while len(at):
            code[at] = (code[at] << W16) | words[at_word[at]]
            at_word[at] += 1
            size[at] <<= W16
            at = at[size[at] < FLOOR]

    for t in range(steps):
        m.predict()
        unit = size >> U(EVENT_BITS)
        # exact: both numbers have under 53 bits, and the quotient's distance to the
        # next integer is at least 2^-36 where doubles are 2^-41 apart
        v = np.minimum((code.astype(np.float64) / unit.astype(np.float64)).astype(np.int64), (1 << EVENT_BITS) - 1)
        event = (v >= m.first.take(m.context)).astype(np.int64) + (v >= m.second.take(m.context))
        at3 = m.context * 3 + event
        code -= unit * m.start.take(at3)
        size = unit * m.freq.take(at3)
        shift()
        x = np.where(event == 0, m.p2, m.p1)
        at = np.flatnonzero(event == 2)
        others = x[at]
        if len(at):
            total = int(m.cum[-1])
            unit = size[at] // U(total)
            v = np.minimum(code[at] // unit, U(total - 1)).astype(np.int32)
            others = m.find(v)
            x[at] = others
            code[at] -= unit * m.cum_u.take(others)
            size[at] = unit * m.count_u.take(others)
            shift()
        out[t] = x
        m.learn(x, event, others)
    ids = np.ascontiguousarray(out.T).ravel()[:n].astype(np.uint32)
    if zlib.crc32(ids.astype("<u4").tobytes()) != crc_ids:
        raise ValueError("damaged block: ids do not fit their checksum")
    return ids


class FileWriter:
    """Blocks as they fill, the document index at the end."""

    def __init__(self, stream):
        self.stream, self.held, self.size = stream, [], 0
        self.names, self.counts, self.n_bytes = [], [], 0

    def put(self, names: list, ids: np.ndarray, per_text: np.ndarray) -> None:
        self.names += names
        self.counts += per_text.tolist()
        self.held.append(ids)
        self.size += len(ids)
        if self.size >= LANES * STEPS:
            self._flush(False)

    def _flush(self, all_of_it: bool) -> None:
        ids, low = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32), 0
        while len(ids) - low >= LANES * STEPS or all_of_it and low < len(ids):
            block = encode_block(ids[low:low + LANES * STEPS])
            self.stream.write(block)
            self.n_bytes += len(block)
            low = min(len(ids), low + LANES * STEPS)
        self.held, self.size = [ids[low:]], len(ids) - low

    def close(self) -> None:
        self._flush(True)
        index = zlib.compress(json.dumps([self.names, self.counts]).encode(), 1)
        self.stream.write(index + struct.pack("<4sII", TAIL, len(index), zlib.crc32(index)))
        self.n_bytes += len(index) + 12
        self.stream.close()


def read_file(f, size: int):
    """(name, ids) of every document of an open file, in order; one block at a time."""
    f.seek(size - 12)
    mark, length, crc = struct.unpack("<4sII", f.read(12))
    f.seek(size - 12 - length)
    index = f.read(length)
    if mark != TAIL or zlib.crc32(index) != crc:
        raise ValueError("damaged index")
    names, counts = json.loads(zlib.decompress(index))
    f.seek(0)
    end, rest = size - 12 - length, np.zeros(0, np.uint32)
    for name, n in zip(names, counts):
        parts, have = [rest], len(rest)
        while have < n:
            if f.tell() >= end:
                raise ValueError("blocks end before the documents")
            head = f.read(HEAD.size)
            got = decode_block(head + f.read(HEAD.unpack(head)[5]))
            parts.append(got)
            have += len(got)
        every = np.concatenate(parts) if len(parts) > 1 else rest
        yield name, every[:n]
        rest = every[n:]


def write(docs: DataFrame, vocabulary: str, *, end_id: int, root: str | None = None, id_col: str = "doc_id",
          text_col: str = "text", files: int | None = None) -> DataFrame:
    """Tokenise and write the files below ``root`` now; returns the stored report
    (part, path, n_bytes, n_docs, n_tokens, start) of the files that count."""
    spark = docs.sparkSession
    root = root or scratch_path(spark, "token-files")
    shared = spark.sparkContext.broadcast(vocabulary)
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    files = files or max(src.rdd.getNumPartitions(), 1)
    # a hash of the text is the second key, so that rows with equal id can be split
    keys = [F.asc_nulls_first("doc_id"), F.xxhash64("text")]
    ranged = (src.repartitionByRange(files, *keys).sortWithinPartitions(*keys, "text").select(F.col("doc_id").cast("string").alias("name"), "text"))

    def task(batches):
        from pyspark import TaskContext
        ctx, lib, out, n = TaskContext.get(), tokens.loaded(shared.value), None, 0
        for batch in batches:
            names = batch.column("name").to_pylist()
            for low, high, texts in bpe.text_runs(batch.column("text")):
                if out is None:
                    fs, base = resolve(root)
                    fs.create_dir(base, recursive=True)
                    path = f"{base}/part-{ctx.partitionId():06d}-{ctx.taskAttemptId()}.tok"
                    out = FileWriter(fs.open_output_stream(path, compression=None))
                ids, per_text = tokens.append_end(*lib.encode(texts), end_id)
                out.put(names[low:high], ids, per_text)
                n += len(ids)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"part": [ctx.partitionId()], "path": [path], "n_bytes": [out.n_bytes],
                                              "n_docs": [len(out.names)], "n_tokens": [n]}, schema=report)

    report = pa.schema([("part", pa.int32()), ("path", pa.string()), ("n_bytes", pa.int64()), ("n_docs", pa.int64()),
                        ("n_tokens", pa.int64())])
    done = materialize(ranged.mapInArrow(task, "part int, path string, n_bytes bigint, n_docs bigint, n_tokens bigint"),
                       "token-report")
    # one row per file: the running sum needs no more than one task
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return materialize(done.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))), "token-manifest")


def read(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """(name, start, n_tokens, ids) of every document in the files of ``manifest``;
    name is the document id as text, ids little-endian unsigned 32-bit integers."""
    names = ["name", "start", "n_tokens", "ids"]

    def task(batches):
        import pandas as pd
        for pdf in batches:
            for path, n_bytes, start in zip(pdf["path"], pdf["n_bytes"], pdf["start"]):
                fs, local = resolve(path)
                rows, held, at = [], 0, int(start)
                with fs.open_input_file(local) as f:
                    for name, ids in read_file(f, int(n_bytes)):
                        rows.append((name, at, len(ids), ids.astype("<u4").tobytes()))
                        at, held = at + len(ids), held + len(ids)
                        if held > 1 << 21:
                            yield pd.DataFrame(rows, columns=names)
                            rows, held = [], 0
                yield pd.DataFrame(rows, columns=names)

    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("start", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])
    files = max(1, manifest.count())                     # a task per file; no coalescing of the few rows
    return manifest.select("path", "n_bytes", "start").repartition(files).mapInPandas(task, schema)
