"""WARC writing and a splittable reader.

Writer: payloads are grouped by SHA-256 and length (a map-side combined
aggregation); of equal payloads of ``min_revisit`` bytes or more, the one with the
largest id is the response and the others revisit it.  Each task writes gzip
members, one record each, to archives of its own in the shared folder.  A file
name carries the task attempt; the stored report of the finished tasks names the
files that count, so a lost or repeated attempt leaves nothing behind that is read.

Reader: archives are cut into byte ranges.  A task looks for the gzip magic in
its range, validates a candidate by decoding its first bytes and their WARC
version line, and owns the records that start inside the range, reading past its
end to finish the last one.  Archives of others are read too (any ``WARC/1.x``); what is
no whole member is reported as a row, not skipped.

Defined results: null payload counts as empty; rows with equal id and payload are
written one record each, and of rows with the largest id one is the response; a
null id is written as an empty id and reads back as null; empty tables give no
archives and no records; a very long payload is one member, written and read whole
by one task, other members in pieces of a megabyte; extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxwise.session import materialize, scratch_path
from boxwise.sources.fsutil import resolve

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/"
DAMAGED = "damaged"                  # record_type of bytes that are no whole member
DATE = "2000-01-01T00:00:00Z"       # pages carry no date of capture; equal input gives equal archives
PEEK = 1 << 12


def mark_revisits(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  min_revisit: int = 1000) -> DataFrame:
    """(id, url, payload, refers_to): refers_to is the response's id for revisits."""
    p = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"),
                     F.coalesce(F.col(f"`{payload_col}`"), F.lit("")).alias("payload"))
    p = p.withColumns({"n": F.octet_length("payload"), "digest": F.sha2(F.col("payload").cast("binary"), 256)})
    groups = materialize(p.filter(F.col("n") >= min_revisit).groupBy("digest", "n")
                         .agg(F.max("id").alias("response"), F.count("*").alias("c")).filter("c > 1")
                         .drop("c"), "warc-groups")
    # only digests that occur twice or more are joined; AQE splits a hot one
    p = p.join(groups.hint("merge"), ["digest", "n"], "left")
    return p.select("id", "url", "payload", F.when(~F.col("id").eqNullSafe(F.col("response")),
                                                   F.col("response")).alias("refers_to"))


def _urn(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record(page_id, url, payload: bytes, refers_to) -> bytes:
    """One WARC record: an HTTP response, or a revisit with its HTTP head only."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    revisit = refers_to is not None
    block = head if revisit else head + payload
    uri = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(page_id)}",
             f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{digest}",
             f"X-Page-Id: {'' if page_id is None else page_id}", f"X-Payload-Length: {len(payload)}"]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: {_urn(refers_to)}", f"X-Refers-To-Page-Id: {refers_to}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 1) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def write(marked: DataFrame, root: str, *, max_bytes: int = 1 << 30, level: int = 1) -> DataFrame:
    """Write the archives below ``root`` now; returns the stored report
    (path, n_bytes, n_records) of the files that count."""

    def task(batches):
        from pyspark import TaskContext
        ctx = TaskContext.get()
        fs, base = resolve(root)
        fs.create_dir(base, recursive=True)
        name = f"{ctx.partitionId():06d}-{ctx.taskAttemptId()}"
        out, part, size, count, done = None, 0, 0, 0, []
        for pdf in batches:
            for page_id, url, payload, refers in zip(pdf["id"], pdf["url"], pdf["payload"], pdf["refers_to"]):
                if out is None:
                    path, size, count = f"{base}/{name}-{part:04d}.warc.gz", 0, 0
                    out = fs.open_output_stream(path, compression=None)
                data = gzip_member(record(_plain(page_id), url, payload.encode(), _plain(refers)), level)
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= max_bytes:
                    out.close()
                    done.append((path, size, count))
                    out, part = None, part + 1
        if out is not None:
            out.close()
            done.append((path, size, count))
        import pandas as pd
        yield pd.DataFrame(done, columns=["path", "n_bytes", "n_records"])

    rows = marked.select(F.col("id").cast("string").alias("id"), "url", "payload",
                         F.col("refers_to").cast("string").alias("refers_to"))
    report = rows.mapInPandas(task, "path string, n_bytes bigint, n_records bigint")
    return materialize(report, "warc-report")


def _plain(v):
    return None if v is None or v != v else v


class _Window:
    """Bytes of a file from ``start`` on, read in chunks as they are asked for."""

    def __init__(self, f, start: int, size: int, chunk: int = 1 << 20):
        self.f, self.at, self.size, self.chunk = f, start, size, chunk
        self.buf = b""
        f.seek(start)

    def fill(self, n: int) -> None:
        while len(self.buf) < n and self.at + len(self.buf) < self.size:
            got = self.f.read(max(self.chunk, n - len(self.buf)))
            if not got:
                break
            self.buf += got

    def skip(self, n: int) -> None:
        self.buf = self.buf[n:]
        self.at += n


def _starts_record(head: bytes) -> bool:
    try:
        return zlib.decompressobj(31).decompress(head, 64).startswith(VERSION)
    except zlib.error:
        return False


def _member(w: _Window):
    """(data, length) of the gzip member at the window's start; the data is None
    if it does not decode to its end with a right checksum."""
    z, out, used = zlib.decompressobj(31), [], 0
    try:
        while True:
            w.fill(used + 1)
            piece = w.buf[used:used + w.chunk]
            if not piece:
                return None, 0
            out.append(z.decompress(piece))
            used += len(piece) - len(z.unused_data)
            if z.eof:
                return b"".join(out), used
    except zlib.error:
        return None, 0


def scan_range(f, size: int, start: int, stop: int):
    """(position, data) of the members that start in [start, stop) of an open archive.  Where a
    member must begin and none does, and for a record that does not decode to its end,
    data is None: every gap between members belongs to the range in which the member
    before it began."""
    w = _Window(f, start, size)
    due = start == 0                                         # a member must begin right here
    while due or w.at < stop:
        w.fill(PEEK)
        if not w.buf:
            return
        record = w.buf.startswith(MAGIC) and _starts_record(w.buf[:PEEK])
        if record:
            if w.at >= stop:
                return
            data, used = _member(w)
            if data is not None:
                yield w.at, data
                w.skip(used)
                due = True
                continue
        if due or record:
            yield w.at, None
        due = False
        i = w.buf.find(MAGIC, 1)
        # a magic may straddle the buffer's end
        w.skip(i if i > 0 else max(1, len(w.buf) - len(MAGIC) + 1))


def read_range(f, size: int, start: int, stop: int):
    """Decoded members that start in [start, stop) of an open archive."""
    return (data for _, data in scan_range(f, size, start, stop) if data is not None)


def parse(data: bytes) -> dict:
    """Headers (lower-case names), block and payload of one decoded record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = {}
    for line in head.split(b"\r\n")[1:]:
        k, _, v = line.decode("utf-8", "replace").partition(":")
        headers[k.strip().lower()] = v.strip()
    block = rest[:int(headers["content-length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    return {"headers": headers, "block": block, "payload": payload}


RECORD = T.StructType([
    T.StructField("page_id", T.StringType()), T.StructField("url", T.StringType()),
    T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.StringType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("payload", T.BinaryType())])


def row_of(data: bytes, where: str) -> tuple:
    """The row of one decoded record.  Headers that only ``write`` gives (page ids, payload
    length) are null in archives of others; a digest that is missing or not SHA-1 is
    computed.  Raises where a payload does not fit its SHA-1 digest."""
    r = parse(data)
    h, kind = r["headers"], r["headers"].get("warc-type")
    if kind not in ("response", "revisit", "resource"):
        return h.get("x-page-id") or None, h.get("warc-target-uri"), kind, None, None, None, None
    # a resource's block is its payload; a response's payload follows the HTTP head
    payload = r["block"] if kind == "resource" else r["payload"]
    name, _, value = h.get("warc-payload-digest", "").partition(":")
    digest = _sha1(value) if name.lower() == "sha1" else None
    length = int(h["x-payload-length"]) if "x-payload-length" in h else None if kind == "revisit" else len(payload)
    if kind != "revisit":
        own = hashlib.sha1(payload).hexdigest()
        if len(payload) != length or digest not in (None, own):
            raise ValueError(f"record {h.get('warc-record-id')} of {where}: payload does not fit its digest")
        digest = own
    return (h.get("x-page-id") or None, h.get("warc-target-uri"), kind, h.get("x-refers-to-page-id"), length, digest,
            None if kind == "revisit" else payload)


def _sha1(value: str) -> str | None:
    """Lower-case hex of a SHA-1 digest in base 32 or hex."""
    try:
        raw = bytes.fromhex(value) if len(value) == 40 else base64.b32decode(value.upper())
    except ValueError:
        return None
    return raw.hex() if len(raw) == 20 else None


def read(spark: SparkSession, files: DataFrame, *, range_bytes: int = 32 << 20, with_payload: bool = True) -> DataFrame:
    """A row per record of the archives in ``files`` (path, n_bytes).  Responses are checked
    against their digest and length; for a revisit both come from its headers.  Other
    record types (warcinfo, request, ...) have their type and no payload; bytes that are no
    whole member are a row of type ``DAMAGED``, so nothing is passed over without a word."""
    cuts = files.agg(F.sum(F.ceil(F.col("n_bytes") / range_bytes))).first()[0] or 1
    ranges = (files.select("path", "n_bytes", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.greatest(F.col("n_bytes") - 1, F.lit(0)), F.lit(range_bytes).cast("bigint"))).alias("start"))
        .repartition(int(min(cuts, 100_000))))               # the few rows would else be coalesced into one task

    def task(batches):
        import pandas as pd
        names = [f.name for f in RECORD.fields]

        def frame(rows):
            # whole numbers with gaps stay whole
            return pd.DataFrame(rows, columns=names).astype({"payload_bytes": "Int64"})

        for pdf in batches:
            for path, n_bytes, start in zip(pdf["path"], pdf["n_bytes"], pdf["start"]):
                rows, held = [], 0
                fs, local = resolve(path)
                with fs.open_input_file(local) as f:
                    for at, data in scan_range(f, int(n_bytes), int(start), min(int(start) + range_bytes, int(n_bytes))):
                        if data is None:
                            rows.append((None, f"{path}@{at}", DAMAGED, None, None, None, None))
                            continue
                        row = row_of(data, path)
                        rows.append(row if with_payload else (*row[:-1], None))
                        held += len(row[-1] or b"") if with_payload else 200
                        if held > 16 << 20:
                            yield frame(rows)
                            rows, held = [], 0
                yield frame(rows)

    return ranges.mapInPandas(task, RECORD)


def missing(files: DataFrame, records: DataFrame) -> int:
    """Records that the stored report of ``write`` counts and ``records`` (of :func:`read`) has not."""
    written = files.agg(F.sum("n_records")).first()[0] or 0
    return written - records.where(F.col("record_type").isin("response", "revisit")).count()


def archive(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
            min_revisit: int = 1000, root: str | None = None) -> DataFrame:
    """Mark revisits and write the archives; returns the stored report."""
    root = root or scratch_path(pages.sparkSession, "warc")
    return write(mark_revisits(pages, id_col=id_col, url_col=url_col, payload_col=payload_col,
                               min_revisit=min_revisit), root)
