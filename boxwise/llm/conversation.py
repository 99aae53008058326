"""Conversation structure repair by a square-root checkpointed dynamic program.

The rows of a conversation, in order of turn, are edited at the least cost until the
roles' initials read ``(s?(ua)+)?``: Keep costs 0, Rerole to user or assistant 1,
Delete 2, Insert of an empty user or assistant row 5; a truncated row that stays
costs 5 more.  Blank rows and duplicates must go.  Of the cheapest edits those with
the ASCII-least string of initials (D < I < K < R) are taken.

Method: the pattern is an automaton of four states, so the cost of the best end from
each state before a row is a vector of four numbers, the state-cost vector.  Backward,
vectors are kept at checkpoints only; forward, the vectors between two checkpoints are
computed again and the first tight edit in ASCII order is taken.

 1. Rows that are equal in turn, role and text become one item with a count: after the
    first one all are duplicates.  Texts stand for themselves as SHA-256 here.
 2. Items are range-partitioned in order, so one long conversation is split over tasks.
    A task packs its items into blocks of ``BLOCK`` codes of one byte; a block that may
    follow another one also gets its matrix of least costs between states.
 3. A task streams over the blocks of a conversation from the last to the first and
    gives each one the state-cost vector behind it: checkpoints between blocks.
 4. Blocks are dealt out and walked one by one, with checkpoints at every square root
    of their length; a block with blocks before it is walked from all four states.
 5. Rows and walked blocks are merged in order: a task streams over a conversation,
    follows the states, and emits edited rows or the conversation's summary.

Only step 5 meets the texts.  It keeps nothing but the conversation's audit string,
which is part of the result, so a long conversation needs no more memory than that; its
digest is one chain of SHA-256 and by nature one stream.

Defined results: null role and null text count as one space; rows are ordered by turn
(nulls first), then role, then SHA-256 of the text, so ties and repeated rows have one
order; a null conversation id is a conversation like others; an empty table gives no
rows; very long texts are hashed where they lie and streamed once; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxwise.llm import bpe
from boxwise.session import materialize

BLOCK = 1 << 16
SPACES = "\t\n\x0b\x0c\r "
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

# automaton: 0 nothing yet, 1 behind system, 2 behind user, 3 behind assistant
STATES = range(4)
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
GROWN = (2, 2, 3, 2)                                  # state behind the row that may be inserted or reroled to
ROLE = (None, None, "user", "assistant")
END = (0, 2 * INSERT, INSERT, 0)                      # least cost of an end without rows
INF = 1 << 60

# codes of items: initial (s, u, a, other) + 4 if truncated; or one of these
DUPLICATE, BLANK = 8, 9
INITIALS = "sua"


def _closed(v):
    """``v`` with the inserts that may come first."""
    for _ in range(2):
        v = [min(v[s], INSERT + v[GROWN[s]]) for s in STATES]
    return tuple(v)


class Steps:
    """The program's steps, each distinct one computed once: state-cost vectors are
    kept with their least entry taken off, and there are few of those."""

    def __init__(self):
        self.back, self.choice = {}, {}

    def before(self, code: int, v: tuple) -> tuple[tuple, int]:
        """The vector before an item from the vector behind it, and what was taken off."""
        got = self.back.get((code, v))
        if got is None:
            w = _closed([min(c for _, c, _ in self.edits(code, s, v)) for s in STATES])
            low = min(w)
            got = self.back[code, v] = tuple(x - low if x < INF // 2 else INF for x in w), low
        return got

    @staticmethod
    def edits(code: int, s: int, v: tuple):
        """(letter, cost to the end, next state) of the item's edits from state ``s``."""
        out = [("D", DELETE + v[s], s)]
        if code < DUPLICATE:
            extra = TRUNCATED if code >= 4 else 0
            kept = NEXT[s].get("sua?"[code % 4])
            if kept is not None:
                out.append(("K", KEEP + extra + v[kept], kept))
            out.append(("R", REROLE + extra + v[GROWN[s]], GROWN[s]))
        return out

    def edit(self, code: int, s: int, v: tuple) -> tuple[str, int]:
        """The ASCII-least tight letters for the item and inserts before it, and the state
        behind it; ``v`` is the vector behind the item."""
        got = self.choice.get((code, s, v))
        if got is None:
            w, low = self.before(code, v)
            letters, at = "", s
            while True:
                tight = {l: to for l, c, to in self.edits(code, at, v) if c == w[at] + low}
                if INSERT + w[GROWN[at]] == w[at]:
                    tight["I"] = GROWN[at]
                first = min(tight)
                letters, at = letters + first, tight[first]
                if first != "I":
                    break
            got = self.choice[code, s, v] = letters, at
        return got

    def through(self, codes: bytes, v: tuple) -> tuple[tuple, int]:
        """The vector before all ``codes``, and the sum taken off."""
        off = 0
        for code in reversed(codes):
            v, low = self.before(code, v)
            off += low
        return v, off

    def matrix(self, codes: bytes) -> list[int]:
        """Least cost from each state (rows) to each state (columns) over the codes."""
        cols = []
        for j in STATES:
            v, off = self.through(codes, tuple(0 if s == j else INF for s in STATES))
            cols.append([min(INF, x + off) if x < INF // 2 else INF for x in v])
        return [cols[j][s] for s in STATES for j in STATES]

    def walk(self, codes: bytes, s: int, behind: tuple) -> tuple[str, int]:
        """Letters of the least edits from state ``s``, and the state behind the codes."""
        low = min(behind)
        v = tuple(x - low for x in behind)
        stride = isqrt(len(codes)) + 1
        marks = [v]                                   # vectors behind each stretch of ``stride`` codes, last first
        for start in range((len(codes) - 1) // stride * stride, 0, -stride):
            v, _ = self.through(codes[start:start + stride], v)
            marks.append(v)
        out = []
        for start in range(0, len(codes), stride):
            part, v = codes[start:start + stride], marks.pop()
            vectors = [v]
            for code in reversed(part[1:]):
                v, _ = self.before(code, v)
                vectors.append(v)
            for code in part:
                letters, s = self.edit(code, s, vectors.pop())
                out.append(letters)
        return "".join(out), s

    @staticmethod
    def ending(s: int) -> str:
        """The inserts behind the last row."""
        return "I" * (END[s] // INSERT)


# --------------------------------------------------------------- the Spark job ---

KEYS = ["conv", "turn", "role", "digest"]


def _rows(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, copies_col: str | None) -> DataFrame:
    """(conv, turn, role, digest, text, copies) of all rows."""
    d = df.select(F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").alias("turn"),
                  F.coalesce(F.col(f"`{role_col}`"), F.lit(" ")).alias("role"),
                  F.coalesce(F.col(f"`{text_col}`"), F.lit(" ")).alias("text"),
                  (F.col(f"`{copies_col}`") if copies_col else F.lit(1)).cast("bigint").alias("copies"))
    return d.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))


def _items(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, digest, code) of the distinct rows."""
    last = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    initial = F.expr(f"instr('{INITIALS}', substring(role, 1, 1)) - 1")
    items = materialize(
        rows.filter("copies > 0")
        .withColumn("code", F.when(last == "", BLANK).otherwise(
            F.when(F.col("role") == "", 3).when(initial >= 0, initial).otherwise(3)
            + F.when(last.isin(".", "!", "?"), 0).otherwise(4)).cast("int"))
        .groupBy(*KEYS).agg(F.max("code").alias("code")), "turn-items")
    # where an equal row comes first; the keys below are unique on both sides, so no key is hot
    first = items.filter(F.col("code") != BLANK).groupBy("conv", "role", "digest").agg(F.min(F.struct("turn")).alias("t")) \
        .select(F.col("conv").alias("_c"), F.col("t.turn").alias("_t"), F.col("role").alias("_r"), F.col("digest").alias("_d"))
    same = (F.col("conv").eqNullSafe(F.col("_c")) & F.col("turn").eqNullSafe(F.col("_t"))
            & (F.col("role") == F.col("_r")) & (F.col("digest") == F.col("_d")))
    found = items.join(first.hint("merge"), same, "left")
    return found.select(*KEYS, F.when((F.col("code") != BLANK) & F.col("_d").isNull(), DUPLICATE).otherwise(F.col("code"))
                        .alias("code"))


def _schema(kinds: dict, more: list) -> T.StructType:
    return T.StructType([T.StructField(n, k) for n, k in kinds.items()] + [T.StructField(n, k) for n, k in more])


def _blocks(items: DataFrame, block: int) -> DataFrame:
    """Items in order, packed: (conv, turn, role, digest of the first one, part, block,
    codes, matrix); the matrix is null where no block can come before."""
    ordered = items.repartitionByRange(*KEYS).sortWithinPartitions(*KEYS)
    kinds = {k: items.schema[k].dataType for k in KEYS}
    schema = _schema(kinds, [("part", T.IntegerType()), ("block", T.IntegerType()), ("codes", T.BinaryType()),
                             ("matrix", T.ArrayType(T.LongType()))])

    def task(batches):
        from pyspark import TaskContext
        part, steps = TaskContext.get().partitionId(), Steps()
        types = None
        held, codes, number, begun = None, bytearray(), 0, 0
        rows = []

        def flush():
            # the first conversation of a task may have begun in the task before
            follows = number > 0 or begun == 1
            rows.append((*held, part, number, bytes(codes), steps.matrix(bytes(codes)) if follows else None))

        def batch_of():
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=schema.names)

        for batch in batches:
            if types is None:
                types = [batch.schema.field(k).type for k in KEYS] + [pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64())]
            for row in zip(*(batch.column(k).to_pylist() for k in [*KEYS, "code"])):
                new = held is None or held[0] != row[0]
                if new or len(codes) == block:
                    if held is not None:
                        flush()
                    number = 0 if new else number + 1
                    begun += new
                    held, codes = row[:4], bytearray()
                codes.append(row[4])
            if len(rows) >= 4096:
                yield batch_of()
                rows = []
        if held is not None:
            flush()
        if rows:
            yield batch_of()

    return ordered.mapInArrow(task, schema)


def _behind(blocks: DataFrame) -> DataFrame:
    """Blocks with ``behind``, the state-cost vector behind them, ``first`` and ``last``."""
    schema = T.StructType([*blocks.drop("matrix").schema.fields, T.StructField("behind", T.ArrayType(T.LongType())),
                           T.StructField("first", T.BooleanType()), T.StructField("last", T.BooleanType())])
    ordered = blocks.repartition("conv").sortWithinPartitions("conv", F.desc("part"), F.desc("block"))

    def task(batches):
        conv, v, matrix, seen, tail = None, END, None, False, None

        def out(batch, behind, first, last):
            return pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in batch.schema.names if n != "matrix"), pa.array(behind, pa.list_(pa.int64())),
                 pa.array(first, pa.bool_()), pa.array(last, pa.bool_())], names=schema.names)

        for batch in batches:
            behind, first, last = [], [], []
            for c, m in zip(batch.column("conv").to_pylist(), batch.column("matrix").to_pylist()):
                same = seen and c == conv
                if same:
                    v = _closed([min(matrix[4 * s + j] + v[j] for j in STATES) for s in STATES])
                else:
                    v = END
                if first:
                    first[-1] = not same
                elif tail is not None:
                    yield out(tail[0], tail[1], [not same], tail[2])
                    tail = None
                conv, matrix, seen = c, m, True
                behind.append(list(v))
                first.append(True)
                last.append(not same)
            n = batch.num_rows
            if n > 1:
                yield out(batch.slice(0, n - 1), behind[:-1], first[:-1], last[:-1])
            if n:                                     # whether the last one is a first one shows in the next batch
                tail = (batch.slice(n - 1, 1), behind[-1:], last[-1:])
        if tail is not None:
            yield out(tail[0], tail[1], [True], tail[2])

    return ordered.mapInArrow(task, schema)


def _walked(blocks: DataFrame) -> DataFrame:
    """(conv, turn, role, digest, codes, letters): letters of the walk from each state, or
    of the only one from the start."""
    kinds = {k: blocks.schema[k].dataType for k in KEYS}
    schema = _schema(kinds, [("codes", T.BinaryType()), ("letters", T.ArrayType(T.StringType()))])

    def task(batches):
        steps = Steps()
        for batch in batches:
            letters = []
            for codes, behind, first, last in zip(*(batch.column(n).to_pylist() for n in ("codes", "behind", "first", "last"))):
                found = []
                for s in [0] if first else STATES:
                    got, to = steps.walk(codes, s, tuple(behind))
                    found.append(got + (steps.ending(to) if last else ""))
                letters.append(found)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in KEYS), batch.column("codes"),
                                              pa.array(letters, pa.list_(pa.string()))], names=schema.names)

    # blocks are small and few; each is walked on its own
    return blocks.repartition(*KEYS).mapInArrow(task, schema)


class _Conversation:
    """Follows one conversation's rows and walked blocks in order."""

    def __init__(self, conv):
        self.conv, self.state = conv, 0
        self.codes, self.letters, self.item, self.at = b"", "", 0, 0
        self.key, self.code = None, None
        self.audit, self.cost = [], 0
        self.turns, self.low, self.high, self.turn = 0, None, None, None
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.before = None

    def block(self, codes: bytes, letters: list[str]) -> None:
        self.codes, self.letters = codes, letters[self.state if len(letters) > 1 else 0]
        self.item = self.at = 0

    def insert(self):
        self.state = GROWN[self.state]
        self.cost += INSERT
        return ROLE[self.state], ""

    def row(self, turn, role: str, digest: bytes, text: str, copies: int):
        """The repaired rows that come of ``copies`` equal rows."""
        if not copies:
            return
        new = self.key != (turn, role, digest)
        initial = role[:1]
        if new:
            self.key = (turn, role, digest)
            if turn is not None and turn != self.turn:
                self.turns, self.turn, self.high = self.turns + 1, turn, turn
                self.low = turn if self.low is None else self.low
            code = self.code = self.codes[self.item]
            self.item += 1
            if self.before is not None and self.before + initial not in ("su", "ua", "au"):
                self.counts["illegal"] += 1
            self.before = initial
            if code == BLANK:
                self.counts["blank"] += 1
            elif code == DUPLICATE:
                self.counts["duplicate"] += 1
            elif code >= 4:
                self.counts["truncated"] += 1
            while True:
                letter = self.letters[self.at]
                self.at += 1
                self.audit.append(letter)
                if letter != "I":
                    break
                yield self.insert()
            if letter == "D":
                self.cost += DELETE
            else:
                self.cost += TRUNCATED if code >= 4 else 0
                if letter == "K":
                    self.state = NEXT[self.state][initial]
                    yield role, text
                else:
                    self.state = GROWN[self.state]
                    self.cost += REROLE
                    yield ROLE[self.state], text
        again = copies - new
        if again:                                     # equal rows: blank, or duplicates of the first
            self.counts["blank" if self.code == BLANK else "duplicate"] += again
            self.counts["illegal"] += again
            self.cost += DELETE * again
            self.audit.append("D" * again)

    def end(self):
        for letter in self.letters[self.at:]:
            self.audit.append(letter)
            yield self.insert()

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


def _merged(rows: DataFrame, walked: DataFrame) -> DataFrame:
    """Rows and blocks of each conversation in order; a block stands before its first row."""
    r = rows.select(*KEYS, F.lit(1).alias("kind"), "text", "copies", F.lit(None).cast("binary").alias("codes"),
                    F.lit(None).cast("string").alias("letters"))
    # letters of the states as one text: arrays that are null in nearly every row are slow to transfer
    w = walked.select(*KEYS, F.lit(0).alias("kind"), F.lit("").alias("text"), F.lit(0).cast("bigint").alias("copies"),
                      "codes", F.array_join("letters", ",").alias("letters"))
    return r.unionByName(w).repartition("conv").sortWithinPartitions(*KEYS, "kind")


def _follow(batches):
    """(conversation, event, value): repaired rows as ("row", (role, text)) and ("end", None)."""
    now, seen = None, False
    for batch in batches:
        small = [batch.column(n).to_pylist() for n in (*KEYS, "kind", "copies", "codes", "letters")]
        for low, high, texts in bpe.text_runs(batch.column("text")):
            for i, text in enumerate(texts, low):
                conv, turn, role, digest, kind, copies, codes, letters = (c[i] for c in small)
                if not seen or conv != now.conv:
                    if seen:
                        for made in now.end():
                            yield now, "row", made
                        yield now, "end", None
                    now, seen = _Conversation(conv), True
                if kind == 0:
                    now.block(codes, letters.split(","))
                else:
                    for made in now.row(turn, role, digest, text, copies):
                        yield now, "row", made
    if seen:
        for made in now.end():
            yield now, "row", made
        yield now, "end", None


def _plan(df, conv_col, turn_col, role_col, text_col, copies_col, block):
    rows = _rows(df, conv_col, turn_col, role_col, text_col, copies_col)
    blocks = materialize(_blocks(_items(rows), block), "turn-blocks")
    return _merged(rows, _walked(_behind(blocks)))


def repair(df: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", copies_col: str | None = None, block: int = BLOCK) -> DataFrame:
    """The repaired conversations: (conv_id, position from 0, role, text).  ``copies_col``
    counts each row's copies; a row of none only names its conversation."""
    plan = _plan(df, conv_col, turn_col, role_col, text_col, copies_col, block)
    schema = T.StructType([T.StructField("conv_id", plan.schema["conv"].dataType), T.StructField("position", T.LongType()),
                           T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])

    def task(batches):
        kind, rows, held, n = None, [], 0, 0

        def typed():
            nonlocal kind
            for b in batches:
                kind = b.schema.field("conv").type
                yield b

        def batch_of():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*rows), (kind, pa.int64(), pa.string(), pa.string()))], names=schema.names)

        for now, event, made in _follow(typed()):
            if event == "end":
                n = 0
                continue
            rows.append((now.conv, n, *made))
            n, held = n + 1, held + len(made[1])
            if held > 1 << 22 or len(rows) > 10_000:
                yield batch_of()
                rows, held = [], 0
        if rows:
            yield batch_of()

    return plan.mapInArrow(task, schema)


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def audit(df: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text", copies_col: str | None = None, block: int = BLOCK) -> DataFrame:
    """One row per conversation: conv_id, faults (gaps, blank, duplicate, truncated,
    illegal), cost, audit (initials of the edits) and repaired_sha256, the digest of the
    repaired ``role:text`` joined by newlines."""
    plan = _plan(df, conv_col, turn_col, role_col, text_col, copies_col, block)
    schema = T.StructType([T.StructField("conv_id", plan.schema["conv"].dataType),
                           *[T.StructField(n, T.LongType()) for n in COUNTS],
                           T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])

    def task(batches):
        kind, rows, sha, n = None, [], hashlib.sha256(), 0

        def typed():
            nonlocal kind
            for b in batches:
                kind = b.schema.field("conv").type
                yield b

        def batch_of():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*rows), (kind, *[pa.int64()] * len(COUNTS), pa.string(), pa.string()))], names=schema.names)

        for now, event, made in _follow(typed()):
            if event == "row":
                sha.update(f"{chr(10) if n else ''}{made[0]}:{made[1]}".encode())
                n += 1
                continue
            c = now.counts
            rows.append((now.conv, now.gaps, c["blank"], c["duplicate"], c["truncated"], c["illegal"], now.cost,
                         "".join(now.audit), sha.hexdigest()))
            sha, n = hashlib.sha256(), 0
            if len(rows) > 10_000:
                yield batch_of()
                rows = []
        if rows:
            yield batch_of()

    return plan.mapInArrow(task, schema)


def damage(df: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Seeded faults for tests and measurements: (conv_id, turn, role, text, copies).
    crc32 of ``conv_id:turn`` modulo 20 decides: 0 drops a row (0 copies), 1 empties its
    text, 2 takes its sentence ends out, 3 repeats it, 4 makes it a user's; nulls count as
    one space."""
    def spaced(c):
        return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    k = F.crc32(F.concat(spaced(conv_col), F.lit(":"), spaced(turn_col)).cast("binary")) % 20
    d = df.select(F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"), spaced(role_col).alias("role"),
                  spaced(text_col).alias("text"), k.alias("k"))
    return d.select("conv_id", "turn", F.when(F.col("k") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
                    .alias("text"), F.expr("CASE k WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END").alias("copies"))
