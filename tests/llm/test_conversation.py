"""Conversation repair against a search over all edits and against a plain walk."""
import hashlib
import heapq
import random
import zlib

import pytest

from boxwise.llm import conversation as c

SCHEMA = "conv_id bigint, turn bigint, role string, text string, conv string, digest string, kind int, copies bigint"


def faults(rows):
    """(blank, duplicate, truncated) of each row of (role, text)."""
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(c.SPACES)
        blank = not body
        dup = not blank and (role, text) in seen
        out.append((blank, dup, not blank and not dup and body[-1] not in ".!?"))
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, repaired) by Dijkstra over (rows read, roles so far mod the pattern)."""
    marks = faults(rows)

    def step(s, initial):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((s, initial))

    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, s, out = heapq.heappop(heap)
        if (i, s) in done:
            continue
        done.add((i, s))
        if i == len(rows) and s in ("", "a"):
            return cost, audit, list(out)
        for role in ("user", "assistant"):
            to = step(s, role[0])
            if to:
                heapq.heappush(heap, (cost + 5, audit + "I", i, to, out + (f"{role}:",)))
        if i < len(rows):
            (role, text), (blank, dup, cut) = rows[i], marks[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, s, out))
            if not blank and not dup:
                for letter, name, price in (("K", role, 0), ("R", "user", 1), ("R", "assistant", 1)):
                    to = step(s, name[:1])
                    if to:
                        heapq.heappush(heap, (cost + price + 5 * cut, audit + letter, i + 1, to, out + (f"{name}:{text}",)))


def expected(rows):
    """The summary of the rows (turn, role, text) of one conversation."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
    marks = faults([r[1:] for r in rows])
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    cost, audit, out = cheapest([r[1:] for r in rows])
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(sum(m[k] for m in marks) for k in range(3)),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = {1: "", 2: text.translate({ord(x): None for x in ".!?"})}.get(k, text)
        out += [(conv, turn, "user" if k == 4 else role, text)] * {0: 0, 3: 2}.get(k, 1)
    return out


def check(got, rows, convs):
    by = {k: [] for k in convs}
    for conv, *rest in rows:
        by[conv].append(tuple(rest))
    assert len(got) == len(by)
    for r in got:
        assert tuple(r[1:]) == expected(by[r[0]]), r
    return by


def drawn(n_convs, longest, seed):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "Sage", "umpire"]
    texts = ["Yes.", "No!", "why", "", " \n", None, "a\tb?  \r\n", "Yes.", "naïve…", "x" * 300 + ".", "end. "]
    rows = []
    for conv in range(n_convs):
        for i in range(rng.randint(0, longest)):
            turn = None if rng.random() < 0.1 else rng.randint(0, 6) if rng.random() < 0.2 else i
            rows.append((conv if conv else None, turn, rng.choice(roles), rng.choice(texts)))
    return rows


@pytest.mark.parametrize("block", [1, 3, c.BLOCK])
def test_audits_equal_a_search(spark, block):
    from boxwise.session import ship_package
    ship_package(spark)
    rows = drawn(60, 14, block)
    df = spark.createDataFrame([(*r, "x", "y", 7, 9) for r in rows], SCHEMA).repartition(5)
    check(c.audit(df, block=block).collect(), rows, {r[0] for r in rows})
    hurt = damaged(rows)
    check(c.audit(c.damage(df), copies_col="copies", block=block).collect(), hurt, {r[0] for r in rows})


def test_repaired_rows_and_empty_tables(spark):
    from boxwise.session import ship_package
    ship_package(spark)
    rows = drawn(20, 9, 5)
    df = spark.createDataFrame([(*r, "x", "y", 7, 9) for r in rows], SCHEMA)
    sums = {r.conv_id: r.repaired_sha256 for r in c.audit(df, block=2).collect()}
    out = {k: [] for k in sums}
    for r in sorted(c.repair(df, block=2).collect(), key=lambda r: r.position):
        out[r.conv_id].append(f"{r.role}:{r.text}")
    assert {k: hashlib.sha256("\n".join(v).encode()).hexdigest() for k, v in out.items()} == sums
    assert c.audit(df.limit(0)).count() == 0 and c.repair(df.limit(0)).count() == 0


def test_long_conversation_over_many_tasks(spark):
    """One conversation with most rows: blocks, matrices and states from task to task."""
    from boxwise.session import ship_package
    ship_package(spark)
    rng = random.Random(3)
    rows = [(1, i, rng.choice(["user", "assistant", "assistant", "tool"]), rng.choice(["a.", "b", "c.", f"{i}."])) for i in range(3000)]
    rows += [(k, i, "user", "x" * 200_000 + ".") for k in (0, 2) for i in range(2)] + [(1, 5, "user", "again.")] * 400
    df = spark.createDataFrame([(*r, "x", "y", 7, 9) for r in rows], SCHEMA)
    check(c.audit(df, block=64).collect(), rows, {0, 1, 2})


def test_walk_keeps_checkpoints_only():
    """Any checkpoint distance gives the plain backward table's edits."""
    rng, steps = random.Random(8), c.Steps()
    for n in (1, 2, 3, 10, 99, 1000):
        codes = bytes(rng.choice([0, 1, 2, 3, 4, 5, 6, 7, 8, 9]) for _ in range(n))
        v, vectors = c.END, []
        for code in reversed(codes):
            vectors.append(v)
            v = steps.before(code, v)[0]
        s, want = 0, ""
        for code in codes:
            letters, s = steps.edit(code, s, vectors.pop())
            want += letters
        assert steps.walk(codes, 0, c.END) == (want, s)
