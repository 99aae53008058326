"""MinHash near-dedup with an LSH forest.

Each document's set is its distinct five-word shingles (64-bit hashes of the word
sequence).  Equal sets collapse to one node.  A node has HASHES minhash values;
``TREES`` orders sort the nodes by rotations of that signature.  In each order,
nodes that share at least the first ``depth`` values are a region, and the
neighbours in a region, those with the longest common prefix, are candidates.
Regions adapt their depth: one of more than ``region_rows`` nodes is divided by
more of the signature, and if even eight values don't divide it, by a hash that
differs from order to order.  The nodes of a divided region also meet in an exact
prefix-filter join: linked sets share one of the rarest 100 - ``percent`` percent of
their shingles.  Holders of such a shingle are candidates; where more than ``FEW``
nodes hold it, they are put into one cluster instead.

Candidates whose whole signatures agree in too few values are dropped
(``fewest_agreements``: under 32 of 64 at a similarity of 0.75, where the chance to drop a
link is 4.6e-6; this also holds for candidates of the exact join).  Components
of the remaining candidates are clusters; a cluster's texts meet in one bounded
group, where links are confirmed on full sets until its true components are known:
the candidates first, then every node outside the largest component against the
whole cluster.  Clusters of more than ``cluster_words`` words or ``cluster_nodes`` nodes are
too large for one group: there the links are confirmed by joins, first each node's best candidate, then
all that still lie between components, then a wide neighbourhood across components;
last, as in the small ones, every node outside the largest component meets the whole
cluster, block by block, on full sets.

Chance of missing a link of similarity s in a region of depth d: (1 - s^d)^TREES,
2e-6 at s = 0.75, d = 2; none is missed by dividing a region.

Defined results: null or word-less texts have no shingle and stay alone; rows
with equal sets, so all repeated rows, are in one component; of ids tied for a
component's least one either names it, as they are equal; null ids join
components but never name one; very long texts are one set each, shingled whole in a
run of their own; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxwise.llm.bpe import text_runs
from boxwise.llm.common import releasing, releasing_batches
from boxwise.session import materialize

SHINGLE = 5
HASHES, TREES, LABEL = 64, 16, 8        # values per signature, orders, values kept per order
U = np.uint64
_RNG = np.random.default_rng(20_240_229)
_XOR = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_MUL = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64) * U(2) + U(1)
_PLACE = _RNG.integers(0, 1 << 63, 2 * SHINGLE, dtype=np.uint64) * U(2) + U(1)
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x9, 0xE)]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


_POWERS: list[np.ndarray] = []


def _powers(n: int):
    if not _POWERS or len(_POWERS[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for seed in (BASE, BASE_INVERSE):
            p = np.full(size, seed, np.uint64)
            p[0] = 1
            _POWERS.append(np.cumprod(p))
        _POWERS[:] = _POWERS[-2:]
    return _POWERS


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    buf = np.frombuffer(("\n".join(texts) + "\n").encode().lower(), np.uint8)      # bytes: A-Z only
    power, inverse = _powers(len(buf) + 1)
    prefix = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + U(1)) * power[:len(buf)], out=prefix[1:])
    space = _SPACE[buf]
    before = np.concatenate([[True], space[:-1]])
    begin = np.flatnonzero(~space & before)
    end = np.flatnonzero(space & ~before)
    word = _mix((prefix[end] - prefix[begin]) * inverse[begin] + (end - begin).astype(np.uint64))
    stops = np.cumsum([len(t.encode()) + 1 for t in texts])
    first = np.concatenate([[0], np.searchsorted(begin, stops)])
    n = len(word)
    rolled = np.zeros(n, np.uint64)
    for j in range(min(SHINGLE, n)):
        rolled[:n - j] += word[j:] * _PLACE[j]
    rolled = _mix(rolled)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= SHINGLE:
            out.append(np.unique(rolled[a:b - SHINGLE + 1]))
        elif b > a:                                  # the whole sequence, marked by its length
            out.append(_mix((word[a:b] * _PLACE[:b - a]).sum(keepdims=True, dtype=np.uint64) + _PLACE[SHINGLE + b - a - 1]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """HASHES minhash values of each non-empty set."""
    out = np.zeros((len(sets), HASHES), np.uint32)
    if sets:
        every = np.concatenate(sets)
        start = np.cumsum([0] + [len(s) for s in sets[:-1]])
        for k in range(HASHES):
            out[:, k] = np.minimum.reduceat((((every ^ _XOR[k]) * _MUL[k]) >> U(32)).astype(np.uint32), start)
    return out


def node_key(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _sign(docs: DataFrame) -> DataFrame:
    """(doc_id, n, node, sig): sig in big-endian, so bytes sort as the values do.
    Columns besides the text are carried."""
    carry = [c for c in docs.columns if c != "text"]

    def task(batches):
        for batch in batches:
            for low, high, texts in text_runs(batch.column("text")):
                sets = shingle_sets(texts)
                full = [s for s in sets if len(s)]
                sig = iter(signatures(full).astype(">u4"))
                node = [node_key(s) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(low, high - low) for c in carry),
                     pa.array([len(s) for s in sets], pa.int64()), pa.array(node, pa.binary()),
                     pa.array([next(sig).tobytes() if len(s) else None for s in sets], pa.binary())],
                    names=[*carry, "n", "node", "sig"])

    return docs.mapInArrow(releasing_batches(task), T.StructType([
        *(docs.schema[c] for c in carry), T.StructField("n", T.LongType()), T.StructField("node", T.BinaryType()),
        T.StructField("sig", T.BinaryType())]))


def _orders(nodes: DataFrame) -> DataFrame:
    """(tree, label, node, n): the first LABEL values of each rotated signature."""
    step = 4 * HASHES // TREES
    return nodes.selectExpr("node", "n", f"concat(sig, substring(sig, 1, {4 * LABEL})) AS s",
                            f"explode(sequence(0, {TREES - 1})) AS tree").selectExpr(
        "tree", f"substring(s, tree * {step} + 1, {4 * LABEL}) AS label", "node", "n")


def _regions(orders: DataFrame, depth: int, region_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows with the key of their region; crowded regions go deeper.  Also the nodes
    of regions that were divided, if there are any."""
    dense = None
    rows = orders.withColumn("key", F.xxhash64("tree", F.expr(f"substring(label, 1, {4 * depth})")))
    for deeper in (4, LABEL, None):
        crowded = materialize(rows.groupBy("key").count().filter(F.col("count") > region_rows), "forest-crowded")
        if crowded.isEmpty():
            break
        if dense is None:
            dense = materialize(rows.join(crowded, "key").select("node").distinct(), "forest-dense")
        part = F.expr(f"substring(label, 1, {4 * (deeper or LABEL)})")
        new = F.xxhash64("tree", part) if deeper else F.xxhash64(
            "key", F.pmod(F.xxhash64("tree", "node"), F.ceil(F.col("count") / region_rows)))
        rows = rows.join(crowded, "key", "left").withColumn(
            "key", F.when(F.col("count").isNull(), F.col("key")).otherwise(new)).drop("count")
    return rows, dense


FEW = 128                                # holders of a shingle that are paired with each other


def _prefix_pairs(texts: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(a, b) candidates that hold every link between the nodes of ``texts`` (node,
    text) with pairs (a, b) of the second result, whose nodes belong in one cluster."""
    def keyed(batches):
        for batch in batches:
            names = batch.column("node").to_pylist()
            for low, high, run in text_runs(batch.column("text")):
                own = [(n, s.tobytes()) for n, s in zip(names[low:high], shingle_sets(run)) if node_key(s) == n]
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in own], pa.binary()) for k in (0, 1)],
                                                 names=["node", "shingles"])

    def shingles(batches):
        for batch in batches:
            for row in range(0, batch.num_rows, 256):
                some = batch.slice(row, 256)
                sets = [np.frombuffer(s, np.int64) for s in some.column("shingles").to_pylist()]
                size = np.array([len(s) for s in sets])
                yield pa.RecordBatch.from_arrays(
                    [some.column("node").take(pa.array(np.repeat(np.arange(len(sets)), size))),
                     pa.array(np.repeat(size, size)), pa.array(np.concatenate(sets))], names=["node", "n", "shingle"])

    sets = materialize(texts.select("node", "text").mapInArrow(keyed, "node binary, shingles binary")
                       .dropDuplicates(["node"]), "forest-sets")
    every = sets.mapInArrow(shingles, "node binary, n bigint, shingle bigint")
    shared = every.groupBy("shingle").count().filter("count > 1")
    # in ascending frequency; those of one node come first and have no partner
    prefix = materialize(
        every.join(shared.hint("merge"), "shingle").groupBy("node", "n")
        .agg(F.sort_array(F.collect_list(F.struct("count", "shingle"))).alias("s"))
        .selectExpr("node", "n", f"inline(slice(s, 1, cast(greatest(0, size(s) - ({percent} * n + 99) div 100 + 1) AS int)))"),
        "forest-prefix")
    few = prefix.filter(F.col("count") <= FEW)
    x, y = (few.select("shingle", F.col("node").alias(v), F.col("n").alias(f"n{v}")) for v in "ab")
    pairs = x.join(y.hint("merge"), "shingle").filter(
        f"a < b AND 100 * least(na, nb) >= {percent} * greatest(na, nb)").select("a", "b").distinct()
    many = prefix.filter(F.col("count") > FEW)
    least = many.groupBy("shingle").agg(F.min("node").alias("b"))
    bound = (many.join(least.hint("merge"), "shingle").select(F.col("node").alias("a"), "b").filter("a <> b").distinct())
    return pairs, bound


NEAR, START = 4, 12                      # neighbours of each node; of the first nodes of a region
FAR = 64                                 # neighbours across the components of a large cluster


def _neighbours(rows: DataFrame, percent: int, near: int = NEAR, start: int = START, by_root: bool = False) -> DataFrame:
    """(a, b) candidates: in each sorted region, every node with the ``near`` before
    it; the first ``start`` + 1 nodes, so all of a small region, with each other.
    ``by_root``: only between nodes of different ``root``."""
    ordered = rows.repartition("key").sortWithinPartitions("key", "label", "node").select(
        "key", "node", "n", F.col("root" if by_root else "node").alias("root"))

    def task(batches):
        tail = None
        for batch in batches:
            key = batch.column("key").to_numpy(zero_copy_only=False)
            n = batch.column("n").to_numpy(zero_copy_only=False)
            node, root = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "V16") for c in ("node", "root"))
            pos = np.zeros(len(key), np.int64)
            known = 0
            if tail is not None:
                key, n, node, root = (np.concatenate([t, x]) for t, x in zip(tail[:4], (key, n, node, root)))
                pos = np.concatenate([tail[4], pos])
                known = len(tail[4])
            change = np.concatenate([[True], key[1:] != key[:-1]])
            began = np.maximum.accumulate(np.where(change, np.arange(len(key)), 0))
            shift = pos[0] if known else 0                   # of the region that goes on from the last batch
            pos = np.arange(len(key)) - began + np.where(began == 0, shift, 0)
            a, b = [], []
            for d in range(1, start + 1):
                i = np.arange(max(d, known), len(key))
                ok = (key[i] == key[i - d]) & ((d <= near) | (pos[i] <= start))
                if by_root:
                    ok &= root[i] != root[i - d]
                small, large = np.minimum(n[i], n[i - d]), np.maximum(n[i], n[i - d])
                i = i[ok & (100 * small >= percent * large)]
                a.append(node[i])
                b.append(node[i - d])
            a, b = np.concatenate(a), np.concatenate(b)
            yield pa.RecordBatch.from_arrays([_fixed(a), _fixed(b)], names=["x", "y"])
            tail = tuple(v[-start:] for v in (key, n, node, root, pos))

    return (ordered.mapInArrow(releasing_batches(task), "x binary, y binary")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())


def _fixed(values: np.ndarray) -> pa.Array:
    data = values.tobytes()
    return pa.array([data[i:i + 16] for i in range(0, len(data), 16)], pa.binary())


def _agreeing(pairs: DataFrame, nodes: DataFrame, least: int) -> DataFrame:
    """(a, b, agree): pairs whose signatures agree in ``least`` values or more."""
    sig = nodes.select("node", "sig")
    both = (pairs.join(sig.select(F.col("node").alias("a"), F.col("sig").alias("s")).hint("merge"), "a")
            .join(sig.select(F.col("node").alias("b"), F.col("sig").alias("t")).hint("merge"), "b"))

    def task(batches):
        for batch in batches:
            s, t = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, HASHES) for c in "st")
            agree = (s == t).sum(1)
            at = pa.array(np.flatnonzero(agree >= least))
            yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at),
                                              pa.array(agree, pa.int32()).take(at)], names=["a", "b", "agree"])

    return both.select("a", "b", "s", "t").mapInArrow(releasing_batches(task), "a binary, b binary, agree int")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): alternating large-star and
    small-star steps until the edges are stars.  Every step is written out; hubs
    are combined before the shuffle, and as the aggregates are stored, AQE splits the
    joins that give a hub's edges its result."""
    e = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v")
                    .distinct(), "forest-edges")
    state = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")),
                            "forest-least")
        large = both.filter("v > u").join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.distinct(), "forest-large")
        low = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "forest-low")
        small = (large.join(low.hint("merge"), "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))))
        e = materialize(small.distinct(), "forest-small")
        now = e.agg(F.count("*").alias("c"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == state:
            break
        state = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def fewest_agreements(percent: int) -> int:
    """How many values the signatures of a linked pair share but for a chance of some
    millionths: 4.6 standard deviations below the mean at a similarity of ``percent``."""
    s = percent / 100
    return max(0, int(HASHES * s - 4.6 * (HASHES * s * (1 - s)) ** 0.5))


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _confirm_groups(texts: DataFrame, pairs: DataFrame, percent: int, least: int) -> DataFrame:
    """(node, root): true components of each cluster.  ``texts`` (cluster, node,
    text), ``pairs`` (cluster, a, b, agree)."""
    def task(left, right):
        sets, names = {}, left.column("node").to_pylist()
        for low, high, texts in text_runs(left.column("text").combine_chunks()):
            for node, s in zip(names[low:high], shingle_sets(texts)):
                if node_key(s) == node:                      # another row may have the same id
                    sets[node] = s
        parent = {n: n for n in sets}

        def find(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        def confirm(a, b):
            ra, rb = find(a), find(b)
            if ra != rb and linked(sets[a], sets[b], percent):
                parent[max(ra, rb)] = min(ra, rb)

        p = right.to_pydict()
        for _, a, b in sorted(zip([-x for x in p["agree"]], p["a"], p["b"])):
            confirm(a, b)
        # what is still apart from the largest component meets the whole cluster: an
        # outlier of a dense group has many neighbours, few of which it is linked with
        order = sorted(sets)
        size = Counter(find(n) for n in order)
        if len(size) > 1:
            sig = signatures([sets[n] for n in order])
            main = max(size, key=lambda k: (size[k], k))
            for i in [i for i, n in enumerate(order) if find(n) != main]:
                agree = (sig == sig[i]).sum(1)
                for j in sorted(np.flatnonzero(agree >= least).tolist(), key=lambda j: -agree[j]):
                    confirm(order[i], order[j])
        return pa.table({"node": pa.array(list(sets), pa.binary()), "root": pa.array([find(n) for n in sets], pa.binary())})

    return (texts.groupBy("cluster").cogroup(pairs.groupBy("cluster"))
            .applyInArrow(releasing(task), "node binary, root binary"))


def _confirm_joined(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are linked, by joins with (node, text)."""
    both = (pairs.select("a", "b")
            .join(texts.select(F.col("node").alias("a"), F.col("text").alias("s")).hint("merge"), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("t")).hint("merge"), "b"))

    def task(batches):
        for batch in batches:
            d = batch.to_pydict()
            a, b = [], []
            for i in range(batch.num_rows):
                x, y = shingle_sets([d["s"][i], d["t"][i]])
                if node_key(x) == d["a"][i] and node_key(y) == d["b"][i] and linked(x, y, percent):
                    a.append(d["a"][i])
                    b.append(d["b"][i])
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return both.select("a", "b", "s", "t").mapInArrow(releasing_batches(task), "a binary, b binary")


def _texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``nodes`` (node, first_id, ...) with a text each instead of first_id.  Other
    rows may have the same id; a node without an id is found by its key."""
    def keyed(batches):
        for batch in batches:
            for low, high, texts in text_runs(batch.column("text")):
                own = [(node_key(x), t) for x, t in zip(shingle_sets(texts), texts) if len(x)]
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in own], pa.binary()),
                                                  pa.array([t for _, t in own], pa.string())], names=["node", "text"])

    named = docs.select("doc_id", "text").join(nodes.withColumnRenamed("first_id", "doc_id").hint("merge"), "doc_id").drop("doc_id")
    nameless = (docs.filter("doc_id IS NULL").select("text").mapInArrow(keyed, "node binary, text string")
                .dropDuplicates(["node"]))
    return named.unionByName(nodes.filter("first_id IS NULL").drop("first_id").join(nameless.hint("merge"), "node"))


def near_duplicates(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", percent: int = 75, depth: int = 2,
                    region_rows: int = 20_000, cluster_words: int = 2_000_000, cluster_nodes: int = 20_000,
                    least_agree: int | None = None, row_keys: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row: links have
    100 * intersection >= percent * union of their sets.  ``row_keys`` adds (digest,
    stays): of each component the rows stay that equal its least one by id, nulls
    last, and digest of the text; word-less rows stay."""
    least_agree = fewest_agreements(percent) if least_agree is None else least_agree
    docs = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    row, first_row, last_row = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "digest"), [], []
    if row_keys:
        docs = docs.withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))
        first_row, last_row = [F.min(row).alias("first_row")], [F.min("first_row").alias("least_row")]
    signed = materialize(_sign(docs), "forest-signed")
    nodes = materialize(signed.filter("n > 0").groupBy("node").agg(
        F.first("n").alias("n"), F.first("sig").alias("sig"), F.min("doc_id").alias("first_id"), *first_row), "forest-nodes")
    regions, dense = _regions(_orders(nodes), depth, region_rows)
    pairs = _neighbours(regions, percent)
    bound = None
    if dense is not None:
        exact, bound = _prefix_pairs(_texts(docs, nodes.join(dense.hint("merge"), "node").select("node", "first_id")), percent)
        pairs, bound = pairs.unionByName(exact).distinct(), materialize(bound, "forest-bound")
    pairs = materialize(pairs, "forest-pairs")
    close = materialize(_agreeing(pairs, nodes, least_agree), "forest-close")
    # clusters: components of the candidates
    ties = close.select("a", "b")
    member = materialize(components(ties if bound is None else ties.unionByName(bound)).withColumnRenamed("root", "cluster")
                         .join(nodes.select("node", "n", "first_id").hint("merge"), "node"), "forest-members")
    weight = materialize(member.groupBy("cluster").agg(F.sum("n").alias("words"), F.count("*").alias("members")), "forest-weights")
    member = materialize(member.join(weight.hint("merge"), "cluster").withColumn(
        "large", (F.col("words") > cluster_words) | (F.col("members") > cluster_nodes)).drop("members"), "forest-weighed")
    texts = materialize(_texts(docs, member.select("cluster", "node", "large", "first_id")), "forest-texts")
    of = close.join(member.select(F.col("node").alias("a"), "cluster", "large").hint("merge"), "a")
    roots = materialize(_confirm_groups(texts.filter("NOT large").select("cluster", "node", "text"),
                                        of.filter("NOT large").select("cluster", "a", "b", "agree"), percent, least_agree), "forest-roots")
    if not member.filter("large").isEmpty():
        big = materialize(of.filter("large").select("a", "b", "agree"), "forest-big")
        roots = roots.unionByName(_large_clusters(
            big, texts.filter("large").select("node", "text"), regions, nodes,
            member.filter("large").select("cluster", "node", "n"), percent, least_agree, max(1, cluster_words // 2)))
    # the smallest id of each component
    named = nodes.drop("n", "sig").join(roots.hint("merge"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = materialize(named, "forest-named")
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"), *last_row)
    of_node = named.select("node", "root").join(least.hint("merge"), "root").drop("root")
    out = signed.drop("sig").join(of_node.hint("merge"), "node", "left")
    stays = [F.col("digest"), (F.col("node").isNull() | row.eqNullSafe(F.col("least_row"))).alias("stays")] if row_keys else []
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.coalesce("component_id", "doc_id").alias("component_id"),
                      F.col("doc_id").eqNullSafe(F.coalesce("component_id", "doc_id")).alias("kept"), *stays)


def _large_clusters(pairs: DataFrame, texts: DataFrame, regions: DataFrame, nodes: DataFrame, member: DataFrame,
                    percent: int, least: int, block_words: int) -> DataFrame:
    """(node, root) for clusters too large for one group: first each node's best
    candidate, then all candidates still between components, then the FAR neighbours
    of nodes in different components, then what is still apart with the whole
    cluster.  ``member`` (cluster, node, n)."""
    def between(p, links):
        root = materialize(components(links), "forest-linked")
        ra = root.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        rb = root.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        return root, (p.join(ra.hint("merge"), "a", "left").join(rb.hint("merge"), "b", "left")
                      .filter("coalesce(ra, a) <> coalesce(rb, b)").select("a", "b"))

    ends = pairs.select("a", "b", "agree", F.explode(F.array("a", "b")).alias("node"))
    best = ends.groupBy("node").agg(F.max_by(F.struct("a", "b"), F.struct("agree", "a", "b")).alias("p")) \
        .select("p.a", "p.b").distinct()
    links = materialize(_confirm_joined(best, texts, percent), "forest-links")
    _, left = between(pairs.select("a", "b"), links)
    links = materialize(links.unionByName(_confirm_joined(left, texts, percent)), "forest-links")
    root, _ = between(pairs.select("a", "b"), links)
    inside = regions.join(texts.select("node").hint("merge"), "node").join(root.hint("merge"), "node", "left") \
        .withColumn("root", F.coalesce("root", "node"))
    far = _agreeing(_neighbours(inside, percent, FAR, FAR, by_root=True), nodes, least).select("a", "b")
    links = materialize(links.unionByName(_confirm_joined(far, texts, percent)), "forest-links")
    root = materialize(components(links), "forest-linked")
    return components(links.unionByName(_apart_links(member, root, texts, percent, block_words)))


def _apart_links(member: DataFrame, root: DataFrame, texts: DataFrame, percent: int, block_words: int) -> DataFrame:
    """(a, b): links that join what lies outside the largest component of its cluster.
    Both the nodes outside and the cluster are dealt into blocks of about
    ``block_words`` words; a group is one block of each."""
    state = materialize(member.join(root.hint("merge"), "node", "left").withColumn("root", F.coalesce("root", "node")),
                        "forest-state")
    main = (state.groupBy("cluster", "root").count().groupBy("cluster")
            .agg(F.max_by("root", F.struct("count", "root")).alias("main")))
    state = state.join(main.hint("merge"), "cluster").withColumn("apart", F.col("root") != F.col("main"))
    blocks = state.groupBy("cluster").agg(
        F.ceil(F.sum("n") / block_words).alias("every"),
        F.ceil(F.sum(F.when(F.col("apart"), F.col("n"))) / block_words).alias("outside")).filter("outside > 0")
    state = state.join(blocks.hint("merge"), "cluster").join(texts.hint("merge"), "node")
    left = state.filter("apart").selectExpr("cluster", "pmod(xxhash64(node), outside) AS i", "node", "root", "text",
                                            "explode(sequence(0L, every - 1)) AS j")
    right = state.selectExpr("cluster", "pmod(xxhash64(node, 1), every) AS j", "node", "root", "text",
                             "explode(sequence(0L, outside - 1)) AS i").toDF("cluster", "j", "node", "root", "text", "i")

    def load(table):
        sets, names = {}, table.column("node").to_pylist()
        for low, high, texts in text_runs(table.column("text").combine_chunks()):
            for node, s in zip(names[low:high], shingle_sets(texts)):
                if node_key(s) == node:                      # another row may have the same id
                    sets[node] = s
        return sets, dict(zip(names, table.column("root").to_pylist()))

    def task(left, right):
        (xs, root), (ys, more) = load(left), load(right)
        root.update(more)
        a, b = block_links(xs, ys, root, percent) if xs and ys else ([], [])
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return (left.groupBy("cluster", "i", "j").cogroup(right.groupBy("cluster", "i", "j"))
            .applyInArrow(releasing(task), "a binary, b binary"))


def block_links(xs: dict, ys: dict, root: dict, percent: int) -> tuple[list, list]:
    """Links between sets of ``xs`` and of ``ys``, as many as join their components
    (``root`` of each node).  All pairs of different components are decided, by
    counting equal shingles; a pair without one among the rarest of x, as many as a
    linked set can't all lack, is no link."""
    names = list(ys)
    size = np.array([len(s) for s in ys.values()])
    vocabulary, place = np.unique(np.concatenate(list(ys.values())), return_inverse=True)
    owner = np.repeat(np.arange(len(names)), size)[np.argsort(place, kind="stable")]
    count = np.bincount(place)
    stop = np.cumsum(count)
    number: dict = {}
    part = np.array([number.setdefault(root[n], len(number)) for n in names])       # root of each y, as a number
    parent = {r: r for r in {root[n] for n in (*xs, *ys)}}

    def find(r):
        while parent[r] != r:
            parent[r] = parent[parent[r]]
            r = parent[r]
        return r

    def holders(ids):
        return [owner[stop[k] - count[k]:stop[k]] for k in ids.tolist()]

    a, b = [], []
    for x, s in xs.items():
        at = np.minimum(np.searchsorted(vocabulary, s), len(vocabulary) - 1)
        at = at[vocabulary[at] == s]
        rare = len(at) - -(-percent * len(s) // 100) + 1     # shared shingles that can't all be missed
        if rare < 1:
            continue
        at = at[np.argsort(count[at], kind="stable")]
        met = np.unique(np.concatenate(holders(at[:rare])))
        known = number.get(root[x], -1)
        if not (part[met] != known).any():
            continue
        both = np.bincount(np.concatenate(holders(at)), minlength=len(names))
        for j in np.flatnonzero((100 * both >= percent * (len(s) + size - both)) & (part != known)).tolist():
            rx, ry = find(root[x]), find(root[names[j]])
            if rx != ry:
                parent[max(rx, ry)] = min(rx, ry)
                a.append(x)
                b.append(names[j])
    return a, b
