"""Best-fit packing by a grouping genetic algorithm.

Documents become pieces: their ids and the end id, cut into full sequences where
they are longer than one (the first piece takes the remainder).  Full pieces are
sequences of their own.  The others are packed by a grouping genetic algorithm:
an individual is a partition of the pieces into bins; crossover injects the
well-filled bins of one parent whole into the other, dissolves the bins that then
hold a piece twice, and best-fits the displaced pieces; mutation dissolves some
badly filled bins.  An individual is better with fewer bins, then with a higher
mean of squared fill.  Individuals start as varied first fits; best fit serves
displaced pieces only, so what comes out is the search's.

Distribution: pieces are dealt by hash into shards of about ``shard_items``
pieces.  ``islands`` populations evolve each shard as separate Spark groups; after
each epoch the elites of an island move to the next one (written to the shared
folder, so a lost executor costs one epoch of one island).  Bins that are badly
filled at the end meet in further rounds across shards while that saves bins.  A
population stops early once it has as few bins as the lengths allow.

Defined results: null text counts as empty and packs as its end id alone; rows
with equal id are packed one by one (``piece_id`` tells them apart); an empty
table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxwise.llm import bpe, tokens
from boxwise.llm.common import releasing_batches, store
from boxwise.session import materialize


# ------------------------------------------------------------------ pieces ---

def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    out = [(0, first)] if first else []
    return out + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, vocabulary: str, *, end_id: int, capacity: int = 1024, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(piece_id, doc_id, piece, start, length, ids), written once to the shared
    folder; ids are little-endian unsigned 32-bit integers."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))

    def task(batches):
        lib = tokens.loaded(shared.value)
        for batch in batches:
            for low, high, texts in bpe.text_runs(batch.column("text")):
                ids, per_text = tokens.append_end(*lib.encode(texts), end_id)
                data, edge = ids.astype("<u4"), np.concatenate([[0], np.cumsum(per_text)])
                row, piece, start, length = [], [], [], []
                for i, n in enumerate(per_text.tolist()):
                    for k, (s, m) in enumerate(cut_points(n, capacity)):
                        row.append(i)
                        piece.append(k)
                        start.append(s)
                        length.append(m)
                at = edge[row] + np.array(start)
                payload = [data[a:a + m].tobytes() for a, m in zip(at.tolist(), length)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, high - low).take(pa.array(row)), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(payload, pa.binary())],
                    names=["doc_id", "piece", "start", "length", "ids"])

    schema = T.StructType([src.schema["doc_id"], T.StructField("piece", T.IntegerType()),
                           T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                           T.StructField("ids", T.BinaryType())])
    return store(src.mapInArrow(releasing_batches(task), schema).withColumn("piece_id", F.monotonically_increasing_id()), "packing-pieces")


# ------------------------------------------------------- genetic algorithm ---

class Bins:
    """Open bins by room left, for best-fit insertion."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.rooms = 0                                       # bit r: some bin has room r

    def add(self, b: int, room: int) -> None:
        self.by_room[room].append(b)
        self.rooms |= 1 << room

    def take(self, need: int) -> tuple[int, int] | None:
        """(bin, room) of a bin with the least room that is enough."""
        fit = self.rooms >> need
        if not fit:
            return None
        room = need + (fit & -fit).bit_length() - 1
        own = self.by_room[room]
        b = own.pop()
        if not own:
            self.rooms &= ~(1 << room)
        return b, room


def first_fit(lengths: np.ndarray, order: np.ndarray, capacity: int) -> np.ndarray:
    """Place the items in ``order``, each into the first bin it fits; a tree over the bins
    holds the most room below each node."""
    n, size = len(lengths), 1
    while size < n:
        size *= 2
    room, assign = [capacity] * (2 * size), np.empty(n, np.int64)
    for i, need in zip(order.tolist(), lengths[order].tolist()):
        k = 1
        while k < size:
            k *= 2
            k += room[k] < need                              # the left bins have no room for it
        assign[i] = k - size
        room[k] -= need
        while k > 1:
            k //= 2
            most = max(room[2 * k], room[2 * k + 1])
            if room[k] == most:
                break
            room[k] = most
    return assign                                            # bins are numbered from 0 without gaps


def best_fit(lengths: np.ndarray, assign: np.ndarray, todo: np.ndarray, capacity: int) -> np.ndarray:
    """Place the items ``todo`` (in this order) into the bins of ``assign`` (-1: no
    bin), each into the fullest one it fits, else into a new one."""
    assign = assign.copy()
    placed = np.flatnonzero(assign >= 0)
    used, inverse = np.unique(assign[placed], return_inverse=True)
    assign[placed] = inverse
    fill = np.bincount(inverse, weights=lengths[placed], minlength=len(used)).astype(np.int64)
    bins = Bins(capacity)
    for b, f in enumerate(fill.tolist()):
        if f < capacity:
            bins.add(b, capacity - f)
    n = len(used)
    for i, need in zip(todo.tolist(), lengths[todo].tolist()):
        found = bins.take(need)
        if found is None:
            found = (n, capacity)
            n += 1
        b, room = found
        assign[i] = b
        if room > need:
            bins.add(b, room - need)
    return assign


def quality(lengths: np.ndarray, assign: np.ndarray, capacity: int) -> tuple[int, float]:
    """(minus bins, mean squared fill): larger is better."""
    fill = np.bincount(assign, weights=lengths)
    return -len(fill), float(((fill / capacity) ** 2).mean())


def crossover(lengths, a: np.ndarray, b: np.ndarray, capacity: int, rng) -> np.ndarray:
    """Inject a random share of b's well-filled bins into a."""
    fill = np.bincount(b, weights=lengths)
    good = np.flatnonzero(fill >= np.median(fill))
    chosen = rng.choice(good, max(1, int(len(good) * rng.uniform(0.1, 0.5))), replace=False)
    injected = np.isin(b, chosen)
    child = a.copy()
    hit = np.zeros(a.max() + 1, bool)
    hit[a[injected]] = True                                  # bins that would hold a piece twice
    displaced = hit[a] & ~injected
    child[displaced] = -1
    child[injected] = a.max() + 1 + b[injected]
    todo = np.flatnonzero(displaced)
    return best_fit(lengths, child, todo[np.argsort(-lengths[todo], kind="stable")], capacity)


def mutate(lengths, a: np.ndarray, capacity: int, rng) -> np.ndarray:
    """Dissolve the worst-filled bins and a few others; best-fit their pieces."""
    fill = np.bincount(a, weights=lengths)
    k = max(2, len(fill) // 50)
    gone = np.zeros(len(fill), bool)
    gone[np.argsort(fill, kind="stable")[:k]] = True
    gone[rng.integers(0, len(fill), k)] = True
    child = np.where(gone[a], -1, a)
    todo = np.flatnonzero(gone[a])
    noise = lengths[todo] * rng.uniform(0.9, 1.1, len(todo))
    return best_fit(lengths, child, todo[np.argsort(-noise, kind="stable")], capacity)


def evolve(lengths: np.ndarray, population: list[np.ndarray], capacity: int, generations: int, size: int, patience: int, rng):
    """(population, its qualities), best first, after at most ``generations`` children.

    A missing individual starts as a first fit in falling order of the lengths, each
    times a random factor; the factors vary more from individual to individual, so
    starts differ in which pieces share a bin.  The search ends early once no packing
    can have fewer bins, or when ``patience`` children in a row bring no better best."""
    least = -(-int(lengths.sum()) // capacity)
    population = list(population)
    while len(population) < size:
        spread = 0.3 * (len(population) + 1) / size
        key = lengths * rng.uniform(1 - spread, 1 + spread, len(lengths))
        population.append(first_fit(lengths, np.argsort(-key, kind="stable"), capacity))
    ranked = sorted(((quality(lengths, p, capacity), i) for i, p in enumerate(population)), reverse=True)
    population, scores = [population[i] for _, i in ranked], [q for q, _ in ranked]
    stale = 0
    for _ in range(generations):
        if -scores[0][0] == least or len(population) < 2 or stale == patience:
            break
        i, j = sorted(rng.choice(len(population), 2, replace=False))
        child = mutate(lengths, crossover(lengths, population[i], population[j], capacity, rng), capacity, rng)
        q = quality(lengths, child, capacity)
        stale = 0 if q > scores[0] else stale + 1
        if q > scores[-1]:
            at = next(k for k, s in enumerate(scores) if q > s)
            population.insert(at, child)
            scores.insert(at, q)
            population, scores = population[:size], scores[:size]
    return population, scores


ISLAND = "shard bigint, island int, rank int, bins bigint, square double, piece_ids array<bigint>, lengths array<bigint>, assign array<bigint>"


def _epoch(capacity: int, generations: int, size: int, patience: int, elites: int, islands: int, seed: int):
    """Evolve one island of one shard: rows are its individuals (or, at first, one
    row without assignment)."""
    def task(key, table):
        shard, island = key[0].as_py(), key[1].as_py()
        rows = table.sort_by([("rank", "ascending"), ("bins", "ascending")]).to_pylist()
        lengths = np.array(rows[0]["lengths"], np.int64)
        rng = np.random.default_rng([seed, shard & 0x7FFFFFFF, island])
        start = [np.array(r["assign"], np.int64) for r in rows if r["assign"] is not None]
        population, scores = evolve(lengths, start, capacity, generations, size, patience, rng)
        # the population stays, and copies of its elites move on to the next island
        keep = [(island, k) for k in range(len(population))]
        move = [((island + 1) % islands, k) for k in range(min(elites, len(population)))] if islands > 1 else []
        out = [{"shard": shard, "island": to, "rank": k, "bins": -scores[k][0], "square": scores[k][1],
                "piece_ids": rows[0]["piece_ids"], "lengths": rows[0]["lengths"], "assign": population[k].tolist()}
               for to, k in keep + move]
        return pa.Table.from_pylist(out, schema=table.schema)
    return task


def _round(items: DataFrame, n_items: int, *, capacity: int, shard_items: int, islands: int, epochs: int,
           generations: int, size: int, patience: int, elites: int, seed: int) -> DataFrame:
    """(piece_id, length, bin, fill) of one round over (piece_id, length); bins
    are numbered shard * 2^24 + bin."""
    shards = max(1, -(-n_items // shard_items))
    # a shard is a bounded group: the hash spreads piece ids evenly over the shards
    state = (items.withColumn("shard", F.pmod(F.xxhash64("piece_id", F.lit(seed)), F.lit(shards)))
             .groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("length", "piece_id")), asc=False).alias("i"))
             .selectExpr("shard", "explode(sequence(0, " + str(islands - 1) + ")) AS island", "0 AS rank",
                         "cast(0 AS bigint) AS bins", "0D AS square", "i.piece_id AS piece_ids", "i.length AS lengths",
                         "cast(null AS array<bigint>) AS assign"))
    for e in range(epochs):
        state = materialize(state.groupBy("shard", "island").applyInArrow(
            _epoch(capacity, generations, size, patience, elites, islands, seed + e), ISLAND), "packing-epoch")
    best = state.groupBy("shard").agg(F.max_by(F.struct("piece_ids", "lengths", "assign"), F.struct(
        -F.col("bins"), "square", "island")).alias("b"))
    flat = best.selectExpr("shard", "explode(arrays_zip(b.piece_ids, b.lengths, b.assign)) AS x").selectExpr(
        "x.piece_ids AS piece_id", "x.lengths AS length", "shard * 16777216 + x.assign AS bin")
    return flat


def pack(items: DataFrame, *, capacity: int = 1024, shard_items: int = 8192, islands: int = 2, epochs: int = 2,
         generations: int = 80, size: int = 4, patience: int = 30, elites: int = 1, rounds: int = 3,
         badly_filled: float = 0.98, seed: int = 5) -> DataFrame:
    """(piece_id, bin, offset) of the items (piece_id, length), length < capacity.  At most
    ``generations`` children an epoch and island."""
    opts = dict(capacity=capacity, shard_items=shard_items, islands=islands, epochs=epochs, generations=generations,
                size=size, patience=patience, elites=elites)
    done = None
    todo, n = items, items.count()
    for r in range(rounds):
        if not n:
            break
        packed = materialize(_round(todo, n, seed=seed + 101 * r, **opts)
                             .withColumn("bin", F.col("bin") + F.lit(r << 56)), "packing-round")
        fills = packed.groupBy("bin").agg(F.sum("length").alias("fill"), F.count("*").alias("c"))
        # further rounds pay off only where several shards leave badly filled bins
        last = r == rounds - 1 or n <= shard_items
        bad = fills.filter(F.col("fill") < badly_filled * capacity).select("bin")
        if last:
            done = packed if done is None else done.unionByName(packed)
            break
        good = packed.join(bad, "bin", "left_anti")
        todo = materialize(packed.join(bad, "bin", "left_semi").select("piece_id", "length"), "packing-rest")
        done = good if done is None else done.unionByName(good)
        n = todo.count()
    if done is None:
        return items.selectExpr("piece_id", "piece_id AS bin", "cast(0 AS bigint) AS offset").limit(0)
    from pyspark.sql import Window
    place = Window.partitionBy("bin").orderBy(F.desc("length"), "piece_id").rowsBetween(Window.unboundedPreceding, -1)
    return done.select("piece_id", "bin", F.coalesce(F.sum("length").over(place), F.lit(0)).alias("offset"))


def pack_documents(docs: DataFrame, vocabulary: str, *, end_id: int = 2, capacity: int = 1024,
                   id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, piece, start, length, ids, sequence_id, offset) of all pieces."""
    p = pieces(docs, vocabulary, end_id=end_id, capacity=capacity, id_col=id_col, text_col=text_col)
    plan = pack(p.filter(F.col("length") < capacity).select("piece_id", "length"), capacity=capacity, **options)
    full = p.filter(F.col("length") == capacity).withColumns(
        {"sequence_id": -F.col("piece_id") - 1, "offset": F.lit(0).cast("bigint")})
    part = p.filter(F.col("length") < capacity).join(
        plan.withColumnRenamed("bin", "sequence_id").hint("merge"), "piece_id")
    return full.unionByName(part.select(full.columns))
