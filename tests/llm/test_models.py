"""Quality classifier and language ID on held-out rows; WARC round trips; near-dedup."""
import hashlib
import io
import random
from collections import Counter

import numpy as np
import pytest

from boxwise.llm import langid, lsh_forest, quality_bt, warc


def test_quality_held_out(spark, sf):
    from boxwise.llm import queries
    got = queries.QUERIES["op1_quality_classifier"](spark, sf).join(
        spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").collect()
    right = [r.predicted == r.quality for r in got]
    assert len(got) > 5 and np.mean(right) >= 0.9
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)


def test_quality_edges(spark, docs_of):
    labels = spark.createDataFrame([(0, 1), (1, 0), (99, 1), (None, 0)], "doc_id bigint, quality int")
    texts = ["The cat sat on the mat, and it was warm. " * 5, "BUY!! NOW!! $$$ ### " * 9, None, "", "w " * 50_000]
    d = docs_of(texts)
    m = quality_bt.fit(d, labels)
    got = {r.id: r.score for r in quality_bt.score(d, m).collect()}
    assert got[0] > got[1] and got[2] == got[3] and len(got) == 5
    none = quality_bt.fit(d, labels.limit(0))
    assert all(r.score == 0.5 for r in quality_bt.score(d, none).collect())
    assert quality_bt.score(d.limit(0), m).count() == 0


def test_language_held_out(spark, sf):
    from boxwise.llm import queries
    got = queries.QUERIES["op10_language_id"](spark, sf).join(
        spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(got) > 20 and np.mean([r.lang_pred == r.lang for r in got]) >= 0.95


def test_language_edges(docs_of):
    en, fr = "the house and the garden of the people were warm ", "la maison et le jardin des gens étaient chauds "
    texts = [en * 30, fr * 30, en, fr, None, "", "123 !!", en * 3000] + [en * k for k in range(5, 25)] + [fr * k for k in range(5, 25)]
    langs = ["en", "fr", "en", "fr", "en", None, "en", "en"] + ["en"] * 20 + ["fr"] * 20
    d = docs_of(texts, langs=langs)
    m = langid.fit(d)
    got = {r.doc_id: r for r in langid.predict(d, m, pred_col="p", score_col="s").collect()}
    assert got[0].p == "en" and got[1].p == "fr" and got[7].p == "en"
    assert [got[i].p for i in (4, 5, 6)] == ["und"] * 3 and got[4].s == 0
    assert langid.fit(d.limit(0)) is None
    assert {r.p for r in langid.predict(d, None, pred_col="p").collect()} == {"und"}


def test_one_product_equals_the_filters():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 256, (300, langid.WINDOW)).astype(np.uint8)
    m = langid.train(x, rng.integers(0, 3, 300), ["a", "b", "c"], epochs=1)
    assert np.allclose(langid._pooled(m, x), langid._pooled_at_once(m, x), atol=1e-4)


def test_warc_ranges_own_each_record_once():
    rng = random.Random(2)
    # payloads that compress badly and ones that hold gzip magics
    bodies = [bytes(rng.randrange(256) for _ in range(rng.randint(0, 3000))) + warc.MAGIC * rng.randint(0, 4) for _ in range(40)]
    data = b"".join(warc.gzip_member(warc.record(i, f"http://x/{i}", b, None), 6) for i, b in enumerate(bodies))
    for step in (len(data), 1000, 137):
        seen = [warc.parse(r) for s in range(0, len(data), step)
                for r in warc.read_range(io.BytesIO(data), len(data), s, min(s + step, len(data)))]
        assert [int(r["headers"]["x-page-id"]) for r in seen] == list(range(40))
        assert [r["payload"] for r in seen] == bodies


def test_warc_rows(spark):
    from boxwise.session import ship_package
    ship_package(spark)
    long, short = "é" * 600, "s" * 900
    rows = [(1, "u1", long, "x"), (2, None, long, "x"), (3, "u\r\n3", long, "x"), (4, "u", short, "x"), (5, "u", short, "x"),
            (6, "u", None, "x"), (7, "u", "", "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, digest string").repartition(2)
    got = {int(r.page_id): r for r in warc.read(spark, warc.archive(pages), range_bytes=300).collect()}
    assert len(got) == 7
    assert [(got[i].record_type, got[i].refers_to) for i in (1, 2, 3)] == [("revisit", "3"), ("revisit", "3"), ("response", None)]
    assert all(got[i].record_type == "response" for i in (4, 5, 6, 7))
    assert got[1].payload_bytes == 1200 and bytes(got[3].payload).decode() == long and got[6].payload_bytes == 0
    assert warc.read(spark, warc.archive(pages.limit(0))).count() == 0


def brute_components(texts, percent=75):
    sets = []
    for t in texts:
        w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", (t or "").translate(
            {c: c + 32 for c in range(65, 91)})) if x]
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(texts)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * k >= percent * (len(sets[i]) + len(sets[j]) - k):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [len(s) for s in sets], [find(i) for i in range(len(texts))]


def edits(text, k, seed):
    rng, w = random.Random(seed), text.split()
    for _ in range(k):
        w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize("options", [{}, {"region_rows": 20, "cluster_words": 600}])
def test_near_dedup_matches_brute_force(docs_of, prose, options):
    texts = [None, "", " \n", "a b", "A  B", "a b c", prose(200, 1).upper()]
    for g in range(12):
        base = prose(150 + 10 * g, 100 + g)
        texts += [base, base] + [edits(base, k, 7 * g + k) for k in (1, 2, 3, 5, 8, 12)]
    hub = prose(120, 55)
    texts += [edits(hub, 2, 900 + i) for i in range(60)]
    texts += [prose(60, 77) + " " + prose(300, 500 + i) for i in range(20)]        # a shared passage only
    n, root = brute_components(texts)
    got = {r.doc_id: r for r in lsh_forest.near_duplicates(docs_of(texts), **options).collect()}
    assert [got[i].n_shingles for i in range(len(texts))] == n
    assert [got[i].component_id for i in range(len(texts))] == root
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_near_dedup_hub_of_a_large_cluster(docs_of, prose):
    hub = prose(150, 5, words=10**6)
    words, rng, texts = hub.split(), random.Random(4), [hub]
    for i in range(3000):                            # each is linked with the hub, hardly any with another
        w = list(words)
        for k in range(4):
            w[rng.randrange(4 + 36 * k, 36 + 36 * k)] = f"edit{i}x{k}"
        texts.append(" ".join(w))
    got = lsh_forest.near_duplicates(docs_of(texts), cluster_words=100_000).collect()
    assert {r.component_id for r in got} == {0} and sum(r.kept for r in got) == 1


@pytest.mark.parametrize("few", [lsh_forest.FEW, 3])
def test_near_dedup_divided_regions(docs_of, prose, monkeypatch, few):
    monkeypatch.setattr(lsh_forest, "FEW", few)
    texts = []
    for g in range(150):
        base = prose(90, 1000 + g, words=10**6)
        texts += [base, edits(base, 2, g), edits(base, 3, g)]
    hub = prose(120, 55)
    texts += [edits(hub, 2, 900 + i) for i in range(40)] + [hub + " " + prose(60, 300 + i) for i in range(20)]
    n, root = brute_components(texts)
    got = {r.doc_id: r.component_id for r in lsh_forest.near_duplicates(docs_of(texts), region_rows=1).collect()}
    assert [got[i] for i in range(len(texts))] == root


def test_block_links_decide_all_pairs():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 60, 400, dtype=np.uint64)
    sets = {bytes([i]): np.unique(rng.choice(base[:60 + 3 * (i % 7)], 50 + i % 9, replace=False)) for i in range(120)}
    for percent in (60, 75, 90):
        a, b = lsh_forest.block_links(sets, sets, {n: n for n in sets}, percent)
        assert all(lsh_forest.linked(sets[x], sets[y], percent) for x, y in zip(a, b))

        def parts(links):
            of = {n: n for n in sets}
            for x, y in links:
                low, high = sorted((of[x], of[y]))
                of = {n: low if r == high else r for n, r in of.items()}
            return of
        assert parts(zip(a, b)) == parts((x, y) for x in sets for y in sets if x < y and lsh_forest.linked(sets[x], sets[y], percent))


def test_near_dedup_edges(docs_of, prose):
    t = prose(50, 3)
    d = docs_of([t, t, t, None], ids=[4, 4, None, 9])
    got = sorted(((r.doc_id or -1), r.component_id) for r in lsh_forest.near_duplicates(d).collect())
    assert got == [(-1, 4), (4, 4), (4, 4), (9, 9)]
    assert lsh_forest.near_duplicates(d.limit(0)).count() == 0


@pytest.mark.parametrize("options", [{}, {"cluster_words": 10}, {"region_rows": 1}])
def test_near_dedup_null_id_near_copy(docs_of, prose, options):
    t = prose(100, 3)
    d = docs_of([t, t + " one", t + " two", prose(100, 4), prose(100, 4) + " three"], ids=[4, None, 7, None, None])
    got = sorted((r.n_shingles, r.doc_id or -1, r.component_id or -1) for r in lsh_forest.near_duplicates(d, **options).collect())
    assert got == [(96, -1, -1), (96, 4, 4), (97, -1, -1), (97, -1, 4), (97, 7, 4)]


def test_components_of_chains_and_stars(spark):
    def key(i):
        return i.to_bytes(16, "big")
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 150)] + [(201, 200)]
    df = spark.createDataFrame([(bytearray(key(a)), bytearray(key(b))) for a, b in edges], "a binary, b binary")
    got = {int.from_bytes(r.node, "big"): int.from_bytes(r.root, "big") for r in lsh_forest.components(df).collect()}
    assert {got[i] for i in range(61)} == {0} and {got[i] for i in range(100, 150)} == {100} and got[201] == 200


def test_warc_of_others(spark, tmp_path):
    """An archive of another writer: other versions and record types, no own headers, a damaged
    member, bytes between members; everything is a row."""
    from boxwise.session import ship_package
    ship_package(spark)

    def member(lines, block):
        return warc.gzip_member("\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode() + block + b"\r\n\r\n")

    page = b"HTTP/1.1 200 OK\r\n\r\n<p>hello</p>"
    good = member(["WARC/1.0", "WARC-Type: response", "WARC-Target-URI: http://a/"], page)
    digest = hashlib.sha1(b"<p>hello</p>").hexdigest()
    hexed = member(["WARC/1.1", "WARC-Type: response", "WARC-Target-URI: http://b/", f"WARC-Payload-Digest: sha1:{digest}"], page)
    parts = [member(["WARC/1.0", "WARC-Type: warcinfo"], b"software: x"), good,
             member(["WARC/1.0", "WARC-Type: request", "WARC-Target-URI: http://a/"], b"GET / HTTP/1.1\r\n\r\n"),
             good[:-9] + bytes([good[-9] ^ 255]) + good[-8:], b"rubbish", hexed,
             member(["WARC/1.1", "WARC-Type: resource", "WARC-Target-URI: http://c/"], b"plain"), good[:40]]
    path = tmp_path / "other.warc.gz"
    path.write_bytes(b"".join(parts))
    files = spark.createDataFrame([(str(path), path.stat().st_size)], "path string, n_bytes bigint")
    for step in (1 << 20, 200, 61):
        rows = warc.read(spark, files, range_bytes=step).collect()
        kinds = Counter(r.record_type for r in rows)
        assert kinds[warc.DAMAGED] >= 2
        del kinds[warc.DAMAGED]
        assert kinds == {"warcinfo": 1, "request": 1, "response": 2, "resource": 1}
        by = {r.url: r for r in rows if r.record_type in ("response", "resource")}
        assert bytes(by["http://a/"].payload) == bytes(by["http://b/"].payload) == b"<p>hello</p>"
        assert by["http://a/"].payload_digest == by["http://b/"].payload_digest == digest and by["http://a/"].page_id is None
        assert bytes(by["http://c/"].payload) == b"plain" and by["http://c/"].payload_bytes == 5


def test_warc_report_counts_what_is_missing(spark):
    from boxwise.session import ship_package
    ship_package(spark)
    rows = [(i if i % 7 else None, f"u{i}", "same " * 300 if i % 3 else f"{i}" * 50) for i in range(60)] + [(5, "u", "same " * 300)] * 3
    rows += [(99, "u", "long " * 600_000)]                   # a member of many read chunks
    report = warc.archive(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3))
    records = warc.read(spark, report, range_bytes=500)
    assert records.count() == 64 and warc.missing(report, records) == 0
    got = [r for r in records.collect() if r.page_id == "99"]
    assert got[0].payload_bytes == 3_000_000 and bytes(got[0].payload) == b"long " * 600_000
    assert records.where("page_id IS NULL").count() == sum(r[0] is None for r in rows)
    # of rows with the largest id of a group one stays, or all where they are that row
    path = report.first().path
    data = bytearray(open(path, "rb").read())
    data[len(data) // 2] ^= 255
    open(path, "wb").write(data)
    again = warc.read(spark, report, range_bytes=500)
    assert warc.missing(report, again) == 1 and again.where("record_type = 'damaged'").count() >= 1


def test_language_sample_is_that_of_a_window(spark, docs_of):
    """The least distinct hashes of each language, with one language held by most rows and copies."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    texts = [f"w{i % 900} text" for i in range(3000)] + ["rare one", "rare two"] + ["copy of one text"] * 500
    rows = docs_of(texts, langs=["en"] * 3000 + ["fr"] * 2 + ["de"] * 500).selectExpr("lang", "xxhash64(text) AS h")
    order = Window.partitionBy("lang").orderBy("h")
    want = {r.lang: r.top for r in rows.distinct().withColumn("r", F.row_number().over(order)).filter("r <= 100")
            .groupBy("lang").agg(F.max("h").alias("top")).collect()}
    assert langid._least_hashes(rows, 100) == want
    plan = rows.groupBy("lang").count()._jdf.queryExecution().toString()
    assert "Window" not in plan


def test_language_of_repeated_rows_and_clashing_columns(spark, docs_of):
    en, fr = "the cat and the house of the people ", "le chat et la maison des gens "
    d = docs_of([en * 4, fr * 4, en * 4, fr * 4, None], langs=["en", "fr", "en", "fr", None])
    out = langid.predict(d, langid.fit(d), pred_col="lang", score_col="score")
    assert sorted(out.columns) == sorted(d.columns)          # its columns take the places of these names
    got = {r.doc_id: r for r in out.collect()}
    assert [got[i].lang for i in range(5)] == ["en", "fr", "en", "fr", "und"] and got[0].score == got[2].score


@pytest.mark.parametrize("percent", [60, 75, 90])
def test_near_links_at_any_percentage(spark, docs_of, percent):
    """Components against brute force, with pairs on both sides of the line."""
    rng = random.Random(percent)
    texts = []
    for g in range(25):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(30, 80))]
        for _ in range(4):
            own = list(words)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = f"x{rng.randrange(5000)}"
            texts.append(" ".join(own))
    sets = [set(zip(*(t.split()[k:] for k in range(5)))) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    for options in ({}, {"cluster_nodes": 2}):
        got = {r.doc_id: r.component_id for r in lsh_forest.near_duplicates(docs_of(texts), percent=percent, **options).collect()}
        assert got == {i: find(i) for i in range(len(texts))}


def test_hub_edges_are_dealt_out(spark):
    """A star of 30,000 edges: AQE splits the joins of its hub."""
    edges = spark.range(1, 30_000).selectExpr("unhex(lpad(hex(0), 8, '0')) AS a", "unhex(lpad(hex(id), 8, '0')) AS b")
    roots = lsh_forest.components(edges)
    assert roots.count() == 30_000 and roots.select("root").distinct().count() == 1
