"""Stages against brute force on a small table, and the registered names."""
import corpus_pipeline

from boxwise.session import materialize


def test_stages(spark, docs_of, prose):
    en = "the people of the town and the river were in it "
    base = en + prose(150, 8)
    secret = en * 4 + "password = hunter2hunter2 end"
    texts = [base, base, base + " more", secret, None, "123", en * 12, "le chat et la maison des gens dans la ville " * 6]
    langs = ["en"] * 7 + ["fr"]
    docs = docs_of(texts, langs=langs).select("doc_id", "text", "lang", "source", "n_chars")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, ""), name)
        seen[name] = docs
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = {k: sorted(r.doc_id for r in v.select("doc_id").distinct().collect()) for k, v in seen.items()}
    assert ids["language_id"] == [0, 1, 2, 3, 6, 7]
    assert ids["exact_dedup"] == [1, 2, 3, 6, 7]
    assert ids["near_dedup"] == ids["secret_scans"] == ids["packing"] == [1, 3, 6, 7]
    text = {r.doc_id: r.text for r in seen["secret_scans"].collect()}
    assert "hunter2" not in text[3] and text[6] == texts[6]


def test_near_copies_with_equal_or_null_ids(spark, docs_of, prose):
    a, b, c, d = (prose(120, 20 + k) for k in range(4))
    texts = [a, a + " more", b, c, c + " more", d, d + " more", None]
    docs = docs_of(texts + [a, None], ids=[1, 2, 2, 5, 5, None, None, 9, 1, 9])
    left = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    assert {(1, a), (2, b), (9, None)} <= set(left) and (2, a + " more") not in left
    assert sum(i == 5 for i, _ in left) == 1 and sum(i is None for i, _ in left) == 1 and sum(i == 1 for i, _ in left) == 1


def test_columns_with_clashing_names(spark, docs_of, prose):
    """Extra columns named like the stages' own pass unread through every stage but the last."""
    names = ["language", "certainty", "_language", "digest", "_digest", "row", "gone_id", "t", "score", "lang_pred", "node"]
    en = "the people of the town and the river were in it "
    base = docs_of([en + prose(150, 8), en + prose(150, 8), en + prose(120, 9) + " password = hunter2hunter2", None])
    docs = base.select("doc_id", "text", "lang", "source", "n_chars").selectExpr("*", *[f"doc_id * 10 + {i} AS `{n}`" for i, n in enumerate(names)])
    want = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, ""), name)
        assert docs.columns == want
        for r in docs.collect():
            assert all(r[n] == r.doc_id * 10 + i for i, n in enumerate(names))
    assert sorted(r.doc_id for r in docs.collect()) == [1, 2]


def test_registered_once_for_each_operator():
    from boxwise.llm import queries
    numbers = [int(n[2:].split("_")[0]) for n in queries.QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    import __spark_entry__ as entry
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
