"""Substring dedup against brute force over all windows."""
import hashlib
import random
import re

import numpy as np
import pytest

from boxwise.llm import automata as a

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(rows, window):
    """Per row (n_words, n_removed, kept words) of rows (doc_id, text)."""
    words = [WORD.findall(t or "") for _, t in rows]
    least = {}
    for (i, _), w in zip(rows, words):
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            if i is not None:
                least[key] = min(least.get(key, i), i)
    out = []
    for (i, _), w in zip(rows, words):
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and least[tuple(w[k:k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def check(docs_of, texts, ids, window, **options):
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256)
           for r in a.repeats(docs_of(texts, ids=ids), window=window, **options).collect()]
    assert sorted(got, key=repr) == expected(list(zip(ids, texts)), window)
    return got


def corpus(seed, n=120):
    rng = random.Random(seed)
    word = lambda: rng.choice("αbcdefgh") * rng.randint(1, 2) + str(rng.randint(0, 30))
    prose = lambda k: [word() for _ in range(k)]
    passage, texts = prose(30), []
    for _ in range(n):
        kind, own = rng.random(), prose(rng.randint(0, 90))
        if kind < 0.3 and texts:                              # a copy, a piece, or a copy with an edit
            own = rng.choice(texts).split()
            own = own[:rng.randint(0, len(own))] if rng.random() < 0.3 else own
            if own and rng.random() < 0.5:
                own[rng.randrange(len(own))] = word()
        if kind > 0.6:
            at = rng.randint(0, len(own))
            own[at:at] = passage[rng.randint(0, 5):]
        texts.append(rng.choice([" ", "\n", " \t\x0b\x1c "]).join(own))
    return texts


@pytest.mark.parametrize("seed,window,options", [
    (1, 10, {}), (2, 5, {"gram": 2}), (3, 10, {"shard_words": 200, "chunk_words": 300, "automaton_words": 60}),
    (4, 50, {}), (5, 12, {"gram": 12})])
def test_equals_brute_force(docs_of, seed, window, options):
    texts = corpus(seed)
    ids = list(range(len(texts)))
    random.Random(seed).shuffle(ids)
    assert any(r[2] for r in check(docs_of, texts, ids, window, **options)) or window == 50


def test_nulls_ties_and_repeated_rows(docs_of):
    texts = corpus(7, 40) * 2 + [None, "", " \n ", "a " * 500, "a " * 700, "b a " * 300] * 2
    ids = list(range(40)) + [5] * 20 + [None] * 10 + list(range(10)) + [50, 51, 52, 53, 54, 55, 50, 51, 52, 53, 53, 60]
    check(docs_of, texts, ids, 10, gram=4)
    assert a.repeats(docs_of(texts).limit(0)).count() == 0


def test_long_text_and_a_common_passage(docs_of, prose):
    """A text of many pieces and its copy, and one passage in most documents."""
    long, passage = prose(9000, 1), prose(60, 2)
    texts = [long, "start " + long + " end"] + [f"{prose(20, 10 + i)} {passage} {prose(i, 500 + i)}" for i in range(300)]
    ids = [900, 901] + list(range(300))
    got = {r[0]: r for r in check(docs_of, texts, ids, 50, chunk_words=2000)}
    assert got[901][2] == 9000 and got[0][2] == 0 and all(got[i][2] >= 60 for i in range(1, 300))


def test_strip_keeps_rows_and_columns(docs_of):
    texts = corpus(9, 30) + [None]
    df = docs_of(texts)
    out = a.strip(df, window=10)
    assert out.columns == df.columns and out.count() == len(texts)
    want = dict((i, k) for i, _, n, k in expected(list(enumerate(texts)), 10) if n)
    for r in out.collect():
        if r.doc_id in want:
            assert hashlib.sha256(r.text.encode()).hexdigest() == want[r.doc_id]
        else:
            assert r.text == texts[r.doc_id]


def test_automaton_equals_plain_search():
    rng = random.Random(4)
    for _ in range(200):
        refs = [([rng.choice("ab") for _ in range(rng.randint(1, 14))], d) for d in rng.sample(range(20), 4)]
        auto = a.Automaton()
        for words, d in refs:
            auto.add(words, d)
        auto.close()
        text, doc, window = [rng.choice("abc") for _ in range(30)], rng.randint(0, 20), rng.randint(1, 5)
        want = [i for i in range(window - 1, 30) if any(
            d < doc and text[i - window + 1:i + 1] == words[k:k + window] for words, d in refs for k in range(len(words) - window + 1))]
        assert auto.matches(text, doc, window) == want


def test_hashes():
    """Equal stretches have equal hashes wherever they stand; words are cut as the pattern cuts them."""
    texts = ["a bb  a bb", "", "\tx\x0b é\x1cz ", "bb"]
    hashes, counts = a.word_hashes(texts)
    assert counts.tolist() == [len(WORD.findall(t)) for t in texts]
    assert hashes[0] == hashes[2] and hashes[1] == hashes[3] == hashes[-1] and len(set(hashes.tolist())) == 4
    x = np.random.default_rng(0).integers(0, 50, 200).astype(np.uint64)
    assert (a._least(x, 7) == np.array([x[i:i + 7].min() for i in range(194)])).all()
