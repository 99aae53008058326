"""Byte-level BPE, cached tokenizer slices, token files, packing."""
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from boxwise.llm import bpe, merging, packing, token_codec, tokens

ALPHABET = " \t\n\r\x1c\x85 'sStrevmldLTab1²Ⅷ½é中文ا!?.-_<>|😀́‍ÉÄΣςK�"


def odd_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(n)] + [
        "", " ", "'s", "don't WE'LL '''s", "a" * 5000, "ab" * 3000, "   x", "\n\n", "<|endoftext|> x", "İstanbul!"]


def read(name, mode="rb"):
    with open(public_tokenizers.path(name), mode) as f:
        return f.read()


@pytest.fixture(scope="module")
def merges():
    return bpe.Merges(bpe.parse_ranks(read("byte_bpe_multi_50k.tiktoken")))


def test_bpe_equals_the_library(merges):
    texts = odd_texts(4000, 1)
    ids, offsets, per_text = bpe.encode_texts(merges, texts)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges.ranks, special_tokens={})
    edge = np.concatenate([[0], np.cumsum(per_text)])
    for i, want in enumerate(own.encode_ordinary_batch(texts, num_threads=1)):
        part = slice(edge[i], edge[i + 1])
        assert ids[part].tolist() == want
        assert bpe.decode_ids(merges, ids[part], offsets[part]) == texts[i].encode()


def test_scan_is_associative():
    """Blocked products equal a plain walk of the automaton, at any length."""
    of_class, table, act, _ = bpe._monoid()
    step, _ = bpe._automaton()
    rng = np.random.default_rng(0)
    for n in (1, 63, 64, 65, 5000):
        c = rng.integers(0, 9, n)
        got = act[bpe.scan(of_class[c], table), bpe.START]
        s, want = bpe.START, []
        for x in c:
            want.append(s)
            s = step[s, x]
        assert got.tolist() == want


def test_bpe_rows(docs_of):
    ranks = read("byte_bpe_multi_50k.tiktoken")
    texts = [None, "", "hello world's", "x" * 300_000, "same", "same"]
    got = {r.id: r for r in bpe.decode(bpe.encode(docs_of(texts), ranks), ranks).collect()}
    for i, t in enumerate(texts):
        assert bytes(got[i].decoded) == (t or "").encode()
        assert len(got[i].ids) == len(got[i].offsets)
    assert got[4].ids == got[5].ids
    assert bpe.encode(docs_of(texts).limit(0), ranks).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_cached_slices_equal_the_library(name):
    lib = tokens.Library(read(name, "r"))
    texts = odd_texts(4000, 2)
    ids, per_text = lib.encode(texts)
    edge = np.concatenate([[0], np.cumsum(per_text)])
    assert [ids[a:b].tolist() for a, b in zip(edge, edge[1:])] == lib.whole(texts)


@pytest.mark.parametrize("n", [1, 2, 129, 70_000])
def test_codec_round_trip(n):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 49_408, n), rng.zipf(1.3, n) % 49_408, np.full(n, 49_407), np.zeros(n)):
        ids = ids.astype(np.uint32)
        block = token_codec.encode_block(ids)
        assert (token_codec.decode_block(block) == ids).all()
    assert len(block) < 400 + 2 * n / 8 + 10 * -(-n // 128)


def test_codec_carry_and_damage():
    ids = np.tile(np.array([1, 2, 3, 1, 2, 4], np.uint32), 5000)
    block = token_codec.encode_block(ids)
    assert (token_codec.decode_block(block) == ids).all()
    for at in (5, 60, len(block) - 1):
        with pytest.raises(ValueError):
            token_codec.decode_block(block[:at] + bytes([block[at] ^ 8]) + block[at + 1:])


def test_token_files(spark, docs_of, prose):
    texts = [prose(50, i) for i in range(30)] + [None, "", prose(40_000, 5)]
    ids = list(range(32, -1, -1))
    lib = tokens.Library(read("word_bpe_49k.json", "r"))
    manifest = token_codec.write(docs_of(texts, ids=ids), read("word_bpe_49k.json", "r"), end_id=2)
    got = {int(r.name): r for r in token_codec.read(spark, manifest).collect()}
    start = 0
    for i, t in sorted(zip(ids, texts)):
        want = lib.whole([t or ""])[0] + [2]
        assert got[i].start == start and np.frombuffer(got[i].ids, "<u4").tolist() == want
        start += len(want)
    assert token_codec.read(spark, token_codec.write(docs_of(texts).limit(0), read("word_bpe_49k.json", "r"),
                                                     end_id=2)).count() == 0


def check_packing(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for seq in by.values():
        at = 0
        for offset, length in sorted(seq):
            assert offset == at
            at += length
        assert at <= capacity
    return by


def test_packing(spark, docs_of, prose):
    vocabulary = read("byte_bpe_50k.json", "r")
    lib = tokens.Library(vocabulary)
    texts = [prose(5 + 7 * i, i) for i in range(60)] + [None, "", prose(3000, 9), "x", "x"]
    rows = packing.pack_documents(docs_of(texts, ids=[i // 2 for i in range(len(texts))]), vocabulary, shard_items=16,
                                  islands=3, epochs=2).collect()
    by = check_packing(rows, 1024)
    total = sum(r.length for r in rows)
    assert total == sum(len(x) + 1 for x in lib.whole([t or "" for t in texts]))
    assert len(by) <= -(-total // 1024) + 2
    long = sorted((r for r in rows if r.doc_id == 31 and r.length > 600 or r.piece), key=lambda r: r.piece)
    assert all(r.length == 1024 for r in rows if r.piece > 0) and long
    assert packing.pack_documents(docs_of(texts).limit(0), vocabulary).count() == 0


def decreasing(lengths):
    """Bins of best-fit decreasing."""
    return int(packing.best_fit(lengths, np.full(len(lengths), -1), np.argsort(-lengths, kind="stable"), 1024).max()) + 1


def test_genetic_algorithm_improves_and_is_valid():
    rng = np.random.default_rng(3)
    lengths = rng.integers(200, 500, 400)
    first = packing.best_fit(lengths, np.full(400, -1), np.arange(400), 1024)
    population, scores = packing.evolve(lengths, [first], 1024, 40, 4, 40, np.random.default_rng(1))
    for p in population:
        assert np.bincount(p, weights=lengths).max() <= 1024 and (p >= 0).all()
    assert scores[0] >= packing.quality(lengths, first, 1024)
    child = packing.crossover(lengths, population[0], first, 1024, rng)
    assert np.bincount(child, weights=lengths).max() <= 1024


@pytest.mark.parametrize("kind", ["triplets", "a fifth to a half"])
def test_search_beats_best_fit_decreasing(kind):
    """Pieces that fill sequences three by three, and pieces of a fifth to a half of one:
    five instances each, none worse and fewer sequences in all."""
    rng, found, plain = np.random.default_rng(1), 0, 0
    for seed in range(5):
        if kind == "triplets":
            a = rng.integers(390, 500, 300)
            b = rng.integers(257, (1024 - a) // 2)
            lengths = np.concatenate([a, b, 1024 - a - b])
        else:
            lengths = rng.integers(200, 500, 400)
        population, scores = packing.evolve(lengths, [], 1024, 300, 8, 300, np.random.default_rng(seed))
        assert np.bincount(population[0], weights=lengths).max() <= 1024
        assert -scores[0][0] <= decreasing(lengths)
        found, plain = found - scores[0][0], plain + decreasing(lengths)
    assert found < plain


def test_first_fit_equals_a_plain_walk():
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 50, 300):
        lengths, order, room, want = rng.integers(1, 1024, n), rng.permutation(n), [], np.empty(n, int)
        for i in order:
            k = next((k for k, r in enumerate(room) if r >= lengths[i]), len(room))
            if k == len(room):
                room.append(1024)
            room[k] -= lengths[i]
            want[i] = k
        assert (packing.first_fit(lengths, order, 1024) == want).all()


def test_pieces_have_the_library_s_ids(docs_of, prose):
    vocabulary = read("byte_bpe_50k.json", "r")
    lib = tokens.Library(vocabulary)
    texts = odd_texts(60, 9) + [prose(2500, 3), None, "x" * 9000]
    rows = packing.pack_documents(docs_of(texts), vocabulary).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    for i, t in enumerate(texts):
        parts = sorted(by[i], key=lambda r: r.piece)
        want = lib.whole([t or ""])[0] + [2]
        assert [(r.piece, r.start, r.length) for r in parts] == [(k, *c) for k, c in enumerate(packing.cut_points(len(want), 1024))]
        assert np.concatenate([np.frombuffer(r.ids, "<u4") for r in parts]).tolist() == want


def test_cut_points():
    assert packing.cut_points(10, 1024) == [(0, 10)]
    assert packing.cut_points(1024, 1024) == [(0, 1024)]
    assert packing.cut_points(2050, 1024) == [(0, 2), (2, 1024), (1026, 1024)]
    assert packing.cut_points(2048, 1024) == [(0, 1024), (1024, 1024)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_merging_equals_the_library(name):
    """Slices of every length and script, merged side by side."""
    rng = random.Random(6)
    lib = tokens.Library(read(name, "r"))
    pool = ["the", "ing", "ab", "é", "ß", "Ж", "中", "😀", "q", "zz", "'", "--", "0", "Über", "ſ", "Ⅷ", "ά", "Σ", "ﬁ"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(1, 14))) for _ in range(6000)]
    texts += ["".join(chr(rng.choice([rng.randint(0x21, 0x24F), rng.randint(0x370, 0x1FFF), rng.randint(0x2C00, 0xA8FF)]))
                      for _ in range(rng.randint(1, 6))) for _ in range(6000)]
    texts += ["a" * n for n in range(1, 80)] + ["ab" * n for n in range(1, 40)] + ["\0", "a\0", "a\0\0b", "\0" * 9]
    ids, per_text = lib.encode(texts)
    edge = np.concatenate([[0], np.cumsum(per_text)])
    assert [ids[a:b].tolist() for a, b in zip(edge, edge[1:])] == lib.whole(texts)


def test_distinct_slices_are_exact():
    rng = np.random.default_rng(2)
    for n in (1, 7, 5000):
        buf = bytes(rng.integers(0, 3, 400, dtype=np.uint8))
        begins = rng.integers(0, 370, n)
        ends = begins + rng.integers(1, 25, n)
        first, group = merging.distinct(buf, begins, ends)
        want = {}
        for i, (a, b) in enumerate(zip(begins, ends)):
            want.setdefault(buf[a:b], []).append(i)
        assert len(first) == len(want)
        for same in want.values():
            assert len({group[i] for i in same}) == 1 and first[group[same[0]]] in same
