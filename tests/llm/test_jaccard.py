"""Jaccard join against all pairs; DivideSkip against all pairs; chunked lists and groups."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from brickwork.llm import jaccard
from brickwork.llm.components import components

UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sets_of(docs, words):
    out = []
    for _, text in docs:
        w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(UPPER))
        out.append({tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set())
    return out


def brute(docs, words, num, den):
    sets = sets_of(docs, words)
    up = {d: d for d, _ in docs}

    def root(d):
        while up[d] != d:
            d = up[d]
        return d

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                x, y = root(docs[i][0]), root(docs[j][0])
                up[max(x, y)] = min(x, y)
    return sorted((d, len(s), root(d)) for (d, _), s in zip(docs, sets, strict=True))


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["Ä", "É1", "the", "of"]
    docs = []
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.choice([1, 2, 3, 8, 40, 120]))]
        for _ in range(rng.choice([1, 1, 3, 12])):
            copy = base.copy()
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            docs.append((len(docs), rng.choice([" ", "\n", "\t "]).join(rng.choice([w, w.upper()]) if w.isascii() else w for w in copy)))
    return docs + [(len(docs), None), (len(docs) + 1, " \n"), (len(docs) + 2, "only"), (len(docs) + 3, "ONLY"), (len(docs) + 4, "\x1c\xa0")]


@pytest.mark.parametrize(("seed", "words", "num"), [(1, 3, 9), (2, 5, 8)])
def test_matches_all_pairs(spark, seed, words, num):
    docs = corpus(seed)
    got = jaccard.join_components(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), words=words, num=num)
    assert sorted(map(tuple, got.collect())) == brute(docs, words, num, 10)


def test_chunked_lists_and_groups(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "LIST_CHUNK", 3)
    monkeypatch.setattr(jaccard, "GROUP_DOCS", 4)
    docs = corpus(3)
    got = jaccard.join_components(spark.createDataFrame(docs, "doc_id long, text string"), words=3, num=9)
    assert sorted(map(tuple, got.collect())) == brute(docs, 3, 9, 10)


def test_null_ids_repeats_extra_columns_and_empty(spark):
    text = " ".join(f"a{i}" for i in range(30))
    frame = spark.createDataFrame([(5, text, 1), (5, text, 1), (None, text, 1), (None, "other", 1), (7, "", 1)], "doc_id long, text string, n int")
    rows = sorted(map(tuple, jaccard.join_components(frame).collect()), key=str)
    assert rows == sorted([(5, 26, 5), (5, 26, 5), (None, 26, 5), (None, 1, None), (7, 0, 7)], key=str)
    assert jaccard.join_components(frame.limit(0)).count() == 0


def test_divide_skip_finds_all_links():
    rng = np.random.default_rng(5)
    sets = []
    for _ in range(30):
        base = rng.choice(5000, rng.integers(1, 200), replace=False)
        for _ in range(rng.integers(1, 6)):
            kept = base[rng.random(len(base)) > 0.04]
            sets.append(np.unique(np.concatenate([kept, rng.choice(5000, rng.integers(0, 4))])).astype(np.uint64))
    sets = [s for s in sets if len(s)]
    want = {frozenset((i, j)) for i in range(len(sets)) for j in range(i) if 10 * (n := len(np.intersect1d(sets[i], sets[j]))) >= 8 * (len(sets[i]) + len(sets[j]) - n)}
    assert {frozenset(p) for p in jaccard.divide_skip(sets, 8, 10, all_links=True)} == want


def test_words_of_long_texts():
    data = b"".join(b"word%d " % i for i in range(200_000))
    whole = jaccard._word_hashes(data)
    assert len(whole) == 200_000
    assert (whole[150_000:150_100] == jaccard._word_hashes(b" ".join(b"word%d" % i for i in range(150_000, 150_100)))).all()
    assert len(jaccard._word_hashes(b"x" * (3 << 20))) == 1


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_heap_merge_finds_what_enough_lists_hold(seed):
    rng = random.Random(seed)
    for _ in range(200):
        lists = [sorted(rng.sample(range(60), rng.randrange(0, 40))) for _ in range(rng.randrange(1, 12))]
        least = rng.randrange(1, len(lists) + 2)
        counts = Counter(x for held in lists for x in held)
        want = sorted((x, n) for x, n in counts.items() if n >= least)
        assert list(zip(*jaccard.merge_skip(lists, least))) == want
        arrays = [np.array(held, np.int64) for held in lists]
        jaccard.HEAP, before = 0, jaccard.HEAP
        try:
            found, count = jaccard.occurrences(arrays, least)
        finally:
            jaccard.HEAP = before
        assert list(zip(found.tolist(), count.tolist())) == want
