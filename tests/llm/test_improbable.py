"""Improbable-feature digests: entropies, selection, filters, likeness and the query against plain versions."""

import math
import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from brickwork.llm import improbable as M
from brickwork.llm import queries

WORDS = [a + b + c for a in ("ka", "lo", "mé", "tri") for b in ("", "n", "sta") for c in ("ra", "vi", "dor", "s")]


def text(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize()


def plain_class(window):
    most = round(M.WINDOW * math.log2(M.WINDOW) * (1 << 20))
    part = sum(round(c * math.log2(c) * (1 << 20)) for c in Counter(window).values())
    return (most - part) * (M.CLASSES - 1) // most


def plain_selected(data, rank):
    """Numbers of the selected windows of one text, stretch by stretch."""
    classes = [plain_class(data[i : i + M.WINDOW]) for i in range(len(data) - M.WINDOW + 1)]
    points = Counter()
    for a in range(-M.STRETCH + 1, len(classes)):
        held = [(rank[classes[i]], i) for i in range(max(a, 0), min(a + M.STRETCH, len(classes))) if classes[i] > M.DULL]
        if held:
            points[min(held)[1]] += 1
    return sorted(i for i, n in points.items() if n >= M.POINTS)


def test_entropy_and_selection_match_plain_versions():
    rng = random.Random(1)
    texts = [text(rng, n).encode() for n in (0, 1, 3, 9, 60, 200)] + [b"a" * 100, b"ab" * 40, bytes(range(32, 120)), b"-" * 30 + text(rng, 30).encode()]
    rank = np.array(rng.sample(range(M.CLASSES), M.CLASSES))
    held = M.Texts(texts)
    chosen = M.selected(held, rank)
    for i, t in enumerate(texts):
        mine = held.owner == i
        assert held.classes[mine].tolist() == [plain_class(t[j : j + M.WINDOW]) for j in range(len(t) - M.WINDOW + 1)]
        assert (held.place[chosen[held.owner[chosen] == i]] - held.starts[i]).tolist() == plain_selected(t, rank)


def test_digests_do_not_depend_on_their_neighbours_and_can_be_read():
    rng = random.Random(2)
    rank = np.arange(M.CLASSES)
    texts = [text(rng, n).encode() for n in (0, 1, 2, 50, 900, 3000, 900)] + [b"", b"x"]
    together = M.digests(texts, rank)
    for t, d in zip(texts, together, strict=True):
        alone = M.digests([t], rank)[0].written()
        assert alone == d.written() and M.Digest.read(alone).written() == alone
        assert len(d.filters) == -(-d.features // M.FULL)
    assert len(together[5].filters) > 2


def test_likeness():
    rng = random.Random(3)
    rank = np.arange(M.CLASSES)
    for n in (12, 40, 300, 2500):
        one, other = text(rng, n), text(rng, n)
        third = len(one) // 3
        a, b, edited, shifted = M.digests([t.encode() for t in (one, other, one[:-third] + other[:third], other[:20] + one)], rank)
        assert M.likeness(a, a) == 1 and M.likeness(a, b) == M.likeness(b, a) < 0.2
        assert 0.4 < M.likeness(a, edited) < 0.9 and M.likeness(a, shifted) > 0.6
    empty, short = M.digests([b"", b"x"], rank)
    assert M.likeness(empty, empty) == M.likeness(short, short) == 1 and M.likeness(empty, short) == M.likeness(short, a) == 0


def plain(docs, rank):
    order = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0)))
    texts = [t or "" for _, t in order]
    out = []
    for i, (doc, t) in enumerate(zip([d for d, _ in order], texts)):
        follow = texts[(i + 1) % len(texts)]
        third = len(t) // 3
        edited = t[: len(t) - third] + follow[:third]
        a, b, c = M.digests([x.encode() for x in (t, edited, follow)], rank)
        out.append((doc, len(t), sha256(edited.encode()).hexdigest(), a.written(), b.written(), M.likeness(a, b), M.likeness(a, c)))
    return sorted(out, key=str)


@pytest.mark.parametrize("buckets", [1, 3, 17])
def test_query_matches_a_plain_pass(spark, monkeypatch, buckets):
    rng = random.Random(buckets)
    docs = [(i * 7 % 1009, text(rng, rng.choice([0, 1, 5, 40, 400]))) for i in range(150)] + [(2000, None), (2001, ""), (None, "no id at all"), (-5, "É" * 100)]
    docs += [(3000, docs[3][1]), (3001, docs[3][1]), (4000, text(rng, 20_000))]
    monkeypatch.setattr(M, "BATCH", 20_000)
    frame = spark.createDataFrame([(t, d, "x", 1) for d, t in docs], "text string, doc_id long, bucket string, extra int").repartition(5)
    rank = M.learn(frame)
    got = M.compare_next(frame, rank, queries._edited, buckets=buckets)
    assert sorted(map(tuple, got.collect()), key=str) == plain(docs, rank)


def test_learnt_ranks_count_all_windows(spark):
    rng = random.Random(9)
    texts = [text(rng, n) for n in (0, 2, 30, 300)] + [None]
    counts = Counter(plain_class(t.encode()[i : i + M.WINDOW]) for t in texts if t for i in range(len(t.encode()) - M.WINDOW + 1))
    rank = M.learn(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    assert sorted(rank) == list(range(M.CLASSES))
    assert all(counts[a] <= counts[b] for a, b in zip(np.argsort(rank), np.argsort(rank)[1:]))


def test_edge_tables(spark):
    schema = "doc_id long, text string"
    rank = np.arange(M.CLASSES)
    assert M.compare_next(spark.createDataFrame([], schema), rank, queries._edited).count() == 0
    one = M.compare_next(spark.createDataFrame([(1, "alone in the table")], schema), rank, queries._edited).collect()
    assert len(one) == 1 and one[0].near_next == 1 and one[0].id == 1
    same = M.compare_next(spark.createDataFrame([(1, "twice"), (1, "twice"), (1, "other"), (None, "a"), (None, "b")], schema), rank, queries._edited, buckets=4)
    assert sorted(str(r.id) for r in same.collect()) == ["1", "1", "1", "None", "None"]
    kept = M.fingerprints(spark.createDataFrame([(1, "x y", "old")], "doc_id long, text string, fingerprint string"), rank)
    assert kept.columns == ["doc_id", "text", "fingerprint"] and kept.first().fingerprint != "old"
