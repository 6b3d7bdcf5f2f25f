"""Periodic runs against all periods of every stretch."""

import random
import re
import zlib
from hashlib import sha256

import pytest

from brickwork.llm import periods, queries


def smallest_period(w):
    borders, k = [0] * len(w), 0
    for i in range(1, len(w)):
        while k and w[i] != w[k]:
            k = borders[k - 1]
        k += w[i] == w[k]
        borders[i] = k
    return len(w) - borders[-1]


def brute(w, least):
    """(start, length, period) of all runs: for every period, the stretches where words that far apart agree."""
    found = set()
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j - i >= q and j + q - i >= least and smallest_period(w[i : j + q]) == q:
                found.add((i, j + q - i, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def made(rng):
    letters = [b"w%d" % i for i in range(rng.choice([1, 2, 3, 5, 50]))]
    some = lambda n: [rng.choice(letters) for _ in range(n)]
    kind = rng.randrange(6)
    if kind == 0:
        return some(rng.randrange(200))
    if kind == 1:  # Fibonacci words
        a, b = [letters[0]], [b"z"]
        for _ in range(rng.randrange(1, 11)):
            a, b = a + b, a
        return a
    if kind == 2:  # Thue-Morse words
        return [b"ab"[i.bit_count() % 2 :][:1] for i in range(rng.randrange(200))]
    if kind == 3:  # highly periodic halves that meet out of phase
        x = some(rng.randrange(1, 6))
        u = x * rng.randrange(1, 40) + x[: rng.randrange(len(x))]
        return (some(rng.randrange(3)) + u * rng.randrange(2, 5) + x[: rng.randrange(len(x) + 1)])[:500]
    if kind == 4:  # planted repetitions with a typo
        u = some(rng.randrange(1, 120))
        w = some(rng.randrange(30)) + u * rng.randrange(1, 5) + u[: rng.randrange(len(u))]
        w[rng.randrange(len(w))] = b"typo"
        return w
    return ((made(rng)[:80] or [b"q"]) * rng.randrange(1, 5) + made(rng)[:60])[:500]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("least", [2, 12])
def test_all_runs_of_random_words(seed, least):
    rng = random.Random(seed)
    for _ in range(40):
        texts = [made(rng) for _ in range(rng.choice([1, 6]))]
        for words, found in zip(texts, periods.find([b" ".join(w) for w in texts], least), strict=True):
            assert [tuple(r) for r in found.runs.tolist()] == brute(words, least), words


def test_sets_are_locally_consistent_and_dense():
    import numpy as np

    rng = random.Random(1)
    words = np.array([rng.randrange(2) for _ in range(4000)], np.int64)
    runs = periods.runs_of(words, len(words))
    hashes = periods._mixed(words.astype(np.uint64) + np.uint64(1))
    for t in (1, 2):
        hashes = periods._joined(hashes[:-t], hashes[t:])
    t = 4
    held = set(periods._synchronising(hashes, t, runs).tolist())
    contexts = {}
    for i in range(len(words) - 2 * t + 1):
        contexts.setdefault(words[i : i + 2 * t].tobytes(), set()).add(i in held)
    assert all(len(c) == 1 for c in contexts.values())
    for i in range(len(words) - 3 * t + 2):
        assert held & set(range(i, i + t)) or smallest_period(words[i : i + 3 * t - 1].tolist()) <= t / 3


def test_long_texts_stay_fast():
    u = [b"%d" % i for i in range(3000)]
    texts = [b" ".join(u * 20), b"a " * 100_000, b"a b " * 50_000 + b"b a " * 50_000]
    first, second, third = periods.find(texts, 12)
    assert [tuple(r) for r in first.runs.tolist()] == [(0, 60000, 3000)]
    assert [tuple(r) for r in second.runs.tolist()] == [(0, 100_000, 1)]
    assert (0, 100_000, 2) in {tuple(r) for r in third.runs.tolist()}
    assert first.collapsed() == b" ".join(u)


def plain(doc_id, text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
    runs = brute(w, 12)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    collapsed = b" ".join(x for i, x in enumerate(w) if i not in gone)
    head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *head, sha256(listed.encode()).hexdigest(), sha256(collapsed).hexdigest())


def test_query_matches_brute_force(spark, tmp_path):
    rng = random.Random(3)
    docs = [(i, (b"\t" if i % 2 else b" ").join(made(rng)).decode()) for i in range(300)]
    docs += [(301, None), (302, ""), (303, " \n\t "), (None, "a " * 20), (7, "é x " * 15), (7, "é x " * 15), (305, "one"), (306, "x\x1cy " * 30)]
    rows = [(d, t, "x", 1) for d, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, n_runs string, start int").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_synchronising_runs(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=str) == sorted((plain(*d) for d in docs), key=str)


def test_operator_keeps_columns_and_returns_the_collapsed_text(spark):
    frame = spark.createDataFrame([(1, "a b c d " * 4, 5)], "doc_id long, text string, length int")
    got = periods.periodic_runs(frame, collapsed="short")
    assert got.columns == ["doc_id", "text", *periods.RESULT, *periods.DIGESTS, "short"]
    assert got.first().short == "a b c d" and got.first().length == 16
    assert periods.periodic_runs(frame.limit(0)).count() == 0
