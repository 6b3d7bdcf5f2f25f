"""Unblocked best match at any threshold against all pairs."""

import random

import pytest

from brickwork.operators import match


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            above, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, above + (x != y))
    return row[-1]


def ratio(a, b):
    longest = max(len(a), len(b))
    return 100.0 if not longest else 100.0 * (1 - lev(a, b) / longest)


def sorted_text(t):
    return " ".join(sorted("".join(c if c.isalnum() else " " for c in t.lower()).split()))


def brute(left, right, threshold, scorer):
    best = {}
    for l in set(left) - {None}:
        for r in set(right) - {None}:
            s = ratio(sorted_text(l), sorted_text(r))
            s = round(max(ratio(l, r), 0.95 * s) if scorer == "wratio" else s, 9)
            if s > threshold and (l not in best or (-s, r) < (-best[l][1], best[l][0])):
                best[l] = (r, s)
    return best


def texts(rng, n):
    words = ["high street", "mill lane", "cowes", "ryde", "flat", "gate", "po30 1ab", "x", "church road"]
    out = []
    for _ in range(n):
        t = " ".join([str(rng.randrange(60)), *rng.sample(words, rng.randrange(1, 5))])
        chars = list(t)
        for _ in range(rng.choice([0, 0, 1, 2, 6, 15])):
            at = rng.randrange(len(chars)) if chars else 0
            chars[at : at + rng.randrange(2)] = rng.choice(["", "q", "zz", " "])
        out.append("".join(chars))
    return out


@pytest.mark.parametrize("scorer", ["wratio", "token_sort"])
@pytest.mark.parametrize("threshold", [0.0, 10.0, 60.0, 80.0, 94.9])
def test_equals_all_pairs(spark, threshold, scorer):
    rng = random.Random(int(threshold) + len(scorer))
    left = [*texts(rng, 40), "", " ", "-", "a", "ab", "zzzz", "12", "unlike everything", None, "0 ryde"]
    right = [*texts(rng, 60), "", "a", "ba", "!", "21", None, left[0], left[1].upper()]
    frames = [spark.createDataFrame([(t,) for t in side], "text string") for side in (left, right)]
    got = match.best_match(*frames, threshold=threshold, scorer=scorer)
    assert {r.l_text: (r.matched_text, pytest.approx(r.score)) for r in got.collect()} == brute(left, right, threshold, scorer)


def test_no_cross_join_and_few_pairs_for_well_matched_rows(spark):
    rng = random.Random(5)
    right = [f"{i} {rng.choice(['high', 'mill', 'gate'])} {rng.randrange(10**6)} street {rng.choice(['cowes', 'ryde'])}" for i in range(800)]
    left = [t.replace("street", "st") for t in right[::8]]
    frames = [spark.createDataFrame([(t,) for t in side], "text string") for side in (left, right)]
    pairs, _ = match.match_pairs(*frames, "text", "text", 10.0, "token_sort")
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert pairs.count() / (len(left) * len(right)) < 0.5


def test_empty_sides(spark):
    empty = spark.createDataFrame([], "text string")
    some = spark.createDataFrame([("a b",)], "text string")
    assert match.best_match(empty, some, threshold=10.0).count() == 0
    assert match.best_match(some, empty, threshold=10.0).count() == 0
    with pytest.raises(ValueError):
        match.best_match(some, some, threshold=-1.0)
