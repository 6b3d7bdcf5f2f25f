"""Snapshot comparison, sorted outputs and positions."""

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from brickwork import sinks
from brickwork.operators import dedup, ordering, quality, snapshots


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, a int, b double, c string")


def brute(old, new):
    """Multiset difference, then rows of a key paired in their order."""
    gone, come = Counter(old) - Counter(new), Counter(new) - Counter(old)
    nulls = lambda row: tuple((v is not None, v if v is not None else 0) for v in row[1:])
    out = []
    for k in {r[0] for r in [*gone, *come]}:
        left, right = (sorted((r for r in side.elements() if r[0] == k), key=nulls) for side in (gone, come))
        if k is None:
            pairs = [(None, l, None) for l in left] + [(None, None, r) for r in right]
        else:
            pairs = [(i + 1, left[i] if i < len(left) else None, right[i] if i < len(right) else None) for i in range(max(len(left), len(right)))]
        for n, l, r in pairs:
            change = "added" if l is None else "removed" if r is None else "changed"
            for i, name in enumerate(("a", "b", "c"), 1):
                x, y = (None if s is None or s[i] is None else str(s[i]) for s in (l, r))
                if change != "changed" or x != y:
                    out.append((k, n, name, x, y, change))
    return sorted(out, key=str)


def releases(seed):
    rng = random.Random(seed)
    old = [(rng.choice([None, "hot", f"k{i % 30}"]), rng.choice([None, i % 3]), rng.choice([1.0, None]), rng.choice(["x", "y", None])) for i in range(150)]
    new = [r for r in old if rng.random() > 0.1] + [("new", 1, 1.0, "z")] * 2
    return old, [r if rng.random() > 0.2 else (*r[:3], "changed") for r in new]


@pytest.mark.parametrize("seed", range(3))
def test_snapshots_match_a_plain_comparison(spark, tmp_path, seed):
    old, new = releases(seed)
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    snapshots.write_snapshot(frame(spark, old), a, ["k"], buckets=7)
    snapshots.write_snapshot(frame(spark, new).repartition(3), b, ["k"], buckets=7)
    got = snapshots.diff_snapshots(spark, a, b, ["k"])
    assert got.columns == ["k", "occurrence", "column", "old", "new", "change"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(old, new)


def test_equal_buckets_are_not_read(spark, tmp_path):
    old = [(f"k{i}", i, 1.0, "x") for i in range(300)]
    new = [(k, a, b, "y" if k == "k7" else c) for k, a, b, c in old]
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    snapshots.write_snapshot(frame(spark, old), a, ["k"])
    snapshots.write_snapshot(frame(spark, new), b, ["k"])
    differ = snapshots.unequal_buckets(spark, a, b)
    assert len(differ) == 1
    got = snapshots.diff_snapshots(spark, a, b, ["k"])
    assert [tuple(r) for r in got.collect()] == [("k7", 1, "c", "x", "y", "changed")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull(_bucket" in plan or "PartitionFilters: [(_bucket" in plan or "PartitionFilters: [_bucket" in plan
    assert snapshots.unequal_buckets(spark, a, a) == [] and snapshots.diff_snapshots(spark, a, a, ["k"]).count() == 0


def test_rows_that_both_releases_hold_are_not_shuffled_whole(spark, tmp_path):
    old = [(f"k{i % 40}", i, 1.0, "x") for i in range(300)] + [(None, 1, None, None)] * 3
    new = [(k, a, b, "y" if a == 7 else c) for k, a, b, c in old[:-1]]
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    snapshots.write_snapshot(frame(spark, old).repartition(3), a, ["k"], buckets=2)
    snapshots.write_snapshot(frame(spark, new).repartition(2), b, ["k"], buckets=2)
    sides = [spark.read.parquet(p) for p in (a, b)]
    assert [side.count() for side in snapshots._without_equal_rows(*sides)] == [4, 3]
    assert sorted(map(tuple, snapshots.diff_snapshots(spark, a, b, ["k"]).collect()), key=str) == brute(old, new)
    # a release with another column is compared whole
    more = frame(spark, new).withColumn("d", F.lit(1))
    snapshots.write_snapshot(more, b, ["k"], buckets=2)
    assert sorted(map(tuple, snapshots.diff_snapshots(spark, a, b, ["k"]).collect()), key=str) == brute(old, new)


def test_a_snapshot_is_written_without_a_shuffle(spark, tmp_path):
    path = str(tmp_path / "a")
    snapshots.write_snapshot(frame(spark, [(f"k{i}", i, 1.0, "x") for i in range(90)]).repartition(3), path, ["k"], buckets=1)
    assert len([f for f in os.listdir(f"{path}/_bucket=0") if f.endswith(".parquet")]) == 3


@pytest.mark.parametrize("seed", range(2))
def test_many_unequal_hashes_are_sent_some_buckets_at_a_time(spark, tmp_path, seed, monkeypatch):
    monkeypatch.setattr(snapshots, "SMALL", 9)
    old, new = releases(seed)
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    snapshots.write_snapshot(frame(spark, old), a, ["k"], buckets=7)
    snapshots.write_snapshot(frame(spark, new), b, ["k"], buckets=7)
    assert sorted(map(tuple, snapshots.diff_snapshots(spark, a, b, ["k"]).collect()), key=str) == brute(old, new)


def test_an_empty_side_and_several_keys(spark, tmp_path):
    rows = [("k", 1, 2.0, "x"), ("k", 2, 2.0, "x")]
    none = frame(spark, [])
    assert {r.change for r in snapshots.diff_rows(none, frame(spark, rows), ["k"]).collect()} == {"added"}
    assert {r.change for r in snapshots.diff_rows(frame(spark, rows), none, ["k"]).collect()} == {"removed"}
    assert snapshots.diff_rows(none, none, ["k"]).count() == 0
    two = snapshots.diff_rows(frame(spark, rows), frame(spark, [("k", 1, 2.0, "y"), ("k", 2, 2.0, "x")]), ["k", "a"])
    assert [tuple(r) for r in two.collect()] == [("k", 1, 1, "c", "x", "y", "changed")]


def test_table_diff_pairs_repeated_keys(spark):
    old, new = [("k", 1, 1.0, "x"), ("k", 2, 1.0, "x")], [("k", 1, 1.0, "x"), ("k", 2, 1.0, "y")]
    assert [tuple(r) for r in quality.table_diff(frame(spark, old), frame(spark, new), "k").collect()] == [("k", "c", "x", "y", "changed")]


def test_schema_diff(spark):
    a, b = spark.createDataFrame([], "x int, y int"), spark.createDataFrame([], "y int, z int")
    assert [tuple(r) for r in quality.schema_diff(a, b).collect()] == [("x", "left_only"), ("z", "right_only")]


def rows(n):
    rng = random.Random(n)
    return [(rng.choice([None, f"u{rng.randrange(40)}"]), rng.choice([None, *range(5)]), float(i), "t") for i in range(n)]


def test_positions_follow_a_mixed_order(spark):
    held = rows(500)
    by = [F.desc_nulls_last("k"), F.asc_nulls_last("a"), "b"]
    placed = ordering.with_position(frame(spark, held).repartition(7), by).collect()
    want = sorted(held, key=lambda r: (r[1] is None, r[1] or 0, r[2]))
    want.sort(key=lambda r: (r[0] is not None, r[0] or ""), reverse=True)
    assert [tuple(r)[:4] for r in sorted(placed, key=lambda r: r.position)] == want
    assert sorted(r.position for r in placed) == list(range(1, 501))
    assert ordering.with_position(frame(spark, []), by).count() == 0
    plan = ordering.with_position(frame(spark, held), by)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan


@pytest.mark.parametrize("kind", ["parquet", "csv"])
def test_sorted_files_follow_one_another(spark, tmp_path, kind):
    held = rows(400)
    path = str(tmp_path / "sorted")
    ordering.write_sorted(frame(spark, held), path, [F.desc_nulls_last("k"), "a", "b"], kind, partitions=4)
    files = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    assert len(files) > 1
    read = []
    for f in files:
        part = spark.read.schema("k string, a int, b double, c string").format(kind).load(f"{path}/{f}").coalesce(1)
        read += [tuple(r) for r in part.collect()]
    want = sorted(held, key=lambda r: (r[1] is None, r[1] or 0, r[2]))
    want.sort(key=lambda r: (r[0] is not None, r[0] or ""), reverse=True)
    assert read == want


def test_sinks_sort_and_skip(spark, tmp_path):
    held = frame(spark, rows(50))
    sinks.materialise(held, str(tmp_path / "m"), order=["k", "b"])
    assert spark.read.parquet(str(tmp_path / "m")).count() == 50
    sinks.export(held, str(tmp_path / "e"), "mart", "me", single_file=True, order=["b"])
    (folder,) = os.listdir(tmp_path / "e")
    (part,) = [f for f in os.listdir(tmp_path / "e" / folder) if f.endswith(".csv")]
    lines = (tmp_path / "e" / folder / part).read_text().splitlines()
    assert folder.startswith("mart_me_") and lines[0] == "k,a,b,c" and [float(x.split(",")[2]) for x in lines[1:]] == [float(i) for i in range(50)]
    assert sinks.export(held, str(tmp_path / "skipped"), "mart", write=False) is held and not os.path.exists(tmp_path / "skipped")


def test_first_rows_and_duplicates(spark):
    held = frame(spark, [("b", 1, 1.0, "x"), (None, 2, 1.0, "x"), ("a", 3, 1.0, "x"), ("a", 4, 1.0, "x")])
    assert [r.a for r in ordering.first_rows(held, 3, ["k", "a"]).collect()] == [3, 4, 1]
    assert [r.a for r in dedup.head(held, 2, ["a"]).collect()] == [1, 2]
    assert [r.a for r in dedup.duplicated_rows(held, "k", ["a"]).collect()] == [4]
    assert {(r.k, r.a) for r in dedup.top_k_per_key(held, "k", "a", 1).collect()} == {("b", 1), (None, 2), ("a", 4)}
    assert dedup.shape(held).first() == (4, 4)
