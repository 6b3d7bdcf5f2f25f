"""Line dedup against a brute-force version, over several batches and levels of runs."""

import random

import pytest

from brickwork.llm import lines

SPACE = " \t\n\x0b\x0c\r"
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(docs, min_chars, min_docs):
    held = {}
    for doc, text in docs:
        for line in (text or "").split("\n"):
            key = line.strip(SPACE).translate(UPPER)
            if len(key) >= min_chars:
                held.setdefault(key, set()).add(doc)
    small = float("-inf")
    keeper = {k: max(d if d is not None else small for d in ds) for k, ds in held.items() if len(ds) >= min_docs}
    out = []
    for doc, text in docs:
        split = (text or "").split("\n")
        kept = [x for x in split if (doc if doc is not None else small) >= keeper.get(x.strip(SPACE).translate(UPPER), small)]
        out.append((doc, "\n".join(kept), len(split), len(split) - len(kept)))
    return sorted(out, key=str)


def corpus(n):
    rng = random.Random(n)
    pool = [f"Line number {i} with ÉÀ text" for i in range(12)] + ["short", "", "  \t", "É" * 20, "é" * 20, "x" * 19, "Ünder twenty chars.."]
    docs = [(i, "\n".join(rng.choice(pool) + rng.choice(["", " ", "\t"]) for _ in range(rng.randint(0, 8)))) for i in range(n)]
    return docs + [(n, None), (n + 1, ""), (None, pool[0] + "\n" + pool[1]), (3, pool[2]), (3, pool[2]), (4, pool[0].upper())]


@pytest.mark.parametrize(("batches", "fanout", "min_docs"), [(1, 2, 3), (5, 2, 3), (7, 3, 2)])
def test_matches_brute_force(spark, batches, fanout, min_docs):
    docs = corpus(60)
    got = lines.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"), min_docs=min_docs, batches=batches, fanout=fanout)
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, 20, min_docs)


def test_clashing_columns_and_shuffled_places(spark, monkeypatch):
    docs = corpus(20)
    frame = spark.createDataFrame([(d, t, 5, "k") for d, t in docs], "doc_id long, text string, n_lines int, _row string")
    monkeypatch.setattr(lines, "BROADCAST_BYTES", 0)
    got = lines.dedup_lines(frame)
    assert got.columns == ["doc_id", "text", "_row", "n_lines", "n_dropped"]
    want = {(a, b, c, d) for a, b, c, d in brute(docs, 20, 3)}
    assert {(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()} == want


def test_empty_table_and_very_long_text(spark):
    assert lines.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    line = "a line that is repeated"
    docs = [(i, "\n".join([f"{line}", *(f"only in {i} at place {j}" for j in range(5000))])) for i in range(4)]
    got = {r.doc_id: r for r in lines.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert [got[i].n_dropped for i in range(4)] == [1, 1, 1, 0]
    assert got[0].text == docs[0][1].split("\n", 1)[1]


def test_runs_are_read_as_they_lie(spark):
    """A batch is merge-anti-joined with the runs, and runs with runs, without an exchange or a sort of a run."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        runs = lines.Runs(2, lines.shuffle_partitions(spark))
        rows = lambda a, b: spark.range(a, b).selectExpr("id AS h1", "id * 3 AS h2", "struct(true AS known, id AS doc) AS keeper", "1L AS docs")
        runs.add_batch(rows(0, 100))
        with lines.ordered_scans(spark):
            anti = runs.unseen(rows(50, 150).select(*lines.HASH))._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in anti and anti.count("Exchange") == 1 and anti.count("Sort [") == 1
        other = lines.Runs(3, lines.shuffle_partitions(spark))
        other.add_batch(rows(0, 100))
        other.add_batch(rows(50, 150))
        with lines.ordered_scans(spark):
            both = lines.merged(other.all())
            plan = both._jdf.queryExecution().executedPlan().toString()
            got = {r.h1: (r.keeper.doc, r.docs) for r in both.collect()}
        assert "SortMergeJoin" in plan and "Exchange" not in plan and "Sort [" not in plan
        assert got == {i: (i, 2 if 50 <= i < 100 else 1) for i in range(150)}
        runs.add_batch(rows(50, 150))
        assert [len(level) for level in runs.levels] == [0, 1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert spark.conf.get(lines.KEEP_ORDER) == "false"
