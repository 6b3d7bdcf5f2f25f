"""What steps shuffle and hold as their input grows."""

from __future__ import annotations

import glob

from brickwork import session, sinks
from brickwork.operators import dedup, match, quality, rules
from brickwork.plans import enrich, marts


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_block_match_weighs_few_texts_where_every_single_token_is_frequent(spark, monkeypatch):
    seen = []

    def cut(df):
        out = session.cut_lineage(df)
        if "weight" in out.columns:
            seen.append(out.count())
        return out

    monkeypatch.setattr(match, "cut_lineage", cut)
    # each unit is in 20 texts, each number in 20: only the two together are rare
    texts = [(f"{n} high street, cowes, po30 1a{u}", f"PO30 1A{u}") for n in range(20) for u in "abcdefghijklmnopqrst"]
    right = spark.createDataFrame(texts, "address string, postcode string")
    left = spark.createDataFrame([(t.replace("street", "st"), p) for t, p in texts], "text string, postcode string")
    got = {r.l_text: r.matched_text for r in match.block_match(left, right).collect()}
    assert got == {t.replace("street", "st"): t for t, _ in texts}
    assert seen and sum(seen) <= 2 * len(texts)


def test_distinct_shuffles_whole_rows_only_where_hashes_repeat(spark):
    rows = [(i, None if i % 3 else "x", float(i)) for i in range(50)] + [(7, None, 7.0), (None, None, None), (None, None, None), (3, "x", 3.0)]
    df = spark.createDataFrame(rows, "a int, b string, c double")
    out = dedup.distinct_rows(df)
    assert sorted(map(repr, out.collect())) == sorted(map(repr, df.dropDuplicates().collect()))
    assert "LeftAnti" in _plan(out)


def test_a_cut_is_read_by_column(spark):
    cut = session.cut_lineage(spark.range(10).selectExpr("id", "cast(id AS string) AS wide"))
    assert "ReadSchema: struct<id:bigint>" in _plan(cut.select("id"))


def test_partitioned_writes_keep_files_open_instead_of_sorting(spark):
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    with session.unsorted_writes(spark, 3):
        assert int(spark.conf.get(key)) >= 3
    assert spark.conf.get(key) == before


def test_wide_rows_are_bucketed_where_they_are(spark, tmp_path):
    frame = spark.range(300, numPartitions=3).selectExpr("cast(id % 50 AS string) AS k", "id", "if(id % 7 = 0, null, 'x') AS t")
    whole = frame.unionByName(spark.createDataFrame([(None, -1, "x"), (None, -1, "x")], "k string, id long, t string").coalesce(1))
    try:
        table = sinks.save_bucketed(whole, "wide_rows", ["k"], 4, f"{tmp_path}/wide", sort=False)
        # more files than buckets: every task wrote its own, so no row went through a shuffle
        assert len(glob.glob(f"{tmp_path}/wide/*.parquet")) > 8
        assert sorted(map(repr, table.collect())) == sorted(map(repr, whole.collect()))
        assert "Exchange" not in _plan(table.groupBy("k").count())
    finally:
        spark.sql("DROP TABLE IF EXISTS wide_rows")


def test_the_measures_mart_shuffles_hashes_and_not_rows(spark):
    staged = spark.createDataFrame([("1", 1), ("2", 2), ("1", 1)], "lmk_key string, n int")
    enriched = staged.selectExpr(
        "lmk_key", "if(n = 2, null, ' 7 ') AS uprn", "'1 a st' AS address", "1.0D AS current_energy_efficiency",
        "2.0D AS environment_impact_current", "0 AS fuzzy_matched",
    )
    recommendation = "lmk_key string, improvement_item int, improvement_summary_text string, improvement_id int, improvement_id_text string, indicative_cost string, improvement_descr_text string"
    recommendations = spark.createDataFrame([("1", 1, "x", 1, "m", "", "N/A"), ("2", 1, None, 1, "m", "", "N/A")], recommendation)
    base = marts.measures_base(enriched, recommendations, spark.createDataFrame([("7", "u", "DPA")], "uprn string, udprn string, os_api_source string"))
    mart = marts.measures_mart(base)
    assert "LeftAnti" in _plan(mart)
    rows = sorted((r.UPRN or "", r.UDPRN or "", r.ImprovementIndex, r.Category) for r in mart.collect())
    assert base.count() == 3 and rows == [("", "", 1, None), ("7", "", 1, "x")]


def test_measures_join_addresses_before_certificates_repeat(spark):
    enriched = spark.createDataFrame([("1", "7", "a"), ("1", "7", "a"), ("2", None, "b"), (None, "8", "c")], "lmk_key string, uprn string, address string")
    enriched = enriched.selectExpr("*", "1.0D AS current_energy_efficiency", "2.0D AS environment_impact_current", "0 AS fuzzy_matched")
    recommendation = "lmk_key string, improvement_item int, improvement_summary_text string, improvement_id int, improvement_id_text string, indicative_cost string, improvement_descr_text string"
    recommendations = spark.createDataFrame([("1", i, "x", 1, "m", "", "y") for i in (1, 2)] + [(None, 3, "x", 1, "m", "", "y")], recommendation)
    addresses = spark.createDataFrame([("7", "u", "DPA"), ("7", "v", "DPA"), ("7", "w", "LPI"), (None, "n", "DPA")], "uprn string, udprn string, os_api_source string")
    base = marts.measures_base(enriched, recommendations, addresses, addresses_first=True)
    last = next(line for line in base._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line)
    assert "lmk_key" in last and "uprn" not in last
    rows = sorted((r.Address, r.udprn or "", r.ImprovementIndex or 0) for r in base.collect())
    assert rows == sorted([("a", u, i) for u in "uv" for i in (1, 2)] * 2 + [("b", "", 0), ("c", "", 0)])


def test_distinct_with_many_repeats_compares_all_rows_once(spark, monkeypatch):
    monkeypatch.setattr(dedup, "SMALL", 1)
    df = spark.createDataFrame([(i % 5, None if i % 2 else "x") for i in range(40)], "a int, b string")
    out = dedup.distinct_rows(df)
    assert "LeftAnti" not in _plan(out)
    assert sorted(map(repr, out.collect())) == sorted(map(repr, df.dropDuplicates().collect()))


def test_unblocked_match_lets_few_pairs_out_where_every_part_is_frequent(spark):
    texts = [f"{n} {street}, cowes, po30 1a{u}" for n in range(20) for street in ("high street", "mill lane") for u in "abcdefghij"]
    right = spark.createDataFrame([(t,) for t in texts], "text string")
    left = spark.createDataFrame([(t.replace("street", "st"),) for t in texts[::3]], "text string")
    for scorer in ("wratio", "token_sort"):
        pairs, _ = match.match_pairs(left, right, "text", "text", 10.0, scorer)
        # about 20 right texts differ in one character of the number or the unit; only they can be nearer than a changed street
        assert len(texts[::3]) <= pairs.count() <= 60 * len(texts[::3])


def test_unblocked_match_over_blocks_of_groups_equals_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(match, "GROUP", 4)
    monkeypatch.setattr(match, "BLOCK", 30)
    monkeypatch.setattr(match, "FIRST_TEXTS", 2)
    texts = [f"{n * 37 % 101} {s}, {t}, hu2{'0' * (n % 2)} {n % 7}ab" for n in range(25) for s in ("ò'brien lane", "high street") for t in ("ryde", "hull")]
    texts += ["", "-", "a", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "zz zz zz zz", "lane ò brien 1"]
    right = spark.createDataFrame([(t,) for t in texts] + [(None,)], "text string")
    changed = [t.replace("ò'b", "òb").replace("lane", "laen").replace("street", "st") for t in texts[::2]] + ["none of them", "b", "aaaaaaaaaaaaaaaaaaaaaaaa", "high lane hull"]
    left = spark.createDataFrame([(t,) for t in changed] + [(None,)], "text string")
    every = left.distinct().selectExpr("text AS l_text").crossJoin(right.distinct().selectExpr("text AS r_text")).filter("l_text IS NOT NULL AND r_text IS NOT NULL")
    every = every.withColumns({"l_sorted": match.token_sort_text("l_text"), "r_sorted": match.token_sort_text("r_text")}).localCheckpoint()
    for scorer, score in (("wratio", match.wratio("l_text", "r_text", "l_sorted", "r_sorted")), ("token_sort", match.ratio("l_sorted", "r_sorted"))):
        for threshold in (10.0, 80.0):
            scored = every.withColumn("score", match.F.round(score, 9)).filter(match.F.col("score") > threshold)
            want = {}
            for r in scored.select("l_text", "r_text", "score").collect():
                if r.l_text not in want or (-r.score, r.r_text) < (-want[r.l_text][1], want[r.l_text][0]):
                    want[r.l_text] = (r.r_text, r.score)
            got = match.best_match(left, right, threshold=threshold, scorer=scorer).collect()
            assert {r.l_text: (r.matched_text, r.score) for r in got} == want


def _unsent(spark, monkeypatch, run):
    """The plans of all that ``run`` writes on its way and returns, under Spark's own broadcast threshold."""
    plans = []

    def noted(df):
        plans.append(_plan(df))
        return session_written(df)

    session_written = session.written
    for module in (session, match, dedup):
        monkeypatch.setattr(module, "written", noted)
    monkeypatch.setattr(match, "small_side", lambda df, *_: session.shuffled(df))
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "10m")
    try:
        plans.append(_plan(run()))
    finally:
        spark.conf.set(key, before)
    return plans


def _addresses(spark):
    rows = [(f"{n} high street, cowes, po30 1aa", "PO30 1AA", str(n), f"u{n}", s) for n in range(9) for s in ("DPA", "LPI")]
    return spark.createDataFrame(rows, "address string, postcode string, uprn string, udprn string, os_api_source string")


def test_block_match_sends_no_growing_table_to_every_executor(spark, monkeypatch):
    left = spark.createDataFrame([("3 high st, cowes", "PO30 1AA"), ("8 high street", "PO30 1AB")], "text string, postcode string")
    plans = _unsent(spark, monkeypatch, lambda: match.block_match(left, _addresses(spark)))
    assert len(plans) > 4 and not any("BroadcastHashJoin" in p for p in plans)


def test_unblocked_match_sends_no_growing_table_to_every_executor(spark, monkeypatch):
    left, right = (spark.createDataFrame([(f"{n} {s}, ryde",) for n in range(9)], "text string") for s in ("high st", "high street"))
    for scorer in ("wratio", "token_sort"):
        plans = _unsent(spark, monkeypatch, lambda scorer=scorer: match.best_match(left, right, threshold=10.0, scorer=scorer))
        # the signature's few hundred bits are the only table sent
        joins = [line for p in plans for line in p.splitlines() if "BroadcastHashJoin" in line]
        assert len(plans) > 4 and all("[gram#" in line for line in joins)


def test_enrichment_and_measures_send_no_growing_table_to_every_executor(spark, monkeypatch):
    rows = [("1", "3", "3 high street", "cowes", "PO30 1AA"), ("2", "", "4 high st", "cowes", "PO30 1AA"), ("3", None, "zz", "zz", "ZZ30 1AA")]
    certificates = spark.createDataFrame(rows, "lmk_key string, uprn string, address string, posttown string, postcode string")
    certificates = certificates.selectExpr("*", "1.0D AS current_energy_efficiency", "2.0D AS environment_impact_current")
    recommendation = "lmk_key string, improvement_item int, improvement_summary_text string, improvement_id int, improvement_id_text string, indicative_cost string, improvement_descr_text string"
    recommendations = spark.createDataFrame([("1", 1, "x", 1, "m", "", "y")], recommendation)
    addresses = _addresses(spark)
    out = []

    def run():
        out.append(marts.measures_base(enrich.enrich_certificates(certificates, addresses, districts=None), recommendations, addresses, addresses_first=True))
        return out[0]

    assert not any("BroadcastHashJoin" in p for p in _unsent(spark, monkeypatch, run))
    assert sorted((r.uprn or "", r.udprn or "", r.ImprovementIndex or 0) for r in out[0].collect()) == [("", "", 0), ("3", "u3", 1), ("4", "u4", 0), ("4", "u4", 0)]


def test_a_relationship_sends_no_keys_to_every_executor(spark, monkeypatch):
    child, parent = (spark.createDataFrame([(k,) for k in keys], "k string") for keys in (["a", "b", None], ["a", "a", "c"]))
    rule = rules.Rule("child", "relationship", "k", {"to": "parent", "field": "k"})
    for run in (lambda: quality.relationship(child, parent, "k", "k"), lambda: rules.run({"child": child, "parent": parent}, [rule])):
        assert not any("BroadcastHashJoin" in p for p in _unsent(spark, monkeypatch, run))
    assert [r.k for r in quality.relationship(child, parent, "k", "k").collect()] == ["b"]


def test_a_side_is_sent_by_its_counted_rows(spark):
    one, other = spark.range(50), spark.range(40)
    assert "BroadcastHashJoin" in _plan(one.join(session.small_side(other, 40), "id"))
    assert "SortMergeJoin" in _plan(one.join(session.small_side(other, 39), "id"))
