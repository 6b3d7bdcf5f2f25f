"""Declared schemas on landed pages, strict staging with quarantine, declared tests."""

import json
import os

import pytest
from pyspark.sql import functions as F

from brickwork.operators import columns, rules
from brickwork.operators.rules import Rule
from brickwork.plans import staging
from brickwork.plans.declared import RULES
from brickwork.sources import pages, schemas


@pytest.mark.parametrize(("feed", "n"), [("domestic", 92), ("non_domestic", 40), ("DPA", 38), ("LPI", 49)])
def test_declared_schemas_read_landed_pages(spark, tmp_path, feed, n):
    """Every declared column arrives, an undeclared one is left out, a missing one is NULL."""
    record = schemas.RECORDS[feed]
    assert len(record) == len(set(record.names)) == n
    value = lambda c, i: float(i) if c in schemas.NUMBERS else f"{c} {i}"
    whole = {c: value(c, 1) for c in record.names} | {"unheard-of": 1}
    part = {record.names[0]: value(record.names[0], 2)}
    rows = [whole, part]
    page = {"rows": rows} if "domestic" in feed else {"results": [{feed: r} for r in rows]}
    (tmp_path / "page.json").write_text(json.dumps(page, indent=2))
    if "domestic" in feed:
        got = pages.read_row_pages(spark, str(tmp_path), record)
    else:
        got = pages.read_result_pages(spark, str(tmp_path), record, feed)
    assert got.schema.names == record.names
    first, second = got.orderBy(F.col(f"`{record.names[-1]}`").isNull()).collect()
    assert first.asDict() == {c: value(c, 1) for c in record.names}
    assert [v for v in second if v is not None] == [value(record.names[0], 2)]


def certificate(**values):
    return {c: None for c in schemas.DOMESTIC + schemas.LINEAGE} | values


def feeds(spark, dirty):
    schema = schemas.record(schemas.DOMESTIC, lineage=True)
    clean = certificate(**{"lmk-key": "ok", "total-floor-area": "10.5", "number-open-fireplaces": "", "lodgement-date": "2020-02-29", "glazed-area": ""})
    rows = [clean, clean, *(certificate(**d) for d in dirty)]
    domestic = spark.createDataFrame([tuple(r[c] for c in schema.names) for r in rows], schema)
    other = schemas.record(schemas.NON_DOMESTIC, lineage=True)
    return domestic, spark.createDataFrame([tuple("nd" if c == "lmk-key" else "2021-01-01" if c.endswith("-date") else c for c in other.names)], other)


def test_full_staging_has_97_and_41_columns(spark):
    staged = staging.stage_certificates(*feeds(spark, []))
    assert len(staged.columns) == 97 and staged.count() == 2
    ok = staged.filter("lmk_key = 'ok'").first()
    assert (ok.total_floor_area, ok.number_open_fireplaces, str(ok.lodgement_date), ok.glazed_area) == (10.5, None, "2020-02-29", "NO DATA!")
    nd = staged.filter("certificate_type = 'non_domestic'").first()
    assert nd.county == "county" and nd.walls_env_eff is None and nd.glazed_area == "NO DATA!" and nd.total_floor_area is None
    real = [c for c, v in nd.asDict().items() if v is not None]
    assert len(real) == 20 + 1 + 4 + 1
    empty = [spark.createDataFrame([], schemas.record(c, lineage=True)) for c in (schemas.DPA, schemas.LPI)]
    assert len(staging.stage_addresses(*empty).columns) == 41


def test_strict_staging_raises_and_the_checked_one_keeps_the_bad_rows(spark, tmp_path):
    dirty = [
        {"lmk-key": "bad1", "total-floor-area": "", "inspection-date": "yesterday"},
        {"lmk-key": "bad2", "number-open-fireplaces": "two", "photo-supply": "1,5"},
        {"lmk-key": "fine", "number-open-fireplaces": "", "total-floor-area": "3"},
    ]
    domestic, other = feeds(spark, dirty)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stage_certificates(domestic, other).collect()
    staged = staging.check_certificates(domestic, other)
    accepted, refused = columns.write_checked(staged, str(tmp_path / "checked"))
    assert sorted(r.lmk_key for r in accepted.collect()) == ["fine", "nd", "ok", "ok"]
    assert accepted.columns == staging.stage_certificates(domestic, other).columns
    lines = columns.quarantine(refused, ["lmk_key"]).collect()
    assert sorted((r.lmk_key, r["column"], r.value, r.type, r.rule) for r in lines) == [
        ("bad1", "inspection_date", "yesterday", "date", "strict"),
        ("bad1", "total_floor_area", "", "double", "strict"),
        ("bad2", "number_open_fireplaces", "two", "int", "nullif"),
        ("bad2", "photo_supply", "1,5", "double", "nullif"),
    ]
    kept = refused.filter("lmk_key = 'bad2'").first()
    assert kept.number_open_fireplaces is None and kept.certificate_type == "domestic"
    strict = staging.stage_certificates(domestic.filter("`lmk-key` IN ('ok', 'fine')"), other)
    assert sorted(map(str, accepted.distinct().collect())) == sorted(map(str, strict.collect()))
    assert "PartitionFilters: [isnotnull(_bad" in accepted._jdf.queryExecution().executedPlan().toString()


CHECKED = [
    Rule("t", "accepted_values", "a", {"values": ["x", "y"]}),
    Rule("t", "between", "n", {"least": 0, "most": 5}),
    Rule("t", "not_null", "a"),
    Rule("t", "regex", "a", {"pattern": "^[xyz]$"}),
    Rule("t", "all_null", "e"),
    Rule("t", "expression", args={"sql": "n > 0"}),
    Rule("t", "row_count", args={"least": 6}),
    Rule("t", "is_date", "d"),
    Rule("t", "type", "n", {"types": ("int", "bigint")}),
    Rule("t", "type", "a", {"types": ("double",)}),
    Rule("t", "type", "missing", {"types": ("double",)}),
    Rule("t", "unique", "a"),
    Rule("t", "relationship", "a", {"to": "p", "field": "k"}),
    Rule("p", "fewer_rows_than", args={"than": "t"}),
    Rule("t", "fewer_rows_than", args={"than": "p"}),
]
WANT = [1, 2, 1, 1, 0, 1, 1, 1, 0, 1, 1, 1, 2, 0, 1]


def checked_tables(spark):
    t = [("x", 1, None, "2020-01-01"), ("x", 9, None, "2020-13-01"), ("zz", -1, None, None), (None, 5, None, "2020-02-02"), ("y", None, None, None)]
    return {"t": spark.createDataFrame(t, "a string, n int, e double, d string"), "p": spark.createDataFrame([("x",), (None,)], "k string")}


def test_every_kind_of_rule(spark):
    got = {(r.table, r.check, r.column): r.failures for r in rules.run(checked_tables(spark), CHECKED).collect()}
    want = {(r.table, r.check, r.column): n for r, n in zip(CHECKED, WANT, strict=True)}
    assert got == want


def test_rules_on_rows_share_one_scan(spark, tmp_path):
    tables = checked_tables(spark)
    path = str(tmp_path / "t")
    tables["t"].write.parquet(path)
    mine = [r for r in CHECKED if r.check in rules.AGGREGATES]
    plan = rules.run({"t": spark.read.parquet(path)}, mine)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1


def test_rules_are_observed_while_a_table_is_written(spark, tmp_path):
    df, watch = rules.observed(checked_tables(spark)["t"], "t", CHECKED)
    df.write.parquet(str(tmp_path / "out"))
    got = {(r.check, r.column): n for r, n in watch.failures()}
    want = {(r.check, r.column): n for r, n in zip(CHECKED, WANT) if r.table == "t" and r.check in rules.AGGREGATES}
    assert got == want and os.path.exists(tmp_path / "out" / "_SUCCESS")


def test_unknown_checks_and_columns_raise(spark):
    with pytest.raises(ValueError):
        rules.run(checked_tables(spark), [Rule("t", "no such check")])
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        rules.run(checked_tables(spark), [Rule("t", "not_null", "missing")]).collect()


def test_an_empty_table_passes_all_but_the_row_count(spark):
    empty = {k: v.limit(0) for k, v in checked_tables(spark).items()}
    mine = [r for r in CHECKED if r.check in rules.AGGREGATES]
    assert {r.check: r.failures for r in rules.run(empty, mine).collect() if r.failures} == {"row_count": 1}


def test_the_declared_rules_are_many():
    assert len(RULES) > 60 and {r.check for r in RULES} >= {"accepted_values", "between", "not_null", "regex", "all_null", "type", "unique", "relationship", "row_count"}
