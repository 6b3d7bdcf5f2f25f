"""Segment plan against landed zips, bucketed joins, keyed lookups, hand-offs, strict prices."""

import zipfile

import pytest
from pyspark.sql import functions as F

from brickwork import sinks
from brickwork.functions import energy, text
from brickwork.plans import chain, handoff
from brickwork.plans.marts import measures_base
from brickwork.sources import pages, segments

COLUMNS = pages.RECOMMENDATION_SCHEMA.names


def land(root, authority, year, month, band, name, offset, rows):
    folder = root / f"authority={authority}" / f"year={year}" / f"month={month}" / f"band={band}"
    folder.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(folder / f"{name}-{offset}.zip", "w") as z:
        if rows is not None:
            lines = [",".join(COLUMNS), *(f'{authority}{year}{month}{band}{offset + i},{i},"Loft, deep",,{i % 60},Measure,£350 - £450' for i in range(rows))]
            z.writestr("recommendations.csv", "\n".join(lines))
        else:
            z.writestr("readme.txt", "no data")


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    root = tmp_path_factory.mktemp("zips")
    land(root, "E1", 2008, 1, "A", "p", 0, 5)  # complete
    land(root, "E1", 2008, 1, "B", "p", 0, None)  # empty: no file in it
    land(root, "E1", 2008, 1, "C", "p", 0, 10)
    land(root, "E1", 2008, 1, "C", "p", 20, 3)  # gapped: offset 10 is missing
    land(root, "E1", 2008, 1, "D", "p", 0, 4)  # gapped: a short page inside
    land(root, "E1", 2008, 1, "D", "p", 10, 2)
    land(root, "E1", 2008, 2, "A", "p", 0, 10)  # open: its last page is full
    land(root, "E1", 2008, 2, "B", "p", 0, 6)
    land(root, "E1", 2008, 2, "B", "again", 0, 6)  # landed twice
    land(root, "E1", 2008, 2, "C", "p", 0, 0)  # empty: a header only
    land(root, "E9", 2008, 1, "A", "p", 0, 1)  # nobody planned it
    return str(root)


def test_the_plan_is_held_against_what_landed(spark, landing):
    plan = pages.segment_plan(spark.createDataFrame([("E1",)], "authority string"), 2008, 2008, ["A", "B", "C", "D"]).filter("month <= 2")
    got = {(r.authority, r.month, r.band): (r.status, r.pages, r.rows, r.landed_again, r.capped) for r in segments.reconcile(plan, segments.landed(spark, landing), 10, 13).collect()}
    assert got == {
        ("E1", 1, "A"): ("complete", 1, 5, 0, False),
        ("E1", 1, "B"): ("empty", 1, 0, 0, False),
        ("E1", 1, "C"): ("gapped", 2, 13, 0, True),
        ("E1", 1, "D"): ("gapped", 2, 6, 0, False),
        ("E1", 2, "A"): ("open", 1, 10, 0, False),
        ("E1", 2, "B"): ("complete", 1, 6, 1, False),
        ("E1", 2, "C"): ("empty", 1, 0, 0, False),
        ("E1", 2, "D"): ("missing", 0, 0, 0, False),
        ("E9", 1, "A"): ("unplanned", 1, 1, 0, False),
    }


def test_segments_are_consolidated_in_one_read(spark, landing):
    whole = segments.consolidate(spark, landing)
    assert whole._jdf.queryExecution().executedPlan().toString().count("FileScan binaryFile") == 1
    rows = whole.collect()
    assert whole.columns == COLUMNS and len(rows) == len({r.LMK_KEY for r in rows}) == 5 + 13 + 6 + 10 + 6 + 1
    assert [r.LMK_KEY for r in rows] == sorted(r.LMK_KEY for r in rows)
    assert rows[0].IMPROVEMENT_SUMMARY_TEXT == "Loft, deep" and rows[0].IMPROVEMENT_DESCR_TEXT is None


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning"), plan


def test_bucketed_staging_joins_without_an_exchange(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        t = chain.staging_tables(spark, "/root/testdata/sf0.001", str(tmp_path), 4, "bucketed_test")
        certificates, recommendations, addresses = t["certificates"], t["recommendations"], t["addresses"]
        j1 = certificates.join(recommendations, "lmk_key", "left")
        j11 = recommendations.join(certificates.select("lmk_key"), "lmk_key", "left_anti")
        j3 = t["certificates_by_property"].join(addresses.filter("os_api_source = 'DPA'").select("uprn", "udprn"), "uprn", "left")
        for joined in (j1, j11, j3):
            assert exchanges(joined)[0] == 0 and "SortMergeJoin" in exchanges(joined)[1]
        enriched = certificates.withColumn("fuzzy_matched", F.lit(0))
        m3 = measures_base(enriched, recommendations, addresses)
        n, plan = exchanges(m3)
        assert n <= 1 and "lmk_key" not in "".join(line for line in plan.splitlines() if "Exchange hashpartitioning" in line).split("ENSURE")[0]
        plain = measures_base(
            chain.staged_certificates(spark, "/root/testdata/sf0.001").withColumn("fuzzy_matched", F.lit(0)),
            chain.staged_recommendations(spark, "/root/testdata/sf0.001"),
            chain.staged_addresses(spark, "/root/testdata/sf0.001"),
        )
        assert sorted(map(str, m3.collect())) == sorted(map(str, plain.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def rows_read(df):
    """Rows that the table's scan put out, from the metrics of an executed plan."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    while plan.children().size():
        plan = plan.children().apply(0)
    return plan.metrics().get("numOutputRows").get().value()


def test_lookups_skip_row_groups(spark, tmp_path):
    path = str(tmp_path / "keyed")
    frame = spark.range(20_000).select((F.col("id") * 2).alias("uprn"), F.concat(F.lit("at "), "id").alias("address")).repartition(5)
    sinks.write_keyed(frame, path, "uprn", rows_per_group=500)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        table = spark.read.parquet(path)
        one = sinks.lookup(table, "uprn", 8000)
        assert [r.address for r in one.collect()] == ["at 4000"] and rows_read(sinks.lookup(table, "uprn", 8000)) <= 500
        assert sorted(r.uprn for r in sinks.lookup(table, "uprn", 10, 30_000).collect()) == [10, 30_000]
        assert rows_read(sinks.lookup(table, "uprn", 10, 30_000)) <= 1000
        between = sinks.open_range(table, "uprn", 1000, 1010)
        assert sorted(r.uprn for r in between.collect()) == [1002, 1004, 1006, 1008] and rows_read(sinks.open_range(table, "uprn", 1000, 1010)) <= 1000
        # a key between the least and the greatest of its group is found missing by the Bloom filter
        assert sinks.lookup(table, "uprn", 8001).count() == 0 and rows_read(sinks.lookup(table, "uprn", 8001)) <= 500
        assert sinks.lookup(table, "uprn", -1).count() == 0 and rows_read(sinks.lookup(table, "uprn", -1)) == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_handoffs(spark):
    base = spark.createDataFrame([("1", "2", "3.0", "1 high st, COWES, PO30 1LY"), ("4", None, None, "2 mill lane, po30 1ly")], "UPRN string, UDPRN string, ParentUPRN string, Address string")
    assert [tuple(r) for r in handoff.address_base(base).collect()] == [("1", "2", "3", "1 High St, Cowes"), ("4", None, None, "2 Mill Lane, PO30 1LY")]
    measures = spark.createDataFrame([("12.0", None, "1 a road, po30 1ly", 1.0), (None, "3", "x", 2.0)], "UPRN string, UDPRN string, Address string, kWhyr double")
    got = handoff.measures(measures)
    assert got.columns == ["UPRN", "UDPRN", "Address", "KwhYr"] and [tuple(r) for r in got.collect()] == [("12", None, "1 A Road, PO30 1LY", 1.0)]
    spaced = spark.createDataFrame([("1", 2.0), (None, 3.0)], "UPRN string, `SAP Rating` double")
    assert [r.asDict() for r in handoff.profiling(spaced).collect()] == [{"UPRN": "1", "SAPRating": 2.0}]


def test_texts_of_the_hand_off(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(text.remove_postcode_and_title_case(F.lit("FLAT 1, HIGH ROAD, PO30 1LY,"))) == "Flat 1, High Road"
    assert one(text.partial_postcode(F.lit("PO30 1LY"))) == "PO30 1L" and one(text.partial_postcode(F.lit("PO30"))) == "PO30"
    assert one(text.strip_dot_zero(F.lit("10.05.0"))) == "10.05" and one(text.default_process(F.lit(" A-b,C "))) == "a b c"
    assert one(text.match_text(F.lit("a"), F.lit(None).cast("string"), F.lit("B"))) == "a, b"  # a missing part is skipped on purpose


def test_unknown_fuels_raise_or_give_null(spark):
    rows = spark.createDataFrame([("mains", 10.0)], "fuel string, area double")
    with pytest.raises(Exception, match="no price for fuel mains"):
        rows.select(energy.heating_cost("area", F.col("fuel"))).collect()
    assert rows.select(energy.heating_cost("area", F.col("fuel"), strict=False).alias("x")).first().x is None
    known = next(iter(energy.FUEL_PRICES))
    assert rows.select(energy.heating_cost("area", F.lit(known)).alias("x")).first().x > 0
    assert rows.select(energy.sap_score(F.lit(None).cast("double"), F.lit(1.0), F.lit(1.0), F.lit(1.0), null_guard=False).alias("x")).first().x is None
