"""Landed pages, zipped segments, CSV, sinks and the incremental stream."""

import io
import json
import os
import tempfile
import time
import zipfile

from pyspark.sql import functions as F

from brickwork import sinks
from brickwork.sources import pages
from brickwork.streaming import incremental


def test_explode_results_envelope(spark):
    record = pages.string_schema(["UPRN", "ADDRESS"])
    doc = json.dumps({"results": [{"DPA": {"UPRN": "1", "ADDRESS": "a"}}, {"DPA": {"UPRN": "2", "ADDRESS": "b"}}]})
    df = spark.createDataFrame([(doc,)], "page string")
    out = sorted(tuple(r) for r in pages.explode_results(df, "page", record, "DPA").collect())
    assert out == [("1", "a"), ("2", "b")]


def test_read_row_pages_and_csv_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="bw-pages-")
    for i in range(3):
        with open(os.path.join(d, f"p{i}.json"), "w") as f:
            json.dump({"rows": [{"lmk-key": f"{i}-{j}", "uprn": str(j)} for j in range(4)]}, f)
    record = pages.string_schema(["lmk-key", "uprn"])
    df = pages.read_row_pages(spark, d, record)
    assert df.count() == 12
    out = os.path.join(tempfile.mkdtemp(prefix="bw-csv-"), "x")
    sinks.write_csv(df, out)
    back = pages.read_csv_extract(spark, out, record)
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0


def test_recommendation_zips(spark):
    d = tempfile.mkdtemp(prefix="bw-zip-")
    csv = "LMK_KEY,IMPROVEMENT_ITEM,IMPROVEMENT_SUMMARY_TEXT,IMPROVEMENT_DESCR_TEXT,IMPROVEMENT_ID,IMPROVEMENT_ID_TEXT,INDICATIVE_COST\n"
    csv += 'k1,1,Loft,Install,5,Measure 5,"£350 - £450"\nk1,2,,,,,\n'
    for name, files in [("a.zip", {"recommendations.csv": csv}), ("b.zip", {"readme.txt": "no data"})]:
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as z:
            for fn, body in files.items():
                z.writestr(fn, body)
        with open(os.path.join(d, name), "wb") as f:
            f.write(buf.getvalue())
    rows = pages.read_recommendation_zips(spark, d).orderBy("IMPROVEMENT_ITEM").collect()
    assert len(rows) == 2
    assert rows[0].INDICATIVE_COST == "£350 - £450" and rows[0].IMPROVEMENT_ID == 5.0
    assert rows[1].IMPROVEMENT_ID is None and rows[1].IMPROVEMENT_SUMMARY_TEXT is None


def test_segment_plan_size(spark):
    auth = spark.createDataFrame([("E1",), ("E2",)], "authority string")
    plan = pages.segment_plan(auth, 2008, 2024, ["A", "B", "C", "D", "E", "F", "G"])
    assert plan.count() == 2 * 17 * 12 * 7


def test_numeric_key_and_export_name(spark):
    df = spark.createDataFrame([("12.0",), (None,)], "UPRN string")
    assert [r.UPRN for r in sinks.numeric_key(df, "UPRN").collect()] == [12]
    import datetime as dt

    assert sinks.export_name("mart", "me", dt.datetime(2024, 1, 2, 3, 4, 5)) == "mart_me_2024-01-02_030405"


def test_incremental_stream_reads_each_page_once(spark):
    landing = tempfile.mkdtemp(prefix="bw-land-")
    target = os.path.join(tempfile.mkdtemp(prefix="bw-out-"), "t")
    ckpt = tempfile.mkdtemp(prefix="bw-ck-")
    record = pages.string_schema(["lmk-key"])

    def land(i):
        with open(os.path.join(landing, f"page{i}.json"), "w") as f:
            json.dump({"rows": [{"lmk-key": f"{i}-{j}"} for j in range(5)]}, f)

    land(0)
    land(1)
    incremental.sync_pages(spark, landing, record, target, ckpt).awaitTermination(120)
    assert spark.read.parquet(target).count() == 10
    land(2)
    time.sleep(1)
    incremental.sync_pages(spark, landing, record, target, ckpt).awaitTermination(120)
    out = spark.read.parquet(target)
    assert out.count() == 15
    assert out.select(F.countDistinct("lmk-key")).first()[0] == 15


def test_build_marts_writes_every_mart(spark):
    from brickwork.plans import chain

    out = tempfile.mkdtemp(prefix="bw-marts-")
    paths = chain.build_marts(spark, "/root/testdata/sf0.001", out, csv_exports=True)
    assert set(paths) == {
        "address_profiling",
        "address_profiling_scored",
        "address_base",
        "improvement_measures",
    }
    prof = spark.read.parquet(paths["address_profiling"])
    assert prof.count() == prof.select("UPRN").distinct().count() > 0
    assert len(os.listdir(os.path.join(out, "exports"))) == 4


def test_page_audit_finds_duplicate_missing_and_short_pages(spark):
    rows = [("dup", 0, 1000), ("dup", 0, 1000), ("dup", 2000, 5), ("short", 0, 1000), ("short", 1000, 400), ("short", 2000, 7), ("ok", 0, 1000), ("ok", 1000, 3)]
    pages_ = spark.createDataFrame(rows, "seg string, offset long, rows long")
    got = {r.seg: r for r in pages.page_audit(pages_, ["seg"], "offset", "rows").collect()}
    assert [(got[s].gapped, got[s].missing, got[s].short_inside, got[s].landed_again, got[s].rows) for s in ("dup", "short", "ok")] == [
        (True, 1, 0, 1, 1005),
        (True, 0, 1, 0, 1407),
        (False, 0, 0, 0, 1003),
    ]
    assert [tuple(r) for r in pages.missing_offsets(pages_, ["seg"], "offset").collect()] == [("dup", 1000)]


def test_replayed_stream_batch_changes_nothing(spark):
    target = tempfile.mkdtemp(prefix="bw-replay-")
    batch = spark.range(7)
    for _ in range(2):
        incremental.write_batch(batch, 0, target)
    incremental.write_batch(spark.range(3), 1, target)
    assert spark.read.parquet(target).count() == 10
