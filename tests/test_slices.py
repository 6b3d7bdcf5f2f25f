"""Year slices on landed folders: what is due, replacing, empty slices, pruning, the streaming form."""

import json
import os
import re

import pytest
from pyspark.sql import functions as F

from brickwork.sources import slices as S
from brickwork.sources.pages import string_schema
from brickwork.streaming.incremental import sync_slices

RECORD = string_schema(["lmk-key", "address"])


def land(landing, authority, year, page, keys):
    folder = landing / f"authority={authority}" / f"year={year}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"page-{page}.json").write_text(json.dumps({"rows": [{"lmk-key": k, "address": f"at {k}", "extra": 1} for k in keys]}, indent=1))


@pytest.fixture
def landed(tmp_path):
    landing = tmp_path / "landing"
    for a in ("E1", "E2"):
        for y in (2008, 2009, 2010):
            land(landing, a, y, 0, [f"{a}{y}-{i}" for i in range(3)])
    land(landing, "E1", 2008, 1, ["E12008-9"])
    return str(landing), str(tmp_path / "certificates"), landing


def keys(df):
    return sorted(r["lmk-key"] for r in df.collect())


def test_a_second_run_loads_only_new_and_open_slices(spark, landed):
    landing, target, folder = landed
    plan = S.slice_plan(spark, ["E1", "E2"], 2008, 2010)
    first = S.sync(spark, landing, RECORD, target, plan)
    assert {(r.authority, r.year): r.rows for r in first.collect()} == {(a, y): 4 if (a, y) == ("E1", 2008) else 3 for a in ("E1", "E2") for y in (2008, 2009, 2010)}
    assert {(r.authority, r.year) for r in S.due_slices(plan, S.ledger(spark, target)).collect()} == {("E1", 2010), ("E2", 2010)}
    before = {p: os.path.getmtime(p) for p in (f"{target}/authority=E1/year={y}" for y in (2008, 2009, 2010))}
    land(folder, "E1", 2008, 5, ["late in a closed year"])
    land(folder, "E1", 2010, 5, ["late"])
    land(folder, "E2", 2011, 0, ["new"])
    second = S.sync(spark, landing, RECORD, target, S.slice_plan(spark, ["E1", "E2"], 2008, 2011))
    assert {(r.authority, r.year): (r.rows, r.open) for r in second.collect()} == {("E1", 2010): (4, False), ("E2", 2010): (3, False), ("E1", 2011): (0, True), ("E2", 2011): (1, True)}
    assert os.path.getmtime(f"{target}/authority=E1/year=2008") == before[f"{target}/authority=E1/year=2008"]
    found = keys(S.read_slices(spark, target, RECORD))
    assert "late" in found and "new" in found and "late in a closed year" not in found and len(found) == len(set(found)) == 21


def test_loading_a_year_again_replaces_it(spark, landed):
    landing, target, folder = landed
    plan = S.slice_plan(spark, ["E1", "E2"], 2008, 2010)
    S.sync(spark, landing, RECORD, target, plan)
    (folder / "authority=E1" / "year=2009" / "page-0.json").write_text(json.dumps({"rows": [{"lmk-key": "corrected"}]}))
    again = plan.filter("authority = 'E1' AND year = 2009")
    assert S.load_slices(spark, landing, RECORD, target, again).first().rows == 1
    one = S.read_slices(spark, target, RECORD, ["E1"], 2009, 2009)
    assert keys(one) == ["corrected"]
    assert S.read_slices(spark, target, RECORD).count() == 19 - 2
    (folder / "authority=E1" / "year=2009" / "page-0.json").write_text(json.dumps({"rows": []}))
    assert S.load_slices(spark, landing, RECORD, target, again).first().rows == 0
    assert S.read_slices(spark, target, RECORD, ["E1"], 2009, 2009).count() == 0 and not os.path.exists(f"{target}/authority=E1/year=2009")
    assert S.ledger(spark, target).filter("authority = 'E1' AND year = 2009").first().rows == 0
    assert S.read_slices(spark, target, RECORD).count() == 16


def test_a_run_that_died_before_the_ledger_leaves_its_slices_due(spark, landed, monkeypatch):
    landing, target, _ = landed
    plan = S.slice_plan(spark, ["E1"], 2008, 2010)

    def killed(target):
        raise InterruptedError

    monkeypatch.setattr(S, "ledger_path", killed)
    with pytest.raises(InterruptedError):
        S.load_slices(spark, landing, RECORD, target, plan)
    monkeypatch.undo()
    assert S.due_slices(plan, S.ledger(spark, target)).count() == 3
    S.sync(spark, landing, RECORD, target, plan)
    assert S.read_slices(spark, target, RECORD).count() == 10


def test_only_the_named_partitions_are_read(spark, landed):
    landing, target, _ = landed
    S.sync(spark, landing, RECORD, target, S.slice_plan(spark, ["E1", "E2"], 2008, 2010))
    pruned = S.read_slices(spark, target, RECORD, ["E2"], 2009)
    files = pruned.select(F.input_file_name().alias("f")).distinct().collect()
    assert {re.search(r"authority=(\w+)/year=(\d+)", r.f).groups() for r in files} == {("E2", "2009"), ("E2", "2010")}
    plan = pruned._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*authority[^\]]*year", plan) and "DataFilters: []" in plan
    pages = S.landed_records(spark, landing, RECORD, [("E1", 2008)])
    assert re.search(r"PartitionFilters: \[[^\]]*authority[^\]]*year", pages._jdf.queryExecution().toString())


def test_nothing_due_and_an_empty_plan(spark, landed):
    landing, target, _ = landed
    plan = S.slice_plan(spark, ["E1"], 2008, 2008).withColumn("open", F.lit(False))
    S.sync(spark, landing, RECORD, target, plan)
    assert S.sync(spark, landing, RECORD, target, plan).count() == 0
    assert S.sync(spark, landing, RECORD, target, plan.limit(0)).count() == 0


def test_the_stream_loads_the_slices_that_changed(spark, landed, tmp_path):
    landing, target, folder = landed

    def run():
        sync_slices(spark, landing, RECORD, target, str(tmp_path / "ckpt"), 2010).awaitTermination()

    run()
    assert S.read_slices(spark, target, RECORD).count() == 19
    loads = S.ledger(spark, target).select(*S.SLICE, "loaded_at").collect()
    run()
    assert sorted(map(str, S.ledger(spark, target).select(*S.SLICE, "loaded_at").collect())) == sorted(map(str, loads))
    land(folder, "E2", 2009, 7, ["more"])
    run()
    now = {(r.authority, r.year): r.loaded_at for r in S.ledger(spark, target).collect()}
    assert [(r.authority, r.year) for r in loads if now[r.authority, r.year] != r.loaded_at] == [("E2", 2009)]
    assert S.read_slices(spark, target, RECORD, ["E2"], 2009, 2009).count() == 4


def test_records_are_loaded_by_the_tasks_that_parse_them(spark, landed):
    landing, target, _ = landed
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "64b")  # a page a task
    try:
        S.sync(spark, landing, RECORD, target, S.slice_plan(spark, ["E1", "E2"], 2008, 2010))
    finally:
        spark.conf.set(key, before)
    # the two pages of a slice were not shuffled together
    assert len([f for f in os.listdir(f"{target}/authority=E1/year=2008") if f.endswith(".parquet")]) == 2
    assert len(keys(S.read_slices(spark, target, RECORD))) == 19
