"""Every registered query against its DuckDB twin on the smallest data."""

import duckdb
import pytest

import __spark_entry__ as entry
from brickwork import queries as Q
from tools.oracle_check import TABLES, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


NAMES = sorted(set(entry.oracle_sql()) & set(Q.REGISTRY))


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    rel = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_of(df.columns, srows) == rows_of(rel.columns, rel.fetchall())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "SAPScore" in df.columns


def test_every_label_is_reached(spark):
    """Each entry of the maps occurs in the feed, so a wrong one turns a row of the oracle red."""
    from brickwork.functions import categories as cat
    from brickwork.functions import energy
    from brickwork.plans import chain
    from pyspark.sql import functions as F

    c = chain.staged_certificates(spark, SF).filter("certificate_type = 'domestic'")
    maps = {
        "heat": (cat.heating_category("mainheat_description"), {label for _, label in cat.HEATING_CATEGORY} | {"Other"}),
        "fuel": (cat.fuel_category("main_fuel"), {label for _, label in cat.FUEL_CATEGORY}),
        "glazing": (F.col("glazed_type"), set(cat.GLAZING_TYPE)),
        "level": (F.col("floor_level"), set(cat.FLOOR_LEVEL_ALL)),
        "wall": (cat.wall_construction("walls_description"), {label for _, label in cat.WALL_CONSTRUCTION if label != "SandstoneOrLimestone"}),
        "insulation": (cat.wall_insulation_type("walls_description"), {label for _, label in cat.WALL_INSULATION_TYPE}),
        "price": (energy.clean_fuel(cat.fuel_category("main_fuel")), set(energy.FUEL_PRICES)),
    }
    found = c.agg(*[F.collect_set(column).alias(name) for name, (column, _) in maps.items()]).first()
    for name, (_, want) in maps.items():
        assert want <= set(found[name]), (name, want - set(found[name]))
