"""Deterministic certificate / address / recommendation feeds derived from
the driver's TPC-H-like tables.

The test data holds no certificates or addresses, so the feeds are derived
from ``orders`` (one certificate per order), ``customer`` (one property per
customer) and ``lineitem`` (one recommendation per line).  The derivation is
plain SQL text that runs unchanged in Spark SQL and in DuckDB, so the Spark
queries and their DuckDB oracles start from identical inputs; only identifier
quoting (hyphenated raw names) and the table reference differ.

Every feed scales with its source table: nothing is sampled or capped.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from . import schemas

# --- shared value expressions ------------------------------------------------


def _street(k: str) -> str:
    return (
        f"CASE {k} % 7 WHEN 0 THEN 'high street' WHEN 1 THEN 'o''brien lane' "
        f"WHEN 2 THEN 'mill hill road' WHEN 3 THEN 'st. john''s-on-sea' WHEN 4 THEN 'gate lane' "
        f"WHEN 5 THEN 'flat 1a cross street' ELSE 'salterns road' END"
    )


def _town(k: str) -> str:
    return f"(CASE {k} % 4 WHEN 0 THEN 'cowes' WHEN 1 THEN 'ryde' WHEN 2 THEN 'hull' ELSE 'goole' END)"


def _postcode(k: str) -> str:
    """Twelve neighbouring keys share a postcode, so postcodes grow with the keys."""
    j = f"cast(floor({k} / 12) as bigint)"
    letters = "'ABDEFGHJLNPQRSTUWXYZ'"
    unit = " || ".join(f"substr({letters}, cast(1 + cast(floor({j} / {step}) as bigint) % 20 as int), 1)" for step in (9, 180))
    return (
        f"(CASE {j} % 8 WHEN 0 THEN 'PO30' WHEN 1 THEN 'PO31' WHEN 2 THEN 'HU2' WHEN 3 THEN 'HU20' "
        f"WHEN 4 THEN 'YO4' WHEN 5 THEN 'YO41' WHEN 6 THEN 'DN14' ELSE 'SW1A' END || ' ' || "
        f"cast(1 + {j} % 9 as string) || {unit})"
    )


def _address(k: str) -> str:
    return f"(cast(1 + {k} % 997 as string) || ' ' || {_street(k)} || ', ' || {_town(k)} || ', ' || lower({_postcode(k)}))"


# Landed descriptions, one for every label of the category maps and some for none.
HEATING = (
    "Boiler and radiators, mains gas", "Electric storage heaters", "Portable electric heaters", "Boiler and radiators, LPG",
    "Boiler and underfloor heating, LPG", "Boiler and radiators, oil", "Boiler and underfloor heating, oil", "Electric underfloor heating",
    "Community scheme", "Warm air, mains gas", "Boiler & underfloor, mains gas", "Boiler and underfloor heating, mains gas",
    "Air source heat pump, radiators, electric", "Boiler and radiators, electric", "Boiler and underfloor heating, electric",
    "Ground source heat pump, radiators", "Boiler and radiators, dual fuel (mineral and wood)", "Boiler and radiators, wood logs",
    "Room heaters, mains gas", "No system present: electric heaters assumed", "Water source heat pump, radiators",
    "boiler and radiators, oil", "Solar panels", None,
)
FUEL = (
    "mains gas (not community)", "Electricity: electricity, unspecified tariff", "oil (not community)", "LPG (community)",
    "To be used only when there is no heating/hot-water system", "dual fuel - mineral + wood", "wood logs", "house coal (not community)",
    "biomass (community)", "INVALID!", "anthracite", "smokeless coal", "bulk wood pellets", "wood chips", "biogas (community)", "straw", None,
)
GLAZING = (
    "double glazing installed before 2002", "double glazing installed during or after 2002", "double glazing, unknown install date",
    "not defined", "secondary glazing", "single glazing", "INVALID!", "triple glazing", "double, known data", "triple, known data", "other", None,
)
LEVEL = (
    "Basement", "-1.0", "-1", "Ground", "ground floor", "00", "0.0", "1st", "01", "1.0", "1", "2nd", "02", "2.0", "2", "3rd", "03", "3.0", "3",
    "4th", "04", "5th", "05", "5.0", "6th", "7th", "07", "8th", "12th", "TopFloor", "MidFloor", "mid floor", None,
)
WALLS = (
    "Cavity wall, filled cavity", "Cavity wall, filled cavity and internal insulation", "Cavity wall, filled cavity and external insulation",
    "Sandstone or limestone, as built, no insulation (assumed)", "Sandstone, with internal insulation", "Solid brick, with external insulation",
    "Timber frame, as built, insulated (assumed)", "Granite or whinstone, with additional insulation", "Park home wall, as built", "Cob,",
    "System built, with internal insulation", "Average thermal transmittance 0.2", None,
)


def _pick(values: tuple, step: int) -> str:
    """The values in turn; ``step`` keeps two lists from going round together."""
    whens = " ".join(f"WHEN {i} THEN " + ("NULL" if v is None else "'" + v.replace("'", "''") + "'") for i, v in enumerate(values))
    return f"CASE cast(floor(o / {step}) as bigint) % {len(values)} {whens} END"


# --- feed definitions ----------------------------------------------------------
# {q} quotes a hyphenated identifier, {t[name]} references a source table.

_DPA_RAW = """
SELECT cast(k as string) AS UPRN, cast(5000000 + k as string) AS UDPRN, {addr} AS ADDRESS, {pc} AS POSTCODE,
 cast(430000 + (k * 37) % 90000 as double) AS X_COORDINATE, cast(85000 + (k * 53) % 340000 as double) AS Y_COORDINATE,
 CASE WHEN k % 50 = 0 THEN NULL ELSE 'osgb' || cast(k % 700 as string) END AS TOPOGRAPHY_LAYER_TOID,
 cast(NULL as string) AS PARENT_UPRN, 'RD' AS CLASSIFICATION_CODE, 'Dwelling' AS CLASSIFICATION_CODE_DESCRIPTION,
 upper({town}) AS POST_TOWN, cast(1 + k % 997 as string) AS BUILDING_NUMBER, upper({street}) AS THOROUGHFARE_NAME,
 cast(NULL as string) AS ORGANISATION_NAME
FROM (SELECT c_custkey AS k FROM {customer} WHERE c_custkey % 6 <> 5) t
"""

_LPI_RAW = """
SELECT cast(k as string) AS UPRN, {addr} AS ADDRESS, {pc} AS POSTCODE_LOCATOR,
 cast(430000 + (k * 37) % 90000 as double) AS X_COORDINATE, cast(85000 + (k * 53) % 340000 as double) AS Y_COORDINATE,
 'osgb' || cast(k % 700 as string) AS TOPOGRAPHY_LAYER_TOID, cast(NULL as string) AS PARENT_UPRN, 'RD' AS CLASSIFICATION_CODE,
 CASE k % 9 WHEN 0 THEN 'Street Record' WHEN 1 THEN 'PO Box' WHEN 2 THEN NULL ELSE 'Dwelling' END AS CLASSIFICATION_CODE_DESCRIPTION
FROM (SELECT c_custkey AS k FROM {customer} WHERE c_custkey % 3 = 2) t
"""

# Domestic certificates: every order except o % 10 = 9; orders with o % 97 = 0
# are landed twice (exact duplicate rows, removed by the staging UNION).
_DOMESTIC_RAW = """
SELECT cast(o as string) AS {q}lmk-key{q}, CASE WHEN o % 11 = 0 THEN '' ELSE cast(k as string) END AS uprn,
 CASE WHEN o % 11 <> 0 THEN a WHEN o % 3 = 0 THEN replace(replace(a, 'street', 'st'), 'road', 'rd')
      WHEN o % 3 = 1 THEN replace(replace(a, 'lane', 'laen'), 'salterns', 'saltern')
      ELSE replace(replace(a, ', ', ' '), '''', '') END AS address,
 {town} AS posttown, {pc} AS postcode,
 CASE o % 6 WHEN 0 THEN 'House' WHEN 1 THEN 'Flat' WHEN 2 THEN 'Park home' WHEN 3 THEN 'Bungalow' WHEN 4 THEN 'Maisonette' ELSE '' END AS {q}property-type{q},
 CASE o % 5 WHEN 0 THEN 'Semi-Detached' WHEN 1 THEN 'Enclosed End-Terrace' WHEN 2 THEN 'NO DATA!' WHEN 3 THEN 'Detached' ELSE NULL END AS {q}built-form{q},
 CASE o % 8 WHEN 0 THEN 'Pitched, 270 mm loft insulation' WHEN 1 THEN 'Pitched, 400+ mm loft insulation' WHEN 2 THEN '(another dwelling above)'
      WHEN 3 THEN 'Flat, insulated  (assumed)' WHEN 4 THEN 'Roof room(s), ceiling insulated' WHEN 5 THEN 'Pitched, 75mm insulation'
      WHEN 6 THEN 'Pitched, *** INVALID INPUT Code : 57 *** loft insulation' ELSE NULL END AS {q}roof-description{q},
 {walls} AS {q}walls-description{q},
 CASE o % 5 WHEN 0 THEN 'Solid, no insulation (assumed)' WHEN 1 THEN 'Suspended, uninsulated' WHEN 2 THEN '(other premises below)'
      WHEN 3 THEN 'To unheated space, limited insulation (assumed)' ELSE NULL END AS {q}floor-description{q},
 CASE o % 3 WHEN 0 THEN 'Fully double glazed' WHEN 1 THEN 'Single glazed' ELSE ' Partial double glazing ' END AS {q}windows-description{q},
 {heating} AS {q}mainheat-description{q},
 {fuel} AS {q}main-fuel{q},
 CASE o % 4 WHEN 0 THEN 'Programmer, room thermostat and TRVs' WHEN 1 THEN 'unknown' WHEN 2 THEN 'No time or thermostatic control of room temperature' ELSE 'Appliance thermostats' END AS {q}main-heating-controls{q},
 {glazing} AS {q}glazed-type{q},
 CASE o % 4 WHEN 0 THEN '' WHEN 1 THEN 'Normal' WHEN 2 THEN 'Much More Than Typical' ELSE NULL END AS {q}glazed-area{q},
 CASE o % 6 WHEN 0 THEN 'Good' WHEN 1 THEN 'Very Good' WHEN 2 THEN 'Poor' WHEN 3 THEN 'Average' WHEN 4 THEN 'N/A' ELSE 'Excellent' END AS {q}walls-env-eff{q},
 CASE o % 6 WHEN 0 THEN 'England and Wales: 1900-1929' WHEN 1 THEN 'England and Wales: 2007 onwards' WHEN 2 THEN 'England and Wales: before 1900'
      WHEN 3 THEN '1999' WHEN 4 THEN 'Year 2012' ELSE 'Unknown' END AS {q}construction-age-band{q},
 {level} AS {q}floor-level{q},
 CASE o % 7 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' WHEN 3 THEN 'D' WHEN 4 THEN 'E' WHEN 5 THEN 'F' ELSE 'G' END AS {q}current-energy-rating{q},
 CASE WHEN o % 19 = 0 THEN '' ELSE cast(1 + o % 100 as string) END AS {q}current-energy-efficiency{q},
 cast(1 + (o * 7) % 100 as string) AS {q}environment-impact-current{q},
 cast(o % 90 as string) || '.' || cast(o % 10 as string) AS {q}co2-emissions-current{q},
 CASE WHEN o % 13 = 0 THEN NULL ELSE cast(30 + o % 170 as string) END AS {q}total-floor-area{q},
 cast(100 + o % 900 as string) AS {q}heating-cost-current{q},
 CASE WHEN o % 17 = 0 THEN '' ELSE cast(60 + o % 240 as string) END AS {q}hot-water-cost-current{q},
 cast(40 + o % 120 as string) AS {q}lighting-cost-current{q},
 CASE WHEN o % 23 = 0 THEN '' ELSE cast(o % 3 as string) END AS {q}number-open-fireplaces{q},
 cast(o % 2 as string) AS {q}wind-turbine-count{q},
 CASE o % 3 WHEN 0 THEN 'natural' WHEN 1 THEN 'mechanical, extract only' ELSE 'NO DATA!' END AS {q}mechanical-ventilation{q},
 CASE WHEN o % 6 = 1 THEN cast(1 + o % 5 as string) ELSE '' END AS {q}flat-storey-count{q},
 cast(cast(d as date) as string) AS {q}inspection-date{q},
 cast(cast(d as date) as string) AS {q}lodgement-date{q},
 CASE o % 3 WHEN 0 THEN 'marketed sale' WHEN 1 THEN 'rental (private)' ELSE 'new dwelling' END AS {q}transaction-type{q}
FROM (SELECT *, {addr} AS a FROM (
        SELECT o_orderkey AS o, o_custkey AS k, o_orderdate AS d FROM {orders} WHERE o_orderkey % 10 <> 9
        UNION ALL
        SELECT o_orderkey AS o, o_custkey AS k, o_orderdate AS d FROM {orders} WHERE o_orderkey % 10 <> 9 AND o_orderkey % 97 = 0
      ) u) t
"""

_NON_DOMESTIC_RAW = """
SELECT cast(o as string) AS {q}lmk-key{q}, CASE WHEN o % 11 = 0 THEN '' ELSE cast(k as string) END AS uprn,
 CASE WHEN o % 11 <> 0 THEN a ELSE replace(replace(a, 'street', 'st'), 'road', 'rd') END AS address,
 {town} AS posttown, {pc} AS postcode,
 CASE o % 4 WHEN 0 THEN 'Retail' WHEN 1 THEN 'Office' WHEN 2 THEN 'B1 Offices and Workshop businesses' ELSE 'Hotel' END AS {q}property-type{q},
 cast(100 + o % 900 as string) AS {q}floor-area{q},
 cast(cast(d as date) as string) AS {q}inspection-date{q},
 cast(cast(d as date) as string) AS {q}lodgement-date{q},
 CASE o % 2 WHEN 0 THEN 'Mandatory issue (Marketed sale)' ELSE 'Voluntary' END AS {q}transaction-type{q}
FROM (SELECT *, {addr} AS a FROM (SELECT o_orderkey AS o, o_custkey AS k, o_orderdate AS d FROM {orders} WHERE o_orderkey % 10 = 9) u) t
"""

_RECOMMENDATIONS_RAW = """
SELECT cast(l_orderkey as string) AS lmk_key, l_linenumber AS improvement_item,
 CASE l_partkey % 4 WHEN 0 THEN 'Loft insulation' WHEN 1 THEN 'Cavity wall insulation' WHEN 2 THEN NULL ELSE 'Solar water heating' END AS improvement_summary_text,
 CASE l_partkey % 4 WHEN 2 THEN 'N/A' ELSE 'Install measure' END AS improvement_descr_text,
 cast(l_partkey % 60 as int) AS improvement_id, 'Measure ' || cast(l_partkey % 60 as string) AS improvement_id_text,
 CASE l_partkey % 3 WHEN 0 THEN '£350 - £450' WHEN 1 THEN '' ELSE '£4,000 - £6,000' END AS indicative_cost
FROM {lineitem}
"""

FEEDS = {
    "dpa_raw": _DPA_RAW,
    "lpi_raw": _LPI_RAW,
    "domestic_raw": _DOMESTIC_RAW,
    "non_domestic_raw": _NON_DOMESTIC_RAW,
    "recommendations_raw": _RECOMMENDATIONS_RAW,
}

SOURCE_TABLES = ("customer", "orders", "lineitem")


# What the other columns hold, by the end of their name.
_ENDINGS = (
    (("-eff",), ("Very Good", "Good", "Average", "Poor", "Very Poor", "N/A", None)),
    (("-rating",), ("A", "B", "C", "D", "E", "F", "G")),
    (("-flag",), ("Y", "N", "", None)),
    (("-description",), ("From main system", "Low energy lighting", "None", "", None)),
)
_NUMERIC = ("-count", "-cost-potential", "-potential", "-rooms", "-supply", "-height", "-length", "-lighting", "-proportion", "-current", "-area", "-efficiency")
_STRICT = ("co2-emissions-potential", "energy-consumption-current", "potential-energy-efficiency")


def _filler(column: str, place: int, key: str) -> str:
    """A column that no rule of the marts reads: numbers, short texts, empty and missing values, by its place."""
    turn = f"cast(floor({key} / {place % 5 + 1}) as bigint)"
    if column.endswith("-datetime"):
        return f"'2021-03-' || cast(10 + {key} % 19 as string) || ' 10:00:00'"
    if column in _STRICT:
        return f"CASE WHEN {key} % {place + 7} = 0 THEN NULL ELSE cast({turn} % {place + 20} as string) END"
    if column.endswith(_NUMERIC):
        return f"CASE {key} % {place % 7 + 5} WHEN 0 THEN '' WHEN 1 THEN NULL ELSE cast({turn} % 89 as string) END"
    for ends, values in _ENDINGS:
        if column.endswith(ends):
            whens = " ".join(f"WHEN {i} THEN " + ("NULL" if v is None else f"'{v}'") for i, v in enumerate(values))
            return f"CASE {turn} % {len(values)} {whens} END"
    return f"CASE {key} % {place % 11 + 3} WHEN 0 THEN NULL WHEN 1 THEN '' ELSE '{column.lower()} ' || cast({turn} % 50 as string) END"


def _whole_record(sql: str, columns: list[str], key: str, feed: str) -> str:
    """The feed's SELECT with every column of its declared schema and the loader's lineage."""
    before, rest = sql.split("\nFROM ", 1)
    made = [c for c in columns if f"{{q}}{c}{{q}}" not in before and not re.search(rf"AS {c}\b", before)]
    number = lambda c: f"cast({key} % 7 as double)" if c in schemas.NUMBERS else _filler(c, columns.index(c), key)
    more = [f"{number(c)} AS {{q}}{c}{{q}}" for c in made]
    stamp = f"cast(1 + cast(floor({key} / 1000) as bigint) as string)"
    lineage = [f"'{feed}-' || {stamp}", f"'emitted ' || {stamp}", f"'normalised ' || {stamp}", f"'{feed}#' || cast({key} as string)"]
    more += [f"{value} AS {name}" for value, name in zip(lineage, schemas.LINEAGE, strict=True)]
    return before + ",\n " + ",\n ".join(more) + "\nFROM " + rest


_WHOLE = {
    "dpa_raw": (schemas.DPA, "k", "dpa"),
    "lpi_raw": (schemas.LPI, "k", "lpi"),
    "domestic_raw": (schemas.DOMESTIC, "o", "domestic"),
    "non_domestic_raw": (schemas.NON_DOMESTIC, "o", "non-domestic"),
}
FEEDS |= {name: _whole_record(FEEDS[name], *how) for name, how in _WHOLE.items()}


def feed_sql(name: str, quote: str, table_ref) -> str:
    """Render one feed for an engine: ``quote`` wraps hyphenated names,
    ``table_ref(name)`` gives the text that reads a source table."""
    k_exprs = {"addr": _address("k"), "pc": _postcode("k"), "town": _town("k"), "street": _street("k")}
    lists = {"heating": (HEATING, 1), "fuel": (FUEL, 2), "glazing": (GLAZING, 3), "level": (LEVEL, 1), "walls": (WALLS, 5)}
    k_exprs |= {column: _pick(*values) for column, values in lists.items()}
    tables = {t: table_ref(t) for t in SOURCE_TABLES}
    return FEEDS[name].format(q=quote, **k_exprs, **tables)


def spark_table_ref(sf_dir: str):
    return lambda name: f"parquet.`{sf_dir}/{name}.parquet`"


def load_feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived raw feed as a DataFrame, read straight from the parquet."""
    return spark.sql(feed_sql(name, "`", spark_table_ref(sf_dir)))


def load_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: load_feed(spark, sf_dir, name) for name in FEEDS}


def duckdb_ctes(names=tuple(FEEDS)) -> str:
    """``name AS (...)`` CTE fragments over the oracle's pre-registered views."""
    return ",\n".join(f"{n} AS ({feed_sql(n, chr(34), lambda t: t)})" for n in names)
