"""Address-base mart (M6), measures base table (M3) and measures mart (M7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import with_lat_lon
from ..functions.text import format_address, trim_ws
from ..operators.columns import null_placeholders_all, rename, strip_all
from ..operators.dedup import distinct_rows, shared_value_flag
from ..session import shuffled
from .enrich import TARGET_DISTRICTS, in_districts

# ---------------------------------------------------------------- fixed values
# The address-base mart: name and staged column (none: empty).
BASE_COLUMNS = [
    ("UPRN", "uprn"), ("UDPRN", "udprn"), ("TOID", "topography_layer_toid"), ("SharesTOID", "shares_toid"), ("Address", "address"),
    ("PostcodeLocator", "postcode"), ("XCoordinate", "x_coordinate"), ("YCoordinate", "y_coordinate"), ("Latitude", "latitude"),
    ("Longitude", "longitude"), ("ParentUPRN", "parent_uprn"), ("WardCode", None), ("LSOA11Code", None), ("COA11Code", None),
    ("ParishCode", None), ("ConservationArea", None), ("NationalPark", None), ("WorldHeritageSite", None), ("AONB", None),
    ("Class", "classification_code"), ("ClassDescription", "classification_code_description"), ("OSAPISource", "os_api_source"),
]
# ---------------------------------------------------------------- /fixed values
COORD_DECIMALS = 7  # ~1 cm; far below the few-metre accuracy of the datum shift


def base_plus(addresses: DataFrame, districts=TARGET_DISTRICTS) -> DataFrame:
    """Staged addresses -> address-base mart (22 columns).  The shared-TOID
    flag counts all rows of the feed, those of other districts and repeated
    ones included."""
    df = shared_value_flag(addresses.filter(F.col("os_api_source") == "DPA"), "topography_layer_toid", "shares_toid")
    df = with_lat_lon(in_districts(df, "postcode", districts), "x_coordinate", "y_coordinate", "latitude", "longitude")
    df = df.withColumns({c: F.round(c, COORD_DECIMALS) for c in ("latitude", "longitude")})
    columns = [(F.col(source) if source else F.lit(None).cast("double")).alias(name) for name, source in BASE_COLUMNS]
    return df.select(*columns).dropDuplicates().withColumn("Address", format_address("Address"))


# ---------------------------------------------------------------- fixed values
# Columns of the measures table that are always 0.
_ZERO_A = [
    "KgCO2SAP2012", "KgCO22017", "KgCO2SAP102", "KgCO22025", "KgCO22030", "KgCO22038", "KgCO22050",
    "FuelBills", "FuelBillsRealistic", "HeatingCost", "kWhyr", "kWhHeatingDemandm2yr", "AvHeatLossCoefficientwK",
    "TotalFloorArea",
]
_ZERO_B = ["CumulativeCost", "SAPfollowingthisMeasure", "IndividualSAPincrease", "CumulativeSAPincrease", "AverageHeatLossCoefficient (w/K)"]
# ---------------------------------------------------------------- /fixed values
NUMERIC = "decimal(38,10)"


def measures_base(enriched: DataFrame, recommendations: DataFrame, addresses: DataFrame, addresses_first: bool = False) -> DataFrame:
    """Certificate x recommendation x DPA address (34 columns).  The DPA
    predicate sits in the join condition (left join keeps unmatched rows).
    Both keys are the certificate's.  ``addresses_first`` shuffles it before it is repeated for its recommendations;
    staging that is bucketed by certificate joins the recommendations first, where its rows are."""
    epc = enriched.alias("epc")
    rec = recommendations.alias("rec")
    os = addresses.filter(F.col("os_api_source") == "DPA").select("uprn", "udprn").alias("os")
    joins = [(rec, F.col("epc.lmk_key") == F.col("rec.lmk_key")), (os, F.col("epc.uprn") == F.col("os.uprn"))]
    j = epc
    for side, same in reversed(joins) if addresses_first else joins:
        j = j.join(shuffled(side), same, "left")
    zero = F.lit(0.0).cast("double")
    return j.select(
        F.col("epc.uprn").alias("uprn"),
        F.col("os.udprn").alias("udprn"),
        F.lit("").alias("AddressId"),
        F.col("epc.address").alias("Address"),
        F.col("epc.current_energy_efficiency").cast(NUMERIC).alias("SAP"),
        F.col("epc.environment_impact_current").cast(NUMERIC).alias("EI"),
        *[zero.alias(c) for c in _ZERO_A],
        F.col("rec.improvement_item").alias("ImprovementIndex"),
        F.col("rec.improvement_summary_text").alias("Category"),
        F.col("rec.improvement_id").alias("MeasureGroupId"),
        F.col("rec.improvement_id_text").alias("MeasureGroupName"),
        F.col("rec.indicative_cost").alias("COST"),
        F.col("rec.improvement_descr_text").alias("ImprovementDescrText"),
        *[zero.alias(c) for c in _ZERO_B],
        F.col("rec.improvement_id").alias("MeasureOutcomeId"),
        F.col("rec.improvement_id_text").alias("MeasureOutcomeName"),
        F.col("epc.fuzzy_matched").alias("FuzzyMatched"),
    )


def measures_mart(base: DataFrame) -> DataFrame:
    """Strip + placeholder-null every text column, keys to trimmed text,
    distinct (by hash: the rows are wide and few repeat), then format the address
    (after the distinct, as the reference does).  The reference's sort is presentation only and left to the sink."""
    df = null_placeholders_all(strip_all(base))
    df = df.withColumns({"uprn": trim_ws(F.col("uprn").cast("string")), "udprn": trim_ws(F.col("udprn").cast("string"))})
    df = rename(df, {"uprn": "UPRN", "udprn": "UDPRN"})
    return distinct_rows(df).withColumn("Address", format_address("Address"))
