"""The declared tests of staging and of the marts."""

from __future__ import annotations

from ..operators.quality import GLAZED_AREA_VALUES, POSTCODE_OR_NA_REGEX, WALLS_ENV_EFF_VALUES
from ..operators.rules import Rule

# ---------------------------------------------------------------- fixed values
_BASE_NUMBERS = ["XCoordinate", "YCoordinate", "Latitude", "Longitude", "WardCode", "LSOA11Code", "COA11Code", "ParishCode"]
_BASE_EMPTY = ["ConservationArea", "NationalPark", "WorldHeritageSite", "AONB"]
_BASE_TEXTS = ["ParentUPRN", "Class", "ClassDescription"]
_PROFILING_TYPES = {"Address": "string", "FuelBills(£/yr)": "double", "SAPRating": "double", "SAPBand": "string", "PropertyType": "string"}
_MEASURES_NUMBERS = ["EI", "KgCO2SAP2012", "KgCO22017", "FuelBills", "HeatingCost", "TotalFloorArea", "ImprovementIndex", "MeasureGroupId"]
_MEASURES_TEXTS = ["Category", "MeasureGroupName", "COST", "ImprovementDescrText"]
# ---------------------------------------------------------------- /fixed values


def _typed(table: str, column: str, *types: str) -> Rule:
    return Rule(table, "type", column, {"types": types})


def _certificates(table: str) -> list[Rule]:
    """Staged certificates, and again after their enrichment."""
    return [
        Rule(table, "accepted_values", "walls_env_eff", {"values": WALLS_ENV_EFF_VALUES}),
        Rule(table, "between", "fixed_lighting_outlets_count", {"least": 0, "most": 300}),
        Rule(table, "accepted_values", "glazed_area", {"values": GLAZED_AREA_VALUES}),
        Rule(table, "between", "low_energy_fixed_light_count", {"least": 0, "most": 300}),
    ]


# The declared expression names a column that no table has beside a count of rows; what it asks for that can be
# asked, that the table is not empty, is the row count.
RULES = [
    *_certificates("certificates"),
    Rule("certificates", "row_count", args={"least": 1}),
    Rule("certificates", "unique", "lmk_key"),
    *_certificates("enriched"),
    Rule("recommendations", "not_null", "lmk_key"),
    Rule("recommendations", "relationship", "lmk_key", {"to": "certificates", "field": "lmk_key"}),
    Rule("address_base", "not_null", "UPRN"),
    Rule("address_base", "not_null", "UDPRN"),
    _typed("address_base", "Address", "string", "varchar", "char"),
    Rule("address_base", "not_null", "PostcodeLocator"),
    Rule("address_base", "regex", "PostcodeLocator", {"pattern": POSTCODE_OR_NA_REGEX}),
    *[_typed("address_base", c, "double") for c in _BASE_NUMBERS],
    Rule("address_base", "between", "Latitude", {"least": -90, "most": 90}),
    Rule("address_base", "between", "Longitude", {"least": -180, "most": 180}),
    *[Rule("address_base", "all_null", c) for c in _BASE_EMPTY],
    *[_typed("address_base", c, "double") for c in _BASE_EMPTY],
    *[_typed("address_base", c, "string") for c in _BASE_TEXTS],
    Rule("address_base", "unique", "UPRN"),
    *[_typed("profiling", c, t) for c, t in _PROFILING_TYPES.items()],
    Rule("profiling", "unique", "UPRN"),
    Rule("profiling", "is_date", "LodgementDate"),
    Rule("profiling", "fewer_rows_than", args={"than": "certificates"}),
    Rule("measures", "between", "SAP", {"least": 0, "most": 300}),
    Rule("measures", "between", "EI", {"least": 0, "most": 150}),
    *[_typed("measures", c, "double") for c in _MEASURES_NUMBERS],
    *[_typed("measures", c, "string") for c in _MEASURES_TEXTS],
]
