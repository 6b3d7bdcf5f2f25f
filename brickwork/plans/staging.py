"""Staging (M1): typed certificates, unioned address feeds, recommendations.

Each feed is renamed and cast in a single projection driven by a spec list;
the two certificate feeds and the two address feeds are unioned by name and
de-duplicated (SQL ``UNION`` semantics, NULLs equal).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.columns import NO_DATA, NULLIF, STRICT, TEXT, checked, stage
from ..sources.schemas import LINEAGE, NUMBERS

# ---------------------------------------------------------------- fixed values
# The 92 staged certificate columns with their type and cast rule; the raw name has hyphens.
_CERTIFICATE_COLUMNS = """
walls_env_eff text
fixed_lighting_outlets_count double nullif
glazed_area text no_data
energy_consumption_potential double nullif
low_energy_fixed_light_count double nullif
secondheat_description text
lmk_key text
county text
main_fuel text
mains_gas_flag text
number_open_fireplaces int nullif
co2_emissions_potential double strict
current_energy_efficiency double nullif
walls_energy_eff text
number_heated_rooms int nullif
floor_env_eff text
mechanical_ventilation text
photo_supply double nullif
mainheat_env_eff text
environment_impact_potential double nullif
windows_energy_eff text
roof_env_eff text
total_floor_area double strict
flat_top_storey text
multi_glaze_proportion double nullif
tenure text
posttown text
uprn text
mainheat_energy_eff text
current_energy_rating text
postcode text
mainheat_description text
sheating_env_eff text
walls_description text
flat_storey_count double nullif
potential_energy_rating text
hotwater_description text
lighting_cost_current double nullif
floor_height double nullif
lighting_cost_potential double nullif
floor_energy_eff text
windows_description text
sheating_energy_eff text
energy_consumption_current double strict
potential_energy_efficiency double strict
heating_cost_current double nullif
hot_water_cost_current double nullif
construction_age_band text
main_heating_controls text
solar_water_heating_flag text
built_form text
property_type text
co2_emiss_curr_per_floor_area double nullif
roof_energy_eff text
lighting_env_eff text
extension_count double nullif
floor_level text
lodgement_datetime text
heat_loss_corridor text
mainheatc_env_eff text
lighting_description text
windows_env_eff text
hot_water_energy_eff text
transaction_type text
mainheatc_energy_eff text
co2_emissions_current double nullif
local_authority_label text
address text
address1 text
address2 text
address3 text
roof_description text
hot_water_env_eff text
environment_impact_current double nullif
energy_tariff text
hot_water_cost_potential double nullif
glazed_type text
lighting_energy_eff text
heating_cost_potential double nullif
local_authority text
constituency_label text
mainheatcont_description text
building_reference_number text
low_energy_lighting int nullif
unheated_corridor_length double nullif
constituency text
floor_description text
wind_turbine_count int nullif
inspection_date date strict
uprn_source text
lodgement_date date strict
number_habitable_rooms int nullif
"""

# Staged columns that the non-domestic feed has as well (glazed_area is the literal NO DATA!, the others typed NULLs).
_NON_DOMESTIC_COLUMNS = """
lmk_key county posttown uprn postcode property_type lodgement_datetime transaction_type local_authority_label address address1
address2 address3 local_authority constituency_label building_reference_number constituency inspection_date uprn_source lodgement_date
"""

# The 36 staged address columns; the DPA feed has each in capitals.
_ADDRESS_COLUMNS = """
rpc postcode logical_status_code country_code_description x_coordinate last_update_date classification_code_description organisation_name
udprn status parent_uprn postal_address_code local_custodian_code_description delivery_point_suffix building_number thoroughfare_name
language dependent_locality blpu_state_code_description blpu_state_code local_custodian_code blpu_state_date
dependent_thoroughfare_name post_town building_name sub_building_name postal_address_code_description uprn topography_layer_toid address
y_coordinate match_description classification_code entry_date match country_code
"""
# Those that the LPI feed lacks: 'N/A'.
_NOT_IN_LPI = """
organisation_name udprn delivery_point_suffix building_number thoroughfare_name dependent_locality dependent_thoroughfare_name post_town
building_name sub_building_name
"""
_LPI_NAMES = {"postcode": "POSTCODE_LOCATOR"}
# ---------------------------------------------------------------- /fixed values

_RULES = {"text": TEXT, "nullif": NULLIF, "strict": STRICT, "no_data": NO_DATA}


def _certificate(line: str) -> tuple[str, str, str, str]:
    name, kind, *rule = line.split()
    return name.replace("_", "-"), name, "string" if kind == "text" else kind, _RULES[(rule or ["text"])[0]]


_LINEAGE = [(c, c, "string", TEXT) for c in LINEAGE]
# (raw domestic name, staged name, type, rule)
CERTIFICATE_SPEC = [_certificate(line) for line in _CERTIFICATE_COLUMNS.strip().splitlines()] + _LINEAGE
# Staged name -> raw non-domestic name.
NON_DOMESTIC_SOURCES = {c: c.replace("_", "-") for c in _NON_DOMESTIC_COLUMNS.split()} | {c: c for c in LINEAGE}
# Address feeds: (staged name, DPA raw name, LPI raw name or None = 'N/A').
ADDRESS_SPEC = [
    (c, c.upper(), None if c in _NOT_IN_LPI.split() else _LPI_NAMES.get(c, c.upper())) for c in _ADDRESS_COLUMNS.split()
] + [(c, c, c) for c in LINEAGE]

# ---------------------------------------------------------------- fixed values
# Non-building address classes dropped from the LPI feed (NULL class drops too).
EXCLUDED_LPI_CLASSES = [
    "Street Record",
    "Property Shell",
    "Static Water",
    "Electricity Sub-Station",
    "Postal Box",
    "Bus Shelter",
    "Additional Mail / Packet Addressee",
    "Hopper / Silo / Cistern / Tank",
    "General Storage Land",
    "Telecommunication",
    "House Boat",
    "Equestrian",
    "Telephone Box",
    "PO Box",
    "Advertising Hoarding",
    "Allocated Parking",
]
# ---------------------------------------------------------------- /fixed values

_ADDRESS_TYPES = {c.lower(): "double" for c in NUMBERS}


_NON_DOMESTIC_SPEC = [(NON_DOMESTIC_SOURCES.get(out), out, dtype, rule) for _, out, dtype, rule in CERTIFICATE_SPEC]


def stage_certificates(domestic: DataFrame, non_domestic: DataFrame, lenient: bool = False, distinct: bool = True) -> DataFrame:
    """Typed union of the two certificate feeds with a ``certificate_type`` tag; exact duplicate rows collapse
    (``UNION``).  ``distinct=False`` is for readers whose result repeated rows cannot change: without the
    distinct, the columns they do not read are pruned at the scan."""
    dom = stage(domestic, CERTIFICATE_SPEC, lenient, tags={"certificate_type": "domestic"})
    nd = stage(non_domestic, _NON_DOMESTIC_SPEC, lenient, tags={"certificate_type": "non_domestic"})
    both = dom.unionByName(nd)
    return both.distinct() if distinct else both


def check_certificates(domestic: DataFrame, non_domestic: DataFrame) -> DataFrame:
    """Both feeds staged row by row, with what could not be cast in ``_errors`` (see ``operators.columns.checked``)."""
    dom = checked(domestic, CERTIFICATE_SPEC, tags={"certificate_type": "domestic"})
    return dom.unionByName(checked(non_domestic, _NON_DOMESTIC_SPEC, tags={"certificate_type": "non_domestic"}))


def stage_addresses(dpa: DataFrame, lpi: DataFrame, distinct: bool = True) -> DataFrame:
    """Union of the DPA and LPI address feeds, LPI padded with ``'N/A'`` and
    filtered to building classes."""

    def col(raw, out, na):
        if raw is None:
            return F.lit(na).alias(out)
        return F.col(raw).cast(_ADDRESS_TYPES.get(out, "string")).alias(out)

    d = dpa.select(*[col(r, o, None) for o, r, _ in ADDRESS_SPEC], F.lit("DPA").alias("os_api_source"))
    lp = lpi.filter(~F.col("CLASSIFICATION_CODE_DESCRIPTION").isin(EXCLUDED_LPI_CLASSES))
    lp = lp.select(*[col(r, o, "N/A") for o, _, r in ADDRESS_SPEC], F.lit("LPI").alias("os_api_source"))
    both = d.unionByName(lp)
    return both.distinct() if distinct else both


def stage_recommendations(raw: DataFrame) -> DataFrame:
    return raw.select(
        "lmk_key",
        "improvement_item",
        "improvement_summary_text",
        "improvement_descr_text",
        "improvement_id",
        "improvement_id_text",
        "indicative_cost",
    )
