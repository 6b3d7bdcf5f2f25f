"""Declared record schemas of the landed feeds."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------- fixed values
# Columns of the certificate and address services, in the services' order.
DOMESTIC = """
address address1 address2 address3 building-reference-number built-form co2-emiss-curr-per-floor-area co2-emissions-current
co2-emissions-potential constituency constituency-label construction-age-band county current-energy-efficiency current-energy-rating
energy-consumption-current energy-consumption-potential energy-tariff environment-impact-current environment-impact-potential
extension-count fixed-lighting-outlets-count flat-storey-count flat-top-storey floor-description floor-energy-eff floor-env-eff
floor-height floor-level glazed-area glazed-type heat-loss-corridor heating-cost-current heating-cost-potential hot-water-cost-current
hot-water-cost-potential hot-water-energy-eff hot-water-env-eff hotwater-description inspection-date lighting-cost-current
lighting-cost-potential lighting-description lighting-energy-eff lighting-env-eff lmk-key local-authority local-authority-label
lodgement-date lodgement-datetime low-energy-fixed-light-count low-energy-lighting main-fuel main-heating-controls mainheat-description
mainheat-energy-eff mainheat-env-eff mainheatc-energy-eff mainheatc-env-eff mainheatcont-description mains-gas-flag
mechanical-ventilation multi-glaze-proportion number-habitable-rooms number-heated-rooms number-open-fireplaces photo-supply postcode
posttown potential-energy-efficiency potential-energy-rating property-type roof-description roof-energy-eff roof-env-eff
secondheat-description sheating-energy-eff sheating-env-eff solar-water-heating-flag tenure total-floor-area transaction-type
unheated-corridor-length uprn uprn-source walls-description walls-energy-eff walls-env-eff wind-turbine-count windows-description
windows-energy-eff windows-env-eff
""".split()

NON_DOMESTIC = """
uprn county address lmk-key address1 address2 address3 postcode posttown floor-area uprn-source asset-rating constituency property-type
aircon-present building-level lodgement-date inspection-date local-authority other-fuel-desc aircon-kw-rating target-emissions
transaction-type asset-rating-band main-heating-fuel renewable-sources typical-emissions building-emissions constituency-label
lodgement-datetime standard-emissions new-build-benchmark special-energy-uses building-environment primary-energy-value
local-authority-label existing-stock-benchmark building-reference-number ac-inspection-commissioned estimated-aircon-kw-rating
""".split()

DPA = """
ADDRESS BLPU_STATE_CODE BLPU_STATE_CODE_DESCRIPTION BLPU_STATE_DATE BUILDING_NAME BUILDING_NUMBER CLASSIFICATION_CODE
CLASSIFICATION_CODE_DESCRIPTION COUNTRY_CODE COUNTRY_CODE_DESCRIPTION DELIVERY_POINT_SUFFIX DEPENDENT_LOCALITY
DEPENDENT_THOROUGHFARE_NAME ENTRY_DATE LANGUAGE LAST_UPDATE_DATE LOCAL_CUSTODIAN_CODE LOCAL_CUSTODIAN_CODE_DESCRIPTION
LOGICAL_STATUS_CODE MATCH MATCH_DESCRIPTION ORGANISATION_NAME PARENT_UPRN PARISH_CODE POSTAL_ADDRESS_CODE
POSTAL_ADDRESS_CODE_DESCRIPTION POSTCODE POST_TOWN RPC STATUS SUB_BUILDING_NAME THOROUGHFARE_NAME TOPOGRAPHY_LAYER_TOID UDPRN UPRN
WARD_CODE X_COORDINATE Y_COORDINATE
""".split()

LPI = """
ADDRESS ADMINISTRATIVE_AREA BLPU_STATE_CODE BLPU_STATE_CODE_DESCRIPTION BLPU_STATE_DATE CLASSIFICATION_CODE
CLASSIFICATION_CODE_DESCRIPTION COUNTRY_CODE COUNTRY_CODE_DESCRIPTION ENTRY_DATE LANGUAGE LAST_UPDATE_DATE LOCALITY_NAME
LOCAL_CUSTODIAN_CODE LOCAL_CUSTODIAN_CODE_DESCRIPTION LOGICAL_STATUS_CODE LPI_KEY LPI_LOGICAL_STATUS_CODE
LPI_LOGICAL_STATUS_CODE_DESCRIPTION MATCH MATCH_DESCRIPTION ORGANISATION PAO_END_NUMBER PAO_START_NUMBER PAO_START_SUFFIX PAO_TEXT
PARENT_UPRN PARISH_CODE POSTAL_ADDRESS_CODE POSTAL_ADDRESS_CODE_DESCRIPTION POSTCODE_LOCATOR RPC SAO_END_NUMBER SAO_START_NUMBER
SAO_START_SUFFIX SAO_TEXT STATUS STREET_CLASSIFICATION_CODE STREET_CLASSIFICATION_CODE_DESCRIPTION STREET_DESCRIPTION
STREET_STATE_CODE STREET_STATE_CODE_DESCRIPTION TOPOGRAPHY_LAYER_TOID TOWN_NAME UPRN USRN WARD_CODE X_COORDINATE Y_COORDINATE
""".split()

# Address columns that the service sends as numbers; all other columns are text.
NUMBERS = ["LOCAL_CUSTODIAN_CODE", "MATCH", "X_COORDINATE", "Y_COORDINATE"]
# ---------------------------------------------------------------- /fixed values

#: Added to every landed record by the loader: its load, when it was read and written, and a digest of the record.
LINEAGE = ["_load_id", "_emitted_at", "_normalised_at", "_row_hashid"]


def record(columns, lineage: bool = False) -> T.StructType:
    """The declared schema of a feed's records."""
    kinds = [T.StructField(c, T.DoubleType() if c in NUMBERS else T.StringType()) for c in columns]
    return T.StructType(kinds + [T.StructField(c, T.StringType()) for c in LINEAGE if lineage])


RECORDS = {"domestic": record(DOMESTIC), "non_domestic": record(NON_DOMESTIC), "DPA": record(DPA), "LPI": record(LPI)}
