"""Hand-off of the marts (M10): headers, keys and addresses as the receiver wants them; each is one projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators.columns import header_title_no_underscore, rename

# ---------------------------------------------------------------- fixed values
# Headers after title-casing, and what they are handed over as.
BASE_HEADERS = {
    "Uprn": "UPRN", "Udprn": "UDPRN", "Aonb": "AONB", "Postcodelocator": "PostcodeLocator", "Xcoordinate": "XCoordinate",
    "Ycoordinate": "YCoordinate", "Parentuprn": "ParentUPRN", "Wardcode": "WardCode", "Lsoa11Code": "LSOA11Code",
    "Coa11Code": "COA11Code", "Parishcode": "ParishCode", "Conservationarea": "ConservationArea", "Nationalpark": "NationalPark",
    "Worldheritagesite": "WorldHeritageSite", "Classdescription": "ClassDescription",
}
MEASURE_HEADERS = {
    "Uprn": "UPRN", "Udprn": "UDPRN", "Addressid": "AddressID", "Sap": "SAP", "Ei": "EI", "Kgco2Sap2012": "KgCO2SAP2012",
    "Kgco22017": "KgCO22017", "Kgco2Sap102": "KgCO2Sap102", "Kgco22025": "KgCO22025", "Kgco22030": "KgCO22030", "Kgco22038": "KgCO22038",
    "Kgco22050": "KgCO22050", "Fuelbills": "FuelBills", "Fuelbillsrealistic": "FuelBillsRealistic", "Heatingcost": "HeatingCost",
    "Kwhyr": "KwhYr", "Kwhheatingdemandm2Yr": "KwhHeatingDemandm2Yr", "Avheatlosscoefficientwk": "AvHeatLossCoefficientWk",
    "Totalfloorarea": "TotalFloorArea", "Measuregroupid": "MeasureGroupID", "Measuregroupname": "MeasureGroupName",
    "Improvement_Descr_Text": "ImprovementDescrText", "Cumulativecost": "CumulativeCost",
    "Sapfollowingthismeasure": "SAPFollowingThisMeasure", "Individualsapincrease": "IndividualSAPIncrease",
    "Cumulativesapincrease": "CumulativeSAPIncrease", "Av. Heat Loss Coefficient (W/K)": "AvHeatLossCoefficient(W/K)",
    "Measure Outcome Id": "MeasureOutcomeId", "Measure Outcome Name": "MeasureOutcomeName",
}
PROFILING_HEADERS = {
    "Environmental Impact Rating": "EnvironmentalImpactRating", "Environmental Impact Rating Band": "EnvironmentalImpactRatingBand",
    "Fuel Bills (£/yr)": "FuelBills(£/yr)", "Realistic Fuel Bill (Regional)": "RealisticFuelBill(Regional)",
    "Heating Cost (£/yr)": "HeatingCost(£/yr)", "Heating Cost (£/yr).1": "HeatingCost(£/yr).1", "SAP Rating": "SAPRating",
    "SAP Band": "SAPBand", "Lodgement Date": "LodgementDate", "SAP version": "SAPVersion",
    "Water Heating Cost (£/yr)": "WaterHeatingCost(£/yr)", "Lighting Cost (£/yr)": "LightingCost(£/yr)", "Total Floor Area": "TotalFloorArea",
}
# ---------------------------------------------------------------- /fixed values


def profiling(mart: DataFrame) -> DataFrame:
    """The profiling mart's rows with a key, spaced headers closed up."""
    return rename(mart.filter(F.col("UPRN").isNotNull()), PROFILING_HEADERS)


def address_base(mart: DataFrame) -> DataFrame:
    """The address-base mart without postcodes in its addresses, parent keys as text.

    The address is title-cased part by part first, postcodes kept in capitals, and then loses them."""
    address = X.remove_postcode_and_title_case(X.title_case_address_parts("Address"))
    mart = mart.withColumns({"Address": address, "ParentUPRN": X.numeric_key_text("ParentUPRN")})
    return rename(mart.toDF(*header_title_no_underscore(mart.columns)), BASE_HEADERS)


def measures(mart: DataFrame) -> DataFrame:
    """The measures mart's rows with a key, keys as text, postcodes of any case in capitals."""
    address = X.title_case_address_parts(X.title_case_address_parts("Address"), case_sensitive=False)
    keys = {c: X.numeric_key_text(c) for c in ("UPRN", "UDPRN")}
    mart = mart.filter(F.col("UPRN").isNotNull()).withColumns({**keys, "Address": address})
    return rename(mart.toDF(*[c.title() for c in mart.columns]), MEASURE_HEADERS)
