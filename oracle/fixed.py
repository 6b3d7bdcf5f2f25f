"""Fixed values of the oracle side, written out so that a changed label, price or constant in the library shows."""

ROOF_CONSTRUCTIONS = ['Pitched', '(Another Dwelling Above)', 'Flat', 'Roof Room(S)', '(Other Premises Above)', 'Thatched']

ROOF_LOCATION_OTHER = ['', '*** INVALID INPUT Code : 57 *** loft insulation', 'insulated  (assumed)', 'Unknown loft insulation']

WALL_CONSTRUCTION = [('cavity wall', 'CavityWall'), ('timber frame', 'TimberFrame'), ('solid brick', 'SolidBrick'), ('sandstone', 'Sandstone'),
 ('sandstone or limestone', 'SandstoneOrLimestone'), ('granite or whin', 'GraniteOrWhinstone'), ('park home wall', 'ParkHomeWall'), ('cob', 'Cob'),
 ('system built', 'SystemBuilt')]

WALL_INSULATION_TYPE = [('as built', 'AsBuilt'), ('filled cavity and internal insulation', 'FilledCavityAndInternalInsulation'),
 ('filled cavity and external insulation', 'FilledCavityAndExternalInsulation'), ('filled cavity', 'FilledCavity'),
 ('internal insulation', 'WithInternalInsulation'), ('external insulation', 'WithExternalInsulation'),
 ('additional insulation', 'WithAdditionalInsulation')]

FLOOR_CONSTRUCTION_VALID = ['Solid', 'Suspended', '(other premises below)', '(another dwelling below)']

FLOOR_CONSTRUCTION_REPLACE = {'(another dwelling below)': 'AnotherDwellingBelow', '(other premises below)': 'OtherPremisesBelow'}

HEATING_CATEGORY = [(('Boiler and radiators, mains gas',), 'BoilerRadiatorsMainsGas'), (('Electric storage heaters', 'Portable electric heaters'), 'ElectricHeaters'),
 (('Boiler and radiators, LPG', 'Boiler and underfloor heating, LPG'), 'BoilerRadiatorsLPG'),
 (('Boiler and radiators, oil', 'Boiler and underfloor heating, oil'), 'BoilerRadiatorsOil'),
 (('Electric underfloor heating',), 'ElectricUnderfloor'), (('Community scheme',), 'CommunityScheme'), (('Warm air, mains gas',), 'WarmAirMainsGas'),
 (('Boiler & underfloor, mains gas', 'Boiler and underfloor heating, mains gas'), 'BoilerUnderfloorMainsGas'),
 (('Air source heat pump',), 'AirSourceHeatPump'),
 (('Boiler and radiators, electric', 'Boiler and underfloor heating, electric'), 'BoilerRadiatorsElectric'),
 (('Ground source heat pump',), 'GroundSourceHeatPump'), (('Boiler and radiators, dual fuel',), 'BoilerRadiatorsDualFuel'),
 (('Boiler and radiators, wood',), 'BoilerRadiatorsWood'), (('Room heaters, mains gas',), 'RoomHeatersMainsGas'),
 (('No system present',), 'NoSystemPresent'), (('Water source heat pump',), 'WaterSourceHeatPump')]

FUEL_CATEGORY = [('mains gas', 'MainsGas'), ('electricity', 'Electricity'), ('oil', 'Oil'), ('lpg', 'LPG'), ('no heating/hot-water system', 'NoSystem'),
 ('dual fuel', 'DualFuel'), ('wood logs', 'WoodLogs'), ('house coal', 'Coal'), ('biomass', 'Biomass'), ('invalid', 'Invalid'),
 ('anthracite', 'Anthracite'), ('smokeless coal', 'SmokelessCoal'), ('wood pellets', 'WoodPellets'), ('wood chips', 'WoodChips'),
 ('biogas', 'Biogas')]

GLAZING_TYPE = {'double glazing installed before 2002': 'DoubleGlazingBefore2002',
 'double glazing installed during or after 2002': 'DoubleGlazingAfter2002',
 'double glazing, unknown install date': 'DoubleGlazing',
 'not defined': None,
 'secondary glazing': 'SecondaryGlazing',
 'single glazing': 'SingleGlazing',
 'INVALID!': None,
 'triple glazing': 'TripleGlazing',
 'double, known data': 'DoubleGlazing',
 'triple, known data': 'TripleGlazing'}

PROPERTY_TYPE = {'A1/A2RetailAndFinancial/ProfessionalServices': 'Other',
 'A3/A4/A5RestaurantAndCafes/DrinkingEstablishmentsAndHotFoodTakeaways': 'Other',
 'B1OfficesAndWorkshopBusinesses': 'Other',
 'B2ToB7GeneralIndustrialAndSpecialIndustrialGroups': 'Other',
 'B8StorageOrDistribution': 'Other',
 'Bungalow': 'Bungalow',
 'C1Hotels': 'Other',
 'C2ASecureResidentialInstitutions': 'Other',
 'C2ResidentialInstitutions-HospitalsAndCareHomes': 'Other',
 'C2ResidentialInstitutions-ResidentialSchools': 'Other',
 'C2ResidentialInstitutions-UniversitiesAndColleges': 'Other',
 'Community/DayCentre': 'Other',
 'D1Non-ResidentialInstitutions-Community/DayCentre': 'Other',
 'D1Non-ResidentialInstitutions-Education': 'Other',
 'D1Non-ResidentialInstitutions-LibrariesMuseumsAndGalleries': 'Other',
 'D1Non-ResidentialInstitutions-PrimaryHealthCareBuilding': 'Other',
 'D2GeneralAssemblyAndLeisurePlusNightClubsAndTheatres': 'Other',
 'Dwelling': 'Other',
 'Flat': 'Flat',
 'GeneralAssemblyAndLeisureNightClubsAndTheatres': 'Other',
 'Hotel': 'Other',
 'Hotels': 'Other',
 'House': 'House',
 'IndustrialProcessBuilding': 'Other',
 'Maisonette': 'Maisonette',
 'Non-ResidentialInstitutions:Education': 'Other',
 'Non-ResidentialInstitutions:LibrariesMuseumsAndGalleries': 'Other',
 'Non-ResidentialInstitutions:PrimaryHealthCareBuilding': 'Other',
 'NursingResidentialHomesAndHostels': 'Other',
 'Office': 'Other',
 'OfficesAndWorkshopBusinesses': 'Other',
 'Others-StandAloneUtilityBlock': 'Other',
 'Others:EmergencyServices': 'Other',
 'ParkHome': 'ParkHome',
 'PrimaryHealthCareBuildings': 'Other',
 'PrimarySchool': 'Other',
 'Prisons': 'Other',
 'ResidentialInstitutions:HospitalsAndCareHomes': 'Other',
 'ResidentialInstitutions:ResidentialSchools': 'Other',
 'ResidentialSpaces': 'Other',
 'Restaurant/PublicHouse': 'Other',
 'RestaurantsAndCafes/DrinkingEstablishments/Takeaways': 'Other',
 'Retail': 'Other',
 'Retail/FinancialAndProfessionalServices': 'Other',
 'RetailWarehouses': 'Other',
 'SocialClubs': 'Other',
 'SportsCentre/LeisureCentre': 'Other',
 'StorageOrDistribution': 'Other',
 'WarehouseAndStorage': 'Other',
 'Workshops/MaintenanceDepot': 'Other'}

FLOOR_LEVEL_ALL = {'Basement': -1,
 '-1.0': -1,
 '-1': -1,
 'Ground': 0,
 'ground floor': 0,
 '00': 0,
 '0.0': 0,
 '1st': 1,
 '01': 1,
 '1.0': 1,
 '1': 1,
 '2nd': 2,
 '02': 2,
 '2.0': 2,
 '2': 2,
 '3rd': 3,
 '03': 3,
 '3.0': 3,
 '3': 3,
 '4th': 4,
 '04': 4,
 '5th': 5,
 '05': 5,
 '5.0': 5,
 '6th': 6,
 '7th': 7,
 '07': 7,
 '8th': 8,
 '12th': 12,
 'TopFloor': 13,
 'MidFloor': 5}

AGE_BAND_REGION = 'England and Wales:'

AVG_KWH_PER_M2_PER_ANNUM = 133.0

ENERGY_COST_DEFLATOR = 0.42

FUEL_PRICES = {'MainsGas': (120.0, 0.0348),
 'Electricity': (54.0, 0.1319),
 'Oil': (0.0, 0.0544),
 'LPG': (70.0, 0.076),
 'DualFuel': (0.0, 0.0399),
 'WoodLogs': (0.0, 0.0423),
 'Coal': (0.0, 0.0367),
 'Biomass': (0.0, 0.47),
 'Anthracite': (0.0, 0.0364),
 'SmokelessCoal': (0.0, 0.0367),
 'WoodPellets': (0.0, 0.0526),
 'WoodChips': (0.0, 0.0307),
 'Biogas': (70.0, 0.076),
 'Other': (0.0, 0.025)}

FUELS_FOLDED_TO_OTHER = ['NoSystem', 'Invalid']

PLACEHOLDER_VALUES = ['unknown', 'no data!', 'nodata!', 'nan', 'n/a']

POSTCODE_PATTERN = '[a-zA-Z]{1,2}[0-9][a-zA-Z0-9]? ?[0-9][a-zA-Z]{2}|GIR ?0AA'

TARGET_DISTRICTS = ['PO30', 'PO31', 'PO32', 'PO33', 'PO34', 'PO35', 'PO36', 'PO37', 'PO38', 'PO39', 'PO40', 'PO41', 'DN8', 'DN14', 'HU2', 'HU4', 'HU5', 'HU6', 'HU7',
 'HU8', 'HU10', 'HU11', 'HU12', 'HU13', 'HU14', 'HU15', 'HU16', 'HU17', 'HU18', 'HU19', 'HU20', 'YO4', 'YO8', 'YO11', 'YO15', 'YO16', 'YO25', 'YO41',
 'YO42', 'YO43', 'YO95']

WALLS_ENV_EFF_VALUES = ['Very Good', 'Good', 'Average', 'Poor', 'Very Poor', 'N/A']

GLAZED_AREA_VALUES = ['Much More Than Typical', 'More Than Typical', 'Normal', 'Less Than Typical', 'Much Less Than Typical', 'NO DATA!']

POSTCODE_OR_NA_REGEX = '^([A-Z]{1,2}[0-9R][0-9A-Z]? [0-9][A-Z]{2})|(N\\/A)$'

PROFILE_KEEP = ['lmk_key', 'uprn', 'address', 'postcode', 'property_type', 'built_form', 'current_energy_rating', 'current_energy_efficiency', 'roof_description',
 'walls_description', 'floor_description', 'windows_description', 'glazed_type', 'total_floor_area', 'environment_impact_current', 'lodgement_date',
 'co2_emissions_current', 'floor_level', 'heating_cost_current', 'construction_age_band', 'main_heating_controls', 'mainheat_description',
 'main_fuel', 'number_open_fireplaces', 'wind_turbine_count', 'mechanical_ventilation', 'hot_water_cost_current', 'lighting_cost_current',
 'inspection_date', 'flat_storey_count', 'fuzzy_matched', 'certificate_type']

PROFILE_RENAMES = {'lmk_key': 'LMK_KEY',
 'uprn': 'UPRN',
 'current_energy_efficiency': 'SAPRating',
 'current_energy_rating': 'SAPBand',
 'roof_description_1': 'RoofConstruction',
 'roof_description_3': 'RoofInsulationThickness',
 'roof_description_4': 'RoofInsulationLocation',
 'walls_description': 'WallConstruction',
 'walls_description_2': 'WallInsulationType',
 'walls_description_3': 'WallInsulationThickness',
 'floor_description_1': 'FloorConstruction',
 'floor_description_2': 'FloorInsulation',
 'glazed_type': 'MultipleGlazingType',
 'co2_emissions_current': 'tCO2',
 'heating_cost_current': 'HeatingCost(£/yr)',
 'main_heating_controls': 'MainHeatingControl',
 'mainheat_description': 'MainHeatingCategory',
 'main_fuel': 'MainFuelType',
 'number_open_fireplaces': 'OpenFireplacesCount',
 'wind_turbine_count': 'Renewables',
 'mechanical_ventilation': 'Ventilation',
 'hot_water_cost_current': 'WaterHeatingCost(£/yr)',
 'lighting_cost_current': 'LightingCost(£/yr)',
 'flat_storey_count': 'StoreysCount',
 'floor_level': 'FlatLevel',
 'address': 'Address',
 'postcode': 'Postcode',
 'environment_impact_current': 'EnvironmentalImpactRating',
 'lodgement_date': 'LodgementDate',
 'property_type': 'PropertyType',
 'construction_age_band': 'ConstructionAgeBand',
 'built_form': 'BuiltForm',
 'total_floor_area': 'TotalFloorArea',
 'fuzzy_matched': 'FuzzyMatched',
 'certificate_type': 'CertificateType'}

PROFILE_BLANK = ['UDPRN', 'ParityAddressId', 'EnvironmentalImpactRatingBand', 'FuelBills(£/yr)', 'FloorInsulationThickness', 'RealisticFuelBill(Regional)',
 'SAPVersion', 'FlatLocation', 'LowestFloorArea', 'DerivedSAPMainHeatingCode', 'HeatEmitterType', 'WaterHeatingFuel']

PROFILE_ORDER = ['LMK_KEY', 'UPRN', 'UDPRN', 'ParityAddressId', 'Address', 'Postcode', 'EnvironmentalImpactRating', 'EnvironmentalImpactRatingBand',
 'FuelBills(£/yr)', 'RealisticFuelBill(Regional)', 'tCO2', 'HeatingCost(£/yr)', 'SAPRating', 'SAPBand', 'LodgementDate', 'SAPVersion', 'PropertyType',
 'ConstructionAgeBand', 'BuiltForm', 'StoreysCount', 'FlatLocation', 'FlatLevel', 'LowestFloorArea', 'MainHeatingCategory', 'MainFuelType',
 'MainHeatingControl', 'DerivedSAPMainHeatingCode', 'HeatEmitterType', 'WaterHeatingFuel', 'RoofConstruction', 'RoofInsulationLocation',
 'RoofInsulationThickness', 'WallConstruction', 'WallInsulationType', 'WallInsulationThickness', 'FloorConstruction', 'FloorInsulation',
 'FloorInsulationThickness', 'MultipleGlazingType', 'OpenFireplacesCount', 'Renewables', 'Ventilation', 'WaterHeatingCost(£/yr)',
 'LightingCost(£/yr)', 'TotalFloorArea', 'FuzzyMatched', 'CertificateType']

BASE_BLANK = ['WardCode', 'LSOA11Code', 'COA11Code', 'ParishCode', 'ConservationArea', 'NationalPark', 'WorldHeritageSite', 'AONB']

BASE_NAMES = ['UPRN', 'UDPRN', 'TOID', 'SharesTOID', 'Address', 'PostcodeLocator', 'XCoordinate', 'YCoordinate', 'Latitude', 'Longitude', 'ParentUPRN', 'WardCode',
 'LSOA11Code', 'COA11Code', 'ParishCode', 'ConservationArea', 'NationalPark', 'WorldHeritageSite', 'AONB', 'Class', 'ClassDescription',
 'OSAPISource']

ZERO_BEFORE = ['KgCO2SAP2012', 'KgCO22017', 'KgCO2SAP102', 'KgCO22025', 'KgCO22030', 'KgCO22038', 'KgCO22050', 'FuelBills', 'FuelBillsRealistic', 'HeatingCost',
 'kWhyr', 'kWhHeatingDemandm2yr', 'AvHeatLossCoefficientwK', 'TotalFloorArea']

ZERO_AFTER = ['CumulativeCost', 'SAPfollowingthisMeasure', 'IndividualSAPincrease', 'CumulativeSAPincrease', 'AverageHeatLossCoefficient (w/K)']

# Staging: how each certificate column that is no plain text is cast.
NULLIF_DOUBLE = """
fixed_lighting_outlets_count energy_consumption_potential low_energy_fixed_light_count current_energy_efficiency photo_supply
environment_impact_potential multi_glaze_proportion flat_storey_count lighting_cost_current floor_height lighting_cost_potential
heating_cost_current hot_water_cost_current co2_emiss_curr_per_floor_area extension_count co2_emissions_current
environment_impact_current hot_water_cost_potential heating_cost_potential unheated_corridor_length
""".split()
NULLIF_INTEGER = "number_open_fireplaces number_heated_rooms low_energy_lighting wind_turbine_count number_habitable_rooms".split()
STRICT_DOUBLE = "co2_emissions_potential total_floor_area energy_consumption_current potential_energy_efficiency".split()
STRICT_DATE = ["inspection_date", "lodgement_date"]
ADDRESS_DOUBLE = ["x_coordinate", "y_coordinate", "local_custodian_code", "match"]
# The address columns that each feed's staging keeps, and those of the DPA feed alone.
BOTH_ADDRESS = """
rpc logical_status_code country_code_description x_coordinate last_update_date classification_code_description status parent_uprn
postal_address_code local_custodian_code_description language blpu_state_code_description blpu_state_code local_custodian_code
blpu_state_date postal_address_code_description uprn topography_layer_toid address y_coordinate match_description classification_code
entry_date match country_code
""".split()
DPA_ONLY = """
organisation_name udprn delivery_point_suffix building_number thoroughfare_name dependent_locality dependent_thoroughfare_name post_town
building_name sub_building_name
""".split()
# Address classes that are no buildings.
EXCLUDED_LPI_CLASSES = [
    "Street Record", "Property Shell", "Static Water", "Electricity Sub-Station", "Postal Box", "Bus Shelter",
    "Additional Mail / Packet Addressee", "Hopper / Silo / Cistern / Tank", "General Storage Land", "Telecommunication",
    "House Boat", "Equestrian", "Telephone Box", "PO Box", "Advertising Hoarding", "Allocated Parking",
]
