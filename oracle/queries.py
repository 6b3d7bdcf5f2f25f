"""DuckDB twins of the registered queries (``oracle_sql()``)."""

from __future__ import annotations

from . import fixed as QC
from . import fn, geo
from .chain import enrich_ctes, match_ctes, profiling_ctes, sap_ctes, staging_ctes, with_ctes
from .fixed import TARGET_DISTRICTS
from .fn import lit, q

_DIST = ", ".join(lit(d) for d in TARGET_DISTRICTS)
_ADDR_COLS = [
    "uprn", "udprn", "address", "postcode", "x_coordinate", "y_coordinate", "topography_layer_toid", "parent_uprn",
    "classification_code", "classification_code_description", "organisation_name", "post_town", "building_number",
    "thoroughfare_name", "os_api_source",
]


def _base_plus_ctes() -> list[str]:
    geo_sql = geo.duckdb_lat_lon_sql(
        "SELECT * FROM stg_addresses WHERE os_api_source = 'DPA'", "x_coordinate", "y_coordinate", _ADDR_COLS, "LATITUDE", "LONGITUDE"
    )
    blanks = ", ".join(f"CAST(NULL AS DOUBLE) AS {q(c)}" for c in QC.BASE_BLANK)
    return [
        f"bp1 AS ({geo_sql})",
        "bp2 AS (SELECT uprn AS UPRN, udprn AS UDPRN, topography_layer_toid AS TOID, "
        "count(*) OVER (PARTITION BY topography_layer_toid) > 1 AS SharesTOID, address AS Address, postcode AS PostcodeLocator, "
        "x_coordinate AS XCoordinate, y_coordinate AS YCoordinate, round(LATITUDE, 7) AS Latitude, round(LONGITUDE, 7) AS Longitude, "
        f"parent_uprn AS ParentUPRN, {blanks}, classification_code AS Class, classification_code_description AS ClassDescription, "
        "os_api_source AS OSAPISource FROM bp1)",
        f"base_plus AS (SELECT * REPLACE ({fn.fmt_address('Address')} AS Address) FROM (SELECT DISTINCT * FROM bp2) "
        f"WHERE {fn.outward('PostcodeLocator')} IN ({_DIST}))",
    ]


def _measures_ctes() -> list[str]:
    zeros_a = ", ".join(f"CAST(0.0 AS DOUBLE) AS {q(c)}" for c in QC.ZERO_BEFORE)
    zeros_b = ", ".join(f"CAST(0.0 AS DOUBLE) AS {q(c)}" for c in QC.ZERO_AFTER)
    base = (
        "SELECT epc.uprn AS uprn, os.udprn AS udprn, '' AS AddressId, epc.address AS Address, "
        "CAST(epc.current_energy_efficiency AS DECIMAL(38,10)) AS SAP, CAST(epc.environment_impact_current AS DECIMAL(38,10)) AS EI, "
        f"{zeros_a}, rec.improvement_item AS ImprovementIndex, rec.improvement_summary_text AS Category, "
        "rec.improvement_id AS MeasureGroupId, rec.improvement_id_text AS MeasureGroupName, rec.indicative_cost AS COST, "
        f"rec.improvement_descr_text AS ImprovementDescrText, {zeros_b}, rec.improvement_id AS MeasureOutcomeId, "
        "rec.improvement_id_text AS MeasureOutcomeName, epc.fuzzy_matched AS FuzzyMatched "
        "FROM enriched epc LEFT JOIN stg_recommendations rec ON epc.lmk_key = rec.lmk_key "
        "LEFT JOIN (SELECT uprn, udprn FROM stg_addresses WHERE os_api_source = 'DPA') os ON epc.uprn = os.uprn"
    )
    text = ["uprn", "udprn", "AddressId", "Address", "Category", "MeasureGroupName", "COST", "ImprovementDescrText", "MeasureOutcomeName"]
    rep = ", ".join(f"{fn.strip_null(c)} AS {c}" for c in text)
    return [
        f"mb AS ({base})",
        f"mm0 AS (SELECT * REPLACE ({rep}) FROM mb)",
        "mm1 AS (SELECT DISTINCT * EXCLUDE (uprn, udprn), uprn AS UPRN, udprn AS UDPRN FROM mm0)",
        f"mm AS (SELECT * REPLACE ({fn.fmt_address('Address')} AS Address) FROM mm1)",
    ]


_KEYLESS = (
    "SELECT lower(concat_ws(', ', address, posttown, postcode)) AS l_text, postcode AS l_postcode FROM stg_certificates "
    f"WHERE uprn = '' AND {fn.outward('postcode')} IN ({_DIST})"
)
_GAZ = "SELECT lower(address) AS r_text, postcode AS r_postcode FROM stg_addresses"


def _table_diff_sql() -> str:
    text_cols = [
        c for c in QC.PROFILE_ORDER
        if c not in QC.PROFILE_BLANK and c not in {
            "UPRN", "EnvironmentalImpactRating", "tCO2", "SAPRating", "LodgementDate", "StoreysCount",
            "FlatLevel", "OpenFireplacesCount", "Renewables", "WaterHeatingCost(£/yr)", "LightingCost(£/yr)", "TotalFloorArea",
            "FuzzyMatched",
        }
    ] + ["WallInsulationThickness"]
    text_cols = list(dict.fromkeys(text_cols))
    parts = []
    for c in text_cols:
        parts.append(
            f"SELECT coalesce(a.\"UPRN\", b.\"UPRN\") AS \"UPRN\", {lit(c)} AS \"column\", CAST(a.{q(c)} AS VARCHAR) AS old, "
            f"CAST(b.{q(c)} AS VARCHAR) AS new, CASE WHEN a.\"UPRN\" IS NULL THEN 'added' WHEN b.\"UPRN\" IS NULL THEN 'removed' "
            f"ELSE 'changed' END AS change FROM profiling a FULL JOIN sap b ON a.\"UPRN\" = b.\"UPRN\" "
            f"WHERE a.\"UPRN\" IS NULL OR b.\"UPRN\" IS NULL OR a.{q(c)} IS DISTINCT FROM b.{q(c)}"
        )
    return " UNION ALL ".join(parts)


def _quality_sql() -> str:
    walls = ", ".join(lit(v) for v in QC.WALLS_ENV_EFF_VALUES)
    glazed = ", ".join(lit(v) for v in QC.GLAZED_AREA_VALUES)
    rx = QC.POSTCODE_OR_NA_REGEX
    checks = [
        ("accepted_values", "walls_env_eff", f"stg_certificates WHERE walls_env_eff IS NOT NULL AND walls_env_eff NOT IN ({walls})"),
        ("accepted_values", "glazed_area", f"stg_certificates WHERE glazed_area IS NOT NULL AND glazed_area NOT IN ({glazed})"),
        ("not_null", "lmk_key", "stg_recommendations WHERE lmk_key IS NULL"),
        (
            "relationship",
            "lmk_key",
            "stg_recommendations r WHERE r.lmk_key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM stg_certificates c WHERE c.lmk_key = r.lmk_key)",
        ),
        ("not_null", "UDPRN", "base_plus WHERE UDPRN IS NULL"),
        ("regex", "PostcodeLocator", f"base_plus WHERE NOT regexp_matches(PostcodeLocator, {lit(rx)})"),
        ("between", "Latitude", "base_plus WHERE NOT (Latitude BETWEEN -90 AND 90)"),
        ("between", "Longitude", "base_plus WHERE NOT (Longitude BETWEEN -180 AND 180)"),
    ]
    parts = [f"SELECT {lit(a)} AS \"check\", {lit(b)} AS \"column\", count(*) AS failures FROM {w}" for a, b, w in checks]
    parts.append("SELECT 'all_null' AS \"check\", 'WardCode' AS \"column\", count(WardCode) AS failures FROM base_plus")
    parts.append(
        "SELECT 'unique' AS \"check\", 'UPRN' AS \"column\", count(*) AS failures FROM "
        "(SELECT UPRN FROM base_plus GROUP BY UPRN HAVING count(*) > 1)"
    )
    for check, col, types in [
        ("column_type", "XCoordinate", ["DOUBLE"]),
        ("column_type", "Latitude", ["DOUBLE"]),
        ("column_type", "SharesTOID", ["BOOLEAN"]),
        ("column_type_in", "Address", ["VARCHAR"]),
    ]:
        allowed = ", ".join(lit(t) for t in types)
        parts.append(
            f"SELECT {lit(check)} AS \"check\", {lit(col)} AS \"column\", "
            f"CAST(count(*) FILTER (WHERE typeof({q(col)}) NOT IN ({allowed})) > 0 AS BIGINT) AS failures FROM base_plus"
        )
    return " UNION ALL ".join(parts)


_UNBLOCKED = [
    "ul AS (SELECT DISTINCT lower(address || ' ' || postcode) AS l_text FROM stg_certificates "
    f"WHERE uprn = '' AND {fn.outward('postcode')} IN ({_DIST}))",
    "ur AS (SELECT DISTINCT lower(address) || ' ' || lower(postcode) AS r_text FROM stg_addresses)",
]


def _brute_best(score_sql: str, threshold: float) -> str:
    """Brute force over every pair (oracle only)."""
    return (
        f"SELECT l_text, r_text AS matched_text, score FROM (SELECT l_text, r_text, score, row_number() OVER ("
        f"PARTITION BY l_text ORDER BY score DESC, r_text ASC) AS rn FROM (SELECT l_text, r_text, round({score_sql}, 9) AS score "
        f"FROM ul CROSS JOIN ur) WHERE score > {threshold}) WHERE rn = 1"
    )


def _handoff_sql() -> str:
    pc = r"[A-Z]{1,2}[0-9R][0-9A-Z]? [0-9][ABD-HJLNP-UW-Z]{2}"
    addr = (
        "array_to_string(list_transform(string_split(Address, ', '), lambda p: "
        f"CASE WHEN regexp_full_match(p, '{pc}') THEN upper(p) ELSE {fn.title('p')} END), ', ')"
    )
    headers = (
        "Uprn Udprn Toid Sharestoid Address Postcodelocator Xcoordinate Ycoordinate Latitude Longitude Parentuprn Wardcode Lsoa11Code "
        "Coa11Code Parishcode Conservationarea Nationalpark Worldheritagesite Aonb Class Classdescription Osapisource"
    ).split()
    exprs = []
    for n, h in zip(QC.BASE_NAMES, headers, strict=True):
        if n == "UPRN":
            e = "CAST(CAST(CAST(UPRN AS DOUBLE) AS BIGINT) AS VARCHAR)"
        elif n == "Address":
            e = addr
        else:
            e = q(n)
        exprs.append(f"{e} AS {q(h)}")
    return f"SELECT {', '.join(exprs)} FROM base_plus WHERE UPRN IS NOT NULL"


def _quarantine_sql() -> str:
    key = 'CAST("lmk-key" AS BIGINT)'
    bad = [("total_floor_area", 211, "n/a", "double", "strict"), ("lodgement_date", 307, "31/12/2019", "date", "strict"), ("number_open_fireplaces", 401, "two", "int", "nullif")]
    lines = [
        f"SELECT \"lmk-key\" AS lmk_key, 'domestic' AS certificate_type, '{c}' AS \"column\", '{v}' AS value, '{t}' AS type, '{r}' AS rule "
        f"FROM domestic_raw WHERE {key} % {n} = 0"
        for c, n, v, t, r in bad
    ]
    clean = " AND ".join(f"{key} % {n} <> 0" for _, n, *_ in bad)
    for kind, table, where in (("domestic", "domestic_raw", clean), ("non_domestic", "non_domestic_raw", "true")):
        lines.append(f"SELECT NULL, '{kind}', '*', CAST(count(*) AS VARCHAR), NULL, 'accepted' FROM {table} WHERE {where}")
    return " UNION ALL ".join(lines)


def _snapshot_ctes() -> list[str]:
    from brickwork.sources import schemas

    cols = [c.replace("-", "_") for c in schemas.DOMESTIC] + schemas.LINEAGE + ["certificate_type"]
    # values are paired in the order of the staged table's columns, which is the reading side's to choose
    from brickwork.plans.staging import CERTIFICATE_SPEC

    listed = [out for _, out, _, _ in CERTIFICATE_SPEC] + ["certificate_type"]
    assert sorted(listed) == sorted(cols)
    order = ", ".join(f"{c} NULLS FIRST" for c in listed if c != "uprn")
    key = "CAST(lmk_key AS BIGINT)"
    entries = ", ".join(
        f"{{'column': '{c}', 'old': CAST(l.{c} AS VARCHAR), 'new': CAST(r.{c} AS VARCHAR), 'diff': l.{c} IS DISTINCT FROM r.{c}}}" for c in listed if c != "uprn"
    )
    return [
        f"changed AS (SELECT * REPLACE (CASE WHEN {key} % 53 = 0 THEN upper(address) ELSE address END AS address, "
        f"CASE WHEN {key} % 47 = 0 THEN total_floor_area + 1 ELSE total_floor_area END AS total_floor_area, "
        f"CASE WHEN {key} % 59 = 0 THEN CAST(lodgement_date + INTERVAL 1 DAY AS DATE) ELSE lodgement_date END AS lodgement_date) "
        f"FROM stg_certificates WHERE {key} % 101 <> 0)",
        f"next_release AS (SELECT * FROM changed UNION ALL SELECT * REPLACE (lmk_key || '-new' AS lmk_key) FROM stg_certificates WHERE {key} % 89 = 0)",
        f"gone AS (SELECT *, true AS old_side, row_number() OVER (PARTITION BY uprn ORDER BY {order}) AS occurrence "
        "FROM (SELECT * FROM stg_certificates EXCEPT ALL SELECT * FROM next_release))",
        f"come AS (SELECT *, true AS new_side, row_number() OVER (PARTITION BY uprn ORDER BY {order}) AS occurrence "
        "FROM (SELECT * FROM next_release EXCEPT ALL SELECT * FROM stg_certificates))",
        "pairs AS (SELECT coalesce(l.uprn, r.uprn) AS uprn, CAST(coalesce(l.occurrence, r.occurrence) AS INTEGER) AS occurrence, "
        "CASE WHEN old_side IS NULL THEN 'added' WHEN new_side IS NULL THEN 'removed' ELSE 'changed' END AS change, "
        f"unnest([{entries}]) AS e FROM gone l FULL JOIN come r ON l.uprn = r.uprn AND l.occurrence = r.occurrence)",
    ]


def _declared_sql() -> str:
    tables = {"certificates": "stg_certificates", "enriched": "enriched", "recommendations": "stg_recommendations", "address_base": "base_plus", "profiling": "profiling", "measures": "mm"}
    out = []

    def add(table, check, column, failures):
        out.append(f"SELECT '{table}' AS \"table\", '{check}' AS \"check\", {lit(column)} AS \"column\", CAST(({failures}) AS BIGINT) AS failures")

    def rows(table, check, column, where):
        add(table, check, column, f"SELECT count(*) FROM {tables[table]} WHERE {where}")

    def kind(table, column, types):
        listed = ", ".join(lit(t) for t in types)
        add(table, "type", column, f"SELECT CASE WHEN max(split_part(typeof({q(column)}), '(', 1)) IN ({listed}) THEN 0 ELSE 1 END FROM {tables[table]}")

    for t in ("certificates", "enriched"):
        for c, values in (("walls_env_eff", QC.WALLS_ENV_EFF_VALUES), ("glazed_area", QC.GLAZED_AREA_VALUES)):
            rows(t, "accepted_values", c, f"{c} NOT IN ({', '.join(lit(v) for v in values)})")
        for c in ("fixed_lighting_outlets_count", "low_energy_fixed_light_count"):
            rows(t, "between", c, f"{c} < 0 OR {c} > 300")
    add("certificates", "row_count", "", "SELECT CASE WHEN count(*) > 0 THEN 0 ELSE 1 END FROM stg_certificates")
    repeated = "SELECT count(*) FROM (SELECT {0} FROM {1} WHERE {0} IS NOT NULL GROUP BY {0} HAVING count(*) > 1)"
    add("certificates", "unique", "lmk_key", repeated.format("lmk_key", "stg_certificates"))
    rows("recommendations", "not_null", "lmk_key", "lmk_key IS NULL")
    rows("recommendations", "relationship", "lmk_key", "lmk_key IS NOT NULL AND lmk_key NOT IN (SELECT lmk_key FROM stg_certificates WHERE lmk_key IS NOT NULL)")
    for c in ("UPRN", "UDPRN", "PostcodeLocator"):
        rows("address_base", "not_null", c, f"{q(c)} IS NULL")
    rows("address_base", "regex", "PostcodeLocator", f"NOT regexp_matches(PostcodeLocator, {lit(QC.POSTCODE_OR_NA_REGEX)})")
    rows("address_base", "between", "Latitude", "abs(Latitude) > 90")
    rows("address_base", "between", "Longitude", "abs(Longitude) > 180")
    empty = ["ConservationArea", "NationalPark", "WorldHeritageSite", "AONB"]
    for c in empty:
        rows("address_base", "all_null", c, f"{q(c)} IS NOT NULL")
    for c in ["XCoordinate", "YCoordinate", "Latitude", "Longitude", "WardCode", "LSOA11Code", "COA11Code", "ParishCode", *empty]:
        kind("address_base", c, ["DOUBLE"])
    for c in ("Address", "ParentUPRN", "Class", "ClassDescription"):
        kind("address_base", c, ["VARCHAR"])
    add("address_base", "unique", "UPRN", repeated.format("UPRN", "base_plus"))
    for c, t in {"Address": "VARCHAR", "FuelBills(£/yr)": "DOUBLE", "SAPRating": "DOUBLE", "SAPBand": "VARCHAR", "PropertyType": "VARCHAR"}.items():
        kind("profiling", c, [t])
    add("profiling", "unique", "UPRN", repeated.format("UPRN", "profiling"))
    rows("profiling", "is_date", "LodgementDate", "LodgementDate IS NOT NULL AND TRY_CAST(CAST(LodgementDate AS VARCHAR) AS DATE) IS NULL")
    add("profiling", "fewer_rows_than", "", "SELECT CASE WHEN (SELECT count(*) FROM profiling) < (SELECT count(*) FROM stg_certificates) THEN 0 ELSE 1 END")
    rows("measures", "between", "SAP", "SAP < 0 OR SAP > 300")
    rows("measures", "between", "EI", "EI < 0 OR EI > 150")
    for c in ("EI", "KgCO2SAP2012", "KgCO22017", "FuelBills", "HeatingCost", "TotalFloorArea", "ImprovementIndex", "MeasureGroupId"):
        kind("measures", c, ["DOUBLE"])
    for c in ("Category", "MeasureGroupName", "COST", "ImprovementDescrText"):
        kind("measures", c, ["VARCHAR"])
    return " UNION ALL ".join(out)


def _sorted_sql() -> str:
    others = ["UDPRN", "AddressId", "Address", "SAP", "EI", *QC.ZERO_BEFORE, "Category", "MeasureGroupId", "MeasureGroupName", "COST",
              "ImprovementDescrText", *QC.ZERO_AFTER, "MeasureOutcomeId", "MeasureOutcomeName", "FuzzyMatched"]
    order = ", ".join(f"{q(c)} NULLS LAST" for c in others)
    return (
        f"SELECT row_number() OVER (ORDER BY UPRN DESC NULLS LAST, ImprovementIndex NULLS LAST, {order}) AS position, "
        "UPRN, ImprovementIndex, UDPRN, Address, MeasureGroupId, COST FROM mm"
    )


_HANDED = {
    "profiling": "LMK_KEY,UPRN,UDPRN,ParityAddressId,Address,Postcode,EnvironmentalImpactRating,EnvironmentalImpactRatingBand,FuelBills(£/yr),"
    "RealisticFuelBill(Regional),tCO2,HeatingCost(£/yr),SAPRating,SAPBand,LodgementDate,SAPVersion,PropertyType,ConstructionAgeBand,BuiltForm,"
    "StoreysCount,FlatLocation,FlatLevel,LowestFloorArea,MainHeatingCategory,MainFuelType,MainHeatingControl,DerivedSAPMainHeatingCode,"
    "HeatEmitterType,WaterHeatingFuel,RoofConstruction,RoofInsulationLocation,RoofInsulationThickness,WallConstruction,WallInsulationType,"
    "WallInsulationThickness,FloorConstruction,FloorInsulation,FloorInsulationThickness,MultipleGlazingType,OpenFireplacesCount,Renewables,"
    "Ventilation,WaterHeatingCost(£/yr),LightingCost(£/yr),TotalFloorArea,FuzzyMatched,CertificateType",
    "address_base": "UPRN,UDPRN,Toid,Sharestoid,Address,PostcodeLocator,XCoordinate,YCoordinate,Latitude,Longitude,ParentUPRN,WardCode,"
    "LSOA11Code,COA11Code,ParishCode,ConservationArea,NationalPark,WorldHeritageSite,AONB,Class,ClassDescription,Osapisource",
    "measures": "UPRN,UDPRN,AddressID,Address,SAP,EI,KgCO2SAP2012,KgCO22017,KgCO2Sap102,KgCO22025,KgCO22030,KgCO22038,KgCO22050,FuelBills,"
    "FuelBillsRealistic,HeatingCost,KwhYr,KwhHeatingDemandm2Yr,AvHeatLossCoefficientWk,TotalFloorArea,Improvementindex,Category,"
    "MeasureGroupID,MeasureGroupName,Cost,Improvementdescrtext,CumulativeCost,SAPFollowingThisMeasure,IndividualSAPIncrease,"
    "CumulativeSAPIncrease,Averageheatlosscoefficient (W/K),Measureoutcomeid,Measureoutcomename,Fuzzymatched",
}


def _handoff_marts_sql() -> str:
    pc = r"[A-Z]{1,2}[0-9R][0-9A-Z]? [0-9][ABD-HJLNP-UW-Z]{2}"

    def parts(x: str, flags: str) -> str:
        return (
            f"array_to_string(list_transform(string_split({x}, ', '), lambda p: CASE WHEN regexp_full_match(p, '{flags}{pc}') THEN upper(p) "
            f"ELSE {fn.title('p')} END), ', ')"
        )

    bare = f"rtrim({fn.trim_ws(f"regexp_replace({parts('Address', '')}, '(,\\s*)?{pc}', '', 'g')")}, ',')"
    whole = "CAST(CAST(CAST({0} AS DOUBLE) AS BIGINT) AS VARCHAR)"
    selects = [
        ("profiling", "UPRN", "Address", "CAST(LodgementDate AS VARCHAR)", "profiling WHERE UPRN IS NOT NULL"),
        ("address_base", "UPRN", parts(bare, "(?i)"), whole.format("ParentUPRN"), "base_plus"),
        ("measures", whole.format("UPRN"), parts(parts("Address", ""), "(?i)"), whole.format("UDPRN"), "mm WHERE UPRN IS NOT NULL"),
    ]
    return " UNION ALL ".join(
        f"SELECT '{n}' AS mart, {k} AS UPRN, {a} AS Address, {d} AS detail, {lit(_HANDED[n])} AS headers FROM {t}" for n, k, a, d, t in selects
    )


def build() -> dict[str, str]:
    st = staging_ctes()
    en = st + enrich_ctes()
    pr = en + profiling_ctes()
    latest_rn = (
        "la AS (SELECT uprn, lmk_key, lodgement_date FROM (SELECT uprn, lmk_key, lodgement_date, row_number() OVER ("
        "PARTITION BY uprn ORDER BY lodgement_date DESC NULLS LAST, lmk_key ASC) AS rn FROM stg_certificates "
        "WHERE uprn IS NOT NULL AND uprn <> '') WHERE rn = 1)"
    )
    latest_grp = (
        "lb AS (SELECT c.uprn, min(c.lmk_key) AS lmk_key, c.lodgement_date FROM stg_certificates c JOIN "
        "(SELECT uprn, max(lodgement_date) AS md FROM stg_certificates WHERE uprn <> '' GROUP BY uprn) m "
        "ON c.uprn = m.uprn AND c.lodgement_date IS NOT DISTINCT FROM m.md GROUP BY c.uprn, c.lodgement_date)"
    )
    geo_all = geo.duckdb_lat_lon_sql(
        "SELECT uprn, os_api_source, x_coordinate, y_coordinate FROM stg_addresses",
        "x_coordinate", "y_coordinate", ["uprn", "os_api_source", "x_coordinate", "y_coordinate"], "latitude", "longitude",
    )
    events_cols = ["event_id", "ts", "user_id", "event_type", "value", "props"]
    return {
        "stage_union": with_ctes(st, "SELECT * FROM stg_certificates"),
        "address_feed_filter": with_ctes(st, "SELECT * FROM stg_addresses"),
        "latest_per_key": with_ctes(st + [latest_rn], "SELECT * FROM la"),
        "certificate_enrichment": with_ctes(en, "SELECT * FROM enriched"),
        "profiling_mart": with_ctes(pr, "SELECT * FROM profiling"),
        "energy_score": with_ctes(pr + sap_ctes(), "SELECT * FROM sap"),
        "shared_flag": "SELECT l_orderkey, l_linenumber, l_partkey, count(*) OVER (PARTITION BY l_partkey) > 1 AS shared FROM lineitem",
        "base_plus_mart": with_ctes(st + _base_plus_ctes(), "SELECT * FROM base_plus"),
        "grid_to_latlon": with_ctes(
            st, f"SELECT uprn, os_api_source, x_coordinate, y_coordinate, round(latitude, 7) AS latitude, round(longitude, 7) AS longitude FROM ({geo_all})"
        ),
        "measures_base": with_ctes(en + _measures_ctes(), "SELECT * FROM mb"),
        "measures_mart": with_ctes(en + _measures_ctes(), "SELECT * FROM mm"),
        "fuzzy_block_match": with_ctes(st + match_ctes("j6", _KEYLESS, _GAZ), "SELECT * FROM j6_best"),
        "district_fuzzy_match": with_ctes(
            st + match_ctes("j7", _KEYLESS, _GAZ),
            "SELECT c.lmk_key, b.l_text, b.matched_text, o.uprn, CASE WHEN o.udprn IN ('', 'N/A') THEN NULL ELSE o.udprn END AS udprn, o.postcode, b.score_y3 "
            "FROM stg_certificates c JOIN j7_best b ON lower(concat_ws(', ', c.address, c.posttown, c.postcode)) = b.l_text AND c.postcode = b.l_postcode "
            "JOIN stg_addresses o ON lower(o.address) = b.matched_text WHERE c.uprn = ''",
        ),
        "title_case_documents": f"SELECT doc_id, {fn.title('text')} AS title FROM documents",
        "format_address_documents": f"SELECT doc_id, {fn.fmt_address('text')} AS formatted FROM documents",
        "pascal_case_documents": f"SELECT doc_id, {fn.pascal('text')} AS pascal FROM documents",
        "quality_checks": with_ctes(st + _base_plus_ctes(), _quality_sql()),
        "table_diff": with_ctes(pr + sap_ctes(), _table_diff_sql()),
        "table_equal": with_ctes(
            st + [latest_rn, latest_grp],
            "SELECT (ol = 0 AND orr = 0) AS equal, ol AS only_left, orr AS only_right FROM (SELECT "
            "(SELECT count(*) FROM (SELECT * FROM la EXCEPT ALL SELECT * FROM lb)) AS ol, "
            "(SELECT count(*) FROM (SELECT * FROM lb EXCEPT ALL SELECT * FROM la)) AS orr)",
        ),
        "value_counts": "SELECT event_type, count(*) AS count FROM events WHERE event_type IS NOT NULL GROUP BY event_type",
        "null_count": "SELECT " + ", ".join(f"count_if({c} IS NULL) AS {c}" for c in events_cols) + " FROM events",
        "best_match_threshold": with_ctes(
            st + _UNBLOCKED, _brute_best(fn.wratio("l_text", "r_text", fn.token_sort("l_text"), fn.token_sort("r_text")), 80.0)
        ),
        "token_sort_match": with_ctes(st + _UNBLOCKED, _brute_best(fn.ratio(fn.token_sort("l_text"), fn.token_sort("r_text")), 80.0)),
        "token_sort_match_low": with_ctes(st + _UNBLOCKED, _brute_best(fn.ratio(fn.token_sort("l_text"), fn.token_sort("r_text")), 10.0)),
        "staging_quarantine": with_ctes(st, _quarantine_sql()),
        "snapshot_diff": with_ctes(
            st + _snapshot_ctes(),
            "SELECT uprn, occurrence, e['column'] AS \"column\", e['old'] AS old, e['new'] AS \"new\", change FROM pairs WHERE change <> 'changed' OR e['diff']",
        ),
        "sorted_measures": with_ctes(en + _measures_ctes(), _sorted_sql()),
        "handoff_marts": with_ctes(pr + _base_plus_ctes() + _measures_ctes(), _handoff_marts_sql()),
        "bucketed_joins": with_ctes(
            st,
            "SELECT c.lmk_key, c.uprn, r.recommendations, r.first_item, "
            "(SELECT count(*) FROM stg_addresses a WHERE a.uprn = c.uprn AND a.os_api_source = 'DPA' AND c.uprn <> '') AS dpa, "
            "(SELECT count(*) FROM stg_addresses a WHERE a.uprn = c.uprn AND a.os_api_source = 'LPI' AND c.uprn <> '') AS lpi "
            "FROM stg_certificates c LEFT JOIN (SELECT lmk_key, count(*) AS recommendations, min(improvement_item) AS first_item "
            "FROM stg_recommendations GROUP BY lmk_key) r ON c.lmk_key = r.lmk_key",
        ),
        "declared_tests": with_ctes(pr + _base_plus_ctes() + _measures_ctes(), _declared_sql()),
        "recommendation_consolidation": with_ctes(
            st,
            "SELECT DISTINCT lmk_key AS LMK_KEY, improvement_item AS IMPROVEMENT_ITEM, "
            "improvement_summary_text AS IMPROVEMENT_SUMMARY_TEXT, improvement_descr_text AS IMPROVEMENT_DESCR_TEXT, "
            "improvement_id AS IMPROVEMENT_ID, improvement_id_text AS IMPROVEMENT_ID_TEXT, indicative_cost AS INDICATIVE_COST "
            "FROM stg_recommendations",
        ),
        "handoff_base_plus": with_ctes(st + _base_plus_ctes(), _handoff_sql()),
        "segment_audit": (
            "WITH landed AS (SELECT event_type, (event_id // 1000) * 1000 AS page, least(1000, 4 * count(*)) AS rows FROM events "
            "WHERE event_id // 1000 % 5 <> 3 GROUP BY ALL), twice AS (SELECT * FROM landed UNION ALL SELECT * FROM landed WHERE page % 7000 = 0), "
            "pages AS (SELECT event_type, page, max(rows) AS rows, count(*) AS n FROM twice GROUP BY ALL), "
            "ends AS (SELECT *, max(page) OVER (PARTITION BY event_type) AS last FROM pages) "
            "SELECT event_type, count(*) AS pages, sum(rows)::BIGINT AS rows, max(page) AS last_offset, sum(n - 1)::BIGINT AS landed_again, "
            "max(page) // 1000 + 1 - count(*) AS missing, count(*) FILTER (rows < 1000 AND page < last) AS short_inside, "
            "(max(page) // 1000 + 1 > count(*) OR count(*) FILTER (rows < 1000 AND page < last) > 0) AS gapped, sum(rows) >= 10000 AS capped "
            "FROM ends GROUP BY event_type"
        ),
        "sliced_certificates": with_ctes(
            st,
            "SELECT CASE WHEN posttown IN ('cowes', 'ryde') THEN 'E06000046' ELSE 'E06000011' END AS authority, "
            'CAST(year(CAST("lodgement-date" AS DATE)) AS INTEGER) AS year, count(*) AS certificates, min("lmk-key") AS first_key, max("lmk-key") AS last_key, '
            'sum(CAST("total-floor-area" AS DOUBLE)) AS floor_area FROM domestic_raw WHERE year(CAST("lodgement-date" AS DATE)) BETWEEN 1992 AND 1997 GROUP BY ALL',
        ),
        "pages_explode": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
        "duplicated_keys": with_ctes(
            st,
            'SELECT CAST(count(*) - count(DISTINCT "lmk-key") - coalesce(max(CASE WHEN "lmk-key" IS NULL THEN 1 ELSE 0 END), 0) '
            "AS BIGINT) AS duplicated FROM domestic_raw",
        ),
    }
