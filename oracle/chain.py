"""The model chain as DuckDB CTEs over the pre-registered driver tables."""

from __future__ import annotations

from brickwork.sources import derived, schemas

from . import fixed as cat
from . import fn
from .fixed import TARGET_DISTRICTS
from .fn import lit, q

_LINEAGE = ", ".join(schemas.LINEAGE)


def _certificate(name: str, real: set[str]) -> str:
    raw = q(name.replace("_", "-"))
    if name == "glazed_area":
        return (f"COALESCE(NULLIF({raw}, ''), 'NO DATA!')" if name in real else "'NO DATA!'") + " AS glazed_area"
    for names, kind, given in (
        (cat.NULLIF_DOUBLE, "DOUBLE", f"NULLIF({raw}, '')"),
        (cat.NULLIF_INTEGER, "INTEGER", f"NULLIF({raw}, '')"),
        (cat.STRICT_DOUBLE, "DOUBLE", raw),
        (cat.STRICT_DATE, "DATE", raw),
    ):
        if name in names:
            return f"CAST({given if name in real else 'NULL'} AS {kind}) AS {name}"
    return f"CAST({raw if name in real else 'NULL'} AS VARCHAR) AS {name}"


def _address(name: str, raw: str) -> str:
    return f"CAST({q(raw)} AS {'DOUBLE' if name in cat.ADDRESS_DOUBLE else 'VARCHAR'}) AS {name}"


def staging_ctes() -> list[str]:
    names = [c.replace("-", "_") for c in schemas.DOMESTIC]
    # of the columns that both feeds have, the marts take floor-area and the like from neither
    shared = {c.replace("-", "_") for c in schemas.NON_DOMESTIC} & set(names)
    dom = ", ".join([*(_certificate(c, set(names)) for c in names), _LINEAGE])
    nd = ", ".join([*(_certificate(c, shared) for c in names), _LINEAGE])
    both = ", ".join(_address(c, c.upper()) for c in cat.BOTH_ADDRESS)
    dpa = f"{both}, {_address('postcode', 'POSTCODE')}, " + ", ".join(_address(c, c.upper()) for c in cat.DPA_ONLY) + f", {_LINEAGE}"
    lpi = f"{both}, {_address('postcode', 'POSTCODE_LOCATOR')}, " + ", ".join(f"'N/A' AS {c}" for c in cat.DPA_ONLY) + f", {_LINEAGE}"
    excl = ", ".join(lit(v) for v in cat.EXCLUDED_LPI_CLASSES)
    return [
        derived.duckdb_ctes(),
        f"stg_certificates AS (SELECT {dom}, 'domestic' AS certificate_type FROM domestic_raw "
        f"UNION SELECT {nd}, 'non_domestic' AS certificate_type FROM non_domestic_raw)",
        f"stg_addresses AS (SELECT {dpa}, 'DPA' AS os_api_source FROM dpa_raw "
        f"UNION SELECT {lpi}, 'LPI' AS os_api_source FROM lpi_raw WHERE CLASSIFICATION_CODE_DESCRIPTION NOT IN ({excl}))",
        "stg_recommendations AS (SELECT lmk_key, improvement_item, improvement_summary_text, improvement_descr_text, "
        "improvement_id, improvement_id_text, indicative_cost FROM recommendations_raw)",
    ]


def _district_keys(pc: str) -> str:
    out = fn.outward(pc)
    return (
        f"list_filter(flatten(list_transform(range(1, length({out})), lambda s: "
        f"list_transform(range(2, length({out}) - s + 2), lambda ln: substr({out}, s, ln)))), lambda k: length(k) >= 2)"
    )


def match_ctes(prefix: str, left_sql: str, right_sql: str) -> list[str]:
    """Best match per (l_text, l_postcode) by brute force over each district: ``{prefix}_best``.
    ``left_sql`` yields (l_text, l_postcode); ``right_sql`` (r_text, r_postcode)."""
    p = prefix
    y1 = fn.weighted_ratio("l_text", "r_text")
    return [
        f"{p}_L AS (SELECT DISTINCT l_text, l_postcode, {fn.outward('l_postcode')} AS bkey FROM ({left_sql}) WHERE l_text IS NOT NULL AND l_postcode IS NOT NULL)",
        f"{p}_R AS (SELECT DISTINCT r_text, unnest({_district_keys('r_postcode')}) AS bkey FROM ({right_sql}) WHERE r_text IS NOT NULL AND r_postcode IS NOT NULL)",
        f"{p}_vocab AS (SELECT token, count(*) AS df FROM (SELECT unnest({fn.tokens('r_text')}) AS token FROM (SELECT DISTINCT r_text FROM {p}_R)) GROUP BY token)",
        f"{p}_ltok AS (SELECT l_text, l_postcode, bkey, token, 1.0 / coalesce(df, 1) AS w FROM "
        f"(SELECT *, unnest({fn.tokens('l_text')}) AS token FROM {p}_L) LEFT JOIN {p}_vocab USING (token))",
        f"{p}_total AS (SELECT l_text, l_postcode, sum(w) AS total FROM {p}_ltok GROUP BY ALL)",
        f"{p}_rtok AS (SELECT DISTINCT bkey, r_text, unnest({fn.tokens('r_text')}) AS token FROM {p}_R)",
        f"{p}_sum AS (SELECT l_text, l_postcode, r_text, sum(w) AS shared FROM {p}_ltok JOIN {p}_rtok USING (bkey, token) GROUP BY ALL)",
        f"{p}_y3 AS (SELECT l_text, l_postcode, r_text, round(shared / total, 9) AS score_y3 FROM {p}_sum JOIN {p}_total USING (l_text, l_postcode))",
        f"{p}_near AS (SELECT * FROM {p}_y3 QUALIFY score_y3 = max(score_y3) OVER (PARTITION BY l_text, l_postcode))",
        f"{p}_best AS (SELECT l_text, l_postcode, r_text AS matched_text, score_y1, score_y3 FROM (SELECT *, round({y1}, 9) AS score_y1 FROM {p}_near) "
        f"QUALIFY row_number() OVER (PARTITION BY l_text, l_postcode ORDER BY score_y1 DESC, r_text) = 1)",
    ]


def enrich_ctes() -> list[str]:
    dist = ", ".join(lit(d) for d in TARGET_DISTRICTS)
    ctes = [
        f"epc AS (SELECT * REPLACE (CASE WHEN uprn IN ('') THEN NULL ELSE uprn END AS uprn) FROM stg_certificates "
        f"WHERE {fn.outward('postcode')} IN ({dist}))",
        "os AS (SELECT * REPLACE (lower(address) AS address, CASE WHEN udprn IN ('', 'N/A') THEN NULL ELSE udprn END AS udprn) "
        "FROM stg_addresses)",
        "ok0 AS (SELECT e.* EXCLUDE (address, postcode), e.address AS address_epc, e.postcode AS postcode_epc, "
        "d.udprn AS udprn_os_dpa, d.address AS address_os_dpa, d.postcode AS postcode_os_dpa, "
        "l.udprn AS udprn_os_lpi, l.address AS address_os_lpi, l.postcode AS postcode_os_lpi "
        "FROM epc e LEFT JOIN (SELECT * FROM os WHERE os_api_source = 'DPA') d ON e.uprn = d.uprn "
        "LEFT JOIN (SELECT * FROM os WHERE os_api_source = 'LPI') l ON e.uprn = l.uprn WHERE e.uprn IS NOT NULL)",
        "ok AS (SELECT *, CASE WHEN udprn_os_dpa IS NOT NULL THEN address_os_dpa ELSE address_os_lpi END AS address_os, "
        "CASE WHEN udprn_os_dpa IS NOT NULL THEN postcode_os_dpa ELSE postcode_os_lpi END AS postcode_os, "
        "CASE WHEN udprn_os_dpa IS NOT NULL THEN 'os_dpa' ELSE 'os_lpi' END AS address_source, 0 AS fuzzy_matched FROM ok0)",
        "na AS (SELECT *, lower(concat_ws(', ', address, posttown, postcode)) AS address_postcode FROM epc WHERE uprn IS NULL)",
    ]
    ctes += match_ctes(
        "fz",
        "SELECT address_postcode AS l_text, postcode AS l_postcode FROM na",
        "SELECT address AS r_text, postcode AS r_postcode FROM os",
    )
    ctes += [
        "na_m AS (SELECT na.*, b.matched_text FROM na LEFT JOIN fz_best b ON na.address_postcode = b.l_text AND na.postcode = b.l_postcode)",
        "na_out AS (SELECT m.* EXCLUDE (uprn, address, postcode, address_postcode, matched_text), o.uprn AS uprn, o.udprn AS udprn, "
        "o.postcode AS postcode_os, m.matched_text AS address_os, m.address_postcode AS address_epc, m.postcode AS postcode_epc, "
        "1 AS fuzzy_matched, 'os_fuzzy' AS address_source FROM na_m m LEFT JOIN os o ON m.matched_text = o.address)",
        "both_ AS (SELECT * FROM ok UNION ALL BY NAME SELECT * FROM na_out)",
        f"enriched AS (SELECT * REPLACE ({fn.fmt_address('address_os')} AS address_os, {fn.fmt_address('address_epc')} AS address_epc), "
        f"coalesce({fn.fmt_address('address_os')}, {fn.fmt_address('address_epc')}) AS address, "
        f"coalesce(postcode_os, postcode_epc) AS postcode FROM both_)",
    ]
    return ctes


_NON_TEXT = {
    "current_energy_efficiency", "total_floor_area", "environment_impact_current", "lodgement_date",
    "co2_emissions_current", "heating_cost_current", "number_open_fireplaces", "wind_turbine_count",
    "hot_water_cost_current", "lighting_cost_current", "inspection_date", "flat_storey_count", "fuzzy_matched",
}


def profiling_ctes(source: str = "enriched") -> list[str]:
    keep = ", ".join(cat.PROFILE_KEEP)
    splits = ", ".join(
        f"{fn.part(c, ',', i)} AS {c}_{i + 1}" for c in ["roof_description", "walls_description", "floor_description"] for i in range(3)
    )
    cols_after_split = cat.PROFILE_KEEP + [f"{c}_{i + 1}" for c in ["roof_description", "walls_description", "floor_description"] for i in range(3)]
    titled = {
        "address": fn.fmt_address(fn.title("address")),
        "property_type": fn.title("property_type"),
        "roof_description_1": fn.title("roof_description_1"),
        "mechanical_ventilation": fn.title("mechanical_ventilation"),
    }
    p2 = ", ".join(f"{titled.get(c, c)} AS {c}" for c in cols_after_split)
    p3 = ", ".join(
        (f"{fn.strip_null(c)} AS {c}" if c not in _NON_TEXT else c) for c in cols_after_split
    )
    ren = dict(cat.PROFILE_RENAMES)
    derived_cols = {
        "roof_description_3": fn.roof_thickness_raw("roof_description_2"),
        "roof_description_4": fn.roof_remainder("roof_description_2"),
    }
    src_of = {v: k for k, v in ren.items()}

    def src(name):
        s = src_of.get(name)
        if s is None:
            return None
        return derived_cols.get(s, s)

    transforms = {
        "RoofConstruction": fn.roof_construction,
        "RoofInsulationLocation": fn.roof_location,
        "RoofInsulationThickness": fn.clean_thickness,
        "FloorConstruction": fn.floor_construction,
        "FloorInsulation": fn.floor_insulation,
        "MainHeatingCategory": fn.heating_category,
        "MainFuelType": fn.fuel_category,
        "MultipleGlazingType": lambda x: fn.exact_map(x, cat.GLAZING_TYPE),
        "ConstructionAgeBand": lambda x: fn.pascal(fn.age_band(x)),
        "PropertyType": lambda x: fn.exact_map(x, cat.PROPERTY_TYPE),
        "BuiltForm": fn.built_form,
        "FlatLevel": lambda x: fn.exact_map(x, cat.FLOOR_LEVEL_ALL),
    }
    # p4 materialises the roof-derived columns so later expressions stay small
    p4 = (
        f"SELECT * REPLACE ({derived_cols['roof_description_3']} AS roof_description_3), "
        f"{derived_cols['roof_description_4']} AS roof_description_4 FROM p3"
    )
    out = []
    for name in cat.PROFILE_ORDER:
        if name in cat.PROFILE_BLANK:
            out.append(f"CAST(NULL AS DOUBLE) AS {q(name)}")
            continue
        s = src_of.get(name)
        if name == "WallInsulationType":
            out.append(f"{fn.wall_insulation_type('walls_description')} AS {q(name)}")
        elif name == "WallConstruction":
            out.append(f"{fn.wall_construction('walls_description')} AS {q(name)}")
        elif name == "WallInsulationThickness":
            out.append(f"CAST(NULL AS VARCHAR) AS {q(name)}")
        elif name == "FloorInsulationThickness":
            out.append(f"CAST(NULL AS DOUBLE) AS {q(name)}")
        elif name in transforms:
            out.append(f"{transforms[name](s)} AS {q(name)}")
        elif name == "LMK_KEY":
            out.append(f"CAST(lmk_key AS VARCHAR) AS {q(name)}")
        else:
            out.append(f"{s} AS {q(name)}")
    final_cols = ", ".join(q(c) for c in cat.PROFILE_ORDER)
    return [
        f"p0 AS (SELECT DISTINCT {keep} FROM {source})",
        f"p1 AS (SELECT *, {splits} FROM p0)",
        f"p2 AS (SELECT {p2} FROM p1)",
        f"p3 AS (SELECT * REPLACE (coalesce(trim(CAST(uprn AS VARCHAR)), '') AS uprn) FROM (SELECT {p3} FROM p2))",
        f"p4 AS ({p4})",
        f"p5 AS (SELECT {', '.join(out)} FROM p4)",
        f"profiling AS (SELECT {final_cols} FROM (SELECT *, row_number() OVER (PARTITION BY \"UPRN\" "
        f"ORDER BY \"LodgementDate\" DESC NULLS LAST, \"LMK_KEY\" ASC) AS rn FROM p5 WHERE \"UPRN\" IS NOT NULL AND \"UPRN\" <> '') WHERE rn = 1)",
    ]


def sap_ctes(source: str = "profiling") -> list[str]:
    area, water, light = q("TotalFloorArea"), q("WaterHeatingCost(£/yr)"), q("LightingCost(£/yr)")
    fuel = q("MainFuelType")
    heat = fn.heating_cost(area, fuel)
    return [
        f"sap0 AS (SELECT * EXCLUDE ({q('HeatingCost(£/yr)')}) REPLACE ({fn.clean_fuel(fuel)} AS {fuel}) FROM {source})",
        f"sap AS (SELECT *, {heat} AS {q('HeatingCost(£/yr)')}, {fn.total_cost(water, light, heat)} AS totalEnergyCost, "
        f"{fn.sap_score(area, water, light, heat)} AS SAPScore FROM sap0)",
    ]


def with_ctes(ctes: list[str], final: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + final
