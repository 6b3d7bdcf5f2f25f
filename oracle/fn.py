"""DuckDB SQL twins of the library's Column functions (oracle side only).

Each function takes SQL text and returns SQL text.  They are written from
the documented semantics, independently of the Spark expressions.
"""

from __future__ import annotations

from . import fixed as cat
from . import fixed as energy
from .fixed import PLACEHOLDER_VALUES, POSTCODE_PATTERN

WS = r"[ \t\n\x0B\f\r]"


def lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def trim_ws(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def title(x: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all(lower({x}), '([\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]+|[^\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]+)', 0), "
        f"lambda r: CASE WHEN r[1] = 'ß' THEN 'Ss' || r[2:] ELSE upper(r[1]) || r[2:] END), '')"
    )


def upper_postcodes(x: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all({x}, '(?i)({POSTCODE_PATTERN}|[\\s\\S])', 0), "
        f"lambda ch: CASE WHEN length(ch) > 1 THEN upper(ch) ELSE ch END), '')"
    )


def fmt_address(x: str) -> str:
    return upper_postcodes(title(x))


def pascal(x: str) -> str:
    return (
        f"array_to_string(list_transform(string_split_regex({trim_ws(x)}, '{WS}+'), "
        f"lambda w: CASE WHEN w[1] = 'ß' THEN 'Ss' ELSE upper(w[1]) END || lower(w[2:])), '')"
    )


def null_placeholder(x: str) -> str:
    vals = ", ".join(lit(v) for v in PLACEHOLDER_VALUES)
    return f"CASE WHEN lower({x}) IN ({vals}) THEN NULL ELSE {x} END"


def strip_null(x: str) -> str:
    return null_placeholder(trim_ws(x))


def part(x: str, sep: str, i0: int) -> str:
    return f"string_split({x}, {lit(sep)})[{i0 + 1}]"


def outward(x: str) -> str:
    return f"split_part({x}, ' ', 1)"


def partial_postcode(x: str) -> str:
    inw = f"string_split({x}, ' ')[2]"
    return f"CASE WHEN {inw} IS NULL THEN {outward(x)} ELSE {outward(x)} || ' ' || substr({inw}, 1, 2) END"


def first_contains(x: str, pairs, default=None) -> str:
    whens = []
    for keys, label in pairs:
        keys = (keys,) if isinstance(keys, str) else keys
        cond = " OR ".join(f"contains({x}, {lit(k)})" for k in keys)
        whens.append(f"WHEN {cond} THEN {lit(label)}")
    body = "CASE " + " ".join(whens) + " ELSE NULL END"
    if default is not None:
        return f"CASE WHEN {x} IS NULL THEN NULL ELSE coalesce({body}, {lit(default)}) END"
    return body


def exact_map(x: str, mapping: dict) -> str:
    return "CASE " + " ".join(f"WHEN {x} = {lit(k)} THEN {lit(v)}" for k, v in mapping.items()) + " ELSE NULL END"


def keep_alnum_space(x: str) -> str:
    return f"regexp_replace({x}, '[^\\p{{L}}\\p{{N}}\\s]', '', 'g')"


# ---- categories -------------------------------------------------------------


def roof_construction(x: str) -> str:
    vals = ", ".join(lit(v) for v in cat.ROOF_CONSTRUCTIONS)
    return f"CASE WHEN {x} IN ({vals}) THEN {pascal(keep_alnum_space(x))} ELSE NULL END"


def roof_thickness_raw(x: str) -> str:
    return f"CASE WHEN contains({x}, 'mm') THEN string_split({x}, ' ')[1] || ' mm' ELSE NULL END"


def roof_remainder(x: str) -> str:
    return f"CASE WHEN contains({x}, 'mm') THEN array_to_string(string_split({x}, ' ')[3:], ' ') ELSE {x} END"


def roof_location(x: str) -> str:
    p = pascal(keep_alnum_space(x))
    others = ", ".join(lit(v) for v in cat.ROOF_LOCATION_OTHER)
    return (
        f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} IN ({others}) THEN 'Other' "
        f"WHEN {p} = 'MmLoftInsulation' THEN 'LoftInsulation' "
        f"WHEN {p} IN ('Insulation', 'WithAdditionalInsulation') THEN 'Insulated' ELSE {p} END"
    )


def clean_thickness(x: str) -> str:
    s = f"trim(regexp_replace(coalesce({x}, ''), '[^0-9+ ]', '', 'g'))"
    return f"CASE WHEN regexp_full_match({s}, '[0-9]+') OR ends_with({s}, '+') THEN {s} || 'mm' ELSE {s} END"


def wall_construction(x: str) -> str:
    return f"coalesce({first_contains(f'lower({x})', cat.WALL_CONSTRUCTION)}, 'Other')"


def wall_insulation_type(x: str) -> str:
    return first_contains(f"lower({x})", cat.WALL_INSULATION_TYPE)


def floor_construction(x: str) -> str:
    valid = ", ".join(lit(v) for v in cat.FLOOR_CONSTRUCTION_VALID)
    rep = " ".join(f"WHEN {x} = {lit(k)} THEN {lit(v)}" for k, v in cat.FLOOR_CONSTRUCTION_REPLACE.items())
    return f"CASE WHEN {x} IS NULL THEN NULL {rep} WHEN {x} NOT IN ({valid}) THEN 'Other' ELSE {pascal(x)} END"


def floor_insulation(x: str) -> str:
    p = pascal(trim_ws(f"replace({x}, '(assumed)', '')"))
    return f"CASE WHEN {p} = 'Uninsulated' THEN 'NoInsulation' ELSE {p} END"


def heating_category(x: str) -> str:
    return first_contains(x, cat.HEATING_CATEGORY, default="Other")


def fuel_category(x: str) -> str:
    return first_contains(f"lower({x})", cat.FUEL_CATEGORY)


def age_band(x: str) -> str:
    years = trim_ws(f"replace({x}, {lit(cat.AGE_BAND_REGION)}, '')")
    reg = f"contains({x}, {lit(cat.AGE_BAND_REGION)})"
    return (
        f"CASE WHEN {reg} AND contains({years}, '-') THEN {years} "
        f"WHEN {reg} AND contains({years}, 'onwards') THEN split_part({years}, ' ', 1) || ' Onwards' "
        f"WHEN regexp_full_match({x}, '[0-9]+') THEN {x} "
        f"WHEN starts_with({x}, 'Year') THEN replace({x}, 'Year', '') ELSE NULL END"
    )


def built_form(x: str) -> str:
    return pascal(f"replace({x}, '-', ' ')")


# ---- energy -----------------------------------------------------------------


def clean_fuel(x: str) -> str:
    folded = ", ".join(lit(v) for v in energy.FUELS_FOLDED_TO_OTHER)
    return f"CASE WHEN {x} IS NULL OR {x} IN ({folded}) THEN 'Other' ELSE {x} END"


def heating_cost(area: str, fuel: str) -> str:
    st = "CASE " + " ".join(f"WHEN {fuel} = {lit(k)} THEN {v[0]!r}" for k, v in energy.FUEL_PRICES.items()) + " END"
    un = "CASE " + " ".join(f"WHEN {fuel} = {lit(k)} THEN {v[1]!r}" for k, v in energy.FUEL_PRICES.items()) + " END"
    return f"(({st}) + ({un}) * ({area} * {energy.AVG_KWH_PER_M2_PER_ANNUM!r}))"


def total_cost(water: str, light: str, heating: str) -> str:
    return f"({water} + {light} + 0.5 * {heating})"


def sap_score(area: str, water: str, light: str, heating: str, null_guard: bool = True) -> str:
    f = f"(({total_cost(water, light, heating)} * {energy.ENERGY_COST_DEFLATOR!r}) / ({area} + 45.0))"
    s = f"CAST(trunc(CASE WHEN {f} > 3.4 THEN 111.0 - 110.0 * log10({f}) ELSE 110.0 - 13.96 * {f} END) AS INTEGER)"
    if null_guard:
        return f"CASE WHEN {area} IS NULL OR {water} IS NULL OR {light} IS NULL THEN NULL ELSE {s} END"
    return s


# ---- similarity -------------------------------------------------------------


def normalised(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"


def tokens(x: str) -> str:
    return f"list_distinct(list_filter(string_split({normalised(x)}, ' '), lambda t: t <> ''))"


def token_sort(x: str) -> str:
    return f"array_to_string(list_sort(list_filter(string_split({normalised(x)}, ' '), lambda t: t <> '')), ' ')"


def ratio(a: str, b: str) -> str:
    m = f"greatest(length({a}), length({b}))"
    return f"CASE WHEN {m} = 0 THEN 100.0 ELSE 100.0 * (1.0 - CAST(levenshtein({a}, {b}) AS DOUBLE) / CAST({m} AS DOUBLE)) END"


def wratio(a: str, b: str, a_s: str, b_s: str) -> str:
    return f"greatest({ratio(a, b)}, 0.95 * {ratio(a_s, b_s)})"


def weighted_ratio(a: str, b: str) -> str:
    shared = f"list_sort(list_intersect({tokens(a)}, {tokens(b)}))"
    only = [f"list_sort(list_filter({tokens(x)}, lambda t: NOT list_contains({tokens(y)}, t)))" for x, y in ((a, b), (b, a))]
    both = f"array_to_string({shared}, ' ')"
    one, two = (f"array_to_string(list_concat({shared}, {o}), ' ')" for o in only)
    sets = f"greatest({ratio(both, one)}, {ratio(both, two)}, {ratio(one, two)})"
    return f"greatest({ratio(a, b)}, 0.95 * {ratio(token_sort(a), token_sort(b))}, 0.95 * {sets})"
