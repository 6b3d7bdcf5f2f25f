"""Energy cost and score arithmetic as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c

# ---------------------------------------------------------------- fixed values
AVG_KWH_PER_M2_PER_ANNUM = 133.0
ENERGY_COST_DEFLATOR = 0.42
# fuel -> (standing cost, unit price)
FUEL_PRICES = {
    "MainsGas": (120.0, 0.0348),
    "Electricity": (54.0, 0.1319),
    "Oil": (0.0, 0.0544),
    "LPG": (70.0, 0.076),
    "DualFuel": (0.0, 0.0399),
    "WoodLogs": (0.0, 0.0423),
    "Coal": (0.0, 0.0367),
    "Biomass": (0.0, 0.47),
    "Anthracite": (0.0, 0.0364),
    "SmokelessCoal": (0.0, 0.0367),
    "WoodPellets": (0.0, 0.0526),
    "WoodChips": (0.0, 0.0307),
    "Biogas": (70.0, 0.076),
    "Other": (0.0, 0.025),
}
FUELS_FOLDED_TO_OTHER = ["NoSystem", "Invalid"]
# ---------------------------------------------------------------- /fixed values


def _price(fuel: Column, idx: int) -> Column:
    m = F.create_map(*[x for k, v in FUEL_PRICES.items() for x in (F.lit(k), F.lit(v[idx]))])
    return F.try_element_at(m, fuel)


def standing_cost(fuel) -> Column:
    return _price(_c(fuel), 0)


def unit_price(fuel) -> Column:
    return _price(_c(fuel), 1)


def clean_fuel(fuel) -> Column:
    """NULL, ``NoSystem`` and ``Invalid`` fold into ``Other``."""
    f = _c(fuel)
    return F.when(f.isNull() | f.isin(FUELS_FOLDED_TO_OTHER), F.lit("Other")).otherwise(f)


def energy_used(area) -> Column:
    return _c(area) * F.lit(AVG_KWH_PER_M2_PER_ANNUM)


def known_fuel(fuel) -> Column:
    """Whether a fuel has a price; NULL for no fuel."""
    return _c(fuel).isin(list(FUEL_PRICES))


def heating_cost(area, fuel, strict: bool = True) -> Column:
    """Standing charge + unit price x energy used (a priced-fuel lookup).  A fuel without a price raises, as the
    lookup in the reference does; with ``strict=False`` its cost is NULL."""
    cost = standing_cost(fuel) + unit_price(fuel) * energy_used(area)
    if not strict:
        return cost
    return F.when(~known_fuel(fuel), F.raise_error(F.concat(F.lit("no price for fuel "), _c(fuel)))).otherwise(cost)


def total_energy_cost(water, lighting, heating) -> Column:
    return _c(water) + _c(lighting) + F.lit(0.5) * _c(heating)


def energy_cost_factor(total, area) -> Column:
    return (_c(total) * F.lit(ENERGY_COST_DEFLATOR)) / (_c(area) + F.lit(45.0))


def sap_score(area, water, lighting, heating, null_guard: bool = True) -> Column:
    """Score from the cost factor; truncates toward zero like Python ``int``.

    With ``null_guard`` a NULL area, water or lighting cost gives NULL
    explicitly; without it NULLs simply propagate through the arithmetic.
    """
    f = energy_cost_factor(total_energy_cost(water, lighting, heating), area)
    score = F.when(f > 3.4, F.lit(111.0) - F.lit(110.0) * F.log10(f)).otherwise(F.lit(110.0) - F.lit(13.96) * f)
    score = score.cast("int")
    if null_guard:
        return F.when(_c(area).isNull() | _c(water).isNull() | _c(lighting).isNull(), F.lit(None).cast("int")).otherwise(score)
    return score
