"""Certificate enrichment with gazetteer addresses (M2).

Certificates with a property key take the DPA address of that key, falling
back to the LPI feed; certificates without a key are fuzzy-matched inside
their postcode block and take the key(s) of the matched address text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import format_address, match_text, null_if_in, outward_code
from ..operators.match import block_match
from ..session import shuffled

# ---------------------------------------------------------------- fixed values
ISLE_OF_WIGHT_DISTRICTS = [
    "PO30", "PO31", "PO32", "PO33", "PO34", "PO35", "PO36", "PO37", "PO38", "PO39", "PO40", "PO41",
]
EAST_RIDING_DISTRICTS = [
    "DN8", "DN14", "HU2", "HU4", "HU5", "HU6", "HU7", "HU8", "HU10", "HU11", "HU12", "HU13", "HU14",
    "HU15", "HU16", "HU17", "HU18", "HU19", "HU20", "YO4", "YO8", "YO11", "YO15", "YO16", "YO25",
    "YO41", "YO42", "YO43", "YO95",
]
# ---------------------------------------------------------------- /fixed values
TARGET_DISTRICTS = ISLE_OF_WIGHT_DISTRICTS + EAST_RIDING_DISTRICTS


def in_districts(df: DataFrame, postcode: str, districts=TARGET_DISTRICTS) -> DataFrame:
    """Keep rows whose outward code is a target district (small literal
    list: an ``IN`` filter, no join)."""
    return df.filter(outward_code(postcode).isin(list(districts)))


def prepare_gazetteer(addresses: DataFrame) -> DataFrame:
    """Lower-case address text; ``''``/``N/A`` delivery keys become NULL."""
    return addresses.withColumns({"address": F.lower("address"), "udprn": null_if_in("udprn", ["", "N/A"])})


def keyed_fallback(ok: DataFrame, os: DataFrame) -> DataFrame:
    """Left-join DPA then LPI on the property key; prefer DPA when it has a
    delivery key (J3, J4, X28, X37)."""
    dpa = os.filter(F.col("os_api_source") == "DPA").select(
        "uprn",
        F.col("udprn").alias("udprn_os_dpa"),
        F.col("address").alias("address_os_dpa"),
        F.col("postcode").alias("postcode_os_dpa"),
    )
    lpi = os.filter(F.col("os_api_source") == "LPI").select(
        "uprn",
        F.col("udprn").alias("udprn_os_lpi"),
        F.col("address").alias("address_os_lpi"),
        F.col("postcode").alias("postcode_os_lpi"),
    )
    j = (
        ok.withColumnsRenamed({"address": "address_epc", "postcode": "postcode_epc"})
        .join(shuffled(dpa), "uprn", "left")
        .join(shuffled(lpi), "uprn", "left")
    )
    has_dpa = F.col("udprn_os_dpa").isNotNull()
    return j.withColumns(
        {
            "address_os": F.when(has_dpa, F.col("address_os_dpa")).otherwise(F.col("address_os_lpi")),
            "postcode_os": F.when(has_dpa, F.col("postcode_os_dpa")).otherwise(F.col("postcode_os_lpi")),
            "address_source": F.when(has_dpa, F.lit("os_dpa")).otherwise(F.lit("os_lpi")),
            "fuzzy_matched": F.lit(0),
        }
    )


def fuzzy_fill(na: DataFrame, os: DataFrame) -> DataFrame:
    """Match key-less certificates and join the winner back on its address
    text (J5/J6): every gazetteer row with that text is returned (fan-out
    kept); an unmatched certificate stays, unmatched (no NULL = NULL)."""
    na = na.withColumn("address_postcode", match_text("address", "posttown", "postcode"))
    best = block_match(
        na,
        os,
        left_text="address_postcode",
        left_postcode="postcode",
        right_text="address",
        right_postcode="postcode",
    )
    na = na.join(
        shuffled(best.select("l_text", "l_postcode", "matched_text")),
        (na["address_postcode"] == best["l_text"]) & (na["postcode"] == best["l_postcode"]),
        "left",
    ).drop("l_text", "l_postcode")
    back = os.select(
        F.col("address").alias("_os_address"),
        F.col("uprn").alias("_os_uprn"),
        F.col("udprn"),
        F.col("postcode").alias("postcode_os"),
    )
    # unmatched rows have a NULL text: they stay out of the join's shuffle
    lost = na.filter(F.col("matched_text").isNull()).withColumns({c: F.lit(None).cast(t) for c, t in back.dtypes})
    na = na.filter(F.col("matched_text").isNotNull())
    na = na.join(shuffled(back), na["matched_text"] == back["_os_address"], "left").unionByName(lost)
    return (
        na.drop("uprn", "address", "_os_address")
        .withColumnsRenamed(
            {"_os_uprn": "uprn", "matched_text": "address_os", "address_postcode": "address_epc", "postcode": "postcode_epc"}
        )
        .withColumns({"fuzzy_matched": F.lit(1), "address_source": F.lit("os_fuzzy")})
    )


def enrich_certificates(
    certificates: DataFrame,
    addresses: DataFrame,
    districts=TARGET_DISTRICTS,
) -> DataFrame:
    """Staged certificates + staged gazetteer -> certificates with OS address,
    postcode and keys, ``fuzzy_matched`` and ``address_source``."""
    epc = certificates.withColumn("uprn", null_if_in("uprn", [""]))
    if districts:
        epc = in_districts(epc, "postcode", districts)
    os = prepare_gazetteer(addresses)
    ok = keyed_fallback(epc.filter(F.col("uprn").isNotNull()), os)
    na = fuzzy_fill(epc.filter(F.col("uprn").isNull()), os)
    both = ok.unionByName(na, allowMissingColumns=True)
    both = both.withColumns({"address_os": format_address("address_os"), "address_epc": format_address("address_epc")})
    return both.withColumns(
        {
            "address": F.coalesce("address_os", "address_epc"),
            "postcode": F.coalesce("postcode_os", "postcode_epc"),
        }
    )
