"""Registered queries: one per operator family of the survey inventory.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole of the
given tables.  Numeric outputs that mix engines' float formatting are
rounded where noted so results compare exactly against the DuckDB twins.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .operators import dedup
from .plans import chain
from .plans.profiling import with_sap_scores
from .session import cut_lineage, shuffled

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    REGISTRY[fn.__name__] = fn
    return fn


@register
def stage_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1-P7 + U1: typed, tagged union of the two certificate feeds."""
    return chain.staged_certificates(spark, sf_dir)


@register
def address_feed_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 + P6 + P8 + U2: DPA and filtered, padded LPI addresses."""
    return chain.staged_addresses(spark, sf_dir)


@register
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 + F5: latest certificate per property key (ties: lowest lmk_key)."""
    c = chain.staged_certificates(spark, sf_dir, distinct=False).filter(F.col("uprn").isNotNull() & (F.col("uprn") != ""))
    c = c.select("uprn", "lmk_key", "lodgement_date")
    return dedup.latest_per_key(c, "uprn", "lodgement_date", tiebreak=["lmk_key"])


@register
def certificate_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: key joins with DPA/LPI fallback + blocked fuzzy match."""
    return chain.enriched_certificates(spark, sf_dir)


@register
def profiling_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: one categorised row per property."""
    return chain.profiling_mart(spark, sf_dir)


@register
def energy_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5 (flagship): profiling mart + recomputed heating cost and score."""
    return chain.profiling_sap_mart(spark, sf_dir)


# --------------------------------------------------------------------- marts
from .functions import text as X  # noqa: E402
from .operators import match as M  # noqa: E402
from .operators import quality as QC  # noqa: E402
from .plans import enrich as EN  # noqa: E402
from .plans import marts  # noqa: E402
from .functions.geo import with_lat_lon  # noqa: E402


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@register
def shared_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: is this line's part shared by another line (whole lineitem)."""
    li = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return dedup.shared_value_flag(li, "l_partkey", "shared")


@register
def base_plus_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6: DPA addresses with lat/lon, shared-TOID flag, target districts."""
    return marts.base_plus(chain.staged_addresses(spark, sf_dir))


@register
def grid_to_latlon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Z1 over every staged address."""
    a = chain.staged_addresses(spark, sf_dir).select("uprn", "os_api_source", "x_coordinate", "y_coordinate")
    a = with_lat_lon(a, "x_coordinate", "y_coordinate", "latitude", "longitude")
    return a.withColumns({"latitude": F.round("latitude", 7), "longitude": F.round("longitude", 7)})


@register
def measures_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: certificate x recommendation x DPA."""
    return marts.measures_base(
        chain.enriched_certificates(spark, sf_dir), chain.staged_recommendations(spark, sf_dir), chain.staged_addresses(spark, sf_dir), addresses_first=True
    )


@register
def measures_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7: cleansed, de-duplicated measures."""
    return marts.measures_mart(measures_base(spark, sf_dir))


def _keyless(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = chain.staged_certificates(spark, sf_dir, distinct=False)
    c = dedup.distinct_rows(EN.in_districts(c.filter(F.col("uprn") == ""), "postcode"))
    return c.withColumn("address_postcode", X.match_text("address", "posttown", "postcode"))


@register
def fuzzy_block_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best gazetteer address per key-less certificate, over its whole district."""
    os = EN.prepare_gazetteer(chain.staged_addresses(spark, sf_dir))
    return M.block_match(_keyless(spark, sf_dir), os, left_text="address_postcode", left_postcode="postcode")


@register
def district_fuzzy_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The match joined back inner, on its address text; the certificate
    takes the keys and postcode of every gazetteer row with that text."""
    os = EN.prepare_gazetteer(chain.staged_addresses(spark, sf_dir))
    keyless = _keyless(spark, sf_dir)
    best = M.block_match(keyless, os, left_text="address_postcode", left_postcode="postcode")
    left = keyless.select("lmk_key", F.col("address_postcode").alias("l_text"), F.col("postcode").alias("l_postcode"))
    back = os.select(F.col("address").alias("matched_text"), "uprn", "udprn", "postcode")
    return left.join(shuffled(best), ["l_text", "l_postcode"]).join(shuffled(back), "matched_text").select("lmk_key", "l_text", "matched_text", "uprn", "udprn", "postcode", "score_y3")


@register
def title_case_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 over every document text."""
    d = _read(spark, sf_dir, "documents")
    return d.select("doc_id", X.title_case("text").alias("title"))


@register
def format_address_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X2 over every document text (postcode-shaped tokens upper-cased)."""
    d = _read(spark, sf_dir, "documents")
    return d.select("doc_id", X.format_address("text").alias("formatted"))


@register
def pascal_case_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X6 over every document text."""
    d = _read(spark, sf_dir, "documents")
    return d.select("doc_id", X.pascal_case("text").alias("pascal"))


@register
def quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1-Q4, Q7, Q8 over staging and the address-base mart."""
    c = chain.staged_certificates(spark, sf_dir)
    r = chain.staged_recommendations(spark, sf_dir)
    b = marts.base_plus(chain.staged_addresses(spark, sf_dir))
    return QC.report(
        [
            QC.failures("accepted_values", "walls_env_eff", QC.accepted_values(c, "walls_env_eff", QC.WALLS_ENV_EFF_VALUES)),
            QC.failures("accepted_values", "glazed_area", QC.accepted_values(c, "glazed_area", QC.GLAZED_AREA_VALUES)),
            QC.failures("not_null", "lmk_key", QC.not_null(r, "lmk_key")),
            QC.failures("relationship", "lmk_key", QC.relationship(r, c, "lmk_key", "lmk_key")),
            QC.failures("not_null", "UDPRN", QC.not_null(b, "UDPRN")),
            QC.failures("regex", "PostcodeLocator", QC.regex_match(b, "PostcodeLocator", QC.POSTCODE_OR_NA_REGEX)),
            QC.failures("between", "Latitude", QC.between(b, "Latitude", -90, 90)),
            QC.failures("between", "Longitude", QC.between(b, "Longitude", -180, 180)),
            QC.all_null("all_null", b, "WardCode"),
            QC.failures("unique", "UPRN", QC.unique(b, "UPRN")),
            QC.column_type("column_type", b, "XCoordinate", [T.DoubleType]),
            QC.column_type("column_type", b, "Latitude", [T.DoubleType]),
            QC.column_type("column_type", b, "SharesTOID", [T.BooleanType]),
            QC.column_type("column_type_in", b, "Address", [T.StringType, T.VarcharType, T.CharType]),
        ]
    )


@register
def table_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What changed per property, text or heating cost, between the
    profiling release (computed once) and the scored release."""
    a = cut_lineage(chain.profiling_mart(spark, sf_dir))
    b = with_sap_scores(a)
    text_cols = [f.name for f in a.schema.fields if f.dataType.simpleString() == "string"]
    return QC.table_diff(a, b, "UPRN", [*text_cols, "HeatingCost(£/yr)"])


@register
def table_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3: the aggregate and window forms of latest-per-key agree."""
    c = chain.staged_certificates(spark, sf_dir).filter(F.col("uprn") != "").select("uprn", "lmk_key", "lodgement_date")
    return QC.frames_equal(
        dedup.latest_per_key(c, "uprn", "lodgement_date", ["lmk_key"]),
        dedup.latest_per_key_window(c, "uprn", "lodgement_date", ["lmk_key"]),
    )


@register
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 on events.event_type."""
    return dedup.value_counts(_read(spark, sf_dir, "events"), "event_type")


@register
def null_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 per events column."""
    e = _read(spark, sf_dir, "events")
    return dedup.null_count(e, ["event_id", "ts", "user_id", "event_type", "value", "props"])


@register
def duplicated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: certificate keys landed more than once in the domestic feed."""
    from .sources.derived import load_feed

    return dedup.duplicated_key_count(load_feed(spark, sf_dir, "domestic_raw"), "`lmk-key`")


@register
def pages_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed as JSON pages of at most 1000 records
    (``{"rows": [...]}``), parsed with a declared schema and exploded."""
    from .sources.pages import JSON_OPTIONS, explode_rows

    e = _read(spark, sf_dir, "events")
    record = e.schema
    pages = e.groupBy(F.to_date("ts").alias("day"), F.floor(F.col("event_id") / 1000).alias("page")).agg(
        F.to_json(F.struct(F.collect_list(F.struct(*e.columns)).alias("rows")), JSON_OPTIONS).alias("page_json")
    )
    return explode_rows(pages, "page_json", record)


def _unblocked_inputs(spark: SparkSession, sf_dir: str):
    left = _keyless(spark, sf_dir).select(F.lower(F.concat("address", F.lit(" "), "postcode")).alias("text"))
    right = chain.staged_addresses(spark, sf_dir).select(F.concat(F.lower("address"), F.lit(" "), F.lower("postcode")).alias("text"))
    return left, right


@register
def best_match_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best gazetteer text over all addresses with weighted ratio > 80."""
    left, right = _unblocked_inputs(spark, sf_dir)
    return M.best_match(left, right, threshold=80.0, scorer="wratio")


@register
def token_sort_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best gazetteer text over all addresses with token-sort ratio > 80."""
    left, right = _unblocked_inputs(spark, sf_dir)
    return M.best_match(left, right, threshold=80.0, scorer="token_sort")


@register
def token_sort_match_low(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J9 at its second threshold: best text with token-sort ratio > 10."""
    left, right = _unblocked_inputs(spark, sf_dir)
    return M.best_match(left, right, threshold=10.0, scorer="token_sort")


@register
def recommendation_consolidation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8: every recommendation segment in one read, API column names,
    whole-row distinct (U4, A1; the sort is left to the sink)."""
    from .sources.pages import RECOMMENDATION_SCHEMA

    r = chain.staged_recommendations(spark, sf_dir)
    names = [f.name for f in RECOMMENDATION_SCHEMA.fields]
    return r.toDF(*names).dropDuplicates()


@register
def handoff_base_plus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hand-off cleanup of the address-base mart: key to integer text
    (X34), comma parts title-cased except the postcode (X32), headers
    title-cased without underscores (P18)."""
    from .operators.columns import normalise_headers

    b = marts.base_plus(chain.staged_addresses(spark, sf_dir))
    b = b.filter(F.col("UPRN").isNotNull()).withColumns(
        {"UPRN": X.numeric_key_text("UPRN"), "Address": X.title_case_address_parts("Address")}
    )
    return normalise_headers(b)


@register
def segment_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page accounting over a landing log derived from events: pages of
    1000 offsets per event type, of which every fifth is missing, every
    seventh landed twice, and some are short."""
    from .sources.pages import page_audit

    e = _read(spark, sf_dir, "events")
    page = F.floor(F.col("event_id") / 1000)
    landed = e.filter(page % 5 != 3).groupBy("event_type", (page * 1000).alias("offset")).agg(F.least(F.lit(1000), 4 * F.count(F.lit(1))).alias("rows"))
    return page_audit(landed.unionByName(landed.filter("offset % 7000 = 0")), ["event_type"], "offset", "rows")


@register
def sliced_certificates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 + S8: domestic certificates landed as pages by authority and year, loaded in two runs (the second one loads
    the years after 1995 and the one open before), read back without the last year and summed up by slice.  The records
    are wide: they are bucketed by page where they are, so that pages are put together without shuffling them."""
    from .session import scratch_path, unsorted_writes
    from .sinks import save_bucketed
    from .sources import slices
    from .sources.derived import load_feed

    raw = load_feed(spark, sf_dir, "domestic_raw")
    at = F.when(F.col("posttown").isin("cowes", "ryde"), "E06000046").otherwise("E06000011")
    page = F.floor(F.col("`lmk-key`").cast("long") / 1000)
    where = raw.withColumns({"authority": at, "year": F.year("lodgement-date"), "page": page})
    body = F.to_json(F.struct(F.collect_list(F.struct(*[f"`{c}`" for c in raw.columns])).alias("rows"))).alias("value")
    landing, target = scratch_path(spark, "landing"), scratch_path(spark, "certificates")
    buckets = max(16, min(128, where.count() // 100_000))
    records = scratch_path(spark, "records")
    dealt = save_bucketed(where, f"records_{records[-8:]}", ["authority", "year", "page"], buckets, records, sort=False)
    pages = dealt.groupBy("authority", "year", "page").agg(body).drop("page")
    with unsorted_writes(spark, 16):
        pages.write.partitionBy("authority", "year").option("compression", "gzip").text(landing)
    for last in (1995, 1998):
        plan = slices.slice_plan(spark, ["E06000046", "E06000011"], 1992, last)
        slices.sync(spark, landing, raw.schema, target, plan, page_per_file=False)
    table = slices.read_slices(spark, target, raw.schema, last_year=1997)
    area = F.col("`total-floor-area`").cast("double")
    return table.groupBy("authority", "year").agg(
        F.count(F.lit(1)).alias("certificates"), F.min("lmk-key").alias("first_key"), F.max("lmk-key").alias("last_key"), F.sum(area).alias("floor_area")
    )


@register
def staging_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1-P3 with an error channel: a feed with bad numbers and dates is staged whole, and what could not be cast is
    kept with its key, raw value and rule."""
    from .operators import columns
    from .plans import staging
    from .session import scratch_path
    from .sources.derived import load_feed

    raw = load_feed(spark, sf_dir, "domestic_raw")
    key = F.col("lmk-key").cast("long")
    dirty = raw.withColumns(
        {
            "total-floor-area": F.when(key % 211 == 0, "n/a").otherwise(F.col("total-floor-area")),
            "lodgement-date": F.when(key % 307 == 0, "31/12/2019").otherwise(F.col("lodgement-date")),
            "number-open-fireplaces": F.when(key % 401 == 0, "two").otherwise(F.col("number-open-fireplaces")),
        }
    )
    staged = staging.check_certificates(dirty, load_feed(spark, sf_dir, "non_domestic_raw"))
    accepted, refused = columns.write_checked(staged, scratch_path(spark, "checked"))
    lines = columns.quarantine(refused, ["lmk_key", "certificate_type"])
    none = F.lit(None).cast("string")
    kept = accepted.groupBy("certificate_type").agg(F.count(F.lit(1)).cast("string").alias("value"))
    return lines.unionByName(kept.select(none.alias("lmk_key"), "certificate_type", F.lit("*").alias("column"), "value", none.alias("type"), F.lit("accepted").alias("rule")))


def _next_release(release: DataFrame) -> DataFrame:
    """A later release: some certificates gone, changed or new."""
    key = F.col("lmk_key").cast("long")
    changed = release.filter(key % 101 != 0).withColumns(
        {
            "address": F.when(key % 53 == 0, F.upper("address")).otherwise(F.col("address")),
            "total_floor_area": F.when(key % 47 == 0, F.col("total_floor_area") + 1).otherwise(F.col("total_floor_area")),
            "lodgement_date": F.when(key % 59 == 0, F.date_add("lodgement_date", 1)).otherwise(F.col("lodgement_date")),
        }
    )
    new = release.filter(key % 89 == 0).withColumn("lmk_key", F.concat("lmk_key", F.lit("-new")))
    return changed.unionByName(new)


@register
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two releases of all staged certificates, stored as snapshots and compared on all columns by
    property, a key that repeats."""
    from .operators import snapshots
    from .session import scratch_path

    release = chain.staged_certificates(spark, sf_dir)
    old, new = scratch_path(spark, "release"), scratch_path(spark, "release")
    snapshots.write_snapshot(release, old, ["uprn"])
    snapshots.write_snapshot(_next_release(release), new, ["uprn"])
    return snapshots.diff_snapshots(spark, old, new, ["uprn"])


@register
def sorted_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2 with positions: the measures mart by property descending and improvement ascending, NULLs last."""
    from .operators.ordering import with_position

    mart = measures_mart(spark, sf_dir)
    rest = [F.asc_nulls_last(f"`{c}`") for c in mart.columns if c not in ("UPRN", "ImprovementIndex")]
    placed = with_position(mart, [F.desc_nulls_last("UPRN"), F.asc_nulls_last("ImprovementIndex"), *rest])
    return placed.select("position", "UPRN", "ImprovementIndex", "UDPRN", "Address", "MeasureGroupId", "COST")


@register
def declared_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1-Q10, A10: every declared rule of staging and the marts, one scan a table for the rules on rows."""
    from .operators import rules
    from .plans.declared import RULES
    from .plans.profiling import SOURCES, profile

    certificates = cut_lineage(chain.staged_certificates(spark, sf_dir))
    addresses, recommendations = chain.staged_addresses(spark, sf_dir), chain.staged_recommendations(spark, sf_dir)
    read = {*SOURCES, *(r.column for r in RULES if r.table == "enriched" and r.column)}
    enriched = EN.enrich_certificates(certificates, addresses)
    enriched = cut_lineage(enriched.select(*[c for c in enriched.columns if c in read]))
    tables = {
        "certificates": certificates,
        "enriched": enriched,
        "recommendations": recommendations,
        "address_base": marts.base_plus(addresses),
        "profiling": cut_lineage(profile(enriched)),
        "measures": marts.measures_mart(marts.measures_base(enriched, recommendations, addresses, addresses_first=True)),
    }
    return rules.run(tables, RULES)


@register
def handoff_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three marts as handed over, each row by its key, its address and a digest of the whole row."""
    from .plans import handoff
    from .plans.profiling import SOURCES, profile

    addresses = chain.staged_addresses(spark, sf_dir)
    # what the marts read: the other columns would be shuffled through the enrichment and written for no reader
    enriched = cut_lineage(chain.enriched_certificates(spark, sf_dir).select(*SOURCES))
    done = {
        "profiling": handoff.profiling(profile(enriched)),
        "address_base": handoff.address_base(marts.base_plus(addresses)),
        "measures": handoff.measures(marts.measures_mart(marts.measures_base(enriched, chain.staged_recommendations(spark, sf_dir), addresses, addresses_first=True))),
    }
    key = {"profiling": "LodgementDate", "address_base": "ParentUPRN", "measures": "UDPRN"}
    out = [
        d.select(F.lit(n).alias("mart"), "UPRN", "Address", F.col(key[n]).cast("string").alias("detail"), F.lit(",".join(d.columns)).alias("headers"))
        for n, d in done.items()
    ]
    return out[0].unionByName(out[1]).unionByName(out[2])


@register
def bucketed_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1, J1, J3, J4, J11 over bucketed staging: certificates by recommendation, and by address feed."""
    from .session import scratch_path

    path = scratch_path(spark, "staging")
    t = chain.staging_tables(spark, sf_dir, path, 16, f"stg_{path[-8:]}")
    rec = t["recommendations"].groupBy("lmk_key").agg(F.count(F.lit(1)).alias("recommendations"), F.min("improvement_item").alias("first_item"))
    by_key = t["certificates"].select("lmk_key", "uprn", "lodgement_date").join(rec, "lmk_key", "left")
    feeds = t["addresses"].groupBy("uprn").agg(F.count_if(F.col("os_api_source") == "DPA").alias("dpa"), F.count_if(F.col("os_api_source") == "LPI").alias("lpi"))
    by_property = t["certificates_by_property"].filter("uprn <> ''").select("lmk_key", "uprn").join(feeds, "uprn").select("lmk_key", "dpa", "lpi")
    found = by_key.join(by_property, "lmk_key", "left")
    return found.select("lmk_key", "uprn", "recommendations", "first_item", F.coalesce("dpa", F.lit(0)).alias("dpa"), F.coalesce("lpi", F.lit(0)).alias("lpi"))
