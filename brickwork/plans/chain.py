"""The model DAG as function composition over one data directory.

feeds -> staging -> enrichment -> profiling (+ score) / measures / base-plus
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import distinct_rows
from ..session import cut_lineage
from ..sources.derived import load_feed
from . import staging
from .enrich import enrich_certificates
from .profiling import profile, with_sap_scores


def staged_certificates(spark: SparkSession, sf_dir: str, distinct: bool = True) -> DataFrame:
    both = staging.stage_certificates(load_feed(spark, sf_dir, "domestic_raw"), load_feed(spark, sf_dir, "non_domestic_raw"), distinct=False)
    return distinct_rows(both) if distinct else both


def staged_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_rows(staging.stage_addresses(load_feed(spark, sf_dir, "dpa_raw"), load_feed(spark, sf_dir, "lpi_raw"), distinct=False))


def staged_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_recommendations(load_feed(spark, sf_dir, "recommendations_raw"))


def enriched_certificates(spark: SparkSession, sf_dir: str, distinct: bool = True) -> DataFrame:
    return enrich_certificates(staged_certificates(spark, sf_dir, distinct), staged_addresses(spark, sf_dir))


def profiling_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per property: certificates landed twice cannot change it, so staging need not compare whole rows."""
    return profile(enriched_certificates(spark, sf_dir, distinct=False))


def profiling_sap_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_sap_scores(profiling_mart(spark, sf_dir))


def staging_tables(spark: SparkSession, sf_dir: str, path: str, buckets: int, prefix: str = "stg") -> dict[str, DataFrame]:
    """Staging as bucketed tables under ``path``, for the joins that the marts repeat: certificates and
    recommendations by certificate (J1, J11), certificates and both address feeds by property (J3, J4).
    The rows are wide and the joins read few of their columns, so they are bucketed without a shuffle or a sort."""
    from .. import sinks

    certificates = cut_lineage(staged_certificates(spark, sf_dir))
    feeds = {
        "certificates": (certificates, ["lmk_key"]),
        "certificates_by_property": (certificates, ["uprn"]),
        "recommendations": (staged_recommendations(spark, sf_dir), ["lmk_key"]),
        "addresses": (staged_addresses(spark, sf_dir), ["uprn"]),
    }
    return {name: sinks.save_bucketed(df, f"{prefix}_{name}", keys, buckets, f"{path.rstrip('/')}/{name}", sort=False) for name, (df, keys) in feeds.items()}


def build_marts(spark: SparkSession, sf_dir: str, out_dir: str, csv_exports: bool = False) -> dict[str, str]:
    """Run the whole model DAG once and write every mart under ``out_dir``.

    The enriched certificates feed two marts (profiling and measures), so
    they are computed once and cut from their lineage with a reliable
    checkpoint in the cluster's ``spark.checkpoint.dir`` (never a local
    checkpoint); without a configured directory the lineage is kept, which is
    still correct and recomputable after executor loss.
    """
    from .. import sinks
    from . import marts

    enriched = cut_lineage(enriched_certificates(spark, sf_dir))
    addresses = staged_addresses(spark, sf_dir)
    profiling = profile(enriched)
    outputs = {
        "address_profiling": profiling,
        "address_profiling_scored": with_sap_scores(profiling),
        "address_base": marts.base_plus(addresses),
        "improvement_measures": marts.measures_mart(
            marts.measures_base(enriched, staged_recommendations(spark, sf_dir), addresses, addresses_first=True)
        ),
    }
    orders = {"improvement_measures": [F.desc_nulls_last("UPRN"), F.asc_nulls_last("ImprovementIndex")]}
    paths = {}
    for name, df in outputs.items():
        path = f"{out_dir.rstrip('/')}/{name}"
        sinks.materialise(df, path, order=orders.get(name))
        if csv_exports:
            sinks.export(spark.read.parquet(path), f"{out_dir.rstrip('/')}/exports", name, order=orders.get(name))
        paths[name] = path
    return paths
