"""The corpus pipeline: language ID, line dedup, near-duplicate removal, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the
next stage's documents.  All but the last return the columns of ``documents``.  SQL can't express the first, third
and last stage, so there is no SQL twin; tests hold the stages against brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brickwork.llm import jaccard, langid, lines, packing
from brickwork.llm.common import Stage, free_name, read, small_side

#: Words that a Python worker remembers: it also holds what the stages before have left.
WORDS = 200_000
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised.  NULL texts, texts without letters and texts that fit their best
    language less than the floor that labelled texts set (``langid.floor_score``) go; without labels none is
    recognised.  Repeated rows and ids are judged row by row."""
    profiles = langid.learn(docs)
    pred, score = free_name(docs.columns, "lang_pred"), free_name(docs.columns, "lang_score")
    found = langid.identify(docs, profiles, pred=pred, score=score)
    known = (F.col(pred) != langid.UNKNOWN) & (F.col(score) >= langid.floor_score(docs, profiles))
    return found.filter(known).select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that a larger id repeats (20 code points, three documents), and ``n_chars`` as
    it is then.  NULL texts become empty, documents of one id count as one to the rule."""
    n_lines, n_dropped = free_name(docs.columns, "n_lines"), free_name(docs.columns, "n_dropped")
    clean = lines.dedup_lines(docs, n_lines=n_lines, n_dropped=n_dropped)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that a 5-word shingle similarity of 0.8 links: the one of the smallest id (NULL
    ids last, then by a hash of the text).

    Rows are told apart by id and text, so a link of one row never drops another text of the same id; of rows equal
    in both, one stays.  Texts without words are linked with nothing and all stay, but for equal rows of one id."""
    key = free_name(docs.columns, "row_key")
    keyed = docs.withColumn(key, F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text"))
    found = jaccard.join_components(keyed.select(F.col(key).alias("key"), "text"), id="key", words=5, num=8, den=10)
    rows = Stage(found.select(F.col("doc_id").alias("key"), "component_id"), "pipeline-components").df
    named = rows.groupBy("key").agg(F.min("component_id").alias("component"), F.count(F.lit(1)).alias("copies"))
    ids = keyed.select(F.col(key).alias("key"), "doc_id").distinct()
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")
    chosen = named.join(ids, "key").groupBy("component").agg(F.min(place)["key"].alias("first"))
    marked = named.join(chosen, "component").select("key", (F.col("key") != F.col("first")).alias("linked"), (F.col("copies") > 1).alias("repeated"))
    marked = Stage(marked.filter("linked OR repeated"), "pipeline-marked").df
    gone = small_side(marked.filter("linked").select(F.col("key").alias(key)))
    left = keyed.join(gone, key, "left_anti")
    twice = small_side(marked.filter("repeated").select(F.col("key").alias(key)))
    once = left.join(twice, key, "left_anti").unionByName(left.join(twice, key, "left_semi").dropDuplicates([key]))
    return once.select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token windows, with their ids; a NULL text has the end id alone."""
    return packing.pack_documents(docs, VOCABULARY, memory=WORDS)


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = Stage(stage(spark, docs, sf_dir), "pipeline-" + name.lower().replace(" ", "-")).df
    return docs
