"""The pipeline's stages on repeated ids, NULLs, clashing columns, foreign texts and empty tables."""

import random

from pyspark.sql import functions as F

import corpus_pipeline as P

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SENTENCES = {
    "it": "Il gatto dorme sul divano mentre la pioggia cade lentamente sopra i tetti della città vecchia e le persone camminano in fretta verso casa per la cena",
    "pl": "Kot śpi na kanapie, a deszcz powoli pada na dachy starego miasta, gdy ludzie szybko idą do domu na kolację i rozmawiają o pogodzie",
    "tr": "Kedi kanepede uyuyor, yağmur yavaşça eski şehrin çatılarına yağıyor ve insanlar akşam yemeği için hızla eve yürüyorlar",
    "nl": "De kat slaapt op de bank terwijl de regen langzaam op de daken van de oude stad valt en de mensen snel naar huis lopen voor het avondeten",
    "ja": "猫はソファで眠り、雨は古い町の屋根にゆっくりと降っています",
}


def prose(rng, n=60):
    return " ".join("".join(rng.choice(["ka", "lo", "tri", "men", "so", "ra"]) for _ in range(rng.randrange(1, 5))) for _ in range(n))


def frame(spark, rows, extra=""):
    return spark.createDataFrame([(d, t, "en", "web", len(t or ""), *more) for d, t, *more in rows], SCHEMA + extra)


def test_near_duplicates_lose_no_text(spark):
    rng = random.Random(1)
    a, b, c = (prose(rng) for _ in range(3))
    rows = [(1, a), (2, a), (2, b), (9, b + " word"), (2, b), (None, a), (None, c), (None, c), (7, c), (5, None), (5, None), (6, ""), (8, "few words")]
    kept = [(r.doc_id, r.text) for r in P.near_duplicates(spark, frame(spark, rows), "").collect()]
    assert sorted(kept, key=str) == sorted([(1, a), (2, b), (7, c), (5, None), (6, ""), (8, "few words")], key=str)


def test_columns_with_clashing_names_stay(spark):
    rng = random.Random(2)
    names = ["lang_pred", "_lang_pred", "Lang_Score", "n_lines", "n_dropped", "row_key", "key", "component", "copies"]
    line = "a line of prose that three documents have in common"
    rows = [(i, f"{prose(rng)}\n{line}", *(f"{n}{i}" for n in names)) for i in range(60)]
    docs = frame(spark, rows, "".join(f", `{n}` string" for n in names))
    for _, stage in P.STAGES[:3]:
        after = stage(spark, docs, "")
        assert after.columns == docs.columns
        got = after.collect()
        assert got and all(r[n] == f"{n}{r.doc_id}" for r in got for n in names)


def test_foreign_texts_go_and_clean_ones_stay(spark):
    whole = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    foreign = frame(spark, [(10_000_000 + i, t) for i, t in enumerate(SENTENCES.values())]).withColumn("lang", F.lit(None).cast("string"))
    kept = {r.doc_id for r in P.language_id(spark, whole.unionByName(foreign.select(whole.columns)), "").select("doc_id").collect()}
    assert not {d for d in kept if d >= 10_000_000}
    clean = {r.doc_id for r in whole.filter("text RLIKE '[a-zA-Z]'").select("doc_id").collect()}
    assert len(clean - kept) <= len(clean) / 500


def test_empty_tables(spark):
    docs = frame(spark, [(1, "x")]).limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, docs, "").count() == 0
