"""Rank-order profiles: n-grams and distances by hand, held-out accuracy, edge cases."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from brickwork.llm import langid
from brickwork.llm.queries import REGISTRY


def plain_grams(text):
    line = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
    found = Counter()
    for n in range(1, langid.ORDERS + 1):
        for i in range(len(line) - n + 1):
            gram = line[i : i + n]
            if gram != " " and " " not in gram[1:-1]:
                found[gram] += 1
    return found


@pytest.mark.parametrize("text", ["Ab c", "a a a", "hello, World 12 x", "é-É ß", "ab ab abc", "12x", "x!"])
def test_counts_match_plain_grams(text):
    _, counts = langid.ngrams(text)
    assert sorted(counts.tolist()) == sorted(plain_grams(text).values())


def test_distance_by_hand():
    keys = langid.ngrams("ab")[0]
    profiles = langid.Profiles({"x": keys.tolist(), "y": keys[::-1].tolist()})
    lang, score = profiles.predict("ab")
    own = langid.top_ranked(*langid.ngrams("ab"))
    places = {k: i for i, k in enumerate(keys.tolist())}
    out = sum(abs(places[k] - i) for i, k in enumerate(own.tolist()))
    assert (lang, score) == ("x", 1 - out / (langid.TOP * len(own)))


def test_top_ranked_ties():
    keys, counts = np.arange(5000, dtype=np.uint64), np.ones(5000, np.int64)
    counts[[7, 4000]] = 3
    assert langid.top_ranked(keys, counts)[:4].tolist() == [7, 4000, 0, 1]


def test_held_out_accuracy_and_whole_result(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = REGISTRY["op5_rank_order"](spark, "/root/testdata/sf0.001")
    rows = found.join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert found.count() == docs.count()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.9 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_nothing_learned_nulls_and_clashing_columns(spark):
    schema = "doc_id long, text string, lang string, score string, lang_pred int"
    docs = spark.createDataFrame([(1, "abc", None, "s", 1), (2, None, "en", "s", 1), (None, "abc", "en", "s", 1)], schema)
    rows = langid.identify(docs, langid.learn(docs)).collect()
    assert [(r.lang_pred, r.score) for r in rows] == [("und", 0.0)] * 3
    assert rows[0].asDict().keys() == {"doc_id", "text", "lang", "lang_pred", "score"}
    learned = spark.createDataFrame([(i, "the cat and the dog", "en") for i in range(9)] + [(9, "le chat et le chien", "fr")], "doc_id long, text string, lang string")
    profiles = langid.learn(learned)
    odd = spark.createDataFrame([(1, "123 !!"), (2, ""), (3, None), (4, "the " * 100_000)], "doc_id long, text string")
    assert [r.lang_pred for r in langid.identify(odd, profiles).collect()] == ["und", "und", "und", "en"]
    assert langid.identify(odd.limit(0), profiles).count() == 0


def test_the_floor_is_fitted_on_every_held_out_document(spark, monkeypatch):
    def found(docs, profiles, pred, score):
        return docs.select("*", F.col("lang").alias(pred), F.col("text").cast("double").alias(score))

    monkeypatch.setattr(langid, "identify", found)
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), (F.col("id") / 40_000).cast("string").alias("text"), F.lit("en").alias("lang"))
    scores = sorted(r.doc_id / 40_000 for r in docs.filter(~langid.learnable()).collect())
    place = -(-len(scores) // 1_000)
    assert langid.floor_score(docs, langid.Profiles({"en": [1]})) == langid.FLOOR_SHARE * scores[place - 1]
