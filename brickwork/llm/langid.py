"""Language ID by rank-order profiles of n-grams.

A text's letters are lower-cased and put into words, each between blanks; its n-grams of 1 to 5
characters stay inside a word and its blanks.  A language's profile is the list of the ``TOP`` most frequent
n-grams of its labelled documents.  A document's own list is held against each profile: an n-gram at place
i there and place j in the profile is |i - j| out of place, one that the profile lacks ``TOP``.  The
language with the smallest sum wins (ties: the smaller name).  The score is 1 less the sum's share of
the largest possible one.

Profiles are fitted on a bounded sample: the ``per_lang`` labelled documents of each language that a hash
of their id puts first.  Everything else covers all documents and whole texts.

Defined cases: a NULL text or one without letters is ``und`` with score 0, as is every text when nothing was
learned; rows without a label are predicted but never learned from; a NULL id is never learned from; an
empty table gives no rows; columns named like the two outputs are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from brickwork.llm.common import Stage, remembered, small_side, tidied

TOP, ORDERS, PER_LANG = 300, 5, 500
UNKNOWN = "und"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return remembered("letters", lambda: np.array([chr(c).isalpha() for c in range(0x110000)]))


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a text's n-grams, ascending, and their counts."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = _letters()[codes]
    if not is_letter.any():
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    # a word's first blank is the last blank of the word before; runs of other characters are one blank
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    line = np.concatenate([[32], np.where(is_letter, codes, 32)[keep], [32]]).astype(np.uint64)
    blank = line == 32
    passed = np.cumsum(blank)
    with np.errstate(over="ignore"):
        grams = line * _MIX
        found = [grams[~blank]]
        for n in range(2, min(ORDERS, len(line)) + 1):
            grams = (grams[:-1] ^ (grams[:-1] >> np.uint64(29))) * _MIX + line[n - 1 :] * np.uint64(2 * n + 1)
            one_word = passed[n - 2 : len(line) - 1] == passed[: len(line) - n + 1] if n > 2 else ~(blank[:-1] & blank[1:])
            found.append(grams[one_word])
    keys = np.concatenate(found)
    keys.sort()
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.diff(np.concatenate([first, [len(keys)]]))


def top_ranked(keys: np.ndarray, counts: np.ndarray, top: int = TOP) -> np.ndarray:
    """The most frequent keys, best first; ties by key."""
    if len(keys) > 4 * top:
        least = np.partition(counts, len(counts) - top)[len(counts) - top]
        likely = counts >= least
        keys, counts = keys[likely], counts[likely]
    return keys[np.lexsort((keys, -counts))[:top]]


class Profiles:
    """Places of all profile n-grams by language."""

    def __init__(self, ranked: dict[str, list[int]]):
        self.langs = sorted(ranked)
        self.keys = np.unique(np.array([k for ks in ranked.values() for k in ks], np.uint64))
        self.places = np.full((len(self.keys) + 1, len(self.langs)), -1, np.int64)
        for j, lang in enumerate(self.langs):
            at = np.searchsorted(self.keys, np.array(ranked[lang], np.uint64))
            self.places[at, j] = np.arange(len(at))

    def predict(self, text: str | None) -> tuple[str, float]:
        keys, counts = ngrams(text) if text else ((), ())
        if not len(keys) or not self.langs:
            return UNKNOWN, 0.0
        own = top_ranked(keys, counts)
        at = np.searchsorted(self.keys, own)
        at[at == len(self.keys)] = 0
        at = np.where(self.keys[at] == own, at, len(self.keys))
        places = self.places[at]
        out = np.where(places < 0, TOP, np.abs(places - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(np.argmin(out))
        return self.langs[best], 1.0 - float(out[best]) / (TOP * len(own))


def _count(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        by_lang: dict[str, list] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            by_lang.setdefault(lang, []).append(ngrams(text))
        for lang, parts in by_lang.items():
            keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            n = np.bincount(where, np.concatenate([c for _, c in parts]), len(keys)).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(keys), pa.string()), "key": pa.array(keys.view(np.int64)), "n": pa.array(n)})


def learnable(id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves a remainder by 5."""
    return F.crc32(F.col(id).cast("string").cast("binary")) % 5 != 0


def learn(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", per_lang: int = PER_LANG) -> Profiles:
    """Profiles from at most ``per_lang`` documents of each label."""
    labelled = docs.select(F.col(id).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text")).filter(learnable("id") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    order = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id"))
    chosen = Stage(labelled.select("id", "lang").distinct().withColumn("r", order).filter(F.col("r") <= per_lang).select("id", "lang"), "langid-sample").df
    sample = labelled.join(small_side(chosen), ["id", "lang"], "left_semi").select("lang", "text")
    counts = sample.mapInArrow(_count, "lang string, key bigint, n bigint").groupBy("lang", "key").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "key"))
    best = counts.withColumn("place", place).filter(F.col("place") <= TOP).select("lang", "key", "place")
    ranked: dict[str, list] = {}
    for row in best.collect():  # TOP rows a language
        ranked.setdefault(row.lang, []).append((row.place, row.key))
    return Profiles({k: [int(np.int64(key).astype(np.uint64)) for _, key in sorted(v)] for k, v in ranked.items()})


#: The share of the lowest scores of labelled documents that the floor may be, and one in how many is left out.
FLOOR_SHARE, FLOOR_LEFT_OUT = 0.75, 1_000


def floor_score(docs: DataFrame, profiles: Profiles, id: str = "doc_id", text: str = "text", lang: str = "lang") -> float:
    """The score below which a text is in none of the learned languages: three quarters of what all but one in a
    thousand labelled documents reach that no profile was learned from.  0 if there are none.

    Fitted on all of those documents, with their exact place in the order of scores."""
    labelled = docs.select(F.col(id).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text")).filter(~learnable("id") & F.col("lang").isin(profiles.langs))
    found = identify(labelled.filter("text IS NOT NULL").select("lang", "text"), profiles, pred="pred", score="score").filter("pred = lang")
    scores = Stage(found.select("score"), "langid-floor").df
    place = -(-scores.count() // FLOOR_LEFT_OUT)
    low = scores.orderBy("score").limit(place).agg(F.max("score")).first()[0]
    return FLOOR_SHARE * low if low is not None else 0.0


def identify(docs: DataFrame, profiles: Profiles, text: str = "text", pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score."""
    kept = [c for c in docs.columns if c not in (pred, score)]
    rows = docs.select(*kept)
    at = kept.index(text)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = [profiles.predict(t) for t in batch.column(at).to_pylist()]
            more = [pa.array([x for x, _ in found], pa.string()), pa.array([y for _, y in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*kept, pred, score])

    schema = StructType([*rows.schema.fields, StructField(pred, StringType()), StructField(score, DoubleType())])
    return rows.mapInArrow(lambda batches: tidied(run(batches)), schema)
