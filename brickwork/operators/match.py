"""Fuzzy address matching as Spark join jobs.

Block match.  Every left row (address text + postcode) looks for the best address text in its postcode
district.  The reference tests ``right_postcode.contains(district)``; for a well-formed postcode that is
equality with one of a few keys of the right row, so the search is an equi-join.

The score (Y3) is the weight of the shared tokens as a share of the left row's whole weight; a token weighs
``1 / df``, ``df`` being the number of distinct right texts that hold it (1 for a token that none holds).  Only
texts with a shared token score above 0.  A single token, even a row's rarest, is in ever more texts as the gazetteer
grows, so texts are indexed by the *pairs* of their tokens in a district, and a row pays for rare pairs only:

1. the rarest pair of its tokens that some text of the district holds brings the first candidates; their best weight, or
   that of its rarest known token, is a floor;
2. a text that reaches the floor has a first and a second shared token (from rare to frequent).  The row probes every
   pair that can be those two: the weight of the first, the second and all after it reaches the floor.  A text
   that shares one token only is probed by that token, if it alone reaches the floor.

Index, probes and candidates are rows of numbers; texts are fetched for the candidates' score and for ties at the top.

The winner has the highest Y3, then Y1 (``weighted_ratio``, computed for ties at the top only), then the smallest text.  A left
row that shares no token with its district is not matched.  The reference first narrows the search to part of
the district and to its 500 best texts by Y1; those limits only save time there and are not reproduced.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import ratio, token_sort_text, tokens, weighted_ratio, wratio
from ..functions.text import outward_code
from ..session import SMALL_TEXTS, cut_lineage, shuffled, small_side, written


def district_block_keys(postcode) -> F.Column:
    """Every substring (length >= 2) of the outward code: ``HU2`` also finds ``HU20``, as containment does."""
    pc = F.col(postcode) if isinstance(postcode, str) else postcode
    out = outward_code(pc)
    n = F.length(out)
    starts = F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1)))
    subs = F.flatten(
        F.transform(
            starts,
            lambda s: F.transform(F.sequence(F.lit(2), F.greatest(n - s + 1, F.lit(2))), lambda ln: F.substring(out, s, ln)),
        )
    )
    return F.array_distinct(F.filter(subs, lambda k: F.length(k) >= 2))


def _round(c, digits: int = 9):
    return F.round(c, digits)


def block_match(
    left: DataFrame,
    right: DataFrame,
    *,
    left_text: str = "text",
    left_postcode: str = "postcode",
    right_text: str = "address",
    right_postcode: str = "postcode",
) -> DataFrame:
    """Best right text per distinct ``(left_text, left_postcode)``:
    ``(l_text, l_postcode, matched_text, score_y1, score_y3)``."""
    key = ["l_text", "l_postcode"]
    L = left.select(F.col(left_text).alias("l_text"), F.col(left_postcode).alias("l_postcode"))
    L = L.filter(F.col("l_text").isNotNull() & F.col("l_postcode").isNotNull()).distinct()
    L = written(L.withColumns({"bkey": outward_code("l_postcode"), "l_id": F.monotonically_increasing_id()}))
    R = right.select(F.col(right_text).alias("r_text"), district_block_keys(right_postcode).alias("bkeys")).filter(F.col("r_text").isNotNull())
    df = R.filter(F.size("bkeys") > 0).select("r_text").distinct().select(F.explode(tokens("r_text")).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    df = small_side(cut_lineage(df), SMALL_TEXTS)
    asked = small_side(cut_lineage(L.select("bkey").distinct()))
    R = R.select("r_text", F.explode("bkeys").alias("bkey")).join(asked, "bkey", "left_semi").distinct()
    R = written(R.withColumns({"r_tokens": tokens("r_text"), "r_id": F.monotonically_increasing_id()}))
    known = R.select("bkey", F.explode("r_tokens").alias("token")).distinct().withColumn("known", F.lit(True))
    known = small_side(cut_lineage(known), SMALL_TEXTS)

    # left tokens that the district knows, rarest first, each with the weight that it and those after it can still add
    held = L.select("l_id", "bkey", F.explode(tokens("l_text")).alias("token")).join(df, "token", "left").join(known, ["bkey", "token"], "left")
    held = held.withColumn("w", F.lit(1.0) / F.coalesce("df", F.lit(1)))
    light = F.when(F.col("known"), F.struct((-F.col("w")).alias("w"), "token"))
    W = held.groupBy("l_id", "bkey").agg(F.sum("w").alias("total"), F.array_sort(F.collect_list(light)).alias("ts")).filter(F.size("ts") > 0)
    after = lambda i: F.aggregate(F.slice("ts", i + 1, F.size("ts")), F.lit(0.0), lambda acc, x: acc - x["w"])
    W = W.withColumn("ts", F.transform("ts", lambda t, i: F.struct(t["token"].alias("token"), (-t["w"]).alias("w"), after(i).alias("rest"))))
    W = written(W)

    def probe(*tokens_):
        return F.xxhash64("bkey", F.least(*tokens_), F.greatest(*tokens_))

    def pairs_of(rows: DataFrame, array: str, *keep: str) -> DataFrame:
        """Every two of a row's tokens, as ``a`` and ``b`` in the order of the array."""
        one = rows.select(*keep, "bkey", array, F.posexplode(array).alias("i", "a"))
        return one.select(*keep, "bkey", "a", F.explode(F.slice(array, F.col("i") + 2, F.size(array))).alias("b"))

    index = pairs_of(R, "r_tokens", "r_id").select("r_id", probe("a", "b").alias("h"))
    lengths = index.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    tried = pairs_of(W, "ts", "l_id").select("l_id", probe("a.token", "b.token").alias("h"))
    start = cut_lineage(tried.join(shuffled(lengths), "h").groupBy("l_id").agg(F.min_by("h", F.struct("n", "h")).alias("h")))

    def scored(candidates: DataFrame, rows: DataFrame) -> DataFrame:
        weights = rows.withColumn("l_w", F.map_from_entries(F.transform("ts", lambda t: F.struct(t["token"], t["w"])))).drop("ts", "bkey")
        shared = F.aggregate("r_tokens", F.lit(0.0), lambda acc, t: acc + F.coalesce(F.try_element_at("l_w", t), F.lit(0.0)))
        return candidates.join(shuffled(R.select("r_id", "r_tokens")), "r_id").join(shuffled(weights), "l_id").withColumn("weight", shared).drop("r_tokens", "l_w")

    first = cut_lineage(scored(start.join(shuffled(index), "h").select("l_id", "r_id"), W.select("l_id", "ts")).select("l_id", "r_id", "weight"))
    floor = F.greatest(F.col("ts")[0]["w"], F.coalesce("best", F.lit(0.0)))
    # scores are compared at nine digits, so what is less than that below the floor can be its equal
    least = floor - 2e-9 * (1 + F.col("total"))
    W = W.join(shuffled(first.groupBy("l_id").agg(F.max("weight").alias("best"))), "l_id", "left").join(shuffled(start), "l_id", "left")
    W = cut_lineage(W.select("l_id", "bkey", "total", "ts", least.alias("least"), "h"))
    more = pairs_of(W, "ts", "l_id", "least", "h").filter(F.col("a.w") + F.col("b.rest") >= F.col("least"))
    more = more.select("l_id", probe("a.token", "b.token").alias("p"), "h").filter(~F.col("p").eqNullSafe(F.col("h")))
    candidates = more.select("l_id", F.col("p").alias("h")).join(shuffled(index), "h").select("l_id", "r_id")
    alone = W.select("l_id", "bkey", "least", F.explode("ts").alias("a")).filter(F.col("a.w") >= F.col("least"))
    if not alone.isEmpty():
        holders = R.select("r_id", "bkey", F.explode("r_tokens").alias("token"))
        candidates = candidates.unionByName(alone.select("l_id", "bkey", "a.token").join(shuffled(holders), ["bkey", "token"]).select("l_id", "r_id"))
    second = scored(candidates.distinct(), W.select("l_id", "ts", "least")).filter("weight >= least").select("l_id", "r_id", "weight")

    pairs = first.unionByName(second).join(shuffled(W.select("l_id", "total", "least")), "l_id").filter("weight >= least")
    pairs = pairs.withColumn("score_y3", _round(F.col("weight") / F.col("total")))
    top = pairs.withColumn("_m", F.max("score_y3").over(Window.partitionBy("l_id"))).filter(F.col("score_y3") == F.col("_m"))
    top = top.select("l_id", "r_id", "score_y3").join(shuffled(R.select("r_id", "r_text")), "r_id").join(shuffled(L.select("l_id", *key)), "l_id")
    y1 = _round(weighted_ratio("l_text", "r_text"))
    ordering = F.struct((-F.col("score_y1")).alias("a"), F.col("r_text").alias("b"))
    best = top.withColumn("score_y1", y1).groupBy(*key).agg(F.min_by(F.struct("r_text", "score_y1", "score_y3"), ordering).alias("w"))
    return best.select(*key, F.col("w.r_text").alias("matched_text"), F.col("w.score_y1").alias("score_y1"), F.col("w.score_y3").alias("score_y3"))


# ---- unblocked best match with a score threshold (J8/J9) ----------------------
#
# An exact search for the best right text of every left text, at any threshold, best first:
#
# 1. A left text's rarest words and pairs of words bring a few right texts; the best score among them is the row's floor
#    (the threshold, where there is none).  A floor only saves work.
# 2. Whatever scores as high as the floor is at most d edits away, and an edit changes at most one character and two bigrams
#    on either side.  A text's signature has a bit for each of the occurrences that tell right texts apart best, so a
#    pair whose signatures miss more than 2d bigrams or d characters of one another is out.
# 3. Right texts with like signatures are put in groups.  A left text passes by a whole group if it misses that many of the
#    bits that every member has, or has that many that no member has; only the members of the other groups are
#    looked at one by one, and only those within d edits leave the task.
#
# Left slices meet right blocks of bounded size; no pair is shuffled before it reached the floor.  The search stays quadratic in
# kind: every left text looks at every group, though at few members.

#: A word or pair of words that more right texts hold brings no first candidates.
FIRST_TEXTS = 500
#: Words and pairs of words that bring first candidates; those after the rarest only to rows with a floor below this.
FIRST_PARTS, GOOD_FLOOR = 8, 85.0
#: Longs of a signature by length of the grams (bigrams, characters), texts in a group, right texts in a block.
LONGS, GROUP, BLOCK = {2: 4, 1: 2}, 64, 200_000
SIGNATURE = [f"m{q}{w}" for q, longs in LONGS.items() for w in range(longs)]


def _grams(rows: DataFrame) -> DataFrame:
    """``(id, gram, n)``: how often ``s`` holds each of its bigrams and characters; needs no shuffle but that by ``id``."""
    places = lambda q: F.sequence(F.lit(1), F.greatest(F.length("s") - (q - 1), F.lit(1)))
    of = lambda q: F.transform(places(q), lambda i: F.substring("s", i, q))
    grams = F.concat(*[of(q) for q in LONGS])
    found = rows.filter(F.length("s") > 0).select("id", "s").repartition("id").select("id", F.explode(grams).alias("gram"))
    return found.groupBy("id", "gram").agg(F.count(F.lit(1)).cast("int").alias("n"))


def _signature_bits(R: DataFrame, n_right: int) -> DataFrame:
    """``(gram, k, longs)``: the grams whose k-th occurrence is nearest to being in half of the right texts, a bit each."""
    held = _grams(R).groupBy("gram", "n").agg(F.count(F.lit(1)).alias("texts"))
    held = held.select("gram", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("k"), "texts").groupBy("gram", "k").agg(F.sum("texts").alias("texts"))
    held = cut_lineage(held)
    rows = []
    for q, longs in LONGS.items():
        best = held.filter(F.length("gram") == q).orderBy(F.abs(2 * F.col("texts") - n_right), "gram", "k").limit(64 * longs).collect()
        for i, r in enumerate(best):
            bit = -(2**63) if i % 64 == 0 else 1 << (63 - i % 64)
            rows.append((r.gram, r.k, *(bit if name == f"m{q}{i // 64}" else 0 for name in SIGNATURE)))
    return R.sparkSession.createDataFrame(rows, "gram string, k int, " + ", ".join(f"{name} long" for name in SIGNATURE))


def _signed(rows: DataFrame, bits: DataFrame) -> DataFrame:
    """``rows`` with the signature of ``s``."""
    have = _grams(rows).join(F.broadcast(bits), "gram").filter("k <= n").groupBy("id").agg(*[F.bit_or(name).alias(name) for name in SIGNATURE])
    return rows.join(shuffled(have), "id", "left").withColumns({name: F.coalesce(name, F.lit(0).cast("long")) for name in SIGNATURE})


def _apart(differing) -> F.Column:
    """Four times the edits that two texts are apart at least, by the bits that differ: an edit changes ``q`` grams on both sides."""
    counts = {q: reduce(add, [F.bit_count(differing(f"m{q}{w}")) for w in range(longs)]) for q, longs in LONGS.items()}
    return F.greatest(counts[2], 2 * counts[1])


def _within(L: DataFrame, R: DataFrame) -> DataFrame:
    """``(l_id, r_id)`` of all texts ``s`` whose edit distance is at most the left row's ``c`` of the longer length."""
    n_right = R.count()
    bits = _signature_bits(R, n_right)
    L = _signed(L, bits).select(F.col("id").alias("l_id"), F.col("s").alias("l_s"), "c", F.length("s").alias("n"), *[F.col(c).alias(f"l_{c}") for c in SIGNATURE])
    R = _signed(R, bits).orderBy(*SIGNATURE, "s").withColumn("g", F.shiftright(F.monotonically_increasing_id(), GROUP.bit_length() - 1))
    member = F.struct(F.col("id").alias("r_id"), F.col("s").alias("r_s"), F.length("s").alias("m"), *[F.col(c).alias(f"r_{c}") for c in SIGNATURE])
    groups = R.groupBy("g").agg(
        *[F.bit_or(c).alias(f"any_{c}") for c in SIGNATURE],
        *[F.bit_and(c).alias(f"all_{c}") for c in SIGNATURE],
        F.min(F.length("s")).alias("shortest"),
        F.max(F.length("s")).alias("longest"),
        F.collect_list(member).alias("members"),
    )
    # a cell is a block of groups with a slice of the left rows
    blocks = -(-n_right // BLOCK)
    slices = -(-3 * L.sparkSession.sparkContext.defaultParallelism // blocks)
    cell = (F.col("block") * slices + F.col("slice")).cast("int").alias("cell")
    part = lambda key, k: F.pmod(F.xxhash64(key), F.lit(k))
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    groups = groups.withColumn("block", part("g", blocks)).withColumn("slice", every(slices)).select("*", cell).drop("g", "block", "slice")
    L = L.withColumn("slice", part("l_id", slices)).withColumn("block", every(blocks)).select("*", cell).drop("block", "slice")
    groups, L = groups.repartition(blocks * slices, "cell"), L.repartition(blocks * slices, "cell")

    edits = lambda length: F.floor(F.col("c") * F.greatest(F.col("n"), F.col(length)) + 1e-6).cast("int")
    lacks = lambda has, other: F.col(has).bitwiseAND(F.bitwise_not(F.col(other)))
    certain = _apart(lambda c: lacks(f"l_{c}", f"any_{c}").bitwiseOR(lacks(f"all_{c}", f"l_{c}")))
    near = (F.col("shortest") - F.col("n") <= edits("shortest")) & (F.greatest(certain, 4 * (F.col("n") - F.col("longest"))) <= 4 * edits("longest"))
    met = L.join(groups.hint("shuffle_hash"), "cell").filter(near).select("l_id", "l_s", "c", "n", *[f"l_{c}" for c in SIGNATURE], F.inline("members"))
    differ = _apart(lambda c: F.col(f"l_{c}").bitwiseXOR(F.col(f"r_{c}")))
    alike = F.greatest(differ, 4 * F.abs(F.col("n") - F.col("m"))) <= 4 * edits("m")
    return met.filter(alike).filter(F.call_function("levenshtein", F.col("l_s"), F.col("r_s"), edits("m")) >= 0).select("l_id", "r_id")


def _floors(L: DataFrame, R: DataFrame, score, threshold: float) -> DataFrame:
    """``L`` with ``floor``: the best score among the right texts that share a row's rarest word or pair of words, or
    one of the next rarest where that is poor."""

    def parts(rows: DataFrame, key: str, text: str) -> DataFrame:
        one = rows.select(key, tokens(text).alias("words")).select(key, "words", F.posexplode("words").alias("i", "a"))
        two = one.select(key, "a", F.explode(F.slice("words", F.col("i") + 1, F.size("words"))).alias("b"))
        return two.select(key, F.xxhash64(F.least("a", "b"), F.greatest("a", "b")).alias("h"))

    index = parts(R, "r_id", "r_text")
    rare = index.groupBy("h").agg(F.count(F.lit(1)).alias("df")).filter(F.col("df") <= FIRST_TEXTS)
    asked = parts(L, "l_id", "l_text").join(shuffled(rare), "h")
    asked = asked.withColumn("place", F.row_number().over(Window.partitionBy("l_id").orderBy("df", "h"))).filter(F.col("place") <= FIRST_PARTS)
    asked = cut_lineage(asked.select("l_id", "h", "place"))

    def raised(rows: DataFrame, by: DataFrame) -> DataFrame:
        tried = by.join(shuffled(index), "h").select("l_id", "r_id").distinct().join(shuffled(R), "r_id").join(shuffled(L), "l_id")
        return rows.join(shuffled(tried.groupBy("l_id").agg(F.max(score).alias("first"))), "l_id", "left").withColumn("floor", F.greatest("floor", "first")).drop("first")

    L1 = cut_lineage(raised(L.withColumn("floor", F.lit(float(threshold))), asked.filter("place = 1")))
    poor = L1.filter(F.col("floor") < GOOD_FLOOR).select("l_id")
    return raised(L1, asked.filter("place > 1").join(shuffled(poor), "l_id", "left_semi"))


def match_pairs(left: DataFrame, right: DataFrame, left_text: str, right_text: str, threshold: float, scorer: str) -> tuple[DataFrame, object]:
    """The pairs whose scores have to be computed, (l_text, l_sorted, r_text, r_sorted), once each, and the score."""
    L = left.select(F.col(left_text).alias("l_text")).filter(F.col("l_text").isNotNull()).distinct().withColumn("l_sorted", token_sort_text("l_text"))
    R = right.select(F.col(right_text).alias("r_text")).filter(F.col("r_text").isNotNull()).distinct().withColumn("r_sorted", token_sort_text("r_text"))
    L, R = written(L.withColumn("l_id", F.monotonically_increasing_id())), written(R.withColumn("r_id", F.monotonically_increasing_id()))
    if scorer == "wratio":
        score, terms = wratio("l_text", "r_text", "l_sorted", "r_sorted"), [("l_text", "r_text", 100.0), ("l_sorted", "r_sorted", 95.0)]
    elif scorer == "token_sort":
        score, terms = ratio("l_sorted", "r_sorted"), [("l_sorted", "r_sorted", 100.0)]
    else:
        raise ValueError(scorer)
    L = cut_lineage(_floors(L, R, score, threshold))
    found = L.join(shuffled(R), (F.length("l_sorted") == 0) & (F.col("l_sorted") == F.col("r_sorted"))).select("l_id", "r_id")
    for l_col, r_col, most in terms:
        c = 1 - (F.col("floor") - 1e-6) / most
        reachable = L.filter((F.length(l_col) > 0) & (c >= 0)).select(F.col("l_id").alias("id"), F.col(l_col).alias("s"), c.alias("c"))
        if not reachable.isEmpty() and not R.isEmpty():
            found = found.unionByName(cut_lineage(_within(reachable, R.select(F.col("r_id").alias("id"), F.col(r_col).alias("s")))))
    pairs = found.distinct().join(shuffled(R), "r_id").join(shuffled(L.select("l_id", "l_text", "l_sorted")), "l_id")
    return pairs.select("l_text", "l_sorted", "r_text", "r_sorted"), score


def best_match(
    left: DataFrame,
    right: DataFrame,
    *,
    left_text: str = "text",
    right_text: str = "text",
    threshold: float = 80.0,
    scorer: str = "wratio",
) -> DataFrame:
    """Best right text with score strictly above ``threshold`` (0 or more) per distinct left text, over all right
    texts (no block).  ``scorer`` is ``wratio`` (max of ratio and 0.95 x token-sort ratio) or ``token_sort``.
    Ties go to the smallest text; NULL texts match nothing."""
    if threshold < 0:
        raise ValueError("the threshold must not be negative")
    pairs, score = match_pairs(left, right, left_text, right_text, threshold, scorer)
    scored = pairs.select("l_text", "r_text", _round(score).alias("score")).filter(F.col("score") > threshold)
    ordering = F.struct((-F.col("score")).alias("a"), F.col("r_text").alias("b"))
    best = scored.groupBy("l_text").agg(F.min_by(F.struct("r_text", "score"), ordering).alias("w"))
    return best.select("l_text", F.col("w.r_text").alias("matched_text"), F.col("w.score").alias("score"))
