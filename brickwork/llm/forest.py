"""Nearest neighbours by inner product over a hash-prefix forest.

Every tree rotates the vectors at random and writes down the order of their largest coordinates, with signs: a
string of up to 63 bits, of which near vectors share a long prefix.  A tree is the sorted array of all
strings, dealt in buckets of equal first bits.  A query descends in all trees at once: two binary
searches give the rows that share its first l bits, for each l.  Then all trees ascend in step, from
long prefixes to short, until together they hold ``share`` of the rows and at least ``least``; the rows
below that level are the candidates, and their inner products are taken in double precision.  Above its own
bucket a query meets the buckets beside it that share its bits; it meets all rows, in one tree, only where that
is no more work.  The queries of a bucket are dealt in blocks, its rows in chunks, and every two of them meet.

Inner product becomes nearness by one more coordinate that lengthens all vectors of a band of norms to the
largest norm there; bands are a factor of the root of two wide.  Each band has trees of its own, and a query ascends in
them to a level of its own, so that the few long vectors are searched as thoroughly as the many short ones; a band of at
most ``least`` rows is met whole.  Equal vectors are one class: it is searched once, and only its k + 1 smallest ids
can be in an answer.

How much is searched depends on the data: vectors without structure (random directions) need about a quarter
of all rows for a recall of 0.9, clustered ones far fewer; ``share`` and ``least`` are parameters.

Defined cases: vectors that are NULL, zero, empty or hold NULL or non-finite components take no part, nor do rows
with a NULL id; shorter vectors count as padded with zeros; rows that share an id are candidates of the others' queries each, but none of their own id's, which is one query;
with fewer candidates than k all are returned; a query without candidates has no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brickwork.llm.common import Stage, key_runs, small_side

TREES, SEED = 48, 7
SHARE, LEAST = 0.25, 2_000
#: Rows of a bucket, or of a chunk of a bucket.
BUCKET = 65_536
#: Queries of a block, and products held at once.
ASKED, PRODUCTS = 8_192, 1 << 22
KEY = ["tree", "bucket", "chunk", "block"]
LEVELS = 32


@lru_cache(maxsize=2)
def _rotations(dim: int, trees: int) -> np.ndarray:
    rng = np.random.default_rng(SEED)
    return np.stack([np.linalg.qr(rng.normal(size=(dim, dim)))[0] for _ in range(trees)])


def _digit_bits(dim: int) -> tuple[int, int]:
    """Bits of a coordinate and its sign, and how many such digits a string has."""
    bits = max(1, (dim - 1).bit_length()) + 1
    return bits, max(1, min(dim, 63 // bits))


def strings(vectors: np.ndarray, trees: int) -> np.ndarray:
    """Hash strings (rows by trees) of vectors, as non-negative integers, and their width by ``_digit_bits``."""
    dim = vectors.shape[1]
    bits, digits = _digit_bits(dim)
    out = np.zeros((len(vectors), trees), np.int64)
    rows = np.arange(len(vectors))[:, None]
    for t, rotation in enumerate(_rotations(dim, trees)):
        turned = vectors @ rotation
        size = np.abs(turned)
        best = np.argpartition(-size, min(digits, dim - 1), axis=1)[:, :digits]
        best = np.take_along_axis(best, np.argsort(-size[rows, best], axis=1, kind="stable"), axis=1)
        for d in range(digits):
            digit = best[:, d] * 2 + (turned[rows[:, 0], best[:, d]] > 0)
            out[:, t] = (out[:, t] << bits) | digit
    return out


def _matrix(column, dim: int) -> np.ndarray:
    """An Arrow list column as rows padded with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (lengths == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(lengths), dim))
    out[np.repeat(np.arange(len(lengths)), lengths), np.concatenate([np.arange(n) for n in lengths])] = flat
    return out


def _hash(batches: Iterator, dim: int, trees: int, longest: dict[int, float]) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            vectors = _matrix(pa.concat_arrays([part.column(2)]), dim)
            norm = np.sqrt((vectors * vectors).sum(axis=1))
            top = np.maximum(np.array([longest[b] for b in part.column(1).to_pylist()]), norm)
            tail = np.sqrt(np.maximum(top * top - norm * norm, 0))
            own = strings(np.concatenate([vectors, tail[:, None]], axis=1) / top[:, None], trees)
            asked = strings(np.concatenate([vectors / norm[:, None], np.zeros((len(norm), 1))], axis=1), trees)
            ends = pa.array(np.arange(len(norm) + 1, dtype=np.int32) * trees)
            lists = [pa.ListArray.from_arrays(ends, pa.array(h.ravel())) for h in (own, asked)]
            raw = pa.array([v.tobytes() for v in vectors], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), raw, *lists], names=["id", "band", "vector", "own", "asked"])


def _runs(frames: Iterator) -> Iterator:
    """For each (tree, bucket, chunk, block): rows of candidates sorted by string, and rows of queries."""
    for frame in key_runs(frames, KEY, 1):
        k = frame[KEY].to_numpy()
        bounds = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1).tolist(), len(frame)]
        for a, b in zip(bounds, bounds[1:]):
            part = frame.iloc[a:b]
            asks = part["asks"].to_numpy()
            yield part[~asks].sort_values(["hash", "id"]), part[asks]


def _range(have: np.ndarray, asked: np.ndarray, level: int | np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    shift = np.asarray(width - level, np.int64)
    low = (asked >> shift) << shift
    return np.searchsorted(have, low, "left"), np.searchsorted(have, low + (np.int64(1) << shift) - 1, "right")


def _descend(frames: Iterator, width: int, first: int, last: int) -> Iterator:
    """For each query and bucket, how many rows share its first bits, by the number of bits."""
    import pandas as pd

    for have, asks in _runs(frames):
        if not len(have) or not len(asks):
            continue
        strings_, asked = have["hash"].to_numpy(), asks["hash"].to_numpy()
        out = {"id": asks["id"].to_numpy(), "tree": asks["tree"].to_numpy()}
        for level in range(last + 1):
            if level < first:
                out[f"c{level}"] = np.zeros(len(asked), np.int64)
            else:
                low, high = _range(strings_, asked, level, width)
                out[f"c{level}"] = high - low
        yield pd.DataFrame(out)


def _score(frames: Iterator, width: int, k: int) -> Iterator:
    """The k nearest candidates of each query in each bucket."""
    import pandas as pd

    for have, asks in _runs(frames):
        if not len(have) or not len(asks):
            continue
        ids, vectors = have["id"].to_numpy(), np.stack([np.frombuffer(v, np.float64) for v in have["vector"]])
        asked = np.stack([np.frombuffer(v, np.float64) for v in asks["vector"]])
        long = np.linalg.norm(vectors, axis=1)
        low, high = _range(have["hash"].to_numpy(), asks["hash"].to_numpy(), asks["level"].to_numpy(), width)
        spans, of = np.unique(np.stack([low, high]), axis=1, return_inverse=True)
        of = of.ravel()
        qids = asks["id"].to_numpy()
        found: list[tuple] = []
        for s, (a, b) in enumerate(spans.T.tolist()):
            if a == b:
                continue
            every = np.flatnonzero(of == s)
            step = max(1, PRODUCTS // (b - a))
            for mine in (every[i : i + step] for i in range(0, len(every), step)):
                rough = asked[mine] @ vectors[a:b].T
                # all that may be among the k best or tie with them: the last bits of a matrix product depend on its shape
                margin = 4 * asked.shape[1] * np.finfo(float).eps * long[a:b].max() * np.linalg.norm(asked[mine], axis=1)
                least = np.partition(rough, max(b - a - k, 0), axis=1)[:, max(b - a - k, 0)] - margin
                for q, row in zip(mine.tolist(), (np.flatnonzero(r >= x) for r, x in zip(rough, least))):
                    exact = (vectors[a + row] * asked[q]).sum(axis=1)
                    order = np.lexsort((ids[a + row], -exact))[:k]
                    found.append((np.full(len(order), qids[q]), ids[a + row[order]], exact[order]))
        if found:
            yield pd.DataFrame({"query": np.concatenate([f[0] for f in found]), "id": np.concatenate([f[1] for f in found]), "score": np.concatenate([f[2] for f in found])})


def usable(vector: Column) -> Column:
    """Not NULL, no NULL or non-finite component, not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def meet(held: DataFrame, asks: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows and queries by ``KEY``: each chunk of a bucket with each block of the queries that ask it."""
    blocks = F.ceil(F.count(F.lit(1)) / ASKED).cast("int").alias("blocks")
    blocks = small_side(Stage(asks.groupBy("tree", "bucket").agg(blocks), "forest-blocks").df)
    sides = [
        held.join(blocks, ["tree", "bucket"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("asks", F.lit(False)),
        asks.join(blocks, ["tree", "bucket"]).join(sizes.select("tree", "bucket", "chunks"), ["tree", "bucket"])
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumn("asks", F.lit(True)),
    ]
    columns = [*KEY, "asks", *[c for c in asks.columns if c not in KEY]]
    rows, queries = (side.select(*columns) for side in sides)
    return rows.unionByName(queries).repartition(*KEY).sortWithinPartitions(*KEY)


def above(sizes: DataFrame, asking: DataFrame, first: int) -> DataFrame:
    """For each (tree, bucket), how many rows share its first bits, by the numbers of bits below ``first``."""
    buckets = sizes.select("tree", "bucket", "n").unionByName(asking.select("tree", "bucket", F.lit(0).cast("long").alias("n")).distinct())
    buckets = buckets.groupBy("tree", "bucket").agg(F.sum("n").alias("n"))
    shared = [F.sum("n").over(Window.partitionBy("tree", F.shiftright("bucket", first - i))).alias(f"c{i}") for i in range(1, first)]
    return buckets.select("tree", "bucket", *shared)


def asked_buckets(asking: DataFrame, levels: DataFrame, sizes: DataFrame, first: int, trees: int) -> DataFrame:
    """(tree, bucket, hash, id, vector, level) of the buckets that each query asks from its level on."""
    columns = ["tree", "bucket", "hash", "id", "vector", "level"]
    key = ["id", "band"]
    level = asking.select(*key).distinct().join(levels, key, "left").select(*key, F.coalesce("level", F.lit(0)).alias("level"))
    own = asking.join(level.filter(F.col("level") >= max(first, 1)), key).select(*columns)
    # at level 0 all rows, in the first tree of each band
    first_trees = sizes.filter(F.pmod("tree", F.lit(trees)) == 0).select("tree", "bucket")
    found = own.unionByName(asking.join(level.filter("level = 0"), key).filter("t = 0").drop("bucket").join(first_trees, "tree").select(*columns))
    if first < 2:
        return found
    prefix = F.expr(f"shiftright(bucket, {first} - level)").alias("prefix")
    beside = sizes.select("tree", "bucket", F.explode(F.sequence(F.lit(1), F.lit(first - 1))).alias("level")).select("tree", "bucket", "level", prefix)
    beside = small_side(Stage(beside, "forest-beside").df)
    climbing = asking.join(level.filter((F.col("level") > 0) & (F.col("level") < first)), key).select("tree", "hash", "id", "vector", "level", prefix)
    return found.unionByName(climbing.join(beside, ["tree", "level", "prefix"]).select(*columns))


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id: str = "vec_id",
    vector: str = "embedding",
    trees: int = TREES,
    share: float = SHARE,
    least: int = LEAST,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest found rows of each query, itself excepted.

    ``is_query`` is a condition on a column ``id``."""
    rows = vectors.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("v")))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    rows = rows.select("id", "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(7), "v").alias("h2"), norm.alias("norm"))
    rows = Stage(rows.withColumn("band", F.round(2 * F.log2("norm")).cast("int")), "forest-rows").df
    bands = {r.band: r.longest for r in rows.groupBy("band").agg(F.max("norm").alias("longest")).collect()}  # as many as powers of the root of two
    if not bands:
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.col("norm").alias("score")).limit(0)
    dim = rows.agg(F.max(F.size("v"))).first()[0]

    # equal vectors: the k + 1 smallest ids of each class
    place = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("id"))
    members = Stage(rows.withColumn("place", place).filter(F.col("place") <= k + 1), "forest-members").df
    classes = members.filter("place = 1")
    in_class = members.select("h1", "h2", F.col("id").alias("member"))
    queries = rows.filter(is_query).select("id", "h1", "h2")
    hashed = Stage(
        classes.select("id", "band", "v").repartition("id").mapInArrow(lambda b: _hash(b, dim, trees, bands), "id bigint, band int, vector binary, own array<bigint>, asked array<bigint>"),
        "forest-strings",
    ).df
    held_by = {r.band: r["count"] for r in hashed.groupBy("band").count().collect()}
    n = sum(held_by.values())
    bits, digits = _digit_bits(dim + 1)
    width = bits * digits
    first = min(max(0, (max(n, 1) - 1).bit_length() - BUCKET.bit_length() + 1), width)
    last = min(width, max(LEVELS, first))
    # what a query wants of each band; none is too few to be met at any level but 0, where all of the band is
    wants = {b: max(least, int(share * m)) if m > least else -1 for b, m in held_by.items()}
    of_band = lambda values: F.try_element_at(F.create_map(*[F.lit(x) for b, v in values.items() for x in (b, v)]), F.col("band"))

    bucket = F.shiftrightunsigned("hash", width - first).alias("bucket") if first else F.lit(0).cast("long").alias("bucket")
    held = hashed.select("id", "band", "vector", F.posexplode("own").alias("t", "hash")).select("id", (F.col("band") * trees + F.col("t")).alias("tree"), bucket, "hash", "vector")
    sizes = held.groupBy("tree", "bucket").agg(F.count(F.lit(1)).alias("n")).withColumn("chunks", F.ceil(F.col("n") / BUCKET).cast("int"))
    sizes = small_side(Stage(sizes, "forest-buckets").df)
    chunk = F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int").alias("chunk")
    held = held.join(sizes, ["tree", "bucket"]).select("tree", "bucket", chunk, "hash", "id", "vector")
    asking = hashed.join(queries.select("h1", "h2").distinct().join(classes.select("id", "h1", "h2"), ["h1", "h2"]).select("id"), "id", "left_semi")
    asking = asking.select("id", "vector", "asked", F.explode(F.array(*[F.lit(b) for b in sorted(bands)])).alias("band"))
    asking = Stage(asking.select("id", "vector", F.col("band"), F.posexplode("asked").alias("t", "hash")).select("id", "vector", "band", (F.col("band") * trees + F.col("t")).alias("tree"), "t", bucket, "hash"), "forest-queries").df

    light = meet(held.drop("vector"), asking.select("tree", "bucket", "hash", "id"), sizes)
    counts = light.mapInPandas(lambda f: _descend(f, width, first, last), "id bigint, tree int, " + ", ".join(f"c{i} bigint" for i in range(last + 1))).drop("c0")
    if first > 1:
        shared = small_side(Stage(above(sizes, asking, first), "forest-above").df)
        shared = asking.select("id", "tree", "bucket").join(shared, ["tree", "bucket"])
        counts = counts.unionByName(shared.select("id", "tree", *[f"c{i}" if i < first else F.lit(0).cast("long").alias(f"c{i}") for i in range(1, last + 1)]))
    counts = counts.groupBy("id", F.floor(F.col("tree") / trees).cast("int").alias("band")).agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(1, last + 1)])

    def place_at(i: int) -> Column:
        """Level i, or 0 where its buckets hold more rows than one tree."""
        return F.when(F.col(f"c{i}") < of_band(held_by), i).otherwise(0) if i < first else F.lit(i)

    wanted = of_band(wants)
    reached = F.coalesce(*[F.when((wanted >= 0) & (F.col(f"c{i}") >= wanted), place_at(i)) for i in range(last, 0, -1)], F.lit(0))
    levels = Stage(counts.select("id", "band", reached.alias("level")), "forest-levels").df
    asks = asked_buckets(asking, levels, sizes, first, trees)
    full = meet(held.withColumn("level", F.lit(0)), asks, sizes)
    near = full.mapInPandas(lambda f: _score(f, width, k + 1), "query bigint, id bigint, score double")
    best = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    near = near.groupBy("query", "id").agg(F.max("score").alias("score")).withColumn("r", best).filter(F.col("r") <= k + 1)

    # from classes back to rows
    names = classes.select("id", "h1", "h2")
    spread = near.select("query", "id", "score").join(names, "id").join(in_class, ["h1", "h2"]).select("query", "member", "score")
    order = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "member"))
    spread = spread.withColumn("r", order).filter(F.col("r") <= k + 1).select("query", "member", "score")
    asked_by = queries.join(names.withColumnRenamed("id", "query"), ["h1", "h2"]).select("query", F.col("id").alias("query_id")).distinct()
    answers = asked_by.join(spread, "query").filter("member <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "member"))
    return answers.select("query_id", rank.alias("rank"), F.col("member").alias("vec_id"), "score").filter(F.col("rank") <= k)
