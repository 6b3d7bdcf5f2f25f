"""Exact top-k by integer inner product over multi-resolution segment statistics.

Components become floor(1024 x).  A vector is cut into 1, 2, 4, ... equal segments; with the means m and
deviations s of segments of length w, the squared distance of two vectors is at least
w * sum((m - m')^2 + (s - s')^2), that is, their inner product is at most w * sum(m m' + s s').
Each query first meets one block of rows exactly, and its k-th score there is a floor for its answer.
In all other blocks bounds are taken from coarse to fine; a pair whose bound lies below the floor is out, and what
is left gets its exact product.

A stated set of queries meets all rows, block by block: tasks hold one block of queries and one of
rows.  Random directions are hardly pruned before the finest segments; the work is that of the bounds
and of exact products then, and the answer is the same.

Defined cases: vectors that are NULL or hold NULL or non-finite components take no part, nor do rows with a NULL id;
empty vectors are zero, shorter ones are padded with zeros; rows that share an id are candidates of the others' queries
each, but none of their own id's, which is one query; products beyond 2^53 are taken in whole numbers of any size and end at the limits of a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brickwork.llm.common import Stage, key_runs

BLOCK = 2_048
#: Share of live pairs from which bounds are taken for the whole block at once.
DENSE = 0.2
LONG = (1 << 63) - 1


def statistics(vectors: np.ndarray, parts: int) -> np.ndarray:
    """Means and deviations of the segments, scaled so that the product of two rows bounds the inner product."""
    n, dim = vectors.shape
    cut = vectors.reshape(n, parts, dim // parts)
    return np.concatenate([cut.mean(axis=2), cut.std(axis=2)], axis=1) * np.sqrt(dim // parts)


class Levels:
    """A block's vectors (padded to a power of two) and their statistics, coarse to fine."""

    def __init__(self, vectors: np.ndarray):
        dim = 1 << max(0, vectors.shape[1] - 1).bit_length()
        self.vectors = np.pad(vectors, ((0, 0), (0, dim - vectors.shape[1])))
        self.stats = [statistics(self.vectors, 1 << i) for i in range(max(1, dim.bit_length() - 1))]


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products (queries by rows) of whole numbers held as doubles."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(queries.shape[1], 1)
    if most < 2.0**53:
        return (queries @ rows.T).astype(np.int64)
    whole = np.array([[int(x) for x in q] for q in queries.tolist()], object) @ np.array([[int(x) for x in r] for r in rows.tolist()], object).T
    return np.clip(whole, -LONG - 1, LONG).astype(np.int64)


def search(queries: Levels, rows: Levels, floor: np.ndarray) -> list[np.ndarray]:
    """For each query, the rows whose bounds reach its floor at every level."""
    live = np.ones((len(queries.vectors), len(rows.vectors)), bool)
    for asked, have in zip(queries.stats, rows.stats, strict=True):
        if live.mean() > DENSE:
            bound = asked @ have.T
            live &= bound + 1e-9 * np.abs(bound) + 1e-6 >= floor[:, None]
        else:
            for i in range(len(live)):
                left = np.flatnonzero(live[i])
                bound = have[left] @ asked[i]
                live[i, left[bound + 1e-9 * np.abs(bound) + 1e-6 < floor[i]]] = False
    return [np.flatnonzero(row) for row in live]


def _meet(frames: Iterator, dim: int, k: int) -> Iterator:
    """The k best rows of each query in each pair of blocks."""
    import pandas as pd

    key = ["asked", "block"]
    for frame in key_runs(frames, key, 1):
        at = frame[key].to_numpy()
        bounds = [0, *(np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1).tolist(), len(frame)]
        for a, b in zip(bounds, bounds[1:]):
            part = frame.iloc[a:b]
            asks = part["asks"].to_numpy()
            if asks.all() or not asks.any():
                continue
            ids, vectors = part["id"].to_numpy(), np.stack([np.frombuffer(v, np.float64) for v in part["vector"]]).reshape(len(part), dim)
            queries, rows = Levels(vectors[asks]), Levels(vectors[~asks])
            qids, rids, floor = ids[asks], ids[~asks], part["floor"].to_numpy(np.float64)[asks]
            left = search(queries, rows, floor)
            out = []
            if sum(map(len, left)) > DENSE * len(qids) * len(rids):
                scores = products(queries.vectors, rows.vectors)
                exact = [scores[i, found] for i, found in enumerate(left)]
            else:
                exact = [products(queries.vectors[i : i + 1], rows.vectors[found])[0] for i, found in enumerate(left)]
            for q, found, score in zip(qids, left, exact, strict=True):
                other = rids[found] != q
                found, score = found[other], score[other]
                best = _best(rids[found], score, min(k, len(found)))
                out.append((np.full(len(best), q), rids[found][best], score[best]))
            yield pd.DataFrame({"query": np.concatenate([o[0] for o in out]), "id": np.concatenate([o[1] for o in out]), "score": np.concatenate([o[2] for o in out])})


def _best(ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if not k:
        return np.empty(0, np.int64)
    least = np.partition(score, len(score) - k)[len(score) - k]
    likely = np.flatnonzero(score >= least)
    order = sorted(likely.tolist(), key=lambda i: (-int(score[i]), int(ids[i])))[:k]
    return np.array(order, np.int64)


def _whole(batches: Iterator, dim: int) -> Iterator:
    """Vectors as rows of floor(1024 x)."""
    import pyarrow as pa

    for batch in batches:
        raw = []
        for v in batch.column(1).to_pylist():
            row = np.zeros(dim)
            row[: len(v)] = np.floor(1024.0 * np.array(v, np.float64))
            raw.append(np.nan_to_num(row).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], names=["id", "vector"])


def _top(found: DataFrame, k: int) -> DataFrame:
    order = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", order).filter(F.col("rank") <= k)


def top_products(vectors: DataFrame, is_query: Column, k: int = 10, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` highest integer inner products of each query with other rows.

    ``is_query`` is a condition on a column ``id``."""
    rows = vectors.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & finite)
    dim = max(rows.agg(F.max(F.size("v"))).first()[0] or 0, 1)
    whole = Stage(rows.mapInArrow(lambda b: _whole(b, dim), "id bigint, vector binary"), "segments-rows").df
    blocks = max(1, -(-whole.count() // BLOCK))
    asked = max(1, -(-whole.filter(is_query).count() // BLOCK))
    have = whole.select("id", "vector", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"))
    asks = whole.filter(is_query).select("id", "vector", F.pmod(F.xxhash64("id"), F.lit(asked)).cast("int").alias("asked"))
    key = ["asked", "block"]

    def meet(rows: DataFrame, queries: DataFrame) -> DataFrame:
        rows = rows.select(*key, "id", "vector", F.lit(None).cast("double").alias("floor"), F.lit(False).alias("asks"))
        both = rows.unionByName(queries.select(*key, "id", "vector", "floor", F.lit(True).alias("asks")))
        return both.repartition(*key).sortWithinPartitions(*key).mapInPandas(lambda f: _meet(f, dim, k), "query bigint, id bigint, score bigint")

    # the first block of each block of queries gives the floors
    first = F.pmod("asked", F.lit(blocks)).cast("int")
    everyone = F.explode(F.sequence(F.lit(0), F.lit(asked - 1))).alias("asked")
    dealt = have.select("id", "vector", "block", everyone)
    start = Stage(meet(dealt.filter(F.col("block") == first), asks.select("*", first.alias("block"), F.lit(float("-inf")).alias("floor"))), "segments-first").df
    floors = _top(start, k).filter(F.col("rank") == k).select(F.col("query").alias("id"), F.col("score").cast("double").alias("floor"))
    known = asks.join(floors.dropDuplicates(["id"]), "id", "left").select("id", "vector", "asked", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"))
    others = known.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")).filter(F.col("block") != first)
    rest = meet(dealt.filter(F.col("block") != first), others)
    best = _top(start.unionByName(rest), k)
    return best.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")
