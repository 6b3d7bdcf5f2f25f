"""Jaccard join of documents on word shingles by T-occurrence search.

A document's set holds the 64-bit hashes of its distinct shingles.  Two documents link when
``den * |intersection| >= num * |union|``, so each shares at least T = ceil(num / den * size) shingles.

1.  Equal sets are one class, of which the smallest id goes on.
2.  Short lists.  Shingles are ordered rarest first (those that a bounded sample of documents holds twice come
    last; any one order for all is exact).  Of its T lists a document may leave out the T - 1 most frequent,
    so two linked documents meet in a list of their first size - T + 1 shingles.  Lists of one are dropped.
3.  Each list is thinned to a star: its smallest document is held against the others by 64 four-bit minima, each
    two documents once for all their lists.  Those that look alike join its group; those that look linked
    are done with in this list, as their partners must look alike too; the rest go on with the next first,
    which gives an edge only to what is not in its group already.  So a list of copies costs its
    length, not its square.  Long lists are dealt in chunks, and what is left of the chunks meets in pairs.
4.  Groups (components of the stars) get their documents' full sets, and DivideSkip runs in each: short
    lists are merged by a heap that skips, candidates below T less the number of long lists fall out, long lists are probed by
    binary search, and the exact test decides.  A pair that is already connected is not tested again.  Large
    groups are dealt in chunks, and every two chunks meet in a task.
5.  Components of the links.

Steps 3 and 4 lose a link only if its two documents, alike in num / den of all minima, differ in most of 64
(for 9/10 less than 1e-20, for 8/10 about 1e-9 for a pair at the very limit).

Defined cases: a text with fewer words than a shingle is one shingle of all its words; NULL text or one without
words has the empty set and links with nothing; rows with a NULL id take part in no link, and get the component
of an equal set, if any; rows that share an id are one node.
"""

from __future__ import annotations

import hashlib
import heapq
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brickwork.llm.common import TEXTS, Stage, key_runs, remembered, small_side, tidied
from brickwork.llm.components import components

#: Documents sampled for the order of shingles, and shingles that the order puts last.
SAMPLE, COMMON = 8_000, 100_000
SLOTS, ALIKE = 64, 18
LIST_CHUNK, GROUP_DOCS, GROUP_SHINGLES = 4_096, 1_024, 2_000_000
#: Entries of short lists that a heap merges; more are merged as arrays.
HEAP = 4_096
PIECE = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def _powers() -> tuple[np.ndarray, np.ndarray]:
    return remembered("powers", _make_powers)


def _make_powers() -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    with np.errstate(over="ignore"):
        up, down = np.full(PIECE, _BASE), np.full(PIECE, inverse)
        up[0] = down[0] = 1
        return np.cumprod(up), np.cumprod(down)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _word_hashes(data: bytes) -> np.ndarray:
    """A hash for each word, in order."""
    if len(data) > PIECE:
        found, at = [], 0
        while at < len(data):
            end = min(at + PIECE // 2, len(data))
            while end < len(data) and not _SPACE[data[end]]:
                end += 1
            piece = data[at:end]
            if len(piece) <= PIECE:
                found.append(_word_hashes(piece))
            else:
                found.append(np.array([int.from_bytes(hashlib.blake2b(w, digest_size=8).digest()) for w in piece.split()], np.uint64))
            at = end
        return np.concatenate(found)
    codes = np.frombuffer(data, np.uint8)
    edge = np.diff(np.concatenate([[True], _SPACE[codes], [True]]).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = _powers()
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes + np.uint64(1)) * up[: len(codes)], out=sums[1:])
    return _mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def shingles(text: str | None, words: int) -> np.ndarray:
    """Ascending hashes of the distinct shingles of ``words`` words."""
    with np.errstate(over="ignore"):
        each = _word_hashes((text or "").encode("utf-8", "surrogatepass").lower())
        n = min(words, len(each))
        if not n:
            return np.empty(0, np.uint64)
        h = np.full(len(each) - n + 1, n, np.uint64)
        for j in range(n):
            h = _mix(h * _BASE + each[j : len(each) - n + 1 + j])
    return np.unique(h)


@lru_cache(maxsize=1)
def _factors() -> np.ndarray:
    return _mix(np.arange(1, SLOTS + 1, dtype=np.uint64) * _BASE) | np.uint64(1)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Four bits of the least of each of 64 rehashes, in four 64-bit words."""
    least = np.full(SLOTS, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(hashes), 4096):
            np.minimum(least, (hashes[at : at + 4096, None] * _factors()).min(axis=0), out=least)
        bits = (_mix(least) >> np.uint64(60)).reshape(4, 16)
    return np.bitwise_or.reduce(bits << (np.arange(16, dtype=np.uint64) * np.uint64(4)), axis=1)


def prefix(hashes: np.ndarray, common: np.ndarray, place: np.ndarray, num: int, den: int) -> np.ndarray:
    """The size - T + 1 rarest shingles; ``common`` (ascending) come last, by ``place``."""
    size = len(hashes)
    length = size + (-num * size) // den + 1
    if len(common):
        at = np.searchsorted(common, hashes)
        at[at == len(common)] = 0
        late = common[at] == hashes
        rare = hashes[~late]
        if len(rare) < length:
            rest = hashes[late][np.argsort(place[at[late]], kind="stable")]
            rare = np.concatenate([rare, rest])
        hashes = rare
    return hashes[:length]


_SIGNED = [("doc", "bigint"), ("n", "bigint"), ("f1", "bigint"), ("f2", "bigint"), ("s0", "bigint"), ("s1", "bigint"), ("s2", "bigint"), ("s3", "bigint"), ("prefix", "array<bigint>")]


def _sign(batches: Iterator, words: int, num: int, den: int, common: np.ndarray, place: np.ndarray) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            n, prints, sketches, firsts = [], [], [], []
            for text in part.column(1).to_pylist():
                found = shingles(text, words)
                n.append(len(found))
                prints.append(np.frombuffer(hashlib.blake2b(found.tobytes(), digest_size=16).digest(), np.int64))
                sketches.append(sketch(found))
                firsts.append(prefix(found, common, place, num, den) if len(found) else found)
            prints, sketches = np.array(prints), np.array(sketches).view(np.int64)
            ends = np.concatenate([[0], np.cumsum([len(f) for f in firsts])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(firsts).view(np.int64)))
            columns = [part.column(0), pa.array(n, pa.int64()), *(pa.array(np.ascontiguousarray(c)) for c in (*prints.T, *sketches.T)), lists]
            yield pa.RecordBatch.from_arrays(columns, names=[name for name, _ in _SIGNED])


def _sample_counts(batches: Iterator, words: int) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        found = [shingles(t, words) for t in batch.column(0).to_pylist()]
        keys, n = np.unique(np.concatenate(found), return_counts=True)
        yield pa.RecordBatch.from_pydict({"token": pa.array(keys.view(np.int64)), "n": pa.array(n.astype(np.int64))})


def _common(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that a bounded sample of documents holds more than once, ascending, and their places by frequency."""
    share = min(1.0, SAMPLE / max(docs.count(), 1))
    sample = docs.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(share * (1 << 20))).select("text")
    counts = sample.mapInArrow(lambda b: tidied(_sample_counts(b, words)), "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    rows = counts.filter("n > 1").orderBy(F.desc("n"), "token").limit(COMMON).toPandas()
    tokens, n = rows["token"].to_numpy(np.int64).view(np.uint64), rows["n"].to_numpy(np.int64)
    order = np.argsort(tokens)
    return tokens[order], n[order]


def _matches(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal four-bit minima of each two rows."""
    x = a ^ b
    x |= x >> np.uint64(2)
    x |= x >> np.uint64(1)
    return SLOTS - np.bitwise_count(x & np.uint64(0x1111111111111111)).sum(axis=1).astype(np.int64)


def _equal_minima() -> Column:
    """Equal four-bit minima of s0 to s3 and f0 to f3."""
    different = F.lit(0)
    for i in range(4):
        x = F.col(f"s{i}").bitwiseXOR(F.col(f"f{i}"))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        different = different + F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
    return SLOTS - different


def _stars(frames: Iterator, keys: list[str], linked: int) -> Iterator:
    """Edges from each list's first documents to those alike that are not tied yet, by their labels (kind 0), and
    what no first took in, with its label (kind 1)."""
    import pandas as pd

    def rows(kind: int, token: np.ndarray, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"kind": kind, "token": token, "a": a, "b": b}).astype({"kind": "int32", "token": "int64", "a": "int64", "b": "int64"})

    for frame in key_runs(frames, keys, 200_000):
        sketches = frame[["s0", "s1", "s2", "s3"]].to_numpy(np.int64).view(np.uint64)
        docs, label, token, salts = (frame[c].to_numpy() for c in ("doc", "label", "token", "salts"))
        key = frame[keys].to_numpy()
        live = np.arange(len(frame))
        edges, left = [], []
        while len(live):
            k = key[live]
            first = np.concatenate([[True], (k[1:] != k[:-1]).any(axis=1)])
            pivot = live[first][np.cumsum(first) - 1]
            same = _matches(sketches[live], sketches[pivot])
            alike = (same >= ALIKE) & (label[live] != label[pivot])
            edges.append(np.stack([docs[live][alike], docs[pivot][alike]], axis=1))
            left.append(live[first])
            live = live[~first & (same < linked)]
        found = np.unique(np.concatenate(edges), axis=0)
        yield rows(0, np.zeros(len(found), np.int64), found[:, 0], found[:, 1])
        left = np.concatenate(left)
        left = left[salts[left] > 1]
        yield rows(1, token[left], docs[left], label[left])


def _paired(rows: DataFrame, key: list[str], chunks: str, doc: str) -> DataFrame:
    """Rows dealt to chunks by ``doc`` and sent to every pair of chunks (lo, hi) that theirs belongs to."""
    mine = F.pmod(F.xxhash64(doc), F.col(chunks)).cast("int")
    both = rows.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), (F.col(chunks) - 1).cast("int"))))
    return both.withColumn("lo", F.least("mine", "other")).withColumn("hi", F.greatest("mine", "other")).drop("other")


def _groups(signed: DataFrame, num: int, den: int) -> DataFrame:
    """(doc, group) of all documents that may link with another."""
    tokens = signed.select(F.col("doc"), F.explode("prefix").alias("token"))
    often = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df"), F.min("doc").alias("first")).filter("df > 1")
    salts = F.ceil(F.col("df") / LIST_CHUNK).cast("int")
    lists = Stage(tokens.join(often, "token").filter("doc <> first").select("token", "doc", "first", salts.alias("salts")), "jaccard-lists").df
    minima = small_side(Stage(signed.select("doc", "s0", "s1", "s2", "s3"), "jaccard-minima").df, 1_000_000)
    linked = -(-SLOTS * num // den)
    schema = "kind int, token bigint, a bigint, b bigint"

    # the first of a list is often the first of many, so these pairs are made distinct before they are held together
    firsts = minima.select(F.col("doc").alias("first"), *[F.col(f"s{i}").alias(f"f{i}") for i in range(4)])
    pairs = lists.select("doc", "first").distinct().join(minima, "doc").join(firsts, "first")
    alike = Stage(pairs.select("doc", "first", _equal_minima().alias("same")).filter(F.col("same") >= ALIKE), "jaccard-alike").df
    rest = lists.join(alike, ["doc", "first"], "left").filter(F.col("same").isNull() | (F.col("same") < linked))
    rest = rest.select("token", "doc", "salts", F.when(F.col("same").isNull(), F.col("doc")).otherwise(F.col("first")).alias("label"))
    edges = alike.select(F.col("doc").alias("a"), F.col("first").alias("b"))

    def star(rows: DataFrame, keys: list[str]) -> DataFrame:
        dealt = rows.join(minima, "doc").repartition(*keys).sortWithinPartitions(*keys, "doc")
        return dealt.mapInPandas(lambda frames: _stars(frames, keys, linked), schema)

    salt = F.pmod(F.xxhash64("doc"), F.col("salts")).cast("int")
    found = Stage(star(rest.withColumn("salt", salt), ["token", "salt"]), "jaccard-stars")
    edges = edges.unionByName(found.df.filter("kind = 0").select("a", "b"))
    left = found.df.filter("kind = 1").select("token", F.col("a").alias("doc"), F.col("b").alias("label")).distinct()
    if left.limit(1).count():
        chunks = F.ceil(F.count(F.lit(1)) / LIST_CHUNK).cast("int")
        sized = left.join(left.groupBy("token").agg(chunks.alias("chunks")), "token").withColumn("salts", F.lit(1))
        more = star(_paired(sized, ["token"], "chunks", "doc").drop("mine"), ["token", "lo", "hi"])
        edges = edges.unionByName(more.filter("kind = 0").select("a", "b"))
    return components(edges).select(F.col("node").alias("doc"), F.col("component").alias("group"))


class Union:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)


def merge_skip(lists: list[list[int]], least: int) -> tuple[list[int], list[int]]:
    """What at least ``least`` of the ascending lists hold, ascending, and how many do, by a heap of the lists' heads.

    When too few lists stand at the least head, ``least - 1`` heads are taken off: whatever is still to be found stands
    at or after the head that is then on top, so each of them skips there by binary search."""
    places = [0] * len(lists)
    heap = [(held[0], i) for i, held in enumerate(lists) if held]
    heapq.heapify(heap)
    found, counts = [], []
    while len(heap) >= least:
        top, taken = heap[0][0], []
        while heap and heap[0][0] == top:
            taken.append(heapq.heappop(heap)[1])
        if len(taken) >= least:
            found.append(top)
            counts.append(len(taken))
            after = top + 1
        else:
            while heap and len(taken) < least - 1:
                taken.append(heapq.heappop(heap)[1])
            if not heap:
                break
            after = heap[0][0]
        for i in taken:
            places[i] = bisect_left(lists[i], after, places[i])
            if places[i] < len(lists[i]):
                heapq.heappush(heap, (lists[i][places[i]], i))
    return found, counts


def occurrences(lists: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    """``merge_skip`` of arrays; where they hold so much that a heap is the slower way, one sorted merge of them all,
    with the same result."""
    if sum(map(len, lists)) <= HEAP:
        found, count = merge_skip([held.tolist() for held in lists], least)
        return np.array(found, np.int64), np.array(count, np.int64)
    found, count = np.unique(np.concatenate(lists), return_counts=True)
    return found[count >= least], count[count >= least]


def divide_skip(sets: list[np.ndarray], num: int, den: int, chunk: np.ndarray | None = None, all_links: bool = False) -> list[tuple[int, int]]:
    """Linked positions (i, j), as many as connect what is linked, or all; with ``chunk``, only pairs across chunks."""
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    sizes = np.array([len(sets[i]) for i in order])
    flat, token = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)
    owner = np.repeat(np.arange(len(order)), sizes)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    by_token = np.argsort(token, kind="stable")
    postings = owner[by_token]
    df = np.bincount(token, minlength=len(flat))
    at = np.concatenate([[0], np.cumsum(df)])
    union, links = Union(len(order)), []
    for x in range(1, len(order)):
        size = int(sizes[x])
        low = int(np.searchsorted(sizes, -(-num * size // den)))
        if low >= x:
            continue
        need = -(-num * size // den)
        mine = token[ends[x] : ends[x + 1]]
        mine = mine[np.argsort(df[mine], kind="stable")]
        n_long = min(need - 1, int(need / (0.0085 * np.log2(max(int(df[mine[-1]]), 2)) + 1)))
        short, long = mine[: size - n_long], mine[size - n_long :]
        lists = [postings[at[t] : at[t + 1]] for t in short]
        cuts = [np.searchsorted(held, (low, x)) for held in lists]
        found, count = occurrences([held[a:b] for held, (a, b) in zip(lists, cuts, strict=True)], need - n_long)
        if chunk is not None and len(found):
            across = chunk[[order[y] for y in found]] != chunk[order[x]]
            found, count = found[across], count[across]
        if not all_links and len(found):
            root = union.root(x)
            apart = np.array([union.root(int(y)) != root for y in found], bool)
            found, count = found[apart], count[apart]
        if len(found) > len(long):
            for t in long:
                listed = postings[at[t] : at[t + 1]]
                hit = np.searchsorted(listed, found)
                hit[hit == len(listed)] = 0
                count = count + (listed[hit] == found)
            probed = zip(found.tolist(), count.tolist(), strict=True)
        else:
            probed = ((y, c + _held(token[ends[y] : ends[y + 1]], long)) for y, c in zip(found.tolist(), count.tolist(), strict=True))
        for y, both in probed:
            if not all_links and union.root(y) == union.root(x):
                continue
            if den * both >= num * (size + int(sizes[y]) - both):
                union.join(x, y)
                links.append((order[x], order[y]))
    return links


def _held(tokens: np.ndarray, probes: np.ndarray) -> int:
    """How many probes the ascending tokens hold."""
    hit = np.searchsorted(tokens, probes)
    hit[hit == len(tokens)] = 0
    return int((tokens[hit] == probes).sum())


def _link(frames: Iterator, num: int, den: int) -> Iterator:
    import pandas as pd

    key = ["group", "lo", "hi"]
    for frame in key_runs(frames, key, 1):
        cut = np.flatnonzero((frame[key].to_numpy()[1:] != frame[key].to_numpy()[:-1]).any(axis=1)) + 1
        bounds = [0, *cut.tolist(), len(frame)]
        docs, chunk, lo, hi = (frame[c].to_numpy() for c in ("doc", "mine", "lo", "hi"))
        sets = [np.frombuffer(s, np.uint64) for s in frame["hashes"]]
        pairs = []
        for a, b in zip(bounds, bounds[1:]):
            found = divide_skip(sets[a:b], num, den, chunk[a:b] if lo[a] != hi[a] else None)
            pairs += [(docs[a + i], docs[a + j]) for i, j in found]
        yield pd.DataFrame(pairs, columns=["a", "b"]).astype("int64")


def _hash_sets(batches: Iterator, words: int) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            found = [shingles(t, words) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(f) for f in found], pa.int64()), pa.array([f.tobytes() for f in found], pa.binary())], names=["doc", "n", "hashes"])


def _links(docs: DataFrame, groups: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """Edges that connect all linked documents of each group."""
    texts = docs.join(small_side(groups.select(F.col("doc").alias("id"))), "id", "left_semi")
    sets = Stage(texts.mapInArrow(lambda b: tidied(_hash_sets(b, words)), "doc bigint, n bigint, hashes binary"), "jaccard-sets", batch=TEXTS).df
    sets = sets.dropDuplicates(["doc", "hashes"])
    load = groups.join(sets.select("doc", "n"), "doc").groupBy("group").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("load"))
    chunks = F.ceil(F.greatest(F.col("docs") / GROUP_DOCS, F.col("load") / GROUP_SHINGLES)).cast("int")
    members = groups.join(load.select("group", chunks.alias("chunks")), "group")
    dealt = _paired(members, ["group"], "chunks", "doc").join(sets.select("doc", "hashes"), "doc")
    key = ["group", "lo", "hi"]
    return dealt.select(*key, "doc", "mine", "hashes").repartition(*key).sortWithinPartitions(*key, "doc").mapInPandas(lambda f: tidied(_link(f, num, den)), "a bigint, b bigint")


def join_components(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    """One row a document: (doc_id, n_shingles, component_id)."""
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    common, place = _common(rows, words)
    schema = ", ".join(f"{name} {kind}" for name, kind in _SIGNED)
    signed = Stage(rows.mapInArrow(lambda b: tidied(_sign(b, words, num, den, common, place)), schema), "jaccard-signed", batch=TEXTS).df
    classes = signed.filter("n > 0").groupBy("f1", "f2").agg(F.min("doc").alias("rep"))
    firsts = signed.join(classes.select(F.col("rep").alias("doc"), F.col("f1").alias("g1"), F.col("f2").alias("g2")), "doc")
    firsts = firsts.filter("f1 = g1 AND f2 = g2").dropDuplicates(["doc", "f1", "f2"])
    groups = Stage(_groups(firsts.select("doc", "s0", "s1", "s2", "s3", "prefix"), num, den), "jaccard-groups").df
    found = components(Stage(_links(rows, groups, words, num, den), "jaccard-links", batch=TEXTS).df)
    named = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("f1", "f2", F.coalesce("component", "rep").alias("component"))
    return signed.join(named, ["f1", "f2"], "left").select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "doc").alias("component_id"))
