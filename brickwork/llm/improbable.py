"""Improbable-feature digests: the rarest byte windows of a text, in chained Bloom filters.

A *feature* is a window of ``WINDOW`` bytes.  Its entropy (the byte distribution's, as thousandths of the most it can
be) falls into one of 1,001 classes.  ``learn`` counts the classes of all windows of a corpus; the fewer windows a
class has, the better its rank.  In every stretch of ``STRETCH`` neighbouring features the leftmost one of the best
rank gains a point (stretches may reach over a text's ends, so short texts have points as well).  Features with
``POINTS`` points are selected: they are improbable, and the choice depends on their surroundings alone.  Windows of
almost no entropy (one repeated character, rules of dashes) stand for nothing and are never selected.

The selected features go, in their order and once each, into Bloom filters of 2,048 bits, five bits a feature; after
``FULL`` features the next filter of the chain begins.  The written form is the number of features, a colon
and the filters in base64.

Likeness: of two filters, the shared bits above those expected by chance, as a share of the most possible; an overlap
within ``SIGMAS`` deviations of chance is none.  Of two digests, each filter of the shorter chain takes its best
partner in the longer one; the mean is weighted by features.  Equal digests are alike by 1, digests without
a feature and others by 0.

Defined cases: NULL is the empty text; a text shorter than a window is one feature by itself, the empty one has none;
equal texts have equal fingerprints; a table of one row has itself as next; NULL ids come last, rows that share an id
are ordered by a hash of their text; ids are whole numbers.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from hashlib import blake2b, sha256

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brickwork.llm.common import shuffle_partitions

WINDOW = 16
STRETCH = 24
POINTS = 6
CLASSES = 1001
#: Classes up to this entropy are never selected.
DULL = 250
BITS, HASHES, FULL = 2048, 5, 160
SIGMAS = 4.5
#: Bytes of text that are worked on at once; a longer text is worked on alone.
BATCH = 1 << 20

_SCALE = 1 << 20
_COUNT = np.arange(WINDOW + 1, dtype=np.float64)
_PART = np.rint(_COUNT * np.log2(np.maximum(_COUNT, 1)) * _SCALE).astype(np.int64)
_GAIN = np.concatenate([[0], np.diff(_PART)])


def entropy_classes(data: np.ndarray) -> np.ndarray:
    """The class of every window of ``data`` (at least ``WINDOW`` bytes).

    The sum of c log c over a window's byte counts c changes by one byte leaving and one entering; the counts
    of these two come from comparing the data with itself, shifted by each distance in the window."""
    n = len(data)
    ahead, behind = np.ones(n, np.uint8), np.ones(n, np.uint8)
    for d in range(1, WINDOW):
        same = (data[d:] == data[:-d]).view(np.uint8)
        ahead[:-d] += same
        behind[d:] += same
    entered = np.cumsum(_GAIN[behind])
    left = np.cumsum(_GAIN[ahead])
    sums = entered[WINDOW - 1 :].copy()
    sums[1:] -= left[: n - WINDOW]
    most = int(_PART[WINDOW])
    return (most - sums) * (CLASSES - 1) // most


class Texts:
    """Many texts as one array of bytes, with the windows that lie inside a text."""

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.lengths = np.array([len(t) for t in texts], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        windows = np.maximum(self.lengths - WINDOW + 1, 0)
        self.owner = np.repeat(np.arange(len(texts)), windows)
        first = np.cumsum(windows) - windows
        self.place = np.arange(len(self.owner)) - first[self.owner] + self.starts[self.owner]
        self.classes = entropy_classes(self.data)[self.place] if len(self.place) else self.place


def selected(texts: Texts, rank: np.ndarray) -> np.ndarray:
    """Numbers (among the windows of all texts) of the features with enough points."""
    n = len(texts.owner)
    if not n:
        return np.zeros(0, np.int64)
    worst = np.int64(1 << 62)
    at = np.arange(n) + (STRETCH - 1) * (texts.owner + 1)  # texts lie a stretch apart
    best = np.full(int(at[-1]) + STRETCH, worst)
    best[at] = np.where(texts.classes > DULL, (rank[texts.classes] << 40) | np.arange(n), worst)
    width = 1
    while width < STRETCH:
        step = min(width, STRETCH - width)
        best = np.minimum(best[: len(best) - step], best[step:])
        width += step
    best = best[best != worst] & ((1 << 40) - 1)
    return np.flatnonzero(np.bincount(best, minlength=n) >= POINTS)


def _mixed(a: np.ndarray) -> np.ndarray:
    a = (a ^ (a >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    a = (a ^ (a >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return a ^ (a >> np.uint64(31))


def _features(texts: Texts, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, 64-bit hash) of the features, by owner and place, once a text."""
    chosen = selected(texts, rank)
    owner = texts.owner[chosen]
    hashes = np.zeros(len(chosen), np.uint64)
    if len(chosen):
        windows = np.lib.stride_tricks.sliding_window_view(texts.data, WINDOW)[texts.place[chosen]]
        for column in np.ascontiguousarray(windows).view("<u8").T:
            hashes = _mixed(hashes * np.uint64(0x9E3779B97F4A7C15) + column + np.uint64(1))
    small = [i for i, t in enumerate(texts.texts) if 0 < len(t) < WINDOW]
    whole = [int.from_bytes(blake2b(texts.texts[i], digest_size=8).digest(), "little") for i in small]
    owner = np.concatenate([owner, np.array(small, np.int64)])
    hashes = np.concatenate([hashes, np.array(whole, np.uint64)])
    place = np.arange(len(owner))
    order = np.lexsort((place, hashes, owner))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (owner[order][1:] != owner[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
    kept = np.sort(order[fresh])
    kept = kept[np.argsort(owner[kept], kind="stable")]
    return owner[kept], hashes[kept]


class Digest:
    """A chain of filters and the features in each."""

    def __init__(self, features: int, filters: np.ndarray):
        self.features, self.filters = features, filters

    @property
    def weights(self) -> np.ndarray:
        held = np.full(len(self.filters), FULL)
        if len(held):
            held[-1] = self.features - FULL * (len(held) - 1)
        return held

    def written(self) -> str:
        return f"{self.features}:{base64.b64encode(self.filters.tobytes()).decode()}"

    @classmethod
    def read(cls, text: str) -> Digest:
        features, filters = text.split(":")
        return cls(int(features), np.frombuffer(base64.b64decode(filters), np.uint8).reshape(-1, BITS // 8))


def digests(texts: list[bytes], rank: np.ndarray) -> list[Digest]:
    owner, hashes = _features(Texts(texts), rank)
    counts = np.bincount(owner, minlength=len(texts))
    chains = -(-counts // FULL)
    base = np.cumsum(chains) - chains
    number = np.arange(len(owner)) - (np.cumsum(counts) - counts)[owner]
    row = base[owner] + number // FULL
    bits = np.zeros((int(chains.sum()), BITS), bool)
    for k in range(HASHES):
        bits[row, (hashes >> np.uint64(11 * k)).astype(np.int64) % BITS] = True
    packed = np.packbits(bits, axis=1)
    return [Digest(int(n), packed[a : a + c]) for n, a, c in zip(counts, base, chains, strict=True)]


def likeness(one: Digest, other: Digest) -> float:
    """From 0 (no more bits shared than by chance) to 1."""
    if one.features == other.features and np.array_equal(one.filters, other.filters):
        return 1.0
    if not one.features or not other.features:
        return 0.0
    few, many = sorted((one, other), key=lambda d: (d.features, d.filters.tobytes()))
    right = np.unpackbits(many.filters, axis=1).astype(np.float32)
    right_bits = right.sum(axis=1)
    total = 0.0
    for a in range(0, len(few.filters), 256):
        left = np.unpackbits(few.filters[a : a + 256], axis=1).astype(np.float32)
        left_bits = left.sum(axis=1)[:, None]
        shared, chance = left @ right.T, left_bits * right_bits / BITS
        spread = np.sqrt(chance * (1 - left_bits / BITS) * (1 - right_bits / BITS))
        most = np.minimum(left_bits, right_bits)
        score = np.where(shared > chance + SIGMAS * spread, (shared - chance) / np.maximum(most - chance, 1e-9), 0)
        total += float((np.clip(score, 0, 1).max(axis=1) * few.weights[a : a + 256]).sum())
    return min(total / few.features, 1.0)


def _batches(column) -> Iterator[list[bytes]]:
    import pyarrow as pa

    held, size = [], 0
    for value in column.cast(pa.binary()):
        text = value.as_py() or b""
        if held and size + len(text) > BATCH:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def learn(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The rank of every entropy class (0: the rarest), from all windows of all texts."""

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = np.zeros(CLASSES, np.int64)
        for batch in batches:
            for texts in _batches(batch.column(0)):
                total += np.bincount(Texts(texts).classes, minlength=CLASSES)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"class": pa.array(seen, pa.int32()), "n": pa.array(total[seen], pa.int64())})

    counts = np.zeros(CLASSES, np.int64)
    for row in docs.select(text).mapInArrow(count, "class int, n long").groupBy("class").agg(F.sum("n").alias("n")).collect():
        counts[row["class"]] = row.n
    rank = np.empty(CLASSES, np.int64)
    rank[np.argsort(counts, kind="stable")] = np.arange(CLASSES)
    return rank


def fingerprints(docs: DataFrame, rank: np.ndarray, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of ``text`` in column ``out`` (which replaces one of this name)."""
    from pyspark.sql.types import StringType, StructField, StructType

    rows = docs.select(*[c for c in docs.columns if c != out], F.col(text).alias("_digest_text"))
    schema = StructType([*rows.schema.fields[:-1], StructField(out, StringType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            done = [d.written() for texts in _batches(batch.column(batch.num_columns - 1)) for d in digests(texts, rank)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(done, pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema)


def _bucket(id: str, cuts: list[int]):
    """How many of the descending ``cuts`` are at least the id, in two steps of about the root of their number."""
    wide = max(int(len(cuts) ** 0.5), 1)
    fine = [cuts[i : i + wide] for i in range(0, len(cuts), wide)]
    at_least = lambda c: c >= F.col(id)
    # the group whose last cut is the first one below the id holds the place
    group = F.size(F.filter(F.array(*[F.lit(g[-1]) for g in fine]), at_least))
    inside = F.size(F.filter(F.get(F.array(*[F.array(*map(F.lit, g)) for g in fine]), group), at_least))
    return F.when(F.col(id).isNull(), len(cuts)).otherwise(group * wide + F.when(group < len(fine), inside).otherwise(len(cuts) - group * wide))


def descending(docs: DataFrame, id: str, text: str, buckets: int) -> DataFrame:
    """(bucket, extra, id, text) in tasks of successive ids, in descending order; each bucket is followed by a copy of
    the next one's first rows (``extra``), the last bucket by the first one's."""
    rows = docs.select(F.col(id).cast("long").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    shares = [1 - i / buckets for i in range(1, buckets)]
    cuts = (rows.agg(F.percentile_approx("id", shares, 100 * buckets)).first()[0] if shares else None) or []
    cuts = sorted(set(cuts), reverse=True)
    dealt = rows.withColumn("bucket", _bucket("id", cuts) if cuts else F.lit(0))
    heads = {r.bucket: r.head for r in dealt.groupBy("bucket").agg(F.max("id").alias("head")).collect()}
    used = sorted(heads)
    before = dict(zip(used, [used[-1], *used[:-1]], strict=True)) if used else {}
    head = F.get(F.array(*[F.lit(heads.get(b)).cast("long") for b in range(len(cuts) + 1)]), F.col("bucket"))
    target = F.get(F.array(*[F.lit(before.get(b, 0)) for b in range(len(cuts) + 1)]), F.col("bucket"))
    own, copy = F.struct("bucket", F.lit(False).alias("extra")), F.struct(target.alias("bucket"), F.lit(True).alias("extra"))
    copies = F.when(F.col("id").eqNullSafe(head), F.array(own, copy)).otherwise(F.array(own))
    placed = dealt.select("id", "text", F.explode(copies).alias("at")).select("at.bucket", "at.extra", "id", "text")
    order = ["bucket", "extra", F.desc_nulls_last("id"), F.xxhash64("text")]
    return placed.repartitionById(len(cuts) + 1, F.col("bucket")).sortWithinPartitions(*order)


_COMPARED = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_next(docs: DataFrame, rank: np.ndarray, edit: Callable[[str, str], str], id: str = "doc_id", text: str = "text", buckets: int | None = None) -> DataFrame:
    """Every text, in descending order of ids, beside ``edit(text, next text)``: both fingerprints, and the likeness of
    the text's to the edited text's and to the next text's."""

    def rows(pairs: list[tuple], follow: str) -> Iterator:
        import pyarrow as pa

        texts = [t for _, t in pairs]
        edited = [edit(a, b) for a, b in zip(texts, [*texts[1:], follow], strict=True)]
        made = digests([t.encode() for t in [*texts, follow, *edited]], rank)
        own, changed = made[: len(texts) + 1], made[len(texts) + 1 :]
        columns = [
            [i for i, _ in pairs],
            [len(t) for t in texts],
            [sha256(t.encode()).hexdigest() for t in edited],
            [d.written() for d in own[:-1]],
            [d.written() for d in changed],
            [likeness(a, b) for a, b in zip(own, changed)],
            [likeness(a, b) for a, b in zip(own, own[1:])],
        ]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in _COMPARED.split(", ")])

    def run(batches: Iterator) -> Iterator:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                for _, extra, doc, body in zip(*[c.to_pylist() for c in batch.slice(a, 256).columns], strict=True):
                    if held and (extra or size + len(body) > BATCH):
                        yield rows(held, body)
                        held, size = [], 0
                    if not extra:
                        held.append((doc, body))
                        size += len(body)

    n = buckets or shuffle_partitions(docs.sparkSession)
    return descending(docs, id, text, n).mapInArrow(run, _COMPARED)
