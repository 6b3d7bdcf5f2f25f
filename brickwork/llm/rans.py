"""Token ids in compressed binary blocks: range asymmetric numeral system with one shared, static table.

Writing takes three steps.  Documents are dealt to ranges of ascending id, tokenized and cut, in order, into
blocks of whole documents (about ``BLOCK`` ids).  Each task counts its ids as it goes and leaves the counts with its
last block; their sums are scaled to a table of 2^20 slots in which every id of the vocabulary has one.  Every block is then coded
by itself: its ids go round ``lanes`` interleaved coders, vectorised, and every ``EVERY`` rounds the
coders' states and the place in the stream are kept, so that decoding can start there.  Blocks have a header
and checksums; Spark's Parquet sink holds them with their document index, so any store that Spark
reaches will do.

    block = header | lane states | checkpoints (words read, lane states) | 32-bit words
    header = "RANS", version, ids, lanes, rounds, checkpoints, words, crc32 of the ids, crc32 of the rest

Defined cases: a NULL or empty text has the end id alone; NULL ids come first; rows that share an id are ordered
by a hash of the text; an empty table gives no blocks.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brickwork.llm.common import Stage, shuffle_partitions, small_side

MAGIC, VERSION = b"RANS", 1
HEADER = struct.Struct("<4sHQIIIQII")
SCALE = 20
LOW = 1 << 31
BLOCK, LANES, EVERY = 1 << 18, 1024, 128
CHUNK = 4096


class Damaged(ValueError):
    """A block whose checksum does not fit."""


class Table:
    """Slots of each symbol, and the symbol of each slot."""

    def __init__(self, counts: np.ndarray):
        self.freq = scale_counts(counts)
        self.first = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(counts), dtype=np.uint32), self.freq.astype(np.int64))


def scale_counts(counts: np.ndarray) -> np.ndarray:
    """Slots in proportion to the counts, at least one each, 2^SCALE in all."""
    slots = 1 << SCALE
    if len(counts) > slots:
        raise ValueError("more symbols than slots")
    spare = slots - len(counts)
    total = max(int(counts.sum()), 1)
    freq = 1 + np.floor(counts.astype(np.float64) * (spare / total)).astype(np.int64)
    freq[int(np.argmax(counts))] += slots - int(freq.sum())
    return freq.astype(np.uint64)


def encode_block(ids: np.ndarray, table: Table) -> bytes:
    n = len(ids)
    lanes = int(min(LANES, max(1, n // 64)))
    rounds = -(-n // lanes)
    scale, mask = np.uint64(SCALE), np.uint64(0xFFFFFFFF)
    state = np.full(lanes, LOW, np.uint64)
    words, marks, read = [], [], 0
    freq, first = table.freq[ids], table.first[ids]
    limit = freq << np.uint64(31 - SCALE + 32)
    for k in range(rounds - 1, -1, -1):
        a, b = k * lanes, min(n, (k + 1) * lanes)
        x = state[: b - a]
        over = x >= limit[a:b]
        out = x[over]
        words.append((out & mask).astype(np.uint32))
        read += len(out)
        x[over] = out >> np.uint64(32)
        f = freq[a:b]
        q = x // f
        state[: b - a] = (q << scale) + (x - q * f) + first[a:b]
        if k and k % EVERY == 0:
            marks.append((read, state.copy()))
    stream = np.concatenate(words[::-1]).tobytes() if words else b""
    points = b"".join(struct.pack("<Q", read - behind) + at.tobytes() for behind, at in marks[::-1])
    rest = state.tobytes() + points + stream
    head = HEADER.pack(MAGIC, VERSION, n, lanes, rounds, len(marks), read, zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(rest))
    return head + rest


def decode_block(block: bytes, table: Table, checkpoint: int = 0) -> np.ndarray:
    """The ids of a block, or those from a checkpoint on (1 is the first kept one)."""
    magic, version, n, lanes, rounds, marks, read, ids_crc, rest_crc = HEADER.unpack_from(block)
    rest = memoryview(block)[HEADER.size :]
    if magic != MAGIC or version != VERSION or zlib.crc32(rest) != rest_crc:
        raise Damaged("the block's bytes do not fit their checksum")
    point = 8 + 8 * lanes
    words = np.frombuffer(rest, np.uint32, read, 8 * lanes + marks * point).astype(np.uint64)
    if checkpoint:
        at = 8 * lanes + (checkpoint - 1) * point
        place = struct.unpack_from("<Q", rest, at)[0]
        state = np.frombuffer(rest, np.uint64, lanes, at + 8).copy()
    else:
        place, state = 0, np.frombuffer(rest, np.uint64, lanes).copy()
    begin = checkpoint * EVERY
    ids = np.empty(n - begin * lanes, np.uint32)
    scale, slots, low = np.uint64(SCALE), np.uint64((1 << SCALE) - 1), np.uint64(LOW)
    for k in range(begin, rounds):
        a, b = (k - begin) * lanes, min(len(ids), (k + 1 - begin) * lanes)
        x = state[: b - a]
        slot = x & slots
        s = table.symbol[slot]
        ids[a:b] = s
        x = table.freq[s] * (x >> scale) + slot - table.first[s]
        short = x < low
        m = int(np.count_nonzero(short))
        x[short] = (x[short] << np.uint64(32)) | words[place : place + m]
        place += m
        state[: b - a] = x
    if not checkpoint and zlib.crc32(ids.astype("<u4").tobytes()) != ids_crc:
        raise Damaged("the ids do not fit their checksum")
    return ids


_RAW = "part int, block int, n_ids bigint, doc_ids binary, known binary, lengths binary, ids binary, counts binary"
_CODED = "part int, block int, n_ids bigint, doc_ids binary, known binary, lengths binary, payload binary"
_DOCS = "doc_id bigint, part int, block int, offset bigint, n_tokens bigint, ids_crc32 bigint"


def _arrow(schema: str):
    import pyarrow as pa

    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in schema.split(", "))])


def _blocks(batches: Iterator, path: str, end_id: int, vocabulary: int) -> Iterator:
    import pyarrow as pa
    from pyspark import TaskContext

    from brickwork.llm.encode import words

    schema, part = _arrow(_RAW), TaskContext.get().partitionId()
    encode, end = words(path).encode, np.array([end_id], "<u4").tobytes()
    docs: list = []
    texts: list[bytes] = []
    block = held = 0
    counts = np.zeros(vocabulary, np.int64)

    def flush(last: bool = False) -> pa.RecordBatch:
        coded = b"".join(texts)
        np.add(counts, np.bincount(np.frombuffer(coded, "<u4"), minlength=vocabulary), out=counts)
        lengths = np.array([len(t) // 4 for t in texts], np.int64)
        known = np.array([d is not None for d in docs], np.uint8)
        ids = np.array([d or 0 for d in docs], np.int64)
        row = [part, block, int(lengths.sum()), ids.tobytes(), known.tobytes(), lengths.tobytes(), coded, zlib.compress(counts.tobytes(), 1) if last else None]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, schema.types, strict=True)], schema=schema)

    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            piece = batch.slice(at, 256)
            for doc_id, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                docs.append(doc_id)
                texts.append(encode(text or "") + end)
                held += len(texts[-1]) // 4
                if held >= BLOCK:
                    yield flush()
                    docs, texts, held, block = [], [], 0, block + 1
    if docs or block:
        yield flush(last=True)


def _counts(batches: Iterator, vocabulary: int) -> Iterator:
    import pyarrow as pa

    total = np.zeros(vocabulary, np.int64)
    for batch in batches:
        for counts in batch.column(0).to_pylist():
            total += np.frombuffer(zlib.decompress(counts), np.int64)
    chunks = [(i, total[i : i + CHUNK]) for i in range(0, vocabulary, CHUNK)]
    chunks = [(i, c) for i, c in chunks if c.any()]
    yield pa.RecordBatch.from_pydict({"first": pa.array([i for i, _ in chunks], pa.int32()), "counts": pa.array([c.tolist() for _, c in chunks], pa.list_(pa.int64()))})


def _frequencies(blocks: DataFrame, vocabulary: int) -> np.ndarray:
    """Occurrences of every id; the result is as long as the vocabulary, whatever the data."""
    sums = (
        blocks.select("counts")
        .filter("counts IS NOT NULL")
        .mapInArrow(lambda b: _counts(b, vocabulary), "first int, counts array<bigint>")
        .select("first", F.posexplode("counts").alias("at", "n"))
        .groupBy((F.col("first") + F.col("at")).alias("id"))
        .agg(F.sum("n").alias("n"))
    )
    counts = np.zeros(vocabulary, np.int64)
    for row in sums.collect():
        counts[row.id] = row.n
    return counts


def _coded(batches: Iterator, freq: bytes) -> Iterator:
    import pyarrow as pa

    schema, table = _arrow(_CODED), Table(np.frombuffer(freq, np.int64))
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            payload = encode_block(np.frombuffer(row.column(6)[0].as_buffer(), np.uint32), table)
            yield pa.RecordBatch.from_arrays([*row.columns[:6], pa.array([payload], pa.binary())], schema=schema)


def _decoded(batches: Iterator, freq: bytes) -> Iterator:
    import pyarrow as pa

    schema, table = _arrow(_DOCS), Table(np.frombuffer(freq, np.int64))
    for batch in batches:
        for row in batch.to_pylist():
            ids = decode_block(row["payload"], table).astype("<u4").tobytes()
            lengths = np.frombuffer(row["lengths"], np.int64)
            ends = np.cumsum(lengths)
            starts = ends - lengths
            docs = [d if k else None for d, k in zip(np.frombuffer(row["doc_ids"], np.int64).tolist(), row["known"], strict=True)]
            crcs = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            same = [[row["part"]] * len(docs), [row["block"]] * len(docs)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip([docs, *same, starts, lengths, crcs], schema.types, strict=True)], schema=schema)


class TokenFiles:
    """A written set of coded blocks (``blocks.path``) and the shared table of counts."""

    def __init__(self, blocks: Stage, counts: np.ndarray):
        self.blocks, self.counts = blocks, counts

    def read_documents(self) -> DataFrame:
        """Decodes all blocks: (doc_id, start, n_tokens, ids_crc32); start counts the ids of all documents before."""
        freq = self.counts.tobytes()
        index = self.blocks.df.groupBy("part").agg(F.sum("n_ids").alias("n"))
        before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        parts = index.select(F.col("part").alias("_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
        inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        blocks = self.blocks.df.select("part", "block", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("block_start"))
        starts = blocks.join(parts, F.col("part") == F.col("_part")).select("part", "block", (F.col("part_start") + F.col("block_start")).alias("base"))
        docs = self.blocks.df.mapInArrow(lambda b: _decoded(b, freq), _DOCS)
        return docs.join(small_side(Stage(starts, "rans-starts").df), ["part", "block"]).select("doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def write_tokens(docs: DataFrame, path: str, end_id: int, id: str = "doc_id", text: str = "text") -> TokenFiles:
    from tokenizers import Tokenizer

    vocabulary = max(Tokenizer.from_file(path).get_vocab_size(), end_id + 1)
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).withColumn("tie", F.xxhash64("text"))
    n = 2 * shuffle_partitions(docs.sparkSession)
    dealt = rows.repartitionByRange(n, "id", "tie").sortWithinPartitions("id", "tie").select("id", "text")
    raw = Stage(dealt.mapInArrow(lambda b: _blocks(b, path, end_id, vocabulary), _RAW), "rans-ids")
    counts = _frequencies(raw.df, vocabulary)
    freq = counts.tobytes()
    coded = Stage(raw.df.drop("counts").filter("n_ids > 0").mapInArrow(lambda b: _coded(b, freq), _CODED), "rans-blocks")
    raw.drop()
    return TokenFiles(coded, counts)
