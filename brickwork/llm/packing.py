"""Hierarchical multi-length packing.

Documents are cut into token windows of several context sizes (tiers, powers of two).  A document's
full windows of the longest tier go out as they are; what is left is routed to the shortest tier that
holds it.  Tiers are packed from long to short: each window starts with one piece of its tier, and its gap
is filled with pieces of shorter tiers, whole ones first, the last one cut to measure.  A piece whose
window can't be filled any more is cut to the next tier's size.  So every window is full, but for
one of fewer than ``tiers[-1]`` tokens in each task; that one is padded to the longest tier.

Tasks pack their own rows, so nothing is shuffled and a hot source or a very long document does not matter.
Windows are then numbered within their tier over all tasks and dealt to steps of ``step_tokens`` tokens of one
tier; ``step_at`` (0 to 1) orders the steps so that the mix of tiers stays even.

Defined cases: a NULL or empty text has the end id alone; a NULL id is carried; repeated rows are packed
once each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brickwork.llm.common import TEXTS, Stage, small_side, tidied
from brickwork.llm.encode import MEMORY, words

TIERS = (1024, 512, 256, 128, 64)
#: Characters tokenized before their documents are packed together.
BATCH_CHARS = 4_000_000
SCHEMA = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary, part int, sequence bigint, tier int, tier_rank bigint, offset bigint"


class Packer:
    """Packs the documents of one task; ``rows`` holds the pieces of finished windows."""

    def __init__(self, tiers: tuple[int, ...], part: int):
        self.tiers, self.part = tiers, part
        self.pools: dict[int, list] = {t: [] for t in tiers}
        self.made = dict.fromkeys(tiers, 0)
        self.sequences = 0
        self.rows: list[tuple] = []

    def route(self, doc: tuple, start: int, length: int) -> None:
        longest = self.tiers[0]
        while length >= longest:
            self.emit(longest, [(doc, start, longest)])
            start, length = start + longest, length - longest
        if length:
            self.pools[min(t for t in self.tiers if t >= length)].append((doc, start, length))

    def emit(self, tier: int, pieces: list) -> None:
        offset = 0
        for (doc_id, total, ids), start, length in pieces:
            self.rows.append((doc_id, start, length, total, ids[4 * start : 4 * (start + length)], self.part, self.sequences, tier, self.made[tier], offset))
            offset += length
        self.sequences += 1
        self.made[tier] += 1

    def filler(self, gap: int, below: list[int]) -> tuple | None:
        """The longest whole piece for the gap, else the head of a longer one."""
        for t in below:
            if t <= gap and self.pools[t]:
                return self.pools[t].pop()
        for t in reversed(below):
            if t > gap and self.pools[t]:
                doc, start, length = self.pools[t].pop()
                if length > gap:
                    self.route(doc, start + gap, length - gap)
                return doc, start, min(gap, length)
        return None

    def pack(self) -> None:
        for i, tier in enumerate(self.tiers):
            below = list(self.tiers[i + 1 :]) or [tier]
            while self.pools[tier]:
                window = [self.pools[tier].pop()]
                gap = tier - window[0][2]
                while gap and (piece := self.filler(gap, below)):
                    window.append(piece)
                    gap -= piece[2]
                if not gap:
                    self.emit(tier, window)
                elif below != [tier]:
                    self.cut(window, below[0])
                else:
                    self.pools[tier] = window  # fewer tokens than the shortest window
                    break

    def cut(self, window: list, size: int) -> None:
        """Split what an unfillable window holds at the next tier's size."""
        head, taken = [], 0
        for doc, start, length in window:
            n = min(length, size - taken)
            if n:
                head.append((doc, start, n))
                taken += n
            if length > n:
                self.route(doc, start + n, length - n)
        if taken == size:
            self.emit(size, head)
        else:
            for piece in head:
                self.route(*piece)

    def finish(self) -> None:
        rest = self.pools[self.tiers[-1]]
        if rest:
            self.emit(self.tiers[0], rest)
            self.pools[self.tiers[-1]] = []


def _packed(batches: Iterator, path: str, end_id: int, tiers: tuple[int, ...], memory: int) -> Iterator:
    import numpy as np
    import pyarrow as pa
    from pyspark import TaskContext

    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in SCHEMA.split(", "))])
    encode, end = words(path, memory).encode, np.array([end_id], "<u4").tobytes()
    packer = Packer(tiers, TaskContext.get().partitionId())

    def flush() -> pa.RecordBatch:
        rows, packer.rows = packer.rows, []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types, strict=True)], schema=schema)

    chars = 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            piece = batch.slice(at, 256)
            for doc_id, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                ids = encode(text or "") + end
                packer.route((doc_id, len(ids) // 4, ids), 0, len(ids) // 4)
                chars += len(text or "")
                if chars >= BATCH_CHARS:
                    packer.pack()
                    chars = 0
                    if packer.rows:
                        yield flush()
    packer.pack()
    packer.finish()
    if packer.rows:
        yield flush()


def pack_documents(
    docs: DataFrame,
    path: str,
    id: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
    tiers: tuple[int, ...] = TIERS,
    step_tokens: int = 65_536,
    memory: int = MEMORY,
) -> DataFrame:
    """One row a piece: (doc_id, start, length, doc_tokens, ids, sequence_id, offset, tier, step, step_at).

    ``memory`` is how many words a Python worker remembers; it changes the time taken only."""
    rows = docs.select(F.col(id).cast("long"), F.col(text))
    pieces = Stage(rows.mapInArrow(lambda batches: tidied(_packed(batches, path, end_id, tiers, memory)), SCHEMA), "packing", batch=TEXTS).df
    made = pieces.filter("offset = 0").groupBy("part", "tier").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("tier").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("n").over(Window.partitionBy("tier"))
    base = Stage(made.select("part", "tier", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"), total.alias("total")), "packing-base").df
    in_step = F.floor(F.lit(step_tokens) / F.col("tier"))
    step = F.floor((F.col("base") + F.col("tier_rank")) / in_step)
    return pieces.join(small_side(base), ["part", "tier"]).select(
        "doc_id", "start", "length", "doc_tokens", "ids",
        (F.shiftleft(F.col("part").cast("long"), 40) + F.col("sequence")).alias("sequence_id"),
        "offset", "tier",
        step.alias("step"),
        ((step + 0.5) / F.ceil(F.col("total") / in_step)).alias("step_at"),
    )
