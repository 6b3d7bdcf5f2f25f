"""Corpus-wide line dedup over levelled sorted runs of line hashes, with DataFrame operations only.

A line's key is the line without ASCII white space at both ends, A-Z lower-cased; only keys of at least
``min_chars`` code points count.  Keys are compared by 128 bits of hash.  Keys found in at least
``min_docs`` documents are repeated; a repeated key keeps its lines in the document of the largest id only.

Documents come in batches of descending id.  A *run* holds, for the line hashes of a stretch of batches, in how many
documents each was found and which document keeps it.  It is a bucketed and sorted table, so that a batch, dealt to the
same buckets, is merge-anti-joined with it as it lies: a hash that no run holds is new, and its largest document in the
batch keeps it; for the others only their documents are counted.  The batch is then written as a run of level 0.
When a level has ``fanout`` runs they are merged, bucket by bucket, into one run of the next level, counts added, so n
batches leave about log(n) runs to join with.  After the last batch the runs hold the counts of all lines and every
keeper.

Defined cases: NULL or empty text is one empty line; a NULL id counts as smaller than any other; rows that share
an id are one document to the rule and are cleaned each; a document whose lines all go keeps an empty text.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brickwork.llm.common import Stage, drop_path, shared_dir, shuffle_partitions, small_side

SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASH = ["h1", "h2"]
BROADCAST_BYTES = 64 << 20


def ascii_lower(text: Column) -> Column:
    """A-Z only; ``lower`` is the faster of two equal ways where all characters are ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


#: Lets a scan of a bucketed table with one file a bucket pass its order on to a merge join.
KEEP_ORDER = "spark.sql.legacy.bucketedTableScan.outputOrdering"


class Run:
    """A written run: (h1, h2, keeper, docs) in buckets of the hashes, sorted by them, a file a bucket.  ``keeper`` is
    NULL where an earlier run has it; ``docs`` counts documents."""

    def __init__(self, rows: DataFrame, buckets: int):
        self.spark, name = rows.sparkSession, f"lines_run_{uuid.uuid4().hex}"
        self.name, self.path = name, f"{shared_dir(self.spark).rstrip('/')}/{name}"
        writer = rows.repartition(buckets, *HASH).write.bucketBy(buckets, *HASH).sortBy(*HASH)
        with ordered_scans(self.spark):
            writer.format("parquet").option("path", self.path).saveAsTable(name)
        self.df = self.spark.table(name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        drop_path(self.spark, self.path)


@contextmanager
def ordered_scans(spark: SparkSession) -> Iterator[None]:
    """While a run is read and written; the session's own setting comes back after."""
    before = spark.conf.get(KEEP_ORDER)
    spark.conf.set(KEEP_ORDER, "true")
    try:
        yield
    finally:
        spark.conf.set(KEEP_ORDER, before)


class Runs:
    """Levels of runs."""

    def __init__(self, fanout: int, buckets: int):
        self.fanout, self.buckets, self.levels = fanout, buckets, []

    def all(self) -> list[Run]:
        return [run for level in self.levels for run in level]

    def unseen(self, keys: DataFrame) -> DataFrame:
        """Merge-anti-join: the keys that no run holds."""
        for run in self.all():
            keys = keys.join(run.df.select(*HASH).hint("merge"), HASH, "left_anti")
        return keys

    def add_batch(self, found: DataFrame) -> None:
        """``found``: (h1, h2, keeper, docs) of a batch.  Hashes that a run holds lose their keeper."""
        batch = Stage(found, "lines-batch")
        new = self.unseen(batch.df.select(*HASH)).withColumn("new", F.lit(True)) if self.all() else batch.df.select(*HASH, F.lit(True).alias("new"))
        keeper = F.when(F.col("new"), F.col("keeper")).alias("keeper")
        marked = batch.df.join(new.hint("merge"), HASH, "left").select(*HASH, keeper, "docs") if self.all() else batch.df
        self.add(marked)
        batch.drop()

    def add(self, rows: DataFrame, level: int = 0) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(Run(rows, self.buckets))
        if len(self.levels[level]) < self.fanout:
            return
        runs, self.levels[level] = self.levels[level], []
        self.add(merged(runs), level + 1)
        for run in runs:
            run.drop()

    def whole(self) -> DataFrame | None:
        """All hashes with their counts and keepers, the runs merged as they are read."""
        return merged(self.all()) if self.all() else None


def merged(runs: list[Run]) -> DataFrame:
    """Merge joins of the runs, bucket by bucket: counts added, the one keeper kept."""
    whole = runs[0].df.select(*HASH, "keeper", "docs")
    for run in runs[1:]:
        more = run.df.select(*HASH, F.col("keeper").alias("keeper2"), F.col("docs").alias("docs2")).hint("merge")
        both = whole.join(more, HASH, "full_outer")
        docs = F.coalesce("docs", F.lit(0)) + F.coalesce("docs2", F.lit(0))
        whole = both.select(*HASH, F.coalesce("keeper", "keeper2").alias("keeper"), docs.alias("docs"))
    return whole


def _text(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def hashed_lines(docs: DataFrame, id: str, text: str, min_chars: int) -> DataFrame:
    """(doc, version, pos, h1, h2) of the lines with long enough keys; version tells rows of one id apart."""
    lines = docs.select(F.col(id).alias("doc"), F.xxhash64(_text(text)).alias("version"), F.posexplode(F.split(_text(text), "\n")).alias("pos", "line"))
    keyed = lines.select("doc", "version", "pos", ascii_lower(F.btrim("line", F.lit(SPACE))).alias("key")).filter(F.length("key") >= min_chars)
    return keyed.select("doc", "version", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"))


def _batches(docs: DataFrame, id: str, batches: int) -> tuple[F.Column, int]:
    """The number of a document's batch, by descending id (NULL ids last), and how many there are."""
    shares = [i / batches for i in range(1, batches)]
    cuts = docs.agg(F.percentile_approx(id, shares, 1000)).first()[0] if shares else []
    cuts = sorted(set(cuts or []))
    number = F.lit(0)
    for cut in cuts:
        number = number + F.when(F.col("doc") > cut, 0).otherwise(1)
    return number, len(cuts) + 1


def dropped_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", min_chars: int = 20, min_docs: int = 3, batches: int = 4, fanout: int = 2) -> DataFrame:
    """(doc, version, pos) of every line to drop."""
    number, n = _batches(docs, id, batches)
    lines = Stage(hashed_lines(docs, id, text, min_chars).withColumn("batch", number), "lines-batches", partition_by="batch")
    runs = Runs(fanout, shuffle_partitions(docs.sparkSession))
    for batch in range(n):
        held = lines.df.filter(F.col("batch") == batch).groupBy(*HASH, "doc").agg(F.lit(1).alias("one"))
        # NULL is the smallest document: it keeps a line where no other holds it
        place = F.struct(F.col("doc").isNotNull().alias("known"), "doc")
        runs.add_batch(held.groupBy(*HASH).agg(F.max(place).alias("keeper"), F.count(F.lit(1)).alias("docs")))
    with ordered_scans(docs.sparkSession):
        repeated = Stage(runs.whole().filter(F.col("docs") >= min_docs).select(*HASH, "keeper.doc").withColumnRenamed("doc", "keeper"), "lines-repeated")
    for run in runs.all():
        run.drop()
    late = (F.col("doc") < F.col("keeper")) | (F.col("doc").isNull() & F.col("keeper").isNotNull())
    return lines.df.join(small_side(repeated.df, 1_000_000), HASH).filter(late).select("doc", "version", "pos")


def dedup_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", n_lines: str = "n_lines", n_dropped: str = "n_dropped", **rule) -> DataFrame:
    """``docs`` with the cleaned ``text`` and two counts (which replace columns of the same names)."""
    dropped = dropped_lines(docs, id, text, **rule)
    places = Stage(dropped.groupBy("doc", "version").agg(F.sort_array(F.collect_set("pos")).alias("gone")), "lines-gone").df
    rows, held = places.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("gone")), F.lit(0))).first()
    places = places.select(F.col("doc").alias("_doc"), F.col("version").alias("_version"), F.col("gone").alias("_gone"))
    places = F.broadcast(places) if 64 * rows + 8 * held <= BROADCAST_BYTES else places.hint("shuffle_hash")
    row = docs.select(F.struct(*docs.columns).alias("_row"), F.col(id).alias("_id"), F.xxhash64(_text(text)).alias("_hash"), _text(text).alias("_text"))
    joined = row.join(places, F.col("_id").eqNullSafe(F.col("_doc")) & (F.col("_hash") == F.col("_version")), "left")
    lines = F.split("_text", "\n")
    total = joined.select("_row", "_text", lines.alias("_lines"), F.coalesce("_gone", F.array().cast("array<int>")).alias("_gone"))

    def stretch(i: Column) -> Column:
        """The lines between dropped line i - 1 and dropped line i."""
        first = F.coalesce(F.get("_gone", i - 1), F.lit(-1)) + 2
        return F.slice("_lines", first, F.coalesce(F.get("_gone", i), F.size("_lines")) - first + 1)

    kept = F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size("_gone")), stretch)), "\n")
    kept = F.when(F.size("_gone") == 0, F.col("_text")).otherwise(kept)
    return total.select(
        *[kept.alias(c) if c == text else F.col("_row")[c].alias(c) for c in docs.columns if c not in (n_lines, n_dropped)],
        F.size("_lines").cast("long").alias(n_lines),
        F.size("_gone").cast("long").alias(n_dropped),
    )
