"""Periodic runs of words, found by string synchronising sets.

A *run* is a stretch of words with smallest period q, at least 2q long, that no neighbouring word extends.  Texts are
cut into words of a batch, numbered by equality, and joined into one array with a mark of its own after each text, so
every step below is a few array operations for many texts at once.

* Periods below ``DIRECT`` are read from the stretches where word i equals word i + q.
* Longer ones are found at dyadic scales t = 4, 8, 16, ...; scale t finds the periods from 3t to 6t - 1.  A position
  belongs to the scale's synchronising set if the smallest hash among the windows of t words that start at it or up to
  t places later is that of the first or the last of them.  Whether a position belongs depends on the 2t words from it
  alone, so a run of period q >= 3t that has one in its first half has its copy q words on.  Positions of equal 2t words
  and a distance in the scale's range propose that distance as a period.
* Windows with a period of t / 3 or less have no hash: the set leaves highly periodic regions out.  These regions are
  runs of smaller scales, found before.  Where two of one period meet, out of phase, their repetitions run across the
  meeting place; every distance in the scale's range that brings the phases together is proposed as well.  The other
  runs have a member of the set in each half, as a stretch of 3t - 1 words without one is highly periodic.

A proposal (place, period) is stretched to both sides by halving over prefix hashes modulo two primes and is a run if
it is at least two periods long.  One stretch found with several periods keeps the smallest.

Defined cases: NULL and empty texts have no words and no runs; words are equal if their bytes are; a text's length is
bounded by memory of a task alone (about 200 bytes a word); rows are independent, so repeated ids and rows have a
result each.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from hashlib import sha256
from itertools import count

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

DIRECT = 12
#: Bytes of text that are worked on at once; a longer text is worked on alone.
BATCH = 2 << 20
PRIMES = (2147483647, 2147483629)
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mixed(a: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that scatters (shifts and odd factors)."""
    a = (a ^ (a >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    a = (a ^ (a >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return a ^ (a >> np.uint64(31))


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return _mixed(left * np.uint64(0x9E3779B97F4A7C15) + right)


class Prefixes:
    """Hashes of all stretches, from prefix sums modulo two primes."""

    def __init__(self, words: np.ndarray, longest: int):
        self.n = len(words)
        self.steps = [1 << k for k in range(longest.bit_length() - 1, -1, -1)]
        self.sums, self.powers = [], []
        for prime, base in zip(PRIMES, (1_000_003, 998_244_353), strict=True):
            p = np.uint64(prime)
            power = np.ones(self.n + 1, np.uint64)
            done, step = 1, np.uint64(base)
            while done <= self.n:
                more = min(done, self.n + 1 - done)
                power[done : done + more] = power[:more] * step % p
                step, done = step * step % p, done + more
            term = _mixed(words.astype(np.uint64)) % p * power[: self.n] % p
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(term)]))
            self.powers.append(power)

    def same(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the stretches of that length from a and from b >= a are equal."""
        equal = np.ones(len(a), bool)
        for prime, sums, powers in zip(PRIMES, self.sums, self.powers, strict=True):
            p = np.uint64(prime)
            left = (sums[a + length] - sums[a]) % p * powers[b - a] % p
            equal &= left == (sums[b + length] - sums[b]) % p
        return equal

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from a and from b > a agree, by halving the steps."""
        found = np.zeros(len(a), np.int64)
        for step in self.steps:
            fits = np.flatnonzero(b + found + step <= self.n)
            good = fits[self.same(a[fits] + found[fits], b[fits] + found[fits], np.full(len(fits), step))]
            found[good] += step
        return found

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before a and before b > a agree."""
        found = np.zeros(len(a), np.int64)
        for step in self.steps:
            fits = np.flatnonzero(a - found - step >= 0)
            back = found[fits] + step
            good = fits[self.same(a[fits] - back, b[fits] - back, np.full(len(fits), step))]
            found[good] += step
        return found


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, by blocks: a running minimum from each side."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, NONE)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def _direct(words: np.ndarray, period: int) -> np.ndarray:
    """(start, end, period) of the stretches of at least two periods."""
    same = np.zeros(max(len(words) - period, 0) + 2, np.int8)
    same[1:-1] = words[period:] == words[:-period] if period < len(words) else 0
    edge = np.flatnonzero(np.diff(same))
    start, end = edge[::2], edge[1::2] + period
    long = end - start >= 2 * period
    return np.stack([start[long], end[long], np.full(int(long.sum()), period)], axis=1)


def _smallest(runs: np.ndarray) -> np.ndarray:
    """One row a stretch, with the smallest period, by (start, end)."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    return runs[first]


def _synchronising(hashes: np.ndarray, t: int, runs: np.ndarray) -> np.ndarray:
    """Members of the scale's set; ``hashes`` are those of the windows of t words."""
    ids = hashes.copy()
    periodic = runs[(3 * runs[:, 2] <= t) & (runs[:, 1] - runs[:, 0] >= t)]
    if len(periodic):
        depth = np.zeros(len(ids) + 1, np.int64)
        np.add.at(depth, periodic[:, 0], 1)
        np.add.at(depth, periodic[:, 1] - t + 1, -1)
        ids[np.cumsum(depth[:-1]) > 0] = NONE
    least = _sliding_min(ids, t + 1)
    return np.flatnonzero((least != NONE) & ((least == ids[: len(least)]) | (least == ids[t:])))


def _pairs(members: np.ndarray, context: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Members of equal context whose distance lies from 3t to 6t - 1.

    Equal contexts are more than t / 3 apart, so a member has fewer than 18 partners."""
    order = np.lexsort((members, context[members]))
    place, key = members[order], context[members][order]
    starts, periods = [], []
    lag = 1
    while lag < len(place):
        far = place[lag:] - place[:-lag]
        near = (key[lag:] == key[:-lag]) & (far < 6 * t)
        if not near.any():
            break
        good = near & (far >= 3 * t)
        starts.append(place[:-lag][good])
        periods.append(far[good])
        lag += 1
    nothing = np.zeros(0, np.int64)
    return np.concatenate([nothing, *starts]), np.concatenate([nothing, *periods])


def _seams(runs: np.ndarray, prefixes: Prefixes, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Proposals where two highly periodic regions of one period meet out of phase."""
    long = runs[(3 * runs[:, 2] <= t) & (runs[:, 1] - runs[:, 0] >= 3 * t)]
    long = long[np.lexsort((long[:, 0], long[:, 2]))]
    left, right = long[:-1], long[1:]
    meet = (left[:, 2] == right[:, 2]) & (right[:, 0] <= left[:, 1])
    starts, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for (b1, e1, r), (b2, e2, _) in zip(left[meet].tolist(), right[meet].tolist(), strict=True):
        ahead = b2 + np.arange(r)
        shift = ahead[prefixes.same(np.full(r, b1), ahead, np.full(r, r))]
        if not len(shift):
            continue
        phase = (int(shift[0]) - b1) % r
        least = 3 * t + (phase - 3 * t) % r
        distance = np.arange(least, min(6 * t - 1, e1 - b1, e2 - b2) + 1, r)
        anchor = np.maximum(b1, b2 - distance)
        good = anchor < np.minimum(e1, e2 - distance)
        starts.append(anchor[good])
        periods.append(distance[good])
    return np.concatenate(starts), np.concatenate(periods)


def runs_of(words: np.ndarray, longest: int) -> np.ndarray:
    """All (start, end, period) of ``words``, in which no window of more than ``longest`` words repeats."""
    runs = _smallest(np.concatenate([_direct(words, q) for q in range(1, min(DIRECT, max(longest // 2 + 1, 1)))] or [np.zeros((0, 3), np.int64)]))
    if longest < 2 * DIRECT:
        return runs
    prefixes = Prefixes(words, longest)
    hashes, t = _mixed(words.astype(np.uint64) + np.uint64(1)), 1
    while 6 * t <= longest:
        context = _joined(hashes[:-t], hashes[t:]) if len(hashes) > t else hashes[:0]
        if 3 * t >= DIRECT and len(context):
            members = _synchronising(hashes, t, runs)
            members = members[members < len(context)]
            starts, periods = _pairs(members, context, t)
            more, seams = _seams(runs, prefixes, t)
            starts, periods = np.concatenate([starts, more]), np.concatenate([periods, seams])
            first = starts - prefixes.backward(starts, starts + periods)
            end = starts + periods + prefixes.forward(starts, starts + periods)
            found = np.stack([first, end, periods], axis=1)[end - first >= 2 * periods]
            runs = _smallest(np.concatenate([runs, found]))
        hashes, t = context, 2 * t
    return runs


class Found:
    """The runs of one text: (n, 3) of start, length and period, by start, then period."""

    def __init__(self, words: list[bytes], runs: np.ndarray):
        self.words, self.runs = words, runs

    def collapsed(self) -> bytes:
        """The words outside every run's later periods, joined by one blank."""
        if not len(self.runs):
            return b" ".join(self.words)
        depth = np.zeros(len(self.words) + 1, np.int64)
        np.add.at(depth, self.runs[:, 0] + self.runs[:, 2], 1)
        np.add.at(depth, self.runs[:, 0] + self.runs[:, 1], -1)
        kept = np.flatnonzero(np.cumsum(depth[:-1]) == 0)
        return b" ".join([self.words[i] for i in kept.tolist()])

    def longest(self) -> tuple[int, int, int] | None:
        if not len(self.runs):
            return None
        return tuple(self.runs[np.lexsort((self.runs[:, 2], self.runs[:, 0], -self.runs[:, 1]))[0]].tolist())

    def listed(self) -> str:
        return "".join([f"{s},{n},{q}\n" for s, n, q in self.runs.tolist()])


def find(texts: list[bytes], least: int) -> Iterator[Found]:
    """The runs of at least ``least`` words of each text."""
    split = [text.split() for text in texts]
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    parts, starts, at = [], [], 0
    for words in split:
        parts.append(list(map(numbers.__getitem__, words)))
        starts.append(at)
        at += len(words) + 1
    flat = np.empty(at, np.int64)
    for i, (a, part) in enumerate(zip(starts, parts, strict=True)):
        flat[a : a + len(part)] = part
        flat[a + len(part)] = -1 - i
    runs = runs_of(flat, max(map(len, split), default=0))
    runs = runs[runs[:, 1] - runs[:, 0] >= least]
    owner = np.searchsorted(starts, runs[:, 0], side="right") - 1
    runs = np.stack([runs[:, 0] - np.asarray(starts, np.int64)[owner], runs[:, 1] - runs[:, 0], runs[:, 2]], axis=1)
    order = np.lexsort((runs[:, 2], runs[:, 0], owner))
    runs, owner = runs[order], owner[order]
    cuts = np.searchsorted(owner, np.arange(len(split) + 1))
    for words, a, b in zip(split, cuts[:-1], cuts[1:], strict=True):
        yield Found(words, runs[a:b])


RESULT = "n_runs start length period exponent_milli".split()
DIGESTS = ["runs_sha256", "collapsed_sha256"]


def _row(found: Found, texts: bool) -> list:
    best = found.longest() or (None, None, None)
    collapsed, listed = found.collapsed(), found.listed()
    exponent = 1000 * best[1] // best[2] if best[1] else None
    out = [len(found.runs), *best, exponent, sha256(listed.encode()).hexdigest(), sha256(collapsed).hexdigest()]
    return [*out, collapsed.decode()] if texts else out


def _batches(column) -> Iterator[tuple[int, int, list[bytes]]]:
    """Stretches of rows with at most ``BATCH`` bytes of text (or one row)."""
    import pyarrow as pa

    held, size, first = [], 0, 0
    for i, text in enumerate(column.cast(pa.binary())):
        text = text.as_py() or b""
        if held and size + len(text) > BATCH:
            yield first, i, held
            held, size, first = [], 0, i
        held.append(text)
        size += len(text)
    if held:
        yield first, first + len(held), held


def periodic_runs(docs: DataFrame, text: str | Column = "text", least: int = 12, keep: list[str] | None = None, collapsed: str | None = None) -> DataFrame:
    """The columns of ``docs`` (or those in ``keep``) with n_runs, the longest run's start, length, period and
    exponent_milli, and digests of all runs and of the collapsed text; with ``collapsed``, also that text in a column of
    this name.  Columns of these names are replaced."""
    names = [*RESULT, *DIGESTS, *([collapsed] if collapsed else [])]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in names]
    rows = docs.select(*kept, (F.col(text) if isinstance(text, str) else text).alias("_periods_text"))
    kinds = [LongType()] * len(RESULT) + [StringType()] * (len(names) - len(RESULT))
    schema = StructType([*rows.schema.fields[:-1], *(StructField(n, k) for n, k in zip(names, kinds, strict=True))])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        types = [pa.int64()] * len(RESULT) + [pa.string()] * (len(names) - len(RESULT))
        for batch in batches:
            for first, end, texts in _batches(batch.column(batch.num_columns - 1)):
                found = zip(*[_row(f, collapsed is not None) for f in find(texts, least)], strict=True)
                more = [pa.array(c, k) for c, k in zip(found, types, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.slice(first, end - first).columns[:-1], *more], names=schema.names)

    return rows.mapInArrow(run, schema)
