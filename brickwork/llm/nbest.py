"""N-best segmentation of texts into the pieces of a SentencePiece vocabulary.

The text is normalised as the vocabulary asks (a blank in front, blanks as U+2581).  Its lattice has an
edge for every piece found in it, and for each character without a piece one edge of its byte pieces.
A forward Viterbi pass gives the best score of every prefix; these are exact heuristics for an A-star search
backward from the end, which so yields segmentations in the order of their scores and visits no others.

No piece reaches over the end of a word (a line end, or a blank after something else), so the lattice of a
text is the chain of the lattices of its words.  A word's passes run once a worker and are remembered; the new words of
some texts are learned together, as columns: all edges by their length, then all passes place by place.
The second-best segmentations of a text differ from the best in the words that lose least; with n wanted
only n - 1 such words matter, and the same search runs over the chain of their alternatives.

The vocabulary's pieces are ranked, not scored by likelihood; a piece of rank r has the log-probability
-ln(r + 2) of a Zipf law, a byte piece 10 less than the last piece.

Defined cases: NULL counts as the empty text, which has one segmentation, of no pieces; with fewer than n
segmentations all are returned; equal scores are ordered by the search alone, the same way each time;
U+2581 in a text is a blank.
"""

from __future__ import annotations

import heapq
import itertools
import math
import re
import struct
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from brickwork.llm.common import remembered

BLANK = "▁"
MEMORY = 700_000
#: Characters of texts that are segmented together, of parts that are learned together, and of the longest such part.
GROUP, COLUMN, LONG = 250_000, 50_000, 64
_WORDS = re.compile(f"{BLANK}+[^{BLANK}\n]*|[^{BLANK}\n]+|\n")


def words_of(text: str) -> list[str]:
    """A text's words with their blanks; empty strings may lie between."""
    if not text:
        return []
    if "  " in text or BLANK in text:
        return _WORDS.findall(BLANK + text.replace(" ", BLANK))
    return (BLANK + text.replace(" ", " " + BLANK).replace("\n", " \n ")).split(" ")


def a_star(ends: list[list[tuple]], ahead: list[float], n: int) -> list[tuple[float, list]]:
    """The n best paths from place 0 to the last, backward; ``ends[j]`` has (place, score, label) of the
    edges into j, ``ahead`` the best scores from 0.  Of equal costs the place nearest to 0 goes on; a place is left at
    most n times, as its first n visits hold the n best ways behind it."""
    found: list[tuple[float, list]] = []
    heap = [(-ahead[-1], len(ahead) - 1, 0, 0.0, None)]
    visits = [0] * len(ahead)
    made = 0
    while heap and len(found) < n:
        cost, at, _, behind, path = heapq.heappop(heap)
        if at == 0:
            labels = []
            while path:
                labels.append(path[0])
                path = path[1]
            found.append((-cost, labels))
            continue
        visits[at] += 1
        if visits[at] > n:
            continue
        for start, score, label in ends[at]:
            if ahead[start] > -math.inf and visits[start] < n:
                made += 1
                heapq.heappush(heap, (-(ahead[start] + score + behind), start, made, score + behind, (label, path)))
    return found


def _points(text: str):
    """The code points of a text."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _held_in(keys, wanted):
    """Which of ``wanted`` are among the sorted ``keys``."""
    return keys[np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)] == wanted


class Segmenter:
    """A vocabulary, and what is known of the words met so far."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        first = plain[0]
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        self.byte_score = -math.log(size - first + 2) - 10
        self.known: dict[str, tuple | None] = {}
        for i in plain:
            piece = self.pieces[i]
            for k in range(1, len(piece)):
                self.known.setdefault(piece[:k], None)
            self.known[piece] = (-math.log(i - first + 2), (i,))
        self.columns({p[k : k + 2] for p in (self.pieces[i] for i in plain) for k in range(len(p) - 1)})
        byte_of = {i: b for b, i in self.bytes.items()}
        self.spelled = [bytes([byte_of[i]]) if i in byte_of else p.replace(BLANK, " ").encode() for i, p in enumerate(self.pieces)]
        self.forget()

    def columns(self, joints: set[str]) -> None:
        """The pieces as a tree: ``child`` has parent and character of each node, sorted; node 0 is the empty start.
        ``joints``: the characters that pieces have next to each other."""
        letters = sorted({c for piece in self.known for c in piece})
        self.code = np.zeros(0x110000, np.int64)
        self.code[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.width = len(letters) + 1
        place = {p: i for i, p in enumerate(sorted(self.known, key=len), 1)} | {"": 0}
        code = lambda c: int(self.code[ord(c)])
        child = np.array([place[p[:-1]] * self.width + code(p[-1]) for p in self.known], np.int64)
        order = child.argsort()
        self.child, self.node = child[order], np.array([place[p] for p in self.known], np.int64)[order]
        self.node_score, self.node_piece = np.full(len(place), -np.inf), np.full(len(place), -1, np.int32)
        for p, hit in self.known.items():
            if hit:
                self.node_score[place[p]], self.node_piece[place[p]] = hit[0], hit[1][0]
        self.joint = np.sort(np.array([code(a) * self.width + code(b) for a, b in joints], np.int64))
        self.depth = max(map(len, self.known))
        self.byte_ids = np.array([self.bytes.get(b, 0) for b in range(256)], "<u4")

    def forget(self, room: int = 0) -> None:
        """Room for so many words and parts of words; a word has at most one part a character."""
        self.index: dict[str, int] = {}
        self.ids: list[bytes] = []
        self.best, self.loss = np.zeros(room + 1), np.zeros(room + 1)
        self.size = np.zeros(room + 1, np.int64)

    def edges(self, word: str) -> Iterator[tuple[int, int, float, tuple]]:
        """(start, end, score, ids) by start."""
        known, n = self.known, len(word)
        for i in range(n):
            single = False
            for j in range(i + 1, n + 1):
                hit = known.get(word[i:j], False)
                if hit is False:
                    break
                if hit:
                    single |= j == i + 1
                    yield i, j, hit[0], hit[1]
            if not single:
                raw = word[i].encode("utf-8", "surrogatepass")
                yield i, i + 1, self.byte_score * len(raw), tuple(self.bytes[b] for b in raw)

    def forward(self, word: str) -> tuple[list[list[tuple]], list[float]]:
        """Edges by end, and the best scores of the prefixes."""
        n = len(word)
        ends: list[list[tuple]] = [[] for _ in range(n + 1)]
        ahead = [0.0] + [-math.inf] * n
        for i, j, score, ids in self.edges(word):
            ends[j].append((i, score, ids))
            ahead[j] = max(ahead[j], ahead[i] + score)
        return ends, ahead

    def nbest(self, word: str, n: int) -> list[tuple[float, bytes]]:
        ends, ahead = self.forward(word)
        return [(score, np.array([i for ids in labels for i in ids], "<u4").tobytes()) for score, labels in a_star(ends, ahead, n)]

    def keep(self, word: str, ids: bytes, best: float, loss: float) -> int:
        at = self.index[word] = len(self.ids)
        self.ids.append(ids)
        self.best[at], self.loss[at], self.size[at] = best, loss, len(ids)
        return at

    def learn_part(self, word: str) -> int:
        n, known = len(word), self.known
        ahead, last = [0.0] + [-math.inf] * n, [None] * (n + 1)
        edges = []
        for i in range(n):
            here, single = ahead[i], False
            for j in range(i + 1, n + 1):
                hit = known.get(word[i:j], False)
                if hit is False:
                    break
                if hit is not None:
                    single = single or j == i + 1
                    score = here + hit[0]
                    edges.append((i, j, hit[0]))
                    if score > ahead[j]:
                        ahead[j], last[j] = score, (i, hit[1])
            if not single:
                raw = word[i].encode("utf-8", "surrogatepass")
                cost = self.byte_score * len(raw)
                edges.append((i, i + 1, cost))
                if here + cost > ahead[i + 1]:
                    ahead[i + 1], last[i + 1] = here + cost, (i, tuple(self.bytes[b] for b in raw))
        path, on_path, j = [], set(), n
        while j:
            i, ids = last[j]
            on_path.add((i, j))
            path.append(ids)
            j = i
        behind, second = [-math.inf] * n + [0.0], -math.inf
        for i, j, score in reversed(edges):
            rest = score + behind[j]
            if rest > behind[i]:
                behind[i] = rest
            rest += ahead[i]
            if rest > second and (i, j) not in on_path:
                second = rest
        ids = struct.pack(f"<{sum(map(len, path))}I", *(i for ids in reversed(path) for i in ids))
        return self.keep(word, ids, ahead[n], ahead[n] - second)

    def learn_words(self, words: list[str]) -> None:
        """Best segmentations of new words, and what the second best lose.  A word is cut between any two characters that no
        piece has next to each other; its parts are learned first."""
        flat = "".join(words)
        letters = self.code[_points(flat)]
        first = np.zeros(len(flat) + 1, bool)
        first[1:-1] = ~_held_in(self.joint, letters[:-1] * self.width + letters[1:])
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        first[0] = first[ends] = True
        cuts = np.flatnonzero(first)
        parts = [flat[i:j] for i, j in itertools.pairwise(cuts.tolist())]
        new = [p for p in dict.fromkeys(parts) if p not in self.index]
        short = [p for p in new if len(p) <= LONG]
        for p in new:
            if len(p) > LONG:
                self.learn_part(p)
        held = np.cumsum(np.fromiter(map(len, short), np.int64, len(short)))
        for some in np.split(np.arange(len(short)), np.flatnonzero(np.diff(held // COLUMN)) + 1):
            if len(some):
                self.learn_parts(short[some[0] : some[-1] + 1])
        at = np.fromiter(map(self.index.__getitem__, parts), np.int64, len(parts))
        stops = np.searchsorted(cuts, ends)
        starts = np.concatenate([[0], stops[:-1]])
        many = np.flatnonzero(stops - starts > 1)
        starts, stops = starts[many], stops[many]
        scores, count = self.best[at], stops - starts
        best = scores[starts]
        for k in range(1, 8):  # one after the other, as the sum over a few parts goes
            more = count > k
            best[more] += scores[starts[more] + k]
        for k in np.flatnonzero(count >= 8).tolist():
            best[k] = scores[starts[k] : stops[k]].sum()
        loss = np.minimum.reduceat(self.loss[at], np.column_stack([starts, stops - 1]).ravel())[::2] if len(many) else np.zeros(0)
        loss = np.minimum(loss, self.loss[at][stops - 1])
        at = at.tolist()
        self.keep_all(
            [words[k] for k in many.tolist()],
            [b"".join([self.ids[k] for k in at[i:j]]) for i, j in zip(starts.tolist(), stops.tolist(), strict=True)],
            best,
            loss,
        )

    def keep_all(self, words: list[str], ids: list[bytes], best, loss) -> None:
        at, n = len(self.ids), len(words)
        self.index.update(zip(words, range(at, at + n), strict=True))
        self.ids += ids
        self.best[at : at + n], self.loss[at : at + n] = best, loss
        self.size[at : at + n] = np.fromiter(map(len, ids), np.int64, n)

    def learn_parts(self, parts: list[str]) -> None:
        """What ``learn_part`` finds, for many parts at once.  Each part has a place before, between and after its characters;
        a row of ``score`` has the edges into a place by their start, the first start in front, and ``piece`` what they are
        (-1: bytes).  Places without a part in front and behind keep all looks inside the table."""
        parts = sorted(parts, key=len, reverse=True)
        n = np.fromiter(map(len, parts), np.int64, len(parts))
        points = _points("".join(parts))
        deep = min(self.depth, int(n[0]))
        back = np.arange(deep, 0, -1)
        begin = deep + np.cumsum(n + 1) - (n + 1)
        end = begin + n
        places = int(end[-1]) + 1 + deep
        here = np.arange(len(points)) + np.repeat(np.arange(len(parts)), n) + deep
        score, piece = np.full((places, deep), -np.inf), np.full((places, deep), -1, np.int32)

        letters, left = np.zeros(places, np.int64), np.zeros(places, np.int64)
        letters[here], left[here] = self.code[points], np.repeat(end, n) - here
        start, node = here, np.zeros(len(here), np.int64)
        single = np.zeros(places, bool)
        for d in range(1, deep + 1):
            fits = left[start] >= d
            start, node = start[fits], node[fits]
            wanted = node * self.width + letters[start + d - 1]
            found = np.minimum(np.searchsorted(self.child, wanted), len(self.child) - 1)
            hit = self.child[found] == wanted
            start, node = start[hit], self.node[found[hit]]
            whole = self.node_piece[node] >= 0
            score[start[whole] + d, deep - d], piece[start[whole] + d, deep - d] = self.node_score[node[whole]], self.node_piece[node[whole]]
            if d == 1:
                single[start[whole]] = True
        raw = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        plain = ~single[here]
        score[here[plain] + 1, deep - 1] = self.byte_score * raw[plain]

        ahead, last = np.full(places, -np.inf), np.zeros(places, np.int64)
        ahead[begin] = 0.0
        for t in range(1, int(n[0]) + 1):
            at = begin[: np.searchsorted(-n, -t, "right")] + t
            near = max(deep - t, 0)
            ways = ahead[at[:, None] - back[near:]] + score[at, near:]
            taken = ways.argmax(1)
            ahead[at], last[at] = ways[np.arange(len(at)), taken], back[near:][taken]
        behind, forth = np.full(places, -np.inf), np.arange(1, deep + 1)
        behind[end] = 0.0
        for t in range(1, int(n[0]) + 1):
            at = end[: np.searchsorted(-n, -t, "right")] - t
            to = at[:, None] + forth[:t]
            behind[at] = (score[to, deep - forth[:t]] + behind[to]).max(1)

        at, path = end, np.zeros(places, bool)
        while len(at):
            path[at] = True
            at = at - last[at]
            at = at[last[at] > 0]
        steps = np.flatnonzero(path)
        taken = deep - last[steps]
        rest = score + behind[:, None]
        rest[deep:] += ahead[np.arange(deep, places)[:, None] - back]
        rest[steps, taken] = -np.inf
        second = np.maximum.reduceat(rest.max(1), begin)

        found = piece[steps, taken]
        character = np.zeros(places, np.int64)
        character[here + 1] = np.arange(len(points))
        spelled = character[steps[found < 0]]
        long = np.ones(len(steps), np.int64)
        long[found < 0] = raw[spelled]
        as_bytes = np.repeat(found < 0, long)
        ids = np.empty(len(as_bytes), "<u4")
        ids[~as_bytes] = found[found >= 0]
        text = points[spelled].tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
        ids[as_bytes] = self.byte_ids[np.frombuffer(text, np.uint8)]
        held = np.zeros(places, np.int64)
        held[steps] = 4 * long
        held, whole = held.cumsum(), ids.tobytes()
        self.keep_all(parts, [whole[i:j] for i, j in zip(held[begin].tolist(), held[end].tolist(), strict=True)], ahead[end], ahead[end] - second)

    def segment(self, text: str, n: int) -> list[tuple[float, bytes]]:
        """The n best segmentations of a text: scores and ids."""
        return next(self.segments([text], n))

    def segments(self, texts: list[str], n: int) -> Iterator[list[tuple[float, bytes]]]:
        """The n best segmentations of each text."""
        size = np.cumsum([len(t) for t in texts])
        for some in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(size // GROUP)) + 1):
            group = [words_of(texts[i]) for i in some.tolist()]
            met = set().union(*group)
            new = [w for w in met if w not in self.index]
            if len(self.ids) + sum(map(len, new)) + len(new) > min(MEMORY, len(self.best) - 1):
                new = list(met)
                self.forget(max(MEMORY, sum(map(len, new)) + len(new)))
            if "" in new:
                new.remove("")
                self.learn_part("")
            if new:
                self.learn_words(new)
            for words in group:
                yield self.ways(words, n)

    def ways(self, words: list[str], n: int) -> list[tuple[float, bytes]]:
        at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        whole, best = float(self.best[at].sum()), b"".join(map(self.ids.__getitem__, at.tolist()))
        found = [(whole, best)]
        loss = self.loss[at]
        few = loss.argsort(kind="stable") if len(loss) < 4 * n else np.argpartition(loss, n - 1)
        few = sorted(i for i in few[: n - 1].tolist() if loss[i] < math.inf)
        if n == 1 or not few:
            return found
        chain: list[list[tuple]] = [[]]
        spans = np.cumsum(self.size[at])
        others = [self.nbest(words[i], n) for i in few]
        for k, ways in enumerate(others):
            chain.append([(k, score - ways[0][0], raw) for score, raw in ways])
        for score, raws in a_star(chain, [0.0] * len(chain), n)[1:]:
            changed, done = [], 0
            for i, raw in zip(few, raws, strict=True):
                end = int(spans[i])
                changed += [best[done : end - int(self.size[at[i]])], raw]
                done = end
            found.append((whole + score, b"".join([*changed, best[done:]])))
        return found

    def decode(self, ids: bytes) -> str:
        """The text of piece ids, without the blank in front."""
        spelled = b"".join(map(self.spelled.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return spelled.decode("utf-8", "surrogatepass")[1:]


def segmenter(path: str) -> Segmenter:
    """One memory a Python worker."""
    return remembered(("pieces", path), lambda: Segmenter(path))


def nbest(docs: DataFrame, path: str, n: int = 4, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, rank, score, ids) of the ``n`` best segmentations of each text; ids are little-endian unsigned 32-bit."""
    schema = "doc_id bigint, rank int, score double, ids binary"

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        segments = segmenter(path).segments
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = []
                texts = [value or "" for value in part.column(1).to_pylist()]
                for doc_id, found in zip(part.column(0).to_pylist(), segments(texts, n), strict=True):
                    rows += [(doc_id, r, s, raw) for r, (s, raw) in enumerate(found, 1)]
                kinds = [pa.int64(), pa.int32(), pa.float64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds, strict=True)], names=["doc_id", "rank", "score", "ids"])

    return docs.select(F.col(id).cast("long"), F.col(text)).mapInArrow(run, schema)


class Speller:
    """The texts of many segmentations at once: pieces taken by id lie one behind the other, as their texts do.  Holds the
    pieces twice, the second time without the first byte, for the blank in front of a text."""

    def __init__(self, path: str):
        import pyarrow as pa
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        names = [(i, model.id_to_piece(i)) for i in range(self.size)]
        spelled = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in names]
        self.pieces = pa.array(spelled + [p[1:] for p in spelled], pa.large_binary())

    def texts(self, rows):
        """A column of little-endian ids as texts, without the blank in front; NULL stays NULL."""
        import pyarrow as pa
        import pyarrow.compute  # noqa: F401

        rows = rows.cast(pa.large_binary())
        empty = rows.fill_null(b"")
        ends = np.frombuffer(empty.buffers()[1], np.int64)[empty.offset : empty.offset + len(empty) + 1]
        raw = empty.buffers()[2]
        ids = np.frombuffer(raw, "<u4", (ends[-1] - ends[0]) // 4, int(ends[0])).astype(np.int64) if raw is not None else np.zeros(0, np.int64)
        ends = (ends - ends[0]) // 4
        ids[ends[:-1][ends[:-1] < ends[1:]]] += self.size
        found = self.pieces.take(pa.array(ids))
        at = np.frombuffer(found.buffers()[1], np.int64)[: len(found) + 1] if len(found) else np.zeros(1, np.int64)
        known = pa.compute.is_valid(rows)
        bits = pa.array(known).buffers()[1] if rows.null_count else None
        column = pa.LargeStringArray.from_buffers(len(rows), pa.py_buffer(at[ends].tobytes()), found.buffers()[2] or pa.py_buffer(b""), bits)
        column.validate(full=True)
        return column.cast(pa.string())


def decode(found: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``found`` with its ids replaced by their text."""
    kept = [c for c in found.columns if c not in (ids, text)]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        spell = remembered(("spelling", path), lambda: Speller(path)).texts
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], spell(part.column(len(kept)))], names=[*kept, text])

    rows = found.select(*kept, ids)
    return rows.mapInArrow(run, StructType([*rows.schema.fields[:-1], StructField(text, StringType())]))
