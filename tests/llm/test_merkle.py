"""Merkle manifest: addresses, trees, proofs and edge cases against a plain tree."""

import random
import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from brickwork.llm import merkle, queries

H = lambda s: sha256(s.encode()).hexdigest()


def plain_levels(row):
    levels = [row]
    while len(row) > 1:
        row = [H("".join(row[i : i + 16])) for i in range(0, len(row), 16)]
        levels.append(row)
    return levels


def plain(docs):
    """(doc_id, source, lang, n_chars, text) rows to the query's result."""
    fields = lambda row: "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    groups = {}
    for row in docs:
        tampered = row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
        claim = H(fields([*row[:4], row[4].translate(lower)])) if tampered else H(fields(row))
        groups.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, H(fields(row)), claim, row[0]))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [plain_levels([x[2] for x in sorted(groups[s])]) for s in names]
    top = plain_levels([t[-1][0] for t in trees])
    out = []
    for i, (s, tree) in enumerate(zip(names, trees)):
        for j, (_, _, leaf, claim, doc_id) in enumerate(sorted(groups[s])):
            proof, folded = "", claim
            for at, levels in ((j, tree), (i, top)):
                for row in levels[:-1]:
                    a = at - at % 16
                    before, after = "".join(row[a:at]), "".join(row[at + 1 : a + 16])
                    proof, folded, at = proof + before + after, H(before + folded + after), at // 16
            out.append((doc_id, leaf, tree[-1][0], top[-1][0], H(proof), folded, folded == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 5])
def test_addresses_are_a_layout_of_aligned_subtrees(levels):
    full = 16 ** (levels - 1)
    rng = np.random.default_rng(levels)
    for leaves in {1, full, *rng.integers(1, full + 1, 30).tolist()}:
        places = [merkle.address(k, np.arange(-(-leaves // 16 ** (levels - 1 - k))), levels, leaves) for k in range(levels)]
        assert sorted(np.concatenate(places)) == list(range(merkle.size(levels, leaves)))
        top = levels // 2
        if top:
            assert max(p.max() for p in places[:top]) < min(p.min() for p in places[top:])
            for t, root in enumerate(places[top]):
                per = 16 ** (levels - 1 - top)
                mine = places[-1][t * per : (t + 1) * per]
                assert mine.min() >= root and (t + 1 == len(places[top]) or mine.max() < places[top][t + 1])


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257, 1000, 4096])
def test_block_and_paths(n):
    digests = [H(str(i)) for i in range(n)]
    block = merkle.Block.build(merkle.levels_of(n), digests)
    again = merkle.Block(merkle.levels_of(n), n, block.nodes.tobytes())
    assert [again.level(k) for k in range(again.levels)] == plain_levels(digests)[::-1]
    assert all(merkle.fold(d, path) == again.root() for d, path in zip(digests, again.paths(), strict=True))


def corpus():
    rng = random.Random(5)
    docs = [(i, "web" if i % 3 else rng.choice(["a", "é", "Z", "z", f"s{i % 20}"]), "en", 7, f"Text {i} É") for i in range(700)]
    docs += [(9, None, None, None, None), (11, None, "de", 0, ""), (None, "web", "en", 1, "A"), (None, None, "en", 1, "A"), (3, "", "en", 1, "long " * 50_000)]
    return docs + [docs[5]] * 3 + [(5, docs[5][1], "fr", 2, "Other")]


def run(spark, docs, tmp_path):
    frame = spark.createDataFrame(docs, "doc_id long, source string, lang string, n_chars long, text string")
    path = str(tmp_path / "sf")
    frame.withColumn("tree", F.lit(1)).withColumn("digest", F.lit("x")).write.parquet(f"{path}/documents.parquet")
    return [tuple(r) for r in queries.op11_merkle_manifest(spark, path).collect()]


def test_query_matches_plain_trees(spark, tmp_path):
    rows = corpus()
    assert sorted(run(spark, rows, tmp_path), key=str) == plain(rows)


def test_more_rounds_than_one(spark, tmp_path):
    rows = [(i, "hot" if i % 5 else "cold", "en", i, f"T{i}") for i in range(9000)]
    assert sorted(run(spark, rows, tmp_path), key=str) == plain(rows)


def test_one_row_and_empty(spark, tmp_path):
    rows = [(4, "a", "en", 1, "X")]
    assert run(spark, rows, tmp_path / "one") == plain(rows)
    assert run(spark, [], tmp_path / "none") == []
