"""rANS blocks: exact round trips, checkpoints, damage, and token files against the tokenizer."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from brickwork.llm import rans
from tests.llm.test_packing import ids_of

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 50), max_size=400), st.lists(st.integers(0, 1000), min_size=51, max_size=51))
def test_round_trip(ids, counts):
    ids, table = np.array(ids, np.uint32), rans.Table(np.array(counts, np.int64))
    if len(ids):
        assert (rans.decode_block(rans.encode_block(ids, table), table) == ids).all()


def test_checkpoints_and_size():
    ids = (np.random.default_rng(1).zipf(1.3, 500_000) % 49408).astype(np.uint32)
    table = rans.Table(np.bincount(ids, minlength=49408))
    block = rans.encode_block(ids, table)
    for c in (0, 1, 3):
        assert (rans.decode_block(block, table, c) == ids[c * rans.EVERY * rans.LANES :]).all()
    share = np.bincount(ids) / len(ids)
    entropy = -(share[share > 0] * np.log2(share[share > 0])).sum()
    assert len(block) * 8 / len(ids) < 1.1 * entropy


def test_damage_is_found():
    table = rans.Table(np.ones(10, np.int64))
    block = bytearray(rans.encode_block(np.arange(10, dtype=np.uint32), table))
    block[-1] ^= 1
    with pytest.raises(rans.Damaged):
        rans.decode_block(bytes(block), table)


def test_token_files(spark, monkeypatch):
    monkeypatch.setattr(rans, "BLOCK", 50)
    docs = [(i, f"Some words, number {i}. " * (i % 7)) for i in range(40)] + [(90, None), (91, ""), (92, "long " * 20_000)]
    frame = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, id string").repartition(3)
    rows = rans.write_tokens(frame, PATH, 2).read_documents().orderBy("start").collect()
    at = 0
    for (d, t), r in zip(sorted(docs), rows, strict=True):
        ids = ids_of(t, PATH, 2)
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_null_ids_repeats_and_empty_table(spark):
    frame = spark.createDataFrame([(None, "a"), (1, "b"), (1, "b")], "doc_id long, text string")
    rows = rans.write_tokens(frame, PATH, 2).read_documents().orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens) for r in rows] == [(None, 0, 2), (1, 2, 2), (1, 4, 2)]
    assert rans.write_tokens(spark.createDataFrame([], "doc_id long, text string"), PATH, 2).read_documents().count() == 0
