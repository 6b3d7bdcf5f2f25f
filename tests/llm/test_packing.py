"""Packing: every id in one piece, windows full but one a task, steps even."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from brickwork.llm import packing
from brickwork.llm.encode import words

PATH = public_tokenizers.path("byte_bpe_50k.json")


def ids_of(text, path=PATH, end=0):
    t = Tokenizer.from_file(path)  # as it comes: control tokens in a text keep their ids
    return np.array([*t.encode(text or "", add_special_tokens=False).ids, end], "<u4")


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_remembered_words_equal_the_tokenizer(name):
    encoder, plain = words(public_tokenizers.path(name)), Tokenizer.from_file(public_tokenizers.path(name))
    texts = [
        "", " a", "a ", "a\n\nb", "a  b", "\n", "\tX y", "It's  don't we're", "x <|endoftext|> y", "é É ñandú", "a\xa0b c", "Å x", "ΣΑΣ x", "12 3,4 5.5",
        "<|endoftext|>", "a<|endoftext|>b", "a\n<|startoftext|> <|endoftext|>.", "<|ENDOFTEXT|> x", "<|endoftext|",
        "  ", "a\n b", "A\nB.\nC!", "\nfoo", "foo\n", "日本語 テスト a", "it's\nwe'll", "İstanbul ß ẞ x", "a b c\x1cd e", "don't. 'S", "x…y", "Word. word, WORD!",
    ]
    for text in texts * 2:
        want = plain.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want, text


def check(rows, docs):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    want = {d: ids_of(t) for d, t in docs}
    assert set(by_doc) == set(want)
    for d, pieces in by_doc.items():
        pieces.sort(key=lambda r: r.start)
        assert [r.start for r in pieces] == np.concatenate([[0], np.cumsum([r.length for r in pieces])])[:-1].tolist()
        assert b"".join(r.ids for r in pieces) == want[d].tobytes()
        assert {r.doc_tokens for r in pieces} == {len(want[d])}
    lengths = []
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == np.concatenate([[0], np.cumsum([r.length for r in pieces])])[:-1].tolist()
        lengths.append(sum(r.length for r in pieces))
    return lengths


def test_pieces_and_windows(spark):
    docs = [(i, "word " * (i * 37 % 2600)) for i in range(120)] + [(500, None), (501, ""), (502, "long text " * 9000), (None, "x")]
    frame = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, part int").coalesce(2)
    rows = packing.pack_documents(frame, PATH).collect()
    lengths = check(rows, docs)
    assert max(lengths) <= 1024
    odd = [n for n in lengths if n & (n - 1)]
    assert len(odd) <= 2
    steps = {}
    for r in {(r.sequence_id, r.tier, r.step) for r in rows}:
        steps.setdefault(r[1:], []).append(r[0])
    for (tier, _), sequences in steps.items():
        assert len(sequences) <= 65_536 // tier


def test_repeated_rows_and_empty_table(spark):
    frame = spark.createDataFrame([(1, "same"), (1, "same")], "doc_id long, text string")
    assert sum(r.length for r in packing.pack_documents(frame, PATH).collect()) == 2 * len(ids_of("same"))
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
