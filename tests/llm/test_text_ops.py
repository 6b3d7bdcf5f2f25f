"""N-best segmentation, licence rules and the pipeline."""

from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from brickwork.llm import licences, nbest, queries
from tests.llm import test_jaccard, test_lines, test_packing

PATH = public_tokenizers.path("piece_bpe_32k.model")


def all_segmentations(s, text):
    full = nbest.BLANK + text.replace(" ", nbest.BLANK) if text else ""
    after = {}
    for i, j, score, ids in s.edges(full):
        after.setdefault(i, []).append((j, score, ids))

    def go(i, score, ids):
        if i == len(full):
            yield score, ids
        for j, w, more in after.get(i, ()):
            yield from go(j, score + w, ids + more)

    return sorted(go(0, 0.0, ()), key=lambda x: -x[0])


@pytest.mark.parametrize("text", ["x" * 1000, "x" * 100_000, "ab" * 20_000, "-" * 100_000, "é" * 20_000, "a" * 500 + " " + "a" * 500])
def test_ties_end_soon(text):
    """Equal characters have very many segmentations of equal score."""
    s = nbest.Segmenter(PATH)
    found = s.segment(text, 4)
    assert 1 < len(found) <= 4 and all(s.decode(ids) == text for _, ids in found)
    assert [x for x, _ in found] == sorted((x for x, _ in found), reverse=True)
    assert len({ids for _, ids in found}) == len(found)


@pytest.mark.parametrize("text", ["x" * 12, "aaaa aaaa", "-" * 9, "xxxxxx ababab"])
def test_ties_match_all_segmentations(text):
    s = nbest.Segmenter(PATH)
    want = [x for x, _ in all_segmentations(s, text)[:6]]
    assert [x for x, _ in s.segment(text, 6)] == pytest.approx(want)


@pytest.mark.parametrize("text", ["ab cd", "the other", " a  b", "a\nb", "a\n\nb c", "é𝔘 x", "  ", "hello", "\n", "x▁y", "a b c d e f"])
def test_nbest_matches_all_segmentations(text):
    s = nbest.segmenter(PATH)
    every = all_segmentations(s, text)
    got = s.segment(text, 5)
    assert [x for x, _ in got] == pytest.approx([x for x, _ in every[:5]])
    scores = {np.array(ids, "<u4").tobytes(): score for score, ids in every}
    assert len({raw for _, raw in got}) == len(got)
    for score, raw in got:
        assert scores[raw] == pytest.approx(score)
        assert s.decode(raw) == text.replace(nbest.BLANK, " ")


def test_nbest_frame(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "some text", 1), (2, None, 1), (None, "", 1), (3, "long words " * 20_000, 1), (1, "some text", 1)], "doc_id long, text string, rank int")
    found = nbest.nbest(docs, PATH, n=3)
    rows = nbest.decode(found, PATH).collect()
    assert [(r.doc_id, r["rank"]) for r in rows] == [(1, 1), (1, 2), (1, 3), (2, 1), (None, 1), (3, 1), (3, 2), (3, 3), (1, 1), (1, 2), (1, 3)]
    assert {r.text for r in rows if r.doc_id == 1} == {"some text"}
    assert {r.text for r in rows if r.doc_id == 3} == {"long words " * 20_000}
    assert nbest.nbest(docs.limit(0), PATH).count() == 0


def test_texts_are_spelled_by_column():
    import pyarrow as pa

    segment, speller = nbest.Segmenter(PATH).segment, nbest.Speller(PATH)
    texts = ["a few words", "", "é 𝔘\n\nx", "  two  blanks ", "x" * 300, " "]
    ids = [raw for t in texts for _, raw in segment(t, 3)[-1:]]
    column = pa.array([None, *ids, None, ids[0]], pa.binary())
    assert speller.texts(column).to_pylist() == [None, *texts, None, texts[0]]
    assert speller.texts(column.slice(2, 4)).to_pylist() == texts[1:5]
    assert speller.texts(column.slice(0, 0)).to_pylist() == [] and speller.texts(pa.array([None, b""], pa.binary())).to_pylist() == [None, ""]


def test_memory_starts_anew(monkeypatch):
    monkeypatch.setattr(nbest, "MEMORY", 4)
    s = nbest.Segmenter(PATH)
    assert [s.decode(s.segment(t, 2)[-1][1]) for t in ("a b c", "d e f", "a b c d e f g")] == ["a b c", "d e f", "a b c d e f g"]


def test_words_are_learned_together(monkeypatch):
    """The new words of some texts go through one pass by columns, not one by one; what it finds is what all ways hold."""
    s = nbest.Segmenter(PATH)
    monkeypatch.setattr(s, "learn_part", lambda word: pytest.fail(f"{word!r} alone"))
    monkeypatch.setattr(nbest, "COLUMN", 6)
    texts = ["ab cd", "", "é𝔘 x", "a\nb the", "日本 🙂", "hello -.x", "ab ab é𝔘", "x▁y"]
    found = list(s.segments(texts, 4))
    assert len(found) == len(texts)
    for text, ways in zip(texts, found, strict=True):
        assert [x for x, _ in ways] == pytest.approx([x for x, _ in all_segmentations(s, text)[:4]])
        assert {s.decode(raw) for _, raw in ways} == {text.replace(nbest.BLANK, " ")}


def test_licence_rules(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this. The above copyright notice and this permission notice shall be included in all copies. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, express."
    texts = {
        1: ("/* Copyright (c) 2020 Foo.\n * All rights reserved. */", ["All rights reserved"], 0),
        2: (mit, ["MIT"], 0),
        3: (None, [], 0),
        4: ("", [], 0),
        5: ("This licence is odd.", [], 1),
        6: ("Released under the MIT Licence. Licensed under CC BY-SA 4.0", ["MIT", "CC-BY-SA"], 0),
        7: ("no hint " * 50_000, [], 0),
        8: ("Licensed under the Apache License, Version 2.0.\nx\nLicensed under the Apache License, Version 2.0.", ["Apache-2.0", "Apache-2.0"], 0),
    }
    frame = spark.createDataFrame([(i, t, "x", 3) for i, (t, _, _) in texts.items()] + [(None, "SPDX-License-Identifier: MIT", "x", 3)], "doc_id long, text string, licences string, n_unknown int")
    got = {r.doc_id: (list(r.licences), r.n_unknown) for r in licences.recognise(frame).collect()}
    assert got == {i: (found, n) for i, (_, found, n) in texts.items()} | {None: (["MIT"], 0)}
    assert licences.recognise(frame.limit(0)).count() == 0


BSD = """Copyright (c) 2020, Foo
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
* Redistributions of source code must retain the above
  copyright notice, this list of conditions and the following disclaimer.
* Redistributions in binary form must reproduce the above copyright
  notice, this list of conditions.
* Neither the name of the copyright holder nor the names of its
  contributors may be used to endorse or promote products derived from
  this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND
CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED."""
GPL = """This program is free software{0} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation{1} either version {2} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will
be useful, but WITHOUT ANY WARRANTY.

You should have received a copy of the GNU General
Public License along with this program."""
APACHE = """Copyright 2020 Foo
Licensed under the Apache License,
Version 2.0 (the "License"); you may not use this
file except in compliance with the License.
You may obtain a copy of the License
at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or
agreed to in writing, software is distributed on an "AS IS" BASIS."""


def commented(text, mark):
    return "\r\n".join(mark + line for line in text.split("\n"))


def test_licence_sentences_over_wrapped_lines(spark):
    bsd2 = BSD[: BSD.index("* Neither")] + BSD[BSD.index("THIS SOFTWARE") :]
    cases = [
        (BSD, "Copyright RightsReserved BsdGrant BsdSource BsdBinary BsdNames BsdAsIs", ["All rights reserved", "BSD-3-Clause"]),
        (bsd2, "Copyright RightsReserved BsdGrant BsdSource BsdBinary BsdAsIs", ["All rights reserved", "BSD-2-Clause"]),
        (GPL.format(":", ",", 3), "Gpl3Later GplHope GplCopy", ["GPL-3.0-or-later"]),
        (GPL.format(";", ";", 2), "Gpl2Later GplHope GplCopy", ["GPL-2.0-or-later"]),
        (APACHE, "Copyright ApacheRef ApacheUse ApacheCopy ApacheAsIs", ["Apache-2.0"]),
    ]
    cases = [(commented(t, m), ids, names) for t, ids, names in cases for m in ("", " * ", "// ", "# ", "-- ")] + [
        ("This work is released under CC0 1.0.", "Cc0", ["CC0-1.0"]),
        ("This program is distributed in the hope that it will be useful.", "GplHope", []),
        ("(c) 2020 Foo", "Copyright", []),
        ("SPDX-License-Identifier: MIT\nSPDX-License-Identifier: GPL-2.0\nfoo", "SpdxMit SpdxGpl2", ["MIT", "GPL-2.0"]),
        ("- Licensed under the MIT License\n- or at your option\n- Licensed under CC BY 4.0", "MitRef CcBy", ["MIT", "CC-BY"]),
        ("text without an end\nCopyright 2020 Foo\nmore text", "Copyright", []),
        ("Subject to the terms of the Mozilla Public License, v. 2.0", "Mpl2Ref", ["MPL-2.0"]),
        ("Licensed under CC BY-\nSA 4.0", "CcBySa", ["CC-BY-SA"]),
    ]
    frame = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: (" ".join(r.identifiers), list(r.licences)) for r in licences.recognise(frame).collect()}
    for i, (text, ids, names) in enumerate(cases):
        assert got[i] == (ids, names), text


def test_every_licence_pattern_needs_a_hint():
    """All choices of the patterns' branches and options hold a hint, also with a line end for each blank."""
    import itertools
    import re
    from re import _constants as c
    from re import _parser

    def spelled(tree):
        parts = []
        for op, arg in tree:
            if op is c.LITERAL:
                parts.append([chr(arg)])
            elif op is c.IN:
                parts.append([chr(x) for kind, x in arg if kind is c.LITERAL])
            elif op is c.BRANCH:
                parts.append([x for branch in arg[1] for x in spelled(branch)])
            elif op is c.SUBPATTERN:
                parts.append(spelled(arg[3]))
            elif op is c.MAX_REPEAT:
                parts.append([x * arg[0] for x in spelled(arg[2])] + [x * (arg[0] + 1) for x in spelled(arg[2])])
            else:
                assert op in (c.ANY, c.AT), op
                parts.append(["x" if op is c.ANY else ""])
        return ["".join(x) for x in itertools.product(*parts)]

    for pattern in [p for _, p in licences.SENTENCES] + [licences.ABOUT]:
        for text in spelled(_parser.parse(pattern)):
            assert re.search(licences.HINT, text.replace(" ", "\n")), text


def test_pipeline_stages_against_brute_force(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language ID", "line dedup", "n-gram Jaccard join", "packing"]
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    extra = spark.createDataFrame([(10**6, None, "en", "s", 0), (10**6 + 1, "12 !!", "en", "s", 5), (10**6 + 2, "漢字かな交じり文の例です", None, None, None)], docs.schema)
    docs = docs.unionByName(extra)
    kept = corpus_pipeline.language_id(spark, docs, sf)
    assert kept.columns == columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect() if r.doc_id < 10**6}
    texts = [(r.doc_id, r.text) for r in kept.collect()]
    clean = corpus_pipeline.line_dedup(spark, kept, sf)
    assert clean.columns == columns
    rows = sorted((r.doc_id, r.text) for r in clean.collect())
    assert rows == sorted((d, t) for d, t, _, _ in test_lines.brute(texts, 20, 3))
    one = corpus_pipeline.near_duplicates(spark, clean, sf)
    assert one.columns == columns
    assert sorted(r.doc_id for r in one.collect()) == sorted(d for d, _, c in test_jaccard.brute(rows, 5, 8, 10) if d == c)
    final = [(r.doc_id, r.text) for r in one.collect()]
    assert max(test_packing.check(corpus_pipeline.pack(spark, one, sf).collect(), final)) <= 1024


def test_the_query_decodes_every_segmentation(spark, tmp_path):
    texts = ["a few words", "", None, "é 𝔘\n\nx", "  two  blanks ", "x" * 300]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op4_nbest_pieces(spark, str(tmp_path)).collect()
    want = {i: sha256((t or "").encode()).hexdigest() for i, t in enumerate(texts)}
    assert {r.doc_id for r in rows} == set(want) and all(r.decoded_sha256 == want[r.doc_id] for r in rows)
    assert sum(r.rank == 2 for r in rows) >= 4


COMMON_LICENCES = {
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice appears.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES.",
    "Zlib": "This software is provided 'as-is', without any express or implied\nwarranty.\n\nPermission is granted to anyone to use this software for any purpose,\nincluding commercial applications.\n\n1. The origin of this software must not be misrepresented; you must not claim it.\n2. Altered source versions must be plainly marked as such.\n3. This notice may not be removed or altered from any source distribution.",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or distribute this software.",
    "EPL-2.0": "This program and the accompanying materials are made available under the\nterms of the Eclipse Public License v. 2.0 which is available online.",
    "GPL-3.0-or-later": "it under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.",
    "GPL-2.0": "under the terms of the GNU General Public License version 2 as it stands.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted.\n\n1. Redistributions of source code must retain the above copyright notice.\n2. Redistributions in binary form must reproduce the above copyright notice.\n3. Neither the name of the University nor the names of its contributors\nmay be used to endorse or promote products.\n\nTHIS SOFTWARE IS PROVIDED BY THE REGENTS AND CONTRIBUTORS ``AS IS'' AND\nANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.",
    "Public domain": "This file is in the public domain.",
    "CC-BY-NC-SA": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 licence.",
}


def test_common_licences_and_what_is_not_licensed(spark):
    rows = [(t,) for t in COMMON_LICENCES.values()] + [("This file is not licensed under the MIT License.",)]
    frame = spark.createDataFrame([(i, t) for i, (t,) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: list(r.licences) for r in licences.recognise(frame).collect()}
    assert [got[i] for i in range(len(rows))] == [[name] for name in COMMON_LICENCES] + [[]]
    assert len(licences.SENTENCES) >= 100


def test_long_texts_with_licences_stay_fast(spark):
    text = ("Some prose that runs on over lines\nand names no terms, " * 20_000) + "\nLicensed under the MIT License.\n" * 3
    found = licences.recognise(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert list(found.licences) == ["MIT"] * 3
