"""Operators that SQL expresses: small cases; the queries are compared with their SQL in test_llm_queries."""

import gzip
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamina.llm import kdtree, licenses, mixing, perspectives, warc
from lamina.session import fresh_folder

DOCS = "doc_id long, text string, source string, size string, target int"


def test_mix_reaches_targets_and_repeats_nothing_too_often(spark):
    rows = [(i, "w " * (1 + i * 7 % 40), "abc"[i % 3] if i % 10 else None, "x", 1) for i in range(900)]
    out = mixing.mix(spark.createDataFrame(rows, DOCS)).toPandas()
    assert len(out) == 900 and (out.taken <= 2 * out["size"]).all() and (out.taken % out["size"] == 0).all()
    source = {r[0]: r[2] for r in rows}
    groups = out.groupby(out.doc_id.map(lambda i: source[i] or "zz"))
    for _, g in groups:
        assert abs(g.taken.sum() - g.target.iloc[0]) <= 20 and g.source_size.iloc[0] == g["size"].sum()
    assert abs(groups.target.first().sum() - 1.5 * out["size"].sum()) < 1e-6
    again = mixing.mix(spark.createDataFrame(rows[::-1], DOCS)).toPandas()
    assert Counter(zip(out.doc_id, out.taken)) == Counter(zip(again.doc_id, again.taken))


def test_targets_stop_at_twice_the_size(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 100), (None, 500)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(sizes).collect()}
    # a and c are full; the rest goes to b and NULL by 1 to 3, and NULL is full as well.
    assert got == {"a": 20.0, "c": 200.0, None: 1000.0, "b": 2415.0 - 1220.0}


def test_mix_of_odd_rows(spark):
    rows = [(1, None, None, None, None), (1, None, None, None, None), (None, "a b", "s", None, None), (2, "", "s", None, None), (3, "x" * 100_000, "t", None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    assert mixing.mix(docs).count() == 5
    assert mixing.mix(docs.limit(0)).count() == 0
    out = mixing.mixed_documents(docs)
    assert out.columns == ["doc_id", "text", "source", "size", "source_size", "target", "taken"]
    assert out.where("taken > 2 * size or taken = 0").isEmpty()


def _brute(rows, k, is_query):
    """[(query id, [(vec_id, score), …])] with every other row as a candidate."""
    out = []
    for n, (query, own) in enumerate(rows):
        if is_query(query):
            scored = [(-sum(a * b for a, b in zip(own, v)), i) for m, (i, v) in enumerate(rows) if m != n and len(v) == len(own)]
            out.append((query, [(i, -s) for s, i in sorted(scored)[:k]]))
    return sorted(out)


def _ranked(found):
    """The hits of each query row; query rows of one id have their ranks side by side."""
    out = {}
    for r in found.collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: sorted(hits) for q, hits in out.items()}


@pytest.mark.parametrize("kind", ["random", "copies", "clusters", "repeated ids"])
def test_top_k_is_exact(spark, kind, monkeypatch):
    monkeypatch.setattr(kdtree, "SHARD_ROWS", 60)
    monkeypatch.setattr(kdtree, "BLOCK_ROWS", 4)
    monkeypatch.setattr(kdtree, "BOXES", 2)
    rng = np.random.default_rng(1)
    points = rng.normal(0, 0.3, (300, 8))
    if kind == "copies":
        points = np.repeat(points[:3], 100, axis=0)
    elif kind == "clusters":
        points = points / 10 + rng.normal(0, 1, (6, 8))[rng.integers(0, 6, 300)]
    rows = [(i // 7 if kind == "repeated ids" else i, [float(x) for x in p], 0) for i, p in enumerate(points)]
    rows += [(900, None, 0), (901, [None] * 8, 0), (902, [float("nan")] * 8, 0), (950, [0.5, 0.25], 0), (951, [0.5, 0.5], 0), (None, [0.1] * 8, 0), rows[3], rows[0]]
    vectors = kdtree.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    whole = [(r.vec_id, r.v) for r in vectors.collect()]
    assert {900, 901, 902, None}.isdisjoint(i for i, _ in whole) and len(whole) == 304
    want = {}
    for query, hits in _brute(whole, 5, lambda i: i % 50 == 0):
        want.setdefault(query, []).extend((n + 1, i, s) for n, (i, s) in enumerate(hits))
    assert _ranked(kdtree.top_k(vectors, F.col("vec_id") % 50 == 0)) == {q: sorted(hits) for q, hits in want.items()}


def test_boxes_out_of_reach_are_not_read():
    rng = np.random.default_rng(2)
    centers = rng.normal(0, 1000, (40, 6))
    points = np.rint(centers[rng.integers(0, 40, 20_000)] + rng.normal(0, 30, (20_000, 6))).astype(np.int64)
    cut = kdtree.coarse_tree(points[:4000], 16)
    cell = kdtree.cells_of(points, cut)
    assert set(cell) == set(range(16)) and np.bincount(cell).max() < 4000
    tree = kdtree.build_tree(np.arange(20_000), np.arange(20_000), points)
    q, ids, scores, leaves = kdtree.search(tree, np.arange(10), points[:10], 5, np.full(10, -(2**63)))
    products = points[:10] @ points.T
    for i in range(10):
        others = sorted((-s, j) for j, s in enumerate(products[i].tolist()) if j != i)[:5]
        assert [(-s, j) for s, j in zip(scores[q == i].tolist(), ids[q == i].tolist())] == others
    assert leaves < 0.5 * (tree.left < 0).sum()


def test_top_k_of_nothing_and_large_values(spark):
    schema = "vec_id long, embedding array<double>"
    empty = kdtree.integer_vectors(spark.createDataFrame([], schema))
    assert kdtree.top_k(empty, F.col("vec_id") % 50 == 0).count() == 0
    rows = [(0, [1e5, 1.0]), (1, [1e5, -1.0]), (2, [1e5, -2.0])]
    got = kdtree.top_k(kdtree.integer_vectors(spark.createDataFrame(rows, schema)), F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(1, 25600000**2 - 65536), (2, 25600000**2 - 131072)]
    # Two rows of another id that is the same.
    rows = [(0, [1.0]), (1, [2.0]), (1, [3.0]), (2, [1.0])]
    got = kdtree.top_k(kdtree.integer_vectors(spark.createDataFrame(rows, schema)), F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(1, 3 * 65536), (1, 2 * 65536), (2, 65536)]


def test_license_sentences_have_signs():
    assert all(any(sign in s for sign in licenses.SIGNS) for s in licenses.SENTENCES)
    assert {i for _, ids in licenses.RULES for i in ids} <= set(licenses.SENTENCES.values()) | {"apache-comply"}


def test_license_rules_need_their_order(spark):
    mit = [s for s, i in licenses.SENTENCES.items() if i in ("mit-grant", "mit-notice", "mit-warranty")]
    texts = {
        1: "Hello. " + ". \nOther words here. ".join(mit) + ".", 2: ". ".join(reversed(mit)), 3: "LICENSED under the Apache License,  Version 2.0.\nx",
        4: None, 5: "", 6: "All rights reserved. All rights reserved!", 7: "word " * 50_000 + "\nReleased under the MIT License.", 8: "licence",
    }
    got = {r.doc_id: (r.licenses, r.n_known) for r in licenses.scan(spark.createDataFrame([(i, t, "z") for i, t in texts.items()], "doc_id long, text string, licenses string")).collect()}
    assert got == {1: ("MIT", 3), 2: ("", 3), 3: ("Apache-2.0", 1), 4: ("", 0), 5: ("", 0), 6: ("LicenseRef-all-rights-reserved", 2), 7: ("MIT", 1), 8: ("", 0)}


APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
{0} Redistributions of source code must retain the above copyright
   notice, this list of conditions and the following disclaimer.
{0} Redistributions in binary form must reproduce the above copyright
   notice, this list of conditions and the following disclaimer in the
   documentation and/or other materials provided with the distribution.
"""
ADVERTISE = """{0} All advertising materials mentioning features or use of this software
   must display the following acknowledgement:
   This product includes software developed by the University of
   California, Berkeley and its contributors.
"""
ENDORSE = """{0} Neither the name of the University nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission.
"""
DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED."""


def test_standard_texts_name_their_license(spark):
    bsd = {"BSD-2-Clause": BSD, "BSD-3-Clause": BSD + ENDORSE, "BSD-4-Clause": BSD + ADVERTISE + ENDORSE}
    cases = [("Apache-2.0", APACHE), ("MPL-2.0", MPL)] + [(n, t.format(x) + DISCLAIMER) for n, t in bsd.items() for x in ("1.", "*", "(a)", "2)")]
    cases += [("BSD-3-Clause,BSD-2-Clause", "\n\n".join([(BSD + ENDORSE).format("*"), BSD.format("*")]))]
    texts = [(n, form(t)) for n, t in cases for form in (str, lambda t: " ".join(t.split()), lambda t: "# " + t.replace("\n", "\n# "), lambda t: "\n".join(t.split()))]
    texts += [("", "see v. 2.0"), ("", "not licensed under the MIT license"), ("MIT", "Licence: \n Licensed under\nthe MIT License; x")]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.licenses for r in licenses.scan(docs).collect()}
    assert [(got[i], texts[i][1]) for i in got if got[i] != texts[i][0]] == []
    mine = licenses.scan(docs, {"see v 2 0": "mine"}, (("Mine", ("mine",)),), "see").where("licenses != ''").collect()
    assert [texts[r.doc_id][1] for r in mine] == ["see v. 2.0"]


TURNS = "conv_id long, turn long, role string, text string, message string"


def test_renderings_join_up_and_masks_cover_own_words(spark):
    rows = [(1, 0, "system", "S", ""), (1, 1, "ann", "hi", ""), (1, 2, "bob", "yo\n", ""), (1, 700, "ann", "ünd", ""), (1, 1, "ann", "hi", ""),
            (2, None, None, None, ""), (None, 3, "ann", "x", ""), (3, 0, "system", "alone", "")]
    out = perspectives.perspectives(spark.createDataFrame(rows, TURNS)).collect()
    assert len(out) == 5 * 2 + 1 + 1
    texts = {}
    for r in sorted(out, key=lambda r: (str(r.conv_id), r.perspective, r.start)):
        whole = texts.setdefault((r.conv_id, r.perspective), [])
        assert sum(map(len, whole)) == r.start and r.end - r.start == len(r.message)
        whole.append(r.message)
        assert (r.role == "assistant") == (r.train_start is not None)
    ann = "".join(texts[1, "ann"])
    assert ann.startswith("<|im_start|>system\nS<|im_end|>\n<|im_start|>assistant\nhi<|im_end|>\n") and "<|im_start|>user name=bob\nyo\n<|im_end|>" in ann
    trained = [ann[r.train_start : r.train_end] for r in out if r.conv_id == 1 and r.perspective == "ann" and r.train_start is not None]
    assert sorted(trained) == ["hi<|im_end|>\n"] * 2 + ["ünd<|im_end|>\n"]
    assert perspectives.perspectives(spark.createDataFrame([], TURNS)).count() == 0


PAGES = "page_id long, url string, html string, block string"


def test_derivatives_refer_to_their_source(spark):
    html = "<html><head><title>A &amp;\n B</title><style>p{}</style></head><body><!-- no --><p>One&#8364;&#x41;&#0;</p><script>var a='<p>';</script><a class=x href=\"/u\">two</a><br>three &lt;b&gt;"
    rows = [(1, "http://a/", html, "b"), (2, None, None, "b"), (2, None, None, "b"), (3, "http://c/", "<script>" * 20_000, "b"), (4, "u", "x" * 300_000, None)]
    responses = warc.responses_of_pages(spark.createDataFrame(rows, PAGES))
    out = warc.derivatives(responses)
    got = out.collect()
    assert len(got) == 10
    ids = {r.record_id for r in responses.collect()}
    assert {r.refers_to for r in got} == ids
    one = {r.warc_type: r for r in got if r.page_id == 1}
    assert one["conversion"].block == "A & B\nOne€A&#0;\ntwo\nthree <b>"
    assert "title: A &amp; B\r\n" in one["metadata"].block and "outlink: /u\r\n" in one["metadata"].block and "source-header: Content-Type: text/html" in one["metadata"].block
    assert [r.block for r in got if r.page_id == 3 and r.warc_type == "conversion"] == [""]
    assert all(r.content_length == len(r.block.encode()) for r in got)
    assert warc.derivatives(responses.limit(0)).count() == 0


def test_links_in_all_their_forms(spark):
    html = """<a href="one.html">1</a> <A class=x HREF = 'two.html' >2</a> <a href=three.html>3</a> <a data-href="no" name='y'>-</a>
<a
href="">4</a> <abbr href="no">-</abbr> <a title="x"href="it's.html" href="second">5</a>""" + "<p>x</p>" * 100_000 + '<a rel=a href=last>6</a>'
    out = warc.derivatives(warc.responses_of_pages(spark.createDataFrame([(1, "http://a.b/", html, None)], PAGES)))
    block = out.where("warc_type = 'metadata'").first()["block"]
    found = [line.removeprefix("outlink: ") for line in block.split("\r\n") if line.startswith("outlink: ")]
    assert found == ["one.html", "two.html", "three.html", "", "it's.html", "last"] and "links: 6" in block


def test_records_are_written_as_warc(spark):
    pages = spark.createDataFrame([(1, "http://a/", "<p>x\n\ny</p>", ""), (2, "http://b/", "<p>z</p>", "")], PAGES)
    records = warc.derivatives(warc.responses_of_pages(pages))
    folder = fresh_folder(spark, "warc")
    warc.write_warc(records, f"{folder}/out")
    data, read = b"".join(gzip.decompress(f.read_bytes()) for f in sorted(Path(folder, "out").glob("*.gz"))), []
    while data:
        header, _, data = data.partition(b"\r\n\r\n")
        size = int(next(x for x in header.split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
        read.append((header.decode() + "\r\n", data[:size].decode()))
        assert data[size : size + 4] == b"\r\n\r\n"
        data = data[size + 4 :]
    assert sorted(read) == sorted((r.header, r.block) for r in records.collect())


def test_entities_are_decoded_in_one_pass(spark):
    html = "<p>a &amp;lt; b &lt;i&gt; &&nbsp;&copy;&#65;&AMP; &amp;amp;  x\t y</p><pre>1</pre><p re>2"
    out = warc.derivatives(warc.responses_of_pages(spark.createDataFrame([(1, "http://a.b/", html)], "page_id long, url string, html string")))
    text = out.where("warc_type = 'conversion'")
    assert text.first()["block"] == "a &lt; b <i> & ©A&AMP; &amp; x y\n1\n2"
    # No pass over the text for each entity.
    assert text._jdf.queryExecution().optimizedPlan().toString().count("replace(") - text._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(") < len(warc.ENTITIES)
