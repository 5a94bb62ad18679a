"""Operators with fingerprints and models, against brute force, exact counts and held-out rows."""

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from checks.compare import differences, duck
from lamina.llm import decontaminate, language_id, near_dup, oracle, pii, queries, toxicity
from lamina.llm.graph import components
from lamina.llm.words import chunks, words_of
from tests.conftest import SMALL

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _docs(spark, texts, lang="en"):
    return spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t in texts.items()], DOCS)


def _prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n))


@pytest.mark.parametrize("name", sorted(oracle.statements()))
def test_same_rows_as_sql(spark, name):
    assert differences(queries.queries()[name](spark, SMALL), duck(SMALL), oracle.statements()[name]) == ""


def test_words_are_whole():
    text = "Ab c1-d É" + "x" * 100 + "  ab"
    w = words_of([None, text, "", "AB"])
    assert w.doc.tolist() == [1, 1, 1, 1, 1, 3] and w.hash[0] == w.hash[4] == w.hash[5] and len(set(w.hash.tolist())) == 4


def _grams(text, n=5):
    words = re.findall(r"[0-9a-z\u0080-\U0010ffff]+", text.lower())
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) or (Counter([tuple(words)]) if words else Counter())


def _jaccard(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def _classes(texts):
    root = {i: i for i in texts}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    grams = {i: _grams(t or "") for i, t in texts.items()}
    for i, j in combinations(texts, 2):
        if (texts[i] or "") == (texts[j] or "") or _jaccard(grams[i], grams[j]) >= 0.8:
            a, b = sorted((top(i), top(j)))
            root[b] = a
    return {i: top(i) for i in texts}


def test_near_duplicates_are_those_of_all_pairs(spark):
    rng = random.Random(4)
    texts = {}
    for base in range(12):
        words = _prose(rng, rng.choice([8, 40, 120])).split()
        for _ in range(rng.choice([1, 3, 25])):
            edited = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                edited[rng.randrange(len(edited))] = _prose(rng, 1) + "z"
            texts[len(texts)] = " ".join(edited)
    texts |= {500: None, 501: "", 502: "!!", 503: "one two", 504: "One, two!", 505: "same " * 3000, 506: "same " * 3100}
    got = {r.doc_id: r.class_id for r in near_dup.near_duplicates(_docs(spark, texts)).collect()}
    assert got == _classes(texts)
    kept = near_dup.drop_near_duplicates(_docs(spark, texts))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(got.values())) and kept.columns == DOCS.replace(",", "").split()[::2]


def test_repeated_rows_are_one_class(spark):
    docs = _docs(spark, {1: "a b c d e f g", 2: None}).union(_docs(spark, {1: "a b c d e f g"}))
    assert sorted((r.class_id, r.class_size) for r in near_dup.near_duplicates(docs).collect()) == [(1, 2), (1, 2), (2, 1)]
    assert near_dup.drop_near_duplicates(docs).count() == 2
    assert near_dup.near_duplicates(docs.limit(0)).count() == 0


def test_unlike_texts_with_one_id_both_stay(spark):
    texts = ["a b c d e f g", "t u v w x y z", "t u v w x y z", "a b c d e f g", "h i j k l m n"]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in zip([1, 1, 2, 3, None], texts)], DOCS)
    got = near_dup.near_duplicates(docs)
    assert sorted((r.doc_id or 0, r.class_id or 0, r.class_size) for r in got.collect()) == [(0, 0, 1), (1, 1, 2), (1, 1, 2), (2, 1, 2), (3, 1, 2)]
    assert got.select("class").distinct().count() == 3
    assert sorted((r.doc_id or 0, r.text) for r in near_dup.drop_near_duplicates(docs).collect()) == [(0, texts[4]), (1, texts[0]), (1, texts[1])]


def test_near_copies_without_ids_and_odd_columns(spark):
    """Of a class one row stays, whether its rows have ids or not; no column of the caller is lost."""
    words = _prose(random.Random(4), 60).split()
    near = " ".join([*words[:-1], "other"])
    rows = [(None, " ".join(words), "a", 1), (None, near, "b", 2), (3, "u v w x y z", "c", 3), (None, "u v w x y z", "d", 4), (None, None, "e", 5), (None, "", "f", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _node string, n long")
    kept = near_dup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    got = [(r.doc_id, r["_node"]) for r in kept.collect()]
    assert len(got) == 3 and (3, "c") in got
    assert near_dup.drop_near_duplicates(docs.limit(0)).count() == 0


def test_chunks_have_a_bounded_number_of_texts():
    batch = pa.record_batch({"text": pa.array(["a b c d e f"] + [""] * 70_000 + ["a b c d e g"])})
    sizes = [c.num_rows for c in chunks(batch, "text")]
    assert sum(sizes) == 70_002 and max(sizes) <= 1 << 15


def test_signatures_agree_like_the_texts():
    rng = random.Random(2)
    words = _prose(rng, 300).split()
    other = words[:200] + _prose(rng, 60).split()
    texts = [" ".join(words), " ".join(other), "a b c d e"]
    doc, element, nth = near_dup._elements_of(texts)
    s = near_dup.signatures(doc, element, nth, 3, k=1000)
    assert abs((s[0] == s[1]).mean() - _jaccard(_grams(texts[0]), _grams(texts[1]))) < 0.06


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (7, 7), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 103: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_leaks_are_those_of_all_windows(spark):
    rng = random.Random(9)
    items = {i: _prose(rng, rng.choice([6, 15, 40, 70, 300])) for i in range(30)} | {30: "too short", 31: None}
    texts, want = {}, {}
    for d in range(80):
        words, i = _prose(rng, rng.choice([0, 3, 200])).split(), rng.randrange(30)
        passage = items[i].split()
        for _ in range(rng.choice([0, 0, 1, 3])):
            passage[rng.randrange(len(passage))] = "edited"
        at = rng.randint(0, len(words))
        texts[d] = " ".join(words[:at] + (passage if d % 4 else []) + words[at:])
        if d % 4 and items[i] in texts[d]:
            want[d] = i
    texts |= {90: None, 91: "", 92: "word " * 30_000 + items[3].upper()}
    benchmark = spark.createDataFrame(list(items.items()), "item_id long, text string")
    report = {r.doc_id: r for r in decontaminate.leak_report(_docs(spark, texts), benchmark).collect()}
    assert set(report) == set(texts)
    assert all(report[d].contaminated and report[d].item_id == i for d, i in want.items())
    assert report[92].item_id == 3 and not report[90].contaminated and not any(report[d].contaminated for d in range(0, 80, 4))
    want = _leaks(items, {d: t for d, t in texts.items() if d < 80})
    for d in range(80):
        assert (report[d].n_items, report[d].similarity) == (len(want[d]), pytest.approx(max(want[d].values(), default=0.0)))
    clean = decontaminate.drop_contaminated(_docs(spark, texts), benchmark)
    assert sorted(r.doc_id for r in clean.collect()) == sorted(d for d, r in report.items() if not r.contaminated)
    assert decontaminate.leak_report(_docs(spark, texts), benchmark.limit(0)).where("contaminated").isEmpty()
    assert decontaminate.leak_report(_docs(spark, {1: "x"}).limit(0), benchmark).count() == 0


def _plain_shingles(words):
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def _leaks(items, texts):
    """{text: {item: similarity}} at 0.8 and above: every item's parts against every window of as many words, in plain Python."""
    def words(text):
        return re.findall(r"[a-z0-9]+|[^\x00-\x7f]+", (text or "").lower())

    known = {i: words(t) for i, t in items.items() if t}
    n_items = Counter(s for w in known.values() for s in _plain_shingles(w))
    rarest = 1 + np.log(len({t for t in items.values() if t}))
    out = {d: {} for d in texts}
    for i, item in known.items():
        if len(item) < 5:
            continue
        for part in np.array_split(np.array(item), -(-len(item) // decontaminate.PART_WORDS)):
            own = _plain_shingles(part.tolist())
            weight = {s: 1 + np.log(len(known) / n_items[s]) for s in own}
            total = sum(n * weight[s] for s, n in own.items())
            for d, text in texts.items():
                w = words(text)
                size = min(len(part), len(w))
                for at in range(len(w) - size + 1 if size > 4 else 0):
                    mine = _plain_shingles(w[at : at + size])
                    if len(mine.keys() & own.keys()) < 0.4 * len(own):
                        continue
                    all_mine = sum(n * weight.get(s, rarest) for s, n in mine.items())
                    both = sum(min(n, own[s]) * weight[s] for s, n in mine.items() if s in own)
                    score = both / (total + all_mine - both)
                    if score >= 0.8:
                        out[d][i] = max(out[d].get(i, 0.0), score)
    return out


@pytest.mark.parametrize("parts", [1, 8])
def test_leaks_don_t_depend_on_the_blocks(spark, monkeypatch, parts):
    """Items that share their beginnings, near copies of them in the documents; blocks of few parts and one of all."""
    rng = random.Random(8)
    stem = _prose(rng, 30)
    items = {i: f"{stem if i % 2 else ''} {_prose(rng, 40 + i % 5)}" for i in range(24)} | {24: _prose(rng, 400), 25: None}
    texts = {}
    for i in range(25):
        passage = items[i].split()
        for _ in range(rng.choice([0, 1, 2])):
            passage[rng.randrange(len(passage))] = "edited"
        texts[i] = f"{_prose(rng, 50)} {' '.join(passage)} {_prose(rng, 20)}"
    docs, benchmark = _docs(spark, texts), spark.createDataFrame(list(items.items()), "item_id long, text string")
    one = sorted(decontaminate.leak_report(docs, benchmark).collect(), key=str)
    left = sorted(r.doc_id for r in decontaminate.drop_contaminated(docs, benchmark).collect())
    monkeypatch.setattr(decontaminate, "BLOCK_PARTS", parts)
    assert sorted(decontaminate.leak_report(docs, benchmark).collect(), key=str) == one and any(r.contaminated for r in one)
    assert sorted(r.doc_id for r in decontaminate.drop_contaminated(docs, benchmark).collect()) == left


def test_fingerprints_within_the_radius_are_all_looked_up():
    rng = np.random.default_rng(5)
    mark = rng.integers(0, 2**63, dtype=np.uint64)
    part = np.array([mark >> np.uint64(16 * b) & np.uint64(0xFFFF) for b in range(4)])
    near = [set((int(part[b]) ^ decontaminate._NEAR16).tolist()) for b in range(4)]
    for _ in range(2000):
        bits = rng.choice(64, rng.integers(0, decontaminate.RADIUS + 1), replace=False)
        other = int(mark)
        for b in bits:
            other ^= 1 << int(b)
        assert any(other >> (16 * b) & 0xFFFF in near[b] for b in range(4))


def test_toxicity_learns_sentences_from_documents(spark):
    rng = random.Random(1)
    rows, labels = {}, []
    for i in range(600):
        sentences = [_prose(rng, 8) for _ in range(rng.randint(1, 6))]
        toxic = i % 5 == 0
        if toxic:
            sentences.insert(rng.randint(0, len(sentences)), f"Ü {_prose(rng, 2)} vilethi{rng.choice('abcdefgh')} {_prose(rng, 1)}")
        rows[i] = ". ".join(sentences) + "."
        labels.append((i, 0, int(toxic)))
    rows |= {1000: None, 1001: "", 1002: "...", 1003: "ok " * 40_000}
    docs, known = _docs(spark, rows), spark.createDataFrame([*labels, (None, 0, 1), (5, None, None), (7, 0, 0)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, known)
    out = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    right = [out[i].predicted == toxic for i, _, toxic in labels if out[i].held_out]
    assert len(right) > 80 and np.mean(right) > 0.95
    assert [out[i].score for i in (1000, 1001, 1002)] == [0.0] * 3 and out[1003].predicted == 0
    found = [rows[i][s.start : s.end] for i in range(0, 600, 5) for s in out[i].sentences]
    assert found and np.mean(["vilethi" in f for f in found]) > 0.95 and all(f[0] not in " ." for f in found)
    assert toxicity.drop_toxic(docs, model).count() == sum(not r.predicted for r in out.values())
    assert toxicity.score(docs.limit(0), model).count() == 0
    nothing = toxicity.train(docs, known.limit(0))
    assert toxicity.score(docs, nothing).where("predicted = 1").isEmpty()


def test_weak_sentences_that_make_a_text_toxic_are_located():
    # Every sentence has a probability of 0.4.
    model = toxicity.Model(np.zeros(toxicity._SIZE * 3, np.float32), float(np.log(0.4 / 0.6)))
    value, found = toxicity.score_texts([None, "Über eins.", "Ü one two. Three four!", ""], model)
    assert np.allclose(value, [0, 0.4, 0.64, 0]) and [len(f) for f in found] == [0, 0, 1, 0]
    assert (found[2][0]["start"], found[2][0]["end"]) == (0, 9) and abs(found[2][0]["score"] - 0.4) < 1e-9


def test_kneser_ney_is_a_distribution_and_counts_are_exact(spark):
    texts = ["abab cab", "abba, abc!", "bab" * 9]
    key = np.concatenate([language_id.characters([t])[1] for t in texts])
    grams, n = language_id._tally(key)
    padded = ["   " + re.sub("[^a-z]+", " ", t) for t in texts]
    want = Counter(p[i : i + 4] for p in padded for i in range(len(p) - 3))
    assert {"".join(chr(int(g) >> s & 0xFFFF) for s in (48, 32, 16, 0)): int(c) for g, c in zip(grams, n)} == want
    alphabet = sorted({p for p in "".join(padded)})
    language = language_id.language_of(grams, n, len(alphabet))
    for context in {g[:3] for g in want} | {"zzz"}:
        head = sum(ord(c) << s for c, s in zip(context, (48, 32, 16)))
        p = language_id.probability(language, np.array([head + ord(c) for c in alphabet], np.uint64))
        assert (p > 0).all() and 0.8 < p.sum() <= 1 + 1e-9


def test_languages_of_held_out_rows(spark):
    docs = queries.table(spark, SMALL, "documents")
    model = language_id.train(docs)
    out = language_id.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(out) > 20 and (out.lang == out.lang_pred).mean() > 0.95 and out.score.between(0, 1).all()
    odd = {1: None, 2: "", 3: "12 !", 4: "the " * 50_000, 5: "漢" * 50, 6: "𠀀𠀁"}
    got = {r.doc_id: r for r in language_id.identify(_docs(spark, odd), model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and got[4].lang_pred == "en" and got[5].rejected and got[6].lang_pred != "und"
    assert language_id.identify(docs.limit(0), model).count() == 0
    nothing = language_id.train(docs.withColumn("lang", docs["lang"].substr(9, 1)).where("lang is null"))
    assert {r.lang_pred for r in language_id.identify(docs, nothing).collect()} == {"und"}


def test_a_sliced_language_model_is_the_whole_one(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, _prose(rng, 60), "aa", "s", 1) for i in range(300)] + [(1000 + i, f"xyz zyx {'xyzw'[i % 4:]} yyzz", "bb", "s", 1) for i in range(12)]
    docs = spark.createDataFrame(rows, DOCS)

    def result():
        model = language_id.train(docs)
        return model, {r.doc_id: r for r in language_id.identify(docs, model).collect()}

    whole, want = result()
    monkeypatch.setattr(language_id, "MAX_GRAMS", 700)
    model, got = result()
    assert len(whole.slices) == 1 < len(model.slices) and model.names == whole.names == ["aa", "bb"]
    assert np.allclose(model.limit, whole.limit) and model.sharpness == whole.sharpness
    assert all(got[i].lang_pred == want[i].lang_pred and abs(got[i].score - want[i].score) < 1e-9 for i in want)
    assert all(got[i].lang_pred == "bb" for i in range(1000, 1012))


EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP, CARD, PHONE = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"


def _base(text):
    def digits(m):
        return re.sub("[^0-9]", "", m[0])

    out = [(0, m) for m in re.finditer(EMAIL, text)]
    out += [(1, m) for m in re.finditer(IP, text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(2, m) for m in re.finditer(CARD, text) if 13 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    out += [(3, m) for m in re.finditer(PHONE, text) if 9 <= len(digits(m)) <= 15]
    return [(k, m.start(), m.end()) for k, m in out]


def test_patterns_find_what_the_plain_ones_find():
    rng = random.Random(8)
    for _ in range(4000):
        text = "".join(rng.choice("ab1234567890.. @@+-()éé%") for _ in range(rng.randint(0, 60)))
        assert pii.base_spans(text) == _base(text), text
    for long in ("1" * 200_000, "a" * 200_000 + "@", "a." * 100_000, "1." * 100_000, "+1" + "(" * 100_000, "@" * 100_000):
        pii.base_spans(long)


def test_personal_data(spark):
    docs = queries.table(spark, SMALL, "documents")
    net = pii.train(docs)
    text = {r.doc_id: r.text for r in docs.collect()}
    out = pii.find(docs, net).collect()
    for r in out:
        base = _base(text[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == b[0] for b in base) for k in range(4)]
        assert set(pii._text_of(base).split(",")) <= set(r.spans.split(","))
    odd = {1: None, 2: "", 3: "a@b.cc " * 3000, 4: "é 1.2.3.4"}
    got = {r.doc_id: r for r in pii.find(_docs(spark, odd), net).collect()}
    assert got[1].spans == got[2].spans == "" and got[3].n_email == 3000 and got[4].spans == "ip:2:9"
    masked = {r.doc_id: r for r in pii.redact(_docs(spark, odd), net).collect()}
    assert masked[4].text == "é [IP]" and masked[4].n_chars == 6 and masked[1].text is None
    assert pii.find(docs.limit(0), net).count() == 0


def test_the_model_finds_spans_of_unseen_texts():
    rng = random.Random(6)

    def text():
        card = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        card += next(d for d in "0123456789" if pii.luhn(card + d))
        data = [f"{_prose(rng, 1)}.{rng.randint(10, 99)}@mail.example.com", ".".join(str(rng.randint(1, 255)) for _ in range(4)), card]
        return f"{_prose(rng, 9)} {rng.choice(data)} {_prose(rng, 9)}"

    net = pii.fit(sorted(text() for _ in range(400)))
    tests = [text() for _ in range(60)]
    found = sum(set(m) == set(pii.base_spans(t)) for m, t in zip(pii.model_spans(tests, net), tests))
    assert found >= 48


def test_gradients_of_the_network():
    rng = np.random.default_rng(0)
    net, codes, tags = pii._fresh(), rng.integers(97, 120, (2, 7)), rng.integers(0, 3, (2, 7))

    def loss(n):
        scores, total = pii._forward(n, codes), 0.0
        for s, t in zip(scores, tags):
            a = n.moves[-1] + s[0]
            own = a[t[0]]
            for i in range(1, 7):
                own += n.moves[t[i - 1], t[i]] + s[i, t[i]]
                a = pii._log_sum(a[:, None] + n.moves[:-1], 0) + s[i]
            total += pii._log_sum(a, 0) - own
        return total / 2

    grad = pii._gradients(net, codes, tags)
    for k, w in enumerate(net):
        at = tuple(rng.integers(0, d) for d in w.shape) if k else (codes[0, 3], 2)
        up, down = [n.copy() for n in net], [n.copy() for n in net]
        up[k][at] += 1e-5
        down[k][at] -= 1e-5
        assert abs((loss(pii.Network(*up)) - loss(pii.Network(*down))) / 2e-5 - grad[k][at]) < 1e-5


def test_pipeline(spark):
    docs = queries.table(spark, SMALL, "documents")
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.written(stage(spark, docs, SMALL), name)
        assert out.count() > 0 and out.select("doc_id").subtract(docs.select("doc_id")).isEmpty()
        if name != "mixing":
            assert out.schema == docs.schema
        if name == "near_duplicates":
            assert near_dup.near_duplicates(out).where("class_size > 1").isEmpty()
        if name == "benchmark_decontamination":
            assert decontaminate.leak_report(out, queries.table(spark, SMALL, "benchmark")).where("contaminated").isEmpty()
        if name == "personal_data":
            assert not any(_base(r.text) for r in out.collect())
        docs = out
    assert docs.where("taken <= 0 or taken > 2 * size").isEmpty()
