"""Merkle manifest, whitening and URL filters against plain versions of them."""

import hashlib
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamina.llm import merkle, queries, url_filter, whitening
from tests.conftest import SMALL

DOCS = "doc_id long, source string, lang string, n_chars long, text string, position int, tree string"


# -- manifest ------------------------------------------------------------------


def _h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _leaf(doc_id, source, lang, n_chars, text):
    values = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return _h("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def _levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([_h("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def _runs(levels, at):
    for nodes in levels[:-1]:
        run = nodes[at // 8 * 8 : at // 8 * 8 + 8]
        yield run, at % 8
        at //= 8


def _manifest(rows):
    """One row after the other, in plain Python."""
    langs = {}
    for r in rows:
        langs.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, _leaf(*r[:5]), r))
    trees = {k: sorted(v, key=lambda x: x[:3]) for k, v in langs.items()}
    order = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    levels = {k: _levels([x[2] for x in v]) for k, v in trees.items()}
    top = _levels([levels[k][-1][0] for k in order])
    for place, k in enumerate(order):
        for i, (_, _, leaf, r) in enumerate(trees[k]):
            given, proof = leaf, []
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                given = _leaf(*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))
            for run, own in [*_runs(levels[k], i), *_runs(top, place)]:
                proof += run[:own] + run[own + 1 :]
                given = _h("".join([*run[:own], given, *run[own + 1 :]]))
            yield (r[0], leaf, levels[k][-1][0], top[-1][0], _h("".join(proof)), given, given == top[-1][0])


def _proofs(df):
    return sorted((tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


# Superblocks of one and two levels give several rounds.
@pytest.mark.parametrize("levels", [1, 2, 4])
def test_manifest_is_that_of_one_row_after_the_other(spark, levels):
    rows = [(i * 3, "s", "en", i, f"Some Text {i}", 7, "x") for i in range(150)]
    rows += [(i, None, "Ünd", 1, "ÄB", 0, "") for i in range(9)] + [(5, "s", None, None, None, 0, None)]
    rows += [(i, "s", f"l{i}", 3, "ABC", 0, "") for i in range(70)]
    # Copies of a row, an id on several rows, no id, an empty and a very long text.
    rows += [(77, "s", "fr", 1, "Again", 0, "")] * 20 + [(77, "t", "fr", 1, "Other", 0, ""), (None, "s", "fr", 1, "none", 0, "")]
    rows += [(78, "s", "", 0, "", 0, ""), (79, "s", "fr", 1, "Q" * 2_000_000, 0, "")]
    got = merkle.manifest(spark.createDataFrame(rows, DOCS), levels)
    assert _proofs(got) == sorted(_manifest(rows), key=str)


def test_manifest_of_one_row_and_of_none(spark):
    docs = spark.createDataFrame([(4, "s", "en", 1, "A", 0, "")], DOCS)
    (row,) = merkle.manifest(docs).collect()
    assert row.leaf == row.subroot == row.root == _leaf(4, "s", "en", 1, "A") and row.proof_sha256 == _h("") and row.n_levels == 0
    assert merkle.manifest(docs.limit(0)).count() == 0


# -- whitening -----------------------------------------------------------------


@pytest.mark.parametrize("kind", ["random", "low rank", "equal eigenvalues", "close pairs", "one", "zero"])
def test_components_are_eigenvectors(kind):
    rng = np.random.default_rng(3)
    if kind == "random":
        a = rng.normal(size=(80, 200))
        a = a @ a.T
    elif kind == "low rank":
        a = rng.normal(size=(40, 6))
        a = a @ a.T
    elif kind == "one":
        a = np.array([[4.0]])
    elif kind == "zero":
        a = np.zeros((5, 5))
    else:
        q, _ = np.linalg.qr(rng.normal(size=(50, 50)))
        values = np.repeat(np.arange(1.0, 6.0), 10) if kind == "equal eigenvalues" else np.arange(50) // 2 + 1e-9 * np.arange(50) + 1
        a = q @ np.diag(values) @ q.T
        a = (a + a.T) / 2
    values, vectors = whitening.leading_components(a, 32)
    want = np.linalg.eigvalsh(a)[::-1][:32]
    want = want[want > 1e-11 * max(want[0], 1e-300)]
    assert len(values) == len(want) and np.abs(values - want).max(initial=0) <= 1e-13 * max(1, want.max(initial=0))
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max(initial=0) < 1e-12
    assert np.abs(vectors @ a - values[:, None] * vectors).max(initial=0) < 1e-12 * max(1, want.max(initial=0))


def test_sturm_counts_are_those_of_the_eigenvalues():
    rng = np.random.default_rng(4)
    d, e = rng.normal(size=30), rng.normal(size=29)
    e[10] = 0
    values = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    at = np.linspace(values[0] - 1, values[-1] + 1, 200)
    assert whitening.count_below(d, e, at).tolist() == [(values < x).sum() for x in at]


def test_whitened_vectors_are_those_of_numpy(spark):
    got = queries.queries()["op11_whitened_vectors"](spark, SMALL).toPandas()
    rows = [(r.vec_id, r.embedding) for r in queries.table(spark, SMALL, "embeddings").collect()]
    x = np.floor(64 * np.array([v for _, v in rows], float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    moved = n * x - sums
    values, vectors = np.linalg.eigh((moved / n).T @ (moved / n) / n)
    values, vectors = values[::-1], vectors[:, ::-1].T
    assert len(got) == n * 32 and (got.n == n).all() and got.identity_error.max() < 1e-10
    far = {i: int((m.astype(object) ** 2).sum()) for (i, _), m in zip(rows, moved)}
    assert (got.deviation == got.vec_id.map(far)).all()
    for k, part in got.groupby("component"):
        assert part.explained.iloc[0] == pytest.approx(values[k - 1] / values.sum(), rel=1e-10) and part.explained.nunique() == 1
        want = moved / n @ vectors[k - 1] / math.sqrt(values[k - 1])
        have = part.set_index("vec_id").whitened.loc[[i for i, _ in rows]].to_numpy()
        assert min(np.abs(want - have).max(), np.abs(want + have).max()) < 1e-9


def test_whitening_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(5)
    good = [(i, rng.normal(size=4).tolist(), 1, 2.0) for i in range(50)]
    odd = [(60, None, 1, 0.0), (61, [1.0, None, 1.0, 1.0], 1, 0.0), (62, [nan] * 4, 1, 0.0), (63, [inf, 0.0, 0.0, 0.0], 1, 0.0), (64, [], 1, 0.0)]
    other = [(70, [1.0, 2.0], 1, 0.0), (71, [3.0, 2.0], 1, 0.0), (80, [5.0], 1, 0.0)]
    repeated = [good[0], (None, good[1][1], None, None)]
    table = spark.createDataFrame(good + odd + other + repeated, "vec_id long, embedding array<double>, n int, whitened double")
    got = whitening.whiten(table).toPandas()
    # Two vectors lie on a line; one alone has no variance at all.
    assert got.groupby("dim").size().to_dict() == {4: 52 * 4, 2: 2} and got.identity_error.max() < 1e-10
    assert (got[got.vec_id == 0].groupby("component").size() == 2).all() and got.vec_id.isna().sum() == 4
    assert sorted(got[got.dim == 2].whitened.round(9)) == [-1.0, 1.0]
    assert whitening.whiten(table.limit(0)).count() == 0
    assert whitening.whiten(table.where("vec_id = 80")).count() == 0


def test_squares_beyond_64_bits_are_null():
    assert whitening._squares(np.array([[2**40, 1], [3, 4]])) == [None, 25]


# -- URLs ----------------------------------------------------------------------


def _host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[end:]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    return host, path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]


def _rule(host, path):
    fits = [
        (len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[1:] if fits else (None, None)


def _entropy(text):
    return -sum(c / len(text) * math.log2(c / len(text)) for c in (text.count(x) for x in set(text))) if text else 0.0


def _plain_bins(url, suffixes, share):
    host, path = _host_path(url)
    url = url or ""
    query = url.split("?", 1)[1].split("#")[0] if "?" in url else ""
    if "#" in url and "?" in url and url.index("#") < url.index("?"):
        query = url.split("?", 1)[1].split("#")[0]
    n, blocked = suffixes.get(host.split(".")[-1], (0, share))

    def capped(x):
        return max(0, min(63, math.floor(x + 1e-12)))

    def logs(x, steps=6):
        return capped(math.log2(x + 1) * steps)

    def share_of(part, text):
        return capped(part * 63 / len(text)) if text else 0

    def digits(text):
        return sum(c in "0123456789" for c in text)

    segments = [s for i, s in enumerate(__import__("re").split("/+", path))]
    return [
        logs(len(url)), logs(len(host)), logs(len(path)), logs(len(query)), capped(host.count(".")), capped(len(segments) - 1),
        share_of(digits(url), url), share_of(digits(host), host), capped(host.count("-")), capped(sum(url.count(c) for c in "%@~")),
        capped(query.count("=")), capped(_entropy(url) * 8), capped(_entropy(host) * 8), int(url.startswith("https://")), int("#" in url),
        logs(n, 2), capped(blocked * 63),
    ]


def _boosted(bins, y, base):
    """Trees grown row by row."""
    x, y = np.array(bins), np.array(y)
    f = np.full(len(y), base)
    trees = []
    for _ in range(url_filter.TREES):
        p = 1 / (1 + np.exp(-f))
        g, h = np.round(p * 2**20) - y * 2**20, np.maximum(np.round(p * (1 - p) * 2**20), 1)
        g, h = g / 2**20, h / 2**20

        def grow(rows, depth):
            gs, hs = g[rows].sum(), h[rows].sum()
            best = None
            if depth < url_filter.DEPTH:
                for feature in range(x.shape[1]):
                    for b in sorted(set(x[rows, feature]))[:-1]:
                        left = rows[x[rows, feature] <= b]
                        gl, hl = g[left].sum(), h[left].sum()
                        if min(hl, hs - hl) < 1:
                            continue
                        gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
                        if gain > 1e-9 and (best is None or gain > best[0]):
                            best = (gain, feature, b)
            if best is None:
                return -0.3 * gs / (hs + 1)
            _, feature, b = best
            side = x[rows, feature] <= b
            return (feature, b, grow(rows[side], depth + 1), grow(rows[~side], depth + 1))

        tree = grow(np.arange(len(y)), 0)
        if not isinstance(tree, tuple):
            break
        trees.append(tree)
        f = f + np.array([_leaf_of(tree, r) for r in x])
    return trees


def _leaf_of(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def test_verdicts_are_those_of_trees_grown_row_by_row(spark):
    pages = [(r.page_id, r.url) for r in queries.table(spark, SMALL, "pages").select("page_id", "url").collect()]
    judged = [(i, u, *_host_path(u), *_rule(*_host_path(u))) for i, u in pages]
    known = [j for j in judged if j[4]]
    assert 0 < sum(j[5] == "block" for j in known) < len(known)
    blocked, n = sum(j[5] == "block" for j in known), len(known)
    share = (blocked + 0.5) / (n + 1)
    counts = {}
    for j in known:
        c = counts.setdefault(j[2].split(".")[-1], [0, 0])
        c[0] += 1
        c[1] += j[5] == "block"
    suffixes = {s: (c, (b + 20 * share) / (c + 20)) for s, (c, b) in counts.items()}
    bins = {j[1]: _plain_bins(j[1], suffixes, share) for j in judged}
    base = math.log(share / (1 - share))
    trees = _boosted([bins[j[1]] for j in known], [j[5] == "block" for j in known], base)
    assert trees
    got = {r.page_id: r for r in queries.queries()["op12_url_verdicts"](spark, SMALL).collect()}
    assert len(got) == len(pages)
    for page_id, url, host, path, rule, verdict in judged:
        score = 1 / (1 + math.exp(-base - sum(_leaf_of(t, bins[url]) for t in trees)))
        row = got[page_id]
        assert (row.host, row.path, row.rule) == (host, path, rule) and row.score == pytest.approx(score, abs=1e-6)
        assert row.verdict == (verdict or ("block" if score > 0.5 else "allow"))


ODD_URLS = [
    None, "", "no scheme", "HTTP://WWW.Example.COM/en/x?y=/en/#f", "http://example.com/en/", "http://a.b.example.com/en/q", "http://badexample.com/en/",
    "http://example.com", "http://example.com?x/en/", "http://x.net/es/1", "http://net/fr/", "http://x.net/en/", "http://x.net/esx", "a://b://c/d",
    "http://ÄÖ.com/é", "://", "http:///en/", "http://u@example.com:80/en/", "http://example.com/EN/", "http://e.com/" + "a" * 300_000,
]


def test_rules_of_odd_urls(spark):
    rows = [(i % 7 or None, u, "allow", "h") for i, u in enumerate(ODD_URLS)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string, host string")
    model = url_filter.train(url_filter.labelled_by_rules(pages))
    got = url_filter.judged(pages, model).collect()
    assert len(got) == len(rows)
    want = sorted((str(i), *_host_path(u), str(_rule(*_host_path(u))[0])) for i, u, *_ in rows)
    assert sorted((str(r.page_id), r.host, r.path, str(r.rule)) for r in got) == want
    assert {r.verdict for r in got} <= {"allow", "block"}
    assert url_filter.judged(pages.limit(0), model).count() == 0
    # No labels, or one only.
    for label in (None, True, False):
        one = url_filter.train(pages.select("url", F.lit(label).cast("boolean").alias("is_blocked")))
        assert {r.verdict for r in url_filter.judged(pages, one, ()).collect()} == {"block" if label else "allow"}


def test_trees_tell_unseen_urls_apart(spark):
    rng = np.random.default_rng(6)

    def word(n, letters="abcdefghijklmnopqrstuvwxyz"):
        return "".join(rng.choice(list(letters), n))

    def url(bad):
        if bad:
            return f"http://{word(12, 'abcdefxyz0123456789')}-{word(4)}.biz/{word(5)}/{word(30)}.php?id={rng.integers(10**9)}&r={word(20)}&s={word(9)}"
        return f"https://www.{word(7)}.org/{word(5)}/{word(6)}"

    rows = [(i, url(i % 2), i % 2 == 1) for i in range(600)]
    # A tenth of the labels is wrong, in learning alone.
    learn = [(u, y != (i % 10 == 0)) for i, u, y in rows[:400]]
    model = url_filter.train(spark.createDataFrame(learn, "url string, is_blocked boolean"))
    held_out = spark.createDataFrame([(i, u) for i, u, _ in rows[400:]], "page_id long, url string")
    got = {r.page_id: r.verdict == "block" for r in url_filter.judged(held_out, model).collect()}
    assert sum(got[i] == y for i, _, y in rows[400:]) >= 195


def test_the_main_path_has_no_python(spark):
    pages = queries.table(spark, SMALL, "pages")
    plan = url_filter.judged(pages, url_filter.Model(0.0, 0.5, [], spark.createDataFrame([("com", 1, 0.5)], "suffix string, suffix_count long, suffix_blocked double")))
    text = plan._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text
