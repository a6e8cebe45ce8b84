"""Lexical search, URL filters and whitening against plain versions, and odd tables."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest

from lodewright.llm import cascade, lexical, whitening

ODD = ["", None, "  \n", "a b a", "A B a", "Ünï ünï 日本 b", "x-y_z x", "a" * 70_000, "b\x00c b", "ÀB àb İ a"]


def _terms(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def _search(docs, items, kept):
    counts = [(key, Counter(_terms(text))) for key, text in docs]
    counts = [(key, c) for key, c in counts if c]
    number, total = len(counts), sum(sum(c.values()) for _, c in counts)
    held = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        rows = []
        for key, c in counts:
            m = 100 - 75 + (75 * sum(c.values()) * number) // total
            score = sum(
                math.floor(1000 * math.log((2 * number + 2) / (2 * held[t] + 1)))
                * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in _terms(text)
                if t in c
            )
            if score > 0:
                rows.append((-score, key is None, key or 0, key))
        out += [(item, i + 1, r[3], -r[0]) for i, r in enumerate(sorted(rows, key=lambda r: r[:3])[:kept])]
    return sorted(out, key=str)


def _tables(spark, docs, items):
    frame = spark.createDataFrame([(k, t, 1, "s") for k, t in docs], "doc_id long, text string, item_id int, term string")
    asked = spark.createDataFrame([(k, t, 2, "n") for k, t in items], "item_id long, text string, doc_id int, codes string")
    return frame, asked


@pytest.mark.parametrize("postings", [1 << 20, 7])
def test_search_equals_scoring_every_document(spark, postings, monkeypatch):
    monkeypatch.setattr(lexical, "CELLS", 50)
    draw = np.random.default_rng(1)
    words = ["a", "b", "x", "Ünï", "日本", *(f"w{i}" for i in range(30))]
    docs = [(i, t) for i, t in enumerate(ODD)]
    docs += [(100 + i, " ".join(draw.choice(words, draw.integers(1, 60)))) for i in range(200)]
    docs += [(400 + i, "w1 w2 w2") for i in range(60)] + [(None, "w1 w2 w2"), (None, "b"), (400, "w1 w2 w2"), (0, "b")]
    items = [(1, "a B b"), (2, "w1 w1 w2"), (3, None), (4, ""), (5, "nowhere"), (None, "x Ünï"), (6, " ".join(words * 2)), (1, "a B b")]
    frame, asked = _tables(spark, docs, items)
    found = lexical.search(frame.repartition(5), asked, postings=postings).collect()
    rows = sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in found), key=str)
    assert rows == _search(docs, dict.fromkeys(items), 10)
    assert lexical.search(frame.where("false"), asked).count() == 0
    assert lexical.search(frame, asked.where("false")).count() == 0


def test_large_sums_stay_exact():
    class Own:
        items, place, times = np.arange(1), np.zeros(2, np.int64), np.array([2**20, 3])
        ends, sizes, repeats = np.array([1, 2]), np.array([1, 1]), np.array([2.0**20, 3.0])

    weights, m = np.array([40_000, 33_333]), np.array([26])
    found = lexical.document_scores(Own, weights, m, np.zeros(2, np.int64), np.array([0, 1]), np.array([10**9, 7]))
    each = [w * (10**9 * t // (1000 * t + 8 * 26)) for w, t in ((40_000, 10**9), (33_333, 7))]
    assert found.tolist() == [[each[0] * 2**20 + each[1] * 3]]


RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
         ("com", "/de/", "block"), ("a.com", "/", "block"), ("both.net", "/x", "allow"), ("both.net", "/x", "block"),
         (None, "/", "block"), ("net", None, "block"), ("bad/host", "/", "block"), ("com", "nopath", "block"), ("whole.net", "", "block")]


def _judged(url, rules, listed):
    rest = url[url.index("://") + 3 :] if url and "://" in url else ""
    host = re.sub("[A-Z]", lambda m: m.group().lower(), re.match(r"[^/?#]*", rest).group())
    path = re.match(r"[^/?#]*([^?#]*)", rest).group(1)
    fits = [
        (len(h + p), len(h), v == "block", h + p)
        for h, p, v in rules
        if h is not None and p is not None and "/" not in h and (p == "" or p[0] == "/")
        and ("." + host).endswith("." + h) and path.startswith(p)
    ]
    inside = any(("." + host).endswith("." + d) for d in listed if d is not None)
    best = max(fits) if fits else None
    blocked = best[2] if best else inside
    return host, path, best[3] if best else None, "block" if blocked else "allow", inside


def test_urls_are_judged_as_by_trying_every_rule(spark):
    hosts = ["example.org", "WWW.Example.org", "a.com", "b.a.com", "xa.com", "both.net", "sub.whole.net", "listed.info",
             "deep.er.listed.info", "unlisted.info", "", ".", "a..com", "org", "x" * 300 + ".com", "y." * 5000 + "com", "user@a.com", "a.com:80"]
    paths = ["", "/", "/es/1", "/en/12", "/en/2", "/fr/x?/de/", "/de/#top", "?q=/", "#/fr/", "/x//y", "/日本"]
    urls = [f"{s}://{h}{p}" for s in ("http", "") for h in hosts for p in paths] + [None, "", "no scheme", "a:/b", "x://y://org/"]
    listed = ["listed.info", "a.com", None, "elsewhere.info"]
    rows = [(i, u, "h", "v") for i, u in enumerate(urls)] + [(None, urls[0], "h", "v"), (3, urls[3], "h", "v")]
    frame = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    names = spark.createDataFrame([(d,) for d in listed], "key string")
    for size in (1 << 20, 40):
        found = cascade.judge(frame, rules, names, shard_keys=size).collect()
        wanted = [(k, *_judged(u, RULES, listed)) for k, u, *_ in rows]
        got = [(r.page_id, r.host, r.path, r.rule, r.verdict, r.listed) for r in found]
        assert sorted(got, key=str) == sorted(wanted, key=str)
    assert cascade.judge(frame.where("false"), rules, names).count() == 0
    free = cascade.judge(frame, rules.where("false")).collect()
    assert {(r.rule, r.verdict) for r in free} == {(None, "allow")}


@pytest.mark.parametrize("count, listed", [(1, 1), (5, 0), (30_000, 40), (30_000, 15_000), (2_000, 1_999), (7, 7)])
def test_a_cascade_is_exact_in_its_universe(count, listed):
    keys = cascade.hashes([f"k{i}" for i in range(count)], [0] * count)
    member = np.arange(count) < listed
    made = cascade.levels(keys[member], keys[~member])
    assert (cascade.listed_by(made, keys) == member).all()
    assert len(made) < 60
    if count == 30_000 and listed == 40:
        # Far less than the universe: some bits for each listed key.
        assert sum(len(level.bits) for level in made) < 40 * 8


def _whitened(vectors, wanted):
    x = np.floor(256 * np.asarray(vectors, np.float64)).astype(np.int64)
    fit = np.unique(x, axis=0)
    centred = fit - fit.sum(axis=0) / len(fit)
    value, vector = np.linalg.eigh(centred.T @ centred / len(fit))
    value, vector = value[::-1][:wanted], vector[:, ::-1][:, :wanted]
    total = fit.sum(axis=0)
    away = ((len(fit) * x - total) ** 2).sum(axis=1)
    return len(fit), away, (x - total / len(fit)) @ vector / np.sqrt(value), value / (centred**2).sum() * len(fit)


def test_whitening_equals_the_plain_decomposition(spark):
    draw = np.random.default_rng(4)
    vectors = (draw.normal(size=(300, 12)) * np.linspace(0.3, 2, 12)).astype(np.float32)
    vectors[::3] = vectors[0]
    vectors[5] = 0
    rows = [(i, v.tolist(), 1.0, 2) for i, v in enumerate(vectors)]
    bad = [None, [], [None] * 12, [float("nan")] + [1.0] * 11, [float("inf")] + [1.0] * 11, [1.0, 2.0], [3.0e38] * 12]
    rows += [(1000 + i, v, 1.0, 2) for i, v in enumerate(bad)] + [(None, vectors[1].tolist(), 1.0, 2)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n double, x int")
    found = whitening.whiten(frame.repartition(4)).collect()
    n, away, white, explained = _whitened(vectors, 4)
    assert len(found) == 4 * 301
    for r in found:
        i = 1 if r.vec_id is None else r.vec_id
        assert (r.n, r.deviation) == (n, away[i])
        assert abs(abs(r.whitened) - abs(white[i, r.component - 1])) < 1e-9
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-12)
        assert r.identity_error < 1e-12
    named = [r for r in found if r.vec_id is not None and abs(r.whitened) > 1e-6]
    assert len({(r.component, r.whitened * white[r.vec_id, r.component - 1] > 0) for r in named}) == 4


def test_whitening_of_tables_without_variance(spark):
    def frame(vectors):
        return spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>")

    assert whitening.whiten(frame([]).where("false")).count() == 0
    assert whitening.whiten(frame([[1.0, 2.0], [1.0, 2.0], None])).count() == 0
    line = whitening.whiten(frame([[0.0, 0.0, 1.0], [1.0, 1.0, 1.0], [2.0, 2.0, 1.0]])).collect()
    assert {r.component for r in line} == {1} and line[0].explained == pytest.approx(1)
    pair = whitening.whiten(frame([[float(2**45), 0.0], [-float(2**45), 1.0]])).collect()
    assert all(r.deviation is None for r in pair)


@pytest.mark.parametrize("size", [1, 3, 30, 200])
def test_residuals_reach_double_precision(size):
    draw = np.random.default_rng(size)
    turn = np.linalg.qr(draw.normal(size=(size, size)))[0]
    spectrum = np.sort(draw.random(size))[::-1] * 10
    spectrum[:3] = spectrum[0]
    matrix = turn @ np.diag(spectrum) @ turn.T
    calls = []

    def product(columns):
        calls.append(columns.shape[1])
        return matrix @ columns

    values, vectors = whitening.jacobi_davidson(product, size, 5)
    assert np.allclose(values, spectrum[: min(5, size)], rtol=1e-13)
    assert np.linalg.norm(matrix @ vectors - vectors * values, axis=0).max() <= 2e-13 * spectrum[0]
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-13)
    assert len(calls) < 150
