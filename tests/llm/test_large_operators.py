"""Repeats, n-gram links, language model and toxicity against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import tempfile
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lodewright.llm import pitman_yor, prefix_tree, repeats, toxicity
from lodewright.llm.induced import Sorter

CLASH = "doc_id long, text string, key string, n long, cid string, total string, split string"


def _frame(spark, rows):
    return spark.createDataFrame([(k, t, "a", 1, "b", "c", "d") for k, t in rows], CLASH)


@pytest.mark.parametrize("memory", [1, 16, 10**6])
def test_suffixes_and_common_prefixes(memory):
    draw = np.random.default_rng(memory)
    for trial in range(25):
        symbols = int(draw.choice([1, 2, 5, 3000]))
        text = draw.integers(0, symbols, int(draw.integers(1, 90)))
        text = np.tile(text, 3) if trial % 3 == 0 else text
        cap = int(draw.choice([3, 40]))
        with tempfile.TemporaryDirectory() as folder:
            blocks = list(Sorter(text, symbols, cap, memory, folder).suffixes())
        places = np.concatenate([p for p, _ in blocks]).tolist()
        shared = np.concatenate([s for _, s in blocks]).tolist()
        cut = [tuple(text[i : i + cap].tolist()) for i in range(len(text))]
        assert sorted(places) == list(range(len(text)))
        found = [cut[i] for i in places]
        assert found == sorted(cut, reverse=True)
        for one, two, n in zip(found, found[1:], shared[1:]):
            least = min(len(one), len(two))
            assert n == next((i for i in range(least) if one[i] != two[i]), least)


def _without_repeats(rows, least):
    count = Counter()
    data = [(k, (t or "").encode()) for k, t in rows]
    for _, b in data:
        count.update(b[i : i + least] for i in range(len(b) - least + 1))
    out = []
    for key, b in data:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - least + 1):
            if count[b[i : i + least]] > 1:
                gone[i : i + least] = True
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-1]])[: len(b)]).sum()) if b else 0
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((key, len(b), int(gone[:-1].sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_removed_repeats_equal_counting_all_strings(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SHARE", 2)
    draw = random.Random(1)
    passage = "".join(draw.choice("abcdé ") for _ in range(700))
    rows = []
    for i in range(80):
        text = "".join(draw.choice("ab ") for _ in range(draw.randrange(0, 700)))
        first = draw.randrange(0, 300)
        rows.append((i, text + passage[first : first + draw.randrange(350, 700)] + text[:50] if i % 3 else text))
    rows += [(100, "a" * 3000), (101, "ab" * 300), (102, None), (103, ""), (104, passage), (104, passage),
             (None, "x" + passage * 2), (107, "q" * 400), (108, "q" * 400), (109, "r" * 399)]
    found = sorted((tuple(r) for r in repeats.deduplicated(_frame(spark, rows)).collect()), key=str)
    assert found == _without_repeats(rows, 400)
    assert repeats.deduplicated(_frame(spark, rows).where("false")).count() == 0


def test_passages_of_over_fifty_words_go_whatever_their_bytes(spark):
    draw = random.Random(9)
    made = iter(range(10**6))
    fresh = lambda n: " ".join(f"{draw.choice('abcdefgh')}{next(made)}" for _ in range(n))
    long, short, left, right = fresh(51), fresh(50), fresh(30), fresh(30)
    tiny = " ".join(draw.choice("abcdefghijklmnopq") for _ in range(51))
    solid = "".join(draw.choice("日本語文字列") for _ in range(200))
    assert len(long.encode()) < 400 and len(tiny) == 101
    rows = [(i, f"{fresh(20)} {p} {fresh(20)}") for i, p in enumerate(
        [long, f"({long}).", short, short, f"{left} {right}", left, right, tiny, tiny, fresh(90), solid, solid])]
    twice = fresh(60)
    rows += [(20, twice), (21, twice), (22, None), (23, ""), (24, long[3:])]
    docs = _frame(spark, rows).select("doc_id", "text").fillna("", ["text"])
    lost = {bytes(r.key): r for r in repeats.remove_passages(docs, memory=1000).collect()}
    gone = {k: lost[hashlib.md5((t or "").encode()).digest()].kept.decode() for k, t in rows
            if hashlib.md5((t or "").encode()).digest() in lost}
    assert sorted(gone) == [0, 1, 7, 8, 10, 11, 20, 21]
    for key, passage in ((0, long), (1, long), (7, tiny), (8, tiny), (20, twice)):
        assert gone[key] == rows[key][1].replace(passage, "") if key < 20 else gone[key] == ""
    assert all(solid[1:-1] not in gone[k] for k in (10, 11))
    assert repeats.remove_passages(docs.where("false")).count() == 0


def _linked(rows, words, percent):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)} or ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                parent[root(i)] = root(j)
    smallest = {}
    for i, (key, _) in enumerate(rows):
        smallest.setdefault(root(i), []).append(key)
    return sorted(
        ((k, len(sets[i]), min((x for x in smallest[root(i)] if x is not None), default=None)) for i, (k, _) in enumerate(rows)),
        key=str,
    )


def test_linked_documents_equal_comparing_all(spark, monkeypatch):
    monkeypatch.setattr(prefix_tree, "SHARED", 4)
    monkeypatch.setattr(prefix_tree, "BLOCK", 8)
    draw = random.Random(2)
    base = [f"w{draw.randrange(40)}x{i}" for i in range(100)]
    rows = []
    for i in range(90):
        words = list(base)
        for _ in range(draw.randrange(5)):
            words[draw.randrange(len(words))] = f"w{draw.randrange(40)}"
        rows.append((i * 7 % 101, " ".join(words)))
    texts = [None, "", " \t", "a", "A", "a b", "a  B", "x y z", "x y z x y z", "x y z x y z x"]
    rows += [(200 + i, t) for i, t in enumerate(texts)] + [(None, "only here and nowhere else"), (3, rows[0][1])]
    found = sorted((tuple(r) for r in prefix_tree.join(_frame(spark, rows)).collect()), key=str)
    assert found == _linked(rows, 3, 90)
    assert prefix_tree.join(_frame(spark, rows).where("false")).count() == 0


def test_tree_links_equal_intersections():
    draw = np.random.default_rng(0)
    for _ in range(40):
        base = np.unique(draw.integers(0, 500, 60).astype(np.uint64))
        sets = [np.unique(np.concatenate([base[draw.random(len(base)) < 0.96], draw.integers(0, 500, 3).astype(np.uint64)]))
                for _ in range(20)]
        frequent = np.unique(draw.integers(0, 500, 100).astype(np.uint64))
        hit = prefix_tree.tree_links(base, sets, 90, lambda s: prefix_tree.ordered(s, frequent))
        wanted = [i for i, s in enumerate(sets)
                  if 100 * len(np.intersect1d(s, base)) >= 90 * len(np.union1d(s, base))]
        assert sorted(hit) == wanted


def test_scores_hold_exact_counts_and_sum_to_one(spark):
    draw = random.Random(4)
    vocabulary = [f"{a}{b}" for a in ("the", "of", "ing", "é") for b in ("", "x", "yy", "z")]
    rows = [(i, " ".join(draw.choice(vocabulary) for _ in range(draw.randrange(60)))) for i in range(150)]
    rows += [(500, None), (501, ""), (None, "the"), (1, "The  OF\tunseen"), (502, "\x1c ﬁ")]
    found = pitman_yor.score(_frame(spark, rows)).collect()
    texts = [(k, re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)})) + [""]) for k, t in rows]
    held = lambda k: k is not None and zlib.crc32(str(k).encode()) % 5 == 1
    count = Counter(w for k, words in texts if not held(k) for w in words)
    tokens, types = sum(count.values()), len(count)
    wanted = sorted(
        (str(k), held(k), len(w), sum(count[x] > 0 for x in w), tokens,
         round(sum(math.log10((count[x] + 0.5) / (tokens + 0.5 * (types + 1))) for x in w), 6))
        for k, w in texts
    )
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found) == wanted
    assert all(r.score < 0 for r in found)
    assert pitman_yor.score(_frame(spark, rows).where("false")).count() == 0


def test_frequent_words_are_counted_in_all_texts(spark):
    # In each task more words than any list of candidates holds are ahead of the one that leads in total.
    rows = [(i, "common " + " ".join(f"w{i}x{n} " * 3 for n in range(5000))) for i in range(4)]
    train = _frame(spark, rows).repartition(4, "doc_id")
    assert pitman_yor._frequent(train)[0] == "common"
    assert pitman_yor._frequent(train.where("false")) == []


def test_a_word_beyond_the_frequent_ones_is_a_context(spark):
    # 256 words in most places, and 600 rarer ones of the same count, in pairs that always stand together.
    follows = [f"p{i} q{(i * 7) % 300}" for i in range(300)]
    held = lambda k: zlib.crc32(str(k).encode()) % 5 == 1
    rows = [(k, " ".join(random.Random(k).sample(follows, 300))) for k in range(30) if not held(k)]
    rows += [(k, " ".join(f"f{i}" for i in range(256))) for k in range(1000, 1100) if not held(k)]
    right, wrong = [k for k in range(100, 200) if held(k)][:2]
    rows += [(right, " ".join(follows)), (wrong, " ".join(f"p{i} q{(i * 7 + 1) % 300}" for i in range(300)))]
    found = {r.doc_id: r for r in pitman_yor.score(_frame(spark, rows)).collect()}
    assert found[right].base_score == pytest.approx(found[wrong].base_score)
    assert found[right].score > found[wrong].score + 100


def test_the_words_before_words_and_ends():
    coded, ends = pitman_yor._split(pa.array(["a b", "", "c"]))
    assert pitman_yor._before(coded, ends, 9).tolist() == [9, 0, 9, 1, 9, 2]
    coded, ends = pitman_yor._split(pa.array(["", " "]))
    assert pitman_yor._before(coded, ends, 9).tolist() == [9, 9]


def test_scores_average_three_sampled_seatings_at_least():
    import inspect

    # The first sweep only starts, and is left out of the average.
    for function in (pitman_yor.fit, pitman_yor.score):
        assert inspect.signature(function).parameters["sweeps"].default - 1 >= 3


def test_spelling_sums_to_one():
    codes, owner = pitman_yor._codes(["the", "then", "of", "é", ""])
    code, number = np.unique(codes, return_counts=True)
    spelling = pitman_yor.Spelling(code, number, 0)
    for before in [(256, 256), (256, ord("t")), (ord("t"), ord("h")), (1, 2)]:
        every = (before[0] * pitman_yor.LETTERS + before[1]) * pitman_yor.LETTERS + np.arange(pitman_yor.LETTERS)
        assert spelling.of(every).sum() == pytest.approx(1)


def test_tables_are_bounded_and_few_for_weak_pull():
    draw = np.random.default_rng(1)
    customers = np.array([0, 1, 2, 50, 10_000, 10**6])
    for pull in (1e-6, 1.0, 1e9):
        tables = pitman_yor.seat(customers, np.full(6, pull), 0.5, draw)
        assert (tables <= customers).all() and (tables >= np.minimum(customers, 1)).all()
    assert pitman_yor.seat(customers, np.full(6, 1e-9), 0.1, draw).tolist() == [0, 1, 1, 1, 1, 1]


def test_customers_are_seated_one_by_one():
    draw = np.random.default_rng(5)
    for pull, discount, seated, tables in [(0.3, 0.9, 1, 1), (40.0, 0.5, 60, 30), (1e5, 0.1, 2, 2), (1e-9, 0.9, 1, 1)]:
        luck = draw.random(20_000)
        now = tables
        for j, u in enumerate(luck):
            now += u * (pull + seated + j - discount * now) < pull
        assert pitman_yor.queue(luck, seated, pull, discount, tables) == now - tables
    # Many dishes side by side, and the same ones alone, have as many tables.
    customers, pull = np.full(2000, 300), np.full(2000, 3.0)
    beside = pitman_yor.seat(customers, pull, 0.5, draw).mean()
    alone = np.mean([pitman_yor.seat(customers[:200], pull[:200], 0.5, draw).mean() for _ in range(10)])
    assert beside == pytest.approx(alone, rel=0.03)


def _chunked(spark, rows):
    docs = _frame(spark, rows).selectExpr("doc_id", "coalesce(text, '') AS text", "true AS learn")
    return pitman_yor._chunks(docs.repartition(3)).localCheckpoint()


def _model(spark, rows, sweeps):
    """Groups, words and pairs after the sweeps; all rows are learned from."""
    chunks, parts, shards = _chunked(spark, rows), 5, 3
    vocabulary = pitman_yor._vocabulary(chunks, shards).localCheckpoint()
    group = pitman_yor._groups(chunks, pitman_yor._frequent(pitman_yor._counted(vocabulary)))
    pairs = pitman_yor._pairs(chunks, vocabulary, group, parts, shards).localCheckpoint()
    return group, *pitman_yor.fit(vocabulary, pairs, shards, 0.5, sweeps)


def test_pairs_of_words_are_seated_and_their_tables_are_customers(spark):
    draw = random.Random(2)
    rows = [(i, " ".join(draw.choice("abcdefgh") for _ in range(200))) for i in range(60)]
    _, words, seats, _ = _model(spark, rows, 3)
    parts = [pitman_yor._Part(r.data) for r in words.collect()]
    rows = seats.where(f"kind = {pitman_yor.REPEATED}").collect()
    customers, total = (np.concatenate([pitman_yor._unpack(r.data)[i] for r in rows]) for i in (2, 4))
    assert customers.min() > 1 and (total > 2).any() and (total >= 2).all() and (total <= 2 * customers).all()
    more = sum(pitman_yor._unpack(r.data)[0].sum() for r in seats.where(f"kind = {pitman_yor.SEATED}").collect())
    served, filled = (sum(getattr(p, name).sum() for p in parts) for name in ("served", "filled"))
    # Every pair's tables are counted in its preceding word's restaurant, and are customers of its group's.
    assert served == filled == sum(p.served_once.sum() for p in parts) + more > sum(p.served_once.sum() for p in parts)


def test_words_probabilities_in_a_group_sum_to_one(spark):
    rows = [(i, " ".join(f"w{(i * j) % 23}" for j in range(1, 80))) for i in range(40)]
    _, words, _, past = _model(spark, rows, 3)
    own, escape = np.zeros(pitman_yor.CONTEXTS), past[-1].escape()
    for row in words.collect():
        part = pitman_yor._Part(row.data)
        own += np.bincount(part.context, weights=part.probabilities(past[-1])[0], minlength=pitman_yor.CONTEXTS)
    assert own + escape == pytest.approx(1)


def test_scores_equal_a_plain_model(spark):
    draw = random.Random(7)
    rows = [(i, " ".join(f"v{int(draw.random() ** 3 * 40)}" for _ in range(draw.randrange(1, 50)))) for i in range(120)]
    held = {k for k, _ in rows if zlib.crc32(str(k).encode()) % 5 == 1}
    group = pitman_yor._groups(*(lambda c: (c, [w for w, _ in Counter(w for k, t in rows if k not in held for w in t.split()).most_common()]))(
        _chunked(spark, [r for r in rows if r[0] not in held])))
    found = {r.doc_id: r.score for r in pitman_yor.score(_frame(spark, rows), sweeps=1).collect()}

    def tokens(text):
        context, before = 0, ""
        for word in [*text.split(), ""]:
            yield context, before, word
            context, before = group.get(word, context), word

    n = Counter(x for k, t in rows if k not in held for x in tokens(t))
    share = lambda some: min(0.9, max(0.1, (a := sum(v == 1 for v in some)) / max(1, a + 2 * sum(v == 2 for v in some))))
    kept, filled, served = Counter(), Counter(), Counter()
    for (g, b, w), number in n.items():
        kept[g, b] += number
        filled[g, b] += 1
        served[g, w] += 1
    guests, dishes = Counter(w for _, w in served), Counter(g for g, _ in served)
    total = Counter()
    for (g, _), number in served.items():
        total[g] += number
    d, d0, d1, strength = share(n.values()), share(served.values()), share(guests.values()), pitman_yor.STRENGTH
    codes, number = np.unique(pitman_yor._codes(list(guests))[0], return_counts=True)
    spelling = pitman_yor.Spelling(codes, number, 0)

    def chance(g, b, w):
        p = float(np.prod(spelling.of(pitman_yor._codes([w])[0])))
        p = (max(0, guests[w] - d1) + (strength + d1 * len(guests)) * p) / (strength + guests.total())
        p = (max(0, served[g, w] - d0) + (strength + d0 * dishes[g]) * p) / (strength + total[g])
        return (max(0, n[g, b, w] - d) + (strength + d * filled[g, b]) * p) / (strength + kept[g, b])

    wanted = {k: sum(math.log10(chance(*x)) for x in tokens(t)) for k, t in rows}
    assert found == {k: pytest.approx(v, rel=1e-6) for k, v in wanted.items()}


def test_pairs_of_words_are_sent_in_few_bytes_and_evenly():
    draw = np.random.default_rng(3)
    # One word in half of the pairs.
    word, cell = np.where(draw.random(200_000) < 0.5, 7, draw.integers(0, 50_000, 200_000)), draw.integers(0, 500_000, 200_000)
    part = pitman_yor._part(word, cell, 20)
    assert np.bincount(part, minlength=20).max() < 1.1 * 10_000
    order = np.lexsort((cell, word))
    data = pitman_yor._pack(pitman_yor._steps(word[order]), cell[order], np.ones(200_000, np.int64))
    assert len(data) < 5 * 200_000
    back = pitman_yor._unpack(data)
    assert (np.cumsum(back[0]) == word[order]).all() and (back[1] == cell[order]).all()
    some = [np.array([-5, 1 << 40]), np.zeros(0, np.int64), np.array([0.1, -3e300]), np.array([1 << 31, 70_000])]
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(some, pitman_yor._unpack(pitman_yor._pack(*some))))


def test_subsequence_kernel_equals_listing_all():
    def listed(text):
        out = Counter()

        def go(first, taken, begin):
            if len(taken) == toxicity.LENGTH:
                return
            for i in range(first, len(text)):
                more = taken + text[i]
                start = i if begin is None else begin
                if len(more) == toxicity.LENGTH:
                    out[more] += toxicity.DECAY ** (i - start + 1)
                go(i + 1, more, start)

        go(0, "", None)
        return out

    strings = ["abcde", "aabcde", "a-b-c-de", "edcba", "abcdeabc", "xy"]
    found = toxicity.subsequences(strings, strings)
    for i, a in enumerate(map(listed, strings)):
        for j, b in enumerate(map(listed, strings)):
            assert found[i, j] == pytest.approx(sum(a[s] * b[s] for s in a), rel=1e-4, abs=1e-6)


def test_toxic_texts_are_found_and_clean_ones_left(spark):
    draw = random.Random(6)
    syllables = ["ran", "tel", "mo", "sit", "ler", "on", "ka", "bis"]
    word = lambda: "".join(draw.choice(syllables) for _ in range(draw.randrange(1, 4)))
    rows, labels = [], []
    for i in range(600):
        words = [word() for _ in range(60)]
        bad = i % 4 == 0
        if bad:
            words[draw.randrange(60)] = draw.choice(["blockhead", "numskull", "dimwitted"])
        rows.append((i, " ".join(words)))
        if i < 500:
            labels.append((i, int(bad)))
    rows += [(900, "you BLOCK-HEAD, go"), (901, "what a b l o c k h e a d"), (902, "numxskull it is"),
             (903, None), (904, ""), (905, "mo " * 50_000), (None, "ran tel"), (0, rows[0][1])]
    marks = spark.createDataFrame([*labels, (0, 1), (7, None), (None, 1)], "doc_id long, toxic int")
    scored = toxicity.toxicity(_frame(spark, rows), marks, ["doc_id"]).collect()
    assert len(scored) == len(rows) and all(0 <= r.score <= 1 for r in scored)
    score = {r.doc_id: r.score for r in scored}
    fresh = [i for i in range(500, 600)]
    assert all(score[i] >= toxicity.THRESHOLD for i in fresh if i % 4 == 0)
    assert sum(score[i] >= toxicity.THRESHOLD for i in fresh if i % 4) <= 3
    assert min(score[900], score[901], score[902]) >= toxicity.THRESHOLD
    assert max(score[903], score[904], score[905], score[None]) < toxicity.THRESHOLD
    none = toxicity.toxicity(_frame(spark, rows), marks.where("toxic = 0"), ["doc_id"])
    assert none.select("score").distinct().count() == 1
    assert toxicity.toxicity(_frame(spark, rows).where("false"), marks, ["doc_id"]).count() == 0


def test_scores_survive_another_split_size(spark, tmp_path):
    path = str(tmp_path / "docs")
    rows = [(i, " ".join(f"w{(i * j) % 97}" for j in range(1, 200))) for i in range(300)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.option("parquet.block.size", 20_000).parquet(path)
    sizes = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    before = [spark.conf.get(name) for name in sizes]
    try:
        found = pitman_yor.score(spark.read.parquet(path))
        wanted = {r.doc_id: r.base_score for r in found.collect()}
        for name in sizes:
            spark.conf.set(name, "7k")
        again = pitman_yor.score(spark.read.parquet(path))
        for name, value in zip(sizes, before):
            spark.conf.set(name, value)
        assert {r.doc_id: pytest.approx(r.base_score) for r in again.collect()} == wanted
    finally:
        for name, value in zip(sizes, before):
            spark.conf.set(name, value)


def test_suffixes_are_sorted_with_few_numbers_by_comparison(monkeypatch, tmp_path):
    """Symbols and buckets are sorted by radix, and doubling sorts only what isn't alone in its rank yet."""
    from lodewright.llm import induced

    draw = np.random.default_rng(5)
    letters = draw.integers(1, 5, 4000)
    text = np.concatenate([letters, [0], letters[500:900], [0], draw.integers(1, 200, 3000), [0]]).astype(np.uint16)
    sorted_, real = [], np.argsort

    def watched(values, *args, **kinds):
        if np.asarray(values).dtype.itemsize > 2:
            sorted_.append(len(values))
        return real(values, *args, **kinds)

    monkeypatch.setattr(np, "argsort", watched)
    places, shared = (
        np.concatenate(x) for x in zip(*induced.Sorter(text, 257, 400, 1 << 22, str(tmp_path)).suffixes())
    )
    raw = text.tolist()
    wanted = sorted(range(len(raw)), key=lambda i: raw[i : i + 400], reverse=True)
    assert [raw[i : i + 400] for i in places] == [raw[i : i + 400] for i in wanted]
    for a, b, same in zip(places, places[1:], shared[1:]):
        x, y = raw[a : a + 400], raw[b : b + 400]
        assert same == next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
    # The names once, and after that ever fewer of them.
    names = sorted_[0]
    assert sum(sorted_) < 4 * names


def test_packing_reads_a_batch_in_parts(monkeypatch):
    import public_tokenizers

    from lodewright.llm import packing

    sizes, real = [], packing.Encoder.__call__

    def watched(self, texts):
        sizes.append(sum(map(len, texts)))
        return real(self, texts)

    monkeypatch.setattr(packing.Encoder, "__call__", watched)

    class Frame:
        def mapInArrow(self, cut, schema):  # noqa: N802
            return cut

    monkeypatch.setattr(packing.TaskContext, "get", staticmethod(lambda: type("T", (), {"partitionId": lambda self: 0})()))
    texts = [f"word{i % 7} and more. " * 2000 for i in range(60)]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(60), pa.int64()), "text": texts})
    cut = packing.pieces(Frame(), public_tokenizers.path("word_bpe_49k.json"), 2048, 0, False)
    rows = pa.Table.from_batches(list(cut([batch])))
    assert max(sizes) <= 1 << 20 and sum(sizes) == sum(map(len, texts))
    assert sorted(set(rows.column("doc_id").to_pylist())) == list(range(60))


def test_the_sorter_works_on_few_places_at_once(tmp_path):
    import tracemalloc

    text = np.random.default_rng(3).integers(1, 30, 600_000).astype(np.uint16)
    tracemalloc.start()
    number = sum(len(places) for places, _ in Sorter(text, 257, 100, 1 << 22, str(tmp_path)).suffixes())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert number == len(text) and peak < 70 * len(text)


def test_marks_and_segments_are_passed_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(repeats, "_ROWS", 10)
    monkeypatch.setattr(repeats, "PART_BYTES", 1000)
    draw = random.Random(4)
    passage = "".join(draw.choice("abcdefgh ") for _ in range(600))
    rows = [(i, "".join(draw.choice("xyz ") for _ in range(700)) + passage * (i % 2)) for i in range(30)]
    found = sorted((tuple(r) for r in repeats.deduplicated(_frame(spark, rows)).collect()), key=str)
    assert found == _without_repeats(rows, 400)

    class Held:
        """A frame that keeps what mapInArrow is given."""

        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            self.run = run

    held = Held()
    monkeypatch.setattr(repeats, "_keyed", lambda docs: held)
    repeats._marks(held, 400, 128)
    texts = [text.encode() for _, text in rows]
    batch = pa.RecordBatch.from_pydict({"key": [hashlib.md5(t).digest() for t in texts], "data": texts})
    sizes = [part.num_rows for part in held.run([batch])]
    most = max(len(repeats.runs(np.frombuffer(t, np.uint8), 400, 128)[0]) for t in texts)
    assert len(sizes) > 1 and max(sizes) < 10 + most


def test_passages_run_one_python_step_a_stage(spark, monkeypatch):
    plans, real = [], repeats.written

    def watched(frame, label):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return real(frame, label)

    monkeypatch.setattr(repeats, "written", watched)
    draw = random.Random(6)
    passage = " ".join(draw.choice(["alpha", "beta", "gämma", "delta"]) + str(i) for i in range(80))
    docs = _frame(spark, [(1, f"one {passage} é"), (2, f"two {passage}"), (3, "three"), (4, None)])
    kept = repeats.passages_cut(docs.select("doc_id", "text").fillna("", ["text"]))
    plans.append(kept._jdf.queryExecution().executedPlan().toString())
    assert sorted(r.kept for r in kept.collect()) == ["one é", "two"]
    for plan in plans:
        steps = re.findall(r"MapInArrow|Exchange", plan)
        assert ("MapInArrow", "MapInArrow") not in list(zip(steps, steps[1:]))


def test_a_join_leaves_no_large_step_behind(spark, monkeypatch):
    from lodewright.llm.tables import open_folder

    steps, real = [], prefix_tree.written

    def watched(frame, label):
        stored = real(frame, label)
        steps.append((label, stored.written_at))
        return stored

    monkeypatch.setattr(prefix_tree, "written", watched)
    base = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    rows = [(i, f"{base} {base[: i % 3]} {i % 7}") for i in range(30)]
    found = prefix_tree.join(_frame(spark, rows))
    left = [label for label, path in steps if open_folder(path)[0].get_file_info(open_folder(path)[1]).type.name != "NotFound"]
    assert not {"described", "classes", "members", "grams", "open"} & set(left)
    assert sorted((tuple(r) for r in found.collect()), key=str) == _linked(rows, 3, 90)


def test_written_steps_leave_no_shuffle_files(spark):
    import time
    from pathlib import Path

    from pyspark.sql import functions as F

    from lodewright.llm.tables import _CLEANUP, written

    folders = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
    shuffled = lambda: {f for folder in folders for f in Path(folder).rglob("shuffle_*.data")}
    setting, before = spark.conf.get(_CLEANUP), shuffled()
    stored = written(spark.range(1000).groupBy(F.col("id") % 7).count(), "counts")
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not shuffled() - before
    assert spark.conf.get(_CLEANUP) == setting and stored.count() == 7
