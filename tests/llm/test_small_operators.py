"""Archives, fingerprints, vectors, licences, pieces and packing against plain versions."""

from __future__ import annotations

import base64
import hashlib
import io
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lodewright.llm import fingerprints, licenses, packing, sentence_pieces, vantage, warc
from lodewright.llm.tables import documents

CLASH = "doc_id long, text string, hash string, sketch string, n long, ids string"


def _docs(spark, texts, first=0):
    rows = [(first + i, text, "x", "y", None, "z") for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, CLASH)


def test_archive_records_point_to_the_largest_equal_page(spark):
    pages = [(1, "u", "a"), (2, "http://x/ é\n", "a"), (3, None, "b" * 70_000), (4, "u", None), (5, "u", ""),
             (None, "u", "a"), (2, "u", "a")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("hash", F.lit(1))
    found = [
        (r.page, r.payload_bytes, r.payload_digest, r.record_type, r.refers)
        for r in warc.round_trip(frame)
        .withColumn("page", warc.page_of("record_id"))
        .withColumn("refers", warc.page_of("refers_to"))
        .collect()
    ]
    wanted = []
    for key, _, html in pages:
        data = (html or "").encode()
        best = max(k for k, _, h in pages if (h or "") == (html or "") and k is not None)
        again = key != best
        wanted.append((key, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                       "revisit" if again else "response", best if again else None))
    assert sorted(found, key=str) == sorted(wanted, key=str)
    assert warc.round_trip(frame.where("page_id > 9")).count() == 0


@pytest.mark.parametrize("size", [1, 7, 100, 10_000])
def test_ranges_of_any_size_give_each_record_once(size):
    records = [
        warc._record("response", i, "u", bytes([i % 256]) * i * 30 + warc.MAGIC * (i % 3), "d", None, "t")
        for i in range(20)
    ]
    data = b"junk" + warc.MAGIC + b"".join(records) + b"\0\0" + records[0]
    found = [
        offset
        for begin in range(0, len(data), size)
        for offset, content in warc.members(io.BytesIO(data), begin, min(begin + size, len(data)))
        if content.startswith(warc.VERSION)
    ]
    ends = np.cumsum([7, *map(len, records)])
    assert found == [*ends[:-1].tolist(), int(ends[-1]) + 2]


def _sketch(text, k):
    words = [w for w in text.replace("\n", " ").split(" ") if w]
    return len({tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))}) if words else 0


def test_damaged_records_are_rows_and_the_others_are_read(spark, tmp_path):
    text = "".join(chr(97 + i * i % 23) for i in range(3000)).encode()
    good = [warc._record("response", i, "u", text + b"%d" % i, warc.digest(text + b"%d" % i), None, "t") for i in range(6)]

    def other(old, new):
        return zlib.compress(zlib.decompress(good[0], 31).replace(old, new), 6, 31)

    flipped = bytearray(good[0])
    flipped[len(flipped) // 2] ^= 255
    bad = {
        "damaged member": bytes(flipped), "no content length": other(b"Content-Length: 3", b"Content-Length: x3"),
        "no record type": other(b"WARC-Type", b"WARC-Tape"), "payload without its digest": other(b"sha1:", b"sha1:A"),
    }
    parts = [piece for pair in zip(good[1:], bad.values()) for piece in pair] + [good[5]]
    data = b"".join(parts) + good[0][:-40]
    file = tmp_path / "a.warc.gz"
    file.write_bytes(data)
    for size in (100, 997, len(data)):
        rows = warc.read_archives(warc.archives(spark, str(file)), size).orderBy("offset").collect()
        assert [r.error for r in rows] == [e for error in bad for e in (None, error)] + [None, "cut off"]
        assert [r.record_id for r in rows if not r.error] == [f"<urn:page:{i}>" for i in (1, 2, 3, 4, 5)]
        assert all(r.payload == text + b"%d" % (2 * i // 2 + 1) for i, r in enumerate(r for r in rows if not r.error))


def test_fingerprints_and_edited_texts(spark):
    texts = ["a b c d e f g", None, "", "one", "a b c d e f g", "déjà vu " * 40] + [f"w{i} " * 3 + "x y z" for i in range(40)]
    rows = fingerprints.edited(documents(_docs(spark, texts))).collect()
    by = {r.doc_id: r for r in rows}
    assert len(by) == len(texts)
    for i, text in enumerate(texts):
        own, following = text or "", texts[i - 1] or ""
        half = len(own) // 2
        assert by[i].edited == own[: len(own) - half] + following[:half]
        assert len(by[i].sketch) == min(fingerprints.K, _sketch(own, fingerprints.K))
        assert by[i].sketch == sorted(by[i].sketch)
    assert by[0].sketch == by[4].sketch
    assert (by[2].near_next, by[3].near_next) == (1.0, 0.0)
    assert fingerprints.edited(documents(_docs(spark, ["a b"]))).first().edited == "a a"
    assert fingerprints.edited(documents(_docs(spark, ["a"]).where("doc_id > 5"))).count() == 0


def test_merged_sketches_are_those_of_the_whole(spark):
    words = [f"w{i}" for i in range(900)]
    halves = [" ".join(words[:500]), " ".join(words[496:])]
    parts = _docs(spark, halves).select(F.lit(1).alias("g"), fingerprints.sketch(F.col("text")).alias("sketch"))
    whole = _docs(spark, [" ".join(words)]).select(fingerprints.sketch(F.col("text")).alias("s")).first().s
    assert fingerprints.merge_by(parts, ["g"]).first().sketch == whole
    two = _docs(spark, halves).groupBy().agg(
        F.max_by(fingerprints.sketch(F.col("text")), "doc_id").alias("b"),
        F.min_by(fingerprints.sketch(F.col("text")), "doc_id").alias("a"),
    )
    near = two.select(
        fingerprints.resemblance(F.col("a"), F.col("b")).alias("r"),
        fingerprints.containment(F.col("a"), F.col("a")).alias("c"),
        fingerprints.distinct_shingles(F.col("a")).alias("n"),
    ).first()
    assert near.r < 0.05 and near.c == 1.0 and abs(near.n - 496) < 150


def _nearest(vectors, queries, k):
    out = []
    for q, a in queries.items():
        score = sorted(
            ((-(np.dot(a, b) / (np.sqrt(np.dot(a, a)) * np.sqrt(np.dot(b, b)))), v) for v, b in vectors.items() if v != q)
        )[:k]
        out += [(q, i + 1, v, round(-s, 9)) for i, (s, v) in enumerate(score)]
    return sorted(out)


def _vectors(spark, count, copies):
    draw = np.random.default_rng(3)
    vectors = {i: draw.normal(size=8).astype(np.float32).tolist() for i in range(count)}
    for i in range(0, count, copies):
        vectors[i] = vectors[0]
    rows = [(i, v) for i, v in vectors.items()]
    rows += [(9001, None), (9002, [0.0] * 8), (9003, [float("nan")] + [1.0] * 7), (9004, [None] + [1.0] * 7), (None, [1.0] * 8)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit(0))
    return {i: np.array(v, np.float64) for i, v in vectors.items()}, frame


def test_nearest_vectors_are_exact_with_slack_one(spark):
    vectors, frame = _vectors(spark, 1200, 7)
    found = vantage.nearest(frame, frame.where("vec_id % 50 = 0"), 5, shard_rows=500).collect()
    wanted = _nearest(vectors, {i: v for i, v in vectors.items() if i % 50 == 0}, 5)
    assert sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in found) == wanted
    loose = vantage.nearest(frame, frame.where("vec_id % 50 = 0"), 5, slack=0.6, shard_rows=500).collect()
    hits = {(r.query_id, r.vec_id) for r in loose} & {(q, v) for q, _, v, _ in wanted}
    assert len(hits) >= 0.9 * len(wanted)
    assert vantage.nearest(frame.where("false"), frame.where("false")).count() == 0
    few = vantage.nearest(frame.where("vec_id < 3"), frame.where("vec_id = 1"), 5).collect()
    assert len(few) == 2


@pytest.mark.parametrize("others", [0, 150, 2000])
def test_parallel_vectors_tie_to_the_smallest_ids(monkeypatch, others):
    monkeypatch.setattr(vantage, "PRODUCTS", 1000)
    draw = np.random.default_rng(others)
    base = draw.normal(size=8)
    # Lengths are powers of two, so that cosines tie exactly; more than a leaf takes in the last case.
    vectors = np.concatenate([[base * 2.0**i for i in range(-150, 150)], draw.normal(size=(others, 8))])
    ids = draw.permutation(len(vectors)).astype(np.int64)
    asked = np.concatenate([[base * 3, vectors[7]], draw.normal(size=(20, 8))])
    keys = np.concatenate([[-1, ids[7]], -2 - np.arange(20)]).astype(np.int64)
    score, found = vantage.Tree(vectors, ids, 6).search(asked, keys, 5, 1.0)
    wanted = _nearest(dict(zip(ids.tolist(), vectors)), dict(zip(keys.tolist(), asked)), 5)
    rows = [(int(q), i + 1, int(v), round(float(s), 9)) for q, a, b in zip(keys, found, score) for i, (v, s) in enumerate(zip(a, b))]
    assert [r[3] for r in sorted(rows)] == [r[3] for r in wanted]
    own = {int(q): [int(v) for v in a] for q, a in zip(keys, found)}
    smallest = sorted(ids[:300].tolist())
    assert own[-1] == smallest[:5]
    assert own[int(ids[7])] == [i for i in smallest if i != ids[7]][:5]


def test_licences(spark):
    texts = ["Intro. Released under the MIT License. More.", "released  under THE mit license", None, "",
             "Licensed under CC BY-NC 4.0.\nLicensed under the Apache License, Version 2.0.", "the license"]
    rows = {r.doc_id: r for r in licenses.scan(_docs(spark, texts)).collect()}
    assert [(rows[i].licence, rows[i].n_licences) for i in range(6)] == [
        ("MIT", 1), ("MIT", 1), (None, 0), (None, 0), ("Apache-2.0", 2), (None, 0)
    ]
    assert rows[0].dice == 1.0
    assert licenses.scan(_docs(spark, ["x"]).where("false")).count() == 0


def test_licences_wrapped_over_lines(spark):
    wrapped = {
        "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted "
        "provided that the following conditions\nare met:",
        "MIT-notice": "Permission is hereby granted, free of charge, to any person\n# obtaining a copy of this software and "
        "associated documentation\n# files (the \"Software\"), to deal in the Software without restriction",
        "GPL-3.0-notice": "This program is free software: you can redistribute\n * it and/or modify it under the terms of "
        "the GNU\n * General Public License as published by the Free Software Foundation; either\n * version 3 of the "
        "License, or (at your option) any later version.",
    }
    words = " ".join(f"w{i} of the" for i in range(300))
    texts = [f"{words}\n\n{notice}\n{words}. The end" for notice in wrapped.values()]
    half = "Redistribution and use in source\nand binary forms, with or without\nchanges are another thing"
    rows = {r.doc_id: r for r in licenses.scan(_docs(spark, [*texts, f"{words} {half} {words}"])).collect()}
    for i, name in enumerate(wrapped):
        assert rows[i].licence == name and rows[i].dice > 0.95
    assert (rows[3].licence, rows[3].n_licences) == (None, 0)


def test_best_window_equals_trying_all(spark):
    import random

    draw = random.Random(2)
    own = "a b c d e f g h i j"
    texts = [" ".join(draw.choice([*"abcdefghijxy"]) for _ in range(4)) + "\n" + " ".join(
        w for w in own.split() if draw.random() < 0.93 for w in [w] + ["x"] * (draw.random() < 0.1)) + ".\n" + "y z" for _ in range(60)]
    pairs = licenses._template_bigrams(own)

    def best(text):
        w = text.replace(".", " ").split()
        b = [f"{x} {y}" for x, y in zip(w, w[1:])]
        sets = [set(b[i:j]) for i in range(len(b)) for j in range(i + 1, len(b) + 1)]
        top = max(2 * len(s & set(pairs)) / (len(s) + len(pairs)) for s in sets)
        return round(top, 9) if top >= 0.8 else None

    rows = licenses.scan(_docs(spark, texts), {"own": own}).collect()
    found = [None if r.dice is None else round(r.dice, 9) for r in sorted(rows, key=lambda r: r.doc_id)]
    assert found == [best(t) for t in texts]
    assert None in found and len(set(found)) > 3


TEXTS = ["", None, "  a  b", " ", "\n\t x", "日本語 text😀 abc", "The quick brown fox's   jumped", "ﬁ Å é",
         "aaaaaaaaaaaaaaaaaaaaaaaaa bbbbb", "1,000.00", "<s> </s> <unk> <0x0A>", "x" * 400, "def f(x):\n    return x"]


def test_pieces_equal_the_library_and_come_back(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    encoded = sentence_pieces.encode(_docs(spark, TEXTS), path)
    found = {r.doc_id: r.ids for r in encoded.collect()}
    assert [found[i] for i in range(len(TEXTS))] == [library.encode(t or "") for t in TEXTS]
    decoded = {r.doc_id: r for r in sentence_pieces.decode(encoded, path).collect()}
    for i, text in enumerate(TEXTS):
        assert decoded[i].text == (text or "")
        assert decoded[i].ids_crc32 == zlib.crc32(np.array(found[i], "<u4").tobytes())


def test_best_sum_of_scores_equals_trying_all():
    model = sentence_pieces.Pieces.__new__(sentence_pieces.Pieces)
    model.text = ["<unk>", "a", "b", "c", "ab", "bc", "abc", "ca", "cab"]
    model.score = np.array([0, -3.0, -3.2, -2.9, -4.1, -4.5, -8.0, -3.3, -9.0])
    model.unknown, model.merges, model.longest = 0, False, 3
    model.byte = np.full(256, -1)
    with np.errstate(over="ignore"):
        model.powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(3, sentence_pieces._ODD)]))
    keys = np.array([model._key(t) for t in model.text[1:]], np.uint64)
    order = np.argsort(keys)
    model.keys, model.ids = keys[order], np.arange(1, 9)[order]
    place = {t: i for i, t in enumerate(model.text) if i}

    def best(word):
        if not word:
            return 0.0
        tries = [model.score[place[word[:n]]] + best(word[n:]) for n in (1, 2, 3) if word[:n] in place]
        return max(tries)

    words = ["abc", "cab", "abcab", "ccabcba", "bcabcabca"]
    for word, ids in zip(words, model.words(words)):
        assert "".join(model.text[i] for i in ids) == word
        assert sum(model.score[i] for i in ids) == pytest.approx(best(word))


def test_packing_keeps_every_token_and_fills_sequences(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    texts = [*TEXTS, "a<|endoftext|>b", "x\x1cy z", "İ ΣΑΣ it's they're", "one two three " * 40] + ["w " * i for i in range(60)]
    capacity = 64
    rows = packing.pack(_docs(spark, texts), path, capacity, rounds=200, with_ids=True).collect()
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    total = 0
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        own = sorted(pieces[i], key=lambda r: r.piece)
        assert [(r.piece, r.start) for r in own] == [(n, n * capacity) for n in range(-(-len(ids) // capacity))]
        assert np.concatenate([np.frombuffer(r.ids, "<u4") for r in own]).tolist() == ids
        assert all(r.ids_crc32 == zlib.crc32(bytes(r.ids)) and r.length == len(r.ids) // 4 for r in own)
        total += len(ids)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        places.sort()
        assert [o for o, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))]
        assert sum(n for _, n in places) <= capacity
    assert len(sequences) <= -(-total // capacity) * 1.1 + 1
    assert packing.pack(_docs(spark, ["x"]).where("false"), path).count() == 0


def test_configurations_meet_any_demand():
    draw = np.random.default_rng(5)
    for _ in range(5):
        demand = np.where(draw.random(33) < 0.5, draw.integers(0, 50, 33), 0)
        demand[0] = 0
        used = packing.configurations(demand, 32, rounds=20)
        met = np.zeros(33, int)
        for taken, times in used:
            assert sum(n * c for n, c in taken.items()) <= 32
            for n, c in taken.items():
                met[n] += c * times
        assert (met == demand).all()


def test_long_words_equal_the_library_and_stay_linear():
    import time

    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library, model = sentencepiece.SentencePieceProcessor(model_file=path), sentence_pieces.pieces(path)
    draw = np.random.default_rng(8)
    letters = "".join(draw.choice([*"abcdefghijklmnopqrstuvwxyz"], 20_000))
    for word in (letters, "日本語テ" * 300, "aaaa" * 500, letters[:257], "é😀" * 400):
        ends, ids = model.encode([word, word[:255]])
        assert ids.tolist() == library.encode(word) + library.encode(word[:255])
        assert model.decode_all(ends, ids).to_pylist() == [word, word[:255]]
    start = time.perf_counter()
    model.encode([letters * 50])
    assert time.perf_counter() - start < 60


def test_long_words_have_the_best_sum_of_scores(monkeypatch):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentence_pieces.Pieces(path)
    model.merges = False
    word = "theinternationalisationofthings" * 3
    whole = model.words([word])[0]
    monkeypatch.setattr(sentence_pieces, "LONG", 10)
    monkeypatch.setattr(sentence_pieces, "PART", 7)
    alone = model.words([word])[0]
    assert model.score[alone].sum() == pytest.approx(model.score[whole].sum())


def test_bytes_that_spell_no_text_are_replaced(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentence_pieces.pieces(path)
    odd = [int(model.byte[b]) for b in (0xE2, 0x96)]
    blank = [int(model.byte[b]) for b in (0xE2, 0x96, 0x81)] + odd[:1]
    rows = [(1, odd), (2, None), (3, []), (4, blank), (5, [int(model.byte[65])])]
    frame = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    found = {r.doc_id: (r.text, r.n_ids) for r in sentence_pieces.decode(frame, path).collect()}
    assert found == {1: ("�", 2), 2: ("", 0), 3: ("", 0), 4: ("�", 4), 5: ("A", 1)}
