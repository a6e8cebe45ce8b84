"""Removal of long byte strings that occur more than once, by suffix arrays of shards.

A string of ``least`` bytes is led to its shard by the smallest hash among its ``GRAM``-byte pieces: equal strings
have equal smallest hashes. Hashes that occur once in all texts rule their strings out before anything is
moved. What is left goes to shards as segments, the stretches whose strings share a hash, and each shard sorts
the suffixes of its segments by external induced sorting; strings with a neighbour that shares ``least`` bytes
are repeated. A hash that many segments have is dealt to several shards by the segments' content, and the
classes of equal strings that those shards find, one row each, are then compared by a digest.

Equal texts are one text here, of which every string repeats if there are two.
"""

from __future__ import annotations

import hashlib
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodewright.llm.induced import Sorter
from lodewright.llm.tables import discard, documents, written

LEAST = 400
GRAM = 128
# Words that a passage of the pipeline is longer than, and the piece that leads its strings to shards.
WORDS = 50
WORDS_GRAM = 32
# Occurrences of a hash that one shard takes; more are dealt to several.
SHARE = 64
# Suffixes that a shard's sorting holds in memory.
MEMORY = 1 << 22
# Bytes of segments in a shard, on average, and those that a task passes on at once.
SHARD_BYTES = 3 << 20
PART_BYTES = 2 << 20
# Rows that a task passes on at once.
_ROWS = 20_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNDER = pow(int(_BASE), -1, 1 << 64)


def _powers(base: int, size: int) -> np.ndarray:
    """base ** 0 .. base ** (size - 1), modulo 2 ** 64."""
    out = np.ones(size, np.uint64)
    filled = 1
    while filled < size:
        step = np.uint64(pow(int(base), filled, 1 << 64))
        more = min(filled, size - filled)
        out[filled : filled + more] = out[:more] * step
        filled += more
    return out


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A hash of each run of ``gram`` bytes, the same wherever it stands."""
    with np.errstate(over="ignore"):
        n = len(data)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(data.astype(np.uint64) * _powers(_BASE, n))])
        x = (sums[gram:] - sums[:-gram]) * _powers(_UNDER, n - gram + 1)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(32))


def smallest_in(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return values if size == width else np.minimum(values[: len(values) - (width - size)], values[width - size :])


def runs(
    data: np.ndarray, least: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, hash, number) of the runs of strings, by where they begin, with one smallest hash;
    ``number`` is 2 if that hash occurs more than once in the run, else 1."""
    hashes, width = gram_hashes(data, gram), least - gram + 1
    routes = smallest_in(hashes, width)
    first = np.concatenate([[0], np.flatnonzero(routes[1:] != routes[:-1]) + 1])
    last = np.concatenate([first[1:], [len(routes)]])
    # A piece is the smallest of some string if no smallest hash of the strings around it is above its own.
    edge = np.zeros(width - 1, np.uint64)
    above = ~smallest_in(~np.concatenate([edge, routes, edge]), width)
    at = np.flatnonzero(above == hashes)
    known, value = np.unique(np.concatenate([hashes[at], routes[first]]), return_inverse=True)
    size = len(hashes) + 1
    places = np.sort(value[: len(at)] * size + at)
    of_run = value[len(at) :] * size
    low = np.searchsorted(places, of_run + first)
    high = np.searchsorted(places, of_run + np.minimum(last + width - 1, size - 1))
    return first, last, routes[first].view(np.int64), 1 + (high - low > 1)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.unhex(F.md5("text")).alias("key"), F.col("text").cast("binary").alias("data"))


def _marks(docs: DataFrame, least: int, gram: int) -> DataFrame:
    """(key, first, hash, number) of every run; ``number`` is 2 if the hash occurs in it more than once."""

    def rows(keys, firsts, hashes, numbers):
        return pa.RecordBatch.from_arrays(
            [
                pa.array(keys, pa.binary()),
                pa.array(np.concatenate(firsts)),
                pa.array(np.concatenate(hashes)),
                pa.array(np.concatenate(numbers)),
            ],
            ["key", "first", "hash", "number"],
        )

    def mark(batches):
        for batch in batches:
            held = [], [], [], []
            for key, data in zip(batch.column(0), batch.column(1)):
                data = np.frombuffer(data.as_buffer(), np.uint8)
                if len(data) < least:
                    continue
                first, _, value, number = runs(data, least, gram)
                for column, found in zip(held, ([key.as_py()] * len(first), [first], [value], [number])):
                    column.extend(found)
                if len(held[0]) >= _ROWS:
                    yield rows(*held)
                    held = [], [], [], []
            if held[0]:
                yield rows(*held)

    return _keyed(docs).mapInArrow(mark, "key binary, first long, hash long, number long")


_SEGMENTS = "hash long, part long, parts long, key binary, first long, data binary"


def _segments(texts: DataFrame, least: int, gram: int) -> DataFrame:
    """The segments of texts (key, data, copies, places): ``places`` lists (first, total) of runs whose hash
    occurs ``total`` times in all. Runs whose hash occurs in copies of the text only aren't needed."""

    def cut(batches):
        for batch in batches:
            rows = {name: [] for name in ("hash", "part", "parts", "key", "first", "data")}
            size = 0
            for key, data, copies, places in zip(*(batch.column(i) for i in range(4))):
                raw = np.frombuffer(data.as_buffer(), np.uint8)
                key, copies = key.as_py(), copies.as_py()
                first, last, value, number = runs(raw, least, gram)
                wanted = {place["first"]: place["total"] for place in places.as_py()}
                own: dict[int, int] = {}
                for h, n in zip(value.tolist(), number.tolist()):
                    own[h] = own.get(h, 0) + n
                for a, b, h in zip(first.tolist(), last.tolist(), value.tolist()):
                    total = wanted.get(a)
                    if total is None or (total <= copies * own[h] and own[h] == 1):
                        continue
                    part = raw[a : b + least - 1].tobytes()
                    parts = -(-total // SHARE)
                    rows["hash"].append(h)
                    rows["part"].append(int.from_bytes(hashlib.md5(part).digest()[:4]) % parts)
                    rows["parts"].append(parts)
                    rows["key"].append(key)
                    rows["first"].append(a)
                    rows["data"].append(part)
                    size += len(part)
                    if size > PART_BYTES:
                        yield pa.RecordBatch.from_pydict(rows, schema=_SEGMENT_SCHEMA)
                        rows, size = {name: [] for name in rows}, 0
            yield pa.RecordBatch.from_pydict(rows, schema=_SEGMENT_SCHEMA)

    return texts.mapInArrow(cut, _SEGMENTS)


_SEGMENT_SCHEMA = pa.schema(
    [
        (name, {"long": pa.int64(), "binary": pa.binary()}[kind])
        for name, kind in (column.split() for column in _SEGMENTS.split(", "))
    ]
)
_FOUND = "key binary, begin long, size long, digest binary, single boolean"


def repeated(text: np.ndarray, valid: np.ndarray, least: int, memory: int, folder: str):
    """Blocks of (places, class number, whether the class has several) of the valid suffixes, class by class.

    A class is the suffixes that share ``least`` symbols. ``text`` has symbols up to 256.
    """
    number, open_places, carried = -1, [], False
    for places, shared in Sorter(text, 257, least, memory, folder).suffixes():
        same = shared >= least
        ok = valid[places]
        # Suffixes that aren't valid never share `least` symbols with valid ones.
        places, same = places[ok], same[ok]
        if not len(places):
            continue
        classes = number + np.cumsum(~same)
        yield places, classes, same
        number = int(classes[-1])


def _search(least: int, memory: int):
    """Strings that repeat in a shard, as byte ranges of the texts; and, for segments whose hash is dealt to
    several shards, a digest of each class, with the place of a string that is alone in its class here."""

    def search(batches):
        with tempfile.TemporaryDirectory() as folder:
            keys, firsts, owners, dealt, starts, number = [], [], [], [], [0], []
            known: dict[bytes, int] = {}
            with open(f"{folder}/text", "wb") as out:
                for batch in batches:
                    for _, _, parts, key, first, data in zip(*batch.columns):
                        data = data.as_buffer()
                        digest = hashlib.md5(data).digest()
                        segment = known.setdefault(digest, len(known))
                        if segment == len(number):
                            symbols = np.frombuffer(data, np.uint8).astype(np.uint16) + 1
                            out.write(symbols.tobytes() + b"\0\0")
                            starts.append(starts[-1] + len(symbols) + 1)
                            number.append(0)
                            dealt.append(parts.as_py() > 1)
                        number[segment] += 1
                        keys.append(key.as_py())
                        firsts.append(first.as_py())
                        owners.append(segment)
            known.clear()
            if not owners:
                return
            text = np.memmap(f"{folder}/text", np.uint16, "r")
            begins = np.array(starts[:-1], np.int64)
            ends = np.array(starts[1:], np.int64) - 1
            number, dealt = np.array(number), np.array(dealt)
            valid = np.memmap(f"{folder}/valid", bool, "w+", shape=(len(text),))
            hit = np.memmap(f"{folder}/hit", bool, "w+", shape=(len(text),))
            for begin, end in zip(begins.tolist(), ends.tolist()):
                valid[begin : end - least + 1] = True

            # Members of each segment: rows of (key, first) in order of the segment.
            order = np.argsort(owners, kind="stable")
            member = np.searchsorted(np.array(owners)[order], np.arange(len(begins) + 1))

            def found(rows):
                return pa.RecordBatch.from_pylist(rows, schema=_FOUND_SCHEMA)

            def classed(places, several):
                """Rows of the digests of a block's classes; ``places`` has one suffix of each."""
                segment = np.searchsorted(begins, places, side="right") - 1
                for at, owner, many in zip(places.tolist(), segment.tolist(), several.tolist()):
                    if dealt[owner]:
                        digest = hashlib.md5((text[at : at + least] - 1).astype(np.uint8).tobytes()).digest()
                        row = order[member[owner]]
                        yield {
                            "key": None if many else keys[row],
                            "begin": None if many else firsts[row] + at - int(begins[owner]),
                            "size": least,
                            "digest": digest,
                            "single": not many,
                        }

            rows, last = [], None
            for places, classes, _ in repeated(text, valid, least, memory, folder):
                if last is not None:
                    # The class that the block before ended with may go on.
                    places = np.concatenate([last[0], places])
                    classes = np.concatenate([last[1], classes])
                head = np.concatenate([[True], classes[1:] != classes[:-1]])
                begin = np.flatnonzero(head)
                count = np.diff(np.append(begin, len(classes)))
                owner = np.searchsorted(begins, places, side="right") - 1
                several = np.repeat(count > 1, count) | (number[owner] > 1)
                several |= np.repeat(np.maximum.reduceat(several, begin), count)
                hit[places[several]] = True
                # Keep up to two of the last class, as one alone may find its like in the next block.
                tail = begin[-1]
                last = places[tail : tail + 2], classes[tail : tail + 2]
                done = begin[:-1]
                for row in classed(places[done], several[done]):
                    rows.append(row)
                    if len(rows) >= _ROWS:
                        yield found(rows)
                        rows = []
            if last is not None:
                owner = np.searchsorted(begins, last[0], side="right") - 1
                several = (len(last[0]) > 1) | (number[owner[:1]] > 1)
                hit[last[0][np.broadcast_to(several, len(last[0]))]] = True
                rows += classed(last[0][:1], several)

            for segment, (begin, end) in enumerate(zip(begins.tolist(), ends.tolist())):
                flags = np.concatenate([[False], hit[begin : end - least + 1], [False]])
                edges = np.flatnonzero(flags[1:] != flags[:-1])
                for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
                    for row in order[member[segment] : member[segment + 1]].tolist():
                        rows.append(
                            {"key": keys[row], "begin": firsts[row] + a, "size": b - a + least - 1, "digest": None, "single": None}
                        )
                if len(rows) >= _ROWS:
                    yield found(rows)
                    rows = []
            if rows:
                yield found(rows)

    return search


_FOUND_SCHEMA = pa.schema(
    [
        (name, {"long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}[kind])
        for name, kind in (column.split() for column in _FOUND.split(", "))
    ]
)


def spans(docs: DataFrame, least: int = LEAST, gram: int = GRAM, memory: int = MEMORY) -> DataFrame:
    """(key, begin, size) of byte ranges to remove, which may overlap; ``key`` is the md5 of the text."""
    marks = written(_marks(docs, least, gram), "marks")
    often = marks.groupBy("hash").agg(F.sum("number").alias("total")).where("total > 1")
    places = (
        marks.join(often, "hash")
        .groupBy("key")
        .agg(F.collect_set(F.struct("first", "total")).alias("places"))
    )
    places = written(places, "places")
    number = places.agg(F.sum(F.size("places"))).first()[0] or 0
    # A run has half as many strings as pieces fit beside each other, and its segment their bytes.
    shards = max(1, number * (least + (least - gram) // 2) // SHARD_BYTES)
    chosen = _texts(docs).join(places, "key").select("key", "data", "copies", "places")
    segments = _segments(chosen, least, gram)
    found = written(
        segments.repartition(shards, "hash", "part").mapInArrow(_search(least, memory), _FOUND), "repeats"
    )
    discard(marks, places)
    # Strings alone in their shard that another shard of the same hash has too.
    classes = found.where("digest is not null")
    shared = classes.groupBy("digest").agg(F.count("*").alias("shards")).where("shards > 1").select("digest")
    apart = classes.where("single").join(shared, "digest").select("key", "begin", "size")
    return found.where("digest is null").select("key", "begin", "size").unionAll(apart)


_RESULT = "key binary, n_bytes long, n_removed long, spans array<struct<begin:long,size:long>>, kept binary"


def _merged(ranges) -> list[list[int]]:
    """[begin, end] of ranges that touch or overlap, as one each."""
    merged: list[list[int]] = []
    for begin, size in sorted((r["begin"], r["size"]) for r in ranges):
        if merged and begin <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], begin + size)
        else:
            merged.append([begin, begin + size])
    return merged


def _cut(batches):
    for batch in batches:
        for key, data, ranges in zip(*(batch.column(i) for i in range(3))):
            raw = data.as_py()
            merged = _merged(ranges.as_py())
            kept, at = [], 0
            for begin, end in merged:
                kept.append(raw[at:begin])
                at = end
            kept.append(raw[at:])
            yield pa.RecordBatch.from_pydict(
                {
                    "key": [key.as_py()],
                    "n_bytes": [len(raw)],
                    "n_removed": [sum(end - begin for begin, end in merged)],
                    "spans": pa.array(
                        [[{"begin": a, "size": b - a} for a, b in merged]],
                        pa.list_(pa.struct([("begin", pa.int64()), ("size", pa.int64())])),
                    ),
                    "kept": pa.array([b"".join(kept)], pa.binary()),
                }
            )


_NO_RANGES = "array<struct<begin:bigint,size:bigint>>"


def _whole(least: int):
    """The range of a whole text that has copies, if it has so many bytes."""
    return F.when(
        (F.col("copies") > 1) & (F.length("data") >= least),
        F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.length("data").cast("long").alias("size"))),
    ).otherwise(F.array().cast(_NO_RANGES))


def _lossy(texts: DataFrame, found: DataFrame, least: int) -> DataFrame:
    """(key, data, ranges, copies) of the texts (key, data, copies) that ``found`` has ranges of, or that repeat."""
    own = found.groupBy("key").agg(F.collect_list(F.struct("begin", "size")).alias("ranges"))
    ranges = F.concat(F.coalesce("ranges", F.array().cast(_NO_RANGES)), _whole(least))
    lossy = texts.join(own, "key", "left").select("key", "data", ranges.alias("ranges"), "copies")
    return lossy.where(F.size("ranges") > 0)


def _texts(docs: DataFrame) -> DataFrame:
    return _keyed(docs).groupBy("key").agg(F.first("data").alias("data"), F.count("*").alias("copies"))


def remove(docs: DataFrame, least: int = LEAST, gram: int = GRAM, memory: int = MEMORY) -> DataFrame:
    """(key, n_bytes, n_removed, spans, kept) of each text that loses bytes; ``key`` is the md5 of the text.

    ``docs`` has (doc_id, text). Bytes of the UTF-8 text go if a string of ``least`` bytes that covers them
    begins anywhere else too, in the same text or another; strings don't cross texts, may overlap, and are judged
    on the input. Shorter and empty texts lose nothing; an empty table gives no rows.
    """
    lossy = _lossy(_texts(docs), spans(docs, least, gram, memory), least)
    return lossy.drop("copies").mapInArrow(_cut, _RESULT)


_BLANK = np.isin(np.arange(256), [*range(9, 14), 32])
# Marks at the ends of a passage aren't part of it: all ASCII that are neither letters, digits nor blanks.
_MARK = np.array([c < 128 and not chr(c).isalnum() for c in range(256)]) & ~_BLANK


def word_places(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word begins and ends, without the marks around it unless it has nothing else."""
    blank = np.concatenate([[True], _BLANK[data], [True]])
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    first, last = edges[::2], edges[1::2]
    solid = np.flatnonzero(~_BLANK[data] & ~_MARK[data])
    if not len(solid):
        return first, last
    after = np.searchsorted(solid, first)
    before = np.searchsorted(solid, last) - 1
    real = before >= after
    begin = np.where(real, solid[np.minimum(after, len(solid) - 1)], first)
    return begin, np.where(real, solid[before] + 1, last)


_WINDOWS = "digest binary, key binary, begin long, size long, copies long"


def _windows(words: int):
    """Each string of ``words`` + 1 words inside the ranges of the texts."""

    def cut(batches):
        for batch in batches:
            for key, data, ranges, copies in zip(*(batch.column(i) for i in range(4))):
                raw = data.as_py()
                begins, ends = word_places(np.frombuffer(raw, np.uint8))
                found: list[tuple[int, int]] = []
                for a, b in _merged(ranges.as_py()):
                    first, last = int(np.searchsorted(begins, a)), int(np.searchsorted(ends, b, side="right"))
                    if last - first > words:
                        found += zip(begins[first : last - words].tolist(), ends[first + words : last].tolist())
                for low in range(0, len(found), _ROWS):
                    part = found[low : low + _ROWS]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([hashlib.md5(raw[a:b]).digest() for a, b in part], pa.binary()),
                            pa.array([key.as_py()] * len(part), pa.binary()),
                            pa.array([a for a, _ in part], pa.int64()),
                            pa.array([b - a for a, b in part], pa.int64()),
                            pa.array([copies.as_py()] * len(part), pa.int64()),
                        ],
                        ["digest", "key", "begin", "size", "copies"],
                    )

    return cut


def _long(least: int):
    """Texts (text) with a stretch of ``least`` bytes inside their ranges."""

    def keep(batches):
        for batch in batches:
            ranges = batch.column(1).to_pylist()
            real = [any(b - a >= least for a, b in _merged(r)) for r in ranges]
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(real, pa.bool_()))], ["data"])

    return keep


def remove_passages(docs: DataFrame, words: int = WORDS, least: int = LEAST, memory: int = MEMORY) -> DataFrame:
    """Like ``remove``, of passages that repeat: strings of more than ``words`` whole words, and for writing with
    few blanks those of ``least`` bytes."""
    return _lossy_passages(docs, words, least, memory).mapInArrow(_cut, _RESULT)


def _lossy_passages(docs: DataFrame, words: int, least: int, memory: int) -> DataFrame:
    """(key, data, ranges) of the texts that lose passages.

    More than ``words`` words have 2 * ``words`` + 1 bytes at least, a letter each and the blanks between them.
    Strings of so many bytes that repeat are found first, of any text. In the stretches they cover each string of
    ``words`` + 1 words is then compared as a whole, so that shorter repeats beside each other don't count as one.
    """
    shortest = 2 * words + 1
    gram = min(WORDS_GRAM, -(-shortest // 3))
    near = written(_lossy(_texts(docs), spans(docs, shortest, gram, memory), shortest), "near")
    windows = written(near.mapInArrow(_windows(words), _WINDOWS), "windows")
    often = windows.groupBy("digest").agg(F.sum("copies").alias("total")).where("total > 1")
    worded = written(windows.join(often, "digest", "left_semi").select("key", "begin", "size"), "worded")
    discard(windows)
    # A repeated string of `least` bytes is in such a stretch in each text that has it. Written, as what the search
    # runs in Python on these rows would else keep a second process a core beside this one.
    stretched = written(near.select("data", "ranges").mapInArrow(_long(least), "data binary"), "stretched")
    texts = stretched.select(F.lit(0).alias("doc_id"), F.col("data").cast("string").alias("text"))
    found = worded.unionAll(spans(texts, least, GRAM, memory))
    discard(stretched)
    lossy = _lossy(near.select("key", "data", "copies"), found, least)
    return lossy.drop("copies")


def passages_cut(docs: DataFrame, words: int = WORDS, least: int = LEAST, memory: int = MEMORY) -> DataFrame:
    """(key, kept) of ``remove_passages``'s rows as texts, without the bytes of characters that are cut apart."""

    def decode(batches):
        for batch in _cut(batches):
            texts = [data.decode("utf-8", "ignore") for data in batch.column("kept").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(texts, pa.string())], ["key", "kept"])

    return _lossy_passages(docs, words, least, memory).mapInArrow(decode, "key binary, kept string")


def deduplicated(frame: DataFrame, least: int = LEAST, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row; see ``remove``.

    A null text is empty. Repeated rows are texts that repeat each other. Other columns aren't looked at.
    """
    docs = documents(frame, text, key)
    lost = remove(docs, least).select(
        "key",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
    lost = written(lost, "lossy")
    own = docs.select(
        "doc_id",
        F.unhex(F.md5("text")).alias("key"),
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.sha2(F.col("text").cast("binary"), 256).alias("whole"),
    )
    return own.join(lost, "key", "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
    )
