"""N-gram Jaccard join: which texts share at least a given share of their word n-grams.

Equal sets are one class. Each class keeps its n-grams in one order for all: rare before frequent, then by hash,
so two sets that are alike share one of their first n-grams, and frequent passages don't bring unlike sets
together. Classes that share a first n-gram are candidates if sizes, places and a parity bitmap of the sets
allow a link; all three only rule out what can't be one. Candidates are decided exactly: those of one class
are stored as a prefix tree, sorted sequences of which each shares the overlap counted so far with the one
before, and subtrees whose remaining lengths can't reach the link are passed over.

Only connectivity is wanted, so no pair inside a component that is known already is looked at. Rounds compare each
class with one hub for each of its first n-grams, so candidates are no more than these: the first round's hub is one
class of the n-gram, later ones' is one of those with the same byte of the bitmap, another byte each time, which
sets that are alike tend to share and others don't. After that all pairs that are still in different components
are compared, each at the first n-gram that they share or soon after it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodewright.llm.tables import discard, documents, slices, written

WORDS = 3
# A link: shared n-grams are at least PERCENT of 100 of those of either.
PERCENT = 90
# Longs of the parity bitmap.
BITS = 8
# An n-gram counts as frequent if it is among the first of more texts than this, and of more than one of
# 2 ** FEW of all first n-grams; so there are at most 2 ** FEW frequent ones.
SHARED = 64
FEW = 17
# Classes of an n-gram that meet in one task at once, and n-grams of sets that a task compares with one set at once.
BLOCK = 256
BLOCK_GRAMS = 1 << 20
# Rounds of hubs by a byte, at most; they end before if one brings less than one of FEW_LINKS of all links.
ROUNDS = 2
FEW_LINKS = 64
SLICE = 2 << 20
# Sets whose bitmaps are made at once.
MAPPED = 1024
PLACE_BITS = 12
CLASS_BITS = 63 - PLACE_BITS
LAST_PLACE = (1 << PLACE_BITS) - 1
# First n-grams before one that a row of the last comparison carries along.
BEFORE = 8
FILTER_BITS = 1 << 24
WIDE_BITS = 1 << 13

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def shingle_sets(texts: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """For each text the sorted 64-bit hashes of its distinct n-grams; all words as one if there are fewer."""
    split = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(texts)))
    ends = split.offsets.to_numpy()
    coded = split.flatten().dictionary_encode()
    known = [xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) for w in coded.dictionary.to_pylist()]
    each = np.array(known, np.uint64)[coded.indices.to_numpy()]
    runs = np.zeros(len(each), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(words):
            runs[: len(each) - i] = _mixed(runs[: len(each) - i] * _ODD + each[i:])
    out = []
    for first, last, text in zip(ends[:-1].tolist(), ends[1:].tolist(), texts):
        if last - first == 1 and len(text.as_py().strip(" \t\n\x0b\x0c\r")) == 0:
            out.append(np.zeros(0, np.uint64))
        elif last - first < words:
            whole = np.uint64(last - first)
            with np.errstate(over="ignore"):
                for value in each[first:last]:
                    whole = _mixed(whole * _ODD + value + np.uint64(1))
            out.append(np.array([whole], np.uint64))
        else:
            out.append(np.unique(runs[first : last - words + 1]))
    return out


def _prefix_size(size: int, percent: int) -> int:
    """How many first n-grams a set needs so that all sets alike share one of them."""
    return size - -(-percent * size // 100) + 1


def ordered(hashes: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    if not len(frequent):
        return hashes
    at = np.searchsorted(frequent, hashes)
    late = frequent[np.minimum(at, len(frequent) - 1)] == hashes
    return np.concatenate([hashes[~late], hashes[late]])


def _signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.view(np.int64))


def _first_counts(docs: DataFrame, words: int, percent: int) -> DataFrame:
    def count(batches):
        for batch in slices(batches, 0, SLICE):
            sets = shingle_sets(batch.column(0), words)
            firsts = [s[: _prefix_size(len(s), percent)] for s in sets if len(s)]
            if firsts:
                token, number = np.unique(np.concatenate(firsts), return_counts=True)
                yield pa.RecordBatch.from_arrays([_signed(token), pa.array(number)], ["token", "n"])

    return docs.select("text").mapInArrow(count, "token long, n long")


def _frequent(docs: DataFrame, words: int, percent: int) -> np.ndarray:
    """The frequent n-grams; at most 2 ** FEW of them."""
    counts = written(
        _first_counts(docs, words, percent).groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") > SHARED),
        "first-grams",
    )
    total = counts.agg(F.sum("n")).first()[0] or 0
    rows = counts.where(F.col("n") > total >> FEW).select("token").toArrow()
    return np.sort(rows.column(0).to_numpy().view(np.uint64))


def _bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """For each set the parities of its n-grams, dealt to 64 * BITS places."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    flat = np.concatenate(sets)
    place = owner * (64 * BITS) + (flat % np.uint64(64 * BITS)).astype(np.int64)
    parity = np.bincount(place, minlength=len(sets) * 64 * BITS) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").view(np.int64).reshape(-1, BITS)


def _described(docs: DataFrame, frequent: np.ndarray, words: int, percent: int) -> DataFrame:
    """Each document with its set's size, digest, first n-grams in the common order, and parity bitmap."""

    def describe(batches):
        for batch in slices(batches, 2, SLICE):
            sets = shingle_sets(batch.column(2), words)
            sizes = np.array([len(s) for s in sets])
            firsts = [ordered(s, frequent)[: _prefix_size(len(s), percent)] if len(s) else s for s in sets]
            keys = [hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets]
            packed = np.concatenate([_bitmaps(sets[i : i + MAPPED]) for i in range(0, len(sets), MAPPED)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(sizes),
                    pa.array(keys, pa.binary()),
                    pa.ListArray.from_arrays(
                        np.concatenate([[0], np.cumsum([len(f) for f in firsts])]).astype(np.int32),
                        _signed(np.concatenate(firsts)),
                    ),
                    *(pa.array(np.ascontiguousarray(packed[:, i])) for i in range(BITS)),
                ],
                ["doc_id", "text_key", "n", "set_key", "firsts", *_BIT_NAMES],
            )

    keyed = docs.select("doc_id", F.unhex(F.md5("text")).alias("text_key"), "text")
    bits = ", ".join(f"{name} long" for name in _BIT_NAMES)
    return keyed.mapInArrow(
        describe, f"doc_id long, text_key binary, n long, set_key binary, firsts array<long>, {bits}"
    )


_BIT_NAMES = [f"b{i}" for i in range(BITS)]


def _slack(a: Column, b: Column, percent: int) -> Column:
    """How many n-grams at most only one of two linked sets of these sizes has."""
    return (a + b) * (100 - percent) / (100 + percent)


def _parity(a: str, b: str) -> Column:
    """How many n-grams at least only one of two sets has."""
    count = F.bit_count(F.col(f"{a}.b0").bitwiseXOR(F.col(f"{b}.b0")))
    for name in _BIT_NAMES[1:]:
        count = count + F.bit_count(F.col(f"{a}.{name}").bitwiseXOR(F.col(f"{b}.{name}")))
    return count


def tree_links(
    probe: np.ndarray, sets: list[np.ndarray], percent: int, rank
) -> list[int]:
    """Which of the sets are linked with the probe. ``rank`` gives a set's n-grams in the common order.

    The sets, sorted as sequences, are the leaves of a prefix tree in its own order. ``shared[d]`` is how
    many of the first d n-grams of the current path the probe has; a set takes over what its path has in
    common with the set before. At depth d the n-grams without partner are known, so a path that has more than
    its lengths allow is left, and with it the whole subtree below.
    """
    sequences = [rank(s) for s in sets]
    order = sorted(range(len(sets)), key=lambda i: sequences[i].astype(">u8").tobytes())
    found, path, shared, dead = [], np.zeros(0, np.uint64), np.zeros(1, np.int64), None
    for i in order:
        sequence = sequences[i]
        least = min(len(path), len(sequence))
        differ = np.flatnonzero(path[:least] != sequence[:least])
        common = int(differ[0]) if len(differ) else least
        if dead is not None and common >= dead[0] and dead[1](len(sequence)):
            continue
        rest = sequence[common:]
        at = np.minimum(np.searchsorted(probe, rest), len(probe) - 1)
        shared = np.concatenate(
            [shared[: common + 1], shared[common] + np.cumsum(probe[at] == rest)]
        )
        path = sequence
        # Missing so far on this path; a link of n and m n-grams allows (n + m - shared) * percent <= 100 * shared.
        missing = np.arange(len(sequence) + 1) - shared
        over = np.flatnonzero(
            100 * (len(sequence) - missing) < percent * (len(probe) + missing)
        )
        if len(over):
            depth, lost = int(over[0]), int(missing[over[0]])

            def hopeless(size: int, lost: int = lost) -> bool:
                return 100 * (size - lost) < percent * (len(probe) + lost)

            dead = (depth, hopeless)
            continue
        dead = None
        both = int(shared[-1])
        if 100 * both >= percent * (len(sequence) + len(probe) - both):
            found.append(i)
    return found


def _decided(pairs: DataFrame, sets: DataFrame, frequent: np.ndarray, percent: int) -> DataFrame:
    """The pairs (a, b) that are linked. About BLOCK partners of a class b, or BLOCK_GRAMS n-grams of partners, meet in a
    task at once; a larger set is alone."""
    parts = pairs.groupBy("b").agg(  # also splits a hot hub
        F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n_a") / BLOCK_GRAMS)).alias("parts")
    )
    stored = (
        pairs.join(parts, "b")
        .select("b", F.pmod(F.xxhash64("a"), F.col("parts")).alias("part"), F.col("a").alias("cid"))
        .join(sets, "cid")
        .select("b", "part", F.col("cid").alias("a"), "grams")
    )
    probes = (
        parts.select(F.col("b"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        .join(sets.withColumnRenamed("cid", "b"), "b")
        .select("b", "part", F.lit(None).cast("long").alias("a"), "grams")
    )

    def decide(batches):
        key, probe, names, held = None, None, [], []

        def links():
            rank = lambda s: ordered(s, frequent)
            hit = tree_links(probe, held, percent, rank) if held and probe is not None else []
            return pa.RecordBatch.from_pydict(
                {"a": pa.array([names[i] for i in hit], pa.int64()), "b": pa.array([key[0]] * len(hit), pa.int64())}
            )

        for batch in batches:
            for b, part, a, grams in zip(*(column.to_pylist() for column in batch.columns)):
                if key != (b, part):
                    if key is not None:
                        yield links()
                    key, probe, names, held = (b, part), None, [], []
                values = np.frombuffer(grams, np.uint64)
                if a is None:
                    probe = values
                else:
                    names.append(a)
                    held.append(values)
        if key is not None:
            yield links()

    both = stored.unionAll(probes).repartition("b", "part").sortWithinPartitions("b", "part")
    return both.mapInArrow(decide, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(cid, component) of every end of a link (a, b): the smallest number it is connected with."""
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(both.distinct(), "links")
    labels = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("component"))
                     .withColumnRenamed("a", "cid"), "labels")
    while True:
        near = (
            both.join(labels.withColumnRenamed("cid", "b"), "b")
            .groupBy(F.col("a").alias("cid"))
            .agg(F.min("component").alias("near"))
        )
        lower = labels.join(near, "cid").select("cid", "component", F.least("component", "near").alias("low"))
        # A component's own label is one of its members; take over what that member found.
        up = lower.select(F.col("cid").alias("low"), F.col("low").alias("lowest"))
        moved = lower.join(up, "low").select(
            "cid", F.least("low", "lowest").alias("component"), (F.least("low", "lowest") < F.col("component")).alias("moved")
        )
        moved = written(moved, "labels")
        labels = moved.select("cid", "component")
        if not moved.where("moved").limit(1).count():
            return labels


def join(
    frame: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: links are taken transitively.

    Words are what ASCII white space parts, A-Z in lower case. A text with fewer words than an n-gram has one
    n-gram, all its words; a null text, or one without words, has none and is its own component. Two texts
    link if they share at least ``percent`` of 100 of the n-grams of either. The component's id is the
    smallest id in it (null only if all are null; a null id without link stays null). Repeated rows are equal
    texts. An empty table gives no rows; other columns are not looked at.
    """
    docs = documents(frame, text, key)
    frequent = _frequent(docs, words, percent)
    described = written(_described(docs, frequent, words, percent), "described")
    classes = (
        described.where("set_key is not null")
        .groupBy("set_key")
        .agg(F.min("text_key").alias("text_key"), *(F.first(c).alias(c) for c in ("n", "firsts", *_BIT_NAMES)))
    )
    classes = written(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    members = written(described.select("doc_id", "n", "set_key"), "members")
    discard(described)

    # The place is kept in the number's high bits, at most LAST_PLACE: a smaller place rules out less.
    place = F.least(F.col("place"), F.lit(LAST_PLACE)).cast("long")
    sample = F.concat(*(F.substring(F.lpad(F.hex(name), 16, "0"), 15, 2) for name in _BIT_NAMES))
    sample = F.conv(sample, 16, -10).cast("long")
    grams = classes.select("cid", "n", sample.alias("sample"), F.posexplode("firsts").alias("place", "token")).select(
        "token", "n", "sample", F.shiftleft(place, CLASS_BITS).bitwiseOR(F.col("cid")).alias("code")
    )
    common = (
        grams.groupBy("token").agg(F.count("*").alias("number"), F.min("code").alias("hub")).where("number > 1")
    )
    rows = written(grams.join(common.select("token", "hub"), "token").select("token", "n", "sample", *_coded("code"), "hub"), "grams")
    bits = classes.select("cid", "n", *_BIT_NAMES)

    met = rows.select("cid", "n", "place", *_coded("hub", "hub", "hub_place"))
    links = _linked(docs, classes, _hub_pairs(met, bits, percent), frequent, words, percent)
    known = components(links)
    for number in range(ROUNDS):
        kept = rows.drop("hub").join(known, "cid", "left").withColumn(
            "byte", F.shiftright("sample", 8 * number).bitwiseAND(F.lit(255))
        )
        code = F.shiftleft("place", CLASS_BITS).bitwiseOR(F.col("cid"))
        hubs = kept.groupBy("token", "byte").agg(
            F.min(F.struct(code.alias("hub"), F.coalesce("component", "cid").alias("of"))).alias("hub"),
            F.count("*").alias("number"),
        )
        others = kept.join(hubs.where("number > 1").select("token", "byte", "hub.*"), ["token", "byte"])
        others = others.where(F.coalesce("component", "cid") != F.col("of"))
        others = others.select("cid", "n", "place", *_coded("hub", "hub", "hub_place"))
        more = _linked(docs, classes, _hub_pairs(others, bits, percent), frequent, words, percent)
        new = more.count()
        if not new:
            break
        links = written(links.unionAll(more), "links")
        known = components(links)
        if new * FEW_LINKS < links.count():
            break

    # All pairs of n-grams whose classes are in several components still.
    placed, spread = _components_of(rows, known)
    open_rows = placed.drop("n").join(spread, "token").join(classes.select("cid", "n", *_BIT_NAMES, "firsts"), "cid")
    open_rows = open_rows.withColumn("before", _before()).drop("firsts")
    in_main = F.col("component") == F.col("main")
    part = F.pmod(F.xxhash64("cid"), F.when(in_main, F.col("main_parts")).otherwise(F.col("other_parts")))
    open_rows = written(open_rows.withColumn("in_main", in_main).withColumn("part", part), "open")
    discard(rows)
    kept = ["token", "cid", "n", "place", "component", "before", *_BIT_NAMES]
    # Every block of other classes meets each block of the main component and each block of others once.
    others = open_rows.where("not in_main")
    left = others.select(*kept, F.col("part").alias("i"), F.explode(
        F.concat(
            F.transform(F.sequence(F.lit(0), F.col("main_parts") - 1), lambda j: -1 - j),
            F.sequence(F.col("part"), F.col("other_parts") - 1),
        )
    ).alias("j"))
    right = open_rows.where("in_main").select(
        *kept, F.explode(F.sequence(F.lit(0), F.col("other_parts") - 1)).alias("i"), (-1 - F.col("part")).alias("j")
    ).unionAll(
        others.select(*kept, F.explode(F.sequence(F.lit(0), F.col("part"))).alias("i"), F.col("part").alias("j"))
    )
    x, y = left.alias("x"), right.alias("y")
    slack = _slack(F.col("x.n"), F.col("y.n"), percent)
    met = x.join(
        y,
        (F.col("x.token") == F.col("y.token"))
        & (F.col("x.i") == F.col("y.i"))
        & (F.col("x.j") == F.col("y.j"))
        & (F.col("x.component") != F.col("y.component"))
        & (F.abs(F.col("x.n") - F.col("y.n")) <= slack)
        & (F.col("x.place") + F.col("y.place") <= slack)
        & (_parity("x", "y") <= slack)
        & ~F.arrays_overlap("x.before", "y.before"),  # they met at that n-gram
    )
    second = met.select(
        F.greatest("x.cid", "y.cid").alias("a"), F.least("x.cid", "y.cid").alias("b")
    ).distinct()
    more = _linked(docs, classes, second, frequent, words, percent)
    discard(open_rows)
    final = components(links.unionAll(more))

    by_class = classes.select("cid", "set_key").join(final, "cid", "left")
    by_class = by_class.select("set_key", F.coalesce("component", "cid").alias("component"))
    placed_docs = members.join(by_class, "set_key", "left")
    smallest = placed_docs.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("smallest"))
    joined = placed_docs.join(smallest, "component", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("smallest")).alias("component_id"),
    )
    joined = written(joined, "joined")
    discard(members, classes)
    return joined


def _before() -> Column:
    """Up to BEFORE of the first n-grams before a row's, in the order of all sets.

    A pair that shares one of them shares an earlier n-gram, and so meets there or earlier still; none is lost, as
    nothing is before the first n-gram that both share. Places that the row doesn't know exactly have nothing before.
    """
    place = F.when(F.col("place") < LAST_PLACE, F.col("place")).otherwise(F.lit(0)).cast("int")
    return F.slice("firsts", F.greatest(place - BEFORE, F.lit(0)) + 1, F.least(place, F.lit(BEFORE)))


def _coded(code: str, cid: str = "cid", place: str = "place") -> tuple[Column, Column]:
    """The class and the place that are one number. The least one has the first place: most others may link with it."""
    number = F.col(code).bitwiseAND(F.lit((1 << CLASS_BITS) - 1))
    return number.alias(cid), F.shiftright(code, CLASS_BITS).alias(place)


def _hub_pairs(rows: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes and hubs of their first n-grams, if places, sizes and bitmaps allow a link.

    Of rows (cid, n, place, hub, hub_place). A set that links with one of n n-grams has at most 100 n / percent.
    """
    near = F.col("place") + F.col("hub_place") <= F.col("n") * (100 - percent) / percent
    pairs = rows.where((F.col("cid") != F.col("hub")) & near).select("cid", "hub").distinct()
    x, y = bits.alias("x"), bits.withColumnRenamed("cid", "hub").alias("y")
    slack = _slack(F.col("x.n"), F.col("y.n"), percent)
    return (
        pairs.join(x, "cid")
        .join(y, "hub")
        .where((F.abs(F.col("x.n") - F.col("y.n")) <= slack) & (_parity("x", "y") <= slack))
        .select(F.col("cid").alias("a"), F.col("hub").alias("b"))
    )


def _components_of(rows: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows with their classes' components, and the n-grams whose classes are in several: with the component
    that most are in, and the blocks that it and the others make."""
    placed = rows.select("token", "cid", "n", "place").join(known, "cid", "left")
    placed = placed.withColumn("component", F.coalesce("component", "cid"))
    spread = (
        placed.groupBy("token", "component")
        .agg(F.count("*").alias("number"))
        .groupBy("token")
        .agg(
            F.max_by("component", F.struct("number", "component")).alias("main"),
            F.max("number").alias("most"),
            F.sum("number").alias("number"),
            F.count("*").alias("components"),
        )
        .where("components > 1")
        .select(
            "token",
            "main",
            F.ceil(F.col("most") / BLOCK).alias("main_parts"),
            F.ceil((F.col("number") - F.col("most")) / BLOCK).alias("other_parts"),
        )
    )
    return placed, spread


def _linked(
    docs: DataFrame, classes: DataFrame, pairs: DataFrame, frequent: np.ndarray, words: int, percent: int
) -> DataFrame:
    """The pairs that are linked, written."""
    pairs = written(pairs, "pairs")
    ends = pairs.select(F.col("a").alias("cid")).unionAll(pairs.select(F.col("b").alias("cid"))).distinct()
    wanted = written(ends.join(classes.select("cid", "text_key"), "cid"), "wanted")
    sets = written(_sets(docs, wanted, words), "grams-of")
    near = written(_near(pairs, sets, percent), "near-pairs")
    links = written(_decided(near, sets, frequent, percent), "links")
    discard(pairs, wanted, sets, near)
    return links


def _near(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that parity bitmaps of WIDE_BITS bits don't rule out; sets themselves move for these only."""

    def describe(batches):
        for batch in batches:
            sizes, packed = [], []
            for grams in batch.column(1):
                grams = np.frombuffer(grams.as_buffer(), np.uint64)
                parity = np.bincount((grams % np.uint64(WIDE_BITS)).astype(np.int64), minlength=WIDE_BITS) & 1
                sizes.append(len(grams))
                packed.append(np.packbits(parity.astype(np.uint8)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())], ["cid", "n", "bits"]
            )

    def passed(batches):
        for batch in batches:
            one, two = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, WIDE_BITS // 8)
                for i in (4, 5)
            )
            apart = np.bitwise_count(one ^ two).sum(axis=1, dtype=np.int64)
            both = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            yield batch.filter(pa.array(apart * (100 + percent) <= both * (100 - percent))).select(["a", "b", "n_a"])

    wide = sets.mapInArrow(describe, "cid long, n long, bits binary")
    one, two = (wide.toDF(name, f"n_{name}", f"bits_{name}") for name in ("a", "b"))
    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b")
    return joined.mapInArrow(passed, "a long, b long, n_a long")


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(cid, grams): the sorted hashes of the wanted classes, each from one of its texts.

    A filter of FILTER_BITS bits, as large for any table, keeps most other texts out of the shuffle.
    """
    spot = F.pmod(F.xxhash64("text_key"), F.lit(FILTER_BITS))
    longs = (
        wanted.select(spot.alias("spot"))
        .groupBy(F.shiftright("spot", 6).alias("slot"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(spot & 63 as int))")).alias("bits"))
        .toArrow()
    )
    held = np.zeros(FILTER_BITS // 64, np.int64)
    held[longs.column("slot").to_numpy()] = longs.column("bits").to_numpy()
    held = np.unpackbits(held.view(np.uint8), bitorder="little")
    packed = np.packbits(held, bitorder="little").tobytes()

    def pass_on(batches):
        bits = np.frombuffer(packed, np.uint8)
        for batch in batches:
            at = batch.column(0).to_numpy()
            keep = pa.array((bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool))
            found = batch.filter(keep)
            yield pa.RecordBatch.from_arrays(found.columns[1:], ["text_key", "text"])

    keyed = docs.select(F.unhex(F.md5("text")).alias("text_key"), "text")
    near = keyed.select(spot.alias("spot"), "text_key", "text").mapInArrow(
        pass_on, "text_key binary, text string"
    )
    texts = near.join(wanted, "text_key").groupBy("cid").agg(F.first("text").alias("text"))

    def collect(batches):
        for batch in slices(batches, 1, SLICE):
            sets = shingle_sets(batch.column(1), words)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], ["cid", "grams"]
            )

    return texts.mapInArrow(collect, "cid long, grams binary")
