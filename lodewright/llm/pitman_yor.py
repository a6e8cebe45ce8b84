"""Language-model scores by a hierarchical Pitman-Yor model.

Four kinds of restaurants share parents. A restaurant for each preceding word in each group serves words; its parent
is the group's restaurant; that one's parent serves words without context; and that one's parent spells words byte by
byte, in restaurants for the last two bytes, the last one and none, over equally likely bytes. The group is that of
the last frequent word before the token. Groups are found from how the most frequent words follow each other; they
tell languages and kinds of text apart. Every word is a preceding word, and so is the beginning of a text: the groups
are only what a pair of words that wasn't seen falls back on.

Customers are counted over the whole training corpus. In every restaurant, those of the preceding words included, the
number of tables of each dish is sampled by Gibbs sweeps: all dishes are seated anew, customer by customer, given the
totals and the parents' probabilities of the sweep before, and each table is a customer of the parent. Probabilities
are averages over the sweeps after the first, in which every dish has one table.

Texts become chunks of word codes once. Words belong to parts by their hash, pairs of words to parts by the hash of
both. Chunks send parts their words and pairs, sorted and packed, and get ids and counts back in the order in which
they asked; in a sweep the parts of the pairs and those of the words do the same. What is sent are rows (to, sender,
kind, n, data) that Spark groups by ``to``.
"""

from __future__ import annotations

from collections import defaultdict
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodewright.llm.tables import discard, documents, slices, written
from lodewright.llm.toxicity import held_out

# Frequent words that are grouped, and the groups.
FREQUENT = 256
GROUPS = 8
CONTEXTS = GROUPS + 1  # with that of no frequent word so far
SWEEPS = 4
STRENGTH = 10.0
# Up to so many dishes are seated one after the other, more of them side by side.
ASIDE = 256
# Customers of one dish whose luck is drawn at once.
QUEUE = 1 << 16
# Bytes and the end of a word.
LETTERS = 257
# Bytes of text that end a chunk.
CHUNK_BYTES = 8 << 20
# Tokens of a part of pairs: so many parts as long as tokens allow, then more parts of the most tokens. A part of words
# takes so many more then: every part of pairs writes to every part of words.
PARTS, LEAST_TOKENS, MOST_TOKENS, MOST_WORDS = 96, 1 << 14, 1 << 20, 8 << 20
# The end of a text, a token like others; no word is empty.
END = ""

LETTER = "to long, sender long, kind int, n long, data binary"
_NAMES = ["to", "sender", "kind", "n", "data"]
(
    TEXTS,  # a chunk
    WORDS,  # to a part, of a chunk: its words there and their customers; n: its tokens
    IDS,  # to a chunk, of a part: the words' ids
    OWNED,  # of a part: its words' restaurants
    PAIRS,  # to a part, of a chunk: its pairs there and their customers
    PLACES,  # of a part, for a chunk: which of the part's pairs are the chunk's
    COUNTS,  # of a part: customers of its pairs
    ONCE,
    TWICE,  # of a part: how many pairs have one customer, or two
    REPEATED,  # of a part: pairs with several customers, which are seated
    JOINED,  # to a part, of a part of pairs: customers and tables of its words, and for which of them it asks
    ASKED,  # of a part, for a part of pairs: for which restaurants it asks
    ANSWERS,  # to a part of pairs: probabilities and tables of those restaurants
    SEATED,  # to a part, of a part of pairs: tables beyond the first in those restaurants
    SCORED,  # to a chunk, of a part: what its words' scores need
    OWN,  # to a chunk, of a part of pairs: customers and tables of its pairs
) = range(16)

_TYPES = ("u1", "u2", "u4", "i8", "f4", "f8")


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers, whole ones in the narrowest type that holds them, compressed. Like bytes of all numbers stand
    together, which compresses better."""
    head, body = [len(arrays)], []
    for array in arrays:
        if array.dtype.kind == "f":
            kind = 4 if array.dtype.itemsize == 4 else 5
        else:
            least, most = (int(array.min()), int(array.max())) if len(array) else (0, 0)
            kind = 3 if least < 0 or most >= 1 << 32 else 0 if most < 1 << 8 else 1 if most < 1 << 16 else 2
        head += [kind, len(array)]
        width = int(_TYPES[kind][1])
        body.append(array.astype(_TYPES[kind]).view("u1").reshape(-1, width).T.tobytes())
    raw = np.array(head, np.int64).tobytes() + b"".join(body)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(data: bytes) -> list[np.ndarray]:
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    number = int.from_bytes(raw[:8], "little")
    head = np.frombuffer(raw, np.int64, 2 * number, 8).tolist()
    found, at = [], 8 * (2 * number + 1)
    for kind, size in zip(head[::2], head[1::2]):
        width = int(_TYPES[kind][1])
        planes = np.frombuffer(raw, np.uint8, width * size, at).reshape(width, size)
        at += width * size
        array = np.ascontiguousarray(planes.T).view(_TYPES[kind]).ravel()
        found.append(array if kind > 3 else array.astype(np.int64))
    return found


def _steps(rising: np.ndarray) -> np.ndarray:
    """Differences, from which np.cumsum makes the array again."""
    return np.diff(rising, prepend=0)


def _bytes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and bytes of words."""
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.uint8)
    _, ends, raw = words.buffers()
    ends = np.frombuffer(ends, np.int32)[words.offset : words.offset + len(words) + 1]
    raw = np.frombuffer(raw, np.uint8) if raw else np.zeros(0, np.uint8)
    return np.diff(ends).astype(np.int64), raw[ends[0] : ends[-1]]


def _strings(sizes: np.ndarray, raw: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    buffers = [None, pa.py_buffer(ends), pa.py_buffer(raw.astype(np.uint8).tobytes())]
    return pa.Array.from_buffers(pa.large_string(), len(sizes), buffers).cast(pa.string())


def _letters(to, sender, kind: int, data: list[bytes], n=0) -> pa.RecordBatch:
    size = len(data)
    columns = [np.broadcast_to(np.asarray(x, np.int64), size) for x in (to, sender, kind, n)]
    columns[2] = columns[2].astype(np.int32)
    return pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(data, pa.binary())], _NAMES)


_NO_LETTERS = _letters(0, 0, 0, [])


def _grouped(answer, *frames: DataFrame, schema: str = LETTER) -> DataFrame:
    """What ``answer`` makes of the letters to each: it gets the number and by kind the letters (sender, n, data)."""

    def read(table: pa.Table) -> pa.Table:
        mail = defaultdict(list)
        table = table.sort_by([("kind", "ascending"), ("sender", "ascending")])
        for kind, *letter in zip(*(table.column(name).to_pylist() for name in ("kind", "sender", "n", "data"))):
            mail[kind].append(letter)
        found = answer(table.column("to")[0].as_py(), mail)
        return pa.Table.from_batches([*([_NO_LETTERS] if schema == LETTER else []), *found])

    return reduce(DataFrame.union, frames).groupBy("to").applyInArrow(read, schema)


def _each(frame: DataFrame, answer, schema: str = LETTER) -> DataFrame:
    """What ``answer`` makes of each letter (to, sender, data), one at a time."""

    def read(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                yield from answer(*(batch.column(name)[i].as_py() for name in ("to", "sender", "data")))

    return frame.mapInArrow(read, schema)


def _kind(frame: DataFrame, *kinds: int) -> DataFrame:
    return frame.where(F.col("kind").isin(*kinds))


def _split(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Words in lower case, and where each text's words end."""
    words = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(texts)))
    counts = np.diff(words.offsets.to_numpy())
    flat = words.flatten()
    real = pc.not_equal(flat, END)
    if not pc.all(real).as_py():  # texts without words
        owner = np.repeat(np.arange(len(counts)), counts)[real.to_numpy(zero_copy_only=False)]
        counts, flat = np.bincount(owner, minlength=len(counts)), flat.filter(real)
    return flat.dictionary_encode(), np.cumsum(counts)


def _numbers(words: pa.Array, numbers: dict[str, int]) -> np.ndarray:
    """The number of each word, 0 of those that have none."""
    at = pc.index_in(words, value_set=pa.array(list(numbers), pa.string()))
    return np.array([0, *numbers.values()], np.int64)[at.fill_null(-1).to_numpy() + 1]


def _contexts(coded: pa.DictionaryArray, ends: np.ndarray, group: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """The context of each word, and that of each text's end."""
    kind = _numbers(coded.dictionary, group)[coded.indices.to_numpy()] if len(coded) else np.zeros(0, np.int64)
    # A slot before each text and one after each word: the last frequent word's place, kept until the next.
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    slots = np.zeros(len(kind) + len(ends), np.int64)
    texts = np.arange(len(ends))
    owner = np.repeat(texts, ends - begins)
    at = np.arange(len(kind)) + owner + 1
    slots[at] = kind
    marked = slots > 0
    heads = begins + texts
    marked[heads] = True
    last = np.maximum.accumulate(np.where(marked, np.arange(len(slots)), 0))
    context = slots[last]
    tails = np.concatenate([heads[1:], [len(slots)]]) - 1
    return context[at - 1], context[tails]


def _before(coded: pa.DictionaryArray, ends: np.ndarray, stop: int) -> np.ndarray:
    """The code of the word before each word and before each text's end; ``stop`` where a text begins."""
    codes = coded.indices.to_numpy().astype(np.int64) if len(coded) else np.zeros(0, np.int64)
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    full = ends > begins
    before = np.concatenate([[stop], codes[:-1]])[: len(codes)]
    before[begins[full]] = stop
    tails = np.full(len(ends), stop, np.int64)
    tails[full] = codes[ends[full] - 1]
    return np.concatenate([before, tails])



def _tallied(train: DataFrame) -> DataFrame:
    """(word, n): occurrences in texts, by task."""

    def count(batches):
        held = None
        for batch in slices(batches, 0):
            coded, _ = _split(batch.column(0))
            found = pa.table({"word": coded.cast(pa.string()), "n": np.ones(len(coded), np.int64)})
            found = found.group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])
            held = found if held is None else pa.concat_tables([held, found])
            if held.num_rows > 1 << 19:
                yield from _summed(held).to_batches(50_000)
                held = None
        if held is not None and held.num_rows:
            yield from _summed(held).to_batches(50_000)

    return train.select("text").mapInArrow(count, "word string, n long")


def _summed(held: pa.Table) -> pa.Table:
    return held.group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])


def _frequent(train: DataFrame) -> list[str]:
    """The most frequent words, by their counts in all texts, or in rows (word, n) that have one for each word."""
    counts = train if "word" in train.columns else _tallied(train).groupBy("word").agg(F.sum("n").alias("n"))
    rows = counts.where((F.col("n") > 0) & (F.col("word") != END)).orderBy(F.desc("n"), "word").limit(FREQUENT)
    return [row["word"] for row in rows.collect()]


class _Chunk:
    """Texts as codes of the chunk's own words; the code after theirs is that of a text's end."""

    def __init__(self, data: bytes):
        ids, known, learn, self.ends, codes, sizes, raw = _unpack(data)
        self.ids, self.learn = pa.array(ids, mask=known == 0), learn.astype(bool)
        self.words = _strings(sizes, raw)
        self.stop = len(self.words)
        self.coded = pa.DictionaryArray.from_arrays(pa.array(codes.astype(np.int32)), self.words)
        # Of all tokens: the words, then the ends.
        texts = np.arange(len(self.ends))
        self.codes = np.concatenate([codes, np.full(len(texts), self.stop)])
        self.owner = np.concatenate([np.repeat(texts, np.diff(self.ends, prepend=0)), texts])
        self.learned = self.learn[self.owner]

    def before(self) -> np.ndarray:
        return _before(self.coded, self.ends, self.stop)

    def contexts(self, group: dict[str, int]) -> np.ndarray:
        return np.concatenate(_contexts(self.coded, self.ends, group))

    def pairs(self, ids: np.ndarray, before: np.ndarray, context: np.ndarray, parts: int):
        """The pairs of the texts, by part, word and cell: ids of words, cells (preceding word's id, context),
        customers; where each part begins; and each token's pair. Tokens have a preceding word and a context each."""
        size, by_id = (self.stop + 1) * CONTEXTS, np.argsort(ids)
        rank = np.empty(len(ids), np.int64)
        rank[by_id] = np.arange(len(ids))
        key, slot = np.unique(rank[self.codes] * size + rank[before] * CONTEXTS + context, return_inverse=True)
        slot, before = slot.ravel(), key % size
        word, cell = ids[by_id[key // size]], ids[by_id[before // CONTEXTS]] * CONTEXTS + before % CONTEXTS
        customers = np.bincount(slot, weights=self.learned, minlength=len(key)).astype(np.int64)
        part = _part(word, cell, parts)
        order = np.argsort(part.astype(np.uint16) if parts < 1 << 16 else part, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        begins = np.searchsorted(part[order], np.arange(parts + 1))
        return word[order], cell[order], customers[order], begins, place[slot]


def _part(word: np.ndarray, cell: np.ndarray, parts: int) -> np.ndarray:
    """The part of each pair, by a hash of both: so a word's pairs are spread evenly, however frequent it is."""
    mixed = word.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ cell.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed ^ mixed >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)


def _chunks(docs: DataFrame) -> DataFrame:
    """Texts (doc_id, text, learn) as chunks, which are rows: whatever reads them reads them whole."""

    def cut(batches):
        held, size, number = [], 0, TaskContext.get().partitionId() << 32

        def chunk():
            texts = pa.Table.from_batches(held).combine_chunks()
            ids, text, learn = (column.chunk(0) for column in texts.columns)
            coded, ends = _split(text)
            codes = coded.indices.to_numpy() if len(coded) else np.zeros(0, np.int64)
            known, learn = (x.to_numpy(zero_copy_only=False) for x in (ids.is_valid(), learn))
            ids = ids.cast(pa.int64()).fill_null(0).to_numpy()
            data = _pack(ids, known, learn, ends, codes, *_bytes(coded.dictionary))
            return _letters(number, number, TEXTS, [data], len(codes) + len(ends))

        for batch in slices(batches, 1):
            held.append(batch)
            size += pc.sum(pc.binary_length(batch.column(1))).as_py()
            if size >= CHUNK_BYTES:
                yield chunk()
                held, size, number = [], 0, number + 1
        if held:
            yield chunk()

    return docs.select("doc_id", "text", "learn").mapInArrow(cut, LETTER)


def _hashes(sizes: np.ndarray, raw: np.ndarray, shards: int) -> np.ndarray:
    """The part of each word, by a polynomial of its bytes."""
    ends = np.cumsum(sizes)
    powers = np.cumprod(np.full(sizes.max(initial=0), 0x9E3779B97F4A7C15, np.uint64))
    place = np.arange(len(raw)) - np.repeat(ends - sizes, sizes)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers[place])])
    mixed = sums[ends] - sums[ends - sizes]
    mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed ^ mixed >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


def _vocabulary(chunks: DataFrame, shards: int) -> DataFrame:
    """Of the parts that words belong to: their words and customers (OWNED), and the chunks' words' ids (IDS)."""

    def ask(to: int, _, data: bytes):
        chunk = _Chunk(data)
        customers = np.bincount(chunk.codes[chunk.learned], minlength=chunk.stop + 1)
        words = pa.concat_arrays([chunk.words, pa.array([END], pa.string())])
        part = _hashes(*_bytes(words), shards)
        order = np.argsort(part, kind="stable")
        there, begins = np.unique(part[order], return_index=True)
        words, ends = words.take(pa.array(order)), [*begins[1:].tolist(), len(order)]
        data = [
            _pack(_steps(order[a:b]), customers[order[a:b]], *_bytes(words.slice(a, b - a)))
            for a, b in zip(begins.tolist(), ends)
        ]
        yield _letters(there, to, WORDS, data)

    def own(to: int, mail):
        letters = [(sender, *_unpack(data)) for sender, _, data in mail[WORDS]]
        words = pa.concat_arrays([_strings(sizes, raw) for *_, sizes, raw in letters]).dictionary_encode()
        index, size = words.indices.to_numpy().astype(np.int64), len(words.dictionary)
        customers = np.bincount(index, weights=np.concatenate([letter[2] for letter in letters]), minlength=size)
        yield _letters(to, to, OWNED, [_pack(*_bytes(words.dictionary), customers.astype(np.int64))])
        mine = _split_like(index, [letter[1] for letter in letters])
        data = [_pack(letter[1], at * shards + to) for letter, at in zip(letters, mine)]
        yield _letters([letter[0] for letter in letters], to, IDS, data)

    return _grouped(own, _each(chunks, ask))


def _split_like(array: np.ndarray, others: list[np.ndarray]) -> list[np.ndarray]:
    return np.split(array, np.cumsum([len(x) for x in others])[:-1])


def _joined(arrays: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.zeros(0, np.int64)


def _counted(vocabulary: DataFrame) -> DataFrame:
    """(word, n): the customers of every word, the end included."""

    def count(_to, _sender, data: bytes):
        sizes, raw, customers = _unpack(data)
        yield pa.RecordBatch.from_arrays([_strings(sizes, raw), pa.array(customers)], ["word", "n"])

    return _each(_kind(vocabulary, OWNED), count, "word string, n long")


def _summed_by(rows: DataFrame, key: str) -> pa.Table:
    """Sums of ``n``, for the driver; written first, so that what was shuffled goes."""
    sums = written(rows.groupBy(key).agg(F.sum("n").alias("n")), "sums")
    table = sums.toArrow()
    discard(sums)
    return table


def _groups(chunks: DataFrame, frequent: list[str]) -> dict[str, int]:
    """Group 1 .. GROUPS of each frequent word, by which frequent words follow it in training texts."""
    number = {word: i + 1 for i, word in enumerate(frequent)}
    size = len(frequent)

    def follow(_to, _sender, data: bytes):
        chunk = _Chunk(data)
        own = np.append(_numbers(chunk.words, number), -1)[chunk.codes]
        real = chunk.learned & (own >= 0)
        total = np.bincount(chunk.contexts(number)[real] * (size + 1) + own[real], minlength=(size + 1) * (size + 1))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"pair": at, "n": total[at]})

    if not size:
        return {}
    # At most (FREQUENT + 1) ** 2 rows.
    rows = _summed_by(_each(chunks, follow, "pair long, n long"), "pair")
    pairs = np.zeros((size + 1) * (size + 1))
    pairs[rows.column("pair").to_numpy()] = rows.column("n").to_numpy()
    pairs = np.sqrt(pairs.reshape(size + 1, size + 1)[1:, 1:])
    near = pairs + pairs.T + 1e-9
    near /= np.sqrt((near * near).sum(axis=1, keepdims=True))
    centres = [near[0]]
    while len(centres) < min(GROUPS, size):
        centres.append(near[int(np.argmin(np.max(near @ np.array(centres).T, axis=1)))])
    centres = np.array(centres)
    for _ in range(20):
        best = np.argmax(near @ centres.T, axis=1)
        for g in range(len(centres)):
            if (best == g).any():
                centres[g] = near[best == g].sum(axis=0)
        centres /= np.sqrt((centres * centres).sum(axis=1, keepdims=True))
    return {word: int(g) + 1 for word, g in zip(frequent, best)}


def _ids(chunk: _Chunk, letters: list) -> np.ndarray:
    """The id of each word of the chunk and of the end."""
    ids = np.zeros(chunk.stop + 1, np.int64)
    for *_, data in letters:
        codes, found = _unpack(data)[:2]
        ids[np.cumsum(codes)] = found
    return ids


def _pairs(chunks: DataFrame, vocabulary: DataFrame, group: dict[str, int], parts: int, shards: int) -> DataFrame:
    """What parts know of their pairs of words: which are whose (PLACES), customers (COUNTS, ONCE, TWICE), the pairs
    that are seated (REPEATED), and what they tell the parts of their words (JOINED)."""

    def ask(to: int, mail):
        chunk = _Chunk(mail[TEXTS][0][-1])
        ids = _ids(chunk, mail[IDS])
        word, cell, customers, begins, _ = chunk.pairs(ids, chunk.before(), chunk.contexts(group), parts)
        there = np.flatnonzero(np.diff(begins))
        some = [slice(begins[i], begins[i + 1]) for i in there]
        yield _letters(there, to, PAIRS, [_pack(_steps(word[x]), cell[x], customers[x]) for x in some])

    def meet(to: int, mail):
        letters = [(sender, *_unpack(data)) for sender, _, data in mail[PAIRS]]
        word, cell = np.concatenate([np.cumsum(x[1]) for x in letters]), np.concatenate([x[2] for x in letters])
        own, index = np.unique(word, return_inverse=True)
        key, slot = np.unique(index.ravel() << 40 | cell, return_inverse=True)
        n = np.bincount(slot.ravel(), weights=np.concatenate([x[3] for x in letters]), minlength=len(key)).astype(np.int64)
        mine = _split_like(slot.ravel(), [x[1] for x in letters])
        yield _letters(to, [x[0] for x in letters], PLACES, [_pack(_steps(x)) for x in mine])
        yield _letters(to, to, COUNTS, [_pack(n)])
        yield _letters(to, to, [ONCE, TWICE], [b"", b""], [(n == 1).sum(), (n == 2).sum()])
        taught = np.flatnonzero(n)
        key, n = key[taught], n[taught]
        cell = key & (1 << 40) - 1
        dish = own[key >> 40] * CONTEXTS + cell % CONTEXTS  # in the group's restaurant, to which a pair's tables go
        every, slot = np.unique(np.concatenate([dish, cell]), return_inverse=True)
        dish, cell = slot.ravel()[: len(n)], slot.ravel()[len(n) :]
        served, filled = (np.bincount(x, minlength=len(every)) for x in (dish, cell))
        kept = np.bincount(cell, weights=n, minlength=len(every)).astype(np.int64)
        asked, again = np.zeros(len(every), bool), n > 1
        asked[dish[again]] = asked[cell[again]] = True
        part = every // CONTEXTS % shards
        order = np.argsort(part, kind="stable")
        there, begins = np.unique(part[order], return_index=True)
        data = [
            _pack(_steps(every[x]), *(some[x] for some in (served, kept, filled, asked)))
            for x in np.split(order, begins[1:]) if len(x)
        ]
        yield _letters(there, to, JOINED, data)
        # Answers come by part, in the order in which it was asked.
        place = np.empty(len(every), np.int64)
        place[order] = np.cumsum(asked[order]) - 1
        data = _pack(place[dish[again]], place[cell[again]], n[again], _steps(taught[again]), np.zeros(again.sum(), np.int64))
        yield _letters(to, to, REPEATED, [data])

    return _grouped(meet, _grouped(ask, chunks, _kind(vocabulary, IDS)))


def seat(customers: np.ndarray, pull: np.ndarray, discount: float, draw: np.random.Generator) -> np.ndarray:
    """A sample of the number of tables of dishes with so many customers each, who are seated one by one. ``pull`` is
    the weight of a new table: the strength and the discounts of all tables, times the parent's probability of the
    dish."""
    tables = np.minimum(customers, 1).astype(np.int64)
    live, seated = np.flatnonzero(customers > 1), 1
    while len(live) > ASIDE:  # a customer of each dish
        new = draw.random(len(live)) * (pull[live] + seated - discount * tables[live]) < pull[live]
        tables[live] += new
        seated += 1
        live = live[customers[live] > seated]
    for dish in live:  # all customers of a dish
        for first in range(seated, int(customers[dish]), QUEUE):
            luck = draw.random(min(QUEUE, int(customers[dish]) - first))
            tables[dish] += queue(luck, first, float(pull[dish]), discount, int(tables[dish]))
    return tables


def queue(luck: np.ndarray, seated: int, pull: float, discount: float, tables: int) -> int:
    """How many customers of a dish, of whom ``seated`` sit at ``tables`` already, open a table one after the other.

    Tables opened by those ahead make a new one likelier. So from no new tables the count ahead of each customer
    only grows, until it is the one that seating them in turn gives.
    """
    weight = pull + seated + np.arange(len(luck))
    ahead = np.zeros(len(luck))
    while True:
        new = luck * (weight - discount * (tables + ahead)) < pull
        total = np.cumsum(new)
        if np.array_equal(total - new, ahead):
            return int(total[-1]) if len(total) else 0
        ahead = (total - new).astype(np.float64)


class Spelling:
    """Byte restaurants: for the last two bytes, the last one, and none. At most LETTERS ** 3 dishes."""

    def __init__(self, codes: np.ndarray, customers: np.ndarray, seed: int):
        draw = np.random.default_rng(seed)
        self.levels = []
        # Customers of a level are the tables of the level below, so seating starts at the longest contexts;
        # the parents' probabilities are those of one table per dish at first.
        for sweep in range(2):
            levels, below, at = [], customers, codes
            for order in (2, 1, 0):
                base = LETTERS ** (order + 1)
                key = at % base
                dish, slot = np.unique(key, return_inverse=True)
                number = np.bincount(slot.ravel(), weights=below, minlength=len(dish)).astype(np.int64)
                if sweep:
                    parent = self._parent(dish, order)
                    discount, _, totals = self._restaurants(order)
                    pull = (STRENGTH + discount * totals) * parent
                    tables = seat(number, pull, discount, draw)
                else:
                    tables = np.minimum(number, 1)
                levels.append((dish, number, tables))
                at, below = dish, tables
            self.levels = levels[::-1]  # by the number of bytes before
            self._prepare()

    def _prepare(self) -> None:
        self.stats = []
        for dish, number, tables in self.levels:
            once, twice = (number == 1).sum(), (number == 2).sum()
            discount = min(0.9, max(0.1, once / max(1, once + 2 * twice)))
            place, slot = np.unique(dish // LETTERS, return_inverse=True)
            guests = np.bincount(slot.ravel(), weights=number, minlength=len(place))
            total = np.bincount(slot.ravel(), weights=tables, minlength=len(place))
            self.stats.append((discount, place, guests, total))

    def _restaurants(self, order: int):
        discount, place, guests, total = self.stats[order]
        slot = np.searchsorted(place, self.levels[order][0] // LETTERS)
        return discount, guests[slot], total[slot]

    def _parent(self, dish: np.ndarray, order: int) -> np.ndarray:
        return self.of(dish % LETTERS**order if order else dish, order - 1)

    def of(self, codes: np.ndarray, order: int = 2) -> np.ndarray:
        """The probability of the last byte of each code after those before it."""
        if order < 0:
            return np.full(len(codes), 1 / LETTERS)
        parent = self.of(codes % LETTERS**order if order else codes, order - 1)
        dish, number, tables = self.levels[order]
        discount, place, guests, total = self.stats[order]

        own = _found(dish, number - discount * tables, codes)
        there, filled = _found(place, guests, codes // LETTERS), _found(place, total, codes // LETTERS)
        return (own + (STRENGTH + discount * filled) * parent) / (STRENGTH + there)


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of every byte with the two before it, the word's end included, and the words they belong to."""
    return _byte_codes(*_bytes(pa.array(words, pa.string())))


def _byte_codes(sizes: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = sizes + 1
    ends = np.cumsum(sizes)
    flat = np.full(ends[-1] if len(ends) else 0, 256, np.int64)
    inner = np.ones(len(flat), bool)
    inner[ends - 1] = False
    flat[inner] = raw
    first, second = np.zeros(len(flat), bool), np.zeros(len(flat), bool)
    first[ends - sizes] = True
    second[1:] = first[:-1]
    one = np.where(first, 256, np.concatenate([[256], flat[:-1]])) if len(flat) else flat
    two = np.where(first | second, 256, np.concatenate([[256, 256], flat[:-2]])[: len(flat)]) if len(flat) else flat
    return (two * LETTERS + one) * LETTERS + flat, np.repeat(np.arange(len(sizes)), sizes)


class Sweep:
    """What a sweep leaves for the next one: totals, and the spelling's probabilities."""

    def __init__(self, discounts, tables, customers, top_tables, top_customers, spelling, seed):
        self.discounts, self.tables, self.customers = discounts, tables, customers
        self.top_tables, self.top_customers = top_tables, top_customers
        self.spelling, self.seed = spelling, seed

    def escape(self) -> np.ndarray:
        """The weight of the words' restaurant in that of each context."""
        return (STRENGTH + self.discounts[0] * self.tables) / (STRENGTH + self.customers)

    def spelled(self, sizes: np.ndarray, raw: np.ndarray) -> np.ndarray:
        """Probabilities of words by their bytes."""
        codes, owner = _byte_codes(sizes, raw)
        code, slot = np.unique(codes, return_inverse=True)
        return np.exp(np.bincount(owner, weights=np.log(self.spelling.of(code))[slot.ravel()], minlength=len(sizes)))

    def top(self, customers: np.ndarray, tables: np.ndarray, spelled: np.ndarray) -> np.ndarray:
        """Probabilities without context, of words with so many customers and tables."""
        rest = STRENGTH + self.discounts[1] * self.top_tables
        return (customers - self.discounts[1] * tables + rest * spelled) / (STRENGTH + self.top_customers)



class _Part:
    """The words of a part, their restaurants' cells (word, context) in order, and who asks for which cells."""

    FIELDS = (
        # Lengths and bytes of the words, and their customers.
        "sizes raw c cells "
        # Of cells: customers of the word in the group, and of the preceding word's restaurant.
        "served kept "
        # Tables in the preceding word's restaurant, of the word in the group, and of the word without context.
        "filled tables top "
        # Customers and tables with one table for each pair.
        "served_once filled_once "
        # Sums over sweeps: the word's own probability in the group, tables, probability without context.
        "own full chance "
        "askers asks asked"
    ).split()

    def __init__(self, data: bytes):
        vars(self).update(zip(self.FIELDS, _unpack(data)))
        self.cells = np.cumsum(self.cells)
        self.row, self.context = self.cells // CONTEXTS, self.cells % CONTEXTS
        self.number, self.spellings = len(self.sizes), {}

    def packed(self) -> bytes:
        return self.pack(**vars(self))

    @classmethod
    def pack(cls, cells: np.ndarray, **fields: np.ndarray) -> bytes:
        fields["cells"] = _steps(cells)
        return _pack(*(fields[name] for name in cls.FIELDS))

    def guests(self) -> np.ndarray:
        """Customers without context."""
        return np.bincount(self.row, weights=self.tables, minlength=self.number).astype(np.int64)

    def spelled(self, sweep: Sweep) -> np.ndarray:
        if sweep.seed not in self.spellings:
            self.spellings[sweep.seed] = sweep.spelled(self.sizes, self.raw)
        return self.spellings[sweep.seed]

    def lists(self) -> list[tuple[int, np.ndarray]]:
        """Who asks for which cells."""
        return list(zip(self.askers.tolist(), np.split(self.asked, np.cumsum(self.asks)[:-1])))

    def probabilities(self, sweep: Sweep) -> tuple[np.ndarray, np.ndarray]:
        """Of the cells' words in their groups, without what the parent gives; of words without context."""
        own = (self.served - sweep.discounts[0] * self.tables) / (STRENGTH + sweep.customers[self.context])
        return own, sweep.top(self.guests(), self.top, self.spelled(sweep))

    def add(self, sweep: Sweep) -> None:
        """Counts the sweep in the averages."""
        own, top = self.probabilities(sweep)
        self.own, self.chance, self.full = self.own + own, self.chance + top, self.full + self.filled


def _opened(vocabulary: DataFrame, pairs: DataFrame, shards: int) -> DataFrame:
    """The parts' restaurants with one table for each dish."""

    def join(to: int, mail):
        sizes, raw, c = _unpack(mail[OWNED][0][-1])
        letters = [(sender, *_unpack(data)) for sender, _, data in mail[JOINED]]
        cell = _joined([np.cumsum(x[1]) for x in letters])
        cells, slot = np.unique(cell // CONTEXTS // shards * CONTEXTS + cell % CONTEXTS, return_inverse=True)
        slot = slot.ravel()
        served, kept, filled = (
            np.bincount(slot, weights=_joined([x[i] for x in letters]), minlength=len(cells)).astype(np.int64)
            for i in (2, 3, 4)
        )
        tables = np.minimum(served, 1)
        guests = np.bincount(cells // CONTEXTS, weights=tables, minlength=len(c)).astype(np.int64)
        lists = [at[x[5] > 0] for at, x in zip(_split_like(slot, [x[1] for x in letters]), letters)]
        data = _Part.pack(
            sizes=sizes, raw=raw, c=c, cells=cells, served=served, kept=kept, filled=filled, tables=tables,
            top=np.minimum(guests, 1), served_once=served, filled_once=filled,
            own=np.zeros(len(cells)), full=np.zeros(len(cells), np.int64), chance=np.zeros(len(c)),
            askers=np.array([x[0] for x in letters], np.int64), asks=np.array([*map(len, lists)], np.int64),
            asked=_joined(lists),
        )
        yield _letters(to, to, OWNED, [data])

    return _grouped(join, _kind(vocabulary, OWNED), _kind(pairs, JOINED))


def _answers(words: DataFrame, sweep: Sweep) -> DataFrame:
    """To the parts of pairs: probabilities in the groups, and tables of preceding words, of what they ask for."""

    def answer(to: int, _, data: bytes):
        part = _Part(data)
        own, top = part.probabilities(sweep)
        value = (own + sweep.escape()[part.context] * top[part.row]).astype(np.float32)
        lists = [(asker, at) for asker, at in part.lists() if len(at)]
        yield _letters([x[0] for x in lists], to, ANSWERS, [_pack(value[at], part.filled[at]) for _, at in lists])

    return _each(words, answer)


def _seated_pairs(seats: DataFrame, answers: DataFrame, discount: float, number: int) -> DataFrame:
    """Pairs of words seated anew (REPEATED), and the tables beyond the first in the restaurants of their words (SEATED)."""

    def reseat(to: int, mail):
        dish, cell, n, where, total = _unpack(mail[REPEATED][0][-1])
        letters = [(sender, *_unpack(data)) for sender, _, data in mail[ANSWERS]]
        chance, filled = _joined([x[1] for x in letters]), _joined([x[2] for x in letters])
        pull = (STRENGTH + discount * filled[cell]) * chance[dish]
        tables = seat(n, pull, discount, np.random.default_rng([to, number]))
        more = [np.bincount(at, weights=tables - 1, minlength=len(filled)).astype(np.int64) for at in (dish, cell)]
        data = zip(*(_split_like(x, [letter[1] for letter in letters]) for x in more))
        yield _letters([x[0] for x in letters], to, SEATED, [_pack(*x) for x in data])
        yield _letters(to, to, REPEATED, [_pack(dish, cell, n, where, total + tables)])

    return _grouped(reseat, _kind(seats, REPEATED), answers)


def _seated(part: _Part, sweep: Sweep, letters: list, draw: np.random.Generator) -> None:
    """Seats the words anew: the pairs' tables in the groups, and the groups' tables without context."""
    spelled = part.spelled(sweep)
    parent = sweep.top(part.guests(), part.top, spelled)
    part.served, part.filled = part.served_once.copy(), part.filled_once.copy()
    lists = dict(part.lists())
    for sender, _, data in letters:
        served, filled = _unpack(data)
        part.served[lists[sender]] += served
        part.filled[lists[sender]] += filled
    pull = (STRENGTH + sweep.discounts[0] * sweep.tables)[part.context] * parent[part.row]
    part.tables = seat(part.served, pull, sweep.discounts[0], draw)
    rest = STRENGTH + sweep.discounts[1] * sweep.top_tables
    part.top = seat(part.guests(), rest * spelled, sweep.discounts[1], draw)


def _seated_words(words: DataFrame, seats: DataFrame, sweep: Sweep, counts: bool) -> DataFrame:
    """The parts after the next sweep; ``counts`` is whether this one counts in the averages."""

    def move(to: int, mail):
        part = _Part(mail[OWNED][0][-1])
        if counts:
            part.add(sweep)
        _seated(part, sweep, mail[SEATED], np.random.default_rng([to, sweep.seed, 1]))
        yield _letters(to, to, OWNED, [part.packed()])

    return _grouped(move, words, _kind(seats, SEATED))


# Keys of the sums that a sweep collects, below the byte codes' own.
_TABLES, _GUESTS, _TOP, _TOP_GUESTS, _ONE, _TWO, _TOP_ONE, _TOP_TWO = (-100 * i for i in range(1, 9))


def _sums(words: DataFrame) -> dict[int, int]:
    """Totals after a sweep; at most LETTERS ** 3 byte codes and a few more rows."""

    def add(batches):
        total: dict[int, int] = {}
        held_codes, held_counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for data in batch.column(0):
                part = _Part(data.as_py())
                guests = part.guests()
                spread = [np.bincount(part.context, weights=x, minlength=CONTEXTS) for x in (part.tables, part.served)]
                some = [
                    (_TABLES, spread[0]),
                    (_GUESTS, spread[1]),
                    (_TOP, [part.top.sum()]),
                    (_TOP_GUESTS, [guests.sum()]),
                    (_ONE, [(part.served == 1).sum()]),
                    (_TWO, [(part.served == 2).sum()]),
                    (_TOP_ONE, [(guests == 1).sum()]),
                    (_TOP_TWO, [(guests == 2).sum()]),
                ]
                for key, values in some:
                    for i, value in enumerate(values):
                        total[key - i] = total.get(key - i, 0) + int(value)
                known = np.flatnonzero(part.top)
                codes, owner = _byte_codes(*_bytes(_strings(part.sizes, part.raw).take(pa.array(known))))
                code, slot = np.unique(np.concatenate([held_codes, codes]), return_inverse=True)
                weights = np.concatenate([held_counts, part.top[known][owner]])
                held_codes, held_counts = code, np.bincount(slot.ravel(), weights=weights, minlength=len(code)).astype(np.int64)
        yield pa.RecordBatch.from_pydict(
            {
                "key": np.concatenate([np.array(list(total), np.int64), held_codes]),
                "n": np.concatenate([np.array(list(total.values()), np.int64), held_counts]),
            }
        )

    table = _summed_by(words.select("data").mapInArrow(add, "key long, n long"), "key")
    return dict(zip(table.column("key").to_pylist(), table.column("n").to_pylist()))


def _swept(words: DataFrame, number: int) -> Sweep:
    sums = _sums(words)

    def spread(key: int) -> np.ndarray:
        return np.array([sums.get(key - i, 0) for i in range(CONTEXTS)], np.float64)

    def discount(one: int, two: int) -> float:
        single, double = sums.get(one, 0), sums.get(two, 0)
        return min(0.9, max(0.1, single / max(1, single + 2 * double)))

    codes = np.array(sorted(key for key in sums if key >= 0), np.int64)
    customers = np.array([sums[key] for key in codes.tolist()], np.int64)
    return Sweep(
        (discount(_ONE, _TWO), discount(_TOP_ONE, _TOP_TWO)),
        spread(_TABLES),
        spread(_GUESTS),
        sums.get(_TOP, 0),
        sums.get(_TOP_GUESTS, 0),
        Spelling(codes, customers, number),
        number,
    )


def _used(sweeps: int) -> range:
    """The sweeps that count in the averages."""
    return range(min(1, sweeps - 1), sweeps)


def fit(
    vocabulary: DataFrame, pairs: DataFrame, shards: int, discount: float, sweeps: int = SWEEPS
) -> tuple[DataFrame, DataFrame, list[Sweep]]:
    """The parts' words and pairs after the sweeps, and the sweeps. The last one isn't in the words' averages yet."""
    words, seats = written(_opened(vocabulary, pairs, shards), "words"), written(_kind(pairs, REPEATED), "seats")
    past = [_swept(words, 0)]
    for number in range(1, sweeps):
        anew = written(_seated_pairs(seats, _answers(words, past[-1]), discount, number), "seats")
        after = written(_seated_words(words, anew, past[-1], number - 1 in _used(sweeps)), "words")
        discard(words, seats)
        words, seats = after, anew
        past.append(_swept(words, number))
    return words, seats, past


def _scored(words: DataFrame, vocabulary: DataFrame, last: Sweep, shards: int, seen: int) -> DataFrame:
    """To chunks: customers, averaged probabilities and tables of their words."""
    asks = _kind(vocabulary, IDS).select(F.col("sender").alias("to"), F.col("to").alias("sender"), "kind", "n", "data")

    def answer(to: int, mail):
        part = _Part(mail[OWNED][0][-1])
        part.add(last)
        begins = np.searchsorted(part.row, np.arange(part.number + 1))
        data = []
        for *_, asked in mail[IDS]:
            codes, ids = _unpack(asked)
            row = ids // shards
            size = begins[row + 1] - begins[row]
            at = np.repeat(begins[row] - np.cumsum(size) + size, size) + np.arange(size.sum())
            cell = np.repeat(np.arange(len(row)), size) * CONTEXTS + part.context[at]
            numbers = (part.own[at] / seen).astype(np.float32), part.kept[at], part.full[at]
            data.append(_pack(codes, ids, part.c[row], part.chance[row] / seen, _steps(cell), *numbers))
        yield _letters([x[0] for x in mail[IDS]], to, SCORED, data)

    return _grouped(answer, words, asks)


def _own(pairs: DataFrame, seats: DataFrame, seen: int) -> DataFrame:
    """To chunks: customers of their pairs, and tables, added up over the sweeps."""

    def answer(to: int, mail):
        (n,) = _unpack(mail[COUNTS][0][-1])
        tables = np.minimum(n, 1) * seen
        *_, where, total = _unpack(mail[REPEATED][0][-1])
        if total.any():
            tables[np.cumsum(where)] = total
        at = [np.cumsum(_unpack(data)[0]) for *_, data in mail[PLACES]]
        yield _letters([x[0] for x in mail[PLACES]], to, OWN, [_pack(n[x], tables[x]) for x in at])

    return _grouped(answer, _kind(pairs, PLACES, COUNTS), _kind(seats, REPEATED))


def _parts(tokens: int) -> tuple[int, int]:
    """The parts of pairs, and those of words."""
    size = min(MOST_TOKENS, max(LEAST_TOKENS, -(-tokens // PARTS)))
    parts = max(1, -(-tokens // size))
    return parts, max(min(parts, PARTS), -(-tokens // MOST_WORDS))


def score(frame: DataFrame, text: str = "text", key: str = "doc_id", sweeps: int = SWEEPS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    The model learns from rows that aren't held out: those whose crc32 of the id as text leaves another
    remainder than 1 by 5, and those with a null id. Tokens are the words, A-Z in lower case, and one end; a null
    text is empty. Repeated rows are texts of their own. Without training rows all bytes are equally likely,
    and the base score is that of no counts. An empty table gives no rows.
    """
    docs = documents(frame, text, key)
    docs = docs.select("doc_id", "text", (~held_out(F.col("doc_id"), 5, 1)).alias("learn"))
    chunks = written(_chunks(docs), "chunks")
    parts, shards = _parts(chunks.agg(F.sum("n")).first()[0] or 0)
    vocabulary = written(_vocabulary(chunks, shards), "vocabulary")
    counts = _counted(vocabulary)
    totals = counts.agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("v")).first()
    tokens, types = totals["n"] or 0, totals["v"] or 0
    group = _groups(chunks, _frequent(counts))
    pairs = written(_pairs(chunks, vocabulary, group, parts, shards), "pairs")
    few = dict(_kind(pairs, ONCE, TWICE).groupBy("kind").agg(F.sum("n")).collect())
    discount = min(0.9, max(0.1, few.get(ONCE, 0) / max(1, few.get(ONCE, 0) + 2 * few.get(TWICE, 0))))
    words, seats, past = fit(vocabulary, pairs, shards, discount, sweeps)

    seen = len(_used(sweeps))
    own = written(_own(pairs, seats, seen), "pair-answers")
    discard(pairs, seats)
    scored = _scored(words, vocabulary, past[-1], shards, seen)
    escape = np.mean([past[i].escape() for i in _used(sweeps)], axis=0)
    scorer = _Scorer(group, parts, discount, escape, seen, tokens, types)
    return _grouped(scorer, chunks, own, scored, schema=_SCORES)


_SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


class _Scorer:
    def __init__(
        self, group: dict[str, int], parts: int, discount: float, escape: np.ndarray, seen: int, tokens: int, types: int
    ):
        self.group, self.parts, self.discount, self.escape = group, parts, discount, escape
        self.seen, self.tokens, self.types = seen, tokens, types

    def __call__(self, _, mail):
        chunk = _Chunk(mail[TEXTS][0][-1])
        size = chunk.stop + 1
        c, top = np.zeros(size, np.int64), np.zeros(size)
        own, kept, full = (np.zeros((size, CONTEXTS)) for _ in range(3))
        for *_, data in mail[SCORED]:
            codes, _, customers, chance, cell, *numbers = _unpack(data)
            codes, cell = np.cumsum(codes), np.cumsum(cell)
            c[codes], top[codes] = customers, chance
            for some, values in zip((own, kept, full), numbers):
                some[codes[cell // CONTEXTS], cell % CONTEXTS] = values
        at, before, context = chunk.codes, chunk.before(), chunk.contexts(self.group)
        *_, place = chunk.pairs(_ids(chunk, mail[SCORED]), before, context, self.parts)
        customers, tables = (np.concatenate(x)[place] for x in zip(*(_unpack(data) for *_, data in mail[OWN])))
        value = own[at, context] + self.escape[context] * top[at]
        rest = (STRENGTH + self.discount * full[before, context] / self.seen) * value
        value = (customers - self.discount * tables / self.seen + rest) / (STRENGTH + kept[before, context])
        base = np.log10((c[at] + 0.5) / (self.tokens + 0.5 * (self.types + 1)))

        def per_text(weights):
            return np.bincount(chunk.owner, weights=weights, minlength=len(chunk.ends))

        yield pa.RecordBatch.from_arrays(
            [
                chunk.ids,
                pa.array(~chunk.learn),
                pa.array(np.diff(chunk.ends, prepend=0) + 1),
                pa.array(per_text(c[at] > 0).astype(np.int64)),
                pa.array(np.full(len(chunk.ends), self.tokens, np.int64)),
                pa.array(per_text(base)),
                pa.array(per_text(np.log10(value))),
            ],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )


def _found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The values of the wanted keys, 0 for those that aren't among ``keys``, which are in order."""
    if not len(keys):
        return np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0.0)
