"""Best-fit packing of tokenised documents into sequences of one capacity.

Documents become token ids and are cut into pieces of at most ``capacity`` tokens. Only the histogram of
piece lengths, which has ``capacity`` entries however many documents there are, reaches the driver. There a
configuration linear program over it is solved by multiplicative weights: every round prices the lengths by
how much of their demand is still open, a knapsack over the capacity finds the dearest configuration, and
the configuration is taken a whole number of times, which rounds the solution as it is made. The few pieces
that are open when the rounds end are placed by best fit, longest first. Each configuration owns ranges of
ranks among the pieces of a length, so Spark gives every piece its place from its own rank.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodewright.llm.tables import documents, slices, written

CAPACITY = 2048
# Rounds of the linear program; a bound of the plan's size too.
ROUNDS = 1500
# How strongly a length whose demand is still open is dearer than one that is nearly met.
ETA = 3.0
# Cached words of a worker; the cache starts anew beyond it.
CACHED_WORDS = 700_000
# Bytes of texts that a task holds as strings and token ids at once (a longer text is handled alone).
CHUNK_BYTES = 1 << 20

PIECES = (
    "block long, doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, "
    "place long"
)


class Encoder:
    """Token ids of whole texts. Words between ASCII white space are encoded once and cached.

    The tokenizer drops white space and never joins characters across it, so the ids of a text are those
    of its words in order. A full stop or comma after a letter is a word of its own to the tokenizer, and so
    it is here. Texts that hold a special token's string are encoded whole.
    """

    def __init__(self, path: str, end: int):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        # The same model for words that are normalised and split already; it marks the end of each.
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[code for word, code in vocabulary.items() if word.endswith("</w>")]] = True
        self.end = end
        self.clear()

    def clear(self) -> None:
        self.codes: dict[str, int] = {}
        self.begins = np.zeros(1, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _learn(self, new: list[str]) -> None:
        """Ids of words that aren't cached yet; most are split here and encoded in one call."""
        parts, counts, other = [], np.zeros(len(new), np.int64), {}
        for i, word in enumerate(new):
            if _LETTERS.fullmatch(word):
                parts.append(word.translate(_BYTES))
                counts[i] = 1
            elif word.isascii() and word.isprintable():
                found = _PARTS.findall(word.lower())
                parts += found
                counts[i] = len(found)
            else:
                other[i] = self.tokenizer.encode(word, add_special_tokens=False).ids
        ids = np.array(self.plain.encode(" ".join(parts), add_special_tokens=False).ids, np.uint32)
        ends = np.concatenate([[0], np.flatnonzero(self.closes[ids]) + 1])[
            np.concatenate([[0], np.cumsum(counts)])
        ]
        sizes = np.diff(ends)
        between, last = [], 0
        for i, own in other.items():
            sizes[i] = len(own)
            between += [ids[last : ends[i]], np.array(own, np.uint32)]
            last = ends[i]
        ids = np.concatenate([*between, ids[last:]])
        self.codes.update(zip(new, range(len(self.codes), len(self.codes) + len(new))))
        self.begins = np.concatenate([self.begins, self.begins[-1] + np.cumsum(sizes)])
        self.flat = np.concatenate([self.flat, ids])

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with the end id, and where each text's ids end."""
        if len(self.codes) > CACHED_WORDS:
            self.clear()
        whole = {
            i: self.tokenizer.encode(text, add_special_tokens=False).ids
            for i, text in enumerate(texts)
            if any(token in text for token in self.special)
        }
        plain = pa.array("" if i in whole else _spread(text) for i, text in enumerate(texts))
        words = pc.ascii_split_whitespace(plain)
        counts = words.offsets.to_numpy()
        words = words.flatten().dictionary_encode()
        known = words.dictionary.to_pylist()
        new = [word for word in known if word not in self.codes]
        if new:
            self._learn(new)
        coded = np.fromiter(map(self.codes.__getitem__, known), np.int64, len(known))
        coded = coded[words.indices.to_numpy()]
        begins, sizes = self.begins[coded], self.begins[coded + 1] - self.begins[coded]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.flat[np.arange(ends[-1]) + np.repeat(begins - ends[:-1], sizes)]
        of_text = ends[counts]
        parts: list[np.ndarray] = []
        for i in range(len(texts)):
            parts.append(np.array(whole[i], np.uint32) if i in whole else ids[of_text[i] : of_text[i + 1]])
            parts.append(np.array([self.end], np.uint32))
        sizes = np.array([len(part) for part in parts]).reshape(-1, 2).sum(axis=1)
        return np.concatenate(parts), np.cumsum(sizes)


# Lower-case letters of Latin-1, which normalisation leaves as they are.
_LETTERS = re.compile("[a-z\xdf-\xf6\xf8-\xff]+")
# The tokenizer's own split, for lower-case ASCII.
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
# The tokenizer's model reads each byte above 0x7F as one character: those of Latin-1 letters' UTF-8 as they
# are from 0xA1 on (0xAD apart), the others numbered from U+0100 after the 33 control bytes and the blank.
_SHIFTED = [*range(0x21), *range(0x7F, 0xA1), 0xAD]
_BYTES = {
    c: "".join(
        chr(0x100 + _SHIFTED.index(b)) if b in _SHIFTED else chr(b) for b in chr(c).encode()
    )
    for c in range(0x80, 0x100)
}
_STOP = re.compile("([.,])(?<=[a-z\xdf-\xf6\xf8-\xff].)(?=[ \t\r\n]|\\Z)")


def _spread(text: str) -> str:
    """Latin-1 texts in lower case with stops set apart; others as they are."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return _STOP.sub(r" \1", text.lower())


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end: int, with_ids: bool) -> DataFrame:
    """A row for each piece; ``place`` numbers the pieces of a block that have the same length."""

    def cut(batches):
        encode = Encoder(tokenizer, end)
        block, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for part in slices(batches, 1, CHUNK_BYTES):
            keys = part.column(0).to_pylist()
            ids, ends = encode(part.column(1).to_pylist())
            sizes = np.diff(ends, prepend=0)
            number = -(-sizes // capacity)
            owner = np.repeat(np.arange(len(keys)), number)
            piece = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
            start = piece * capacity
            length = np.minimum(sizes[owner] - start, capacity)
            begin = ends[owner] - sizes[owner] + start
            raw = ids.astype("<u4").tobytes()
            cut_ids = [raw[4 * a : 4 * (a + n)] for a, n in zip(begin.tolist(), length.tolist())]
            order = np.argsort(length, kind="stable")
            ordered = length[order]
            run = np.arange(len(ordered)) - np.searchsorted(ordered, ordered)
            place = np.empty(len(length), np.int64)
            place[order] = seen[ordered] + run
            seen += np.bincount(length, minlength=capacity + 1)
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array(np.full(len(owner), block, np.int64)),
                    "doc_id": pa.array([keys[i] for i in owner.tolist()], pa.int64()),
                    "piece": pa.array(piece.astype(np.int32)),
                    "start": pa.array(start),
                    "length": pa.array(length),
                    "ids_crc32": pa.array([zlib.crc32(x) for x in cut_ids], pa.int64()),
                    "ids": pa.array(cut_ids if with_ids else [None] * len(owner), pa.binary()),
                    "place": pa.array(place),
                }
            )

    return docs.mapInArrow(cut, PIECES)


def dearest(prices: np.ndarray, capacity: int) -> dict[int, int]:
    """The configuration of the highest total price: an unbounded knapsack. ``prices[n - 1]`` is that of
    length n, minus infinity where there is none."""
    best = np.zeros(capacity + 1)
    reverse = prices[::-1]
    for room in range(1, capacity + 1):
        value = (best[:room] + reverse[capacity - room :]).max()
        best[room] = value if value > best[room - 1] else best[room - 1]
    taken: dict[int, int] = defaultdict(int)
    room = capacity
    while room and best[room] > 0:
        if best[room] == best[room - 1]:
            room -= 1
            continue
        left = int(np.argmax(best[:room] + reverse[capacity - room :]))
        taken[room - left] += 1
        room = left
    return dict(taken)


def configurations(
    demand: np.ndarray, capacity: int, rounds: int = ROUNDS
) -> list[tuple[dict[int, int], int]]:
    """Configurations (length -> copies) with how often each is used; together exactly the demand.

    ``demand[n]`` is the number of pieces of length n.
    """
    left = demand.astype(np.int64).copy()
    used: list[tuple[dict[int, int], int]] = []
    if left[capacity]:
        used.append(({capacity: 1}, int(left[capacity])))
        left[capacity] = 0
    lengths = np.arange(capacity + 1)
    whole = np.maximum(demand, 1)
    for _ in range(rounds):
        if not left.any():
            break
        prices = np.where(left > 0, lengths * np.exp(ETA * left / whole), -np.inf)
        taken = dearest(prices[1:], capacity)
        taken = {n: min(copies, int(left[n])) for n, copies in taken.items()}
        most = min(int(left[n]) // copies for n, copies in taken.items())
        times = max(1, most // 2)
        used.append((taken, times))
        for n, copies in taken.items():
            left[n] -= copies * times
    return used + _best_fit(left, capacity)


def _best_fit(left: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Longest first, each into the fullest sequence that has room; equal sequences are kept as one."""
    open_by_room: dict[int, list[tuple[dict[int, int], int]]] = defaultdict(list)
    for n in range(capacity, 0, -1):
        todo = int(left[n])
        while todo:
            room = next((r for r in range(n, capacity) if open_by_room.get(r)), capacity)
            if room == capacity:
                each = min(capacity // n, todo)
                times = todo // each
                open_by_room[capacity - each * n].append(({n: each}, times))
                todo -= each * times
                continue
            taken, times = open_by_room[room].pop()
            each = min(room // n, todo)
            now = min(times, todo // each)
            open_by_room[room - each * n].append((taken | {n: taken.get(n, 0) + each}, now))
            if times > now:
                open_by_room[room].append((taken, times - now))
            todo -= each * now
    return [entry for entries in open_by_room.values() for entry in entries]


def _plan(used: list[tuple[dict[int, int], int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By (length, first rank): the first sequence of the range and the offset in each."""
    rank: dict[int, int] = defaultdict(int)
    rows, first = [], 0
    for taken, times in used:
        offset = 0
        for n, copies in sorted(taken.items(), reverse=True):
            for _ in range(copies):
                rows.append((n << 44 | rank[n], first, offset))
                rank[n] += times
                offset += n
        first += times
    rows.sort()
    keys, sequences, offsets = (np.array(x, np.int64) for x in zip(*rows)) if rows else [np.zeros(0, np.int64)] * 3
    return keys, sequences, offsets


def pack(
    frame: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end: int = 0,
    rounds: int = ROUNDS,
    with_ids: bool = False,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """A row for each piece of each document, with the sequence and the offset it is packed at.

    ``tokenizer`` is a file of the tokenizers library that every executor can read. A null or empty text is
    one piece that holds the end id. Rows with a null or repeated key are packed like any other; an empty
    table gives no row. Other columns of ``frame`` are not looked at. With ``with_ids`` the piece's ids are
    returned too, as little-endian unsigned 32-bit numbers.
    """
    cut = written(pieces(documents(frame, text, key), tokenizer, capacity, end, with_ids), "pieces")
    blocks = written(cut.groupBy("block", "length").agg(F.count("*").alias("n")), "lengths")
    counts = blocks.groupBy("length").agg(F.sum("n").alias("n")).collect()  # at most `capacity` rows
    demand = np.zeros(capacity + 1, np.int64)
    for row in counts:
        demand[row["length"]] = row["n"]
    keys, sequences, offsets = _plan(configurations(demand, capacity, rounds))

    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        "block", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier")
    )

    def place(batches):
        for batch in batches:
            length, earlier, own = (
                batch.column(name).to_numpy() for name in ("length", "earlier", "place")
            )
            rank = earlier + own
            wanted = length << 44 | rank
            at = np.searchsorted(keys, wanted, side="right") - 1
            made = {name: batch.column(name) for name in kept}
            made["sequence_id"] = pa.array(sequences[at] + wanted - keys[at])
            made["offset"] = pa.array(offsets[at])
            yield pa.RecordBatch.from_pydict(made)

    kept = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, "
    schema += ("ids binary, " if with_ids else "") + "sequence_id long, offset long"
    ranked = cut.join(starts, ["block", "length"]).select(*kept, "place", "earlier")
    return ranked.mapInArrow(place, schema)
