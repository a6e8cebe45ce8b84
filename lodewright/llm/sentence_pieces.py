"""Encoding and decoding with the pieces of a SentencePiece model.

A text is normalised (blanks become U+2581, one is put before it) and cut where no piece reaches across; each
distinct word is encoded once. Words of one length advance together: at every place the substrings that end
there are looked up by hash among the sorted keys of the pieces, all words at once, and the best of them by
the model's rule is kept as a backpointer.

Rule of a unigram model: the greatest sum of scores. Rule of a merge (BPE) model: the only piece that may end a
merged word there, which is one that the piece before it tolerates: undoing the two pieces' merges from the last
on, no merge across their border comes before the merges it would break up. So one pass gives what the merges
give, without doing them one by one. What has no piece becomes its bytes' pieces, or the unknown piece.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodewright.llm.tables import slices

BLANK = "▁"
# Words, and ids of them, that a worker remembers.
CACHED_WORDS = 400_000
CACHED_IDS = 4_000_000
# Bytes of texts that are encoded at once.
CHUNK_BYTES = 2 << 20
# Words of one length times their characters that advance together.
CELLS = 1 << 20
# A word of more characters advances by itself; characters of it that are looked up at once.
LONG = 256
PART = 1 << 16
# Pairs of pieces whose verdict is remembered for long words.
CACHED_PAIRS = 1 << 20
# Places, as a power of two, for verdicts on pairs of pieces.
TABLE_BITS = 20
# What a character without piece costs below the least score, for unigram models.
UNKNOWN_COST = 10.0

_ODD = np.uint64(0x9E3779B97F4A7C15)
_UNDER = pow(int(_ODD), -1, 1 << 64)


def _powers(base: int, size: int) -> np.ndarray:
    """base ** 0 .. base ** (size - 1), modulo 2 ** 64."""
    out = np.ones(size, np.uint64)
    out[1:] = base
    with np.errstate(over="ignore"):
        return np.cumprod(out)


def _hashed(codes: np.ndarray) -> np.ndarray:
    """Running hashes along the rows: column j is that of the first j characters, each times _ODD plus the next."""
    out = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
    size = codes.shape[1]
    with np.errstate(over="ignore"):
        summed = np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * _powers(_UNDER, size), axis=1, dtype=np.uint64)
        out[:, 1:] = summed * _powers(int(_ODD), size)
    return out


class Pieces:
    """The pieces of a model file, with what is needed to encode and decode."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        number = model.get_piece_size()
        self.text = [model.id_to_piece(i) for i in range(number)]
        self.score = np.array([model.get_score(i) for i in range(number)])
        self.unknown = model.unk_id()
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(number)]
        self.control = np.array(special)
        self.byte = np.full(256, -1, np.int64)
        self.of_byte = np.full(number, -1, np.int64)
        for i in range(number):
            if model.is_byte(i):
                value = int(self.text[i][3:5], 16)
                self.byte[value], self.of_byte[i] = i, value
        usable = [i for i in range(number) if not special[i] and self.of_byte[i] < 0]
        self.longest = max(len(self.text[i]) for i in usable)
        with np.errstate(over="ignore"):
            self.powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(self.longest, _ODD)]))
        keys = np.array([self._key(self.text[i]) for i in usable], np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(usable)[order]
        # A piece that scores are ranks of: merge models score by minus the order of the merges.
        self.merges = _is_merge_model(path)
        if self.merges:
            self._undo(usable)
        inner = {c for i in usable if len(self.text[i]) > 1 for c in self.text[i]}
        self.joined = any(BLANK in self.text[i].lstrip(BLANK) for i in usable)
        # Words end before blanks, and around characters that no longer piece has.
        self.inner = "".join(sorted(inner))
        known = "".join(re.escape(c) for c in sorted(inner - {BLANK}))
        self.cut = re.compile(f"{BLANK}*[{known}]+|{BLANK}+|.", re.S)
        self.known: dict[str, int] = {}
        self._forget()
        self.side: dict[tuple[int, int], bool] = {}
        shown = [b"" if special[i] else self.text[i].replace(BLANK, " ").encode() for i in range(number)]
        for i in np.flatnonzero(self.of_byte >= 0).tolist():
            shown[i] = bytes([self.of_byte[i]])
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.shown_size = np.array([len(x) for x in shown])
        self.shown_at = np.cumsum(self.shown_size) - self.shown_size

    def _key(self, text: str) -> np.uint64:
        return _hashed(_codes([text]))[0, -1]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The piece of each key, -1 where there is none."""
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ids[at], -1)

    def _undo(self, usable: list[int]) -> None:
        """For each piece the two that its last merge joins; itself twice if it is one character."""
        number = len(self.text)
        self.rank = np.argsort(np.argsort(-self.score, kind="stable"), kind="stable")
        self.left, self.right = np.arange(number), np.arange(number)
        self.reachable = np.zeros(number, bool)
        place = {self.text[i]: i for i in usable}
        for i in usable:
            parts = _merged(self.text[i], place, self.rank)
            self.reachable[i] = len(parts) == 1
            if len(parts) == 1 and len(self.text[i]) > 1:
                two = _merged(self.text[i], place, self.rank, stop=i)
                self.left[i], self.right[i] = place[two[0]], place[two[1]]
        pair = self.left * np.int64(number) + self.right
        merged = np.array([i for i in usable if self.left[i] != i])
        order = np.argsort(pair[merged])
        self.pair_at, self.verdict = np.zeros(0, np.int64), np.zeros(0, bool)
        self.pairs, self.pair_ids = pair[merged][order], merged[order]
        left, right = self.left.tolist(), self.right.tolist()
        self.undo = left, right, self.rank.tolist(), {(left[i], right[i]): i for i in merged.tolist()}

    def remembered(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """``tolerates``, which is asked only for pairs that don't stand in their place of a table."""
        pair = first * np.int64(len(self.text)) + second
        with np.errstate(over="ignore"):
            spot = (pair.astype(np.uint64) * _ODD >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        if not len(self.pair_at):
            self.pair_at, self.verdict = np.full(1 << TABLE_BITS, -1), np.zeros(1 << TABLE_BITS, bool)
        out = self.verdict[spot]
        new = np.flatnonzero(self.pair_at[spot] != pair)
        if len(new):
            out[new] = self.tolerates(first[new], second[new])
            # Of pairs with one place the last stays, with its own verdict: the table is read anew for both.
            self.pair_at[spot[new]] = pair[new]
            last = self.pair_at[spot[new]] == pair[new]
            self.verdict[spot[new[last]]] = out[new[last]]
        return out

    def tolerates(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether merging leaves the two pieces side by side."""
        first, second = first.copy(), second.copy()
        number, rank = np.int64(len(self.text)), self.rank * 2 + 1
        limit = np.full(len(first), np.iinfo(np.int64).max)
        out = np.ones(len(first), bool)
        live = np.arange(len(first))
        while len(live):
            a, b = first[live], second[live]
            at = np.minimum(np.searchsorted(self.pairs, a * number + b), len(self.pairs) - 1)
            joined = np.where(self.pairs[at] == a * number + b, self.pair_ids[at], -1)
            broken = (joined >= 0) & (rank[joined] < limit[live])
            out[live[broken]] = False
            whole_a, whole_b = self.left[a] == a, self.left[b] == b
            # Undo the later merge of the two; of one piece with itself at a border, the right one's.
            ra, rb = np.where(whole_a, -1, rank[a]), np.where(whole_b, -1, rank[b])
            undo_a = ra > rb
            first[live] = np.where(undo_a, self.right[a], a)
            second[live] = np.where(undo_a, b, self.left[b])
            limit[live] = np.where(undo_a, rank[a], rank[b] + 1)
            live = live[~broken & ~(whole_a & whole_b)]
        return out

    def words(self, words: list[str]) -> list[np.ndarray]:
        """The ids of each word; equal lengths advance together."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(words)
        sizes = np.array([len(word) for word in words])
        for size in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == size)
            if size > LONG:
                for i in rows.tolist():
                    out[i] = self._advance_alone(words[i])
                continue
            at_once = max(1, CELLS // (size + 1))
            for first in range(0, len(rows), at_once):
                part = rows[first : first + at_once].tolist()
                for i, ids in zip(part, self._advance([words[i] for i in part])):
                    out[i] = ids
        return out

    def _ending(self, hashes: np.ndarray, first: int, last: int):
        """For each place of a range, the pieces that end there as (take, piece), the shortest first."""
        ends, takes, found = [], [], []
        for take in range(1, self.longest + 1):
            end = np.arange(max(first, take), last)
            if not len(end):
                break
            with np.errstate(over="ignore"):
                own = self.find(hashes[end] - hashes[end - take] * self.powers[take])
            hit = own >= 0
            if self.merges and take > 1:
                hit &= self.reachable[own]
            ends.append(end[hit])
            takes.append(np.full(len(ends[-1]), take))
            found.append(own[hit])
        end, take, piece = (np.concatenate(x) for x in (ends, takes, found))
        order = np.argsort(end, kind="stable")
        cuts = np.searchsorted(end[order], np.arange(first, last + 1)).tolist()
        take, piece = take[order].tolist(), piece[order].tolist()
        return [list(zip(take[a:b], piece[a:b])) for a, b in zip(cuts[:-1], cuts[1:])]

    def _beside(self, first: int, second: int) -> bool:
        """``tolerates`` of one pair, remembered."""
        pair = first, second
        if pair in self.side:
            return self.side[pair]
        if len(self.side) >= CACHED_PAIRS:
            self.side.clear()
        left, right, rank, joins = self.undo
        limit, out = None, True
        while True:
            joined = joins.get((first, second))
            if joined is not None and (limit is None or 2 * rank[joined] + 1 < limit):
                out = False
                break
            whole, other = left[first] == first, left[second] == second
            if whole and other:
                break
            ra, rb = -1 if whole else 2 * rank[first] + 1, -1 if other else 2 * rank[second] + 1
            if ra > rb:
                first, limit = right[first], ra
            else:
                second, limit = left[second], rb + 1
        self.side[pair] = out
        return out

    def _advance_alone(self, word: str) -> np.ndarray:
        """The ids of one long word, by the same rule; places are looked up part by part."""
        size = len(word)
        hashes = _hashed(_codes([word]))[0]
        length, piece = np.zeros(size + 1, np.int16), np.full(size + 1, -1, np.int32)
        worst = float(self.score.min()) - UNKNOWN_COST
        recent, own_piece = [0.0], [-1]
        for first in range(1, size + 1, PART):
            last = min(size + 1, first + PART)
            # What the pieces that end in this part may begin after.
            keep = min(first, self.longest)
            value, before, base = recent[-keep:], own_piece[-keep:], first - keep
            for end, options in enumerate(self._ending(hashes, first, last), first):
                best, taken, chosen = -np.inf, 1, -1
                if self.merges:
                    best = 0.0
                    for take, own in reversed(options):
                        left = before[end - take - base]
                        if end == take or left < 0 or self._beside(left, own):
                            taken, chosen = take, own
                            break
                else:
                    for take, own in options:
                        score = value[end - take - base] + float(self.score[own])
                        if score > best:
                            best, taken, chosen = score, take, own
                    if value[-1] + worst > best:
                        best, taken, chosen = value[-1] + worst, 1, -1
                value.append(best)
                before.append(chosen)
                length[end], piece[end] = taken, chosen
            recent, own_piece = value, before
        return self._back(word, length, piece)

    def _back(self, word: str, length, piece) -> np.ndarray:
        """The ids along the backpointers."""
        ids, end = [], len(word)
        while end:
            take, own = int(length[end]), int(piece[end])
            if own >= 0:
                ids.append(own)
            else:
                ids += self._spelled(word[end - take : end])[::-1]
            end -= take
        return np.array(ids[::-1], np.int64)

    def _advance(self, words: list[str]) -> list[np.ndarray]:
        codes = _codes(words)
        number, size = codes.shape
        hashes = _hashed(codes)
        value = np.full((number, size + 1), -np.inf)
        value[:, 0] = 0
        length = np.zeros((number, size + 1), np.int64)
        piece = np.full((number, size + 1), -1, np.int64)
        worst = self.score.min() - UNKNOWN_COST
        for end in range(1, size + 1):
            if self.merges:
                self._merged_end(end, hashes, length, piece)
                continue
            for take in range(1, min(end, self.longest) + 1):
                begin = end - take
                with np.errstate(over="ignore"):
                    found = self.find(hashes[:, end] - hashes[:, begin] * self.powers[take])
                rows = np.flatnonzero(found >= 0)
                score = value[rows, begin] + self.score[found[rows]]
                better = score > value[rows, end]
                rows, score = rows[better], score[better]
                value[rows, end], length[rows, end], piece[rows, end] = score, take, found[rows]
            # A character that isn't a piece stands by itself.
            score = value[:, end - 1] + worst
            alone = np.flatnonzero(score > value[:, end])
            value[alone, end], length[alone, end], piece[alone, end] = score[alone], 1, -1
        return self._all_back(words, length, piece)

    def _merged_end(self, end: int, hashes: np.ndarray, length: np.ndarray, piece: np.ndarray) -> None:
        """The longest piece that ends here and that the piece before it tolerates, for all words at once."""
        open_ = np.arange(len(hashes))
        length[:, end] = 1  # a character without piece stands by itself
        for take in range(min(end, self.longest), 0, -1):
            begin = end - take
            with np.errstate(over="ignore"):
                found = self.find(hashes[open_, end] - hashes[open_, begin] * self.powers[take])
            hit = found >= 0
            if take > 1:
                hit &= self.reachable[found]
            at = np.flatnonzero(hit)
            if begin and len(at):
                before = piece[open_[at], begin]
                bound = before >= 0  # a character without piece never merges
                fits = ~bound
                fits[bound] = self.remembered(before[bound], found[at[bound]])
                at = at[fits]
            if len(at):
                rows = open_[at]
                length[rows, end], piece[rows, end] = take, found[at]
                open_ = np.delete(open_, at)
                if not len(open_):
                    return

    def _all_back(self, words: list[str], length: np.ndarray, piece: np.ndarray) -> list[np.ndarray]:
        """The ids of all words along their backpointers."""
        number, size = len(words), length.shape[1] - 1
        ids, count = np.full((number, size), -1, np.int64), np.zeros(number, np.int64)
        at, live, spelled = np.full(number, size), np.arange(number), np.zeros(number, bool)
        for step in range(size):
            own = piece[live, at[live]]
            ids[live, size - 1 - step] = own
            spelled[live[own < 0]] = True
            count[live] += 1
            at[live] -= length[live, at[live]]
            live = live[at[live] > 0]
            if not len(live):
                break
        return [
            self._back(words[row], length[row], piece[row]) if other else ids[row, size - own :]
            for row, (own, other) in enumerate(zip(count.tolist(), spelled.tolist()))
        ]

    def _spelled(self, text: str) -> list[int]:
        if (self.byte >= 0).all():
            return [int(self.byte[b]) for b in text.encode("utf-8", "surrogatepass")]
        return [self.unknown]

    def _forget(self) -> None:
        """Begins the store of known words anew: their ids lie one after the other."""
        self.known.clear()
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def _learn(self, words: list[str]) -> None:
        ids = self.words(words)
        sizes = np.array([len(x) for x in ids], np.int64)
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words))))
        self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(sizes) - sizes])
        self.size = np.concatenate([self.size, sizes])
        self.flat = np.concatenate([self.flat, *ids]).astype(np.int32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ends, ids): the ids of all texts one after the other, and where each text's end, after a first 0."""
        if len(self.known) > CACHED_WORDS or len(self.flat) > CACHED_IDS:
            self._forget()
        split = [self.cut.findall(BLANK + text.replace(" ", BLANK)) if text else [] for text in texts]
        new = {word for words in split for word in words}.difference(self.known)
        if new:
            self._learn(sorted(new))
        word = np.fromiter((self.known[w] for words in split for w in words), np.int64)
        ends = np.concatenate([[0], np.cumsum(self.size[word])])
        flat = self.flat[spread(self.begin[word], self.size[word])]
        return ends[np.cumsum([0, *map(len, split)])], flat

    def decode_all(self, ends: np.ndarray, ids: np.ndarray) -> pa.Array:
        """The texts of lists of ids that lie one after the other."""
        size = self.shown_size[ids]
        data = self.shown[spread(self.shown_at[ids], size)]
        cuts = np.concatenate([[0], np.cumsum(size)])[ends]
        begin, end = cuts[:-1], cuts[1:]
        # The blank that encoding put before a text goes.
        blank = (begin < end) & (data[np.minimum(begin, max(0, len(data) - 1))] == 32) if len(data) else begin < end
        kept = np.ones(len(data), bool)
        kept[begin[blank]] = False
        cuts = cuts - np.concatenate([[0], np.cumsum(blank)])
        data = data[kept].tobytes()
        try:
            if BLANK.encode() in data:
                raise ValueError
            buffers = [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data)]
            return pa.Array.from_buffers(pa.large_binary(), len(begin), buffers).cast(pa.large_string()).cast(pa.string())
        except ValueError:  # bytes that are no text, or spell a blank
            return pa.array([self.decode(ids[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())], pa.string())

    def decode(self, ids: np.ndarray) -> str:
        parts, held = [], bytearray()
        for i in ids.tolist():
            if self.of_byte[i] >= 0:
                held.append(int(self.of_byte[i]))
                continue
            if held:
                parts.append(held.decode("utf-8", "replace"))
                held = bytearray()
            if not self.control[i]:
                parts.append(self.text[i])
        if held:
            parts.append(held.decode("utf-8", "replace"))
        text = "".join(parts).replace(BLANK, " ")
        return text[1:] if text.startswith(" ") else text


def _codes(words: list[str]) -> np.ndarray:
    flat = "".join(words).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(flat, np.uint32).reshape(len(words), -1)


def _is_merge_model(path: str) -> bool:
    """Whether the file says that its model is one of merges: field 3 of the trainer's settings (field 2) is 2."""
    with open(path, "rb") as file:
        data = file.read()

    def fields(at: int, end: int):
        while at < end:
            tag, at = _number(data, at)
            kind = tag & 7
            if kind == 0:
                value, at = _number(data, at)
                yield tag >> 3, value, None
            elif kind == 2:
                size, at = _number(data, at)
                yield tag >> 3, at, at + size
                at += size
            else:
                at += 4 if kind == 5 else 8

    for name, begin, end in fields(0, len(data)):
        if name == 2 and end is not None:
            return any(field == 3 and value == 2 for field, value, inner in fields(begin, end) if inner is None)
    return False


def _number(data: bytes, at: int) -> tuple[int, int]:
    value, shift = 0, 0
    while True:
        value |= (data[at] & 127) << shift
        at, shift = at + 1, shift + 7
        if data[at - 1] < 128:
            return value, at


def _merged(text: str, place: dict[str, int], rank: np.ndarray, stop: int = -1) -> list[str]:
    """The text after all merges, the best first; or, before the merge into the piece ``stop``."""
    parts = list(text)
    while len(parts) > 1:
        best = min(
            ((rank[place[a + b]], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in place),
            default=None,
        )
        if best is None or (len(parts) == 2 and place[parts[0] + parts[1]] == stop):
            return parts
        i = best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


_HELD: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """The model of a file, read once by each worker."""
    if path not in _HELD:
        _HELD[path] = Pieces(path)
    return _HELD[path]


def spread(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places begin, begin + 1, ... of each stretch, one stretch after the other."""
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begin - (ends - size), size)


def _encoded(model: Pieces, batches):
    """(keys, ends, ids) of parts of the batches, each of some bytes or one text."""
    for part in slices(batches, 1, CHUNK_BYTES):
        yield part.column(0), *model.encode(part.column(1).to_pylist())


def _rows(frame: DataFrame, text: str, key: str) -> DataFrame:
    return frame.select(frame[key].alias("doc_id"), F.coalesce(frame[text], F.lit("")).alias("text"))


def encode(frame: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, ids) of every row; ``path`` is a model file that each executor can read.

    A null or empty text has no ids. Repeated rows are encoded alike, an empty table gives no rows, and other
    columns aren't looked at.
    """

    def run(batches):
        for keys, ends, ids in _encoded(pieces(path), batches):
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([keys, lists], ["doc_id", "ids"])

    return _rows(frame, text, key).mapInArrow(run, "doc_id long, ids array<int>")


_DECODED = "doc_id long, n_ids long, ids_crc32 long, text string"


def _decoded(model: Pieces, keys, ends: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    data, cuts = memoryview(ids.astype("<u4").tobytes()), ends.tolist()
    digests = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(cuts[:-1], cuts[1:])]
    return pa.RecordBatch.from_arrays(
        [keys, pa.array(np.diff(ends)), pa.array(digests, pa.int64()), model.decode_all(ends, ids)],
        ["doc_id", "n_ids", "ids_crc32", "text"],
    )


def decode(frame: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_ids, ids_crc32, text) of rows (doc_id, ids). Control pieces are left out; null ids are none.
    ``ids_crc32`` is that of the ids as little-endian unsigned 32-bit numbers."""

    def run(batches):
        model = pieces(path)
        for batch in batches:
            lists = pc.fill_null(batch.column(1), [])
            ends = lists.offsets.to_numpy().astype(np.int64)
            yield _decoded(model, batch.column(0), ends - ends[0], lists.flatten().to_numpy().astype(np.int64))

    return frame.select("doc_id", "ids").mapInArrow(run, _DECODED)


def round_trip(frame: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """What ``decode`` of ``encode`` gives, in one pass: the ids stay in the worker."""

    def run(batches):
        model = pieces(path)
        for keys, ends, ids in _encoded(model, batches):
            yield _decoded(model, keys, ends, ids)

    return _rows(frame, text, key).mapInArrow(run, _DECODED)
