"""Suffix and common-prefix arrays of texts larger than memory, by induced sorting on disk.

The order of the suffixes at certain places (each smaller than its left neighbour's and its right one's, in
the usual sense of left-most smaller suffixes) gives that of all others: those larger than the suffix to their
right are found by one pass in ascending order, the smaller ones by one in descending order. In a pass each
suffix that is taken from a queue puts its left neighbour into it. The queue gives out symbols in order; it
keeps what belongs to one symbol, or one range of symbols, in order of arrival, in memory up to a bound
and on disk beyond it. The places themselves are sorted by naming the stretches between them with the same two
passes and by sorting the string of names in the same way, down to a string that fits into memory.

What travels is (place, common prefix): the length that a suffix shares with the one taken before it. A pushed
suffix shares one symbol more than the least of what was taken since the last push of its symbol. Lengths
are counted up to a bound ``cap``; suffixes alike to there are in no particular order.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np

FAN = 512
# A string of names this many times the queue's bound is sorted in memory, without queues.
IN_MEMORY = 1
# Places that one step of a pass over the text or the starts works on, beside the bound of memory.
STEP = 1 << 16
_MANY = np.int32(1 << 30)
Block = tuple[np.ndarray, np.ndarray]


class Queue:
    """Items (place, common prefix) by symbol, smallest symbol first, in order of arrival within it."""

    def __init__(self, folder: str, low: int, high: int, memory: int):
        self.folder, self.low, self.high, self.memory = folder, low, high, memory
        self.width = -(-(high - low) // FAN)
        number = -(-(high - low) // self.width)
        self.buffers: list[list] = [[] for _ in range(number)]
        self.files: list[str | None] = [None] * number
        self.size = np.zeros(number, np.int64)
        self.buffered = 0
        self.children: dict[int, Queue] = {}

    def push(self, symbols: np.ndarray, places: np.ndarray, shared: np.ndarray) -> None:
        bucket = (symbols - self.low) // self.width
        order = np.argsort(bucket.astype(np.uint16), kind="stable")  # numbers below FAN, sorted by radix
        bucket, symbols, places, shared = bucket[order], symbols[order], places[order], shared[order]
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), len(bucket)]):
            if first == last:
                continue
            number = int(bucket[first])
            part = symbols[first:last], places[first:last], shared[first:last]
            if number in self.children:
                self.children[number].push(*part)
                continue
            self.buffers[number].append(part)
            self.size[number] += last - first
            self.buffered += last - first
        if self.buffered > self.memory:
            self._spill()

    def _spill(self) -> None:
        for number, parts in enumerate(self.buffers):
            if parts:
                if self.files[number] is None:
                    handle, self.files[number] = tempfile.mkstemp(dir=self.folder)
                    os.close(handle)
                with open(self.files[number], "ab") as out:
                    for symbols, places, shared in parts:
                        rows = np.empty(len(places), _ROW)
                        rows["s"], rows["p"], rows["l"] = symbols, places, shared
                        rows.tofile(out)
                self.buffers[number] = []
        self.buffered = 0

    def _take(self, number: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """What a bucket holds now; what is pushed meanwhile is kept for the next call."""
        path, parts = self.files[number], self.buffers[number]
        self.files[number], self.buffers[number] = None, []
        self.buffered -= sum(len(part[1]) for part in parts)
        self.size[number] = 0
        if path is not None:
            with open(path, "rb") as source:
                while len(rows := np.fromfile(source, _ROW, self.memory)):
                    yield rows["s"].copy(), rows["p"].copy(), rows["l"].copy()
            os.unlink(path)
        if parts:
            yield tuple(np.concatenate(column) for column in zip(*parts))

    def smallest(self) -> int | None:
        """The smallest symbol that has items."""
        while True:
            filled = np.flatnonzero(self.size)
            number = min([*filled[:1].tolist(), *self.children], default=None)
            if number is None:
                return None
            if self.width == 1:
                return self.low + number
            if number not in self.children:
                low = self.low + number * self.width
                child = Queue(self.folder, low, min(low + self.width, self.high), self.memory)
                for part in self._take(number):
                    child.push(*part)
                self.children[number] = child
            found = self.children[number].smallest()
            if found is not None:
                return found
            del self.children[number]

    def generation(self, symbol: int) -> Iterator[Block]:
        """The items of the smallest symbol so far, in blocks; those it gets meanwhile are left."""
        number = (symbol - self.low) // self.width
        if number in self.children:
            yield from self.children[number].generation(symbol)
        else:
            for _, places, shared in self._take(number):
                yield places, shared

    def has(self, symbol: int) -> bool:
        return self.smallest() == symbol


_ROW = np.dtype([("s", "<i8"), ("p", "<i8"), ("l", "<i4")])


class _Least:
    """For each symbol, the least common prefix taken since its last push; anew for each taken symbol."""

    def __init__(self):
        self.symbols, self.values = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def pushed(self, shared: np.ndarray, at: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Common prefixes, without the new symbol, of the pushes made at places ``at`` of a block."""
        n = len(shared)
        short = symbols.max(initial=0) < 1 << 16  # sorted by radix
        order = np.argsort(symbols.astype(np.uint16) if short else symbols, kind="stable")
        ordered, places = symbols[order], at[order]
        first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        last = np.concatenate([first[1:], [True]])
        begin = np.where(first, 0, np.concatenate([[0], places[:-1] + 1]))
        value = _range_least(shared, begin, places)
        heads = ordered[first]
        before = np.zeros(len(heads), np.int32)  # not pushed since this symbol began: nothing is shared
        slot = np.searchsorted(self.symbols, heads)
        slot_ok = slot < len(self.symbols)
        hit = np.zeros(len(heads), bool)
        hit[slot_ok] = self.symbols[slot[slot_ok]] == heads[slot_ok]
        before[hit] = self.values[slot[hit]]
        value[first] = np.minimum(value[first], before)
        # What is left of the block after the last push of each symbol.
        tail = np.full(len(heads), _MANY, np.int32)
        ends = places[last]
        rest = ends < n - 1
        if rest.any():
            tail[rest] = _range_least(shared, ends[rest] + 1, np.full(rest.sum(), n - 1))
        if len(self.symbols):
            keep = np.ones(len(self.symbols), bool)
            keep[slot[hit]] = False
            old, old_values = self.symbols[keep], np.minimum(self.values[keep], shared.min())
            both = np.concatenate([old, heads])
            sort = np.argsort(both, kind="stable")
            self.symbols = both[sort]
            self.values = np.concatenate([old_values, tail])[sort]
        else:
            self.symbols, self.values = heads, tail
        out = np.empty(len(at), np.int32)
        out[order] = value
        return out

    def passed(self, shared: np.ndarray) -> None:
        if len(self.values):
            self.values = np.minimum(self.values, shared.min())


def _range_least(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Least value of each range, ends included."""
    span = end - begin + 1
    level = np.frexp(span.astype(np.float64))[1] - 1
    out = np.empty(len(begin), np.int32)
    table, size = values.astype(np.int32), 1
    for current in range(int(level.max()) + 1 if len(level) else 0):
        chosen = level == current
        if chosen.any():
            out[chosen] = np.minimum(table[begin[chosen]], table[end[chosen] - size + 1])
        table, size = np.minimum(table[:-size], table[size:]), size * 2
    return out


class Sorter:
    """Sorts the suffixes of one string of symbols 0 .. ``symbols`` - 1, an array or a memory map."""

    def __init__(self, text: np.ndarray, symbols: int, cap: int, memory: int, folder: str):
        self.text, self.symbols, self.cap, self.memory, self.folder = text, symbols, cap, memory, folder
        self.n = len(text)
        # Whether common prefixes are wanted; names need only the order.
        self.sharing = True
        self.small = self._types()
        self.starts = self._starts()

    def _array(self, size: int, kind) -> np.ndarray:
        """An array in memory or, beyond the bound, on disk."""
        if size <= self.memory:
            return np.zeros(size, kind)
        handle, path = tempfile.mkstemp(dir=self.folder)
        os.close(handle)
        out = np.memmap(path, kind, "w+", shape=(size,))
        os.unlink(path)
        return out

    def _step(self) -> int:
        return min(STEP, max(1024, self.memory))

    def _types(self) -> np.ndarray:
        """Whether each suffix is smaller than the one to its right; the last one isn't."""
        small, block = self._array(self.n, bool), self._step()
        carry, right = False, None
        for last in range(self.n, 0, -block):
            first = max(0, last - block)
            part = np.asarray(self.text[first:last]).astype(np.int64)
            after = np.concatenate([part[1:], [part[-1] + (0 if right is None else np.sign(right - part[-1]))]])
            sign = np.sign(after - part)
            if right is None:
                sign[-1] = -1
            # Equal neighbours are of the same kind, so the next unequal place decides.
            at = np.where(sign != 0, np.arange(len(part)), len(part))
            at = np.minimum.accumulate(at[::-1])[::-1]
            known = at < len(part)
            out = np.full(len(part), carry)
            out[known] = sign[at[known]] > 0
            small[first:last] = out
            carry, right = bool(out[0]), int(part[0])
        return small

    def _starts(self) -> np.ndarray:
        block, count = self._step(), 0
        for pass_ in range(2):
            out = self._array(count, np.int64) if pass_ else None
            done = 0
            for first in range(1, self.n, block):
                last = min(self.n, first + block)
                here, left = self.small[first:last], self.small[first - 1 : last - 1]
                found = np.flatnonzero(here & ~left) + first
                if pass_:
                    out[done : done + len(found)] = found
                done += len(found)
            count = done
        return out

    def _left(self, places: np.ndarray, shared: np.ndarray, small: bool, least: _Least, queue: Queue, flip: bool):
        """Pushes the left neighbours, of the given kind, of what was taken."""
        before = places - 1
        chosen = np.flatnonzero(before >= 0)
        chosen = chosen[self.small[before[chosen]] == small]
        if not len(chosen):
            least.passed(shared)
            return
        places = before[chosen]
        symbols = self.text[places].astype(np.int64)
        keys = self.symbols - 1 - symbols if flip else symbols
        if self.sharing:
            value = np.minimum(least.pushed(shared, chosen, keys) + 1, self.cap).astype(np.int32)
        else:
            value = np.zeros(len(places), np.int32)
        queue.push(keys, places, value)

    def _seam(self, a: int, b: int) -> int:
        """The common prefix of two suffixes, by looking."""
        size = min(self.cap, self.n - max(a, b))
        differ = np.flatnonzero(self.text[a : a + size] != self.text[b : b + size])
        return int(differ[0]) if len(differ) else size

    def _ascending(self, seeds: Queue, keep) -> None:
        """Finds the larger-than-right suffixes in order; ``keep`` gets (symbol, places, shared)."""
        queue = Queue(self.folder, 0, self.symbols, self.memory)
        least = _Least()
        self._left(np.array([self.n]), np.zeros(1, np.int32), False, least, queue, False)
        while True:
            symbols = [s for s in (queue.smallest(), seeds.smallest()) if s is not None]
            if not symbols:
                return
            symbol, least, last = min(symbols), _Least(), None
            while queue.has(symbol):
                for places, shared in queue.generation(symbol):
                    if last is None:
                        shared[0] = 0
                    last = int(places[-1])
                    keep(symbol, places, shared)
                    self._left(places, shared, False, least, queue, False)
            if seeds.has(symbol):
                fresh = True
                for places, shared in seeds.generation(symbol):
                    if fresh:
                        shared[0] = 0 if last is None else self._seam(last, int(places[0]))
                        fresh = False
                    self._left(places, shared, False, least, queue, False)

    def _descending(self, larger: _Runs) -> Iterator[Block]:
        """All suffixes, largest first, each with what it shares with the one before."""
        queue = Queue(self.folder, 0, self.symbols, self.memory)
        while True:
            key = queue.smallest()
            symbols = [s for s in (None if key is None else self.symbols - 1 - key, larger.symbol()) if s is not None]
            if not symbols:
                return
            symbol, least, last = max(symbols), _Least(), None
            key = self.symbols - 1 - symbol
            while queue.has(key):
                for places, shared in queue.generation(key):
                    if last is None:
                        shared[0] = 0
                    last = int(places[-1])
                    yield places, shared
                    self._left(places, shared, True, least, queue, True)
            if larger.symbol() == symbol:
                fresh = True
                for places, shared in larger.take():
                    if fresh:
                        shared[0] = 0 if last is None else self._seam(last, int(places[0]))
                        fresh = False
                    yield places, shared
                    self._left(places, shared, True, least, queue, True)

    def _induced(self, places: Iterator[np.ndarray], shared: Iterator[np.ndarray]) -> Iterator[Block]:
        seeds = Queue(self.folder, 0, self.symbols, self.memory)
        for some, common in zip(places, shared):
            seeds.push(self.text[some].astype(np.int64), np.asarray(some), np.asarray(common))
        larger = _Runs(self.folder, self.memory)
        self._ascending(seeds, larger.add)
        larger.close()
        yield from self._descending(larger)

    def _blocks(self, size: int) -> Iterator[slice]:
        step = self._step()
        return (slice(i, min(size, i + step)) for i in range(0, size, step))

    def suffixes(self) -> Iterator[Block]:
        """(places, shared) in blocks, largest suffix first; ``shared`` is with the suffix before."""
        number = len(self.starts)
        order, shared = self._array(number, np.int64), self._array(number, np.int32)
        if number:
            names, count = self._named()
            if number <= IN_MEMORY * self.memory:
                found = _doubled(np.asarray(names), self.cap // 2 + 2)
                order[:], shared[:] = found
            else:
                done = number
                inner = Sorter(names, count, self.cap // 2 + 2, self.memory, self.folder)
                for places, common in inner.suffixes():  # descending, so filled from the end
                    done -= len(places)
                    order[done : done + len(places)] = places[::-1]
                    # What a name shares with its larger neighbour becomes that one's share with it.
                    moved = np.concatenate([common[1:], [0]])[::-1]
                    shared[done : done + len(places)] = moved
                    if done + len(places) < number:
                        shared[done + len(places)] = common[0]
        for part in self._blocks(number):
            shared[part] = self._in_symbols(order, shared, part)
        yield from self._induced(
            (self.starts[np.asarray(order[part])] for part in self._blocks(number)),
            (shared[part] for part in self._blocks(number)),
        )

    def _named(self) -> tuple[np.ndarray, int]:
        """A name for each stretch between starts, in their order, and the number of names."""
        number = len(self.starts)
        names = self._array(number, np.int64)
        # The number of the start at each place, counted from 1.
        slot = self._array(self.n, np.int32 if number < 1 << 31 else np.int64)
        for part in self._blocks(number):
            slot[self.starts[part]] = np.arange(part.start, part.stop) + 1
        zeros = (np.zeros(part.stop - part.start, np.int32) for part in self._blocks(number))
        self.sharing = False
        found = self._induced((self.starts[part] for part in self._blocks(number)), zeros)
        last, name = None, 0
        for places, _ in found:
            at = np.asarray(slot[places]).astype(np.int64)
            at = at[at > 0] - 1
            if not len(at):
                continue
            chain = at if last is None else np.concatenate([[last], at])
            fresh = np.concatenate([[0] if last is None else [], ~self._same(chain[:-1], chain[1:])]).astype(np.int64)
            own = name + np.cumsum(fresh)
            names[at] = own
            name, last = int(own[-1]), int(at[-1])
        self.sharing = True
        for part in self._blocks(number):  # names were given from the largest on
            names[part] = name - names[part]
        return names, name + 1

    def _end(self, starts: np.ndarray) -> np.ndarray:
        after = np.minimum(starts + 1, len(self.starts) - 1)
        return np.where(starts + 1 < len(self.starts), self.starts[after], self.n)

    def _same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the stretches from two starts to the next ones are equal, the next start's symbol included."""
        parts = [self._alike(a[part], b[part]) for part in self._blocks(len(a))]
        return np.concatenate(parts) if parts else np.zeros(0, bool)

    def _alike(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        pa, pb = self.starts[a], self.starts[b]
        size, other = self._end(a) - pa, self._end(b) - pb
        same = (size == other) & (pa + size < self.n) & (pb + size < self.n)
        live = np.flatnonzero(same)
        done, width = 0, 8
        while len(live):
            steps = np.arange(done, done + width)
            x = np.minimum(pa[live][:, None] + steps, self.n - 1)
            y = np.minimum(pb[live][:, None] + steps, self.n - 1)
            equal = (self.text[x] == self.text[y]) | (steps > size[live][:, None])
            equal = equal.all(axis=1)
            same[live[~equal]] = False
            done += width
            live = live[equal & (size[live] >= done)]
            width = min(4 * width, max(8, self._step() * 8 // max(1, len(live))))
        return same

    def _in_symbols(self, order: np.ndarray, shared: np.ndarray, part: slice) -> np.ndarray:
        """Common prefixes in symbols of neighbouring starts, from those in names."""
        own = np.asarray(order[part])
        before = np.concatenate([[order[part.start - 1] if part.start else own[0]], own[:-1]])
        whole = np.asarray(shared[part]).astype(np.int64)
        whole = np.minimum(whole, len(self.starts) - 1 - np.maximum(own, before))
        done = self.starts[own + whole] - self.starts[own]
        a, b = self.starts[own + whole], self.starts[before + whole]
        out = np.minimum(done, self.cap)
        live = np.flatnonzero((out < self.cap) & (own != before))
        offset = np.zeros(len(own), np.int64)
        width = 8
        while len(live):
            steps = offset[live][:, None] + np.arange(width)
            x, y = a[live][:, None] + steps, b[live][:, None] + steps
            inside = (x < self.n) & (y < self.n)
            equal = inside & (self.text[np.minimum(x, self.n - 1)] == self.text[np.minimum(y, self.n - 1)])
            run = np.where(equal.all(axis=1), width, np.argmin(equal, axis=1))
            out[live] += run
            offset[live] += width
            live = live[(run == width) & (out[live] < self.cap)]
        if part.start == 0 and len(out):
            out[0] = 0
        return np.minimum(out, self.cap).astype(np.int32)


class _Runs:
    """Items written in ascending order of symbols, read back from the end."""

    def __init__(self, folder: str, memory: int):
        self.memory, self.counts, self.total = memory, [], 0
        handle, self.path = tempfile.mkstemp(dir=folder)
        self.file = os.fdopen(handle, "wb")

    def add(self, symbol: int, places: np.ndarray, shared: np.ndarray) -> None:
        rows = np.empty(len(places), _PAIR)
        rows["p"], rows["l"] = places, shared
        rows.tofile(self.file)
        if self.counts and self.counts[-1][0] == symbol:
            self.counts[-1][1] += len(places)
        else:
            self.counts.append([symbol, len(places)])
        self.total += len(places)

    def close(self) -> None:
        self.file.close()
        self.file = open(self.path, "rb")
        os.unlink(self.path)

    def symbol(self) -> int | None:
        return self.counts[-1][0] if self.counts else None

    def take(self) -> Iterator[Block]:
        """The last symbol's items, last first; each shares with the one before it here."""
        _, count = self.counts.pop()
        last, after = self.total, 0
        self.total -= count
        while last > self.total:
            first = max(self.total, last - max(1024, self.memory))
            self.file.seek(first * _PAIR.itemsize)
            rows = np.fromfile(self.file, _PAIR, last - first)[::-1]
            own = rows["l"]
            yield rows["p"].copy(), np.concatenate([[after], own[:-1]]).astype(np.int32)
            after, last = int(own[-1]), first


_PAIR = np.dtype([("p", "<i8"), ("l", "<i4")])


def _doubled(names: np.ndarray, cap: int) -> Block:
    """Order and common prefixes of the suffixes of a string in memory, by doubling; prefixes up to ``cap``."""
    n = len(names)
    order = np.argsort(names, kind="stable")
    ordered = names[order]
    fresh = np.concatenate([np.ones(min(n, 1), bool), ordered[1:] != ordered[:-1]])
    # A rank is the place of its first suffix in the order; those alone in their rank need no further sorting.
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0)) + 1
    ranks, size = [rank.astype(np.int32)], 1
    while not fresh.all() and size < cap:
        at = np.flatnonzero(~fresh | np.append(~fresh[1:], False))
        live = order[at]
        second = np.zeros(len(live), np.int64)
        inside = live < n - size
        second[inside] = rank[live[inside] + size]
        key = rank[live] * (n + 1) + second
        sort = np.argsort(key, kind="stable")
        live, ordered = live[sort], key[sort]
        order[at] = live
        fresh[at[1:]] |= ordered[1:] != ordered[:-1]
        rank[live] = np.maximum.accumulate(np.where(fresh[at], at, 0)) + 1
        ranks.append(rank.astype(np.int32))
        size *= 2
    before = np.concatenate([order[:1], order[:-1]])
    shared = np.zeros(n, np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        a, b = order + shared, before + shared
        inside = (a < n) & (b < n)
        same = np.zeros(n, bool)
        same[inside] = ranks[level][a[inside]] == ranks[level][b[inside]]
        # Equal ranks at the end of the string stand for fewer names than the level has.
        same &= np.maximum(a, b) + (1 << level) <= n
        shared += np.where(same, 1 << level, 0)
    if n:
        shared[0] = 0
    return order, np.minimum(shared, cap).astype(np.int32)
