"""Ranked lexical search, reversed: the items' terms are the index, and the documents stream through it.

Items are the queries. An inverted index from their terms to the items is broadcast, in blocks of a bounded number of
postings. A first pass over the documents counts the terms that the index holds, and what the weights need of all
documents; a second pass sends each document's counts through the postings and updates a bounded heap per item.
The heaps of all tasks are merged in two steps, so that no task merges those of all others at once.

The score of a document sums w * ((10^9 * tf) div (1000 * tf + 8 * m)) over the item's terms, repeats included:
w = floor(1000 * ln((2 N + 2) / (2 df + 1))) and m = 100 - 75 + (75 * n * N) div L, with N documents that have a term,
L terms in all of them, n in the document, df documents that hold the term and tf times it stands in the document.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodewright.llm.tables import documents, slices, written

KEPT = 10
# Postings (an item's distinct terms) that one block of the index holds, as expected over blocks by hash.
POSTINGS = 1 << 20
# Scores that a task holds at once: documents times items, and postings met by them.
CELLS = 1 << 21
# Groups of heaps that are merged before the last merge.
MERGES = 64
_NO_ID = np.iinfo(np.int64).max
# Terms are runs of ASCII letters and digits and of anything beyond ASCII; only A-Z are lower-cased.
_TERMS = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms(text: pa.Scalar) -> list[bytes]:
    return text.as_buffer().to_pybytes().translate(_TERMS).split()


def _postings(items: DataFrame) -> DataFrame:
    """(item, term, times): each item's distinct terms."""

    def count(batches):
        for batch in slices(batches, 1):
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = pa.array(terms(text), pa.binary()).value_counts()
                if len(found):
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(item, len(found)), found.field("values"), found.field("counts")],
                        ["item", "term", "times"],
                    )

    return items.select("item", "text").mapInArrow(count, "item long, term binary, times long")


class Index:
    """The postings of a block of items: for each term, the places of its items and how often each has it."""

    def __init__(self, postings: pa.Table):
        items = postings.column("item").combine_chunks().to_numpy(zero_copy_only=False)
        coded = postings.column("term").combine_chunks().dictionary_encode()
        self.code = {term: i for i, term in enumerate(coded.dictionary.to_pylist())}
        codes = coded.indices.to_numpy(zero_copy_only=False)
        self.items, place = np.unique(items, return_inverse=True)
        order = np.argsort(codes, kind="stable")
        self.place = place[order]
        self.times = postings.column("times").combine_chunks().to_numpy(zero_copy_only=False)[order]
        self.ends = np.searchsorted(codes[order], np.arange(len(self.code)), side="right")
        self.sizes = np.diff(self.ends, prepend=0)
        self.repeats = np.bincount(codes, postings.column("times").to_numpy(), len(self.code))


def _counted(docs: DataFrame, index) -> DataFrame:
    """(doc_id, n, codes, times) of documents with terms: n terms in all, and the counts of those in the index."""

    def count(batches):
        code = index.value.code
        for batch in slices(batches, 1):
            sizes, owners, codes = [], [], []
            for row, text in enumerate(batch.column(1)):
                words = terms(text)
                sizes.append(len(words))
                known = [c for c in map(code.get, words) if c is not None]
                codes.append(np.array(known, np.int64))
                owners.append(len(known))
            pairs = np.repeat(np.arange(len(sizes)), owners) * max(1, len(code)) + np.concatenate(codes)
            pairs, times = np.unique(pairs, return_counts=True)
            cuts = np.searchsorted(pairs, np.arange(len(sizes) + 1) * max(1, len(code)))
            codes = (pairs % max(1, len(code))).astype("<i4")
            times = times.astype("<i8")
            worded = [i for i, n in enumerate(sizes) if n]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(worded, pa.int64())),
                    pa.array([sizes[i] for i in worded], pa.int64()),
                    pa.array([codes[cuts[i] : cuts[i + 1]].tobytes() for i in worded], pa.binary()),
                    pa.array([times[cuts[i] : cuts[i + 1]].tobytes() for i in worded], pa.binary()),
                ],
                ["doc_id", "n", "codes", "times"],
            )

    return docs.mapInArrow(count, "doc_id long, n long, codes binary, times binary")


def _statistics(counted: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Documents with terms, terms in all of them, and documents that hold each term of the index."""

    def add(batches):
        held = np.zeros(size + 2, np.int64)
        for batch in batches:
            held[size] += batch.num_rows
            held[size + 1] += pc.sum(batch.column(0)).as_py() or 0
            codes = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<i4")
            held[:size] += np.bincount(codes, minlength=size)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], ["code", "number"])

    parts = counted.select("n", "codes").mapInArrow(add, "code long, number long")
    found = parts.groupBy("code").agg(F.sum("number").alias("number")).toArrow()
    held = np.zeros(size + 2, np.int64)
    held[found.column("code").to_numpy()] = found.column("number").to_numpy()
    return int(held[size]), int(held[size + 1]), held[:size]


class Heaps:
    """Of each item the best documents so far, best first: by score, then by id, null ids last."""

    def __init__(self, items: int, kept: int):
        self.kept = kept
        self.score = np.zeros((items, kept), np.int64)
        self.id = np.full((items, kept), _NO_ID)
        self.known = np.zeros((items, kept), bool)

    def update(self, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        """``scores``: documents by items. What is below an item's last score can't be among its best."""
        row, item = np.nonzero((scores >= self.score[:, -1]) & (scores > 0))
        if not len(row):
            return
        open_items = np.unique(item)
        again = np.repeat(open_items, self.kept)
        item = np.concatenate([again, item])
        score = np.concatenate([self.score[open_items].ravel(), scores[row, item[len(again) :]]])
        own = np.concatenate([self.id[open_items].ravel(), ids[row]])
        named = np.concatenate([self.known[open_items].ravel(), known[row]])
        order = np.lexsort((own, ~named, -score, item))
        item = item[order]
        order = order[np.arange(len(item)) - np.searchsorted(item, item) < self.kept]
        for held, values in ((self.score, score), (self.id, own), (self.known, named)):
            held[open_items] = values[order].reshape(-1, self.kept)


def _steps(sizes: np.ndarray, most: int):
    """Ranges of rows whose sizes sum to ``most`` or less; a larger row is alone."""
    ends, first = np.cumsum(sizes), 0
    while first < len(sizes):
        done = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield first, last
        first = last


def document_scores(index: Index, weights: np.ndarray, m: np.ndarray, owner, codes, times) -> np.ndarray:
    """Documents by items: the counts (owner, code, times) sent through the postings. Sums are exact."""
    each = weights[codes] * ((1_000_000_000 * times) // (1000 * times + 8 * m[owner]))
    sizes = index.sizes[codes]
    within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.repeat(index.ends[codes] - sizes, sizes) + within
    target = np.repeat(owner, sizes) * len(index.items) + index.place[at]
    value = np.repeat(each, sizes) * index.times[at]
    cells = len(m) * len(index.items)
    # No sum of an item is above that of its document over all postings; below 2^53 doubles hold it exactly.
    if np.bincount(owner, each * index.repeats[codes], len(m)).max(initial=0) < 2**52:
        found = np.bincount(target, value, cells).astype(np.int64)
    else:
        found = np.zeros(cells, np.int64)
        np.add.at(found, target, value)
    return found.reshape(len(m), len(index.items))


def _ranked(counted: DataFrame, index, weights: np.ndarray, number: int, total: int, kept: int) -> DataFrame:
    """(item, score, doc_id): the heaps of each task."""

    def rank(batches):
        own = index.value
        heaps = Heaps(len(own.items), kept)
        for batch in batches:
            n = batch.column("n").to_numpy()
            m = 100 - 75 + (75 * n * number) // total
            known = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            ids = batch.column("doc_id").fill_null(_NO_ID).to_numpy()
            codes = [np.frombuffer(b, "<i4") for b in batch.column("codes").to_pylist()]
            times = [np.frombuffer(b, "<i8") for b in batch.column("times").to_pylist()]
            met = [int(own.sizes[c].sum()) for c in codes]
            for first, last in _steps(np.maximum(np.array(met), len(own.items)), CELLS):
                lengths = [len(c) for c in codes[first:last]]
                scores = document_scores(
                    own,
                    weights,
                    m[first:last],
                    np.repeat(np.arange(last - first), lengths),
                    np.concatenate(codes[first:last]),
                    np.concatenate(times[first:last]),
                )
                heaps.update(scores, ids[first:last], known[first:last])
        item, at = np.nonzero(heaps.score > 0)
        for begin in range(0, len(item), 10_000):
            part = item[begin : begin + 10_000], at[begin : begin + 10_000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(own.items[part[0]]),
                    pa.array(heaps.score[part]),
                    pa.array(heaps.id[part], mask=~heaps.known[part]),
                ],
                ["item", "score", "doc_id"],
            )

    return counted.mapInArrow(rank, "item long, score long, doc_id long")


def _merged(heaps: DataFrame, kept: int) -> DataFrame:
    """The best of all heaps with their ranks, first within groups of heaps, then of these."""
    best = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = F.pmod(F.xxhash64("doc_id", "score"), F.lit(MERGES))
    groups = Window.partitionBy("item", "part").orderBy(*best)
    some = heaps.withColumn("part", part).withColumn("rank", F.row_number().over(groups)).where(F.col("rank") <= kept)
    ranks = F.row_number().over(Window.partitionBy("item").orderBy(*best))
    return some.withColumn("rank", ranks).where(F.col("rank") <= kept).drop("part")


def search(
    frame: DataFrame,
    items: DataFrame,
    kept: int = KEPT,
    text: str = "text",
    key: str = "doc_id",
    item_text: str = "text",
    item_key: str = "item_id",
    postings: int = POSTINGS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``kept`` documents of highest score above 0 for each item.

    Equal scores rank by ascending id, null ids last. Rows that repeat an id are documents each; equal rows of items
    are one item, and rows with one id and different texts, or a null id, are items each. A null text has no terms.
    A document without terms takes no part in any count; an item without terms, or whose terms stand nowhere,
    has no rows, and neither has an empty table. Other columns are not looked at. Items beyond ``postings`` distinct
    terms in all are searched in blocks, each in a pass of its own.
    """
    docs = documents(frame, text, key)
    own = items.select(items[item_key].alias("item_id"), F.coalesce(items[item_text], F.lit("")).alias("text"))
    own = written(own.distinct().withColumn("item", F.monotonically_increasing_id()), "items")
    stored = written(_postings(own), "postings")
    blocks = max(1, -(-stored.count() // postings))
    parts = [_block(docs, stored, block, blocks, kept) for block in range(blocks)]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionAll(part)
    return found.join(own.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _block(docs: DataFrame, stored: DataFrame, block: int, blocks: int, kept: int) -> DataFrame:
    index = Index(stored.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).toArrow())
    size, shared = len(index.code), docs.sparkSession.sparkContext.broadcast(index)
    counted = written(_counted(docs, shared), "term-counts")
    number, total, held = _statistics(counted, size)
    weights = np.array([math.floor(1000 * math.log((2 * number + 2) / (2 * df + 1))) for df in held.tolist()], np.int64)
    return _merged(_ranked(counted, shared, weights, number, max(1, total), kept), kept)


# The same ranking over views of the tables.
ORACLE = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), counts AS (
  SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL
), sizes AS (
  SELECT doc_id, count(*) AS n FROM words GROUP BY ALL
), totals AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS l FROM sizes
), asked AS (
  SELECT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM counts GROUP BY ALL), totals
), scores AS (
  SELECT item_id, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // l))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN sizes USING (doc_id), totals
  GROUP BY ALL
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
  FROM scores WHERE score > 0
)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
