"""Nearest vectors by cosine, through a vantage-point tree for each shard of the table.

A tree's node holds a vantage vector and the median distance to it; vectors up to the median are on one
side, the others on the other. A side is passed over if the triangle inequality shows that it holds nothing
nearer than the found ones: if its lower bound is above ``slack`` times the distance of the k-th nearest. With
slack 1 the search is exact, with less it passes over more. All queries of a block go down a tree together.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodewright.llm.tables import open_folder, written

LEAF = 256
SHARD_ROWS = 16_384
QUERY_BLOCK = 1_024
# Rounding of distances of unit vectors, and of their products.
EDGE = 1e-7
PRODUCT_EDGE = 1e-9
# Products, and components of pairs, that scoring a leaf holds at once.
PRODUCTS = 1 << 20


def usable(vector):
    """Not null, not zero, and each component finite."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def cosines(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosines of rows with rows. Equal rows give equal results: each is summed by itself."""
    dot = (queries * vectors).sum(-1)
    return dot / (np.sqrt((queries * queries).sum(-1)) * np.sqrt((vectors * vectors).sum(-1)))


def units(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


class Tree:
    """A vantage-point tree over the rows of a matrix; ``ids`` number them."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, copies: int, seed: int = 0):
        # Of equal vectors only the `copies` with the smallest ids can be among the nearest.
        order = np.argsort(ids, kind="stable")
        vectors, ids = vectors[order], ids[order]
        _, group = np.unique(vectors, axis=0, return_inverse=True)
        by_group = np.argsort(group.ravel(), kind="stable")
        ordered = group.ravel()[by_group]
        kept = by_group[np.arange(len(ordered)) - np.searchsorted(ordered, ordered) < copies]
        self.vectors, self.ids = vectors[kept], ids[kept]
        self.units = units(self.vectors)
        self.random = np.random.default_rng(seed)
        self.nodes: list[tuple] = []
        self.root = self._build(np.arange(len(self.ids)))

    def _build(self, rows: np.ndarray) -> int:
        """The node's number. A leaf is (rows, None); a node is (vantage row, median, inner, outer)."""
        todo, root = [(rows, None, 0)], None
        while todo:
            rows, parent, side = todo.pop()
            number = len(self.nodes)
            if parent is None:
                root = number
            else:
                self.nodes[parent][2 + side] = number
            if len(rows) > LEAF:
                vantage = rows[self.random.integers(len(rows))]
                away = self.distances(self.units[rows], vantage)
                median = float(np.median(away))
                inner = away <= median
                if not inner.all():
                    self.nodes.append([vantage, median, None, None])
                    todo += [(rows[inner], number, 0), (rows[~inner], number, 1)]
                    continue
            self.nodes.append((rows, None))
        return root

    def distances(self, points: np.ndarray, row: int) -> np.ndarray:
        return np.sqrt(np.maximum(0, 2 - 2 * (points @ self.units[row])))

    def search(
        self, vectors: np.ndarray, ids: np.ndarray, k: int, slack: float
    ) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the k nearest of each query, best first; -inf where there are fewer."""
        best = np.full((len(ids), k), -np.inf), np.full((len(ids), k), np.iinfo(np.int64).max)
        points = units(vectors)
        todo: list[tuple[int, np.ndarray, np.ndarray]] = []
        # First each query's own way down, so that there is something to compare bounds with.
        todo.append((self.root, np.arange(len(ids)), np.zeros(len(ids))))
        seen = self._walk(todo, points, vectors, ids, best, k, slack, home=True)
        todo.append((self.root, np.arange(len(ids)), np.zeros(len(ids))))
        self._walk(todo, points, vectors, ids, best, k, slack, home=False, seen=seen)
        return best

    def _walk(self, todo, points, vectors, ids, best, k, slack, home, seen=None):
        leaf_of = np.full(len(ids), -1)
        while todo:
            number, active, bound = todo.pop()
            near = np.sqrt(np.maximum(0, 2 - 2 * np.maximum(best[0][active, -1], -1)))
            active = active[bound <= slack * near + EDGE]
            if not len(active):
                continue
            node = self.nodes[number]
            if node[1] is None:
                if home:
                    leaf_of[active] = number
                else:
                    active = active[seen[active] != number]
                if len(active):
                    self._score(node[0], active, points, vectors, ids, best, k)
                continue
            away = self.distances(points[active], node[0])
            inside = away <= node[1]
            if home:
                todo += [
                    (child, part, np.zeros(len(part)))
                    for child, part in ((node[2], active[inside]), (node[3], active[~inside]))
                ]
            else:
                todo += [(node[2], active, away - node[1]), (node[3], active, node[1] - away)]
        return leaf_of

    def _score(self, rows, active, points, vectors, ids, best, k) -> None:
        """Scores rows of a leaf for the queries: all whose rough product may be among the k best."""
        step = max(1, PRODUCTS // len(rows))
        for begin in range(0, len(active), step):
            self._score_some(rows, active[begin : begin + step], points, vectors, ids, best, k)

    def _score_some(self, rows, active, points, vectors, ids, best, k) -> None:
        rough = points[active] @ self.units[rows].T
        rough[self.ids[rows] == ids[active][:, None]] = -np.inf
        least = best[0][active, -1]
        if k < len(rows):
            least = np.maximum(least, -np.partition(-rough, k - 1, axis=1)[:, k - 1])
        query, at = np.nonzero((rough >= least[:, None] - PRODUCT_EDGE) & np.isfinite(rough))
        if not len(query):
            return
        asked, row = active[query], rows[at]
        size = max(1, PRODUCTS // self.vectors.shape[1])
        score = np.concatenate(
            [
                cosines(vectors[asked[i : i + size]], self.vectors[row[i : i + size]])
                for i in range(0, len(row), size)
            ]
        )
        # What was best before and what is new, by query, best first, ties to the smaller id.
        query = np.concatenate([np.repeat(np.arange(len(active)), k), query])
        score = np.concatenate([best[0][active].ravel(), score])
        found = np.concatenate([best[1][active].ravel(), self.ids[row]])
        order = np.lexsort((found, -score, query))
        query = query[order]
        order = order[np.arange(len(query)) - np.searchsorted(query, query) < k]
        best[0][active] = score[order].reshape(-1, k)
        best[1][active] = found[order].reshape(-1, k)


def _matrices(ids: np.ndarray, vectors: pa.ListArray):
    """(ids, matrix) by number of components."""
    sizes = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    begins = np.cumsum(sizes) - sizes
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield size, ids[rows], values[begins[rows][:, None] + np.arange(size)]


def nearest(
    frame: DataFrame,
    queries: DataFrame,
    k: int = 5,
    slack: float = 1.0,
    key: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of ``frame`` for each row of ``queries``.

    Both have an id and a vector. Nearest is the largest cosine, ties to the smaller id; a query's own id is
    no candidate. Null ids, and vectors that are null, zero or hold a null or non-finite component, take no
    part. Vectors of another number of components are never near. Of query rows with one id the one with the
    smallest vector is taken; rows that repeat an id in ``frame`` are candidates each. Queries are written
    to the shared folder, from where each shard's task reads them block by block. An empty table, or one
    without queries, gives no rows.
    """

    def clean(rows: DataFrame) -> DataFrame:
        rows = rows.select(rows[key].cast("long").alias("id"), rows[vector].alias("vector"))
        return rows.where(F.col("id").isNotNull() & usable(F.col("vector")))

    asked = clean(queries).groupBy("id").agg(F.min("vector").alias("vector"))
    stored = written(asked, "queries")
    base = stored.written_at
    rows = clean(frame)
    shards = max(1, -(-rows.count() // shard_rows))

    def search(batches):
        ids, vectors = [], []
        for batch in batches:
            ids.append(batch.column(0).to_numpy())
            vectors.append(batch.column(1))
        if not ids:
            return
        joined = pa.chunked_array(vectors).combine_chunks()
        trees = {
            size: Tree(matrix, own, k + 1) for size, own, matrix in _matrices(np.concatenate(ids), joined)
        }
        source, path = open_folder(base)
        for block in ds.dataset(path, filesystem=source, format="parquet").to_batches(
            batch_size=QUERY_BLOCK
        ):
            if not block.num_rows:
                continue
            for size, own, matrix in _matrices(block.column(0).to_numpy(), block.column(1)):
                if size not in trees:
                    continue
                score, found = trees[size].search(matrix, own, k, slack)
                real = np.isfinite(score).ravel()
                yield pa.RecordBatch.from_pydict(
                    {
                        "query_id": np.repeat(own, k)[real],
                        "vec_id": found.ravel()[real],
                        "score": score.ravel()[real],
                    }
                )

    found = rows.repartition(shards).mapInArrow(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
