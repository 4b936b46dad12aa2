"""Exact top-k inner products by best-first search in M-trees.

Vectors are dealt by hash into trees of bounded size. An inner product becomes a metric by one more
component that brings all vectors of a tree to the same length: the largest product is then the smallest
Euclidean distance. A tree is bulk-loaded into pages: a routing entry keeps its pivot, covering radius
and distance to the pivot of the page above; a leaf entry keeps its vector and that distance. Search
takes pages in the order of their lower bound and stops at the k-th best score; by the triangle
inequality the stored distances rule out entries before their own distance is computed. Bounds are
widened by a rounding margin and scores are exact products of whole numbers, so the result is exact.

Queries meet trees in blocks: a block of queries is one row, and each tree is paired with each block.
Every pair gives its best k, and the best k of those remain.

Defined results: vectors that are null or hold null or non-finite components take no part; a vector
meets only vectors of its own length; a query does not meet rows with its own id; rows repeated with
one id are candidates each, and queries once; null ids are candidates but no queries; ties go to the
smaller id; extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import store

NONE = np.iinfo(np.int64).min


@dataclass(frozen=True)
class TreeRules:
    tree_rows: int = 8192  # vectors of a tree, on average
    page: int = 256  # entries of a page
    block_rows: int = 512  # queries of a block, on average
    seed: int = 11


class MTree:
    """Pages over the rows of ``vectors`` (already of equal length by the extra component)."""

    def __init__(self, vectors: np.ndarray, page: int, seed: int):
        self.vectors, self.page = vectors, page
        self.square = float((vectors**2).sum(axis=1).max()) if len(vectors) else 0.0
        self.rng = np.random.default_rng(seed)
        # per page: child pages (or None for a leaf), and of its entries the rows, radii, distances to
        # the pivot above, and vectors
        self.pages: list[tuple] = []
        self.root = self._load(np.arange(len(vectors)), None) if len(vectors) else None

    def _apart(self, rows: np.ndarray, pivot: int | None) -> np.ndarray:
        if pivot is None:
            return np.zeros(len(rows))
        return np.sqrt(((self.vectors[rows] - self.vectors[pivot]) ** 2).sum(axis=1))

    def _load(self, rows: np.ndarray, pivot: int | None) -> int:
        if len(rows) <= self.page:
            own = np.ascontiguousarray(self.vectors[rows])
            self.pages.append((None, rows, np.zeros(len(rows)), self._apart(rows, pivot), own))
            return len(self.pages) - 1
        count = min(self.page, -(-len(rows) // self.page) * 2)
        pivots = self.rng.choice(rows, count, replace=False)
        own = self.vectors[rows]
        near = ((own**2).sum(axis=1)[:, None] - 2 * own @ self.vectors[pivots].T + (self.vectors[pivots] ** 2).sum(axis=1)).argmin(axis=1)
        order = np.argsort(near, kind="stable")
        parts = [p for p in np.split(rows[order], np.searchsorted(near[order], np.arange(1, count))) if len(p)]
        if len(parts) == 1:  # equal vectors: cut by size
            parts = np.array_split(rows, count)
        heads = np.array([p[0] for p in parts])
        for k, part in enumerate(parts):  # the entry nearest to the middle is the pivot
            middle = self.vectors[part].mean(axis=0)
            heads[k] = part[((self.vectors[part] - middle) ** 2).sum(axis=1).argmin()]
        radii = np.array([self._apart(part, head).max() for part, head in zip(parts, heads)])
        children = [self._load(part, int(head)) for part, head in zip(parts, heads)]
        self.pages.append((children, heads, radii, self._apart(heads, pivot), self.vectors[heads]))
        return len(self.pages) - 1

    def search(self, query: np.ndarray, counted, margin: float) -> None:
        """Best-first search. ``counted(rows, products)`` takes the leaf entries that may count and
        returns the largest distance that still counts."""
        most, scale = np.inf, float((query**2).sum()) + self.square
        heap = [(0.0, self.root, 0.0, True)]
        while heap:
            bound, page, above, top = heapq.heappop(heap)
            if bound > most + margin:
                return
            children, rows, radii, apart, own = self.pages[page]
            if not top and most < np.inf:
                open_ = np.flatnonzero(np.abs(above - apart) - radii <= most + margin)
                if not len(open_):
                    continue
                if len(open_) < len(rows) // 2:
                    rows, radii, own = rows[open_], radii[open_], own[open_]
                    children = None if children is None else [children[k] for k in open_]
            products = own @ query
            if children is None:
                most = counted(rows, products)
                continue
            apart = np.sqrt(np.maximum(0.0, scale - 2 * products))
            least = np.maximum(0.0, apart - radii)
            for at in np.flatnonzero(least <= most + margin).tolist():
                heapq.heappush(heap, (float(least[at]), children[at], float(apart[at]), False))


def whole_vectors(df: DataFrame, id_col: str, vector: Column) -> DataFrame:
    """(id, vector, width) of the rows whose vector is complete and finite."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), vector.cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(F.col("vector").isNotNull() & ~F.coalesce(bad, F.lit(False))).withColumn("width", F.size("vector"))


def packed_rows(df: DataFrame, group: Column, name: str) -> DataFrame:
    """One row a group: ids and vectors in one array each."""
    rows = F.sort_array(F.collect_list(F.struct("id", "vector")))
    return df.groupBy("width", group.alias(name)).agg(rows.alias("rows")).select(
        "width", name, F.col("rows.id").alias("ids"), F.flatten("rows.vector").alias("vectors")
    )


def top_products(
    df: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vector: Column | None = None, rules: TreeRules = TreeRules()
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` largest inner products with all other rows."""
    vector = F.col("embedding") if vector is None else vector
    rows = store(whole_vectors(df, id_col, vector), "mtree-vectors")
    asked = whole_vectors(df.filter(queries & F.col(id_col).isNotNull()), id_col, vector).dropDuplicates(["id", "vector"])
    asked = store(asked, "mtree-queries")
    total, count = rows.count(), asked.count()
    trees, blocks = max(1, total // rules.tree_rows), max(1, count // rules.block_rows)
    # the stored rows keep their numbers, so repeated rows are spread and a task run again deals alike
    own = lambda n: F.pmod(F.xxhash64(F.lit(rules.seed), "id", F.monotonically_increasing_id()), F.lit(n)).cast("int")
    tree_rows = packed_rows(rows, own(trees), "tree").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    block_rows = packed_rows(asked, own(blocks), "block").select(
        "width", "block", F.col("ids").alias("query_ids"), F.col("vectors").alias("query_vectors")
    )
    pairs = tree_rows.join(block_rows, ["width", "block"]).repartition(
        max(trees * blocks, 1), "width", "tree", "block"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                width = batch.column(0)[row].as_py()
                ids, vectors, query_ids, query_vectors = (batch.column(c)[row].values for c in range(1, 5))
                ids = ids.fill_null(NONE).to_numpy()
                shape = lambda x, n: x.to_numpy().reshape(n, width)
                found = search_tree(
                    ids, shape(vectors, len(ids)), query_ids.to_numpy(), shape(query_vectors, len(query_ids)), k, rules
                )
                if found:
                    own_ids = np.concatenate([f[2] for f in found])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat([f[0] for f in found], [len(f[2]) for f in found]), pa.int64()),
                         pa.array(np.repeat([f[1] for f in found], [len(f[2]) for f in found]), pa.int64()),
                         pa.array(own_ids, pa.int64(), mask=own_ids == NONE),
                         pa.array(np.concatenate([f[3] for f in found]))],
                        names=["query_id", "query", "vec_id", "score"],
                    )

    best = pairs.select("width", "ids", "vectors", "query_ids", "query_vectors").mapInArrow(
        run, "query_id long, query long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def search_tree(ids, vectors, query_ids, query_vectors, k, rules) -> list:
    """(query id, query's hash, ids, scores) of the best of one tree for each query of a block."""
    lengths = (vectors**2).sum(axis=1)
    longest = float(lengths.max())
    lifted = np.hstack([vectors, np.sqrt(np.maximum(0.0, longest - lengths))[:, None]])
    tree = MTree(lifted, rules.page, rules.seed)
    found = []
    for own, query in zip(query_ids.tolist(), query_vectors):
        square = float((query**2).sum())
        scale = square + longest
        margin = 1e-6 * (1 + np.sqrt(scale))
        best = [np.zeros(0), np.zeros(0, np.int64)]

        def counted(rows, products, best=best, own=own, scale=scale):
            if len(best[0]) == k:  # only what reaches the k-th best can change it
                good = np.flatnonzero(products >= best[0][-1])
                rows, products = rows[good], products[good]
            other = ids[rows] != own
            score = np.concatenate([best[0], products[other]])
            held = np.concatenate([best[1], ids[rows[other]]])
            # a null id ranks after all others
            order = np.lexsort((np.where(held == NONE, np.iinfo(np.int64).max, held), -score))[:k]
            best[0], best[1] = score[order], held[order]
            return np.sqrt(max(0.0, scale - 2 * best[0][-1])) if len(order) == k else np.inf

        tree.search(np.append(query, 0.0), counted, margin)
        if len(best[0]):
            found.append((own, crc32(query.tobytes()), best[1], best[0]))
    return found
