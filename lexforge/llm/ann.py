"""Approximate nearest neighbours with a hash-prefix forest.

The rows are dealt into blocks of bounded size and the queries into blocks too; one task holds one of each. For its rows
it builds a forest: each tree gives a row a long hash string and keeps the strings in a sorted array. A symbol of a string
says which of the axes of a random projection, with its sign, lies nearest to the vector; near vectors share such symbols
far more often than bits of as many random planes. A query descends in every tree to its longest matching prefix; then
all trees ascend together, one symbol at a time, until the ranges of rows that share the prefix hold enough distinct
candidates. Candidates are scored exactly on the original vectors in double precision, and the best of all blocks merge.

A range of a prefix of two symbols holds one row in 64² on average, whatever the number of rows, so the trees together
ask for some 10 % of them where vectors lie evenly in all directions, the worst case, and for less where they cluster.

Inner products of vectors of unequal length are turned into angles by one more coordinate, sqrt(M² - |x|²) for rows and
0 for queries, where M is the longest row. That coordinate hides the rest where lengths differ much, so the rows of a
block are sorted into classes of similar length, and each class has its own forest or, if small, is scored whole.

Nothing is fitted and every row is indexed.

Defined results: vectors that are null, zero, or that hold null or non-finite components take no part, nor does a null
vec_id; vectors of different dimensions are never compared; rows that share an id are one row, whose vector is the
smallest of them; equal scores go to the smaller vec_id; fewer rows than k give all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._common import lean, power_of_two
from .pieces import gather

#: Rows and queries of one task on average.
BLOCK_ROWS = 32_768
BLOCK_QUERIES = 4_096
#: Trees, symbols of a hash string, axes that a symbol chooses from, and the distinct candidates asked for as a share of the rows.
TREES = 384
SYMBOLS = 3
AXES = 32
#: Projections that the trees choose their symbols from; the strings of all trees cost as many as that, not three a tree.
POOL = 256
SHARE = 0.03
#: Classes of at most so many rows are scored whole; the longest row of a class is at most LENGTHS times the shortest.
WHOLE = 8_192
LENGTHS = 1.2

HITS = "query_id long, vec_id long, score double"


class PrefixForest:
    def __init__(self, rows: np.ndarray, trees: int = TREES, seed: int = 7):
        norms = np.linalg.norm(rows, axis=1)
        self.n, self.trees = len(rows), trees
        rng = np.random.default_rng(seed)
        self.planes = rng.standard_normal((rows.shape[1] + 1, AXES * POOL), dtype=np.float32)
        self.symbols = np.stack([rng.permutation(POOL)[:SYMBOLS] for _ in range(trees)])  # of the pool, for each tree
        most = norms.max(initial=0)
        strings = self.strings(np.hstack([rows, np.sqrt(np.maximum(most * most - norms * norms, 0))[:, None]]))
        self.order = np.argsort(strings, axis=1, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(strings, self.order, axis=1)

    def strings(self, vectors: np.ndarray) -> np.ndarray:
        """Hash strings of vectors as integers in base 2 * AXES, one row per tree."""
        out = np.empty((self.trees, len(vectors)), np.uint32)
        axis = np.arange(AXES, dtype=np.uint32)[:, None]
        for a in range(0, len(vectors), 256):
            part = (vectors[a : a + 256].astype(np.float32) @ self.planes).view(np.uint32).reshape(-1, AXES, POOL)
            # the bits of a positive float order as the float does: the axis and its sign go into the lowest of them
            sign = part >> np.uint32(31) << np.uint32(5)
            part &= np.uint32(0x7FFFFFC0)
            part |= sign
            part |= axis
            symbol = part.max(axis=1) & np.uint32(2 * AXES - 1)
            string = symbol[:, self.symbols[:, 0]]
            for s in range(1, SYMBOLS):
                string = string * np.uint32(2 * AXES) + symbol[:, self.symbols[:, s]]
            out[:, a : a + 256] = string.T
        return out

    def candidates(self, queries: np.ndarray, wanted: int) -> Iterator[np.ndarray]:
        """For each query the distinct rows in the ranges of the longest prefix that gives enough of them."""
        strings = self.strings(np.hstack([queries, np.zeros((len(queries), 1))]))
        tree = np.arange(self.trees)[:, None] * self.n
        flat = self.order.reshape(-1)
        for first in range(0, len(queries), 256):
            part = strings[:, first : first + 256].astype(np.int64)
            found: list[np.ndarray | None] = [None] * part.shape[1]
            open_ = np.arange(len(found))
            for symbols in range(SYMBOLS, 0, -1):  # the ascent
                if not len(open_):
                    break
                width = (2 * AXES) ** (SYMBOLS - symbols)
                begin = part[:, open_] // width * width
                lo = np.stack([np.searchsorted(s, b.astype(np.uint32)) for s, b in zip(self.sorted, begin)])
                hi = np.stack([np.searchsorted(s, (b + width - 1).astype(np.uint32), "right") for s, b in zip(self.sorted, begin)])
                enough = (hi - lo).sum(axis=0) >= wanted  # fewer entries can't be enough distinct rows
                for j in np.flatnonzero(enough).tolist():
                    seen = np.zeros(self.n, bool)
                    seen[gather(flat, tree[:, 0] + lo[:, j], hi[:, j] - lo[:, j])] = True
                    rows = np.flatnonzero(seen)
                    enough[j] = len(rows) >= wanted
                    found[open_[j]] = rows
                open_ = open_[~enough]
            for j in open_.tolist():
                found[j] = np.arange(self.n)
            yield from found


def length_classes(rows: np.ndarray) -> list[np.ndarray]:
    """The places of the rows, those of similar length together."""
    norms = np.linalg.norm(rows, axis=1)
    order = np.argsort(norms, kind="stable")
    out, a = [], 0
    while a < len(order):
        b = max(a + 1, int(np.searchsorted(norms[order], norms[order[a]] * LENGTHS, side="right")))
        out.append(np.sort(order[a:b]))
        a = b
    return out


def search_block(row_ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, trees: int = TREES, share: float = SHARE) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The best k candidates of each query in one block of rows."""
    classes = length_classes(rows)
    whole = np.concatenate([np.zeros(0, np.int64), *(c for c in classes if len(c) <= WHOLE)])
    large = [c for c in classes if len(c) > WHOLE]
    met = [PrefixForest(rows[c], trees).candidates(queries, min(len(c), max(8 * k, int(np.ceil(share * len(c)))))) for c in large]
    longest = np.linalg.norm(rows, axis=1).max(initial=0)
    out = []
    for q, vector in zip(query_ids.tolist(), queries):
        found = np.sort(np.concatenate([whole, *(c[next(m)] for c, m in zip(large, met))]))
        found = found[row_ids[found] != q]
        scores = rows[found] @ vector
        if len(found) > 4 * k:
            edge = np.partition(scores, len(scores) - k)[len(scores) - k]
            found = found[scores >= edge - 1e-12 * len(vector) * longest * np.linalg.norm(vector)]  # rounding can't hide a neighbour
        scores = np.array([exact_inner(rows[j], vector) for j in found.tolist()])
        best = np.lexsort((row_ids[found], -scores))[:k]
        out.append((np.full(len(best), q), row_ids[found[best]], scores[best]))
    return out


def exact_inner(a: np.ndarray, b: np.ndarray) -> float:
    """The inner product in double precision, summed from the first component to the last."""
    return float(np.add.accumulate(a * b)[-1])


def valid_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col("v")
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    usable = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return rows.where("id is not null").where(v.isNotNull()).where(usable)


def one_per_id(ids: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in the order of their ids; of rows that share an id the one with the smallest vector."""
    order = np.argsort(ids, kind="stable")
    if len(ids) and (np.diff(ids[order]) == 0).any():
        order = np.lexsort((*vectors.T[::-1], ids))
    ids, vectors = ids[order], vectors[order]
    first = np.concatenate(([True], ids[1:] != ids[:-1])) if len(ids) else np.zeros(0, bool)
    return ids[first], vectors[first]


def nearest_neighbours(df: DataFrame, k: int = 20, query_every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", trees: int = TREES, share: float = SHARE) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for every row whose id is divisible by query_every."""
    rows = valid_vectors(df, id_col, vector_col).withColumn("d", F.size("v"))
    n = rows.count()
    row_blocks = power_of_two(n / BLOCK_ROWS)
    query_blocks = power_of_two(n / query_every / BLOCK_QUERIES)
    block = lambda m, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(m)).cast("int")
    upto = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    left = rows.select("id", "v", "d", block(row_blocks, 1).alias("rb"), upto(query_blocks).alias("qb"))
    right = rows.where(F.pmod("id", F.lit(query_every)) == 0).select("id", "v", "d", block(query_blocks, 2).alias("qb"), upto(row_blocks).alias("rb"))

    def run(rows_: pa.Table, queries: pa.Table) -> pa.Table:
        empty = {"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())}
        if not rows_.num_rows or not queries.num_rows:
            return pa.table(empty)
        dimension = rows_.column("d")[0].as_py()
        read = lambda t: one_per_id(t.column("id").to_numpy(), t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension))
        found = search_block(*read(rows_), *read(queries), k, trees, share)
        return pa.table({name: np.concatenate([f[i] for f in found]) for i, name in enumerate(empty)})

    # columns of the two sides must not be the same attributes: a cogroup of those loses some
    left, right = (d.select(*(F.col(c).alias(c) for c in d.columns)) for d in (left, right))
    hits = left.groupBy("d", "rb", "qb").cogroup(right.groupBy("d", "rb", "qb")).applyInArrow(lean(run), HITS)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
ok AS (SELECT vec_id, e FROM v WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e) AS score FROM ok q JOIN ok c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 20
"""
