"""Exact top-k inner products by norm-bucketed retrieval."""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, SCALE = 5, 256
BUCKET_ROWS, QUERY_BLOCK = 2048, 2048
FOCUS = 4
_EXACT = 1 << 53
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): vectors in doubles. Rows with a null vec_id, a null or empty vector, or a null, infinite or NaN component
    are left out."""
    x = F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    found = vectors.where(F.col("vec_id").isNotNull() & (F.size(x) > 0) & ~bad)
    return found.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("v"))


def scaled(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) in doubles, or in whole numbers without a bound where a product could leave the doubles."""
    if np.abs(x).max(initial=0) < 2.0**900:
        return np.floor(x * scale)
    return np.array([[math.floor(c * scale) if abs(c) < _EXACT else int(c) * scale for c in row] for row in x], object)


def _whole(matrix: np.ndarray) -> np.ndarray:
    """The same numbers as Python integers."""
    return np.array([[int(c) for c in row] for row in matrix], object).reshape(matrix.shape)


def lengths(matrix: np.ndarray) -> np.ndarray:
    """Lengths in doubles; of vectors too long for that, infinite, which rules nothing out."""
    with np.errstate(over="ignore"):
        try:
            return np.sqrt((matrix.astype(float) ** 2).sum(axis=1))
        except OverflowError:  # a whole number beyond the doubles
            return np.full(len(matrix), np.inf)


def _units(matrix: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """Directions; zeros for vectors of infinite length, which no threshold is sharp against."""
    units = np.zeros(matrix.shape)
    some = np.isfinite(norms)
    units[some] = matrix[some].astype(float) / np.maximum(norms[some], 1e-300)[:, None]
    return units


class TopK:
    """The best `k` rows so far of a block of queries, and how to improve them from a bucket of rows of like length."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.norms = lengths(vectors)
        self.units = _units(vectors, self.norms)
        self.largest = np.array([int(abs(row).max()) for row in vectors], object)
        self.scores = np.full((len(ids), k), np.iinfo(np.int64).min)
        self.found = np.zeros((len(ids), k), np.int64)
        self.count = np.zeros(len(ids), int)

    def _products(self, q: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Exact inner products. Those beyond a long are the nearest long."""
        bound = max(self.largest[q]) * int(abs(rows).max()) * rows.shape[1]
        vectors = self.vectors[q]
        if bound < _EXACT:
            return (vectors.astype(float) @ rows.astype(float).T).astype(np.int64)
        if bound < 1 << 62:
            return vectors.astype(np.int64) @ rows.astype(np.int64).T
        whole = _whole(vectors) @ _whole(rows).T
        return np.clip(whole, _LEAST, _MOST).astype(np.int64)

    def add(self, ids: np.ndarray, rows: np.ndarray, norms: np.ndarray) -> None:
        """Verify a bucket's rows against the queries that could still take one of them."""
        most, least = norms.max(), norms.min()
        threshold = np.where(self.count == self.k, self.scores[:, -1].astype(float), -np.inf)
        # The cosine a row of this bucket needs to reach a query's k-th score. A little is given for rounding.
        with np.errstate(divide="ignore", invalid="ignore"):
            local = np.where(threshold > 0, threshold / (self.norms * most), -np.inf) - 1e-9
        local[np.isnan(local)] = -np.inf
        alive = np.flatnonzero(local <= 1)
        for k in range(0, len(alive), 256):
            q = alive[k : k + 256]
            keep = np.ones((len(q), len(rows)), bool)
            sharp = np.flatnonzero(local[q] > 0.5)
            if len(sharp):
                # Coordinate pruning: within angle c of the query, a row's unit vector is within c of each coordinate's angle.
                units = _units(rows, norms)
                for s in sharp:
                    u, c = self.units[q[s]], np.arccos(min(1.0, local[q[s]]))
                    for f in np.argsort(-np.abs(u))[:FOCUS]:
                        a = np.arccos(np.clip(u[f], -1, 1))
                        keep[s] &= units[:, f] >= np.cos(min(a + c, np.pi)) - 1e-9
                        keep[s] &= units[:, f] <= np.cos(max(a - c, 0.0)) + 1e-9
            dull = np.flatnonzero((local[q] > 0) & (local[q] <= 0.5))
            if len(dull) and least < most:
                # Length pruning: the row's own length has to reach the score even at cosine 1.
                keep[dull] &= norms[None, :] * self.norms[q[dull], None] >= threshold[q[dull], None] * (1 - 1e-9)
            columns = np.flatnonzero(keep.any(axis=0))
            if len(columns):
                self._merge(q, ids[columns], self._products(q, rows[columns]), keep[:, columns])

    def _merge(self, q: np.ndarray, ids: np.ndarray, scores: np.ndarray, keep: np.ndarray) -> None:
        own = self.ids[q, None] == ids[None, :]
        good = keep & ~own & (scores >= self.scores[q, -1:])
        for i in np.flatnonzero(good.any(axis=1)):
            at = np.flatnonzero(good[i])
            n = self.count[q[i]]
            s = np.concatenate([self.scores[q[i], :n], scores[i, at]])
            v = np.concatenate([self.found[q[i], :n], ids[at]])
            order = np.lexsort((v, ~s))  # best score first, then the smaller id
            once = np.sort(np.unique(v[order], return_index=True)[1])[: self.k]
            n = self.count[q[i]] = len(once)
            self.scores[q[i], :n], self.found[q[i], :n] = s[order][once], v[order][once]

    def rows(self) -> Iterator[tuple[int, int, int]]:
        for i, query in enumerate(self.ids):
            for j in range(self.count[i]):
                yield int(query), int(self.found[i, j]), int(self.scores[i, j])


def top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE) -> DataFrame:
    """For every row of `vectors` (vec_id, embedding) with `is_query` its `k` best others: query_id, rank, vec_id, score.

    The score is the inner product of the scaled components, and of products beyond a long the nearest long; of equal scores the smaller vec_id comes first. vec_id is
    a vector's name: a query never finds its own, repeated rows of one are one row with their best score, and repeated
    queries count once (their smallest vector in array order). Rows that `usable` leaves out take no part, and rows with
    another number of components than a query's are none of its others. Fewer than k others: all of them.

    Queries go in blocks of `QUERY_BLOCK`, each held by every task while it reads its rows once. A task groups its rows
    by length, longest first, and compares a bucket only with queries whose k-th score it can reach, by the bucket's
    local cosine threshold; what coordinates or lengths don't rule out is verified exactly.
    """
    rows = usable(vectors)
    queries = rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    blocks = -(-queries.count() // QUERY_BLOCK)
    found = None
    for b in range(blocks):
        part = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b)
        best = _of_block(rows, part.collect(), k, scale)  # about QUERY_BLOCK rows
        found = best if found is None else found.union(best)
    if found is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")  # k rows a task
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _of_block(rows: DataFrame, queries: list, k: int, scale: int) -> DataFrame:
    by_size: dict[int, tuple[list, list]] = {}
    for r in queries:
        ids, values = by_size.setdefault(len(r["v"]), ([], []))
        ids.append(r["vec_id"])
        values.append(r["v"])
    packed = {n: (np.array(i, np.int64), scaled(np.array(v, float), scale)) for n, (i, v) in by_size.items()}

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states = {n: TopK(i, v, k) for n, (i, v) in packed.items()}
        for batch in batches:
            ids, lists = batch["vec_id"].to_numpy(), batch["v"]
            flat, starts = lists.flatten().to_numpy(), np.asarray(lists.offsets)
            starts = starts - starts[0]
            sizes = np.diff(starts)
            for n in np.intersect1d(np.unique(sizes), list(states)):
                at = np.flatnonzero(sizes == n)
                matrix = scaled(flat[starts[at][:, None] + np.arange(n)], scale)
                norms = lengths(matrix)
                order = np.lexsort((ids[at], -norms))
                for j in range(0, len(order), BUCKET_ROWS):
                    o = order[j : j + BUCKET_ROWS]
                    states[n].add(ids[at][o], matrix[o], norms[o])
        out = [r for s in states.values() for r in s.rows()]
        q, v, s = (np.array(x, np.int64) for x in zip(*out)) if out else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (q, v, s)], ["query_id", "vec_id", "score"])

    return rows.mapInArrow(search, "query_id long, vec_id long, score long")
