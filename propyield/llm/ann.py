"""Nearest neighbours by collision-counting hashing with query-centred windows.

Each of ``PROJECTIONS`` random lines sorts the vectors of an index block by their
projection. A query opens a window around its own projection on every line; a vector
inside a window collides once with the query. Virtual rehashing widens all windows
with the radius, adding only the newly covered stretches of the sorted arrays; a
vector that reaches the collision threshold is verified once by its inner product
(first in single precision; the best, with a margin, again in double). The search ends at the first radius that holds k verified vectors, or when
the windows cover the block, so fewer than k are returned only when there are fewer.

Threshold: a vector within radius R of the query falls into one window with
probability P(|N(0,1)| < WIDTH); the threshold lies a standard deviation below the
expected number of collisions of a vector at the very edge, so nearer ones, which the
true neighbours are but for the last, are verified more often still (measured recall:
README).

Largest inner product becomes smallest distance: with M the largest norm, vectors get
the coordinate sqrt(M^2 - |x|^2) and queries are scaled to norm M.

Rows are dealt to index blocks of bounded size by a hash; the queries (the stated set)
are copied to every block, whose index is built once and streams them past. The k best
of each block are merged by query.

Defined cases: vectors null, empty, zero or holding null or non-finite components take
no part; vectors of different length are searched apart; equal vectors tie and the
smaller id wins; rows with equal ids are separate candidates but a query meets none of
its own id; equal query rows are searched once, different vectors under one query id each
for itself; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propyield.llm.common import many_tasks, matrix, meet_blocks

K = 20
PROJECTIONS = 64
#: Half width of a window in units of the radius.
WIDTH = 1.3
#: Bytes of the vectors of an index block, about, and queries whose windows are found at once.
INDEX_BYTES = 1 << 25
QUERIES = 256
SEED = 20240229
#: The radii that windows grow through, in units of sqrt(2) * M (orthogonal vectors
#: are 1 apart; no distance exceeds sqrt(2)).
RADII = (0.3, 0.5, 0.6, 0.66, 0.7, 0.74, 0.78, 0.82, 0.88, 0.95, 1.05, 1.2, 1.42)


def threshold(m: int = PROJECTIONS, width: float = WIDTH) -> int:
    p = math.erf(width / math.sqrt(2))
    return max(1, math.floor(m * p - math.sqrt(m * p * (1 - p))))


def lines(dim: int, m: int = PROJECTIONS) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((dim + 1, m))


class BlockIndex:
    """The sorted projections of one block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, largest: float):
        self.ids, self.vectors, self.largest = ids, vectors, largest
        rest = np.sqrt(np.maximum(largest ** 2 - (vectors ** 2).sum(axis=1), 0.0))
        self.lines, self.rough = lines(vectors.shape[1]), vectors.astype(np.float32)
        at = np.ascontiguousarray((vectors @ self.lines[:-1] + rest[:, None] * self.lines[-1]).T)
        self.order = np.argsort(at, axis=1, kind="stable")
        self.sorted = np.take_along_axis(at, self.order, axis=1)

    def windows(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each query's window begins and ends on every line, for every radius."""
        scale = self.largest / np.sqrt((queries ** 2).sum(axis=1))
        centres = (queries * scale[:, None]) @ self.lines[:-1]
        half = WIDTH * math.sqrt(2) * self.largest * np.array(RADII)
        low, high = (np.empty((len(queries), len(RADII), len(self.order)), dtype=np.int64) for _ in range(2))
        for j, line in enumerate(self.sorted):
            low[:, :, j] = line.searchsorted(centres[:, j, None] - half, "left")
            high[:, :, j] = line.searchsorted(centres[:, j, None] + half, "right")
        return low, high

    def search(self, query_id: int, query: np.ndarray, low: np.ndarray, high: np.ndarray,
               k: int = K) -> tuple[np.ndarray, np.ndarray]:
        """(positions, scores) of the k best found in this block, best first."""
        n, need, norm = len(self.ids), threshold(len(self.order)), float(np.sqrt((query ** 2).sum()))
        counts = np.zeros(n, dtype=np.uint16)
        open_ = self.ids != query_id  # a query never meets its own id
        where, near, rough = np.zeros(0, dtype=np.int64), np.zeros(0), query.astype(np.float32)
        for i, r in enumerate(RADII):
            lo, hi = low[i].tolist(), high[i].tolist()
            if i == 0:
                for o, x, y in zip(self.order, lo, hi, strict=True):
                    counts[o[x:y]] += 1  # a line holds each vector once
            else:  # virtual rehashing: only what the wider windows add
                for o, x, y in zip(self.order, lo, low[i - 1].tolist(), strict=True):
                    counts[o[x:y]] += 1
                for o, x, y in zip(self.order, high[i - 1].tolist(), hi, strict=True):
                    counts[o[x:y]] += 1
            fresh = np.flatnonzero((counts >= (need if r < RADII[-1] else 0)) & open_)
            if len(fresh):
                open_[fresh] = False
                where = np.concatenate([where, fresh])
                near = np.concatenate([near, self.rough[fresh] @ rough])
            if len(where) >= k:
                kth = np.partition(near, len(near) - k)[len(near) - k]
                distance2 = 2 * self.largest ** 2 - 2 * self.largest * kth / norm
                if distance2 <= 2 * (r * self.largest) ** 2:
                    break
        # exact scores by the same sum for equal vectors, so that ties are ties
        if len(where) > k:
            kth = np.partition(near, len(near) - k)[len(near) - k]
            where = where[near >= kth - 1e-5 * self.largest * norm]
        score = (self.vectors[where] * query).sum(axis=1)
        best = np.lexsort((self.ids[where], -score))[:k]
        return where[best], score[best]


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, row (a hash of the vector), v (array<double>) of the rows that take part."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    rows = df.select(F.col(f"`{id_col}`").alias("vec_id"), v.alias("v")).where("vec_id is not null and v is not null")
    big = float("inf")
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < big))
    return rows.where(good & F.exists("v", lambda x: x != 0)).select("vec_id", F.xxhash64("v").alias("row"), "v")


def nearest(df: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding",
            k: int = K, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest inner products found for each query.

    ``is_query`` maps the id column to a boolean column.
    """
    spark = df.sparkSession
    rows = usable(df, id_col, vector_col)
    norm2 = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    # a row for each length of vectors
    stats = rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.max(norm2).alias("top")).collect()
    if not stats:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    largest = {s["dim"]: math.sqrt(s["top"]) * (1 + 1e-9) for s in stats}
    blocks = max(1, -(-sum(s["n"] * s["dim"] * 8 for s in stats) // index_bytes))
    out = pa.schema([("query_id", pa.int64()), ("query_row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def build(dim: int, part) -> BlockIndex:
        return BlockIndex(part.column("vec_id").to_numpy(), matrix(part.column("v"), dim), largest[dim])

    def ask(block: BlockIndex, part: pa.RecordBatch) -> pa.RecordBatch:
        ids, hashes = part.column("vec_id").to_numpy(), part.column("row").to_numpy()
        queries = matrix(part.column("v"), block.vectors.shape[1])
        got = []
        for a in range(0, len(ids), QUERIES):
            low, high = block.windows(queries[a:a + QUERIES])
            for i in range(len(low)):
                where, score = block.search(ids[a + i], queries[a + i], low[i], high[i], k)
                got.append((np.full(len(where), ids[a + i]), np.full(len(where), hashes[a + i]), block.ids[where], score))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), t.type) for x, t in zip(zip(*got, strict=True), out, strict=True)], schema=out)

    # equal rows are spread by their place as well, so that no block takes all of them
    index = rows.select("vec_id", "row", "v", F.monotonically_increasing_id().alias("place"))
    deal = F.pmod(F.xxhash64("vec_id", "row", "place"), F.lit(blocks)).cast("int")
    queries = rows.where(is_query(F.col("vec_id"))).distinct().withColumn("place", F.lit(0).cast("long"))
    found = meet_blocks(index, queries, "v", deal, blocks, many_tasks(spark), build, ask, out,
                        "query_id long, query_row long, vec_id long, score double")
    best = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def neighbours_report(vectors: DataFrame) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20, against all others."""
    return nearest(vectors, lambda c: c % 20 == 0)
