"""Hard negatives of anchor vectors: other labels, scored close under a positive.

Vectors are quantised (``floor(256 * x)``); a score is an exact integer inner product.
Rows are dealt to blocks of bounded bytes and anchors are copied to every block (never
the rows to the anchors); a task holds one block and streams the anchors past it.

1. *Positives.* Each block gives its best rows of the anchor's label; the best of all
   blocks are the anchor's positives.
2. *Candidates.* Anchors return to the blocks with the score windows of their
   positives. A block hands on its first ``negatives`` rows of each window: a row behind
   them in its own block cannot be among the first of all blocks.
3. *Secondary sort.* Positives and candidates get one packed key: anchor, falling score,
   positives first, id. ``repartitionAndSortWithinPartitions`` brings each anchor's rows
   to one partition in that order, where an iterator opens a window at each positive
   and emits the negatives that fall into the open ones. It holds an anchor's open
   windows only, never its rows.

Defined cases: rows with a null label, a null vector, or a null or non-finite component
take no part, nor do rows with a null id; an empty vector scores 0. Equal rows (id,
label, vector) count once. Different rows of one id are rows of their own: each is an
anchor if the id says so, and a candidate of the others. Vectors of different length
are never compared. Quantised components are cut to 2^60, scores to 63 bits. An empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propyield.llm.common import many_tasks, matrix, meet_blocks
from propyield.session import scratch_path

POSITIVES, NEGATIVES = 5, 10
#: Lowest and highest score of a negative, in hundredths of the positive's.
LOW, HIGH = 30, 90
#: Bytes of the quantised vectors of one block, about.
BLOCK_BYTES = 1 << 24
#: Anchors that meet a block at once.
ANCHORS = 64
#: Components and scores are cut to these.
_LARGEST, _LAST = 2.0 ** 60, (1 << 63) - 1

ROWS = "vec_id long, label long, row long, q array<double>"


def quantised(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
              label_col: str = "label") -> DataFrame:
    """vec_id, label, row (a hash of the row), q: the rows that take part, each once."""
    kept = rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("long").alias("label"),
                       F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = kept.where("vec_id is not null and label is not null and v is not null").where(finite)

    def whole(x):
        cut = F.least(F.greatest(x * 256, F.lit(-_LARGEST)), F.lit(_LARGEST))
        return F.floor(cut).cast("double")

    return kept.select("vec_id", "label", F.xxhash64("label", "v").alias("row"),
                       F.transform("v", whole).alias("q")).distinct()


def products(anchors: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The exact inner products (long) of whole-numbered vectors."""
    top = block.shape[1] * float(np.abs(anchors).max(initial=0)) * float(np.abs(block).max(initial=0))
    if top < 2.0 ** 53:
        return (anchors @ block.T).astype(np.int64)
    if top < 2.0 ** 62:
        return anchors.astype(np.int64) @ block.astype(np.int64).T
    big = [[min(max(sum(int(x) * int(y) for x, y in zip(a, b, strict=True)), -_LAST), _LAST) for b in block] for a in anchors]
    return np.array(big, dtype=np.int64).reshape(len(anchors), len(block))


def first(scores: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` of the places ``at`` (ascending) with the highest scores, ties by place."""
    v = scores[at]
    if len(at) > k:
        kth = np.partition(v, len(v) - k)[len(v) - k]
        above = at[v > kth]
        at = np.concatenate([above, at[v == kth][:k - len(above)]])
    return at[np.lexsort((at, -scores[at]))]


def window(score: int, low: int = LOW, high: int = HIGH) -> tuple[int, int]:
    """The scores s with low * score <= 100 * s <= high * score."""
    return -(-low * score // 100), high * score // 100


class Block:
    """Rows of one block in order of id, which anchors stream past."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, q: np.ndarray):
        self.ids, self.labels, self.rows, self.q = ids, labels, rows, q

    def positives(self, scores: np.ndarray, anchor: tuple[int, int, int], k: int) -> np.ndarray:
        vec_id, label, row = anchor
        at = np.flatnonzero((self.labels == label) & ~((self.ids == vec_id) & (self.rows == row)))
        return first(scores, at, k)

    def negatives(self, scores: np.ndarray, label: int, windows: list[tuple[int, int]], k: int) -> np.ndarray:
        """Places of the first ``k`` rows of another label in each window."""
        other = self.labels != label
        found = [first(scores, np.flatnonzero(other & (scores >= lo) & (scores <= hi)), k) for lo, hi in windows]
        return np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.int64)


def meet(rows: DataFrame, anchors: DataFrame, blocks: int, tasks: int,
         pick: Callable[[Block, np.ndarray, tuple, list], np.ndarray]) -> DataFrame:
    """anchor_id, anchor_row, vec_id, row, score: what ``pick`` takes of each block for each anchor.

    ``anchors`` has the columns of ``rows`` and ``windows`` (the positives' scores).
    """
    out = pa.schema([(n, pa.int64()) for n in ("anchor_id", "anchor_row", "vec_id", "row", "score")])

    def build(dim: int, part) -> Block:
        return Block(*(part.column(n).to_numpy() for n in ("vec_id", "label", "row")), matrix(part.column("q"), dim))

    def ask(block: Block, part: pa.RecordBatch) -> pa.RecordBatch:
        ids, labels, rows_ = (part.column(n).to_numpy() for n in ("vec_id", "label", "row"))
        q, windows = matrix(part.column("q"), block.q.shape[1]), part.column("windows").to_pylist()
        got = []
        for a in range(0, len(ids), ANCHORS):
            for i, s in enumerate(products(q[a:a + ANCHORS], block.q), start=a):
                places = pick(block, s, (ids[i], labels[i], rows_[i]), windows[i])
                got.append((np.full(len(places), ids[i]), np.full(len(places), rows_[i]),
                            block.ids[places], block.rows[places], s[places]))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in zip(*got, strict=True)], schema=out)

    index = rows.select("vec_id", "label", "row", "q", F.lit(None).cast("array<long>").alias("windows"))
    deal = F.pmod(F.xxhash64("vec_id", "row"), F.lit(blocks)).cast("int")
    return meet_blocks(index, anchors.select(*index.columns), "q", deal, blocks, tasks, build, ask, out,
                       "anchor_id long, anchor_row long, vec_id long, row long, score long")


#: Anchor (id, row), falling score, kind (positives first), id: bytes that sort as these do.
KEY = ">QQQBQ"
_SHIFT = 1 << 63


def packed(anchor_id: int, anchor_row: int, score: int, negative: bool, vec_id: int) -> bytes:
    return struct.pack(KEY, anchor_id + _SHIFT, anchor_row + _SHIFT, _LAST - score, negative, vec_id + _SHIFT)


def open_windows(keys: Iterator[tuple[bytes, None]], negatives: int, low: int, high: int) -> Iterator[tuple]:
    """The negatives of each positive from sorted keys; holds the open windows of one anchor."""
    at, opened = None, []
    for key, _ in keys:
        anchor_id, row, falling, negative, vec_id = struct.unpack(KEY, key)
        anchor_id, score, vec_id = anchor_id - _SHIFT, _LAST - falling, vec_id - _SHIFT
        if (anchor_id, row) != at:
            at, opened = (anchor_id, row), []
        if not negative:
            opened.append([vec_id, score, *window(score, low, high), 0])
            continue
        for w in opened:
            if w[4] < negatives and w[2] <= score <= w[3]:
                w[4] += 1
                yield anchor_id, w[0], w[4], vec_id, w[1], score


def hard_negatives(rows: DataFrame, is_anchor: Callable[[Column], Column], positives: int = POSITIVES,
                   negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` as from ``quantised``; ``is_anchor`` maps the id column to a boolean column.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "mining-rows")
    rows.write.parquet(path)
    rows = spark.read.schema(ROWS).parquet(path)
    cells = rows.agg(F.sum(F.size("q") + 3)).collect()[0][0] or 0
    blocks = max(1, -(-cells * 8 // block_bytes))
    tasks = many_tasks(spark)
    anchors = rows.where(is_anchor(F.col("vec_id")))

    found = meet(rows, anchors.withColumn("windows", F.lit(None).cast("array<long>")), blocks, tasks,
                 lambda block, scores, anchor, _: block.positives(scores, anchor, positives))
    of_anchor = Window.partitionBy("anchor_id", "anchor_row").orderBy(F.desc("score"), "vec_id", "row")
    path = scratch_path(spark, "mining-positives")
    found.withColumn("place", F.row_number().over(of_anchor)).where(F.col("place") <= positives).write.parquet(path)
    best = spark.read.parquet(path)

    scores = best.groupBy(F.col("anchor_id").alias("vec_id"), F.col("anchor_row").alias("row")).agg(
        F.collect_set("score").alias("windows"))
    near = meet(rows, anchors.join(scores, ["vec_id", "row"]), blocks, tasks,
                lambda block, scores, anchor, known: block.negatives(
                    scores, anchor[1], [window(s, low, high) for s in known], negatives))
    columns = ["anchor_id", "anchor_row", "score", "negative", "vec_id"]
    pairs = (best.withColumn("negative", F.lit(False)).select(*columns)
             .union(near.withColumn("negative", F.lit(True)).select(*columns)))
    sorted_keys = pairs.rdd.map(lambda r: (packed(*r), None)).repartitionAndSortWithinPartitions(
        tasks, lambda key: zlib.crc32(key[:16]))
    mined = sorted_keys.mapPartitions(lambda keys: open_windows(keys, negatives, low, high))
    return spark.createDataFrame(mined, T.StructType.fromDDL(
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"))


def mining_report(vectors: DataFrame) -> DataFrame:
    """Hard negatives of every vector whose id is divisible by 100, after every seventh
    id's label has moved one on."""
    rows = vectors.select("vec_id", "embedding", F.when(
        F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return hard_negatives(quantised(rows), lambda c: c % 100 == 0)
