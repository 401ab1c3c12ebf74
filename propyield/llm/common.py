"""Helpers shared by the text operators: words, checked inputs and Arrow batches."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of anything but the space and the five ASCII white spaces.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

#: Rows a task hands to Python at once; with Spark's own byte bound of a batch this
#: keeps a worker's memory independent of the table.
BATCH_ROWS = 1000


def words_of(text: bytes | None) -> list[bytes]:
    """The lower-cased (A-Z only) words of UTF-8 text; null has none.

    ``bytes.lower`` touches A-Z only and ``bytes.split`` cuts at exactly the six
    ASCII white spaces, so both work on the raw UTF-8 bytes.
    """
    return text.lower().split() if text else []


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of an Arrow batch for this session (never raised)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def map_batches(df: DataFrame, fn: Callable[..., dict], schema: str) -> DataFrame:
    """Run ``fn(*columns as Python lists) -> {column: values}`` on each Arrow batch.

    The values are converted with the Arrow types of ``schema``; no row is kept
    between batches, so a lost task is simply run again.
    """
    small_batches(df.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(_parsed(df.sparkSession, schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = fn(*[c.to_pylist() for c in batch.columns])
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[f.name], type=f.type) for f in target], schema=target)

    return df.mapInArrow(run, schema)


def _parsed(spark: SparkSession, ddl: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl)


def fresh(prefix: str) -> str:
    """A column name that no input column can clash with."""
    return f"__{prefix}_{uuid.uuid4().hex[:8]}"


def keep_columns(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text, under fixed names (extra columns cannot clash)."""
    return df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))


def span_digest(spans: DataFrame, base_kinds: tuple[str, ...]) -> DataFrame:
    """Counts of the base kinds, the hash of the base spans, and all spans as text."""
    def text(a):
        return F.array_join(F.transform(a, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*base_kinds))
    return spans.select("doc_id", *[count(k) for k in base_kinds],
                        F.sha2(text(base).cast("binary"), 256).alias("base_sha256"),
                        text(F.col("spans")).alias("spans"))


#: Distinct pieces a task counts before it hands them on.
FLUSH = 200_000


def count_pieces(texts: DataFrame, pieces_of: Callable[..., list[bytes] | list[str]]) -> DataFrame:
    """word (binary), n: how often each piece occurs in the one column of ``texts``.

    Pieces are summed within tasks first, in tables of bounded size.
    """
    small_batches(texts.sparkSession)
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def counted(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts)).cast(pa.binary()) if counts else pa.array([], pa.binary()), pa.array(list(counts.values()), pa.int64())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(pieces_of(text))
            if len(counts) > FLUSH:
                yield counted(counts)
                counts = Counter()
        yield counted(counts)

    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_grade(counts: DataFrame, limit: int, max_bytes: int) -> DataFrame:
    """The rows of ``counts`` with the highest counts: ``limit`` at most, by whole grades.

    A grade is a sixteenth of a doubling; no sort of the table is needed. Longer
    pieces than ``max_bytes`` are left out, so the result's bytes are bounded too.
    """
    rows = counts.where(F.length("word") <= max_bytes).withColumn("grade", F.floor(F.log2("n") * 16).cast("int"))
    taken, floor = 0, None
    for r in rows.groupBy("grade").agg(F.count(F.lit(1)).alias("w")).orderBy(F.desc("grade")).collect():
        taken += r["w"]
        if taken > limit:
            break
        floor = r["grade"]
    return rows.where(F.lit(False) if floor is None else F.col("grade") >= floor).select("word", "n")


def frequent_pieces(counts: DataFrame, limit: int, max_bytes: int) -> list[tuple[bytes, int]]:
    """``frequent_grade`` on the driver, by falling count, then bytes."""
    got = frequent_grade(counts, limit, max_bytes).toArrow()
    pairs = zip(got["word"].to_pylist(), got["n"].to_pylist(), strict=True)
    return sorted(pairs, key=lambda x: (-x[1], x[0]))


def meet_blocks(index: DataFrame, asked: DataFrame, vector: str, block: Column, blocks: int, tasks: int,
                build: Callable[[int, pa.RecordBatch], object], ask: Callable[[object, pa.RecordBatch], pa.RecordBatch],
                out: pa.Schema, ddl: str) -> DataFrame:
    """What ``ask(build(dim, rows of a block), rows asked)`` gives for every block and all of ``asked``.

    ``index`` is dealt to ``blocks`` blocks by ``block`` (per length of ``vector``); ``asked``, which
    must have the same columns, is copied to each block. A task sorts a block's rows before
    what is asked of it, holds the block and streams the rest past it, a batch at a time.
    """
    key = ["__dim", "__block", "__asked"]
    dim = F.size(vector).alias("__dim")
    dealt = index.select(dim, block.alias("__block"), F.lit(0).alias("__asked"), *index.columns).unionByName(
        asked.select(dim, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("__block"), F.lit(1).alias("__asked"), *index.columns))
    dealt = dealt.repartition(tasks, "__dim", "__block").sortWithinPartitions(*key, "vec_id", "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, made = None, [], None
        for batch in batches:
            where = np.stack([batch.column(n).to_numpy() for n in key], axis=1)
            cuts = (np.flatnonzero((where[1:] != where[:-1]).any(axis=1)) + 1).tolist()
            for lo, hi in zip([0, *cuts], [*cuts, len(where)], strict=True):
                if lo == hi:
                    continue
                dim, number, later = where[lo].tolist()
                if (dim, number) != at:
                    at, held, made = (dim, number), [], None
                part = batch.slice(lo, hi - lo)
                if not later:
                    held.append(part)
                elif held:  # else no row of this length is in the block
                    if made is None:
                        made = build(dim, pa.Table.from_batches(held).combine_chunks())
                    yield ask(made, part)

    small_batches(index.sparkSession)
    return dealt.mapInArrow(run, ddl)


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """A column of lists of ``dim`` doubles as rows of a matrix."""
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), dim)


def many_tasks(spark: SparkSession) -> int:
    """Tasks for work that takes long a byte, which the planner would merge by its bytes."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
