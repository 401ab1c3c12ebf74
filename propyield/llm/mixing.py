"""Mixing sources to target weights along a time-varying curriculum.

Targets: sources share all words by weight; a source may be repeated at most
``max_epochs`` times, and what it cannot take is shared again by weight among the
others until none is above (the level at which this settles is found directly, from
the sources in the order of cap / weight).

Curriculum: each source has a linear weight schedule over training time 0..1
(early sources fall, late ones rise). Its integral is the share of the target that
is due by a time; inverting it at a document's place in its source's cumulative
words gives the document's training position. Documents stand in a hashed order
within their source and epoch, so the mix takes whole epochs and then the head of
the next one.

Cumulative words need no pass over a whole source in one task: words are first
summed per (source, hash bucket), the buckets' offsets are added up over that small
table, and the running sum within a bucket is a window over that bucket alone.

Defined cases: a null text has size 0 and is never due (taken 0); a null source is
a source of its own, last in order; equal rows stand next to each other and count
each; an empty table gives an empty result; extra columns are ignored by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propyield.llm.common import WORD, fresh
from propyield.session import scratch_path

MAX_EPOCHS = 3
#: Hash buckets a source is cut into for its running sums; a bucket's rows are sorted
#: in one task, the offsets of a source's buckets are added up in one task.
BUCKETS = 1024


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(per_source: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size -> also weight (1, 2, 3, repeating) and target (double).

    One row per source: the only step that orders sources against each other, on a
    table of as many rows as there are sources.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = per_source.withColumn("weight", (F.row_number().over(by_name) - 1) % 3 + 1)
    cap = F.col("source_size") * max_epochs
    ratio = Window.orderBy((cap / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    step = (ranked.withColumn("__cap", cap)
            .withColumn("__total", F.sum("source_size").over(whole))
            .withColumn("__left", F.col("__total") - F.coalesce(F.sum("__cap").over(before), F.lit(0)))
            .withColumn("__w", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
            # capped: with all before it at their caps, its share of the rest is above its own cap
            .withColumn("__full", F.col("__cap") * F.col("__w") < F.col("weight") * F.col("__left")))
    # of the sources not capped the first in the order of ratio has the largest rest weight
    first = F.max(F.when(~F.col("__full"), F.struct("__w", "__left"))).over(whole)
    return (step.withColumn("__first", first)
            .withColumn("target", F.when(F.col("__full"), F.col("__cap").cast("double")).otherwise(
                F.col("weight") * F.col("__first")["__left"] / F.col("__first")["__w"]))
            .drop("__cap", "__total", "__left", "__w", "__full", "__first"))


def schedule_inverse(share: Column, weight: Column) -> Column:
    """The time by which ``share`` (0..1) of a source's target is due.

    The source's density over time is ``1 + a (2t - 1)`` with a = -0.5, 0, 0.5 for
    weights 1, 2, 3: its integral is ``(1 - a) t + a t^2``, solved for t.
    """
    a = (weight - 2) * 0.5
    b = 1 - a
    root = (F.sqrt(b * b + 4 * a * share) - b) / (2 * a)
    return F.when(a == 0, share).otherwise(root)


def _keys(docs: DataFrame, id_col: str, text_col: str, seed: int) -> list[Column]:
    """Two hashes of id and text: the documents' random order, and what equal rows share."""
    parts = [F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))]
    return [F.xxhash64(F.lit(seed), *parts).alias("key"), F.xxhash64(F.lit(seed + 1), *parts).alias("key2")]


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        buckets: int = BUCKETS, max_epochs: int = MAX_EPOCHS, seed: int = 7) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, taken, copies, position.

    ``copies`` epochs of the document enter the mix (taken = copies * size) and
    ``position`` (null if none) is the training time of the first. ``start`` is its
    place in an epoch's words; ``key`` and ``key2`` are shared by equal rows only.
    """
    base = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"),
        F.coalesce(F.concat(F.lit("="), F.col(f"`{source_col}`").cast("string")), F.lit("")).alias("name"),
        word_count(F.col(f"`{text_col}`")).alias("size"), *_keys(docs, id_col, text_col, seed))
    base = base.withColumn("bucket", F.pmod(F.shiftrightunsigned("key", 20), F.lit(buckets)))
    # the texts are read and counted once; no text from here on
    path = scratch_path(docs.sparkSession, "mixing-sizes")
    base.write.parquet(path)
    base = docs.sparkSession.read.schema(base.schema).parquet(path)
    sums = base.groupBy("name", "bucket").agg(F.sum("size").alias("n"), F.max("source").alias("source"))
    goal = targets(sums.groupBy("name").agg(F.sum("n").alias("source_size"), F.max("source").alias("source")),
                   max_epochs).drop("source")
    before = Window.partitionBy("name").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (sums.select("name", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
               .join(goal, "name"))
    rows = base.join(offsets, ["name", "bucket"])
    within = (Window.partitionBy("name", "bucket").orderBy("key", "key2")
              .rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("start", F.col("offset") + F.coalesce(F.sum("size").over(within), F.lit(0)))
    size = F.col("size")
    # an epoch takes the document when its middle lies before the words still due
    due = F.floor((F.col("target") - F.col("start") - size / 2) / F.col("source_size")) + 1
    copies = F.when(size > 0, F.greatest(F.lit(0), F.least(F.lit(max_epochs), due))).otherwise(0)
    return (rows.withColumn("copies", copies.cast("int"))
            .select("doc_id", "source", "size", "source_size", "weight", "target",
                    (F.col("copies") * size).cast("long").alias("taken"), "copies",
                    F.when(F.col("copies") > 0, position(F.lit(0))).alias("position"),
                    "start", "key", "key2"))


def position(epoch: Column) -> Column:
    """The training time of a document's copy in ``epoch`` (0, 1, ...)."""
    middle = F.col("start") + epoch * F.col("source_size") + F.col("size") / 2
    return schedule_inverse(F.least(F.lit(1.0), middle / F.col("target")), F.col("weight"))


def mix_report(docs: DataFrame) -> DataFrame:
    """The digest of ``mix`` per document, in training order (documents left out first)."""
    cols = ["doc_id", "size", "source_size", "target", "taken", "copies", "position"]
    return mix(docs).select(*cols).orderBy("position", "doc_id")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", seed: int = 7) -> DataFrame:
    """The documents of the mix: each as often as it is taken, in training order.

    The mix is settled on narrow rows; the texts are shuffled once to meet it and once
    into ranges of positions. Equal rows are matched with the mix by their number.
    """
    k1, k2, no, at = (fresh(x) for x in ("key", "key2", "no", "at"))
    number = lambda order: F.row_number().over(Window.partitionBy(k1, k2).orderBy(order))
    plan = mix(docs, id_col, text_col, source_col, seed=seed)
    plan = (plan.withColumnsRenamed({"key": k1, "key2": k2}).withColumn(no, number(F.col("start")))
            .where("copies > 0")
            .select(F.col(k1).alias("a"), F.col(k2).alias("b"), F.col(no).alias("c"),
                    F.transform(F.sequence(F.lit(0), F.col("copies") - 1), position).alias("times")))
    keys = _keys(docs, id_col, text_col, seed)
    texts = docs.select("*", keys[0].alias(k1), keys[1].alias(k2)).withColumn(no, number(F.lit(0)))
    side = plan.select(*[F.col(c).alias(f"{no}_{c}") for c in plan.columns])
    # the number is compared by a difference, so that both sides keep their partitioning by key
    mixed = texts.join(side, (F.col(k1) == F.col(f"{no}_a")) & (F.col(k2) == F.col(f"{no}_b"))
                       & ((F.col(no) - F.col(f"{no}_c")) == 0))
    out = mixed.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(f"{no}_times").alias(at))
    return (out.repartitionByRange(F.col(at), F.col(f"`{id_col}`")).sortWithinPartitions(at, f"`{id_col}`")
            .select(*[F.col(f"`{c}`") for c in docs.columns]))

