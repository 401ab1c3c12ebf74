"""Spelling variants: words that differ by one inserted, deleted or replaced letter.

Words are counted first (partial sums in each task). Two words at distance one agree on
their first half or on their last half, where a half is half the shorter word's length,
rounded down. So each word stands in the groups of its beginnings and of its endings,
and each group has its own **bit-sliced position index**: for every length, position
and letter one bitset over the group's words. A word runs through its group's index
with two word-parallel recurrences at once: the set that agrees so far (no error) and
the set with exactly one error, whose positions are shifted by one after an inserted
or deleted letter. Bits stand in order of falling count, so the number of near words is
the popcount of the final set and the most frequent near word its lowest bit: a group
hands on one row for each of its words, never a pair.

Groups are cut into index blocks of ``BLOCK`` letters; all words of the group stream through
each of its blocks, so no group has to fit into one task.

Defined cases: a null or empty text has no words; a null id stands as empty text before
the colon of the hashed string; each row counts, repeated ones too; ties go to the
smaller word in code-point order; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propyield.llm.common import FLUSH, keep_columns, many_tasks, small_batches
from propyield.session import scratch_path

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: One run in so many loses a letter.
NOISE = 97
#: Letters of the words of one index block. Its bitsets (a bit for each word; one for each
#: length, position and letter) then take some megabytes, however long the words are.
BLOCK = 1 << 19
MIN_LENGTH, MIN_COUNT = 5, 3


def noisy(doc_id: str, run: str) -> str:
    """The lower-cased run, without one letter if the hash of id and run says so."""
    run = run.translate(_LOWER)
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % NOISE:
        return run
    i = h % len(run)
    return run[:i] + run[i + 1:]


_LOWER = {c: c + 32 for c in range(65, 91)}


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n: the words of all whole texts with at least so many letters and occurrences."""
    small_batches(docs.sparkSession)
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def counted(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for found, times in Counter(RUN.findall(text or "")).items():
                    word = noisy(doc_id, found)
                    if len(word) >= min_length:
                        counts[word] += times
                if len(counts) > FLUSH:
                    yield counted(counts)
                    counts = Counter()
        yield counted(counts)

    texts = keep_columns(docs, id_col, text_col).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text")
    return (texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= min_count))


class PositionIndex:
    """Bitsets over the words of one block: by length, position and letter.

    All words share their first ``half`` letters. Words are added in order of falling
    count, ties by code point; bit ``i`` is the i-th word.
    """

    def __init__(self, words: list[str], half: int):
        self.half = half
        self.every: dict[int, int] = {}
        self.at: dict[tuple[int, int, str], int] = {}
        bits: dict[tuple, bytearray] = {}
        size = (len(words) + 7) // 8
        for i, w in enumerate(words):
            for key in [(len(w),), *((len(w), j, c) for j, c in enumerate(w))]:
                row = bits.get(key)
                if row is None:
                    row = bits[key] = bytearray(size)
                row[i >> 3] |= 1 << (i & 7)
        for key, row in bits.items():
            (self.every if len(key) == 1 else self.at)[key[0] if len(key) == 1 else key] = int.from_bytes(row, "little")

    def replaced(self, q: str) -> int:
        """Words of the same length with exactly one other letter."""
        n = len(q)
        none, one = self.every.get(n, 0), 0
        for j in range(self.half, n):
            hit = self.at.get((n, j, q[j]), 0)
            same = none & hit
            one = (one & hit) | (none ^ same)
            none = same
            if not one | none:
                break
        return one

    def inserted(self, q: str) -> int:
        """Words that have one more letter: after it, their positions are one ahead."""
        n = len(q) + 1
        none = one = self.every.get(n, 0)
        for j in range(self.half, len(q)):
            if not one:
                break
            one &= self.at.get((n, j + 1, q[j]), 0)
            none &= self.at.get((n, j, q[j]), 0)
            one |= none
        return one

    def deleted(self, q: str) -> int:
        """Words that lack one letter of ``q``: after it, their positions are one behind."""
        n = len(q) - 1
        none, one = self.every.get(n, 0), 0
        for j in range(self.half, len(q)):
            one = (one & self.at.get((n, j - 1, q[j]), 0)) | none
            none &= self.at.get((n, j, q[j]), 0)
            if not one | none:
                break
        return one

    def agreeing(self, q: str, n: int, last: int) -> int:
        """Words of ``n`` letters that agree with ``q`` on the last ``last`` letters."""
        found = self.every.get(n, 0)
        for j in range(1, last + 1):
            if not found:
                break
            found &= self.at.get((n, n - j, q[len(q) - j]), 0)
        return found

    def near(self, q: str, ending: bool) -> int:
        """All words at distance one whose shared half with ``q`` is this group's.

        In a group of endings (words are reversed there) those that also share their
        beginning are left to the group of beginnings.
        """
        found = 0
        for n, step in ((len(q), self.replaced), (len(q) + 1, self.inserted), (len(q) - 1, self.deleted)):
            if min(n, len(q)) // 2 == self.half and n in self.every:
                one = step(q)
                if one and ending:
                    one &= ~self.agreeing(q, n, self.half)
                found |= one
        return found


def in_groups(words: DataFrame) -> DataFrame:
    """side, half, part: each word under its beginnings and endings of the halves it can share."""
    halves = F.array_distinct(F.array(F.floor((F.length("word") - 1) / 2), F.floor(F.length("word") / 2)).cast("array<int>"))
    both = words.select("word", "n", F.explode(halves).alias("half"))
    sides = F.explode(F.array(
        F.struct(F.lit(False).alias("ending"), F.col("word").alias("form")),
        F.struct(F.lit(True).alias("ending"), F.reverse("word").alias("form"))))
    return both.select("n", "half", sides.alias("s")).select(
        "n", "half", "s.ending", "s.form", F.expr("substring(s.form, 1, half)").alias("part"))


def near_counts(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """word, n_near, form, form_n for the words that have a near word.

    ``words`` (word, n; distinct words) is read twice: pass a written table.
    """
    spark = words.sparkSession
    groups = in_groups(words)
    # groups of more than a block's letters are rare; they alone get several blocks
    blocks = (groups.groupBy("ending", "half", "part").agg(F.sum(F.length("form")).alias("size")).where(F.col("size") > block)
              .select("ending", "half", "part", F.ceil(F.col("size") / block).cast("int").alias("blocks")))
    placed = groups.join(blocks, ["ending", "half", "part"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("form"), F.col("blocks")).cast("int")
    # a word is indexed in its own block and asked in all blocks of its group
    dealt = placed.select("ending", "half", "part", "form", "n", own.alias("own"),
                          F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    dealt = dealt.select("ending", "half", "part", "block", "form", "n", (F.col("own") == F.col("block")).alias("indexed"),
                         F.when(F.col("ending"), F.reverse("form")).otherwise(F.col("form")).alias("word"))
    key = ["ending", "half", "part", "block"]
    # the rows of a block come together, the indexed ones first, by falling count and word
    ordered = dealt.repartition(many_tasks(spark), *key).sortWithinPartitions(*key, F.desc("indexed"), F.desc("n"), "word")
    out = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form", pa.string()), ("form_n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, index = None, [], None
        got: list[tuple] = []

        def ask(word: str, form: str):
            hit = index.near(form, at[0])
            if hit:
                best = held[(hit & -hit).bit_length() - 1]
                got.append((word, hit.bit_count(), best[0], best[2]))

        def close():
            nonlocal index
            if at is not None and index is None:
                index = PositionIndex([h[1] for h in held], at[1]) if len(held) > 1 or at[3] else None
                if index is not None:
                    for word, form, _ in held:
                        ask(word, form)

        for batch in batches:
            cols = [batch.column(n).to_pylist() for n in (*key, "word", "form", "n", "indexed")]
            for *where, word, form, n, indexed in zip(*cols, strict=True):
                if where != at:
                    close()
                    at, held, index = where, [], None
                if indexed:
                    held.append((word, form, n))
                    continue
                if index is None:  # the first word of another block of the group
                    index = PositionIndex([h[1] for h in held], at[1])
                    for w, f, _ in held:
                        ask(w, f)
                ask(word, form)
            yield pa.RecordBatch.from_arrays([pa.array([g[i] for g in got], t.type) for i, t in enumerate(out)], schema=out)
            got.clear()
        close()
        yield pa.RecordBatch.from_arrays([pa.array([g[i] for g in got], t.type) for i, t in enumerate(out)], schema=out)

    small_batches(spark)
    found = ordered.select(*key, "word", "form", "n", "indexed").mapInArrow(
        run, "word string, n_near long, form string, form_n long")
    # of a word's few groups: all near words, and the most frequent of the best ones
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root for the words of ``forms`` (word, form): forms followed to the last.

    Pointer doubling: each round joins every word's root with that root's own. Counts at
    least double along a chain, so a few rounds end it.
    """
    spark = forms.sparkSession
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        path = scratch_path(spark, "spelling-roots")
        step = now.alias("a").join(now.alias("b"), F.col("a.root") == F.col("b.word"), "left").select(
            "a.word", F.coalesce("b.root", "a.root").alias("root"), F.col("b.word").isNotNull().alias("moved"))
        step.write.parquet(path)
        now = spark.read.parquet(path)
        if now.where("moved").limit(1).count() == 0:
            return now.select("word", "root")
        now = now.select("word", "root")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, block: int = BLOCK) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of the texts.

    ``form`` is the most frequent near word, if it is at least twice as frequent.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "spelling-words")
    word_counts(docs, id_col, text_col, min_length, min_count).write.parquet(path)
    words = spark.read.parquet(path)
    path = scratch_path(spark, "spelling-near")
    judged = words.join(near_counts(words, block), "word", "left")
    taken = F.col("form_n") >= 2 * F.col("n")
    judged.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                  F.when(taken, F.col("form")).alias("form"),
                  F.when(taken, F.col("form_n")).alias("form_n")).write.parquet(path)
    judged = spark.read.parquet(path)
    ends = roots(judged.where("form is not null").select("word", "form"))
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
