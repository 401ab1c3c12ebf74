"""Quality rules as a short-circuit cascade, on Spark SQL functions only.

Every rule is a condition on features of a text. On a sample of the raw rows the work of
each rule (the elements it visits, counted on the sample's texts) and its rejection rate
are estimated; rules then run in the order of rejection per work inside one ``CASE``,
which Spark evaluates lazily. ``quality_cascade`` builds each feature where its rule
stands in the ``CASE``, so a row that a cheap, selective rule rejects never pays for the
8-word windows. The order changes the work (and which rule is named first), never the
verdict.

``quality_report`` returns every feature of every row, as its contract asks, and so pays
for all of them; its ``CASE`` saves the comparisons only.

Defined cases: a null or empty text has no words and fails ``too_short``; an empty
table gives an empty result; equal rows give equal rows; extra columns are kept by
``quality_cascade`` whatever their names, but for ``rejected_by`` and ``kept``, which it
replaces.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propyield.llm.common import SPACE, fresh

#: Rows of the sample that orders the rules, about. It decides the order only, never a verdict.
SAMPLE_ROWS = 2000
SEED = 17
WINDOW_WORDS = 8
FEATURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_upper", "n_repeat_words")


class Features:
    """The features of a text: expressions over it and its words, or columns that hold them."""

    def __init__(self, text: Column, words: Column, known: bool = False):
        self.text, self.words, self.known = text, words, known

    def _of(self, name: str, build: Callable[[], Column]) -> Column:
        return F.col(name) if self.known else build()

    @property
    def n_chars(self) -> Column:
        return F.length(self.text)

    @property
    def n_words(self) -> Column:
        return self._of("n_words", lambda: F.size(self.words))

    @property
    def word_chars(self) -> Column:
        return self._of("word_chars", lambda: F.length(F.regexp_replace(self.text, SPACE, "")))

    @property
    def n_symbols(self) -> Column:
        return self._of("n_symbols", lambda: self.n_chars - F.length(F.translate(self.text, "#*$%&|<>", "")))

    @property
    def n_upper(self) -> Column:
        return self._of("n_upper", lambda: self.n_chars - F.length(F.regexp_replace(self.text, "[A-Z]+", "")))

    @property
    def lines(self) -> Column:
        return F.filter(F.split(self.text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    @property
    def n_lines(self) -> Column:
        return self._of("n_lines", lambda: F.size(self.lines))

    @property
    def n_dup_lines(self) -> Column:
        return self._of("n_dup_lines", lambda: _let(self.lines, lambda x: F.size(x) - F.size(F.array_distinct(x))))

    @property
    def n_repeat_words(self) -> Column:
        return self._of("n_repeat_words", lambda: _repeated(self.words))


@dataclass(frozen=True)
class Rule:
    """``reject`` says whether a text fails; ``work`` how many elements that looks at."""

    name: str
    reject: Callable[[Features], Column]
    work: Callable[[Features], Column]


def rules() -> list[Rule]:
    """The production rules. Percentages of words; a text fails when one rule rejects it.

    The words are split once for all rules; the work of a rule is what it adds to that.
    """
    one = lambda f: F.lit(1)
    chars = lambda f: f.n_chars
    return [
        Rule("too_short", lambda f: f.n_words < 20, one),
        # each word is hashed in eight windows, and the windows are compared
        Rule("repeated_words", lambda f: 100 * f.n_repeat_words > 30 * f.n_words, lambda f: f.n_chars + 10 * f.n_words),
        Rule("symbols", lambda f: 10 * f.n_symbols > f.n_words, chars),
        Rule("repeated_lines", lambda f: 2 * f.n_dup_lines > f.n_lines, lambda f: 2 * f.n_chars + f.n_lines),
        Rule("word_length", lambda f: (f.word_chars < 2 * f.n_words) | (f.word_chars > 25 * f.n_words), chars),
        Rule("shouting", lambda f: 2 * f.n_upper > f.word_chars, lambda f: 2 * f.n_chars),
    ]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _text_and_words(text_col: str) -> tuple[Column, Column]:
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return text, F.array_remove(F.split(text, SPACE), "")


def _windows(words: Column) -> Column:
    """A 64-bit hash for the window of 8 words that starts at each word."""
    n = F.size(words) - WINDOW_WORDS
    return F.when(n >= 0, F.transform(
        F.sequence(F.lit(1), F.greatest(n, F.lit(0)) + 1),
        lambda i: F.xxhash64(F.slice(words, i, WINDOW_WORDS)))).otherwise(F.array().cast("array<bigint>"))


def _covered(starts: Column) -> Column:
    """How many words the windows at ``starts`` (ascending) cover together."""
    # a window covers its 8 words, or those up to the next window's start
    return F.aggregate(F.transform(starts, lambda x, i: F.least(F.lit(WINDOW_WORDS), F.coalesce(
        F.get(starts, i + 1) - x, F.lit(WINDOW_WORDS)))), F.lit(0), lambda a, x: a + x)


def _repeated(words: Column) -> Column:
    """The words in 8-word windows that are found twice or more, as one expression."""
    def starts(p: Column) -> Column:
        same = lambda i, j: F.coalesce(F.get(p, i)["h"] == F.get(p, j)["h"], F.lit(False))
        twice = F.filter(F.sequence(F.lit(0), F.size(p) - 1), lambda i: same(i, i - 1) | same(i, i + 1))
        return F.sort_array(F.transform(twice, lambda i: F.get(p, i)["i"]))

    def of(h: Column) -> Column:
        # only a text in which two windows agree pays for sorting them
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), _let(_let(pairs, starts), _covered)).otherwise(0)

    return _let(_windows(words), of)


def with_features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The id columns kept, and all ``FEATURES`` of every row, each computed once.

    Columns of ``docs`` that are called like a feature are replaced.
    """
    text, words = _text_and_words(text_col)
    w, lines, h, p, s = (fresh(x) for x in ("words", "lines", "hashes", "pairs", "starts"))
    keep = [F.col(f"`{k}`") for k in docs.columns if k not in FEATURES]
    f = Features(text, words)
    long = lambda c, name: c.cast("long").alias(name)
    step = docs.select(*keep, words.alias(w), f.lines.alias(lines), long(f.n_symbols, "n_symbols"),
                       long(f.n_upper, "n_upper"), long(f.word_chars, "word_chars"))
    step = step.select(*keep, "n_symbols", "n_upper", "word_chars", long(F.size(w), "n_words"), long(F.size(lines), "n_lines"),
                       long(F.size(lines) - F.size(F.array_distinct(lines)), "n_dup_lines"), _windows(F.col(w)).alias(h))
    # only a text in which two windows agree pays for sorting them
    pairs = F.when(F.size(F.array_distinct(h)) < F.size(h),
                   F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))))
    step = step.withColumn(p, pairs).drop(h)
    q = F.col(p)
    same = lambda i, j: F.coalesce(F.get(q, i)["h"] == F.get(q, j)["h"], F.lit(False))
    twice = F.filter(F.sequence(F.lit(0), F.size(q) - 1), lambda i: same(i, i - 1) | same(i, i + 1))
    step = step.withColumn(s, F.when(q.isNotNull(), F.sort_array(F.transform(twice, lambda i: F.get(q, i)["i"])))).drop(p)
    return step.withColumn("n_repeat_words", F.coalesce(_covered(F.col(s)), F.lit(0)).cast("long")).drop(s)


def order_rules(docs: DataFrame, rule_list: Sequence[Rule], text_col: str = "text",
                sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by rejection per work, highest first, estimated on about ``sample_rows`` rows.

    The raw rows are sampled, their features computed and summed up where they are: one row
    a task is all that moves.
    """
    n = docs.count()
    if not n:
        return list(rule_list)
    sample = docs.select(F.col(f"`{text_col}`").alias("text")).sample(min(1.0, sample_rows / n), SEED)
    features = with_features(sample.withColumn("text", F.coalesce("text", F.lit(""))))
    f = Features(F.col("text"), F.array(), known=True)
    got = features.agg(
        *[F.sum(F.coalesce(r.reject(f), F.lit(False)).cast("long")).alias(f"r{i}") for i, r in enumerate(rule_list)],
        *[F.sum(r.work(f).cast("double")).alias(f"w{i}") for i, r in enumerate(rule_list)]).first()

    def worth(i: int) -> float:
        return (got[f"r{i}"] or 0) / (got[f"w{i}"] or 1.0)

    return [rule_list[i] for i in sorted(range(len(rule_list)), key=lambda i: (-worth(i), got[f"w{i}"] or 0.0, i))]


def first_rejection(ordered: Sequence[Rule], f: Features) -> Column:
    """The name of the first rule of the cascade that rejects the text, or null."""
    out = F.when(F.coalesce(ordered[0].reject(f), F.lit(False)), F.lit(ordered[0].name))
    for r in ordered[1:]:
        out = out.when(F.coalesce(r.reject(f), F.lit(False)), F.lit(r.name))
    return out.otherwise(F.lit(None).cast("string"))


def quality_cascade(docs: DataFrame, text_col: str = "text",
                    rule_list: Sequence[Rule] | None = None) -> DataFrame:
    """``docs`` with ``rejected_by`` (null: none) and ``kept``; features are built in the ``CASE``."""
    ordered = order_rules(docs, list(rule_list or rules()), text_col)
    text, words = _text_and_words(text_col)
    rejected = _let(words, lambda w: first_rejection(ordered, Features(text, w)))
    name = fresh("rejected")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("rejected_by", "kept")]
    return docs.withColumn(name, rejected).select(*kept, F.col(name).alias("rejected_by"), F.col(name).isNull().alias("kept"))


def quality_report(docs: DataFrame) -> DataFrame:
    """The digest of the rules per document, with every feature."""
    docs = docs.select("doc_id", "text")
    ordered = order_rules(docs, rules())
    f = Features(F.col("text"), F.array(), known=True)
    failed = (f.n_words < 20) | (100 * f.n_repeat_words > 30 * f.n_words)
    kept = first_rejection(ordered, f).isNull()
    return with_features(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                      failed.alias("base_failed"), (~failed & kept).alias("kept"))
