"""Toxicity severity by cumulative-link ordinal regression over sparse text features.

Model: for ordered grades 0 < 1 < 2, P(grade > k | x) = sigmoid(w.x - theta_k), with
one weight vector shared by both thresholds, theta_0 < theta_1. Expected severity is
the sum of the two probabilities; a text is toxic when P(grade > 0) >= 0.5.

Features: the distinct words of the whole text (A-Z lowered, punctuation around them
stripped) and their beginnings of 4 to 6 bytes, those that the labelled sample ties
to toxicity (chi-square), present or not, so a long text is judged like a short one.

Grades: labels hold one bit. Rows not toxic have grade 0. Among toxic rows the distinct
words that nearly only toxic rows use are counted: above the median number the grade
is 2 (severe), else 1. (A share of the words would contradict the model: long texts
have more features and a smaller share.)

The fit uses at most ``SAMPLE_ROWS`` labelled rows of different texts (a documented bound,
chosen by the hash of the id, then of the text); every feature that passes the test on
them is in the model. Scoring reads every row and its whole text.

Defined cases: a null or empty text has no features and gets the model's base
severity; rows without a label are scored all the same; without labelled rows of
both kinds nothing is toxic (severity 0); repeated labels of an id count once, toxic
if any is; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from propyield.llm.common import map_batches, small_batches, words_of

#: Labelled rows that the classifier is fitted on, at most.
SAMPLE_ROWS = 16384
#: The chi-square that a feature of the model must reach.
MIN_CHI2 = 25.0
PREFIXES = (4, 5, 6)
#: Features that a task counts before it hands them on.
TALLY = 100_000
_STRIP = b".,;:!?\"'()[]{}<>*#$%&|-_"


def word_features(word: bytes) -> set[bytes]:
    w = word.strip(_STRIP)
    return {b"=" + w, *(b"^" + w[:n] for n in PREFIXES if len(w) >= n)} if w else set()


def text_features(text: bytes | None) -> set[bytes]:
    out: set[bytes] = set()
    for w in set(words_of(text)):
        out |= word_features(w)
    return out


@dataclass(frozen=True)
class OrdinalModel:
    features: tuple[bytes, ...]
    weights: np.ndarray
    thetas: np.ndarray  # increasing; empty: no toxic class was seen

    def index(self) -> dict[bytes, float]:
        return dict(zip(self.features, self.weights.tolist(), strict=True))

    def probabilities(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each k, one row a text."""
        return _sigmoid(scores[:, None] - self.thetas[None, :])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def _minimise(f, x: np.ndarray, steps: int, memory: int = 10) -> np.ndarray:
    """L-BFGS with backtracking on ``f(x) -> (value, gradient)``."""
    value, grad = f(x)
    pairs: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        d, alphas = -grad, []
        for s, y, r in reversed(pairs):
            alphas.append(r * (s @ d))
            d = d - alphas[-1] * y
        if pairs:
            s, y, _ = pairs[-1]
            d = d * ((s @ y) / (y @ y))
        for (s, y, r), a in zip(pairs, reversed(alphas), strict=True):
            d = d + (a - r * (y @ d)) * s
        slope, size = grad @ d, 1.0 if pairs else 1.0 / max(1.0, float(np.abs(grad).sum()))
        if slope >= 0 or np.abs(grad).max() < 1e-7:
            break
        while True:
            new_value, new_grad = f(x + size * d)
            if new_value <= value + 1e-4 * size * slope or size < 1e-10:
                break
            size /= 2
        if size < 1e-10:
            break
        s, y = size * d, new_grad - grad
        if s @ y > 1e-12:
            pairs = [*pairs[1 - memory:], (s, y, 1.0 / (s @ y))]
        x, value, grad = x + s, new_value, new_grad
    return x


class SparseRows:
    """A matrix of zeros and ones, as the columns of each row's ones."""

    dtype = np.dtype(np.float64)

    def __init__(self, ones: list[list[int]], width: int):
        self.shape = (len(ones), width)
        self.row = np.repeat(np.arange(len(ones)), [len(x) for x in ones])
        self.col = np.array([c for x in ones for c in x], dtype=np.int64)

    def __matmul__(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.col], minlength=self.shape[0])

    @property
    def T(self) -> "SparseRows":
        turned = SparseRows([], 0)
        turned.shape, turned.row, turned.col = self.shape[::-1], self.col, self.row
        return turned


def fit_ordinal(x: np.ndarray | SparseRows, grade: np.ndarray, grades: int = 3, l2: float = 1e-5,
                steps: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Weights and increasing thresholds that maximise the ordinal likelihood.

    theta_0 is free and each later gap is exp(.), which keeps the order.
    """
    n, d = x.shape
    above = (grade[:, None] > np.arange(grades - 1)[None, :])
    share = np.clip(above.mean(axis=0), 1e-4, 1 - 1e-4)
    start = -np.log(share / (1 - share))
    rows, none = np.arange(n), np.zeros((n, 1))

    def loss(params: np.ndarray) -> tuple[float, np.ndarray]:
        w, gaps = params[:d], np.exp(params[d + 1:])
        theta = params[d] + np.concatenate([[0.0], np.cumsum(gaps)])
        s = _sigmoid((x @ w.astype(x.dtype)).astype(np.float64)[:, None] - theta[None, :])  # P(grade > k)
        edge = np.concatenate([none + 1, s, none], axis=1)
        p = np.maximum(edge[rows, grade] - edge[rows, grade + 1], 1e-12)
        ds = s * (1 - s)
        slope = np.concatenate([none, ds, none], axis=1)
        dz = (slope[rows, grade] - slope[rows, grade + 1]) / p  # d log p / d score
        # d log p / d theta_k: down for the grade above theta_k, up for the one below
        g = np.array([(np.where(grade == k, ds[:, k], 0) / p - np.where(grade == k + 1, ds[:, k], 0) / p).sum()
                      for k in range(grades - 1)])
        grad = np.concatenate([
            -(x.T @ dz.astype(x.dtype)).astype(np.float64) / n + l2 * w, [-g.sum() / n],
            [-g[k + 1:].sum() / n * gaps[k] for k in range(grades - 2)]])
        return -np.log(p).mean() + l2 / 2 * (w @ w), grad

    best = _minimise(loss, np.concatenate([np.zeros(d), start[:1], np.log(np.maximum(np.diff(start), 0.1))]), steps)
    return best[:d], best[d] + np.concatenate([[0.0], np.cumsum(np.exp(best[d + 1:]))])


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """text, toxic of at most ``rows`` labelled documents; equal texts count once."""
    one = (labels.where("doc_id is not null and toxic is not null")
           .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    # at most `rows` pairs of numbers: a proven bound for the broadcast
    named = (docs.select(F.col("doc_id").alias("__id"), "text")
             .join(F.broadcast(one), F.col("__id") == F.col("doc_id"))
             .select("__id", F.xxhash64("text").alias("__hash"), "text", "toxic"))
    # an id may stand on very many rows: of (id, hash) pairs too there are at most `rows`
    chosen = (named.select("__id", "__hash").distinct()
              .orderBy(F.xxhash64("__id", "__hash"), "__id", "__hash").limit(rows))
    return named.join(F.broadcast(chosen), ["__id", "__hash"]).groupBy("text").agg(F.max("toxic").alias("toxic"))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> OrdinalModel:
    """Fit on the labelled sample: features and counts in tasks, the bounded fit here."""
    none = OrdinalModel((), np.zeros(0), np.zeros(0))
    sample = labelled_sample(docs, labels, rows).select(F.col("text").cast("binary"), "toxic")

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}  # clean texts, and from bit 32 the others
        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                one = 1 << 32 if y > 0 else 1
                for f in text_features(text):
                    counts[f] = counts.get(f, 0) + one
                if len(counts) > TALLY:
                    yield tallied(counts)
                    counts = {}
        yield tallied(counts)

    def tallied(counts: dict[bytes, int]) -> pa.RecordBatch:
        n = np.fromiter(counts.values(), dtype=np.int64, count=len(counts))
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(n & 0xFFFFFFFF), pa.array(n >> 32)],
                                          names=["feature", "clean", "bad"])

    size = sample.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("toxic") > 0).cast("long")).alias("bad")).first()
    n, bad = size["n"], size["bad"] or 0
    if not 0 < bad < n:
        return none
    small_batches(docs.sparkSession)
    counts = (sample.mapInArrow(tally, "feature binary, clean long, bad long")
              .groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("bad").alias("bad")))
    a, b = F.col("bad"), F.col("clean")
    c, d = F.lit(bad) - a, F.lit(n - bad) - b
    det = (a * d - b * c).cast("double")
    chi = n * det * det / (F.greatest((a + b).cast("double") * (c + d), F.lit(1.0)) * float(bad) * float(n - bad))
    top = (counts.withColumn("chi2", chi).where((F.col("chi2") >= MIN_CHI2) & (a + b >= 4))
           .orderBy(F.desc("chi2"), "feature").collect())  # the sample bounds them
    if not top:
        return none
    features = tuple(bytes(r["feature"]) for r in top)
    index = {f: i for i, f in enumerate(features)}
    cues = {f for f, r in zip(features, top, strict=True)
            if f[:1] == b"=" and r["bad"] >= 0.9 * (r["bad"] + r["clean"])}
    cues |= {f for f, r in zip(features, top, strict=True)
             if f[:1] == b"^" and r["bad"] >= 0.98 * (r["bad"] + r["clean"])}

    def encode(texts, toxic):
        active, cue_words = [], []
        for text in texts:
            found = {w: word_features(w) for w in set(words_of(text))}
            active.append(sorted({index[f] for fs in found.values() for f in fs if f in index}))
            hits = {w for w, fs in found.items() if fs & cues}
            cue_words.append(len(hits))
        return {"toxic": toxic, "active": active, "cues": cue_words}

    got = map_batches(sample, encode, "toxic int, active array<int>, cues int").toArrow()
    # reruns agree whatever the order of rows
    found = sorted(zip(got["cues"].to_pylist(), got["toxic"].to_pylist(), got["active"].to_pylist(), strict=True))
    cue_count, toxic = np.array([r[0] for r in found]), np.array([r[1] for r in found]) > 0
    x = SparseRows([r[2] for r in found], len(features))
    middle = np.median(cue_count[toxic])
    grade = np.where(toxic, np.where(cue_count > middle, 2, 1), 0)
    w, theta = fit_ordinal(x, grade)
    return OrdinalModel(features, w, theta)


def score_toxicity(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, p_toxic, p_severe, severity, grade, toxic."""
    index, thetas = model.index(), model.thetas

    def fn(ids, texts):
        if not len(thetas):
            zero = [0.0] * len(ids)
            return {"doc_id": ids, "p_toxic": zero, "p_severe": zero, "severity": zero,
                    "grade": [0] * len(ids), "toxic": [False] * len(ids)}
        scores = np.array([sum(index[f] for f in sorted(text_features(t) & index.keys())) for t in texts], dtype=np.float64)
        p = model.probabilities(scores)
        return {"doc_id": ids, "p_toxic": p[:, 0].tolist(), "p_severe": p[:, -1].tolist(),
                "severity": p.sum(axis=1).tolist(), "grade": (p >= 0.5).sum(axis=1).tolist(),
                "toxic": (p[:, 0] >= 0.5).tolist()}

    kind = docs.schema[id_col].dataType.simpleString()
    return map_batches(docs.select(f"`{id_col}`", F.col(f"`{text_col}`").cast("binary")), fn,
                       f"doc_id {kind}, p_toxic double, p_severe double, severity double, grade int, toxic boolean")


def without_toxic(docs: DataFrame, model: OrdinalModel, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text is toxic; all columns unchanged."""

    index, thetas = model.index(), model.thetas

    @pandas_udf("boolean")
    def toxic(texts: pd.Series) -> pd.Series:
        bound = thetas[0] if len(thetas) else float("inf")
        return texts.map(lambda t: sum(index[f] for f in sorted(text_features(t) & index.keys())) >= bound).astype(bool)

    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")
    return docs.where(~toxic(text))
