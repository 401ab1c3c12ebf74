"""Language model scores from a hidden Markov model trained by Baum-Welch.

Words: maximal runs of anything but ASCII white space, A-Z lowered; one end token
closes every text. Emissions go through classes, so the model stays bounded while the
vocabulary grows: the most frequent training words are classes of their own, all
others share a class by a hash of their last three bytes, and

    P(word | state) = P(class | state) * (c(word) + 1) / (C(class) + V(class) + 1)

within a shared class (C tokens, V distinct words in training; one place is kept for
the unknown). That sums to one over known words and an unknown one in each class.

Training: every training text is cut into segments of at most ``SEGMENT`` tokens (no
token is left out); each E-step runs in tasks, the expected counts are summed across
partitions, and the M-step renews states on the driver (a fixed number of values).
Scoring: the scaled forward recursion over the whole text, exact.

Counts of words cover all training texts. A bounded dictionary of frequent words
(``DICTIONARY`` words of at most 64 bytes) is broadcast and settles most tokens where
they are; the other words of each text meet their counts in a shuffled join, so every
count is exact whatever the size of the vocabulary.

Defined cases: a null text is empty (the end token alone); a null id counts as
training; with no training text N = V = 0; equal rows train and are scored each; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propyield.llm.common import count_pieces, frequent_pieces, map_batches, small_batches, words_of
from propyield.session import scratch_path

STATES = 8
ROUNDS = 6
#: Frequent words with a class of their own, and classes shared by the other words.
OWN, SHARED = 3071, 1024
END = OWN + SHARED  # the end token's class
CLASSES = OWN + SHARED + 1
#: Words of the broadcast dictionary, at most, of at most so many bytes each.
DICTIONARY, WORD_BYTES = 1 << 18, 64
SEGMENT = 256
#: Pseudo-tokens by which a state's emissions lean on the class frequencies.
LEAN = 50.0
#: Tokens a task scores at a time.
CHUNK = 4_000_000


def shared_class(word: bytes) -> int:
    return OWN + zlib.crc32(word[-3:]) % SHARED


# Broadcasts carry the fields of these classes: workers need no copy of this package.


@dataclass
class Dictionary:
    """Frequent words: their class and count; a shared class's place count."""

    words: dict[bytes, int]   # to the place in the two arrays
    cls: np.ndarray
    count: np.ndarray
    room: np.ndarray          # C + V + 1 of each shared class, by class
    ends: int                 # training texts


@dataclass
class Hmm:
    start: np.ndarray   # K: at the beginning of a text
    mean: np.ndarray    # K: at the beginning of a later segment
    step: np.ndarray    # K x K
    emit: np.ndarray    # CLASSES x K


def initial(class_counts: np.ndarray, states: int = STATES, seed: int = 11) -> Hmm:
    """Class frequencies, perturbed for each state; states tend to stay."""
    rng = np.random.default_rng(seed)
    p = (class_counts + 1.0) / (class_counts + 1.0).sum()
    emit = p[:, None] * np.exp(0.7 * rng.standard_normal((len(p), states)))
    step = np.full((states, states), 0.1 / max(states - 1, 1))
    np.fill_diagonal(step, 0.9 if states > 1 else 1.0)
    flat = np.full(states, 1.0 / states)
    return Hmm(flat, flat.copy(), step, emit / emit.sum(axis=0))


def segments(codes: list[np.ndarray], size: int = SEGMENT) -> tuple[list[np.ndarray], np.ndarray]:
    """All texts cut into pieces of at most ``size``; whether each begins its text."""
    parts, first = [], []
    for c in codes:
        for i in range(0, len(c), size):
            parts.append(c[i:i + size])
            first.append(i == 0)
    return parts, np.array(first, dtype=bool)


def expected_counts(model: Hmm, codes: list[np.ndarray], group: int = 1024) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The E-step: expected starts (K), transitions (K x K) and emissions (CLASSES x K)."""
    k = len(model.start)
    starts, trans, emits = np.zeros(k), np.zeros((k, k)), np.zeros((CLASSES, k))
    parts, first = segments(codes)
    order = np.argsort([-len(p) for p in parts], kind="stable")
    for g in range(0, len(order), group):
        pick = order[g:g + group]
        lens = np.array([len(parts[i]) for i in pick])
        begin = first[pick]
        grid = np.full((len(pick), lens[0]), 0, dtype=np.int64)
        for r, i in enumerate(pick):
            grid[r, :lens[r]] = parts[i]
        grid = np.ascontiguousarray(grid.T)
        live = [int((lens > t).sum()) for t in range(lens[0])]  # longest first: a prefix is live
        alphas, scales = [], []
        a = np.where(begin[:, None], model.start, model.mean)
        for t, n in enumerate(live):
            b = model.emit[grid[t, :n]]
            a = (a if t == 0 else a[:n] @ model.step) * b
            s = a.sum(axis=1, keepdims=True)
            a = a / s
            alphas.append(a)
            scales.append(s)
        beta = np.ones((live[-1], k))
        for t in range(len(live) - 1, -1, -1):
            n = live[t]
            if t + 1 < len(live):
                m = live[t + 1]
                ahead = model.emit[grid[t + 1, :m]] * beta / scales[t + 1]
                trans += alphas[t][:m].T @ ahead
                beta = np.ones((n, k))
                beta[:m] = ahead @ model.step.T
            gamma = alphas[t] * beta
            if t == 0:
                starts += gamma[begin].sum(axis=0)
            alphas[t] = gamma
        seen = np.concatenate([grid[t, :n] for t, n in enumerate(live)])
        gammas = np.concatenate(alphas)
        for j in range(k):
            emits[:, j] += np.bincount(seen, weights=gammas[:, j], minlength=CLASSES)
    return starts, trans * model.step, emits


def renewed(starts: np.ndarray, trans: np.ndarray, emits: np.ndarray, class_counts: np.ndarray) -> Hmm:
    """The M-step, with emissions leaning on the class frequencies."""
    k = len(starts)
    p = (class_counts + 1.0) / (class_counts + 1.0).sum()
    emit = emits + LEAN * p[:, None]
    mass = emits.sum(axis=0) + 1.0
    return Hmm((starts + 1.0) / (starts.sum() + k), mass / mass.sum(),
               (trans + 1.0) / (trans + 1.0).sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def log10_likelihood(model: Hmm, codes: list[np.ndarray]) -> np.ndarray:
    """log10 P(classes of the text) by the scaled forward recursion, each text whole."""
    out = np.zeros(len(codes))
    if not codes:
        return out
    lens = np.array([len(c) for c in codes])
    order = np.argsort(-lens, kind="stable")
    texts = [codes[i] for i in order]
    ends = np.concatenate([[0], np.cumsum(lens[order])])
    flat = np.concatenate(texts).astype(np.int64)
    base = ends[:-1]
    live, a, total = len(texts), None, np.zeros(len(texts))
    sorted_lens = lens[order]
    for t in range(int(sorted_lens[0])):
        while sorted_lens[live - 1] <= t:
            live -= 1
        b = model.emit[flat[base[:live] + t]]
        a = model.start * b if t == 0 else (a[:live] @ model.step) * b
        s = a.sum(axis=1)
        a /= s[:, None]
        total[:live] += np.log10(s)
    out[order] = total
    return out


def _class_rooms(counts: DataFrame, own: set[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and distinct words of each shared class."""
    def fn(words, ns):
        c, v = np.zeros(SHARED, dtype=np.int64), np.zeros(SHARED, dtype=np.int64)
        at = np.array([shared_class(w) - OWN for w in words if w not in own], dtype=np.int64)
        n = np.array([n for w, n in zip(words, ns, strict=True) if w not in own], dtype=np.int64)
        np.add.at(c, at, n)
        np.add.at(v, at, 1)
        hit = np.flatnonzero(v)
        return {"cls": hit.tolist(), "c": c[hit].tolist(), "v": v[hit].tolist()}

    tokens, kinds = np.zeros(SHARED), np.zeros(SHARED)
    for r in (map_batches(counts, fn, "cls int, c long, v long").groupBy("cls")
              .agg(F.sum("c").alias("c"), F.sum("v").alias("v")).collect()):
        tokens[r["cls"]], kinds[r["cls"]] = r["c"], r["v"]
    return tokens, kinds


def _encode(docs: DataFrame, spread) -> DataFrame:
    """One row per text: its classes, what the dictionary settles, and its other words."""
    def fn(ids, held, texts):
        d = SimpleNamespace(**spread.value)
        get, log_count = d.words.get, np.log10(d.count + 1.0)
        out: dict[str, list] = {c: [] for c in ("doc_id", "held_out", "n_tokens", "codes", "log_all", "log_shared", "log_room", "known", "rare")}
        for i, h, text in zip(ids, held, texts, strict=True):
            words = words_of(text)
            at = np.array([get(w, -1) for w in words], dtype=np.int64)
            codes = np.empty(len(words) + 1, dtype=np.uint16)
            codes[-1] = END
            codes[:-1] = d.cls[at] if len(d.cls) else 0
            unknown = np.flatnonzero(at < 0)
            rare = Counter([words[j] for j in unknown])
            cls = {w: shared_class(w) for w in rare}
            if len(unknown):
                codes[unknown] = [cls[words[j]] for j in unknown]
            settled = at[at >= 0]
            logs = log_count[settled]
            shared = codes[(codes >= OWN) & (codes < END)] - OWN
            out["doc_id"].append(i)
            out["held_out"].append(h)
            out["n_tokens"].append(len(codes))
            out["codes"].append(codes.tobytes())
            out["log_all"].append(float(logs.sum() + math.log10(d.ends + 1)))
            out["log_shared"].append(float(logs[d.cls[settled] >= OWN].sum()) if len(settled) else 0.0)
            out["log_room"].append(float(np.log10(d.room[shared]).sum()))
            out["known"].append(len(settled) + (d.ends > 0))
            out["rare"].append([{"word": w, "n": n} for w, n in rare.items()])
        return out

    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 2, F.lit(False))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(
        docs.select("doc_id", held.alias("held_out"), F.col("text").cast("binary")), fn,
        f"doc_id {kind}, held_out boolean, n_tokens long, codes binary, log_all double, log_shared double, "
        "log_room double, known long, rare array<struct<word:binary,n:long>>")


def _round(codes: DataFrame, model: Hmm, class_counts: np.ndarray) -> Hmm:
    """One Baum-Welch round: expected counts in tasks, summed across partitions."""
    spread = codes.sparkSession.sparkContext.broadcast(vars(model))
    k = len(model.start)
    width = k + k * k + CLASSES * k
    schema = pa.schema([("at", pa.int32()), ("n", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for texts in _gathered(batches, 0):
            total += np.concatenate([x.ravel() for x in expected_counts(SimpleNamespace(**spread.value), texts[1])])
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), pa.array(total[hit], pa.float64())], schema=schema)

    got = codes.mapInArrow(run, "at int, n double").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(width)
    total[got["at"].to_numpy()] = got["n"].to_numpy()
    spread.unpersist()
    return renewed(total[:k], total[k:k + k * k].reshape(k, k), total[k + k * k:].reshape(CLASSES, k), class_counts)


def _gathered(batches: Iterator[pa.RecordBatch], column: int, tokens: int = CHUNK):
    """(batches, codes of their texts) in chunks of about ``tokens`` tokens."""
    held, codes, n = [], [], 0
    for batch in batches:
        held.append(batch)
        new = [np.frombuffer(x, dtype=np.uint16) for x in batch.column(column).to_pylist()]
        codes += new
        n += sum(map(len, new))
        if n >= tokens:
            yield held, codes
            held, codes, n = [], [], 0
    if codes:
        yield held, codes


def hmm_scores(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per input row.

    Writes two tables below the shared folder (word counts, encoded texts) and reads
    them again, so that a lost executor repeats one stage at most.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    docs = docs.select("doc_id", "text")
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 2, F.lit(False))
    train = docs.where(~held)
    path = scratch_path(spark, "hmm-counts")
    count_pieces(train.select(F.col("text").cast("binary")), words_of).write.parquet(path)
    counts = spark.read.parquet(path)
    ends = train.count()
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n_train, vocabulary = sums["n"] + ends, sums["v"] + (ends > 0)

    frequent = frequent_pieces(counts, DICTIONARY, WORD_BYTES)
    own = {w: i for i, (w, _) in enumerate(frequent[:OWN])}
    tokens, kinds = _class_rooms(counts, set(own))
    class_counts = np.zeros(CLASSES)
    class_counts[:len(own)] = [n for _, n in frequent[:OWN]]
    class_counts[OWN:END] = tokens + kinds
    class_counts[END] = ends
    spread = sc.broadcast(vars(Dictionary(
        {w: i for i, (w, _) in enumerate(frequent)},
        np.array([own.get(w, -1) if w in own else shared_class(w) for w, _ in frequent], dtype=np.int64),
        np.array([n for _, n in frequent], dtype=np.float64), tokens + kinds + 1.0, ends)))
    path = scratch_path(spark, "hmm-texts")
    # the row number is fixed once it is written
    _encode(docs, spread).withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    texts = spark.read.parquet(path)

    model = initial(class_counts, states)
    if ends:
        for _ in range(rounds):
            model = _round(texts.where(~F.col("held_out")).select("codes"), model, class_counts)

    small_batches(spark)
    final = sc.broadcast(vars(model))
    kind = docs.schema["doc_id"].dataType.simpleString()
    narrow = ["row", "doc_id", "held_out", "n_tokens", "known", "log_all", "log_shared", "log_room"]
    schema = f"row long, doc_id {kind}, held_out boolean, n_tokens long, known long, log_all double, log_shared double, log_room double, forward double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, codes in _gathered(batches, len(narrow)):
            scores = log10_likelihood(SimpleNamespace(**final.value), codes)
            at = 0
            for b in part:
                cols = [b.column(i) for i in range(len(narrow))]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(scores[at:at + b.num_rows])], names=[*narrow, "forward"])
                at += b.num_rows

    scored = texts.select(*narrow, "codes").mapInArrow(run, schema)
    rare = (texts.select("row", F.explode("rare").alias("r")).select("row", F.col("r.word").alias("word"), F.col("r.n").alias("m"))
            .join(counts, "word", "left").groupBy("row")
            .agg(F.sum(F.col("m") * F.log10(F.coalesce(F.col("n"), F.lit(0)) + 1)).alias("rare_log"),
                 F.sum(F.when(F.col("n") > 0, F.col("m")).otherwise(0)).alias("rare_known")))
    rare_log = F.coalesce(F.col("rare_log"), F.lit(0.0))
    unit = math.log10(n_train + vocabulary + 1)
    return scored.join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("log_all") + rare_log - F.col("n_tokens") * F.lit(unit)).alias("base_score"),
        (F.col("forward") + F.col("log_shared") + rare_log - F.col("log_room")).alias("score"))
