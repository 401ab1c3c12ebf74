"""Byte-level BPE encoding and decoding of whole texts by the ranks of a public vocabulary.

Encoding a word starts from its bytes and merges, again and again, the adjacent pair
whose joined bytes have the lowest rank (the leftmost of equal ones), until no pair
has a rank. That fold is a Spark ``aggregate`` over the word's pieces, with the ranks
as one literal: a table of the merges, found by the ids of both pieces (a token is always
made by the same last merge). A word that is a token is not folded. It runs on distinct
words:

* A text falls into chunks (a space or line break and what follows it up to the
  next), at places where no match of the vocabulary's pattern can cross. Frequent
  chunks (a bounded number, of bounded length) and their words are folded once and
  broadcast; they settle most of the text.
* The distinct other words of each text are folded in its row.
* Words of more than ``FOLD_BYTES`` bytes (long runs) are merged by the same rule with
  a heap, which stays near-linear.

Nothing is shuffled but counts, and no text leaves its row. Ids are packed as
little-endian unsigned 32-bit integers; decoding concatenates the binary pieces.

Defined cases: a null or empty text has no ids and decodes to no bytes; equal rows
give equal rows; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
import json
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from dataclasses import dataclass
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from propyield.llm.common import count_pieces, frequent_grade, map_batches, small_batches
from propyield.session import scratch_path

#: Chunks and words of the broadcast dictionary, at most, of at most so many bytes each.
CHUNKS, WORDS, WORD_BYTES = 1 << 17, 1 << 19, 64
#: Longest word that is folded in Spark.
FOLD_BYTES = 128

# White space (the Unicode property) other than single spaces and line breaks
_WIDE = "".join(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_ODD = (*"\t\x0b\x0c\r\0", "  ", " \n", "\n ", "\n\n", *_WIDE)


def splitter(pattern: str):
    """The vocabulary's pattern, compiled; its white space is the Unicode property."""
    import regex

    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


def word_finder(pattern: str):
    """All matches of the pattern in a chunk; ASCII letters need no search where they are one match."""
    matches, parts = splitter(pattern), pattern.split("|")
    letters = r" ?\p{L}+"
    if letters not in parts or not all(x.startswith("'") for x in parts[:parts.index(letters)]):
        return matches.findall

    def find(chunk: str) -> list[str]:
        if chunk.isascii() and (chunk[1:] if chunk[:1] == " " else chunk).isalpha():
            return [chunk]
        return matches.findall(chunk)

    return find


def chunks_of(text: str | None, words) -> list[str]:
    """Pieces of the text that no match of the pattern crosses, in order.

    Single spaces and line breaks between words start a chunk each; a text with other
    white space, or two in a row, falls into its words at once.
    """
    if not text:
        return []
    if any(map(text.__contains__, _ODD)):
        return words.findall(text)
    cut = text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")
    return cut if cut[0] else cut[1:]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def last_pairs(ranks: dict[bytes, int]) -> dict[tuple[int, int], int]:
    """The pair of ids whose merge makes a token, for each token that merges make.

    What is merged inside a piece does not depend on what stands beside it, so a token
    is always made by the same last merge: that of its own bytes alone.
    """
    pairs = {}
    for token, rank in ranks.items():
        left = merge_long(token, ranks, 2) if len(token) > 1 else []
        if len(left) == 2:
            pairs[tuple(left)] = rank
    return pairs


def pair_table(ranks: dict[bytes, int]) -> dict[str, list[int]]:
    """The merges as three arrays: (left, right) is found at ``shift[left] + right``.

    There ``owner`` names the left id and ``rank`` the merge's rank less ``low``, the smallest
    number above all ranks, so that every rank is negative and every id is not. Rows (the
    merges of one left id) are shifted against each other until no two share a place.
    """
    low = max(ranks.values(), default=-1) + 1
    rows: dict[int, list[tuple[int, int]]] = {}
    for (left, right), rank in last_pairs(ranks).items():
        rows.setdefault(left, []).append((right, rank - low))
    size = 1 << 20
    taken, shift = np.zeros(size, dtype=bool), np.zeros(low, dtype=np.int64)
    owner, rank_at = np.full(size, -1), np.zeros(size, dtype=np.int64)
    reached: dict[int, int] = {}  # where rows of a size have found room: the search goes on from there
    for left, row in sorted(rows.items(), key=lambda x: (-len(x[1]), min(x[1]), x[0])):
        rights, values = np.array(sorted(row)).T
        first, span = max(reached.get(len(row), 0), rights[0]), rights - rights[0]
        while True:
            if first + 256 + low > size:
                taken, rank_at = (np.append(x, np.zeros_like(x)) for x in (taken, rank_at))
                owner, size = np.append(owner, np.full(size, -1)), 2 * size
            free = first + np.flatnonzero(~taken[first:first + 256])
            free = free[~taken[free[:, None] + span].any(axis=1)]
            if len(free):
                break
            first += 256
        places = free[0] + span
        shift[left], reached[len(row)] = free[0] - rights[0], free[0]
        taken[places], owner[places], rank_at[places] = True, left, values
    end = int(np.flatnonzero(taken).max(initial=-1)) + 1
    return {"shift": shift.tolist(), "owner": owner[:end].tolist(), "rank": rank_at[:end].tolist()}


def rank_literal(ranks: dict[bytes, int]) -> Column:
    """The ranks of all merges as one literal."""
    return F.from_json(F.lit(json.dumps(pair_table(ranks), separators=(",", ":"))),
                       "struct<shift: array<int>, owner: array<int>, rank: array<int>>")


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed, and named in the plan, once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


class Starts:
    """What the fold starts from: a word's bytes as ids, and the rank of each adjacent pair.

    Ids and ranks take turns in one array; two nulls stand before and behind them.
    """

    def __init__(self, ranks: dict[bytes, int]):
        low = max(ranks.values(), default=-1) + 1
        self.id = np.array([ranks.get(bytes([i]), -1) for i in range(256)], dtype=np.int32)
        self.rank = np.zeros((256, 256), dtype=np.int32)
        for token, rank in ranks.items():
            if len(token) == 2:
                self.rank[token[0], token[1]] = rank - low

    def __call__(self, words: list[bytes | None]) -> pa.ListArray:
        """One array a word; an empty one for no word."""
        sizes = np.array([len(w) if w else 0 for w in words], dtype=np.int64)
        ends = np.concatenate([[0], np.cumsum(np.where(sizes > 0, 2 * sizes + 3, 0))])
        data = np.frombuffer(b"".join([w for w in words if w]), dtype=np.uint8)
        values, known = np.zeros(ends[-1], dtype=np.int32), np.zeros(ends[-1], dtype=bool)
        first = np.cumsum(sizes) - sizes
        at = np.repeat(ends[:-1] + 2 - 2 * first, sizes) + 2 * np.arange(len(data))
        values[at], known[at] = self.id[data], True
        if (values[at] < 0).any():
            raise ValueError("the vocabulary has no rank for a byte of the text")
        inner = np.ones(len(data), dtype=bool)
        inner[(first + sizes - 1)[sizes > 0]] = False
        i = np.flatnonzero(inner)
        pair = self.rank[data[i], data[i + 1]] if len(i) else values[:0]
        values[at[i] + 1], known[at[i] + 1] = pair, pair < 0
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values, mask=~known))


def fold(start: Column, table: Column, low: int) -> Column:
    """The ids of a word, given as ``Starts`` makes it: adjacent pieces merged by ascending rank."""
    def pair(left: Column, right: Column) -> Column:
        place = F.get(table["shift"], left) + right
        return F.when(F.get(table["owner"], place) == left, F.get(table["rank"], place))

    def merge(state: Column) -> Column:
        def joined(rank: Column, at: Column) -> Column:
            piece = rank + F.lit(low)
            return F.concat(F.slice(state, F.lit(1), at - 3),
                            F.array(pair(F.get(state, at - 4), piece), piece, pair(piece, F.get(state, at + 2))),
                            F.slice(state, at + 3, F.size(state)))

        # the leftmost pair of the lowest rank gives way to its piece, whose pairs are ranked anew
        return _let(F.array_min(state), lambda rank: F.when(rank < 0, _let(
            F.array_position(state, rank).cast("int"), lambda at: joined(rank, at))).otherwise(state))

    merges = F.sequence(F.lit(1), F.greatest((F.size(start) - 3) / 2, F.lit(1)).cast("int"))
    return F.filter(F.aggregate(merges, start, lambda state, _: merge(state)), lambda x: x >= 0)


def merge_long(word: bytes, ranks: dict[bytes, int], stop_at: int = 1) -> list[int]:
    """The same merges for a long word: the lowest rank first, the leftmost of equal ones.

    They end when ``stop_at`` pieces are left.
    """
    n = left = len(word)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    end = list(range(1, n + 1))  # a piece is word[i:end[i]]; 0 when it was merged away

    def pair(i: int):
        j = after[i]
        return ranks.get(word[i:end[j]]) if j < n else None

    heap = [(r, i, i + 2) for i in range(n - 1) if (r := pair(i)) is not None]
    heapq.heapify(heap)
    while heap and left > stop_at:
        _, i, stop = heapq.heappop(heap)
        if not end[i] or after[i] >= n or end[after[i]] != stop:
            continue  # one of its pieces has changed
        j = after[i]
        left -= 1
        end[i], end[j] = end[j], 0
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for k in (before[i], i):
            if k >= 0 and (r := pair(k)) is not None:
                heapq.heappush(heap, (r, k, end[after[k]]))
    return [ranks[word[i:end[i]]] for i in range(n) if end[i]]


@dataclass
class Dictionary:
    """Words and chunks with their ids: all keys and all ids, one after another.

    Packed, so that neither the driver nor the broadcast holds an object for each.
    """

    keys: bytes
    bounds: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    ids: np.ndarray


def _packed(table: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the lists of an Arrow list array start, their sizes, and all their values."""
    offsets = table.offsets.to_numpy().astype(np.int64)
    return offsets[:-1] - offsets[0], np.diff(offsets), table.flatten().to_numpy().astype(np.uint32)


def build_dictionary(docs: DataFrame, pattern: str, ranks: dict[bytes, int], literal: Column,
                     chunk_limit: int = CHUNKS, word_limit: int = WORDS) -> Dictionary:
    """Fold the most frequent distinct words of all texts, and those of frequent chunks."""
    spark = docs.sparkSession
    matches, words_in = splitter(pattern), word_finder(pattern)

    def pieces(text: str | None) -> list[str]:
        return chunks_of(text, matches)

    def words(chunks, ns):
        found: Counter = Counter()
        for chunk, n in zip(chunks, ns, strict=True):
            for w in words_in(chunk.decode()):
                found[w] += n
        return {"word": [w.encode() for w in found], "n": list(found.values())}

    path = scratch_path(spark, "bpe-chunks")
    count_pieces(docs.select("text"), pieces).write.parquet(path)
    counts = spark.read.parquet(path)
    path = scratch_path(spark, "bpe-words")
    map_batches(counts, words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).write.parquet(path)
    # chunks of one word are words; of the others, the words that they fall into
    chunks, often, parts, ends = [], [], [], [0]
    frequent = frequent_grade(counts, chunk_limit, WORD_BYTES).toArrow()
    for chunk, n in zip(frequent["word"].to_pylist(), frequent["n"].to_pylist(), strict=True):
        found = [w.encode() for w in words_in(chunk.decode())]
        if len(found) > 1:
            chunks.append(chunk)
            often.append(n)
            ends.append(ends[-1] + len(found))
        parts += found if len(found) > 1 else []
    chunks, parts = pa.array(chunks, pa.binary()), pa.array(parts, pa.binary())
    more = spark.createDataFrame(pa.table({"word": parts.unique()})).withColumn("n", F.lit(0).cast("long"))
    wanted = frequent_grade(spark.read.parquet(path), word_limit, WORD_BYTES).union(more).groupBy("word").agg(F.max("n").alias("n"))
    vocabulary, starts_of = spark.sparkContext.broadcast(ranks), Starts(ranks)

    def started(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            whole = [[vocabulary.value[w]] if w in vocabulary.value else None for w in words]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, starts_of([None if g else w for w, g in zip(words, whole, strict=True)]),
                 pa.array(whole, pa.list_(pa.int32()))], names=["w", "n", "start", "whole"])

    small_batches(spark)
    made = wanted.repartition(2 * spark.sparkContext.defaultParallelism).mapInArrow(started, "w binary, n long, start array<int>, whole array<int>")
    low = max(ranks.values(), default=-1) + 1
    folded = made.select("w", "n", F.coalesce("whole", _let(literal, lambda t: fold(F.col("start"), t, low))).alias("ids")).toArrow().combine_chunks()
    if not folded.num_rows:
        return Dictionary(b"", *(np.zeros(n, dtype=t) for n, t in ((1, np.int64), (0, np.int64), (0, np.int64), (0, np.uint32))))
    starts, sizes, ids = _packed(folded["ids"].chunk(0))
    known = folded["w"].chunk(0).cast(pa.binary())
    # a chunk's ids are those of its words, one after another
    at = pc.index_in(parts, value_set=known).to_numpy(zero_copy_only=False).astype(np.int64)
    chunk_ids = ids[_spans(starts[at], sizes[at])]
    bounds = np.concatenate([[0], np.cumsum(sizes[at])])[np.array(ends)].astype(np.int64)
    keys = pa.concat_arrays([known, chunks])
    # the most frequent first: their entries stand close together in the look-up
    order = np.argsort(-np.concatenate([folded["n"].to_numpy(), np.array(often, dtype=np.int64)]), kind="stable")
    keys = keys.take(pa.array(order))
    return Dictionary(b"".join(keys.to_pylist()), np.concatenate([[0], np.cumsum(pc.binary_length(keys).to_numpy())]).astype(np.int64),
                      np.concatenate([starts, len(ids) + bounds[:-1]])[order],
                      np.concatenate([sizes, np.diff(bounds)])[order], np.concatenate([ids, chunk_ids]))


def place_of(dictionary: dict) -> dict[str, int]:
    """The place of each key; built once in each Python worker, kept with the broadcast."""
    if "place" not in dictionary:
        data, at = dictionary.pop("keys"), dictionary.pop("bounds")
        dictionary["place"] = {data[a:b].decode(): i for i, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True))}
    return dictionary["place"]


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id",
           text_col: str = "text", decoded: bool = False) -> DataFrame:
    """doc_id, ids (packed little-endian uint32), text_sha256 for every input row.

    ``decoded`` adds what the ids decode to (binary), in the task that packs them.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    literal, low = rank_literal(ranks), max(ranks.values(), default=-1) + 1
    built = vars(build_dictionary(docs, pattern, ranks, literal))
    # each of the two kinds of workers holds its part of the dictionary only
    keyed = spark.sparkContext.broadcast({k: built.pop(k) for k in ("keys", "bounds")})
    spread = spark.sparkContext.broadcast(built)
    vocabulary, matches, starts_of = spark.sparkContext.broadcast(ranks), splitter(pattern), Starts(ranks)
    words_in = word_finder(pattern)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Places in the dictionary; the text's other words are numbered from -1 down."""
        get, known = place_of(keyed.value).get, vocabulary.value
        for batch in batches:
            places, others, given, ends = [], [], [], [0]
            for text in batch.column(1).to_pylist():
                other: dict[str, int] = {}
                chunks = chunks_of(text, matches)
                found = np.fromiter(map(get, chunks, repeat(-1)), dtype="<i4", count=len(chunks))
                at, done = [], 0
                for i in np.flatnonzero(found < 0).tolist():
                    here = [-1 - other.setdefault(w, len(other)) if (j := get(w)) is None else j for w in words_in(chunks[i])]
                    at += found[done:i].tobytes(), np.array(here, dtype="<i4").tobytes()
                    done = i + 1
                places.append(b"".join([*at, found[done:].tobytes()]))
                for w in map(str.encode, other):
                    whole = [known[w]] if w in known else merge_long(w, known) if len(w) > FOLD_BYTES else None
                    given.append(whole)
                    others.append(None if whole else w)
                ends.append(len(others))
            bounds = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(places, pa.binary()), pa.ListArray.from_arrays(bounds, starts_of(others)),
                 pa.ListArray.from_arrays(bounds, pa.array(given, pa.list_(pa.int32())))],
                names=["doc_id", "text_sha256", "places", "others", "given"])

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Gather the ids of each place: a batch's own words stand behind the dictionary's."""
        d = SimpleNamespace(**spread.value)
        pieces = pieces_by_id(vocabulary.value if decoded else {})
        for batch in batches:
            texts = [np.frombuffer(x, dtype="<i4") for x in batch.column(2).to_pylist()]
            lists = batch.column(3)
            first, count, own = _packed(lists.flatten()) if len(lists) else (d.starts[:0], d.sizes[:0], d.ids[:0])
            starts = np.concatenate([d.starts, first + len(d.ids)])
            sizes, ids = np.concatenate([d.sizes, count]), np.concatenate([d.ids, own]).astype("<u4")
            base = lists.offsets.to_numpy() - lists.offsets[0].as_py() + len(d.starts)
            out = []
            for at, b in zip(texts, base, strict=False):
                at = np.where(at < 0, b - 1 - at, at)
                out.append(ids[_spans(starts[at], sizes[at])].tobytes())
            columns = {"doc_id": batch.column(0), "text_sha256": batch.column(1), "ids": pa.array(out, pa.binary())}
            if decoded:
                columns["decoded"] = pa.array([joined_pieces(x, pieces) for x in out], pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    found = docs.select("doc_id", "text", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256")).mapInArrow(
        look_up, f"doc_id {kind}, text_sha256 string, places binary, others array<array<int>>, given array<array<int>>")
    folded = _let(literal, lambda t: F.transform("others", lambda w, i: F.coalesce(F.get("given", i), fold(w, t, low))))
    return found.select("doc_id", "text_sha256", "places", folded.alias("folded")).mapInArrow(
        assemble, f"doc_id {kind}, text_sha256 string, ids binary" + ", decoded binary" * decoded)


def _spans(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers first[i], first[i] + 1, ... (count[i] of them), one span after another."""
    total = int(count.sum())
    shift = np.repeat(first - (np.cumsum(count) - count), count)
    return shift + np.arange(total)


def pieces_by_id(ranks: dict[bytes, int]) -> np.ndarray:
    pieces = np.full(max(ranks.values(), default=-1) + 1, b"", dtype=object)
    for piece, i in ranks.items():
        pieces[i] = piece
    return pieces


def joined_pieces(ids: bytes, pieces: np.ndarray) -> bytes:
    """The binary pieces of packed ids, concatenated."""
    return b"".join(pieces[np.frombuffer(ids, dtype="<u4")].tolist())


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``encoded`` with ``decoded`` (binary): the pieces of the packed ids, concatenated."""
    spread = encoded.sparkSession.sparkContext.broadcast(ranks)
    names = encoded.columns
    at = names.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_by_id(spread.value)
        for batch in batches:
            texts = [joined_pieces(x, pieces) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], names=[*names, "decoded"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, f"{schema}, decoded binary")


def bpe_report(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """The digest of encoding and decoding per document."""
    coded = encode(docs, ranks, pattern, decoded=True)
    return coded.select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.sha2("decoded", 256) == F.col("text_sha256")).alias("round_trip"))
