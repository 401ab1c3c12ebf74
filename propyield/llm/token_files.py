"""Token ids in binary files of bit or byte planes, and back.

Texts are encoded by a public vocabulary and written in ascending order of document as
files of one stream of ids each. **File format** (little-endian):

* ``b"IDPLANES"``, then one block after another. A block holds ``BLOCK`` ids (the last
  of a file holds the rest), transposed: plane *p* of byte planes is byte *p* of each
  id, plane *p* of bit planes is bit *p* of each id, eight ids a byte. Each plane is
  compressed by zstandard on its own; a plane of zeros alone takes no bytes.
* The index, two Arrow streams: of the blocks (``offset`` in the file, ``ids``, ``sizes``
  of its planes, ``crc32`` of its ids) and of the documents (``doc_id``, ``n_tokens``).
* The sizes of the two streams (8 bytes each), the version and kind of planes (4 bytes
  each), ``b"IDPLANES"``.

A reader takes the index from the file's end and reads only the blocks it wants
(``read_ids`` does so for any range of ids).

Rows are sorted by ranges of (id, hash of the text), so documents of one id spread over
several tasks. Each task writes the file of its range under a name of its own and
returns its name, sizes and counts; these rows are the **manifest** (Parquet). A task
that is run again writes another file, and the manifest names the one that counts, so a
lost executor leaves unnamed files at most. The manifest gives each file the number of
ids before it.

Defined cases: a null or empty text has the end id only; null document ids come last;
equal ids are ordered by the hash of their texts, and equal rows give one document
each; strings of special tokens in a text are ordinary text; an empty table gives no
file and an empty result; extra columns are ignored.
"""

from __future__ import annotations

import gc
import json
import os
import re
import struct
import uuid
import zlib
from collections import deque
from collections.abc import Iterable, Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from propyield.llm.common import keep_columns, small_batches

MAGIC, VERSION = b"IDPLANES", 1
#: Ids of a block.
BLOCK = 1 << 16
#: zstandard's level.
LEVEL = 3
#: A longer text is encoded in parts of about so many code points.
PART = 1 << 22
#: Files of one group of the running sum of ids.
GROUP = 1024
_TAIL = "<QQII"
# Letters and digits of Latin scripts, and ASCII signs but the apostrophe (it may begin a
# contraction). No match of the pattern of byte-level vocabularies crosses from one to
# the other, nor into a single space or line break between other characters.
_LATIN, _SIGN = "A-Za-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", r"!-&(-/:-@\[-`{-~"
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
_CHUNK = re.compile(rf"[ \n]?(?:[{_LATIN}]++(?=[ \n{_SIGN}]|\Z)|[{_SIGN}]++(?=[ \n{_LATIN}]|\Z)|[^ \n]++)|[ \n]")
_WORD = re.compile(r"[ \n]?\S*+\Z")
#: Two of those in a row, or white space of another kind.
_ODD = ("  ", "\n\n", " \n", "\n ", *(chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n"))
#: Words whose ids a worker keeps (compactly, in Arrow) before it starts anew, how many times
#: fewer chunks (in Python, to join new words from), and the longest of both.
KNOWN, FEWER, KNOWN_LENGTH = 1 << 20, 4, 64


# ------------------------------------------------------------------ planes

def planes_of(ids: np.ndarray, bits: bool) -> list[bytes]:
    """The planes of the ids (uint32); b"" for one of zeros."""
    raw = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if bits:
        raw = np.unpackbits(raw, axis=1, bitorder="little")
    used = np.bitwise_or.reduce(ids) if len(ids) else 0
    rows = [raw[:, i] if used >> (i if bits else 8 * i) & (1 if bits else 255) else None for i in range(32 if bits else 4)]
    return [b"" if r is None else (np.packbits(r, bitorder="little") if bits else r).tobytes() for r in rows]


def ids_of(planes: list[bytes], n: int, bits: bool) -> np.ndarray:
    """What ``planes_of`` was given."""
    raw = np.zeros((32 if bits else 4, n), dtype=np.uint8)
    for row, plane in zip(raw, planes, strict=True):
        if plane:
            got = np.frombuffer(plane, dtype=np.uint8)
            row[:] = np.unpackbits(got, count=n, bitorder="little") if bits else got
    cells = np.ascontiguousarray(raw.T)
    return (np.packbits(cells, axis=1, bitorder="little") if bits else cells).reshape(-1).view("<u4")


class PlaneWriter:
    """Writes ids and their documents to an open binary file."""

    def __init__(self, file: BinaryIO, doc_type: pa.DataType, bits: bool = False, block: int = BLOCK, level: int = LEVEL):
        import zstandard

        self.file, self.bits, self.block, self.doc_type = file, bits, block, doc_type
        self.pack = zstandard.ZstdCompressor(level=level).compress
        self.offset = self.file.write(MAGIC)
        self.waiting, self.held = [], 0
        self.blocks: list[tuple] = []
        self.docs, self.sizes = [], []
        self.total = 0

    def add(self, doc_id, *ids: np.ndarray) -> None:
        """A document: its ids, in one array or several."""
        n = sum(map(len, ids))
        self.docs.append(doc_id)
        self.sizes.append(n)
        self.total += n
        self.waiting += ids
        self.held += n
        if self.held >= self.block:
            every = np.concatenate(self.waiting)
            whole = len(every) - len(every) % self.block
            for a in range(0, whole, self.block):
                self._put(every[a:a + self.block])
            self.waiting, self.held = [every[whole:].copy()], len(every) - whole

    def _put(self, ids: np.ndarray) -> None:
        packed = [self.pack(p) if p else b"" for p in planes_of(ids, self.bits)]
        self.blocks.append((self.offset, len(ids), [len(p) for p in packed], zlib.crc32(ids.astype("<u4").tobytes())))
        self.offset += self.file.write(b"".join(packed))

    def close(self) -> None:
        if self.held:
            self._put(np.concatenate(self.waiting))
        index = pa.table({
            "offset": pa.array([b[0] for b in self.blocks], pa.int64()), "ids": pa.array([b[1] for b in self.blocks], pa.int64()),
            "sizes": pa.array([b[2] for b in self.blocks], pa.list_(pa.int64())), "crc32": pa.array([b[3] for b in self.blocks], pa.int64())})
        docs = pa.table({"doc_id": pa.array(self.docs, self.doc_type), "n_tokens": pa.array(self.sizes, pa.int64())})
        streams = [_stream(index), _stream(docs)]
        self.file.write(b"".join(streams) + struct.pack(_TAIL, *map(len, streams), VERSION, self.bits) + MAGIC)
        self.file.close()


def _stream(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


class PlaneReader:
    """Reads the index of a file of planes, and any range of its ids."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        tail = len(MAGIC) + struct.calcsize(_TAIL)
        file.seek(size - tail)
        end = file.read(tail)
        if end[-len(MAGIC):] != MAGIC:
            raise ValueError("not a file of id planes, or one cut short")
        first, second, version, self.bits = struct.unpack(_TAIL, end[:-len(MAGIC)])
        if version != VERSION:
            raise ValueError(f"unknown version {version} of id planes")
        file.seek(size - tail - first - second)
        index = pa.ipc.open_stream(file.read(first)).read_all()
        self.docs = pa.ipc.open_stream(file.read(second)).read_all()
        self.offsets, self.counts, self.sizes, self.sums = (index[n].to_pylist() for n in ("offset", "ids", "sizes", "crc32"))
        self.starts = np.concatenate([[0], np.cumsum(self.counts)]).astype(np.int64)

    def block(self, i: int) -> np.ndarray:
        import zstandard

        sizes = self.sizes[i]
        self.file.seek(self.offsets[i])
        data, at, planes = self.file.read(sum(sizes)), 0, []
        unpack = zstandard.ZstdDecompressor().decompress
        for n in sizes:
            planes.append(unpack(data[at:at + n]) if n else b"")
            at += n
        ids = ids_of(planes, self.counts[i], bool(self.bits))
        if zlib.crc32(ids.tobytes()) != self.sums[i]:
            raise ValueError(f"block {i} is damaged")
        return ids

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the file's stream; reads the blocks that hold them."""
        first = int(np.searchsorted(self.starts, start, "right")) - 1
        got = [np.zeros(0, dtype="<u4")]
        for i in range(first, len(self.counts)):
            if self.starts[i] >= stop:
                break
            got.append(self.block(i)[max(0, start - self.starts[i]):stop - self.starts[i]])
        return np.concatenate(got)

    def documents(self) -> Iterator[tuple[object, int, int, bytes]]:
        """(id, start in the file, number of ids, packed ids) of each document in turn; holds a
        block and a document."""
        held, place, next_block, at = b"", 0, 0, 0
        for doc_id, n in zip(self.docs["doc_id"].to_pylist(), self.docs["n_tokens"].to_pylist(), strict=True):
            stop = place + 4 * n
            if stop > len(held):
                got = [held[place:]]
                have, place, stop = len(got[0]), 0, 4 * n
                while have < stop:
                    got.append(self.block(next_block).tobytes())
                    have += len(got[-1])
                    next_block += 1
                held = b"".join(got)
            yield doc_id, at, n, held[place:stop]
            place, at = stop, at + n


# ------------------------------------------------------------------ encoding

def text_parts(text: str, size: int = PART) -> Iterator[str]:
    """The text in parts of about ``size`` code points, cut where no match crosses."""
    at = 0
    while len(text) - at > size:
        m = _CUT.search(text, at + size)
        if m is None:
            break
        yield text[at:m.start()]
        at = m.start()
    yield text[at:]


def is_odd(text: str) -> bool:
    """Whether some white space does not stand alone or is of another kind."""
    return any(x in text for x in _ODD)


def marked(text: str, odd: bool) -> str:
    """The text with a mark at places that no match of the pattern crosses: before each
    space and line break that stands alone (``odd``: not all do)."""
    return "\0".join(_CUT.split(text)) if odd else text.replace(" ", "\0 ").replace("\n", "\0\n")


class Coder:
    """Encodes whole texts with the library, each distinct chunk once while it is known.

    New chunks go to the library as one text, joined by a special token of the vocabulary
    (the library encodes what stands between special tokens apart). Strings of special
    tokens in a text are ordinary text: chunks that hold one go alone.
    """

    def __init__(self, vocabulary: str, known: int = KNOWN):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        special = [t for t in json.loads(vocabulary).get("added_tokens") or [] if t["special"]]
        self.special = [t["content"] for t in special]
        # a token that takes no white space beside it can stand between chunks
        self.joint = next(((t["content"], t["id"]) for t in special if not (t["lstrip"] or t["rstrip"] or t["single_word"])), None)
        self.known: dict[str, bytes] = {}  # chunks, as the library encoded them
        # what stands between two cuts, and its packed ids
        self.words, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        self.limit = known

    def _encode(self, texts: list[str], special: bool = False) -> Iterator[np.ndarray]:
        """The library's ids of each text; strings of special tokens are such only if asked for."""
        self.tokenizer.encode_special_tokens = not special
        for got in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            yield np.array(got.ids, dtype="<u4")

    def _learn(self, chunks: list[str]) -> None:
        every = "\0".join(chunks)
        held = [s for s in self.special if s in every]
        together = [c for c in chunks if not any(s in c for s in held)] if held else chunks
        together = together if self.joint else []
        if together:
            sep, sep_id = self.joint
            (ids,) = self._encode([sep.join(together)], special=True)
            raw, at = ids.tobytes(), 0
            for chunk, end in zip(together, [*np.flatnonzero(ids == sep_id).tolist(), len(ids)], strict=True):
                self.known[chunk] = raw[4 * at:4 * end]
                at = end + 1
        alone = [c for c in chunks if c not in self.known] if held or not self.joint else []
        for chunk, ids in zip(alone, self._encode(alone), strict=True):
            self.known[chunk] = ids.tobytes()

    def _joined(self, words: list[str], odd: bool) -> list[bytes]:
        """The ids of what lies between two cuts, joined from those of its chunks."""
        cuts = [_CHUNK.findall(w) if not odd or _WORD.match(w) else [w] for w in words]
        wanted = set().union(*cuts)
        unknown = wanted.difference(self.known)
        if len(self.known) + len(unknown) > self.limit // FEWER:
            self.known.clear()
            unknown = wanted
        if unknown:
            self._learn(list(unknown))
        got = [self.known[cut[0]] if len(cut) == 1 else b"".join(map(self.known.__getitem__, cut)) for cut in cuts]
        for chunk in unknown:
            if len(chunk) > KNOWN_LENGTH:
                del self.known[chunk]
        return got

    def _ids_of_words(self, words: pa.Array, odd: bool) -> pa.Array:
        """The packed ids of distinct words; only those not met before leave Arrow."""
        at = pc.index_in(words, value_set=self.words)
        new = at.is_null()
        fresh = words.filter(new)
        places = at.fill_null(0).to_numpy().copy()
        places[new.to_numpy(zero_copy_only=False)] = len(self.words) + np.arange(len(fresh))
        keys = pa.concat_arrays([self.words, fresh])
        ids = pa.concat_arrays([self.ids, pa.array(self._joined(fresh.to_pylist(), odd), pa.large_binary())])
        out = ids.take(pa.array(places))
        short = pc.less_equal(pc.utf8_length(fresh), KNOWN_LENGTH)
        if len(keys) > self.limit or not pc.all(short).as_py():  # keep what is known, and the short ones if they fit
            n = len(self.words)
            kept = pa.concat_arrays([pa.array(np.ones(n, dtype=bool)), short]) if len(keys) <= self.limit else pa.array(np.zeros(len(keys), dtype=bool))
            keys, ids = keys.filter(kept), ids.filter(kept)
        self.words, self.ids = keys, ids
        return out

    def _ids_of_parts(self, parts: list[str]) -> list[np.ndarray]:
        odd = is_odd("\0".join(parts))
        texts = pa.array([marked(p, odd and is_odd(p)) for p in parts], pa.large_string())
        words = pc.split_pattern(texts, "\0")
        coded = words.flatten().dictionary_encode()
        # the ids of all words, one after another
        every = self._ids_of_words(coded.dictionary, odd).take(coded.indices)
        ids = np.frombuffer(every.buffers()[2] or b"", dtype="<u4")
        at = np.frombuffer(every.buffers()[1], dtype=np.int64)[words.offsets.to_numpy() - words.offsets[0].as_py()] // 4
        return [ids[a:b] for a, b in zip(at.tolist(), at[1:].tolist(), strict=False)]

    def ids_of_texts(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text, in order; takes in some megabytes of text at a time."""
        opened: list[np.ndarray] = []
        for group in _groups(texts):
            parts = [p for _, p in group]
            plain = [p for p in parts if "\0" not in p]  # the mark of the cuts
            got = iter(self._ids_of_parts(plain) if plain else [])
            for last, part in group:
                opened.append(next(got) if "\0" not in part else next(self._encode([part])))
                if last:
                    yield opened[0] if len(opened) == 1 else np.concatenate(opened)
                    opened = []


def _groups(texts: Iterable[str | None]) -> Iterator[list[tuple[bool, str]]]:
    """(last part of its text?, part): groups of about ``PART`` code points."""
    group, size = [], 0
    for text in texts:
        parts = list(text_parts(text or "", PART))
        for i, part in enumerate(parts):
            group.append((i == len(parts) - 1, part))
            size += len(part)
            if size >= PART:
                yield group
                group, size = [], 0
    if group:
        yield group


# ------------------------------------------------------------------ Spark

MANIFEST = "part int, file string, bytes long, ids long, docs long"


def write_token_files(docs: DataFrame, vocabulary: str, path: str, id_col: str = "doc_id", text_col: str = "text",
                      end_id: int = 0, bits: bool = False, block: int = BLOCK, level: int = LEVEL) -> None:
    """Encode the texts in ascending order of their ids to files of planes below ``path``.

    ``vocabulary`` is the JSON text of the tokenizer. ``path`` must be a store that
    every executor writes to through pyarrow (a shared folder, an object store, HDFS).
    A file holds the rows of one range partition (``spark.sql.shuffle.partitions``,
    merged by the planner where small).
    """
    spark = docs.sparkSession
    small_batches(spark)
    spread = spark.sparkContext.broadcast({"vocabulary": vocabulary})
    rows = keep_columns(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType
    # equal rows are told apart by their place, so that a range never holds all of them
    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("place"))
    order = [F.asc_nulls_last("doc_id"), F.asc("h"), F.asc("place")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    folder, schema = f"{path}/files", pa.schema([("part", pa.int32()), ("file", pa.string()), ("bytes", pa.int64()), ("ids", pa.int64()), ("docs", pa.int64())])
    from pyspark.sql.pandas.types import to_arrow_type

    doc_type = to_arrow_type(kind)

    end = np.array([end_id], dtype="<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, part = None, TaskContext.get().partitionId()
        name = f"part-{part:07d}-{uuid.uuid4().hex}.planes"
        rows = (r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        doc_ids: deque = deque()

        def texts() -> Iterator[str | None]:
            for doc_id, text in rows:
                doc_ids.append(doc_id)
                yield text

        if "coder" not in spread.value:  # one for all tasks of a worker
            spread.value["coder"] = Coder(spread.value["vocabulary"])
        gc.disable()  # nothing here makes cycles, and the collector would walk the dictionaries again and again
        try:
            for found in spread.value["coder"].ids_of_texts(texts()):
                if writer is None:
                    writer = PlaneWriter(open_output(f"{folder}/{name}"), doc_type, bits, block, level)
                writer.add(doc_ids.popleft(), found, end)
        finally:
            gc.enable()
        if writer is not None:
            writer.close()
            said = [[part], [name], [file_size(f"{folder}/{name}")], [writer.total], [len(writer.docs)]]
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(said, schema, strict=True)], schema=schema)

    ordered.mapInArrow(run, MANIFEST).write.parquet(f"{path}/manifest")


def open_output(uri: str) -> BinaryIO:
    from pyarrow import fs

    store, at = fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)
    store.create_dir(at.rpartition("/")[0], recursive=True)
    return store.open_output_stream(at)


def open_input(uri: str):
    from pyarrow import fs

    store, at = fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)
    return store.open_input_file(at)


def file_size(uri: str) -> int:
    with open_input(uri) as f:
        return f.size()


def read_manifest(spark: SparkSession, path: str, group: int = GROUP) -> DataFrame:
    """The manifest with ``start``: the ids of all files before each.

    Sums run within groups of files and over the groups, so no task takes all files.
    """
    files = spark.read.schema(MANIFEST).parquet(f"{path}/manifest").withColumn("group", F.floor(F.col("part") / group))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    groups = files.groupBy("group").agg(F.sum("ids").alias("all")).select(
        "group", F.coalesce(F.sum("all").over(before(Window.orderBy("group"))), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("ids").over(before(Window.partitionBy("group").orderBy("part"))), F.lit(0))
    return files.withColumn("inside", inside).join(groups, "group").select(
        "part", "file", "bytes", "ids", "docs", (F.col("base") + F.col("inside")).cast("long").alias("start"))


def read_token_files(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """doc_id, start, n_tokens, ids (packed little-endian uint32) of every document.

    ``start`` counts the ids of all documents before it, over all files.
    """
    small_batches(spark)
    folder = f"{path}/files"
    files = read_manifest(spark, path).select("part", "file", "start")
    files = files.repartition(2 * spark.sparkContext.defaultParallelism, "part")
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ddl = f"doc_id {id_type}, start long, n_tokens long, ids binary"
    out = to_arrow_schema(StructType.fromDDL(ddl))
    limit = 1 << 23  # bytes of ids of one batch

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns: list[list] = [[], [], [], []]
        doc_ids, starts, sizes, packed = columns
        size = 0

        def full() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out, strict=True)], schema=out)
            for c in columns:
                c.clear()
            return batch

        for batch in batches:
            for name, start in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                with open_input(f"{folder}/{name}") as f:
                    for doc_id, at, n, ids in PlaneReader(f).documents():
                        doc_ids.append(doc_id)
                        starts.append(start + at)
                        sizes.append(n)
                        packed.append(ids)
                        size += len(ids)
                        if size > limit or len(packed) >= 1000:
                            yield full()
                            size = 0
        yield full()

    return files.mapInArrow(run, ddl)


def token_files_report(docs: DataFrame, vocabulary: str, path: str) -> DataFrame:
    """Write the files, read them back, and digest each document's ids."""
    write_token_files(docs, vocabulary, path)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return read_token_files(docs.sparkSession, path, kind).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
