"""Spreadsheet source: one sheet of every ``.xlsx`` workbook in a folder.

Spark lists the workbooks with the ``binaryFile`` source (one row per file, so many
workbooks are decoded in parallel tasks) and ``mapInArrow`` decodes each one with
the standard library: a workbook is a zip of XML parts. The first row of the sheet
is the header; blank and repeated names are numbered (``_c3``, ``taux1``). Types are
declared by the caller or inferred by a first distributed pass whose kinds are merged
by column name in Spark, so one row a column reaches the driver; what it found is kept
for unchanged files. Numbers in cells of a date format become timestamps.

``register_workbooks`` adds the same as a data source (``spark.read.format("workbook")``).
"""

from __future__ import annotations

import datetime as dt
import hashlib
import io
import json
import re
import uuid
import zipfile
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from propyield.session import shared_dir
from propyield.sources import fs

# --- fixed values: sheet read by default, and the Office Open XML namespaces
DEFAULT_SHEET = "Feuille1"
MAIN_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
DOC_REL_NS = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
PKG_REL_NS = "{http://schemas.openxmlformats.org/package/2006/relationships}"
# number formats of the standard that show dates or times, by their id
DATE_FORMATS = frozenset([*range(14, 23), *range(27, 37), 45, 46, 47, *range(50, 59)])
# day 0 of the serial dates (of the 1900 system, from March 1900 on; and of the 1904 one)
EPOCHS = {False: dt.datetime(1899, 12, 30), True: dt.datetime(1904, 1, 1)}
# --- end of fixed values

_REF = re.compile(r"([A-Z]+)(\d+)")


def _column_index(ref: str | None, fallback: int) -> int:
    m = _REF.match(ref or "")
    if not m:
        return fallback
    idx = 0
    for ch in m.group(1):
        idx = idx * 26 + (ord(ch) - ord("A") + 1)
    return idx - 1


def _date_styles(styles: ET.Element) -> set[int]:
    """The cell styles whose number format shows a date or a time."""
    custom = {int(f.get("numFmtId", -1)): f.get("formatCode", "") for f in styles.iter(f"{MAIN_NS}numFmt")}
    plain = {i: re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", code).lower() for i, code in custom.items()}
    dates = DATE_FORMATS | {i for i, code in plain.items() if re.search("[ymdhs]", code) and "general" not in code}
    cells = styles.find(f"{MAIN_NS}cellXfs")
    return {i for i, x in enumerate(cells if cells is not None else []) if int(x.get("numFmtId", 0)) in dates}


def header_names(row: list) -> list[str]:
    """One name for each column: blanks by their place, repeats numbered from 1."""
    names: list[str] = []
    for i, value in enumerate(row):
        name = base = str(value).strip() if value not in (None, "") else f"_c{i}"
        n = 0
        while name in names:
            n += 1
            name = f"{base}{n}"
        names.append(name)
    return names


def _cell_value(c: ET.Element, shared: list[str], dates: set[int] = frozenset(), epoch=EPOCHS[False]):
    t = c.get("t", "n")
    if t == "inlineStr":
        return "".join(x.text or "" for x in c.iter(f"{MAIN_NS}t"))
    v = c.find(f"{MAIN_NS}v")
    if v is None or v.text is None:
        return None
    if t == "s":
        return shared[int(v.text)]
    if t == "b":
        return v.text == "1"
    if t in ("str", "d"):
        return v.text
    if t == "e":
        return None
    number = float(v.text)
    if int(c.get("s", 0)) in dates:
        return epoch + dt.timedelta(milliseconds=round(number * 86_400_000))
    return number


def sheet_rows(data: bytes, sheet: str = DEFAULT_SHEET) -> list[list]:
    """Rows of ``sheet`` (first row = header) as lists, blank cells as None."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = set(z.namelist())
        shared: list[str] = []
        if "xl/sharedStrings.xml" in names:
            root = ET.fromstring(z.read("xl/sharedStrings.xml"))
            shared = ["".join(t.text or "" for t in si.iter(f"{MAIN_NS}t"))
                      for si in root.iter(f"{MAIN_NS}si")]
        wb = ET.fromstring(z.read("xl/workbook.xml"))
        rid = next((s.get(f"{DOC_REL_NS}id") for s in wb.iter(f"{MAIN_NS}sheet")
                    if s.get("name") == sheet), None)
        if rid is None:
            raise ValueError(f"no sheet named {sheet!r}")
        rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
        target = next(r.get("Target") for r in rels.iter(f"{PKG_REL_NS}Relationship")
                      if r.get("Id") == rid)
        part = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
        dates = _date_styles(ET.fromstring(z.read("xl/styles.xml"))) if "xl/styles.xml" in names else set()
        properties = wb.find(f"{MAIN_NS}workbookPr")
        epoch = EPOCHS[properties is not None and properties.get("date1904") in ("1", "true")]
        rows = []
        with z.open(part) as sheet_xml:
            for _, row in ET.iterparse(sheet_xml):  # a row at a time, not the whole document
                if row.tag != f"{MAIN_NS}row":
                    continue
                cells: dict[int, object] = {}
                for pos, c in enumerate(row.iter(f"{MAIN_NS}c")):
                    cells[_column_index(c.get("r"), pos)] = _cell_value(c, shared, dates, epoch)
                width = max(cells) + 1 if cells else 0
                rows.append([cells.get(i) for i in range(width)])
                row.clear()
    return rows


def _kind(v) -> str:
    if v is None or v == "":
        return "empty"
    if isinstance(v, bool):
        return "boolean"
    if isinstance(v, float):
        return "double"
    if isinstance(v, dt.datetime):
        return "timestamp"
    return "string"


def _merge(a: str, b: str) -> str:
    if a == "empty":
        return b
    if b == "empty" or a == b:
        return a
    return "string"


_KIND_TYPE = {"double": DoubleType(), "boolean": BooleanType(), "string": StringType(), "timestamp": TimestampNTZType(),
              "empty": StringType()}


_TRUTH = {"true": True, "vrai": True, "1": True, "false": False, "faux": False, "0": False}


def _as(v, dtype):
    if v is None or v == "":
        return None
    if isinstance(dtype, DoubleType):
        if isinstance(v, dt.datetime):
            return None
        if isinstance(v, str):
            try:
                return float(v.replace(",", "."))
            except ValueError:
                return None
        return float(v)
    if isinstance(dtype, BooleanType):
        # text as spreadsheets write it; anything else is no boolean
        return _TRUTH.get(v.strip().lower()) if isinstance(v, str) else bool(v)
    if isinstance(dtype, TimestampNTZType):
        return v if isinstance(v, dt.datetime) else None
    if isinstance(v, float):
        return str(int(v)) if v.is_integer() else repr(v)
    return str(v)


def _list(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", False).load(folder))
    return files.select("path", "length", "modificationTime", "content")


def header_kinds(rows: list[list]) -> tuple[list[str], list[str]]:
    """Header names and the merged kind of each column's values."""
    header = header_names(rows[0]) if rows else []
    kinds = ["empty"] * len(header)
    for r in rows[1:]:
        for i, v in enumerate(r[:len(header)]):
            kinds[i] = _merge(kinds[i], _kind(v))
    return header, kinds


def infer_workbook_schema(files: DataFrame, sheet: str = DEFAULT_SHEET) -> StructType:
    """Header names and value kinds of all workbooks, merged by name in Spark."""
    out = StructType([StructField("name", StringType()), StructField("place", StringType()),
                      StructField("kind", StringType())])

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[str, str, str]] = []
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                header, kinds = header_kinds(sheet_rows(content, sheet))
                found += [(h, f"{path}\x1f{i:06d}", k) for i, (h, k) in enumerate(zip(header, kinds))]
            yield pa.RecordBatch.from_pydict({"name": [f[0] for f in found], "place": [f[1] for f in found],
                                              "kind": [f[2] for f in found]})

    known = F.array_remove(F.collect_set("kind"), "empty")
    merged = (files.mapInArrow(summarise, out).groupBy("name")
              .agg(F.min("place").alias("place"),
                   F.when(F.size(known) == 1, known[0]).when(F.size(known) == 0, "empty").otherwise("string").alias("kind")))
    # one row a column, in the order of the first workbook that has it
    columns = sorted(merged.collect(), key=lambda r: r["place"])
    return StructType([StructField(r["name"], _KIND_TYPE[r["kind"]]) for r in columns])


def known_workbook_schema(spark: SparkSession, files: DataFrame, sheet: str = DEFAULT_SHEET) -> StructType | None:
    """``infer_workbook_schema``, remembered below the shared folder for these very files.

    The key is a digest of the workbooks' paths, sizes and times, so a changed, new or removed
    workbook is inferred anew, and unchanged ones are decoded once a read. None: no workbook.
    """
    said = F.concat_ws(":", "path", "length", "modificationTime")
    key = files.agg(F.sha1(F.array_join(F.sort_array(F.collect_list(said)), "\n")).alias("k"), F.count(F.lit(1)).alias("n")).first()
    if not key["n"]:
        return None
    name = hashlib.sha1(f"{key['k']}\n{sheet}".encode()).hexdigest()
    path = f"{shared_dir(spark)}/propyield/workbook-kinds/{name}.json"
    if fs.exists(spark, path):
        return StructType.fromJson(json.loads(fs.read_text(spark, path)))
    schema = infer_workbook_schema(files.select("path", "content"), sheet)
    draft = f"{path}.{uuid.uuid4().hex}"
    fs.write_text(spark, draft, json.dumps(schema.jsonValue()))
    if not fs.exists(spark, path):
        fs.rename(spark, draft, path)
    return schema


def decoded(data: bytes, path: str, fields: list[StructField], sheet: str, file_column: str | None,
            schema: pa.Schema) -> pa.RecordBatch:
    """The rows of one workbook as the columns of ``fields``, matched by header name; only
    those are converted."""
    rows = sheet_rows(data, sheet)
    pos = {h: i for i, h in enumerate(header_names(rows[0]))} if rows else {}
    cols = {}
    for f in fields:
        i = pos.get(f.name)
        cols[f.name] = [_as(r[i] if i is not None and i < len(r) else None, f.dataType) for r in rows[1:]]
    if file_column:
        cols[file_column] = [path] * max(0, len(rows) - 1)
    return pa.RecordBatch.from_pydict(cols, schema=schema)


def read_workbooks(spark: SparkSession, folder: str, sheet: str = DEFAULT_SHEET,
                   schema: StructType | None = None, glob: str = "*.[xX][lL][sS][xX]",
                   file_column: str | None = None) -> DataFrame:
    """Rows of ``sheet`` from every workbook in ``folder``, matched to ``schema`` by
    header name (a column a workbook lacks is null). ``file_column`` adds the path. A
    folder without workbooks (extension in any case) is an error.

    Each workbook is decoded once; without a schema the kinds of its values are inferred by
    a pass of their own, which is remembered for unchanged workbooks.
    """
    files = _list(spark, folder, glob)
    if schema is None:
        schema = known_workbook_schema(spark, files, sheet)
        if schema is None:
            raise ValueError(f"no workbook in folder {folder}")
    elif files.select("path").isEmpty():
        raise ValueError(f"no workbook in folder {folder}")
    fields = list(schema.fields)
    out_schema = StructType(fields + ([StructField(file_column, StringType())] if file_column else []))
    arrow_schema = to_arrow_schema(out_schema)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                yield decoded(content, path, fields, sheet, file_column, arrow_schema)

    return files.select("path", "content").mapInArrow(decode, out_schema)


class WorkbookSource(DataSource):
    """``spark.read.format("workbook").option("sheet", ...).load(folder)``: one partition a workbook.

    With ``.schema(...)`` the wanted columns alone are converted and each workbook is decoded
    once. Without one the first workbook's header and kinds are taken (``read_workbooks`` infers
    over all of them in Spark). The folder is read through pyarrow's filesystems.
    """

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> StructType:
        paths = self._paths()
        with _opened(paths[0]) as f:
            header, kinds = header_kinds(sheet_rows(f.read(), self._sheet()))
        return StructType([StructField(h, _KIND_TYPE[k]) for h, k in zip(header, kinds, strict=True)])

    def reader(self, schema: StructType) -> "WorkbookReader":
        return WorkbookReader(self._paths(), schema, self._sheet())

    def _sheet(self) -> str:
        return self.options.get("sheet", DEFAULT_SHEET)

    def _paths(self) -> list[str]:
        from pyarrow import fs as stores

        folder = self.options.get("path")
        if not folder:
            raise ValueError("the workbook source needs a folder: load(folder)")
        store, at = _store(folder)
        found = store.get_file_info(stores.FileSelector(at))
        prefix = folder.rstrip("/")
        names = sorted(f.base_name for f in found if f.is_file and f.base_name.lower().endswith(".xlsx") and f.base_name[0] not in "._")
        if not names:
            raise ValueError(f"no workbook in folder {folder}")
        return [f"{prefix}/{n}" for n in names]


class WorkbookReader(DataSourceReader):
    def __init__(self, paths: list[str], schema: StructType, sheet: str):
        self.paths, self.fields, self.sheet = paths, list(schema.fields), sheet

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.paths]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        with _opened(partition.value) as f:
            yield decoded(f.read(), partition.value, self.fields, self.sheet, None, to_arrow_schema(StructType(self.fields)))


def _store(uri: str):
    from pyarrow import fs as stores

    if "://" not in uri and not uri.startswith("file:"):
        return stores.LocalFileSystem(), uri
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return stores.FileSystem.from_uri(uri)


def _opened(uri: str):
    store, at = _store(uri)
    return store.open_input_file(at)


def register_workbooks(spark: SparkSession) -> None:
    """Make the ``workbook`` format known to the session."""
    spark.dataSource.register(WorkbookSource)
