"""Input files in the layout of the engine's real inputs, written by Spark from the
analog tables (once per data directory, below the shared folder):

* ``rent_folder``  one ``;`` file group per year named ``rent_<year>_<x>.csv``, the
  year known only from the file name; later years have their columns in another
  order and one file has an upper-case ``.CSV`` extension;
* ``sale_folder``  ``|`` separated ``.txt`` files, one group per sale kind;
* ``geo_semicolon`` / ``geo_tab``  the lookup as ``;`` / TAB folders;
* ``geo_tolerant`` the lookup as TSV lines mixed with short and long (malformed) rows;
* ``nation_text``, ``typed_sales``  the nation table and sale lines as ``;`` text, for type
  inference;
* ``workbooks``    ``.xlsx`` workbooks (sheet ``Feuille1``) of customers per nation.
"""

from __future__ import annotations

import datetime as dt
import io
import threading
import uuid
import zipfile
from collections.abc import Callable
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propyield.plans.analogs import input_key, geo_table, load, rent_table, sale_table
from propyield.schemas import (
    GEO_RENAMES,
    RENT_HEADER,
    RENT_RENAMES,
    SALE_HEADER,
    SALE_RENAMES,
)
from propyield.session import shared_dir
from propyield.sinks import export_csv
from propyield.sources import fs
from propyield.sources.delimited import rename_columns

# Rent files of years after this one are written with their columns reversed.
REORDER_AFTER_YEAR = 1997

_LOCK = threading.Lock()


def _raw(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    """Back to the header names of the real files."""
    return rename_columns(df, {v: k for k, v in renames.items()})


def _letters(i: int) -> str:
    """0 -> a, 25 -> z, 26 -> ba: a digit-free file-name suffix."""
    s = ""
    while True:
        s = chr(ord("a") + i % 26) + s
        i //= 26
        if i == 0:
            return s


def _once(spark: SparkSession, sf_dir: str, name: str,
          write: Callable[[str], None]) -> str:
    """Run ``write(tmp_folder)`` once per data directory; return the final folder."""
    root = f"{shared_dir(spark)}/propyield/fixtures/{input_key(spark, sf_dir)}"
    final = f"{root}/{name}"
    with _LOCK:
        if not fs.exists(spark, f"{final}/_DONE"):
            tmp = f"{root}/{name}.tmp-{uuid.uuid4().hex}"
            write(tmp)
            spark.createDataFrame([("done",)], "s string").coalesce(1) \
                .write.mode("overwrite").text(f"{tmp}/_DONE")
            fs.delete(spark, final)
            fs.rename(spark, tmp, final)
    return final


def _unsorted(spark: SparkSession) -> SparkSession:
    """A session whose tasks keep a file open for each part, so that no task sorts its rows."""
    own = spark.newSession()
    own.conf.set("spark.sql.maxConcurrentOutputFileWriters", "64")
    return own


def _spread_parts(spark: SparkSession, parts_dir: str, part_col: str, folder: str,
                  stem: Callable[[str], str], ext: str, upper_first: bool = False) -> None:
    """Move ``parts_dir/<part_col>=<v>/part-*`` files to ``folder/<stem(v)>_<x><ext>``."""
    n = 0
    for sub in fs.glob(spark, f"{parts_dir}/{part_col}=*"):
        value = sub.rsplit("=", 1)[1]
        for i, part in enumerate(fs.glob(spark, f"{sub}/part-*")):
            suffix = ext.upper() if (upper_first and n == 0) else ext
            fs.rename(spark, part, f"{folder}/{stem(value)}_{_letters(i)}{suffix}")
            n += 1
    fs.delete(spark, parts_dir)


def rent_folder(spark: SparkSession, sf_dir: str) -> str:
    def write(tmp: str) -> None:
        rent_table(spark, sf_dir)  # made in the caller's session
        raw = _raw(rent_table(_unsorted(spark), sf_dir), RENT_RENAMES)  # RENT_HEADER + year
        early = raw.where(F.col("year").cast("int") <= REORDER_AFTER_YEAR)
        late = raw.where(F.col("year").cast("int") > REORDER_AFTER_YEAR) \
            .select(*[F.col(f"`{c}`") for c in reversed(RENT_HEADER)], "year")
        for tag, part in (("early", early), ("late", late)):
            parts_dir = f"{tmp}/_{tag}"
            part.write.partitionBy("year").options(header=True, sep=";").csv(parts_dir)
            _spread_parts(spark, parts_dir, "year", tmp, lambda y: f"rent_{y}", ".csv",
                          upper_first=(tag == "early"))
    return _once(spark, sf_dir, "rent_folder", write)


def sale_folder(spark: SparkSession, sf_dir: str) -> str:
    def write(tmp: str) -> None:
        sale_table(spark, sf_dir)  # made in the caller's session
        raw = _raw(sale_table(_unsorted(spark), sf_dir), SALE_RENAMES)
        parts_dir = f"{tmp}/_parts"
        (raw.withColumn("_kind", F.col("Nature mutation"))
         .write.partitionBy("_kind").options(header=True, sep="|").csv(parts_dir))
        _spread_parts(spark, parts_dir, "_kind", tmp, lambda k: f"sales_{k.lower()}",
                      ".txt", upper_first=True)
    return _once(spark, sf_dir, "sale_folder", write)


def geo_delimited(spark: SparkSession, sf_dir: str, sep: str) -> str:
    name = "geo_tab" if sep == "\t" else "geo_semicolon"
    return _once(spark, sf_dir, name, lambda tmp: export_csv(
        _raw(geo_table(spark, sf_dir), GEO_RENAMES), tmp, sep=sep))


TOLERANT_HEADER = ["code", "commune", "dep", "region_label"]


def geo_tolerant(spark: SparkSession, sf_dir: str) -> str:
    """Every lookup row as a 4-field TSV line, plus a 2-field and a 5-field line."""
    def write(tmp: str) -> None:
        g = geo_table(spark, sf_dir)
        good = F.concat_ws("\t", "insee", "commune", "dep", "region_label")
        short = F.concat_ws("\t", "insee", "commune")
        long = F.concat_ws("\t", "insee", "commune", "dep", "region_label", "region_code")
        lines = g.select(F.explode(F.array(good, short, long)).alias("\t".join(TOLERANT_HEADER)))
        (lines.write.options(header=True, sep="\u0001", quote="", escapeQuotes=False,
                             ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
         .csv(tmp))
    return _once(spark, sf_dir, "geo_tolerant", write)


def typed_sales(spark: SparkSession, sf_dir: str) -> str:
    """Sale lines as ``;`` files for type inference, one column order for each line status:
    a code with leading zeros, a code of digits in some files and of letters in others, whole
    and decimal numbers, a date, a flag, and a column that only some rows fill."""
    def write(tmp: str) -> None:
        line = load(spark, sf_dir, "lineitem")
        shipped = F.date_format("l_shipdate", "yyyy-MM-dd")
        rows = line.select(
            "l_linestatus", F.col("l_orderkey").alias("order"), F.lpad(F.col("l_partkey").cast("string"), 8, "0").alias("part"),
            F.concat(F.when(F.col("l_linestatus") == "O", "2A").otherwise("1"), F.lpad(F.col("l_suppkey").cast("string"), 4, "0")).alias("place"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("price"), shipped.alias("shipped"),
            (F.col("l_returnflag") == "R").alias("returned"),
            F.when(F.col("l_linenumber") > 3, F.col("l_linenumber")).alias("line"))
        for status in ("F", "O"):
            part = rows.where(F.col("l_linestatus") == status).drop("l_linestatus")
            export_csv(part.select(*(part.columns if status == "F" else reversed(part.columns))), f"{tmp}/_{status}")
            for i, file in enumerate(fs.glob(spark, f"{tmp}/_{status}/part-*")):
                fs.rename(spark, file, f"{tmp}/lines_{status}_{_letters(i)}.csv")
            fs.delete(spark, f"{tmp}/_{status}")
    return _once(spark, sf_dir, "typed_sales", write)


def nation_text(spark: SparkSession, sf_dir: str) -> str:
    return _once(spark, sf_dir, "nation_text",
                 lambda tmp: export_csv(load(spark, sf_dir, "nation"), tmp, sep=";"))


# ------------------------------------------------------------------ workbooks

# --- fixed values: the parts that the workbook format asks for in any file
_CONTENT_TYPES = (
    '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
    '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
    '<Default Extension="xml" ContentType="application/xml"/>'
    '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
    '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
    '<Override PartName="/xl/sharedStrings.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sharedStrings+xml"/>'
    '</Types>')
_ROOT_RELS = (
    '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
    '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/>'
    '</Relationships>')
_WORKBOOK = (
    '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
    'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">'
    '<sheets><sheet name="{sheet}" sheetId="1" r:id="rId1"/></sheets></workbook>')
_WORKBOOK_RELS = (
    '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
    '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/>'
    '<Relationship Id="rId2" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/sharedStrings" Target="sharedStrings.xml"/>'
    '</Relationships>')


_STYLES = (
    '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    '<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
    '<cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
# --- end of fixed values ---


def xlsx_bytes(header: list[str | None], rows: list[list], sheet: str = "Feuille1") -> bytes:
    """A minimal one-sheet workbook: text as shared strings, numbers as values, dates
    as serial numbers of a date style, None as a blank (absent) cell."""
    strings: dict[str, int] = {}

    def cell(ref: str, v) -> str:
        if v is None:
            return ""
        if isinstance(v, str):
            i = strings.setdefault(v, len(strings))
            return f'<c r="{ref}" t="s"><v>{i}</v></c>'
        if isinstance(v, bool):
            return f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
        if isinstance(v, dt.date):
            return f'<c r="{ref}" s="1"><v>{(v - dt.date(1899, 12, 30)).days}</v></c>'
        return f'<c r="{ref}"><v>{float(v)!r}</v></c>'

    lines = []
    for n, values in enumerate([header, *rows], start=1):
        cells = "".join(cell(f"{chr(ord('A') + j)}{n}", v) for j, v in enumerate(values))
        lines.append(f'<row r="{n}">{cells}</row>')
    sheet_xml = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                 '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
                 f'<sheetData>{"".join(lines)}</sheetData></worksheet>')
    sst = ''.join(f'<si><t>{escape(s)}</t></si>' for s in strings)
    shared_xml = ('<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                  '<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
                  f'count="{len(strings)}" uniqueCount="{len(strings)}">{sst}</sst>')
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", _CONTENT_TYPES)
        z.writestr("_rels/.rels", _ROOT_RELS)
        z.writestr("xl/workbook.xml", _WORKBOOK.format(sheet=escape(sheet)))
        z.writestr("xl/_rels/workbook.xml.rels", _WORKBOOK_RELS)
        z.writestr("xl/worksheets/sheet1.xml", sheet_xml)
        z.writestr("xl/sharedStrings.xml", shared_xml)
        z.writestr("xl/styles.xml", _STYLES)
    return buf.getvalue()


WORKBOOK_HEADER = ["code", "dep", "level", "pct", "pct", None, "day"]
# customers per workbook group: bounds the rows one task turns into one file
WORKBOOK_CHUNK = 50_000


def _open_output(uri: str):
    import pyarrow.fs as pafs
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    filesystem, path = pafs.FileSystem.from_uri(uri)
    filesystem.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return filesystem.open_output_stream(path)


def workbook_folder(spark: SparkSession, sf_dir: str) -> str:
    """One workbook per (nation, customer-key range): code (text that looks numeric),
    dep, level (blank for one segment), pct (number), a second column of that name
    (the key), a column without a name (a boolean) and a date."""
    def write(tmp: str) -> None:
        c = load(spark, sf_dir, "customer")
        n = load(spark, sf_dir, "nation")
        data = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("code"),
            F.col("n_name").alias("dep"),
            F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_mktsegment")).alias("level"),
            F.col("c_acctbal").alias("pct"), "c_custkey",
            F.floor(F.col("c_custkey") / WORKBOOK_CHUNK).alias("chunk"))

        def write_group(pdf):
            import pandas as pd
            name = f"niveau_{pdf['dep'].iloc[0]}_{_letters(int(pdf['chunk'].iloc[0]))}.xlsx"
            rows = [[r.code, r.dep, None if pd.isna(r.level) else r.level,
                     None if pd.isna(r.pct) else float(r.pct), float(r.c_custkey),
                     r.c_custkey % 2 == 0, dt.date(2020, 1, 1) + dt.timedelta(days=int(r.c_custkey % 1000))]
                    for r in pdf.itertuples(index=False)]
            with _open_output(f"{tmp}/{name}") as out:
                out.write(xlsx_bytes(WORKBOOK_HEADER, rows))
            return pd.DataFrame({"file": [name], "rows": [len(rows)]})

        data.groupBy("dep", "chunk").applyInPandas(write_group, "file string, rows long").count()
    return _once(spark, sf_dir, "workbooks", write)
