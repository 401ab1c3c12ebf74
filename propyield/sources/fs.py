"""Small Hadoop FileSystem helpers (listing, rename, delete) through the session's JVM.

They work on whatever filesystem the path names (local, HDFS, object stores) and
only touch metadata on the driver; data always moves through Spark jobs.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, jpath


def list_files(spark: SparkSession, folder: str, suffix: str) -> list[str]:
    """Files directly in ``folder`` whose name ends with ``suffix``, any case.

    Not recursive: sub-folders are ignored. Sorted, so unions are reproducible.
    """
    fs, jpath = _fs(spark, folder)
    if not fs.exists(jpath):
        return []
    want = suffix.lower()
    out = []
    for st in fs.listStatus(jpath):
        name = st.getPath().getName()
        if st.isFile() and name.lower().endswith(want) and not name.startswith((".", "_")):
            out.append(st.getPath().toString())
    return sorted(out)


def listing(spark: SparkSession, path: str) -> list[str]:
    """``name:bytes:time`` of a file, or of everything below a folder, sorted.

    Any filesystem that Spark reads; used to notice changed inputs.
    """
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return []
    out, files = [], fs.listFiles(jpath, True)
    while files.hasNext():
        st = files.next()
        out.append(f"{st.getPath()}:{st.getLen()}:{st.getModificationTime()}")
    return sorted(out)


def escaped(path: str) -> str:
    """``path`` with the characters that readers take as patterns escaped."""
    return "".join("\\" + c if c in "{}[]*?\\" else c for c in path)


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file."""
    fs, jpath = _fs(spark, path)
    fs.create(jpath, True).close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small UTF-8 file, replaced."""
    fs, jpath = _fs(spark, path)
    stream = fs.create(jpath, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small UTF-8 file."""
    fs, jpath = _fs(spark, path)
    stream = fs.open(jpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def make_folder(spark: SparkSession, path: str) -> None:
    fs, jpath = _fs(spark, path)
    fs.mkdirs(jpath)


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return bool(fs.exists(jpath))


def delete(spark: SparkSession, path: str) -> None:
    fs, jpath = _fs(spark, path)
    fs.delete(jpath, True)


def rename(spark: SparkSession, src: str, dst: str) -> None:
    fs, jsrc = _fs(spark, src)
    jdst = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(dst)
    if not fs.rename(jsrc, jdst):
        raise OSError(f"could not rename {src} to {dst}")


def glob(spark: SparkSession, pattern: str) -> list[str]:
    fs, jpath = _fs(spark, pattern)
    found = fs.globStatus(jpath)
    return sorted(st.getPath().toString() for st in (found or []))


def folder_bytes(spark: SparkSession, folder: str) -> int:
    """Bytes of everything below a folder, or of a file (one call to the filesystem)."""
    fs, jpath = _fs(spark, folder)
    return fs.getContentSummary(jpath).getLength() if fs.exists(jpath) else 0


def has_folders(spark: SparkSession, folder: str) -> bool:
    """Whether anything lies in sub-folders of a folder."""
    fs, jpath = _fs(spark, f"{escaped(folder.rstrip('/'))}/*/*")
    return bool(fs.globStatus(jpath))


def depth(spark: SparkSession, folder: str) -> int:
    """The number of slashes in the folder's absolute path."""
    fs, jpath = _fs(spark, folder)
    return fs.makeQualified(jpath).toUri().getPath().rstrip("/").count("/")
