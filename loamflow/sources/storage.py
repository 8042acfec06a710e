"""Small files on the shared file system, through the Hadoop file systems Spark itself uses.

A path without a scheme means what it means to Spark (below ``fs.defaultFS``), and every
scheme that Spark reads works here, so schema versions, file manifests and the data they
describe always lie on one file system."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def qualify(spark: SparkSession, path: str) -> str:
    """The path with its scheme and authority."""
    fs, p = _open(spark, path)
    return fs.makeQualified(p).toString()


#: Hadoop's local file system and Hive's wrapper of it, which write a checksum file for each file.
_WITH_CHECKSUMS = ("org.apache.hadoop.fs.LocalFileSystem", "org.apache.hadoop.hive.ql.io.ProxyLocalFileSystem")


def without_checksums(spark: SparkSession, path: str) -> str | None:
    """Class of the plain file system below a local one that adds checksum files; None for any other."""
    fs, _ = _open(spark, path)
    return "org.apache.hadoop.fs.RawLocalFileSystem" if fs.getClass().getName() in _WITH_CHECKSUMS else None


def names(spark: SparkSession, folder: str) -> list[str]:
    """File names directly below a folder; none if there is no such folder."""
    fs, p = _open(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p)


def folders(spark: SparkSession, glob: str) -> list[str]:
    """Folders that match a glob."""
    fs, p = _open(spark, glob)
    return [s.getPath().toString() for s in (fs.globStatus(p) or []) if s.isDirectory()]


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    fs, p = _open(spark, path)
    return fs.getContentSummary(p).getLength()


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _open(spark, path)
    fs.mkdirs(p)


def write(spark: SparkSession, path: str, data: bytes) -> None:
    """Write a small file under a temporary name and move it into place, over an older one."""
    folder, _, name = path.rpartition("/")
    fs, p = _open(spark, path)
    _, tmp = _open(spark, f"{folder}/_tmp_{uuid.uuid4().hex}_{name}")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(tmp, p):
        raise OSError(f"cannot move {tmp} to {path}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _open(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a text file, gzip by its suffix; nothing after it is read."""
    fs, p = _open(spark, path)
    stream = fs.open(p)
    jvm = spark._jvm
    try:
        inner = jvm.java.util.zip.GZIPInputStream(stream) if path.lower().endswith(".gz") else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(inner, "UTF-8")).readLine() or ""
    finally:
        stream.close()
