"""Landing writer: one Parquet or CSV file per (collection, day, file_key) group, named
'<epoch13>_<collection>_<dd>_<ff>.<ext>' in the Hive landing layout.

Spark's own writer cannot choose file names, so the groups go through
``groupBy(...).applyInArrow``: Spark shuffles rows by file, each task writes its files
with Arrow (types kept as they are, no pandas conversion). Rows per group are bounded by
the caller's ``file_key`` (see :func:`block_file_key`), never by the data size. A retried
task rewrites the same name with the same rows; files are written under a hidden
temporary name and moved into place."""

from __future__ import annotations

import io
import os
import uuid
from urllib.parse import unquote, urlparse

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pacsv
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..session import ship_package
from . import storage

MANIFEST_SCHEMA = ("path string, collection string, day date, file_key long, "
                   "format string, rows long, bytes long")
_CONTROL = ("collection", "day", "file_key", "file_epoch_ms", "_format", "_reverse", "_mtime_ms",
            "_name_day")


def block_file_key(id_col: str | Column, rows_per_file: int) -> Column:
    """File key from a unique row id: at most ``rows_per_file`` rows per file."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    n = F.lit(int(rows_per_file))
    return ((c - F.pmod(c, n)) / n).cast("long")


def resolve_fs(uri: str):
    """(pyarrow filesystem, path, is_local) for a qualified Hadoop-style URI (see storage.qualify):
    what a path without a scheme means, only the driver's configuration says."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + unquote(urlparse(uri).path).lstrip("/"), True
    if "://" not in uri:
        raise ValueError(f"not a qualified path: {uri}")
    fixed = uri.replace("s3a://", "s3://", 1).replace("s3n://", "s3://", 1)
    fs, path = pafs.FileSystem.from_uri(fixed)
    return fs, path, False


def _as_uri(root: str, local_path: str, is_local: bool, fs_path: str) -> str:
    if is_local:
        return "file:" + local_path
    scheme = root.split("://", 1)[0]
    return f"{scheme}://{fs_path}"


def _file_bytes(table: pa.Table, fmt: str) -> bytes:
    buf = io.BytesIO()
    if fmt == "csv":
        pacsv.write_csv(table, buf, pacsv.WriteOptions(include_header=True, quoting_style="needed"))
    else:
        pq.write_table(table, buf)
    return buf.getvalue()


def _make_writer(root: str, database: str, default_fmt: str, omit_null_columns: bool):
    root = root.rstrip("/")

    def write_group(table: pa.Table) -> pa.Table:
        if table.num_rows == 0:
            return pa.table({n: [] for n in ("path", "collection", "day", "file_key", "format",
                                             "rows", "bytes")})
        coll = table.column("collection")[0].as_py()
        day = table.column("day")[0].as_py()
        key = int(table.column("file_key")[0].as_py())
        epoch = int(pc.min(table.column("file_epoch_ms")).as_py())
        fmt = table.column("_format")[0].as_py() if "_format" in table.column_names else default_fmt
        reverse = bool(table.column("_reverse")[0].as_py()) if "_reverse" in table.column_names else False
        mtime = (table.column("_mtime_ms")[0].as_py() if "_mtime_ms" in table.column_names else None)
        payload = table.drop_columns([c for c in _CONTROL if c in table.column_names])
        if omit_null_columns:
            keep = [n for n in payload.column_names if payload.column(n).null_count < payload.num_rows]
            payload = payload.select(keep)
        if reverse:
            payload = payload.select(list(reversed(payload.column_names)))
        name_day = (int(table.column("_name_day")[0].as_py()) if "_name_day" in table.column_names
                    else day.day)
        name = f"{epoch:013d}_{coll}_{name_day:02d}_{key:02d}.{fmt}"
        rel = (f"{config.LANDING_SOURCE_SEGMENT}/year={day.year:04d}/month={day.month:02d}/"
               f"day={day.day:02d}/database={database}/collection={coll}")
        fs, base, is_local = resolve_fs(root)
        dir_path = f"{base}/{rel}"
        fs.create_dir(dir_path, recursive=True)
        data = _file_bytes(payload, fmt)
        tmp = f"{dir_path}/_tmp_{uuid.uuid4().hex}_{name}"
        final = f"{dir_path}/{name}"
        with fs.open_output_stream(tmp) as out:
            out.write(data)
        fs.move(tmp, final)
        if mtime is not None and is_local:
            os.utime(final, (mtime / 1000.0, mtime / 1000.0))
        return pa.table({
            "path": [_as_uri(root, final, is_local, final)], "collection": [coll],
            "day": pa.array([day], pa.date32()), "file_key": pa.array([key], pa.int64()),
            "format": [fmt], "rows": pa.array([payload.num_rows], pa.int64()),
            "bytes": pa.array([len(data)], pa.int64())})

    return write_group


def write_landing(df: DataFrame, root: str, database: str, manifest_path: str,
                  fmt: str = "parquet", omit_null_columns: bool = False) -> DataFrame:
    """Write ``df`` as landing files and return the manifest (one row per file).

    ``df`` columns: ``collection`` string, ``day`` date, ``file_key`` long,
    ``file_epoch_ms`` long (the file name epoch is its minimum per file), optional
    ``_format`` ('parquet'/'csv', per file), ``_reverse`` (write columns in reverse order),
    ``_mtime_ms`` (local file systems only: set the modification time), ``_name_day`` (day
    number used in the file name instead of the day of month), and the payload
    columns. With ``omit_null_columns`` a column that is NULL in every row of a file is
    left out of that file."""
    ship_package(df.sparkSession)
    writer = _make_writer(storage.qualify(df.sparkSession, root), database, fmt, omit_null_columns)
    manifest = (df.groupBy("collection", "day", "file_key")
                .applyInArrow(writer, MANIFEST_SCHEMA))
    manifest.write.mode("overwrite").parquet(manifest_path)
    return df.sparkSession.read.parquet(manifest_path)
