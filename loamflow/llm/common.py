"""Helpers shared by the text operators: Arrow blocks, byte-level word hashing in numpy,
and tables written to the shared work folder to cut lineage.

Words are the maximal runs of characters outside space and TAB..CR; "lower case" maps A-Z
only. Both work on UTF-8 bytes: the separators and A-Z are ASCII, and a UTF-8 multi-byte
sequence holds no ASCII byte.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_run_dir, ship_package

WORD = r"[^\x20\x09-\x0D]+"
#: Text bytes handled at once by the numpy kernels (a longer document is one block).
BLOCK_BYTES = 1 << 20
#: Limits of the batches that go to and from Python workers.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared work folder and read it back: lineage is cut, and a lost
    executor loses nothing that the folder holds."""
    spark = df.sparkSession
    path = new_run_dir(spark, label)
    with shuffles_released(spark):
        df.write.parquet(path)
    give_back()
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """A job within deletes its shuffle files when it has ended, not when the driver happens to
    collect its garbage; for jobs whose result is written."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def give_back() -> None:
    """Return memory that is free in this process to the system: Arrow's pool, and the C heap
    where it can be trimmed."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def _tidy(func: Callable) -> Callable:
    """``func``, giving memory back when a partition ends: a worker is reused by later stages."""
    @wraps(func)
    def run(batches):
        try:
            yield from func(batches)
        finally:
            give_back()
    return run


def free_name(names: list[str], stem: str) -> str:
    """``stem``, with so many underscores that no column of ``names`` is called so."""
    taken = {n.lower() for n in names}
    while stem.lower() in taken:
        stem += "_"
    return stem


def map_arrow(df: DataFrame, func: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` in batches small enough for whole texts: the session's batch limits are
    lowered to BATCH_ROWS and BATCH_BYTES if they are above (results don't depend on them)."""
    spark = df.sparkSession
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        now = spark.conf.get(key).rstrip("bB")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))
    ship_package(spark)
    return df.mapInArrow(_tidy(func), schema)


def keyed_text(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The two columns an operator reads, under fixed names; a null text becomes empty.
    Other columns, whatever their names, are left out."""
    return df.select(F.col(key).cast("long").alias("doc_id"),
                     F.coalesce(F.col(text), F.lit("")).alias("text"))


def utf8(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary Arrow array; nulls count as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if len(col) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type)
                            else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(off, kind, len(col) + 1, col.offset * np.dtype(kind).itemsize)
    offsets = offsets.astype(np.int64)
    if data is None:
        return np.empty(0, np.uint8), offsets - offsets[0]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]
    return raw, offsets - offsets[0]


def blocks(col, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive row ranges of at most ``limit`` text bytes (or one longer row):
    (first row, end row, bytes, offsets from 0)."""
    raw, off = utf8(col)
    n, a = len(off) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
        b = min(b, n)
        yield a, b, raw[off[a]:off[b]], off[a:b + 1] - off[a]
        a = b


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply), wrapping."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_PINV = np.uint64(pow(int(_P), -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def _series(size: int, base: np.uint64) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse; those of two blocks are kept."""
    if n > 2 * BLOCK_BYTES + 1:
        return _series(n, _P), _series(n, _PINV)
    if not _POWERS:
        _POWERS["p"], _POWERS["i"] = (_series(2 * BLOCK_BYTES + 1, x) for x in (_P, _PINV))
    return _POWERS["p"], _POWERS["i"]


def word_spans(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document index) of every word of a block."""
    if not len(raw):
        return (np.empty(0, np.int64),) * 3
    text = ~IS_SPACE[raw]
    first = np.zeros(len(raw) + 1, bool)
    first[off] = True
    starts = text.copy()
    starts[1:] &= ~text[:-1] | first[1:-1]
    ends = text.copy()
    ends[:-1] &= ~text[1:] | first[1:-1]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return s, e, np.searchsorted(off, s, "right") - 1


def word_hashes(raw: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span, from one running polynomial over the block. A longer text
    is hashed in pieces, if its spans come in ascending order: a span's hash doesn't depend on
    where it lies."""
    if not len(s):
        return np.empty(0, np.uint64)
    if len(raw) > 2 * BLOCK_BYTES and (s[1:] >= s[:-1]).all():
        cuts = np.searchsorted(s, np.arange(0, len(raw) + BLOCK_BYTES, BLOCK_BYTES)).tolist()
        out = np.empty(len(s), np.uint64)
        for a, b in zip(cuts, cuts[1:]):
            if a < b:
                out[a:b] = _span_hashes(raw[s[a]:e[a:b].max()], s[a:b] - s[a], e[a:b] - s[a])
        return out
    return _span_hashes(raw, s, e)


def _span_hashes(raw: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    p, inv = _powers(len(raw) + 1)
    run = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * p[:len(raw)], out=run[1:])
    h = (run[e] - run[s]) * inv[s]
    return mix64(h + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def ngram_hashes(words: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of its first word) of every run of ``n`` words within one document."""
    m = len(words) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    at = np.flatnonzero(doc[:m] == doc[n - 1:])
    h = np.zeros(len(at), np.uint64)
    for j in range(n):
        h = mix64(h * np.uint64(0xFF51AFD7ED558CCD) + words[at + j])
    return h, at


#: Slots of the id filter below: 2 MB whatever the table.
FILTER_SLOTS = 1 << 24


def _slot(col) -> F.Column:
    return F.pmod(F.xxhash64(col), F.lit(FILTER_SLOTS)).cast("int")


def id_filter(ids: DataFrame, key: str) -> np.ndarray:
    """A fixed-size bitmap of the hashed ids of a table: a test against it has false positives
    but no false negatives."""
    return slot_filter(ids.select(_slot(F.col(key)).alias("slot")))


def slot_filter(slots: DataFrame) -> np.ndarray:
    """The bitmap of a table's ``slot`` column. Spark ors 64 slots into a word, so at most 2**18
    rows come here."""
    words = (slots.distinct().groupBy((F.col("slot") / 64).cast("int").alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, slot % 64)")).alias("bits")).toArrow())
    out = np.zeros(FILTER_SLOTS // 64, np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out


def has_slot(bits: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return (bits[slot >> 6] >> (slot & 63)) & 1 == 1


def maybe_in(rows: DataFrame, bits: np.ndarray, key: str, keep: bool = True) -> DataFrame:
    """Rows whose key may be among the filter's ids (``keep``), or that surely aren't."""
    shared = rows.sparkSession.sparkContext.broadcast(bits)
    names = rows.columns

    def run(batches):
        for batch in batches:
            hit = has_slot(shared.value, batch.column(len(names)).to_numpy())
            yield batch.filter(pa.array(hit == keep)).select(range(len(names)))
    return map_arrow(rows.withColumn(free_name(names, "slot"), _slot(F.col(key))), run, rows.schema)


def row_key() -> F.Column:
    """A key of a row's id and text, so that rows without an id or with a repeated one can be
    told apart by what they hold."""
    return F.xxhash64("doc_id", "text")


def without_rows(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """``docs``, all columns, without the rows whose row_key() is in ``keys`` (key). Only
    rows that the id filter can't clear are shuffled. Columns of ``docs`` may have any name."""
    names = docs.columns
    name = free_name(names, "row_key")
    keys = materialize(keys.select(F.col("key").alias(name)).distinct(), "keys")
    bits = id_filter(keys, name)
    keyed = docs.withColumn(name, row_key())
    return (maybe_in(keyed, bits, name, keep=False).select(*names)
            .unionByName(maybe_in(keyed, bits, name).join(keys, name, "left_anti").select(*names)))


def semi_join_text(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Join texts with a narrow table on doc_id: rows that the id filter rules out aren't
    shuffled; the join itself is exact. ``ids`` holds one row an id."""
    ids = materialize(ids, "ids")
    return maybe_in(docs, id_filter(ids, "doc_id"), "doc_id").join(ids, "doc_id")
