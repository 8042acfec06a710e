"""Incremental ingestion of one collection into its append-only raw dataset.

Open-source Spark has no self-tracking, schema-evolving file stream, and a plain file
stream silently drops columns it does not know. So the stream is a *metadata* stream — the
planned batches of :mod:`.filestate`, each a list of at most the tier's file cap — and each
micro-batch runs in ``foreachBatch``:

1. probe every file of the batch in parallel (Parquet footer / CSV header line; a
   ``mapInPandas`` over the paths, no data read) and group files by that signature;
2. read each group with Spark (Parquet files whose shared columns agree in type are one
   group; CSV bound by the names of its header);
3. evolve the tracked schema (add columns only, never change a type) unless frozen; the type of
   a new CSV column is guessed by a few rows, folded over all rows by the write of step 5, and
   the folder written again where the guess was wrong, so no batch is kept in memory;
4. align every group to the tracked schema; values that do not fit and untracked
   columns go to ``_rescued_data`` as JSON;
5. add lineage columns and overwrite the batch's own folder, so a replay after a crash
   rewrites the same rows; rows, rescued rows and malformed lines are observed on the way;
6. save the evolved schema, then the batch's file manifest: that is its commit. Readers see
   the batches that have one, and a replayed batch that has one is not written again.

Nothing is shuffled: a batch's files are what its scan makes of them. :func:`compact` puts
small batches together afterwards.

The file list of a batch is bounded by ``maxFilesPerTrigger`` (the tier's file cap); it is
the only thing that reaches the driver, as with Spark's own file source."""

from __future__ import annotations

import csv
import gzip
import hashlib
import json
import re
import time
import uuid
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import config
from ..functions import names as N
from ..functions import schema as S
from ..session import ship_package
from ..sources import storage
from ..sources.landing import escape_glob, source_glob
from .filestate import batch_stream, plan_files



@dataclass(frozen=True)
class CollectionSpec:
    """One resolved collection."""
    collection: str
    name: str
    fmt: str
    tier: str = "high"
    max_files: int = config.TIER_PARAMS["high"][0]
    interval_seconds: int = config.TIER_PARAMS["high"][1]


@dataclass(frozen=True)
class Layout:
    """Where a run reads from and writes to."""
    source_root: str
    database: str
    raw_root: str
    checkpoint_root: str
    prefix: str = ""
    gz: bool = False

    def raw_path(self, name: str) -> str:
        return f"{self.raw_root.rstrip('/')}/{self.prefix}raw_{name}"

    def checkpoint_path(self, name: str) -> str:
        return f"{self.checkpoint_root.rstrip('/')}/{self.prefix}raw/{name}"

    def files_path(self, name: str) -> str:
        return f"{self.checkpoint_root.rstrip('/')}/{self.prefix}files/{name}"

    def schema_path(self, name: str) -> str:
        return f"{self.checkpoint_root.rstrip('/')}/{self.prefix}schemas/{name}"

    @property
    def plan_root(self) -> str:
        return f"{self.checkpoint_root.rstrip('/')}/{self.prefix}plan"

    def plan_path(self, name: str) -> str:
        return f"{self.plan_root}/name={name}"

    def compact_path(self, name: str) -> str:
        return f"{self.checkpoint_root.rstrip('/')}/{self.prefix}compact/{name}"

    def glob(self, spec: CollectionSpec) -> str:
        return source_glob(self.source_root, self.database, spec.collection, spec.fmt, gz=self.gz)


# ----------------------------------------------------------------------------------------
# per-file probe (runs in Python workers; small helper, no data read)
# ----------------------------------------------------------------------------------------

def _signature_of_stream(stream, path: str, fmt: str) -> str:
    """Parquet: the physical schema from the footer; CSV: the header line."""
    if fmt == "parquet":
        import base64

        import pyarrow.parquet as pq

        schema = pq.read_schema(stream).remove_metadata()
        return "parquet:" + base64.b64encode(schema.serialize().to_pybytes()).decode("ascii")
    src = gzip.GzipFile(fileobj=stream) if path.lower().endswith(".gz") else stream
    buf = b""
    while b"\n" not in buf:             # the whole first line, however long
        chunk = src.read(1 << 16)
        if not chunk:
            break
        buf += chunk
    head = buf.split(b"\n", 1)[0].rstrip(b"\r")
    return "csv:" + head.decode("utf-8", errors="replace").lstrip("\ufeff")


def _file_signature(path: str, fmt: str) -> str | None:
    """Signature read through Arrow's file systems (footer / first line only); None when
    Arrow cannot open the scheme, so the caller falls back to Spark's reader."""
    from ..sources.landing_writer import resolve_fs

    try:
        fs, p, _ = resolve_fs(path)
        if fmt == "parquet":
            f = fs.open_input_file(p)
        else:  # raw bytes; gzip is handled once, by the caller
            f = fs.open_input_stream(p, compression=None)
    except Exception:
        return None
    with f:
        return _signature_of_stream(f, p, fmt)


def _probe_partition(fmt: str):
    def probe(batches):
        for pdf in batches:
            yield pd.DataFrame({"path": pdf["path"],
                                "signature": [_file_signature(p, fmt) for p in pdf["path"]]})
    return probe


def probe_groups(files: DataFrame, fmt: str) -> list[tuple[str, list[str]]]:
    """[(signature, sorted paths)] for the files of one micro-batch. Where Arrow can't open a
    scheme, the footer or first line is read through Spark's own file system; no file's
    body is read either way."""
    schema = "path string, signature string"
    sig = files.select("path").mapInPandas(_probe_partition(fmt), schema)
    rows = (sig.groupBy("signature").agg(F.sort_array(F.collect_list("path")).alias("paths"))
            .orderBy("signature").collect())
    groups = {r.signature: list(r.paths) for r in rows if r.signature is not None}
    for path in (p for r in rows if r.signature is None for p in r.paths):
        groups.setdefault(_spark_signature(files.sparkSession, path, fmt), []).append(path)
    return sorted((s, sorted(p)) for s, p in groups.items())


def _spark_signature(spark: SparkSession, path: str, fmt: str) -> str:
    if fmt == "parquet":
        return "spark:" + spark.read.parquet(*_glob_safe([path])).schema.json()
    return "csv:" + storage.first_line(spark, path).lstrip("\ufeff")


def merge_groups(groups: list[tuple[str, list[str]]]) -> list[tuple[T.StructType | None, list[str]]]:
    """Parquet groups joined where their schemas agree on the type of every column they share:
    such files read as one under the union of their columns (a column that a file lacks is
    NULL), so optional columns don't multiply the reads. A group whose schema only Spark can
    tell stays alone (None)."""
    out: list[tuple[T.StructType | None, list[str]]] = []
    for sig, paths in groups:
        schema = parquet_schema(sig)
        if schema is None:
            out.append((None, list(paths)))
            continue
        mine = {f.name.lower(): f for f in schema.fields}
        for i, (other, more) in enumerate(out):
            if other is None or len(mine) != len(schema.fields):
                continue
            theirs = {f.name.lower(): f.dataType for f in other.fields}
            if all(theirs.get(n, f.dataType) == f.dataType for n, f in mine.items()):
                joined = T.StructType(other.fields + [f for n, f in mine.items() if n not in theirs])
                out[i] = (joined, more + list(paths))
                break
        else:
            out.append((schema, list(paths)))
    return out


# ----------------------------------------------------------------------------------------
# batch processing
# ----------------------------------------------------------------------------------------

def _glob_safe(paths: list[str]) -> list[str]:
    return [escape_glob(p) for p in paths]


CORRUPT_COLUMN = "_corrupt_record"
#: Rows of one file a header that a new column's type is first guessed by; all rows are looked at in the write.
GUESS_ROWS = 1000


def parquet_schema(signature: str | None) -> T.StructType | None:
    """Spark schema of a Parquet signature group (from the probed footer), so reading the
    group needs no schema-inference job; None -> let Spark infer."""
    if signature and signature.startswith("spark:"):
        return T.StructType.fromJson(json.loads(signature[len("spark:"):]))
    if not signature or not signature.startswith("parquet:"):
        return None
    import base64

    import pyarrow as pa

    try:
        arrow = pa.ipc.read_schema(pa.py_buffer(base64.b64decode(signature[len("parquet:"):])))
    except Exception:
        return None
    return S.spark_schema_from_arrow(arrow)


def header_names(signature: str) -> list[str]:
    """Column names of a CSV header line (RFC 4180 quoting); empty -> _c<i>,
    repeated -> name<i>."""
    line = signature[len("csv:"):]
    fields = next(csv.reader([line]), []) if line else []
    out: list[str] = []
    seen: set[str] = set()
    for i, name in enumerate(fields):
        name = name if name else f"_c{i}"
        if name.lower() in seen:
            name = f"{name}{i}"
        seen.add(name.lower())
        out.append(name)
    return out


def read_group(spark: SparkSession, fmt: str, paths: list[str], signature: str | None = None,
               known: T.StructType | None = None) -> DataFrame:
    """Read files that share one physical schema (Parquet) or one header (CSV: bound by
    the group's own header, all columns as text; a line whose field count does not match
    keeps its raw text in ``_corrupt_record``), with the source file of every row."""
    if fmt == "parquet":
        known = known or parquet_schema(signature)
        reader = spark.read.schema(known) if known is not None else spark.read
        df = reader.parquet(*_glob_safe(paths))
    else:
        names = header_names(signature or "csv:")
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names] +
                              [T.StructField(CORRUPT_COLUMN, T.StringType())])
        df = (spark.read.schema(schema).option("header", True).option("escape", '"')
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
              .csv(_glob_safe(paths)))
    return df.withColumn(config.FILE_COLUMN, F.col("_metadata.file_path"))


def evolve_for_batch(frames: list[DataFrame], fmt: str, tracked: T.StructType | None,
                     evolve: bool, types: dict[str, T.DataType] | None = None) -> T.StructType:
    """Tracked schema after this batch (unchanged when frozen and already known). ``types``: those
    of the new columns of a CSV batch, by name."""
    if tracked is not None and not evolve:
        return tracked
    if fmt == "parquet":
        observed = [T.StructType([f for f in fr.schema.fields if f.name != config.FILE_COLUMN])
                    for fr in frames]
        return S.evolve(tracked, observed)
    return S.evolve(tracked, [T.StructType([T.StructField(c, t) for c, t in (types or {}).items()])])


def new_text_columns(frames: list[DataFrame], tracked: T.StructType | None) -> list[str]:
    """Columns of a CSV batch that aren't tracked yet, in order of appearance; names that differ by
    case only are one column, under the name that came first."""
    skip = S.RESERVED | {CORRUPT_COLUMN} | ({f.name.lower() for f in tracked.fields} if tracked is not None else set())
    found: dict[str, str] = {}
    for c in (c for fr in frames for c in fr.columns):
        if c.lower() not in skip:
            found.setdefault(c.lower(), c)
    return list(found.values())


def _text_bits(fr: DataFrame, new: list[str]) -> dict[str, Column]:
    """Column name -> the fold of its type, for the new columns that ``fr`` has."""
    mine = {c.lower(): c for c in fr.columns}
    return {c: S.text_type_bits(S.quoted(mine[c.lower()])) for c in new if c.lower() in mine}


def guess_text_types(heads: list[DataFrame], new: list[str]) -> dict[str, T.DataType]:
    """Types of new columns by the first rows of one file a header: what the write begins with.
    The write itself tells the types of all rows (``BatchHandler``)."""
    folds = []
    for fr in heads:
        bits = _text_bits(fr, new)
        if bits:
            folds.append(fr.limit(GUESS_ROWS).agg(F.map_from_arrays(
                F.array(*map(F.lit, bits)), F.array(*bits.values())).alias("bits")))
    rows = reduce(DataFrame.unionByName, folds).collect() if folds else []
    return _types_of([r.bits for r in rows], new)


def _types_of(parts: list[dict[str, int | None]], new: list[str]) -> dict[str, T.DataType]:
    """Types by the folds of several parts; a part without a value of a column says nothing."""
    seen = {c: [p[c] for p in parts if p.get(c) is not None] for c in new}
    return {c: S.text_type_of(reduce(lambda x, y: x & y, bits) if bits else None) for c, bits in seen.items()}


def finish(df: DataFrame, tracked: T.StructType) -> DataFrame:
    """Lineage columns and final column order of a raw dataset."""
    return df.select(*[S.quoted(f.name) for f in tracked.fields], config.RESCUED_COLUMN,
                     F.current_timestamp().alias("_ingested_at"), F.col(config.FILE_COLUMN).alias("_source_file"),
                     N.file_epoch_ms(config.FILE_COLUMN).alias("_file_epoch_ms"))


class BatchHandler:
    """``foreachBatch`` callback of one collection."""

    def __init__(self, spec: CollectionSpec, layout: Layout, evolve: bool = True):
        self.spec = spec
        self.layout = layout
        self.evolve = evolve
        self.store: S.SchemaStore | None = None
        self.files_seen = 0
        self.batches = 0
        self.progress: list[tuple] = []
        self.phase_seconds: dict[str, float] = {}

    def _tick(self, phase: str, t0: float) -> float:
        now = time.perf_counter()
        self.phase_seconds[phase] = self.phase_seconds.get(phase, 0.0) + now - t0
        return now

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        began = t = time.perf_counter()
        if self.store is None:
            self.store = S.SchemaStore(spark, self.layout.schema_path(self.spec.name))
        if storage.exists(spark, manifest_path(self.layout.files_path(self.spec.name), batch_id)):
            return  # replayed after its commit
        tracked = self.store.latest()
        t = self._tick("schema_load", t)
        groups = probe_groups(batch, self.spec.fmt)
        t = self._tick("probe", t)
        if not groups:
            return
        if self.spec.fmt == "parquet":
            frames = [read_group(spark, "parquet", paths, known=schema) for schema, paths in merge_groups(groups)]
        else:
            frames = [read_group(spark, "csv", paths, sig) for sig, paths in groups]
        t = self._tick("read_plan", t)
        new = (new_text_columns(frames, tracked)
               if self.spec.fmt == "csv" and (self.evolve or tracked is None) else [])
        types = guess_text_types([read_group(spark, "csv", paths[:1], sig) for sig, paths in groups], new) if new else {}
        t = self._tick("evolve", t)
        while True:
            new_tracked = evolve_for_batch(frames, self.spec.fmt, tracked, self.evolve, types)
            counted, exact = self._write(frames, new_tracked, new, batch_id)
            if exact == types:
                break
            types = exact  # a later row is of another type than the first ones: the folder is written anew
        t = self._tick("write", t)
        paths = [p for _s, group in groups for p in group]
        if tracked is None or new_tracked != tracked:
            self.store.save(new_tracked, batch_id)
        write_file_manifest(spark, self.layout.files_path(self.spec.name), batch_id, paths)
        self._tick("schema_save", t)
        self.files_seen += len(paths)
        self.batches += 1
        self.progress.append((int(batch_id), len(paths), int(1000 * (time.perf_counter() - began)),
                              counted["rows"], counted["rescued"], counted["malformed"]))


    def _write(self, frames: list[DataFrame], tracked: T.StructType, new: list[str],
               batch_id: int) -> tuple[dict, dict[str, T.DataType]]:
        """Write the batch's own folder, as a whole (a replay rewrites it). Returns what the same pass
        observed: rows, rescued rows and malformed lines, and the types of the ``new`` text columns."""
        folds: list[Observation] = []
        aligned = []
        for fr in frames:
            bits = _text_bits(fr, new)
            if bits:
                folds.append(Observation())
                fr = fr.observe(folds[-1], *[b.alias(c) for c, b in bits.items()])
            aligned.append(S.align_and_rescue(fr, tracked, text_source=self.spec.fmt == "csv"))
        seen = Observation()
        out = finish(reduce(lambda a, b: a.unionByName(b), aligned), tracked).observe(
            seen, F.count(F.lit(1)).alias("rows"), F.count(config.RESCUED_COLUMN).alias("rescued"),
            F.count_if(F.get_json_object(config.RESCUED_COLUMN, f"$.{CORRUPT_COLUMN}").isNotNull()).alias("malformed"))
        out.write.mode("overwrite").parquet(batch_folder(self.layout, self.spec.name, batch_id))
        return seen.get, _types_of([f.get for f in folds], new)


def batch_folder(layout: Layout, name: str, batch_id: int | str) -> str:
    return f"{layout.raw_path(name)}/{config.BATCH_COLUMN}={batch_id}"


def query_name(prefix: str, layout: Layout, name: str) -> str:
    tag = hashlib.sha1(layout.checkpoint_root.encode()).hexdigest()[:8]
    return f"{prefix}_{name}_{tag}"


def start_ingest(spark: SparkSession, spec: CollectionSpec, layout: Layout,
                 trigger: str = "availableNow", evolve: bool = True,
                 handler: BatchHandler | None = None, plan: bool = True) -> StreamingQuery:
    """Start the stream of one collection. ``trigger``: 'availableNow' (bounded drain) or
    'continuous' (micro-batch every tier interval; files that land later come in as a
    ``filestate.start_planner`` of the run plans them). ``plan``: plan its new files first."""
    ship_package(spark)
    if plan:
        plan_files(spark, layout, [spec])
    handler = handler or BatchHandler(spec, layout, evolve)
    writer = (batch_stream(spark, layout, spec.name).writeStream
              .queryName(query_name("raw", layout, spec.name))
              .option("checkpointLocation", layout.checkpoint_path(spec.name))
              .foreachBatch(handler))
    if trigger == "continuous":
        writer = writer.trigger(processingTime=f"{int(spec.interval_seconds)} seconds")
    else:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def ingest_available(spark: SparkSession, spec: CollectionSpec, layout: Layout,
                     evolve: bool = True) -> BatchHandler:
    """Bounded drain of one collection; returns the handler with its counters."""
    handler = BatchHandler(spec, layout, evolve)
    q = start_ingest(spark, spec, layout, "availableNow", evolve, handler)
    q.awaitTermination()
    return handler


def tracked_schema(spark: SparkSession, layout: Layout, name: str) -> T.StructType | None:
    return S.SchemaStore(spark, layout.schema_path(name)).latest()


FILES_SCHEMA = "batch_id BIGINT, path STRING"


def manifest_path(folder: str, batch_id: int) -> str:
    return f"{folder}/batch-{int(batch_id):012d}.json"


def write_file_manifest(spark: SparkSession, folder: str, batch_id: int, paths: list[str]) -> None:
    """The files of one micro-batch (already on the driver, at most the tier's file cap) as
    one small JSON-lines file named after the batch id. Written through the file system that
    Spark uses for the folder, in one move: the batch's commit."""
    lines = "".join(json.dumps({"batch_id": int(batch_id), "path": p}) + "\n" for p in paths)
    storage.write(spark, manifest_path(folder, batch_id), lines.encode("utf-8"))


def committed_batches(spark: SparkSession, layout: Layout, name: str) -> list[int]:
    """The batches with a manifest: one small file each, so this list is of batches, not files."""
    found = (re.fullmatch(r"batch-(\d+)\.json", n) for n in storage.names(spark, layout.files_path(name)))
    return sorted(int(m[1]) for m in found if m)


def compactions(spark: SparkSession, layout: Layout, name: str) -> dict[str, list[int]]:
    """Folder suffix -> the batches that it holds, as of the last compaction."""
    versions = sorted(n for n in storage.names(spark, layout.compact_path(name)) if n.startswith("v"))
    return json.loads(storage.read_text(spark, f"{layout.compact_path(name)}/{versions[-1]}")) if versions else {}


def raw_folders(spark: SparkSession, layout: Layout, name: str) -> list[str]:
    """The folders whose files are the raw dataset now: of committed batches only, a compacted
    folder in place of the batches that it holds."""
    packed = compactions(spark, layout, name)
    within = {b for batches in packed.values() for b in batches}
    alone = [b for b in committed_batches(spark, layout, name) if b not in within]
    return [batch_folder(layout, name, x) for x in [*packed, *alone]]


def compact(spark: SparkSession, layout: Layout, name: str, target_bytes: int = config.COMPACT_BYTES) -> int:
    """Put consecutive small batches together into folders of about ``target_bytes``, and return
    how many batches were. Rows and columns stay as they are. The new folders count from the moment
    that the new version of the compaction list is in place; what they replace is no longer
    read, and is left for a clean-up once no reader of older versions runs."""
    packed = compactions(spark, layout, name)
    within = {b for batches in packed.values() for b in batches}
    bins: list[list[int]] = [[]]
    size = 0
    for batch in (b for b in committed_batches(spark, layout, name) if b not in within):
        own = storage.folder_bytes(spark, batch_folder(layout, name, batch))
        if bins[-1] and size + own > target_bytes:
            bins.append([])
            size = 0
        bins[-1].append(batch)
        size += own
    tracked = tracked_schema(spark, layout, name)
    new: dict[str, list[int]] = {}
    for batches in (b for b in bins if len(b) > 1):
        folder = f"{batches[0]}-{batches[-1]}-{uuid.uuid4().hex[:8]}"
        rows = spark.read.schema(S.raw_schema(tracked)).parquet(*[batch_folder(layout, name, b) for b in batches])
        rows.coalesce(1).write.parquet(batch_folder(layout, name, folder))  # one task reads about target_bytes
        new[folder] = batches
    if new:
        version = len(storage.names(spark, layout.compact_path(name)))
        storage.write(spark, f"{layout.compact_path(name)}/v{version:012d}.json", json.dumps(packed | new).encode())
    return sum(map(len, new.values()))


def ingested_files(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """(batch_id, path) of every file a collection's stream has written: a small table,
    so backlog questions never scan the raw data."""
    if not storage.exists(spark, layout.files_path(name)):
        return spark.createDataFrame([], FILES_SCHEMA)
    return (spark.read.schema(FILES_SCHEMA).option("recursiveFileLookup", "true")
            .json(layout.files_path(name)))


def read_raw(spark: SparkSession, layout: Layout, name: str) -> DataFrame | None:
    """Raw dataset with the latest tracked schema (older batches: new columns NULL), as of the
    batches that are committed now; a batch that is being written isn't seen.
    None when nothing was ingested yet; data that a commit promises but that isn't
    there or can't be read is an error."""
    tracked = tracked_schema(spark, layout, name)
    if tracked is None:
        return None
    schema = S.raw_schema(tracked)
    folders = raw_folders(spark, layout, name)
    if not folders:
        return None
    df = spark.read.schema(schema).parquet(*folders)
    return df.select(*[S.quoted(f.name) for f in schema.fields])
