"""Tracked schemas: versioned storage, add-only evolution, type inference over text, and
alignment of a DataFrame to the tracked schema with a rescued-data column."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config
from ..sources import storage

_HISTORY_SCHEMA = "version INT, batch_id BIGINT, schema_json STRING"
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMERIC = _INTEGRAL + (T.FloatType, T.DoubleType, T.DecimalType)
_COMPLEX = (T.StructType, T.ArrayType, T.MapType, T.VariantType)
#: Lower-case names of our own columns: a source column of such a name is rescued.
RESERVED = frozenset(n.lower() for n in (config.RESCUED_COLUMN, config.BATCH_COLUMN, config.FILE_COLUMN,
                                         *config.LINEAGE_COLUMNS))


class SchemaStore:
    """Versioned schema history of one collection: one small JSON-lines file per version
    (``v00001.json`` …) below the collection's schema location, written to a temporary
    name and moved into place. One writer per collection (its stream), so the cached
    latest value stays valid. ``history()`` reads the folder as a DataFrame."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._cache: tuple[int, T.StructType | None] | None = None

    def _load(self) -> tuple[int, T.StructType | None]:
        versions = [int(n[1:-5]) for n in storage.names(self.spark, self.path)
                    if n.startswith("v") and n.endswith(".json") and n[1:-5].isdigit()]
        if not versions:
            return 0, None
        row = json.loads(storage.read_text(self.spark, self._file(max(versions))).strip())
        return int(row["version"]), T.StructType.fromJson(json.loads(row["schema_json"]))

    def _file(self, version: int) -> str:
        return f"{self.path}/v{version:05d}.json"

    def latest(self) -> T.StructType | None:
        if self._cache is None:
            self._cache = self._load()
        return self._cache[1]

    def version(self) -> int:
        if self._cache is None:
            self._cache = self._load()
        return self._cache[0]

    def save(self, schema: T.StructType, batch_id: int) -> int:
        v = self.version() + 1
        line = json.dumps({"version": v, "batch_id": int(batch_id), "schema_json": schema.json()})
        storage.write(self.spark, self._file(v), (line + "\n").encode("utf-8"))
        self._cache = (v, schema)
        return v

    def history(self) -> DataFrame:
        return self.spark.read.schema(_HISTORY_SCHEMA).json(self.path)


def spark_type_from_arrow(t) -> T.DataType | None:
    """Spark type of a Parquet column as Spark's reader infers it, for a conservative set
    of Arrow types; None when not covered (the caller lets Spark infer)."""
    import pyarrow as pa
    import pyarrow.types as at

    simple = [(at.is_boolean, T.BooleanType), (at.is_int8, T.ByteType), (at.is_int16, T.ShortType),
              (at.is_int32, T.IntegerType), (at.is_int64, T.LongType), (at.is_float32, T.FloatType),
              (at.is_float64, T.DoubleType), (at.is_date32, T.DateType)]
    for test, cls in simple:
        if test(t):
            return cls()
    if at.is_string(t) or at.is_large_string(t):
        return T.StringType()
    if at.is_binary(t) or at.is_large_binary(t):
        return T.BinaryType()
    if at.is_timestamp(t) and t.unit in ("ms", "us"):
        return T.TimestampType() if t.tz is not None else T.TimestampNTZType()
    if at.is_decimal(t) and t.precision <= 38:
        return T.DecimalType(t.precision, t.scale)
    if isinstance(t, pa.ListType):
        inner = spark_type_from_arrow(t.value_type)
        return None if inner is None else T.ArrayType(inner, True)
    if isinstance(t, pa.StructType):
        fields = []
        for i in range(t.num_fields):
            f = t.field(i)
            ft = spark_type_from_arrow(f.type)
            if ft is None:
                return None
            fields.append(T.StructField(f.name, ft, True))
        return T.StructType(fields)
    return None


def spark_schema_from_arrow(schema) -> T.StructType | None:
    fields = []
    for f in schema:
        t = spark_type_from_arrow(f.type)
        if t is None:
            return None
        fields.append(T.StructField(f.name, t, True))
    return T.StructType(fields)


def widen(a: T.DataType, b: T.DataType) -> T.DataType:
    """Common type of two observations of one new column."""
    if a == b:
        return a
    if isinstance(a, _INTEGRAL) and isinstance(b, _INTEGRAL):
        return T.LongType()
    if isinstance(a, _NUMERIC) and isinstance(b, _NUMERIC):
        return T.DoubleType()
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    return T.StringType()


def merge_nested(tracked_t: T.DataType, seen: T.DataType) -> T.DataType:
    """Add sub-fields never seen before to a struct (or array of structs), recursively;
    every existing (sub-)field keeps its type."""
    if isinstance(tracked_t, T.StructType) and isinstance(seen, T.StructType):
        by = {f.name.lower(): f for f in seen.fields}
        out = []
        for f in tracked_t.fields:
            s = by.pop(f.name.lower(), None)
            out.append(T.StructField(f.name, merge_nested(f.dataType, s.dataType) if s else f.dataType, True))
        for f in seen.fields:
            if f.name.lower() in by:
                out.append(T.StructField(f.name, f.dataType, True))
        return T.StructType(out)
    if isinstance(tracked_t, T.ArrayType) and isinstance(seen, T.ArrayType):
        return T.ArrayType(merge_nested(tracked_t.elementType, seen.elementType), True)
    return tracked_t


def evolve(tracked: T.StructType | None, observed: list[T.StructType]) -> T.StructType:
    """Add columns (and struct sub-fields) never seen before, in order of first
    appearance; never change a type."""
    fields = list(tracked.fields) if tracked is not None else []
    known = {f.name.lower() for f in fields}
    pos = {f.name.lower(): i for i, f in enumerate(fields)}
    new: dict[str, T.DataType] = {}
    lower_to_name: dict[str, str] = {}
    for s in observed:
        for f in s.fields:
            key = f.name.lower()
            if key in known:
                i = pos[key]
                fields[i] = T.StructField(fields[i].name, merge_nested(fields[i].dataType, f.dataType), True)
                continue
            if key in RESERVED:
                continue
            if key in lower_to_name:
                name = lower_to_name[key]
                new[name] = widen(new[name], f.dataType)
            else:
                lower_to_name[key] = f.name
                new[f.name] = f.dataType
    out = fields + [T.StructField(n, T.StringType() if isinstance(t, T.NullType) else t, True)
                    for n, t in new.items()]
    return T.StructType(out)


_ISO_TS = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})?$"


#: What a text value parses as, narrowest first; a column's type is the first that all its values do.
_TEXT_TYPES = (T.LongType(), T.DoubleType(), T.BooleanType(), T.TimestampType())


def text_type_bits(c: Column) -> Column:
    """The aggregate that folds a text column's values into one number: bit i is set when every
    value present parses as ``_TEXT_TYPES[i]``; NULL when no value is present. Folds of parts
    of the rows are put together by ``&``, so that it may be observed on a write."""
    parses = (c.rlike(r"^\s*[+-]?[0-9]+\s*$") & c.try_cast("bigint").isNotNull(),
              c.try_cast("double").isNotNull(),
              F.lower(F.trim(c)).isin("true", "false"),
              c.rlike(_ISO_TS) & c.try_cast("timestamp").isNotNull())
    bits = sum((F.when(p, 1 << i).otherwise(0) for i, p in enumerate(parses)), F.lit(0))
    return F.bit_and(F.when(c.isNotNull(), bits))


def text_type_of(bits: int | None) -> T.DataType:
    """The type that ``text_type_bits`` leaves for a column."""
    return next((t for i, t in enumerate(_TEXT_TYPES) if bits and bits >> i & 1), T.StringType())


def infer_text_types(df: DataFrame, columns: list[str]) -> dict[str, T.DataType]:
    """Narrowest of bigint, double, boolean, timestamp (ISO 8601 date-time text only),
    string that every non-null value of a text column parses as. One aggregation pass,
    one result row."""
    if not columns:
        return {}
    row = df.agg(*[text_type_bits(quoted(c)).alias(f"t{i}") for i, c in enumerate(columns)]).first()
    return {c: text_type_of(row[f"t{i}"]) for i, c in enumerate(columns)}


def nested_fits(src: T.DataType, tgt: T.DataType) -> bool:
    """Every source (sub-)field exists in the target with the same type; target structs
    may have extra sub-fields."""
    if src == tgt:
        return True
    if isinstance(src, T.StructType) and isinstance(tgt, T.StructType):
        want = {f.name.lower(): f for f in tgt.fields}
        return all(f.name.lower() in want and nested_fits(f.dataType, want[f.name.lower()].dataType)
                   for f in src.fields)
    if isinstance(src, T.ArrayType) and isinstance(tgt, T.ArrayType):
        return nested_fits(src.elementType, tgt.elementType)
    return False


def fit_nested(c: Column, src: T.DataType, tgt: T.DataType) -> Column | None:
    """``c`` (of type ``src``) reshaped to ``tgt`` — missing struct sub-fields NULL — or
    None when it does not fit (the caller rescues the whole value)."""
    if not nested_fits(src, tgt):
        return None
    return _reshape(c, src, tgt)


def _reshape(c: Column, src: T.DataType, tgt: T.DataType) -> Column:
    if src == tgt:
        return c
    if isinstance(src, T.StructType):
        have = {f.name.lower(): f for f in src.fields}
        parts = []
        for f in tgt.fields:
            s = have.get(f.name.lower())
            parts.append(F.lit(None).cast(f.dataType).alias(f.name) if s is None
                         else _reshape(c.getField(s.name), s.dataType, f.dataType).alias(f.name))
        return F.when(c.isNull(), F.lit(None).cast(tgt)).otherwise(F.struct(*parts))
    return F.transform(c, lambda x: _reshape(x, src.elementType, tgt.elementType))


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


_FAMILY = ((T.BooleanType, "boolean"), (_NUMERIC, "number"), ((T.StringType, T.VarcharType, T.CharType), "text"),
           (T.BinaryType, "binary"), (T.DateType, "date"), ((T.TimestampType, T.TimestampNTZType), "time"))
#: Families between which try_cast is defined; all others are rescued as a whole.
_CASTABLE = {("boolean", "number"), ("number", "boolean"), ("number", "time"), ("time", "number"), ("text", "boolean"),
             ("text", "number"), ("text", "date"), ("text", "time"), ("text", "binary"), ("boolean", "text"),
             ("number", "text"), ("date", "text"), ("time", "text"), ("binary", "text"), ("date", "time"), ("time", "date")}


def family(t: T.DataType) -> str | None:
    return next((name for kinds, name in _FAMILY if isinstance(t, kinds)), None)


def castable(src: T.DataType, tgt: T.DataType) -> bool:
    """Whether Spark defines try_cast from one atomic type to the other."""
    a, b = family(src), family(tgt)
    if a is None or b is None:
        return src == tgt
    if "time" in (a, b) and "number" in (a, b):  # only instants count seconds, and not every number type
        other = src if a == "number" else tgt
        instant = tgt if a == "number" else src
        return isinstance(instant, T.TimestampType) and isinstance(other, (T.LongType, T.IntegerType, T.DoubleType, T.FloatType))
    return a == b or (a, b) in _CASTABLE


def rescuable(c: Column, t: T.DataType) -> Column:
    """A value as the rescue JSON takes it: types JSON has no form for become text."""
    if isinstance(t, T.BinaryType):
        return F.base64(c)
    if isinstance(t, (T.NullType, T.CalendarIntervalType, T.DayTimeIntervalType, T.YearMonthIntervalType)):
        return c.cast("string")
    return c


def align_and_rescue(df: DataFrame, tracked: T.StructType, text_source: bool = False,
                     keep: tuple[str, ...] = (config.FILE_COLUMN,),
                     rescue_col: str = config.RESCUED_COLUMN) -> DataFrame:
    """Project ``df`` onto ``tracked``: same type -> as is; other atomic type -> try_cast,
    and a value that does not convert (text that does not parse, or a non-text value that
    does not round-trip) becomes NULL and is kept in ``rescue_col`` as JSON; a complex-type
    clash is rescued whole; tracked columns absent from ``df`` are NULL; columns of ``df``
    not in ``tracked`` go to ``rescue_col``. ``rescue_col`` is NULL when nothing was kept."""
    src = {f.name.lower(): f for f in df.schema.fields}
    used = set()
    cols, rescued = [], []
    for f in tracked.fields:
        s = src.get(f.name.lower())
        if s is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        used.add(s.name.lower())
        c = quoted(s.name)
        if s.dataType == f.dataType:
            cols.append(c.alias(f.name))
            continue
        if isinstance(s.dataType, _COMPLEX) or isinstance(f.dataType, _COMPLEX):
            fitted = fit_nested(c, s.dataType, f.dataType)
            if fitted is not None:
                cols.append(fitted.alias(f.name))
            else:
                cols.append(F.lit(None).cast(f.dataType).alias(f.name))
                rescued.append(rescuable(c, s.dataType).alias(s.name))
            continue
        if not castable(s.dataType, f.dataType):
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            rescued.append(rescuable(c, s.dataType).alias(s.name))
            continue
        tc = c.try_cast(f.dataType)
        if text_source or isinstance(s.dataType, T.StringType):
            fits = c.isNull() | tc.isNotNull()
        else:
            back = tc.try_cast(s.dataType) if castable(f.dataType, s.dataType) else F.lit(None).cast(s.dataType)
            fits = c.isNull() | F.coalesce(tc.isNotNull() & (back == c), F.lit(False))
        cols.append(F.when(fits, tc).alias(f.name))
        rescued.append(F.when(~fits, rescuable(c, s.dataType)).alias(s.name))
    for f in df.schema.fields:
        if f.name.lower() in used or f.name in keep:
            continue
        rescued.append(rescuable(quoted(f.name), f.dataType).alias(f.name))
    if rescued:
        rescue = F.nullif(F.to_json(F.struct(*rescued)), F.lit("{}"))
    else:
        rescue = F.lit(None).cast("string")
    kept = [quoted(k) for k in keep if k in df.columns]
    return df.select(*cols, rescue.alias(rescue_col), *kept)


def raw_schema(tracked: T.StructType) -> T.StructType:
    """Columns of a raw dataset: tracked columns + rescued data + lineage."""
    extra = [T.StructField(config.RESCUED_COLUMN, T.StringType(), True),
             T.StructField("_ingested_at", T.TimestampType(), True),
             T.StructField("_source_file", T.StringType(), True),
             T.StructField("_file_epoch_ms", T.LongType(), True)]
    return T.StructType(list(tracked.fields) + extra)
