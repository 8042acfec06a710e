"""Column expressions for names, paths, epochs and messages (all JVM-side built-ins)."""

from __future__ import annotations

import re
import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def collection_of(topic) -> Column:
    """Text after the first '.', or the topic unchanged when it has none."""
    t = _c(topic)
    pos = F.instr(t, ".")
    return F.when(pos > 0, t.substr(pos + 1, F.length(t))).otherwise(t)


def trim_topic(topic) -> Column:
    """Strip leading and trailing whitespace (any Unicode white space)."""
    return F.regexp_replace(_c(topic), r"(?U)^\s+|\s+$", "")


def table_name(collection) -> Column:
    """Table-name form: '-' and '.' become '_'."""
    return F.translate(_c(collection), "-.", "__")


def safe_name(collection) -> Column:
    """Measurement-name form: every char outside [A-Za-z0-9_] becomes '_'."""
    return F.regexp_replace(_c(collection), "[^A-Za-z0-9_]", "_")


def safe_name_text(collection: str) -> str:
    """The same of a plain string, for names of streams and folders."""
    return re.sub("[^A-Za-z0-9_]", "_", collection)


def file_epoch_ms(path) -> Column:
    """First 13-digit run followed by '_' after a '/', as bigint; NULL without a match."""
    return F.nullif(F.regexp_extract(_c(path), r"/(\d{13})_", 1), F.lit("")).try_cast("bigint")


def clean_message(msg, n: int | None = config.OUTCOME_MESSAGE_CHARS) -> Column:
    """Newlines to spaces, then the first ``n`` characters (None: all)."""
    whole = F.regexp_replace(_c(msg), "\n", " ")
    return whole if n is None else F.substring(whole, 1, n)


def failure_kind(text, extra_types=(), extra_classes=()) -> Column:
    """'schema_evolution' when the text names a known type (case-sensitive) or error class
    (on the upper-cased text); anything else is 'genuine'."""
    t = _c(text)
    cond = F.lit(False)
    for name in tuple(config.SCHEMA_EVOLUTION_TYPES) + tuple(extra_types):
        cond = cond | t.contains(name)
    up = F.upper(t)
    for name in tuple(config.SCHEMA_EVOLUTION_ERROR_CLASSES) + tuple(extra_classes):
        cond = cond | up.contains(name.upper())
    return F.when(t.isNull(), F.lit(None)).when(cond, "schema_evolution").otherwise("genuine")


def landing_file_name(epoch_ms, collection, day_idx, file_idx, ext) -> Column:
    """'%013d_<collection>_%02d_%02d.<ext>'."""
    return F.format_string("%013d_%s_%02d_%02d.%s", _c(epoch_ms), _c(collection),
                           _c(day_idx), _c(file_idx), _c(ext))


def day_partition_values(day) -> dict[str, Column]:
    """Zero-padded year / month / day text of a date column."""
    d = _c(day)
    return {"year": F.date_format(d, "yyyy"), "month": F.date_format(d, "MM"),
            "day_of_month": F.date_format(d, "dd")}


def midnight_epoch_ms(day) -> Column:
    """Epoch-ms of midnight UTC of a date (session time zone must be UTC)."""
    return F.unix_millis(F.to_timestamp(_c(day)))


def format_suffix(path, allow_gzip: bool) -> Column:
    """'parquet' / 'csv' / NULL from a file name. Strict form: exact lower-case suffix;
    lenient form: case-insensitive and with an optional '.gz'."""
    p = _c(path)
    if allow_gzip:
        low = F.lower(p)
        return (F.when(low.rlike(r"\.parquet(\.gz)?$"), "parquet")
                .when(low.rlike(r"\.csv(\.gz)?$"), "csv"))
    return F.when(p.endswith(".parquet"), "parquet").when(p.endswith(".csv"), "csv")


def run_token(pinned: str | None = None) -> str:
    """Run id: the caller's pinned token, or UTC timestamp + 8 hex characters."""
    if pinned:
        return pinned
    return datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%SZ") + "_" + uuid.uuid4().hex[:8]


def total_wall(start, drain, stop) -> Column:
    """start + drain + stop; NULL when any part is missing."""
    return _c(start) + _c(drain) + _c(stop)


def cast_seconds_to_double(df: DataFrame) -> DataFrame:
    """Every column whose name ends in '_seconds' becomes double."""
    return df.withColumns({c: F.col(c).cast("double") for c in df.columns if c.endswith("_seconds")})


def join_errors(parts, sep: str = " | ", n: int = config.LISTING_ERROR_CHARS) -> Column:
    """Array of error strings -> one text with a separator, first ``n`` characters."""
    return F.substring(F.array_join(_c(parts), sep), 1, n)


def append_error(existing, extra) -> Column:
    """(existing or '') + '; ' + extra, then leading ';' and ' ' characters stripped."""
    return F.regexp_replace(F.concat(F.coalesce(_c(existing), F.lit("")), F.lit("; "), _c(extra)),
                            r"^[; ]+", "")
