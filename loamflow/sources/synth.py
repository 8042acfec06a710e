"""Synthetic landing data as a Spark job.

``spark.range`` gives one row id per (collection, day, file, row); every value is a hash of
(seed, collection, day, file, row, field), so the output does not depend on partitioning
or task retries. Same collections, formats, schemas, value ranges and file naming as the
generator this re-implements; not the same random values. Files are written by the
named-file landing writer, one bounded group (``rows_per_file`` rows) per file."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions import names as N
from .landing_writer import write_landing


class _Gen:
    """Column expressions over (coll, day_idx, file_idx, row_idx) hashed with the seed."""

    def __init__(self, seed: int):
        self.seed = int(seed)

    def h(self, field: str) -> Column:
        return F.xxhash64(F.lit(self.seed), F.col("collection"), F.col("day_idx"),
                          F.col("file_idx"), F.col("row_idx"), F.lit(field))

    def uniform_int(self, field: str, lo: int, hi: int) -> Column:
        return (F.pmod(self.h(field), F.lit(hi - lo + 1)) + F.lit(lo)).cast("long")

    def uniform_double(self, field: str, lo: float, hi: float) -> Column:
        u = F.pmod(self.h(field), F.lit(1_000_000_007)) / F.lit(1_000_000_007.0)
        return F.round(F.lit(lo) + u * F.lit(hi - lo), 2)

    def choice(self, field: str, values: list) -> Column:
        idx = F.pmod(self.h(field), F.lit(len(values))) + F.lit(1)
        return F.element_at(F.array(*[F.lit(v) for v in values]), idx.cast("int"))

    def ident(self, field: str, prefix: str, lo: int, hi: int) -> Column:
        return F.concat(F.lit(prefix), self.uniform_int(field, lo, hi).cast("string"))

    def ms(self, field: str) -> Column:
        return F.col("_day_ms") + self.uniform_int(field, 0, C.SYNTH_ROW_JITTER_MS)

    def phone(self, field: str) -> Column:
        return F.concat(F.lit("9"), self.uniform_int(field, 100_000_000, 999_999_999).cast("string"))


def _payload(g: _Gen, collection: str) -> dict[str, Column]:
    if collection == "transactions":
        return {"_id": g.ident("_id", "txn_", 100_000, 999_999),
                "userId": g.ident("userId", "usr_", 10_000, 99_999),
                "amount": g.uniform_double("amount", 10.0, 50_000.0),
                "status": g.choice("status", C.SYNTH_TRANSACTION_STATUSES),
                "createdAt": g.ms("createdAt"), "updatedAt": g.ms("updatedAt"), "ts": g.ms("ts")}
    if collection == "transactions_statuslogs":
        return {"_id": g.ident("_id", "stl_", 100_000, 999_999),
                "transactionId": g.ident("transactionId", "txn_", 100_000, 999_999),
                "previousStatus": g.choice("previousStatus", C.SYNTH_STATUSLOG_STATUSES),
                "newStatus": g.choice("newStatus", C.SYNTH_STATUSLOG_STATUSES),
                "changedAt": g.ms("changedAt"), "ts": g.ms("ts")}
    if collection == "users":
        return {"_id": g.ident("_id", "usr_", 10_000, 99_999),
                "employerId": g.ident("employerId", "emp_", 1_000, 9_999),
                "kycStatus": g.choice("kycStatus", C.SYNTH_KYC_STATES),
                "phone": g.phone("phone"),
                "createdAt": g.ms("createdAt"), "updatedAt": g.ms("updatedAt"), "ts": g.ms("ts")}
    if collection == "videokycs":
        return {"_id": g.ident("_id", "vkyc_", 100_000, 999_999),
                "userId": g.ident("userId", "usr_", 10_000, 99_999),
                "callStatus": g.choice("callStatus", C.SYNTH_CALL_STATES),
                "attemptCount": g.uniform_int("attemptCount", 1, 5),
                "scheduledAt": g.ms("scheduledAt"), "ts": g.ms("ts")}
    if collection == "departments":
        return {"_id": g.ident("_id", "dept_", 100, 999),
                "employerId": g.ident("employerId", "emp_", 1_000, 9_999),
                "name": g.choice("name", C.SYNTH_DEPARTMENT_NAMES),
                "headCount": g.uniform_int("headCount", 5, 500),
                "createdAt": g.ms("createdAt"), "ts": g.ms("ts")}
    if collection == "otps":
        return {"_id": g.ident("_id", "otp_", 100_000, 999_999),
                "phone": g.phone("phone"),
                "purpose": g.choice("purpose", C.SYNTH_OTP_PURPOSES),
                "verified": F.pmod(g.h("verified"), F.lit(2)) == 1,
                "expiresAt": g.ms("expiresAt"), "ts": g.ms("ts")}
    raise ValueError(f"no row factory for {collection!r}")


def synth_rows(spark: SparkSession, num_days: int = 3, files_per_day: int = 5,
               rows_per_file: int = 200, seed: int = 42) -> DataFrame:
    """Landing rows of every catalogue collection (payload columns differ by collection;
    the others are NULL and left out of each file by the writer)."""
    for name, v in (("num_days", num_days), ("files_per_day", files_per_day),
                    ("rows_per_file", rows_per_file)):
        if int(v) < 1:
            raise ValueError(f"{name} must be a positive integer (got {v})")
    g = _Gen(seed)
    per_coll = num_days * files_per_day * rows_per_file
    frames = []
    for coll, _tier, fmt, _parent in C.SYNTH_COLLECTIONS:
        base = (spark.range(per_coll)
                .select(F.lit(coll).alias("collection"),
                        F.expr(f"id div {files_per_day * rows_per_file}").cast("int").alias("day_idx"),
                        F.expr(f"(id div {rows_per_file}) % {files_per_day}").cast("int").alias("file_idx"),
                        F.expr(f"id % {rows_per_file}").cast("int").alias("row_idx"))
                .withColumn("day", F.date_add(F.lit(C.SYNTH_ANCHOR_DATE).cast("date"), F.col("day_idx")))
                .withColumn("_day_ms", N.midnight_epoch_ms("day")))
        file_epoch = F.col("_day_ms") + F.pmod(
            F.xxhash64(F.lit(int(seed)), F.col("collection"), F.col("day_idx"), F.col("file_idx"),
                       F.lit("file")), F.lit(C.SYNTH_FILE_JITTER_MS + 1))
        payload = _payload(g, coll)
        frames.append(base.select(
            "collection", "day", F.col("file_idx").cast("long").alias("file_key"),
            file_epoch.alias("file_epoch_ms"), F.lit(fmt).alias("_format"),
            F.col("day_idx").alias("_name_day"),
            *[c.alias(k) for k, c in payload.items()]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def synthesize(spark: SparkSession, root: str, database: str, manifest_path: str,
               num_days: int = 3, files_per_day: int = 5, rows_per_file: int = 200,
               seed: int = 42) -> DataFrame:
    """Write the synthetic landing zone; returns the manifest (one row per file)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    rows = synth_rows(spark, num_days, files_per_day, rows_per_file, seed)
    return write_landing(rows, root, database, manifest_path, omit_null_columns=True)


def synth_summary(manifest: DataFrame) -> DataFrame:
    """Files, rows and bytes per collection plus a total line (collection NULL)."""
    return (manifest.rollup("collection")
            .agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"),
                 F.sum("bytes").alias("bytes")))
