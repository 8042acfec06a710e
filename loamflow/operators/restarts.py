"""Restart verdict of streams, as a query over an attempt log.

Rules of one stream (attempts in order):
- an attempt of kind 'ok' ends the stream: verdict 'ok';
- a failed attempt that ran >= ``healthy_seconds`` first resets both counters;
- then it counts: 'schema_evolution' -> schema counter, anything else -> genuine counter;
- genuine counter > ``max_restarts`` or schema counter > ``max_schema_restarts`` ends the
  stream: verdict 'failed';
- a log that ends before either: verdict 'running'.

The log is read and shuffled once. Attempts are cut into buckets of ``width`` order values; one
window a (stream, bucket) counts within it, and one aggregate on the same partitioning leaves a row
a bucket: its counters at its end, its first attempt that ends the stream whatever came before,
and the attempts before its first reset that might, given what came before (at most the two limits
together). Counters are then carried from bucket to bucket over this small table, so no stream's
log is sorted in one task and no attempt is joined back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config

_COUNTERS = ("g", "s")


def _within_buckets(attempts: DataFrame, healthy_seconds: float, width: int) -> DataFrame:
    """``attempts`` (stream, at, kind, ran) plus ``bucket``, ``was_reset`` (one came at or before
    this attempt in its bucket) and the counters ``g`` and ``s`` from the bucket's start or the
    last reset, this attempt included."""
    bucket = Window.partitionBy("stream", "bucket").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    since = Window.partitionBy("stream", "bucket", "resets").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    failed = F.col("kind") != "ok"
    reset = F.coalesce(failed & (F.col("ran") >= F.lit(float(healthy_seconds))), F.lit(False))
    schema = F.col("kind") == "schema_evolution"
    marked = attempts.select(
        "stream", "at", F.floor(F.col("at") / F.lit(int(width))).cast("long").alias("bucket"),
        (~failed).alias("ok"), (failed & ~schema).alias("is_g"), schema.alias("is_s"), reset.alias("reset"))
    return (marked.withColumn("resets", F.count_if("reset").over(bucket))
            .withColumns({c: F.count_if(f"is_{c}").over(since) for c in _COUNTERS})
            .withColumn("was_reset", F.col("resets") > 0))


def _bucket_rows(rows: DataFrame, limits: dict[str, int]) -> DataFrame:
    """One row a (stream, bucket); see the module's text. An attempt is (at, ok, g, s, was_reset)."""
    over = [F.col(f"is_{c}") & (F.col(c) > limits[c]) for c in _COUNTERS]
    ends = F.coalesce(F.col("ok") | over[0] | over[1], F.lit(False))
    ended_at = F.when(ends, F.col("at"))
    attempt = F.struct("at", "ok", "g", "s", "was_reset", "is_g", "is_s")
    might = ~F.col("was_reset") & ~ends & (F.col("is_g") | F.col("is_s"))
    return rows.groupBy("stream", "bucket").agg(
        F.count(F.lit(1)).alias("attempts"), F.max("was_reset").alias("has_reset"),
        *[F.max_by(c, "at").alias(f"end_{c}") for c in _COUNTERS],
        F.min_by(attempt, ended_at).alias("sure"),
        F.collect_list(F.when(might, attempt)).alias("maybe"))


def _carried(buckets: DataFrame) -> DataFrame:
    """``buckets`` plus ``in_g`` and ``in_s``: the counters that each begins with."""
    order = Window.partitionBy("stream").orderBy("bucket")
    run = Window.partitionBy("stream", "runs").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    summed = (buckets.withColumn("runs", F.count_if("has_reset").over(upto))
              .withColumns({f"sum_{c}": F.sum(f"end_{c}").over(run) for c in _COUNTERS}))
    return summed.withColumns({f"in_{c}": F.coalesce(F.lag(f"sum_{c}").over(order), F.lit(0)) for c in _COUNTERS})


def restart_verdict(attempts: DataFrame, stream_col: str = "collection", order_col: str = "attempt",
                    kind_col: str = "kind", ran_col: str = "ran_seconds",
                    max_restarts: int = config.MAX_RESTARTS,
                    max_schema_restarts: int = config.MAX_SCHEMA_RESTARTS,
                    healthy_seconds: float = config.HEALTHY_RESET_SECONDS,
                    width: int = 1 << 16) -> DataFrame:
    """(stream, verdict, decided_at, genuine_restarts, schema_restarts, attempts_logged).
    ``order_col`` must be unique within a stream (attempt numbers are); ties would make the
    running counters depend on an arbitrary order. An attempt of kind NULL only counts as logged."""
    limits = {"g": int(max_restarts), "s": int(max_schema_restarts)}
    log = attempts.select(F.col(stream_col).alias("stream"), F.col(order_col).alias("at"),
                          F.col(kind_col).alias("kind"), F.col(ran_col).alias("ran"))
    buckets = _carried(_bucket_rows(_within_buckets(log, healthy_seconds, width), limits))

    def ends(a):
        return F.exists(F.array(*[a[f"is_{c}"] & (a[c] + F.col(f"in_{c}") > limits[c]) for c in _COUNTERS]),
                        lambda hit: F.coalesce(hit, F.lit(False)))

    # the attempts that might end the stream come before the one that surely does, if they do at all
    first = F.array_min(F.filter(F.concat("maybe", F.array_compact(F.array("sure"))),
                                 lambda a: ends(a) | (a["at"] == F.col("sure.at"))))
    counter = {c: F.col(f"first.{c}") + F.when(F.col("first.was_reset"), 0).otherwise(F.col(f"in_{c}"))
               for c in _COUNTERS}
    ended = buckets.withColumn("first", first).withColumns({f"at_{c}": counter[c] for c in _COUNTERS})
    key = F.col("first.at")
    out = ended.groupBy("stream").agg(
        F.min(key).alias("decided_at"), F.min_by("first.ok", key).alias("ok"),
        *[F.min_by(f"at_{c}", key).alias(c) for c in _COUNTERS], F.sum("attempts").alias("attempts_logged"))
    return out.select(
        F.col("stream").alias(stream_col),
        F.when(F.col("decided_at").isNull(), "running").when(F.col("ok"), "ok").otherwise("failed").alias("verdict"),
        "decided_at", F.col("g").alias("genuine_restarts"), F.col("s").alias("schema_restarts"), "attempts_logged")
