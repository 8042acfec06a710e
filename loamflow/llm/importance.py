"""Importance resampling towards a target distribution, over hashed word n-grams.

A feature is a run of 1..n words joined by one space; its bucket is the CRC-32 of its bytes
modulo the number of buckets. Newlines separate words, so texts are cut into lines: a line
that occurs often is counted once and its counts are multiplied by its occurrences, and only
the n-grams that cross a line's end are counted document by document. Each bucket's gain is
the log ratio of its smoothed shares in the target and in the corpus; a document's weight is
the mean gain of its features, and a Gumbel-perturbed draw takes the highest scores.

Words are the runs of digits, a-z (A-Z lower-cased) and non-ASCII characters.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, LOWER, blocks, keyed_text, map_arrow, materialize

BUCKETS = 10_000
#: Words at most so long take the vectorised CRC; what is left of longer ones goes to zlib.
SHORT = 64

IS_WORD = np.ones(256, bool)
IS_WORD[:0x30] = IS_WORD[0x3A:0x61] = IS_WORD[0x7B:0x80] = False


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1).astype(np.uint32)
    return c


CRC = _crc_table()
_START = np.uint32(0xFFFFFFFF)


def _step(state: np.ndarray, byte: np.ndarray) -> np.ndarray:
    return CRC[(state ^ byte) & np.uint32(255)] ^ (state >> np.uint32(8))


def crc_feed(state: np.ndarray, raw: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """CRC-32 register of each row after the bytes of its span."""
    length = e - s
    order = np.argsort(-length, kind="stable")
    st, at, length = state[order], s[order], length[order]
    longer = np.searchsorted(-length, -np.arange(SHORT + 1), "left")  # spans of more than j bytes
    for j in range(SHORT):
        m = longer[j]
        if not m:
            break
        st[:m] = _step(st[:m], raw[at[:m] + j])
    for i in range(longer[SHORT]):
        rest = raw[at[i] + SHORT:at[i] + length[i]].tobytes()
        st[i] = ~np.uint32(zlib.crc32(rest, int(~st[i])))
    out = np.empty_like(st)
    out[order] = st
    return out


def _spans(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word."""
    word = IS_WORD[raw]
    first = np.zeros(len(raw) + 1, bool)
    first[off] = True
    starts, ends = word.copy(), word.copy()
    starts[1:] &= ~word[:-1] | first[1:-1]
    ends[:-1] &= ~word[1:] | first[1:-1]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return s, e, np.searchsorted(off, s, "right") - 1


def _pieces(raw: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts of a long text after about BLOCK_BYTES each, never inside a word."""
    p, n = 0, len(raw)
    while p < n:
        q = min(p + BLOCK_BYTES, n)
        while q < n and IS_WORD[raw[q - 1]]:
            gap = np.flatnonzero(~IS_WORD[raw[q:q + BLOCK_BYTES]])
            q = min(q + (int(gap[0]) + 1 if len(gap) else BLOCK_BYTES), n)
        yield p, q
        p = q


def grams(col, n: int, buckets: int, crossing: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(row, bucket, words) of every n-gram of 1..n words of each row of a string array, in
    chunks of one length; ``crossing``: only those that cross a newline. A row longer than a
    block is read in pieces, each with the last n - 1 words of the piece before it."""
    for a, _, raw, off in blocks(col):
        raw = LOWER[raw]
        cuts = [(0, len(raw))] if len(raw) <= 2 * BLOCK_BYTES else _pieces(raw)
        held = (np.empty(0, np.int64),) * 4  # start, end, row, line of the words held over
        lines = 0
        for p, q in cuts:
            s, e, row = _spans(raw[p:q], np.clip(off - p, 0, q - p))
            line = np.empty(0, np.int64)
            if crossing:
                breaks = np.flatnonzero(raw[p:q] == 10)
                line = lines + np.searchsorted(breaks, s)
                lines += len(breaks)
            else:
                line = np.zeros(len(s), np.int64)
            s, e, row, line = (np.concatenate(x) for x in zip(held, (s + p, e + p, row, line)))
            old = len(held[0])
            state = np.full(len(s), _START)
            for g in range(1, min(n, len(s)) + 1):
                m = len(s) - g + 1
                if g > 1:
                    state = _step(state[:m], np.uint32(32))
                state = crc_feed(state, raw, s[g - 1:], e[g - 1:])
                fits = row[:m] == row[g - 1:]
                fits[:max(0, old - g + 1)] = False  # seen in the piece before
                if crossing:
                    fits &= line[:m] != line[g - 1:]
                yield a + row[:m][fits], (~state[fits] % np.uint32(buckets)).astype(np.int64), g
            held = tuple(x[max(0, len(s) - n + 1):] if n > 1 else x[:0] for x in (s, e, row, line))


def _count_lines(n: int, buckets: int):
    """Bucket counts of distinct lines, times their occurrences."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            times = batch.column(1).to_numpy()
            for row, bucket, _ in grams(batch.column(0), n, buckets):
                np.add.at(total, bucket, times[row])
        yield _filled(total)
    return run


def _count_crossing(n: int, buckets: int):
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, bucket, _ in grams(batch.column(0), n, buckets, crossing=True):
                total += np.bincount(bucket, minlength=buckets)
        yield _filled(total)
    return run


def _filled(total: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], ["bucket", "n"])


def bucket_counts(texts: DataFrame, text: str = "text", n: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): occurrences of the features of each bucket over all texts; at most
    ``buckets`` rows. Null and empty texts hold none; an empty table gives no rows."""
    whole = texts.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    lines = (whole.select(F.explode(F.split("text", "\n")).alias("line")).where("line <> ''")
             .groupBy("line").count())
    counts = map_arrow(lines, _count_lines(n, buckets), "bucket long, n long")
    if n > 1:
        counts = counts.union(map_arrow(whole, _count_crossing(n, buckets), "bucket long, n long"))
    return counts.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, n: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Each bucket's gain: floor(1000 ln of its smoothed share in ``target`` over that in
    ``docs``). ``buckets`` numbers, whatever the tables hold."""
    spark = docs.sparkSession
    s, t = (bucket_counts(x, n=n, buckets=buckets) for x in (docs, target))
    both = (s.withColumnRenamed("n", "s").join(t.withColumnRenamed("n", "t"), "bucket", "full")
            .join(spark.range(buckets).withColumnRenamed("id", "bucket"), "bucket", "right").fillna(0))
    rows = both.select("bucket", "s", "t").toArrow()
    own, aim = np.zeros(buckets), np.zeros(buckets)
    at = rows["bucket"].to_numpy()
    own[at], aim[at] = rows["s"].to_numpy(), rows["t"].to_numpy()
    ratio = (aim + 1) * (own.sum() + buckets) / ((own + 1) * (aim.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weigh(gains, n: int, buckets: int):
    names = ["doc_id", "n_features", "n_words", "weight"]

    def totals(col, rows: int, crossing: bool) -> np.ndarray:
        """(features, words, gain) of each row."""
        out = np.zeros((3, rows), np.int64)
        for row, bucket, g in grams(col, n, buckets, crossing):
            found = np.bincount(row, minlength=rows)
            out[0] += found
            if g == 1:
                out[1] += found
            out[2] += np.bincount(row, gains.value[bucket], rows).astype(np.int64)
        return out

    def run(batches):
        for batch in batches:
            text = batch.column(1).cast(pa.large_string())
            parts = pc.split_pattern(text, "\n")
            lines = parts.flatten().dictionary_encode()  # each distinct line of the batch once
            of_line = totals(lines.dictionary, len(lines.dictionary), False)
            doc, line = pc.list_parent_indices(parts).to_numpy(), lines.indices.to_numpy()
            sums = np.zeros((3, len(text)), np.int64)
            for i in range(3):
                np.add.at(sums[i], doc, of_line[i][line])
            if n > 1:
                sums += totals(text, len(text), True)
            weight = np.floor_divide(sums[2], np.maximum(sums[0], 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sums[0]), pa.array(sums[1]),
                                              pa.array(weight)], names)
    return run


def weigh(docs: DataFrame, gains: np.ndarray, n: int = 1) -> DataFrame:
    """doc_id, n_features, n_words, weight of every whole text: the floored mean gain of its
    features, 0 without any."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)
    return map_arrow(keyed_text(docs), _weigh(shared, n, len(gains)),
                     "doc_id long, n_features long, n_words long, weight long")


def resample(docs: DataFrame, target: DataFrame, n: int = 1, buckets: int = BUCKETS, seed: str = "2024",
             min_words: int = 20, percent: int = 10) -> DataFrame:
    """Draw ``percent`` % (floored) of the documents of at least ``min_words`` words towards the
    word n-grams of ``target``: every document's doc_id, n_features, n_words, weight, score and
    rank (1, 2, ... by falling score, then rising doc_id; null if not drawn).

    The score adds to the weight a Gumbel variate made from the SHA-256 of seed and id, so
    reruns agree. Null and empty texts have no features, weight 0, and are never drawn while
    ``min_words`` > 0. A null id hashes as an empty one and ranks after others of its score;
    rows of equal id and score rank in any order. An empty ``docs`` gives no rows; an empty
    ``target`` counts nothing. Only ``doc_id`` and ``text`` of ``docs`` are read, so other
    columns may have any name.

    Scores are whole numbers within a range that the bucket count and the variate's 32 bits
    bound, so the score histogram that finds the cut stays small (tens of thousands of rows),
    and ranks are counted within one score each."""
    spark = docs.sparkSession
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))),
                                  256), 1, 8), 16, 10).cast("long")
    gumbel = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")
    scored = materialize(weigh(docs, bucket_gains(docs, target, n, buckets), n)
                         .withColumn("score", F.col("weight") + gumbel), "importance")
    fit = F.col("n_words") >= min_words
    hist = scored.where(fit).groupBy("score").count().toArrow()
    score, count = hist["score"].to_numpy(), hist["count"].to_numpy()
    order = np.argsort(-score)
    before = np.concatenate([[0], np.cumsum(count[order])])
    draw = int(before[-1]) * percent // 100
    drawn = int(np.searchsorted(before[:-1], draw, "left"))  # scores that begin before the cut
    starts = spark.createDataFrame(pa.table({"score": pa.array(score[order][:drawn], pa.int64()),
                                             "before": pa.array(before[:drawn], pa.int64())}))
    joined = scored.join(starts, "score", "left").withColumn("before", F.when(fit, F.col("before")))
    place = F.col("before") + F.row_number().over(
        Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last()))
    ranked = joined.where("before is not null").withColumn("rank", place.cast("long"))
    rest = joined.where("before is null").withColumn("rank", F.lit(None).cast("long"))
    return (ranked.withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank"))).unionByName(rest)
            .select("doc_id", "n_features", "n_words", "weight", "score", "rank"))


ORACLE_RESAMPLE = r"""
WITH RECURSIVE
bits AS (
  SELECT i AS b, i::UBIGINT AS c, 0 AS k FROM range(256) r(i)
  UNION ALL
  SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
tab AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE k = 8),
dw AS (
  SELECT rid, doc_id, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM (SELECT row_number() OVER () AS rid, * FROM documents)),
bw AS (
  SELECT unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM benchmark),
dc AS (SELECT rid, w, count(*) AS n FROM dw GROUP BY rid, w),
words AS (SELECT w, hex(encode(w)) AS x FROM (SELECT DISTINCT w FROM dw UNION SELECT w FROM bw)),
bucket AS (
  SELECT w, xor(list_reduce(
           list_prepend(4294967295::UBIGINT, list_transform(range(len(x) // 2),
             lambda i: ('0x' || substr(x, (2 * i + 1)::BIGINT, 2))::UBIGINT)),
           lambda c, y: xor(c >> 8, t[((xor(c, y) & 255) + 1)::BIGINT])), 4294967295::UBIGINT) % 10000 AS b
  FROM words, tab),
s AS (SELECT b, sum(n)::BIGINT AS s FROM dc JOIN bucket USING (w) GROUP BY b),
t AS (SELECT b, count(*) AS t FROM bw JOIN bucket USING (w) GROUP BY b),
gain AS (
  SELECT b, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)::DOUBLE
           / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS g
  FROM s FULL JOIN t USING (b)),
per AS (
  SELECT rid, sum(n)::BIGINT AS n_features, floor(sum(n * g) / sum(n))::BIGINT AS weight
  FROM dc JOIN bucket USING (w) JOIN gain USING (b) GROUP BY rid),
scored AS (
  SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln(
           (('0x' || substr(sha256('2024:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 8))::BIGINT + 0.5)
           / 4294967296)))::BIGINT AS score
  FROM (SELECT row_number() OVER () AS rid, * FROM documents) d LEFT JOIN per USING (rid)),
r AS (
  SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS rank,
         (SELECT count(*) FROM scored WHERE n_features >= 20) * 10 // 100 AS draw
  FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= draw THEN rank END AS rank FROM r
UNION ALL
SELECT doc_id, n_features, weight, score, NULL FROM scored WHERE n_features < 20
"""
