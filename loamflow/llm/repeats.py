"""Exact substring deduplication over a prefix-free parse.

A rolling hash runs over the UTF-8 bytes of each text. Within every ``length``-byte string the
trigger is the place of the least hash of ``trigger`` bytes, so each such string holds one and
equal strings have it at the same place. Consecutive strings with one trigger make up a
phrase; the phrases are the parse, the distinct ones the dictionary. A byte is removed if a
``length``-byte string over it also starts earlier in the corpus (smaller doc_id, or the same
document, earlier start).

Only the order of a corpus position's first ``length`` bytes matters, that is, which positions
agree in them and which of these comes first; so suffixes of dictionary and parse are told
apart by class (128 bits of hash: trigger and phrase) in place of rank, which Spark
finds by hash aggregates in place of a sort of all suffixes:

1. count the triggers: one that occurs once lies in no repeated string, and is dropped here;
2. classes of phrases: of each class the first stays, all others are repeats as a whole;
3. where a trigger has several classes (ends of repeats), the strings of their first phrases
   are classed one by one, and the first of each class stays;
4. each document gets back its phrases, the firsts among them and its first strings.

Every step is a map-side combined aggregate or a join on a hash: a passage that a third of
all documents share is one row a task before it is shuffled. No step depends on how much
repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.scans import with_rank
from .common import BLOCK_BYTES, blocks, keyed_text, map_arrow, materialize, mix64, utf8, word_hashes

LENGTH, TRIGGER = 100, 32
#: A phrase's place in its document: start << PLACE_BITS | number of strings.
PLACE_BITS = 8
_POSITION = np.uint64((1 << 21) - 1)  # places within a piece
_LOW = np.uint64((1 << 48) - 1)


def _pieces(raw: np.ndarray, off: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first byte, bytes, offsets) of overlapping pieces: every string lies in just one as a
    whole, or is not the piece's first or last."""
    for p in range(0, max(1, len(raw) - length + 1), BLOCK_BYTES):
        q = min(p + BLOCK_BYTES + length - 1, len(raw))
        yield p, raw[p:q], np.clip(off - p, 0, q - p)


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have < width:
        step = min(have, width - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def phrases(raw: np.ndarray, off: np.ndarray, length: int = LENGTH,
            trigger: int = TRIGGER) -> tuple[np.ndarray, ...]:
    """(row, start in the row, number of strings, trigger code, phrase code) of every phrase of a
    block of texts."""
    out = [(np.empty(0, np.int64),) * 5]
    for p, piece, cut in _pieces(raw, off, length):
        n = len(piece) - length + 1
        if n <= 0:
            continue
        at = np.arange(len(piece) - trigger + 1)
        code = word_hashes(piece, at, at + trigger)
        place = (_sliding_least((code & ~_POSITION) | at.astype(np.uint64), length - trigger + 1)
                 & _POSITION).astype(np.int64)
        end = np.repeat(cut[1:], np.diff(cut))
        start = np.flatnonzero(np.arange(n) + length <= end[:n])
        if not len(start):
            continue
        place = place[start]
        first = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)))
        last = np.append(first[1:], len(start)) - 1
        s, e, t = start[first], start[last] + length, place[first]
        phrase = mix64(word_hashes(piece, s, e) ^ (t - s).astype(np.uint64))
        row = np.searchsorted(off, s + p, "right") - 1
        out.append((row, s + p - off[row], last - first + 1, (code[t] & _LOW).astype(np.int64),
                    (phrase & _LOW).astype(np.int64)))
    return tuple(np.concatenate(x) for x in zip(*out))


def _parse(length: int, trigger: int):
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for a, _, raw, off in blocks(batch.column(1)):
                row, start, n, code, phrase = phrases(raw, off, length, trigger)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(code), pa.array(phrase), ids.take(pa.array(row + a)),
                     pa.array(start << PLACE_BITS | n)], ["code", "phrase", "row", "place"])
    return run


def string_codes(raw: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    """The code of the string at each (ascending) start, piece by piece."""
    out = np.empty(len(start), np.uint64)
    for p in range(0, len(raw), BLOCK_BYTES):
        a, b = np.searchsorted(start, [p, p + BLOCK_BYTES])
        if a < b:
            s = start[a:b] - p
            out[a:b] = word_hashes(raw[p:p + BLOCK_BYTES + length], s, s + length)
    return out.view(np.int64)


def _listed(col) -> tuple[np.ndarray, np.ndarray]:
    """(parent row, value) of a list column."""
    return col.value_parent_indices().to_numpy(), col.flatten().to_numpy()


def _expand(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the phrase, start) of every string of some phrases."""
    n = place & ((1 << PLACE_BITS) - 1)
    which = np.repeat(np.arange(len(place)), n)
    return which, (place >> PLACE_BITS)[which] + np.arange(len(which)) - (np.cumsum(n) - n)[which]


def _strings(length: int):
    """(code, row, start) of every string of the listed phrases of each text."""
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            raw, off = utf8(batch.column(1))
            row, place = _listed(batch.column(2))
            which, start = _expand(place)
            row = row[which]
            at = start + off[row]
            order = np.argsort(at, kind="stable")
            yield pa.RecordBatch.from_arrays(
                [pa.array(string_codes(raw, at[order], length)), ids.take(pa.array(row[order])),
                 pa.array(start[order])], ["code", "row", "start"])
    return run


#: What a place of a document's list is: a phrase with a repeated trigger, one that is the
#: first of its class, one of these whose strings were classed, a string first of its class.
REPEATED, FIRST, OPENED, FIRST_STRING = range(4)


def _union(s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal intervals covered by some [s, e)."""
    if not len(s):
        return s, e
    order = np.argsort(s, kind="stable")
    s, reach = s[order], np.maximum.accumulate(e[order])
    new = np.append(True, s[1:] > reach[:-1])
    return s[new], reach[np.append(np.flatnonzero(new)[1:], len(s)) - 1]


def removed_spans(marks: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the maximal removed runs of one document, from its marked places
    (place << 2 | what it is)."""
    kind, place = marks & 3, marks >> 2
    gone = np.setdiff1d(place[kind == REPEATED], place[kind == FIRST])
    strings = np.setdiff1d(_expand(place[kind == OPENED])[1], place[kind == FIRST_STRING])
    start = gone >> PLACE_BITS
    return _union(np.concatenate([start, strings]),
                  np.concatenate([start + (gone & ((1 << PLACE_BITS) - 1)) + length - 1, strings + length]))


def _apply(length: int, with_text: bool):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept", "starts", "ends"] * with_text

    def run(batches):
        for batch in batches:
            raw, off = utf8(batch.column(1))
            marks = batch.column(2)
            rows = []
            for i in range(batch.num_rows):
                own = raw[off[i]:off[i + 1]]
                s, e = removed_spans(marks[i].values.to_numpy() if marks[i].is_valid else np.empty(0, np.int64), length)
                kept = [own[x:y] for x, y in zip(np.append(0, e).tolist(), np.append(s, len(own)).tolist())]
                digest = hashlib.sha256()
                for part in kept:
                    digest.update(part)
                rows.append((len(own), int((e - s).sum()), len(s), digest.hexdigest()))
                if with_text:
                    rows[-1] += (b"".join(k.tobytes() for k in kept), s, e)
            cols = list(zip(*rows)) or [()] * (len(names) - 1)
            kinds = [pa.int64()] * 3 + [pa.string()] + [pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())] * with_text
            yield pa.RecordBatch.from_arrays(
                [batch.column(3), *[pa.array(c, k) for c, k in zip(cols, kinds)]], names)
    return run


def numbered(docs: DataFrame) -> DataFrame:
    """(row, text, doc_id): each text with its number in corpus order. Distinct ids, none null,
    are their own numbers; else rows are ranked by (doc_id, nulls first, a hash of the text),
    rows equal in both in any order."""
    docs = keyed_text(docs)
    odd = docs.groupBy("doc_id").count().where("count > 1 or doc_id is null")
    if odd.isEmpty():
        return docs.select(F.col("doc_id").alias("row"), "text", "doc_id")
    docs = materialize(docs.withColumn("at", F.monotonically_increasing_id()), "repeats-rows")
    rank = with_rank(docs.select("at", "doc_id", F.xxhash64("text").alias("digest")),
                     [F.col("doc_id").asc_nulls_first(), "digest", "at"], "row").select("at", "row")
    return docs.join(rank, "at").select("row", "text", "doc_id")


def remove_repeats(docs: DataFrame, length: int = LENGTH, trigger: int = TRIGGER,
                   with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every whole text as UTF-8 bytes and,
    ``with_text``, the kept bytes and the removed runs' starts and ends.

    Null and empty texts, and those shorter than ``length``, lose nothing. Rows of null id come
    first in corpus order; rows of equal id are ordered by a hash of their text, and of equal
    rows one stands first. An empty table gives no rows. Only ``doc_id`` and ``text`` are read, so
    other columns may have any name. Long texts are parsed in pieces of a megabyte; a task
    holds a row's bytes and its places. ``trigger`` < ``length`` < 2 ** 8 + ``trigger``."""
    docs = numbered(docs)
    parse = map_arrow(docs.select("row", "text"), _parse(length, trigger), "code long, phrase long, row long, place long")
    # written first, so that a hot trigger's phrases meet a plain scan and Spark can split the join
    often = materialize(parse.groupBy("code").count().where("count > 1").select("code"), "repeats-often")
    repeated = materialize(parse.join(often, "code"), "repeats-phrases")
    first = F.min(F.struct("row", "place")).alias("first")
    classes = materialize(repeated.groupBy("code", "phrase").agg(first).select("code", "first.row", "first.place"),
                          "repeats-classes")
    forked = classes.groupBy("code").count().where("count > 1").select("code")
    opened = materialize(classes.join(forked, "code").select("row", "place"), "repeats-opened")
    per_doc = opened.groupBy("row").agg(F.collect_list("place").alias("places"))
    strings = map_arrow(docs.join(per_doc, "row").select("row", "text", "places"), _strings(length),
                        "code long, row long, start long")
    firsts = materialize(strings.groupBy("code").agg(F.min(F.struct("row", "start")).alias("first"))
                         .select("first.row", "first.start"), "repeats-strings")
    marks = [t.select("row", F.shiftleft(c, 2).bitwiseOR(F.lit(what)).alias("mark")) for t, c, what in (
        (repeated, "place", REPEATED), (classes, "place", FIRST), (opened, "place", OPENED),
        (firsts, "start", FIRST_STRING))]
    marks = marks[0].union(marks[1]).union(marks[2]).union(marks[3])
    marked = docs.join(marks.groupBy("row").agg(F.collect_list("mark").alias("marks")), "row", "left")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return map_arrow(marked.select("row", "text", "marks", "doc_id"), _apply(length, with_text),
                     schema + ", kept binary, starts array<long>, ends array<long>" * with_text)
