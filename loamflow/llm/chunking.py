"""Document fingerprints by content-defined chunking.

A gear hash rolls over the UTF-8 bytes (its 32 bits depend on the last 32 bytes only). A chunk
ends after a byte whose hash has all-zero leading bits: more bits are asked for below the
normal chunk size and fewer above it (normalised chunking), within a least and a greatest
size. Boundaries follow content, so an insertion moves the chunks around it only. The
fingerprint is the set of chunk digests with their lengths; likeness is the share of a
document's chunk bytes that the other document also has (containment).
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, keyed_text, map_arrow, mix64, word_hashes

MIN_SIZE, NORMAL_SIZE, MAX_SIZE = 16, 64, 256
HARD_BITS, EASY_BITS = 7, 4
GEAR = (mix64(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
#: Where a null id stands in ascending order.
NULL_KEY = -(1 << 63)
#: Key ranges of the neighbour pass for each shuffle partition.
RANGES_A_PARTITION = 8


def gear_hashes(raw: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte: sum of GEAR[byte j back] << j, by doubling windows."""
    h = GEAR[raw]
    for shift in (1, 2, 4, 8, 16):
        older = h[:-shift].copy() if shift < len(h) else h[:0]
        h[shift:] += older << np.uint32(shift)
    return h


def _next_at(mask: np.ndarray) -> np.ndarray:
    """For each position the first masked position at or after it, else the length."""
    n = len(mask)
    at = np.where(mask, np.arange(n, dtype=np.int32), np.int32(n))
    return np.append(np.minimum.accumulate(at[::-1])[::-1], np.int32(n))


def chunk_spans(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of every chunk of a block. The hash doesn't start anew at a
    document, but its first ``MIN_SIZE`` bytes end no chunk, and from its 32nd byte on the
    hash depends on the document alone; the bytes between are hashed anew from its start."""
    n = len(raw)
    if not n:
        return (np.empty(0, np.int64),) * 3
    h = gear_hashes(raw)
    starts, ends = off[:-1], off[1:]
    full = ends > starts
    for a, b in zip(starts[full].tolist(), np.minimum(ends, starts + 31)[full].tolist()):
        if a:
            h[a:b] = gear_hashes(raw[a:b])
    hard = _next_at(h >> np.uint32(32 - HARD_BITS) == 0)
    easy = _next_at(h >> np.uint32(32 - EASY_BITS) == 0)
    doc, p = np.flatnonzero(full), starts[full]
    stop = ends[full]
    out_s, out_e, out_d = [], [], []
    while len(p):
        first = hard[np.minimum(p + MIN_SIZE - 1, n)] + 1
        later = np.minimum(easy[np.minimum(p + NORMAL_SIZE - 1, n)] + 1, p + MAX_SIZE)
        e = np.minimum(np.where(first < p + NORMAL_SIZE, first, later), stop)
        out_s.append(p), out_e.append(e), out_d.append(doc)
        more = e < stop
        p, stop, doc = e[more], stop[more], doc[more]
    s, e, d = np.concatenate(out_s), np.concatenate(out_e), np.concatenate(out_d)
    order = np.argsort(s, kind="stable")
    return s[order], e[order], d[order]


def fingerprints(texts: pa.Array) -> list[np.ndarray]:
    """For each text its sorted distinct chunks, 48 digest bits above 16 length bits."""
    out: list[np.ndarray] = []
    for a, b, raw, off in blocks(texts):
        s, e, d = chunk_spans(raw, off)
        code = (word_hashes(raw, s, e) & ~np.uint64(0xFFFF)) | (e - s).astype(np.uint64)
        cut = np.searchsorted(d, np.arange(b - a + 1))
        for i in range(b - a):
            c = np.sort(code[cut[i]:cut[i + 1]])
            if len(c) > 1:
                c = c[np.append(True, c[1:] != c[:-1])]
            out.append(c)
    return out


def packed(codes: np.ndarray) -> str:
    """Base64 of the big-endian codes."""
    return base64.b64encode(codes.astype(">u8").tobytes()).decode()


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the chunk bytes of ``a`` whose chunks are in ``b`` too; two empty sets are
    alike (1), an empty one and another are not (0)."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    size = (a & np.uint64(0xFFFF)).astype(np.int64)
    return float(size[b[at] == a].sum() / size.sum())


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, fingerprint of every whole text; null text counts as empty."""
    def run(batches):
        for batch in batches:
            text = batch.column(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in text.to_pylist()], pa.int64()),
                 pa.array([packed(c) for c in fingerprints(text)], pa.string())],
                ["doc_id", "n_chars", "fingerprint"])
    return map_arrow(keyed_text(docs), run, "doc_id long, n_chars long, fingerprint string")


def with_neighbours(docs: DataFrame) -> DataFrame:
    """(range, guard, doc_id, text): documents dealt into key ranges, so that each row's next
    document by ascending doc_id is the next row of its range. Ranges come from quantiles of
    the ids; the first document of each range is sent to the range before it as well, as its
    guard (the first of all to the last range). Null ids come first; rows of equal id are
    ordered by text. Only the first id of each range passes through the driver."""
    spark = docs.sparkSession
    base = keyed_text(docs)
    key = F.coalesce("doc_id", F.lit(NULL_KEY)).alias("key")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = RANGES_A_PARTITION * parts
    cuts = base.select(key).agg(F.percentile_approx("key", [i / n for i in range(1, n)], 10 * n)).first()[0]
    edges = np.array(sorted(set(cuts or ())), np.int64)
    # one row a range, so at most RANGES_A_PARTITION * partitions of them
    firsts = sorted(tuple(r) for r in map_arrow(base.select(key), _first_keys(edges), "range int, first long")
                    .groupBy("range").agg(F.min("first")).collect())
    before = {first: firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}
    return (map_arrow(base, _deal(edges, before), "range int, guard boolean, key long, doc_id long, text string")
            .repartition(parts, "range").sortWithinPartitions("range", "guard", "key", "text")
            .drop("key"))


def _keys(ids: pa.Array) -> np.ndarray:
    return ids.fill_null(NULL_KEY).to_numpy(zero_copy_only=False)


def _first_keys(edges: np.ndarray):
    """Of each batch, the least key of each range; a range holds the keys up to its cut."""
    def run(batches):
        for batch in batches:
            if key := np.sort(batch.column(0).to_numpy(zero_copy_only=False)).tolist():
                rng = np.searchsorted(edges, key, "left").tolist()
                least = {r: k for r, k in zip(reversed(rng), reversed(key))}
                yield pa.RecordBatch.from_arrays([pa.array(list(least), pa.int32()),
                                                  pa.array(list(least.values()), pa.int64())], ["range", "first"])
    return run


def _deal(edges: np.ndarray, before: dict[int, int]):
    names = ["range", "guard", "key", "doc_id", "text"]

    def run(batches):
        for batch in batches:
            key = _keys(batch.column(0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.searchsorted(edges, key, "left").astype(np.int32)),
                 pa.array(np.zeros(len(key), bool)), pa.array(key), batch.column(0), batch.column(1)], names)
            if at := [i for i, k in enumerate(key.tolist()) if k in before]:
                own = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([before[int(key[i])] for i in at], pa.int32()), pa.array([True] * len(at)),
                     pa.array(key[at]), own.column(0), own.column(1)], names)
    return run


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as much of the start of ``following``."""
    cut = len(text) // 4
    return text[:len(text) - cut] + following[:cut]


def compare_with_next(docs: DataFrame) -> DataFrame:
    """For every document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. The next document is the next by (doc_id, text), the first after
    the last; a single document is its own next. An empty table gives no rows."""
    names = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
             "near_edited", "near_next")
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())

    def rows_of(window: pa.Table) -> pa.RecordBatch:
        rng, guard = window.column("range").to_pylist(), window.column("guard").to_pylist()
        ids, text = window.column("doc_id").to_pylist(), window.column("text").to_pylist()
        codes = fingerprints(window.column("text").combine_chunks())
        at = [i for i in range(len(ids) - 1) if not guard[i]]
        assert all(rng[i] == rng[i + 1] for i in at), "a range has no guard"
        new = [edited(text[i], text[i + 1]) for i in at]
        other = fingerprints(pa.array(new, pa.large_string()))
        rows = [(ids[i], len(text[i]), hashlib.sha256(t.encode()).hexdigest(), packed(codes[i]), packed(c),
                 containment(codes[i], c), containment(codes[i], codes[i + 1]))
                for i, t, c in zip(at, new, other)]
        return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], k)
                                           for j, k in enumerate(kinds)], list(names))

    def run(batches):
        held = None  # rows not yet followed by their next
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                piece = pa.Table.from_batches([batch.slice(a, 256)])
                held = piece if held is None else pa.concat_tables([held, piece])
                if held.num_rows > 1:
                    yield rows_of(held)
                    held = held.slice(held.num_rows - 1)

    return map_arrow(with_neighbours(docs), run, ", ".join(
        f"{n} {'long' if k == pa.int64() else 'double' if k == pa.float64() else 'string'}"
        for n, k in zip(names, kinds)))
