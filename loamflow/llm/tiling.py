"""Benchmark decontamination by greedy string tiling.

Tokens are runs of letters and digits, A-Z lowered. Documents and benchmark items are joined on
shared seeds (runs of five tokens); a fixed-size Bloom filter of the benchmark's seeds keeps all
other seeds out of the join. Each text then meets its items once and is tiled by each: running
Karp-Rabin finds the longest common runs of unmarked tokens, each token belongs to one tile,
and what the tiles cover of the item decides. Order doesn't matter, so reordered passages are caught.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (FILTER_SLOTS, LOWER, blocks, has_slot, id_filter, map_arrow, materialize, maybe_in, mix64,
                     ngram_hashes, row_key, slot_filter, without_rows, word_hashes)

MIN_MATCH = 5
THRESHOLD = 0.5
_TOKEN = np.zeros(256, bool)
_TOKEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def tokens(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of every token of a block."""
    if not len(raw):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    inside, first = _TOKEN[raw], np.zeros(len(raw) + 1, bool)
    first[off] = True
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1] | first[1:-1]
    ends[:-1] &= ~inside[1:] | first[1:-1]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return word_hashes(LOWER[raw], s, e), np.searchsorted(off, s, "right") - 1


def _slots(seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = mix64(seed)
    mask = np.uint64(FILTER_SLOTS - 1)
    return (h & mask).astype(np.int64), (h >> np.uint64(32) & mask).astype(np.int64)


def _items(min_match: int):
    """item_id, tokens, seeds, slots of each benchmark item; a seed is a run of ``min_match``
    tokens, for a shorter item all of it."""
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for a, b, raw, off in blocks(batch.column(1)):
                word, doc = tokens(raw, off)
                rows = []
                for i in range(b - a):
                    w = word[doc == i]
                    seed = np.unique(ngram_hashes(w, np.zeros(len(w)), min(min_match, len(w)))[0]) if len(w) else word[:0]
                    rows.append((w.tobytes(), seed.astype(np.int64).tolist(), np.concatenate(_slots(seed)).tolist()))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array([r[0] for r in rows], pa.binary()),
                     pa.array([r[1] for r in rows], pa.list_(pa.int64())),
                     pa.array([r[2] for r in rows], pa.list_(pa.int32()))], ["item_id", "tokens", "seeds", "slots"])
    return run


def _candidates(bits, lengths: list[int]):
    """key, seeds of the texts with seeds that may be the benchmark's."""
    def run(batches):
        for batch in batches:
            key = batch.column(0).to_numpy()
            for a, _, raw, off in blocks(batch.column(1)):
                word, doc = tokens(raw, off)
                hits, at = [], []
                for n in lengths:
                    seed, first = ngram_hashes(word, doc, n)
                    x, y = _slots(seed)
                    ok = has_slot(bits.value, x)
                    ok[ok] = has_slot(bits.value, y[ok])
                    hits.append(seed[ok].view(np.int64))
                    at.append(doc[first[ok]])
                if not sum(map(len, hits)):
                    continue
                row, seed = np.unique(np.stack([np.concatenate(at), np.concatenate(hits)]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(key[a + row]), pa.array(seed)], ["key", "seed"])
    return run


_BASE = 0x100000001B3


class Runs:
    """The runs of ``n`` tokens of a sequence by Karp-Rabin hash, for any ``n``; marked tokens are
    in none."""

    def __init__(self, x: np.ndarray, used: np.ndarray):
        self.x, self.used = x, used
        base = np.full(len(x) + 1, _BASE, np.uint64)
        base[0] = 1
        self.power = np.cumprod(base, dtype=np.uint64)
        self.run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * self.power[:-1], dtype=np.uint64)])

    def of(self, n: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, start) of the unmarked runs of ``n`` tokens; hashes are shifted to the power of
        ``size``, the longer of two sequences."""
        m = len(self.x) - n + 1
        if m <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        marked = np.concatenate([[0], np.cumsum(self.used)])
        at = np.flatnonzero(marked[n:] == marked[:-n])
        h = (self.run[at + n] - self.run[at]) * self.power[m - 1 - at]
        return h * np.uint64(pow(_BASE, size - len(self.x), 1 << 64)), at


def _common(p: Runs, t: Runs, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash and start of the unmarked runs of ``n`` tokens of both whose hash the other has too."""
    size = max(len(p.x), len(t.x))
    (hp, ip), (ht, it) = p.of(n, size), t.of(n, size)
    order = np.argsort(hp, kind="stable")
    known = hp[order]
    if not len(known):
        return hp, ip, ht[:0], it[:0]
    at = np.minimum(np.searchsorted(known, ht), len(known) - 1)
    both = known[at] == ht
    ht, it = ht[both], it[both]
    mine = np.isin(hp, ht)
    return hp[mine], ip[mine], ht, it


def _shared_part(p: np.ndarray, t: np.ndarray, least: int) -> np.ndarray:
    """Places of ``t`` in runs of ``least`` tokens or more that all occur in ``p``."""
    inside = np.concatenate([[False], np.isin(t, p), [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    a, b = edge[::2], edge[1::2]
    keep = b - a >= least
    a, b = a[keep], b[keep]
    return np.repeat(a - np.concatenate([[0], np.cumsum(b - a)[:-1]]), b - a) + np.arange((b - a).sum()) if len(a) else a


def tiles(p: np.ndarray, t: np.ndarray, min_match: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Greedy string tiling of pattern ``p`` by ``t``: (length, start in p, start in t), longest
    first; of equal lengths the first in p, then in t. Every token is in one tile at most.
    Tiles of fewer than ``min_match`` tokens (all of a shorter pattern) don't count.

    Each round finds the greatest length of a common run of unmarked tokens, by bisection over
    Karp-Rabin hashes, and marks all runs of that length in order; what a marked run leaves of
    others is found again at its shorter length. A round takes time in proportion to the
    tokens, however often they repeat."""
    least = min(min_match, len(p))
    if not least:
        return []
    place = _shared_part(p, t, least)
    if not len(place):
        return []
    gap = np.flatnonzero(np.diff(place) > 1) + 1  # a marked token stands for what is left out
    used_t = np.insert(np.zeros(len(place), bool), gap, True)
    t, place = np.insert(t[place], gap, 0), np.insert(place, gap, -1)
    a, b = Runs(p, np.zeros(len(p), bool)), Runs(t, used_t)
    out: list[tuple[int, int, int]] = []
    most = min(len(p), len(t))
    while True:
        lo, hi = least - 1, most  # some run of lo tokens is common (if lo >= least), none of more than hi
        while lo < hi:
            n = least if lo < least else (lo + hi + 1) // 2
            if len(_common(a, b, n)[0]):
                lo = n
            else:
                hi = n - 1
        if lo < least:
            return out
        hp, ip, ht, it = _common(a, b, lo)
        order = np.argsort(ht, kind="stable")  # by hash, then by place
        ht, it = ht[order], it[order]
        first = np.searchsorted(ht, hp, "left")
        turn: dict[int, int] = {}  # a hash's places before this one are marked in t
        for i, j in zip(ip.tolist(), first.tolist()):
            if a.used[i:i + lo].any():
                continue
            k, h = turn.get(j, j), ht[j]
            while k < len(ht) and ht[k] == h and (b.used[it[k]:it[k] + lo].any() or (p[i:i + lo] != t[it[k]:it[k] + lo]).any()):
                k += 1
            turn[j] = k
            if k < len(ht) and ht[k] == h:
                s = int(it[k])
                a.used[i:i + lo] = b.used[s:s + lo] = True
                out.append((lo, i, int(place[s])))
        most = lo


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH,
                       threshold: float = THRESHOLD) -> DataFrame:
    """key, doc_id, item_id, item_tokens, covered_tokens, n_tiles, coverage of every document and
    benchmark item whose tiles cover at least ``threshold`` of the item's tokens.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text; key is the row_key() of the
    document. Null and empty texts hold nothing and empty items can't be held; items of fewer
    than ``min_match`` tokens must be held whole. Rows that repeat a document give one row an item;
    rows without an id are reported without one. Empty tables give no rows."""
    spark = docs.sparkSession
    items = materialize(map_arrow(
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text"), _items(min_match),
        "item_id long, tokens binary, seeds array<long>, slots array<int>"), "items")
    bits = spark.sparkContext.broadcast(slot_filter(items.select(F.explode("slots").alias("slot"))))
    short = [r[0] for r in items.select((F.octet_length("tokens") / 8).cast("int").alias("n"))
             .where(F.col("n").between(1, min_match - 1)).distinct().collect()]  # fewer than min_match rows
    found = map_arrow(docs.select(row_key(), "text"), _candidates(bits, sorted({*short, min_match})), "key long, seed long")
    seeds = items.select("item_id", F.explode("seeds").alias("seed")).distinct()
    pairs = found.distinct().join(seeds, "seed").select("key", "item_id").distinct()
    held = items.select("item_id", "tokens").dropDuplicates()
    per_doc = materialize(pairs.join(held, "item_id").groupBy("key")
                          .agg(F.collect_list(F.struct("item_id", "tokens")).alias("items")), "candidates")
    texts = docs.select(row_key().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    both = maybe_in(texts, id_filter(per_doc, "key"), "key").join(per_doc, "key")  # each text once, with its items

    def run(batches):
        for batch in batches:
            rows = []
            for a, b, raw, off in blocks(batch.column(2)):
                word, doc = tokens(raw, off)
                cut = np.searchsorted(doc, np.arange(b - a + 1))
                for i in range(b - a):
                    key, doc_id = batch.column(0)[a + i].as_py(), batch.column(1)[a + i].as_py()
                    for item in batch.column(3)[a + i].as_py():
                        p = np.frombuffer(item["tokens"], np.uint64)
                        got = tiles(p, word[cut[i]:cut[i + 1]], min_match)
                        rows.append((key, doc_id, item["item_id"], len(p), sum(k for k, _, _ in got), len(got)))
            key, doc_id, item, n, covered, count = zip(*rows) if rows else ((),) * 6
            share = np.array(covered, float) / np.maximum(np.array(n, np.int64), 1)
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(x, pa.int64()) for x in (key, doc_id, item, n, covered, count)], pa.array(share)],
                ["key", "doc_id", "item_id", "item_tokens", "covered_tokens", "n_tiles", "coverage"])
    return (map_arrow(both, run, "key long, doc_id long, item_id long, item_tokens long, covered_tokens long, "
                      "n_tiles long, coverage double").where(F.col("coverage") >= threshold).distinct())


def decontaminate(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH,
                  threshold: float = THRESHOLD) -> DataFrame:
    """``docs``, all columns, whatever their names, without the rows that hold a benchmark item.
    Null and empty texts stay, as do all rows if either table is empty; of repeated rows all
    go or stay. A long text's memory is its own tokens'."""
    bad = contaminated_pairs(docs, benchmark, min_match, threshold)
    return without_rows(docs, bad.select("key"))
