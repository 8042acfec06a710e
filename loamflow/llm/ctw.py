"""Language-model scoring by context-tree weighting over bytes.

A byte is eight binary decisions (a path of 255 inner nodes), each with its own context tree
over the bytes before it. Every tree node has a Krichevsky-Trofimov estimate from its counts
of zeros and ones, and the mixture weighs, at every node, stopping there against the product
of its children, over all depths up to ``DEPTH`` bytes.

* Counts: Spark counts (context of DEPTH bytes, next byte) over all texts, those learnt from
  apart; counts of shorter contexts are sums of these. Texts start after DEPTH bytes 0xFF and
  end with one (UTF-8 has none), so starts and ends are modelled, too.
* Tree: every context of 0..DEPTH bytes that was learnt from is a node. Contexts that share
  their last SPLIT bytes are a subtree, worked on within one task; the levels above, at most
  256**(SPLIT - 1) contexts, meet on the driver and go to the tasks.
* Score: the mixture's probability of each distinct (context, byte) of all texts is a table in
  Spark. Its most used rows, of fixed number, go to the tasks; the rest is joined.

``train`` is the same mixture with at most ``NODE_SHARE`` nodes a depth, the rare contexts below
a node sharing one, as a table in memory; ``score`` doesn't use it.

The base score needs the corpus counts of every word. They stay in Spark: a table of the most
frequent words of fixed size goes to the tasks, and the rest is joined.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, blocks, keyed_text, map_arrow, materialize, word_hashes, word_spans

DEPTH = 5
NODE_SHARE = 1 << 14
#: Codes that a counting task sorts at once.
PIECE = 4 << 20
EDGE = 0xFF
#: Bytes of a stretch when scoring.
STRETCH = 256
#: Words that are at least a 1/FREQUENT of all, so at most as many: their counts are sent to the tasks.
FREQUENT = 1 << 21
#: The distinct (context, byte) of the greatest use sent to the tasks, at most.
FREQUENT_GRAMS = 1 << 21
SPLIT = 3
#: Rows that a task works on at once, besides one subtree of more.
CHUNK = 1 << 18
FOLDS, HELD_OUT = 7, 2
LN10 = float(np.log(10))


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from training; a null id counts as the empty string."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


# ---- counts ---------------------------------------------------------------------------------

def framed(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The block's texts, A-Z lowered, each after DEPTH edge bytes and before one, and the
    positions of the bytes to predict (the end included)."""
    n = len(off) - 1
    size = np.diff(off)
    row = np.repeat(np.arange(n), size)
    out = np.full(len(raw) + n * (DEPTH + 1), EDGE, np.uint8)
    at = np.arange(len(raw)) + row * (DEPTH + 1) + DEPTH
    out[at] = LOWER[raw]
    ends = off[1:] + np.arange(n) * (DEPTH + 1) + DEPTH
    return out, np.sort(np.concatenate([at, ends]))


def _grams(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Context and next byte of each position as one number, the oldest byte on top."""
    code = np.zeros(len(at), np.uint64)
    for j in range(DEPTH, -1, -1):
        code = (code << np.uint64(8)) | text[at - j].astype(np.uint64)
    return code


def _add(total: tuple[np.ndarray, np.ndarray], more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Adds the codes ``more``, with repeats, to (ascending codes, counts)."""
    if not len(more):
        return total
    more = np.sort(more)
    first = np.flatnonzero(np.append(True, more[1:] != more[:-1]))
    key, n = more[first], np.diff(np.append(first, len(more)))
    have, count = total
    at = np.searchsorted(have, key)
    hit = np.zeros(len(key), bool)
    hit[at < len(have)] = have[at[at < len(have)]] == key[at < len(have)]
    count[at[hit]] += n[hit]
    return np.insert(have, at[~hit], key[~hit]), np.insert(count, at[~hit], n[~hit])


def _counter(codes):
    """A map over batches whose first column is text: (code, n) of ``codes(bytes, offsets)``, summed
    within the task in pieces of bounded size."""
    def run(batches):
        none = (np.empty(0, np.uint64), np.empty(0, np.int64))
        total, held, size = none, [], 0
        for batch in batches:
            for _, _, raw, off in blocks(batch.column(0)):
                held.append(codes(raw, off))
                size += len(held[-1])
                if size > PIECE:
                    total, held, size = _add(total, np.concatenate(held)), [], 0
                    if len(total[0]) > PIECE:
                        yield _rows(total)
                        total = none
        if held:
            total = _add(total, np.concatenate(held))
        yield _rows(total)
    return run


def _rows(total):
    return pa.RecordBatch.from_arrays([pa.array(total[0].view(np.int64)), pa.array(total[1])], ["code", "n"])


def _counted(texts: DataFrame, codes) -> DataFrame:
    return (map_arrow(texts.select("text"), _counter(codes), "code long, n long")
            .groupBy("code").agg(F.sum("n").alias("n")))


def gram_counts(texts: DataFrame) -> DataFrame:
    """(ctx, byte, n): how often each byte follows each context of DEPTH bytes in ``texts`` (text)."""
    return _counted(texts, lambda raw, off: _grams(*framed(raw, off))).select(
        F.shiftrightunsigned("code", 8).alias("ctx"), F.col("code").bitwiseAND(F.lit(255)).alias("byte"), "n")


def node_counts(grams: DataFrame) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
    """For each depth 0..DEPTH the contexts that are nodes (ascending), and where bytes follow
    them, node * 256 + byte and the count. At most NODE_SHARE nodes a depth come here."""
    total = grams.agg(F.sum("n")).first()[0] or 0
    nodes, keys, counts = [], [], []
    for d in range(DEPTH, -1, -1):
        if d < DEPTH:
            shorter = F.col("ctx").bitwiseAND(F.lit((1 << 8 * d) - 1))
            grams = materialize(grams.groupBy(shorter.alias("ctx"), "byte").agg(F.sum("n").alias("n")), f"depth-{d}")
        kept = (grams.groupBy("ctx").agg(F.sum("n").alias("all"))
                .where(F.col("all") * NODE_SHARE >= total).select("ctx"))
        got = grams.join(kept, "ctx").toArrow()
        ctx, byte, n = (got[c].to_numpy().astype(np.int64) for c in ("ctx", "byte", "n"))
        own = np.unique(ctx) if d or len(ctx) else np.zeros(1, np.int64)  # the root is always a node
        nodes.insert(0, own)
        keys.insert(0, np.searchsorted(own, ctx) * 256 + byte)
        counts.insert(0, n)
    return nodes, keys, counts


# ---- the tree -------------------------------------------------------------------------------

def _log_gamma(x: np.ndarray) -> np.ndarray:
    """log Gamma by Stirling's series, shifted up by seven."""
    shift = np.zeros_like(x)
    for i in range(7):
        shift += np.log(x + i)
    z = x + 7
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + 1 / (12 * z) - 1 / (360 * z ** 3) + 1 / (1260 * z ** 5) - shift


def kt_log(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of any order of a zeros and b ones."""
    return _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - _log_gamma(a + b + 1.0) - np.log(np.pi)


def bit_counts(byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(zeros, ones) at the 255 inner nodes 1..255 of the byte's binary path (index 0 unused), from
    counts of the 256 bytes; leading axes are kept."""
    ones = np.zeros(byte.shape)
    zeros = np.zeros(byte.shape)
    level = byte
    for depth in range(7, -1, -1):
        pair = level.reshape(*byte.shape[:-1], 1 << depth, 2)
        zeros[..., 1 << depth:2 << depth] = pair[..., 0]
        ones[..., 1 << depth:2 << depth] = pair[..., 1]
        level = pair.sum(-1)
    return zeros, ones


def byte_logs(one: np.ndarray) -> np.ndarray:
    """Log probability of the 256 bytes from the probability of a one at the inner nodes."""
    log = np.zeros((*one.shape[:-1], 1))
    for depth in range(8):
        p = one[..., 1 << depth:2 << depth]
        log = (log[..., None] + np.stack([np.log1p(-p), np.log(p)], -1)).reshape(*one.shape[:-1], 2 << depth)
    return log


@dataclass
class Model:
    """log10[state, byte] and the state after it; ``start`` is the state of a text's start."""
    log10: np.ndarray
    after: np.ndarray
    start: int


def _dense(key, n, rows) -> np.ndarray:
    out = np.zeros(rows * 256)
    out[key] = n
    return out.reshape(rows, 256)


def build(nodes: list[np.ndarray], keys: list[np.ndarray], counts: list[np.ndarray], step: int = 2048) -> Model:
    """The mixture over all depths as a table. A state is a node; its context's deeper bytes, if
    any, lead to the node that the rare contexts below it share."""
    parent = [np.zeros(0, np.int64)] + [
        np.searchsorted(nodes[d - 1], nodes[d] & ((1 << 8 * (d - 1)) - 1)) for d in range(1, DEPTH + 1)]
    byte = [_dense(k, n, len(c)) for k, n, c in zip(keys, counts, nodes)]
    # from the leaves: log P_w of each node and inner bit node, summed into its parent
    below: list = [np.zeros((len(nodes[d]), 256)) if d == DEPTH - 1 else None for d in range(DEPTH + 1)]
    weight: list = [None] * (DEPTH + 1)
    rest_counts: list = [None] * (DEPTH + 1)
    for d in range(DEPTH, -1, -1):
        if d < DEPTH:
            rest = byte[d].copy()
            np.subtract.at(rest, parent[d + 1], byte[d + 1])
            rest_counts[d] = np.maximum(rest, 0)
        w = np.ones((len(nodes[d]), 256), np.float32)
        for a in range(0, len(nodes[d]), step):
            part = slice(a, min(a + step, len(nodes[d])))
            own = kt_log(*bit_counts(byte[d][part]))
            mixed = own
            if d < DEPTH:
                deeper = (0 if below[d] is None else below[d][part]) + kt_log(*bit_counts(rest_counts[d][part]))
                mixed = np.logaddexp(own, deeper) + np.log(0.5)
                w[part] = np.exp(own + np.log(0.5) - mixed)
            if d:
                if below[d - 1] is None:
                    below[d - 1] = np.zeros((len(nodes[d - 1]), 256))
                np.add.at(below[d - 1], parent[d][part], mixed)
        weight[d], below[d] = w, None

    def kt(counts):
        zero, one = bit_counts(counts)
        return (one + 0.5) / (zero + one + 1.0)

    base = np.cumsum([0] + [len(c) for c in nodes])
    log10 = np.zeros((int(base[-1]), 256), np.float32)
    for d in range(DEPTH + 1):
        for a in range(0, len(nodes[d]), step):
            part = np.arange(a, min(a + step, len(nodes[d])))
            p = kt(byte[d][part] if d == DEPTH else rest_counts[d][part])
            at, e = part, d
            while e >= 0:
                if e < DEPTH:
                    w = weight[e][at]
                    p = w * kt(byte[e][at]) + (1 - w) * p
                at, e = parent[e][at] if e else at, e - 1
            log10[base[d] + part] = byte_logs(p) / LN10
    # the next state: the deepest node that ends the context and the byte
    after = np.zeros((int(base[-1]), 256), np.int32)
    for d in range(DEPTH + 1):
        longer = (nodes[d][:, None] << 8) | np.arange(256)
        for e in range(0, min(d + 1, DEPTH) + 1):
            want = longer & ((1 << 8 * e) - 1)
            at = np.minimum(np.searchsorted(nodes[e], want), max(len(nodes[e]) - 1, 0))
            if len(nodes[e]):
                hit = nodes[e][at] == want
                block = after[base[d]:base[d + 1]]
                block[hit] = (base[e] + at)[hit]
    state = 0
    for _ in range(DEPTH):
        state = int(after[state, EDGE])
    return Model(log10, after, state)


def log10_of(model: Model, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """log10 probability of each text of a block, its end included."""
    n = len(off) - 1
    text, _ = framed(raw, off)
    ends = off[1:] + np.arange(n) * (DEPTH + 1) + DEPTH + 1  # of the framed texts
    starts = np.concatenate([[0], ends[:-1]]) + DEPTH
    pieces = -(-(ends - starts) // STRETCH)
    doc = np.repeat(np.arange(n), pieces)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    at = starts[doc] + nth * STRETCH
    left = np.minimum(STRETCH, ends[doc] - at)
    order = np.argsort(-left, kind="stable")
    doc, at, left = doc[order], at[order], left[order]
    state = np.zeros(len(at), np.int64)
    after, table = model.after.ravel(), model.log10.ravel()
    for j in range(DEPTH, 0, -1):
        state = after[state * 256 + text[at - j]].astype(np.int64)
    total = np.zeros(len(at))
    live = len(at)
    for j in range(int(left.max(initial=0))):
        live = int(np.searchsorted(-left[:live], -j, "left"))  # stretches longer than j
        k = state[:live] * 256 + text[at[:live] + j]
        total[:live] += table[k]
        state[:live] = after[k]
    return np.bincount(doc, total, n)[:n]


# ---- the whole tree in Spark ----------------------------------------------------------------

def _newest_first(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """As _grams with the newest byte on top, so that a shorter context is a prefix."""
    code = np.zeros(len(at), np.uint64)
    for j in (*range(1, DEPTH + 1), 0):
        code = (code << np.uint64(8)) | text[at - j].astype(np.uint64)
    return code


def tree_grams(training: DataFrame, others: DataFrame) -> DataFrame:
    """(code, n, uses): how often each code is in ``training`` and in both (text)."""
    def part(texts, learnt):
        return (map_arrow(texts.select("text"), _counter(lambda raw, off: _newest_first(*framed(raw, off))), "code long, n long")
                .select("code", F.col("n").alias("uses"), (F.col("n") * learnt).alias("n")))
    return (part(training, 1).unionByName(part(others, 0)).groupBy("code")
            .agg(F.sum("n").alias("n"), F.sum("uses").alias("uses")))


_SMALL = 1 << 16
_KT: list[np.ndarray] = []


def _kt_small(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """kt_log, by a table where the counts are small."""
    if not _KT:
        k = np.arange(_SMALL, dtype=float)
        _KT.extend([_log_gamma(k + 0.5), _log_gamma(k + 1.0)])
    all_ = a + b
    i, j, n = (np.where(all_ < _SMALL, x, 0).astype(np.int64) for x in (a, b, all_))
    out = _KT[0][i] + _KT[0][j] - _KT[1][n] - np.log(np.pi)
    if len(big := np.flatnonzero(all_ >= _SMALL)):
        out[big] = kt_log(a[big], b[big])
    return out


@dataclass
class Level:
    """Of one depth the bit nodes (context << 8 | node of the byte's path, ascending) with their zeros
    and ones, log P_w, and the weight of stopping there."""
    key: np.ndarray
    zero: np.ndarray
    one: np.ndarray
    log: np.ndarray
    weight: np.ndarray


def deepest(code: np.ndarray, n: np.ndarray) -> Level:
    """The level of depth DEPTH from ascending distinct codes with their counts."""
    ctx, byte = code >> 8 << 8, code & 255
    keys, zeros, ones = [], [], []
    for j in range(8):
        key, bit = ctx | (byte | 256) >> (8 - j), byte >> (7 - j) & 1
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
        keys.append(key[first])
        zeros.append(np.add.reduceat(n * (1 - bit), first) if len(first) else first)
        ones.append(np.add.reduceat(n * bit, first) if len(first) else first)
    key = np.concatenate(keys)
    order = np.argsort(key, kind="stable")
    zero, one = np.concatenate(zeros)[order].astype(float), np.concatenate(ones)[order].astype(float)
    return Level(key[order], zero, one, _kt_small(zero, one), np.ones(len(key)))


def mixed(key: np.ndarray, zero: np.ndarray, one: np.ndarray, below: np.ndarray) -> Level:
    """A level from its counts and the sum of log P_w of its children."""
    own = _kt_small(zero, one) + np.log(0.5)
    log = np.logaddexp(own, below + np.log(0.5))
    return Level(key, zero, one, log, np.exp(own - log))


def summed(x: Level) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Key, zeros, ones and log P_w of the children of each bit node one level up."""
    key, at = np.unique(x.key >> 16 << 8 | x.key & 255, return_inverse=True)
    return key, *(np.bincount(at, v, len(key)) for v in (x.zero, x.one, x.log))


def subtree(code: np.ndarray, n: np.ndarray) -> list[Level]:
    """The levels DEPTH..SPLIT of ascending codes that hold whole subtrees."""
    levels = [deepest(code[n > 0], n[n > 0])]
    while len(levels) <= DEPTH - SPLIT:
        levels.append(mixed(*summed(levels[-1])))
    return levels


def log10_of_codes(code: np.ndarray, levels: list[Level]) -> np.ndarray:
    """log10 probability of each code's byte after its context; ``levels`` from DEPTH to 0."""
    byte, out = code & 255, np.zeros(len(code))
    for j in range(8):
        u, p = (byte | 256) >> (8 - j), np.full(len(code), 0.5)
        for d, x in zip(range(DEPTH, -1, -1), levels):
            if not len(x.key):
                continue
            key = code >> 8 * (DEPTH + 1 - d) << 8 | u
            at = np.minimum(np.searchsorted(x.key, key), len(x.key) - 1)
            hit = np.flatnonzero(x.key[at] == key)  # where nothing was learnt p is a half at any depth
            at = at[hit]
            w = x.weight[at]
            p[hit] = w * (x.one[at] + 0.5) / (x.zero[at] + x.one[at] + 1) + (1 - w) * p[hit]
        out += np.log10(np.where(byte >> (7 - j) & 1, p, 1 - p))
    return out


def _chunks(batches):
    """Ascending rows (code, n, uses) in pieces of whole subtrees: a row of three packed columns, and
    the bit nodes of depth SPLIT - 1 with what the piece adds to them."""
    def row(part):
        code, n, _ = part
        up = summed(subtree(code, n)[-1])
        packed = [pa.array([x.tobytes()], pa.binary()) for x in part]
        lists = [pa.array([x.tolist()], pa.list_(t)) for x, t in zip(up, (pa.int64(), *[pa.float64()] * 3))]
        return pa.RecordBatch.from_arrays([*packed, *lists], ["code", "n", "uses", "key", "zero", "one", "log"])

    held: list = []
    for batch in batches:
        held.append([c.to_numpy() for c in batch.columns])
        if sum(len(x[0]) for x in held) > CHUNK:
            part = [np.concatenate(x) for x in zip(*held)]
            tree = part[0] >> 8 * (DEPTH + 1 - SPLIT)
            cut = int(np.searchsorted(tree, tree[-1], "left"))  # the last subtree may go on
            if cut:
                yield row([x[:cut] for x in part])
            held = [[x[cut:] for x in part]]
    if held:
        yield row([np.concatenate(x) for x in zip(*held)])


def gram_logs(training: DataFrame, others: DataFrame) -> DataFrame:
    """(code, uses, log): the log10 probability of every distinct code of ``training`` and ``others``
    (text), learnt from ``training``."""
    tree = F.shiftrightunsigned("code", 8 * (DEPTH + 1 - SPLIT))
    chunks = materialize(map_arrow(
        tree_grams(training, others).select("code", "n", "uses").repartition(tree).sortWithinPartitions("code"), _chunks,
        "code binary, n binary, uses binary, key array<long>, zero array<double>, one array<double>, log array<double>"), "trees")
    top = (chunks.select(F.inline(F.arrays_zip("key", "zero", "one", "log"))).groupBy("key")
           .agg(*(F.sum(c).alias(c) for c in ("zero", "one", "log"))).toArrow())
    key = top["key"].to_numpy()
    order = np.argsort(key)
    upper = [mixed(key[order], *(top[c].to_numpy()[order] for c in ("zero", "one", "log")))]
    while len(upper) < SPLIT:
        upper.append(mixed(*summed(upper[-1])))
    shared = training.sparkSession.sparkContext.broadcast(upper)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                code, n, uses = (np.frombuffer(batch.column(c)[i].as_buffer(), np.int64) for c in range(3))
                levels = [*subtree(code, n), *shared.value]
                for a in range(0, len(code), CHUNK):
                    part = code[a:a + CHUNK]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part), pa.array(uses[a:a + CHUNK]), pa.array(log10_of_codes(part, levels))], ["code", "uses", "log"])
    return map_arrow(chunks.select("code", "n", "uses"), run, "code long, uses long, log double")


_NONE = np.uint64((1 << 64) - 1)


def _home(code: np.ndarray, bits: int) -> np.ndarray:
    return (code * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int64)


def hash_table(code: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, values) of a table with open addresses, at most half full."""
    bits = max(4, int(2 * len(code)).bit_length())
    keys, values = np.full(1 << bits, _NONE), np.zeros(1 << bits)
    slot, left = _home(code, bits), np.arange(len(code))
    while len(left):
        free = np.flatnonzero(keys[slot] == _NONE)
        at, first = np.unique(slot[free], return_index=True)
        put = free[first]
        keys[at], values[at] = code[left[put]], value[left[put]]
        stay = np.ones(len(left), bool)
        stay[put] = False
        left, slot = left[stay], slot[stay] + 1 & (1 << bits) - 1
    return keys, values


def look_up(table: tuple[np.ndarray, np.ndarray], code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(value or 0, whether it is there) of each code."""
    keys, values = table
    slot = _home(code, len(keys).bit_length() - 1)
    have = keys[slot]
    hit = have == code
    out = np.where(hit, values[slot], 0.0)
    left = np.flatnonzero(~hit & (have != _NONE))
    while len(left):
        slot[left] = slot[left] + 1 & len(keys) - 1
        have = keys[slot[left]]
        got = left[have == code[left]]
        out[got], hit[got] = values[slot[got]], True
        left = left[(have != code[left]) & (have != _NONE)]
    return out, hit


def train(texts: DataFrame) -> Model:
    """The model of all ``texts`` (text). Without any it gives every byte a 256th."""
    return build(*node_counts(materialize(gram_counts(texts), "grams")))


# ---- words and scores -----------------------------------------------------------------------

def _word_codes(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    s, e, _ = word_spans(raw, off)
    return word_hashes(LOWER[raw], s, e)


def score(docs: DataFrame, frequent: int = FREQUENT, frequent_grams: int = FREQUENT_GRAMS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte of
    every row of ``docs`` (doc_id, text).

    Learnt from the rows that aren't held out. A text's tokens are its words, A-Z lowered, and
    one end, so an empty or null text has one token; score is the log10 probability of its
    lowered bytes and its end. Repeated rows score alike; a row without an id is scored as
    any other. If no row is learnt from, counts are 0 and bytes equally likely."""
    spark = docs.sparkSession
    texts = keyed_text(docs)
    training = texts.where(~held_out(F.col("doc_id")))
    words = materialize(_counted(training, _word_codes).withColumnRenamed("code", "word"), "words")
    ends = training.count()
    n_words, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    tokens, vocabulary = n_words + ends, distinct + (ends > 0)
    bottom = float(np.log10(tokens + vocabulary + 1)) if tokens else 0.0
    top = words.where(F.col("n") * frequent >= n_words).toArrow()
    key = top["word"].to_numpy()
    order = np.argsort(key)
    grams = materialize(gram_logs(training, texts.where(held_out(F.col("doc_id")))), "gram-logs").withColumn(
        "use", F.floor(F.log2("uses") * 8))
    use, room = 1 << 20, frequent_grams
    for r in grams.groupBy("use").count().orderBy(F.desc("use")).collect():
        if (room := room - r["count"]) < 0:
            break
        use = r.use
    hot = grams.where(F.col("use") >= use).select("code", "log").toArrow()
    shared = spark.sparkContext.broadcast((
        hash_table(hot["code"].to_numpy().astype(np.uint64), hot["log"].to_numpy()), key[order], np.log10(top["n"].to_numpy()[order] + 1.0), float(np.log10(ends + 1.0))))

    def run(batches):
        table, known, logs, end_log = shared.value

        def lists(parts):
            return pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0]] + [c[1:] + o for (c, _), o in zip(
                    parts, np.cumsum([0] + [len(x) for _, x in parts]))]), pa.int32()),
                pa.array(np.concatenate([x for _, x in parts]) if parts else np.empty(0, np.int64)))
        for batch in batches:
            ids, cols = batch.column(0), [[] for _ in range(7)]
            for a, b, raw, off in blocks(batch.column(1)):
                s, e, doc = word_spans(raw, off)
                w = word_hashes(LOWER[raw], s, e).astype(np.int64)
                at = np.minimum(np.searchsorted(known, w), max(len(known) - 1, 0))
                hit = known[at] == w if len(known) else np.zeros(len(w), bool)
                cut = np.searchsorted(doc[~hit], np.arange(b - a + 1))
                code = _newest_first(*framed(raw, off))
                log, there = look_up(table, code)
                row = np.repeat(np.arange(b - a), np.diff(off) + 1)
                for col, x in zip(cols, (
                        np.bincount(doc, minlength=b - a)[:b - a] + 1,
                        np.bincount(doc[hit], minlength=b - a)[:b - a],
                        np.bincount(doc[hit], logs[at[hit]] if len(known) else None, b - a)[:b - a] + end_log,
                        np.bincount(row, log, b - a), np.diff(off))):
                    col.extend(x.tolist())
                cols[5].append((cut, w[~hit]))
                cols[6].append((np.searchsorted(row[~there], np.arange(b - a + 1)), code[~there].view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array(c, t) for c, t in zip(cols[:5], (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()))),
                 lists(cols[5]), lists(cols[6])], ["doc_id", "n_tokens", "hits", "logs", "score", "bytes", "rest", "rest_grams"])

    rows = materialize(map_arrow(texts, run, "doc_id long, n_tokens long, hits long, logs double, score double, bytes long, "
                                 "rest array<long>, rest_grams array<long>").withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = (rows.select("row", F.explode("rest").alias("word")).join(words, "word")
            .groupBy("row").agg(F.count("*").alias("more"), F.sum(F.log10(F.col("n") + 1.0)).alias("more_logs")))
    rare_grams = (rows.select("row", F.explode("rest_grams").alias("code"))
                  .join(grams.where(F.col("use") < use).select("code", "log"), "code")
                  .groupBy("row").agg(F.sum("log").alias("more_score")))
    scored = F.col("score") + F.coalesce("more_score", F.lit(0.0))
    return (rows.drop("rest", "rest_grams").join(rare, "row", "left").join(rare_grams, "row", "left").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens",
        (F.col("hits") + F.coalesce("more", F.lit(0)) + F.lit(int(ends > 0))).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(bottom)).alias("base_score"),
        scored.alias("score"), (-scored / F.log10(F.lit(2.0)) / (F.col("bytes") + 1)).alias("bits_per_byte")))

