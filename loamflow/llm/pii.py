"""Personal data: patterns, and a character-level bidirectional LSTM with CRF transitions.

The patterns' spans are the base, and on a bounded sample of windows they are the labels the
network learns from (numpy, on the driver). The network then reads every stretch of text
that can hold a kind: e-mail addresses hold ``@``, all other kinds digits, so it reads all
windows near one of these. Windows overlap; each is decoded by Viterbi, and a text's spans are
reconciled over all of its windows: a span cut by a window's edge yields to the window that
has it whole, and of spans in conflict the set of greatest total score stays.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from itertools import zip_longest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, keyed_text, map_arrow, materialize
from .secrets import _FOUND, _SPAN, FOUND, SPANS

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE = 96, 48
SAMPLE_WINDOWS = 1_500
EMBED, HIDDEN = 10, 16
EPOCHS, BATCH, RATE = 14, 50, 0.02
#: Tags: outside, then begin and inside of each kind.
TAGS = 1 + 2 * len(KINDS)
#: A span the network adds has at least this mean margin per character.
MIN_MARGIN = 1.0

_EMAIL_END = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# starting within a run of digits can't do better than starting with it
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    twice = [sum(divmod(2 * int(c), 10)) for c in digits[-2::-2]]
    return (sum(twice) + sum(map(int, digits[-1::-2]))) % 10 == 0


def _emails(text: str):
    """Each ``@`` with its whole run of local characters before it, in one pass."""
    end, at = 0, text.find("@")
    while at >= 0:
        m = _EMAIL_END.match(text, at + 1)
        start = at
        while m and start > end and text[start - 1] in _LOCAL:
            start -= 1
        if m and start < at:
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def patterns(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base spans, by start, then kind as listed."""
    out = [("email", a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return in_order(out)


def in_order(spans) -> list[tuple[str, int, int]]:
    return sorted(set(spans), key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


# ---- characters and windows -----------------------------------------------------------------

#: Character classes: each of these on its own, then digits, capitals, small letters, space, line
#: ends, other ASCII, other.
_OWN = "@.+-()_%:/,;"
CLASSES = len(_OWN) + 7
_CLASS = np.full(129, len(_OWN) + 5, np.int8)
for _i, _c in enumerate(_OWN):
    _CLASS[ord(_c)] = _i
_CLASS[48:58], _CLASS[65:91], _CLASS[97:123] = len(_OWN), len(_OWN) + 1, len(_OWN) + 2
_CLASS[[32, 9]], _CLASS[[10, 11, 12, 13]], _CLASS[128] = len(_OWN) + 3, len(_OWN) + 4, len(_OWN) + 6


def classes(text: str) -> np.ndarray:
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _CLASS[np.minimum(code, 128)]


def window_starts(cls: np.ndarray) -> np.ndarray:
    """Starts, multiples of STRIDE, of the windows within half a stride of a digit or ``@``."""
    at = np.flatnonzero((cls == 0) | (cls == len(_OWN)))
    if not len(at):
        return at
    lo = np.maximum(at - WINDOW + 1 - STRIDE // 2, -STRIDE) // STRIDE
    hi = (at + STRIDE // 2) // STRIDE
    w = np.unique(np.concatenate([np.minimum(lo + k, hi) for k in range(int((hi - lo).max()) + 1)]))
    return w[(w >= 0) & (w * STRIDE < max(len(cls), 1))] * STRIDE


def windows(cls: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(classes, lengths) of the windows; what is past the text's end counts as other."""
    at = starts[:, None] + np.arange(WINDOW)
    out = np.where(at < len(cls), cls[np.minimum(at, len(cls) - 1)], len(_OWN) + 6)
    return out.astype(np.int8), np.minimum(WINDOW, len(cls) - starts)


def tag_row(spans, start: int) -> np.ndarray:
    """The tags of one window."""
    row = np.zeros(WINDOW, np.int8)
    for kind, a, b in spans:
        k = 1 + 2 * KINDS.index(kind)
        lo, hi = max(a - start, 0), min(b - start, WINDOW)
        if lo < hi and not row[lo:hi].any():
            row[lo:hi] = k + 1
            if a >= start:
                row[lo] = k
    return row


# ---- the network ----------------------------------------------------------------------------

@dataclass
class Network:
    """Embedding, two LSTMs, emission weights and CRF transitions."""
    p: dict[str, np.ndarray]

    @staticmethod
    def fresh(seed: int = 5) -> Network:
        r = np.random.default_rng(seed)
        p = {"embed": r.normal(0, 0.3, (CLASSES, EMBED)), "out": r.normal(0, 0.2, (2 * HIDDEN, TAGS)), "out_b": np.zeros(TAGS),
             "trans": np.zeros((TAGS, TAGS)), "first": np.zeros(TAGS)}
        for d in "fb":
            p[f"w{d}"] = r.normal(0, 0.25, (EMBED + HIDDEN, 4 * HIDDEN))
            p[f"b{d}"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
        return Network({k: v.astype(np.float32) for k, v in p.items()})

    def _lstm(self, x: np.ndarray, d: str, keep: bool):
        """Hidden states (time, batch, HIDDEN) of inputs (time, batch, EMBED)."""
        w, b = self.p[f"w{d}"], self.p[f"b{d}"]
        t, n, _ = x.shape
        pre = (x.reshape(t * n, -1) @ w[:EMBED] + b).reshape(t, n, -1)
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        out, tape = np.empty((t, n, HIDDEN), np.float32), []
        for i in range(t):
            z = pre[i] + h @ w[EMBED:]
            g = np.tanh(z[:, 3 * HIDDEN:])
            s = 0.5 + 0.5 * np.tanh(0.5 * z[:, :3 * HIDDEN])
            gi, gf, go = s[:, :HIDDEN], s[:, HIDDEN:2 * HIDDEN], s[:, 2 * HIDDEN:]
            before, c0 = h, c
            c = gf * c + gi * g
            tc = np.tanh(c)
            h = go * tc
            out[i] = h
            if keep:
                tape.append((before, c0, gi, gf, go, g, tc))
        return out, tape

    def emissions(self, cls: np.ndarray, keep: bool = False):
        """(time, batch, TAGS) scores of windows (batch, time) of classes."""
        x = self.p["embed"][cls.T]
        f, tape_f = self._lstm(x, "f", keep)
        b, tape_b = self._lstm(x[::-1], "b", keep)
        both = np.concatenate([f, b[::-1]], 2)
        return both @ self.p["out"] + self.p["out_b"], (x, both, tape_f, tape_b)

    def _lstm_back(self, x, tape, dh, d, grad):
        w = self.p[f"w{d}"]
        t, n, _ = x.shape
        gw, gb = np.zeros_like(w), np.zeros(4 * HIDDEN, np.float32)
        dx = np.empty_like(x)
        next_h, next_c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        for i in range(t - 1, -1, -1):
            before, c0, gi, gf, go, g, tc = tape[i]
            h = dh[i] + next_h
            c = next_c + h * go * (1 - tc * tc)
            dz = np.concatenate([c * g * gi * (1 - gi), c * c0 * gf * (1 - gf), h * tc * go * (1 - go), c * gi * (1 - g * g)], 1)
            gw[:EMBED] += x[i].T @ dz
            gw[EMBED:] += before.T @ dz
            gb += dz.sum(0)
            back = dz @ w.T
            dx[i], next_h, next_c = back[:, :EMBED], back[:, EMBED:], c * gf
        grad[f"w{d}"], grad[f"b{d}"] = gw, gb
        return dx

    def loss(self, cls: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of the tag rows, and its gradient."""
        e, (x, both, tape_f, tape_b) = self.emissions(cls, keep=True)
        t, n, _ = e.shape
        tr, first, y = self.p["trans"], self.p["first"], tags.T.astype(np.int64)
        rows = np.arange(n)
        alpha = np.empty_like(e)
        alpha[0] = first + e[0]
        for i in range(1, t):
            alpha[i] = _lse(alpha[i - 1][:, :, None] + tr, 1) + e[i]
        z = _lse(alpha[-1], 1)
        gold = first[y[0]] + e[0][rows, y[0]]
        beta = np.zeros((n, TAGS), np.float32)
        de = np.empty_like(e)
        g_tr = np.zeros_like(tr)
        de[-1] = np.exp(alpha[-1] - z[:, None])
        for i in range(t - 1, 0, -1):
            ahead = e[i] + beta
            pair = np.exp(alpha[i - 1][:, :, None] + tr + (ahead - z[:, None])[:, None, :])
            g_tr += pair.sum(0)
            np.subtract.at(g_tr, (y[i - 1], y[i]), 1)
            gold = gold + tr[y[i - 1], y[i]] + e[i][rows, y[i]]
            beta = _lse(tr + ahead[:, None, :], 2)
            de[i - 1] = np.exp(alpha[i - 1] + beta - z[:, None])
        for i in range(t):
            de[i][rows, y[i]] -= 1
        grad = {"trans": g_tr, "first": de[0].sum(0)}
        flat = de.reshape(t * n, TAGS)
        grad["out"], grad["out_b"] = both.reshape(t * n, -1).T @ flat, flat.sum(0)
        dboth = de @ self.p["out"].T
        dx = self._lstm_back(x, tape_f, dboth[:, :, :HIDDEN], "f", grad)
        dx += self._lstm_back(x[::-1], tape_b, dboth[::-1, :, HIDDEN:], "b", grad)[::-1]
        g_embed = np.zeros_like(self.p["embed"])
        np.add.at(g_embed, cls.T.reshape(-1), dx.reshape(t * n, -1))
        grad["embed"] = g_embed
        return float((z - gold).mean()), {k: v / n for k, v in grad.items()}

    def decode(self, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags (batch, time) by Viterbi, and each character's margin: its emission for the
        tag over that for outside."""
        e, _ = self.emissions(cls)
        t, n, _ = e.shape
        best, back = self.p["first"] + e[0], np.empty((t, n, TAGS), np.int8)
        for i in range(1, t):
            via = best[:, :, None] + self.p["trans"]
            back[i] = via.argmax(1)
            best = via.max(1) + e[i]
        tags = np.empty((t, n), np.int64)
        tags[-1] = best.argmax(1)
        rows = np.arange(n)
        for i in range(t - 1, 0, -1):
            tags[i - 1] = back[i][rows, tags[i]]
        margin = np.take_along_axis(e, tags[:, :, None], 2)[:, :, 0] - e[:, :, 0]
        return tags.T, margin.T


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def fit(cls: np.ndarray, tags: np.ndarray, epochs: int = EPOCHS) -> Network:
    """Adam over shuffled batches of windows; the rate falls linearly."""
    net = Network.fresh()
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v = {k: np.zeros_like(x) for k, x in net.p.items()}
    rnd, step = np.random.default_rng(6), 0
    total = epochs * -(-len(cls) // BATCH)
    for _ in range(epochs):
        order = rnd.permutation(len(cls))
        for a in range(0, len(order), BATCH):
            at, step = order[a:a + BATCH], step + 1
            _, grad = net.loss(cls[at], tags[at])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            for k, g in grad.items():
                g = g * min(1.0, 5.0 / max(norm, 1e-9))
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.01 * (g * g - v[k])
                net.p[k] -= RATE * (1 - (step - 1) / total) * (m[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-6)
    return net


# ---- spans ----------------------------------------------------------------------------------

def window_spans(tags: np.ndarray, margin: np.ndarray, start: int, size: int, ends_text: bool):
    """(kind, start, end, score, whole) of one decoded window; a span that touches an edge of the
    window other than the text's own isn't whole."""
    out, i = [], 0
    tags = tags[:size]
    while i < size:
        if not tags[i]:
            i += 1
            continue
        kind, j = (int(tags[i]) - 1) // 2, i + 1
        while j < size and tags[j] == 2 * kind + 2:
            j += 1
        whole = (i > 0 or start == 0) and (j < size or ends_text)
        out.append((KINDS[kind], start + i, start + j, float(margin[i:j].sum()), whole))
        i = j
    return out


def reconcile(spans) -> list[tuple[str, int, int, float]]:
    """Of the spans of all windows of a text, the set without overlaps of greatest total score.
    A span that isn't whole takes part only if no whole one overlaps it."""
    best: dict[tuple[str, int, int], float] = {}
    whole = sorted({(a, b) for _, a, b, _, w in spans if w})
    starts = np.array([a for a, _ in whole])
    reach = np.maximum.accumulate([b for _, b in whole]) if whole else starts
    for kind, a, b, score, w in spans:
        if not w and whole:
            k = int(np.searchsorted(starts, b, "left"))
            if k and reach[k - 1] > a:
                continue
        best[kind, a, b] = max(best.get((kind, a, b), -np.inf), score)
    items = sorted(((b, a, kind, s) for (kind, a, b), s in best.items() if s > 0))
    ends = [x[0] for x in items]
    total, choice = [0.0], []
    for i, (b, a, kind, s) in enumerate(items):
        k = int(np.searchsorted(ends[:i], a, "right"))
        take = total[k] + s > total[i]
        total.append(max(total[i], total[k] + s))
        choice.append((take, k))
    out, i = [], len(items)
    while i:
        take, k = choice[i - 1]
        if take:
            b, a, kind, s = items[i - 1]
            out.append((kind, a, b, s))
            i = k
        else:
            i -= 1
    return out[::-1]


def plausible(kind: str, span: str) -> bool:
    """What any span of the kind holds at least."""
    digits = sum(c in "0123456789" for c in span)
    return {"email": "@" in span[1:-1], "ip": span.count(".") == 3 and digits >= 4,
            "card": digits >= 12, "phone": digits >= 7}[kind]


def _read(texts, net: Network | None):
    """(base, found) of each of some texts; windows of all of them are decoded together."""
    base, cut, cls, place = [], [], [], []
    for i, text in enumerate(texts):
        base.append(patterns(text))
        if net is not None:
            c = classes(text)
            starts = window_starts(c)
            if len(starts):
                w, sizes = windows(c, starts)
                cls.append(w)
                place += [(i, int(s), int(z), int(s + z) == len(c)) for s, z in zip(starts, sizes)]
    found: list[list] = [[] for _ in texts]
    if cls:
        cls = np.concatenate(cls)
        for a in range(0, len(cls), 512):
            tags, margin = net.decode(cls[a:a + 512])
            for k in np.flatnonzero(tags.any(1)).tolist():
                i, start, size, last = place[a + k]
                found[i] += window_spans(tags[k], margin[k], start, size, last)
    for i, text in enumerate(texts):
        known = [(a, b) for _, a, b in base[i]]
        cut.append([(kind, a, b, "bilstm-crf") for kind, a, b, score in reconcile(found[i])
                    if score >= MIN_MARGIN * (b - a) and plausible(kind, text[a:b])
                    and not any(a < y and x < b for x, y in known)])
    return base, cut


def _texts_with_signs(col):
    """(row, text) of the texts that hold a digit or ``@``."""
    for a, b, raw, off in blocks(col):
        at = np.flatnonzero((raw == 64) | (raw >= 48) & (raw < 58))
        for i in np.unique(np.searchsorted(off, at, "right") - 1).tolist():
            yield a + i, col[a + i].as_py() or ""


def strata(tags: np.ndarray) -> list[int]:
    """What a window is drawn for: each kind (1, 2, …) that it holds some of, or 0 for none."""
    return np.unique((tags[tags > 0].astype(np.int64) + 1) // 2).tolist() or [0]


def _sampler(sample: int):
    """A map over batches whose first column is text: (stratum, rank, cls, tags) of the task's
    ``sample`` distinct windows of smallest rank, a hash of the window, in each stratum."""
    def smallest(have: dict) -> dict:
        return dict(sorted(have.items())[:sample])

    def run(batches):
        held: list[dict] = [{} for _ in range(len(KINDS) + 1)]
        for batch in batches:
            for _, text in _texts_with_signs(batch.column(0)):
                c = classes(text)
                spans = patterns(text)
                starts = window_starts(c)
                w, _ = windows(c, starts)
                for s, x in zip(starts.tolist(), w):
                    tags = tag_row([p for p in spans if p[1] < s + WINDOW and p[2] > s], s)
                    row = x.tobytes(), tags.tobytes()
                    rank = int.from_bytes(hashlib.blake2b(b"".join(row), digest_size=8).digest(), "big") >> 1
                    for k in strata(tags):
                        held[k][rank, *row] = None
                        if len(held[k]) > 4 * sample + 1000:
                            held[k] = smallest(held[k])
        for k, have in enumerate(held):
            rows = list(smallest(have))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k] * len(rows), pa.int32()), pa.array([r[0] for r in rows], pa.int64()),
                 pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())],
                ["stratum", "rank", "cls", "tags"])
    return run


def draw(texts: DataFrame, sample: int) -> list[list[tuple[bytes, bytes]]]:
    """For each stratum the (cls, tags) of the ``sample`` distinct windows of smallest rank over all
    ``texts`` (text), by rank; or as many as there are."""
    rows = materialize(map_arrow(texts.select("text"), _sampler(sample),
                                 "stratum int, rank long, cls binary, tags binary"), "windows")
    bucket = F.shiftright("rank", 51)  # 4096 of them; whole buckets come here, as few as hold the sample
    count = (rows.select("stratum", "rank").distinct().groupBy("stratum", bucket.alias("bucket")).count()
             .orderBy("stratum", "bucket").collect())
    need, last = [sample] * (len(KINDS) + 1), [-1] * (len(KINDS) + 1)
    for r in count:
        if need[r.stratum] > 0:
            need[r.stratum] -= r["count"]
            last[r.stratum] = r.bucket
    got = (rows.where(bucket <= F.element_at(F.array(*map(F.lit, last)), F.col("stratum") + 1)).distinct()
           .orderBy("stratum", "rank", "cls", "tags").collect())
    return [[(bytes(r.cls), bytes(r.tags)) for r in got if r.stratum == k][:sample] for k in range(len(KINDS) + 1)]


def choose(drawn: list[list[tuple[bytes, bytes]]], sample: int) -> list[tuple[bytes, bytes]]:
    """At most ``sample`` of the drawn windows: half without a span, or what there is of these, and
    the rest from the kinds in turn, so that a kind with few windows leaves its turns to others."""
    none = drawn[0][:sample // 2]
    some: dict[tuple[bytes, bytes], None] = {}
    turns = [x for turn in zip_longest(*drawn[1:]) for x in turn if x is not None]
    for x in turns:
        if len(some) == sample - len(none):
            break
        some[x] = None
    return sorted([*none, *some]) if some else []


def train(texts: DataFrame, sample: int = SAMPLE_WINDOWS) -> Network | None:
    """A network from at most ``sample`` distinct windows near a digit or ``@``, those of smallest
    hash among the windows with a span of each kind and, for half of the sample, among those
    without any. None if no text has such a window with a span."""
    rows = choose(draw(texts, sample), sample)
    cls = np.array([np.frombuffer(x, np.int8) for x, _ in rows])
    tags = np.array([np.frombuffer(y, np.int8) for _, y in rows])
    return fit(cls, tags) if rows else None


def find_personal_data(docs: DataFrame, sample: int = SAMPLE_WINDOWS) -> DataFrame:
    """doc_id, base, found of every whole text of ``docs`` (doc_id, text): the patterns' spans and
    those that the network alone finds, apart from any base span. Offsets are code points,
    ends exclusive. A null text counts as empty and holds nothing; repeated rows are read
    alike. Without any base span to learn from, nothing is added."""
    texts = keyed_text(docs)
    net = docs.sparkSession.sparkContext.broadcast(train(texts, sample))

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            base, found = [[] for _ in range(n)], [[] for _ in range(n)]
            some = list(_texts_with_signs(batch.column(1)))
            for a in range(0, len(some), 64):
                part = some[a:a + 64]
                for (i, _), x, y in zip(part, *_read([t for _, t in part], net.value)):
                    base[i] = [dict(zip(("kind", "start", "end"), s)) for s in x]
                    found[i] = [dict(zip(("kind", "start", "end", "path"), s)) for s in y]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, _SPAN), pa.array(found, _FOUND)],
                                             ["doc_id", "base", "found"])
    return map_arrow(texts, run, f"doc_id long, base {SPANS}, found {FOUND}")
