"""Secret scans with a recursive decoding worklist.

A text is scanned as it is, then unwrapped: URL escapes, Unicode escapes, base64 runs, and
compressed bytes within them become new layers, which are scanned and unwrapped in turn until
nothing new comes up. Every layer carries a map from its characters to the original's, so a
secret found in any layer has a span of the original text. A layer or unfolded content seen
before at the same place ends its branch (cycle detection).

The worklist is a stack of generators, so that layers nested however deep need no recursion
and only one branch is held at a time. What compressed bytes unfold to is read as a stream:
above ``KEPT`` bytes it is unfolded again for each look and read in pieces, cut where no
secret and no wrapping can go on, so memory doesn't grow with it.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, keyed_text, map_arrow

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
MIN_ASSIGN, MIN_ACCESS = 8, 16
URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|\\u\{[0-9A-Fa-f]{1,6}\})+")
UNICODE_ONE = re.compile(r"\\(?:u\{([0-9A-Fa-f]+)\}|u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|x([0-9A-Fa-f]{2}))")
#: A run may go on over line ends and the next line's indent.
BASE64 = re.compile(r"[A-Za-z0-9+/_-](?:(?:\r?\n[ \t]*)?[A-Za-z0-9+/_-]){15,}")
_BREAK = re.compile(r"[\r\n \t]+")
#: Characters of a stretch within other bytes, at least; no secret is shorter.
MIN_STRETCH = 14
_CHAR = r"[^\x00-\x08\x0e-\x1f\x7f\ud800-\udfff]"
_ANY, _STRETCH = re.compile(_CHAR + "+"), re.compile(_CHAR + "{%d,}" % MIN_STRETCH)
#: Where compressed bytes may begin within others.
_MAGIC = re.compile(rb"\x1f\x8b\x08|BZh[1-9]|\xfd7zXZ\x00|\x78[\x01\x5e\x9c\xda]")
#: Unfolded bytes up to so many are kept; more are read as a stream, in chunks and pieces of about these sizes.
KEPT, CHUNK, PIECE = 8 << 20, 1 << 20, 4 << 20
#: Bytes of a possible stream that are tried before all of it.
TRIED = 1 << 14
#: A byte that is in no secret and no wrapping: text may be cut after it.
_CUT = re.compile(rb"[^A-Za-z0-9+/_.=:%\\\\\"'{}\s\x80-\xff]")
#: Bytes of which at least one run of 16 is needed by access, hex and base64 (which may go over lines).
_RUN = np.zeros(256, bool)
_RUN[[*range(48, 58), *range(65, 91), *range(97, 123), *b"+/_-\r\n"]] = True
_MARK = np.zeros(256, bool)
_MARK[[*b"=:%\\"]] = True


def scan(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the secrets of one layer, by start, then kind as listed."""
    out = []
    if "=" in text or ":" in text:
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return in_order(out)


def in_order(spans) -> list[tuple[str, int, int]]:
    return sorted(set(spans), key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


class Layer:
    """A text whose character i stands for ``[start[i], end[i])`` of the original; one number
    in place of a map stands for all characters."""

    def __init__(self, text: str, start: np.ndarray | int, end: np.ndarray | int, path: tuple[str, ...] = ()):
        self.text, self.start, self.end, self.path = text, start, end, path

    def origin(self, a: int, b: int) -> tuple[int, int]:
        if isinstance(self.start, int):
            return self.start, self.end
        return int(self.start[a]), int(self.end[b - 1])

    def origins(self, a: np.ndarray, b: np.ndarray):
        """Maps of characters that stand for ``[a, b)`` of this layer."""
        return (self.start, self.end) if isinstance(self.start, int) else (self.start[a], self.end[b - 1])


def _characters(data: bytes, base: int) -> list[tuple[str, int, int]]:
    """(character, first, end) byte offsets, from ``base``, of readable UTF-8."""
    out = []
    for c in data.decode("utf-8"):
        size = len(c.encode())
        out.append((c, base, base + size))
        base += size
    return out


def _stretches(data: bytes, pattern: re.Pattern) -> Iterator[tuple[bytes, int]]:
    """The bytes of each stretch of readable UTF-8, and where it begins."""
    text, base, last = data.decode("utf-8", "surrogateescape"), 0, 0
    for m in pattern.finditer(text):
        base += len(text[last:m.start()].encode("utf-8", "surrogateescape"))
        part = m[0].encode()
        yield part, base
        base, last = base + len(part), m.end()


def _parts(data: bytes) -> list[tuple[bytes, int]]:
    """All of the bytes if they are readable, or else the stretches of MIN_STRETCH characters."""
    whole = list(_stretches(data, _ANY))
    return whole if len(whole) == 1 and whole[0][0] == data else list(_stretches(data, _STRETCH))


def _readable(data: bytes) -> tuple[str, np.ndarray, np.ndarray]:
    """Text, first and end byte of each character of the readable UTF-8 of the bytes: all of them,
    or the stretches of MIN_STRETCH characters, a NUL, which no pattern takes, after each."""
    text, first, end = [], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for part, a in _parts(data):
        begins = np.flatnonzero(np.frombuffer(part, np.uint8) & 0xC0 != 0x80) + a
        ends = np.append(begins[1:], a + len(part))
        if len(part) < len(data):
            part, begins, ends = part + b"\0", np.append(begins, begins[-1]), np.append(ends, ends[-1])
        text.append(part.decode())
        first.append(begins)
        end.append(ends)
    return "".join(text), np.concatenate(first), np.concatenate(end)


class Broken(Exception):
    """Bytes that are no compressed stream, or not all of one."""


_FORMS = ((b"\x1f\x8b", lambda: zlib.decompressobj(31)), (b"BZh", bz2.BZ2Decompressor),
          (b"\xfd7zXZ\0", lambda: lzma.LZMADecompressor(lzma.FORMAT_XZ)))


def _form(head: bytes):
    """A decompressor for bytes that begin so, or None."""
    for magic, new in _FORMS:
        if head.startswith(magic):
            return new()
    if len(head) > 2 and head[0] == 0x78 and (head[0] << 8 | head[1]) % 31 == 0:
        return zlib.decompressobj(15)
    return None


def _unfold(chunks: Iterator[bytes], taken: list[int]) -> Iterator[bytes]:
    """What the compressed stream at the beginning of ``chunks`` unfolds to, in chunks; members
    joined one after another unfold as one. ``taken`` gets the number of bytes after each whole
    member. Raises Broken if the first member isn't whole; a later one that isn't ends it."""
    data, used = b"", 0
    while True:
        while len(data) < 6 and (more := next(chunks, b"")):
            data += more
        z = _form(data)
        if z is None:
            if not taken:
                raise Broken
            return
        try:
            while not z.eof:
                if isinstance(z, (bz2.BZ2Decompressor, lzma.LZMADecompressor)):
                    if z.needs_input and not data:
                        data = next(chunks, b"")
                    if z.needs_input and not data:
                        raise EOFError
                    size, out = len(data), z.decompress(data, CHUNK)
                    data = b""
                else:
                    if not data:
                        data = next(chunks, b"")
                    if not data:
                        raise EOFError
                    size, out = len(data), z.decompress(data, CHUNK)
                    data = z.unconsumed_tail
                    size -= len(data)
                used += size
                if out:
                    yield out
        except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError) as e:
            if not taken:
                raise Broken from e
            return
        data = z.unused_data + (data if z.unused_data is not data else b"")
        used -= len(z.unused_data)
        taken.append(used)


class Content:
    """Bytes that can be read again and again: kept ones, or those that another content's bytes
    from ``at`` on unfold to."""

    def __init__(self, kept: bytes | None, parent: Content | None = None, at: int = 0):
        self.kept, self.parent, self.at = kept, parent, at

    def chunks(self, at: int = 0) -> Iterator[bytes]:
        if self.kept is not None:
            view = memoryview(self.kept)
            for a in range(at, len(view), CHUNK):
                yield bytes(view[a:a + CHUNK])
            return
        for chunk in _unfold(self.parent.chunks(self.at), []):
            if at < len(chunk):
                yield chunk[at:]
            at = max(0, at - len(chunk))


def _opened(parent: Content, at: int, head: bytes) -> tuple[Content, int, bytes] | None:
    """The content of the stream that begins at ``at`` of ``parent`` with the bytes ``head``, the
    bytes it takes, and its digest; None if there is no whole stream."""
    try:
        for _ in _unfold(iter([head]), []):
            break
    except Broken as e:
        if len(head) < TRIED or not isinstance(e.__cause__, EOFError):
            return None
    taken: list[int] = []
    digest, kept, size = hashlib.sha1(), [], 0
    try:
        for chunk in _unfold(parent.chunks(at), taken):
            digest.update(chunk)
            size += len(chunk)
            if size <= KEPT:
                kept.append(chunk)
    except Broken:
        return None
    whole = b"".join(kept) if size <= KEPT else None
    return Content(whole, parent, at), taken[-1], digest.digest()


def _pieces(content: Content) -> Iterator[tuple[int, bytes]]:
    """(first byte, bytes) of pieces of a content, cut where no secret and no wrapping can go on."""
    if content.kept is not None:
        yield 0, content.kept
        return
    at, held, searched = 0, bytearray(), 0
    for chunk in content.chunks():
        held += chunk
        if len(held) < PIECE:
            continue
        cut = max((m.end() for m in _CUT.finditer(held, searched)), default=0)
        searched = len(held)
        if cut:
            yield at, bytes(held[:cut])
            at += cut
            del held[:cut]
            searched = len(held)
    if held:
        yield at, bytes(held)


def _unfolded(data: Content, origin, path: tuple[str, ...], seen: set) -> Iterator:
    """The layers of the compressed bytes that begin anywhere in ``data``, and the generator that
    goes on within each; these stand for their container as a whole, ``origin(first byte, end
    byte)``. Content seen before at its place gives nothing."""
    end, carry = 0, b""
    path = (*path, "compressed")
    for first, piece in _pieces(data):
        block, base = carry + piece, first - len(carry)
        starts = {m.start() for m in _MAGIC.finditer(block)} | ({0} if first == 0 else set())
        for at in sorted(starts):
            if base + at < end or _form(block[at:at + 6]) is None:
                continue
            got = _opened(data, base + at, block[at:at + TRIED])
            if got is None:
                continue
            inner, size, digest = got
            end = base + at + size
            lo, hi = origin(base + at, end)
            if ("content", digest, lo, hi) in seen:
                continue
            seen.add(("content", digest, lo, hi))
            for _, part in _pieces(inner):
                if text := "\0".join(x.decode() for x, _ in _parts(part)):
                    yield Layer(text, lo, hi, path)
            yield _unfolded(inner, lambda a, b, lo=lo, hi=hi: (lo, hi), path, seen)
        carry = block[-5:]  # a magic may lie across two pieces


def _base64(layer: Layer, m: re.Match, seen: set) -> Iterator:
    """The layers of one run, read from each of its first four characters: what is before the
    encoded text may be of any length."""
    if "\n" in m[0]:
        at = np.array([m.start() + i for i, c in enumerate(m[0]) if not c.isspace()])
        run = _BREAK.sub("", m[0])
    else:
        at, run = np.arange(m.start(), m.end()), m[0]
    run = run.replace("-", "+").replace("_", "/")
    path = (*layer.path, "base64")
    for k in range(4):
        part = run[k:]
        if len(part) % 4 == 1:
            part = part[:-1]
        data = base64.b64decode(part + "=" * (-len(part) % 4))

        def origin(a: int, b: int, k=k) -> tuple[int, int]:
            return layer.origin(at[k + 4 * a // 3], at[k + (8 * (b - 1) + 7) // 6] + 1)
        yield from _unfolded(Content(data), origin, path, seen)
        text, first, end = _readable(data)
        if text:
            yield Layer(text, *layer.origins(at[k + 4 * first // 3], at[k + (8 * (end - 1) + 7) // 6] + 1), path)


def _rewritten(layer: Layer, pattern: re.Pattern, decode, name: str) -> Iterator[Layer]:
    """The whole layer with each match of ``pattern`` replaced by ``decode(match)``, a list of
    (character, first, end) offsets within the layer, or None to leave it."""
    text, first, end, last = [], [], [], 0

    def keep(b: int) -> None:
        text.append(layer.text[last:b])
        first.append(np.arange(last, b, dtype=np.int32))
        end.append(np.arange(last + 1, b + 1, dtype=np.int32))
    for m in pattern.finditer(layer.text):
        if (new := decode(m)) is None:
            continue
        keep(m.start())
        text.append("".join(c for c, _, _ in new))
        first.append(np.array([a for _, a, _ in new], np.int32))
        end.append(np.array([b for _, _, b in new], np.int32))
        last = m.end()
    if text:
        keep(len(layer.text))
        yield Layer("".join(text), *layer.origins(np.concatenate(first), np.concatenate(end)), (*layer.path, name))


def _url(m: re.Match):
    """Bytes that aren't readable stay escaped."""
    data, last = binascii.unhexlify(m[0].replace("%", "")), 0
    out: list[tuple[str, int, int]] = []

    def kept(a: int, b: int):
        return [(m.string[i], i, i + 1) for i in range(m.start() + 3 * a, m.start() + 3 * b)]
    for part, at in _stretches(data, _ANY):
        out += kept(last, at)
        out += [(c, m.start() + 3 * a, m.start() + 3 * b) for c, a, b in _characters(part, at)]
        last = at + len(part)
    return out + kept(last, len(data)) if last else None


def _unicode(m: re.Match):
    """Escapes that are no character stay as they are."""
    out: list[tuple[str, int, int]] = []
    for x in UNICODE_ONE.finditer(m[0]):
        code = int(next(g for g in x.groups() if g), 16)
        a, b = m.start() + x.start(), m.start() + x.end()
        if 0xDC00 <= code < 0xE000 and out and 0xD800 <= ord(out[-1][0]) < 0xDC00:
            high, a, _ = out.pop()
            code = 0x10000 + ((ord(high) - 0xD800) << 10) + (code - 0xDC00)
        out.append((chr(code) if code <= 0x10FFFF else "\ud800", a, b))
    lone = [0xD800 <= ord(c) < 0xE000 for c, _, _ in out]
    if all(lone):
        return None
    return [y for x, bad in zip(out, lone) for y in ([(m.string[i], i, i + 1) for i in range(x[1], x[2])] if bad else [x])]


def _escaped_bytes(m: re.Match) -> tuple[bytes, list[int]] | None:
    """The bytes that escapes below 256 stand for, and where each begins (and the end)."""
    found = list(UNICODE_ONE.finditer(m[0]))
    codes = [int(next(g for g in x.groups() if g), 16) for x in found]
    return (bytes(codes), [m.start() + x.start() for x in found] + [m.end()]) if max(codes) < 256 else None


def unwrap(layer: Layer, seen: set) -> Iterator:
    """The layers one step below, and generators of more."""
    text = layer.text
    if "%" in text:
        yield from _rewritten(layer, URL, _url, "url")
        for m in URL.finditer(text):  # escaped bytes that are compressed
            yield from _unfolded(Content(binascii.unhexlify(m[0].replace("%", ""))),
                                 lambda a, b, m=m: layer.origin(m.start() + 3 * a, m.start() + 3 * b),
                                 (*layer.path, "url"), seen)
    if "\\" in text:
        yield from _rewritten(layer, UNICODE, _unicode, "unicode")
        for m in UNICODE.finditer(text):
            if got := _escaped_bytes(m):
                yield from _unfolded(Content(got[0]), lambda a, b, at=got[1]: layer.origin(at[a], at[b]),
                                     (*layer.path, "unicode"), seen)
    for m in BASE64.finditer(text):
        yield from _base64(layer, m, seen)


def find_secrets(text: str) -> tuple[list, list]:
    """(base, found): (kind, start, end) spans of the text as it is, and those that only its
    decoded layers show as (kind, start, end, path of decodings), both in order."""
    base = scan(text)
    n = len(text)
    seen: set = set()
    known, found = set(base), {}
    todo = [unwrap(Layer(text, np.arange(n, dtype=np.int32), np.arange(1, n + 1, dtype=np.int32)), seen)]
    while todo:
        layer = next(todo[-1], None)
        if layer is None:
            todo.pop()
        elif not isinstance(layer, Layer):
            todo.append(layer)
        else:
            mark = (hashlib.sha1(layer.text.encode()).digest(), *layer.origin(0, len(layer.text)))
            if mark in seen:
                continue
            seen.add(mark)
            for kind, a, b in scan(layer.text):
                span = (kind, *layer.origin(a, b))
                if span not in known:
                    known.add(span)
                    found[span] = "/".join(layer.path)
            todo.append(unwrap(layer, seen))
    return base, [(*s, found[s]) for s in in_order(found)]


def may_hold(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Which texts of a block need a look: every secret and every wrapping needs one of
    ``= : % \\`` or a run of 16 letters, digits or ``+/_-``."""
    got = np.zeros(len(off) - 1, bool)
    if not len(raw):
        return got
    got[np.searchsorted(off, np.flatnonzero(_MARK[raw]), "right") - 1] = True
    stops = np.concatenate([[-1], np.flatnonzero(~_RUN[raw]), [len(raw)]])
    # a run that joins several texts marks them all: a look too many, never one too few
    for at in np.flatnonzero(np.diff(stops) > 16).tolist():
        i, j = np.searchsorted(off, [stops[at] + 1, stops[at + 1] - 1], "right") - 1
        got[i:j + 1] = True
    return got


SPANS = "array<struct<kind:string,start:int,end:int>>"
FOUND = "array<struct<kind:string,start:int,end:int,path:string>>"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
_FOUND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("path", pa.string())]))


def _look(text) -> Iterator[tuple[list, list]]:
    """(base, found) of each text of an Arrow column."""
    for a, _, raw, off in blocks(text):
        for i, look in enumerate(may_hold(raw, off).tolist()):
            yield find_secrets(text[a + i].as_py() or "") if look else ([], [])


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, base, found of every whole text of ``docs`` (doc_id, text). ``base`` holds the
    spans of the text as it is, ``found`` those of decoded layers alone with the path of
    decodings. Offsets are code points, ends exclusive. A null text counts as empty and has no
    spans; repeated rows are scanned alike; other columns don't matter, whatever their names."""
    def run(batches):
        for batch in batches:
            both = list(_look(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0),
                 pa.array([[dict(zip(("kind", "start", "end"), s)) for s in x] for x, _ in both], _SPAN),
                 pa.array([[dict(zip(("kind", "start", "end", "path"), s)) for s in y] for _, y in both], _FOUND)],
                ["doc_id", "base", "found"])
    return map_arrow(keyed_text(docs), run, f"doc_id long, base {SPANS}, found {FOUND}")


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def ordered(kinds: tuple[str, ...], *spans: Column) -> Column:
    """All spans of several columns by start, then kind as listed, then end."""
    rank = F.array(*[F.lit(k) for k in kinds])
    merged = F.concat(*[F.transform(c, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(rank, s["kind"]).alias("rank"), s["end"].alias("end"),
        s["kind"].alias("kind"))) for c in spans])
    return F.array_sort(merged)


def digest_columns(found: DataFrame, kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """doc_id, a count of base spans for each kind, base_sha256 and spans (base and found)."""
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(k) for k in kinds],
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(ordered(kinds, F.col("base"), F.col("found"))).alias("spans"))


MASK = "[SECRET]"


def masked(text: str, spans, mask: str = MASK) -> str:
    """``text`` with each stretch of overlapping or touching spans replaced by one mask."""
    out, at = [], 0
    for _, a, b in sorted((x[:3] for x in spans), key=lambda x: x[1:]):
        if a > at or not out:
            out += [text[at:a], mask]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, mask: str = MASK) -> DataFrame:
    """``docs`` with every secret span of its texts replaced by ``mask`` and n_chars (if there)
    set to the new length. Texts without secrets, null ones too, and all other columns stay
    as they are, as does the number of rows."""
    names = docs.columns
    k, size = names.index("text"), names.index("n_chars") if "n_chars" in names else -1

    def run(batches):
        for batch in batches:
            cols, text = list(batch.columns), batch.column(k)
            if new := {i: masked(text[i].as_py(), [*x, *y], mask) for i, (x, y) in enumerate(_look(text)) if x or y}:
                cols[k] = pa.array([new[i] if i in new else t for i, t in enumerate(text.to_pylist())], text.type)
                if size >= 0:
                    cols[size] = pa.array([len(new[i]) if i in new else n for i, n in enumerate(cols[size].to_pylist())],
                                          cols[size].type)
            yield pa.RecordBatch.from_arrays(cols, names)
    return map_arrow(docs, run, docs.schema)

