"""N-gram Jaccard join by PartEnum signatures.

Documents are sets of word shingles. Two sets link at a Jaccard similarity of 4/5 or more,
that is at a Hamming distance of at most a ninth of their sizes' sum.

* Equal-size bands: linked sets lie in one size band or in two next to each other. Group g
  takes the sets of band g as its own and those of band g-1 as guests, and so has a greatest
  distance k. Pairs of one band meet in their own group, others in the larger set's.
* Partitions: each group divides the feature domain into n1 parts of n2 pieces by hash. k
  differences leave one part with at most k2 differing pieces, so two linked sets agree on
  some n2-k2 pieces of some part: a signature is the hash of a set's features in such a
  subset of pieces, and all of them are enumerated.
* Empty projections say nothing and would meet in huge groups. A set whose parts would take
  more differences than any of its partners has (see ``_spare``) is sure to share a signature
  that isn't empty, so it leaves out the empty ones; the others (few) emit them all. A guest
  picks only as many parts as its partners can't all differ on.

Sets are classed by their hash first: equal sets emit signatures once a task, and take part
in the join as one. Sets that share a signature are candidates. First each is verified against
the least set of the signature group it shares most signatures with; verified links make
components. What is left are pairs of one signature group in different components; they are
compared in blocks, where size, component and a lower bound of the distance rule out
nearly all without sending them on, and the rest are verified on their exact sets. A large
group's blocks are spread by hash, and two blocks of one component are never put together. So
no link between components is lost, and no group of copies is ever expanded into its pairs.

``jaccard_links`` gives the join itself: every link between two classes.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import (LOWER, blocks, free_name, id_filter, keyed_text, map_arrow, materialize, maybe_in, mix64,
                     ngram_hashes, utf8, word_hashes, word_spans)
from .components import connected_components

WORDS = 5
#: Jaccard threshold as a fraction.
NUM, DEN = 4, 5
#: Members of a signature group compared at once.
BLOCK = 256
#: Classes a task remembers, so as not to send their signatures again.
KEPT_CLASSES = 1 << 18
#: Slots of a set's sketch.
SKETCH = 256
FACTS = ("cls", "root", "n", "sketch")


def shingle_sets(raw: np.ndarray, off: np.ndarray, n: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a block; a text of fewer than ``n``
    words has its whole word sequence as its one shingle, one without words none."""
    s, e, doc = word_spans(raw, off)
    words = word_hashes(LOWER[raw], s, e)
    h, at = ngram_hashes(words, doc, n)
    cut = np.searchsorted(doc[at], np.arange(len(off)))
    first = np.searchsorted(doc, np.arange(len(off)))
    out = []
    for i in range(len(off) - 1):
        own = np.sort(h[cut[i]:cut[i + 1]])
        if len(own) > 1:
            own = own[np.append(True, own[1:] != own[:-1])]
        elif not len(own) and first[i + 1] > first[i]:
            w = words[first[i]:first[i + 1]]
            own = ngram_hashes(w, np.zeros(len(w), np.int64), len(w))[0]
        out.append(own)
    return out


def set_class(s: np.ndarray) -> int:
    """A 64-bit hash of a set, as a signed integer."""
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def band_edges(largest: int) -> list[int]:
    """Least sizes of the bands up to one past ``largest``: 5/4 of a band's largest size is less
    than the next band but one."""
    out = [1, 2]
    while out[-1] <= largest or len(out) < 3:
        out.append(max(out[-1] + 1, (out[-1] - 1) * DEN // NUM + 1))
    out.append(max(out[-1] + 1, (out[-1] - 1) * DEN // NUM + 1))
    return out


def distance(a, b):
    """Greatest Hamming distance of linked sets of these sizes."""
    return (a + b) * (DEN - NUM) // (DEN + NUM)


def scheme(k: int) -> tuple[int, int, int]:
    """(n1, n2, k2) for distance ``k``. Small sets enumerate pairs of pieces of the whole domain;
    middle ones two of three pieces of each part; for large ones, whose projections are
    selective enough, one piece a part makes fewest signatures. Some parts more than k asks
    for make up for empty ones."""
    if k <= 3:
        return 1, k + 2, k
    if k <= 12:
        return (k + 1) // 2 + 1, 3, 1
    return -(-(k + 1) * 21 // 20) + 2, 1, 0


def _spare(filled: np.ndarray, k2: int) -> np.ndarray:
    """How many differing pieces it takes at least to spoil every signature of a set that isn't
    empty. ``filled``: for each set and part, the number of pieces with features. A part is
    spoiled by k2+1 differing pieces, or by all its filled ones."""
    return np.minimum(filled, k2 + 1).sum(1)


def signatures(sets: list[np.ndarray], sizes: np.ndarray, edges: list[int], g: int,
               guest: bool) -> list[np.ndarray]:
    """Signatures in group ``g`` of sets that are its own (band g) or its guests (band g-1)."""
    top = edges[g + 1] - 1
    k = int(distance(top, top))
    n1, n2, k2 = scheme(k)
    pieces, n = n1 * n2, len(sets)
    x = mix64(np.concatenate(sets) + mix64(np.array([g + 1], np.uint64)))
    row = np.repeat(np.arange(n), sizes)
    piece = ((x >> np.uint64(32)) * np.uint64(pieces) >> np.uint64(32)).astype(np.int64)
    flat = row * pieces + piece
    total = np.zeros(n * pieces, np.uint64)
    np.add.at(total, flat, mix64(x))
    count = np.bincount(flat, minlength=n * pieces).reshape(n, n1, n2)
    code = mix64(total.reshape(n, n1, n2) + (np.arange(pieces, dtype=np.uint64).reshape(n1, n2) << np.uint64(32))
                 + np.uint64(g))
    far = distance(sizes, np.minimum(sizes * DEN // NUM, top))
    filled = (count > 0).sum(2)
    sure = _spare(filled, k2) > far
    if n2 == 1:
        sig, have = code[:, :, 0], count[:, :, 0]
        keep = (have > 0) | ~sure[:, None]
        if guest:  # any far+1 of its filled parts will do: those with most features
            order = np.argsort(-have, 1, kind="stable")
            rank = np.empty_like(order)
            np.put_along_axis(rank, order, np.arange(n1)[None, :].repeat(n, 0), 1)
            keep &= (rank <= far[:, None]) | ~sure[:, None]
    else:
        subsets = list(combinations(range(n2), n2 - k2))
        sig = np.concatenate([mix64(sum(code[:, :, q] for q in s) + np.uint64(j)) for j, s in enumerate(subsets)], 1)
        keep = np.concatenate([sum(count[:, :, q] for q in s) > 0 for s in subsets], 1) | ~sure[:, None]
    return [sig[i][keep[i]] for i in range(n)]


def all_signatures(sets: list[np.ndarray]) -> list[np.ndarray]:
    """For each set (none empty) the signatures of its own group and of the next one."""
    sizes = np.array([len(s) for s in sets])
    edges = band_edges(int(sizes.max()))
    band = np.searchsorted(edges, sizes, "right") - 1
    out: list[list[np.ndarray]] = [[] for _ in sets]
    for b in np.unique(band).tolist():
        at = np.flatnonzero(band == b)
        for lo in range(0, len(at), 512):
            part = at[lo:lo + 512]
            for g, guest in ((b, False), (b + 1, True)):
                for i, s in zip(part.tolist(), signatures([sets[j] for j in part], sizes[part], edges, g, guest)):
                    out[i].append(s)
    return [np.concatenate(o) for o in out]


def sketch(s: np.ndarray) -> bytes:
    """How many of a set's features fall into each of 256 slots, up to 15, two to a byte."""
    n = np.minimum(np.bincount((s >> np.uint64(56)).astype(np.int64), minlength=SKETCH), 15).astype(np.uint8)
    return (n[0::2] | n[1::2] << 4).tobytes()


def _slots(sketches) -> np.ndarray:
    """The slots of an Arrow array of sketches."""
    packed = utf8(sketches)[0].reshape(-1, SKETCH // 2)
    out = np.empty((len(packed), SKETCH), np.int8)
    out[:, 0::2], out[:, 1::2] = packed & 15, packed >> 4
    return out


def _classes(batches):
    """Two kinds of rows (kind, cls, codes): for each text its shingle count, its class (null
    without words) and its doc_id; for each class, once a task as long as it is remembered, -1
    and its signatures."""
    seen: set[int] = set()
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for a, b, raw, off in blocks(batch.column(1)):
            if len(seen) > KEPT_CLASSES:
                seen.clear()
            sets = shingle_sets(raw, off)
            cls = [set_class(s) if len(s) else None for s in sets]
            new = [i for i, c in enumerate(cls) if c is not None and c not in seen and not seen.add(c)]
            sigs = [s.astype(np.int64) for s in all_signatures([sets[i] for i in new])] if new else []
            kind = [len(s) for s in sets] + [-1] * len(new)
            codes = pa.ListArray.from_arrays(
                pa.array(np.cumsum([0] + [1] * len(sets) + [len(s) for s in sigs]), pa.int32()),
                pa.concat_arrays([pa.array(ids[a:b], pa.int64()), *map(pa.array, sigs)]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(kind, pa.int64()), pa.array(cls + [cls[i] for i in new], pa.int64()), codes],
                ["kind", "cls", "codes"])


def _full_sets(batches):
    """(cls, n, sketch, features) of every text with words; features cut to 48 bits."""
    for batch in batches:
        for _, _, raw, off in blocks(batch.column(1)):
            rows = {set_class(s): s for s in shingle_sets(raw, off) if len(s)}
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(rows), pa.int64()), pa.array([len(s) for s in rows.values()], pa.int32()),
                 pa.array([sketch(s) for s in rows.values()], pa.binary()),
                 pa.array([_packed(s) for s in rows.values()], pa.binary())], ["cls", "n", "sketch", "features"])


def _packed(s: np.ndarray) -> bytes:
    """The set's top 48 bits each, six bytes apiece, ascending."""
    return s.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), np.uint8)
    wide[:, 2:] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return wide.view(">u8").ravel().astype(np.uint64)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets link."""
    if not len(a) or not len(b):
        return False
    both = int(np.isin(a, b, assume_unique=True).sum()) if len(a) < 16 else int(
        (b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return DEN * both >= NUM * (len(a) + len(b) - both)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs`` (u, v) of classes whose sets link."""
    a = sets.select(F.col("cls").alias("u"), F.col("features").alias("a"))
    b = sets.select(F.col("cls").alias("v"), F.col("features").alias("b"))

    def run(batches):
        for batch in batches:
            last, left = None, None
            ok = []
            for u, x, y in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                if u != last:
                    last, left = u, _unpacked(x.as_py())
                ok.append(linked(left, _unpacked(y.as_py())))
            yield batch.select([1, 0]).filter(pa.array(ok, pa.bool_()))
    return map_arrow(pairs.join(b, "v").join(a, "u").select("v", "u", "a", "b"), run, "u long, v long")


#: Pairs a task remembers, so as not to send them again.
KEPT_PAIRS = 1 << 20
#: Each round looks at one of so many signatures, and pairs a class with so many members of a
#: group; the last looks at all, with all that are left.
ROUNDS = ((8, 8), (1, None))


def _near(pairs: DataFrame, turn: int, most: int | None) -> DataFrame:
    """Pairs (u, v) of classes between two blocks of a signature group (columns cls, root, n,
    sketch, their namesakes ending in 2, and same) that are of different components and that
    neither sizes nor sketches keep from linking; of each class at most ``most``, dealt by a
    hash of the pair and the turn."""
    def run(batches):
        sent = np.empty((0, 2), np.int64)
        for batch in batches:
            col = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            side = []
            for end in ("", "2"):
                flat = col["sketch" + end].flatten()
                side.append((col["cls" + end].offsets.to_numpy() - col["cls" + end].offsets[0].as_py(),
                             col["cls" + end].flatten().to_numpy(), col["root" + end].flatten().to_numpy(),
                             col["n" + end].flatten().to_numpy().astype(np.int64),
                             _slots(flat)))
            out = [np.empty((0, 2), np.int64)]
            for i, same in enumerate(col["same"].to_pylist()):
                (ca, ra, na, sa), (cb, rb, nb, sb) = ([x[o[i]:o[i + 1]] for x in rest] for o, *rest in side)
                ok = (ra[:, None] != rb) & (np.abs(na[:, None] - nb) <= distance(na[:, None], nb))
                if same:
                    ok = np.triu(ok, 1)
                p, q = np.nonzero(ok)
                for c in range(0, len(p), 8192):
                    x, y = p[c:c + 8192], q[c:c + 8192]
                    near = np.abs(sa[x] - sb[y]).sum(1) <= distance(na[x], nb[y])
                    got = np.stack([ca[x[near]], cb[y[near]]], 1)
                    if most is not None and len(got) > most:
                        got = _dealt(got, turn, most)
                    if len(got):
                        out.append(got)
            got = np.concatenate(out)
            got = np.unique(np.stack([got.min(1), got.max(1)], 1), axis=0) if len(got) else got
            if len(got):
                both = np.concatenate([sent, got])
                _, first = np.unique(both, axis=0, return_index=True)
                got = both[np.sort(first[first >= len(sent)])]
                sent = np.concatenate([sent, got])[-KEPT_PAIRS:]
            yield pa.RecordBatch.from_arrays([pa.array(got[:, 0]), pa.array(got[:, 1])], ["u", "v"])
    return map_arrow(pairs, run, "u long, v long").distinct()


def _dealt(pairs: np.ndarray, turn: int, most: int) -> np.ndarray:
    """Of each first class the ``most`` pairs of least hash."""
    h = mix64(pairs[:, 0].astype(np.uint64) ^ mix64(pairs[:, 1].astype(np.uint64) + np.uint64(turn)))
    pairs = pairs[np.lexsort((h, pairs[:, 0]))]
    start = np.flatnonzero(np.append(True, pairs[1:, 0] != pairs[:-1, 0]))
    rank = np.arange(len(pairs)) - np.repeat(start, np.diff(np.append(start, len(pairs))))
    return pairs[rank < most]


def _members_of(rows: DataFrame, *keys: str) -> DataFrame:
    """The classes of each group in one row, as arrays."""
    group = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*FACTS))).alias("m"))
    return group.select(*keys, *[F.col(f"m.{c}").alias(c) for c in FACTS])


def _block_pairs(large: DataFrame, facts: DataFrame, all_pairs: bool) -> DataFrame:
    """Pairs of blocks of each large signature group, as ``_near`` takes them; but for
    ``all_pairs`` only a block with itself and with the group's first.

    Components of a block's size or more have blocks of their own, the others share some; a
    class's block follows from counts and hashes, so no group is ranked in one task. Blocks
    that hold nothing but one and the same component are not paired. The pairs are
    found on the blocks' names; each block's classes are joined to them by that name."""
    counts = large.groupBy("sig", "root").agg(F.count("*").alias("m"))
    rest = counts.where(F.col("m") < BLOCK).groupBy("sig").agg(F.sum("m").alias("rest"))
    homes = counts.join(rest, "sig", "left")
    own = F.xxhash64("root", F.pmod(F.xxhash64("cls"), F.ceil(F.col("m") / BLOCK)))
    common = F.xxhash64(F.pmod(F.xxhash64("root"), F.ceil(F.col("rest") / BLOCK)))
    placed = (large.join(homes, ["sig", "root"])
              .withColumn("block", F.when(F.col("m") >= BLOCK, own).otherwise(common))
              .select("sig", "block", "cls", "root").join(facts, "cls"))
    filled = materialize(_members_of(placed, "sig", "block"), "blocks")
    names = filled.select("sig", "block", F.array_min("root").alias("lo"), F.array_max("root").alias("hi"))
    one = (F.col("a.lo") == F.col("a.hi")) & (F.col("b.lo") == F.col("b.hi")) & (F.col("a.lo") == F.col("b.lo"))
    pairs = (names.alias("a").join(names.alias("b"), (F.col("a.sig") == F.col("b.sig"))
                                   & (F.col("a.block") <= F.col("b.block")) & ~one)
             .select("a.sig", F.col("a.block").alias("x"), F.col("b.block").alias("y")))
    if not all_pairs:
        first = names.groupBy("sig").agg(F.min("block").alias("first"))
        pairs = pairs.join(first, "sig").where("x = y OR x = first").drop("first")
    left = filled.withColumnRenamed("block", "x")
    right = filled.select("sig", F.col("block").alias("y"), *[F.col(c).alias(c + "2") for c in FACTS])
    return (pairs.join(left, ["sig", "x"]).join(right, ["sig", "y"])
            .select(*FACTS, *[c + "2" for c in FACTS], (F.col("x") == F.col("y")).alias("same")))


def _candidates(labelled: DataFrame, facts: DataFrame, turn: int, most: int | None) -> DataFrame:
    """Pairs (u, v) of classes of different components that share a signature and may link.
    ``labelled``: (sig, cls, root); ``facts``: (cls, n, sketch). See ``_near`` for the others."""
    open_ = (labelled.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("size"))
             .where("lo < hi").select("sig", "size"))
    dealt = materialize(labelled.join(open_, "sig"), "open")
    small = _members_of(dealt.where(F.col("size") <= BLOCK).join(facts, "cls"), "sig")
    # groups of the same members are one; larger groups pair their blocks
    pairs = small.dropDuplicates(["cls"]).select(
        *FACTS, *[F.col(c).alias(c + "2") for c in FACTS], F.lit(True).alias("same"))
    large = dealt.where(F.col("size") > BLOCK)
    if not large.isEmpty():
        pairs = pairs.unionByName(_block_pairs(large, facts, most is None))
    # groups of one least member meet in one task, which drops the pairs they have in common;
    # no class is in more groups than it has signatures
    return _near(pairs.repartition(F.array_min("cls"), F.array_min("cls2")), turn, most)


def set_links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (u, v) that join the classes into the components of all links. ``members``:
    (sig, cls, hub), the classes of every signature that several classes share, and its least.

    After the hubs, ever more pairs of each group are tried in rounds, in the first rounds
    within blocks and with the first block only, so that a large group of near copies comes
    together before the last round takes every pair of different components that is left."""
    shared = members.where("cls <> hub").groupBy("cls", "hub").agg(F.count("*").alias("n"))
    best = shared.groupBy("cls").agg(F.max(F.struct("n", F.col("hub").alias("hub"))).alias("best"))
    tried = materialize(best.select(F.least("best.hub", "cls").alias("u"), F.greatest("best.hub", "cls").alias("v")), "tried")
    links = materialize(verified(tried, sets), "links")
    facts = sets.select("cls", "n", "sketch")
    for turn, (share, most) in enumerate(ROUNDS):
        links = roots = connected_components(links).select("u", F.col("root").alias("v"))  # as good as all links
        labelled = (members.where(F.pmod("sig", F.lit(share)) == 0).select("sig", "cls").join(roots, F.col("cls") == F.col("u"), "left")
                    .select("sig", "cls", F.coalesce("v", "cls").alias("root")))
        new = materialize(_candidates(labelled, facts, turn, most).join(tried, ["u", "v"], "left_anti"), "tried")
        links = materialize(links.unionByName(verified(new, sets)), "links")
        tried = tried.unionByName(new)
    return links


def _signed(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What the join works on: (doc_id, n_shingles, cls) of every row, the members of shared
    signatures (sig, cls, hub), and the sets of their classes (cls, n, sketch, features)."""
    texts = keyed_text(docs)
    group = Window.partitionBy("kind", "code")
    seen = (map_arrow(texts, _classes, "kind long, cls long, codes array<long>")
            .select("kind", "cls", F.explode("codes").alias("code"))
            .withColumn("hub", F.min("cls").over(group)).withColumn("far", F.max("cls").over(group))
            .where("kind >= 0 OR hub <> far").drop("far"))
    seen = materialize(seen, "signatures")  # of signatures only those that several classes share
    info = seen.where("kind >= 0").select(F.col("code").alias("doc_id"), F.col("kind").alias("n_shingles"), "cls")
    members = materialize(seen.where("kind < 0").select(F.col("code").alias("sig"), "cls", "hub").distinct(), "members")
    shared = materialize(members.select("cls").distinct(), "shared")
    wanted = materialize(info.join(shared, "cls").groupBy("cls").agg(F.min("doc_id").alias("doc_id"))
                         .select("doc_id"), "wanted")
    sets = materialize(
        map_arrow(maybe_in(texts, id_filter(wanted, "doc_id"), "doc_id"), _full_sets,
                  "cls long, n int, sketch binary, features binary")
        .join(shared, "cls", "left_semi").dropDuplicates(["cls"]), "full-sets")
    return info, members, sets


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id reachable by links, the own included. Texts without
    words (null, empty) have no shingles and link with nothing; repeated rows link with each
    other; rows with a null id take part, and get the component of their class (null only if
    no id is in it). An empty table gives no rows."""
    info, members, sets = _signed(docs)
    classes = info.where("cls IS NOT NULL").groupBy("cls").agg(F.min("doc_id").alias("first_id"))
    roots = connected_components(set_links(members, sets)).select(F.col("u").alias("cls"), "root")
    rooted = classes.join(roots, "cls", "left").select("cls", F.coalesce("root", "cls").alias("root"), "first_id")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component"))
    return (info.join(rooted.join(least, "root").select("cls", "component"), "cls", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))


def jaccard_links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The join itself: (rows, links).

    ``rows``: doc_id, n_shingles, cls, n_links of every row of ``docs`` (doc_id, text); cls is the
    class of equal sets (null without words), n_links the number of other rows that the row
    links with, equal ones included. ``links``: (u, v), u < v, every two classes that link. Its
    size is that of the result: classes are not expanded into their rows, but a group of many
    different near copies has as many links as it has. Nulls, empty and repeated rows
    are as for ``jaccard_components``; an empty table gives two empty ones."""
    info, members, sets = _signed(docs)
    labelled = members.select("sig", "cls", F.col("cls").alias("root"))
    tried = materialize(_candidates(labelled, sets.select("cls", "n", "sketch"), 0, None), "tried")
    links = materialize(verified(tried, sets).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")), "links")
    sizes = info.where("cls IS NOT NULL").groupBy("cls").agg(F.count("*").alias("size"))
    ends = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    others = (ends.join(sizes, F.col("v") == F.col("cls")).groupBy(F.col("u").alias("cls"))
              .agg(F.sum("size").alias("others")))
    counts = sizes.join(others, "cls", "left").select(
        "cls", (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    return (info.join(counts, "cls", "left")
            .select("doc_id", "n_shingles", "cls", F.coalesce("n_links", F.lit(0)).alias("n_links")), links)


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that stay when each group of linked documents keeps the
    one of smallest doc_id. Of rows that repeat an id and text one stays; an id with several
    texts stays with all of them if one is its group's smallest; rows without an id stay.
    Only rows that may have to go are shuffled."""
    found = materialize(jaccard_components(docs), "components").where("doc_id IS NOT NULL")
    ids = found.groupBy("doc_id").agg(F.max(F.col("doc_id") == F.col("component_id")).alias("stays"),
                                      F.count("*").alias("n"))
    odd = materialize(ids.where("n > 1 OR NOT stays"), "odd-ids")
    bits = id_filter(odd, "doc_id")
    names = docs.columns
    known = free_name(names, "known")
    odd = odd.select(F.struct("doc_id", "stays", "n").alias(known))
    rest = maybe_in(docs, bits, "doc_id").join(odd, F.col("doc_id") == F.col(f"{known}.doc_id"), "left")
    alone, stays = F.col(f"{known}.n") == 1, F.col(f"{known}.stays")
    once = rest.where(~alone & stays).dropDuplicates(["doc_id", "text"])
    return (maybe_in(docs, bits, "doc_id", keep=False)
            .unionByName(rest.where(F.col(known).isNull() | (alone & stays)).select(*names))
            .unionByName(once.select(*names)))


ORACLE_COMPONENTS = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) BETWEEN 1 AND 4 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM d),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id
      GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
r(doc_id, other) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, l.y FROM r JOIN l ON l.x = r.other)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
FROM d LEFT JOIN n USING (doc_id)
JOIN (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id) m ON m.doc_id = d.doc_id
"""
