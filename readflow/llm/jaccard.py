"""N-gram Jaccard join: exact links between documents whose shingle sets are nearly equal, and their components."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from readflow.llm.graph import components
from readflow.llm.texts import broadcast_if_small, in_slices, release_memory, spare_name
from readflow.session import materialize

#: A word: everything between ASCII blanks.
BLANKS = re.compile(r"[\x20\x09-\x0D]+")
SHINGLE = 3
#: Links need ``100 * |common| >= PERCENT * |union|``.
PERCENT = 90
#: What ``keep_one`` takes for near copies: word 5-grams and a similarity of 0.8 or more.
COPY_SHINGLE, COPY_PERCENT = 5, 80
#: Shingles that one cell of a candidate block should hold; larger blocks are cut into parts that meet pair by pair.
CELL_SHINGLES = 600_000


def shingle_set(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word ``width``-grams of a text.

    With fewer words, the whole sequence is one gram; without words the set is empty. Two different
    grams of the two texts under comparison share a hash with a chance of about 2^-44 for sets of
    a thousand; only then could a count be off by one.

    Bytes know no letters and no blanks but those of ASCII, so lowering and splitting them takes one
    pass each, and hashing a word takes no longer than looking its hash up would.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    size = min(n, width)
    grams = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        grams = (grams ^ (grams >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + codes[i : n - size + 1 + i]
    return _distinct(_mix(grams))


def _distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct numbers; for short arrays a plain sort is quicker than ``np.unique``."""
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x


def _mix(x: np.ndarray) -> np.ndarray:
    """A well-mixed permutation of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def needed(size: int, percent: int = PERCENT) -> int:
    """The least overlap that a set of ``size`` needs with any partner."""
    return -(-percent * size // 100)


def _level(size: int, percent: int) -> int:
    """The size class: linked sets lie in the same or in neighbouring classes."""
    return int(math.log(size) / math.log(100 / percent) + 1e-9)


def _parts(level: int, percent: int) -> tuple[int, int]:
    """(parts, spare) for sets of classes ``level`` and ``level + 1``.

    Linked x, y differ in |x − y| + |y − x| <= (1 − t)/(1 + t) · (|x| + |y|) grams, and their sizes
    lie below r^(level + 1) and r^(level + 2) with r = 1/t. With that many differences d, cutting the
    sets into d + 1 + spare parts leaves spare + 1 parts or more that are equal in both. Where parts
    hold few grams on average, more of them are weak, and more spare ones make up for that.
    """
    r = 100 / percent
    most = int((r - 1) / (r + 1) * (r ** (level + 1) + r ** (level + 2)) + 1e-6)
    spare = 0 if not most else 1 + most // 8
    if r**level >= 6 * (most + 1):
        spare = min(4, spare)
    return most + 1 + spare, spare


def signatures(grams: np.ndarray, percent: int = PERCENT) -> list[tuple[int, np.ndarray]]:
    """(level, keys) for a set's own class and then the one below: linked sets share a key of the smaller one's class.

    The grams are cut by hash into ``_parts`` parts, and a key is a hash of a whole part. Parts of
    fewer than three grams say little and would tie strangers together, so they are left out
    where the spare parts make up for them: with at most ``spare`` such parts in a set, one of the
    ``spare + 1`` equal parts is a good one. A set with more of them leaves out only parts of fewer than
    two grams, or only empty ones, or none. Linked sets may differ in that: the equal part that is good
    by the stricter of their two bounds is given by both.
    """
    out = []
    own = _level(len(grams), percent)
    strong = _mix(grams + np.uint64(0x5851F42D4C957F2D))
    for level in sorted({own, max(own - 1, 0)}, reverse=True):
        k, spare = _parts(level, percent)
        part = (grams % np.uint64(k)).astype(np.int64)
        sizes = np.bincount(part, minlength=k)
        sums = np.zeros(k, np.uint64)
        np.add.at(sums, part, strong)
        least = next(least for least in (3, 2, 1, 0) if (sizes < least).sum() <= spare)
        wanted = np.flatnonzero(sizes >= least)
        out.append((level, _mix(sums[wanted] ^ _mix(np.uint64(level * 1_000_003) + wanted.astype(np.uint64)))))
    return out


#: Parts that signatures are dealt into by the first bits of their keys; one part at a time is compared in a task.
KEY_PARTS = 4096
#: Bytes of a key beyond its part, and of a node: what one signature takes in a shuffle is twice as much.
KEY_BYTES = 5


def _nodes(hi: int, n: int, percent: int) -> list[int]:
    """What stands for a set in the graph of signatures, for each of its levels: a hash of ``KEY_BYTES`` bytes.

    Sets that share one by chance, some 400 pairs among 15 million sets, are candidates too many and no more.
    """
    own = _level(n, percent)
    mixed = [(hi + level * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF for level in sorted({own, max(own - 1, 0)}, reverse=True)]
    return (_mix(np.array(mixed, np.uint64)) >> np.uint64(64 - 8 * KEY_BYTES)).tolist()


def _set_rows(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    """A row per document: key, size of its set, hash of the set in two halves, nodes."""
    for batch in batches:
        at = 0
        for texts in in_slices((t.as_py() or "" for t in batch.column(1)), 8_000_000):
            sizes, his, los, nodes = [], [], [], []
            for text in texts:
                grams = shingle_set(text, width)
                raw = xxhash.xxh3_128_intdigest(grams.tobytes())
                sizes.append(len(grams))
                his.append(raw >> 64)
                los.append(raw & 0xFFFFFFFFFFFFFFFF)
                nodes.append(_nodes(raw >> 64, len(grams), percent) if len(grams) else [])
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(at, len(texts)), pa.array(sizes, pa.int64()), pa.array(np.array(his, np.uint64).astype(np.int64)),
                pa.array(np.array(los, np.uint64).astype(np.int64)), pa.array(nodes, pa.list_(pa.int64()))], names=["doc", "n", "hi", "lo", "nodes"])
            at += len(texts)
    release_memory()


def _packed(key: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Keys and nodes as lines of ``2 * KEY_BYTES`` bytes; of a key, what follows the bits that name its part."""
    rest = key << np.uint64((KEY_PARTS - 1).bit_length()) >> np.uint64(64 - 8 * KEY_BYTES)
    lines = np.stack([rest, node.astype(np.uint64)], 1).astype("<u8").view(np.uint8).reshape(-1, 2, 8)
    return np.ascontiguousarray(lines[:, :, :KEY_BYTES]).reshape(-1)


def _unpacked(lines: bytes) -> np.ndarray:
    """Keys (without their part) and nodes of ``_packed`` lines, as two rows of numbers."""
    wide = np.zeros((len(lines) // (2 * KEY_BYTES), 2, 8), np.uint8)
    wide[:, :, :KEY_BYTES] = np.frombuffer(lines, np.uint8).reshape(-1, 2, KEY_BYTES)
    return wide.view("<u8")[:, :, 0].T.astype(np.int64)


def _distinct_pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Different pairs of different numbers, a pair per line."""
    apart = a != b
    a, b = a[apart], b[apart]
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))[: len(a)]
    return np.stack([a[new], b[new]], 1)


def _signature_rows(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (part, lines, ties) of each slice of the texts: a part's signatures as ``_packed`` lines, or nodes that share one.

    A signature takes ten bytes, as few rows hold very many of them. Signatures that repeat inside a slice are
    turned into pairs of nodes at once, so a key that very many documents share makes one line per slice.
    """
    bits = np.uint64(64 - (KEY_PARTS - 1).bit_length())
    names = ["part", "lines", "ties"]
    for batch in batches:
        for texts in in_slices((t.as_py() or "" for t in batch.column(0)), 8_000_000):
            keys, owners, seen = [], [], set()
            for text in texts:
                grams = shingle_set(text, width)
                raw = xxhash.xxh3_128_intdigest(grams.tobytes())
                if len(grams) and raw not in seen:
                    seen.add(raw)
                    for node, (_, some) in zip(_nodes(raw >> 64, len(grams), percent), signatures(grams, percent)):
                        keys.append(some)
                        owners.append(np.full(len(some), node, np.int64))
            if not keys:
                continue
            x, y = np.concatenate(keys), np.concatenate(owners)
            del keys, owners
            distinct, first, back = np.unique(x, return_index=True, return_inverse=True)
            part = (distinct >> bits).astype(np.int32)
            starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
            ends = (np.append(starts, len(part)) * 2 * KEY_BYTES).astype(np.int32)
            lines = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(_packed(distinct, y[first]))])
            yield pa.RecordBatch.from_arrays([pa.array(part[starts]), lines, pa.nulls(len(starts), pa.binary())], names=names)
            pairs = _distinct_pairs(y, y[first][back])
            if len(pairs):
                yield pa.RecordBatch.from_arrays([pa.array([int(pairs[0, 0] % KEY_PARTS)], pa.int32()), pa.nulls(1, pa.binary()), pa.array([pairs.tobytes()], pa.binary())], names=names)
    release_memory()


def _shared_signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of nodes that share a signature, each with the smallest node that has it; rows come sorted by part."""
    def tied(lines, ties):
        key, node = _unpacked(b"".join(lines))
        order = np.lexsort((node, key))
        key, node = key[order], node[order]
        first = np.concatenate(([True], key[1:] != key[:-1]))[: len(key)]
        lowest = node[first][np.cumsum(first) - 1]
        inside = np.frombuffer(b"".join(ties), np.int64).reshape(-1, 2)
        pairs = _distinct_pairs(np.concatenate((node, inside[:, 0])), np.concatenate((lowest, inside[:, 1])))
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"])

    part, lines, ties = None, [], []
    for batch in batches:
        for here, *some in zip(*(batch.column(c).to_pylist() for c in range(3))):
            if here != part:
                if lines or ties:
                    yield tied(lines, ties)
                part, lines, ties = here, [], []
            for held, value in zip((lines, ties), some):
                if value is not None:
                    held.append(value)
    if lines or ties:
        yield tied(lines, ties)
    release_memory()


SET_TYPE = "doc bigint, n bigint, hi bigint, lo bigint, nodes array<bigint>"


class InvertedLists:
    """Sorted posting lists of a cell's sets, and T-occurrence search in them by DivideSkip.

    All lists lie in one sorted array of ``gram * sets + set``, so that probing a list for a set is
    one binary search, and probing many lists for many sets is one vectorised call.
    """

    def __init__(self, sets: list[np.ndarray], percent: int = PERCENT):
        self.count, self.percent = len(sets), percent
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.ends = np.cumsum(self.sizes)
        _, self.grams = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(self.count), self.sizes)
        self.postings = np.sort(self.grams * self.count + owner)
        self.lengths = np.bincount(self.grams)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)))

    def search(self, q: int, skip) -> Iterator[int]:
        """Sets linked with set ``q``; ``skip`` maps an array of candidates to a mask of those not wanted (any more).

        A partner shares at least T = ``needed(|q|)`` grams with q. The T − 1 longest lists are set
        aside, so that it must occur in one of the short ones: those are merged by one sort, whose
        runs are each candidate's occurrences; the long lists are then probed for it by binary search,
        unless it would fall short of its own size's overlap even if it were in all of them.
        """
        size = int(self.sizes[q])
        own = self.grams[self.ends[q] - size : self.ends[q]]
        least = needed(size, self.percent)
        own = own[np.argsort(self.lengths[own], kind="stable")]
        short, long = own[: size - least + 1], np.sort(own[size - least + 1 :])  # probes in order are quicker
        short = short[self.lengths[short] > 1]
        if not len(short):
            return
        runs = self.lengths[short]
        place = np.arange(runs.sum()) + np.repeat(self.starts[short] - (np.cumsum(runs) - runs), runs)
        merged = np.sort(self.postings[place] - np.repeat(short * self.count, runs))
        firsts = np.flatnonzero(np.concatenate(([True], merged[1:] != merged[:-1])))
        cands, seen = merged[firsts], np.diff(firsts, append=len(merged))
        sizes = self.sizes[cands]
        fits = (cands != q) & (sizes >= least) & (self.percent * sizes <= 100 * size)
        fits &= (100 + self.percent) * (seen + len(long)) >= self.percent * (size + sizes)
        fits[fits] = ~skip(cands[fits])
        order = np.flatnonzero(fits)[np.argsort(-seen[fits], kind="stable")]
        cands, seen = cands[order], seen[order]
        for first in range(0, len(cands), 64):
            some, counts = cands[first : first + 64], seen[first : first + 64]
            keep = ~skip(some)
            some, counts = some[keep], counts[keep]
            if len(some):
                codes = long[None, :] * self.count + some[:, None]
                place = np.minimum(np.searchsorted(self.postings, codes), len(self.postings) - 1)
                common = counts + (self.postings[place] == codes).sum(1)
                yield from some[100 * common >= self.percent * (size + self.sizes[some] - common)].tolist()


def spanning_links(sets: list[np.ndarray], side: np.ndarray | None = None, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that tie together the same sets as all links do, at most one per set.

    With ``side`` (0 or 1 per set) only links between the two sides count. A candidate already tied
    to the set in question is not verified again; that changes no component.
    """
    if len(sets) < 2:
        return []
    lists = InvertedLists(sets, percent)
    root = np.arange(len(sets))
    links = []
    for q in range(len(sets)) if side is None else np.flatnonzero(side == 0).tolist():
        def skip(cands):
            done = root[cands] == root[q]
            return done | (cands < q if side is None else side[cands] == 0)

        for d in lists.search(q, skip):
            if root[d] != root[q]:
                root[root == root[d]] = root[q]
                links.append((q, d))
    return links


def _cell_links(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Links inside each cell; rows come sorted by cell: (block, i, j, part, doc, text)."""
    cell, docs, parts, sets = None, [], [], []

    def links():
        i, j = cell[1:] if cell else (0, 0)
        side = None if i == j else (np.array(parts) == j).astype(np.int8)
        pairs = spanning_links(sets, side, percent)
        return pa.RecordBatch.from_arrays([pa.array([docs[p[k]] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])

    for batch in batches:
        for *here, part, doc, text in zip(*(batch.column(c).to_pylist() for c in range(5)), batch.column(5)):
            if tuple(here) != cell:
                if len(sets) > 1:
                    yield links()
                cell, docs, parts, sets = tuple(here), [], [], []
            docs.append(doc)
            parts.append(part)
            sets.append(shingle_set(text.as_py(), width))
    if len(sets) > 1:
        yield links()
    release_memory()


def link_components(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE, percent: int = PERCENT, cell: int = CELL_SHINGLES) -> DataFrame:
    """Per document: key (bigint), n_shingles, component_id.

    1. Every set gives its ``signatures``, ten bytes each in one shuffle; sets that share one are tied together, and the
       components of that graph are candidate blocks: linked sets are always in a common block. Nothing is
       emitted per pair, and equal sets are one node. Sets of one size class meet in a block of that
       class, so a block whose sets are all there for the class below their own is passed over.
    2. One document per different set goes to its block. A block of more than ``cell`` shingles is
       cut into parts by hash, and every pair of parts is a cell of its own, so no task holds more
       than two parts; work then grows with the square of the different texts in one block.
    3. In a cell, T-occurrence search with DivideSkip (``InvertedLists``) finds the links exactly.
       Only spanning links leave it; together with the ties between equal sets they give the
       components.

    Null and empty texts have no shingles and link with nothing. Rows with one key count as one
    document with several texts: each row keeps its own ``n_shingles``, and they share a component.
    A null key gives a null ``component_id`` and takes no part. Other columns are not read.
    """
    rows = docs.select(F.col(key).cast("bigint").alias("doc"), F.col(text).alias("text"))
    sets = materialize(rows.mapInArrow(lambda b: _set_rows(b, width, percent), SET_TYPE), "signed-sets")
    filled = sets.filter("n > 0 and doc is not null")
    # Signatures are made from the texts again: they take most of the room, and are in no table besides the shuffle.
    signed = rows.filter("doc is not null").select("text").mapInArrow(lambda b: _signature_rows(b, width, percent), "part int, lines binary, ties binary")
    dealt = signed.repartition("part").sortWithinPartitions("part")
    blocks = components(dealt.mapInArrow(_shared_signatures, "a bigint, b bigint"))
    first = materialize(filled.groupBy("hi", "lo").agg(F.min("doc").alias("rep"), F.first("n").alias("n"), F.first("nodes").alias("nodes")), "sets")
    members = first.select("rep", "n", F.posexplode("nodes").alias("below", "node")).join(blocks, "node").select(F.col("root").alias("block"), "rep", "n", "below")
    members = materialize(members, "members")
    sizes = members.groupBy("block").agg(F.ceil(F.sum("n") / cell).cast("int").alias("c"), F.count(F.lit(1)).alias("m"), F.min("below").alias("below"))
    sizes = sizes.filter("m > 1 and below = 0").select("block", "c")
    cells = members.join(sizes, "block").withColumn("part", F.pmod(F.xxhash64("rep"), F.col("c")).cast("int"))
    cells = cells.select("rep", "block", "part", F.explode(F.sequence(F.lit(0), F.col("c") - 1)).alias("other"))
    cells = cells.select("rep", "block", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part")
    texts = rows.join(broadcast_if_small(cells, "cells"), F.col("doc") == F.col("rep")).select("block", "i", "j", "part", "doc", "text")
    placed = texts.repartition("block", "i", "j").sortWithinPartitions("block", "i", "j", "doc")
    links = placed.mapInArrow(lambda b: _cell_links(b, width, percent), "a bigint, b bigint")
    same = filled.join(first.select("hi", "lo", "rep"), ["hi", "lo"]).select(F.col("doc").alias("a"), F.col("rep").alias("b"))
    tied = components(links.unionByName(same))
    return (
        sets.join(tied, F.col("doc") == F.col("node"), "left")
        .select(F.col("doc").alias(key), F.col("n").alias("n_shingles"), F.coalesce("root", "doc").alias("component_id"))
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = COPY_SHINGLE, percent: int = COPY_PERCENT, **options) -> DataFrame:
    """The documents whose key is the smallest of its component of near copies, with all their columns.

    Rows with a null key are kept. Repeated rows with the smallest key are all kept: they are one
    document.
    """
    gone = spare_name(docs, "_gone_")
    copies = link_components(docs, key, text, width, percent, **options).filter(F.col(key) != F.col("component_id")).select(F.col(key).alias(gone)).distinct()
    return docs.join(broadcast_if_small(copies, "near-copies"), F.col(key) == F.col(gone), "left_anti")
