"""Best-fit packing of tokenised documents: large pieces meet in pairs, small ones fill the gaps that fit best."""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import Column, DataFrame, functions as F

from readflow.llm.ranks import with_rank
from readflow.llm.texts import in_slices, release_memory
from readflow.session import materialize

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
END_ID = 0
#: Lower-case letters of ASCII and Latin-1, which no normaliser composes, and signs of ASCII behind them.
WORD_AND_SIGNS = re.compile(r"^([a-zªµºß-öø-ÿ]+)([!-/:-@\[-`{-~]*)$", re.M)
#: Characters whose lower case or composition may depend on others.
BEYOND = re.compile(r"[^\x00-\xff]")
#: Distinct blank-free strings whose ids a generation of the memory holds.
MEMORY = 300_000
#: Characters of text that are tokenised at once.
SLICE = 4_000_000


class Generations(dict):
    """A bounded memory: when full, what was used since the last time stays for one more generation."""

    def __init__(self, size: int):
        self.size, self.old = size, {}

    def missing(self, keys: set[str]) -> set[str]:
        """Those of ``keys`` that are not known; the others are at hand until the next call."""
        if len(self) > self.size:
            self.old = dict(self)
            self.clear()
        unknown = keys.difference(self)
        again = self.old.keys() & unknown
        self.update(zip(again, map(self.old.__getitem__, again)))
        return unknown - again if again else unknown


class TextIds:
    """Token ids of texts as little-endian unsigned 32-bit bytes.

    The tokenizer drops white space and never looks across it, so a text's ids are those of its parts
    between blanks and line ends, one after the other; the ids of a part are remembered. It lower-cases,
    which for texts of ASCII and Latin-1 may be done at once. Letters and the signs behind them never
    share a token, so both are looked up apart, and a word of letters goes to the vocabulary's merges.
    """

    def __init__(self, path: str, memory: int = MEMORY):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.written = str.maketrans({c: split(c)[0][0] for c in map(chr, range(256)) if WORD_AND_SIGNS.match(c)})
        self.known = Generations(memory)

    def of(self, texts: list[str]) -> list[bytes]:
        parts = [(t if BEYOND.search(t) else t.lower()).replace("\n", " ").split(" ") for t in texts]
        distinct = set()
        for own in parts:
            distinct.update(own)
        self._learn(self.known.missing(distinct))
        known = self.known.__getitem__
        return [b"".join(map(known, own)) for own in parts]

    def _learn(self, parts: set[str]) -> None:
        known, merge, written = self.known, self.tokenizer.model.tokenize, self.written
        found = WORD_AND_SIGNS.findall("\n".join(parts))
        for word in {word for word, signs in found if word not in known}:
            known[word] = array("I", [t.id for t in merge(word.translate(written))]).tobytes()
        signed = [x for x in found if x[1]]
        others = parts.difference(known, [word + signs for word, signs in signed])
        others.update({signs for _, signs in signed}.difference(known))
        known.update(zip(others, self._codes(list(others))))
        known.update((word + signs, known[word] + known[signs]) for word, signs in signed)

    def _codes(self, texts: list[str]) -> list[bytes]:
        return [np.array(code.ids, "<u4").tobytes() for code in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


_loaded: dict[str, TextIds] = {}


def text_ids(path: str) -> TextIds:
    """The ids of a vocabulary, with one memory for all tasks of a worker."""
    if path not in _loaded:
        _loaded[path] = TextIds(path)
    return _loaded[path]


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(key, piece, start, length, ids_crc32) of every document's ids with the end id behind them.

    Documents of more than ``capacity`` ids are cut into pieces of that many, the last one may be
    shorter; all others are one piece. A null or empty text is the end id alone.
    """
    path = path or public_tokenizers.path(TOKENIZER)
    end = np.array([END_ID], "<u4").tobytes()
    fields = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = text_ids(path)
        for batch in batches:
            at, rows, made = 0, [], []
            for own in in_slices((t.as_py() or "" for t in batch.column(1)), SLICE):
                for code in ids.of(own):
                    code += end
                    for n, start in enumerate(range(0, len(code), 4 * capacity)):
                        part = code[start : start + 4 * capacity]
                        rows.append(at)
                        made.append((n, start // 4, len(part) // 4, zlib.crc32(part)))
                    at += 1
            columns = list(zip(*made)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(c, t) for c, (_, t) in zip(columns, fields))],
                names=["key", *(n for n, _ in fields)])
        release_memory()

    kind = docs.select(F.col(key).alias("key")).schema["key"].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(cut, f"key {kind}, piece int, start long, length long, ids_crc32 long")


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """Bins as (how many alike, [(length, pieces of it in each), …]) for ``counts`` of pieces by length.

    At most two pieces above a third of the capacity fit one bin. They are matched greedily: the
    largest with the largest that still fits beside it. The smaller ones, longest first, go where
    the gap left is the smallest that takes them, and open a bin when there is none. Bins alike are
    handled together, so the work depends on the number of distinct lengths, not of pieces.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    if any(not 0 < n <= capacity for n in left):
        raise ValueError("lengths must lie between 1 and the capacity")
    by_gap: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}

    def put(gap: int, n: int, held: list[tuple[int, int]]) -> None:
        if n:
            by_gap.setdefault(gap, []).append((n, held))

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        a = large[-1]
        place = bisect_left(large, capacity - a + 1) - 1
        if place < 0:
            put(capacity - a, left.pop(large.pop()), [(a, 1)])
            continue
        b = large[place]
        n = left[a] // 2 if a == b else min(left[a], left[b])
        if n:
            put(capacity - a - b, n, [(a, 2)] if a == b else [(a, 1), (b, 1)])
        else:  # a single piece is left of this length
            others = [x for x in large[:place] if left[x]]
            b = others[-1] if others else None
            if b is None:
                put(capacity - a, left[a], [(a, 1)])
                left[a] = 0
            else:
                put(capacity - a - b, 1, [(a, 1), (b, 1)])
                left[a] -= 1
                left[b] -= 1
            n = 0
        if n:
            left[a] -= 2 * n if a == b else n
            if a != b:
                left[b] -= n
        large = [x for x in large if left[x]]
    for size in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        todo = left[size]
        while todo:
            gap = min((g for g, own in by_gap.items() if g >= size and own), default=None)
            n, held = by_gap[gap].pop() if gap is not None else (todo, [])
            gap = capacity if gap is None else gap
            each = min(gap // size, todo)
            full = min(n, todo // each)
            put(gap - each * size, full, [*held, (size, each)])
            if held:
                put(gap, n - full, held)
            todo -= full * each
    return [(n, held) for own in by_gap.values() for n, held in own]


def _segments(bins: list[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """Rows (length, first rank, first bin, pieces per bin, first offset), sorted: where the n-th piece of a length goes."""
    rows, used, first = [], {}, 0
    for n, held in bins:
        offset = 0
        for length, each in held:
            rows.append((length, used.get(length, 0), first, each, offset))
            used[length] = used.get(length, 0) + n * each
            offset += length * each
        first += n
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Per piece: key, piece, start, length, ids_crc32, sequence_id, offset.

    Only the numbers of pieces by length (at most ``capacity`` rows) come to the driver, which plans
    the bins; each piece then finds its place from its rank among the pieces of its length. The
    ranks are counted in parts of a length, so that a length held by most pieces is spread out; the
    plan sent to the tasks has at most some ten thousand rows, whatever the number of pieces.
    Repeated rows are packed each; null keys are kept; an empty table packs into nothing. Other
    columns are not read.
    """
    made = materialize(pieces(docs, key, text, path, capacity), "pieces")
    counts = {r["length"]: r["n"] for r in made.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = _segments(plan_bins(counts, capacity))
    ranked = with_rank(made, "length", [F.col(c) for c in ("key", "piece", "ids_crc32", "start")], F.xxhash64("key", "piece"), "rank")

    def places(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        codes = (plan[:, 0] << 44) + plan[:, 1]
        for length, rank in batches:
            length, rank = (x.to_numpy(zero_copy_only=False) for x in (length, rank))
            own = plan[np.searchsorted(codes, (length << 44) + rank, "right") - 1] if len(length) else plan[:0]
            nth = rank - own[:, 1]
            yield pa.StructArray.from_arrays([pa.array(own[:, 2] + nth // own[:, 3]), pa.array(own[:, 4] + nth % own[:, 3] * length)], ["sequence_id", "offset"])

    place = F.arrow_udf(places, "struct<sequence_id:bigint,offset:bigint>")
    return ranked.withColumn("place", place("length", "rank")).select(
        F.col("key").alias(key), "piece", "start", "length", "ids_crc32", "place.sequence_id", "place.offset")


def sequences_needed(total: Column, capacity: int = CAPACITY) -> Column:
    """The least number of sequences that ``total`` ids can take."""
    return F.ceil(total / capacity)
