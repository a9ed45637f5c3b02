"""Spelling variants: words one letter apart, found in a trie over the counts of their letter groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from readflow.llm.texts import broadcast_if_small
from readflow.session import materialize

#: A run of letters: ASCII and Latin-1.
RUN = "[A-Za-zÀ-ÿ]+"
#: Letter groups in the order of the trie's levels; every other character belongs to one more group at the end.
GROUPS = ("etq", "anz", "ihx", "orj", "sduv", "lcpä", "mfwyö", "gbkü")
#: Levels of the trie that tell cells apart; the levels below are searched inside a task.
UPPER = 4
#: Words a task holds of a cell; cells of more are cut into parts, and a word searches all of them.
CELL = 50_000
PAIRS = 4_000_000  # letters compared at once
_GROUP = np.full(256, len(GROUPS), np.int64)
for _level, _letters in enumerate(GROUPS):
    _GROUP[[ord(c) for c in _letters]] = _level
#: What a stored word's upper counts may differ in from those of a word that looks for it: nothing, one letter less in a
#: group (deficit), or that and one letter more in a later group (surplus). The other cases are found from the other side.
OFFSETS = [(0,) * UPPER] + [tuple(-(g == i) + (g == j) for g in range(UPPER)) for i in range(UPPER) for j in [-1, *range(i + 1, UPPER)]]


def count_words(runs: DataFrame, word: str = "word", least: int = 3, letters: int = 5) -> DataFrame:
    """(word, n) of the words of at least ``letters`` code points that occur ``least`` times or more; null is no word."""
    counted = runs.select(F.col(word).alias("word")).filter(F.char_length("word") >= letters).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= least)


def upper_counts(word: Column) -> list[Column]:
    """How many letters of each of the first ``UPPER`` groups a word has."""
    return [(F.char_length(word) - F.char_length(F.translate(word, letters, ""))).alias(f"c{g}") for g, letters in enumerate(GROUPS[:UPPER])]


class CountTrie:
    """Words of one cell arranged by their counts of letter groups, level by level.

    The trie is kept as the sorted table of its leaves: a node of a level is a range of rows that agree
    in all counts so far. A leaf holds the words with exactly its counts, so they are equally long.
    """

    def __init__(self, letters: np.ndarray, starts: np.ndarray, rows: np.ndarray, counts: np.ndarray):
        self.letters, self.starts, self.counts = letters, starts, counts
        order = rows[np.lexsort(counts[rows].T[::-1])]
        new = np.ones(len(order), bool)
        new[1:] = (counts[order[1:]] != counts[order[:-1]]).any(1)
        first = np.flatnonzero(new)
        self.leaves = counts[order[first]]
        self.words = np.split(order, first[1:])

    def search(self, queries: np.ndarray, spent: np.ndarray, level: int = UPPER) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(stored, query) rows of near words. ``spent``: 0 nothing, 1 the deficit, 2 deficit and surplus.

        Depth first from the cell's node; a branch is followed with the queries that can pay for it:
        one letter less costs the deficit, one more the surplus, which is only open once the deficit is
        spent. What arrives at a leaf is compared letter by letter.
        """
        stack = [(0, len(self.leaves), level, queries, spent)]
        while stack:
            low, high, level, own, paid = stack.pop()
            if level == self.leaves.shape[1]:
                yield from self._verified(self.words[low], own, paid)
                continue
            column = self.leaves[low:high, level]
            cuts = np.flatnonzero(column[1:] != column[:-1]) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), high - low]):
                more = column[a] - self.counts[own, level]
                cost = np.where(more == 0, 0, np.where((more == -1) & (paid == 0) | (more == 1) & (paid == 1), 1, 9))
                some = cost < 9
                if some.any():
                    stack.append((low + a, low + b, level + 1, own[some], (paid + cost)[some]))

    def _verified(self, stored: np.ndarray, queries: np.ndarray, spent: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        size = int(self.starts[stored[0] + 1] - self.starts[stored[0]])
        for longer, check in ((0, _one_replaced), (1, _one_inserted)):
            some = queries[spent == 1] if longer else queries[spent != 1]
            if not len(some):
                continue
            here = self.letters[self.starts[stored][:, None] + np.arange(size)]
            step = max(1, PAIRS // max(1, len(stored) * size))
            for first in range(0, len(some), step):
                part = some[first : first + step]
                there = self.letters[self.starts[part][:, None] + np.arange(size + longer)]
                i, j = np.nonzero(check(here[:, None, :], there[None, :, :]))
                if len(i):
                    yield stored[i], part[j]


def _one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(2) == 1


def _one_inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether ``b`` without one letter is ``a``: what they share in front and behind makes up ``a``."""
    front = np.logical_and.accumulate(a == b[:, :, :-1], axis=2).sum(2)
    back = np.logical_and.accumulate((a == b[:, :, 1:])[:, :, ::-1], axis=2).sum(2)
    return front + back >= a.shape[2]


def near_in_cell(words: list[str], n: np.ndarray, stored: np.ndarray, spent: np.ndarray) -> list[tuple[str, int, int, str]]:
    """(word, near words, largest n among them, smallest near word with it) from one part of a cell.

    ``stored`` marks the rows the trie holds; the others look for them with ``spent`` already paid
    above. Words with the same counts meet twice, once from each side, and count once.
    """
    lengths = np.array([len(w) for w in words], np.int64)
    starts = np.concatenate(([0], np.cumsum(lengths)))
    letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    groups = np.where(letters < 256, _GROUP[np.minimum(letters, 255)], len(GROUPS))
    width = len(GROUPS) + 1
    counts = np.bincount(np.repeat(np.arange(len(words)), lengths) * width + groups, minlength=len(words) * width).reshape(-1, width)
    found = list(CountTrie(letters, starts, np.flatnonzero(stored), counts).search(np.flatnonzero(~stored), spent[~stored]))
    if not found:
        return []
    a, b = (np.concatenate(x) for x in zip(*found))
    place = np.empty(len(words), np.int64)
    place[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    once = (counts[a] != counts[b]).any(1) | (place[a] < place[b])
    a, b = a[once], b[once]
    word, near = np.concatenate((a, b)), np.concatenate((b, a))
    order = np.lexsort((place[near], -n[near], word))
    word, near = word[order], near[order]
    first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))[: len(word)]
    totals = np.diff(np.concatenate((first, [len(word)])))
    return [(words[w], int(t), int(n[m]), words[m]) for w, t, m in zip(word[first].tolist(), totals.tolist(), near[first].tolist())]


def _near_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by cell and part: (c0, …, part, spent, stored, word, n)."""
    cell, words, ns, stored, spent = None, [], [], [], []

    def found():
        rows = near_in_cell(words, np.array(ns, np.int64), np.array(stored), np.array(spent, np.int64))
        columns = list(zip(*rows)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()))], names=["word", "n_near", "near_n", "near"])

    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for *here, paid, is_stored, word, n in zip(*columns):
            if here != cell:
                if any(stored) and not all(stored):
                    yield found()
                cell, words, ns, stored, spent = here, [], [], [], []
            words.append(word)
            ns.append(n)
            stored.append(is_stored)
            spent.append(paid)
    if any(stored) and not all(stored):
        yield found()


def near_words(words: DataFrame, cell: int = CELL) -> DataFrame:
    """(word, n_near, near_n, near): of the words that have any, how many are one inserted, deleted or replaced code
    point away, the largest ``n`` among those, and the first of them in code-point order with it.

    ``words``: (word, n), each word once. The upper levels of the trie are the table of existing cells: a
    word goes to its own cell to be found and to at most ``len(OFFSETS)`` existing ones to search. A cell
    of more than ``cell`` words is cut into parts by hash. Tasks give sums per word, not pairs.
    """
    prefix = [f"c{g}" for g in range(UPPER)]
    rows = materialize(words.select("word", "n", *upper_counts(F.col("word"))), "words")
    sizes = rows.groupBy(*prefix).agg(F.ceil(F.count(F.lit(1)) / cell).cast("int").alias("parts"))
    sizes = broadcast_if_small(sizes, "word-cells")
    stored = rows.join(sizes, prefix).select(
        *prefix, F.pmod(F.xxhash64("word"), F.col("parts")).cast("int").alias("part"), F.lit(0).alias("spent"), F.lit(True).alias("stored"), "word", "n")
    offsets = F.array(*[F.struct(*[F.lit(d).alias(f"d{g}") for g, d in enumerate(o)], F.lit(sum(d != 0 for d in o)).alias("spent")) for o in OFFSETS])
    looking = rows.select("*", F.explode(offsets).alias("o"))
    looking = looking.select(*[(F.col(p) + F.col(f"o.d{g}")).alias(p) for g, p in enumerate(prefix)], F.col("o.spent").alias("spent"), "word", "n")
    looking = looking.join(sizes, prefix).select(
        *prefix, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "spent", F.lit(False).alias("stored"), "word", "n")
    keys = [*prefix, "part"]
    placed = stored.unionByName(looking).repartition(*keys).sortWithinPartitions(*keys)
    found = placed.mapInArrow(_near_rows, "word string, n_near bigint, near_n bigint, near string")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("b")).select(
        "word", "n_near", (-F.col("b.n")).alias("near_n"), F.col("b.near").alias("near"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): where following the forms ends. Each round doubles the way; n at least doubles per step, so few are needed."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = materialize(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if after.filter("moved").isEmpty():
            return after.drop("moved")
        now = after.drop("moved")


def variants(words: DataFrame, ratio: int = 2, cell: int = CELL) -> DataFrame:
    """Per word of (word, n): word, form, root, n, n_near, form_n.

    The form of a word is its most frequent near word (ties: the smallest in code-point order) if that
    occurs at least ``ratio`` times as often, else null; forms of forms lead to the ``root``, the word itself
    if it has no form. An empty table gives an empty one.
    """
    words = materialize(words, "vocabulary")
    near = materialize(near_words(words, cell), "near-words")
    rows = words.join(near, "word", "left")
    has_form = F.col("near_n") >= ratio * F.col("n")
    rows = rows.select(
        "word", F.when(has_form, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(has_form, F.col("near_n")).alias("form_n"))
    ends = roots(rows.filter("form is not null"))
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
