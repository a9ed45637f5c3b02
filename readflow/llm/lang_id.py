"""Language identification per word and per text by a linear-chain conditional random field."""

from __future__ import annotations

import itertools
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType

from readflow.llm.texts import bounded_sample, in_slices, words_of

LONGEST = 30  # characters of a word that is labelled whole; longer runs are cut
SAMPLE = 300  # labelled texts of each language that are fitted on, at most
TEXTS = 64 * 64 * SAMPLE  # bound of texts times languages that are fitted on: with many languages each gets fewer texts, but one at least
CELLS = 4_000_000  # chances (words times languages) that are held at once in fitting
BUCKETS = 1 << 15  # hashed features
LEXICON = 400  # most frequent words of a language that make its lexicon
SEGMENT = 32  # words of a training sequence
SWITCH = (4, 24)  # words before a training sequence changes to another text
STEPS, RATE, RIDGE = 50, 0.15, 1e-3
MEMORY = 300_000  # words whose scores a task remembers
NEW_WORDS = 50_000  # words whose features are made at once
SLICE = 8_000_000  # characters handled at once
SEED = 11
UNKNOWN = "und"


class Model(NamedTuple):
    labels: tuple[str, ...]
    weights: np.ndarray  # (BUCKETS, labels): of word features
    moves: np.ndarray  # (labels, labels): scores from one word's label to the next one's
    start: np.ndarray
    lexicon: dict[str, int]  # word -> bit set of the languages whose lexicon holds it


def tokens_of(text: str) -> list[str]:
    """The words of a text, in order; runs of more than ``LONGEST`` characters are cut into equal consecutive pieces.

    Scripts without blanks make a word of a whole sentence or text, and each piece gets its own label.
    """
    words = words_of(text)
    if max(map(len, words), default=0) <= LONGEST:
        return words
    out = []
    for w in words:
        if len(w) <= LONGEST:
            out.append(w)
        else:
            n = -(-len(w) // LONGEST)
            out += [w[len(w) * i // n : len(w) * (i + 1) // n] for i in range(n)]
    return out


def word_features(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of lower-case words, one word's after the other's, and their number per word.

    In order: its first 1 to 3 letters, its last 1 to 4, its letter groups with the ends marked, its
    lexicon entries and its kind.
    """
    size = np.fromiter(map(len, words), np.int64, len(words))
    data = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-8", "surrogatepass"), np.uint8)
    at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))  # where each character starts
    first = np.cumsum(size + 2) - size - 1  # each word's first character, and the one past its last
    last = first + size
    entries = [lexicon.get(w) for w in words]
    known = np.array([e is not None for e in entries], bool)
    counts = size + 8 + 2 * known
    starts = np.cumsum(counts) - counts
    out = np.empty(counts.sum(), np.int64)
    for n in (1, 2, 3):
        out[starts + n - 1] = _buckets(data, at[first], at[np.minimum(first + n, last)], b"p")
    for n in (1, 2, 3, 4):
        out[starts + n + 2] = _buckets(data, at[np.maximum(last - n, first)], at[last], b"s")
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    group = np.repeat(first - 1, size) + inside
    out[np.repeat(starts + 7, size) + inside] = _buckets(data, at[group], at[group + 3])
    for i in np.flatnonzero(known).tolist():
        end = starts[i] + counts[i]
        out[end - 3 : end - 1] = _bucket(f"w{words[i]}"), _bucket(f"l{entries[i]}")
    kinds = {kind: _bucket(kind) for kind in "dnau"}
    out[starts + counts - 1] = [kinds["d" if w.isdigit() else "n" if any(map(str.isdigit, w)) else "a" if w.isascii() else "u"] for w in words]
    return out, counts


def _features_in_goes(words: Iterable[str], lexicon: dict[str, int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``word_features`` of any number of words, ``NEW_WORDS`` at a time."""
    left = iter(words)
    while some := list(itertools.islice(left, NEW_WORDS)):
        yield word_features(some, lexicon)


def _bucket(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % BUCKETS


#: The table of CRC-32: what each low byte of the state does to the rest of it.
_CRC = np.array([zlib.crc32(bytes([b ^ 0xFF])) ^ 0xFF000000 for b in range(256)], np.uint32)


def _buckets(data: np.ndarray, start: np.ndarray, end: np.ndarray, prefix: bytes = b"") -> np.ndarray:
    """``zlib.crc32(prefix + data[start:end]) % BUCKETS`` of many short pieces, byte by byte."""
    state = np.full(len(start), zlib.crc32(prefix) ^ 0xFFFFFFFF, np.uint32)
    size = end - start
    for i in range(int(size.max(initial=0))):
        on = slice(None) if i < size.min() else np.flatnonzero(size > i)
        now = state[on]
        state[on] = _CRC[(now ^ data[start[on] + i]) & np.uint32(0xFF)] ^ (now >> np.uint32(8))
    return ((state ^ np.uint32(0xFFFFFFFF)) % np.uint32(BUCKETS)).astype(np.int64)


def forward_backward(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Label chances of every word, summed chances of label pairs, and log-likelihood normaliser of all sequences.

    ``scores`` has the words of the sequences one after the other. All sequences advance one word
    at a time, longest first, so that each step is one product for those that are not yet at their end.
    """
    order = np.argsort(-lengths, kind="stable")
    firsts = (np.cumsum(lengths) - lengths)[order]
    lengths = lengths[order]
    alive = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), "right") if len(lengths) else []
    emit = np.exp(scores - scores.max(1, keepdims=True))
    alpha, beta, scale = np.empty_like(emit), np.empty_like(emit), np.empty(len(emit), emit.dtype)
    step, first = np.exp(moves).astype(emit.dtype), np.exp(start).astype(emit.dtype)
    before = np.broadcast_to(first, (len(lengths), len(first)))
    for t, n in enumerate(alive):
        at = firsts[:n] + t
        now = before[:n] * emit[at]
        total = now.sum(1)
        now /= total[:, None]
        alpha[at], scale[at] = now, total
        before = now @ step
    pairs = np.zeros_like(step)
    after = np.ones((len(lengths), len(first)), emit.dtype)
    for t in range(len(alive) - 1, -1, -1):
        n = alive[t]
        at = firsts[:n] + t
        beta[at] = after[:n]
        if t:
            back = after[:n] * emit[at] / scale[at][:, None]
            pairs += alpha[at - 1].T @ back
            after[:n] = back @ step.T
    chances = alpha * beta
    chances /= chances.sum(1, keepdims=True)
    return chances, pairs * step, float(np.log(scale).sum() + scores.max(1).sum())


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", rows: int = SAMPLE) -> Model:
    """Fit on at most ``rows`` keys of every language; null languages, texts and keys are left out.

    The cost of fitting grows with texts times languages. That product is bounded by ``TEXTS``, shared
    evenly: 300 texts each up to 64 languages, 39 at 176, one at least. No language is left out.

    The keys are chosen first, so that no text is moved before it is known to be in the sample.

    Training sequences join stretches of texts of different languages, so that the learned
    transitions allow for code switching. Without labelled texts the model knows no label.
    """
    known = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).alias("l")).filter("t is not null and l is not null and k is not null")
    languages = known.select("l").distinct().count()
    chosen = bounded_sample(known.select("k", "l"), "l", texts_each(languages, rows), "lang", "k")
    few = known.join(F.broadcast(chosen.distinct()), ["k", "l"])
    sample = sorted(((r["l"], tokens_of(r["t"])) for r in few.select("l", "t").collect()), key=lambda x: (x[0], len(x[1]), x[1][:20]))
    return fit_texts([s for s in sample if s[1]])


def texts_each(languages: int, rows: int = SAMPLE) -> int:
    """Texts of each language that are fitted on, at most."""
    return min(rows, max(1, TEXTS // max(1, languages) ** 2))


def fit_texts(sample: list[tuple[str, list[str]]], steps: int = STEPS) -> Model:
    labels = tuple(sorted({label for label, _ in sample}))
    n = len(labels)
    if not n:
        return Model((), np.zeros((BUCKETS, 0)), np.zeros((0, 0)), np.zeros(0), {})
    lexicon: dict[str, int] = {}
    place = {label: k for k, label in enumerate(labels)}
    counts = [Counter() for _ in labels]
    for label, words in sample:
        counts[place[label]].update(words)
    for k, own in enumerate(counts):
        for w, _ in sorted(own.items(), key=lambda x: (-x[1], x[0]))[:LEXICON]:
            lexicon[w] = lexicon.get(w, 0) | 1 << k
    index: dict[str, int] = {}
    coded = [(place[label], np.array([index.setdefault(w, len(index)) for w in words])) for label, words in sample]
    sequences = _switching(coded, np.random.default_rng(SEED))
    features = []
    for flat, sizes in _features_in_goes(index, lexicon):
        features += np.split(flat, np.cumsum(sizes)[:-1])
    seen = {"w": np.zeros((BUCKETS, n)), "m": np.zeros((n, n)), "s": np.zeros(n)}
    parts, step = [], max(1, CELLS // (n * SEGMENT))
    for first in range(0, len(sequences), step):
        some = sequences[first : first + step]
        words, truth = (np.concatenate([s[i] for s in some]) for i in (0, 1))
        lengths = np.array([len(s[0]) for s in some])
        used, words = np.unique(words, return_inverse=True)
        owner = np.repeat(np.arange(len(used)), [len(features[i]) for i in used])
        feature = np.concatenate([features[i] for i in used])
        inner = np.ones(len(words), bool)
        inner[np.cumsum(lengths) - lengths] = False
        for k in range(n):
            seen["w"][:, k] += np.bincount(feature, np.bincount(words, truth == k, len(used))[owner], BUCKETS)
        seen["m"] += np.bincount(truth[:-1][inner[1:]] * n + truth[1:][inner[1:]], minlength=n * n).reshape(n, n)
        seen["s"] += np.bincount(truth[~inner], minlength=n)
        parts.append((words, lengths, len(used), owner, feature, inner))
    held = {"w": np.zeros((BUCKETS, n)), "m": np.zeros((n, n)), "s": np.zeros(n)}
    mean, square = ({k: np.zeros_like(v) for k, v in held.items()} for _ in range(2))
    for step in range(1, steps + 1):
        expected = {k: np.zeros_like(v) for k, v in held.items()}
        for words, lengths, used, owner, feature, inner in parts:
            by_word = np.stack([np.bincount(owner, held["w"][feature, k], used) for k in range(n)], 1)
            chances, pairs, _ = forward_backward(by_word[words], lengths, held["m"], held["s"])
            for k in range(n):
                told = np.bincount(words, chances[:, k], used)
                expected["w"][:, k] += np.bincount(feature, told[owner], BUCKETS)
            expected["m"] += pairs
            expected["s"] += chances[~inner].sum(0)
        for k, x in held.items():
            slope = (seen[k] - expected[k]) / len(sequences) - RIDGE * x
            mean[k] = 0.9 * mean[k] + 0.1 * slope
            square[k] = 0.99 * square[k] + 0.01 * slope**2
            x += RATE * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
    return Model(labels, held["w"].astype(np.float32), held["m"].astype(np.float32), held["s"].astype(np.float32), lexicon)


def _switching(coded: list[tuple[int, np.ndarray]], rnd: np.random.Generator) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sequences of ``SEGMENT`` words that use every word of the sample once, cut into stretches and shuffled."""
    stretches = []
    for label, words in coded:
        at = 0
        while at < len(words):
            size = int(rnd.integers(*SWITCH))
            stretches.append((label, words[at : at + size]))
            at += size
    order = rnd.permutation(len(stretches))
    words = np.concatenate([stretches[i][1] for i in order])
    truth = np.concatenate([np.full(len(stretches[i][1]), stretches[i][0]) for i in order])
    return [(words[i : i + SEGMENT], truth[i : i + SEGMENT]) for i in range(0, len(words), SEGMENT)]


class _Places(dict):
    """Numbers of words, given in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        place = self[word] = len(self)
        return place


class Labeller:
    """Label chances of the words of texts under a model; the scores of words are remembered."""

    def __init__(self, model: Model):
        self.model = model
        self.places = _Places()
        self.scores = np.empty((0, len(model.labels)), np.float32)

    def chances(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """(chances of all words one after the other, words per text)."""
        if len(self.places) > _share(MEMORY, self.model):
            self.places, self.scores = _Places(), self.scores[:0]
        lengths = np.array([len(words) for words in texts])
        ids = np.fromiter(map(self.places.__getitem__, itertools.chain.from_iterable(texts)), np.int64, lengths.sum())
        new = itertools.islice(self.places, len(self.scores), None)
        for flat, sizes in _features_in_goes(new, self.model.lexicon):
            self.scores = np.concatenate((self.scores, np.add.reduceat(self.model.weights[flat], np.cumsum(sizes) - sizes, axis=0)))
        filled = lengths > 0
        if not filled.any():
            return np.empty((0, len(self.model.labels)), np.float32), lengths
        return forward_backward(self.scores[ids], lengths[filled], self.model.moves, self.model.start)[0], lengths


def _share(bound: int, model: Model) -> int:
    """A bound meant for up to eight languages, less for models with more: what is held grows with both."""
    return bound * 8 // max(8, len(model.labels))


def identify(text: Column, model: Model) -> Column:
    """Struct (lang, score, mix) per text.

    ``lang`` is the label with the largest mean chance over the words, ``score`` that mean, ``mix``
    the share of words per likeliest label, largest first. A null text, one without any letter, and
    every text under a model without labels is ``und`` with score 0 and no mix.
    """

    @F.arrow_udf(DataType.fromDDL("struct<lang:string,score:double,mix:array<struct<lang:string,share:double>>>"))
    def identified(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        labeller, labels = Labeller(model), model.labels
        for batch in batches:
            out = []
            for texts in in_slices((t.as_py() or "" for t in batch), _share(SLICE, model)):
                split = [tokens_of(t) if labels and any(map(str.isalpha, t)) else [] for t in texts]
                chances, lengths = labeller.chances(split)
                filled = np.flatnonzero(lengths)
                rows = [(UNKNOWN, 0.0, [])] * len(texts)
                if len(filled):
                    starts = (np.cumsum(lengths) - lengths)[filled]
                    means = np.add.reduceat(chances.astype(np.float64), starts, axis=0) / lengths[filled, None]
                    best = np.argmax(chances, 1)
                    shares = np.add.reduceat(np.eye(len(labels), dtype=np.float32)[best], starts, axis=0, dtype=np.float64) / lengths[filled, None]
                    for i, mean, share in zip(filled.tolist(), means, shares):
                        k = int(mean.argmax())
                        mix = [{"lang": labels[j], "share": float(share[j])} for j in np.argsort(-share, kind="stable") if share[j]]
                        rows[i] = (labels[k], min(1.0, float(mean[k])), mix)
                out += rows
            yield pa.array([{"lang": a, "score": b, "mix": c} for a, b, c in out], _IDENTIFIED)

    return identified(text)


_IDENTIFIED = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("mix", pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))])


def label_words(text: Column, model: Model) -> Column:
    """The likeliest language of each token (``tokens_of``), in order: the spans of code-switched text. Null and empty texts have none."""

    @F.arrow_udf("array<string>")
    def labelled(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        labeller = Labeller(model)
        for batch in batches:
            out = []
            for texts in in_slices((t.as_py() or "" for t in batch), _share(SLICE, model)):
                chances, lengths = labeller.chances([tokens_of(t) if model.labels else [] for t in texts])
                best = iter(np.argmax(chances, 1).tolist() if len(chances) else ())
                out += [[model.labels[next(best)] for _ in range(n)] for n in lengths.tolist()]
            yield pa.array(out, pa.list_(pa.string()))

    return labelled(text)
