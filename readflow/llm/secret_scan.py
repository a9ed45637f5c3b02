"""Secret scans: fixed credential patterns, and guess-cost estimates of the values in credential context."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from functools import cache

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType

# The base kinds in their order, and their patterns.
BASE_KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs of 24 and more: a shorter run fails, and a longer one is taken whole
ASSIGN_CHARS, ACCESS_CHARS = 6, 20

#: Kind of the spans that the guess-cost method adds: values in credential context that are hard to guess.
GUESS = "guess"
#: ``key`` is a word, the last part of a name (SECRET_KEY, apiKey, api key) or ends one of the names listed, but not turkey. After : or = the scheme of an authorization header is not the value.
#: Behind blanks alone the value is only looked at, so that what follows is searched as well.
CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|(?:(?<![a-z])|(?-i:(?=K))|(?:api|access|secret|private|auth|session|master|shared|account|ssh|encryption|signing|license))key|client[_-]?id|credentials?|auth(?:orization)?|bearer)["']?\s*(?:=>|[:=])\s*(?:(?:bearer|basic|digest|token)[ \t]+)?(?:"([^"\n]+)"|'([^'\n]+)'|([^\s"',;]+))|(?:authorization|bearer)[ \t]+(?=([^\s"',;]+))""",
    re.A | re.I)
_WORDS = re.compile(r"(?:[A-Z]?[a-z]+|[A-Z]+)(?:[-./:!?)\]]+(?:[A-Z]?[a-z]+|[A-Z]+))*[-./:!?)\]]*")
CONTEXT_KEYS = (b"pass", b"pwd", b"secret", b"token", b"api", b"key", b"client", b"credential", b"auth", b"bearer")
MIN_BITS = 40.0
PROSE_SIGNS = "-.,:;!?()[]…'"
MIN_CHARS = 8

# Frequent parts of chosen passwords, most frequent first.
COMMON_WORDS = (
    "password pass admin root user login welcome letmein master secret token test guest default changeme example sample demo "
    "hello monkey dragon shadow sunshine princess football baseball superman batman trustno iloveyou love summer winter spring "
    "autumn monday friday january february march april may june july august september october november december server database "
    "system manager service public private access key true false null none your here value string code name data file home "
    "office company project dev prod staging local host mysql postgres oracle redis mongo docker cloud"
).split()
KEYBOARD_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
LEET = str.maketrans("@4310$57!", "aaeiossti")

#: The file of a public tokenizer: its whole words, in the order in which it learned them, are words of common language by frequency.
DICTIONARY = "word_bpe_49k.json"
WORD_END = "</w>"
LONGEST_WORD = 24


@cache
def word_ranks() -> dict[str, int]:
    """Ranks from 1: parts of chosen passwords, then the words of letters (3 to ``LONGEST_WORD``) of the tokenizer's vocabulary.

    The vocabulary is a fixed file of some 49,000 entries, read once per process.
    """
    with open(public_tokenizers.path(DICTIONARY), encoding="utf-8") as f:
        entries = json.load(f)["model"]["vocab"]
    ends = [w.removesuffix(WORD_END) for w in sorted(entries, key=entries.__getitem__) if w.endswith(WORD_END)]
    words = [*COMMON_WORDS, *(w for w in ends if 3 <= len(w) <= LONGEST_WORD and w.isascii() and w.isalpha())]
    return {w: i for i, w in enumerate(dict.fromkeys(words), 1)}

_PLACE = {c: (y, x) for y, row in enumerate(KEYBOARD_ROWS) for x, c in enumerate(row)}
_DATE = re.compile(r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d|(?:19|20)\d\d")
_ALPHABET = ((str.isdigit, 10), (str.islower, 26), (str.isupper, 26))


def _char_bits(c: str) -> float:
    if not c.isascii():
        return 10.0
    return math.log2(next((n for test, n in _ALPHABET if test(c)), 33))


def _adjacent(a: str, b: str) -> bool:
    """Neighbours on the keyboard, or neighbours in code order among letters or digits."""
    if a.isalnum() and b.isalnum() and a.isascii() and b.isascii() and abs(ord(a) - ord(b)) == 1:
        return True
    p, q = _PLACE.get(a.lower()), _PLACE.get(b.lower())
    return bool(p and q) and p != q and abs(p[0] - q[0]) <= 1 and abs(p[1] - q[1]) <= 1


def guess_bits(value: str) -> float:
    """log2 of the guesses a value costs: its cheapest cut into words, dates, repeats, walks and brute-force characters.

    ``best[i]`` is the least cost of the first i characters. Repeats and walks are cheaper the longer
    they are, so only the whole rest of a run is tried from each start; every step looks at a bounded
    number of pieces, which makes the cost linear in the length. Every piece but brute force pays one
    bit for its kind and its place. The empty value costs 0.
    """
    ranks = word_ranks()
    n = len(value)
    plain = value.lower()
    leet = plain.translate(LEET)
    repeat_end, walk_end = [0] * n, [0] * n
    for i in range(n - 1, -1, -1):
        more = i + 1 < n
        repeat_end[i] = repeat_end[i + 1] if more and value[i] == value[i + 1] else i + 1
        walk_end[i] = walk_end[i + 1] if more and _adjacent(value[i], value[i + 1]) else i + 1
    best = [math.inf] * (n + 1)
    best[0] = 0.0
    for i in range(n):
        at = best[i]

        def offer(end: int, bits: float) -> None:
            if at + bits < best[end]:
                best[end] = at + bits

        offer(i + 1, _char_bits(value[i]))
        if repeat_end[i] - i >= 3:
            offer(repeat_end[i], 1 + _char_bits(value[i]) + math.log2(repeat_end[i] - i))
        if walk_end[i] - i >= 3:
            length = walk_end[i] - i
            offer(walk_end[i], 1 + math.log2(len(_PLACE)) + math.log2(length) + 0.5 * length)
        for end in range(i + 3, min(n, i + LONGEST_WORD) + 1):
            rank = ranks.get(plain[i:end])
            if rank is None and (rank := ranks.get(leet[i:end])) is not None:
                rank *= 4
            if rank is not None:
                piece = value[i:end]
                case = 0.0 if piece.islower() else 1.0 if piece.isupper() or piece.istitle() else float(end - i)
                offer(end, 1 + math.log2(rank + 1) + case)
        if value[i].isdigit() and (date := _DATE.match(value, i)):
            offer(date.end(), 1 + math.log2(366 * 100 if date.end() - i > 4 else 100))
    return best[n]


def is_prose(value: str) -> bool:
    """Blank-separated words (two or more), all of them, but for signs around them, in the dictionary: a sentence or title."""
    words = value.lower().split()
    return len(words) > 1 and all((w := x.strip(PROSE_SIGNS)) in word_ranks() or len(w) < 3 and w.isalpha() for x in words)


def find_spans(text: str) -> list[tuple[int, int, str, float]]:
    """(start, end, kind, bits) by start, then kind as listed; code points, end exclusive.

    The base kinds take their whole matches, leftmost and without overlap per kind, and carry the
    guess cost of the value (group 2 of ``assign``). ``guess`` takes the values in credential context
    of at least ``MIN_CHARS`` characters that cost ``MIN_BITS`` or more; behind a blank alone (``bearer
    certificates``) plain words are not values, nor are several words in quotation marks (``is_prose``) unless a password is
    named before them. A text without any of the
    cheap signs (key words, AKIA, a run of 24 hex digits) is not searched further.
    """
    raw = text.encode("utf-8", "surrogatepass")
    low = raw.lower()
    spans: list[tuple[int, int, int, float]] = []
    if any(k in low for k in CONTEXT_KEYS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= ASSIGN_CHARS:
                spans.append((m.start(), m.end(), 0, guess_bits(m[2])))
        for m in CONTEXT.finditer(text):
            value = m[m.lastindex]
            if m.lastindex == 4 and _WORDS.fullmatch(value) or m.lastindex < 3 and m[0][:1] not in "pP" and is_prose(value):
                continue
            if len(value) >= MIN_CHARS and (bits := guess_bits(value)) >= MIN_BITS:
                spans.append((m.start(m.lastindex), m.end(m.lastindex), 3, bits))
    if b"AKIA" in raw:
        spans += [(m.start(), m.end(), 1, guess_bits(m[0])) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_CHARS]
    if _HEX_RUN in raw.translate(_HEX_TABLE):
        spans += [(m.start(), m.end(), 2, guess_bits(m[0])) for m in HEX.finditer(text)]
    kinds = (*BASE_KINDS, GUESS)
    return [(s, e, kinds[k], b) for s, e, k, b in sorted(spans, key=lambda x: (x[0], x[2], x[1]))]


_HEX_TABLE = bytes(1 if chr(c) in "0123456789abcdef" else 0 for c in range(256))
_HEX_RUN = b"\x01" * 24

SPAN_TYPE = "array<struct<start:int,end:int,kind:string,bits:double>>"
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("bits", pa.float64())]))


def secret_spans(text: Column) -> Column:
    """The spans of ``find_spans`` per text; null and empty texts have none."""

    @F.arrow_udf(DataType.fromDDL(SPAN_TYPE))
    def spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [[dict(zip(("start", "end", "kind", "bits"), s)) for s in find_spans(t)] if t else [] for t in map(_plain, batch)]
            yield pa.array(found, _ARROW_SPANS)

    return spans(text)


def _plain(scalar: pa.Scalar) -> str | None:
    return scalar.as_py()


def redact(text: str) -> str:
    """``text`` with each span, overlapping ones merged, replaced by ``<kind>`` of its first."""
    out, at = [], 0
    merged: list[list] = []
    for start, end, kind, _ in find_spans(text):
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end, kind])
    for start, end, kind in merged:
        out += [text[at:start], f"<{kind}>"]
        at = end
    return "".join([*out, text[at:]])


def redacted(text: Column) -> Column:
    """Each text without its secrets; null stays null, texts without secrets stay as they are."""

    @F.arrow_udf("string")
    def cleaned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([redact(t) if t else t for t in map(_plain, batch)], pa.string())

    return cleaned(text)


def span_list(spans: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """``kind:start:end`` of the spans (of ``kinds``), comma-joined in their order."""
    chosen = spans if kinds is None else F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
