"""What several text operators share: words, ASCII lower case, row keys, bounded samples of labelled rows."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from readflow.session import materialize

#: A word: letters and digits of ASCII (after lower-casing) and everything beyond ASCII.
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = re.compile(WORD_PATTERN)
NOT_WORD_PATTERN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: str) -> str:
    """Lower-case A-Z and nothing else, as ``bytes.lower`` does; a table of letters takes some ten times as long."""
    return text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def words_of(text: str) -> list[str]:
    return WORD.findall(ascii_lower(text))


def lowered(text: Column) -> Column:
    """``ascii_lower`` as a column; the general form is only taken where a text leaves ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def word_array(text: Column) -> Column:
    """``words_of`` as a column; null gives an empty array."""
    return F.array_remove(F.split(lowered(F.coalesce(text, F.lit(""))), NOT_WORD_PATTERN), "")


def spare_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def crc_mod(key: Column, n: int) -> Column:
    """crc32 of a key's text, modulo ``n``; null counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n


def share_order(key: Column, salt: str) -> Column:
    """A fixed pseudo-random number of a key, for choosing bounded samples."""
    return F.xxhash64(F.lit(salt), key)


def bounded_sample(df: DataFrame, by: str, rows: int, salt: str, key: str = "doc_id") -> DataFrame:
    """At most ``rows`` rows of each value of ``by``: those with the smallest hash of ``key``.

    Spark keeps ``rows`` rows of a value per task before it shuffles, so a value that holds most
    rows costs no more than any other.
    """
    rank = spare_name(df, "_rank")
    order = W.partitionBy(by).orderBy(share_order(F.col(key), salt), F.col(key))
    return df.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= rows).drop(rank)


#: Rows of ids up to which a table is broadcast (some 100 bytes each in memory); larger ones are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def broadcast_if_small(ids: DataFrame, name: str) -> DataFrame:
    """A narrow table, written once and counted: marked for broadcast up to ``BROADCAST_ROWS`` rows, left as it is beyond.

    It spares joins that pick few documents a shuffle of all texts.
    """
    stored = materialize(ids, name)
    return F.broadcast(stored) if stored.count() <= BROADCAST_ROWS else stored


def in_slices(texts: Iterable[str], chars: int = 1_000_000) -> Iterator[list[str]]:
    """Texts in order, in lists of about ``chars`` characters, so that a batch of long texts stays small."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text) + 1
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held


def release_memory() -> None:
    """Give freed memory back to the system at the end of a task, as the worker lives on for other tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not the GNU C library
        pass
