"""Text cleaning."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# What the cleaner removes, in this order, and the stop words of the default language.
URL_PATTERN = r"(https?:\/\/\S+)|(www\.\S+)"
TAG_PATTERN = r"<[^>]+>"
DISALLOWED_PATTERN = r"""[^A-Za-z0-9ÁÉÍÓÚÀÈÌÒÙÂÊÎÔÛÃÕÇáéíóúàèìòùâêîôûãõç\s!"#$%&\'()*+,\-./:;<=>?@\[\]\\^_`{|}~]"""
BLANKS_PATTERN = r"\s+"
# Runs of what DISALLOWED_PATTERN matches, for texts of characters up to U+FFFF. Java tries negated classes and ranges over surrogates code point by
# code point, which takes many times as long as a list of plain characters.
DISALLOWED_PLAIN = "[" + "".join(
    f"\\x{i:02x}" for i in range(256) if re.match(DISALLOWED_PATTERN, chr(i), re.ASCII)) + r"\u0100-\uD7FF\uE000-\uFFFF]+"
PORTUGUESE_STOP_WORDS = [
    "a", "o", "as", "os", "um", "uma", "para", "com", "de", "do", "da", "em", "no", "na",
    "e", "que", "é", "dos", "das", "se", "por", "como", "mas", "mais", "ou",
    "não", "já", "tudo", "todos", "todas", "nada", "algum", "alguma", "alguns", "algumas",
    "quem", "onde", "quando", "porque", "pelo", "pela",
    "meu", "minha", "teu", "tua", "seu", "sua", "nosso", "nossa", "deles", "delas", "isso",
    "aquilo", "isto", "aqui", "ali", "lá", "aquela", "aquele", "aquelas", "aqueles",
]


def beyond_plain(c: Column) -> Column:
    """True for texts with characters beyond U+FFFF: UTF-8 begins those, and nothing else, with bytes F0 to F4."""
    written = c.cast("binary")
    found = F.lit(False)
    for first in range(0xF0, 0xF5):
        found = found | F.contains(written, F.lit(bytes([first])))
    return found


def clean_text(c: Column) -> Column:
    """Drop URLs, tags and characters outside the allowed set, squeeze blanks, lower, trim; patterns that cannot match a text are passed over."""
    bare = F.regexp_replace(F.regexp_replace(c, URL_PATTERN, ""), TAG_PATTERN, "")
    marked = c.contains("http") | c.contains("www.") | c.contains("<")
    text = (
        F.when(beyond_plain(c), F.regexp_replace(bare, DISALLOWED_PATTERN, ""))
        .when(marked, F.regexp_replace(bare, DISALLOWED_PLAIN, "")).otherwise(F.regexp_replace(c, DISALLOWED_PLAIN, "")))
    return F.coalesce(F.trim(F.lower(F.regexp_replace(text, BLANKS_PATTERN, " "))), F.lit(""))
