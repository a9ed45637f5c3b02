"""Small column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F


def epoch_seconds(as_of: datetime | str | int | float | None) -> Column:
    """Reference time as epoch seconds; ``None`` means the time the query starts."""
    if as_of is None:
        return F.unix_timestamp()
    if isinstance(as_of, str):
        as_of = datetime.fromisoformat(as_of)
    if isinstance(as_of, datetime):
        if as_of.tzinfo is None:
            as_of = as_of.replace(tzinfo=timezone.utc)
        as_of = as_of.timestamp()
    return F.lit(int(as_of)).cast("bigint")


def lenient_long(c: Column) -> Column:
    """String to bigint: decimals are cut off, anything that is no number becomes NULL."""
    return F.regexp_replace(F.trim(c), r"\.\d*$", "").try_cast("bigint")


def apply_present(df: DataFrame, names: Iterable[str], fn: Callable[[Column], Column]) -> DataFrame:
    """Apply ``fn`` in place to those of ``names`` that ``df`` has."""
    return df.withColumns({n: fn(F.col(n)) for n in names if n in df.columns})


def with_row(df: DataFrame, row: DataFrame, name: str) -> DataFrame:
    """Add a one-row frame as a struct column.

    It becomes one scalar subquery, run once, however often its fields are used afterwards; naming
    the subquery in every expression instead would repeat its plan each time.
    """
    return df.withColumn(name, row.select(F.struct(*row.columns)).scalar())


def md5_number(c: Column, hex_digits: int = 8) -> Column:
    """The first hex digits of a string's MD5 as a bigint: stable over engines and partitionings."""
    return F.conv(F.substring(F.md5(c), 1, hex_digits), 16, 10).cast("bigint")


SHARE_DIGITS = 15  # hex digits of the hash that shares are compared with


def hash_share(ratio: float, *keys: str, purpose: str, seed: int = 42) -> Column:
    """True for a share ``ratio`` of the keys, the same on every run.

    Shares of different purposes are independent of each other, so that a sample can be split again.
    """
    number = md5_number(F.concat_ws("|", *[F.col(k) for k in keys], F.lit(purpose), F.lit(str(seed))), SHARE_DIGITS)
    return number < int(ratio * 16**SHARE_DIGITS)


def round_doubles(df: DataFrame, digits: int = 6, skip: Iterable[str] = ()) -> DataFrame:
    """Round every double column except those in ``skip``."""
    names = [n for n, t in df.dtypes if t == "double" and n not in set(skip)]
    return df.withColumns({n: F.round(n, digits) for n in names}) if names else df
