"""Exact order statistics by radix selection: the values are neither sorted nor ranged nor numbered.

Values become 64-bit keys in their own order. A round counts the keys that share the digits found so
far by their next digit, and keeps for each wanted rank the digit that holds it. Keys that differ in
few bits (counts of anything) need one or two rounds, doubles of all sizes at most six; once some
thousands of rows are left, one round settles all their digits.
"""

from __future__ import annotations

import math
import struct
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from readflow.session import materialize

DIGIT = 12  # bits; a round has at most 4,096 counters per wanted rank
_LOW_BITS = 0x7FFF_FFFF_FFFF_FFFF


def sortable_key(value: Column, kind: str) -> Column:
    """A bigint in the order of ``value``: integers are their own key, of other numbers the bits of the double (NaN last)."""
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return value.cast("bigint")
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value.cast("double") + 0.0).cast("bigint")
    return F.when(bits < 0, bits.bitwiseXOR(F.lit(_LOW_BITS))).otherwise(bits)


def value_of(key: int, kind: str) -> float:
    """The number of a ``sortable_key``, as double."""
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return float(key)
    return struct.unpack("<d", struct.pack("<q", key ^ _LOW_BITS if key < 0 else key))[0]


@dataclass(frozen=True)
class Values:
    """Non-NULL values stored once as (value, key, n), with their number and the ends of their keys."""

    table: DataFrame
    kind: str
    rows: int
    first: int
    last: int


def stored_values(df: DataFrame, value: str, counted: bool = True) -> Values:
    """Store the values of a column; ``counted`` merges equal values first, which pays where many are equal."""
    kind = dict(df.dtypes)[value]
    some = df.select(F.col(value).alias("value")).filter(F.col("value").isNotNull())
    some = some.groupBy("value").agg(F.count(F.lit(1)).alias("n")) if counted else some.withColumn("n", F.lit(1).cast("bigint"))
    table = materialize(some.select("value", sortable_key(F.col("value"), kind).alias("key"), "n"), "values")
    ends = table.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.min("key").alias("a"), F.max("key").alias("b")).first()
    return Values(table, kind, ends["n"], ends["a"], ends["b"])


def select_ranks(values: Values, ranks: list[int]) -> dict[int, float]:
    """The values at ``ranks`` (from 0) in ascending order. The counters of a round come back, at most 2**DIGIT per rank."""
    bits = (values.first ^ values.last).bit_length() if (values.first < 0) == (values.last < 0) else 64
    shared = values.first >> bits if bits < 64 else 0
    found = {r: (shared, r) for r in set(ranks)}  # rank -> digits so far, rank among the keys that share them
    left = values.rows
    while bits:
        # few enough keys left: all their digits at once
        width, bits = bits, 0 if left <= 1 << DIGIT else max(0, bits - DIGIT)
        prefix = F.shiftright("key", width) if width < 64 else F.lit(0).cast("bigint")
        some = values.table.filter(prefix.isin([p for p, _ in set(found.values())]))
        counts = some.groupBy(prefix.alias("prefix"), F.shiftright("key", bits).alias("next")).agg(F.sum("n").alias("n"))
        ordered: dict[int, list[tuple[int, int]]] = {}
        for r in counts.collect():
            ordered.setdefault(r["prefix"], []).append((r["next"], r["n"]))
        upto = {p: np.cumsum([n for _, n in sorted(own)]) for p, own in ordered.items()}
        step, held = {}, {}
        for p, inner in set(found.values()):
            i = int(np.searchsorted(upto[p], inner, "right"))
            digits, n = sorted(ordered[p])[i]
            step[p, inner], held[digits] = (digits, inner - int(upto[p][i]) + n), n
        left, found = sum(held.values()), {r: step[at] for r, at in found.items()}
    return {r: value_of(key, values.kind) for r, (key, _) in found.items()}


def select_quantiles(values: Values, probabilities: list[float]) -> list[float | None]:
    """Exact quantiles, linear between ranks; of no values at all they are None."""
    if not values.rows:
        return [None] * len(probabilities)
    places = [(values.rows - 1) * float(p) for p in probabilities]
    at = select_ranks(values, [end(x) for x in places for end in (math.floor, math.ceil)])

    def between(x: float) -> float:
        low, high, share = at[math.floor(x)], at[math.ceil(x)], x - math.floor(x)
        return low if low == high or not share else low * (1 - share) + high * share

    return [between(x) for x in places]
