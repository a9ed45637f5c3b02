"""Shards by a hierarchical weighted hash tree: region, rack and shard are drawn level by level."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from readflow.functions.columns import md5_number
from readflow.llm.ranks import with_rank

RACK_SHARDS, REGION_RACKS = 4, 2


class Leaf(NamedTuple):
    region: int
    rack: int
    shard: int
    weight: float


def regular_tree(shards: int, rack_shards: int = RACK_SHARDS, region_racks: int = REGION_RACKS) -> list[Leaf]:
    """``shards`` leaves of weight 1, in racks of ``rack_shards`` and regions of ``region_racks`` racks.

    With the defaults a region holds 8 shards, so the shard after a full region opens a region of
    its own and can draw rows to itself only.
    """
    if shards < 1:
        raise ValueError("a tree needs a shard")
    return [Leaf(s // (rack_shards * region_racks), s // rack_shards, s, 1.0) for s in range(shards)]


def _draw(key: Column, children: list[tuple[int, float]], level: str) -> Column:
    """The child with the smallest exponential draw −ln(u)/weight; u depends on key, level and child alone."""
    if len(children) == 1:
        return F.lit(children[0][0])
    draws = [
        F.struct(
            (-F.log((md5_number(F.concat_ws(":", F.lit(level), F.lit(str(child)), key)) + 0.5) / float(16**8)) / F.lit(weight)).alias("d"),
            F.lit(child).alias("c"))
        for child, weight in children
    ]
    return F.least(*draws)["c"]


def shard_of(key: Column, tree: list[Leaf]) -> Column:
    """The shard of a key (a string column; null counts as the empty text).

    At each level a child is drawn with a chance in proportion to the weight of its subtree. When a
    leaf's weight changes, only draws of the subtrees that hold it change: a subtree whose weight
    grew only gains keys, one whose weight fell only loses them, and keys that stay in a subtree
    without change keep their rack and shard.
    """
    leaves = [leaf for leaf in tree if leaf.weight > 0]
    if not leaves:
        raise ValueError("no leaf has weight")
    key = F.coalesce(key, F.lit(""))

    def weights(level: str, inside: list[Leaf]) -> list[tuple[int, float]]:
        names = sorted({getattr(leaf, level) for leaf in inside})
        return [(n, sum(leaf.weight for leaf in inside if getattr(leaf, level) == n)) for n in names]

    def chosen(node: Column, level: str, inside: list[Leaf], below) -> Column:
        names = sorted({getattr(leaf, level) for leaf in inside})
        parts = [(n, below([leaf for leaf in inside if getattr(leaf, level) == n])) for n in names]
        if len(parts) == 1:
            return parts[0][1]
        return reduce(lambda c, p: c.when(node == p[0], p[1]), parts[1:], F.when(node == parts[0][0], parts[0][1]))

    def in_rack(inside: list[Leaf]) -> Column:
        return _draw(key, [(leaf.shard, leaf.weight) for leaf in sorted(inside, key=lambda x: x.shard)], "shard")

    def in_region(inside: list[Leaf]) -> Column:
        return chosen(_draw(key, weights("rack", inside), "rack"), "rack", inside, in_rack)

    return chosen(_draw(key, weights("region", leaves), "region"), "region", leaves, in_region)


def shard_documents(docs: DataFrame, tree: list[Leaf], grown: list[Leaf] | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, size, text_crc32, shard, slot and grown_shard.

    ``size`` is the text's UTF-8 bytes (null: none) plus 1; ``slot`` numbers a shard's rows from 0
    without gaps; ``grown_shard`` is the shard under ``grown`` (null without it). Only the key
    decides the shard, so equal keys share one; null keys count as the empty text. Repeated rows
    each keep a slot of their own. An empty table gives no rows. Other columns are not read.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    name = F.col(key).cast("string")
    rows = docs.select(
        F.col(key),
        (F.octet_length(body) + 1).cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        shard_of(name, tree).cast("int").alias("shard"),
        (shard_of(name, grown) if grown else F.lit(None)).cast("int").alias("grown_shard"),
    )
    return with_rank(rows, "shard", [F.col(key), F.col("size"), F.col("text_crc32")], F.xxhash64(name), "slot")
