"""Shards by a hierarchical weighted hash tree, in DataFrame operations.

Regions hold racks, racks hold shards. A key descends level by level: each child draws -ln(u) / weight, with u from
a hash of the key and the child's name, and the least draw wins. A draw depends on the child's own name and weight
alone. So when weights change, keys move only into or out of the subtrees whose weights change, and below a node
only when that node is chosen anew. A further shard comes as a region of its own: it takes keys from all
others and none move between those.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardstat.llm.common import stored, text_of


class Shard(NamedTuple):
    region: str
    rack: str
    weight: float = 1.0


def topology(shards: int = 40, regions: int = 4, racks: int = 2) -> list[Shard]:
    """``shards`` shards of equal weight; shard k is the k-th of the list."""
    per_rack = -(-shards // (regions * racks))
    return [Shard(f"r{k // (per_rack * racks)}", f"k{k // per_rack % racks}") for k in range(shards)]


def grown(tree: list[Shard], weight: float = 1.0) -> list[Shard]:
    """The tree with one more shard, in a region of its own."""
    return [*tree, Shard(f"g{len(tree)}", "k0", weight)]


def _choice(key: Column, names: Column, weights: Column) -> Column:
    """The name of least draw among ``names`` (text array) with ``weights`` (array); ties go to the lesser name."""
    # 53 bits of the hash, moved off zero.
    unit = lambda name: (F.shiftrightunsigned(F.xxhash64(key, name), 11) + F.lit(0.5)) * F.lit(2.0**-53)
    draws = F.zip_with(names, weights, lambda n, w: F.struct((-F.log(unit(n)) / w).alias("draw"), n.alias("name")))
    return F.array_min(draws).getField("name")


def shard_of(key: Column, tree: list[Shard]) -> Column:
    """The number of the shard that ``key`` descends to. Shards of weight 0 or less take nothing; a null key
    descends like any other key."""
    children: dict[str, dict[str, float]] = {}
    leaves: dict[str, int] = {}
    for number, shard in enumerate(tree):
        if shard.weight > 0:
            path = ["", shard.region, f"{shard.region}/{shard.rack}", f"{shard.region}/{shard.rack}/{number}"]
            leaves[path[-1]] = number
            for node, child in zip(path, path[1:]):
                children.setdefault(node, {}).setdefault(child, 0.0)
                children[node][child] += shard.weight
    if not leaves:
        raise ValueError("no shard has a weight above 0")
    texts = lambda c: F.array(*[F.lit(x) for x in c])
    pairs = [x for node, c in children.items() for x in (F.lit(node), F.struct(texts(c).alias("n"), F.array(*map(F.lit, c.values())).alias("w")))]
    below = F.create_map(*pairs)
    node = F.lit("")
    for _ in range(3):
        kids = below[node]
        node = _choice(key, kids.getField("n"), kids.getField("w"))
    numbers = F.create_map(*[F.lit(x) for pair in leaves.items() for x in pair])
    return numbers[node].cast("int")


def assign(docs: DataFrame, tree: list[Shard], larger: list[Shard], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, shard, slot, grown_shard) per row: the shard in ``tree`` and in ``larger``, and a number
    within the shard, gapless from 0.

    ``size`` is the text's UTF-8 bytes plus 16; a null text has none, and the checksum of the empty text. Equal keys
    share a shard. The text is read once; what is numbered is a narrow stored table. Rows are numbered within
    the partition of that first read, and partitions get their first number from running counts, so no task holds
    a shard, however many rows share a key.
    """
    own = F.col(f"`{key}`")
    rows = docs.select(
        own.alias("key"),
        (F.octet_length(text_of(text)) + 16).cast("long").alias("size"),
        F.crc32(text_of(text).cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row"),
    )
    at, then = shard_of(F.col("key"), tree).alias("shard"), shard_of(F.col("key"), larger).alias("grown_shard")
    rows = stored(rows.select("*", at, then, F.shiftrightunsigned("row", 33).alias("part")), "shards")
    group = ["shard", "part"]
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = rows.groupBy(*group).count().select(*group, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    place = F.row_number().over(Window.partitionBy(*group).orderBy("row"))
    return rows.withColumn("place", place).join(first, group).select(
        F.col("key").alias(key), "size", "text_crc32", "shard", (F.col("first") + F.col("place") - 1).alias("slot"), "grown_shard"
    )


def write_shards(docs: DataFrame, path: str, tree: list[Shard], key: str = "doc_id", rows_per_file: int = 1_000_000) -> None:
    """``docs`` as Parquet in one folder per shard (``_shard=0`` ...); a task writes what it reads, without a shuffle."""
    placed = docs.withColumn("_shard", shard_of(F.col(f"`{key}`"), tree))
    placed.write.option("maxRecordsPerFile", rows_per_file).partitionBy("_shard").parquet(path)
