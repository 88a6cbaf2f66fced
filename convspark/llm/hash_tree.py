"""Shards from a weighted hash tree of regions, racks and shards."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from convspark.workspace import materialise

#: Hex digits of a draw: 52 bits, so that every draw is an exact double.
_DIGITS = 13


@dataclass(frozen=True)
class Topology:
    """Weights of shards, by region and rack. Shards are numbered in order of appearance."""

    regions: tuple[tuple[tuple[float, ...], ...], ...]

    def __post_init__(self) -> None:
        weights = [w for racks in self.regions for rack in racks for w in rack]
        if not weights or not all(racks and all(racks) for racks in self.regions):
            raise ValueError("every region needs a rack, every rack a shard")
        if any(not w > 0 for w in weights):
            raise ValueError("weights must be positive")

    @classmethod
    def uniform(cls, regions: int, racks: int, shards: int) -> Topology:
        return cls((((1.0,) * shards,) * racks,) * regions)

    @property
    def n_shards(self) -> int:
        return sum(len(rack) for racks in self.regions for rack in racks)

    def grown(self, weight: float = 1.0) -> Topology:
        """One more shard, in a region of its own: rows move only into it, none between the others."""
        return Topology(self.regions + (((weight,),),))


def _winner(key: Column, prefix: Column, weights: Column) -> Column:
    """Index of the child with the largest draw ln(u) / weight, u a hash of key, path and index."""

    def draw(weight: Column, index: Column) -> Column:
        name = F.concat_ws("/", key, prefix, index.cast("string"))
        bits = F.conv(F.substring(F.md5(name), 1, _DIGITS), 16, 10).cast("double")
        return F.struct((F.ln((bits + 1) / F.lit(float(16**_DIGITS))) / weight).alias("draw"), index.alias("index"))

    return F.array_max(F.transform(weights, draw))["index"]


def _nested(value) -> Column:
    return F.array(*map(_nested, value)) if isinstance(value, (list, tuple)) else F.lit(value)


def hash_tree_shard(key: Column, topology: Topology) -> Column:
    """Shard number of a string key: one weighted draw per level, from the root down.

    A child is drawn with a probability in proportion to its subtree's weight, and a draw depends on
    the key and that child alone. A weight that grows takes rows from the siblings only into itself,
    one that shrinks gives rows away only from itself: rows move only below nodes whose weights
    change. A null key counts as the empty string.
    """
    key = F.coalesce(key, F.lit(""))
    regions = topology.regions
    first, firsts = 0, []
    for racks in regions:
        firsts.append([])
        for rack in racks:
            firsts[-1].append(first)
            first += len(rack)
    region = _winner(key, F.lit("r"), _nested([float(sum(map(sum, racks))) for racks in regions]))
    racks = F.get(_nested([[float(sum(rack)) for rack in racks] for racks in regions]), region)
    at_region = F.concat(F.lit("r"), region.cast("string"))
    rack = _winner(key, at_region, racks)
    shards = F.get(F.get(_nested([[list(map(float, rack)) for rack in racks] for racks in regions]), region), rack)
    at_rack = F.concat_ws("/", at_region, rack.cast("string"))
    return F.get(F.get(_nested(firsts), region), rack) + _winner(key, at_rack, shards)


def shard_documents(
    docs: DataFrame,
    topology: Topology,
    slot_buckets: int = 1024,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Put documents into the shards of a hash tree and number them inside each shard.

    The shard depends on the id and the topology alone. Slots run from 0 without gaps: rows of a
    shard are ordered inside hash buckets, whose offsets come from one counting pass, so that a shard
    is never one task. The table of counts has at most ``n_shards * slot_buckets`` rows and is
    broadcast. The narrow table (no texts) is written once and read by both passes.

    Result per row: id, ``size`` (UTF-8 bytes + 1; a null text has none), ``text_crc32``, ``law``
    ('key'), ``shard``, ``slot``, ``grown_shard`` (with one more shard). Null ids go to one shard,
    repeated rows to the same shard and slots of their own. An empty table gives an empty table.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    key = F.col(id_column).cast("string")
    narrow = materialise(
        docs.select(
            F.col(id_column),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.lit("key").alias("law"),
            hash_tree_shard(key, topology).cast("int").alias("shard"),
            hash_tree_shard(key, topology.grown()).cast("int").alias("grown_shard"),
        ).withColumn("_bucket", F.pmod(F.xxhash64(F.col(id_column), "text_crc32"), F.lit(slot_buckets))),
        "shards",
    )
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        narrow.groupBy("shard", "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    )
    place = Window.partitionBy("shard", "_bucket").orderBy(F.col(id_column), "text_crc32", "size")
    return narrow.join(F.broadcast(offsets), ["shard", "_bucket"]).select(
        id_column,
        "size",
        "text_crc32",
        "law",
        "shard",
        (F.col("_first") + F.row_number().over(place) - 1).cast("long").alias("slot"),
        "grown_shard",
    )
