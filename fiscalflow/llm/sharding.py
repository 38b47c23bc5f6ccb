"""Sharding by a hierarchical weighted hash tree (native columns only).

A topology is a tree region -> rack -> shard; each shard has a weight, and a rack or
region weighs the sum of what is below it.  A row descends the tree: at every level each
child draws ``-ln(u) / weight`` with ``u`` hashed from (row key, child id), and the least
draw wins, so a child is taken in proportion to its weight.  A draw depends on that child
and its weight alone.  Changing a weight therefore moves rows only into (or out of) the
subtrees whose weights changed; everything else keeps its place.  A shard that opens a
region of its own takes rows only into itself.

Defined cases: a null key is one key like any other (all its rows share a shard); a null
text has size ``overhead`` and the checksum of the empty text; repeated rows get the same
shard and different slots; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalflow.llm._common import number_within, text_bytes


@dataclass(frozen=True)
class Shard:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def standard_topology(shards: int, base: int = 40, region_size: int = 10, rack_size: int = 5) -> list[Shard]:
    """Equal shards; the first ``base`` fill regions of ``region_size`` in racks of ``rack_size``.

    Every shard after them opens a region of its own, so that it takes rows only into itself.
    """
    out = []
    for s in range(shards):
        if s < base:
            out.append(Shard(s // region_size, s // rack_size, s))
        else:
            out.append(Shard(base + s, base + s, s))
    return out


def _array(children: list[tuple[int, float]]) -> Column:
    return F.array(*[F.struct(F.lit(i).cast("int").alias("id"), F.lit(float(w)).alias("w")) for i, w in children])


def _draw(key: Column, level: str, children: Column) -> Column:
    """Id of the child with the least draw; ties go to the smaller id."""
    def one(c: Column) -> Column:
        h = F.xxhash64(key, F.lit(level), c["id"])
        u = (F.shiftrightunsigned(h, 11).cast("double") + 0.5) / F.lit(float(1 << 53))
        return F.struct((-F.log(u) / c["w"]).alias("d"), c["id"].alias("id"))

    return F.array_min(F.transform(children, one))["id"]


def place(df: DataFrame, key: str, topology: list[Shard], out: str = "shard", salt: str = "") -> DataFrame:
    """Adds ``out``: the shard of each row by descent through ``topology``.

    The tree is written into the plan as literals: its size is the number of shards, a
    parameter, not the number of rows.  Shards of weight 0 take nothing.
    """
    live = [s for s in topology if s.weight > 0]
    if not live:
        raise ValueError("the topology has no shard with a weight")
    regions: dict[int, float] = {}
    racks: dict[int, dict[int, float]] = {}
    leaves: dict[tuple[int, int], dict[int, float]] = {}
    for s in live:
        regions[s.region] = regions.get(s.region, 0.0) + s.weight
        racks.setdefault(s.region, {})[s.rack] = racks.get(s.region, {}).get(s.rack, 0.0) + s.weight
        leaves.setdefault((s.region, s.rack), {})[s.shard] = s.weight
    k = F.col(key)
    by_region = F.create_map(*[x for r in sorted(racks) for x in (F.lit(r), _array(sorted(racks[r].items())))])
    by_rack = F.create_map(*[x for r in sorted(racks) for x in (F.lit(r), F.create_map(*[
        y for c in sorted(racks[r]) for y in (F.lit(c), _array(sorted(leaves[(r, c)].items())))]))])
    region, rack = f"__region_{out}", f"__rack_{out}"
    df = df.withColumn(region, _draw(k, salt + "region", _array(sorted(regions.items()))))
    df = df.withColumn(rack, _draw(k, salt + "rack", by_region[F.col(region)]))
    leaf = by_rack[F.col(region)][F.col(rack)]
    return df.withColumn(out, _draw(k, salt + "shard", leaf)).drop(region, rack)


def shard_documents(docs: DataFrame, shards: int = 40, key: str = "doc_id", text: str = "text",
                    overhead: int = 16) -> DataFrame:
    """One row per input row: key, size, text_crc32, law, shard, slot, grown_shard.

    ``slot`` is gapless from 0 in every shard.  ``grown_shard`` is the shard under one more
    shard than ``shards``.  The law is ``key``: key and shard count alone decide.
    """
    t = F.col(text)
    narrow = docs.select(
        F.col(key).alias("__key"),
        (text_bytes(t) + F.lit(overhead)).alias("size"),
        F.crc32(F.coalesce(t, F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
    )
    placed = place(narrow, "__key", standard_topology(shards, base=shards), "shard")
    placed = place(placed, "__key", standard_topology(shards + 1, base=shards), "grown_shard")
    numbered = number_within(placed, "shard", "slot")
    return numbered.select(F.col("__key").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
                           "grown_shard")
