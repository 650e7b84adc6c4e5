"""Sharding by a hierarchical weighted hash tree: regions, racks, shards."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import Staged, narrow, text_or_empty

#: Fixed value: the prime modulus of the draws, 2^31 - 1.
PRIME = 2147483647


@dataclass(frozen=True)
class Leaf:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def layout(n_shards: int, per_rack: int = 4, racks: int = 3, weights: dict[int, float] | None = None, base: int = 24) -> list[Leaf]:
    """Shards below ``base`` fill racks of ``per_rack`` and regions of ``racks``; each later one is a region of its own, so
    that its weight is no other shard's business and it takes rows only into itself."""
    w, full = weights or {}, -(-base // (per_rack * racks))
    return [Leaf(s // (per_rack * racks), s // per_rack % racks, s, w.get(s, 1.0)) if s < base else Leaf(full + s - base, 0, s, w.get(s, 1.0)) for s in range(n_shards)]


@dataclass(frozen=True)
class Node:
    """A place in the tree: ``value`` is the region, rack or shard; the weight is the sum of the leaves below."""

    path: str
    value: int
    weight: float
    children: tuple[Node, ...] = ()

    def constants(self) -> tuple[int, int, int]:
        """Multipliers of this node's draw, from its path alone: other nodes never change it."""
        h = hashlib.sha256(self.path.encode()).digest()
        return tuple(int.from_bytes(h[8 * i : 8 * i + 8], "big") % (PRIME - 1) + 1 for i in range(3))


def tree(leaves: list[Leaf]) -> tuple[Node, ...]:
    """The regions, with their racks and shards below them."""

    def level(part: list[Leaf], path: str, kinds: tuple[str, ...]) -> tuple[Node, ...]:
        kind, *below = kinds
        groups: dict[int, list[Leaf]] = {}
        for leaf in part:
            groups.setdefault(getattr(leaf, kind), []).append(leaf)
        at = lambda v: f"{path}/{kind}{v}".lstrip("/")
        return tuple(Node(at(v), v, sum(x.weight for x in g), level(g, at(v), tuple(below)) if below else ()) for v, g in groups.items())

    return level(leaves, "", ("region", "rack", "shard"))


def key_parts(id_name: str = "doc_id") -> tuple[Column, Column]:
    """Two 28-bit integers of the key's MD5; the SQL oracle computes the same."""
    m = F.md5(F.coalesce(F.col(id_name).cast("string"), F.lit("null")))
    return tuple(F.conv(F.substring(m, 1 + 7 * i, 7), 16, 10).cast("long") for i in range(2))


def _draw(node: Node) -> Column:
    """Exponential draw of rate ``weight``: the smallest of several wins with probability weight / sum of weights."""
    a, b, c = node.constants()
    u = (F.col("k1") * F.lit(a) + F.col("k2") * F.lit(b) + F.lit(c)) % F.lit(PRIME)
    u = (u * F.lit(48271) + F.shiftright(u, 7)) % F.lit(PRIME)
    return F.struct((-F.ln((u + 1) / F.lit(float(PRIME + 1))) / F.lit(float(node.weight))).alias("draw"), F.lit(node.value).alias("value"))


def _winner(nodes: tuple[Node, ...]) -> Column:
    return F.lit(nodes[0].value) if len(nodes) == 1 else F.least(*[_draw(n) for n in nodes])["value"]


def _among(column: str, branches: list[tuple[int, Column]]) -> Column:
    """The branch of the value in ``column``; the others are not computed."""
    out = F.when(F.col(column) == branches[0][0], branches[0][1])
    for value, branch in branches[1:]:
        out = out.when(F.col(column) == value, branch)
    return out


def descend(d: DataFrame, leaves: list[Leaf], names: tuple[str, str, str]) -> DataFrame:
    """The region, the rack in it and the shard in that, each the smallest weighted draw among its siblings.

    A level draws with hashes of its own nodes and the weights of their subtrees, and only the winner's children draw
    next: a row costs a draw per region, per rack of one region and per shard of one rack. A changed weight changes the
    draws of its own ancestors alone. So a row that moves moves into a subtree whose weight grew, or out of one whose
    weight shrank; between siblings of unchanged weight none moves.
    """
    region, rack, shard = names
    regions = tree(leaves)
    d = d.withColumn(region, _winner(regions))
    d = d.withColumn(rack, _among(region, [(r.value, _winner(r.children)) for r in regions]))
    return d.withColumn(shard, _among(region, [(r.value, _among(rack, [(k.value, _winner(k.children)) for k in r.children])) for r in regions]))


def shard_documents(docs: DataFrame, n_shards: int = 24, leaves: list[Leaf] | None = None, grown: list[Leaf] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, size, text_crc32, law, shard, slot, grown_shard, region, rack``.

    Identifier and topology alone decide; equal identifiers (repeated rows too) share a shard, and null identifiers
    are one key. ``size`` is the text's UTF-8 bytes plus 8, with null text as none. Slots run from 0 in every shard in
    order of identifier (null first), then CRC-32 and size. ``grown_shard`` is the place under ``grown``, by default
    one shard more, which takes rows only into itself (``layout``). Ranks come from range partitions: rows are numbered
    within (partition, shard) and moved up by the counts of the partitions before, so no shard is sorted in one task;
    rows repeated whole are dealt out by their place in the input. An empty table gives an empty result; other columns
    are ignored.
    """
    st = Staged(docs.sparkSession)
    leaves = leaves or layout(n_shards)
    grown = grown or layout(n_shards + 1)
    d = narrow(docs, doc_id=id_col, text=text_col)
    k1, k2 = key_parts()
    d = d.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"), F.crc32(text_or_empty().cast("binary")).alias("text_crc32"), k1.alias("k1"), k2.alias("k2"))
    d = descend(descend(d, leaves, ("region", "rack", "shard")), grown, ("grown_region", "grown_rack", "grown_shard"))
    d = d.select("doc_id", "size", "text_crc32", "region", "rack", "shard", "grown_shard", F.monotonically_increasing_id().alias("uid"))
    d = d.repartitionByRange(F.col("doc_id").asc_nulls_first(), "text_crc32", "size", "uid").withColumn("part", F.spark_partition_id())
    d = st.write(d, "shard-rows")
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    moved = d.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n")).select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    order = Window.partitionBy("shard", "part").orderBy(F.col("doc_id").asc_nulls_first(), "text_crc32", "size", "uid")
    ranked = d.withColumn("rank", F.row_number().over(order) - 1)
    return ranked.join(moved, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("base") + F.col("rank")).cast("long").alias("slot"), "grown_shard", "region", "rack"
    )
