"""Hierarchical weighted hash tree: region, rack and shard by weighted hash draws.

At each level every child of the node reached so far draws a number from the
row's key and its own name; an exponential draw divided by the child's weight
wins with probability proportional to that weight. A changed weight changes that
child's draws only, so rows move only into or out of subtrees whose weights
change. DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import Scratch


@dataclass(frozen=True)
class Leaf:
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def even_tree(shards: int, per_rack: int = 2, racks_per_region: int = 2) -> list[Leaf]:
    """``shards`` equal shards, packed into racks and regions."""
    out = []
    for s in range(shards):
        rack = s // per_rack
        out.append(Leaf(f"region{rack // racks_per_region}", f"rack{rack}", s))
    return out


def grown_tree(tree: list[Leaf], weight: float = 1.0) -> list[Leaf]:
    """The tree with one more shard, in a region of its own.

    No old subtree changes its weight, so rows move into the new shard alone.
    """
    s = max((x.shard for x in tree), default=-1) + 1
    return [*tree, Leaf(f"region+{s}", f"rack+{s}", s, weight)]


def levels(tree: list[Leaf]) -> list[list[tuple[str, str, float]]]:
    """(parent, node, weight) of each level; an inner node weighs what its shards weigh."""
    out: list[dict[tuple[str, str], float]] = [{}, {}, {}]
    for x in tree:
        names = ["", f"{x.region}", f"{x.region}/{x.rack}", f"{x.region}/{x.rack}/{x.shard}"]
        for level, (parent, node) in zip(out, zip(names, names[1:])):
            level[parent, node] = level.get((parent, node), 0.0) + x.weight
    return [[(p, n, w) for (p, n), w in sorted(level.items())] for level in out]


def _hash52(*parts: Column) -> Column:
    return F.conv(F.substring(F.md5(F.concat_ws("/", *parts)), 1, 13), 16, 10).cast("double")


def _draw(key: Column, node: Column, weight: Column) -> Column:
    return -F.log((_hash52(node, key) + F.lit(1.0)) / F.lit(float(1 << 52))) / weight


def _winner(key: Column, parent: Column, level: list[tuple[str, str, float]]) -> Column:
    """The child of ``parent`` with the smallest draw, the first by name if draws tie."""
    children = F.array(*[F.struct(F.lit(p).alias("parent"), F.lit(n).alias("node"), F.lit(w).alias("w")) for p, n, w in level if w > 0])
    own = F.filter(children, lambda c: c["parent"] == parent)
    drawn = F.transform(own, lambda c: F.struct(_draw(key, c["node"], c["w"]).alias("draw"), c["node"].alias("node")))
    return F.array_min(drawn)["node"]


def placed(key: Column, tree: list[Leaf]) -> Column:
    """The shard of a key, level by level."""
    node = F.lit("")
    for level in levels(tree):
        node = _winner(key, node, level)
    return F.element_at(F.split(node, "/"), -1).cast("int")


def shard_documents(
    docs: DataFrame, shards: int = 8, doc: str = "doc_id", text: str = "text", tree: list[Leaf] | None = None
) -> DataFrame:
    """(doc, size, text_crc32, law, shard, slot, grown_shard) of each row, under the law ``key``.

    The id and the tree decide the shard, whatever the other rows are: rows of
    one id go together, a null id counts as the empty key. ``slot`` numbers a
    shard's rows without gaps from 0, by 4096 hash buckets and then by id,
    checksum and size; equal rows get different slots. Slots are counted in each
    bucket apart, and only the bucket counts (at most 4096 a shard) meet, so no
    task orders a whole shard. A null text has size 1 and checksum 0. Other
    columns are ignored; an empty table gives an empty result.
    """
    tree = tree or even_tree(shards)
    key = F.coalesce(F.col("doc").cast("string"), F.lit(""))
    content = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = docs.select(F.col(f"`{doc}`").alias("doc"), F.col(f"`{text}`").alias("text")).select(
        "doc",
        (F.octet_length(content) + 1).cast("long").alias("size"),
        F.crc32(content).alias("text_crc32"),
    )
    rows = rows.select(
        "*",
        placed(key, tree).alias("shard"),
        placed(key, grown_tree(tree)).alias("grown_shard"),
        F.conv(F.substring(F.md5(F.concat_ws("/", F.lit("slot"), key, "text_crc32", "size")), 1, 3), 16, 10).cast("int").alias("bucket"),
    )
    rows = Scratch(docs.sparkSession).store(rows)  # ids and numbers; counted and numbered below
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n")).select(
        "shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    )
    inside = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc", "text_crc32", "size")) - 1
    return (
        rows.withColumn("inside", inside)
        .join(F.broadcast(counts), ["shard", "bucket"])  # at most 4096 rows a shard
        .select(
            F.col("doc").alias(doc), "size", "text_crc32", F.lit("key").alias("law"), "shard",
            (F.col("first") + F.col("inside")).cast("long").alias("slot"), "grown_shard",
        )
    )
