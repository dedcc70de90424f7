"""Shards by a hierarchical weighted hash tree, with built-in functions only.

A tree has regions, racks and shards. At each level every child draws u from a hash of (document, child's path), and the child with
the least -ln(u)/weight wins, so each gets a share in proportion to its weight. If a child's weight grows, documents move only to
it, and below unchanged nodes nothing moves. A shard is added as a region of its own: rows then move only into that shard.

Defined cases: a null doc_id draws as the empty string; equal ids (repeated rows) land together; a null text has size 1 and the
checksum of the empty string; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

#: region -> rack -> shard -> weight.
Tree = dict[str, dict[str, dict[int, int]]]


def default_tree(shards: int = 16, racks_per_region: int = 2, shards_per_rack: int = 2) -> Tree:
    """Shards 0 .. shards-1 of weight 1, filled rack by rack and region by region."""
    tree: Tree = {}
    for s in range(shards):
        rack = s // shards_per_rack
        tree.setdefault(f"g{rack // racks_per_region}", {}).setdefault(f"k{rack}", {})[s] = 1
    return tree


def grown(tree: Tree, weight: int = 1) -> Tree:
    """tree with one more shard, in a new region and rack of its own."""
    new = 1 + max(s for racks in tree.values() for shards in racks.values() for s in shards)
    return tree | {f"g+{new}": {f"k+{new}": {new: weight}}}


def draw(doc: Column, path: str) -> Column:
    """A number in (0, 1) from 52 bits of md5(document:path)."""
    bits = F.conv(F.substring(F.md5(F.concat(doc, F.lit(f":{path}"))), 1, 13), 16, 10).cast("long")
    return (bits + F.lit(0.5)) / F.lit(float(2**52))


def _choose(doc: Column, weights: dict[str, int]) -> Column:
    """The index of the child that wins, weights by path."""
    if len(weights) == 1:
        return F.lit(0)
    draws = [F.struct((-F.ln(draw(doc, path)) / F.lit(float(w))).alias("s"), F.lit(i).alias("i")) for i, (path, w) in enumerate(weights.items()) if w > 0]
    return F.least(*draws)["i"] if len(draws) > 1 else draws[0]["i"]


def _branch(chosen: Column, options: list[Column]) -> Column:
    out = options[-1]
    for i in reversed(range(len(options) - 1)):
        out = F.when(chosen == i, options[i]).otherwise(out)
    return out


def shard_of(doc: Column, tree: Tree) -> Column:
    """The shard of a document (a string column that is never null)."""

    def rack(region: str, name: str) -> Column:
        shards = tree[region][name]
        return _branch(_choose(doc, {f"{region}/{name}/{s}": w for s, w in shards.items()}), [F.lit(s) for s in shards])

    def of_region(region: str) -> Column:
        racks = tree[region]
        return _branch(_choose(doc, {f"{region}/{k}": sum(v.values()) for k, v in racks.items()}), [rack(region, k) for k in racks])

    return _branch(_choose(doc, {g: sum(w for v in racks.values() for w in v.values()) for g, racks in tree.items()}), [of_region(g) for g in tree])


def with_slots(placed: DataFrame, rows_per_block: int = 20_000) -> DataFrame:
    """placed(doc_id, shard, ..) with slot, gapless from 0 in each shard.

    A shard is cut into blocks by a hash, their number from the count of rows; slots are numbered in each block and moved by the
    counts of the blocks before it, so no task holds a shard. placed is a written table with a number `_u` for each row, by which equal
    rows are spread too.
    """
    blocks = max(1, placed.count() // (16 * rows_per_block) + 1)
    cut = placed.withColumn("_block", F.pmod(F.xxhash64("doc_id", "text_crc32", "_u"), F.lit(blocks * 4)).cast("int"))
    counts = cut.groupBy("shard", "_block").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.sum("_n").over(Window.partitionBy("shard").orderBy("_block")) - F.col("_n")).drop("_n")
    ranked = cut.withColumn("_rank", F.row_number().over(Window.partitionBy("shard", "_block").orderBy("doc_id", "text_crc32", "_u")) - 1)
    return ranked.join(before, ["shard", "_block"]).withColumn("slot", (F.col("_before") + F.col("_rank")).cast("long")).drop("_block", "_before", "_rank", "_u")


def assign(docs: DataFrame, tree: Tree | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for each row of docs."""
    tree = tree or default_tree()
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    placed = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(key, tree).cast("int").alias("shard"),
        shard_of(key, grown(tree)).cast("int").alias("grown_shard"),
        F.monotonically_increasing_id().alias("_u"),
    )
    return with_slots(materialise(placed, "placed")).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
