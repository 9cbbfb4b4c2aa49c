"""Sharding by a hierarchical weighted hash tree.

A row descends region, rack and shard. At each level every child draws
``-ln(u) / weight`` with ``u`` in (0, 1) from a hash of the row's key and the
child's name; the smallest draw wins, so children win in proportion to their
weights. A draw depends on nothing but key, child and weight: when weights
change, rows move only into or out of children whose weights changed.

A new shard grows as a region of its own (:func:`grow`), as more shards inside
an old region would raise that region's weight and also pull rows into the
shards beside it. So one more shard takes rows only into itself.

Slots: the rows of a shard are dealt to ``blocks`` blocks by a hash, the blocks'
counts give each its offset, and rows are numbered within their block: no task
sorts a whole shard.

Defined results: a null key is the key ``null``; rows with equal keys share a
shard and get slots of their own (exact repeats in any order); a null text has
size 1 and the checksum of the empty text; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.llm.common import let, table

#: region -> rack -> [(shard, weight)]
Tree = dict[str, dict[str, list[tuple[int, float]]]]


def even_tree(shards: int, regions: int = 4, racks: int = 2) -> Tree:
    """``shards`` equal shards, dealt round over the racks of all regions."""
    tree: Tree = {}
    for k in range(shards):
        region, rack = f"region{k % regions}", f"rack{k // regions % racks}"
        tree.setdefault(region, {}).setdefault(rack, []).append((k, 1.0))
    return tree


def grow(tree: Tree, shard: int, weight: float = 1.0) -> Tree:
    return {**tree, f"region-of-{shard}": {"rack0": [(shard, weight)]}}


def _draw(key: Column, name: str, weight: float) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(name)), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    return -F.ln(u) / F.lit(weight)


def _winner(key: Column, children: list[tuple[str, float, object]]) -> Column:
    """The value of the child with the least draw; equal draws: the first child."""
    live = [c for c in children if c[1] > 0]
    if len(live) == 1:
        return F.lit(live[0][2])
    values = F.array(*[F.lit(v) for _, _, v in live])
    return let(F.array(*[_draw(key, n, w) for n, w, _ in live]),
               lambda d: F.element_at(values, F.array_position(d, F.array_min(d)).cast("int")))


def place(docs: DataFrame, tree: Tree, key: str, prefix: str = "") -> DataFrame:
    """``docs`` with ``region``, ``rack`` and ``shard``, each named with ``prefix``."""
    k = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    weight = {r: {a: sum(w for _, w in s) for a, s in racks.items()} for r, racks in tree.items()}
    region, rack, shard = f"{prefix}region", f"{prefix}rack", f"{prefix}shard"
    docs = docs.withColumn(region, _winner(k, [(r, sum(x.values()), r) for r, x in weight.items()]))
    by_region = by_rack = None
    for r, racks in tree.items():
        if sum(weight[r].values()) <= 0:
            continue
        pick = _winner(k, [(f"{r}/{a}", weight[r][a], a) for a in racks])
        by_region = F.when(F.col(region) == r, pick) if by_region is None else by_region.when(F.col(region) == r, pick)
    docs = docs.withColumn(rack, by_region)
    for r, racks in tree.items():
        for a, shards in racks.items():
            if weight[r][a] > 0:
                here = (F.col(region) == r) & (F.col(rack) == a)
                pick = _winner(k, [(f"{r}/{a}/{s}", w, s) for s, w in shards])
                by_rack = F.when(here, pick) if by_rack is None else by_rack.when(here, pick)
    return docs.withColumn(shard, by_rack)


def with_slots(rows: DataFrame, order: list[str], blocks: int = 256) -> DataFrame:
    """``rows`` (with ``shard``) and ``slot``, gapless from 0 in each shard.

    ``rows`` is computed twice and must be the same both times. The offsets are
    ``shards * blocks`` rows, whatever the input, and are broadcast.
    """
    rows = rows.withColumn("_block", F.pmod(F.xxhash64(*order), F.lit(blocks)).cast("int"))
    sizes = rows.groupBy("shard", "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy("shard").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("shard", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    number = F.row_number().over(W.partitionBy("shard", "_block").orderBy(*order))
    return (rows.withColumn("_number", number).join(F.broadcast(offsets), ["shard", "_block"])
            .withColumn("slot", (F.col("_before") + F.col("_number") - 1).cast("long"))
            .drop("_block", "_number", "_before"))


def shard_documents(docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text", blocks: int = 256) -> DataFrame:
    """Placement of each document by its key, now and with one more shard."""
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("doc_id"), (F.octet_length(t) + 1).cast("long").alias("size"),
                       F.crc32(F.encode(t, "UTF-8")).alias("text_crc32"))
    tree = even_tree(shards)
    rows = place(place(rows, tree, "doc_id"), grow(tree, shards), "doc_id", "grown_")
    return with_slots(rows, ["doc_id", "text_crc32", "size"], blocks)


def query(spark, sf_dir):
    return shard_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard", "region", "rack")
