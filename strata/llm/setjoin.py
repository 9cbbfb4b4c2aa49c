"""What the exact set joins share: frequent shingles, candidate links, verification, classes.

Sets are sorted arrays of shingle hashes; equal sets share a *node* (the hash of
the set). A method emits ``(cell, node, left)``: the node can only be linked with
nodes that share one of its cells. The low bits of a cell whose signature has
only frequent shingles are a salt, so that no task gets a frequent cell whole;
all other cells are small, as a signature is no more frequent than its rarest
shingle.

Links are searched in two steps, so that large groups of similar sets never
become all pairs and no link between two classes is missed:

1. In each cell every node is compared with one pivot, the node with most of its
   cells shared (in a group of edited copies that is the original).
2. Verified links give classes. The nodes of all cells of a pivot that still hold
   several classes are compared with each other, block by block: a task gets two
   blocks of at most about ``TILE`` nodes each, compares their sketches, and only
   pairs of different classes that may be linked leave it.

Sketches are parities: each shingle flips one bit of two a shingle or more, so sets
that differ in d shingles differ in at most d bits. Whole sets are compared last.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import written
from strata.llm.wordhash import give_back, mix

PERCENT = 75
#: A shingle in a 2,000th of a block's sets or more is frequent; blocks have about so many shingles.
FREQUENT_SHARE, BLOCK, LEAST = 2000, 1 << 20, 4
SALT_BITS = 7
PAIR = "a long, b long"
#: Nodes of a block in the second step, and pairs of a task's blocks that are held at once.
TILE, PAIRS_AT_ONCE = 512, 1 << 19


def node_of(shingles: np.ndarray) -> int:
    return int(mix(mix(shingles).sum(keepdims=True, dtype=np.uint64) + np.uint64(len(shingles))).view(np.int64)[0])


class FrequentShingles:
    """Counts shingles of different sets, block by block.

    What is in a share of all sets is in that share of the sets of some block,
    so the blocks' frequent shingles hold all frequent ones, and there are at
    most ``FREQUENT_SHARE`` times a mean set's size of them. They order
    signatures by rarity; that changes the cost of a join, never its result.
    """

    def __init__(self):
        self.parts, self.size, self.sets, self.seen = [], 0, 0, set()

    def add(self, node: int, shingles: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if node in self.seen:
            return
        self.seen.add(node)
        self.parts.append(shingles)
        self.size += len(shingles)
        self.sets += 1
        if self.size >= BLOCK:
            yield self.close()

    def add_all(self, nodes: list[int], tokens: np.ndarray, sets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``tokens`` of the ``sets`` sets of a batch that hadn't been seen."""
        self.seen.update(nodes)
        self.parts.append(tokens)
        self.size += len(tokens)
        self.sets += sets
        if self.size >= BLOCK:
            yield self.close()

    def close(self) -> tuple[np.ndarray, np.ndarray]:
        values, counts = np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *self.parts]), return_counts=True)
        often = counts >= max(LEAST, self.sets // FREQUENT_SHARE)
        self.__init__()
        return values[often], counts[often]


def broadcast_frequent(counts: DataFrame, sets: int):
    """A broadcast of the sorted frequent shingles of ``(shingle, n)`` rows of blocks.

    Those with a ``FREQUENT_SHARE``-th of all ``sets`` in their blocks' counts: a shingle
    in twice that share of the sets is always among them, and there are at most
    ``FREQUENT_SHARE`` times a mean set's size, whatever the number of blocks.
    """
    spark = counts.sparkSession
    rows = counts.groupBy("shingle").agg(F.sum("n").alias("n")).filter(F.col("n") >= max(LEAST, sets // FREQUENT_SHARE)).select("shingle").toPandas()
    return spark.sparkContext.broadcast(np.sort(rows["shingle"].to_numpy(dtype=np.int64).view(np.uint64)))


def is_frequent(shingles: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    if not len(frequent):
        return np.zeros(len(shingles), dtype=bool)
    return frequent[np.minimum(np.searchsorted(frequent, shingles), len(frequent) - 1)] == shingles


def cells_of(signatures: np.ndarray, common: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Cells of signatures: low bits 0, or for a common signature a salt of its node."""
    low, half = np.uint64((1 << SALT_BITS) - 1), np.uint64(1 << (SALT_BITS - 1))
    salt = half | (nodes.view(np.uint64) % half)
    return ((signatures & ~low) | np.where(common, salt, np.uint64(0))).view(np.int64)


def _need(a, b):
    """Least overlap of linked sets of the given sizes."""
    return F.ceil((a + b) * PERCENT / (100 + PERCENT) - 1e-9)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose sets (node, shingles) are linked."""
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(a, "a").join(b, "b").withColumn("both", both)
            .filter(100 * F.col("both") >= PERCENT * (F.size("sa") + F.size("sb") - F.col("both"))).select("a", "b"))


def sketch(shingles: np.ndarray) -> bytes:
    bits = 64
    while bits < 2 * len(shingles):
        bits *= 2
    return np.packbits(np.bincount((mix(shingles) >> np.uint64(7)) & np.uint64(bits - 1), minlength=bits).astype(np.uint8) & 1).tobytes()


def fold(x: np.ndarray, width: int) -> np.ndarray:
    """Sketches (a row each) as sketches of fewer bytes: parities add."""
    while x.shape[1] > width:
        half = x.shape[1] // 2
        x = x[:, :half] ^ x[:, half:]
    return x


def near(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b, na, nb) whose sketches differ in few enough bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for na, nb, x, y in zip(*(batch.column(c).to_pylist() for c in ("na", "nb", "sa", "sb"))):
                x, y = (np.frombuffer(v, dtype=np.uint8)[None] for v in (x, y))
                width = min(x.shape[1], y.shape[1])
                keep.append(int(np.bitwise_count(fold(x, width) ^ fold(y, width)).sum()) <= most_different(na + nb))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    a = nodes.select(F.col("node").alias("a"), F.col("sketch").alias("sa"))
    b = nodes.select(F.col("node").alias("b"), F.col("sketch").alias("sb"))
    return pairs.join(a, "a").join(b, "b").mapInArrow(run, PAIR)


def most_different(both):
    """Most shingles in which linked sets of so many shingles in all can differ."""
    return (100 - PERCENT) * both // (100 + PERCENT)


def _tile_pairs(start: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i < j) of rows of one tile, for rows ``i`` in runs of bounded total."""
    later = end - np.arange(len(start)) - 1
    total = np.cumsum(later)
    at = 0
    while at < len(start):
        stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS_AT_ONCE, side="right")))
        count = later[at:stop]
        i = np.repeat(np.arange(at, stop), count)
        yield i, i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
        at = stop


def _close(i: np.ndarray, j: np.ndarray, n: np.ndarray, sketches: list[bytes]) -> np.ndarray:
    """Which pairs' whole sketches allow a link, width by width."""
    width = np.array([len(x) for x in sketches], dtype=np.int64)
    least, ok = np.minimum(width[i], width[j]), np.zeros(len(i), dtype=bool)
    for w in np.unique(least):
        at = np.flatnonzero(least == w)
        rows, place = np.unique(np.concatenate([i[at], j[at]]), return_inverse=True)
        folded = np.concatenate([fold(np.frombuffer(sketches[r], dtype=np.uint8)[None], w) for r in rows])
        differ = np.bitwise_count(folded[place[:len(at)]] ^ folded[place[len(at):]]).sum(axis=1, dtype=np.int64)
        ok[at] = differ <= most_different(n[i[at]] + n[j[at]])
    return ok


class Tiles:
    """Compares the nodes of whole tiles; one for a task.

    Where the rows have the sets, pairs are verified here, and classes that a
    link of the task has joined already aren't compared again.
    """

    def __init__(self):
        self.joined: dict[int, int] = {}

    def root_of(self, x: int) -> int:
        while x in self.joined:
            x = self.joined[x]
        return x

    def pairs(self, rows: pa.Table) -> Iterator[np.ndarray]:
        """Pairs (two columns) of different classes whose sizes and sketches (and sets) allow a link."""
        n, node, root, side = (rows.column(c).to_numpy() for c in ("n", "node", "root", "side"))
        new = tile_starts(rows)
        tile = np.cumsum(new) - 1
        end = np.append(np.flatnonzero(new), len(n))[1:][tile]
        sketches = rows.column("sketch").to_pylist()
        short = np.concatenate([fold(np.frombuffer(x, dtype=np.uint8)[None], 8) for x in sketches]).view(np.uint64)[:, 0]
        sets = rows.column("shingles").combine_chunks() if "shingles" in rows.column_names else None
        for i, j in _tile_pairs(np.flatnonzero(new)[tile], end):
            fits = (root[i] != root[j]) & ((side[i] != side[j]) | (side[i] == 2))
            i, j = i[fits], j[fits]
            fits = ((100 * np.minimum(n[i], n[j]) >= PERCENT * np.maximum(n[i], n[j]))
                    & (np.bitwise_count(short[i] ^ short[j]) <= most_different(n[i] + n[j])))
            i, j = i[fits], j[fits]
            fits = _close(i, j, n, sketches)
            i, j = i[fits], j[fits]
            if sets is not None:
                linked = [self._join(x, y, root, sets) for x, y in zip(i.tolist(), j.tolist())]
                i, j = i[linked], j[linked]
            yield np.stack([np.minimum(node[i], node[j]), np.maximum(node[i], node[j])], axis=1)

    def _join(self, x: int, y: int, root: np.ndarray, sets: pa.ListArray) -> bool:
        rx, ry = self.root_of(int(root[x])), self.root_of(int(root[y]))
        if rx == ry:
            return False
        sx, sy = sets[x].values.to_numpy(), sets[y].values.to_numpy()
        both = len(np.intersect1d(sx, sy, assume_unique=True))
        if 100 * both < PERCENT * (len(sx) + len(sy) - both):
            return False
        self.joined[max(rx, ry)] = min(rx, ry)
        return True


def tile_starts(rows: pa.Table) -> np.ndarray:
    """True where a row is the first of its tile."""
    new = np.zeros(rows.num_rows, dtype=bool)
    new[:1] = True
    for c in ("family", "i", "j"):
        v = rows.column(c).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return new


def _whole_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by tile as tables of whole tiles; a batch's last tile waits for the next batch."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        if rows.num_rows == 0:
            continue
        last = int(np.flatnonzero(tile_starts(rows))[-1])
        held = rows.slice(last)
        if last:
            yield rows.slice(0, last)
    if held is not None:
        yield held


def pairs_in_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tiles = Tiles()
    for rows in _whole_tiles(batches):
        for found in tiles.pairs(rows):
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])
    give_back()


def with_partner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes that have a pair, each once for a table of tiles."""
    tiles = Tiles()
    for rows in _whole_tiles(batches):
        met = np.unique(np.concatenate([np.zeros(0, dtype=np.int64), *(np.unique(found) for found in tiles.pairs(rows))]))
        yield pa.RecordBatch.from_arrays([pa.array(met)], ["node"])
    give_back()


def _tiles(members: DataFrame, compare, schema: str, sets: DataFrame | None = None) -> DataFrame:
    blocks = members.groupBy("family").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("blocks"))
    dealt = members.join(blocks, "family").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    if sets is not None:
        dealt = dealt.join(sets, "node")
    tiles = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "family", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "n", "root", "sketch",
        *(["shingles"] if sets is not None else []),
        F.when(F.col("own") == F.col("other"), 2).otherwise((F.col("own") < F.col("other")).cast("int")).alias("side"))
    return tiles.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j").mapInArrow(compare, schema)


def across_classes(members: DataFrame, sets: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b) of nodes of a group (family, node, n, root, sketch) that may be
    linked; with ``sets`` (node, shingles), that are."""
    return _tiles(members, pairs_in_tiles, PAIR, sets).distinct()


def links(records: DataFrame, nodes: Callable[[DataFrame], DataFrame], sets: Callable[[DataFrame], DataFrame],
          small_sets: bool = False) -> DataFrame:
    """Links (a, b) whose classes are those of all links.

    ``records``: (cell, node, left), or with ``sizes`` for left: the set's size n in
    the high half, left in the low one (else n is left). ``left`` is an upper bound of
    what the node can still share, this cell's shingle included. ``nodes``: a written table with (node, sketch), one row a node, of given
    nodes at least. ``sets``: (node, shingles) of given rows of that table;
    ``small_sets``: they are small.
    """
    low = (1 << SALT_BITS) - 1
    common = F.col("cell").bitwiseAND(F.lit(low)) != 0
    here = Window.partitionBy("cell")
    shared = records.withColumn("several", F.min("node").over(here) != F.max("node").over(here)).filter(F.col("several") | common)
    if "sizes" in records.columns:
        shared = shared.withColumns({"left": F.col("sizes").bitwiseAND(F.lit(0xFFFFFFFF)), "n": F.shiftright("sizes", 32)})
    else:
        shared = shared.withColumn("n", F.col("left"))
    shared = written(shared.select(F.col("cell").bitwiseAND(F.lit(~low)).alias("cell"), "node", "left", "n").distinct(), "shared_cells")
    nodes = nodes(shared.select("node").distinct())

    def sets_of(wanted: DataFrame) -> DataFrame:
        return sets(nodes.join(wanted, "node"))

    met = shared.groupBy("node").agg((F.count(F.lit(1)) / F.max("n")).alias("met"))
    pivots = written(shared.join(met, "node").groupBy("cell")
                     .agg(F.max_by(F.struct("node", "n", "left"), F.struct("met", "node")).alias("p"), F.count(F.lit(1)).alias("size"))
                     .filter("size > 1").select("cell", "p"), "pivots")
    stars = shared.join(pivots, "cell").select(
        F.col("node").alias("x"), F.col("n").alias("nx"), F.col("left").alias("lx"),
        F.col("p.node").alias("y"), F.col("p.n").alias("ny"), F.col("p.left").alias("ly"))
    first = written(_linked(near(_candidates(stars), nodes), sets_of), "pivot_links")

    placed = shared.join(components(first), "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = (placed.groupBy("cell").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
             .filter("lo <> hi").join(pivots, "cell").select("cell", F.col("p.node").alias("family")))
    members = placed.join(mixed, "cell").select("family", "node", "n", "root").distinct()
    members = members.join(nodes.select("node", "sketch"), "node")
    if small_sets:  # they go with the nodes that sketches leave open, and blocks verify their pairs themselves
        members = written(members, "open_members")
        left_open = written(_tiles(members, with_partner, "node long").distinct(), "open_nodes")
        members = members.join(left_open, "node")
        second = across_classes(members, sets_of(left_open))
    else:
        second = _linked(across_classes(members), sets_of)
    return first.unionByName(written(second, "class_links"))


def _linked(pairs: DataFrame, sets) -> DataFrame:
    pairs = written(pairs, "sieved_pairs")
    return verified(pairs, sets(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()))


def _candidates(pairs: DataFrame) -> DataFrame:
    """Different pairs (a < b, na, nb) that pass the length and positional filters."""
    need = _need(F.col("nx"), F.col("ny"))
    flip = F.col("x") > F.col("y")
    return (pairs.filter((F.col("x") != F.col("y")) & (F.least("lx", "ly") >= need)
                         & (100 * F.least("nx", "ny") >= PERCENT * F.greatest("nx", "ny")))
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"),
                    F.when(flip, F.col("ny")).otherwise(F.col("nx")).alias("na"),
                    F.when(flip, F.col("nx")).otherwise(F.col("ny")).alias("nb")).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of an edge (a, b): root is the least node of its class.

    Rounds of large and small stars; a round's edges are written, and rounds end
    when the edges stay the same. Minima have partial counts, so a node with many
    edges does no harm.
    """
    edges = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    before = None
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        before = mark
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").filter("u <> v").distinct())
        edges = written(small, "edges")


def set_rows(nodes: list[int], found: list[np.ndarray]) -> pa.RecordBatch:
    lengths = np.cumsum([0, *map(len, found)])
    lists = pa.ListArray.from_arrays(pa.array(lengths, pa.int32()),
                                     pa.array(np.concatenate([np.zeros(0, dtype=np.uint64), *found]).view(np.int64)))
    return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), lists], ["node", "shingles"])
