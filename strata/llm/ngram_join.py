"""N-gram Jaccard join by universe partition and pigeonhole.

A document's set has its different shingles of five words (lower case; a text of
fewer words is one shingle). Two documents link when the Jaccard similarity is
0.75 or more. Exact; no links are lost and no group becomes all pairs.

Sizes go in bands. In a band the universe of shingles is hashed into ``m``
segments. Linked sets of sizes r and s differ in at most ``(r + s) / 7`` shingles,
so in at most as many segments, and agree in all others. Each document orders its
segments' subsets by cost (frequent subsets, then empty ones, last; the order is
the same for all) and indexes the ``H + 1`` cheapest, H the most that a partner
may differ in: of two linked documents, at least one subset of both indexes is
equal. So frequent segments get no budget, others budget 0. In the least band
(sets up to 6, H at most 1) one segment holds the whole set with budget 1: the
set and its one-deletion neighbourhood are indexed. A set near the lower edge of
its band is also indexed in the band below.

Candidates pass a parity sketch (two bits a shingle or more; sets that differ in
d shingles differ in at most d bits) before whole sets are compared.

Defined results: null and blank texts have no shingles and are a class of their
own; equal sets always link; repeated rows give a row each; null ids are kept,
and are ignored as a class's id where the class has others (else it is null);
other columns are ignored. 64-bit hashes stand for shingles and sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import setjoin as S
from strata.llm.common import broadcast_if_small, table, written
from strata.llm.wordhash import give_back, mix, pieces, shingles, words

#: Largest set of the least band; each further band reaches four times as far.
TINY, RATIO = 5, 4
_EMPTY = np.uint64(0x2545F4914F6CDD1D)


def tops(n: int) -> list[int]:
    """Largest smaller set of the bands in which a set of size n is indexed."""
    top, below = TINY, 0
    while top < n:
        top, below = top * RATIO + 4, top
    return [top] + ([below] if below and 4 * below >= 3 * n else [])


def signatures(found: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What a set (sorted shingle hashes) is indexed by: hashes, and which are common."""
    n = len(found)
    mixed, often = mix(found), S.is_frequent(found, frequent)
    out, common = [], []
    for top in tops(n):
        band = mix(np.array([top], dtype=np.uint64))[0]
        if top == TINY:
            total = mixed.sum(dtype=np.uint64)
            out.append(mix(np.concatenate([[total], total - mixed]) ^ band))
            common.append(np.concatenate([[often.all()], [np.delete(often, k).all() for k in range(n)]]))
            continue
        budget = n // 3 if n <= top else (n + top) // 7
        m = max(2, -(-2 * top // 5))
        segment = ((mixed ^ band) % np.uint64(m)).astype(np.int64)
        order = np.argsort(segment, kind="stable")
        segment = segment[order]
        first = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
        held = segment[first].astype(np.uint64)
        subset = mix(np.add.reduceat(mixed[order], first) ^ mix(held + band))
        only = np.minimum.reduceat(often[order].astype(np.int8), first)
        best = np.lexsort((subset, only))[:budget + 1]
        out.append(subset[best])
        common.append(only[best] == 1)
        if len(best) <= budget:  # few segments: empty ones too
            empty = np.setdiff1d(np.arange(m, dtype=np.uint64), held)
            bare = np.sort(mix(_EMPTY ^ mix(empty + band)))[:budget + 1 - len(best)]
            out.append(bare)
            common.append(np.ones(len(bare), dtype=bool))
    return np.concatenate(out), np.concatenate(common)


#: Bytes of text whose sets are held at once.
PART = 1 << 19


def _each(batches, column="text"):
    """(slice, sets of its rows) of all batches."""
    for batch in batches:
        for part in pieces(batch, column, PART):
            yield part, list(shingles(words(part.column(column))))
    give_back()


def document_sets(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, copy, node, n, sketch) of all rows, and (shingle, n) of blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = S.FrequentShingles()

        def counted(block):
            values, n = block
            return pa.RecordBatch.from_arrays([
                pa.nulls(len(values), kind), pa.nulls(len(values), pa.int64()), pa.array(values.view(np.int64)),
                pa.array(n.astype(np.int64)), pa.nulls(len(values), pa.binary()), pa.array(np.ones(len(values), dtype=bool))], names)

        for part, found in _each(batches):
            nodes = [S.node_of(x) for x in found]
            for node, x in zip(nodes, found):
                for block in often.add(node, x):
                    yield counted(block)
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), part.column("copy"), pa.array(nodes, pa.int64()), pa.array([len(x) for x in found], pa.int64()),
                pa.array([S.sketch(x) for x in found], pa.binary()), pa.array(np.zeros(len(found), dtype=bool))], names)
        yield counted(often.close())

    names = ["doc_id", "copy", "node", "n", "sketch", "is_count"]
    kind = pa.string() if dict(docs.dtypes)[doc_id] == "string" else pa.int64()
    rows = written(_input(docs, doc_id, text).mapInArrow(
        run, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, copy long, node long, n long, sketch binary, is_count boolean"),
        "document_sets")
    return (rows.filter("NOT is_count").drop("is_count"),
            rows.filter("is_count").select(F.col("node").alias("shingle"), "n"))


def _input(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(t).alias("copy"), t.alias("text"))


def index(docs: DataFrame, doc_id: str, text: str, frequent) -> DataFrame:
    """(cell, node, left): what each different set is indexed by.

    A task indexes a set once, however many copies it reads.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = frequent.value, set()
        for _, found in _each(batches):
            keys, nodes, sizes = [np.zeros(0, dtype=np.int64)], [], []
            for x in found:
                node = S.node_of(x)
                if len(x) and node not in seen:
                    seen.add(node)
                    keys.append(S.cells_of(*signatures(x, known), np.array([node])))
                    nodes.append(node)
                    sizes.append(len(x))
            counts = np.array([len(k) for k in keys[1:]], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate(keys)), pa.array(np.repeat(np.array(nodes, dtype=np.int64), counts)),
                pa.array(np.repeat(np.array(sizes, dtype=np.int32), counts))], ["cell", "node", "left"])

    return _input(docs, doc_id, text).mapInArrow(run, "cell long, node long, left int")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, copy, node, n_shingles, component_id) of each row of ``docs``."""
    rows, counts = document_sets(docs, doc_id, text)
    frequent = S.broadcast_frequent(counts, rows.count())
    nodes = written(rows.filter("n > 0").groupBy("node").agg(
        F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.min(F.struct("doc_id", "copy")).alias("of")), "nodes")

    def sets(wanted: DataFrame) -> DataFrame:
        of = broadcast_if_small(written(wanted.select("of.doc_id", "of.copy"), "wanted_texts"))
        texts = _input(docs, doc_id, text)
        texts = texts.join(of, (texts["doc_id"].eqNullSafe(of["doc_id"])) & (texts["copy"] == of["copy"]), "left_semi")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, found in _each(batches):
                yield S.set_rows([S.node_of(x) for x in found], found)

        return texts.mapInArrow(run, "node long, shingles array<long>").groupBy("node").agg(F.first("shingles").alias("shingles"))

    found = S.links(index(docs, doc_id, text, frequent), lambda _: nodes, sets)
    classes = S.components(found)
    placed = rows.drop("sketch").join(classes, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = placed.filter("n > 0").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return placed.join(ids, "root", "left").select(
        "doc_id", "copy", "node", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        "root")


def distinct_documents(docs: DataFrame) -> DataFrame:
    """One row of each class: that with the least doc_id (then the least text hash).

    Rows of blank texts stay. What meets the documents is an id and a hash a row.
    """
    rows = written(near_duplicates(docs), "near_duplicates")
    first = rows.filter("n_shingles > 0").groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("none"), "doc_id", "copy")).alias("k"), F.count(F.lit(1)).alias("n"))
    gone = rows.filter("n_shingles > 0").join(first, "root").filter(
        ~(F.col("doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("copy") == F.col("k.copy")))).select("doc_id", "copy").distinct()
    repeated = rows.filter("n_shingles > 0").groupBy("doc_id", "copy").count().filter("count > 1")
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), docs["doc_id"].alias("id"), F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("of"))

    def met(table: DataFrame, kept: DataFrame, how: str) -> DataFrame:
        return kept.join(table, kept["id"].eqNullSafe(table["doc_id"]) & (kept["of"] == table["copy"]), how)

    kept = met(gone, whole, "left_anti")
    once = met(repeated, kept, "left_semi").dropDuplicates(["id", "of"])
    return met(repeated, kept, "left_anti").unionByName(once).select("doc.*")


def query(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, s FROM (SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN
  list_transform(range(1, len(w) - 3), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4])
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id JOIN n na ON na.doc_id = a.doc_id
  JOIN n nb ON nb.doc_id = b.doc_id GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 75 * (any_value(na.n) + any_value(nb.n) - count(*))),
g AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT g.b, r.c FROM r JOIN g ON g.a = r.doc_id AND r.c < g.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.c AS component_id FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id) m ON m.doc_id = d.doc_id
"""
