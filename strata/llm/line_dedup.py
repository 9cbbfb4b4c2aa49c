"""Line dedup by an exact set-similarity join.

A line's tokens are its different shingles of five words (lower case); a line of
fewer words has one token, its whole sequence. Two lines match when the Jaccard
similarity of their tokens is 0.75 or more. The join:

* tokens are ordered by rarity: frequent ones (counted over all lines) last, the
  others by hash, the same order for all lines;
* prefix filter: lines of n tokens are joined by their ``n - ceil(0.75 n) + 1``
  rarest tokens only;
* positional filter: a pair that meets at a token can share no more than what
  either line has from there on; length filter: sizes must allow 0.75;
* Jaccard is verified on whole token sets.

Matches make classes, and in each class the first line (by document id, then line
number) stays; all later ones are removed.

Defined results: null and empty texts have no lines to compare; lines with equal
tokens match; rows with equal id and text are one document and lose the same
lines; ids are numbers or strings, and null ids come after all others; a document
whose every line with words is removed is dropped by :func:`dedup_lines`; other
columns are kept as they are, whatever their names, but ``n_chars``, where it exists, is counted anew.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import setjoin as S
from strata.llm.common import NOT_SPACE, broadcast_if_small, let, table, written
from strata.llm.wordhash import _PLACE, _buffers, give_back, line_rows, mix, pieces, windows, words

SIZE = 5
#: Bytes of text whose tokens are sorted at once.
PART = 1 << 19


def rarest_first(which: np.ndarray, common: np.ndarray, tokens: np.ndarray, lines: int) -> np.ndarray:
    """The order of tokens by line, then rarity, then hash.

    One sort of packed keys; should different tokens of a line have the same
    key, a sort by the three columns.
    """
    bits = np.uint64(max(1, lines).bit_length())
    key = (which.astype(np.uint64) << (np.uint64(64) - bits)) | (common.astype(np.uint64) << (np.uint64(63) - bits)) | (tokens >> (bits + np.uint64(1)))
    order = np.argsort(key)
    key, sorted_tokens = key[order], tokens[order]
    if ((key[1:] == key[:-1]) & (sorted_tokens[1:] != sorted_tokens[:-1])).any():
        return np.lexsort((tokens, common, which))
    return order


class LineSets:
    """Token sets of all comparable lines of a batch, flat.

    ``row`` and ``line``: where each line stands; ``tokens[first[k]:first[k + 1]]``:
    its different tokens, rarest first; ``node``, ``n``, ``common``.
    """

    def __init__(self, texts: pa.Array, frequent: np.ndarray):
        w = words(texts, lines=True)
        data, offsets = _buffers(texts)
        first_line = line_rows(data, offsets)[1]
        count = np.diff(w.first)
        with_words = np.flatnonzero(count)
        grams = windows(w.hashes, SIZE)
        lengths = np.maximum(count[with_words] - SIZE + 1, 1)
        which = np.repeat(np.arange(len(with_words)), lengths)
        begin = np.cumsum(lengths) - lengths
        at = np.repeat(w.first[with_words] - begin, lengths) + np.arange(int(lengths.sum()))
        tokens, size = np.zeros(len(which), dtype=np.uint64), count[with_words][which]
        tokens[size >= SIZE] = grams[at[size >= SIZE]]
        for k in range(1, SIZE):
            own = size == k
            tokens[own] = sequences(w.hashes, at[own], k)
        common = S.is_frequent(tokens, frequent)
        order = rarest_first(which, common, tokens, len(with_words))
        which, tokens, common = which[order], tokens[order], common[order]
        new = np.ones(len(which), dtype=bool)
        new[1:] = (which[1:] != which[:-1]) | (tokens[1:] != tokens[:-1])
        self.tokens, self.common, self.which = tokens[new], common[new], which[new]
        self.n = np.bincount(self.which, minlength=len(with_words))
        self.first = np.concatenate([[0], np.cumsum(self.n)])
        sums = np.add.reduceat(mix(self.tokens), self.first[:-1]) if len(self.n) else np.zeros(0, dtype=np.uint64)
        self.node = mix(sums + self.n.astype(np.uint64)).view(np.int64)
        self.row = np.searchsorted(first_line, with_words, side="right") - 1
        self.line = with_words - first_line[self.row]

    def sketches(self) -> pa.Array:
        """The same as ``setjoin.sketch`` of each line."""
        bits = 64 << np.maximum(0, np.ceil(np.log2(np.maximum(self.n, 32) / 32)).astype(np.int64))
        begin = np.cumsum(bits) - bits
        at = ((mix(self.tokens) >> np.uint64(7)) & np.repeat(bits - 1, self.n).astype(np.uint64)).astype(np.int64)
        total = int(bits.sum())
        packed = np.packbits(np.bincount(at + np.repeat(begin, self.n), minlength=total).astype(np.uint8) & 1)
        offsets = np.append(begin, total) // 8
        return pa.Array.from_buffers(pa.large_binary(), len(self.n), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(packed)]).cast(pa.binary())


def sequences(hashes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """The token of whole lines of ``size`` words, as ``wordhash.shingles`` has it."""
    total = np.full(len(at), size, dtype=np.uint64)
    for k in range(size):
        total += hashes[at + k] * _PLACE[100 + k]
    return mix(total)


def _input(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(t).alias("copy"), t.alias("text"))


def line_sets(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, copy, line, node, n, sketch) of comparable lines, and (shingle, n) of blocks."""
    names = ["doc_id", "copy", "line", "node", "n", "sketch"]
    kind = docs.schema[doc_id].dataType.simpleString()
    id_type = pa.string() if kind == "string" else pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, none = S.FrequentShingles(), np.zeros(0, dtype=np.uint64)

        def counted(block):
            values, n = block
            return pa.RecordBatch.from_arrays([
                pa.nulls(len(values), id_type), pa.nulls(len(values), pa.int64()), pa.nulls(len(values), pa.int32()),
                pa.array(values.view(np.int64)), pa.array(n.astype(np.int64)), pa.nulls(len(values), pa.binary())], names)

        for batch in batches:
            for part in pieces(batch, "text", PART):
                sets = LineSets(part.column("text"), none)
                new = {}
                for k, node in enumerate(sets.node.tolist()):
                    new.setdefault(node, k)
                fresh = np.zeros(len(sets.n), dtype=bool)
                fresh[[k for node, k in new.items() if node not in often.seen]] = True
                for block in often.add_all([*new], sets.tokens[fresh[sets.which]], int(fresh.sum())):
                    yield counted(block)
                rows = pa.array(sets.row)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").take(rows).cast(id_type), part.column("copy").take(rows), pa.array(sets.line.astype(np.int32)),
                    pa.array(sets.node), pa.array(sets.n.astype(np.int64)), sets.sketches()], names)
        yield counted(often.close())
        give_back()

    rows = written(_input(docs, doc_id, text).mapInArrow(
        run, f"doc_id {kind}, copy long, line int, node long, n long, sketch binary"), "line_sets")
    return rows.filter("line IS NOT NULL"), rows.filter("line IS NULL").select(F.col("node").alias("shingle"), "n")


def index(docs: DataFrame, doc_id: str, text: str, frequent) -> DataFrame:
    """(cell, node, left and n as one number) of the prefix tokens of each different line."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in pieces(batch, "text", PART):
                sets = LineSets(part.column("text"), frequent.value)
                fresh = np.zeros(len(sets.n), dtype=bool)
                for k, node in enumerate(sets.node.tolist()):
                    if node not in seen:
                        seen.add(node)
                        fresh[k] = True
                prefix = sets.n - -(-S.PERCENT * sets.n // 100) + 1
                place = np.arange(len(sets.tokens)) - np.repeat(sets.first[:-1], sets.n)
                chosen = fresh[sets.which] & (place < prefix[sets.which])
                node = sets.node[sets.which[chosen]]
                yield pa.RecordBatch.from_arrays([
                    pa.array(S.cells_of(mix(sets.tokens[chosen]), sets.common[chosen], node)), pa.array(node),
                    pa.array((sets.n[sets.which[chosen]] << 32) | (sets.n[sets.which[chosen]] - place[chosen]))], ["cell", "node", "sizes"])
        give_back()

    return _input(docs, doc_id, text).mapInArrow(run, "cell long, node long, sizes long")


def matches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, copy, line, first_doc_id, first_line): each later line, and the one that stays."""
    rows, counts = line_sets(docs, doc_id, text)
    frequent = S.broadcast_frequent(counts, rows.count())

    def nodes(wanted: DataFrame) -> DataFrame:
        return written(rows.join(wanted, "node").groupBy("node").agg(
            F.first("sketch").alias("sketch"), F.min(F.struct("doc_id", "copy", "line")).alias("of")), "line_nodes")

    def sets(wanted: DataFrame) -> DataFrame:
        of = written(wanted.select("of.*").groupBy("doc_id", "copy").agg(F.collect_list("line").alias("lines")), "wanted_lines")
        texts, of = _input(docs, doc_id, text), broadcast_if_small(of, F.size("lines") + 1)
        texts = texts.join(of, texts["doc_id"].eqNullSafe(of["doc_id"]) & (texts["copy"] == of["copy"])).select(F.explode(
            let(F.split("text", "\n"), lambda all_lines: F.transform("lines", lambda i: F.get(all_lines, i)))).alias("text"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in pieces(batch, "text", PART):
                    found = LineSets(part.column("text"), np.zeros(0, dtype=np.uint64))
                    yield S.set_rows(found.node.tolist(), np.split(found.tokens, found.first[1:-1]) if len(found.n) else [])

        return texts.mapInArrow(run, "node long, shingles array<long>").groupBy("node").agg(F.first("shingles").alias("shingles"))

    classes = S.components(S.links(index(docs, doc_id, text, frequent), nodes, sets, small_sets=True))
    placed = rows.select("doc_id", "copy", "line", "node").join(classes, "node", "left").select(
        F.coalesce("root", "node").alias("root"), "doc_id", "copy", "line")
    several = placed.groupBy("root").agg(F.min("doc_id").alias("first_doc_id"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    placed = written(placed.join(several.drop("size"), "root"), "class_lines")
    in_first = F.col("doc_id").eqNullSafe(F.col("first_doc_id"))  # null only where all ids of the class are
    firsts = placed.filter(in_first).groupBy("root").agg(F.min(F.struct("copy", "line")).alias("first"))
    return (placed.join(firsts, "root").filter(~(in_first & (F.struct("copy", "line") == F.col("first"))))
            .select("doc_id", "copy", "line", "first_doc_id", F.col("first.line").alias("first_line")).distinct())


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` without the later lines; documents of which nothing is left are dropped."""
    gone = written(matches(docs).groupBy("doc_id", "copy").agg(F.collect_list("line").alias("gone")), "later_lines")
    gone = broadcast_if_small(gone, F.size("gone") + 1)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), docs["doc_id"].alias("id"), F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("of"))
    rows = rows.join(gone, rows["id"].eqNullSafe(gone["doc_id"]) & (rows["of"] == gone["copy"]), "left").select("doc", "gone")
    changed, text = F.col("gone").isNotNull(), F.col("doc")["text"]
    rows = rows.withColumn("lines", F.when(changed, F.split(text, "\n")))
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone"), lambda i: F.get("lines", i))
    rows = rows.withColumn("text", F.when(changed, F.array_join(left, "\n")).otherwise(text)).filter(~changed | F.col("text").rlike(NOT_SPACE))
    columns = {"text": F.col("text"), "n_chars": F.when(changed, F.length("text").cast("long")).otherwise(F.col("doc")["n_chars"]) if "n_chars" in docs.columns else None}
    return rows.select(*[(columns[c] if c in columns else F.col("doc")[c]).alias(c) for c in docs.columns])


def query(spark, sf_dir):
    return matches(table(spark, sf_dir, "documents")).select("doc_id", "line", "first_doc_id", "first_line")


SQL = r"""
WITH RECURSIVE l AS (SELECT doc_id, unnest(range(0, len(l))) AS line, unnest(l) AS t FROM
  (SELECT doc_id, string_split(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), chr(10)) AS l FROM documents)),
w AS (SELECT doc_id, line, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM l),
sets AS (SELECT doc_id, line, CASE WHEN len(w) >= 5 THEN list_sort(list_distinct(list_transform(range(1, len(w) - 3),
  lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4]))) ELSE [array_to_string(w, ' ')] END AS s FROM w WHERE len(w) > 0),
node AS (SELECT s, row_number() OVER () AS k FROM (SELECT DISTINCT s FROM sets)),
t AS (SELECT k, len(s) AS n, unnest(s) AS t FROM node),
e AS (SELECT a.k AS a, b.k AS b FROM t a JOIN t b ON a.t = b.t AND a.k < b.k GROUP BY a.k, b.k
  HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))),
g AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT k, k AS c FROM node UNION SELECT g.b, r.c FROM r JOIN g ON g.a = r.k AND r.c < g.b),
c AS (SELECT k, min(c) AS c FROM r GROUP BY k),
placed AS (SELECT doc_id, line, c FROM sets JOIN node USING (s) JOIN c USING (k)),
f AS (SELECT doc_id, line, first_value(doc_id) OVER o AS first_doc_id, first_value(line) OVER o AS first_line FROM placed
  WINDOW o AS (PARTITION BY c ORDER BY doc_id, line))
SELECT doc_id, CAST(line AS INTEGER) AS line, first_doc_id, CAST(first_line AS INTEGER) AS first_line FROM f
WHERE doc_id <> first_doc_id OR line <> first_line
"""
