"""Exact duplicates by distributed MSD radix partitioning.

Texts are equal when they are the same after A-Z are lower-cased. All documents
start in one group. Each round looks at the next bytes of the texts still open (256,
then 16 times as many, up to 1 MB) and splits every group by them. A document is
done when it is alone in its group, or when its text has ended: then the group's
texts are equal byte for byte. No digest decides anything; a digest is only returned.

A round is a partial count of (group, bytes), which sends a hot group's copies over
the network as one row a task, and a join back to the documents. Keys with more than
``1 / slots`` of the open rows, of which there can't be more than ``slots``, are
broadcast, so that their documents aren't shuffled at all; ``slots`` falls as the
pieces get longer and keeps that table under ``HOT_BYTES``. All other keys meet in
shuffled joins. Bytes that have been compared aren't carried on, and documents that
are done leave their text behind, so all rounds together move about the copies' bytes.

Defined results: a null text counts as empty, and empty texts are a group; ids may
be null (the least of all) or repeated; of equal rows with the largest id one stays;
other columns are kept as they are under any name; an empty table gives an empty one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import table, written

#: Bytes of the first round; each further round looks at ``GROWTH`` times as many.
FIRST, GROWTH, WIDEST = 256, 16, 1 << 20
#: Most bytes and rows of the pieces that are broadcast in a round.
HOT_BYTES, HOT_ROWS = 32 << 20, 1000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ALL = (1 << 31) - 1


def _lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def _bytes(text: Column, start: int, length: int = _ALL) -> Column:
    return F.substring(text, start, length)


def _split(rows: DataFrame, piece: Column, width: int, total: int) -> tuple[DataFrame, int]:
    """``rows`` with their new group, its size and largest id (nulls where alone),
    and how many rows stay open. ``rows``: id, group and what ``piece`` needs."""
    keyed = rows.withColumn("piece", piece)
    sums = written(keyed.groupBy("group", "piece").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("keep_id"))
                   .filter("n > 1").withColumn("new", F.monotonically_increasing_id()), "radix_groups")
    slots = max(16, min(HOT_ROWS, HOT_BYTES // width))
    hot = F.col("n") * slots > total
    many, still_open = sums.agg(F.count_if(hot), F.sum(F.when(F.length("piece") == width, F.col("n")))).first()
    cold = keyed
    if many:
        frequent = F.broadcast(sums.filter(hot))
        cold = keyed.join(frequent, ["group", "piece"], "left_anti")
    # The groups grow with the documents; their join keeps one plan, in bounded memory, at every size.
    split = cold.join(sums.filter(~hot).hint("merge"), ["group", "piece"], "left")
    if many:
        split = split.unionByName(keyed.join(frequent, ["group", "piece"]))
    return split, still_open or 0


def _groups(rows: DataFrame) -> DataFrame:
    """(id, text, extra columns) -> (row, id, round, group, n, keep_id, digest, extra
    columns): n and keep_id are null for a document that has no equal."""
    extra = [c for c in rows.columns if c not in ("id", "text")]
    # The first round's pieces come from a text's first characters, so that only the rows of its join are normalised whole.
    rows = rows.withColumns({"text": F.coalesce("text", F.lit("")), "group": F.lit(0).cast("long")})
    first = _bytes(_lower(F.substring("text", 1, FIRST)).cast("binary"), 1, FIRST)
    split, still_open = _split(rows, first, FIRST, rows.count())
    split = (split.withColumn("whole", _lower(F.col("text"))).withColumns({
        "digest": F.sha2(F.col("whole"), 256), "left": F.col("whole").cast("binary"), "row": F.monotonically_increasing_id()}))
    done, width, k = [], FIRST, 0
    while True:
        ended = F.col("n").isNull() | (F.length("piece") < width)
        split = written(split.select("row", "id", "digest", *extra, F.lit(k).alias("round"), F.col("new").alias("group"), "n", "keep_id",
                                     F.when(~ended, _bytes(F.col("left"), width + 1)).alias("left")), "radix_round")
        done.append(split.filter(F.col("left").isNull()).drop("left"))
        if not still_open:
            return reduce(DataFrame.unionByName, done)
        width, k = min(width * GROWTH, WIDEST), k + 1
        rest = split.filter(F.col("left").isNotNull()).drop("round", "n", "keep_id")
        split, still_open = _split(rest, _bytes(F.col("left"), 1, width), width, still_open)


def equal_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: bool = False) -> DataFrame:
    """(id, keep_id, group_size, kept, digest) of each row of ``docs``; with ``carry``
    also ``doc``, a struct of all its columns."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), *([F.struct(*[docs[c] for c in docs.columns]).alias("doc")] if carry else []))
    found = _groups(rows)
    several = found.filter("n IS NOT NULL")
    stays = several.filter(F.col("id").eqNullSafe(F.col("keep_id"))).groupBy("round", "group").agg(F.min("row").alias("row"))
    several = several.join(stays.select("row", F.lit(True).alias("kept")), "row", "left").withColumn("kept", F.coalesce("kept", F.lit(False)))
    alone = found.filter("n IS NULL").withColumns({"n": F.lit(1).cast("long"), "keep_id": F.col("id"), "kept": F.lit(True)})
    return several.unionByName(alone).select("id", "keep_id", F.col("n").alias("group_size"), "kept", "digest", *(["doc"] if carry else []))


def distinct_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, whole, without those whose text a row with a larger id has."""
    return equal_texts(docs, doc_id, text, carry=True).filter("kept").select("doc.*")


def query(spark, sf_dir):
    return equal_texts(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


SQL = f"""
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents) WINDOW w AS (PARTITION BY t)
"""
