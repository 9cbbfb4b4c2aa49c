"""Repeated passages by a sparse suffix array.

Equal texts are one from the start: a text goes with the least and the greatest
of its documents. Of a text's word positions only minimisers are kept: in every run of
``LEAST - K + 1`` neighbouring K-grams that with the least hash. Equal passages of
``LEAST`` words keep a suffix at the same place, so none is missed, and about one
position in thirteen is kept. Suffixes whose first K words one document alone
has are dropped. The others go, with the ``REACH`` words before and after those K, to
the task of their first words and are sorted there by the words that follow.
Neighbours in that order, and in the order by the words before (from the nearest
back), are compared: the words that they share are how far a match extends to the
right and to the left. Suffixes that share l words back and ``REACH - l`` words on
hold the same window of ``LEAST`` words; a passage is a run of such windows.

A group of equal first words with more than ``GROUP`` suffixes is too large for
one task. Windows around those are hashed and met by partial aggregates instead,
which gives the same rows; so no group is capped.

Joins are merges at every size: with broadcasts of what happens to be small, work
would grow by jumps.

Words are compared by hashes: the first K by one of 64 bits, each word around them
by 32 bits.

Defined results: null, blank and short texts have no passages; exact copies are
passages of each other; rows of equal id are one document; rows with null id are
told apart by their text and come before all others; case of A-Z is ignored;
other columns are ignored, or kept by :func:`without_repeats`. Whole-number ids
order documents, ids of other types do by a hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import NOT_SPACE, table, written
from strata.llm.wordhash import give_back, pieces, windows, words

LEAST, K = 50, 25
#: Words of a window beside the K that a suffix is met by.
REACH = LEAST - K
#: Suffixes of equal first words that one task compares (200 bytes of context each: 7 MB).
GROUP = 1 << 15
#: Suffixes with their contexts in one batch.
CONTEXTS = 20_000


def minimisers(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, K-gram hashes) that are kept; rows are ``first[i]:first[i + 1]``."""
    grams, span = windows(hashes, K), LEAST - K + 1
    if len(grams) < span:
        return np.zeros(0, dtype=np.int64), grams[:0]
    views = np.lib.stride_tricks.sliding_window_view(grams, span)
    at = np.arange(len(views))
    row = np.searchsorted(first, at, side="right") - 1
    whole = at + LEAST <= first[row + 1]
    kept = np.unique((at + views.argmin(axis=1))[whole])
    return kept, grams[kept]


def _ids(docs: DataFrame, doc_id: str, text: str) -> tuple[Column, Column]:
    """(number of the document, hash of the text); numbers of null ids are negative."""
    copy = F.xxhash64(F.coalesce(docs[text], F.lit("")))
    whole = isinstance(docs.schema[doc_id].dataType, T.IntegralType)
    number = docs[doc_id].cast("long") if whole else F.xxhash64(docs[doc_id].cast("string"))
    return F.when(docs[doc_id].isNull(), copy.bitwiseOR(F.lit(-2**63))).otherwise(number), copy


def _input(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(d, doc_id, copy, text) of the texts that are long enough for a passage."""
    d, copy = _ids(docs, doc_id, text)
    rows = docs.select(d.alias("d"), docs[doc_id].alias("doc_id"), copy.alias("copy"), docs[text].alias("text"))
    return rows.filter(F.octet_length("text") >= 2 * LEAST - 1)


def suffixes(docs: DataFrame) -> DataFrame:
    """(key, copy, at, lo, hi): the kept suffixes of each text, and its least and greatest document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                w = words(part.column("text"))
                at, keys = minimisers(w.hashes, w.first)
                row = np.searchsorted(w.first, at, side="right") - 1
                rows = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), part.column("d").take(rows), part.column("copy").take(rows),
                                                  pa.array((at - w.first[row]).astype(np.int32))], ["key", "d", "copy", "at"])
        give_back()
    rows = docs.select("d", "copy", "text").mapInArrow(run, "key long, d long, copy long, at int")
    return rows.groupBy("copy", "at", "key").agg(F.min("d").alias("lo"), F.max("d").alias("hi"))


def seeds(found: DataFrame, within: bool) -> DataFrame:
    """(copy, lo, hi, places, hot): suffixes whose first words stand elsewhere, too; those of
    large groups apart."""
    elsewhere = "lo <> hi" + (" OR first <> last" if within else "")
    keys = (found.groupBy("key").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("at").alias("first"), F.max("at").alias("last"),
                                     F.count(F.lit(1)).alias("n"))
            .filter(elsewhere).select("key", (F.col("n") > GROUP).alias("hot")))
    return found.join(keys.hint("merge"), "key").groupBy("copy").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.collect_set(F.when(~F.col("hot"), F.col("at"))).alias("places"),
        F.collect_set(F.when(F.col("hot"), F.col("at"))).alias("hot"))


def _places(docs: DataFrame, found: DataFrame) -> DataFrame:
    """One text for each copy, with the places of its seeds: (copy, lo, hi, text, places, hot)."""
    found = found.withColumnRenamed("copy", "of").hint("merge")
    texts = docs.join(found, (docs["copy"] == found["of"]) & (docs["d"] == found["lo"]))
    return texts.select("copy", "lo", "hi", "text", "places", "hot").dropDuplicates(["copy", "lo"])


def _words_around(hashes: np.ndarray, at: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """Per place the hashes of the words from ``at``, a column each; 0 beyond the text."""
    there = (at >= begin[:, None]) & (at < end[:, None])
    around = np.where(there, hashes[np.clip(at, 0, max(len(hashes) - 1, 0))], 0).astype(">u4")
    offsets = np.arange(len(at) + 1, dtype=np.int32) * (4 * REACH)
    return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(around.tobytes())])


def _around(first: np.ndarray, places: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(first words, rows) of the windows that hold the K words of a place."""
    row = np.repeat(np.arange(len(places)), np.diff(places.offsets.to_numpy()))
    at = places.flatten().to_numpy() + first[row]
    lo, hi = np.maximum(at - REACH, first[row]), np.minimum(at, first[row + 1] - LEAST)
    edges = np.zeros(int(first[-1]) + 1, dtype=np.int64)
    np.add.at(edges, lo[hi >= lo], 1)
    np.add.at(edges, hi[hi >= lo] + 1, -1)
    at = np.flatnonzero(np.cumsum(edges) > 0)
    return at, np.searchsorted(first, at, side="right") - 1


def contexts(texts: DataFrame) -> DataFrame:
    """(key, copy, lo, hi, at, back, ahead): seeds with the words around them, nearest first;
    for seeds of large groups all windows around them, with their hash and without those words."""
    step = np.arange(REACH)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                w = words(part.column("text"))
                grams, short = windows(w.hashes, K).view(np.int64), np.maximum(w.hashes >> np.uint64(32), 1)
                places = part.column("places")
                row = np.repeat(np.arange(part.num_rows), np.diff(places.offsets.to_numpy()))
                every = places.flatten().to_numpy() + w.first[row]
                for i in range(0, len(every), CONTEXTS):
                    at, rows = every[i:i + CONTEXTS], row[i:i + CONTEXTS]
                    begin, end = w.first[rows], w.first[rows + 1]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(grams[at]), *(part.column(c).take(pa.array(rows)) for c in ("copy", "lo", "hi")),
                        pa.array((at - begin).astype(np.int32)), _words_around(short, at[:, None] - 1 - step, begin, end),
                        _words_around(short, at[:, None] + K + step, begin, end)], ["key", "copy", "lo", "hi", "at", "back", "ahead"])
                at, row = _around(w.first, part.column("hot"))
                keys = windows(w.hashes, LEAST).view(np.int64)[at]
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys), *(part.column(c).take(pa.array(row)) for c in ("copy", "lo", "hi")), pa.array((at - w.first[row]).astype(np.int32)),
                    pa.nulls(len(at), pa.binary()), pa.nulls(len(at), pa.binary())], ["key", "copy", "lo", "hi", "at", "back", "ahead"])
        give_back()
    return texts.mapInArrow(run, "key long, copy long, lo long, hi long, at int, back binary, ahead binary")


def _matrix(column: pa.Array) -> np.ndarray:
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]].view(">u4").reshape(-1, REACH)


def _shared(key: np.ndarray, side: np.ndarray) -> np.ndarray:
    """How many words each sorted row shares with the row before it; -1 at a new key."""
    same = (side[1:] == side[:-1]) & (side[1:] != 0)
    shared = np.where(same.all(axis=1), REACH, same.argmin(axis=1))
    return np.concatenate([[-1], np.where(key[1:] == key[:-1], shared, -1)])


def _met(shared: np.ndarray) -> np.ndarray:
    """The most words that each row shares with a neighbour."""
    return np.maximum(shared, np.append(shared[1:], -1))


def matches(key: np.ndarray, lo: np.ndarray, hi: np.ndarray, at: np.ndarray, back: np.ndarray, ahead: np.ndarray,
            within: bool) -> tuple[np.ndarray, np.ndarray]:
    """For rows sorted by key and the words ahead: whether the window that reaches l words
    back from a row stands elsewhere, and whether it does earlier than in the row's least
    document (rows x windows)."""
    again, later = np.zeros((2, len(key), REACH + 1), dtype=bool)
    right = _shared(key, ahead)
    text = np.concatenate([key.astype(">i8").view(np.uint8).reshape(-1, 8), np.ascontiguousarray(back).view(np.uint8)], axis=1)
    order = np.argsort(text.view(f"S{text.shape[1]}").ravel(), kind="stable")
    left = _shared(key[order], back[order])
    right_met, left_met = _met(right), np.empty_like(left)
    left_met[order] = _met(left)
    several = lo != hi  # a text of several documents repeats all that it has
    right_met[several], left_met[several] = (ahead[several] != 0).sum(axis=1), (back[several] != 0).sum(axis=1)
    left_class = np.empty(len(key), dtype=np.int64)
    for back_words in range(REACH + 1):
        ahead_words = REACH - back_words
        rows = np.flatnonzero((left_met >= back_words) & (right_met >= ahead_words))
        if not len(rows):
            continue
        left_class[order] = np.cumsum(left < back_words)
        window = left_class[rows] * (len(key) + 1) + np.cumsum(right < ahead_words)[rows]
        start = (at[rows] - back_words) if within else np.zeros(len(rows), dtype=np.int64)
        by = np.lexsort((start, lo[rows], window))
        rows, start, window = rows[by], start[by], window[by]
        first = np.flatnonzero(np.concatenate([[True], window[1:] != window[:-1]]))
        size = np.diff(np.append(first, len(rows)))
        elsewhere = (np.maximum.reduceat(hi[rows], first) != lo[rows][first]) | (np.maximum.reduceat(start, first) != start[first])
        again[rows, back_words] = np.repeat(elsewhere, size)
        later[rows, back_words] = (lo[rows] != np.repeat(lo[rows][first], size)) | (start != np.repeat(start[first], size))
    return again, later


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, end) of each run of set flags in a row."""
    edges = np.diff(np.pad(flags, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, first = np.nonzero(edges == 1)
    return row, first, np.nonzero(edges == -1)[1]


def neighbours(rows: DataFrame, within: bool) -> DataFrame:
    """(copy, start, stop, later): runs of first words of repeated windows, and of those
    that stand earlier than in the text's least document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in _and_none(batches):
            if batch is None:
                whole = rest
            else:
                whole = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
                key = whole.column("key").to_numpy()
                cut = int(np.searchsorted(key, key[-1])) if len(key) else 0  # the last group may go on
                whole, rest = whole.slice(0, cut), whole.slice(cut)
            if whole is None or not whole.num_rows:
                continue
            t = whole.combine_chunks()
            one = {c: t.column(c).chunk(0) for c in t.column_names}
            at = one["at"].to_numpy().astype(np.int64)
            found = matches(*(one[c].to_numpy() for c in ("key", "lo", "hi")), at, _matrix(one["back"]), _matrix(one["ahead"]), within)
            for later, flags in enumerate(found):
                row, first, end = _runs(flags)  # l words back: starts at - end + 1 ... at - first
                yield pa.RecordBatch.from_arrays([one["copy"].take(pa.array(row)), pa.array((at[row] - end + 1).astype(np.int32)),
                                                  pa.array((at[row] - first + 1).astype(np.int32)), pa.array(np.full(len(row), bool(later)))],
                                                 ["copy", "start", "stop", "later"])
        give_back()
    return rows.repartition("key").sortWithinPartitions("key", "ahead").mapInArrow(run, "copy long, start int, stop int, later boolean")


def _and_none(items: Iterator) -> Iterator:
    yield from items
    yield None


def hot_windows(rows: DataFrame, within: bool) -> DataFrame:
    """The rows of :func:`neighbours` for windows of large groups, met by their hashes."""
    rows = rows.select("key", "copy", "lo", "hi", F.col("at").alias("start"))
    start = F.col("start") if within else F.lit(0)
    met = (rows.groupBy("key").agg(F.min(F.struct("lo", start.alias("start"))).alias("one"), F.max("hi").alias("last"), F.max(start).alias("end"))
           .filter("one.lo <> last OR one.start <> end").select("key", "one"))
    first = (F.col("lo") == F.col("one")["lo"]) & (start == F.col("one")["start"])
    return rows.join(met.hint("merge"), "key").select("copy", "start", (F.col("start") + 1).alias("stop"), F.explode(
        F.when(first, F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))).alias("later"))


def _found(docs: DataFrame, within: bool) -> tuple[DataFrame, DataFrame]:
    """(copy, lo) of texts with seeds, and (copy, later, first_word, end_word): their
    repeated passages, and those that stand earlier than in the least document."""
    found = written(seeds(written(suffixes(docs), "suffixes"), within), "seeds")
    rows = written(contexts(_places(docs, found)), "contexts")
    runs = neighbours(rows.filter("back IS NOT NULL"), within).unionByName(hot_windows(rows.filter("back IS NULL"), within))
    return found.select("copy", "lo"), written(_spans(runs, ["copy", "later"]), "passages")


def _spans(runs: DataFrame, by: list[str]) -> DataFrame:
    """Runs of places that meet, joined: columns ``by``, first_word and end_word."""
    order = Window.partitionBy(*by).orderBy("start")
    before = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(F.coalesce(before < F.col("start"), F.lit(True)), 1).otherwise(0)
    return (runs.select(*by, "start", "stop").withColumn("new", new).withColumn("span", F.sum("new").over(order))
            .groupBy(*by, "span").agg(F.min("start").alias("first_word"), (F.max("stop") - 1 + LEAST).alias("end_word")).drop("span"))


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", within: bool = False) -> DataFrame:
    """(doc_id, first_word, end_word): each passage that other documents hold, or, with
    ``within``, that stands elsewhere in the same document."""
    docs = _input(docs, doc_id, text)
    spans = _found(docs, within)[1].filter("NOT later").withColumnRenamed("copy", "of")
    held = docs.select("d", "copy", "doc_id").distinct()
    places = held.join(spans.hint("merge"), held["copy"] == spans["of"]).select(
        "d", "doc_id", F.col("first_word").alias("start"), (F.col("end_word") - LEAST + 1).alias("stop"))
    return _spans(places, ["d", "doc_id"]).select("doc_id", "first_word", "end_word")


def _cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
    """Texts without the words of the spans; other white space stays."""
    out = []
    for text, gone in zip(texts, spans):
        if gone is not None and len(gone):
            raw = text.encode()
            w, left, at = words(pa.array([text])), [], 0
            for first, end in sorted(map(tuple, gone)):
                left.append(raw[at:int(w.starts[first])])
                at = int(w.ends[end - 1])
            text = b"".join([*left, raw[at:]]).decode()
        out.append(text)
    return pd.Series(out, dtype=object)


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", within: bool = False) -> DataFrame:
    """``docs`` without passages that an earlier document (``within``: or an earlier place)
    holds; documents of which no word is left are dropped. The first of equal passages stays;
    with ``within``, a passage that overlaps its own repeats keeps one period."""
    texts, spans = _found(_input(docs, doc_id, text), within)
    pair = F.array("first_word", "end_word")
    spans = spans.groupBy("copy").agg(F.collect_list(F.when(~F.col("later"), pair)).alias("again"), F.collect_list(F.when(F.col("later"), pair)).alias("later"))
    gone = written(texts.join(spans, "copy"), "later_passages").select(F.col("copy").alias("of"), "lo", "again", "later")
    d, copy = _ids(docs, doc_id, text)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), d.alias("d"), copy.alias("copy"))
    rows = rows.join(gone.hint("merge"), rows["copy"] == gone["of"], "left")
    # The least of equal documents keeps what stands nowhere earlier; the others keep no repeated passage.
    rows = rows.select("doc", F.when(F.col("d") == F.col("lo"), F.col("later")).otherwise(F.col("again")).alias("gone"))
    left = F.pandas_udf(_cut, "string")(F.col("doc")[text], F.col("gone"))
    rows = rows.withColumn("left", left).filter((F.coalesce(F.size("gone"), F.lit(0)) <= 0) | F.col("left").rlike(NOT_SPACE))
    return rows.select(*[(F.col("left") if c == text else F.col("doc")[c]).alias(c) for c in docs.columns])


def query(spark, sf_dir):
    return repeated_passages(table(spark, sf_dir, "documents"))


SQL = r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, pos, md5(array_to_string(w[pos + 1:pos + 50], ' ')) AS k FROM
  (SELECT doc_id, w, unnest(CASE WHEN len(w) >= 50 THEN range(0, len(w) - 49) ELSE [] END) AS pos FROM w)),
r AS (SELECT DISTINCT doc_id, pos FROM g JOIN (SELECT k FROM g GROUP BY k HAVING count(DISTINCT doc_id) > 1) USING (k)),
i AS (SELECT doc_id, pos, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM r)
SELECT doc_id, CAST(min(pos) AS INTEGER) AS first_word, CAST(max(pos) + 50 AS INTEGER) AS end_word FROM i GROUP BY doc_id, run
"""
