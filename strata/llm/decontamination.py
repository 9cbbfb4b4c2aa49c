"""Benchmark decontamination by template canonicalisation.

Texts become sequences of template tokens: numbers, units after numbers and
names (capitalised words inside a sentence) turn into typed placeholders, other
words are lower-cased. Windows of ``WINDOW`` tokens are hashed, and documents'
windows are hash-joined with the benchmark's; plain windows (words without
placeholders) go with them, so a copy in other case is found as well.

A placeholder matches any value, so the values are checked: along a run of
windows at one distance between item and document, each of the item's values
must always stand for the same value of the document. Template windows count in
runs that pass, plain windows, which match word for word, in all. A document is
contaminated by an item if at least ``MIN_SHARE`` of the item's windows are
found, or that share of its template windows of ``MIN_LITERALS`` words or more
(the only ones indexed) in two places at least that cover ``MIN_COVER`` of its
tokens. Values that differ mark a re-parameterised copy. An item of fewer than
``WINDOW`` tokens is one window and found only where it is a whole sentence or line;
items of fewer than ``MIN_LITERALS`` tokens say too little and are never found.

Windows that many items share (an instruction) don't pair every document with
every item: items are first met by their rarest windows alone, as many as leave
too few others to reach the share, and only pairs that met are compared in full.

Of a document's windows only those leave the task whose hash the benchmark has.
The benchmark's hashes are broadcast if there are at most ``MAX_BROADCAST`` (they
are counted first), else all windows go through a join by hash.

Defined results: null and empty texts match nothing; an empty benchmark matches nothing; repeated rows (same id and
text) give one row per item, equal texts under other ids rows of their own;
null ids are kept as null; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import table, written
from strata.llm.wordhash import mix, pieces, windows, words

WINDOW, MIN_LITERALS, MIN_SHARE, MIN_COVER, MAX_BROADCAST = 8, 4, 0.5, 0.25, 4_000_000
#: Units that count as such after a number.
UNITS = ("mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres g kg mg lb lbs oz "
         "gram grams kilogram kilograms pound pounds ounce ounces ton tons l ml liter liters litre litres s sec second "
         "seconds min minute minutes h hour hours day days week weeks month months year years percent dollar dollars "
         "euro euros cent cents degree degrees mph kph hz w kw volt volts watt watts").split()

_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_STOP = np.zeros(256, dtype=np.int32)
_STOP[[10, 33, 46, 58, 63]] = 1  # newline ! . : ?
_NUMBER, _UNIT, _NAME = (mix(np.array([k], dtype=np.uint64))[0] for k in (11, 12, 13))
_PLAIN = np.uint64(0x5851F42D4C957F2D)


def _units() -> np.ndarray:
    return np.sort(words(pa.array(UNITS), _WORD).hashes)


def canonical(texts: pa.Array, units: np.ndarray):
    """(template tokens, values or 0, plain tokens, whether a sentence or line begins, first token of each row) of a batch."""
    w = words(texts, _WORD)
    n = len(w.hashes)
    if not n:
        return w.hashes, w.hashes, w.hashes, np.zeros(0, dtype=bool), w.first
    lead, nxt = w.data[w.starts], w.data[np.minimum(w.starts + 1, len(w.data) - 1)]
    number = (lead >= 48) & (lead < 58)
    opens = np.zeros(n, dtype=bool)
    opens[w.first[:-1][w.first[:-1] < n]] = True
    after = np.concatenate([[0], w.ends[:-1]])
    # 3.5 or 1,000: one number of all its parts.
    joined = number & np.concatenate([[False], number[:-1]]) & (w.starts - after == 1) & np.isin(w.data[after], (44, 46)) & ~opens
    stops = np.concatenate([[0], np.cumsum(_STOP[w.data], dtype=np.int64)])
    begins = opens | (stops[w.starts] > stops[after])
    upper = ((lead >= 65) & (lead < 91)) | ((lead == 0xC3) & (nxt >= 0x80) & (nxt < 0x9F))
    unit = np.concatenate([[False], number[:-1]]) & ~opens & np.isin(w.hashes, units)
    name = upper & ~begins & ~unit & ~number
    heads = np.flatnonzero(~joined)
    value = np.add.reduceat(w.hashes, heads)
    number, unit, name = number[heads], unit[heads], name[heads]
    template = np.where(number, _NUMBER, np.where(unit, _UNIT, np.where(name, _NAME, value)))
    values = np.where(number | unit | name, value, np.uint64(0))
    return template, values, value, begins[heads], np.searchsorted(heads, w.first)


def _table(hashes: np.ndarray):
    """Sorted hashes and a bitmap of their low bits, to pass over most others."""
    bits = np.zeros(1 << 22, dtype=bool)
    bits[hashes & np.uint64((1 << 22) - 1)] = True
    return hashes, bits


def _sized(size: int) -> np.uint64:
    """What tells hashes of shorter windows from those of ``WINDOW`` tokens."""
    return mix(np.array([100 + size], dtype=np.uint64))[0] if size < WINDOW else np.uint64(0)


def window_rows(texts: DataFrame, key: str, text: str, wanted=None, sizes: list[int] | None = None) -> DataFrame:
    """(key, at, size, window, windows, usable, values): windows of each text, all or those ``wanted`` has.

    Windows have ``sizes`` tokens; without it, ``WINDOW`` or, where a text has
    fewer, all of it. ``wanted`` is a broadcast of :func:`_table`. ``windows`` and
    ``usable`` count the text's windows and those of enough literals to be
    template windows; ``values`` of plain windows are empty. Windows shorter than
    ``WINDOW`` are whole sentences.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = _units()
        for batch in batches:
            for part in pieces(batch, "text"):
                template, values, plain, begins, first = canonical(part.column("text"), units)
                literal = np.concatenate([[0], np.cumsum(values == 0)])
                tokens = np.diff(first)
                for size in sizes or range(MIN_LITERALS, WINDOW + 1):
                    n = len(template) - size + 1
                    if n < 1:
                        continue
                    row = np.searchsorted(first, np.arange(n), side="right") - 1
                    whole = np.arange(n) + size <= first[row + 1]
                    if sizes is None and size < WINDOW:
                        whole &= tokens[row] == size
                    if size < WINDOW and sizes is not None:
                        last = np.arange(n) + size == first[row + 1]
                        whole &= begins[:n] & (last | np.append(begins, True)[size:size + n])
                    if not whole.any():
                        continue
                    enough = whole & (literal[size:size + n] - literal[:n] >= MIN_LITERALS)
                    salt = _sized(size)
                    usable = np.bincount(row[enough], minlength=len(tokens))
                    for hashes, ok, typed in ((windows(template, size) ^ salt, enough, True), (windows(plain, size) ^ salt ^ _PLAIN, whole, False)):
                        if wanted is not None:
                            known, bits = wanted.value
                            ok = ok & bits[hashes & np.uint64(len(bits) - 1)]
                        at = np.flatnonzero(ok)
                        if wanted is not None and len(at):
                            place = np.minimum(np.searchsorted(known, hashes[at]), len(known) - 1)
                            at = at[known[place] == hashes[at]]
                        if not len(at):
                            continue
                        held = values[at[:, None] + np.arange(size)] if typed else np.zeros((len(at), 0), dtype=np.uint64)
                        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * held.shape[1], pa.int32()),
                                                         pa.array(held.ravel().view(np.int64)))
                        rows = pa.array(row[at])
                        yield pa.RecordBatch.from_arrays(
                            [part.column("key").take(rows), part.column("copy").take(rows),
                             pa.array((at - first[row[at]]).astype(np.int64)), pa.array(np.full(len(at), size, dtype=np.int64)),
                             pa.array(hashes[at].view(np.int64)), pa.array((tokens[row[at]] - size + 1).astype(np.int64)),
                             pa.array(usable[row[at]].astype(np.int64)), lists],
                            ["key", "copy", "at", "size", "window", "windows", "usable", "values"])

    kind = texts.schema[key].dataType.simpleString()
    t = F.coalesce(F.col(text), F.lit(""))
    return texts.select(F.col(key).alias("key"), F.xxhash64(t).alias("copy"), t.alias("text")).mapInArrow(
        run, f"key {kind}, copy long, at long, size long, window long, windows long, usable long, values array<long>")


def leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text",
          min_share: float = MIN_SHARE, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """One row for each document and item that contaminates it."""
    spark = docs.sparkSession
    items = written(window_rows(benchmark, item_id, text), "decontamination")
    distinct = items.select("window").distinct()
    wanted = None
    if distinct.count() <= max_broadcast:
        known = np.sort(np.array([r[0] for r in distinct.toLocalIterator()], dtype=np.int64).view(np.uint64))
        if not len(known):
            known = np.zeros(1, dtype=np.uint64)
        wanted = spark.sparkContext.broadcast(_table(known))
    sizes = sorted(r[0] for r in items.select("size").distinct().collect()) or [WINDOW]
    found = window_rows(docs, doc_id, text, wanted, sizes).select(
        F.col("key").alias("doc_id"), "copy", F.col("at").alias("doc_at"), "window", F.col("values").alias("doc_values"))
    found = written(found if wanted else found.join(distinct, "window", "left_semi"), "decontamination")
    items = items.select(F.col("key").alias("item_id"), F.col("copy").alias("item_copy"), "at", "size", "window", "windows", "usable", "values")
    met = (found.select("doc_id", "copy", "window").join(rarest(items, min_share), "window")
           .select("doc_id", "copy", "item_id", "item_copy").distinct())
    same = lambda *names: [F.col(f"a.{n}").eqNullSafe(F.col(f"b.{n}")) for n in names]
    pairs = met.alias("a").join(found.alias("b"), same("doc_id", "copy")).select(
        "a.doc_id", "a.copy", "a.item_id", "a.item_copy", "b.doc_at", "b.window", "b.doc_values")
    runs = (pairs.alias("a").join(items.alias("b"), same("item_id", "item_copy", "window"))
            .select("a.*", "b.at", "b.size", "b.windows", "b.usable", "b.values")
            .groupBy("doc_id", "copy", "item_id", "item_copy", (F.col("doc_at") - F.col("at")).alias("shift"))
            .agg(F.collect_set(F.when(F.size("values") == 0, F.col("at"))).alias("plain"),
                 F.collect_set(F.when(F.size("values") > 0, F.col("at"))).alias("typed"), F.max("size").alias("size"),
                 F.max("windows").alias("windows"), F.max("usable").alias("usable"),
                 F.array_distinct(F.flatten(F.collect_set(F.arrays_zip("values", "doc_values")))).alias("pairs")))
    pairs = F.filter("pairs", lambda p: p["values"] != 0)
    none = F.array().cast("array<long>")
    runs = runs.withColumn("pairs", pairs).withColumn(
        "passes", F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda p: p["values"])))).withColumn(
        "at", F.array_union("plain", F.when(F.col("passes"), F.col("typed")).otherwise(none))).withColumn(
        "typed", F.when(F.col("passes"), F.col("typed")).otherwise(none)).filter(F.size("at") > 0)
    spans = runs.select("doc_id", "copy", "item_id", "item_copy", "windows", "usable", "size", "at", "typed",
                        (F.array_min("at") + F.col("shift")).alias("first"), (F.array_max("at") + F.col("shift") + F.col("size") - 1).alias("last"),
                                        (F.col("passes") & F.exists("pairs", lambda p: p["values"] != p["doc_values"])).alias("changed"))
    per_item = spans.groupBy("doc_id", "copy", "item_id", "item_copy").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("at")))).cast("long").alias("found_windows"),
        F.size(F.array_distinct(F.flatten(F.collect_list("typed")))).cast("long").alias("typed_windows"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("typed")))).alias("typed"), F.max("size").alias("size"),
        F.max("windows").alias("item_windows"), F.max("usable").alias("usable_windows"), F.min("first").alias("first_token"), F.max("last").alias("last_token"),
        F.max("changed").alias("reparameterised"))
    # Tokens covered: each window's own, less what the next one covers.
    covered = F.aggregate(F.transform("typed", lambda x, k: F.least(F.col("size"), F.coalesce(F.get("typed", k + 1) - x, F.col("size")))),
                          F.lit(0).cast("long"), lambda n, x: n + x)
    by_type = ((F.col("typed_windows") >= F.greatest(F.lit(2.0), min_share * F.col("usable_windows")))
               & (covered >= MIN_COVER * (F.col("item_windows") + F.col("size") - 1)))
    return per_item.filter((F.col("found_windows") >= min_share * F.col("item_windows")) | by_type).drop("typed", "size")


def rarest(items: DataFrame, min_share: float) -> DataFrame:
    """(window, item_id, item_copy): the windows by which an item has to be met.

    With n places of which ``need`` must be found, a pair that has none of the
    n - need + 1 rarest has too few; so for all windows and for the typed ones.
    An item's places are sorted by how many items share their windows.
    """
    shared = items.groupBy("window").agg(F.count(F.lit(1)).alias("shared"))
    rows = items.select("window", "item_id", "item_copy", "at", "windows", "usable", (F.size("values") > 0).alias("typed")).join(shared, "window")
    item = ["item_id", "item_copy"]
    places = (rows.groupBy(*item, "at").agg(
        F.max("shared").alias("any"), F.max("windows").alias("windows"), F.max("usable").alias("usable"),
        F.max(F.when(F.col("typed"), F.col("shared"))).alias("typed")))
    order = lambda c: F.row_number().over(Window.partitionBy(*item).orderBy(F.col(c).asc_nulls_last(), "at"))
    spare = lambda n, least: F.col(n) - F.greatest(F.lit(least), F.ceil(min_share * F.col(n))) + 1
    chosen = places.select(*item, "at", (order("any") <= spare("windows", 1)).alias("by_any"),
                           ((order("typed") <= spare("usable", 2)) & F.col("typed").isNotNull()).alias("by_type")).filter("by_any OR by_type")
    both = rows.alias("a").join(chosen.alias("b"), [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*item, "at"]])
    return (both.filter("b.by_any OR (a.typed AND b.by_type)")
            .select("a.window", "a.item_id", "a.item_copy").distinct())


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, with all their columns."""
    bad = leaks(docs.select("doc_id", "text"), benchmark, **options).select("copy").distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("copy"))
    return rows.join(bad, "copy", "left_anti").select("row.*")


def query(spark, sf_dir):
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "found_windows", "item_windows", "first_token", "last_token", "reparameterised")
