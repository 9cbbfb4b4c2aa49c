"""Hard negatives by Fagin's threshold algorithm.

Components are whole numbers (``floor(256 * x)``), scores are exact inner products.
An anchor's positives are its best other rows of the same label; each positive sets a
window of scores, and the best rows of other labels whose scores lie in it are the
hard negatives.

Rows are dealt into cells of about ``CELL_ROWS`` rows and anchors into groups of about
``ANCHOR_GROUP``; a task gets one cell and one group (a stated query set against all
rows, in blocks). In a cell each dimension has a list of rows sorted by that component.
The lists are read in step, from the end that the sign of the anchor's component asks
for. Rows met for the first time are scored whole (random access); what is still unmet
can't score more than the threshold, the score of the values at which the lists stand.
A window is settled once the threshold falls strictly below its k-th score (ties go by
id, so equal ones must be met), or below its lower bound. Lists stand at depths that
double, and what has been met at a depth is kept as a bit map for each list and end, so
that "met by any list" is one OR of bit maps. A cell's best are merged over cells in
rounds of ``FAN_IN`` cells, so no task gets all cells' rows of an anchor.

Defined results: rows without a label or vector, or with a null, infinite or NaN
component, take no part; missing components of shorter vectors count as 0; rows that
repeat id, label and vector count once; different rows with one id are rows of their
own; null ids are never anchors and come last among equal scores; an anchor without
positives, or a window without rows, has no result. Scores must fit in 64 bits. Other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import table, written

CELL_ROWS, ANCHOR_GROUP, FAN_IN = 8192, 4096, 64
FIRST_DEPTH = 32
_NO_ID = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Rules:
    """``positives`` best rows of the label set windows of ``low`` to ``high`` percent of
    their scores; the first ``negatives`` rows in each are mined."""

    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90


class Lists:
    """Sorted lists of the rows of a cell, one a dimension."""

    def __init__(self, values: np.ndarray):
        n, dims = values.shape
        most = int(np.abs(values).max(initial=0)) ** 2 * dims
        # Sums of whole numbers are exact in floating point below the mantissa's range.
        self.values = values.astype(np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64)
        self.n, self.dims = n, dims
        order = np.argsort(values, axis=0, kind="stable")
        self.depths, self.met, self.edge = [], [], []
        depth, seen = 0, np.zeros((2, dims, n), dtype=bool)
        column = np.arange(dims)
        while depth < n:
            last, depth = depth, min(n, max(FIRST_DEPTH, depth * 2))
            seen[0, column, order[last:depth]] = True  # from the smallest on
            seen[1, column, order[n - depth:n - last]] = True
            self.depths.append(depth)
            self.met.append(np.packbits(seen, axis=2))
            self.edge.append(np.stack([values[order[depth - 1], column], values[order[n - depth], column]]))

    def accesses(self, anchor: np.ndarray):
        """(rows met for the first time, their scores, threshold) at each depth."""
        used = np.flatnonzero(anchor)
        if not len(used):  # all scores are 0, and so is the threshold
            yield np.arange(self.n), np.zeros(self.n, dtype=np.int64), 0
            return
        end = (anchor[used] > 0).astype(np.int64)
        exact = anchor.astype(self.values.dtype)
        if exact.dtype != np.int64 and int(np.abs(anchor).max()) * float(np.abs(self.values).max(initial=0)) * self.dims >= (
                1 << 24 if exact.dtype == np.float32 else 1 << 53):
            exact, self.values = anchor, self.values.astype(np.int64)
        done = np.zeros(self.met[0].shape[2], dtype=np.uint8) if self.n else None
        for met, edge in zip(self.met, self.edge):
            now = np.bitwise_or.reduce(met[end, used], axis=0)
            new = np.flatnonzero(np.unpackbits(now & ~done, count=self.n))
            done = now
            yield new, (self.values[new] @ exact).astype(np.int64), int((anchor[used] * edge[end, used]).sum())


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k by score, largest first, then id."""
    if len(scores) > k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def top(lists: Lists, ids: np.ndarray, allowed: np.ndarray, anchor: np.ndarray, windows: list[tuple[int, int]],
        k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each window (low, high: 100 times a score lies between) the first k allowed
    rows of the cell: their places and scores, best first."""
    none = np.zeros(0, dtype=np.int64)
    found = [(none, none) for _ in windows]
    waiting = set(range(len(windows)))
    for new, scores, threshold in lists.accesses(anchor):
        ok = allowed[new]
        new, scores = new[ok], scores[ok]
        for w in list(waiting):
            low, high = windows[w]
            at, had = found[w]
            fits = (scores >= -(-low // 100)) & (scores <= high // 100)
            at, had = np.concatenate([at, new[fits]]), np.concatenate([had, scores[fits]])
            first = best(had, ids[at], k)
            found[w] = at[first], had[first]
            if 100 * threshold < low or (len(first) == k and threshold < had[first[-1]]):
                waiting.discard(w)
        if not waiting:
            break
    return found


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    """A list column as rows of ``dims`` numbers."""
    rows = column.combine_chunks()
    rows = pa.concat_arrays(rows.chunks) if isinstance(rows, pa.ChunkedArray) else rows
    lengths = np.diff(rows.offsets.to_numpy())
    flat = rows.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(rows), dims), dtype=np.int64)
    if len(flat):
        row = np.repeat(np.arange(len(rows)), lengths)
        out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _ids(column: pa.ChunkedArray) -> np.ndarray:
    return column.fill_null(_NO_ID).to_numpy()


#: A window that holds every score: positives are the best rows whatever they score.
_ANY = (-100 << 62, 100 << 62)


def _searcher(rules: Rules, dims: int, positives: bool):
    """A function of a cell's rows and an anchor group: (anchor, window, uid, id, score)."""
    def search(key, rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = {"anchor": [], "window": [], "uid": [], "id": [], "score": []}
        if rows.num_rows and anchors.num_rows:
            values, vectors = _matrix(rows["vector"], dims), _matrix(anchors["anchor_vector"], dims)
            ids, uids, labels = _ids(rows["id"]), rows["uid"].to_numpy(), rows["label"].to_numpy()
            own, theirs = anchors["anchor"].to_numpy(), anchors["anchor_label"].to_numpy()
            lists = Lists(values)
            wanted = None if positives else anchors["scores"].to_pylist()
            for i, vector in enumerate(vectors):
                allowed = (labels == theirs[i]) & (uids != own[i]) if positives else labels != theirs[i]
                windows = [_ANY] if positives else [(rules.low * s, rules.high * s) for s in wanted[i]]
                for w, (at, scores) in enumerate(top(lists, ids, allowed, vector, windows, rules.positives if positives else rules.negatives)):
                    out["anchor"].append(np.full(len(at), own[i]))
                    out["window"].append(np.full(len(at), w))
                    out["uid"].append(uids[at])
                    out["id"].append(ids[at])
                    out["score"].append(scores)
        none = np.zeros(0, dtype=np.int64)
        columns = {c: np.concatenate([none, *v]) for c, v in out.items()}
        return pa.table({"cell": pa.array(np.full(len(columns["id"]), key[0].as_py()), pa.int64()),
                         **{c: pa.array(v, pa.int64(), mask=(v == _NO_ID) if c == "id" else None) for c, v in columns.items()}})

    return search


FOUND = "cell long, anchor long, window long, uid long, id long, score long"


def _merged(found: DataFrame, k: int, cells: int) -> DataFrame:
    """The first k of each anchor's window, over cells and then over what is left of them; with ``rank``."""
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("uid")]
    while True:
        cells = -(-cells // FAN_IN)
        found = found.withColumn("cell", F.floor(F.col("cell") / FAN_IN))
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy("anchor", "window", "cell").orderBy(*order))).filter(F.col("rank") <= k)
        if cells <= 1:
            return found.drop("cell")


def prepared(rows: DataFrame, vec_id: str, vector: str, label: str, relabel: Column | None = None) -> DataFrame:
    """(uid, id, label, vector of whole numbers) of the rows that take part, each once."""
    known = rows.select(F.col(vec_id).alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    known = known.filter(F.col("label").isNotNull() & F.col("vector").isNotNull() & ~bad)
    if relabel is not None:
        known = known.withColumn("label", relabel)
    known = known.withColumn("vector", F.transform("vector", lambda x: F.floor(x * 256).cast("long")))
    return written(known.withColumn("uid", F.xxhash64("id", "label", "vector")).dropDuplicates(["uid", "id", "label", "vector"]), "mining_rows")


def hard_negatives(rows: DataFrame, is_anchor: Column, rules: Rules = Rules(), cell_rows: int = CELL_ROWS,
                   anchor_group: int = ANCHOR_GROUP) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for
    ``prepared`` rows; ``is_anchor`` is a condition on ``id``."""
    count, anchors_count, dims = rows.agg(F.count(F.lit(1)), F.count_if(is_anchor), F.max(F.size("vector"))).first()
    dims = max(dims or 0, 1)
    cells, groups = max(1, -(-count // cell_rows)), max(1, -(-anchors_count // anchor_group))
    cell = F.pmod(F.xxhash64("uid", F.lit(7)), F.lit(cells)).alias("cell")
    group = F.pmod(F.xxhash64("uid", F.lit(11)), F.lit(groups)).alias("group")
    each_group = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("group")
    each_cell = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cells - 1).cast("long"))).alias("cell")
    anchors = rows.filter(is_anchor)
    dealt = rows.select(cell, each_group, "uid", "id", "label", "vector").groupBy("cell", "group")

    def met(asked: DataFrame, positives: bool, k: int) -> DataFrame:
        asked = asked.select(group, each_cell, F.col("uid").alias("anchor"), F.col("label").alias("anchor_label"), F.col("vector").alias("anchor_vector"),
                             *([] if positives else ["scores"])).groupBy("cell", "group")
        found = dealt.cogroup(asked).applyInArrow(_searcher(rules, dims, positives), FOUND)
        return written(_merged(found, k, cells), "mined")

    positives = met(anchors, True, rules.positives)
    scores = positives.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("found"))
    windows = anchors.join(scores.select(F.col("anchor").alias("uid"), F.col("found.score").alias("scores")), "uid")
    negatives = met(windows, False, rules.negatives)
    positives = positives.select("anchor", (F.col("rank") - 1).cast("long").alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (negatives.join(positives, ["anchor", "window"]).join(anchors.select(F.col("uid").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))


def query(spark, sf_dir):
    wrong = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(prepared(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label", wrong), F.coalesce(F.col("id") % 100 == 0, F.lit(False)))


SQL = """
WITH known AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
score AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
  CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM known a JOIN known b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
pos AS (SELECT anchor_id, id, score FROM score WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
neg AS (SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
  row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS rank
  FROM pos p JOIN score n ON n.anchor_id = p.anchor_id AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 10
"""
