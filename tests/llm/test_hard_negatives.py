"""Hard negatives against a whole score matrix."""

import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, uid string, cell string, `group` string, score string"
NAN, INF = float("nan"), float("inf")


def vectors(seed, n, dims=8, labels=4):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(dims)] for _ in range(labels)]
    out = []
    for k in range(n):
        label = rnd.randrange(labels)
        out.append((k, [round(c + rnd.gauss(0, 0.8), 2) for c in rnd.choice([centres[label], centres[label], rnd.choice(centres)])], label))
    return out


def odd_rows():
    rows = vectors(1, 400)
    rows += [(500, None, 1), (600, [1.0] * 8, None), (601, [1.0, NAN] + [0.0] * 6, 1), (602, [INF] * 8, 1), (700, [None] * 8, 2), (None, [0.5] * 8, 2),
             (None, [0.4] * 8, 3), (900, [0.0] * 8, 1), (1000, [], 2), (1100, [1.0, 2.0], 3), (1200, [-0.001] * 8, 0), (4900, [9.0] * 8, 9)]
    rows += [(800, [0.25] * 8, 1)] * 3  # repeated rows
    rows += [(2000 + k, [0.75] * 8, k % 4) for k in range(60)]  # one vector, many ties
    rows += [(2100, [0.1] * 8, 0), (2100, [0.2] * 8, 1)]  # one id, two rows
    return rows


def model(rows, rules=H.Rules()):
    known = {}
    for k, v, label in rows:
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            v = tuple(math.floor(256 * struct.unpack("f", struct.pack("f", x))[0]) for x in v)
            known[(k, (label + 1) % 10 if k is not None and k % 7 == 0 else label, v)] = None
    known = list(known)
    order = lambda s: (-s[0], s[1][0] is None, s[1][0] or 0)
    out = []
    for a in known:
        if a[0] is None or a[0] % 100:
            continue
        scored = sorted(((sum(x * y for x, y in zip(a[2], b[2])), b) for b in known if b is not a), key=order)
        for ps, p in [s for s in scored if s[1][1] == a[1]][:rules.positives]:
            fits = [s for s in scored if s[1][1] != a[1] and rules.low * ps <= 100 * s[0] <= rules.high * ps][:rules.negatives]
            out += [(a[0], p[0], rank, n[0], ps, s) for rank, (s, n) in enumerate(fits, 1)]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA).repartition(3)


def mined(spark, rows, **limits):
    wrong = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    known = H.prepared(frame(spark, rows), "vec_id", "embedding", "label", wrong)
    return H.hard_negatives(known, F.coalesce(F.col("id") % 100 == 0, F.lit(False)), **limits)


def key(row):
    return tuple((x is None, x) if x is None else (False, x) for x in row)


@pytest.mark.parametrize("limits", [{}, {"cell_rows": 10, "anchor_group": 2}, {"rules": H.Rules(2, 3, 10, 100)}])
def test_equal_to_the_score_matrix(spark, limits):
    rows = odd_rows()
    got = sorted((key(r) for r in mined(spark, rows, **limits).collect()), key=str)
    want = sorted((key(r) for r in model(rows, limits.get("rules", H.Rules()))), key=str)
    assert len(want) > 50 and got == want


def test_query(spark, tmp_path):
    rows = vectors(3, 900, dims=5)
    frame(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = H.query(spark, str(tmp_path))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == sorted(model(rows))


def test_empty_table_and_large_numbers(spark):
    empty = H.prepared(frame(spark, odd_rows()).limit(0), "vec_id", "embedding", "label")
    assert H.hard_negatives(empty, F.col("id") % 100 == 0).count() == 0
    for scale in (1e3, 1e6):  # scores beyond what 32 and 53 bits of a float hold
        rows = [(k, [x * scale for x in v], label) for k, v, label in vectors(4, 200)]
        assert sorted(map(tuple, mined(spark, rows).collect())) == sorted(model(rows))


def test_search_stops_before_all_rows_are_met():
    """With a strong first dimension the threshold falls below the k-th score early."""
    values = np.zeros((4000, 3), dtype=np.int64)
    values[:, 0] = np.arange(4000)
    lists = H.Lists(values)
    met = []
    for new, scores, threshold in lists.accesses(np.array([5, 0, 0])):
        met.append(len(new))
        if threshold < np.sort(scores)[-10:].min():
            break
    assert sum(met) < 100
    (places, scores), = H.top(lists, np.arange(4000), np.ones(4000, dtype=bool), np.array([5, 0, 0]), [H._ANY], 10)
    assert scores.tolist() == [5 * k for k in range(3999, 3989, -1)]
