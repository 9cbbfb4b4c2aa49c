"""Property checks against brute-force Python models on small random inputs."""

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.operators.dedup import dedup_by_key
from strata.operators.expectations import apply_expectations, expect_or_drop
from strata.operators.pivot import conditional_counts, pivot_counts

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
small_int = st.one_of(st.none(), st.integers(-3, 3))
rows3 = st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), small_int, small_int), max_size=25)


def nulls_first(v):
    return (v is not None, v if v is not None else 0)


@SETTINGS
@given(rows3)
def test_kept_plus_dropped_equals_input(spark, rows):
    df = spark.createDataFrame(rows, "k string, x int, y int")
    exps = [expect_or_drop("x_pos", "x > 0"), expect_or_drop("y_small", "y < 2")]
    out, obs = apply_expectations(df, exps, "p")
    kept = out.count()
    m = obs.get
    passed = [r for r in rows if r[1] is not None and r[1] > 0 and r[2] is not None and r[2] < 2]
    assert kept == len(passed) and m["total_records"] == len(rows)
    assert m["failed_x_pos"] == sum(1 for r in rows if not (r[1] is not None and r[1] > 0))
    assert m["failed_y_small"] == sum(1 for r in rows if not (r[2] is not None and r[2] < 2))


@SETTINGS
@given(rows3)
def test_dedup_keeps_the_minimum_per_key(spark, rows):
    df = spark.createDataFrame(rows, "k string, x int, y int")
    got = {r.k: (r.x, r.y) for r in dedup_by_key(df, ["k"], ["x", "y"]).collect()}
    groups = defaultdict(list)
    for k, x, y in rows:
        groups[k].append((x, y))
    want = {k: min(v, key=lambda t: (nulls_first(t[0]), nulls_first(t[1]))) for k, v in groups.items()}
    assert got == want
    assert dedup_by_key(df, ["k"], ["x"]).count() == len(groups)  # keys unique


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 4), st.sampled_from(["desktop", "mobile", "tablet", "tv", None])),
                max_size=30))
def test_pivot_totals(spark, rows):
    df = spark.createDataFrame(rows, "k int, device string")
    listed = ["desktop", "mobile", "tablet"]
    a = {r.k: r for r in pivot_counts(df, "k", "device", listed).collect()}
    b = {r.k: r for r in conditional_counts(df, "k", "device", listed).collect()}
    total = defaultdict(int)
    other = defaultdict(int)
    for k, d in rows:
        total[k] += 1
        other[k] += d not in listed
    assert set(a) == set(b) == set(total)
    for k in total:
        assert a[k] == b[k]
        assert sum(a[k][d] for d in listed) + other[k] == total[k]
