"""Snapshot tables: batches published once, readers of versions, compaction, the ingest log."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from strata.plans.adhoc import register_paths, run_sql
from strata.sinks import snapshots as S
from strata.sinks.writers import write_table


def rows(spark, a, b, days=40):
    return spark.range(a, b).select("id", F.expr(f"date_add(DATE'2024-01-01', CAST(id % {days} AS INT))").alias("d"))


def put(spark, path, batch, a, b, **kw):
    return S.append_batch(rows(spark, a, b, **kw), path, batch, partition_cols=["d"], date_col="d")


def test_batches_are_published_once(spark, tmp_path):
    path = str(tmp_path / "t")
    assert S.latest_version(spark, path) == 0 and not S.is_snapshot_table(spark, path)
    with pytest.raises(ValueError, match="schema"):
        S.read(spark, path)
    assert [put(spark, path, k, 100 * k, 100 * k + 100) for k in range(3)] == [1, 2, 3]
    assert put(spark, path, 1, 100, 200) == 3  # a batch that is run again
    assert S.read(spark, path).count() == 300
    assert S.read(spark, path, version=2).count() == 200
    assert S.read(spark, path).columns == ["id", "d"]


def test_a_failed_batch_leaves_no_trace(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, 0, 0, 10)
    bad = rows(spark, 0, 10).withColumn("id", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        S.append_batch(bad, path, 1, partition_cols=["d"], date_col="d")
    assert S.read(spark, path).count() == 10
    rows(spark, 10, 15).write.mode("overwrite").partitionBy("d").parquet(f"{path}/batch=0-00000001")  # written, never published
    assert S.read(spark, path).count() == 10
    put(spark, path, 1, 10, 30)
    assert S.read(spark, path).count() == 30


def test_empty_batches_advance_the_mark_only(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, 0, 0, 0)
    assert S.read(spark, path, rows(spark, 0, 0).schema).count() == 0
    put(spark, path, 1, 0, 5)
    assert [p.name for p in S.added_since(spark, path, 0)] == ["0-00000001"]


def test_the_log_tells_new_files_and_months(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, 0, 0, 40)
    version = put(spark, path, 1, 40, 70, days=30)
    put(spark, path, 2, 31, 40)
    new = S.added_since(spark, path, version)
    assert [(p.name, p.rows, p.months) for p in new] == [("0-00000002", 9, ("2024-02",))]
    assert all("batch=0-00000002" in f for f in S.read_pieces(spark, path, new).inputFiles())


def test_compaction_bounds_files_and_keeps_rows(spark, tmp_path):
    path, total = str(tmp_path / "t"), 0
    for k in range(12):
        put(spark, path, k, total, total + 60)
        total += 60
        if k % 2:
            S.compact_dates(spark, path, (date(2024, 1, 10) + timedelta(days=2 * k)).isoformat(), "d", ["id"], most_compacted=3)
    S.compact_dates(spark, path, "2024-01-31", "d", ["id"], most_compacted=3)
    table = S.read(spark, path)
    assert table.count() == total and table.select("id").distinct().count() == total
    closed = table.filter("d <= DATE'2024-01-31'").select("d", F.input_file_name().alias("file")).distinct().groupBy("d").count()
    assert closed.agg(F.max("count")).first()[0] <= 4
    assert {p.name for p in S.added_since(spark, path, 0)} == {f"0-{k:08d}" for k in range(12)}  # compaction changes no consumer's log
    assert S.compact_dates(spark, path, "2024-01-31", "d") == S.latest_version(spark, path)  # nothing left to do
    last = S.snapshot(spark, path)[0]
    old = S.read(spark, path, version=1)
    assert old.count() == 60 and last > 12


def test_compaction_keeps_undated_rows_and_clusters(spark, tmp_path):
    path = str(tmp_path / "t")
    some = rows(spark, 0, 50).withColumn("d", F.when(F.col("id") < 45, F.col("d")))
    S.append_batch(some, path, 0, partition_cols=["d"], date_col="d")
    S.compact_dates(spark, path, "2024-12-31", "d", ["id"])
    assert S.read(spark, path).filter("d IS NULL").count() == 5 and S.read(spark, path).count() == 50
    with pytest.raises(ValueError, match="Clustering"):
        put(spark, path, 1, 0, 5)
        S.compact_dates(spark, path, "2025-12-31", "d", ["nope"])


def test_sql_and_batch_writes_know_snapshot_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, 0, 0, 50)
    S.compact_dates(spark, path, "2024-01-20", "d")
    register_paths(spark, {"snap": path})
    assert run_sql(spark, "SELECT count(*) AS n FROM snap").first()["n"] == 50
    with pytest.raises(ValueError, match="written by a stream"):
        write_table(spark.range(1), path)


def test_column_added_by_a_later_batch_is_null_before(spark, tmp_path):
    path = str(tmp_path / "t")
    S.append_batch(spark.range(3), path, 0)
    S.append_batch(spark.range(3, 5).withColumn("x", F.lit("y")), path, 1)
    got = S.read(spark, path, spark.range(0).withColumn("x", F.lit("")).schema)
    assert got.filter("x IS NULL").count() == 3 and got.filter("x = 'y'").count() == 2
