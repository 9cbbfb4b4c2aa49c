"""The command line end to end, in its own process (it owns its session)."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(*args):
    env = dict(os.environ, STRATA_SHUFFLE_PARTITIONS="4")
    r = subprocess.run([sys.executable, "-m", "strata", "--master", "local[2]", *args], cwd=ROOT, env=env,
                       capture_output=True, text=True, timeout=600)
    assert r.returncode == 0, r.stderr[-2000:]
    return r.stdout


def test_generate_batch_run_and_sql(tmp_path):
    base, lake = str(tmp_path / "raw"), str(tmp_path / "lake")
    run("generate", "--base", base, "--orders", "200", "--customers", "30", "--days", "10", "--as-of", "2024-02-13")
    out = run("run-batch", "--base", base, "--tables", lake, "--as-of", "2024-02-13")
    assert "gold_ml_feature_table" in out and "failed_valid_order_date" in out
    sql = run("sql", "--tables", lake, "SELECT metric_type FROM gold_real_time_metrics ORDER BY metric_type")
    assert "7_day_rolling" in sql and "daily" in sql
    v = run("sql", "--view", f"p={lake}/tables/gold_features_customer_behavior", "SELECT count(*) AS n FROM p")
    assert "30" in v
    dq = run("sql", "--view", f"dq={lake}/tables/_dq_log", "SELECT count(*) AS n FROM dq WHERE failed_records > 0")
    import re
    assert re.search(r"^\|\s*[1-9][0-9]*\s*\|$", dq, re.M), dq  # some expectation failed rows


def test_triggered_update_command(tmp_path):
    base, lake = str(tmp_path / "raw"), str(tmp_path / "lake")
    run("generate", "--base", base, "--orders", "150", "--customers", "20", "--days", "5", "--as-of", "2024-02-13")
    out = run("update-orders", "--base", base, "--tables", lake, "--as-of", "2024-02-13")
    assert "gold_daily_sales_refresh" in out and '"full": true' in out
    again = run("update-orders", "--base", base, "--tables", lake, "--as-of", "2024-02-13")
    assert '"months": []' in again  # nothing new: no month recomputed
