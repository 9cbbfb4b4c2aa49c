"""Write the physical plan trees of the main registered queries to PLANS.md.

    python tools/explain_plans.py [sf_dir]

Plans are taken with broadcast joins disabled, to show the shapes a large
cluster gets when no side is small enough to broadcast.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.plans.registry import QUERIES  # noqa: E402
from strata.session import build_session  # noqa: E402

NAMES = ["silver_orders", "gold_daily_sales", "gold_customer_insights", "gold_real_time_metrics",
         "ml_feature_table", "features_customer_behavior_joined", "top_products", "gen_activity",
         "expect_or_fail_silver"]


def tree(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    keep = []
    for line in text.splitlines():
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"\[plan_id=\d+\]", "", line)
        keep.append(line[:160])
    return "\n".join(keep)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", extra={"spark.sql.autoBroadcastJoinThreshold": "-1",
                                             "spark.sql.adaptive.enabled": "false"})
    out = ["# Physical plans (broadcast disabled, AQE off, so the static large-scale shape shows)", "",
           f"Generated by `python tools/explain_plans.py {sf}`.", ""]
    for n in NAMES:
        df = QUERIES[n](spark, sf)
        p = tree(df)
        out += [f"## {n}", "", f"Exchanges: {p.count('Exchange ')}", "", "```", p, "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
