"""Command line: generate data, run triggered updates, run ad-hoc SQL.

    python -m strata generate --base /data/dev/raw --orders 2000 --customers 100
    python -m strata update-orders --env dev --base /data/dev/raw --tables /data/dev/tables
    python -m strata update-sample --env dev --base /data/dev/raw --tables /data/dev/tables
    python -m strata update-features --env dev --base /data/dev/raw --tables /data/dev/tables
    python -m strata sql --tables /data/dev/tables "SELECT * FROM gold_daily_sales ORDER BY total_revenue DESC LIMIT 10"
    python -m strata sql --view sales=hdfs:///lake/tables/gold_daily_sales "SELECT count(*) FROM sales"
"""

from __future__ import annotations

import argparse
import glob
import json
import os

from strata.config import get_config
from strata.session import build_session


def _cfg(args):
    cfg = get_config(args.env)
    return cfg.with_overrides(base_path=args.base) if getattr(args, "base", None) else cfg


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="strata")
    p.add_argument("--master", default=os.environ.get("STRATA_MASTER", "local[*]"))
    sub = p.add_subparsers(dest="cmd", required=True)
    g = sub.add_parser("generate", help="write synthetic orders, profiles and activity as JSON")
    g.add_argument("--env", default=None)
    g.add_argument("--base", required=True)
    g.add_argument("--orders", type=int, default=2000)
    g.add_argument("--customers", type=int, default=100)
    g.add_argument("--days", type=int, default=30)
    g.add_argument("--sessions", type=int, default=8)
    g.add_argument("--as-of", default=None)
    for name in ("update-orders", "update-features", "update-sample", "run-batch"):
        u = sub.add_parser(name)
        u.add_argument("--env", default=None)
        u.add_argument("--base", default=None)
        u.add_argument("--tables", required=True)
        u.add_argument("--as-of", default=None)
    q = sub.add_parser("sql", help="run SQL over written tables (each sub-folder is a view)")
    q.add_argument("--tables", default=None, help="local pipeline root: every table folder becomes a view")
    q.add_argument("--view", action="append", default=[], help="name=path, any file system (repeatable)")
    q.add_argument("--limit", type=int, default=20)
    q.add_argument("text")
    args = p.parse_args(argv)

    spark = build_session(args.master, shuffle_partitions=int(os.environ.get("STRATA_SHUFFLE_PARTITIONS", "200")))
    if args.cmd == "generate":
        from strata.sinks.writers import write_json
        from strata.sources import synthetic as G
        cfg = _cfg(args)
        write_json(G.generate_orders(spark, args.orders, args.as_of, args.customers), cfg.orders_source_path)
        write_json(G.generate_customer_profiles(spark, args.customers, args.as_of), cfg.profiles_source_path)
        write_json(G.generate_customer_activity(spark, args.customers, args.as_of, args.days, args.sessions),
                   cfg.activity_source_path)
        print(json.dumps({"orders": cfg.orders_source_path, "profiles": cfg.profiles_source_path,
                          "activity": cfg.activity_source_path}))
    elif args.cmd in ("update-orders", "update-features", "update-sample", "run-batch"):
        from strata.plans import run
        from strata.streaming.runner import StreamLayout
        cfg, lay = _cfg(args), StreamLayout(args.tables)
        reports = []
        if args.cmd == "update-orders":
            reports.append(run.update_orders(spark, cfg, cfg.orders_source_path, lay, args.as_of))
        elif args.cmd == "update-sample":
            reports.append(run.update_sample(spark, cfg, cfg.orders_source_path, lay, args.as_of))
        elif args.cmd == "update-features":
            reports.append(run.update_features(spark, cfg, cfg.activity_source_path, cfg.profiles_source_path,
                                               lay, args.as_of))
        else:
            from strata.sources.readers import bronze_customer_activity, bronze_customer_profiles, bronze_orders
            reports.append(run.run_orders_pipeline(spark, bronze_orders(spark, cfg, stream=False), cfg, lay,
                                                   args.as_of))
            reports.append(run.run_features_pipeline(spark, bronze_customer_activity(spark, cfg, stream=False),
                                                     bronze_customer_profiles(spark, cfg), cfg, lay, args.as_of))
        for r in reports:
            run.record_quality(spark, r, lay)
        print(json.dumps([{"tables": r.tables, "expectations": r.expectations} for r in reports], default=str))
    else:
        from strata.plans.adhoc import register_paths, run_sql
        views = dict(v.split("=", 1) for v in args.view)
        if args.tables:
            root = args.tables.rstrip("/") + "/tables"
            views.update({os.path.basename(d): d for d in glob.glob(root + "/*")
                          if os.path.isdir(d) and not os.path.basename(d).startswith("_")})
        register_paths(spark, views)
        run_sql(spark, args.text).show(args.limit, truncate=False)
    spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
