"""Write the physical plans of the headline queries to docs/PLANS.md.

usage: python scripts/explain_plans.py [sf_dir]
Plans are taken over the orders table materialized as parquet (as bench.py
does); they are the adaptive plans as submitted (AQE may re-plan at run time).
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from ordersight.operators.ordering import ordered_limit  # noqa: E402
from ordersight.plans import registry as R  # noqa: E402
from ordersight.plans.batch import report_pack  # noqa: E402
from ordersight.session import build_session, scratch_path  # noqa: E402
from ordersight.sources.parquet import read_orders  # noqa: E402
from ordersight.sources.star import orders_from_star  # noqa: E402

NAMES = (
    "orders_by_status", "kpis", "amount_histogram", "filter_all", "top_states",
    "monthly_trend", "filter_options", "status_share",
)


def plan_text(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]")
    spark.conf.set("spark.sql.maxMetadataStringLength", "120")
    path = scratch_path(spark, "plans")
    orders_from_star(spark, sf_dir).write.parquet(path)
    orders = read_orders(spark, path)
    parts = [
        "# Physical plans",
        "",
        f"Generated by `scripts/explain_plans.py` over the orders table built from `{sf_dir}`",
        "and written as parquet. These are the adaptive plans as submitted; at run time AQE may\nstill coalesce shuffle partitions or turn a sort-merge join into a broadcast join.",
        "",
    ]
    items = [(n, R.ORDER_QUERIES[n](orders)) for n in NAMES]
    items.append(("report_pack[orders_by_status] (reads the checkpointed GROUPING SETS aggregate)",
                  report_pack(orders)["orders_by_status"]))
    items.append(("ordered_limit (n=100)", ordered_limit(orders, 100)))
    star = orders_from_star(spark, sf_dir).select("order_id", "final_amount")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    items.append(("star fixture joins with broadcasts disabled (the 100 TB shape)", star))
    for name, df in items:
        parts += [f"## {name}", "", "```", plan_text(df).rstrip(), "```", ""]
    with open(os.path.join(ROOT, "docs", "PLANS.md"), "w") as fh:
        fh.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main()
