"""Plans of the mart's queries, as PLANS.md.

usage: python tools/plan_summary.py [sf_dir] > PLANS.md
Counts exchanges, broadcasts and joins in the plan of each query before it runs, and the
shuffles that adaptive execution really ran (equal ones run once), and lists what the scans read.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from martlet.plans.catalog import queries  # noqa: E402
from martlet.session import build_session  # noqa: E402

NAMES = ["silver_order_items_dedup", "silver_orders", "dim_products_kit_cost", "fact_item_details", "fact_orders",
         "fact_channel_performance", "fact_product_performance", "fact_component_demand", "weekly_distinct_orders",
         "item_details_at_cost", "product_performance_at_cost", "demand_forecast", "upsert_indexed", "upsert_null_safe",
         "abc_curve", "landed_orders"]
SHUFFLE = r"Exchange (?:hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)"

INTRO = """# Plans

Written by `tools/plan_summary.py {sf}`; every registered query is one lazy plan from the driver's tables.

- **One exchange of the lines by order.** Records collapse to plain columns, so where orders are
  too large to broadcast the exchange of the join of lines with their headers serves W1, M16's join
  with orders and M17's sums (`tests/test_landing_sets.py` checks it).  At small scale the header side is
  broadcast, and W1 brings its own exchange, cut to one row per order and product before it.
- **Products are a broadcast side only where their rows were counted** (`operators/lookup.py`, 500,000
  at most); beyond that lines meet them by an exchange on the product.
- **M17 takes M16's line costs without M16's join with orders.**
- **Landed text is parsed once per line**: the fields come out of a generator.
- **Partial aggregates** run before every aggregate shuffle; W1 and top-k windows have a partial group limit.

"planned" counts the shuffles of the plan before it runs; "run" those that adaptive execution ran,
where an equal exchange is run once and reused.

| query | planned | run | reused | broadcasts | sort-merge joins | from_json |
| --- | --- | --- | --- | --- | --- | --- |"""


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(master="local[8]", shuffle_partitions=8)
    print(INTRO.format(sf=sf_dir))
    scans = []
    for name in NAMES:
        execution = queries()[name](spark, sf_dir)._jdf.queryExecution()
        before = execution.executedPlan().toString()
        parsed = execution.optimizedPlan().toString().count("from_json")
        execution.toRdd().count()
        after = execution.executedPlan().toString().split("== Initial Plan ==")[0]
        print(f"| {name} | {len(re.findall(SHUFFLE, before))} | {len(re.findall(SHUFFLE, after))} | "
              f"{after.count('ReusedExchange')} | {before.count('BroadcastExchange')} | {before.count('SortMergeJoin')} | {parsed} |")
        scans.append((name, sorted(set(re.findall(r"ReadSchema: (struct<[^\n]*>)", before)))))
    print("\n## What the scans read\n")
    for name, read in scans:
        print(f"- **{name}**: " + "; ".join(f"`{s}`" for s in read))


if __name__ == "__main__":
    main()
