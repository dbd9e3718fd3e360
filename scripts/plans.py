"""Write PLANS.md: the final (post-AQE) physical plan shape of the headline queries.

    python scripts/plans.py [sf_dir]

Each query is run once (to the noop sink) so that AQE's final plan is shown;
the tree is printed with node names only, followed by the scans' pushed
filters and read schemas and a count of exchanges by kind.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from refinery.plans import catalog  # noqa: E402
from refinery.session import build_session  # noqa: E402

from refinery.operators.keys import ranked_partitions  # noqa: E402
from refinery.plans import gold  # noqa: E402

HEADLINE = ["silver_sales", "fact_sales", "fact_sales_current", "fact_sales_salted", "latest_per_key", "dq_report"]


def extra_plans(spark, sf):
    """Stages that are written before the query that uses them."""
    attrs = gold.customer_attributes(catalog.s_customers(spark, sf), catalog.s_erp_customers(spark, sf),
                                     catalog.s_locations(spark, sf))
    yield ("dense_key stage 1 on the customer dimension (written as Parquet)",
           ranked_partitions(attrs, ["customer_id", "customer_number"]))
    yield ("dim_customers: keys from the written stage + offsets",
           gold.dim_customers(catalog.s_customers(spark, sf), catalog.s_erp_customers(spark, sf),
                              catalog.s_locations(spark, sf)))
    yield ("dense_key stage 1 on orders with a unique key (distinct=True, JVM only)",
           ranked_partitions(catalog.orders_by_date(spark, sf), ["o_orderdate", "o_orderkey"], distinct=True))


def final_plan(df) -> str:
    qe = df._jdf.queryExecution()
    qe.toRdd().count()                    # runs this very execution, so AQE's final plan is shown
    return qe.explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def summarize(text: str) -> str:
    tree, _, details = text.partition("\n\n")
    final = tree.split("== Initial Plan ==")[0]
    ids = re.findall(r"Exchange \((\d+)\)", final)
    kinds = []
    for i in ids:
        m = re.search(r"\(" + i + r"\) (?:Broadcast)?Exchange\n(?:.*\n)*?Arguments: (\w+)", details)
        if m:
            kinds.append(m.group(1))
    counts = {k: kinds.count(k) for k in sorted(set(kinds))}
    tree = re.sub(r" \(\d+\)", "", final)
    scans = re.findall(r"PushedFilters: (\[.*?\])\nReadSchema: (struct<.*?>)", details)
    scans = list(dict.fromkeys(scans))
    out = [tree.strip()]
    if scans:
        out.append("\nScans (pushed filters / read schema):")
        out += [f"- {f} {s[:160]}" for f, s in scans]
    counts = {("broadcast" if k == "HashedRelationBroadcastMode" else k): v for k, v in counts.items()}
    out.append(f"\nExchanges in the final plan: {counts or 'none'} "
               "(a SinglePartition exchange carries one partial-aggregate row per task)")
    return "\n".join(out)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", app="refinery-plans")
    parts = ["# Final physical plans of the headline queries",
             f"\nGenerated by `scripts/plans.py` on `{os.path.basename(sf)}` (local[8], AQE on). "
             "Node ids removed; checkpoint paths are per run.\n",
             "The fact is not shuffled when the dimension lookups are broadcast.\n"]
    for name in HEADLINE:
        df = catalog.QUERIES[name](spark, sf)
        parts.append(f"## {name}\n\n```\n{summarize(final_plan(df))}\n```\n")
    for title, df in extra_plans(spark, sf):
        parts.append(f"## {title}\n\n```\n{summarize(final_plan(df))}\n```\n")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(parts))
    spark.stop()


if __name__ == "__main__":
    main()
