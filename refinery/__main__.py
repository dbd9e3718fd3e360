"""Command line: run the layers on the session the cluster provides.

    python -m refinery init     --warehouse ROOT [--prefix P]
    python -m refinery run      --landing DIR --warehouse ROOT [--prefix P] [--as-of YYYY-MM-DD]
                                [--customer-buckets N] [--fact-by-month] [--salt-customers N]
                                [--keep-keys] [--checks FILE] [--only-if-passed]
    python -m refinery bronze   --landing DIR [--prefix P]
    python -m refinery silver   [--prefix P] [--as-of YYYY-MM-DD]
    python -m refinery gold     [--prefix P]
    python -m refinery validate [--prefix P] [--out PATH] [--checks FILE]
    python -m refinery reset    [--prefix P] [--dry-run]
    python -m refinery stream   --landing DIR --warehouse ROOT [--as-of YYYY-MM-DD]
    python -m refinery land-fixtures --tables SF_DIR --landing DIR

``run`` publishes the tables of all layers together at its end; with
``--only-if-passed`` only if no check fails.  ``validate`` prints the report and
exits non-zero when a check fails (warnings do not fail).  ``--checks`` names a
JSON file with a list of further checks (``plans.checks.from_dicts``).  ``stream`` loads only files that arrived since its
last run into silver folders under ``ROOT/incremental`` (Structured Streaming,
availableNow).  ``land-fixtures`` writes the six test extracts as CSV to a
landing folder, for trying the layers on the test tables.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from refinery.session import DEFAULT_CONF, scratch_scope


def _session() -> SparkSession:
    """The cluster's session, with this library's settings where it has none."""
    from pyspark import SparkConf

    given, builder = SparkConf(), SparkSession.builder.appName("refinery")
    for key, value in DEFAULT_CONF.items():
        if not given.contains(key):
            builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="refinery", description=__doc__,
                                 formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("command", choices=["init", "run", "bronze", "silver", "gold", "validate", "reset",
                                        "stream", "land-fixtures"])
    ap.add_argument("--landing")
    ap.add_argument("--warehouse")
    ap.add_argument("--prefix", default="")
    ap.add_argument("--as-of", dest="as_of")
    ap.add_argument("--dry-run", action="store_true")
    ap.add_argument("--out")
    ap.add_argument("--tables")
    ap.add_argument("--customer-buckets", dest="customer_buckets", type=int,
                    help="bucket silver sales and the customer dimension on customer_id")
    ap.add_argument("--fact-by-month", dest="fact_by_month", action="store_true",
                    help="write the fact partitioned by order month")
    ap.add_argument("--salt-customers", dest="salt_customers", type=int,
                    help="salt the fact's customer join for hot customers over N sub-keys")
    ap.add_argument("--keep-keys", dest="keep_keys", action="store_true",
                    help="keep the surrogate keys that known dimension rows have")
    ap.add_argument("--checks", help="JSON file with checks to add to the report")
    ap.add_argument("--only-if-passed", dest="only_if_passed", action="store_true",
                    help="publish a run's tables only if no check fails")
    a = ap.parse_args(argv)

    spark = _session()
    with scratch_scope(spark):               # what the step writes besides its tables goes with it
        return _run(spark, a)


def _run(spark: SparkSession, a: argparse.Namespace) -> int:
    from refinery.plans import checks, layers, quality
    from refinery.sources import files
    from refinery.sources.fixtures import bronze_inputs

    names = layers.Layers.with_prefix(a.prefix, a.customer_buckets, a.fact_by_month, a.salt_customers, a.keep_keys)
    if a.command == "init":
        layers.create_layers(spark, names, a.warehouse)
    elif a.command == "bronze":
        layers.run_bronze(spark, a.landing, names)
    elif a.command == "silver":
        layers.run_silver(spark, names, a.as_of)
    elif a.command == "gold":
        layers.run_gold(spark, names)
    elif a.command in ("run", "validate"):
        wanted = list(quality.CHECKS)
        if a.checks:
            with open(a.checks, encoding="utf-8") as f:
                wanted += checks.from_dicts(json.load(f))
        try:
            report = (layers.run_all(spark, a.landing, names, a.warehouse, a.as_of, wanted, a.only_if_passed) if a.command == "run"
                      else layers.report(spark, names, wanted))
        except layers.ChecksFailed as failed:
            report = failed.report
            print("nothing published: a check failed")
        rows = report.orderBy("check_id").collect()        # one row per check: the report itself
        for r in rows:
            print(f"{r.status:5} {r.check_id:3} {r.check_name:58} {r.value}" + (f"  {r.about}" if r.status != "pass" else ""))
        counts = {s: sum(1 for r in rows if r.status == s) for s in ("pass", "warn", "fail")}
        print(f"{counts['pass']}/{len(rows)} passed, {counts['warn']} warnings, {counts['fail']} failed")
        if a.out:
            report.write.mode("overwrite").parquet(a.out)
        return 1 if counts["fail"] else 0
    elif a.command == "reset":
        for stmt in files.drop_layer_schemas(spark, dry_run=a.dry_run, prefix=a.prefix):
            print(("[dry run] " if a.dry_run else "") + stmt)
    elif a.command == "stream":
        from refinery.streaming import run_incremental_all
        for table, folder in run_incremental_all(spark, a.landing, f"{a.warehouse.rstrip('/')}/incremental",
                                                 a.as_of).items():
            print(table, folder)
    elif a.command == "land-fixtures":
        files.land_sources(bronze_inputs(spark, a.tables), a.landing)
    return 0


if __name__ == "__main__":
    sys.exit(main())
