"""Print the physical plan of every report as a large cluster would plan it.

Broadcast joins are disabled (at 100 TB neither join side fits a broadcast)
and AQE is off so the static plan is shown; the prepared tables are built from
the sf0.01 test tables in a scratch folder.  For each report: the number of
file scans, shuffles (hash exchanges), sort-merge joins, windows, and the
formatted plan.  With --bucketed the prepared id-keyed tables are bucketed
(`Prepared(buckets=8)`), as a production run writes them.
Usage: python tools/plan_summary.py [--full] [--bucketed] [report ...]
"""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from collabstats.plans.jobs import Prepared, RawInputs, prepare_primary, prepare_secondary, report_builders  # noqa: E402
from collabstats.session import local_session  # noqa: E402
from collabstats.sources import adapter  # noqa: E402


def main(argv):
    full = "--full" in argv
    names = [a for a in argv if not a.startswith("--")]
    sf = "/root/testdata/sf0.01"
    spark = local_session(8)
    work = tempfile.mkdtemp(prefix="collabstats-plans-", dir=os.environ.get("PLANS_WORK", tempfile.gettempdir()))
    raw = RawInputs(adapter.raw_users(spark, sf), adapter.raw_commits(spark, sf),
                    adapter.raw_users_secondary(spark, sf), adapter.raw_commits_secondary(spark, sf))
    target = Prepared(work, buckets=8) if "--bucketed" in argv else Prepared(work)
    prepared = prepare_secondary(spark, raw, prepare_primary(spark, raw, target))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    builders = report_builders(spark, prepared, 2014)
    print("| report | scans | shuffles | sort-merge joins | shuffles below the join | windows |")
    print("| --- | --- | --- | --- | --- | --- |")
    plans = {}
    for name in names or builders:
        df = builders[name]()
        plan = df._jdf.queryExecution().executedPlan().toString()
        plans[name] = df
        lines = plan.splitlines()
        j = next((i for i, line in enumerate(lines) if "SortMergeJoin" in line), len(lines))
        below = sum("Exchange hashpartitioning" in line for line in lines[j + 1:])
        print(f"| {name} | {plan.count('FileScan')} | {plan.count('Exchange hashpartitioning')} | "
              f"{plan.count('SortMergeJoin')} | {below} | {plan.count('Window [')} |")
    if full:
        for name, df in plans.items():
            print(f"\n### {name}\n\n```")
            df.explain("formatted")
            print("```")


if __name__ == "__main__":
    main(sys.argv[1:])
