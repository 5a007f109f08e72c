"""Benchmark: preparation steps and the eight report tables at one scale factor.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default
8), BENCH_RUNS (timed runs per query, default 3; one warm-up run first),
BENCH_FACTOR (copies of the input, default 1), BENCH_WORK (folder of the
prepared tables, default the system's temporary folder).

The adapter tables are materialised first (not timed), then every step is
timed as wall-clock seconds, median of the timed runs.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from collabstats.plans.jobs import Prepared, RawInputs, prepare_primary, prepare_reports, prepare_secondary, report_builders  # noqa: E402
from collabstats.session import local_session  # noqa: E402
from collabstats.sources import adapter  # noqa: E402
from collabstats.tables import PRODUCTION_YEAR  # noqa: E402


def _time(fn, runs: int) -> float:
    fn()  # warm-up
    samples = []
    for _ in range(runs):
        t = time.perf_counter()
        fn()
        samples.append(time.perf_counter() - t)
    return round(statistics.median(samples), 3)


def _larger(df: DataFrame, name: str, factor: int) -> DataFrame:
    """`factor` copies of a table, each with users and repositories of its own: the same shape at a larger size."""
    if factor == 1:
        return df
    copies = df.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(factor - 1))).cast("bigint"))
    shift, mark = F.col("_copy") * 10_000_000, F.concat(F.lit("c"), F.col("_copy").cast("string"), F.lit("_"))
    new = {
        "users": {"id": F.col("id") + shift, "login": F.concat(mark, "login")},
        "commits": {"branch": F.concat(mark, "branch"), "authors_id": F.transform("authors_id", lambda a: a + shift)},
        "users_secondary": {"id": F.col("id") + shift, "login": F.concat(mark, "login")},
        "commits_secondary": {"userid": F.col("userid") + shift, "repoid": F.concat(mark, "repoid")},
    }[name]
    return copies.withColumns(new).drop("_copy")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None

    spark = local_session(cpus, shuffle_partitions=cpus)
    work = tempfile.mkdtemp(prefix="collabstats-bench-", dir=os.environ.get("BENCH_WORK", tempfile.gettempdir()))

    factor = int(os.environ.get("BENCH_FACTOR", "1"))
    # Adapter tables, materialised once (not timed).
    raw_root = f"{work}/raw"
    for name, fn in [("users", adapter.raw_users), ("commits", adapter.raw_commits),
                     ("users_secondary", adapter.raw_users_secondary),
                     ("commits_secondary", adapter.raw_commits_secondary)]:
        _larger(fn(spark, sf_dir), name, factor).write.mode("overwrite").parquet(f"{raw_root}/{name}")
    raw = RawInputs(*(spark.read.parquet(f"{raw_root}/{n}")
                      for n in ("users", "commits", "users_secondary", "commits_secondary")))

    timings: dict[str, float] = {}
    # Production default: plain Parquet (shuffled joins, AQE skew splitting).  BENCH_BUCKETS=n
    # times the bucketed layout instead.
    buckets = int(os.environ.get("BENCH_BUCKETS", "0")) or None
    prepared = Prepared(f"{work}/prepared", buckets=buckets)
    steps: dict[str, Prepared] = {}
    timings["prepare_primary"] = _time(lambda: steps.update(a=prepare_primary(spark, raw, prepared)), runs)
    timings["prepare_secondary"] = _time(lambda: steps.update(b=prepare_secondary(spark, raw, steps["a"])), runs)
    timings["prepare_reports"] = _time(lambda: steps.update(c=prepare_reports(spark, steps["b"], PRODUCTION_YEAR)), runs)
    prepared = steps["c"]

    for name, build in report_builders(spark, prepared, PRODUCTION_YEAR).items():
        # Build (plan) and run the report each time, so nothing is cached between runs.
        timings[name] = _time(lambda b=build: b().collect(), runs)

    print(json.dumps({
        "metric": "total_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": sf,
        "cpus": cpus,
        "runs": runs,
        "buckets": buckets,
        "factor": factor,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
