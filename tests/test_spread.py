"""Work that one key, login or list could put into a single task."""

import random
import re
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from collabstats.operators import institutions, skew
from collabstats.operators.clean import attach_agency, repeated
from collabstats.operators.collab import PAIR_BLOCK, pairs_of_branches
from collabstats.operators.institutions import new_repos_by_agency_year
from tests.conftest import first_df, users_df


@pytest.fixture()
def fixed_partitions(spark):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", old)


def test_a_login_hot_on_both_sides_is_spread(spark, monkeypatch, fixed_partitions):
    monkeypatch.setattr(skew, "HOT_ROWS", 20)
    rng = random.Random(2)
    users = spark.createDataFrame([("hot" if i % 3 == 0 else f"u{rng.randrange(60)}" if i % 7 else None, i, int(i % 5 != 0)) for i in range(300)],
                                  "login string, id bigint, government int")
    classes = spark.createDataFrame([("hot" if i % 3 == 0 else f"u{rng.randrange(60)}", rng.choice(["X", "Y", None]), True) for i in range(90)],
                                    "login string, new_agencies string, org_in_agency boolean")
    got = attach_agency(users, classes)
    want = users.where("government = 1").join(classes, "login", "left").select("login", "id", "government", "new_agencies", "org_in_agency")
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert "_salt" in got._jdf.queryExecution().executedPlan().toString()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tasks = attach_agency(users, classes).where("login = 'hot'").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    total = sum(r["count"] for r in tasks)
    assert len(tasks) >= 3 and max(r["count"] for r in tasks) < 0.7 * total


def test_rows_repeated_in_blocks(spark):
    df = spark.createDataFrame([("a", 1), ("b", 7), ("c", 8), ("d", 30)], "k string, n bigint")
    assert {r.k: r["count"] for r in repeated(df, F.col("n"), block=8).groupBy("k").count().collect()} == {"a": 1, "b": 7, "c": 8, "d": 30}


def test_pairs_of_short_and_long_lists(spark):
    rng = random.Random(3)
    names = [f"n{i:04d}" for i in range(3 * PAIR_BLOCK + 5)]
    branches = {f"b{b}": set(rng.sample(names, rng.choice([1, 2, 5, PAIR_BLOCK - 1, PAIR_BLOCK, PAIR_BLOCK + 1, 2 * PAIR_BLOCK]))) for b in range(12)}
    branches["all"] = set(names)
    branches["copy"] = branches["b1"]
    rows = [(b, c, 2) for b, cs in branches.items() for c in [*cs, None, "Missing Country"]] + [("alone", "n0000", 1), ("alone", "n0001", 1)]
    got = pairs_of_branches(spark.createDataFrame(rows, "branch string, country string, n_users bigint"))
    want = Counter(p for cs in branches.values() for p in combinations(sorted(cs), 2))
    assert {(r.country_1, r.country_2): r.co_developed_repositories for r in got.collect()} == want


def test_pairs_of_a_very_long_list_are_spread(spark, fixed_partitions):
    """2,000 names make two million pairs; before they are counted they lie in all tasks, none with the bulk."""
    bc = spark.range(2000).select(F.lit("b").alias("branch"), F.format_string("name %05d", "id").alias("country"), F.lit(2).cast("bigint").alias("n_users"))
    counted = pairs_of_branches(bc)
    assert counted.count() == 2000 * 1999 // 2
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate explode") == 4 and "REPARTITION_BY_NUM" in plan


def test_agency_years_run_the_join_once(spark):
    """One job of the whole plan, whose few rows give the columns and the report."""
    users = users_df(spark, [(i, "United States", ["Department of Energy", "Elsewhere", ""][i % 3], "government") for i in range(30)])
    first = first_df(spark, [(f"b{i % 17}", i % 33, 2009 + i % 20) for i in range(200)] + [("late", 0, 2028)]).distinct()
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("agency-years", "build")
    try:
        report = new_repos_by_agency_year(first, users)
        jobs = len(tracker.getJobIdsForGroup("agency-years"))
        rows = report.collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert 0 < jobs and not re.search(r"(Hash|Merge|Loop)Join", plan)
    assert {r.institution for r in rows} == {"Federal Total", "Department of Energy", "All Other Federal"}
    assert [c for c in report.columns if c.isdigit()][-1] > "2023"       # a later year that occurs is a column
    fixed = new_repos_by_agency_year(first, users, years=list(range(2009, 2029)))
    assert sorted(map(str, fixed.select(*report.columns).collect())) == sorted(map(str, rows))


def test_long_form_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(institutions, "LONG_ROWS", 3)
    counts = spark.createDataFrame([("a", 2000 + i, 1) for i in range(4)], "institution string, first_year bigint, n bigint")
    with pytest.raises(ValueError, match="name the years"):
        institutions.collected(counts)
    assert institutions.collected(counts.limit(3)).count() == 3
