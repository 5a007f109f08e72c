"""Session configuration and plan-shape regressions."""

import re
import tempfile

from collabstats.operators.commits import yearly_commits
from collabstats.plans.jobs import RawInputs, prepare_primary, report_builders
from collabstats.session import SCALE_DEFAULTS, configure
from collabstats.sources import adapter
from tests.conftest import SF001


def test_configure_keeps_user_settings(spark):
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "12345")
    try:
        applied = configure(spark)
        assert key not in applied and spark.conf.get(key) == "12345"
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)
        for k in SCALE_DEFAULTS:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_year_range_reaches_the_parquet_scan(spark):
    root = tempfile.mkdtemp(prefix="collabstats-test-")
    adapter.raw_commits(spark, SF001).write.parquet(f"{root}/raw")
    plan = yearly_commits(spark.read.parquet(f"{root}/raw"))._jdf.queryExecution().executedPlan().toString()
    pushed = re.search(r"PushedFilters: \[([^\]]*)", plan).group(1)
    assert "GreaterThanOrEqual(committedat" in pushed and "LessThan(committedat" in pushed


def test_reports_join_commits_and_users_once(spark):
    """At scale (no broadcast): every report has exactly one commits x users join;
    the only other scan is the hot-key count, which reads the author column only."""
    root = tempfile.mkdtemp(prefix="collabstats-test-")
    prepared = prepare_primary(spark, RawInputs(adapter.raw_users(spark, SF001), adapter.raw_commits(spark, SF001)), root)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, build in report_builders(spark, prepared, 2014).items():
            plan = build()._jdf.queryExecution().executedPlan().toString()
            assert plan.count("SortMergeJoin") == 1, name
            scans = [line for line in plan.splitlines() if "FileScan" in line]
            hot = ("ReadSchema: struct<author_id:bigint>", "ReadSchema: struct<author_id:bigint,salts:int>")
            extra = [line for line in scans if not any(h in line for h in hot)]
            assert len(extra) == 2, name    # the join's two inputs; the rest read the hot-author set
            assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_bucketed_preparation_same_results_and_no_join_shuffle(spark):
    from collabstats.plans.jobs import Prepared, prepare_secondary

    raw = RawInputs(adapter.raw_users(spark, SF001), adapter.raw_commits(spark, SF001),
                    adapter.raw_users_secondary(spark, SF001), adapter.raw_commits_secondary(spark, SF001))
    plain = prepare_secondary(spark, raw, prepare_primary(spark, raw, tempfile.mkdtemp(prefix="collabstats-test-")))
    bucketed = prepare_secondary(spark, raw, prepare_primary(
        spark, raw, Prepared(tempfile.mkdtemp(prefix="collabstats-test-"), buckets=4)))
    a, b = report_builders(spark, plain, 2014), report_builders(spark, bucketed, 2014)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in a:
            x, y = a[name](), b[name]()
            assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0, name
            lines = y._jdf.queryExecution().executedPlan().toString().splitlines()
            j = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
            assert not any("Exchange hashpartitioning" in line for line in lines[j + 1:]), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_prepared_hot_authors_are_salted(spark, monkeypatch):
    """With a low threshold, preparation records hot authors and the reports
    salt them; results equal the plain-join results."""
    from collabstats.operators import skew
    from collabstats.plans.jobs import Prepared

    raw = RawInputs(adapter.raw_users(spark, SF001), adapter.raw_commits(spark, SF001))
    plain = Prepared(tempfile.mkdtemp(prefix="collabstats-test-"), buckets=2)   # plain joins
    prepare_primary(spark, raw, plain)
    monkeypatch.setattr(skew, "HOT_ROWS", 4)
    salted = prepare_primary(spark, raw, tempfile.mkdtemp(prefix="collabstats-test-"))
    assert salted.read(spark, "hot_authors").count() > 10
    a, b = report_builders(spark, plain, 2014), report_builders(spark, salted, 2014)
    most = salted.read(spark, "commits_first").groupBy("author_id").count().agg({"count": "max"}).first()[0]
    assert salted.read(spark, "hot_authors").agg({"salts": "max"}).first()[0] == max(2, -(-most // 4))   # no ceiling
    for name in ("fractional_by_country", "sectors_by_year", "collab_by_country", "top_institutions"):
        x, y = a[name](), b[name]()
        assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0, name
        assert "_salt" in y._jdf.queryExecution().executedPlan().toString(), name


def test_merged_commits_have_hot_authors_of_their_own(spark, monkeypatch):
    from collabstats.operators import skew
    from collabstats.plans.jobs import prepare_secondary

    monkeypatch.setattr(skew, "HOT_ROWS", 50)
    raw = RawInputs(adapter.raw_users(spark, SF001), adapter.raw_commits(spark, SF001),
                    adapter.raw_users_secondary(spark, SF001), adapter.raw_commits_secondary(spark, SF001))
    prepared = prepare_secondary(spark, raw, prepare_primary(spark, raw, tempfile.mkdtemp(prefix="collabstats-test-")))
    first, merged = (prepared.read(spark, t) for t in ("hot_authors", "hot_authors_merged"))
    assert merged.join(first, "author_id", "left_anti").count() > 0
    plan = report_builders(spark, prepared, 2014)["agency_totals"]()._jdf.queryExecution().executedPlan().toString()
    assert "hot_authors_merged" in plan and "_salt" in plan


def test_hot_key_set_is_bounded(spark, monkeypatch):
    from collabstats.operators import skew

    monkeypatch.setattr(skew, "HOT_KEYS", 3)
    rows = spark.range(1000).selectExpr("id % 10 as k", "id")
    assert [r.salts for r in skew.hot_keys(rows, "k", 10).collect()] == [10, 10, 10]


def test_a_bucketed_table_read_as_files_is_salted(spark):
    from collabstats.plans.jobs import Prepared

    raw = RawInputs(adapter.raw_users(spark, SF001), adapter.raw_commits(spark, SF001))
    prepared = prepare_primary(spark, raw, Prepared(tempfile.mkdtemp(prefix="collabstats-test-"), buckets=2))
    for name in ("users_clean", "commits_yearly", "commits_first"):
        spark.sql(f"DROP TABLE {prepared.table(name)}")   # as in a new session; external tables keep their files
    plan = report_builders(spark, prepared, 2014)["fractional_by_country"]()._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan


def test_merge_is_one_two_key_anti_join_without_null_keys(spark):
    from collabstats.operators.merge import merge_commits

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = spark.createDataFrame([(1, "x", 2010), (None, "x", 2010)], "author_id bigint, branch string, min_commit_year bigint")
        b = spark.createDataFrame([(1, "x", 2011), (1, "y", 2011), (None, "x", 2011), (2, None, 2012)], a.schema)
        merged = merge_commits(a, b)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 1 and "isnotnull(author_id" in plan
        assert sorted(map(str, merged.collect())) == sorted(map(str, [*a.collect(), *b.collect()[1:]]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_null_logins_stay_out_of_the_join(spark):
    from collabstats.operators.clean import attach_agency

    users = spark.createDataFrame([("a", 1), (None, 1), (None, 1), ("b", 0)], "login string, government int")
    classes = spark.createDataFrame([("a", "X", True), (None, "Y", True)], "login string, new_agencies string, org_in_agency boolean")
    out = attach_agency(users, classes)
    assert sorted(map(str, (tuple(r) for r in out.collect()))) == sorted(map(str, [("a", 1, "X", True), (None, 1, None, None), (None, 1, None, None)]))
