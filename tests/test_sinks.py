import csv
import glob
import os
import tempfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from collabstats.plans.jobs import RawInputs, prepare_primary, prepare_reports, prepare_secondary, reports, write_reports
from collabstats.sources import adapter
from collabstats.sources.parquet import preview, scan, scan_glob, scan_year_folders, MissingColumnsError, SchemaDriftError
from collabstats.sources.sinks import write_by_year, write_parquet, write_report
from tests.conftest import SF001, YEARLY_DDL, yearly_df

import pytest


def test_write_by_year_and_year_folder_scan(spark):
    root = tempfile.mkdtemp(prefix="collabstats-test-")
    df = yearly_df(spark, [("b1", 1, 2010), ("b2", 2, 2011), ("b3", 3, 2030)])
    write_by_year(df, f"{root}/yearly")
    assert sorted(d for d in os.listdir(f"{root}/yearly") if d.startswith("commit_year=")) == \
        ["commit_year=2010", "commit_year=2011", "commit_year=2030"]
    pruned = scan(spark, f"{root}/yearly").where(F.col("commit_year") == 2011)
    assert "PartitionFilters: [isnotnull(commit_year" in pruned._jdf.queryExecution().executedPlan().toString()
    assert [r.branch for r in pruned.collect()] == ["b2"]
    # other files in the folders are left alone
    # year folders named "<year>.0" as in the raw commit archive
    for y in (2009, 2010, 2024):
        write_parquet(yearly_df(spark, [(f"y{y}", y, y)]), f"{root}/archive/{y}.0")
    with open(f"{root}/archive/2010.0/notes.txt", "w") as fh:
        fh.write("not a table")
    assert sorted(r.branch for r in scan_year_folders(spark, f"{root}/archive").collect()) == ["y2009", "y2010"]
    with pytest.raises(FileNotFoundError):
        scan_year_folders(spark, f"{root}/archive", [1999])
    assert sorted(r.branch for r in scan_glob(spark, f"{root}/archive").collect()) == ["y2009", "y2010", "y2024"]


def _years_at(spark, path):
    return sorted((r.commit_year, r.branch) for r in spark.read.schema(YEARLY_DDL).parquet(path).collect())


def test_rewriting_a_year_leaves_the_others(spark):
    path = tempfile.mkdtemp(prefix="collabstats-test-") + "/yearly"
    write_by_year(yearly_df(spark, [("a", 1, 2010), ("b", 2, 2011), ("c", 3, 2012)]), path)
    write_by_year(yearly_df(spark, [("new", 1, 2011)]), path)
    assert _years_at(spark, path) == [(2010, "a"), (2011, "new"), (2012, "c")]
    write_by_year(yearly_df(spark, [("none left in 2010", 1, 2012)]), path, years=[2010, 2012])
    assert _years_at(spark, path) == [(2011, "new"), (2012, "none left in 2010")]
    write_by_year(yearly_df(spark, []), path, years=[2013])
    write_by_year(yearly_df(spark, [("z", 1, 2009)]), path, whole=True)
    assert _years_at(spark, path) == [(2009, "z")]


def test_a_failed_rewrite_leaves_the_old_years(spark):
    path = tempfile.mkdtemp(prefix="collabstats-test-") + "/yearly"
    old = [("a", 1, 2010), ("b", 2, 2011)]
    write_by_year(yearly_df(spark, old), path)
    broken = yearly_df(spark, [("x", i, 2010) for i in range(100)]).withColumn(
        "branch", F.when(F.col("author_id") == 99, F.raise_error(F.lit("broken row"))).otherwise(F.col("branch")))
    outside = yearly_df(spark, [("x", 1, 2010), ("x", 2, 2011)])
    without = yearly_df(spark, [("x", 1, 2010), ("x", 2, None)])
    for rows, told in ((broken, "broken row"), (outside, "outside 2010..2010: 2011"), (without, "outside 2010..2010: none")):
        with pytest.raises(Exception, match=told):
            write_by_year(rows, path, years=[2010])
        assert _years_at(spark, path) == [(2010, "a"), (2011, "b")]


def test_scans_reconcile_columns_of_years(spark):
    root = tempfile.mkdtemp(prefix="collabstats-test-")
    spark.sql("SELECT 1 AS a, array(1, 2) AS l, CAST(1.5 AS FLOAT) AS f, struct(CAST(1 AS SMALLINT) AS x) AS s").write.parquet(f"{root}/2009.0")
    spark.sql("SELECT 5000000000 AS a, array(6000000000) AS l, 2.5D AS f, 'late' AS note, struct(7000000000 AS x, 'y' AS y) AS s").write.parquet(f"{root}/2010.0")
    spark.sql("SELECT CAST(3 AS SMALLINT) AS a").write.parquet(f"{root}/2011.0")
    spark.sql("SELECT 4L AS a, 'same folder' AS note").write.mode("append").parquet(f"{root}/2011.0")   # one folder, two schemas
    os.makedirs(f"{root}/2012.0")
    for df in (scan_year_folders(spark, root), scan_glob(spark, root)):
        assert dict(df.dtypes) == {"a": "bigint", "l": "array<bigint>", "f": "double", "note": "string", "s": "struct<x:bigint,y:string>"}
        rows = sorted((tuple(r) for r in df.select("a", "l", "f", "note", "s.x").collect()), key=lambda r: r[0])
        assert rows == [(1, [1, 2], 1.5, None, 1), (3, None, None, None, None), (4, None, None, "same folder", None), (5_000_000_000, [6_000_000_000], 2.5, "late", 7_000_000_000)]
    wanted = T.StructType([T.StructField("a", T.LongType()), T.StructField("never", T.StringType())])
    assert scan_glob(spark, root, expected=wanted).columns[:2] == ["a", "never"]
    plan = scan_glob(spark, root).where("a > 4").select("f")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(a,4)" in plan and "ReadSchema: struct<a:bigint,f:double>" in plan   # still one pruned scan


def test_drift_that_cannot_meet_names_a_file(spark):
    root = tempfile.mkdtemp(prefix="collabstats-test-")
    spark.sql("SELECT 1 AS a, 'x' AS b").write.parquet(f"{root}/2009.0")
    spark.sql("SELECT 'y' AS b").write.parquet(f"{root}/2010.0")
    spark.sql("SELECT 2.5D AS a").write.parquet(f"{root}/2011.0")
    with pytest.raises(SchemaDriftError, match=r"column a .*int in .*2009\.0/part.*double in .*2011\.0/part"):
        scan_year_folders(spark, root)
    with pytest.raises(SchemaDriftError, match=r"column b .*bigint in the expected schema; string in .*part"):
        scan_year_folders(spark, root, [2009, 2010], expected=T.StructType([T.StructField("b", T.LongType())]))
    os.makedirs(f"{root}/empty/2009.0")
    with pytest.raises(FileNotFoundError):
        scan_year_folders(spark, f"{root}/empty")
    with pytest.raises(FileNotFoundError):
        scan_glob(spark, f"{root}/empty/2009.0")


def test_footers_are_read_by_few_jobs(spark, monkeypatch):
    from collabstats.sources import parquet

    root = tempfile.mkdtemp(prefix="collabstats-test-")
    for y in range(2009, 2017):
        spark.range(3).selectExpr(f"CAST(id AS {'int' if y < 2013 else 'bigint'}) AS a").write.parquet(f"{root}/{y}.0")
    asked, merged = [], parquet._merged
    monkeypatch.setattr(parquet, "_merged", lambda s, paths: asked.append(len(paths)) or merged(s, paths))
    assert dict(scan_year_folders(spark, root).dtypes) == {"a": "bigint"}
    assert asked == [8, 4, 4]


def test_a_failed_report_leaves_the_old_one(spark):
    root = tempfile.mkdtemp(prefix="collabstats-test-")
    good = spark.createDataFrame([("b", 2, 1), ("a", 1, 0)], "name string, n int, row_order int")
    path = write_report(good, root, "sheet", {"name": "Name"})
    write_report(good, root, "other")
    bad = good.withColumn("n", F.when(F.col("n") == 1, F.raise_error(F.lit("broken report")).cast("int")).otherwise(F.col("n")))
    with pytest.raises(Exception, match="broken report"):
        write_report(bad, root, "sheet", {"name": "Name"})
    read = lambda: [tuple(r) for r in spark.read.option("header", True).csv(path).collect()]
    assert read() == [("a", "1"), ("b", "2")] and sorted(os.listdir(root)) == ["other", "sheet"]
    write_report(good.where("n = 2"), root, "sheet", {"name": "Name"})
    assert read() == [("b", "2")] and sorted(os.listdir(root)) == ["other", "sheet"]


def test_a_report_leaves_the_aggregate_its_tasks(spark):
    """The last aggregation runs in its own tasks: an exchange, not a coalesce, brings its rows to the writing task."""
    plans = []
    listened = spark.range(100_000, numPartitions=6).groupBy((F.col("id") % 5000).alias("k")).count()
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plans.append(listened.repartition(1)._jdf.queryExecution().executedPlan().toString())
        path = write_report(listened, tempfile.mkdtemp(prefix="collabstats-test-"), "sheet", fmt="parquet", order=["k"])
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert plans[0].index("SinglePartition") < plans[0].index("HashAggregate") and "Coalesce" not in plans[0]
    assert len(glob.glob(f"{path}/*.parquet")) == 1 and [r.k for r in spark.read.parquet(path).limit(3).collect()] == [0, 1, 2]


def test_scan_checks_columns(spark):
    with pytest.raises(MissingColumnsError):
        scan(spark, f"{SF001}/nation.parquet", ["n_nationkey", "nope"])
    assert scan(spark, f"{SF001}/nation.parquet", ["n_name"]).columns == ["n_name"]


def test_preview_puts_ids_first(spark):
    df = spark.createDataFrame([("x", 1, 2)], "login string, author_id bigint, id bigint")
    assert preview(df, 5).columns == ["id", "author_id", "login"]


def test_end_to_end_jobs_and_report_sink(spark):
    root = tempfile.mkdtemp(prefix="collabstats-test-")
    raw = RawInputs(adapter.raw_users(spark, SF001), adapter.raw_commits(spark, SF001),
                    adapter.raw_users_secondary(spark, SF001), adapter.raw_commits_secondary(spark, SF001))
    prepared = prepare_secondary(spark, raw, prepare_primary(spark, raw, f"{root}/prepared"))
    tables = reports(spark, prepared, 2014)
    assert set(tables) == {"collab_by_country", "collab_by_country_supp", "codeveloped_pairs",
                           "fractional_by_country", "top_institutions", "sectors_by_year", "countries_by_year",
                           "agency_new_by_year", "agency_totals"}
    written = write_reports(tables, f"{root}/out")
    files = glob.glob(f"{written['agency_totals']}/*.csv")
    assert len(files) == 1
    with open(files[0]) as fh:
        rows = list(csv.reader(fh))
    assert rows[0] == ["Institution", "Number of repositories"]
    assert rows[1][0] == "Federal Total" and rows[-1][0] == "All Other Federal"
    with open(glob.glob(f"{written['codeveloped_pairs']}/*.csv")[0]) as fh:
        counts = [int(r[2]) for r in list(csv.reader(fh))[1:]]
    assert len(counts) > 5 and counts == sorted(counts, reverse=True)
    assert write_report(tables["agency_totals"], None, "skip") is None


def test_production_entry_point(spark):
    from collabstats.__main__ import main

    root = tempfile.mkdtemp(prefix="collabstats-test-")
    commits = adapter.raw_commits(spark, SF001)
    for y in (2009, 2012, 2014):   # an unpacked archive: one folder per year, named "<year>.0"
        commits.where(F.year("committedat") == y).write.parquet(f"{root}/archive/{y}.0")
    adapter.raw_users(spark, SF001).write.parquet(f"{root}/users")
    adapter.raw_users_secondary(spark, SF001).write.parquet(f"{root}/users2")
    adapter.raw_commits_secondary(spark, SF001).write.parquet(f"{root}/commits2")
    from collabstats.session import SCALE_DEFAULTS, SESSION_DEFAULTS

    before = {k: spark.conf.get(k, None) for k in {**SESSION_DEFAULTS, **SCALE_DEFAULTS}}
    try:
        written = main(["--users", f"{root}/users", "--commits", f"{root}/archive", "--users2", f"{root}/users2",
                        "--commits2", f"{root}/commits2", "--prepared", f"{root}/prepared", "--out", f"{root}/out",
                        "--year", "2014"])
    finally:   # the session is shared with other tests: undo the cluster settings main() applied
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(written) == 9 and all(glob.glob(f"{p}/*.csv") for p in written.values())
    years = {r.commit_year for r in scan(spark, f"{root}/prepared/commits_yearly").select("commit_year").distinct().collect()}
    assert years == {2009, 2012, 2014}


def _inputs(spark, second: bool = True) -> RawInputs:
    more = (adapter.raw_users_secondary(spark, SF001), adapter.raw_commits_secondary(spark, SF001)) if second else ()
    return RawInputs(adapter.raw_users(spark, SF001), adapter.raw_commits(spark, SF001), *more)


def test_a_run_without_second_source_ignores_an_older_merge(spark):
    root = tempfile.mkdtemp(prefix="collabstats-test-")
    both = prepare_secondary(spark, _inputs(spark), prepare_primary(spark, _inputs(spark), root))
    with_second = {r.institution: r.n_repositories for r in reports(spark, both, 2014)["agency_totals"].collect()}
    alone = prepare_primary(spark, _inputs(spark, second=False), root)   # the merged folders are still there
    fresh = prepare_primary(spark, _inputs(spark, second=False), tempfile.mkdtemp(prefix="collabstats-test-"))
    got, want = (reports(spark, p, 2014)["agency_totals"].collect() for p in (alone, fresh))
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert {r.institution: r.n_repositories for r in got} != with_second


def test_a_lone_second_source_table_is_an_error():
    from collabstats.__main__ import main

    need = ["--users", "u", "--commits", "c", "--prepared", "p", "--out", "o"]
    for option in ("--users2", "--commits2"):
        with pytest.raises(SystemExit):
            main([*need, option, "x"])


def test_shared_tables_give_the_same_reports(spark):
    prepared = prepare_secondary(spark, _inputs(spark), prepare_primary(spark, _inputs(spark), tempfile.mkdtemp(prefix="collabstats-test-")))
    shared = prepare_reports(spark, prepared, 2014)
    a, b = reports(spark, prepared, 2014), reports(spark, shared, 2014)
    for name in ("collab_by_country", "collab_by_country_supp", "codeveloped_pairs", "agency_new_by_year", "agency_totals"):
        assert sorted(map(str, a[name].collect())) == sorted(map(str, b[name].collect())), name
        assert "Join" not in b[name]._jdf.queryExecution().executedPlan().toString(), name


def test_raw_tables_are_checked_at_the_edge(spark):
    raw = _inputs(spark, second=False)
    with pytest.raises(MissingColumnsError):
        prepare_primary(spark, RawInputs(raw.users.drop("login"), raw.commits), "unused")
    with pytest.raises(TypeError):
        prepare_primary(spark, RawInputs(raw.users, raw.commits.withColumn("committedat", F.lit("2014"))), "unused")


def test_wide_year_ranges_take_the_yearly_table(spark):
    raw = _inputs(spark, second=False)
    wide = prepare_primary(spark, raw, tempfile.mkdtemp(prefix="collabstats-test-"), years=list(range(1950, 2024)))
    usual = prepare_primary(spark, raw, tempfile.mkdtemp(prefix="collabstats-test-"))
    for table in ("commits_yearly", "commits_first"):
        x, y = wide.read(spark, table), usual.read(spark, table).select(*wide.read(spark, table).columns)
        assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0, table
