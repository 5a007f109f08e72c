"""Named derivations from the test tables, shared by the driver entry points,
the tests and the benchmark.

Each function takes (spark, sf_dir) and returns a lazy DataFrame whose work
grows with the input tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collabstats.operators.clean import attach_agency, classify_agency, clean_users
from collabstats.operators.commits import (
    commit_rows,
    commit_years,
    first_commits,
    first_commits_secondary,
    first_year,
    with_branch_year,
    yearly_commits,
    years_to_rows,
)
from collabstats.operators.fractional import countries_of_cube, country_cube
from collabstats.operators.merge import merge_commits, merge_users, new_commits
from collabstats.operators.skew import tasks_for
from collabstats.plans.incremental import add_year
from collabstats.plans.jobs import Prepared, RawInputs, prepare_primary, report_builders
from collabstats.schemas import ORG_COLUMNS_SECONDARY, USERS_CLEAN_SCHEMA
from collabstats.session import settings
from collabstats.sources import adapter
from collabstats.sources.parquet import preview, scan, scan_glob, scan_year_folders
from collabstats.sources.sinks import write_by_year, write_parquet, write_report

# The adapter shifts commits into 2009-2015; 2014 is the single production year.
PRODUCTION_YEAR = 2014


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_users(adapter.raw_users(spark, sf_dir))


def agency_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_agency(adapter.raw_users_secondary(spark, sf_dir))


def users_gov_secondary(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = adapter.raw_users_secondary(spark, sf_dir)
    return attach_agency(raw, classify_agency(raw))


def users_secondary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_users(users_gov_secondary(spark, sf_dir), ORG_COLUMNS_SECONDARY)


def commits_yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return yearly_commits(adapter.raw_commits(spark, sf_dir))


def commits_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Same result as first_commits(commits_yearly(..)) with one shuffle fewer.
    return first_commits(commit_rows(adapter.raw_commits(spark, sf_dir)))


def commits_first_secondary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_commits_secondary(adapter.raw_commits_secondary(spark, sf_dir))


def users_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_users(users(spark, sf_dir), users_secondary(spark, sf_dir))


def commits_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_commits(commits_first(spark, sf_dir), commits_first_secondary(spark, sf_dir))


def commits_merged_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C8 in steps that are written, as `plans.jobs` prepares it: first participation, which the merge reads twice, and the
    pairs that the second source adds.  A report's join and its count of hot authors read both tables."""
    first = written(commits_first(spark, sf_dir))
    return first.unionByName(written(new_commits(first, commits_first_secondary(spark, sf_dir))))


def commits_yearly_from_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return years_to_rows(commit_years(adapter.raw_commits(spark, sf_dir)))


def commits_first_from_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_year(commit_years(adapter.raw_commits(spark, sf_dir)))


def commits_branch_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = written(commits_first_from_mask(spark, sf_dir))
    return with_branch_year(first, tasks=tasks_for(first))


def first_year_report(report: Callable[..., DataFrame], commits: DataFrame, users: DataFrame) -> DataFrame:
    """A first-year report (C16, C17) over the written commits, whose rows tell its tasks; one of many tasks sums by split."""
    table = written(commits)
    tasks = tasks_for(table)
    return report(table, users, commits_distinct=True, tasks=tasks, write=written if tasks else None)


def commits_first_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C5 from a state without 2011 and 2015, to which these years are added one by one."""
    commits = written(adapter.raw_commits(spark, sf_dir))   # the archive, of which three loads read their years
    of = lambda *years: commits.where(F.year("committedat").isin(*years))
    start = RawInputs(adapter.raw_users(spark, sf_dir), of(2009, 2010, 2012, 2013, 2014))
    state = prepare_primary(spark, start, shared_folder(spark), incremental=True)
    for year in (2015, 2011):
        state = add_year(spark, state, of(year), year)
    return state.read(spark, "commits_first").join(state.read(spark, "branch_years"), "branch")


def fractional_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C12 over bucketed tables whose hot authors - here those of 50 branches or more - lie apart."""
    raw = RawInputs(adapter.raw_users(spark, sf_dir), adapter.raw_commits(spark, sf_dir))
    prepared = prepare_primary(spark, raw, Prepared(shared_folder(spark), buckets=8), hot_rows=50)
    return report_builders(spark, prepared, PRODUCTION_YEAR)["fractional_by_country"]()


def countries_from_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C17 from its written sums, by a threshold instead of a ranking of all countries."""
    return countries_of_cube(written(first_year_report(country_cube, commits_first(spark, sf_dir), users(spark, sf_dir))))


def shared_folder(spark: SparkSession) -> str:
    """A new folder for round trips, under the folder that the session shares: `spark.checkpoint.dir`, or the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/collabstats-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """`df` as a table in the shared folder: what reads it several times - a join, the count of its hot keys - computes it once.
    The shuffle files of that computation go when it is written; else they stay until the driver collects its garbage."""
    with settings(df.sparkSession, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        return scan(df.sparkSession, write_parquet(df, shared_folder(df.sparkSession)))


def parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4, S1."""
    return scan(spark, write_parquet(users(spark, sf_dir), shared_folder(spark)))


def glob_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 into two folders, S2 over both."""
    root, table = shared_folder(spark), users(spark, sf_dir)
    odd = table["id"] % 2 == 1
    write_parquet(table.where(odd), f"{root}/odd")
    write_parquet(table.where(~odd), f"{root}/even")
    return scan_glob(spark, root)


def year_folder_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year folders `<year>.0` written one by one, S3 over some of them (2008 does not exist)."""
    root, table = shared_folder(spark), written(commits_yearly(spark, sf_dir))
    for year in range(2009, 2016):
        write_parquet(table.where(table["commit_year"] == year), f"{root}/{year}.0")
    return scan_year_folders(spark, root, [2008, *range(2010, 2015)])


def drifting_years_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 over year folders whose columns differ: narrow ids in even years, no branch in 2010, a further column from 2012
    that is narrow in 2012 only."""
    root, table = shared_folder(spark), written(commits_yearly(spark, sf_dir))
    for year in range(2009, 2016):
        rows = table.where(table["commit_year"] == year)
        if year % 2 == 0:
            rows = rows.withColumn("author_id", F.col("author_id").cast("int"))
        if year == 2010:
            rows = rows.drop("branch")
        if year >= 2012:
            rows = rows.withColumn("weight", (F.col("author_id") % 7).cast("smallint" if year == 2012 else "bigint"))
        write_parquet(rows, f"{root}/{year}.0")
    return scan_year_folders(spark, root)


def drifting_glob_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 over folders of which only the second has some columns, and a folder without files."""
    root, table = shared_folder(spark), users(spark, sf_dir)
    odd = table["id"] % 2 == 1
    write_parquet(table.where(odd).select("id", "login"), f"{root}/a")
    write_parquet(table.where(~odd), f"{root}/b")
    return scan_glob(spark, root, expected=USERS_CLEAN_SCHEMA)


def rewritten_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 twice: all years, then 2011 with other rows and 2012 with none; the other years stay."""
    path, table = shared_folder(spark), commits_yearly(spark, sf_dir)
    write_by_year(table, path)
    again = table.where(table["commit_year"] == 2011).withColumn("author_id", -F.col("author_id"))
    write_by_year(again, path, years=[2011, 2012])
    return spark.read.schema("branch string, author_id bigint, commit_year bigint").parquet(path)


def by_year_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 and a scan of its partitioned folders."""
    written = write_by_year(commits_yearly(spark, sf_dir), shared_folder(spark))
    return spark.read.schema("branch string, author_id bigint, commit_year bigint").parquet(written)


def report_round_trip(spark: SparkSession, sf_dir: str, report: DataFrame, headers: dict[str, str]) -> DataFrame:
    """S6 with display headers."""
    return spark.read.parquet(write_report(report, shared_folder(spark), "report", headers, "parquet"))


def users_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 and O5 over an ordered table, so the limit is determined."""
    return preview(users(spark, sf_dir).orderBy("id"), 10)
