"""First-year reports of many tasks: what they shuffle by branch, and what they leave on disk (`credit.credit_sums`)."""

import re
import time

import pytest
from pyspark.sql import functions as F

from collabstats import tables
from collabstats.operators import skew
from collabstats.operators.commits import with_branch_year
from collabstats.operators.credit import credit_cells, credit_sums
from collabstats.operators.expand import expand_country_sector
from collabstats.operators.fractional import country_cube, new_repos_by_country_year, new_repos_by_sector_year
from tests.conftest import SF001, first_df, users_df

DIMS, LABELS = ["country_val", "sector_val"], ["Missing", "Unclassified"]


def _odd_tables(spark):
    """Repeated and NULL ids, blank lists, users of the same lists; NULL branches, authors and years, repeated rows, a branch
    that no user knows, and one that most authors share."""
    countries, sectors = ["A, B", "C", "", "United States", "B, A"], ["Business", "", "Academic, Business"]
    people = [(i, countries[i % 5], "", sectors[i % 3]) for i in range(60)]
    people += [(7, "D", "", "Nonprofit"), (7, "D", "", "Nonprofit"), (None, "C", "", ""), (None, "E", "", "")]
    rows = [(f"b{n % 17}", n % 75, 2009 + n % 6) for n in range(400)] + [("hot", n, 2010 + n % 2) for n in range(70)]
    rows += [(None, n, 2011 + n % 2) for n in range(9)] + [("lost", 900, 2012), ("lost", None, 2011), ("b3", None, 2009)]
    rows += [("late", 3, None), ("late", 4, 2014), ("never", 5, None), ("b1", 1, 2009), ("b1", 1, 2009)]
    return first_df(spark, rows), users_df(spark, people)


def _sums(cells):
    by = cells.groupBy("year", "is_total", *DIMS).agg(F.round(F.sum("credit"), 9).alias("credit"))
    return sorted(map(str, by.collect()))


@pytest.mark.parametrize("hot_rows", [skew.HOT_ROWS, 8])
@pytest.mark.parametrize("prepared", [False, True])
def test_sums_equal_the_cells(spark, monkeypatch, hot_rows, prepared):
    monkeypatch.setattr(skew, "HOT_ROWS", hot_rows)
    first, users = _odd_tables(spark)
    how = {}
    if prepared:
        first, how = with_branch_year(first.distinct()), {"branch_year_col": "branch_year"}
    commits, people = first.withColumnRenamed("min_commit_year", "year"), expand_country_sector(users)
    want = _sums(credit_cells(commits, people, DIMS, LABELS, "year", **how))
    got = _sums(credit_sums(commits, people, DIMS, LABELS, "year", write=tables.written, tasks=5, **how))
    assert got == want and len(want) > 30


@pytest.mark.parametrize("report", [new_repos_by_sector_year, new_repos_by_country_year, country_cube])
def test_rows_are_shuffled_by_branch_once(spark, monkeypatch, report):
    """Without values: a row has the name of its author's split."""
    first, users = tables.commits_first(spark, SF001), tables.users(spark, SF001)
    monkeypatch.setattr(skew, "TASK_ROWS", 100)
    plan = tables.first_year_report(report, first, users)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(branch#", plan)) == 1
    monkeypatch.setattr(skew, "HOT_ROWS", 3)   # branches that are hot are combined before they meet
    plan = tables.first_year_report(report, first, users)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(branch#", plan)) == 2


def test_a_written_table_leaves_no_shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f for f in str(disk.getAllFiles().mkString(" ")).split() if "/shuffle_" in f}
    before = files()
    rows = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    table = tables.written(rows)
    for _ in range(50):   # executors are told, not waited for
        if left := files() - before:
            time.sleep(0.1)
    assert not left and table.count() == 10
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
