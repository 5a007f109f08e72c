"""One more year, without a full run (C4, C5, and the first year of W3).

The prepared tables are the state: yearly commits by year, first participation
by its year, and the branches' first years by year (`prepare_primary` with
`incremental=True`).  Adding a year writes that year's folder of each.  A pair
or a branch that occurs in an earlier folder stays where it is; that is the
whole merge of a minimum.

A year that is not the last may be added or rewritten, too: pairs that began
later may now begin earlier, or no longer begin in it, so the folders from that
year on are derived again from the yearly commits of those years.  Earlier
folders are read - two columns of first participation and their year - and
never written; the raw commits of other years are not read at all.

Earlier pairs enter the minimum of the later ones and leave by it: one shuffle.
In a bucketed layout they are anti-joined instead, bucket by bucket without a
shuffle; only the pairs of the year and later are exchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collabstats.operators.commits import branch_years, commit_rows, first_commits
from collabstats.operators.skew import HOT, hot_keys
from collabstats.plans.jobs import Prepared
from collabstats.schemas import RAW_COMMITS_SCHEMA
from collabstats.session import settings
from collabstats.sources.parquet import require_schema
from collabstats.sources.sinks import write_parquet

#: Buckets by author serve a join by author and branch.
CO_LOCATED = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


def unseen(rows: DataFrame, earlier: DataFrame, keys: list[str]) -> DataFrame:
    """`rows` whose keys are not in `earlier`.  A NULL branch is a branch like any other; author ids are never NULL here, and
    compared plainly, so that buckets by author fit."""
    a, b = rows.alias("a"), earlier.select(*keys).alias("b")
    same = F.lit(True)
    for k in keys:
        mine, theirs = F.col(f"a.{k}"), F.col(f"b.{k}")
        same = same & (mine == theirs if k == "author_id" else mine.eqNullSafe(theirs))
    return a.join(b, same, "left_anti")


def first_from(prepared: Prepared, spark: SparkSession, year: int) -> DataFrame:
    """First participation in `year` or later: the pairs of those years that no earlier year has."""
    keys = ["author_id", "branch"]
    later = prepared.read(spark, "commits_yearly").where(F.col("commit_year") >= year)
    earlier = prepared.read(spark, "commits_first").where(F.col("min_commit_year") < year)
    if HOT not in earlier.columns:
        # One aggregation instead of an anti-join: a pair of an earlier year keeps that year in the minimum, and leaves.
        both = later.unionByName(earlier.withColumnRenamed("min_commit_year", "commit_year"))
        return first_commits(both).where(F.col("min_commit_year") >= year)
    # An author's rows all lie with the cold or all with the hot authors, in both tables; the cold ones meet by bucket.
    cold = unseen(first_commits(later.where(~F.col(HOT))), earlier.where(~F.col(HOT)), keys)
    return cold.unionByName(unseen(first_commits(later.where(F.col(HOT))), earlier.where(F.col(HOT)), keys))


def add_year(spark: SparkSession, prepared: Prepared, raw_commits: DataFrame, year: int, hot_rows: int | None = None) -> Prepared:
    """Adds or rewrites `year` from its raw commits (rows of other years are passed over).

    Afterwards the tables equal those of a full run over all years.  Merged and report tables that were prepared from the
    earlier state are dropped from the result's list.  A run that fails can be repeated.
    """
    need = {"commits_yearly", "commits_first", "branch_years"}
    if not need <= prepared.tables:
        raise ValueError(f"add_year needs the state {sorted(need)}: prepare_primary(.., incremental=True)")
    require_schema(raw_commits, RAW_COMMITS_SCHEMA, "raw commits")
    hot = prepared.read(spark, "hot_authors")
    with settings(spark, CO_LOCATED):
        prepared.rewrite(commit_rows(raw_commits, [year]).distinct(), "commits_yearly", "commit_year", [year], "author_id", hot)
        later = sorted({year, *(y for t, c in (("commits_yearly", "commit_year"), ("commits_first", "min_commit_year"))
                                for y in prepared.years(spark, t, c) if y >= year)})
        write_parquet(first_from(prepared, spark, year), prepared.path("first_added"))
        added = prepared.read(spark, "first_added")
        prepared.rewrite(added, "commits_first", "min_commit_year", later, "author_id", hot)
        known = prepared.read(spark, "branch_years").where(F.col("branch_year") < year)
        both = added.select("branch", "min_commit_year").unionByName(known.withColumnRenamed("branch_year", "min_commit_year"))
        write_parquet(branch_years(both).where(F.col("branch_year") >= year), prepared.path("branches_added"))
        prepared.rewrite(prepared.read(spark, "branches_added"), "branch_years", "branch_year", later)
    if not prepared.buckets:   # a bucketed layout keeps the authors that lie apart
        write_parquet(hot_keys(prepared.read(spark, "commits_first"), "author_id", hot_rows), prepared.path("hot_authors"))
    return Prepared(prepared.root, prepared.buckets).having("users_clean", "hot_authors", *need)
