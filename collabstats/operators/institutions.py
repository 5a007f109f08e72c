"""Institution reports over first participation.

Users are expanded with aligned (zipped) lists: the i-th organisation pairs
with the i-th country and sector (E3).  Per (branch, org[, sector]) the first
year is the minimum over its contributors.  Each report is one chain ending
in a single aggregation: every (branch, org) row is exploded into the report
rows it counts toward.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from collabstats.functions.lists import not_in_keep_null
from collabstats.operators.expand import expand_aligned
from collabstats.operators.skew import keep, skewed_join
from collabstats.sources.parquet import require_columns
from collabstats.plans.report import contributions, order_rows, stack_blocks
from collabstats.schemas import (
    AGENCY_LIST,
    ALL_OTHER_FEDERAL,
    FEDERAL_TOTAL,
    INSTITUTION_BLOCKS,
    REPORT_YEARS,
    US,
)


def branch_org_first_year(first_commits: DataFrame, users: DataFrame, country: str | None = US,
                          sectors: Sequence[str] = ("government",), keep_sector: bool = False,
                          hot_rows: int | DataFrame | None = None) -> DataFrame:
    """(branch, org[, sector], first_year) for users whose aligned entry has
    the given country and one of the sectors at the same list position.

    NULL org (a shorter organisation list) is a group of its own.  The user
    filter runs before the join, so only qualifying users are shuffled.
    """
    require_columns(first_commits, ["author_id", "branch", "min_commit_year"], "first commits")
    ux = expand_aligned(users).where(F.col("sector").isin(list(sectors)))
    if country is not None:
        ux = ux.where(F.col("country") == country)
    keys = ["org", "sector"] if keep_sector else ["org"]
    ux = ux.select(F.col("id").alias("author_id"), *keys)
    joined = skewed_join(keep(first_commits, "author_id", "branch", "min_commit_year"), ux, "author_id", "inner",
                         salt_cols=["branch"], hot_rows=hot_rows)
    return joined.groupBy("branch", *keys).agg(F.min("min_commit_year").alias("first_year"))


def _agency_rows(agencies: Sequence[str]):
    """Listed agency -> [agency, Federal Total]; other non-NULL org ->
    [All Other Federal, Federal Total]; NULL org -> [Federal Total] (P8)."""
    org = F.col("org")
    return (
        F.when(org.isin(list(agencies)), F.array(org, F.lit(FEDERAL_TOTAL)))
        .when(org.isNotNull(), F.array(F.lit(ALL_OTHER_FEDERAL), F.lit(FEDERAL_TOTAL)))
        .otherwise(F.array(F.lit(FEDERAL_TOTAL)))
    )


def agency_counts(branch_orgs: DataFrame, agencies: Sequence[str] = AGENCY_LIST) -> DataFrame:
    """(institution, first_year, n): the lossless long form of C13, from `branch_org_first_year` rows."""
    rows = branch_orgs.select("first_year", F.explode(_agency_rows(agencies)).alias("institution"))
    return rows.groupBy("institution", "first_year").agg(F.count(F.lit(1)).alias("n"))


def new_repos_by_agency_year(first_commits: DataFrame, users: DataFrame,
                             agencies: Sequence[str] = AGENCY_LIST,
                             years: Sequence[int] | None = None, hot_rows: int | DataFrame | None = None) -> DataFrame:
    """New repositories per listed agency and first year, years as columns.

    Federal Total counts (branch, org) pairs - a branch touched by two agencies
    counts twice, NULL-org pairs included; All Other Federal counts pairs whose
    org is not listed (NULL excluded, '' included).  Agencies without data
    have no row.

    The year columns are the report years and every other year that occurs, so
    no pair is lost.  With an explicit list, a pair outside it fails the query.
    """
    counts = agency_counts(branch_org_first_year(first_commits, users, hot_rows=hot_rows), agencies)
    return agency_years_of(counts, agencies, years) if years is not None else agency_years_of(collected(counts), agencies)


#: Rows of the long form that may come to the driver: labels times years.
LONG_ROWS = 100_000


def collected(counts: DataFrame) -> DataFrame:
    """The long form as a local table: the join below runs once, in one job, and both the year columns and the
    report follow from its few rows.  More than LONG_ROWS of them are an error."""
    rows = counts.limit(LONG_ROWS + 1).collect()
    if len(rows) > LONG_ROWS:
        raise ValueError(f"more than {LONG_ROWS} pairs of an institution and a year: name the years")
    return counts.sparkSession.createDataFrame(rows, counts.schema)


def agency_years_of(counts: DataFrame, agencies: Sequence[str] = AGENCY_LIST,
                    years: Sequence[int] | None = None) -> DataFrame:
    """C13 from `agency_counts` rows, written or `collected`: without `years` they are read for the years."""
    long = counts
    if years is None:
        occurring = [r[0] for r in counts.select("first_year").distinct().collect() if r[0] is not None]   # one row per year
        years = sorted({*REPORT_YEARS, *occurring})
    else:
        outside = F.concat(F.lit("first year outside the report's years: "), F.coalesce(F.col("first_year").cast("string"), F.lit("none")))
        inside = F.coalesce(F.col("first_year").isin(list(years)), F.lit(False))
        long = long.withColumn("n", F.when(inside, F.col("n")).otherwise(F.raise_error(outside).cast("bigint")))
    sums = [F.coalesce(F.sum(F.when(F.col("first_year") == y, F.col("n"))), F.lit(0)).cast("bigint").alias(str(y)) for y in years]
    wide = long.groupBy("institution").agg(*sums)
    return order_rows(wide, "institution", [FEDERAL_TOTAL, *agencies, ALL_OTHER_FEDERAL])


def repos_by_agency(first_commits: DataFrame, users: DataFrame,
                    agencies: Sequence[str] = AGENCY_LIST, hot_rows: int | DataFrame | None = None) -> DataFrame:
    """C14: repositories per listed agency over all years, plus Federal Total
    and All Other Federal (both always present, 0 on empty input)."""
    return agency_totals_of(agency_counts(branch_org_first_year(first_commits, users, hot_rows=hot_rows), agencies), agencies)


def agency_totals_of(counts: DataFrame, agencies: Sequence[str] = AGENCY_LIST) -> DataFrame:
    """C14 from `agency_counts` rows, which C13 shares: the sum over all years."""
    always = counts.sparkSession.createDataFrame([(FEDERAL_TOTAL, 0), (ALL_OTHER_FEDERAL, 0)], "institution string, n bigint")
    out = stack_blocks(counts.select("institution", "n"), always).groupBy("institution").agg(F.sum("n").cast("bigint").alias("n_repositories"))
    return order_rows(out, "institution", [FEDERAL_TOTAL, *agencies, ALL_OTHER_FEDERAL])


def top_institutions(first_commits: DataFrame, users: DataFrame, top_n: int = 10,
                     blocks: Sequence[tuple] = INSTITUTION_BLOCKS, buckets: int = 1024,
                     hot_rows: int | DataFrame | None = None) -> DataFrame:
    """Per sector block - header, total, top-n organisations, all other.

    Counts are distinct branches per (org, sector).  Excluded orgs ('' and the
    Misc. label) leave the block; a NULL org is kept (R's `%in%` rule, P9) and
    may rank.  Top-n keeps no ties: count descending, then name (NULL last).

    Distributed top-k in two stages, so no task sees every organisation: orgs
    are hashed into `buckets` groups per sector; within a group only the
    top-n survive individually and the rest collapse into one row (an org
    beaten by n others in its group cannot be in the global top-n).  The
    second stage ranks the <= buckets x (n + 1) survivors per sector.  With
    1024 buckets, 10 million organisations give ~10k rows per first-stage
    group and at most ~11k survivors per sector.
    """
    spark: SparkSession = first_commits.sparkSession
    sectors = [b[0] for b in blocks]
    counts = (
        branch_org_first_year(first_commits, users, country=None, sectors=sectors, keep_sector=True,
                              hot_rows=hot_rows)
        .groupBy("org", "sector").agg(F.count(F.lit(1)).alias("n"))
    )
    eligible = None
    for sector, _h, _t, _o, excluded in blocks:
        cond = (F.col("sector") == sector) & not_in_keep_null("org", excluded)
        eligible = cond if eligible is None else eligible | cond
    order = [F.desc("n"), F.asc_nulls_last("org")]

    bucket = F.pmod(F.xxhash64("org"), F.lit(buckets))
    stage1 = counts.where(eligible).withColumn("_b", bucket).withColumn(
        "_r", F.row_number().over(Window.partitionBy("sector", "_b").orderBy(*order)))
    rest = F.col("_r") > top_n
    survivors = stage1.groupBy(
        "sector", "_b", F.when(~rest, F.col("org")).alias("org"), rest.alias("_rest")
    ).agg(F.sum("n").alias("n"))
    stage2 = survivors.withColumn(
        "_r", F.row_number().over(Window.partitionBy("sector").orderBy(F.asc("_rest"), *order)))

    is_top = ~F.col("_rest") & (F.col("_r") <= top_n)
    labels = None
    literal_rows = []
    offset = 0
    for sector, header, total_label, other_label, _excluded in blocks:
        header = header.format(n=top_n)
        in_block = F.col("sector") == sector
        block_labels = F.when(is_top, contributions((F.col("org"), F.col("_r") + offset + 1), (total_label, offset + 1))) \
            .otherwise(contributions((other_label, offset + top_n + 2), (total_label, offset + 1)))
        labels = F.when(in_block, block_labels) if labels is None else labels.when(in_block, block_labels)
        literal_rows += [(header, None, offset), (total_label, 0, offset + 1), (other_label, 0, offset + top_n + 2)]
        offset += top_n + 3
    rows = stage2.select(F.col("n").cast("bigint").alias("n"), F.explode(labels).alias("_l")) \
        .select(F.col("_l.label").alias("institution"), F.col("_l.row_order").alias("row_order"), "n")
    fixed = spark.createDataFrame(literal_rows, "institution string, n bigint, row_order int")
    return (
        stack_blocks(rows, fixed)
        .groupBy("institution", "row_order").agg(F.sum("n").alias("n_repositories"))
        .select("institution", F.col("n_repositories").cast("bigint"), F.col("row_order").cast("int"))
    )
