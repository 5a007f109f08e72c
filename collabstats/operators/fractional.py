"""Fractional repository counts.

Every report is a single chain: credit cells (see `credit`) -> each cell is
exploded into the report rows it contributes to -> one aggregation with one
conditional sum per year (the pivot).  Nothing is computed twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from collabstats.functions.numeric import round_half_even
from collabstats.operators.credit import credit_cells, credit_sums
from collabstats.operators.expand import expand_countries, expand_country_sector
from collabstats.operators.ranking import numbered, top_with_ties
from collabstats.operators.skew import keep
from collabstats.plans.report import contributions, order_rows, pivot_years, recode, year_sums
from collabstats.schemas import (
    MISSING,
    MISSING_COUNTRY,
    REPORT_YEARS,
    SECTOR_RECODE,
    SECTOR_ROW_ORDER,
    UNCLASSIFIED,
    US,
)


def fractional_repos_by_country(commits_yearly: DataFrame, users: DataFrame, year: int,
                                missing: str = MISSING_COUNTRY, hot_rows: int | DataFrame | None = None,
                                commits_distinct: bool = False) -> DataFrame:
    """(country, total_repositories) for one year, sorted descending.

    Left join, so authors unknown to the user table count as the missing
    label; only branches with >= 1 matched user are kept.  The grand total
    equals the number of kept branches.
    """
    commits = keep(commits_yearly.where(F.col("commit_year") == year), "branch", "author_id")
    cells = credit_cells(commits, expand_countries(users, missing), ["country"], [missing], hot_rows=hot_rows,
                         commits_distinct=commits_distinct)
    return (
        cells.where(~F.col("is_total"))
        .groupBy("country").agg(F.sum("credit").alias("total_repositories"))
        .orderBy(F.desc("total_repositories"), "country")
    )


def _first_year_cells(first_commits: DataFrame, users_x: DataFrame, dims, labels, hot_rows, commits_distinct, tasks, write) -> DataFrame:
    """Cells of the branches' first years, or with `write` their sums (`credit.credit_sums`); a prepared `branch_year` column,
    where there is one, saves splitting later rows."""
    prepared = [c for c in ("branch_year",) if c in first_commits.columns]
    commits = keep(first_commits, "branch", "author_id", F.col("min_commit_year").alias("year"), *prepared)
    cells = partial(credit_sums, write=write) if write else credit_cells
    return cells(commits, users_x, dims, labels, year_col="year", hot_rows=hot_rows,
                 commits_distinct=commits_distinct, branch_year_col=prepared[0] if prepared else None, tasks=tasks)


def new_repos_by_sector_year(first_commits: DataFrame, users: DataFrame, years: Sequence[int] = REPORT_YEARS,
                             home: str = US, missing: str = MISSING, unclassified: str = UNCLASSIFIED,
                             hot_rows: int | DataFrame | None = None, commits_distinct: bool = False,
                             tasks: int | None = None, write: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """First-year fractional credit by sector and year.

    Rows: Total Repos; Total (Global) = neither home nor missing; Total (US);
    home credit by sector (recoded); Total (Missing Country).  Values are
    rounded half-to-even; every year of `years` is a column (0 when absent).
    A home cell counts toward Total (US) and toward its sector row.
    """
    ux = expand_country_sector(users, missing, unclassified)
    cells = _first_year_cells(first_commits, ux, ["country_val", "sector_val"], [missing, unclassified], hot_rows, commits_distinct, tasks, write)
    # Small cube first (year x class x sector), then each cube row adds to its report rows.
    cube = cells.groupBy("year", "is_total", "country_val", "sector_val").agg(F.sum("credit").alias("credit"))
    country = F.col("country_val")
    labels = (
        F.when(F.col("is_total"), F.array(F.lit("Total Repos")))
        .when(country == home, F.array(F.lit("Total (US)"), recode(F.col("sector_val"), SECTOR_RECODE)))
        .when(country == missing, F.array(F.lit("Total (Missing Country)")))
        .otherwise(F.array(F.lit("Total (Global)")))
    )
    rows = cube.select("year", "credit", F.explode(labels).alias("sector"))
    wide = pivot_years(rows, "sector", "year", "credit", years)
    report = wide.select("sector", *[round_half_even(str(y)).alias(str(y)) for y in years])
    return order_rows(report, "sector", SECTOR_ROW_ORDER)


def country_cube(first_commits: DataFrame, users: DataFrame, missing: str = MISSING,
                 hot_rows: int | DataFrame | None = None, commits_distinct: bool = False, tasks: int | None = None,
                 write: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(is_total, country_val, year, credit): the sums of which C17 is made."""
    ux = expand_countries(users, missing, out="country_val")
    cells = _first_year_cells(first_commits, ux, ["country_val"], [missing], hot_rows, commits_distinct, tasks, write)
    return cells.groupBy("is_total", "country_val", "year").agg(F.sum("credit").alias("credit"))


def countries_of_cube(cube: DataFrame, years: Sequence[int] = REPORT_YEARS, top_n: int = 10, missing: str = MISSING) -> DataFrame:
    """C17 from a written `country_cube`.

    The same report as `new_repos_by_country_year`, for any number of ties: the top countries are those from the
    n-th score up (`ranking.top_with_ties`), their rows are numbered in parts (`ranking.numbered`), and no
    task sees all of them.  The cube is read several times, which is why it should be written.
    """
    scores = cube.where(~F.col("is_total") & (F.col("country_val") != missing)) \
        .groupBy("country_val").agg(F.round(F.sum("credit"), 6).alias("_score"))
    leaders = numbered(top_with_ties(scores, "_score", top_n), [-F.col("_score"), F.col("country_val")], "_pos")
    country, placed = F.col("country_val"), F.col("_pos").isNotNull()
    labels = (
        F.when(F.col("is_total"), contributions(("Total Repos", 0)))
        .when(country == missing, contributions(("Total (Missing Country)", 1_000_001)))
        .when(placed, contributions((country, F.col("_pos") + 1), ("Total (Any Country)", 1)))
        .otherwise(contributions(("All Other Countries", 1_000_000), ("Total (Any Country)", 1)))
    )
    rows = cube.join(leaders.select("country_val", "_pos"), "country_val", "left").select("year", "credit", F.explode(labels).alias("_l"))
    wide = rows.groupBy(F.col("_l.label").alias("country"), F.col("_l.row_order").alias("row_order")).agg(*year_sums("credit", "year", years))
    return wide.select("country", *[round_half_even(str(y)).alias(str(y)) for y in years], "row_order")


def new_repos_by_country_year(first_commits: DataFrame, users: DataFrame, years: Sequence[int] = REPORT_YEARS,
                              top_n: int = 10, missing: str = MISSING, hot_rows: int | DataFrame | None = None,
                              commits_distinct: bool = False, buckets: int = 256, tasks: int | None = None,
                              write: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """C17: first-year fractional credit by country and year.

    Rows: Total Repos; Total (Any Country); the top-n countries by total over
    all years (rank with ties, missing excluded; T16); All Other Countries;
    Total (Missing Country).  Top rows are sorted by total, then name.

    The ranking is a distributed top-k in two stages, as in C15: countries are
    hashed into `buckets` groups; a country with `top_n` better ones in its
    group cannot be in the top n, so the rest of a group collapses into one
    row, and the final ranking sees at most about buckets x (n + 1) rows
    however many country strings the users wrote.
    """
    cube = country_cube(first_commits, users, missing, hot_rows, commits_distinct, tasks, write)
    per_country = cube.groupBy("is_total", "country_val").agg(
        F.sum("credit").alias("overall"), *year_sums("credit", "year", years)
    )
    country = F.col("country_val")
    rankable = ~F.col("is_total") & (country != missing)
    score = F.when(rankable, F.round("overall", 6))
    names = [str(y) for y in years]
    bucket = F.pmod(F.xxhash64("country_val"), F.lit(buckets))
    local = per_country.withColumn("_score", score).withColumn("_b", bucket).withColumn(
        "_r", F.rank().over(Window.partitionBy("_b").orderBy(F.desc_nulls_last("_score"))))
    rest = rankable & (F.col("_r") > top_n)
    survivors = local.withColumn("_rest", rest).groupBy(
        "_b", "_rest", "is_total", F.when(~rest, country).alias("country_val"), F.when(~rest, F.col("_score")).alias("_score")
    ).agg(*[F.sum(n).alias(n) for n in names])
    ranked = survivors.select(
        "*",
        F.rank().over(Window.orderBy(F.desc_nulls_last("_score"))).alias("_rank"),
        F.row_number().over(Window.orderBy(F.desc_nulls_last("_score"), country)).alias("_pos"),
    )
    top = F.col("_score").isNotNull() & (F.col("_rank") <= top_n)
    labels = (
        F.when(F.col("is_total"), contributions(("Total Repos", 0)))
        .when(country == missing, contributions(("Total (Missing Country)", 1_000_001)))
        .when(top, contributions((country, F.col("_pos") + 1), ("Total (Any Country)", 1)))
        .otherwise(contributions(("All Other Countries", 1_000_000), ("Total (Any Country)", 1)))
    )
    rows = ranked.select(*names, F.explode(labels).alias("_l"))
    out = rows.groupBy(F.col("_l.label").alias("country"), F.col("_l.row_order").alias("row_order")) \
        .agg(*[F.sum(n).alias(n) for n in names])
    return out.select("country", *[round_half_even(n).alias(n) for n in names], "row_order")
