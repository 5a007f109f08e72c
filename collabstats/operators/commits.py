"""Commit reduction: yearly distinct commits (C4), first participation
and the second-source first participation (C6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from collabstats.operators.skew import branch_key, skewed_join
from collabstats.schemas import FIRST_YEAR, REPORT_YEARS
from collabstats.sources.parquet import require_columns


MASK_YEARS = 62   # years that `commit_years` can hold; `plans.jobs` takes the C4 -> C5 path beyond


def year_range_predicate(col: str, first: int, last: int, dtype: T.DataType | None = None):
    """`EXTRACT(YEAR FROM ts) BETWEEN first AND last` as a range on the raw
    timestamp, so Parquet row-group min/max statistics can skip data.

    The bounds are literals of the column's own type (wall-clock for
    TIMESTAMP_NTZ, session time zone for TIMESTAMP, as `year()` uses), so the
    column is compared uncast and the filter reaches the scan.
    """
    parse = F.to_timestamp_ntz if isinstance(dtype, T.TimestampNTZType) else F.to_timestamp
    lo, hi = (parse(F.lit(f"{y:04d}-01-01 00:00:00")) for y in (first, last + 1))
    ts = F.col(col)
    return (ts >= lo) & (ts < hi)


def commit_rows(raw: DataFrame, years: Sequence[int] = REPORT_YEARS) -> DataFrame:
    """(branch, author_id, commit_year) per author of each raw commit, not deduplicated.

    E1: one row per list member; a NULL or empty list gives no row.  NULL
    author ids are dropped (trap T8: they would be rows without a user and
    make credits exceed 1).
    """
    require_columns(raw, ["branch", "authors_id", "committedat"], "raw commits")
    lo, hi = min(years), max(years)
    rows = (
        raw.where(year_range_predicate("committedat", lo, hi, raw.schema["committedat"].dataType))
        .select("branch", F.explode("authors_id").alias("author_id"),
                F.year("committedat").cast("bigint").alias("commit_year"))
        .where(F.col("author_id").isNotNull())
    )
    if list(years) != list(range(lo, hi + 1)):
        rows = rows.where(F.col("commit_year").isin(list(years)))
    return rows.select("branch", F.col("author_id").cast("bigint").alias("author_id"), "commit_year")


def yearly_commits(raw: DataFrame, years: Sequence[int] = REPORT_YEARS) -> DataFrame:
    """C4: distinct (branch, author_id, commit_year) for every year at once.

    One shuffle (hash on all three columns, with map-side partial dedup) instead
    of one scan per year; write it with `sinks.write_by_year` for per-year files.
    """
    return commit_rows(raw, years).distinct()


def first_commits(commits: DataFrame) -> DataFrame:
    """MIN(commit_year) per (author_id, branch).

    Accepts either the yearly table or the undeduplicated `commit_rows` (the
    minimum is the same), so a caller that does not need the yearly table pays
    one shuffle.  Activity before the first report year never entered C4, so
    it is clipped, not removed.
    """
    return commits.groupBy("author_id", "branch").agg(F.min("commit_year").cast("bigint").alias("min_commit_year"))


def commit_years(raw: DataFrame, years: Sequence[int] = REPORT_YEARS) -> DataFrame:
    """(author_id, branch, year_bits): the years each author committed to each
    branch, as a bitmask (bit i = year min(years) + i).

    One shuffle by (author_id, branch) with a codegen'd `bit_or` hash
    aggregate, combined map-side, so repeated commits collapse before the
    shuffle.  Both C4 and C5 derive from it without another shuffle
    (`years_to_rows`, `first_year`), which is how `plans.jobs` prepares them.
    """
    base, span = min(years), max(years) - min(years) + 1
    if span > MASK_YEARS:
        raise ValueError(f"{span} years do not fit a 64-bit mask: use yearly_commits and first_commits")
    bit = F.expr(f"shiftleft(1L, cast(commit_year - {base} AS INT))")
    return commit_rows(raw, years).groupBy("author_id", "branch").agg(F.bit_or(bit).alias("year_bits"))


def years_to_rows(bits: DataFrame, years: Sequence[int] = REPORT_YEARS) -> DataFrame:
    """C4 from `commit_years`: one (branch, author_id, commit_year) row per set bit."""
    base, span = min(years), max(years) - min(years) + 1
    set_years = F.expr(
        f"transform(filter(sequence(0, {span - 1}), i -> ((year_bits >> i) & 1) = 1), i -> CAST(i + {base} AS BIGINT))")
    return bits.select("branch", "author_id", F.explode(set_years).alias("commit_year"))


def first_year(bits: DataFrame, years: Sequence[int] = REPORT_YEARS) -> DataFrame:
    """C5 from `commit_years`: the lowest set bit is the first year."""
    lowest = F.col("year_bits").bitwiseAND(-F.col("year_bits"))   # 2^k
    k = F.length(F.bin(lowest)) - 1
    return bits.select("author_id", "branch", (k + F.lit(min(years))).cast("bigint").alias("min_commit_year"))


def branch_years(first: DataFrame) -> DataFrame:
    """(branch, branch_year): the earliest year of each branch (the minimum of W3), a NULL branch being one of its own."""
    return first.groupBy("branch").agg(F.min("min_commit_year").cast("bigint").alias("branch_year"))


def with_branch_year(first: DataFrame, hot_rows: int | None = None, tasks: int | None = None) -> DataFrame:
    """First participation with `branch_year`, the earliest year of the branch.

    The minimum per branch is combined map-side and joined back; a branch with
    many participants is salted, so no task holds a hot branch.  The rows are
    read three times and should be written; `tasks` is `skew.tasks_for` them.
    """
    keyed = first.select("*", branch_key())
    earliest = keyed.groupBy("_branch").agg(F.min("min_commit_year").alias("branch_year"))
    joined = skewed_join(keyed, earliest, "_branch", "inner", salt_cols=["author_id"], hot_rows=hot_rows, tasks=tasks)
    return joined.select("author_id", "branch", "min_commit_year", "branch_year")


def first_commits_secondary(raw: DataFrame, min_year: int = FIRST_YEAR) -> DataFrame:
    """MIN(year) per (userid, repoid), HAVING the minimum >= min_year.

    Pairs that started before `min_year` are removed entirely; there is no
    upper bound (trap T5).
    """
    require_columns(raw, ["userid", "repoid", "commityear"], "second-source commits")
    return (
        raw.groupBy(F.col("userid").alias("author_id"), F.col("repoid").alias("branch"))
        .agg(F.min(F.year("commityear")).cast("bigint").alias("min_commit_year"))
        .where(F.col("min_commit_year") >= min_year)
    )
