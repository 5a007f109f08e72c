"""Fractional repository credit.

Each kept repository (branch) is worth 1: every distinct author gets
1/n_users, split equally over the author's distinct attribute values
(countries, or country x sector combinations).

The computation is one chain of operators, so the large commits x users join
runs once per report and nothing is consumed twice:

1. users side, once per user id: the distinct value combinations and the
   weight w = 1 / prod(|distinct values of each attribute|) - an author's
   split depends only on the user, not on the branch, so it is computed on
   the (smaller) user table, one row per id, like a dimension;
2. left-join the commits to it on the author id (one output row per commit
   row; hot authors salted, see `skew`); unmatched authors get the labels
   with weight 1;
3. explode each row into its combinations plus one *marker* element (all
   values NULL, weight 1) that counts the author, and pre-aggregate to
   (branch[, year], values) with map-side partial aggregation, so a hot
   branch collapses to one row per value (and one marker per year) before it
   is shuffled;
4. one window pass partitioned by branch over those few rows gives the
   branch's first year, whether any author matched a user, and n_users (the
   marker weight of the first year) - no join back, no DISTINCT window;
5. credit = w / n_users; the marker row carries n_users x 1/n_users, the
   branch's contribution to "Total Repos".

Authors are counted once per branch[, year] whatever the input: commit rows are
first reduced to distinct (branch, author_id[, year]).  `commits_distinct=True`
says that they are distinct already - as the yearly, first-participation and
merged tables of this package are - and saves that shuffle.

`credit_sums` has the sums of the cells over all branches, which is what the
first-year reports need, for tables of many tasks: there steps 3 and 4 move
one short row per commit, with the name of its author's split, instead of a
row with strings per value; values are exploded from the sums.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from collabstats.operators.skew import HOT, branch_key, hot_keys, keep, skewed_join
from collabstats.sources.parquet import require_columns


def user_splits(users_x: DataFrame, dims: Sequence[str]) -> DataFrame:
    """(id, elements): per user id, an array of (*dims, w) structs - each
    distinct value combination with weight w = 1 / prod(number of distinct
    values per attribute) - followed by the marker (dims NULL, w = 1).

    Duplicate user rows merge, as the reference's per-(branch, author)
    distinct counts merge them.  Sets are bounded by the attribute domains.
    Everything per-user is computed here, on the user table, so the large
    side of the join only explodes the array.
    """
    per_id = users_x.groupBy("id").agg(
        F.collect_set(F.struct(*[F.col(d) for d in dims])).alias("_combos"),
        *[F.size(F.collect_set(d)).alias(f"_n_{d}") for d in dims],
    )
    denom: Column = F.lit(1.0)
    for d in dims:
        denom = denom * F.col(f"_n_{d}")
    weighted = F.transform("_combos", lambda c: F.struct(*[c[d].alias(d) for d in dims], (F.lit(1.0) / denom).alias("w")))
    return per_id.select("id", F.concat(weighted, _marker(dims)).alias("elements"))


def _marker(dims: Sequence[str]) -> Column:
    return F.array(F.struct(*[F.lit(None).cast("string").alias(d) for d in dims], F.lit(1.0).alias("w")))


def _unmatched(dims: Sequence[str], labels: Sequence[str]) -> Column:
    """The elements of an author without a user: the labels, and the marker."""
    own = F.struct(*[F.lit(lbl).alias(d) for d, lbl in zip(dims, labels)], F.lit(1.0).alias("w"))
    return F.concat(F.array(own), _marker(dims))


def credit_cells(commits: DataFrame, users_x: DataFrame, dims: Sequence[str], labels: Sequence[str],
                 year_col: str | None = None, hot_rows: int | DataFrame | None = None,
                 commits_distinct: bool = False, branch_year_col: str | None = None, tasks: int | None = None) -> DataFrame:
    """Per kept branch: (branch[, year], *dims, credit, is_total).

    `commits` holds (branch, author_id[, year_col]).  With `year_col`, a
    branch belongs to its earliest year and only that year's authors share
    its credit (first-year rule); without it all authors share.  A branch is
    kept if any of its authors - in any year - matched a user (T15).
    `is_total` rows (dims NULL) carry the branch's total, n_users x 1/n_users.

    With `branch_year_col` - the branch's earliest year, prepared beforehand -
    rows of later years are not split at all: each adds one element of weight
    0 to the marker, which carries whether it matched a user.

    `tasks` (`skew.tasks_for` the commits): the tasks of the join and of the
    window over branches.
    """
    keys = ["branch"] + ([year_col] if year_col else [])
    extra = [branch_year_col] if branch_year_col else []
    require_columns(commits, ["author_id", *keys, *extra], "commits")
    splits = user_splits(users_x, dims).withColumnRenamed("id", "author_id")
    rows = keep(commits, "author_id", *keys, *extra)
    if not commits_distinct:
        rows = rows.distinct()
    joined = skewed_join(rows, splits, "author_id", "left", salt_cols=["branch"], hot_rows=hot_rows, tasks=tasks)

    split = F.coalesce(F.col("elements"), _unmatched(dims, labels))
    if branch_year_col:
        flag = F.array(F.struct(*[F.lit(None).cast("string").alias(d) for d in dims], F.lit(0.0).alias("w")))
        split = F.when(F.col(year_col) == F.col(branch_year_col), split).otherwise(flag)
    own_keys = [F.col(branch_year_col).alias(k) if branch_year_col and k == year_col else F.col(k) for k in keys]
    elements = joined.select(
        *own_keys, F.col("elements").isNotNull().alias("matched"), F.explode(split).alias("_e"),
    ).select(*keys, "matched", *[F.col(f"_e.{d}").alias(d) for d in dims], F.col("_e.w").alias("w"))

    cells = elements.groupBy(*keys, *dims).agg(F.sum("w").alias("w"), F.max("matched").alias("matched"))
    if tasks:
        cells = cells.repartition(tasks, "branch")
    by_branch = Window.partitionBy("branch")
    is_total = F.col(dims[0]).isNull()
    marker_w = F.when(is_total, F.col("w"))
    # One window pass per branch: kept flag, first year, and the marker weight
    # (= number of authors) of the first year.
    stats = [F.max("matched").over(by_branch).alias("_kept")]
    if year_col:
        stats += [
            F.min(year_col).over(by_branch).alias("_first"),
            F.min_by(marker_w, F.when(is_total, F.col(year_col))).over(by_branch).alias("_n"),
        ]
    else:
        stats += [F.max(marker_w).over(by_branch).alias("_n")]
    kept = cells.select("*", *stats).where(
        F.col("_kept") & ((F.col(year_col) == F.col("_first")) if year_col else F.lit(True))
    )
    credit = F.when(is_total, F.col("_n") * (F.lit(1.0) / F.col("_n"))).otherwise(F.col("w") / F.col("_n"))
    return kept.select(*keys, *dims, credit.alias("credit"), is_total.alias("is_total"))


def named_splits(splits: DataFrame, write: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(id, split) and (split, elements), both written: users of the same elements share one name, the smallest of their ids.

    Each id of `splits` occurs once.  Most users may share a split, so the join by it is salted.
    """
    table = write(splits.where(F.col("id").isNotNull()).select("id", F.sort_array("elements").alias("elements")))
    kinds = write(table.groupBy("elements").agg(F.min("id").alias("split")))
    return write(skewed_join(table, kinds, "elements", "inner", salt_cols=["id"]).select("id", "split")), kinds


def credit_sums(commits: DataFrame, users_x: DataFrame, dims: Sequence[str], labels: Sequence[str], year_col: str,
                write: Callable[[DataFrame], DataFrame], hot_rows: int | DataFrame | None = None,
                commits_distinct: bool = False, branch_year_col: str | None = None, tasks: int | None = None) -> DataFrame:
    """(year_col, *dims, credit, is_total): the credits of `credit_cells` - see there - summed over the branches of a year
    and the authors of a split; a (year, dims) may have several rows.

    The rows go to their branch as they are, in one shuffle.  If any branch is hot - has `skew.HOT_ROWS` rows - they are
    first combined to (branch, year, split), map-side, so a task gets at most (#years x #splits) rows of a branch.
    An author's share of its branch, 1 / n_users, is summed by year and split, and only these sums meet the
    splits' values.

    `write` writes a table and reads it back: the splits, their names, the names of users, the hot authors and branches.
    """
    extra = [branch_year_col] if branch_year_col else []
    require_columns(commits, ["author_id", "branch", year_col, *extra], "commits")
    names, kinds = named_splits(user_splits(users_x, dims), write)
    rows = keep(commits, "author_id", "branch", year_col, *extra)
    if not commits_distinct:
        rows = rows.distinct()
    if hot_rows is None and HOT not in rows.columns:   # counted by itself, so that the count's shuffle is gone when the rows are joined
        hot_rows = write(hot_keys(rows, "author_id"))
    joined = skewed_join(rows, names.withColumnRenamed("id", "author_id"), "author_id", "left", salt_cols=["branch"],
                         hot_rows=hot_rows, tasks=tasks)

    year, split, own = F.col(year_col), F.col("split"), F.lit(1)
    if branch_year_col:   # rows of later years only tell whether they matched a user
        of_first = F.col(year_col) == F.col(branch_year_col)
        year, split, own = F.col(branch_year_col), F.when(of_first, split), F.when(of_first, own).otherwise(0)
    named = joined.select("branch", year.alias(year_col), split.alias("split"), own.alias("own"), F.col("split").isNotNull().alias("matched"))
    hot = bool(tasks) and not write(hot_keys(rows.select(branch_key()), "_branch")).isEmpty()
    if tasks and not hot:
        named = named.repartition(tasks, "branch")
    cells = named.groupBy("branch", year_col, "split").agg(F.sum("own").alias("own"), F.max("matched").alias("matched"))
    if hot:
        cells = cells.repartition(tasks, "branch")
    by_branch = Window.partitionBy("branch")
    kept = cells.select("*", F.max("matched").over(by_branch).alias("_kept"), F.min(year_col).over(by_branch).alias("_first")) \
        .where(F.col("_kept") & (F.col(year_col) == F.col("_first")) & (F.col("own") > 0))
    shares = kept.select(year_col, "split", (F.col("own") / F.sum("own").over(by_branch)).alias("share")) \
        .groupBy(year_col, "split").agg(F.sum("share").alias("share"))
    elements = shares.join(kinds, "split", "left").select(
        year_col, "share", F.explode(F.coalesce(F.col("elements"), _unmatched(dims, labels))).alias("_e"))
    return elements.select(year_col, *[F.col(f"_e.{d}").alias(d) for d in dims], (F.col("share") * F.col("_e.w")).alias("credit"),
                           F.col(f"_e.{dims[0]}").isNull().alias("is_total"))
