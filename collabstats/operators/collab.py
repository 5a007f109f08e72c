"""International collaboration reports for one year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from collabstats.operators.expand import expand_countries
from collabstats.operators.skew import keep, skewed_join
from collabstats.sources.parquet import require_columns
from collabstats.schemas import MISSING_COUNTRY, US


def branch_countries(commits_yearly: DataFrame, users: DataFrame, year: int,
                     missing: str = MISSING_COUNTRY, hot_rows: int | DataFrame | None = None,
                     commits_distinct: bool = False) -> DataFrame:
    """(branch, country, n_users) for the year's commits by known users.

    One row per distinct (branch, country) plus one marker row per branch
    (country NULL); every row carries n_users, the number of distinct known
    authors of the branch.  Built as one chain:

    * users side, once per id: the set of the user's countries (bounded by
      the country domain), so the join emits one row per commit row;
    * inner join of the year's commits to it (J1); the year filter prunes the
      partitioned commits table;
    * explode each author's countries plus a NULL marker and count per
      (branch, country) with map-side partial aggregation, so a branch with
      millions of authors is a few rows after the shuffle;
    * n_users from the marker row through a window by branch, over at most
      (number of countries + 1) rows per branch.

    Authors are counted once per branch whatever the input: commit rows are
    first reduced to distinct (branch, author_id).  `commits_distinct=True`
    says that they are distinct already, as the yearly table is, and saves
    that shuffle.
    """
    require_columns(commits_yearly, ["branch", "author_id", "commit_year"], "yearly commits")
    commits = keep(commits_yearly.where(F.col("commit_year") == year), "branch", "author_id")
    if not commits_distinct:
        commits = commits.distinct()
    per_id = expand_countries(users, missing).groupBy(F.col("id").alias("author_id")) \
        .agg(F.collect_set("country").alias("_cs"))
    elems = skewed_join(commits, per_id, "author_id", "inner", salt_cols=["branch"], hot_rows=hot_rows).select(
        "branch", F.explode(F.concat("_cs", F.array(F.lit(None).cast("string")))).alias("country")
    )
    counts = elems.groupBy("branch", "country").agg(F.count(F.lit(1)).alias("_n"))
    return counts.withColumn(
        "n_users", F.max(F.when(F.col("country").isNull(), F.col("_n"))).over(Window.partitionBy("branch"))
    ).drop("_n")


def collaborations_by_country(commits_yearly: DataFrame, users: DataFrame, year: int,
                              home: str = US, top_n: int | None = 11,
                              missing: str = MISSING_COUNTRY, hot_rows: int | DataFrame | None = None,
                              commits_distinct: bool = False) -> DataFrame:
    """Per foreign country, distinct branches of three kinds of collaboration.

    Per branch (only known users count): n_users, has_home, n_foreign =
    distinct countries that are neither home nor missing.  Then
      with home      = has_home and n_users > 1 and n_foreign >= 1
      with non-home  = n_users > 1 and n_foreign >= 2
      excluding home = not has_home and n_users > 1 and n_foreign >= 2
    Only foreign countries are rows; a country with all three counts 0 is
    absent.  Top n by `collaborations_with_us`, ties broken by name (T10).
    """
    bc = branch_countries(commits_yearly, users, year, missing, hot_rows, commits_distinct)
    return collaborations_of_branches(bc, home, top_n, missing)


def collaborations_of_branches(bc: DataFrame, home: str = US, top_n: int | None = 11,
                               missing: str = MISSING_COUNTRY) -> DataFrame:
    """C10 from the year's `branch_countries`, which C11 shares."""
    country = F.col("country")
    foreign = (country != home) & (country != missing)
    by_branch = Window.partitionBy("branch")
    profiled = bc.select(
        "branch", "country", "n_users", foreign.alias("_foreign"),
        F.max(country == home).over(by_branch).alias("has_home"),
        F.count(F.when(foreign, F.lit(1))).over(by_branch).alias("n_foreign"),
    ).where(F.col("_foreign") & (F.col("n_users") > 1))
    multi = F.col("n_foreign") > 1
    out = profiled.groupBy("country").agg(
        F.count(F.when(F.col("has_home"), F.lit(1))).alias("collaborations_with_us"),
        F.count(F.when(multi, F.lit(1))).alias("collaborations_with_non_us"),
        F.count(F.when(~F.col("has_home") & multi, F.lit(1))).alias("collaborations_non_us_excl_us"),
    ).where(
        (F.col("collaborations_with_us") + F.col("collaborations_with_non_us")
         + F.col("collaborations_non_us_excl_us")) > 0
    )
    ordered = out.orderBy(F.desc("collaborations_with_us"), F.asc("country"))
    return ordered.limit(top_n) if top_n is not None else ordered


def codeveloped_pairs(commits_yearly: DataFrame, users: DataFrame, year: int,
                      missing: str = MISSING_COUNTRY, min_users: int = 2, hot_rows: int | DataFrame | None = None,
                      commits_distinct: bool = False) -> DataFrame:
    """C11: distinct branches per unordered country pair (country_1 < country_2).

    Branches need >= `min_users` distinct known users (counted including users
    without a country); pairs with the missing label are dropped, which equals
    dropping that label before pairing because users were counted first.

    Pairs are generated once per distinct *country combination*, not per
    branch: each branch is reduced to its sorted country set (bounded by the
    number of countries), the sets are counted, and each distinct set emits
    its pairs weighted by that count.  Byte order decides which country is
    listed first (T13).
    """
    bc = branch_countries(commits_yearly, users, year, missing, hot_rows, commits_distinct)
    return pairs_of_branches(bc, missing, min_users)


#: Countries of a block in which pairs are formed.
PAIR_BLOCK = 64


def pairs_of_branches(bc: DataFrame, missing: str = MISSING_COUNTRY, min_users: int = 2) -> DataFrame:
    """C11 from the year's `branch_countries`, which C10 shares.

    Countries are free text, so a list may be long and its pairs very many.
    The sorted list is cut into blocks: one row pairs a block with what
    follows from it on, is dealt to any task, and goes on block by block.  So a
    list is copied once per block and not per country, no task forms all pairs
    of a long list, and no row holds more than a list and two blocks.
    """
    sets = (
        bc.where(F.col("country").isNotNull() & (F.col("country") != missing) & (F.col("n_users") >= min_users))
        .groupBy("branch").agg(F.array_sort(F.collect_set("country")).alias("countries"))
        .where(F.size("countries") >= 2)
        .groupBy("countries").agg(F.count(F.lit(1)).alias("n_branches"))
    )

    def blocks(of: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.floor((F.size(of) - 1) / PAIR_BLOCK).cast("int")))

    at = F.col("_block") * PAIR_BLOCK + 1
    mine = sets.withColumn("_block", blocks("countries")).select(
        "n_branches", F.slice("countries", at, F.lit(PAIR_BLOCK)).alias("_mine"), F.slice("countries", at, F.size("countries")).alias("_from"))
    tasks = int(bc.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = mine.repartition(tasks, F.xxhash64("_mine", "_from")).withColumn("_block", blocks("_from")).select(
        "n_branches", F.explode("_mine").alias("country_1"), F.slice("_from", at, F.lit(PAIR_BLOCK)).alias("_others"))
    pairs = met.select("n_branches", "country_1", F.explode("_others").alias("country_2")).where(F.col("country_1") < F.col("country_2"))
    return (
        pairs.groupBy("country_1", "country_2")
        .agg(F.sum("n_branches").cast("bigint").alias("co_developed_repositories"))
        .orderBy(F.desc("co_developed_repositories"), "country_1", "country_2")
    )
