"""End-to-end jobs: preparation of both sources and the eight report tables.

Preparation materialises the reduced tables as Parquet, as the reference
does: cleaned users, yearly commits (partitioned by year, so single-year
reports prune to one folder), first participation, the second source and the
merged tables.  Each written table also cuts the lineage, so a lost executor
only recomputes from the last table written.

Reports are lazy DataFrames over the prepared tables; `write_reports` writes
them with display headers (S6).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from collabstats.operators.clean import attach_agency, classify_agency, clean_users
from collabstats.operators.collab import branch_countries, collaborations_of_branches, pairs_of_branches
from collabstats.operators.commits import (
    MASK_YEARS,
    branch_years,
    commit_years,
    first_commits,
    first_commits_secondary,
    first_year,
    yearly_commits,
    years_to_rows,
)
from collabstats.operators.fractional import (
    countries_of_cube,
    country_cube,
    fractional_repos_by_country,
    new_repos_by_country_year,
    new_repos_by_sector_year,
)
from collabstats.operators.institutions import agency_counts, agency_totals_of, agency_years_of, branch_org_first_year, top_institutions
from collabstats.operators.merge import merge_users, new_commits
from collabstats.operators.skew import HOT, hot_keys, mark_hot, within_bytes
from collabstats.schemas import (
    COMMITS_FIRST_SCHEMA,
    COMMITS_YEARLY_SCHEMA,
    DISPLAY_HEADERS,
    ORG_COLUMNS_PRIMARY,
    ORG_COLUMNS_SECONDARY,
    RAW_COMMITS_SCHEMA,
    RAW_COMMITS_SECONDARY_SCHEMA,
    RAW_USERS_SCHEMA,
    RAW_USERS_SECONDARY_SCHEMA,
    REPORT_ORDER,
    REPORT_YEARS,
    USERS_CLEAN_SCHEMA,
)
from collabstats.session import settings
from collabstats.sources import files
from collabstats.sources.parquet import require_schema, scan
from collabstats.sources.sinks import only_years, write_by_year, write_parquet, write_report


@dataclass(frozen=True)
class RawInputs:
    users: DataFrame
    commits: DataFrame
    users_secondary: DataFrame | None = None
    commits_secondary: DataFrame | None = None


@dataclass(frozen=True)
class Prepared:
    """Folder of prepared tables.

    With `buckets`, the tables every report joins on the author / user id
    (cleaned and merged users, yearly, first and merged commits) are written
    as external catalog tables bucketed by that id into the same number of
    buckets.  The per-user aggregation then needs no shuffle (the bucketed
    scan is already partitioned by id) and the commits x users sort-merge join
    shuffles neither side: the largest shuffle of every report is paid once,
    here.  Without a catalog entry for a table (e.g. a new session on an
    in-memory catalog) it is read as plain Parquet: same rows, just not
    co-located.

    A bucketed join is not shuffled, so a hot author's rows would all be joined
    by the task of its bucket.  Commit tables are therefore written in two
    parts: the bucketed table of the cold authors, and beside it, as plain
    files spread over many tasks, the rows of the hot authors.  `read` unites
    them under the column HOT, and joins treat them apart (`operators.skew`).
    The default (None) keeps salted, shuffled joins, and so does a table that
    is read as plain Parquet.
    """

    root: str
    buckets: int | None = None
    #: Tables that this run wrote (or that the caller vouches for); other folders under the root are never read.
    tables: frozenset[str] = frozenset()

    def having(self, *names: str) -> Prepared:
        return replace(self, tables=self.tables | set(names))

    def without(self, *names: str) -> Prepared:
        return replace(self, tables=self.tables - set(names))

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str) -> str:
        return f"collabstats_{hashlib.sha1(self.root.encode()).hexdigest()[:12]}_{name}"

    def bucketed(self, spark: SparkSession, name: str) -> bool:
        """Whether `read` finds the bucketed layout (a session may lack the catalog entry)."""
        return bool(self.buckets) and spark.catalog.tableExists(self.table(name))

    def write(self, df: DataFrame, name: str, key: str | None = None, year_col: str | None = None,
              hot: DataFrame | None = None) -> str:
        """Writes a table anew: `key` names the column of buckets, `year_col` that of folders, `hot` the keys set apart."""
        if self.buckets and key:
            if name in SPLIT_TABLES:
                marked = mark_hot(df, key, hot)
                df, apart = marked.where(~F.col(HOT)).drop(HOT), marked.where(F.col(HOT)).drop(HOT)
                apart = apart.repartition(self.buckets, *df.columns)   # a hot key's rows go to every task
                writer = apart.write.mode("overwrite")
                (writer.partitionBy(year_col) if year_col else writer).parquet(self.path(f"{name}_hot"))
            writer = df.repartition(self.buckets, key).write.mode("overwrite").option("path", self.path(name))
            if year_col:
                writer = writer.partitionBy(year_col)
            writer.bucketBy(self.buckets, key).saveAsTable(self.table(name))
            return self.path(name)
        return write_by_year(df, self.path(name), year_col, whole=True) if year_col else write_parquet(df, self.path(name))

    def rewrite(self, df: DataFrame, name: str, year_col: str, years: Sequence[int], key: str | None = None,
                hot: DataFrame | None = None) -> None:
        """Replaces the folders of these years alone, in the layout that `write` gave the table."""
        spark = df.sparkSession
        if not (self.buckets and key):
            write_by_year(df, self.path(name), year_col, years)
            return
        marked = mark_hot(df, key, hot)
        write_by_year(marked.where(F.col(HOT)).drop(HOT), self.path(f"{name}_hot"), year_col, years)
        cold, table = only_years(marked.where(~F.col(HOT)).drop(HOT), years, year_col), self.table(name)
        columns = spark.table(table).columns
        with settings(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
            # Years that get no rows end empty: their folders go, once the others are written.
            before = {y: files.matching(spark, f"{self.path(name)}/{year_col}={y}/*") for y in years}
            cold.select(*columns).repartition(self.buckets, key).write.insertInto(table, overwrite=True)
            for year, names in before.items():
                if names and files.matching(spark, f"{self.path(name)}/{year_col}={year}/*") == names:
                    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({year_col} = {year})")
                    files.remove(spark, f"{self.path(name)}/{year_col}={year}")

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        schema = PREPARED_SCHEMAS.get(name)
        plain = lambda path: spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
        apart = bool(self.buckets) and name in SPLIT_TABLES
        if self.bucketed(spark, name):
            table = spark.table(self.table(name))
            if not apart:
                return table
            hot = plain(self.path(f"{name}_hot")).select(*table.columns)
            return table.withColumn(HOT, F.lit(False)).unionByName(hot.withColumn(HOT, F.lit(True)))
        if schema is None:
            return scan(spark, self.path(name))
        # Known schema: no footer-reading job to infer it.
        return plain(self.path(name)).unionByName(plain(self.path(f"{name}_hot"))) if apart else plain(self.path(name))

    def years(self, spark: SparkSession, name: str, year_col: str) -> list[int]:
        """Years that the table has folders of."""
        parts = {self.path(name), self.path(f"{name}_hot")}
        found = {f.rpartition("=")[2] for p in parts for f in files.matching(spark, f"{p}/{year_col}=*", folders=True)}
        return sorted(int(y) for y in found if y.lstrip("-").isdigit())


#: Commit tables: a bucketed layout sets their hot authors' rows apart.
SPLIT_TABLES = ("commits_yearly", "commits_first", "commits_merged")

_HOT_SCHEMA = T.StructType([T.StructField("author_id", T.LongType()), T.StructField("salts", T.IntegerType())])
_BRANCH_YEARS_SCHEMA = T.StructType([T.StructField("branch", T.StringType()), T.StructField("branch_year", T.LongType())])
PREPARED_SCHEMAS = {
    "users_clean": USERS_CLEAN_SCHEMA,
    "users_clean_secondary": USERS_CLEAN_SCHEMA,
    "users_merged": USERS_CLEAN_SCHEMA,
    "commits_yearly": COMMITS_YEARLY_SCHEMA,
    "commits_first": COMMITS_FIRST_SCHEMA,
    "branch_years": _BRANCH_YEARS_SCHEMA,
    "first_added": COMMITS_FIRST_SCHEMA,
    "branches_added": _BRANCH_YEARS_SCHEMA,
    "commits_first_secondary": COMMITS_FIRST_SCHEMA,
    "commits_merged": COMMITS_FIRST_SCHEMA,
    "commits_added": COMMITS_FIRST_SCHEMA,
    "hot_authors": _HOT_SCHEMA,
    "hot_authors_merged": _HOT_SCHEMA,
}


def _user_bytes(users: DataFrame) -> DataFrame:
    """(author_id, bytes): no less than what any report's expansion of the user row holds."""
    def length(c: str):
        return F.coalesce(F.octet_length(c), F.lit(0)).cast("bigint") + 16

    def entries(c: str):
        return F.coalesce(F.size(F.split(c, ",")), F.lit(1)).cast("bigint")

    whole = (length("country_cleaned") * entries("sector") + length("sector") * entries("country_cleaned") + length("organization_cleaned")
             + 32 * entries("country_cleaned") * entries("sector"))
    return users.select(F.col("id").alias("author_id"), whole.alias("bytes"))


def _write_hot(spark: SparkSession, out: Prepared, name: str, pairs: DataFrame, users: str, hot_rows: int | None) -> DataFrame:
    """Authors with many (author, branch) pairs: salted in every report's join, or set apart in a bucketed layout."""
    hot = hot_keys(pairs, "author_id", hot_rows)
    if out.buckets:
        hot = within_bytes(hot, _user_bytes(out.read(spark, users)), "author_id")
    write_parquet(hot, out.path(name))
    return out.read(spark, name)


def prepare_primary(spark: SparkSession, raw: RawInputs, root: str | Prepared,
                    years=REPORT_YEARS, org_cols=ORG_COLUMNS_PRIMARY, hot_rows: int | None = None,
                    incremental: bool = False) -> Prepared:
    """First source: cleaned users; per (author, branch) the active years (one
    shuffle of the raw commits); from that table, without another shuffle of
    it, the hot authors, the yearly distinct commits (partitioned by year) and
    first participation.  Year ranges beyond the mask of `commit_years` take
    the distinct rows first and their minimum second.

    With `incremental`, first participation is partitioned by its year and the
    branches' first years are written, so `plans.incremental.add_year` can
    add or rewrite one year.
    """
    out = root if isinstance(root, Prepared) else Prepared(root)
    require_schema(raw.users, RAW_USERS_SCHEMA, "raw users")
    require_schema(raw.commits, RAW_COMMITS_SCHEMA, "raw commits")
    out.write(clean_users(raw.users, org_cols), "users_clean", key="id")
    if max(years) - min(years) + 1 <= MASK_YEARS:
        write_parquet(commit_years(raw.commits, years), out.path("commit_years"))
        bits = out.read(spark, "commit_years")
        yearly, first = years_to_rows(bits, years), first_year(bits, years)
    else:
        write_parquet(yearly_commits(raw.commits, years), out.path("commit_years"))
        yearly = out.read(spark, "commit_years")
        first = first_commits(yearly)
    hot = _write_hot(spark, out, "hot_authors", first, "users_clean", hot_rows)
    out.write(yearly, "commits_yearly", key="author_id", year_col="commit_year", hot=hot)
    out.write(first, "commits_first", key="author_id", year_col="min_commit_year" if incremental else None, hot=hot)
    # A new first source ends what was prepared from an earlier one.
    done = Prepared(out.root, out.buckets).having("users_clean", "commits_yearly", "commits_first", "hot_authors")
    if not incremental:
        return done
    out.write(branch_years(out.read(spark, "commits_first")), "branch_years", year_col="branch_year")
    return done.having("branch_years")


def prepare_secondary(spark: SparkSession, raw: RawInputs, prepared: Prepared, hot_rows: int | None = None) -> Prepared:
    """Second source: agency classification and cleaning of the second source, its first
    participation (>= first report year), and the merged tables (first source wins)."""
    users2 = raw.users_secondary
    require_schema(users2, RAW_USERS_SECONDARY_SCHEMA, "second-source users")
    require_schema(raw.commits_secondary, RAW_COMMITS_SECONDARY_SCHEMA, "second-source commits")
    write_parquet(clean_users(attach_agency(users2, classify_agency(users2)), ORG_COLUMNS_SECONDARY),
                  prepared.path("users_clean_secondary"))
    write_parquet(first_commits_secondary(raw.commits_secondary), prepared.path("commits_first_secondary"))
    prepared.write(merge_users(prepared.read(spark, "users_clean"), prepared.read(spark, "users_clean_secondary")),
                   "users_merged", key="id")
    # The pairs that the second source adds, written once: the merged table and its hot authors need no second anti-join.
    first = prepared.read(spark, "commits_first").drop(HOT)
    write_parquet(new_commits(first, prepared.read(spark, "commits_first_secondary")), prepared.path("commits_added"))
    merged = first.unionByName(prepared.read(spark, "commits_added"))
    hot = _write_hot(spark, prepared, "hot_authors_merged", merged, "users_merged", hot_rows)
    prepared.write(merged, "commits_merged", key="author_id", hot=hot)
    return prepared.having("users_clean_secondary", "commits_first_secondary", "users_merged", "commits_merged", "hot_authors_merged")


def _salting(spark: SparkSession, prepared: Prepared, commits: str) -> dict:
    """How reports join the given commits table: by the hot authors found during preparation, which are salted or,
    where the table is read bucketed, lie apart."""
    hot = "hot_authors_merged" if commits == "commits_merged" else "hot_authors"
    if prepared.bucketed(spark, commits) or hot in prepared.tables:
        return {"hot_rows": prepared.read(spark, hot)}
    return {}


def _agency_tables(prepared: Prepared) -> tuple[str, str]:
    """The agency reports use the merged tables of this run; without a second source, the first source's."""
    merged = {"commits_merged", "users_merged"} <= prepared.tables
    return ("commits_merged", "users_merged") if merged else ("commits_first", "users_clean")


def _branch_countries(spark: SparkSession, prepared: Prepared, year: int) -> DataFrame:
    return branch_countries(prepared.read(spark, "commits_yearly"), prepared.read(spark, "users_clean"), year,
                            commits_distinct=True, **_salting(spark, prepared, "commits_yearly"))


def _agency_counts(spark: SparkSession, prepared: Prepared) -> DataFrame:
    commits, users = _agency_tables(prepared)
    return agency_counts(branch_org_first_year(
        prepared.read(spark, commits), prepared.read(spark, users), **_salting(spark, prepared, commits)))


def prepare_reports(spark: SparkSession, prepared: Prepared, year: int) -> Prepared:
    """The joins that several reports share, written once: the year's countries per branch (C10 twice, C11) and
    the agencies' pairs per first year (C13, C14), whose few rows also tell the year columns;
    and the countries' credit by year, in which C17 looks for its top countries."""
    write_parquet(_branch_countries(spark, prepared, year), prepared.path(f"branch_countries_{year}"))
    write_parquet(_agency_counts(spark, prepared), prepared.path("agency_counts"))
    write_parquet(country_cube(prepared.read(spark, "commits_first"), prepared.read(spark, "users_clean"), commits_distinct=True,
                               **_salting(spark, prepared, "commits_first")), prepared.path("country_cube"))
    return prepared.having(f"branch_countries_{year}", "agency_counts", "country_cube")


def report_builders(spark: SparkSession, prepared: Prepared, year: int,
                    years=REPORT_YEARS) -> dict[str, Callable[[], DataFrame]]:
    """The eight report tables as zero-argument builders over the prepared tables.

    What `prepare_reports` wrote is read; otherwise the report computes it.
    """
    users = lambda: prepared.read(spark, "users_clean")
    first = lambda: prepared.read(spark, "commits_first")
    yearly = lambda: prepared.read(spark, "commits_yearly")

    def countries() -> DataFrame:
        name = f"branch_countries_{year}"
        return prepared.read(spark, name) if name in prepared.tables else _branch_countries(spark, prepared, year)

    def agencies() -> DataFrame:
        return prepared.read(spark, "agency_counts") if "agency_counts" in prepared.tables else _agency_counts(spark, prepared)

    y = {"commits_distinct": True, **_salting(spark, prepared, "commits_yearly")}
    h = _salting(spark, prepared, "commits_first")
    f = {"commits_distinct": True, **h}
    return {
        "collab_by_country": lambda: collaborations_of_branches(countries(), top_n=11),
        "collab_by_country_supp": lambda: collaborations_of_branches(countries(), top_n=51),
        "codeveloped_pairs": lambda: pairs_of_branches(countries()),
        "fractional_by_country": lambda: fractional_repos_by_country(yearly(), users(), year, **y),
        "top_institutions": lambda: top_institutions(first(), users(), **h),
        "sectors_by_year": lambda: new_repos_by_sector_year(first(), users(), years, **f),
        "countries_by_year": lambda: countries_of_cube(prepared.read(spark, "country_cube"), years) if "country_cube" in prepared.tables
        else new_repos_by_country_year(first(), users(), years, **f),
        "agency_new_by_year": lambda: agency_years_of(agencies()),
        "agency_totals": lambda: agency_totals_of(agencies()),
    }


def reports(spark: SparkSession, prepared: Prepared, year: int, years=REPORT_YEARS) -> dict[str, DataFrame]:
    """The eight report tables as lazy DataFrames over the prepared tables."""
    return {name: build() for name, build in report_builders(spark, prepared, year, years).items()}


def write_reports(tables: dict[str, DataFrame], root: str, fmt: str = "csv") -> dict[str, str]:
    """S6 for every report: display headers, one folder per report name."""
    written = {}
    for name, df in tables.items():
        kind = name.replace("_supp", "")
        order = [F.desc(c[1:]) if c.startswith("-") else c for c in REPORT_ORDER.get(kind, ["row_order"])]
        written[name] = write_report(df, root, name, DISPLAY_HEADERS.get(kind, {}), fmt, order)
    return written
