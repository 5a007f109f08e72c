"""User cleaning (C1) and agency classification of the second source.

All three are narrow per-row transformations except C3's left join on `login`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from collabstats.functions.agency import agency_case
from collabstats.functions.lists import flag_labels, merged_list
from collabstats.operators.skew import skewed_join
from collabstats.schemas import (
    AGENCY_RULES,
    COUNTRY_COLUMNS,
    ORG_COLUMNS_PRIMARY,
    SECTOR_FLAGS,
    US,
    US_LONG,
)
from collabstats.sources.parquet import require_columns


def clean_users(raw: DataFrame, org_cols: Sequence[str] = ORG_COLUMNS_PRIMARY,
                country_cols: Sequence[str] = COUNTRY_COLUMNS) -> DataFrame:
    """One row per raw user with `, `-separated, deduplicated lists.

    Countries come from the four country columns, organisations from the
    organisation columns (with `Inc.` removed from the joined string, trap T2),
    sectors from the 0/1 flags in the order nonprofit, government, business,
    academic.  No shuffle: a projection over the scan.
    """
    require_columns(raw, ["id", "login", *country_cols, *org_cols, *SECTOR_FLAGS], "raw users")
    return raw.select(
        F.col("id").cast("bigint").alias("id"),
        F.col("login"),
        merged_list(country_cols).alias("country_cleaned"),
        F.replace(merged_list(org_cols), F.lit("Inc."), F.lit("")).alias("organization_cleaned"),
        flag_labels(SECTOR_FLAGS).alias("sector"),
    )


def classify_agency(users: DataFrame, rules=AGENCY_RULES, org_col: str = "organization_company_government",
                    country_col: str = "country_government") -> DataFrame:
    """(login, new_agencies, org_in_agency) for U.S. government users.

    Row filter (P17): an organisation plus `United States`, or the long
    spelling `United States of America` with or without one (`&` binds first).
    Then the ordered rule table on the government organisation (P13/F9).
    """
    require_columns(users, ["login", org_col, country_col], "users")
    org, country = F.col(org_col), F.col(country_col)
    keep = (org.isNotNull() & (country == US)) | (country == US_LONG)
    agency = agency_case(org_col, rules)
    return users.where(keep).select(
        "login",
        agency.alias("new_agencies"),
        agency.isNotNull().alias("org_in_agency"),
    )


def attach_agency(users: DataFrame, classes: DataFrame, hot_rows: int | DataFrame | None = None) -> DataFrame:
    """Government users (`government == 1`) left-joined to C2 on `login`.

    A login that occurs twice in `classes` multiplies the user's rows, as a
    left join does.  A NULL login matches nothing: such users stay out of the
    join, where they would all meet in one task.

    A login may be hot on both sides, where its rows multiply.  The classes
    are first counted by their values - a login has few, whatever its rows -
    so the users' side can be salted and that of the classes repeated for
    every salt; each joined row then comes out as often as its class occurred,
    in the tasks over which the users' rows are spread.
    """
    require_columns(users, ["login", "government"], "users")
    require_columns(classes, ["login", "new_agencies", "org_in_agency"], "agency classes")
    gov = users.where(F.col("government") == 1)
    named = F.col("login").isNotNull()
    columns = [*users.columns, "new_agencies", "org_in_agency"]
    counted = classes.where(named).groupBy("login", "new_agencies", "org_in_agency").agg(F.count(F.lit(1)).alias("_times"))
    joined = skewed_join(gov.where(named), counted, "login", "left", salt_cols=users.columns, hot_rows=hot_rows)
    nameless = gov.where(~named).select(
        *users.columns, F.lit(None).cast("string").alias("new_agencies"), F.lit(None).cast("boolean").alias("org_in_agency"))
    return repeated(joined, F.coalesce("_times", F.lit(1))).select(*columns).unionByName(nameless)


def repeated(df: DataFrame, times: Column, block: int = 1 << 16) -> DataFrame:
    """Every row as often as `times` says, with two short lists in memory instead of one of that length."""
    blocks = df.withColumn("_n", times).withColumn("_block", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / block).cast("int"))))
    return blocks.withColumn("_i", F.explode(F.sequence(F.lit(1), F.least(F.lit(block), F.col("_n") - F.col("_block") * block).cast("int"))))
