"""Derive user and commit tables from the TPC-H-like test tables.

`customer ⋈ nation` plays the first-source users, `lineitem ⋈ orders` the raw
commits, `supplier` the second-source users and all of `lineitem` the
second-source commits.  Dates are shifted so commits fall in 2009-2015 and the
second source spans 2007-2013, for every fourth supplier 2019-2025.  The derivation is narrow per row except for the
two joins, which Spark plans as it likes (the nation side is a 25-row dimension).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from collabstats.schemas import US, US_LONG
from collabstats.sources.parquet import scan


# Fixture values: government organisations of the second source, in turn over the
# suppliers.  Each agency rule occurs, in upper and lower case where that decides,
# besides a missing and an unlisted organisation.
SECONDARY_ORGS = [
    "USDA Forest Service", "office of agriculture", "US National Weather Service", "us patent and trademark office",
    "USGS", "national park service", "Department of Defense", "department of defense", "Oak Ridge", "office of energy",
    "National Institutes of Health", "national institutes of health", "FEMA", "fema", "Bureau of Investigation", "unicor",
    "Bureau of Labor", "labor statistics", "NHTSA", "aviation office", "Department of Veterans Affairs",
    "environmental protection agency", "Federal Election Commission", "GSA", "gsa",
    "National Aeronautics and Space Administration", "US National Science Foundation", "us national science foundation",
    "OPM", "Social Security Administration", "US Department of State", "Dept of State", None, "City of Springfield",
]


def _tbl(spark: SparkSession, sf_dir: str, name: str, cols: list[str]) -> DataFrame:
    return scan(spark, f"{sf_dir}/{name}.parquet", cols)


def _mod(col: str, m: int) -> Column:
    return F.col(col) % F.lit(m)


def _null_str() -> Column:
    return F.lit(None).cast("string")


def _branch() -> Column:
    return F.concat(F.lit("repo_"), (F.col("l_partkey") * 10 + _mod("l_orderkey", 10)).cast("string"))


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _tbl(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey"])
    n = _tbl(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    k = "c_custkey"
    gov_org = (
        F.when(_mod(k, 3) != 0, _null_str())
        .when(_mod(k, 8) == 1, F.lit("Department of Energy"))
        .when(_mod(k, 8) == 3, F.lit("Department of Commerce|US NOAA Fisheries"))
        .when(_mod(k, 8) == 5, F.lit("USDA Forest Service"))
        .when(_mod(k, 8) == 7, F.lit("City of Springfield"))
        .otherwise(F.lit("Department of Labor"))
    )
    flag = lambda cond: F.when(cond, F.lit(1)).otherwise(F.lit(0))
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col(k).alias("id"),
        F.col("c_name").alias("login"),
        F.when(_mod(k, 11) == 0, _null_str())
        .when(F.col("n_nationkey") < 5, F.lit(US))
        .otherwise(F.col("n_name")).alias("country_location"),
        F.when(_mod(k, 7) == 0, F.lit("NATION_6|NATION_7")).alias("country_email"),
        F.when(_mod(k, 3) == 0, F.lit(US)).alias("country_government"),
        F.when(_mod(k, 13) == 0, F.lit("NATION_8")).alias("country_academic"),
        F.when(_mod(k, 2) == 0, F.concat(F.lit("Acme "), _mod(k, 17).cast("string"), F.lit(", Inc.")))
        .alias("organization_company_business"),
        F.when(_mod(k, 10) == 0, F.lit("Misc. Business")).alias("organization_email_business"),
        gov_org.alias("organization_company_government"),
        _null_str().alias("organization_email_government"),
        F.when(_mod(k, 5) == 0, F.concat(F.lit("University "), _mod(k, 23).cast("string")))
        .alias("organization_company_academic"),
        F.when(_mod(k, 25) == 0, F.lit("Misc. Academic")).alias("organization_email_academic"),
        F.when(_mod(k, 19) == 0, F.lit("Apache Foundation")).alias("organization_company_nonprofit"),
        _null_str().alias("organization_email_nonprofit"),
        _null_str().alias("organization"),
        F.when(_mod(k, 3) != 0, _null_str())
        .when(_mod(k, 8) == 5, F.lit("Department of Agriculture")).alias("new_agencies"),
        flag((_mod(k, 19) == 0) | (_mod(k, 17) == 0)).alias("nonprofit"),
        flag(_mod(k, 3) == 0).alias("government"),
        flag((_mod(k, 2) == 0) | (_mod(k, 9) == 0)).alias("business"),
        flag(_mod(k, 5) == 0).alias("academic"),
    )


def raw_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _tbl(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_linenumber"])
    o = _tbl(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    cust = F.col("o_custkey")
    authors = (
        F.when(F.col("l_linenumber") == 2, F.array(cust, cust + 1))
        .when(F.col("l_linenumber") == 3, F.array(cust, F.lit(900000) + cust % 50))
        .otherwise(F.array(cust))
    )
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        _branch().alias("branch"),
        authors.alias("authors_id"),
        (F.col("o_orderdate") + F.expr("INTERVAL 14 YEARS")).alias("committedat"),
    )


def raw_users_secondary(spark: SparkSession, sf_dir: str) -> DataFrame:
    from collabstats.schemas import COUNTRY_COLUMNS, ORG_COLUMNS_BASE

    s = _tbl(spark, sf_dir, "supplier", ["s_suppkey", "s_name"])
    k = "s_suppkey"
    given = {
        "id": F.when(_mod(k, 4) == 0, F.col(k)).otherwise(F.lit(1000000) + F.col(k)),
        "login": F.col("s_name"),
        "country_government": F.when(_mod(k, 5) == 0, F.lit(US_LONG)).otherwise(F.lit(US)),
        "organization_company_government": F.element_at(
            F.array(*map(F.lit, SECONDARY_ORGS)), (_mod(k, len(SECONDARY_ORGS)) + 1).cast("int")),
        "government": F.when(_mod(k, 7) == 6, F.lit(0)).otherwise(F.lit(1)),
    }
    cols = ["id", "login"] + COUNTRY_COLUMNS + ORG_COLUMNS_BASE + ["nonprofit", "government", "business", "academic"]
    out = []
    for name in cols:
        if name in given:
            out.append(given[name].alias(name))
        elif name in ("nonprofit", "business", "academic"):
            out.append(F.lit(0).alias(name))
        else:
            out.append(_null_str().alias(name))
    return s.select(*out)


def raw_commits_secondary(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _tbl(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_shipdate"])
    k = "l_suppkey"
    return li.select(
        F.when(_mod(k, 4) == 0, F.col(k)).otherwise(F.lit(1000000) + F.col(k)).alias("userid"),
        _branch().alias("repoid"),
        F.when(_mod(k, 4) == 3, F.col("l_shipdate") + F.expr("INTERVAL 24 YEARS"))
        .otherwise(F.col("l_shipdate") + F.expr("INTERVAL 12 YEARS")).alias("commityear"),
    )
