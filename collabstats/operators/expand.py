"""Row generators over the delimited user lists (C9: E2, E3, E4).

All three are Generate nodes over the users scan: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from collabstats.functions.lists import label_missing, split_list
from collabstats.sources.parquet import require_columns
from collabstats.schemas import MISSING, MISSING_COUNTRY, UNCLASSIFIED


def expand_countries(users: DataFrame, missing: str = MISSING_COUNTRY, out: str = "country") -> DataFrame:
    """(id, country) - split on `,`, one row per member, trimmed, blank -> label.

    A user with no country has `country_cleaned = ''` and so yields one row
    with the label (trap T4).
    """
    require_columns(users, ["id", "country_cleaned"], "users")
    return (
        users.select("id", F.explode(split_list("country_cleaned")).alias("_c"))
        .select("id", label_missing(F.trim("_c"), missing).alias(out))
    )


def expand_aligned(users: DataFrame) -> DataFrame:
    """(id, org, country, sector) - the three lists unnested side by side.

    Row i pairs the i-th members; shorter lists are padded with NULL (as
    `arrays_zip` does).  Each list is coalesced to an empty array so one NULL
    list does not drop the user (trap T3).  Values are trimmed, not labelled.
    """
    require_columns(users, ["id", "organization_cleaned", "country_cleaned", "sector"], "users")
    zipped = F.arrays_zip(
        split_list("organization_cleaned").alias("org"),
        split_list("country_cleaned").alias("country"),
        split_list("sector").alias("sector"),
    )
    return (
        users.select("id", F.inline(zipped))
        .select("id", F.trim("org").alias("org"), F.trim("country").alias("country"), F.trim("sector").alias("sector"))
    )


def expand_country_sector(users: DataFrame, missing: str = MISSING, unclassified: str = UNCLASSIFIED) -> DataFrame:
    """(id, country_val, sector_val) - country and sector unnested in
    separate steps, i.e. their cross product per user."""
    require_columns(users, ["id", "country_cleaned", "sector"], "users")
    return (
        users.select(
            "id",
            F.explode(split_list("country_cleaned")).alias("_c"),
            split_list("sector").alias("_sl"),
        )
        .select("id", "_c", F.explode("_sl").alias("_s"))
        .select(
            "id",
            label_missing(F.trim("_c"), missing).alias("country_val"),
            label_missing(F.trim("_s"), unclassified).alias("sector_val"),
        )
    )
