"""Merging the two sources; the first source wins.

Each merge is one anti-join of the second source against the first one's keys.
Rows with a NULL key can never match: they stay out of the join (where they
would meet in one task) and are handled apart.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_users(primary: DataFrame, secondary: DataFrame, key: str = "id") -> DataFrame:
    """Primary ∪ secondary users whose id is not in primary (J6 + U1).

    `NOT IN (subquery)` plans as a null-aware broadcast anti-join of the whole
    primary id set, which cannot scale; a `left_anti` is hash-partitioned.
    NULL ids are dropped on both sides (trap T7; the SQL rule would instead
    empty the secondary part when the primary holds a NULL id).
    """
    known = primary.select(key).where(F.col(key).isNotNull())
    new = secondary.where(F.col(key).isNotNull()).join(known, on=key, how="left_anti")
    return primary.unionByName(new.select(*primary.columns))


def merge_commits(primary: DataFrame, secondary: DataFrame,
                  keys: tuple[str, ...] = ("author_id", "branch")) -> DataFrame:
    """Primary ∪ secondary pairs that are not in primary (J7 + U1).

    Correlated `NOT EXISTS` on two keys is one `left_anti` join on both: a
    single shuffle per side, in which a hot author is spread over its branches.
    A NULL key never matches, so such secondary rows are kept, exactly as NOT
    EXISTS keeps them.
    """
    return primary.unionByName(new_commits(primary, secondary, keys))


def new_commits(primary: DataFrame, secondary: DataFrame, keys: tuple[str, ...] = ("author_id", "branch")) -> DataFrame:
    """The part of C8 that the secondary source adds."""
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    known = primary.select(*keys).where(complete)
    new = secondary.where(complete).join(known, on=list(keys), how="left_anti").select(*primary.columns)
    return new.unionByName(secondary.where(~complete).select(*primary.columns))
