"""Skew-safe equi-join of a large fact side to a small per-key side.

Every report joins commits (many rows per author, and one bot may hold a
third of them) to a user-derived table (a few rows per id).  A plain
hash-partitioned join would send all rows of a hot author to one task.  Here
hot keys are salted explicitly:

* hot keys = the heaviest keys with at least `hot_rows` rows on the large
  side, found by a partially aggregated count and a distributed top-k.  The
  set holds at most HOT_KEYS rows whatever the data, so it may be broadcast; a
  key beyond it holds less than 1 / HOT_KEYS of all rows and needs no split.
  Each hot key gets ceil(rows / hot_rows) salts, without a ceiling, so its
  pieces stay at about `hot_rows` rows however large it is;
* large side: rows of a hot key get salt pmod(xxhash64(salt_cols), salts) -
  deterministic, so a retried task produces the same rows - others salt 0;
* small side: rows of a hot key are replicated once per salt value (a few
  user rows times its salt count);
* join on (key, salt): both join inputs are ordinary shuffles, so AQE's own
  skew splitting applies too.

Rows are neither dropped nor duplicated: each large-side row meets exactly the
small-side rows of its key (through the one replica with its salt).

`hot_rows=0` declares that no key is hot and plans a plain join.

`tasks` - `tasks_for` of a written large side - deals its rows to that many
tasks.  Without it AQE unites shuffle partitions by their compressed bytes,
which for these short, repetitive rows means millions of rows in a task: what
a task sorts and aggregates then grows with the input.

Tables bucketed by the key carry the column HOT instead of salts, which would
undo their co-location: their hot rows were set apart when they were written.
The cold rows then join without a shuffle, the hot rows by a broadcast of the
small side's rows of the hot keys, whose number and bytes were bounded when
the hot set was made (`hot_keys`, `within_bytes`); a union follows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000   # rows per key beyond which a key is split, and rows per piece
HOT_BYTES = 64 << 20   # bytes of the small side's rows that may be broadcast for hot keys
HOT = "hot_author"     # column of a large side whose hot rows lie apart: whether the row is one of them
HOT_KEYS = 10_000      # size bound of the hot set: a key outside it has at most 1 / HOT_KEYS of the rows
TASK_ROWS = 500_000    # rows of a large side that one task of its join gets
TASKS = 20_000         # tasks of one join at most; beyond TASK_ROWS x TASKS rows each gets more


def hot_keys(large: DataFrame, key: str, hot_rows: int | None = None) -> DataFrame:
    """(key, salts) of the at most HOT_KEYS heaviest keys with at least
    `hot_rows` rows, with salts = ceil(rows / hot_rows), at least 2."""
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    salts = F.greatest(F.ceil(F.col("_rows") / F.lit(hot_rows)).cast("int"), F.lit(2))
    return (
        large.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") >= hot_rows)
        .orderBy(F.desc("_rows"), key).limit(HOT_KEYS)
        .select(key, salts.alias("salts"))
    )


def branch_key() -> Column:
    """`_branch`: the branch as a key that is not NULL; a NULL branch is a branch of its own."""
    return F.when(F.col("branch").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col("branch"))).alias("_branch")


def tasks_for(table: DataFrame) -> int | None:
    """Tasks of at most about TASK_ROWS rows for a join whose large side is `table`, a written one: Parquet's footers
    tell its rows.  None - as many as the session plans - if one such task would do."""
    rows = table.count()
    if rows <= TASK_ROWS:
        return None
    return min(TASKS, max(-(-rows // TASK_ROWS), table.sparkSession.sparkContext.defaultParallelism))


def within_bytes(hot: DataFrame, sizes: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """The heaviest of the `hot` keys whose rows of the small side - `sizes` has (key, bytes) - together take at most
    `limit` bytes (default HOT_BYTES).  The window sees at most HOT_KEYS rows."""
    limit = HOT_BYTES if limit is None else limit
    per_key = sizes.join(F.broadcast(hot.select(key)), key, "left_semi").groupBy(key).agg(F.sum("bytes").alias("_bytes"))
    so_far = Window.orderBy(F.desc("salts"), key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        hot.join(per_key, key, "left").withColumn("_sum", F.sum(F.coalesce("_bytes", F.lit(0))).over(so_far))
        .where(F.col("_sum") <= limit).select(key, "salts")
    )


def mark_hot(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """`df` with HOT; `hot` has at most HOT_KEYS rows."""
    flags = F.broadcast(hot.select(key, F.lit(True).alias(HOT)))
    return df.join(flags, key, "left").select(*df.columns, F.coalesce(HOT, F.lit(False)).alias(HOT))


def keep(df: DataFrame, *columns) -> DataFrame:
    """The columns of `df`, and HOT where the table has it."""
    return df.select(*columns, *([HOT] if HOT in df.columns else []))


def split_join(large: DataFrame, small: DataFrame, key: str, how: str, hot: DataFrame) -> DataFrame:
    """Join of a large side with HOT: each row meets exactly the small side's rows of its key, in one of two joins."""
    cold = large.where(~F.col(HOT)).drop(HOT).join(small, on=key, how=how)
    few = small.join(F.broadcast(hot.select(key)), key, "left_semi")
    apart = large.where(F.col(HOT)).drop(HOT).join(F.broadcast(few), on=key, how=how)
    return cold.unionByName(apart)


def skewed_join(large: DataFrame, small: DataFrame, key: str, how: str, salt_cols: Sequence[str],
                hot_rows: int | DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """`hot_rows`: threshold (default HOT_ROWS), 0 for a plain join, or a
    DataFrame of `hot_keys` computed beforehand (e.g. during preparation).
    A large side with HOT needs the hot set that it was written with, and is
    not dealt to `tasks`: it lies in its buckets."""
    if HOT in large.columns:
        if isinstance(hot_rows, DataFrame):
            return split_join(large, small, key, how, hot_rows)
        large = large.drop(HOT)
    if isinstance(hot_rows, DataFrame):
        hot = hot_rows.select(key, "salts")
    elif hot_rows == 0:   # caller guarantees no hot keys (e.g. inputs bucketed by the key)
        return (large.repartition(tasks, key) if tasks else large).join(small, on=key, how=how)
    else:
        hot = hot_keys(large, key, hot_rows)
    hot = F.broadcast(hot.select(key, F.col("salts").alias("_salts")))   # at most HOT_KEYS rows
    is_hot = F.col("_salts").isNotNull()
    large_s = large.join(hot, on=key, how="left").select(
        *large.columns,
        F.when(is_hot, F.pmod(F.xxhash64(*salt_cols), F.col("_salts").cast("long"))).otherwise(F.lit(0)).alias("_salt"),
    )
    if tasks:
        large_s = large_s.repartition(tasks, key, "_salt")
    small_s = small.join(hot, on=key, how="left").select(
        *small.columns,
        F.explode(F.when(is_hot, F.sequence(F.lit(0), F.col("_salts") - 1)).otherwise(F.array(F.lit(0)))).alias("_salt"),
    )
    return large_s.join(small_s, on=[key, "_salt"], how=how).drop("_salt")
