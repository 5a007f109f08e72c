"""Ranks without a task that sees every row: top n with ties (W4) by a threshold, and positions in a total order.

Both read their input several times - a score is looked for, then rows are compared with it - so the input should be a
written table or a cheap plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that one window numbers, most parts beyond that, and drawn keys for each of them.
PART_ROWS, PARTS, OVER = 100_000, 256, 32


def top_with_ties(scores: DataFrame, score: str, n: int) -> DataFrame:
    """The rows with `rank() <= n` by `score` from high to low; rows without a score are none of them.

    The n-th highest score comes from the best n rows of every task; rows are then compared with that one value,
    so however many tie with it, they stay where they are.
    """
    best = scores.where(F.col(score).isNotNull()).select(score).orderBy(F.desc(score)).limit(n)
    nth = best.agg(F.when(F.count(F.lit(1)) == n, F.min(score))).scalar()   # NULL: fewer than n rows, all of them rank
    return scores.where(F.col(score).isNotNull() & (nth.isNull() | (F.col(score) >= nth)))


def numbered(rows: DataFrame, order: Sequence[Column], out: str = "pos", limit: int = PART_ROWS) -> DataFrame:
    """`rows` with their position, from 1, in the ascending order of the `order` expressions, which tell all rows apart.

    Up to `limit` rows are numbered by one window.  More are parted: keys drawn by their hash, OVER for each part, give
    regular cuts; a row finds its part by comparing itself with few of them; parts are counted, and the window of a
    part starts at the count of those before.  The driver sees the rows' number, at most PARTS x OVER or so keys, and
    the parts' counts.
    """
    total = rows.count()
    if total <= limit:
        return rows.withColumn(out, F.row_number().over(Window.orderBy(*order)))
    names = [f"_k{i}" for i in range(len(order))]
    keyed = rows.withColumns(dict(zip(names, order)))
    parts = min(PARTS, -(-total // limit))
    drawn = F.pmod(F.xxhash64(*names), F.lit(max(1, total // (parts * OVER)))) == 0
    keys = sorted(tuple(r) for r in keyed.where(drawn).select(*names).collect())
    cuts = [keys[len(keys) * i // parts] for i in range(1, parts)] if keys else []
    dealt = keyed.withColumn("_part", _part(names, cuts, 0, len(cuts)))
    counts = dict(dealt.groupBy("_part").count().collect())
    starts, so_far = [], 0
    for part in range(len(cuts) + 1):
        starts.append(so_far)
        so_far += counts.get(part, 0)
    start = F.element_at(F.array(*[F.lit(s).cast("bigint") for s in starts]), F.col("_part") + 1)
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*names))
    return dealt.withColumn(out, own + start).select(*rows.columns, out)


def _part(names: Sequence[str], cuts: Sequence[tuple], first: int, last: int) -> Column:
    """How many of the sorted cuts come before the row or equal it, by halving."""
    if first == last:
        return F.lit(first)
    middle = (first + last) // 2
    before, equal = F.lit(False), F.lit(True)
    for name, value in zip(names, cuts[middle], strict=True):
        before = before | (equal & (F.col(name) < F.lit(value)))
        equal = equal & (F.col(name) == F.lit(value))
    return F.when(before, _part(names, cuts, first, middle)).otherwise(_part(names, cuts, middle + 1, last))
