"""Report shaping: pivot years to columns (A13, O4), fixed row order (O3),
recoding (P15), label contributions and stacking blocks by name (U2).

These act on small aggregates (label x year), never on the large inputs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def year_sums(value_col: str | None, year_col: str, years: Sequence[int]) -> list[Column]:
    """One aggregate column per year, named "YYYY": the sum of `value_col`
    (or the row count when None) over rows of that year, 0 when there are none.

    Used inside a groupBy, this is the long -> wide pivot in a single
    aggregation, with the year columns fixed and ordered by the list.
    """
    cols = []
    for y in years:
        hit = F.col(year_col) == F.lit(y)
        if value_col is None:
            cols.append(F.count(F.when(hit, F.lit(1))).alias(str(y)))
        else:
            cols.append(F.sum(F.when(hit, F.col(value_col)).otherwise(F.lit(0.0))).alias(str(y)))
    return cols


def pivot_years(blocks: DataFrame, labels: str | Sequence[str], year_col: str, value_col: str | None,
                years: Sequence[int]) -> DataFrame:
    """Long (labels, year, value) -> wide, one column per year (0 when absent)."""
    keys = [labels] if isinstance(labels, str) else list(labels)
    return blocks.groupBy(*keys).agg(*year_sums(value_col, year_col, years))


def contributions(*pairs: tuple) -> Column:
    """Array of (label, row_order) structs: the report rows one input row adds to."""
    return F.array(*[
        F.struct((lbl if isinstance(lbl, Column) else F.lit(lbl)).alias("label"),
                 (pos if isinstance(pos, Column) else F.lit(pos)).cast("int").alias("row_order"))
        for lbl, pos in pairs
    ])


def order_rows(df: DataFrame, col: str, order: Sequence[str], out: str = "row_order") -> DataFrame:
    """Add an integer row order from a fixed list; values outside the list
    (NA in an R factor) sort last (T14)."""
    pos = F.array_position(F.array(*[F.lit(v) for v in order]), F.col(col))
    return df.withColumn(out, F.when(pos > 0, pos.cast("int")).otherwise(F.lit(len(order) + 1)))


def recode(col: Column, mapping: Mapping[str, str]) -> Column:
    """`dplyr::recode`: mapped values replaced, others unchanged."""
    lookup = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(lookup, col), col)


def stack_blocks(*blocks: DataFrame) -> DataFrame:
    """`bind_rows`: stack by column name; missing columns become NULL."""
    out = blocks[0]
    for b in blocks[1:]:
        out = out.unionByName(b, allowMissingColumns=True)
    return out
