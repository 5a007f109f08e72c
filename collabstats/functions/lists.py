"""Column expressions for delimited multi-valued attributes.

Raw tables store lists as `|`-separated strings, cleaned tables as
`, `-separated strings, and every report splits on `,` and trims.  All helpers
return Column expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

RAW_DELIMITER = "|"
CLEAN_DELIMITER = ", "


def normalise_delimiter(col: str | Column) -> Column:
    """`|` -> `, ` as a literal replacement (F1)."""
    return F.replace(F.col(col) if isinstance(col, str) else col, F.lit(RAW_DELIMITER), F.lit(CLEAN_DELIMITER))


def merged_list(cols: Sequence[str | Column]) -> Column:
    """Concatenate several delimited columns into one `, ` list, deduplicated.

    concat_ws skips NULL inputs and yields '' when all are NULL (F2); split on
    `, ` (F3) keeps first-seen order through array_distinct (F5); the result is
    rejoined with `, ` (F6).
    """
    joined = F.concat_ws(CLEAN_DELIMITER, *[normalise_delimiter(c) for c in cols])
    return F.array_join(F.array_distinct(F.split(joined, CLEAN_DELIMITER)), CLEAN_DELIMITER)


def flag_labels(flags: Sequence[str]) -> Column:
    """`CASE WHEN flag = 1 THEN 'flag' END` for each flag, joined with `, `.

    The flag labels are distinct by construction, so the split/distinct/join
    round trip of the cleaned lists is the identity here.
    """
    return F.concat_ws(CLEAN_DELIMITER, *[F.when(F.col(f) == 1, F.lit(f)) for f in flags])


def split_list(col: str | Column) -> Column:
    """`string_split(x, ',')` (F4); NULL input gives an empty list, not NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.split(c, ","), F.array().cast("array<string>"))


def label_missing(col: str | Column, label: str) -> Column:
    """`ifelse(is.na(x) | x == "", label, x)`."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isNull() | (c == ""), F.lit(label)).otherwise(c)


def not_in_keep_null(col: str | Column, values: Sequence[str]) -> Column:
    """`!x %in% values` with R's NULL rule: a NULL value is kept."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(~c.isin(list(values)), F.lit(True))
