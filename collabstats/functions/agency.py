"""Agency classification as one searched CASE expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from collabstats.schemas import AGENCY_RULES


def agency_case(col: str | Column, rules: Sequence[tuple[str, str, bool]] = AGENCY_RULES) -> Column:
    """First matching rule wins; no match (or a NULL input) gives NULL.

    Each rule is (label, Java regex, ignore_case).  The chain is built from the
    rule list, so it compiles to a single codegen'd CASE WHEN.
    """
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for label, pattern, ignore_case in rules:
        cond = c.rlike(("(?i)" if ignore_case else "") + pattern)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(None).cast("string"))
