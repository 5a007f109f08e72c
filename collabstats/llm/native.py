"""Column helpers for work that must stay in Spark's own expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements summed at once by ``running``.
STEP = 64


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(values: Column, of: str) -> Column:
    """Running sum or maximum of an array of non-negative bigints; two levels, so far below quadratic work."""
    zero = F.lit(0).cast("bigint")

    def fold(part: Column) -> Column:
        return F.aggregate(part, zero, (lambda a, x: a + x) if of == "sum" else (lambda a, x: F.greatest(a, x)))

    def both(a: Column, b: Column) -> Column:
        return a + b if of == "sum" else F.greatest(a, b)

    def whole(v: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / STEP).cast("int")), lambda b: fold(F.slice(v, b * STEP + 1, F.lit(STEP))))
        return let(blocks, lambda s: let(
            F.transform(s, lambda _, b: fold(F.slice(s, F.lit(1), b))),
            lambda base: F.transform(v, lambda _, i: both(
                F.get(base, F.floor(i / STEP).cast("int")),
                fold(F.slice(v, F.floor(i / STEP).cast("int") * STEP + 1, i % STEP + 1))))))

    return let(values, lambda v: F.when(F.size(v) > 0, whole(v)).otherwise(F.array().cast("array<bigint>")))
