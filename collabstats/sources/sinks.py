"""Sinks: Parquet tables (S4), per-year partitioned output (S5) and named
report tables with display headers (S6)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from collabstats.sources import files


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """`COPY (query) TO file (FORMAT PARQUET)`."""
    df.write.mode(mode).parquet(path)
    return path


def only_years(df: DataFrame, years: Sequence[int], year_col: str) -> DataFrame:
    """`df`, whose rows fail if they belong to none of the years."""
    year = F.col(year_col)
    outside = F.concat(F.lit(f"{year_col} outside {min(years)}..{max(years)}: "), F.coalesce(year.cast("string"), F.lit("none")))
    inside = F.coalesce(year.isin(list(years)), F.lit(False))
    kind = df.schema[year_col].dataType
    return df.withColumn(year_col, F.when(inside, year).otherwise(F.raise_error(outside).cast(kind)))


def write_by_year(df: DataFrame, path: str, year_col: str = "commit_year", years: Sequence[int] | None = None,
                  whole: bool = False, max_records_per_file: int = 50_000_000) -> str:
    """One output per year in a single job (instead of one query per year).

    The rows are rebalanced by the year first, so a year's rows meet in few
    tasks - as many as its size asks for, AQE splits large years - instead of
    every task writing a small file for every year.  Files are capped at
    `max_records_per_file`.  Readers prune folders by `year_col = y`.

    A year's folder is its own: only the years that are written are replaced,
    and only once all of them are written (dynamic partition overwrite), so a
    job that fails leaves every old year.  `years` names the years that this
    write stands for: a row of another year fails the write, and a named year
    without rows ends empty.  `whole=True` replaces the entire table instead.
    """
    spark, before = df.sparkSession, {}
    if years is not None:
        df = only_years(df, years, year_col)
        before = {y: files.matching(spark, f"{path}/{year_col}={y}/*") for y in years}
    df.hint("rebalance", year_col).write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file) \
        .option("partitionOverwriteMode", "static" if whole else "dynamic").partitionBy(year_col).parquet(path)
    for year, names in before.items():
        if files.matching(spark, f"{path}/{year_col}={year}/*") == names:   # no file of this write: the year has no rows
            files.remove(spark, f"{path}/{year_col}={year}")
    return path


def write_report(df: DataFrame | None, root: str | None, name: str,
                 headers: Mapping[str, str] | None = None, fmt: str = "csv",
                 order: Sequence[Column | str] = ("row_order",)) -> str | None:
    """Write a result table under a sheet-like name with display headers.

    Other reports under `root` are left alone.  `root=None` skips writing (the
    reference's `output_file = NULL`).  Report tables are bounded by their label
    domains (countries, agencies, sectors), so they are written as one file,
    sorted by those of `order` that the table has; the helper column
    `row_order` orders the rows and is not part of the report.

    The finished rows are exchanged into one task, so the aggregation before
    keeps its own parallelism.  The report is written under a hidden name and
    takes the place of an older one only when it is complete: a job that
    fails leaves the older report as it was.
    """
    if root is None or df is None:
        return None
    spark, headers = df.sparkSession, dict(headers or {})
    one = df.repartition(1)
    by = [c for c in order if not isinstance(c, str) or c in df.columns]
    out = (one.sortWithinPartitions(*by) if by else one).drop("row_order")
    out = out.toDF(*[headers.get(c, c) for c in out.columns])
    path = f"{root}/{name}"
    staged = files.staging(path)
    try:
        if fmt == "csv":
            out.write.option("header", True).csv(staged)
        else:
            out.write.parquet(staged)
        files.put(spark, staged, path)
    finally:
        files.remove(spark, staged)
    return path
