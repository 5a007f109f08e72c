"""Parquet sources (S1-S3) and the preview helper."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from collabstats.schemas import REPORT_YEARS
from collabstats.sources import files


class MissingColumnsError(ValueError):
    pass


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "table") -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumnsError(f"{what} lacks columns {missing}; has {df.columns}")
    return df


def scan(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Scan one Parquet file or folder, checking the expected columns.

    Only the requested columns are selected, so the scan's ReadSchema is pruned
    to them; filters applied later are pushed into the scan by Catalyst.
    """
    df = spark.read.parquet(path)
    if columns:
        require_columns(df, columns, path)
        df = df.select(*columns)
    return df


def require_schema(df: DataFrame, schema: T.StructType, what: str = "table") -> DataFrame:
    """`df` after a check at the edge: every field of `schema` is there, with its kind of type
    (integers of any width, timestamps with or without time zone)."""
    require_columns(df, schema.fieldNames(), what)

    def kind(dtype: T.DataType) -> object:
        if isinstance(dtype, T.ArrayType):
            return ("array", kind(dtype.elementType))
        if isinstance(dtype, T.IntegralType):
            return "integer"
        if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            return "time"
        return dtype.typeName()

    wrong = {f.name: df.schema[f.name].dataType.simpleString() for f in schema.fields
             if kind(df.schema[f.name].dataType) != kind(f.dataType)}
    if wrong:
        raise TypeError(f"{what} has columns of another type: {wrong}")
    return df


class SchemaDriftError(TypeError):
    pass


_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def widened(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds values of both, None where there is none: integers of any width, floats of any width,
    and lists and structures of such."""
    if type(a) is type(b) and not isinstance(a, (T.ArrayType, T.StructType, T.DecimalType)):
        return a
    if isinstance(a, _INTEGERS) and isinstance(b, _INTEGERS):
        return max(a, b, key=lambda t: _INTEGERS.index(type(t)))
    if isinstance(a, (T.FloatType, T.DoubleType)) and isinstance(b, (T.FloatType, T.DoubleType)):
        return T.DoubleType()
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        element = widened(a.elementType, b.elementType)
        return element and T.ArrayType(element)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        both, clash = _union([("", a), ("", b)])
        return None if clash else both
    return a if a == b else None


def _union(schemas: Sequence[tuple[str, T.StructType]]) -> tuple[T.StructType, str | None]:
    """Every column of the schemas in order of first occurrence, widened; the first column that cannot be."""
    held: dict[str, T.DataType] = {}
    for _, schema in schemas:
        for field in schema.fields:
            kind = field.dataType if field.name not in held else widened(held[field.name], field.dataType)
            if kind is None:
                return T.StructType(), field.name
            held[field.name] = kind
    return T.StructType([T.StructField(n, k) for n, k in held.items()]), None


def _merged(spark: SparkSession, paths: Sequence[str]) -> T.StructType | None:
    """One schema of all files under the paths; None if Spark finds columns of different types.  A path without files has none."""
    try:
        return spark.read.option("mergeSchema", "true").option("pathGlobFilter", "*.parquet").parquet(*paths).schema
    except (PySparkException, Py4JJavaError) as e:
        if "UNABLE_TO_INFER_SCHEMA" in str(e):
            return T.StructType()
        if "CANNOT_MERGE_SCHEMAS" in str(e) or "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE" in str(e):
            return None
        raise


def schema_groups(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, T.StructType]]:
    """(first path, schema) of groups of paths whose files agree on the types of the columns that they share.

    Spark merges the footers of all paths in one job, in which tasks read them.  Only where types differ the paths are
    halved, down to single files: few groups take few jobs however many files there are.
    """
    schema = _merged(spark, paths)
    if schema is not None:
        return [(paths[0], schema)] if schema.fields else []
    if len(paths) == 1:
        return schema_groups(spark, files.matching(spark, f"{paths[0]}/*.parquet"))
    half = len(paths) // 2
    return schema_groups(spark, paths[:half]) + schema_groups(spark, paths[half:])


def _file_with(spark: SparkSession, paths: Sequence[str], column: str, wrong: T.DataType) -> str:
    """The first file that has the column in that type; asked only to name it in an error."""
    for path in paths:
        for file in [path] if path.endswith(".parquet") else files.matching(spark, f"{path}/*.parquet"):
            schema = spark.read.parquet(file).schema
            if column in schema.fieldNames() and schema[column].dataType == wrong:
                return file
    return paths[0]


def reconciled_schema(spark: SparkSession, paths: Sequence[str], expected: T.StructType | None = None) -> T.StructType:
    """The schema under which every file of the paths can be read whole.

    Columns of any file are in it; integers and floats take their widest form.  With `expected`, its columns take at
    least its types, and those that no file has are in it too.  A column of types that cannot meet is an error that
    names a file.
    """
    groups = schema_groups(spark, paths)
    if not groups:
        raise FileNotFoundError(f"no Parquet files under {', '.join(paths)}")
    if expected is not None:
        groups = [("the expected schema", expected), *groups]
    union, clash = _union(groups)
    if clash is None:
        return union
    kinds = {}
    for place, schema in groups:
        if clash in schema.fieldNames():
            kinds.setdefault(schema[clash].dataType.simpleString(), (place, schema[clash].dataType))
    told = [f"{name} in {place if place.startswith('the ') else _file_with(spark, paths, clash, kind)}" for name, (place, kind) in kinds.items()]
    raise SchemaDriftError(f"column {clash} has types that cannot meet: {'; '.join(told)}")


def _scan_folders(spark: SparkSession, folders: Sequence[str], expected: T.StructType | None) -> DataFrame:
    """One scan over all folders under their reconciled schema: the reader widens, and fills what a file lacks with NULL."""
    schema = reconciled_schema(spark, folders, expected)
    return spark.read.schema(schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "false").parquet(*folders)


def scan_glob(spark: SparkSession, root: str, expected: T.StructType | None = None) -> DataFrame:
    """Every `<root>/*/*.parquet`, whatever the folder name.

    Folders and files may differ: see `reconciled_schema`.
    """
    folders = files.matching(spark, f"{root}/[!_.]*", folders=True)
    if not folders:
        raise FileNotFoundError(f"no folders under {root}")
    return _scan_folders(spark, folders, expected)


def scan_year_folders(spark: SparkSession, root: str, years: Sequence[int] = REPORT_YEARS,
                      suffix: str = ".0", expected: T.StructType | None = None) -> DataFrame:
    """S3: the `.parquet` files under year folders `<root>/<year><suffix>/`.

    Folders that do not exist are passed over (the archive may lack a year),
    and files of another kind are left alone.  Years may differ in their
    columns: see `reconciled_schema`.
    """
    folders = files.matching(spark, f"{root}/{{{','.join(map(str, years))}}}{suffix}", folders=True)
    if not folders:
        raise FileNotFoundError(f"no year folders {years[0]}..{years[-1]} under {root}")
    return _scan_folders(spark, folders, expected)


def preview(df: DataFrame, n: int = 10, first: Sequence[str] = ("id", "author_id")) -> DataFrame:
    """The first n rows with the id columns first (a sampling feature)."""
    lead = [c for c in first if c in df.columns]
    rest = [c for c in df.columns if c not in lead]
    return df.select(*lead, *rest).limit(n)
