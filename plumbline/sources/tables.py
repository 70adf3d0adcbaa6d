"""Scans and sinks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.expressions import finite
from plumbline.schema import SemanticSchema, quoted, require_columns


def with_missing_as_null(df: DataFrame) -> DataFrame:
    """One notion of missing: NaN and infinities in floating columns become NULL."""
    return df.select(
        *[
            finite(quoted(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else quoted(f.name)
            for f in df.schema.fields
        ]
    )


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Delimited files with a header. A declared schema avoids the extra inference scan."""
    reader = spark.read.option("header", True).option("enforceSchema", False)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return with_missing_as_null(reader.csv(path))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return with_missing_as_null(spark.read.parquet(path))


def read_first(
    spark: SparkSession,
    candidates: Sequence[str],
    reader: Callable[[SparkSession, str], DataFrame] = read_parquet,
) -> DataFrame:
    """The first candidate path that exists; an error naming all of them if none does."""
    for path in candidates:
        try:
            return reader(spark, path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError("No input found at: " + ", ".join(candidates))


def given_or(table: DataFrame | None, compute: Callable[[], DataFrame]) -> DataFrame:
    """An upstream result if there is one and it has rows, else the computed one."""
    if table is not None and not table.isEmpty():
        return table
    return compute()


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    row_key: Sequence[str] = (),
) -> None:
    """Write a result; ``row_key`` names the columns that must stay with every row."""
    require_columns(df, [*partition_by, *row_key], "writing")
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def land_raw(df: DataFrame, path: str) -> DataFrame:
    """Keep an untouched copy of the input and continue from it."""
    write_table(df, path)
    return df.sparkSession.read.parquet(path)


def feature_name_table(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """Ordered model columns as a table."""
    return spark.createDataFrame(
        [(i, name) for i, name in enumerate(names, start=1)], "position int, feature_name string"
    )


def read_feature_names(spark: SparkSession, path: str) -> list[str]:
    rows = spark.read.parquet(path).orderBy("position").collect()
    return [row["feature_name"] for row in rows]


def aligned_type(rule) -> str:
    """Storage type a schema column is brought to."""
    if rule.storage == "string":
        return "string"
    return "bigint" if rule.whole_number else "double"


def aligned(rule, source: Column) -> Column:
    """A value in the storage type of its rule; NULL if it does not fit, never another number."""
    if rule.storage == "string":
        return F.trim(source.cast("string"))
    number = finite(source.try_cast("double"))
    if not rule.whole_number:
        return number
    return F.when(F.rint(number) == number, number.try_cast("bigint"))


def schema_clean(df: DataFrame, schema: SemanticSchema, keep: Sequence[str] = ()) -> DataFrame:
    """Only the schema columns, in schema order, in their declared types.

    Values that do not convert become NULL, among them fractions in columns of whole numbers,
    and the audit counts them. Text is trimmed, NULLs stay, no row is dropped. A projection
    only: no shuffle.
    """
    require_columns(df, [*keep, *schema.names], "schema cleaning")
    cleaned = [aligned(rule, quoted(rule.name)).alias(rule.name) for rule in schema.rules]
    return df.select(*[quoted(name) for name in keep], *cleaned)
