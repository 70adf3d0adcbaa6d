"""Content fingerprint of a table, independent of row order and partitioning."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.durable import durable, forget, kept
from plumbline.functions.expressions import number_text
from plumbline.schema import quoted

DIGITS = 8
PARTS = ("part_1", "part_2", "part_3", "part_4")
PART_TYPE = "decimal(38,0)"
#: New files that are read by their names; the names pass the driver.
LISTED_FILES = 10_000


def _field_text(df: DataFrame, name: str) -> Column:
    """A value as its length and text, so that no two rows of values run together; NULL is ``~``."""
    kind, column = df.schema[name].dataType, quoted(name)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        text = number_text(column.cast("double"))
    elif isinstance(kind, T.TimestampNTZType):
        text = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    elif isinstance(kind, T.TimestampType):
        # An instant: its text would change with the time zone of the session.
        text = F.unix_micros(column).cast("string")
    elif isinstance(kind, T.DateType):
        text = F.date_format(column, "yyyy-MM-dd")
    elif isinstance(kind, T.BinaryType):
        text = F.hex(column)
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        text = F.to_json(column)
    else:
        text = column.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~"))


def _sums(df: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``row_total`` and the sums of the slices of the row hashes, in all or per group; they add up."""
    row_hash = F.md5(F.concat(*[_field_text(df, name) for name in names]))
    hashed = df.select(*by, row_hash.alias("h"))
    sums = []
    for i, part in enumerate(PARTS):
        digits = F.substring("h", 1 + i * DIGITS, DIGITS)
        number = F.conv(digits, 16, 10).cast("decimal(20,0)")
        sums.append(F.coalesce(F.sum(number), F.lit(0)).cast(PART_TYPE).alias(part))
    return hashed.groupBy(*by).agg(F.count(F.lit(1)).alias("row_total"), *sums)


def _header(df: DataFrame, names: Sequence[str]) -> str:
    return "".join(f"{len(n)}:{n} {df.schema[n].dataType.simpleString()};" for n in names)


def _digest(sums: DataFrame, header: str, columns: int) -> DataFrame:
    """The fingerprint row of one row of sums."""
    parts = [F.col(part).cast("string") for part in PARTS]
    return sums.select(
        "row_total",
        F.lit(columns).cast("long").alias("column_total"),
        F.md5(F.concat_ws("-", F.lit(header), F.col("row_total").cast("string"), *parts)).alias("fingerprint"),
    )


def dataset_fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: row and column counts and a digest of names, types and contents.

    Contents enter as the sums of four 32-bit slices of each row hash. Sums are exact
    integers, so partial sums may be added in any order; equal tables give equal
    fingerprints and repeated rows count. One scan, no shuffle of rows.
    """
    names = list(columns or df.columns)
    return _digest(_sums(df, names), _header(df, names), len(names))


def _same_path(path: Column) -> Column:
    """A path as listings and as scans give it, in one form: slashes of the scheme and escapes differ."""
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(plain, "^([a-z0-9]+):/+", "$1:/")


def _listed(spark: SparkSession, path: str) -> DataFrame:
    """``file, location, length, modified`` of the data files of a table; none is opened."""
    found = spark.read.format("binaryFile").load(path)
    # A listing gives names without escapes, so a percent sign in one is a character.
    file = _same_path(F.replace("path", F.lit("%"), F.lit("%25")))
    return found.select(
        file.alias("file"), F.col("path").alias("location"), "length", F.unix_micros("modificationTime").alias("modified")
    )


def table_fingerprint(spark: SparkSession, path: str, manifest: str, listed: int = LISTED_FILES) -> DataFrame:
    """The `dataset_fingerprint` of the Parquet table at ``path``; only files not seen before are read.

    ``manifest`` is a folder of its own: a Parquet table of the sums of each file, known by its path, length and
    time of change. Files never seen, or changed, are hashed and appended; the fingerprint adds the
    sums of the files that are there now, so removed files need no work. Up to ``listed`` new files
    are read by name; with more, and always the first time, the table is read as a whole.
    Columns or types other than before start anew. Files must not change during a run.
    """
    df = spark.read.parquet(path)
    names, header = df.columns, _header(df, df.columns)
    held = f"file string, length bigint, modified bigint, header string, row_total bigint, {', '.join(f'{p} {PART_TYPE}' for p in PARTS)}"
    identity = ["file", "length", "modified"]
    # Files of a table, not rows: still a table, as there may be millions.
    here = durable(_listed(spark, path))

    def known() -> DataFrame:
        try:
            seen = spark.read.schema(held).parquet(manifest)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            seen = spark.createDataFrame([], held)
        # Two runs at a time may both have added a file, with equal sums.
        return seen.where(F.col("header") == header).drop("header").dropDuplicates(identity)

    unseen = here.join(known().select(*identity), identity, "left_anti")
    total, new = here.count(), unseen.count()
    if new:
        rows = df
        if new <= listed and new < total:
            # Names may hold characters that patterns use.
            paths = [re.sub(r"([{}\[\]*?\\])", r"\\\1", r["location"]) for r in unseen.select("location").collect()]
            rows = spark.read.schema(df.schema).option("basePath", path).parquet(*paths)
        # The file is a hidden column; its place in the row gets a name that no column has.
        file = next(n for n in ("file", *(f"file_{i}" for i in range(len(names) + 1))) if n not in names)
        rows = rows.withColumn(file, _same_path(F.col("_metadata.file_path")))
        sums = _sums(rows, names, [file]).withColumnRenamed(file, "file")
        # A file without rows has no sums, and is remembered as well.
        added = unseen.select(*identity).join(sums, "file", "left").withColumn("header", F.lit(header))
        zero = F.lit(0)
        added = added.withColumns({n: F.coalesce(n, zero) for n in ("row_total", *PARTS)})
        added.select(*[F.col(f.name).cast(f.dataType) for f in spark.createDataFrame([], held).schema]).write.mode("append").parquet(manifest)
    current = here.join(known(), identity).agg(
        F.coalesce(F.sum("row_total"), F.lit(0)).alias("row_total"),
        *[F.coalesce(F.sum(p), F.lit(0)).cast(PART_TYPE).alias(p) for p in PARTS],
    )
    # One row of numbers: held, so that the listing can go.
    found = kept(_digest(current, header, len(names)), 1)
    forget(here)
    return found
