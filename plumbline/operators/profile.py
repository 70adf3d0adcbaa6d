"""Structural profile of a table: types, counts, frequencies, examples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.durable import durable, forget, kept
from plumbline.functions.joins import BROADCAST_ROWS
from plumbline.functions.expressions import is_whole, number_text, percentage, ratio
from plumbline.functions.moments import deviation, per_column
from plumbline.functions.quantiles import quantile_table
from plumbline.schema import SemanticSchema, numeric_columns, quoted, string_columns

# Fixed values of the profile flags.
LOW_CARDINALITY_VALUES = 20
LOW_CARDINALITY_RATIO = 0.05
IDENTIFIER_RATIO = 0.98
DATETIME_SHARE = 0.90
EXAMPLES = 5
MISSING_LABEL = "<MISSING>"
DATETIME_FORMATS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd", "MM/dd/yyyy")

WIDE_ROW_BYTES = 64
BROADCAST_HASHES = 4_000_000
#: Rows, first by key, in which examples are looked for before whole columns are.
EXAMPLE_ROWS = 1000


def _typed(df: DataFrame, name: str) -> tuple[Column, Column, Column]:
    """A value as (whole number, double, text): the one of its type, the others NULL."""
    column, kind = quoted(name), df.schema[name].dataType
    whole, number, text = F.lit(None).cast("long"), F.lit(None).cast("double"), F.lit(None).cast("string")
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        whole = column.cast("long")
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        # -0.0 and 0.0 are one value.
        number = F.when(column == 0, F.lit(0.0)).otherwise(column.cast("double"))
    else:
        text = column.cast("string")
    return whole, number, text


def value_frequencies(
    df: DataFrame, columns: Sequence[str] | None = None, row_key: str | None = None
) -> DataFrame:
    """``column_name, observed_value, frequency`` of every value of every column.

    One scan and one shuffle of the combined (column number, value) pairs, whatever the
    number of columns. Values are grouped in their own type and become text afterwards, where
    text is asked for; NULL is a value without ``present``. Distinct counts, frequencies,
    modes and examples all come from this table. With ``row_key`` it also holds the first
    key of each value.
    """
    names = list(columns or df.columns)
    cells = []
    for place, name in enumerate(names):
        whole, number, text = _typed(df, name)
        cells.append(F.struct(F.lit(place).alias("_c"), whole.alias("_w"), number.alias("_d"), text.alias("_t")))
    key = [quoted(row_key).alias("_key")] if row_key else []
    long = df.select(*key, F.inline(F.array(*cells)))
    measures = [F.count(F.lit(1)).alias("frequency")]
    if row_key:
        measures.append(F.min("_key").alias("first_key"))
    counted = long.groupBy("_c", "_w", "_d", "_t").agg(*measures)
    flags = [i for i, n in enumerate(names) if isinstance(df.schema[n].dataType, T.BooleanType)]
    whole = F.col("_w").cast("string")
    if flags:
        whole = F.when(F.col("_c").isin(flags), F.col("_w").cast("boolean").cast("string")).otherwise(whole)
    return counted.select(
        F.element_at(F.array(*[F.lit(n) for n in names]), F.col("_c") + 1).alias("column_name"),
        F.coalesce(whole, number_text(F.col("_d")), F.col("_t")).alias("observed_value"),
        (F.col("_w").isNotNull() | F.col("_d").isNotNull() | F.col("_t").isNotNull()).alias("present"),
        F.col("_d").alias("number"),
        "frequency",
        *(["first_key"] if row_key else []),
    )


def distinct_counts(frequencies: DataFrame) -> DataFrame:
    """Distinct non-missing values per column."""
    return frequencies.groupBy("column_name").agg(F.count_if("present").alias("unique_count"))


def unique_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column_name, unique_count``: exact distinct non-missing values of each column.

    Numbers are counted as they are, eight bytes each, all other values by a 64-bit hash of their text,
    so a nearly unique text column sends hashes, not texts. A hash that occurs once is one value.
    Only where hashes repeat are the texts behind them compared: few such hashes are broadcast
    and pick the rows, with many the column's texts are grouped.
    """
    names = list(columns or df.columns)
    cells, texts = [], {}
    for place, name in enumerate(names):
        whole, number, text = _typed(df, name)
        if not isinstance(df.schema[name].dataType, (T.IntegralType, T.BooleanType, T.DoubleType, T.FloatType)):
            texts[place] = text
            whole = F.when(text.isNotNull(), F.xxhash64(text))
        cells.append(F.struct(F.lit(place).alias("_c"), whole.alias("_w"), number.alias("_d")))
    coded = df.select(F.inline(F.array(*cells))).where("_w is not null or _d is not null")
    counted = coded.groupBy("_c", "_w", "_d").agg(F.count(F.lit(1)).alias("_n"))
    none = F.lit(None).cast("long")
    totals = counted.groupBy("_c").agg(F.count_if(F.col("_n") == 1).alias("_single"), F.count_if(F.col("_n") > 1).alias("_repeated"))
    repeated = counted.where(F.col("_c").isin(list(texts)) & (F.col("_n") > 1))
    # One query for both, so that the exchange below them is made once.
    found = durable(
        totals.select("_c", none.alias("_w"), "_single", "_repeated").unionByName(
            repeated.select("_c", "_w", none.alias("_single"), none.alias("_repeated"))
        )
    )
    known = {r["_c"]: r for r in found.where("_w is null").collect()}
    counts = {place: r["_single"] + r["_repeated"] for place, r in known.items() if place not in texts}
    few, many, held = [], [], 0
    for place in sorted((p for p in known if p in texts), key=lambda p: known[p]["_repeated"]):
        counts[place] = known[place]["_single"]
        held += known[place]["_repeated"]
        if known[place]["_repeated"]:
            (few if held <= BROADCAST_ROWS else many).append(place)
    for places in (few, many):
        if not places:
            continue
        values = [F.struct(F.lit(p).alias("_c"), F.xxhash64(texts[p]).alias("_w"), texts[p].alias("_t")) for p in places]
        rows = df.select(F.inline(F.array(*values))).where("_t is not null")
        if places is few:
            rows = rows.join(F.broadcast(found.where(F.col("_w").isNotNull() & F.col("_c").isin(few))), ["_c", "_w"], "left_semi")
        for r in rows.select("_c", "_t").distinct().groupBy("_c").count().collect():
            # Grouped whole, a column has all its values here, single ones included.
            counts[r["_c"]] = r["count"] + (counts[r["_c"]] if places is few else 0)
    forget(found)
    rows = [(name, counts.get(place, 0)) for place, name in enumerate(names)]
    return df.sparkSession.createDataFrame(rows, "column_name string, unique_count long")


def first_examples(df: DataFrame, row_key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """``column_name, example_values`` as `example_values` gives them, without counting whole columns.

    The first rows by key hold the first occurrences of what they hold. Columns that show enough
    values there are done; the others, which have few values or start with few, are counted.
    """
    names = list(columns or df.columns)
    held = df.select(*[quoted(n) for n in dict.fromkeys([row_key, *names])]).where(quoted(row_key).isNotNull())
    first = kept(held.orderBy(quoted(row_key)).limit(EXAMPLE_ROWS), EXAMPLE_ROWS)
    seen = value_frequencies(first, names, row_key=row_key).where("present")
    shown = distinct_counts(seen).join(example_values(seen), "column_name").where(F.col("unique_count") >= EXAMPLES)
    found = kept(shown.select("column_name", "example_values"))
    enough = {r["column_name"] for r in found.collect()}
    rest = [n for n in names if n not in enough]
    return found.unionByName(example_values(value_frequencies(df, rest, row_key=row_key))) if rest else found


def distinct_with_examples(df: DataFrame, row_key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct counts and examples of the columns; one row per column of the schema."""
    return unique_counts(df, columns).join(F.broadcast(first_examples(df, row_key, columns)), "column_name", "left")


def example_values(frequencies: DataFrame, limit: int = EXAMPLES) -> DataFrame:
    """First distinct values of each column in row order, joined with `` | ``.

    ``row_number() <= limit`` lets Spark keep only ``limit`` candidates per column in
    every task before the shuffle.
    """
    order = Window.partitionBy("column_name").orderBy("first_key", "observed_value")
    first = (
        frequencies.where("present").withColumn("place", F.row_number().over(order)).where(F.col("place") <= limit)
    )
    ordered = F.sort_array(F.collect_list(F.struct("place", "observed_value")))
    return first.groupBy("column_name").agg(
        F.array_join(F.transform(ordered, lambda x: x["observed_value"]), " | ").alias("example_values")
    )


def duplicate_rows(df: DataFrame, by_hash: bool | None = None, limit: int = BROADCAST_HASHES) -> DataFrame:
    """Rows beyond the first of each set of equal rows; NULL equals NULL.

    Wide rows are never shuffled: a 64-bit hash of each is counted first, and only rows whose
    hash occurs more than once are compared, by the SHA-256 of all their values. Up to ``limit``
    such hashes are broadcast and pick the rows; with more, every row sends its digest. Narrow
    rows are grouped as they are.
    """
    if by_hash is None:
        by_hash = sum(_width(f.dataType) for f in df.schema.fields) > WIDE_ROW_BYTES
    keys, suspects = [quoted(c) for c in df.columns], df
    if by_hash:
        hashed = df.withColumn("_h", F.xxhash64(*keys))
        # Written before the join is planned, so that its size is known.
        repeated = durable(hashed.groupBy("_h").count().where("count > 1").select("_h"))
        if repeated.count() <= limit:
            suspects = hashed.join(F.broadcast(repeated), "_h", "left_semi").drop("_h")
        keys = [F.unhex(F.sha2(_row_text(df), 256)).alias("_digest")]
    counted = suspects.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    return counted.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"))


def _row_text(df: DataFrame) -> Column:
    """All values of a row as one text that no other row has: each with its length, a gap as ``~``."""
    fields = []
    for name in df.columns:
        whole, number, text = _typed(df, name)
        value = F.coalesce(whole.cast("string"), number.cast("string"), text)
        fields.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("~")))
    return F.concat(*fields)


def _width(kind: T.DataType) -> int:
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return 20
    return 4 if isinstance(kind, (T.IntegerType, T.FloatType, T.DateType)) else 8


def null_counts(df: DataFrame) -> DataFrame:
    """``position, column_name, row_total, missing_count`` in one aggregation."""
    return per_column(
        df,
        df.columns,
        lambda name: {
            "row_total": F.count(F.lit(1)),
            "missing_count": F.count_if(quoted(name).isNull()),
        },
        label="column_name",
    )


def missing_table(df: DataFrame) -> DataFrame:
    """Missing count and percentage of every column, most affected first."""
    return (
        null_counts(df)
        .select(
            F.col("column_name").alias("feature"),
            "missing_count",
            F.round(percentage(F.col("missing_count"), F.col("row_total")), 2).alias("missing_percentage"),
        )
        .orderBy(F.desc("missing_count"), "feature")
    )


def missing_summary(df: DataFrame, schema: SemanticSchema) -> DataFrame:
    """Columns with gaps, with what the schema says about them."""
    declared = schema.to_frame(df.sparkSession)
    gaps = null_counts(df).where("missing_count > 0").withColumn(
        "missing_percentage", percentage(F.col("missing_count"), F.col("row_total"))
    )
    return gaps.join(declared.drop("position"), "column_name", "left").select(
        "column_name",
        "missing_count",
        "missing_percentage",
        F.coalesce("nullable_in_schema", F.lit(False)).alias("nullable_in_schema"),
        F.coalesce("documented_treatment", F.lit("")).alias("documented_treatment"),
    )


def dataset_summary(df: DataFrame, schema: SemanticSchema, label: str = "Training") -> DataFrame:
    """Size, predictor kinds, gaps and duplicates of a table in one row."""
    gaps = null_counts(df).agg(
        F.max("row_total").alias("observations"),
        F.sum("missing_count").alias("total_missing_values"),
        F.count_if(F.col("missing_count") > 0).alias("variables_with_missing_values"),
    )
    return gaps.withColumn("duplicate_rows", duplicate_rows(df).scalar()).select(
        F.lit(label).alias("dataset"),
        "observations",
        F.lit(len(df.columns)).alias("variables"),
        F.lit(len(schema.numerical)).alias("numerical_predictors"),
        F.lit(len(schema.categorical)).alias("categorical_predictors"),
        F.lit(schema.target).alias("target_column"),
        "total_missing_values",
        "variables_with_missing_values",
        "duplicate_rows",
        percentage(F.col("duplicate_rows"), F.col("observations")).alias("duplicate_percentage"),
    )


def looks_like_datetime(value: Column, formats: Sequence[str] = DATETIME_FORMATS) -> Column:
    """True where a text reads as a date or time in one of the formats."""
    attempts = [F.try_to_timestamp(value, F.lit(fmt)).isNotNull() for fmt in formats]
    found = attempts[0]
    for attempt in attempts[1:]:
        found = found | attempt
    return found


def datetime_candidates(
    df: DataFrame, formats: Sequence[str] = DATETIME_FORMATS, columns: Sequence[str] | None = None
) -> DataFrame:
    """Share of all text values that parse as dates, and whether it reaches the threshold."""
    names = list(columns or string_columns(df))
    cells = [F.struct(F.lit(n).alias("column_name"), quoted(n).alias("text")) for n in names]
    values = df.select(F.inline(F.array(*cells))).where(F.col("text").isNotNull())
    tested = values.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("tested_values"),
        F.count_if(looks_like_datetime(F.col("text"), formats)).alias("parsed_values"),
    )
    return tested.withColumn(
        "datetime_candidate",
        F.coalesce(ratio(F.col("parsed_values"), F.col("tested_values")) >= DATETIME_SHARE, F.lit(False)),
    )


def _structural_type(kind: T.DataType, whole: Column, dated: Column) -> Column:
    if isinstance(kind, T.BooleanType):
        return F.lit("Boolean")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.lit("Datetime")
    if isinstance(kind, T.StringType):
        return F.when(dated, F.lit("Datetime candidate")).otherwise(F.lit("String / categorical candidate"))
    if isinstance(kind, T.IntegralType):
        return F.lit("Integer numeric")
    if isinstance(kind, T.NumericType):
        return F.when(whole, F.lit("Integer-valued numeric")).otherwise(F.lit("Continuous numeric"))
    return F.lit("Other")


def column_profile(df: DataFrame, row_key: str) -> DataFrame:
    """One row of 22 fields per column.

    Passes: one wide aggregation for counts and moments, the distinct counts by codes, the
    examples of columns with few values, and the medians.
    """
    numeric = set(numeric_columns(df))
    none = F.lit(None)

    def measures(name: str) -> dict[str, Column]:
        c, number = quoted(name), quoted(name).cast("double") if name in numeric else None
        is_number = number is not None
        return {
            "observed_type": F.lit(df.schema[name].dataType.simpleString()),
            "observations": F.count(F.lit(1)),
            "non_missing_count": F.count(c),
            "whole": F.coalesce(F.bool_and(is_whole(number)), F.lit(False)) if is_number else F.lit(False),
            "minimum": F.min(number) if is_number else none.cast("double"),
            "maximum": F.max(number) if is_number else none.cast("double"),
            "mean": F.avg(number) if is_number else none.cast("double"),
            "standard_deviation": deviation(number) if is_number else none.cast("double"),
            "zero_count": F.count_if(number == 0).cast("double") if is_number else none.cast("double"),
            "negative_count": F.count_if(number < 0).cast("double") if is_number else none.cast("double"),
        }

    counted = per_column(df, df.columns, measures, label="column_name")
    # Every table joined here has one row per column of the schema.
    profile = counted.join(F.broadcast(distinct_with_examples(df, row_key)), "column_name", "left")
    if numeric:
        medians = quantile_table(df, [n for n in df.columns if n in numeric], {"median": 0.5})
        medians = medians.withColumnRenamed("variable", "column_name")
        profile = profile.join(F.broadcast(medians), "column_name", "left")
    else:
        profile = profile.withColumn("median", none.cast("double"))
    texts = string_columns(df)
    if texts:
        dated = datetime_candidates(df).select("column_name", "datetime_candidate")
        profile = profile.join(F.broadcast(dated), "column_name", "left")
    else:
        profile = profile.withColumn("datetime_candidate", F.lit(False))

    dated = F.coalesce("datetime_candidate", F.lit(False))
    kind = none.cast("string")
    for name in df.columns:
        inferred = _structural_type(df.schema[name].dataType, F.col("whole"), dated)
        kind = F.when(F.col("column_name") == name, inferred).otherwise(kind)
    unique, present = F.coalesce("unique_count", F.lit(0)), F.col("non_missing_count")
    share = F.coalesce(ratio(unique, present), F.lit(0.0))
    missing = F.col("observations") - present
    return profile.select(
        F.col("position").alias("column_position"),
        "column_name",
        "observed_type",
        kind.alias("inferred_structural_type"),
        "observations",
        "non_missing_count",
        missing.alias("missing_count"),
        percentage(missing, F.col("observations")).alias("missing_percentage"),
        unique.alias("unique_count"),
        percentage(unique, F.col("observations")).alias("unique_percentage"),
        (unique == 2).alias("binary_candidate"),
        ((unique > 0) & ((unique <= LOW_CARDINALITY_VALUES) | (share <= LOW_CARDINALITY_RATIO))).alias(
            "low_cardinality_candidate"
        ),
        ((present > 0) & (share >= IDENTIFIER_RATIO)).alias("identifier_candidate"),
        F.col("whole").alias("integer_valued_candidate"),
        "minimum",
        "maximum",
        "mean",
        "median",
        "standard_deviation",
        "zero_count",
        "negative_count",
        F.coalesce("example_values", F.lit("")).alias("example_values"),
    )


def categorical_candidates(df: DataFrame) -> DataFrame:
    """Value frequencies of every low-cardinality column, with the gaps as a value."""
    frequencies = value_frequencies(df)
    sizes = frequencies.groupBy("column_name").agg(
        F.count_if("present").alias("unique_count"),
        F.sum(F.when(F.col("present"), F.col("frequency"))).alias("present"),
        F.sum("frequency").alias("row_total"),
    )
    low = sizes.where(
        (F.col("unique_count") > 0)
        & (
            (F.col("unique_count") <= LOW_CARDINALITY_VALUES)
            | (ratio(F.col("unique_count"), F.col("present")) <= LOW_CARDINALITY_RATIO)
        )
    )
    # One row per column of the table, so the broadcast side is bounded by the schema.
    return frequencies.drop("present").join(F.broadcast(low), "column_name").select(
        "column_name",
        F.coalesce("observed_value", F.lit(MISSING_LABEL)).alias("observed_value"),
        "frequency",
        percentage(F.col("frequency"), F.col("row_total")).alias("percentage"),
    )


def categorical_frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Level counts of the given text columns as a share of all rows."""
    frequencies = value_frequencies(df, columns)
    totals = frequencies.groupBy("column_name").agg(F.sum("frequency").alias("row_total"))
    return frequencies.join(F.broadcast(totals), "column_name").select(
        "column_name",
        F.coalesce("observed_value", F.lit(MISSING_LABEL)).alias("category_level"),
        "frequency",
        percentage(F.col("frequency"), F.col("row_total")).alias("percentage"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Counts of one column, NULL included, with the share of the counted rows."""
    counts = df.groupBy(quoted(column).alias("value")).agg(F.count(F.lit(1)).alias("value_count"))
    total = counts.agg(F.sum("value_count")).scalar()
    share = F.round(percentage(F.col("value_count"), total), 2)
    return counts.withColumn("percentage", share).orderBy(F.desc("value_count"), "value")


def structure_table(df: DataFrame) -> DataFrame:
    """Type, gaps and distinct values of every column."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    counted = per_column(
        df,
        df.columns,
        lambda name: {
            "data_type": F.lit(types[name]),
            "row_total": F.count(F.lit(1)),
            "missing_values": F.count_if(quoted(name).isNull()),
        },
        label="column_name",
    )
    return counted.join(F.broadcast(unique_counts(df)), "column_name", "left").select(
        "column_name",
        "data_type",
        "missing_values",
        F.round(percentage(F.col("missing_values"), F.col("row_total")), 2).alias("missing_percentage"),
        F.col("unique_count").alias("unique_values"),
    )


def preview(df: DataFrame, row_key: Sequence[str], rows: int = 10) -> DataFrame:
    """First rows by key; each task keeps only its own first rows."""
    return df.orderBy(*[quoted(k) for k in row_key]).limit(rows)
