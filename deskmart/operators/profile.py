"""Data profiling of unified text tickets (C3-C9), every section a DataFrame.

One pass counts each distinct value per column; nulls, distinct counts, types, numeric statistics
and date formats all follow from that table. Samples take one more pass, whose tasks keep a bounded number of cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from deskmart.functions.numbers import ratio, to_number
from deskmart.functions.text import strip
from deskmart.operators.clean import present_cells
from deskmart.schemas import CANONICAL, DATE_COLUMNS, NUMBER_COLUMNS

# Row position columns of an ingested frame; they are never profiled.
BLOCK, LINE = "_block", "_line"
_POSITION = (BLOCK, LINE)

# The date shapes that are told apart.
_ISO_DAY = r"^\d{4}-\d{2}-\d{2}"
_US_DAY = r"^\d{1,2}/\d{1,2}/\d{2,4}"

# Longer texts are counted by digest, so that a shuffle moves 65 characters instead of a document.
_DIGEST_OVER = 64
_BUCKETS = 1024
DATE_FORMATS = ("iso", "us", "other", "empty")


def profiled_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in _POSITION]


def _ordinal(spark: SparkSession, columns: Sequence[str]) -> Column:
    return F.element_at(
        F.create_map(*(F.lit(x) for i, c in enumerate(columns) for x in (c, i))),
        F.col("column_name"))


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    cells = present_cells(df)
    ids = [c for c in _POSITION if c in df.columns]
    return cells.unpivot(ids, list(columns), "column_name", "value")


def date_shape(value: Column) -> Column:
    """Iso, us, other or empty."""
    text = strip(value)
    return (F.when(text == "", "empty").when(text.rlike(_ISO_DAY), "iso")
            .when(text.rlike(_US_DAY), "us").otherwise("other"))


def _date_counts(weight: Column, shape: Column) -> list[Column]:
    return [F.coalesce(F.sum(F.when(shape == name, weight)), F.lit(0)).cast("bigint").alias(name)
            for name in DATE_FORMATS]


def column_stats(df: DataFrame, columns: Sequence[str] | None = None,
                 approximate: bool = False) -> DataFrame:
    """One row per column: nulls, distinct values, type votes, numbers and date shapes.

    Counting is two-phase: (column, value) pairs first, with a map-side partial count that absorbs
    frequent values, then columns. This is exact and needs one shuffle of the distinct values,
    where several ``count_distinct`` in one aggregate would multiply every row.

    ``approximate`` estimates the distinct counts (everything else stays exact) in a single
    aggregate whose shuffle is one row per column and task.
    """
    columns = list(columns or profiled_columns(df))
    value, n = F.col("value"), F.col("n")
    number = to_number(strip(value))
    # a digest keeps neither numbers nor date shapes nor truth values, so only other texts get one; short cells, the
    # first branch, never meet a pattern
    plain = number.isNull() & (date_shape(value) == "other") & ~F.lower(strip(value)).isin("true", "false")
    key = (F.when(F.length(value) <= _DIGEST_OVER, value)
           .when(plain, F.concat(F.lit("#"), F.sha2(value, 256))).otherwise(value))
    if approximate:
        counted = _long(df, columns).select(
            "column_name", "value", F.lit(1).cast("bigint").alias("n"))
        distinct = F.approx_count_distinct(value)
    else:
        counted = _long(df, columns).select("column_name", key.alias("value")).groupBy(
            "column_name", "value").agg(F.count(F.lit(1)).alias("n"))
        distinct = F.count(value)
    # a column of a frame without rows still gets its line of zeros
    every = df.sparkSession.createDataFrame(
        [(c, None, 0) for c in columns], "column_name string, value string, n bigint")
    shape = F.col("shape")
    stats = counted.unionByName(every).select(
        "column_name", "value", "n", number.alias("number"), date_shape(value).alias("shape"),
        F.when(strip(value).rlike(r"^[+-]?\d+$"), strip(value).try_cast("bigint").isNotNull())
        .otherwise(F.when(value.isNotNull(), False)).alias("whole"),
        F.lower(strip(value)).isin("true", "false").alias("truth"),
    ).groupBy("column_name").agg(
        F.sum("n").alias("total"),
        F.coalesce(F.sum(F.when(value.isNull(), n)), F.lit(0)).alias("nulls"),
        distinct.alias("distinct_values"),
        F.bool_and("whole").alias("all_whole"),
        F.bool_and(F.when(value.isNotNull(), F.col("number").isNotNull())).alias("all_numeric"),
        F.bool_and("truth").alias("all_truth"),
        F.min("number").alias("min"), F.max("number").alias("max"),
        F.sum(F.col("number") * n).alias("number_total"),
        F.sum(F.when(F.col("number").isNotNull(), n)).alias("numbers"),
        F.coalesce(F.sum(F.when(F.col("number") < 0, n)), F.lit(0)).alias("negatives"),
        *_date_counts(F.when(value.isNotNull(), n), shape))
    return stats.withColumn("position", _ordinal(df.sparkSession, columns))


def null_counts(stats: DataFrame) -> DataFrame:
    """C3."""
    return stats.select(
        "column_name", "total", "nulls", (ratio(F.col("nulls"), F.col("total")) * 100.0)
        .alias("null_pct"), "distinct_values")


def column_types(stats: DataFrame) -> DataFrame:
    """C4: the narrowest type every non-null value fits; an all-null column stays text."""
    return stats.select("column_name", _type().alias("data_type"))


def _type() -> Column:
    return (F.when(F.col("all_whole"), "bigint").when(F.col("all_numeric"), "double")
            .when(F.col("all_truth"), "boolean").otherwise("string"))


def numeric_stats(stats: DataFrame) -> DataFrame:
    """Score, reopen count and every numeric column, if any value is a number."""
    wanted = F.col("column_name").isin(*NUMBER_COLUMNS) | _type().isin("bigint", "double")
    return stats.where(wanted & (F.col("numbers") > 0)).select(
        "column_name", "min", "max", (F.col("number_total") / F.col("numbers")).alias("mean"),
        "negatives")


def date_formats(df: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Date shapes of all values per date column."""
    columns = [c for c in DATE_COLUMNS if c in df.columns]
    stats = column_stats(df, columns) if stats is None else stats
    return stats.where(F.col("column_name").isin(*columns)).select("column_name", *DATE_FORMATS)


def first_values(df: DataFrame, limit: int, columns: Sequence[str] | None = None) -> DataFrame:
    """First ``limit`` non-null values per column in (file block, line) order, in one scan.

    A rank that is limited lets each task keep no more than ``limit`` cells per column and bucket of blocks ahead of the
    shuffle. Buckets are ranked on their own first, so that the last step, one task a column, meets
    no more than ``limit`` cells of each bucket, however many blocks there are.
    """
    columns = list(columns or profiled_columns(df))
    cells = _long(df, columns).where(F.col("value").isNotNull()).withColumn(
        "bucket", F.pmod(F.xxhash64(BLOCK), F.lit(_BUCKETS)))
    for group in (["column_name", "bucket"], ["column_name"]):
        order = Window.partitionBy(*group).orderBy(BLOCK, LINE)
        cells = cells.withColumn("ordinal", F.row_number().over(order)).where(F.col("ordinal") <= limit)
    return cells.select("column_name", "ordinal", "value")


def samples(df: DataFrame, limit: int = 10) -> DataFrame:
    """C5."""
    return first_values(df, limit)


def quality_issues(df: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """One row per violated rule and column."""
    columns = profiled_columns(df)
    stats = column_stats(df, columns) if stats is None else stats
    is_date = F.col("column_name").isin(*DATE_COLUMNS)
    is_numeric = F.col("column_name").isin(*NUMBER_COLUMNS) | _type().isin("bigint", "double")
    shapes = sum((F.when(F.col(s) > 0, 1).otherwise(0) for s in ("iso", "us", "other")), F.lit(0))
    mix = F.concat_ws(", ", *(F.concat(F.lit(f"{s}="), F.col(s)) for s in DATE_FORMATS))
    rules = F.array_compact(F.array(
        _issue("all_null", F.col("nulls") == F.col("total"), F.lit("100% null")),
        _issue("mixed_date_formats", is_date & (shapes > 1), mix),
        _issue("unrecognized_dates", is_date & (F.col("other") > 0), F.col("other")),
        _issue("negative_values", is_numeric & (F.col("negatives") > 0), F.col("negatives"))))
    found = stats.select("column_name", F.explode(rules).alias("issue")).select(
        "issue.rule", "column_name", "issue.detail")
    missing = [(c,) for c in CANONICAL if c not in df.columns]
    if not missing:
        return found
    absent = df.sparkSession.createDataFrame(missing, "column_name string").select(
        F.lit("canonical_column_absent").alias("rule"), "column_name",
        F.lit("no synonym matched").alias("detail"))
    return found.unionByName(absent)


def _issue(rule: str, broken: Column, detail: Column) -> Column:
    return F.when(broken, F.struct(F.lit(rule).alias("rule"), detail.cast("string").alias("detail")))


def totals(df: DataFrame, files: int | None = None) -> DataFrame:
    """Files, rows, columns, and which canonical columns are there.

    ``files`` is the number of files found, skipped ones included; without it, files with rows
    count, from one pre-aggregated row per file.
    """
    columns = profiled_columns(df)
    per_file = df.groupBy("_source_file").agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(F.count(F.lit(1)).alias("files"),
                        F.coalesce(F.sum("n"), F.lit(0)).alias("total")).select(
        "files" if files is None else F.lit(files).cast("bigint").alias("files"), "total",
        F.lit(len(columns)).alias("columns"),
        F.lit(",".join(c for c in CANONICAL if c in columns)).alias("present"),
        F.lit(",".join(c for c in CANONICAL if c not in columns)).alias("absent"))
