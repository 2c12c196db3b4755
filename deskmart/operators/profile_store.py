"""Column profiles that grow with new files (C3, C4, C6, C7): per file and column counts and sketches that merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmart.functions.numbers import to_number
from deskmart.functions.text import strip
from deskmart.operators.clean import present_cells
from deskmart.operators.profile import DATE_FORMATS, date_shape, profiled_columns

SOURCE_FILE = "_source_file"
DISTINCT_BITS = 14   # relative error of distinct counts: 0.8 % (one standard deviation)
QUANTILE_K = 400     # rank error of quantiles: below 0.7 % at 99 % confidence
_MERGE_GROUPS = 1024

_STATES = ("whole", "numeric", "truth")
_COUNTS = ("total", "nulls", "numbers", "negatives", *DATE_FORMATS)
LAYOUT = ("file string, length bigint, modified bigint, column_name string, "
          + ", ".join(f"{c} bigint" for c in _COUNTS) + ", " + ", ".join(f"{c} boolean" for c in _STATES)
          + ", min double, max double, number_total double, distinct_sketch binary, number_sketch binary")


def file_profiles(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per file and column of a unified text frame, in one scan whose shuffle is one row per task, file and column."""
    columns = list(columns or (c for c in profiled_columns(df) if c != SOURCE_FILE))
    cells = present_cells(df.select(SOURCE_FILE, *(F.col(f"`{c}`") for c in columns)))
    value, number, text = F.col("value"), F.col("number"), F.col("text")
    long = (cells.unpivot([F.col(SOURCE_FILE).alias("file")], columns, "column_name", "value")
            .withColumn("text", strip(value)).withColumn("number", to_number(text)).withColumn("shape", date_shape(value)))
    count = lambda condition: F.count_if(F.coalesce(condition, F.lit(False)))
    return long.groupBy("file", "column_name").agg(
        F.count(F.lit(1)).alias("total"), count(value.isNull()).alias("nulls"), F.count("number").alias("numbers"),
        count(number < 0).alias("negatives"), *(count(value.isNotNull() & (F.col("shape") == s)).alias(s) for s in DATE_FORMATS),
        F.bool_and(F.when(value.isNotNull(), text.rlike(r"^[+-]?\d+$") & text.try_cast("bigint").isNotNull())).alias("whole"),
        F.bool_and(F.when(value.isNotNull(), number.isNotNull())).alias("numeric"),
        F.bool_and(F.when(value.isNotNull(), F.lower(text).isin("true", "false"))).alias("truth"),
        F.min("number").alias("min"), F.max("number").alias("max"), F.sum("number").alias("number_total"),
        F.hll_sketch_agg("value", F.lit(DISTINCT_BITS)).alias("distinct_sketch"),
        F.kll_sketch_agg_double("number", F.lit(QUANTILE_K)).alias("number_sketch"))


def _merged_numbers(sketches: Column) -> Column:
    """One sketch of a list of sketches; null for an empty list."""
    return F.aggregate(sketches, F.lit(None).cast("binary"), lambda acc, s: F.when(
        acc.isNull(), s).otherwise(F.kll_sketch_merge_double(acc, s)))


def merged_profile(profiles: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """One row per column from per-file rows of LAYOUT: all counts, the type, estimated distinct values and quantiles
    (a column without numbers has none).

    Distinct counts are off by 0.8 % (one standard deviation), ranks of quantiles by 0.7 %; all else is exact. Number
    sketches are merged in groups of files first, so no task holds those of all files.
    """
    group = F.pmod(F.xxhash64("file"), F.lit(_MERGE_GROUPS)).alias("group")
    sums = [F.sum(c).cast("bigint").alias(c) for c in _COUNTS]
    rest = [*(F.bool_and(c).alias(c) for c in _STATES), F.min("min").alias("min"), F.max("max").alias("max"),
            F.sum("number_total").alias("number_total"), F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
            F.collect_list(F.when(F.col("numbers") > 0, F.col("number_sketch"))).alias("number_sketch")]
    found = profiles
    for keys in (["column_name", group], ["column_name"]):
        found = found.groupBy(*keys).agg(*sums, *rest).withColumn("number_sketch", _merged_numbers(F.col("number_sketch")))
    kind = (F.when(F.col("whole"), "bigint").when(F.col("numeric"), "double").when(F.col("truth"), "boolean").otherwise("string"))
    return found.select(
        "column_name", *_COUNTS, kind.alias("data_type"), "min", "max", (F.col("number_total") / F.col("numbers")).alias("mean"),
        F.hll_sketch_estimate("distinct_sketch").alias("distinct_values"),
        *(F.when(F.col("number_sketch").isNotNull(), F.kll_sketch_get_quantile_double("number_sketch", F.lit(float(q)))).alias(f"q{round(q * 100):02d}")
          for q in quantiles))
