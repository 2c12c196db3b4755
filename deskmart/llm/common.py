"""Helpers that several operators share: written intermediate tables and keys of whole texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deskmart.session import new_folder


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written below the shared checkpoint folder and read again.

    Cuts the lineage in a way that survives lost executors, and gives the planner the true size, so
    that it broadcasts the table only below its own threshold.
    """
    spark = df.sparkSession
    path = new_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_once(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path``, a new folder, and read again, for chains of large tables: Spark deletes the shuffles of
    the job when it ends, which nothing reads again, and files are compressed more closely."""
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name)
    conf.set(name, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.set(name, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def emptied(spark: SparkSession, path: str) -> None:
    """Frees the disk of a written table that nothing reads any more: an empty table takes its place."""
    spark.range(0).write.mode("overwrite").parquet(path)


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def text_key(column: str = "text") -> list[Column]:
    """128 bits that stand for a whole text; null and empty texts share a key."""
    text = text_of(column)
    return [F.xxhash64(text).alias("key_a"), F.xxhash64(F.lit(7), text, F.length(text)).alias("key_b")]


KEY = ["key_a", "key_b"]


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, also where lambdas inside refer to it."""
    return F.transform(F.array(value), use)[0]


def sums_ahead(lengths: Column) -> Column:
    """For each entry of an array of whole numbers the sum of all entries ahead of it.

    Appending to an array copies it, so sums run inside blocks of about the root of the array's size, and over the
    totals of the blocks.
    """
    def running(values: Column, start: Column) -> Column:
        first = F.struct(start.cast("int").alias("at"), F.expr("cast(array() as array<int>)").alias("sums"))
        return F.aggregate(values, first, lambda acc, x: F.struct(
            (acc["at"] + x).alias("at"), F.array_append(acc["sums"], acc["at"]).alias("sums")), lambda acc: acc["sums"])

    def blocked(values: Column) -> Column:
        size = F.ceil(F.sqrt(F.greatest(F.size(values), F.lit(1)))).cast("int")
        count = F.ceil(F.size(values) / size).cast("int")
        blocks = F.when(count > 0, F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))),
                                               lambda b: F.slice(values, b * size + 1, size)))
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda acc, x: acc + x))
        inside = F.zip_with(blocks, running(totals, F.lit(0)), running)
        return F.coalesce(F.flatten(inside), F.expr("cast(array() as array<int>)"))

    return let(lengths, blocked)


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, hit>> of the leftmost matches that do not overlap, in code points, end exclusive.

    Splitting by the pattern gives the text between matches; sums of both lengths give positions. ``pattern`` must
    not match the empty text.
    """
    both = F.struct(F.transform(F.split(text, pattern, -1), lambda x: F.length(x)).alias("gaps"),
                    F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"))

    def placed(b: Column) -> Column:
        gaps = F.slice(b["gaps"], 1, F.size(b["hits"]))
        ahead = sums_ahead(F.zip_with(gaps, b["hits"], lambda gap, hit: gap + F.length(hit)))
        return F.zip_with(F.zip_with(ahead, gaps, lambda a, gap: a + gap), b["hits"], lambda start, hit: F.struct(
            start.alias("start"), (start + F.length(hit)).alias("end"), hit.alias("hit")))

    return let(both, placed)
