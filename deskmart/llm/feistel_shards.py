"""Sharding: a Feistel permutation with cycle walking over global row numbers."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deskmart.llm.common import KEY, text_key, text_of, written
from deskmart.llm.kernels import mixed

ROUNDS = 6
ROWS_PER_BIN = 50_000


def permuted(numbers: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A fixed permutation of 0 .. n-1, computed pointwise.

    A balanced Feistel network permutes the next power of four; values that fall beyond n walk on
    along their cycle until they are back inside, which keeps the map one to one.
    """
    half = np.uint64(max(1, math.ceil(math.log2(max(2, n)) / 2)))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = mixed(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                 ^ np.uint64(seed & (2**64 - 1)))
    out = numbers.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for key in keys:
            left, right = right, left ^ (mixed(right ^ key) & mask)
        out[todo] = left << half | right
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def numbered(df: DataFrame, by: list[str], count: str, rows: int) -> DataFrame:
    """``df`` with ``first``: how many units of ``count`` stand before the row in a canonical order.

    The order is by hash bin, then by the columns ``by``, which must tell rows apart. Bins hold
    about ROWS_PER_BIN rows each; their totals are summed up in two levels, so no task sees more
    than a bin or about the square root of the number of bins.
    """
    bins = max(16, 2 ** math.ceil(math.log2(max(1, rows / ROWS_PER_BIN))))
    wide = 2 ** (int(math.log2(bins)) // 2)
    df = df.withColumn("_bin", F.pmod(F.xxhash64(F.lit(11), *by), F.lit(bins)))
    totals = (df.groupBy("_bin").agg(F.sum(count).alias("_n"))
              .withColumn("_group", F.floor(F.col("_bin") / wide)))
    groups = totals.groupBy("_group").agg(F.sum("_n").alias("_n")).select(
        "_group", F.coalesce(F.sum("_n").over(
            Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_skip"))
    inner = Window.partitionBy("_group").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.join(groups, "_group").select(
        "_bin", (F.col("_skip") + F.coalesce(F.sum("_n").over(inner), F.lit(0))).alias("_start"))
    own = Window.partitionBy("_bin").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    return (df.withColumn("_own", F.coalesce(F.sum(count).over(own), F.lit(0)))
            .join(starts, "_bin")
            .withColumn("first", F.col("_start") + F.col("_own"))
            .drop("_bin", "_own", "_start"))


def assign_shards(docs: DataFrame, shards: int = 16, seed: int = 20_240) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row of ``docs``.

    Rows get global numbers in a canonical order of their contents, not of files or partitions; the
    permutation p of a number gives shard ``p mod shards`` and slot ``p div shards``, so shards
    differ by one row at most, slots have no gaps, and both can be computed again from the number.
    Equal (doc_id, text) rows are counted first and numbered as one run, so a pile of repeated rows
    is never sorted. Texts are not shuffled. Null texts count as empty, null ids are one id; further
    columns are ignored; an empty table gives no rows.
    """
    classes = written(
        docs.select("doc_id", (F.octet_length(text_of()) + 1).cast("long").alias("size"),
                    F.crc32(text_of()).alias("text_crc32"), *text_key())
        .groupBy("doc_id", "size", "text_crc32", *KEY).agg(F.count("*").alias("copies")), "classes")
    n, rows = classes.agg(F.coalesce(F.sum("copies"), F.lit(0)), F.count("*")).first()

    @F.pandas_udf("long")
    def places(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for numbers in batches:
            yield pd.Series(permuted(numbers.to_numpy(), n, seed))

    step = 10_000  # a long run is unfolded in two steps of bounded arrays
    runs = (numbered(classes, ["doc_id", *KEY, "size"], "copies", rows)
            .withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1,
                                                      F.lit(step).cast("long"))))
            .withColumn("_at", F.explode(F.sequence(
                F.col("_from"), F.least(F.col("_from") + step, F.col("copies")) - 1))))
    return (runs.withColumn("_p", places(F.col("first") + F.col("_at")))
            .select("doc_id", "size", "text_crc32",
                    (F.col("_p") % shards).cast("int").alias("shard"),
                    F.floor(F.col("_p") / shards).cast("long").alias("slot")))
