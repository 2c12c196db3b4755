"""Dense 1..n numbering that never sorts an unbounded table in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskmart.session import new_folder

# Up to this many short rows are numbered by one sorted window in a single task.
SINGLE_TASK_ROWS = 200_000
MEMBERS_PER_TASK = 100_000


def _before(size: str, *order: str) -> Column:
    """Running total of ``size`` over all earlier buckets."""
    earlier = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(size).over(earlier), F.lit(0))


def number_in_blocks(df: DataFrame, block: Sequence[str], line: str, out: str) -> DataFrame:
    """1..n in (block, line) order, e.g. block = (file, split start).

    Rows are ranked inside their block only; a table with one row per block supplies the offsets.
    """
    offsets = df.groupBy(*block).agg(F.count(F.lit(1)).alias("_size"))
    offsets = offsets.select(*block, _before("_size", *block).alias("_offset"))
    inside = Window.partitionBy(*block).orderBy(line)
    ranked = df.withColumn("_rank", F.row_number().over(inside))
    return (
        ranked.join(offsets, list(block), "left")
        .withColumn(out, F.col("_offset") + F.col("_rank"))
        .drop("_offset", "_rank"))


def number_lines(df: DataFrame, block: str, line: str, out: str) -> DataFrame:
    """1..n in (block, line) order where lines are consecutive inside a block.

    The rank of a line is its distance from the block's first one, so rows are not moved at all. The table
    of blocks has one short row per file split (800,000 for 100 TB), which bounds the broadcast and
    the running total.
    """
    blocks = df.groupBy(block).agg(F.count(F.lit(1)).alias("_size"), F.min(line).alias("_first"))
    offsets = blocks.select(F.col(block).alias("_of"), "_first", _before("_size", block).alias("_offset"))
    return (df.join(F.broadcast(offsets), F.col(block) == F.col("_of"))
            .withColumn(out, F.col("_offset") + F.col(line) - F.col("_first") + 1)
            .drop("_of", "_first", "_offset"))


def dense_keys(members: DataFrame, order: Sequence[Column], out: str, rows: int,
               limit: int | None = None) -> DataFrame:
    """Number distinct members 1..n by ``order``; ``rows`` is their known count.

    Small sets use one window. Large ones are dealt by range to sorted partitions of about MEMBERS_PER_TASK, each
    member's place in its partition is written with it below the shared folder, so that it holds when an executor is
    lost, and the size of the partitions before is added. Where the ranges were cut affects balance only,
    never the keys.
    """
    limit = SINGLE_TASK_ROWS if limit is None else limit
    if rows <= limit:
        return members.withColumn(out, F.row_number().over(Window.orderBy(*order)).cast("int"))
    parts = max(2, -(-rows // min(MEMBERS_PER_TASK, limit)))
    placed = (members.repartitionByRange(parts, *order).sortWithinPartitions(*order)
              .withColumn("_part", F.spark_partition_id())
              # the lower 33 bits count the rows of a partition
              .withColumn("_rank", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1))
    path = new_folder(members.sparkSession, out)
    placed.write.parquet(path)
    placed = members.sparkSession.read.schema(placed.schema).parquet(path)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.select("_part", _before("_size", "_part").alias("_offset"))
    # one short row per partition bounds the broadcast
    return (placed.join(F.broadcast(offsets), "_part")
            .withColumn(out, (F.col("_offset") + F.col("_rank")).cast("int"))
            .drop("_part", "_offset", "_rank"))
