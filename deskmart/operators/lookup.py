"""Attach dimension keys to a large table, whatever the size of the dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Dimensions up to this measured size (text plus an overhead per row) are broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD = 64
# Beyond it no reducer should receive more than 1/SHARES of the rows because of a single member.
SHARES = 20_000


def attach(rows: DataFrame, dim: DataFrame, on: Sequence[str], size: int,
           limit: int | None = None, shares: int = SHARES) -> DataFrame:
    """Left join ``rows`` to ``dim`` (unique on ``on``); ``size`` is its measured bytes.

    A dimension known to be small is broadcast. A larger one is joined by shuffle with hot members
    split: a member holding a share s of all rows gets ceil(s * SHARES) copies, and its rows are
    spread over them. At most SHARES members can be hot, and at most 2 * SHARES copies exist.
    """
    on = list(on)
    limit = BROADCAST_BYTES if limit is None else limit
    if size <= limit:
        return rows.join(F.broadcast(dim), on, "left")
    counts = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    total = rows.count()
    hot = counts.where(F.col("_n") * shares > total).select(
        *on, F.ceil(F.col("_n") * shares / F.lit(max(total, 1))).cast("int").alias("_copies"))
    copies = F.coalesce(F.col("_copies"), F.lit(1))
    spread = F.pmod(F.xxhash64(*(c for c in rows.columns if c not in on)), copies).cast("int")
    left = rows.join(F.broadcast(hot), on, "left").withColumn("_salt", spread).drop("_copies")
    right = dim.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), copies - 1))).drop("_copies")
    return left.join(right, [*on, "_salt"], "left").drop("_salt")
