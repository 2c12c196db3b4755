"""The five dimensions."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmart.functions.dates import date_key, monday_week
from deskmart.operators.lookup import ROW_OVERHEAD
from deskmart.operators.ordinals import dense_keys
from deskmart.schemas import (
    CALENDAR_LOOKAHEAD_DAYS, DEFAULT_SLA_HOURS, PLACEHOLDERS, SLA_HOURS, STAR_TABLES,
)
from deskmart.session import new_folder


def member(column: str) -> Column:
    """The value itself, or the label of the unknown member."""
    return F.coalesce(F.col(column), F.lit(PLACEHOLDERS[column]))


def _members(raw: DataFrame, **columns: str) -> DataFrame:
    """Distinct members. Nulls are replaced before the distinct, so no member can appear twice."""
    return raw.select(*(member(source).alias(name) for name, source in columns.items())).distinct()


_SETS = {"agent": ("agent_name", "team"), "category": ("category",), "channel": ("channel",), "priority": ("priority",), "first": ()}
_SET_COLUMNS = ("agent_name", "team", "category", "channel", "priority")


def member_sets(raw: DataFrame) -> dict[str, DataFrame]:
    """The distinct members of all dimensions and the first creation time (``first``), from one pass over the tickets.

    Grouping sets keep the sets apart, so the result is as large as the dimensions, not as their combinations. It
    is written below the shared folder, where a lost executor cannot take it along.
    """
    found = raw.select(*_SET_COLUMNS, "created_at").groupingSets(list(map(list, _SETS.values())), *_SET_COLUMNS).agg(
        F.min("created_at").alias("created_at"), F.grouping_id().alias("set"))
    spark = raw.sparkSession
    path = new_folder(spark, "members")
    found.write.parquet(path)
    found = spark.read.schema(found.schema).parquet(path)
    # a bit of the grouping id is set for each column, from the left, that is not grouped by
    ids = {name: sum(1 << i for i, c in enumerate(reversed(_SET_COLUMNS)) if c not in columns) for name, columns in _SETS.items()}
    return {name: found.where(F.col("set") == ids[name]).select(*(columns or ("created_at",))) for name, columns in _SETS.items()}


def _conform(df: DataFrame, table: str) -> DataFrame:
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in STAR_TABLES[table]))


@dataclass(frozen=True)
class Counted:
    """A keyed dimension and the measured size of its text."""

    table: DataFrame
    bytes: int


def _numbered(members: DataFrame, table: str, key: str, *order: Column) -> Counted:
    """Members of the written sets, measured and numbered."""
    text = sum((F.octet_length(name) for name, kind in members.dtypes if kind == "string"),
               F.lit(ROW_OVERHEAD))
    rows, size = members.agg(F.count(F.lit(1)), F.coalesce(F.sum(text), F.lit(0))).head()
    return Counted(_conform(dense_keys(members, order, key, rows), table), size)


def dim_agent(raw: DataFrame) -> Counted:
    found = _members(raw, agent_name="agent_name", team="team")
    return _numbered(found, "dim_agent", "agent_key", F.col("agent_name"), F.col("team"))


def dim_category(raw: DataFrame) -> Counted:
    found = _members(raw, category_name="category")
    return _numbered(found, "dim_category", "category_key", F.col("category_name"))


def dim_channel(raw: DataFrame) -> Counted:
    found = _members(raw, channel_name="channel")
    return _numbered(found, "dim_channel", "channel_key", F.col("channel_name"))


def dim_priority(raw: DataFrame) -> Counted:
    """Most urgent first; members outside the SLA table come last, by name."""
    name = F.col("priority_name")
    rank, hours = F.lit(len(SLA_HOURS) + 1), F.lit(DEFAULT_SLA_HOURS)
    for position, (level, target) in enumerate(SLA_HOURS.items(), start=1):
        rank = F.when(name == level, position).otherwise(rank)
        hours = F.when(name == level, target).otherwise(hours)
    found = _members(raw, priority_name="priority").withColumn("sla_target_hours", hours)
    return _numbered(found, "dim_priority", "priority_key", rank, name)


def dim_calendar(raw: DataFrame, as_of: datetime) -> DataFrame:
    """Every day from the first ticket (or ``as_of``) to 30 days after ``as_of``.

    A single row is exploded, so the size depends on the covered years only. When the first ticket
    lies beyond the end, its own day is still listed.
    """
    today = as_of.date()
    bounds = raw.agg(
        F.coalesce(F.to_date(F.min("created_at")), F.lit(today)).alias("first"))
    last = F.greatest(F.col("first"), F.lit(today + timedelta(days=CALENDAR_LOOKAHEAD_DAYS)))
    days = bounds.select(F.explode(F.sequence("first", last)).alias("date"))
    day = F.col("date")
    weekend = F.dayofweek(day).isin(1, 7)
    return _conform(days.select(
        date_key(day).alias("date_key"), "date",
        F.date_format(day, "EEEE").alias("day_of_week"),
        monday_week(day).alias("week_number"),
        F.month(day).alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        F.when(weekend, 1).otherwise(0).alias("is_weekend"),
        F.when(weekend, 0).otherwise(1).alias("is_business_day"),
    ), "dim_calendar")
