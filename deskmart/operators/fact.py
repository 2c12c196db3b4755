"""The ticket fact (E1-E10) and the assembled star."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmart.functions.dates import date_key, hour_boundaries, seconds_between
from deskmart.operators import dims
from deskmart.operators.lookup import attach
from deskmart.schemas import AGE_BANDS, FACT_SECONDS, OLDEST_BAND, RESOLVED_BAND, STAR_TABLES
from deskmart.session import prepare, side_by_side


@dataclass(frozen=True)
class Star:
    """One fact and five dimensions, lazily built or read back from a written star."""

    fact: DataFrame
    agent: DataFrame
    category: DataFrame
    channel: DataFrame
    priority: DataFrame
    calendar: DataFrame
    as_of: datetime

    def tables(self) -> dict[str, DataFrame]:
        """The six tables in their exported layout."""
        return {
            "fact_tickets": self.fact.select(*STAR_TABLES["fact_tickets"].names),
            "dim_agent": self.agent,
            "dim_category": self.category,
            "dim_channel": self.channel,
            "dim_priority": self.priority,
            "dim_calendar": self.calendar,
        }


def clock(as_of: datetime) -> Column:
    """The explicit "now" of a build or a report."""
    return F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def band_by_limits(amount: Column, unit: int) -> Column:
    """Label of the first band whose limit holds ``amount``; null falls into the last band."""
    label = F.lit(OLDEST_BAND)
    for limit, name in reversed(AGE_BANDS):
        label = F.when(amount <= limit * unit, name).otherwise(label)
    return label


def age_band(as_of: datetime) -> Column:
    """Band frozen at build time, by exact elapsed seconds."""
    elapsed = seconds_between(F.col("created_at"), clock(as_of))
    return F.when(F.col("resolved_at").isNotNull(), RESOLVED_BAND).otherwise(
        band_by_limits(elapsed, 3600))


def live_age_band(as_of: datetime) -> Column:
    """Band at report time, by clock-hour boundaries."""
    elapsed = hour_boundaries(F.col("created_at"), clock(as_of))
    return F.when(F.col("resolved_at").isNotNull(), RESOLVED_BAND).otherwise(
        band_by_limits(elapsed, 1))


def derive_measures(rows: DataFrame, as_of: datetime) -> DataFrame:
    """E2-E9 on tickets that already carry ``sla_target_hours``."""
    created, resolved = F.col("created_at"), F.col("resolved_at")
    taken = F.col("resolution_seconds")
    return (
        rows
        .withColumn("resolution_seconds", seconds_between(created, resolved))
        .withColumn("response_seconds", seconds_between(created, F.col("first_response_at")))
        .withColumn("reopen_count", F.coalesce("reopen_count", F.lit(0).cast("bigint")))
        .withColumn("created_date_key", date_key(created))
        .withColumn("resolution_hours", taken / F.lit(3600.0))
        .withColumn("response_hours", F.col("response_seconds") / F.lit(3600.0))
        .withColumn("sla_breached",
                    F.when(taken > F.col("sla_target_hours") * F.lit(3600).cast("bigint"), 1)
                    .otherwise(0))
        .withColumn("is_first_contact_resolved",
                    F.when((F.col("status") == "Resolved") & (F.col("reopen_count") == 0), 1)
                    .otherwise(0))
        .withColumn("ticket_age_band", age_band(as_of)))


def build_star(raw: DataFrame, as_of: datetime) -> Star:
    """Typed tickets to the star. Four member sets are measured; the fact stays lazy, unless a dimension is too
    large to broadcast, which takes a count of its members' rows.

    One pass writes the member sets, from which all dimensions follow; the fact is the second and last pass.
    """
    prepare(raw.sparkSession)
    sets = dims.member_sets(raw)
    counted = side_by_side(raw.sparkSession, [partial(make, sets[name]) for name, make in (
        ("agent", dims.dim_agent), ("category", dims.dim_category), ("channel", dims.dim_channel),
        ("priority", dims.dim_priority))])
    agent, category, channel, priority = (c.table for c in counted)
    agents, categories, channels, priorities = (c.bytes for c in counted)
    rows = raw.drop("description").withColumns({
        "agent_name": dims.member("agent_name"), "team": dims.member("team"),
        "category_name": dims.member("category"), "channel_name": dims.member("channel"),
        "priority_name": dims.member("priority"),
    })
    rows = attach(rows, agent, ["agent_name", "team"], agents)
    rows = attach(rows, category, ["category_name"], categories)
    rows = attach(rows, channel, ["channel_name"], channels)
    rows = attach(rows, priority, ["priority_name"], priorities)
    fields = {f.name: f.dataType for f in STAR_TABLES["fact_tickets"]}
    fact = derive_measures(rows, as_of).select(
        *(F.col(name).cast(kind).alias(name) for name, kind in fields.items()), *FACT_SECONDS)
    return Star(fact, agent, category, channel, priority, dims.dim_calendar(sets["first"], as_of), as_of)
