"""The datasets behind the three dashboard pages."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmart.operators.fact import Star
from deskmart.plans.context import FilterContext
from deskmart.plans.measures import base_cube, evaluate, evaluate_open
from deskmart.schemas import RESOLVED_BAND
from deskmart.session import new_folder

Context = FilterContext | None
Cube = DataFrame | None


def _traffic_light(rate: Column, orange_from: float) -> Column:
    return F.when(rate >= 95, "green").when(rate >= orange_from, "orange").otherwise("red")


def overview_cards(star: Star, context: Context = None, cube: Cube = None) -> DataFrame:
    """I1 with the colour of I2."""
    cards = evaluate(star, ["total_tickets", "backlog_count", "mttr_display",
                            "sla_compliance_display", "csat_display", "sla_compliance_rate"],
                     context=context, cube=cube)
    return cards.withColumn("sla_colour", _traffic_light(F.col("sla_compliance_rate"), 85))


def tickets_over_time(star: Star, context: Context = None, cube: Cube = None) -> DataFrame:
    """A date axis; days without tickets, and tickets without a calendar day, are absent."""
    return (evaluate(star, ["total_tickets"], ["date"], context, cube=cube)
            .where(F.col("date").isNotNull()).orderBy("date"))


def tickets_by_priority(star: Star, context: Context = None, cube: Cube = None) -> DataFrame:
    """I4."""
    return evaluate(star, ["total_tickets"], ["priority_name"], context, cube=cube).orderBy(
        F.col("total_tickets").desc(), "priority_name")


def backlog_aging(star: Star, context: Context = None, cube: Cube = None) -> DataFrame:
    """Bands frozen at build time."""
    return evaluate(star, ["total_tickets"], ["ticket_age_band"], context, cube=cube).where(
        F.col("ticket_age_band") != RESOLVED_BAND)


def performance_cards(star: Star, context: Context = None, as_of: datetime | None = None,
                      cube: Cube = None) -> DataFrame:
    """I6."""
    return evaluate(star, ["sla_breach_count", "sla_at_risk", "fcr_rate_display",
                           "oldest_open_days"], context=context, as_of=as_of, cube=cube)


def breach_rate_by_category(star: Star, context: Context = None, cube: Cube = None) -> DataFrame:
    """I7."""
    return evaluate(star, ["sla_breach_rate"], ["category_name"], context, cube=cube).orderBy(
        F.col("sla_breach_rate").desc(), "category_name")


def agent_matrix(star: Star, context: Context = None, cube: Cube = None) -> DataFrame:
    """I8 with the colour of I9: one row per agent name over all teams, worst SLA first."""
    rows = evaluate(star, ["total_tickets", "agent_mttr", "agent_fcr_rate",
                           "agent_sla_compliance"], ["agent_name"], context, cube=cube)
    return rows.withColumn(
        "sla_colour", _traffic_light(F.col("agent_sla_compliance"), 80)
    ).orderBy("agent_sla_compliance", "agent_name")


def csat_cards(star: Star, context: Context = None, cube: Cube = None) -> DataFrame:
    """I10."""
    return evaluate(star, ["csat_display", "csat_satisfied_rate", "csat_dissatisfied_rate"],
                    context=context, cube=cube)


def csat_by_category(star: Star, context: Context = None, cube: Cube = None) -> DataFrame:
    """Unrated categories are absent; lowest first."""
    return (evaluate(star, ["avg_csat"], ["category_name"], context, cube=cube)
            .where(F.col("avg_csat").isNotNull()).orderBy("avg_csat", "category_name"))


def live_aging(star: Star, as_of: datetime, context: Context = None, opened: Cube = None) -> DataFrame:
    """Bands as of the report instead of the build; from ``opened`` (of open_tickets, same context) without a scan
    of the fact."""
    if opened is not None:
        return evaluate_open(star, opened, ["total_tickets"], ["live_age_band"], as_of)
    return evaluate(star, ["total_tickets"], ["live_age_band"], context, as_of).where(
        F.col("live_age_band") != RESOLVED_BAND)


def efficiency_by(star: Star, attribute: str, context: Context = None) -> DataFrame:
    """Resolution and response times per agent, priority or channel."""
    return evaluate(star, ["mttr_hours", "mtta_hours"], [attribute], context)


def csat_by_resolution_time(star: Star, context: Context = None) -> DataFrame:
    """Satisfaction per category and resolution-time bucket; unrated cells are absent."""
    return evaluate(star, ["avg_csat"], ["category_name", "resolution_time"], context).where(
        F.col("avg_csat").isNotNull())


def dashboard(star: Star, context: Context = None) -> dict[str, DataFrame]:
    """Every dataset of the three pages under one and the same context.

    The facts in context are read once, for a table of base aggregates below the shared checkpoint
    folder; all pages are rolled up from that.
    """
    spark = star.fact.sparkSession
    folder = new_folder(spark, "dashboard")
    reduced = base_cube(star, context)
    reduced.write.parquet(folder)
    cube = spark.read.schema(reduced.schema).parquet(folder)
    pages = (overview_cards, tickets_over_time, tickets_by_priority, backlog_aging, performance_cards,
             breach_rate_by_category, agent_matrix, csat_cards, csat_by_category)
    return {page.__name__: page(star, context, cube=cube) for page in pages}
