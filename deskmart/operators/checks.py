"""The five validation checks (F1-F6). They report; nothing is repaired or rejected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmart.operators.fact import Star


def _rows(df: DataFrame, name: str = "bad_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def dates_without_calendar(star: Star) -> DataFrame:
    """facts whose date key is missing from the calendar; a null key counts.

    Facts shrink to one row per date key before they meet the calendar.
    """
    per_day = star.fact.groupBy(F.col("created_date_key").alias("date_key")).agg(
        F.count(F.lit(1)).alias("n"))
    orphans = per_day.join(star.calendar, "date_key", "left_anti")
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("bad_rows"))


def facts_without_agent(star: Star) -> DataFrame:
    """F2."""
    return _rows(star.fact.where(F.col("agent_key").isNull()))


def breaches_by_priority(star: Star) -> DataFrame:
    """breached tickets per priority, most first."""
    per_key = star.fact.where("sla_breached = 1").groupBy("priority_key").agg(
        F.count(F.lit(1)).alias("breached_tickets"))
    return (per_key.join(star.priority, "priority_key").select("priority_name", "breached_tickets")
            .orderBy(F.col("breached_tickets").desc(), "priority_name"))


def negative_resolution(star: Star) -> DataFrame:
    """F4."""
    return _rows(star.fact.where("resolution_hours < 0"))


def row_parity(raw: DataFrame, star: Star) -> DataFrame:
    """the fact must hold exactly the raw rows."""
    counted = _rows(raw, "n").select(F.lit(True).alias("is_raw"), "n").unionAll(
        _rows(star.fact, "n").select(F.lit(False).alias("is_raw"), "n"))
    return counted.agg(
        F.sum(F.when(F.col("is_raw"), F.col("n"))).alias("raw_rows"),
        F.sum(F.when(~F.col("is_raw"), F.col("n"))).alias("fact_rows"),
    ).withColumn("result", _pass(F.col("raw_rows") == F.col("fact_rows")))


def _pass(ok: Column) -> Column:
    return F.when(ok, "PASS").otherwise("FAIL")


def all_checks(raw: DataFrame, star: Star) -> DataFrame:
    """one row per check (F3 is a table of its own and appears as its total).

    One pass over the fact reduces it to date and priority keys, which answer all five.
    """
    n = F.col("n")
    reduced = star.fact.groupBy(F.col("created_date_key").alias("date_key"), "priority_key").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("agent_key").isNull()).alias("no_agent"),
        F.sum("sla_breached").alias("breached"), F.count_if(F.col("resolution_hours") < 0).alias("negative"))
    known = star.calendar.select("date_key", F.lit(True).alias("known"))
    priorities = star.priority.select("priority_key", F.lit(True).alias("named"))
    facts = reduced.join(known, "date_key", "left").join(priorities, "priority_key", "left").agg(
        F.sum(F.when(F.col("known").isNull(), n)).alias("no_date"), F.sum("no_agent").alias("no_agent"),
        F.sum(F.when(F.col("named"), F.col("breached"))).alias("breached"),
        F.sum("negative").alias("negative"), F.sum("n").alias("facts"))
    raw_rows = raw.agg(F.count(F.lit(1)).alias("raw_rows"))
    one = facts.unionByName(raw_rows, allowMissingColumns=True).agg(*(
        F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in (*facts.columns, "raw_rows")))

    def check(number: int, label: str, value: Column, status: Column | None = None) -> Column:
        return F.struct(F.lit(number).alias("check"), F.lit(label).alias("label"), value.alias("value"),
                        (_pass(value == 0) if status is None else status).alias("status"))

    rows = F.array(
        check(1, "facts without a calendar date", F.col("no_date")),
        check(2, "facts without an agent", F.col("no_agent")),
        check(3, "breached tickets", F.col("breached"), F.lit("INFO")),
        check(4, "negative resolution hours", F.col("negative")),
        check(5, "raw rows minus fact rows", F.col("raw_rows") - F.col("facts")))
    return one.select(F.explode(rows).alias("c")).select("c.*")
