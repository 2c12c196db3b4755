"""The measure registry (H1-H32) and its evaluator.

A measure is a formula over base aggregates (counts, sums, maxima of ticket rows). ``evaluate``
collects the base aggregates of all requested measures and computes them in one pass:

1. facts in context, grouped by the surrogate keys the request needs (partial + final aggregate);
2. these few rows meet the dimensions and are combined per requested attribute;
3. the formulas are applied.

Large tables therefore never meet a dimension row by row, and a dimension never needs a broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmart.functions.dates import hour_boundaries
from deskmart.functions.numbers import hours_minutes, one_decimal, ratio
from deskmart.operators.fact import Star, band_by_limits, clock, live_age_band
from deskmart.plans.context import FilterContext

_DISTINCT_AGENTS = "agents"


def _resolved() -> Column:
    return F.col("resolved_at").isNotNull()


def _rated() -> Column:
    """An empty score equals 0 in the measure language, so a score of 0 is not a rating."""
    return F.col("satisfaction_score") != 0


def _at_risk(as_of: datetime) -> Column:
    elapsed = hour_boundaries(F.col("created_at"), clock(as_of))
    return ~_resolved() & (elapsed >= F.col("sla_target_hours") * F.lit(0.8))


def _open_days(as_of: datetime) -> Column:
    return F.when(~_resolved(), F.datediff(F.to_date(clock(as_of)), F.to_date("created_at")))


def _in_band(*bands: str) -> Column:
    return F.col("ticket_age_band").isin(*bands)


# name -> row condition, counted
_COUNTS: dict[str, Callable[[datetime], Column]] = {
    "tickets": lambda _: F.lit(True),
    "resolved": lambda _: _resolved(),
    "open_status": lambda _: F.col("status").isin("Open", "Pending"),
    "fcr": lambda _: F.col("is_first_contact_resolved") == 1,
    "compliant": lambda _: (F.col("sla_breached") == 0) & _resolved(),
    "breached": lambda _: F.col("sla_breached") == 1,
    "at_risk": _at_risk,
    "backlog": lambda _: ~_resolved(),
    "band_1": lambda _: _in_band("0-1 Day"),
    "band_3": lambda _: _in_band("1-3 Days"),
    "band_7": lambda _: _in_band("3-7 Days"),
    "band_over_7": lambda _: _in_band("7-14 Days", "14+ Days"),
    "resolutions": lambda _: F.col("resolution_seconds").isNotNull(),
    "responses": lambda _: F.col("response_seconds").isNotNull(),
    "rated": lambda _: _rated(),
    "satisfied": lambda _: _rated() & (F.col("satisfaction_score") >= 4),
    "dissatisfied": lambda _: _rated() & (F.col("satisfaction_score") <= 2),
}
# name -> row value, summed
_SUMS: dict[str, Callable[[datetime], Column]] = {
    "resolution_total": lambda _: F.col("resolution_seconds"),
    "response_total": lambda _: F.col("response_seconds"),
    "score_total": lambda _: F.when(_rated(), F.col("satisfaction_score")),
}
# name -> row value, of which the largest counts
_MAXIMA: dict[str, Callable[[datetime], Column]] = {"oldest_days": _open_days}


@dataclass(frozen=True)
class Measure:
    id: str
    name: str
    bases: tuple[str, ...]
    formula: Callable[..., Column]
    format: str  # count | hours | rate | score | text


# base -> the attribute that its row condition is about, for those that tickets can be grouped by
_CONDITION_ON = {"open_status": "status", "band_1": "ticket_age_band", "band_3": "ticket_age_band",
                 "band_7": "ticket_age_band", "band_over_7": "ticket_age_band"}


def _count(id_: str, name: str, base: str) -> Measure:
    return Measure(id_, name, (base,), lambda n: n, "count")


def _rate(id_: str, name: str, part: str, whole: str) -> Measure:
    return Measure(id_, name, (part, whole), lambda n, d: ratio(n, d) * 100.0, "rate")


def _mean_hours(total: Column, n: Column) -> Column:
    return F.try_divide(total / F.lit(3600.0), n.cast("double"))


def _hours(id_: str, name: str, total: str, n: str) -> Measure:
    return Measure(id_, name, (total, n), _mean_hours, "hours")


def _clock_text(id_: str, name: str, total: str, n: str) -> Measure:
    return Measure(id_, name, (total, n), lambda t, c: hours_minutes(_mean_hours(t, c)), "text")


def _percent_text(id_: str, name: str, part: str, whole: str) -> Measure:
    return Measure(id_, name, (part, whole),
                   lambda n, d: F.concat(one_decimal(ratio(n, d) * 100.0), F.lit("%")), "text")


def _mean_score(total: Column, n: Column) -> Column:
    return F.try_divide(total, n.cast("double"))


def _score_text(total: Column, n: Column) -> Column:
    return F.coalesce(F.concat(one_decimal(_mean_score(total, n)), F.lit(" / 5.0")), F.lit("n/a"))


MEASURES: dict[str, Measure] = {m.name: m for m in (
    _count("H1", "total_tickets", "tickets"),
    _count("H2", "tickets_created", "tickets"),
    _count("H3", "tickets_resolved", "resolved"),
    _count("H4", "tickets_open", "open_status"),
    _count("H5", "tickets_by_day", "tickets"),
    _hours("H6", "mttr_hours", "resolution_total", "resolutions"),
    _clock_text("H7", "mttr_display", "resolution_total", "resolutions"),
    _hours("H8", "mtta_hours", "response_total", "responses"),
    _clock_text("H9", "mtta_display", "response_total", "responses"),
    _count("H10", "fcr_count", "fcr"),
    _rate("H11", "fcr_rate", "fcr", "resolved"),
    _percent_text("H12", "fcr_rate_display", "fcr", "resolved"),
    _count("H13", "sla_compliant_count", "compliant"),
    _count("H14", "sla_breach_count", "breached"),
    _rate("H15", "sla_compliance_rate", "compliant", "resolved"),
    _percent_text("H16", "sla_compliance_display", "compliant", "resolved"),
    _count("H17", "sla_at_risk", "at_risk"),
    _rate("H18", "sla_breach_rate", "breached", "resolved"),
    _count("H19", "backlog_count", "backlog"),
    Measure("H20", "oldest_open_days", ("oldest_days",), lambda d: d, "count"),
    _count("H21", "band_0_1_day", "band_1"),
    _count("H22", "band_1_3_days", "band_3"),
    _count("H23", "band_3_7_days", "band_7"),
    _count("H24", "band_over_7_days", "band_over_7"),
    Measure("H25", "tickets_per_agent", ("tickets", _DISTINCT_AGENTS), ratio, "hours"),
    _hours("H26", "agent_mttr", "resolution_total", "resolutions"),
    _rate("H27", "agent_fcr_rate", "fcr", "resolved"),
    _rate("H28", "agent_sla_compliance", "compliant", "resolved"),
    Measure("H29", "avg_csat", ("score_total", "rated"), _mean_score, "score"),
    Measure("H30", "csat_display", ("score_total", "rated"), _score_text, "text"),
    _rate("H31", "csat_satisfied_rate", "satisfied", "rated"),
    _rate("H32", "csat_dissatisfied_rate", "dissatisfied", "rated"),
)}

# Attributes a request may group by, and the fact column that leads to them.
_DIM_OF = {
    "agent_name": ("agent", "agent_key", "agent_key"),
    "team": ("agent", "agent_key", "agent_key"),
    "category_name": ("category", "category_key", "category_key"),
    "channel_name": ("channel", "channel_key", "channel_key"),
    "priority_name": ("priority", "priority_key", "priority_key"),
} | {name: ("calendar", "date_key", "created_date_key") for name in (
    "date", "day_of_week", "week_number", "month_number", "month_name", "quarter", "year",
    "is_weekend", "is_business_day")}


def _row_attributes(as_of: datetime) -> dict[str, Column]:
    taken = F.col("resolution_seconds")
    return {
        "status": F.col("status"),
        "ticket_age_band": F.col("ticket_age_band"),
        "live_age_band": live_age_band(as_of),
        "resolution_time": F.when(taken.isNotNull(), band_by_limits(taken, 3600)),
    }


def _base_aggregates(names: Sequence[str], as_of: datetime) -> list[Column]:
    out = []
    for name in names:
        if name in _COUNTS:
            out.append(F.count_if(_COUNTS[name](as_of)).alias(name))
        elif name in _SUMS:
            out.append(F.sum(_SUMS[name](as_of)).alias(name))
        elif name in _MAXIMA:
            out.append(F.max(_MAXIMA[name](as_of)).alias(name))
    return out


def _combined(names: Sequence[str]) -> list[Column]:
    out = []
    for name in names:
        if name in _COUNTS:
            out.append(F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name))
        elif name in _SUMS:
            out.append(F.sum(name).alias(name))
        elif name in _MAXIMA:
            out.append(F.max(name).alias(name))
        else:
            out.append(F.count_distinct("agent_key").alias(name))
    return out


# What the pages of the dashboard group by.
_CUBE_KEYS = ("created_date_key", "agent_key", "category_key", "priority_key", "ticket_age_band")


def base_cube(star: Star, context: FilterContext | None = None) -> DataFrame:
    """All base aggregates per combination of the keys that dashboard pages group by."""
    bases = [*_COUNTS, *_SUMS, *_MAXIMA]
    return (context or FilterContext()).apply(star).groupBy(*_CUBE_KEYS).agg(
        *_base_aggregates(bases, star.as_of))


def evaluate(star: Star, measures: Sequence[str], by: Sequence[str] = (),
             context: FilterContext | None = None, as_of: datetime | None = None,
             cube: DataFrame | None = None, replace: bool = False) -> DataFrame:
    """One row per combination of ``by`` members with at least one ticket in ``context``.

    ``cube`` is a ``base_cube`` of the same context, which is then rolled up instead of the fact. A condition of a
    measure narrows the row it stands in: open tickets by status are 0 for closed ones. With ``replace`` it
    takes the place of the row's own member of that attribute, as a filter argument of the measure language does: every
    status shows all open tickets of the rest of its row. That is a roll-up of the reduced rows, not another pass.
    """
    as_of = as_of or star.as_of
    chosen = [MEASURES[name] for name in measures]
    bases = list(dict.fromkeys(base for m in chosen for base in m.bases))
    own = _row_attributes(as_of)
    keys = {_DIM_OF[name][2]: None for name in by if name in _DIM_OF}
    if _DISTINCT_AGENTS in bases:
        keys["agent_key"] = None
    grouping = [*keys, *(own[name].alias(name) for name in by if name in own)]
    if cube is None:
        fact = (context or FilterContext()).apply(star)
        grouped = fact.groupBy(*grouping).agg(*_base_aggregates(bases, as_of))
    else:
        grouped = cube.groupBy(*grouping).agg(*_combined([b for b in bases if b != _DISTINCT_AGENTS]))
    return _finished(star, grouped, by, chosen, bases, bool(keys), replace)


def _finished(star: Star, grouped: DataFrame, by: Sequence[str], chosen: Sequence[Measure], bases: Sequence[str],
              keyed: bool, replace: bool = False) -> DataFrame:
    """Base aggregates by surrogate key to the measures by member."""
    if keyed:
        for dim, key, fact_key in dict.fromkeys(_DIM_OF[name] for name in by if name in _DIM_OF):
            wanted = [name for name in by if _DIM_OF.get(name, ("",))[0] == dim]
            members = getattr(star, dim).select(F.col(key).alias(fact_key), *wanted)
            grouped = grouped.join(members, fact_key, "left")
        grouped = grouped.groupBy(*by).agg(*_combined(bases))
    if replace:
        rolled = {base: [b for b in by if b != _CONDITION_ON[base]] for base in bases if _CONDITION_ON.get(base) in by}
        for rest in {tuple(r) for r in rolled.values()}:  # one aggregate of the reduced rows for each attribute
            own = [base for base, r in rolled.items() if tuple(r) == rest]
            total = grouped.groupBy(*(F.col(r).alias(f"_of_{r}") for r in rest)).agg(*_combined(own))
            same = [F.col(r).eqNullSafe(F.col(f"_of_{r}")) for r in rest]
            grouped = grouped.drop(*own).join(total, reduce(and_, same, F.lit(True))).drop(*(f"_of_{r}" for r in rest))
    return grouped.select(
        *by, *(m.formula(*(F.col(b) for b in m.bases)).alias(m.name) for m in chosen))


# What can be said of open tickets at any later time, and from which base aggregates.
_OPEN_BASES = ("tickets", "backlog", "at_risk", "oldest_days")
_OPEN_KEYS = ("created_date_key", "agent_key", "category_key", "channel_key", "priority_key", "sla_target_hours", "status")


def open_tickets(star: Star, context: FilterContext | None = None) -> DataFrame:
    """Open tickets counted by the hour they were created in, their members, target and status.

    Ageing goes by clock hours and days, so this table answers it for every later clock without the fact. It is
    additive: the counts of further tickets can be appended, those of resolved ones with a minus sign.
    """
    hour = F.date_trunc("hour", "created_at").cast("timestamp_ntz").alias("created_hour")
    return (context or FilterContext()).apply(star).where(~_resolved()).groupBy(hour, *_OPEN_KEYS).agg(
        F.count(F.lit(1)).alias("tickets"))


def evaluate_open(star: Star, opened: DataFrame, measures: Sequence[str], by: Sequence[str], as_of: datetime) -> DataFrame:
    """``evaluate`` over open tickets only, from ``opened`` (of open_tickets), as of any time. The fact is not read."""
    chosen = [MEASURES[name] for name in measures]
    bases = list(dict.fromkeys(base for m in chosen for base in m.bases))
    if unknown := [m.name for m in chosen if not set(m.bases) <= set(_OPEN_BASES)]:
        raise ValueError(f"open tickets do not tell {', '.join(unknown)}")
    rows = (opened.groupBy("created_hour", *_OPEN_KEYS).agg(F.sum("tickets").alias("n")).where("n <> 0")
            .withColumn("created_at", F.col("created_hour")).withColumn("resolved_at", F.lit(None).cast("timestamp_ntz")))
    own = {"live_age_band": live_age_band(as_of), "status": F.col("status")}
    keys = {_DIM_OF[name][2]: None for name in by if name in _DIM_OF}
    grouping = [*keys, *(own[name].alias(name) for name in by if name not in _DIM_OF)]
    counted = {base: F.coalesce(F.sum(F.when(_COUNTS[base](as_of), F.col("n"))), F.lit(0)).cast("bigint") for base in bases if base in _COUNTS}
    counted |= {base: F.max(_MAXIMA[base](as_of)) for base in bases if base in _MAXIMA}
    grouped = rows.groupBy(*grouping).agg(*(counted[base].alias(base) for base in bases))
    return _finished(star, grouped, by, chosen, bases, bool(keys))


def formatted(df: DataFrame) -> DataFrame:
    """The dashboard's number formats as text; other columns stay as they are."""
    def shown(name: str) -> Column:
        kind = MEASURES[name].format if name in MEASURES else "text"
        value = F.col(name)
        if kind == "count":
            return F.format_number(value, 0).alias(name)
        if kind in ("hours", "rate", "score"):
            return one_decimal(value).alias(name)
        return value
    return df.select(*(shown(name) for name in df.columns))
