"""The slicers of the dashboard as one filter context."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from operator import ge, le

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskmart.operators.fact import Star


def _key(day: date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


@dataclass(frozen=True)
class FilterContext:
    """Dates bound the *created* date; an empty member list keeps every member."""

    date_from: date | None = None
    date_to: date | None = None
    priorities: tuple[str, ...] = ()
    channels: tuple[str, ...] = ()
    categories: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        for name in ("priorities", "channels", "categories"):
            chosen = getattr(self, name)
            if isinstance(chosen, str):
                raise TypeError(f"{name} must be a list of members, not the string {chosen!r}")
            object.__setattr__(self, name, tuple(chosen))

    @classmethod
    def last_days(cls, as_of: datetime, days: int = 30, **members: Iterable[str]) -> FilterContext:
        """The relative-date slicer, ``as_of`` included."""
        last = as_of.date()
        return cls(last - timedelta(days=days - 1), last,
                   **members)

    def apply(self, star: Star) -> DataFrame:
        """The facts in context.

        The keys of chosen members are looked up first. Names are unique per dimension, so the caller's
        list bounds them, and as literals they reach the scan.
        """
        fact = star.fact
        if self.date_from or self.date_to:
            fact = self._between(fact, star.calendar)
        for dim, name, key, chosen in (
            (star.priority, "priority_name", "priority_key", self.priorities),
            (star.channel, "channel_name", "channel_key", self.channels),
            (star.category, "category_name", "category_key", self.categories),
        ):
            if chosen:
                keys = [r[0] for r in dim.where(F.col(name).isin(*chosen)).select(key).collect()]
                fact = fact.where(F.col(key).isin(*keys) if keys else F.lit(False))
        return fact

    def _between(self, fact: DataFrame, calendar: DataFrame) -> DataFrame:
        """The key range reaches the scan; the calendar decides which dates exist."""
        days = calendar.select(F.col("date_key").alias("created_date_key"), "date")
        for limit, within in ((self.date_from, ge), (self.date_to, le)):
            if limit is None:
                continue
            days = days.where(within(F.col("date"), F.lit(limit)))
            fact = fact.where(within(F.col("created_date_key"), _key(limit)))
            if "created_month" in fact.columns:  # partition column of a written star
                fact = fact.where(within(F.col("created_month"), _key(limit) // 100))
        return fact.join(days.select("created_date_key"), "created_date_key", "left_semi")
