"""Raw text tickets -> typed canonical tickets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskmart.functions.dates import in_range, parse_any_year, parse_datetime
from deskmart.functions.numbers import to_count, to_number
from deskmart.functions.text import present, strip, tidy_label, tidy_priority, tidy_status
from deskmart.operators.ordinals import number_lines
from deskmart.schemas import CANONICAL, DATE_COLUMNS, RAW_TICKETS, RESPONSE_HOURS_COLUMN
from deskmart.session import prepare

_LABELS = ("category", "channel", "agent_name", "team")


def present_cells(df: DataFrame) -> DataFrame:
    """A1: cells spelling "missing" become null in every text column."""
    return df.select(*(F.when(present(name), F.col(f"`{name}`")).alias(name)
                       if kind == "string" else F.col(f"`{name}`") for name, kind in df.dtypes))


def prepare_cells(df: DataFrame) -> DataFrame:
    """Missing cells become null; all text but the description is stripped."""
    def cell(name: str) -> Column:
        value = F.col(name)
        text = value if name == "description" else strip(value)
        return F.when(present(name), text).alias(name)
    return df.select(*(cell(name) for name in df.columns))


def response_from_hours(created: Column, hours: Column) -> Column:
    """Creation time plus a latency in hours, cut to the second.

    Rounding to microseconds first keeps 2.3 h at 8280 s where binary fractions fall just short.
    """
    seconds = F.floor(F.round(to_number(hours) * 3600.0, 6))
    return F.timestamp_add("SECOND", seconds, created).cast("timestamp_ntz")


def project_columns(df: DataFrame, names: Sequence[str] = CANONICAL) -> DataFrame:
    """Exactly the named columns, in order; absent ones are null text."""
    return df.select(*(F.col(c) if c in df.columns
                       else F.lit(None).cast("string").alias(c) for c in names))


def synthesize_ids(df: DataFrame, block: str, line: str) -> DataFrame:
    """1..n in (file, line) order when not a single id is present, else unchanged.

    Cells that spell "missing" are no ids; lines are consecutive inside a block.
    """
    if "ticket_id" in df.columns:
        if not df.where(present("ticket_id")).isEmpty():
            return df
        df = df.drop("ticket_id")
    numbered = number_lines(df, block, line, "ticket_id")
    return numbered.withColumn("ticket_id", F.col("ticket_id").cast("string"))


def clean_tickets(df: DataFrame) -> DataFrame:
    """Unified text frame (canonical names, extras allowed) to the typed ``raw_tickets`` layout.

    No shuffle: rows stay in the partitions they were read into. Times are parsed in a projection of their own, so that
    the limits of the calendar look at a parsed column instead of parsing again.
    """
    prepare(df.sparkSession)
    derive = "first_response_at" not in df.columns and RESPONSE_HOURS_COLUMN in df.columns
    wanted = [*CANONICAL, RESPONSE_HOURS_COLUMN] if derive else list(CANONICAL)
    text = prepare_cells(project_columns(df, wanted))
    parsed = text.withColumns({c: parse_any_year(F.col(c)) for c in DATE_COLUMNS})
    typed = {c: in_range(F.col(c)) for c in DATE_COLUMNS}
    if derive:
        typed["first_response_at"] = response_from_hours(typed["created_at"], F.col(RESPONSE_HOURS_COLUMN))
    typed |= {c: tidy_label(F.col(c)) for c in _LABELS}
    typed["status"] = tidy_status(F.col("status"))
    typed["priority"] = tidy_priority(F.col("priority"))
    typed["satisfaction_score"] = to_number(F.col("satisfaction_score"))
    typed["reopen_count"] = to_count(F.col("reopen_count"))
    return parsed.select(*(typed.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name)
                           for f in RAW_TICKETS))


def unparseable_dates(df: DataFrame) -> DataFrame:
    """B2: per date column, how many non-null cells could not be read as a time."""
    present = [c for c in DATE_COLUMNS if c in df.columns]
    cells = prepare_cells(df.select(*present))
    counted = cells.agg(*(F.count_if(F.col(c).isNotNull() & parse_datetime(F.col(c)).isNull())
                          .alias(c) for c in present))
    return counted.unpivot([], present, "column_name", "unparseable")
