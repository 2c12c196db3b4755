"""Column layouts and business constants shared by every step."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: the 13 canonical columns, in order -----------------------------------------
CANONICAL = (
    "ticket_id", "created_at", "resolved_at", "first_response_at", "status", "priority", "category",
    "channel", "agent_name", "team", "satisfaction_score", "reopen_count", "description",
)

DATE_COLUMNS = ("created_at", "resolved_at", "first_response_at")
NUMBER_COLUMNS = ("satisfaction_score", "reopen_count")
RESPONSE_HOURS_COLUMN = "first_response_time_hours"

# --- Fixed values: accepted source headers per canonical column, best match first --------------
SYNONYMS = {
    "ticket_id": ("ticket_id", "id", "ticket id", "ticket number", "ticketid", "case_id", "case id"),
    "created_at": ("created_at", "date_created", "open_date", "opened_at", "ticket_created_date",
                   "created", "open date", "submitted_at", "submitted"),
    "resolved_at": ("resolved_at", "date_resolved", "close_date", "closed_at", "resolution_date",
                    "resolved", "closed", "ticket_resolved_date", "time_to_resolution",
                    "time to resolution"),
    "first_response_at": ("first_response_at", "first_reply_at", "first response", "first_response",
                          "first reply", "first_reply", "first_response_time",
                          "first response time"),
    "status": ("status", "ticket_status", "state", "ticket state"),
    "priority": ("priority", "ticket_priority", "urgency", "severity"),
    "category": ("category", "issue_type", "ticket_type", "type", "issue category",
                 "ticket category"),
    "channel": ("channel", "source", "ticket_channel", "contact_channel", "submission_channel",
                "via"),
    "agent_name": ("agent_name", "assigned_to", "agent", "assignee", "owner", "handler"),
    "team": ("team", "department", "group", "queue"),
    "satisfaction_score": ("satisfaction_score", "csat", "rating", "customer_satisfaction_rating",
                           "customer_satisfaction_score", "customer satisfaction", "satisfaction"),
    "reopen_count": ("reopen_count", "reopens", "times_reopened", "reopened", "reopen"),
    "description": ("description", "subject", "body", "summary", "ticket_description",
                    "issue_description", "ticket_subject"),
}

# --- Fixed values: text tokens that mean "missing" in a CSV cell --------------------------------
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# --- Fixed values: spellings of each priority and status ---------------------------------------
PRIORITY_SPELLINGS = {
    "Critical": ("critical", "crit", "urgent", "p1", "1", "sev1", "s1"),
    "High": ("high", "p2", "2", "sev2", "s2"),
    "Medium": ("medium", "med", "normal", "p3", "3", "sev3", "s3"),
    "Low": ("low", "p4", "4", "sev4", "s4"),
}
STATUS_SPELLINGS = {
    "Open": ("open", "new"),
    "Pending": ("pending", "in progress", "in_progress", "on hold", "waiting"),
    "Resolved": ("resolved", "solved"),
    "Closed": ("closed", "complete", "completed"),
}

# --- Fixed values: SLA hours by priority, most urgent first; anything else gets the default ----
SLA_HOURS = {"Critical": 4, "High": 8, "Medium": 24, "Low": 72}
DEFAULT_SLA_HOURS = 24

# --- Fixed values: labels of the unknown members -----------------------------------------------
PLACEHOLDERS = {
    "agent_name": "(Unassigned)",
    "team": "(Unknown)",
    "category": "(Uncategorized)",
    "channel": "(Unknown)",
    "priority": "(Unknown)",
}

# --- Fixed values: age bands as (upper limit in hours, label) ------------------------------------
AGE_BANDS = ((24, "0-1 Day"), (72, "1-3 Days"), (168, "3-7 Days"), (336, "7-14 Days"))
OLDEST_BAND = "14+ Days"
RESOLVED_BAND = "(Resolved)"

CALENDAR_LOOKAHEAD_DAYS = 30


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_text, _int, _long, _real, _time = (
    T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampNTZType(),
)

# --- Fixed values: layouts of the typed tickets and of the six star tables -----------------------
RAW_TICKETS = _struct(
    ("ticket_id", _text), ("created_at", _time), ("resolved_at", _time),
    ("first_response_at", _time), ("status", _text), ("priority", _text), ("category", _text),
    ("channel", _text), ("agent_name", _text), ("team", _text), ("satisfaction_score", _real),
    ("reopen_count", _long), ("description", _text),
)

STAR_TABLES = {
    "fact_tickets": _struct(
        ("ticket_id", _text), ("created_at", _time), ("resolved_at", _time),
        ("first_response_at", _time), ("status", _text), ("agent_key", _int),
        ("category_key", _int), ("channel_key", _int), ("priority_key", _int),
        ("created_date_key", _int), ("satisfaction_score", _real), ("reopen_count", _long),
        ("resolution_hours", _real), ("response_hours", _real), ("sla_target_hours", _int),
        ("sla_breached", _int), ("is_first_contact_resolved", _int), ("ticket_age_band", _text),
    ),
    "dim_agent": _struct(("agent_key", _int), ("agent_name", _text), ("team", _text)),
    "dim_category": _struct(("category_key", _int), ("category_name", _text)),
    "dim_channel": _struct(("channel_key", _int), ("channel_name", _text)),
    "dim_priority": _struct(
        ("priority_key", _int), ("priority_name", _text), ("sla_target_hours", _int)),
    "dim_calendar": _struct(
        ("date_key", _int), ("date", T.DateType()), ("day_of_week", _text), ("week_number", _int),
        ("month_number", _int), ("month_name", _text), ("quarter", _int), ("year", _int),
        ("is_weekend", _int), ("is_business_day", _int),
    ),
}

# Whole-second durations kept beside the exported hours, so that averages are exact integer sums.
FACT_SECONDS = ("resolution_seconds", "response_seconds")
