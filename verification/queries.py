"""Every operator as a query over the driver tables, next to its expected-result SQL.

``CASES`` maps a key to ``(callable, sql or None)``. Reports and star tables read a star that is
built once per session and state of the input files, and written below ``spark.checkpoint.dir``, as
a dashboard reads the tables of the latest build.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deskmart.functions.dates import as_text, parse_datetime
from deskmart.functions.numbers import to_count, to_number
from deskmart.functions.text import strip, tidy_label, tidy_priority, tidy_status
from deskmart.operators import checks, layouts, profile
from deskmart.operators.clean import (
    clean_tickets, prepare_cells, present_cells, project_columns, synthesize_ids, unparseable_dates,
)
from deskmart.operators.fact import Star
from deskmart.plans import reports
from deskmart.plans.context import FilterContext
from deskmart.plans.measures import MEASURES, evaluate, evaluate_open, formatted, open_tickets
from deskmart.schemas import CANONICAL, DATE_COLUMNS, STAR_TABLES
from deskmart.session import new_folder, prepare
from deskmart.sources import csv_ingest, tables
from deskmart.sources.ticket_adapter import AS_OF, raw_tickets
from verification import oracle as sql

Query = Callable[[SparkSession, str], DataFrame]
CASES: dict[str, tuple[Query, str | None]] = {}

ADAPTER_TABLES = ("events", "supplier", "nation", "customer", "part")


def register(name: str, expected: str | None = None) -> Callable[[Query], Query]:
    def keep(query: Query) -> Query:
        CASES[name] = (query, expected)
        return query
    return keep


# --- one build per session and input state ---------------------------------------------------------

_built: dict[tuple, str] = {}


def _input_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Digest of the input files' paths, sizes and times; a changed file means a new build."""
    files = spark.read.format("binaryFile").load(
        [f"{sf_dir}/{t}.parquet" for t in ADAPTER_TABLES])
    state = files.agg(F.count(F.lit(1)), F.sum("length"), F.max("modificationTime"), F.bit_xor(
        F.xxhash64("path", "length", "modificationTime"))).head()
    return spark.sparkContext.applicationId, sf_dir, *state


def _once(spark: SparkSession, sf_dir: str, purpose: str, make: Callable[[str], object]) -> str:
    prepare(spark)
    state = (purpose, _input_state(spark, sf_dir))
    if state not in _built:
        folder = new_folder(spark, purpose)
        make(folder)
        _built[state] = folder
    return _built[state]


def built(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Star]:
    folder = _once(spark, sf_dir, "star", lambda path: tables.build_tables(
        clean_tickets(raw_tickets(spark, sf_dir)), path, AS_OF))
    return tables.read_tables(spark, folder, AS_OF)


def star_of(spark: SparkSession, sf_dir: str) -> Star:
    return built(spark, sf_dir)[1]


# --- comparable output: times and dates as text, reals at six digits -----------------------------


def comparable(df: DataFrame) -> DataFrame:
    def shown(name: str, kind: str) -> Column:
        column = F.col(name)
        if kind.startswith("timestamp"):
            return as_text(column).alias(name)
        if kind == "date":
            return F.date_format(column, "yyyy-MM-dd").alias(name)
        if kind == "double":
            return F.round(column, 6).alias(name)
        return column
    return df.select(*(shown(name, kind) for name, kind in df.dtypes))


# --- A: sources and sinks ----------------------------------------------------------------------------

# The adapter's tickets as a directory of three CSV layouts: even event ids under canonical headers,
# odd ones under synonyms without team and description, and all of them once more without any
# creation time, which makes that layout unusable.
_SYNONYM_HEADERS = {
    "event_id": "Event No", "ticket_id": "Ticket ID", "created_at": "Open Date",
    "resolved_at": "closed-at", "first_response_at": "First Reply", "status": "State",
    "priority": "Severity", "category": "Type", "channel": "Via", "agent_name": "Assignee",
    "satisfaction_score": "CSAT", "reopen_count": "Reopens",
}


def _stored_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The adapter's tickets, written once for all layouts that are made of them."""
    tickets = raw_tickets(spark, sf_dir)
    folder = _once(spark, sf_dir, "tickets", tickets.write.parquet)
    return spark.read.schema(tickets.schema).parquet(folder)


def _write_csvs(tickets: DataFrame, folder: str) -> None:
    canonical = tickets.where("event_id % 2 = 0")
    synonyms = tickets.where("event_id % 2 = 1").select(
        *(F.col(c).alias(h) for c, h in _SYNONYM_HEADERS.items()))
    unusable = tickets.select("event_id", F.col("ticket_id").alias("id"), "status", "priority")
    for part in (canonical, synonyms, unusable):
        part.write.mode("append").options(**tables.CSV_OUT).csv(folder)


def ingested(spark: SparkSession, sf_dir: str) -> csv_ingest.Ingested:
    folder = _once(spark, sf_dir, "csv", lambda path: _write_csvs(
        _stored_tickets(spark, sf_dir), path))
    return csv_ingest.ingest(spark, folder)


_ABSENT = {"team", "description"}  # in the second layout
_CSV_CELLS = ", ".join(
    f"case when event_id % 2 = 1 then null else {c} end as {c}" if c in _ABSENT else c
    for c in sql.TEXT_COLUMNS)
_NA_CELLS = ", ".join(f"case when {c} not in ({sql.quoted(sql.NA_TOKENS)}) then {c} end as {c}"
                      for c in sql.TEXT_COLUMNS)


@register("a1_csv_scan", sql.from_source(
    f"select event_id, {_NA_CELLS} from (select event_id, {_CSV_CELLS} from src)"))
def a1_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1, A3, A5: every cell of the usable files, missing tokens as null."""
    frame = ingested(spark, sf_dir).frame
    event = F.coalesce("event_id", "`Event No`").cast("bigint").alias("event_id")
    return present_cells(frame.select(event, *CANONICAL))


# Descriptions that CSV readers trip over, by event id.
_HOSTILE = ("'plain, with comma'", "concat('two', chr(10), 'lines')", "concat('crlf', chr(13), chr(10), 'x')",
            "concat('old', chr(13), 'mac', chr(13))", "'say ""now""'", "'5"" disk'",
            "concat('a"",', chr(10), '""b""')", "concat(chr(10), chr(10), 'end')")
_HOSTILE_SQL = "case event_id % 8 " + " ".join(
    f"when {i} then {text.replace(chr(34) * 2, chr(34))}" for i, text in enumerate(_HOSTILE)) + " end"


@register("a1_spanning_records", sql.from_source(
    f"select event_id, {_HOSTILE_SQL} as description from src"))
def a1_spanning_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: large files whose quoted cells hold line breaks of all kinds, quotes and commas."""
    def write(path: str) -> None:
        rows = raw_tickets(spark, sf_dir).select(
            F.col("event_id").alias("id"), "created_at", F.expr(_HOSTILE_SQL).alias("body"))
        rows.repartitionByRange(3, "id").write.options(**tables.CSV_OUT, quoteAll=True).csv(path)

    frame = csv_ingest.ingest(spark, _once(spark, sf_dir, "spanning", write)).frame
    return frame.select(F.col("ticket_id").cast("bigint").alias("event_id"), "description")


# Six layouts by event id, the last two in files that file sources pass over.
_NUMBERED = ("0", "1", "2", "3", "_4", ".5")
_NUMBERED_COLUMNS = (
    {"event_id": "ref", "ticket_id": "id", "created_at": "created"}, {"created_at": "opened_at", "event_id": "ref", "ticket_id": "case id"},
    {"status": "state", "event_id": "ref", "created_at": "created", "ticket_id": "id"}, {"event_id": "ref", "created_at": "submitted", "status": "status"},
    {"priority": "urgency", "created_at": "created", "ticket_id": "id", "event_id": "ref"}, {"ticket_id": "id", "event_id": "ref", "created_at": "open date"})


def _if_written(column: str) -> str:
    having = ", ".join(str(i) for i, names in enumerate(_NUMBERED_COLUMNS) if column in names)
    return f"case when event_id % 6 in ({having}) then {column} end as {column}"


@register("a1_hidden_files", sql.from_source(
    "select event_id, " + ", ".join(map(_if_written, ("ticket_id", "created_at", "status", "priority"))) + ", case event_id % 6 "
    + " ".join(f"when {i} then '{name}'" for i, name in enumerate(_NUMBERED)) + " end as origin from src"))
def a1_hidden_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1, A4: numbered files beside files with hidden names, each kind with headers of its own."""
    def write(path: str) -> None:
        files = spark._jvm.org.apache.hadoop.fs
        system = files.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        system.mkdirs(files.Path(path))
        tickets = _stored_tickets(spark, sf_dir)
        for i, (name, columns) in enumerate(zip(_NUMBERED, _NUMBERED_COLUMNS)):
            part = new_folder(spark, "part")
            (tickets.where(f"event_id % 6 = {i}").select(*(F.col(c).alias(h) for c, h in columns.items()))
             .write.options(**tables.CSV_OUT).csv(part))
            written = [f.getPath() for f in system.listStatus(files.Path(part)) if f.getPath().getName().endswith(".csv")]
            for k, file in enumerate(written):
                system.rename(file, files.Path(f"{path}/{name}{k:05d}.csv"))

    frame = csv_ingest.ingest(spark, _once(spark, sf_dir, "hidden", write)).frame
    return frame.select(F.col("ref").cast("bigint").alias("event_id"), "ticket_id", "created_at", "status", "priority",
                        F.regexp_extract("_source_file", r"^([_.]?[0-9])", 1).alias("origin"))


# (rows of the layout, header, canonical column)
_MAPPED = [("event_id % 2 = 0", c, c) for c in CANONICAL] + [
    ("event_id % 2 = 1", h, c) for h, c in
    ((h, c) for c, h in _SYNONYM_HEADERS.items() if c != "event_id")] + [
    ("true", h, c) for h, c in
    (("id", "ticket_id"), ("status", "status"), ("priority", "priority"))]


@register("a2_header_mapping", sql.from_source("select distinct * from (" + " union all ".join(
    f"select '{h}' as raw_header, '{c}' as canonical from src where {w}" for w, h, c in _MAPPED)
    + ")"))
def a2_header_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: which headers of the directory were recognised as what."""
    return csv_ingest.header_mapping(ingested(spark, sf_dir)).select(
        "raw_header", "canonical").distinct()


@register("a3_file_eligibility", sql.from_source(
    "select included, cast(count(*) as bigint) as n from src, (values (true), (false)) v(included) "
    "group by 1"))
def a3_file_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: rows in usable and in skipped files."""
    return csv_ingest.file_summary(ingested(spark, sf_dir)).groupBy("included").agg(
        F.sum("rows").alias("n"))


@register("a4_lineage", sql.from_source(
    "select cast(count(*) as bigint) as traced, cast(count(distinct event_id) as bigint) as tickets "
    "from src"))
def a4_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: every row names a file that the directory listing knows."""
    found = ingested(spark, sf_dir)
    names = spark.createDataFrame([(f.name,) for f in found.files], "_source_file string")
    event = F.coalesce("event_id", "`Event No`")
    # one row per file and ticket first, so that the distinct count is a plain count per ticket
    per_ticket = found.frame.join(names, "_source_file", "left_semi").groupBy(
        event.alias("event")).agg(F.count(F.lit(1)).alias("n"))
    return per_ticket.agg(F.sum("n").alias("traced"), F.count("event").alias("tickets"))


@register("a5_union_by_name", sql.from_source("select " + ", ".join(
    f"cast(count({c}) as bigint) as {c}" for c in sql.TEXT_COLUMNS)
    + f" from (select {_CSV_CELLS} from src)"))
def a5_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: filled cells per canonical column; a column absent from a layout is null there."""
    frame = ingested(spark, sf_dir).frame
    return frame.agg(*(F.count(c).alias(c) for c in CANONICAL))


_RAW_TIMES = ", ".join(sql.at(c) for c in DATE_COLUMNS)
_RAW_REST = ("status, priority, category, channel, agent_name, team, "
             "round(satisfaction_score, 6) as satisfaction_score, reopen_count, description")


@register("a6_canonical_projection", sql.from_raw(
    f"select ticket_id, {_RAW_TIMES}, status, priority, category, channel, agent_name, "
    "case when event_id % 2 = 0 then team end as team, "
    "round(satisfaction_score, 6) as satisfaction_score, reopen_count, description from raw"))
def a6_canonical_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 with A1-A5 and B1-B11: the CSV directory as typed canonical tickets."""
    return comparable(csv_ingest.load_tickets(ingested(spark, sf_dir)))


@register("a7_raw_sink", sql.from_raw(f"select ticket_id, {_RAW_TIMES}, {_RAW_REST} from raw"))
def a7_raw_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written ``raw_tickets`` table, read back."""
    return comparable(built(spark, sf_dir)[0])


def _as_rows(name: str, columns: list[str]) -> str:
    """SQL text: the columns of a table as one text per row."""
    cells = " || '|' || ".join(f"coalesce(cast({c} as string), '')" for c in columns)
    return f"select '{name}' as table_name, {cells} as content"


_CONTENT_COLUMNS = {
    "fact_tickets": ["ticket_id", *"agent_key category_key channel_key priority_key created_date_key status "
                     "ticket_age_band sla_breached".split()],
} | {t: [f.name for f in STAR_TABLES[t]] for t in STAR_TABLES if t != "fact_tickets"}


@register("a8_idempotent_rebuild", sql.from_star(" union all ".join(
    f"{_as_rows(t, c)} from {'fact' if t == 'fact_tickets' else t}" for t, c in _CONTENT_COLUMNS.items())))
def a8_idempotent_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writing the star twice to one place, and a third time without an end, leaves each row of each table once."""
    star = star_of(spark, sf_dir)
    folder = new_folder(spark, "rebuild")
    tables.write_star(star, folder)
    tables.write_star(star, folder)
    star.fact.limit(0).write.parquet(f"{folder}/{tables.VERSIONS}/stopped/fact_tickets")
    return _contents(tables.read_star(spark, folder, AS_OF).tables())


def _contents(star_tables: dict[str, DataFrame]) -> DataFrame:
    parts = []
    for name, columns in _CONTENT_COLUMNS.items():
        cells = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)
        parts.append(star_tables[name].select(F.lit(name).alias("table_name"), F.concat_ws("|", *cells).alias("content")))
    return reduce(DataFrame.unionAll, parts)


def _exported(spark: SparkSession, sf_dir: str) -> str:
    return _once(spark, sf_dir, "export",
                 lambda path: tables.export_csv(star_of(spark, sf_dir), path))


_FACT_TIMES = ", ".join(sql.at(c) for c in DATE_COLUMNS)
_FACT_KEYS = "agent_key, category_key, channel_key, priority_key, created_date_key"
_FACT_HOURS = ("round(resolution_hours, 6) as resolution_hours, "
               "round(response_hours, 6) as response_hours")
_FACT_SQL = sql.from_star(
    f"select ticket_id, {_FACT_TIMES}, status, {_FACT_KEYS}, "
    "round(satisfaction_score, 6) as satisfaction_score, reopen_count, "
    f"{_FACT_HOURS}, sla_target_hours, sla_breached, is_first_contact_resolved, ticket_age_band "
    "from fact")


@register("a9_csv_export", sql.from_star(
    f"select ticket_id, {_FACT_TIMES}, status, " + ", ".join(
        f"cast({c} as varchar) as {c}" for c in (*_FACT_KEYS.split(", "), "reopen_count", "sla_target_hours",
                                                 "sla_breached", "is_first_contact_resolved"))
    + f", {_FACT_HOURS}, round(satisfaction_score, 6) as satisfaction_score, ticket_age_band from fact"))
def a9_csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exported fact as the text cells of its CSV files; reals compared as numbers."""
    cells = spark.read.option("header", True).csv(f"{_exported(spark, sf_dir)}/fact_tickets")
    reals = {c: F.round(F.col(c).cast("double"), 6) for c in (
        "resolution_hours", "response_hours", "satisfaction_score")}
    return cells.withColumns(reals)


def _broken(text: Column) -> Column:
    """Line breaks and backslashes put into a label."""
    return F.concat(text, F.lit("\n\\n\r\\"), F.length(text).cast("string"))


_BREAKS_SQL = "|| chr(10) || chr(92) || 'n' || chr(13) || chr(92) || cast(length({c}) as varchar)"
_LABELS = {"dim_agent": ("agent_name", "team"), "dim_category": ("category_name",), "dim_channel": ("channel_name",),
           "dim_priority": ("priority_name",), "fact_tickets": ("ticket_id",), "dim_calendar": ()}


@register("a10_typed_reread", _FACT_SQL)
def a10_typed_reread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: the exported fact with its types restored."""
    return comparable(tables.read_csv_table(spark, _exported(spark, sf_dir), "fact_tickets"))


@register("a10_round_trip", sql.from_star(" union all ".join(
    _as_rows(t, [f"({n} {_BREAKS_SQL.format(c=n)})" if n in _LABELS[t] else n for n in c])
    + f" from {'fact' if t == 'fact_tickets' else t}" for t, c in _CONTENT_COLUMNS.items())))
def a10_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All six tables with line breaks in their labels, exported and read again."""
    star = star_of(spark, sf_dir)
    broken = {name: table.withColumns({c: _broken(F.col(c)) for c in _LABELS[name]})
              for name, table in star.tables().items()}
    changed = replace(star, fact=broken["fact_tickets"], **{
        name.removeprefix("dim_"): broken[name] for name in broken if name != "fact_tickets"})
    folder = new_folder(spark, "round-trip")
    tables.export_csv(changed, folder)
    return _contents({name: tables.read_csv_table(spark, folder, name) for name in broken})


# --- B: cleaning ----------------------------------------------------------------------------------


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = raw_tickets(spark, sf_dir)
    return source.select("event_id", *CANONICAL)


def _cleaned(spark: SparkSession, sf_dir: str, *columns: Column) -> DataFrame:
    source = _cells(spark, sf_dir)
    text = prepare_cells(source.select(F.col("event_id").cast("string"), *CANONICAL))
    return text.select(F.col("event_id").cast("bigint").alias("event_id"), *columns)


_DAY, _MON, _YEAR = "strftime(ts, '%d')", "strftime(ts, '%m')", "strftime(ts, '%Y')"
_SWAP = ("case when day(ts) <= 12 then make_timestamp(year(ts), day(ts), month(ts), {h}, {m}, {s}) "
         "else make_timestamp(year(ts), month(ts), day(ts), {h}, {m}, {s}) end")


def _midnight(text: str) -> str:
    return f"cast(cast({text} as date) as timestamp)"


_FULL = {"h": "hour(ts)", "m": "minute(ts)", "s": "second(ts)"}
_TO_SECOND, _TO_MINUTE = "date_trunc('second', ts)", "date_trunc('minute', ts)"
# pattern of the text -> the moment it must be read as
_LAYOUTS = (
    ("yyyy-MM-dd HH:mm:ss", _TO_SECOND),
    ("yyyy-M-d H:m:s", _TO_SECOND),
    ("yyyy-MM-dd HH:mm", _TO_MINUTE),
    ("yyyy-MM-dd", _midnight("ts")),
    ("MM/dd/yyyy HH:mm:ss", _TO_SECOND),
    ("M/d/yyyy H:m", _TO_MINUTE),
    ("M/d/yyyy", _midnight("ts")),
    ("dd/MM/yyyy HH:mm:ss", _SWAP.format(**_FULL)),
    ("dd/MM/yyyy", _SWAP.format(h=0, m=0, s=0)),
    ("yyyy/MM/dd", _midnight("ts")),
    ("yyyy-MM-dd'T'HH:mm:ss", _TO_SECOND),
    ("yyyy-MM-dd HH:mm:ss.SSSSSS", _TO_SECOND),
    ("yyyy-MM-dd'T'HH:mm:ss'Z'", _TO_SECOND),
    ("yyyy-MM-dd'T'HH:mm:ss'+05:30'", f"{_TO_SECOND} - interval 330 minute"),
    ("dd/MM/yyyy HH:mm", _SWAP.format(h="hour(ts)", m="minute(ts)", s=0)),
    ("yyyy/M/d H:m:s", _TO_SECOND),
    ("d-MMM-yyyy", _midnight("ts")),
    ("MMM d, yyyy", _midnight("ts")),
    ("MMMM yyyy", "date_trunc('month', ts)"),
    ("yyyyMMdd", _midnight("ts")),
    ("M/d/yy", _midnight("ts")),
    ("M.d.yyyy", _midnight("ts")),
    ("M/d/yyyy h:mm a", _TO_MINUTE),
    ("'week' D", "null"),
    ("yyyy-MM-'32' HH:mm", "null"),
    ("'9999'-MM-dd HH:mm:ss", "null"),
    ("'0001'-MM-dd", "null"),
    ("M/d/'1600'", "null"),
    ("'2262-04-11 23:47:16'", "timestamp '2262-04-11 23:47:16'"),
    ("'2262-04-11 23:47:17'", "null"),
)


@register("b1_parse_dates", "select event_id, strftime(case event_id % "
          f"{len(_LAYOUTS)} " + " ".join(f"when {i} then {moment}" for i, (_, moment)
                                        in enumerate(_LAYOUTS))
          + " end, '%Y-%m-%d %H:%M:%S') as parsed from events")
def b1_parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: every event time, written in one of the accepted (or unusable) layouts and read back."""
    prepare(spark)
    text = F.lit(None).cast("string")
    for i, (pattern, _) in enumerate(_LAYOUTS):
        text = F.when(F.col("event_id") % len(_LAYOUTS) == i,
                      F.date_format("ts", pattern)).otherwise(text)
    written = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", F.concat(F.lit(" "), text, F.lit("\t")).alias("text"))
    stripped = written.select("event_id", strip(F.col("text")).alias("text"))
    return comparable(stripped.select("event_id", parse_datetime(F.col("text")).alias("parsed")))


# What five files write, the moment it stands for, and which events they hold
_FILE_LAYOUTS = (
    ("dd/MM/yyyy HH:mm", _TO_MINUTE, "true"), ("M/d/yyyy h:mm a", _TO_MINUTE, "true"), ("d.M.yyyy", _midnight("ts"), "true"),
    ("dd-MM-yy", _midnight("ts"), "true"), ("M/d/yyyy", _midnight("ts"), "day(ts) <= 12"))


def _file_of(event: str, values: Sequence[str]) -> str:
    return f"case {event} % 5 " + " ".join(f"when {i} then {v}" for i, v in enumerate(values)) + " end"


def _layout_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    text = F.lit(None).cast("string")
    for i, (pattern, _, held) in enumerate(_FILE_LAYOUTS):
        text = F.when((F.col("event_id") % 5 == i) & F.expr(held), F.date_format("ts", pattern)).otherwise(text)
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", F.concat(F.lit(" "), text).alias("created_at"), F.concat((F.col("event_id") % 5).cast("string"), F.lit(".csv")).alias("_source_file"))


@register("b1_inferred_layouts", "select event_id, strftime(" + _file_of(
    "event_id", [f"case when {held} then {moment} end" for _, moment, held in _FILE_LAYOUTS])
    + ", '%Y-%m-%d %H:%M:%S') as created_at from events")
def b1_inferred_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: every event time in the layout of its file, days or months first, told by evidence."""
    files = _layout_files(spark, sf_dir)
    read = layouts.apply_layouts(files, layouts.choose_layouts(layouts.date_masks(files)))
    return comparable(read.select("event_id", parse_datetime(strip(F.col("created_at"))).alias("created_at")))


@register("b1_date_masks", "select event_id % 5 || '.csv' as file, mask, first, evidence, cast(count(*) as bigint) as n from "
          "(select *, " + _file_of("event_id", ("'n/n/y n:n'", "'n/n/y n:n a'", "'n.n.y'", "'n-n-n'", "'n/n/y'")) + " as mask, "
          + _file_of("event_id", ("'day'", "'month'", "'day'", "'day'", "'month'")) + " as first, "
          + _file_of("event_id", ("'certain'",) * 4 + ("'ambiguous'",)) + " as evidence from events where event_id % 5 < 4 or day(ts) <= 12) "
          "group by all")
def b1_date_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: shapes of all cells per file, the order chosen and how sure it is."""
    masks = layouts.date_masks(_layout_files(spark, sf_dir))
    chosen = layouts.choose_layouts(masks).select("_source_file", "separator", "first", "evidence")
    return masks.join(chosen, ["_source_file", "separator"]).select(
        F.col("_source_file").alias("file"), "mask", "first", "evidence", "n")


@register("b2_unparseable_dates", sql.from_cells(" union all ".join(
    f"select '{c}' as column_name, cast(count(*) filter (where {c} is not null and "
    f"{sql.parse(c)} is null) as bigint) as unparseable from cells" for c in DATE_COLUMNS)))
def b2_unparseable_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unparseable_dates(raw_tickets(spark, sf_dir))


@register("b3_response_from_hours", sql.from_raw(
    "select r.event_id, strftime(case when r.event_id % 7 <> 0 then r.created_at + "
    "to_seconds(cast(floor(round((v.event_id % 400) / 8.0::double * 3600.0::double, 6)) as bigint)) "
    "end, '%Y-%m-%d %H:%M:%S') as first_response_at "
    "from raw r join events v on v.event_id = r.event_id"))
def b3_response_from_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No response time in the source, but a latency in hours."""
    event = F.col("event_id")
    hours = F.when(event % 7 != 0, ((event % 400) / 8.0).cast("string")).otherwise("N/A")
    source = _cells(spark, sf_dir).drop("first_response_at").select(
        event.cast("string").alias("ticket_id"), "created_at",
        hours.alias("first_response_time_hours"))
    return comparable(clean_tickets(source).select(
        F.col("ticket_id").cast("bigint").alias("event_id"), "first_response_at"))


def _without_ids(spark: SparkSession, sf_dir: str) -> csv_ingest.Ingested:
    """The adapter's tickets as sorted CSV files whose ids all spell "missing"."""
    def write(path: str) -> None:
        rows = raw_tickets(spark, sf_dir).select(
            "event_id", F.when(F.col("event_id") % 2 == 0, "N/A").otherwise("n/a").alias("id"), "created_at")
        (rows.repartitionByRange("event_id").sortWithinPartitions("event_id")
         .write.options(**tables.CSV_OUT).csv(path))

    return csv_ingest.ingest(spark, _once(spark, sf_dir, "no-ids", write))


@register("b4_synthetic_ids", sql.from_source(
    "select event_id, cast(row_number() over (order by event_id) as varchar) as ticket_id from src"))
def b4_synthetic_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids 1..n in (file, line) order for a directory without any id."""
    frame = synthesize_ids(_without_ids(spark, sf_dir).frame, profile.BLOCK, profile.LINE)
    return frame.select(F.col("event_id").cast("bigint").alias("event_id"), "ticket_id")


@register("b5_priority", sql.from_raw("select event_id, priority from raw"))
def b5_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned(spark, sf_dir, tidy_priority(F.col("priority")).alias("priority"))


@register("b6_status", sql.from_raw("select event_id, status from raw"))
def b6_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned(spark, sf_dir, tidy_status(F.col("status")).alias("status"))


@register("b7_title_case", sql.from_raw(
    "select event_id, category, channel, agent_name, team from raw"))
def b7_title_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = ("category", "channel", "agent_name", "team")
    return _cleaned(spark, sf_dir, *(tidy_label(F.col(c)).alias(c) for c in labels))


@register("b8_satisfaction", sql.from_raw(
    "select event_id, round(satisfaction_score, 6) as satisfaction_score from raw"))
def b8_satisfaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_cleaned(
        spark, sf_dir, to_number(F.col("satisfaction_score")).alias("satisfaction_score")))


@register("b9_reopen_count", sql.from_raw("select event_id, reopen_count from raw"))
def b9_reopen_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned(spark, sf_dir, to_count(F.col("reopen_count")).alias("reopen_count"))


@register("b10_null_cells", sql.from_cells("select " + ", ".join(
    f"cast(count(*) filter (where {c} is null) as bigint) as {c}" for c in CANONICAL)
    + " from cells"))
def b10_null_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls per column once the missing tokens are gone."""
    cells = present_cells(project_columns(raw_tickets(spark, sf_dir)))
    return cells.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in CANONICAL))


@register("b11_second_precision",
          "select event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') as created_at "
          "from events")
def b11_second_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Microseconds are cut, not rounded."""
    prepare(spark)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return comparable(events.select("event_id", parse_datetime(text).alias("created_at")))


# --- C: profiling ---------------------------------------------------------------------------------


def _unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The adapter's cells with the position columns of an ingested frame."""
    return raw_tickets(spark, sf_dir).select(
        *CANONICAL, F.lit("events").alias("_source_file"),
        F.floor(F.col("event_id") / 1000).alias(profile.BLOCK),
        F.col("event_id").alias(profile.LINE))


_PROFILED = [*CANONICAL, "_source_file"]
_PRESENT = (f"(select event_id, {_NA_CELLS}, 'events' as _source_file from src)")


def _per_column(select: Callable[[str], str], columns=_PROFILED) -> str:
    return sql.from_source(" union all ".join(select(c) for c in columns))


# Columns of a layout that no header feeds.
_LACKING = {True: "team, description", False: ", ".join(
    c for c in CANONICAL if c not in ("ticket_id", "status", "priority"))}


@register("c1_file_summary", sql.from_source(
    "select true as included, cast(13 as integer) as mapped_columns, 'OK' as reason, '' as missing_columns, "
    "cast(0 as bigint) as surplus_rows, cast(count(*) as bigint) as n from src where event_id % 2 = 0 "
    f"union all select true, cast(11 as integer), 'OK', '{_LACKING[True]}', 0, "
    "cast(count(*) as bigint) from src where event_id % 2 = 1 "
    f"union all select false, cast(3 as integer), 'no header stands for created_at', '{_LACKING[False]}', "
    "0, cast(count(*) as bigint) from src"))
def c1_file_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 summed over files of one layout (file names differ from run to run)."""
    return csv_ingest.file_summary(ingested(spark, sf_dir)).groupBy(
        "included", "mapped_columns", "reason", "missing_columns").agg(
        F.sum("surplus_rows").alias("surplus_rows"), F.sum("rows").alias("n"))


@register("c2_header_mapping", sql.from_source(
    "select raw_header, canonical, cast(sum(n) as bigint) as n from (" + " union all ".join(
        f"select '{h}' as raw_header, '{c}' as canonical, count(*) as n from src where {w}"
        for w, h, c in _MAPPED) + ") group by 1, 2"))
def c2_header_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each mapped header with the rows of the files it was found in."""
    found = ingested(spark, sf_dir)
    sizes = csv_ingest.file_summary(found).select("file", "rows")
    return csv_ingest.header_mapping(found).join(sizes, "file").groupBy(
        "raw_header", "canonical").agg(F.sum("rows").alias("n"))


@register("c3_null_counts", _per_column(
    lambda c: f"select '{c}' as column_name, cast(count(*) as bigint) as total, "
    f"cast(count(*) - count({c}) as bigint) as nulls, "
    f"round(coalesce((count(*) - count({c})) / nullif(count(*), 0)::double, 0) * 100.0::double, 6) "
    f"as null_pct, cast(count(distinct {c}) as bigint) as distinct_values from {_PRESENT}"))
def c3_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(profile.null_counts(profile.column_stats(_unified(spark, sf_dir))))


_STORED = ("created_at", "priority", "satisfaction_score", "reopen_count", "status")


@register("c3_stored_profile", sql.from_source(" union all ".join(
    f"select '{c}' as column_name, cast(count(*) as bigint) as total, cast(count(*) - count(v) as bigint) as nulls, "
    f"min(try_cast(v as double)) as min, max(try_cast(v as double)) as max, true as distinct_close from "
    f"(select case when {c} not in ({sql.quoted(sql.NA_TOKENS)}) then trim({c}) end as v from src)" for c in _STORED)))
def c3_stored_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged profile after two updates, the second of which reads the later files only."""
    def write(path: str) -> None:
        for k in (0, 1):
            tickets = raw_tickets(spark, sf_dir).where(f"event_id % 3 = 0 = ({k} = 0)").select("ticket_id", *_STORED)
            tickets.write.mode("append").options(**tables.CSV_OUT).csv(f"{path}/in")
            csv_ingest.StoredProfile(spark, f"{path}/store").update(f"{path}/in")

    folder = _once(spark, sf_dir, "stored", write)
    merged = csv_ingest.StoredProfile(spark, f"{folder}/store").columns()
    counted = profile.column_stats(raw_tickets(spark, sf_dir).select(*_STORED)).select("column_name", F.col("distinct_values").alias("n"))
    return merged.join(counted, "column_name").select(
        "column_name", "total", "nulls", "min", "max", (F.abs(F.col("distinct_values") - F.col("n")) <= 0.03 * F.col("n")).alias("distinct_close"))


@register("c4_column_types", _per_column(
    lambda c: f"select '{c}' as column_name, case "
    f"when bool_and(regexp_full_match(trim({c}), '[+-]?\\d+') and ({c} is null or try_cast(trim({c}) as bigint) is not null)) "
    f"then 'bigint' "
    f"when bool_and(regexp_full_match(trim({c}), '[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?')) "
    f"then 'double' when bool_and(lower(trim({c})) in ('true', 'false')) then 'boolean' "
    f"else 'string' end as data_type from {_PRESENT}"))
def c4_column_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.column_types(profile.column_stats(_unified(spark, sf_dir)))


@register("c5_samples", _per_column(
    lambda c: f"select * from (select '{c}' as column_name, cast(row_number() over "
    f"(order by event_id) as integer) as ordinal, {c} as value from {_PRESENT} "
    f"where {c} is not null) where ordinal <= 10"))
def c5_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten values of each column, which is the feature itself."""
    return profile.samples(_unified(spark, sf_dir))


def _shape(c: str) -> str:
    v = f"trim({c})"
    return (f"case when {c} is null then null when {v} = '' then 'empty' "
            f"when regexp_matches({v}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}') then 'iso' "
            f"when regexp_matches({v}, '^\\d{{1,2}}/\\d{{1,2}}/\\d{{2,4}}') then 'us' "
            "else 'other' end")


def _shape_counts(c: str) -> str:
    return ", ".join(f"cast(count(*) filter (where {_shape(c)} = '{s}') as bigint) as {s}"
                     for s in profile.DATE_FORMATS)


@register("c6_date_formats", _per_column(
    lambda c: f"select '{c}' as column_name, {_shape_counts(c)} from {_PRESENT}", DATE_COLUMNS))
def c6_date_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.date_formats(_unified(spark, sf_dir))


# Cells over 64 characters in every shape, and whole numbers up to and beyond 64 bits.
_LONG = {
    "created_at": ("case event_id % 5 when 0 then {pad} when 1 then concat({pad}, '2024-01-', {n}) "
                   "when 2 then concat({pad}, '3/4/2024', {pad}) when 3 then concat('note ', {n}, {pad}) "
                   "else concat('20', {n}, '-01-01') end"),
    "ticket_id": "concat('12345678901234567', {n})",
    "reopen_count": "concat('1234567890123456789', {n})",
    "status": "case event_id % 2 when 0 then concat({pad}, 'true') else 'FALSE' end",
}
_LONG_KINDS = {"created_at": "string", "ticket_id": "bigint", "reopen_count": "double", "status": "boolean"}


def _long_cells(text_type: str) -> str:
    filled = {c: cell.format(pad="repeat(chr(32), 70)", n=f"cast(10 + event_id % 90 as {text_type})")
              for c, cell in _LONG.items()}
    return ", ".join(f"{cell} as {c}" for c, cell in filled.items())


@register("c6_long_cells", " union all ".join(
    f"select '{c}' as column_name, '{kind}' as data_type, cast(count(distinct {c}) as bigint) as "
    f"distinct_values, {_shape_counts(c)} from (select {_long_cells('varchar')} from events)"
    for c, kind in _LONG_KINDS.items()))
def c6_long_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4 and C6 of padded, blank and long cells, where exact and estimating passes agree."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    frame = events.selectExpr(f"inline(array(struct({_long_cells('string')})))")
    exact, estimated = (profile.column_stats(frame, approximate=a) for a in (False, True))

    def shaped(stats: DataFrame) -> DataFrame:
        return profile.column_types(stats).join(stats.select("column_name", *profile.DATE_FORMATS), "column_name")

    counted = profile.null_counts(exact).select("column_name", "distinct_values")
    return shaped(exact).intersect(shaped(estimated)).join(counted, "column_name")


@register("c7_numeric_stats", _per_column(
    lambda c: f"select '{c}' as column_name, min(v) as min, max(v) as max, round(avg(v), 6) as mean, "
    f"cast(count(*) filter (where v < 0) as bigint) as negatives from "
    f"(select try_cast({c} as double) as v from {_PRESENT})",
    ("satisfaction_score", "reopen_count")))
def c7_numeric_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(profile.numeric_stats(profile.column_stats(_unified(spark, sf_dir))))


def _issues() -> str:
    mix = " || ', ' || ".join(f"'{s}=' || cast({s} as varchar)" for s in profile.DATE_FORMATS)
    parts = [f"select 'all_null' as rule, '{c}' as column_name, '100% null' as detail "
             f"from {_PRESENT} having count({c}) = 0" for c in _PROFILED]
    for c in DATE_COLUMNS:
        counts = f"(select {_shape_counts(c)} from {_PRESENT})"
        parts.append(f"select 'mixed_date_formats', '{c}', {mix} from {counts} "
                     "where (iso > 0)::int + (us > 0)::int + (other > 0)::int > 1")
        parts.append(f"select 'unrecognized_dates', '{c}', cast(other as varchar) from {counts} "
                     "where other > 0")
    for c in ("satisfaction_score", "reopen_count"):
        parts.append(f"select 'negative_values', '{c}', cast(n as varchar) from (select count(*) "
                     f"as n from {_PRESENT} where try_cast({c} as double) < 0) where n > 0")
    return sql.from_source(" union all ".join(parts))


@register("c8_quality_issues", _issues())
def c8_quality_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.quality_issues(_unified(spark, sf_dir))


@register("c9_totals", sql.from_source(
    "select cast(1 as bigint) as files, cast(count(*) as bigint) as total, "
    f"cast({len(_PROFILED)} as integer) as columns, '{','.join(CANONICAL)}' as present, "
    "'' as absent from src"))
def c9_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.totals(_unified(spark, sf_dir))


# --- D: dimensions --------------------------------------------------------------------------------


def _dim(name: str, attribute: str) -> None:
    register(name, sql.from_star(f"select * from dim_{attribute}"))(
        lambda spark, sf_dir: comparable(getattr(star_of(spark, sf_dir), attribute)))


for _name, _attribute in (("d1_dim_agent", "agent"), ("d2_dim_category", "category"),
                          ("d3_dim_channel", "channel"), ("d4_dim_priority", "priority"),
                          ("d5_dim_calendar", "calendar")):
    _dim(_name, _attribute)


@register("d6_surrogate_keys", sql.from_star(" union all ".join(
    f"select '{t}' as dim, cast(min({t}_key) as integer) as first_key, "
    f"cast(max({t}_key) as integer) as last_key, cast(count(*) as bigint) as members from dim_{t}"
    for t in ("agent", "category", "channel", "priority"))))
def d6_surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys run from 1 to the number of members without a gap."""
    star = star_of(spark, sf_dir)
    parts = [getattr(star, t).agg(F.min(f"{t}_key").alias("first_key"),
                                  F.max(f"{t}_key").alias("last_key"),
                                  F.count_distinct(f"{t}_key").alias("members"))
             .select(F.lit(t).alias("dim"), "first_key", "last_key", "members")
             for t in ("agent", "category", "channel", "priority")]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])


@register("d7_unknown_members", sql.from_star(
    "select agent_name, team, category_name, channel_name, priority_name, "
    "cast(count(*) as bigint) as tickets from fact where agent_name = '(Unassigned)' "
    "or team = '(Unknown)' or category_name = '(Uncategorized)' or channel_name = '(Unknown)' "
    "or priority_name = '(Unknown)' group by all"))
def d7_unknown_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickets that landed on a placeholder in any dimension."""
    names = ["agent_name", "team", "category_name", "channel_name", "priority_name"]
    rows = evaluate(star_of(spark, sf_dir), ["total_tickets"], names)
    return rows.where(
        "agent_name = '(Unassigned)' or team = '(Unknown)' or category_name = '(Uncategorized)' "
        "or channel_name = '(Unknown)' or priority_name = '(Unknown)'"
    ).withColumnRenamed("total_tickets", "tickets")


# --- E: fact --------------------------------------------------------------------------------------

register("e_fact", _FACT_SQL)(
    lambda spark, sf_dir: comparable(star_of(spark, sf_dir).tables()["fact_tickets"]))

for _key, _columns in {
    "e1_dimension_keys": "agent_key, category_key, channel_key, priority_key",
    "e2_created_date_key": "created_date_key",
    "e3_resolution_hours": "resolution_hours",
    "e4_response_hours": "response_hours",
    "e5_sla_target": "sla_target_hours",
    "e6_sla_breached": "sla_breached",
    "e7_first_contact": "is_first_contact_resolved",
    "e8_age_band": "ticket_age_band",
    "e9_reopen_default": "reopen_count",
    "e10_pass_through": "created_at, resolved_at, first_response_at, status, satisfaction_score",
}.items():
    _names = ["ticket_id", *_columns.split(", ")]
    _sql_names = ", ".join(
        sql.at(c) if c in DATE_COLUMNS else f"round({c}, 6) as {c}"
        if c.endswith("_hours") and c != "sla_target_hours" or c == "satisfaction_score" else c
        for c in _names)
    register(_key, sql.from_star(f"select {_sql_names} from fact"))(
        lambda spark, sf_dir, names=tuple(_names): comparable(
            star_of(spark, sf_dir).fact.select(*names)))


# --- F: checks ------------------------------------------------------------------------------------

_BAD_DATES = "created_date_key is null or created_date_key not in (select date_key from dim_calendar)"


def _bad(where: str) -> str:
    return sql.from_star(f"select cast(count(*) as bigint) as bad_rows from fact where {where}")


register("f1_dates_without_calendar", _bad(_BAD_DATES))(
    lambda spark, sf_dir: checks.dates_without_calendar(star_of(spark, sf_dir)))
register("f2_facts_without_agent", _bad("agent_key is null"))(
    lambda spark, sf_dir: checks.facts_without_agent(star_of(spark, sf_dir)))
register("f3_breaches_by_priority", sql.from_star(
    "select priority_name, cast(count(*) as bigint) as breached_tickets from fact "
    "where sla_breached = 1 group by 1"))(
    lambda spark, sf_dir: checks.breaches_by_priority(star_of(spark, sf_dir)))
register("f4_negative_resolution", _bad("resolution_hours < 0"))(
    lambda spark, sf_dir: checks.negative_resolution(star_of(spark, sf_dir)))
register("f5_row_parity", sql.from_star(
    "select *, case when raw_rows = fact_rows then 'PASS' else 'FAIL' end as result from (select "
    "(select cast(count(*) as bigint) from raw) as raw_rows, "
    "(select cast(count(*) as bigint) from fact) as fact_rows)"))(
    lambda spark, sf_dir: checks.row_parity(*built(spark, sf_dir)))
register("f6_all_checks", sql.from_star(
    "select n as \"check\", label, value, case when n = 3 then 'INFO' when value = 0 then 'PASS' "
    "else 'FAIL' end as status from ("
    "select 1 as n, 'facts without a calendar date' as label, "
    f"cast(count(*) filter (where {_BAD_DATES}) as bigint) as value from fact "
    "union all select 2, 'facts without an agent', "
    "cast(count(*) filter (where agent_key is null) as bigint) from fact "
    "union all select 3, 'breached tickets', cast(sum(sla_breached) as bigint) from fact "
    "union all select 4, 'negative resolution hours', "
    "cast(count(*) filter (where resolution_hours < 0) as bigint) from fact "
    "union all select 5, 'raw rows minus fact rows', "
    "cast((select count(*) from raw) - count(*) as bigint) from fact)"))(
    lambda spark, sf_dir: checks.all_checks(*built(spark, sf_dir)))


# --- G: filter context ----------------------------------------------------------------------------

_KPIS = ("total_tickets", "tickets_resolved", "mttr_hours", "sla_compliance_rate", "avg_csat")
_CONTEXTS = {
    "g2_date_between": (FilterContext(date(2024, 1, 5), date(2024, 1, 20)),
                        "date between '2024-01-05' and '2024-01-20'"),
    "g3_last_30_days": (FilterContext.last_days(AS_OF),
                        "date between '2024-01-02' and '2024-01-31'"),
    "g4_members": (FilterContext(priorities=("Critical", "Planned"), channels=("Machinery",),
                                 categories=("Promo", "(Uncategorized)")),
                   "priority_name in ('Critical', 'Planned') and channel_name = 'Machinery' "
                   "and category_name in ('Promo', '(Uncategorized)')"),
    "g_filters": (FilterContext.last_days(AS_OF, 14, priorities=("High", "Medium")),
                  "date between '2024-01-18' and '2024-01-31' "
                  "and priority_name in ('High', 'Medium')"),
}
for _key, (_context, _where) in _CONTEXTS.items():
    register(_key, sql.measures(_KPIS, ["team"], _where))(
        lambda spark, sf_dir, context=_context: comparable(
            evaluate(star_of(spark, sf_dir), _KPIS, ["team"], context)))

register("g1_star_join", sql.from_star(
    "select agent_name, team, category_name, channel_name, priority_name, date, "
    "cast(count(*) as bigint) as total_tickets from fact group by all"))(
    lambda spark, sf_dir: comparable(evaluate(
        star_of(spark, sf_dir), ["total_tickets"],
        ["agent_name", "team", "category_name", "channel_name", "priority_name", "date"])))


# One context for all pages: the same four numbers must come out of four datasets.
_SYNCED = FilterContext(date(2024, 1, 10), date(2024, 1, 25), channels=("Machinery", "Building"))
_SYNCED_SQL = ("date between '2024-01-10' and '2024-01-25' "
               "and channel_name in ('Machinery', 'Building')")


@register("g5_synced_pages", sql.from_star(
    " union all ".join(f"select '{page}' as page, cast(count(*) as bigint) as tickets from fact "
                       f"where {_SYNCED_SQL}" for page in
                       ("agent_matrix", "overview_cards", "tickets_by_priority",
                        "tickets_over_time"))))
def g5_synced_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = reports.dashboard(star_of(spark, sf_dir), _SYNCED)
    parts = [pages[p].agg(F.sum("total_tickets").alias("tickets")).select(
        F.lit(p).alias("page"), "tickets") for p in
        ("agent_matrix", "overview_cards", "tickets_by_priority", "tickets_over_time")]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])


# --- H: measures ----------------------------------------------------------------------------------


def _measure(key: str, names, by=()) -> None:
    register(key, sql.measures(names, by))(
        lambda spark, sf_dir: comparable(evaluate(star_of(spark, sf_dir), names, by)))


for _measure_name, _m in MEASURES.items():
    _measure(f"h{int(_m.id[1:]):02d}_{_measure_name}", [_measure_name], ["priority_name"])

for _theme, _names, _by in (
    ("volume", ["total_tickets", "tickets_created", "tickets_resolved", "tickets_open",
                "tickets_by_day"], ["date"]),
    ("efficiency", ["mttr_hours", "mttr_display", "mtta_hours", "mtta_display"], ["channel_name"]),
    ("fcr", ["fcr_count", "fcr_rate", "fcr_rate_display"], ["team"]),
    ("sla", ["sla_compliant_count", "sla_breach_count", "sla_compliance_rate",
             "sla_compliance_display", "sla_at_risk", "sla_breach_rate"], ["category_name"]),
    ("backlog", ["backlog_count", "oldest_open_days", "band_0_1_day", "band_1_3_days",
                 "band_3_7_days", "band_over_7_days"], ["status"]),
    ("agent", ["tickets_per_agent", "agent_mttr", "agent_fcr_rate", "agent_sla_compliance"],
     ["agent_name"]),
    ("csat", ["avg_csat", "csat_display", "csat_satisfied_rate", "csat_dissatisfied_rate"],
     ["category_name", "channel_name"]),
):
    _measure(f"h_theme_{_theme}", _names, _by)

_measure("h_all_measures", list(MEASURES))


# --- I: report datasets ---------------------------------------------------------------------------


def _light(rate: str, orange: int) -> str:
    return (f"case when {rate} >= 95 then 'green' when {rate} >= {orange} then 'orange' "
            "else 'red' end")


_SLA_RATE = sql.MEASURE_SQL["sla_compliance_rate"]


def _report(key: str, expected: str, query: Callable[[Star], DataFrame]) -> None:
    register(key, expected)(lambda spark, sf_dir: comparable(query(star_of(spark, sf_dir))))


_CARDS = ["total_tickets", "backlog_count", "mttr_display", "sla_compliance_display",
          "csat_display"]
_report("i01_overview_cards", sql.measures(_CARDS),
        lambda star: reports.overview_cards(star).select(*_CARDS))
_report("i02_sla_colour",
        sql.measures(["sla_compliance_rate"], extra=f", {_light(_SLA_RATE, 85)} as sla_colour"),
        lambda star: reports.overview_cards(star).select("sla_compliance_rate", "sla_colour"))
_report("i03_tickets_over_time", sql.measures(["total_tickets"], ["date"], "date is not null"),
        reports.tickets_over_time)
_report("i04_tickets_by_priority", sql.measures(["total_tickets"], ["priority_name"]),
        reports.tickets_by_priority)
_report("i05_backlog_aging",
        sql.measures(["total_tickets"], ["ticket_age_band"], "ticket_age_band <> '(Resolved)'"),
        reports.backlog_aging)
_report("i06_performance_cards",
        sql.measures(["sla_breach_count", "sla_at_risk", "fcr_rate_display", "oldest_open_days"]),
        reports.performance_cards)
_report("i07_breach_rate_by_category", sql.measures(["sla_breach_rate"], ["category_name"]),
        reports.breach_rate_by_category)
_MATRIX = ["total_tickets", "agent_mttr", "agent_fcr_rate", "agent_sla_compliance"]
_report("i08_agent_matrix", sql.measures(_MATRIX, ["agent_name"]),
        lambda star: reports.agent_matrix(star).drop("sla_colour"))
_report("i09_agent_sla_colour",
        sql.measures(["agent_sla_compliance"], ["agent_name"],
                     extra=f", {_light(_SLA_RATE, 80)} as sla_colour"),
        lambda star: reports.agent_matrix(star).select(
            "agent_name", "agent_sla_compliance", "sla_colour"))
_report("i10_csat_cards",
        sql.measures(["csat_display", "csat_satisfied_rate", "csat_dissatisfied_rate"]),
        reports.csat_cards)
_report("i11_csat_by_category", sql.measures(
    ["avg_csat"], ["category_name"]) + " having count(*) filter (where satisfaction_score <> 0) > 0",
    reports.csat_by_category)
_report("i12_live_aging",
        sql.measures(["total_tickets"], ["live_age_band"], "live_age_band <> '(Resolved)'"),
        lambda star: reports.live_aging(star, AS_OF))
_REPLACED = {"tickets_open": "status", "band_1_3_days": "ticket_age_band", "band_over_7_days": "ticket_age_band"}


@register("g6_replacing_predicates", sql.from_star(
    "select priority_name, status, ticket_age_band, cast(sum(n) as bigint) as total_tickets, " + ", ".join(
        f"cast(any_value({m}) as bigint) as {m}" for m in _REPLACED) + " from (select priority_name, status, ticket_age_band, n, " + ", ".join(
        f"sum({m}) over (partition by priority_name, {'ticket_age_band' if c == 'status' else 'status'}) as {m}" for m, c in _REPLACED.items())
    + " from (select priority_name, status, ticket_age_band, count(*) as n, " + ", ".join(f"{sql.MEASURE_SQL[m]} as {m}" for m in _REPLACED)
    + " from fact group by all)) group by all"))
def g6_replacing_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conditions that take the place of the row's own status or age band."""
    return evaluate(star_of(spark, sf_dir), ["total_tickets", *_REPLACED], ["priority_name", "status", "ticket_age_band"], replace=True)


# Open tickets at three later clocks, from one written table
_CLOCKS = ("2024-01-31 00:00:00", "2024-02-01 17:30:00", "2024-02-19 08:15:00")
_ELAPSED = "date_diff('hour', created_at, cast(clock as timestamp))"


@register("i12_live_aging_stored", sql.from_star(
    f"select clock, live_age_band, cast(count(*) as bigint) as backlog_count, cast(count(*) filter (where {_ELAPSED} >= 0.8::double * "
    "sla_target_hours) as bigint) as sla_at_risk, cast(max(date_diff('day', created_at, cast(clock as timestamp))) as integer) as "
    f"oldest_open_days from (select clock, created_at, sla_target_hours, {sql.band(_ELAPSED, 1)} as live_age_band from fact, (values "
    + ", ".join(f"('{c}')" for c in _CLOCKS) + ") v(clock) where resolved_at is null) group by clock, live_age_band"))
def i12_live_aging_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ageing at several clocks without reading the fact again."""
    star = star_of(spark, sf_dir)
    folder = _once(spark, sf_dir, "open", lambda path: open_tickets(star).write.parquet(path))
    opened = spark.read.parquet(folder)
    at = [evaluate_open(star, opened, ["backlog_count", "sla_at_risk", "oldest_open_days"], ["live_age_band"],
                        datetime.fromisoformat(c)).select(F.lit(c).alias("clock"), "*") for c in _CLOCKS]
    return reduce(DataFrame.unionAll, at)


for _attribute in ("agent_name", "priority_name", "channel_name"):
    _report(f"i13_efficiency_by_{_attribute.removesuffix('_name')}",
            sql.measures(["mttr_hours", "mtta_hours"], [_attribute]),
            lambda star, attribute=_attribute: reports.efficiency_by(star, attribute))
_report("i13_csat_by_resolution_time", sql.measures(
    ["avg_csat"], ["category_name", "resolution_time"])
    + " having count(*) filter (where satisfaction_score <> 0) > 0",
    reports.csat_by_resolution_time)
_FORMATTED = ["total_tickets", "mttr_hours", "sla_compliance_rate", "avg_csat", "mttr_display"]
_report("i14_number_formats", sql.from_star(
    "select channel_name, format('{:,}', cast(count(*) as bigint)) as total_tickets, "
    + ", ".join(f"{sql.tenth(sql.MEASURE_SQL[m])} as {m}" for m in
                ("mttr_hours", "sla_compliance_rate", "avg_csat"))
    + f", {sql.MEASURE_SQL['mttr_display']} as mttr_display from fact group by channel_name"),
    lambda star: formatted(evaluate(star, _FORMATTED, ["channel_name"])))
