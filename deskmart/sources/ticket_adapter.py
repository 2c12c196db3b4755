"""Support tickets derived from the driver's tables (see FIXTURES.md section 4).

Every ``error``/``signup``/``view`` event opens a ticket. The same user's next ``click`` is the first
response and the next ``purchase`` the resolution. Cell values are deliberately messy text.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from deskmart.functions.dates import to_second
from deskmart.session import prepare, spread_small

# Fixed value: the clock at which the adapter's tickets are looked at.
AS_OF = datetime(2024, 1, 31)

TICKET_EVENTS = ("error", "signup", "view")

# Only the columns used; given schemas spare a footer-reading job per table.
_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey bigint, c_mktsegment string",
    "part": "p_partkey bigint, p_type string",
}
# Events without a user form one group of their own. Two plain columns say so, because equality on
# plain columns lets the optimizer see that the lookup is unique and drop it where it is not needed.
_KEY = ("user", "named", "sec")
# Position inside the second: microseconds first, then the event id.
_RANK = ("cast(timestampdiff(MICROSECOND, sec, ts) as decimal(6,0)) * 10000000000000000000BD"
         " + event_id")


def _opens_ticket() -> Column:
    return F.col("event_type").isin(*TICKET_EVENTS)


def _next_times(events: DataFrame) -> DataFrame:
    """Per (user, second) with a ticket: the last click/purchase inside it and the next second holding one.

    A plain ``min() over (partition by user order by ts ...)`` puts every event of a user into one
    task. Only the second of the following event matters, so events are first reduced to one row per
    user and second. A window looks for it inside the day, where a user has 86,400 rows at most; else it is
    the first one of a later day, found among one row per user and day.
    """
    def last(kind: str) -> Column:
        return F.max(F.when(F.col("event_type") == kind, F.expr(_RANK)))

    per_second = events.groupBy(*_KEY).agg(
        last("click").alias("last_click"), last("purchase").alias("last_purchase"),
        F.bool_or(_opens_ticket()).alias("asked")
    ).withColumn("day", F.to_date("sec"))
    click = F.when(F.col("last_click").isNotNull(), F.col("sec"))
    purchase = F.when(F.col("last_purchase").isNotNull(), F.col("sec"))
    days = Window.partitionBy("user", "named").orderBy(F.col("day").desc()).rowsBetween(
        Window.unboundedPreceding, -1)
    per_day = per_second.groupBy("user", "named", "day").agg(
        F.min(click).alias("click"), F.min(purchase).alias("purchase")).select(
        "user", "named", "day", F.min("click").over(days).alias("next_click"),
        F.min("purchase").over(days).alias("next_purchase"))
    later = Window.partitionBy("user", "named", "day").orderBy(F.col("sec").desc()).rowsBetween(
        Window.unboundedPreceding, -1)
    return per_second.withColumns({
        "later_click": F.min(click).over(later), "later_purchase": F.min(purchase).over(later),
    }).where("asked").join(per_day, ["user", "named", "day"], "left").select(
        *_KEY, "last_click", "last_purchase",
        F.coalesce("later_click", "next_click").alias("later_click"),
        F.coalesce("later_purchase", "next_purchase").alias("later_purchase"))


def raw_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per ticket with the 13 canonical columns as text, plus ``event_id`` for ordering."""
    prepare(spark)
    events, supplier, nation, customer, part = (
        spark.read.schema(schema).parquet(f"{sf_dir}/{name}.parquet")
        for name, schema in _SCHEMAS.items())
    events = events.withColumns({
        "sec": to_second(F.col("ts")), "user": F.coalesce("user_id", F.lit(0)),
        "named": F.isnotnull("user_id")})
    tickets = spread_small(events.where(_opens_ticket()))
    # The remainders bound these keys, so at most 15 suppliers and 99 parts can ever match.
    supplier = F.broadcast(supplier.where("s_suppkey between -7 and 7"))
    part = F.broadcast(part.where("p_partkey between -49 and 49"))
    joined = (
        tickets
        .join(customer, F.expr("c_custkey = user_id"), "left")
        # plans without any time column drop this join altogether
        .join(_next_times(events), list(_KEY), "left")
        # small tables last, so that the shuffles do not carry their names
        .join(supplier, F.expr("s_suppkey = user_id % 8"), "left")
        .join(nation, F.expr("n_nationkey = s_nationkey"), "left")
        .join(part, F.expr("p_partkey = event_id % 50"), "left"))
    timed = joined.selectExpr(
        "*", f"case when last_click > {_RANK} then sec else later_click end as click",
        f"case when last_purchase > {_RANK} then sec else later_purchase end as purchase")
    return timed.selectExpr("event_id", *_MESSY_COLUMNS)


def _iso(column: str) -> str:
    return f"date_format({column}, 'yyyy-MM-dd HH:mm:ss')"


_MESSY_COLUMNS = (
    "concat('TCK-', lpad(cast(event_id as string), 8, '0')) as ticket_id",
    f"""case when event_id % 701 = 0 then 'garbage'
             when event_id % 4 = 2 then date_format(sec, 'MM/dd/yyyy HH:mm:ss')
             when event_id % 4 = 3 then date_format(sec, 'yyyy-MM-dd HH:mm')
             else {_iso('sec')} end as created_at""",
    f"""case when event_id % 499 = 0 and purchase is not null then '2023-12-25 00:00:00'
             else {_iso('purchase')} end as resolved_at""",
    f"{_iso('click')} as first_response_at",
    """case when purchase is not null then case when event_id % 5 = 0 then 'closed' else ' Solved ' end
            when click is not null then 'In Progress' else 'new' end as status""",
    """case event_id % 9 when 0 then 'P1' when 1 then 'urgent' when 2 then ' High ' when 3 then 'sev2'
            when 4 then 'Normal' when 5 then 'p3' when 6 then 'low' when 7 then 'planned' end
       as priority""",
    "case when event_id % 11 <> 0 then p_type end as category",
    "c_mktsegment as channel",
    "case when event_id % 17 <> 0 then s_name end as agent_name",
    "case when event_id % 13 <> 0 then n_name end as team",
    """case when purchase is not null and event_id % 3 <> 0
                then cast(cast(floor(value) as bigint) % 6 as string)
            when event_id % 6 = 0 then 'n/a' end as satisfaction_score""",
    "case when event_id % 7 = 0 then '1' when event_id % 10 <> 0 then '0' end as reopen_count",
    "cast(null as string) as description",
)
