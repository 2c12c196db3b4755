"""Timings of the headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

``build`` is the whole way from the source tables to a written star (adapter, cleaning, raw table,
dimensions, fact). The reports then read that star, as dashboard pages do. Each job runs three
times and its median counts; results are consumed in full.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from deskmart.operators import checks, profile
from deskmart.operators.clean import clean_tickets
from deskmart.plans import reports
from deskmart.plans.context import FilterContext
from deskmart.plans.measures import MEASURES, evaluate
from deskmart.session import new_folder
from deskmart.sources import tables
from deskmart.sources.ticket_adapter import AS_OF, raw_tickets
from verification import queries
from verification.scratch import ensure_folder

RUNS = 3


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(job: Callable[[], object]) -> float:
    seconds = []
    for _ in range(RUNS):
        start = time.perf_counter()
        job()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ensure_folder(spark)

    def build() -> None:
        spark.catalog.clearCache()
        tables.build_tables(clean_tickets(raw_tickets(spark, sf_dir)),
                            new_folder(spark, "bench"), AS_OF)

    def all_pages(context: FilterContext | None) -> None:
        for page in reports.dashboard(star, context).values():
            consume(page)

    results = {"build": timed(build)}
    raw, star = queries.built(spark, sf_dir)
    unified = queries._unified(spark, sf_dir)
    ingested = queries.ingested(spark, sf_dir)
    jobs: dict[str, Callable[[], object]] = {
        "clean": lambda: consume(clean_tickets(raw_tickets(spark, sf_dir))),
        "csv_ingest": lambda: consume(queries.csv_ingest.load_tickets(ingested)),
        "profile": lambda: consume(profile.column_stats(unified)),
        "checks": lambda: consume(checks.all_checks(raw, star)),
        "agent_matrix": lambda: consume(reports.agent_matrix(star)),
        "all_measures": lambda: consume(evaluate(star, list(MEASURES))),
        "all_measures_by_day_and_agent": lambda: consume(
            evaluate(star, list(MEASURES), ["date", "agent_name"])),
        "dashboard": lambda: all_pages(None),
        "dashboard_filtered": lambda: all_pages(
            FilterContext.last_days(AS_OF, 14, priorities=["Critical", "High"])),
    }
    results |= {name: timed(job) for name, job in jobs.items()}
    print(json.dumps({
        "metric": "ticket_analytics_total", "value": round(sum(results.values()), 3),
        "unit": "sec", "queries": results, "sf": sf_dir.rsplit("sf", 1)[-1], "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
