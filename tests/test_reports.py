import random
from datetime import date, datetime, timedelta

import pytest
from conftest import AS_OF
from pyspark.sql import functions as F

from deskmart.operators import checks
from deskmart.operators.fact import build_star
from deskmart.plans import reports
from deskmart.plans.context import FilterContext
from deskmart.plans.measures import MEASURES, evaluate, evaluate_open, formatted, open_tickets
from deskmart.sources import tables

T0 = datetime(2024, 3, 12, 9)


def sample(rng, n=200):
    rows = []
    for _ in range(n):
        created = T0 + timedelta(minutes=rng.randint(0, 20 * 24 * 60))
        done = rng.random() < 0.7
        rows.append(dict(
            created_at=created, resolved_at=created + timedelta(minutes=rng.randint(0, 6000))
            if done else None,
            first_response_at=created + timedelta(minutes=rng.randint(0, 300))
            if rng.random() < 0.8 else None,
            status=rng.choice(["Resolved", "Closed"]) if done else rng.choice(["Open", "Pending"]),
            priority=rng.choice(["Critical", "High", "Medium", "Low", None]),
            category=rng.choice(["Net", "Disk", None]), channel=rng.choice(["Web", "Mail"]),
            agent_name=rng.choice(["Ann", "Bob", None]), team=rng.choice(["A", "B"]),
            satisfaction_score=rng.choice([None, 0.0, 1.0, 2.0, 3.0, 4.0, 5.0]),
            reopen_count=rng.choice([0, 0, 1])))
    return rows


@pytest.fixture(scope="module")
def rows():
    return sample(random.Random(11))


@pytest.fixture(scope="module")
def star(tickets, rows):
    return build_star(tickets(*rows), AS_OF)


def test_there_are_32_measures():
    assert [m.id for m in MEASURES.values()] == [f"H{i}" for i in range(1, 33)]


def test_invariants(star, rows):
    m = evaluate(star, list(MEASURES)).head()
    assert m["total_tickets"] == len(rows) == m["tickets_resolved"] + m["backlog_count"]
    assert m["sla_compliant_count"] + m["sla_breach_count"] == m["tickets_resolved"]
    assert m["backlog_count"] == sum(m[b] for b in (
        "band_0_1_day", "band_1_3_days", "band_3_7_days", "band_over_7_days"))
    assert m["csat_satisfied_rate"] + m["csat_dissatisfied_rate"] <= 100
    rated = [r["satisfaction_score"] for r in rows if r["satisfaction_score"]]
    assert m["avg_csat"] == pytest.approx(sum(rated) / len(rated))
    taken = [(r["resolved_at"] - r["created_at"]).total_seconds() / 3600
             for r in rows if r["resolved_at"]]
    assert m["mttr_hours"] == pytest.approx(sum(taken) / len(taken))
    per_day = reports.tickets_over_time(star).collect()
    assert sum(r["total_tickets"] for r in per_day) == len(rows)
    assert [r["date"] for r in per_day] == sorted(r["date"] for r in per_day)


def test_groups_add_up_and_agents_are_distinct(star, rows):
    teams = evaluate(star, ["total_tickets", "tickets_per_agent"], ["team"]).collect()
    assert sum(r["total_tickets"] for r in teams) == len(rows)
    for r in teams:
        agents = {x["agent_name"] for x in rows if x["team"] == r["team"]}
        assert r["tickets_per_agent"] == pytest.approx(r["total_tickets"] / len(agents))


def test_empty_context_gives_zeros_and_placeholders(star):
    m = evaluate(star, list(MEASURES), context=FilterContext(priorities=("Nope",))).head()
    assert m["total_tickets"] == 0 and m["tickets_by_day"] == 0 and m["tickets_per_agent"] == 0
    assert m["mttr_hours"] is None and m["mttr_display"] == "n/a" and m["csat_display"] == "n/a"
    assert m["fcr_rate_display"] == "0.0%" and m["oldest_open_days"] is None
    assert evaluate(star, ["total_tickets"], ["team"],
                    FilterContext(priorities=("Nope",))).collect() == []


def test_context_equals_prefiltered_tickets(tickets, star, rows):
    context = FilterContext(date(2024, 3, 15), date(2024, 3, 27), ("High", "(Unknown)"), ("Web",),
                            ("Net", "(Uncategorized)"))
    kept = [r for r in rows if date(2024, 3, 15) <= r["created_at"].date() <= date(2024, 3, 27)
            and r["priority"] in ("High", None) and r["channel"] == "Web"
            and r["category"] in ("Net", None)]
    assert kept
    whole = build_star(tickets(*kept), AS_OF)
    names = [n for n in MEASURES]
    a = evaluate(star, names, ["agent_name"], context).collect()
    b = evaluate(whole, names, ["agent_name"]).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))
    filtered, plain = reports.dashboard(star, context), reports.dashboard(whole)
    for page in filtered:
        assert sorted(map(str, filtered[page].collect())) == sorted(map(str, plain[page].collect()))


def test_relative_dates():
    context = FilterContext.last_days(AS_OF)
    assert (context.date_from, context.date_to) == (date(2024, 3, 3), date(2024, 4, 1))


def test_tickets_outside_the_calendar(tickets):
    star = build_star(tickets(dict(created_at=T0), dict(),
                              dict(created_at=datetime(2031, 1, 1))), AS_OF)
    assert evaluate(star, ["total_tickets"]).head()[0] == 3
    assert [r["total_tickets"] for r in reports.tickets_over_time(star).collect()] == [1]
    assert {r["date"]: r["total_tickets"] for r in
            evaluate(star, ["total_tickets"], ["date"]).collect()} == {T0.date(): 1, None: 2}
    late = FilterContext(date(2030, 1, 1))
    assert evaluate(star, ["total_tickets"], context=late).head()[0] == 0


def test_at_risk_counts_hour_boundaries(tickets):
    # Medium: 24 h, so 0.8 * 24 = 19.2 -> the 20th boundary puts a ticket at risk
    star = build_star(tickets(
        dict(created_at=datetime(2024, 3, 31, 4, 59), priority="Medium"),
        dict(created_at=datetime(2024, 3, 31, 5, 0), priority="Medium")), AS_OF)
    assert evaluate(star, ["sla_at_risk"]).head()[0] == 1


def test_live_bands_move_with_the_clock(tickets):
    star = build_star(tickets(dict(created_at=AS_OF - timedelta(hours=2))), AS_OF)
    assert reports.backlog_aging(star).head()[0] == "0-1 Day"
    assert reports.live_aging(star, AS_OF + timedelta(days=5)).head()[0] == "3-7 Days"


def test_a_replacing_condition_ignores_the_member_of_its_row(tickets):
    rows = [dict(created_at=AS_OF - timedelta(hours=30 * i), status=s, team=t, agent_name="a", resolved_at=AS_OF if s == "Closed" else None)
            for i, (s, t) in enumerate([("Open", "x"), ("Open", "y"), ("Pending", "x"), ("Closed", "x"), ("Closed", None)])]
    star = build_star(tickets(*rows), AS_OF)
    narrowed = {r[0]: r[1] for r in evaluate(star, ["tickets_open"], ["status"]).collect()}
    assert narrowed == {"Open": 2, "Pending": 1, "Closed": 0}
    replaced = evaluate(star, ["tickets_open", "tickets_created"], ["status"], replace=True)
    assert {tuple(r) for r in replaced.collect()} == {("Open", 3, 2), ("Pending", 3, 1), ("Closed", 3, 2)}
    by_team = {(r[0], r[1]): r[2] for r in evaluate(star, ["tickets_open"], ["team", "status"], replace=True).collect()}
    assert by_team == {("x", "Open"): 2, ("x", "Pending"): 2, ("x", "Closed"): 2, ("y", "Open"): 1, ("(Unknown)", "Closed"): 0}
    assert evaluate(star, ["tickets_open"], ["team"], replace=True).count() == 3


def test_open_tickets_answer_every_later_clock(spark, tickets, tmp_path):
    rng = random.Random(8)
    rows = [dict(created_at=None if i % 17 == 0 else AS_OF - timedelta(minutes=rng.randrange(40_000)), priority=rng.choice(["Critical", "Low", None]),
                 resolved_at=AS_OF if i % 3 == 0 else None, team=f"t{i % 4}", agent_name=f"a{i % 5}", status="Open") for i in range(300)]
    star = build_star(tickets(*rows), AS_OF)
    open_tickets(star).write.parquet(str(tmp_path / "open"))
    opened = spark.read.parquet(str(tmp_path / "open"))
    plan = evaluate_open(star, opened, ["backlog_count"], ["team"], AS_OF)._jdf.queryExecution().toString()
    assert "resolution_seconds" not in plan
    for later in (AS_OF, AS_OF + timedelta(hours=7, minutes=40), AS_OF + timedelta(days=9, seconds=1)):
        for by in ([], ["live_age_band"], ["team", "live_age_band"], ["status", "priority_name"]):
            names = ["backlog_count", "sla_at_risk", "oldest_open_days"]
            want = evaluate(star, names, by, as_of=later).where("backlog_count > 0")
            got = evaluate_open(star, opened, names, by, later)
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        bands = {tuple(r) for r in reports.live_aging(star, later, opened=opened).collect()}
        assert bands == {tuple(r) for r in reports.live_aging(star, later).collect()}
    more = opened.union(open_tickets(star)).union(opened.withColumn("tickets", -F.col("tickets")))  # additive
    assert evaluate_open(star, more, ["backlog_count"], [], AS_OF).head()[0] == opened.agg(F.sum("tickets")).head()[0]
    with pytest.raises(ValueError, match="mttr_hours"):
        evaluate_open(star, opened, ["mttr_hours"], [], AS_OF)


def test_matrix_merges_teams_and_sorts_worst_first(star, rows):
    matrix = reports.agent_matrix(star).collect()
    assert {r["agent_name"] for r in matrix} == {"Ann", "Bob", "(Unassigned)"}
    rates = [r["agent_sla_compliance"] for r in matrix]
    assert rates == sorted(rates)
    for r in matrix:
        rate = r["agent_sla_compliance"]
        assert r["sla_colour"] == ("green" if rate >= 95 else "orange" if rate >= 80 else "red")


def test_number_formats(star):
    got = formatted(evaluate(star, ["total_tickets", "mttr_hours", "mttr_display"])).head()
    assert got["total_tickets"] == "200" and got["mttr_hours"].count(".") == 1


def test_reports_need_one_pass_over_the_fact(star):
    plan = reports.agent_matrix(star)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "Generate" not in plan


def test_sort_orders(star):
    ordered = lambda df, key: [tuple(r) for r in df.collect()] == sorted(map(tuple, df.collect()), key=key)
    assert ordered(checks.breaches_by_priority(star), lambda r: (-r[1], r[0]))
    assert ordered(reports.tickets_by_priority(star), lambda r: (-r[1], r[0]))
    assert ordered(reports.breach_rate_by_category(star), lambda r: (-r[1], r[0]))
    assert ordered(reports.csat_by_category(star), lambda r: (r[1], r[0]))
    assert ordered(reports.tickets_over_time(star), lambda r: r[0])


def test_dashboard_pages_equal_single_reports(star):
    for context in (None, FilterContext.last_days(AS_OF, 40, priorities=["High", "Low"], channels=["Web"])):
        pages = reports.dashboard(star, context)
        assert len(pages) == 9
        for name, page in pages.items():
            single = getattr(reports, name)(star, context).collect()
            assert sorted(map(repr, page.collect())) == sorted(map(repr, single)), name


def test_passes_over_written_tables(spark, tickets, rows, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")  # else plans cut paths short
    raw, star = tables.build_tables(tickets(*rows), str(tmp_path), AS_OF)
    scans = lambda df, table: df._jdf.queryExecution().executedPlan().toString().count(f"{tables.current(spark, str(tmp_path))}/{table}")
    assert scans(checks.all_checks(raw, star), "fact_tickets") == 1
    pages = reports.dashboard(star, FilterContext.last_days(AS_OF, 30, priorities=["High"]))
    assert len(pages) == 9 and all(scans(page, "fact_tickets") == 0 for page in pages.values())
    filtered = FilterContext(priorities=("High",)).apply(star)
    assert "PushedFilters: [IsNotNull(priority_key), EqualTo(priority_key," in filtered._jdf.queryExecution().executedPlan().toString()
    built = build_star(raw, AS_OF)
    assert scans(built.fact, "raw_tickets") == 1
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_a_plain_string_is_no_member_list():
    with pytest.raises(TypeError):
        FilterContext.last_days(AS_OF, 30, priorities="High")
