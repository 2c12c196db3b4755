import random
from datetime import date, datetime, timedelta

import pytest
from conftest import AS_OF
from pyspark.sql import functions as F

from deskmart.operators import checks
from deskmart.operators.fact import build_star
from deskmart.operators.lookup import attach
from deskmart.operators.ordinals import dense_keys, number_in_blocks
from deskmart.schemas import STAR_TABLES
from deskmart.sources import tables

T0 = datetime(2024, 3, 12, 9, 14)


def facts(star):
    return {r["ticket_id"]: r for r in star.fact.collect()}


def test_worked_example(tickets):
    star = build_star(tickets(dict(
        created_at=T0, resolved_at=datetime(2024, 3, 12, 11, 2), status="Resolved",
        first_response_at=datetime(2024, 3, 12, 9, 31), priority="Critical")), AS_OF)
    row = facts(star)["0"]
    assert row["resolution_hours"] == pytest.approx(1.8)
    assert row["response_hours"] == pytest.approx(17 / 60)
    assert (row["sla_target_hours"], row["sla_breached"], row["is_first_contact_resolved"],
            row["created_date_key"], row["ticket_age_band"]) == (4, 0, 1, 20240312, "(Resolved)")
    day = star.calendar.where("date_key = 20240312").head()
    assert tuple(day) == (20240312, date(2024, 3, 12), "Tuesday", 11, 3, "March", 1, 2024, 0, 1)
    assert [f.dataType for f in star.tables()["fact_tickets"].schema] == [
        f.dataType for f in STAR_TABLES["fact_tickets"]]


@pytest.mark.parametrize("priority, hours", [
    ("Critical", 4), ("High", 8), ("Medium", 24), ("Low", 72), ("Vip", 24), (None, 24)])
def test_exactly_on_target_is_no_breach(tickets, priority, hours):
    due = T0 + timedelta(hours=hours)
    star = build_star(tickets(
        dict(created_at=T0, resolved_at=due, priority=priority),
        dict(created_at=T0, resolved_at=due + timedelta(seconds=1), priority=priority)), AS_OF)
    rows = facts(star)
    assert (rows["0"]["sla_breached"], rows["1"]["sla_breached"]) == (0, 1)


def test_age_bands_and_odd_tickets(tickets):
    ages = [24, 72, 168, 336]
    rows = [dict(created_at=AS_OF - timedelta(hours=h, seconds=s)) for h in ages for s in (0, 1)]
    rows += [dict(), dict(created_at=T0, resolved_at=T0 - timedelta(hours=1), status="Closed"),
             dict(status="Resolved", created_at=T0), dict(resolved_at=T0, status="Resolved",
                                                          reopen_count=1)]
    got = facts(build_star(tickets(*rows), AS_OF))
    bands = [got[str(i)]["ticket_age_band"] for i in range(len(rows))]
    assert bands == ["0-1 Day", "1-3 Days", "1-3 Days", "3-7 Days", "3-7 Days", "7-14 Days",
                     "7-14 Days", "14+ Days", "14+ Days", "(Resolved)", "14+ Days", "(Resolved)"]
    assert got["9"]["resolution_hours"] == -1 and got["9"]["sla_breached"] == 0
    assert [got[str(i)]["is_first_contact_resolved"] for i in (9, 10, 11)] == [0, 1, 0]
    assert got["11"]["sla_breached"] == 0 and got["8"]["created_date_key"] is None


def test_dimensions(tickets):
    star = build_star(tickets(
        dict(agent_name="Bo", team="B", category="Net", channel="Web", priority="Low"),
        dict(agent_name="Bo", team="A", priority="Vip"), dict(agent_name="(Unassigned)"),
        dict(priority="Critical"), dict(priority="Beta")), AS_OF)
    assert [tuple(r) for r in star.agent.orderBy("agent_key").collect()] == [
        (1, "(Unassigned)", "(Unknown)"), (2, "Bo", "A"), (3, "Bo", "B")]
    assert [tuple(r) for r in star.priority.orderBy("priority_key").collect()] == [
        (1, "Critical", 4), (2, "Low", 72), (3, "(Unknown)", 24), (4, "Beta", 24), (5, "Vip", 24)]
    assert star.category.count() == 2 and star.channel.count() == 2
    assert star.fact.count() == 5


def test_calendar_ends(tickets):
    def days(*rows):
        found = build_star(tickets(*rows), AS_OF).calendar.agg(
            F.min("date"), F.max("date"), F.count("*")).head()
        return tuple(found)
    end = AS_OF.date() + timedelta(days=30)
    assert days(dict()) == (AS_OF.date(), end, 31)
    assert days(dict(created_at=T0)) == (T0.date(), end, (end - T0.date()).days + 1)
    late = datetime(2030, 1, 1, 12)
    assert days(dict(created_at=late)) == (late.date(), late.date(), 1)


def test_checks(tickets):
    raw = tickets(dict(created_at=T0), dict(), dict(created_at=datetime(2030, 1, 1)),
                  dict(created_at=T0, resolved_at=T0 - timedelta(hours=1)),
                  dict(created_at=T0, resolved_at=T0 + timedelta(days=9), priority="Low"))
    star = build_star(raw, AS_OF)
    got = {r["check"]: (r["value"], r["status"]) for r in checks.all_checks(raw, star).collect()}
    assert got == {1: (2, "FAIL"), 2: (0, "PASS"), 3: (1, "INFO"), 4: (1, "FAIL"), 5: (0, "PASS")}
    assert [tuple(r) for r in checks.breaches_by_priority(star).collect()] == [("Low", 1)]
    assert tuple(checks.row_parity(raw.limit(2), star).head()) == (2, 5, "FAIL")


def test_dense_keys_agree_with_and_without_buckets(spark):
    rng = random.Random(5)
    rows = sorted({(f"n{rng.randint(0, 300)}", f"t{rng.randint(0, 40)}") for _ in range(6000)}
                  | {("hot", f"t{i}") for i in range(3000)})
    df = spark.createDataFrame(rows, "a string, b string").repartition(6)
    order = (F.col("a"), F.col("b"))
    one = dense_keys(df, order, "k", len(rows))
    many = dense_keys(df, order, "k", len(rows), limit=500)
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, one.collect()))
    assert [r["k"] for r in many.orderBy("k").collect()] == list(range(1, len(rows) + 1))


def test_number_in_blocks(spark):
    rows = [(f, s, i) for f in "ba" for s in (0, 10) for i in range(7)]
    df = spark.createDataFrame(rows, "f string, s int, i int").repartition(4)
    got = number_in_blocks(df, ("f", "s"), "i", "n").orderBy("n").collect()
    assert [(r["f"], r["s"], r["i"]) for r in got] == sorted(rows)


def test_large_dimension_lookup_with_a_hot_member(spark):
    rows = [(i, "hot" if i % 3 else f"m{i % 500}") for i in range(3000)] + [(-1, None)]
    fact = spark.createDataFrame(rows, "id int, name string").repartition(5)
    names = sorted({n for _, n in rows if n})
    dim = spark.createDataFrame(list(enumerate(names)), "key int, name string")
    small = attach(fact, dim, ["name"], len(names))
    large = attach(fact, dim, ["name"], len(names), limit=10, shares=50)
    assert sorted(map(str, large.select("id", "key").collect())) == sorted(
        map(str, small.select("id", "key").collect()))
    assert "Broadcast" in small._jdf.queryExecution().executedPlan().toString()


def test_written_star_and_csv_round_trip(spark, tickets, tmp_path):
    raw = tickets(
        dict(created_at=T0, agent_name=' a "b", c', status=" x ", satisfaction_score=4.5),
        dict(created_at=T0 + timedelta(days=40), resolved_at=T0 + timedelta(days=41)), dict())
    path = str(tmp_path)
    assert tables.write_raw(raw, f"{path}/r") == 3
    assert tables.write_raw(raw, f"{path}/r") == 3
    read, star = tables.build_tables(tables.read_raw(spark, f"{path}/r"), f"{path}/s", AS_OF)
    assert read.count() == 3
    tables.write_star(star, f"{path}/again")
    again = tables.read_star(spark, f"{path}/again", AS_OF)
    tables.export_csv(star, f"{path}/csv")
    for name, table in star.tables().items():
        want = sorted(map(str, table.collect()))
        assert sorted(map(str, again.tables()[name].collect())) == want
        back = tables.read_csv_table(spark, f"{path}/csv", name)
        assert back.dtypes == table.dtypes
        assert sorted(map(str, back.collect())) == want


def test_an_interrupted_rebuild_leaves_the_star_whole(spark, tickets, tmp_path, monkeypatch):
    path = str(tmp_path)
    created = datetime(2024, 3, 1)
    old = tickets(*({"created_at": created, "agent_name": f"a{i}"} for i in range(3)))
    new = tickets(*({"created_at": created, "agent_name": f"b{i}"} for i in range(5)))
    with pytest.raises(FileNotFoundError):
        tables.read_tables(spark, path, AS_OF)
    raw, star = tables.build_tables(old, path, AS_OF)
    finished = tables._write_tables

    def stopped(built, folder):  # raw tickets, the fact and one dimension are written when the build ends
        for name in ("fact_tickets", "dim_agent"):
            built.tables()[name].write.parquet(f"{folder}/{name}")
        raise KeyboardInterrupt

    monkeypatch.setattr(tables, "_write_tables", stopped)
    with pytest.raises(KeyboardInterrupt):
        tables.build_tables(new, path, AS_OF)
    raw, star = tables.read_tables(spark, path, AS_OF)
    assert raw.count() == star.fact.count() == 3 and star.agent.where("agent_name like 'a%'").count() == 3
    monkeypatch.setattr(tables, "_write_tables", finished)
    later, newer = tables.build_tables(new, path, AS_OF)
    assert later.count() == newer.fact.count() == 5 and newer.agent.where("agent_name like 'a%'").count() == 0
    assert star.fact.count() == 3  # frames of the rebuild before stay valid
    tables.build_tables(old, path, AS_OF)
    assert len(tables._commits(spark, path)) == 3 and tables.read_tables(spark, path, AS_OF)[0].count() == 3
    kept = [v for _, v in tables._commits(spark, path)[-2:]]
    there = {p.name for p in (tmp_path / tables.VERSIONS).iterdir()}
    assert set(kept) <= there and tables._commits(spark, path)[0][1] not in there


def test_result_does_not_depend_on_partitioning(tickets):
    rng = random.Random(2)
    rows = [dict(created_at=T0 + timedelta(hours=rng.randint(0, 300)), priority=rng.choice("abc"),
                 agent_name=rng.choice(["x", "y", None]), team=rng.choice(["p", None]))
            for _ in range(60)]
    raw = tickets(*rows)
    a, b = (sorted(map(str, build_star(df, AS_OF).fact.collect()))
            for df in (raw.coalesce(1), raw.repartition(7)))
    assert a == b
