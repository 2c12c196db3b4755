import random
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from deskmart.sources.ticket_adapter import raw_tickets
from verification import queries

START = datetime(2024, 1, 1)


def write_tables(folder, events):
    pq.write_table(pa.table({
        "event_id": pa.array([e[0] for e in events], pa.int64()),
        "ts": pa.array([e[1] for e in events], pa.timestamp("us")),
        "user_id": pa.array([e[2] for e in events], pa.int64()),
        "event_type": [e[3] for e in events],
        "value": pa.array([1.0] * len(events), pa.float64())}), folder / "events.parquet")
    key = lambda n: pa.array(range(n), pa.int64())
    pq.write_table(pa.table({"s_suppkey": key(8), "s_name": [f"S{i}" for i in range(8)],
                             "s_nationkey": pa.array([0] * 8, pa.int32())}),
                   folder / "supplier.parquet")
    pq.write_table(pa.table({"n_nationkey": pa.array([0], pa.int32()), "n_name": ["N"]}),
                   folder / "nation.parquet")
    pq.write_table(pa.table({"c_custkey": key(4), "c_mktsegment": ["M"] * 4}),
                   folder / "customer.parquet")
    pq.write_table(pa.table({"p_partkey": key(50), "p_type": ["P"] * 50}),
                   folder / "part.parquet")


def expected(events):
    """Brute force: per ticket, the second of the user's next click and purchase."""
    ordered = sorted(events, key=lambda e: (e[1], e[0]))
    out = {}
    for i, (event_id, _, user, kind, *_) in enumerate(ordered):
        if kind not in ("error", "signup", "view"):
            continue
        after = [e for e in ordered[i + 1:] if e[2] == user]
        first = lambda k: next((e[1].replace(microsecond=0) for e in after if e[3] == k), None)
        out[event_id] = (first("click"), first("purchase"))
    return out


@pytest.mark.parametrize("spread", [1, 60, 40_000, 900_000])
def test_next_events_against_brute_force(spark, tmp_path, spread):
    """One user holds most events; many share a second or even a microsecond; some have no user."""
    rng = random.Random(spread)
    ids = list(range(400))
    rng.shuffle(ids)
    events = []
    for i in ids:
        step = timedelta(seconds=rng.randint(0, spread), microseconds=rng.choice([0, 5, 999_999]))
        user = rng.choice([0, 0, 0, 0, 1, 2, None])
        events.append((i, START + step, user,
                       rng.choice(["click", "purchase", "error", "signup", "view"])))
    write_tables(tmp_path, events)
    want = expected(events)
    got = raw_tickets(spark, str(tmp_path)).select(
        "event_id", "first_response_at", "resolved_at").collect()
    assert len(got) == len(want)
    text = lambda t: t and t.strftime("%Y-%m-%d %H:%M:%S")
    for event_id, click, purchase in got:
        assert click == text(want[event_id][0])
        if event_id % 499:
            assert purchase == text(want[event_id][1])


def test_tickets_are_computed_once_for_all_layouts(spark, tmp_path, monkeypatch):
    write_tables(tmp_path, [(i, START + timedelta(hours=i), 1, "error") for i in range(12)])
    given, write = [], queries._write_csvs
    monkeypatch.setattr(queries, "_write_csvs", lambda tickets, folder: given.append(tickets) or write(tickets, folder))
    assert queries.a4_lineage(spark, str(tmp_path)).collect() == [(12, 12)]
    plan = given[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "parquet" in plan
    assert sorted(given[0].collect(), key=str) == sorted(raw_tickets(spark, str(tmp_path)).collect(), key=str)


def test_shuffles_carry_no_names(spark, tmp_path):
    """Small tables are joined behind all shuffles of the tickets."""
    write_tables(tmp_path, [(1, START, 1, "error")])
    plan = raw_tickets(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line]
    assert [any(k in j for k in ("p_partkey", "n_nationkey", "s_suppkey")) for j in joins[:4]] == [True, True, True, False]
