from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from deskmart.functions import dates, numbers, text

NTZ = "timestamp_ntz"


def column(spark, values, function):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in sorted(rows.select("i", function(F.col("v"))).collect())]


PARSED = {
    "2024-3-2 9:4:5": datetime(2024, 3, 2, 9, 4, 5),
    "2024-03-02 09:04": datetime(2024, 3, 2, 9, 4),
    "2024-03-02": datetime(2024, 3, 2),
    "3/4/2024 10:11:12": datetime(2024, 3, 4, 10, 11, 12),
    "3/4/2024 10:11": datetime(2024, 3, 4, 10, 11),
    "3/4/2024": datetime(2024, 3, 4),
    "13/04/2024 1:2:3": datetime(2024, 4, 13, 1, 2, 3),
    "13/04/2024": datetime(2024, 4, 13),
    "13/04/2024 10:15": datetime(2024, 4, 13, 10, 15),
    "2024/3/2": datetime(2024, 3, 2),
    "2024/3/2 9:04": datetime(2024, 3, 2, 9, 4),
    "2024-03-12T09:14:00Z": datetime(2024, 3, 12, 9, 14),
    "2024-03-12T09:14:00+05:30": datetime(2024, 3, 12, 3, 44),
    "2024-03-12T09:14Z": datetime(2024, 3, 12, 9, 14),
    "2024-03-12 09:14 UTC": datetime(2024, 3, 12, 9, 14),
    "2024-03-12 09:14-0300": datetime(2024, 3, 12, 12, 14),
    "2024-03-12 09:14:04.9 +01:00": datetime(2024, 3, 12, 8, 14, 4),
    "2024-03-12 09:14:04.9": datetime(2024, 3, 12, 9, 14, 4),
    "12-Mar-2024": datetime(2024, 3, 12),
    "Mar 12, 2024": datetime(2024, 3, 12),
    "March 2024": datetime(2024, 3, 1),
    "20240312": datetime(2024, 3, 12),
    "3/4/24": datetime(2024, 3, 4),
    "3.4.2024": datetime(2024, 3, 4),
    "3/4/2024 9:05 PM": datetime(2024, 3, 4, 21, 5),
    "3/4/2024 12:05:07 AM": datetime(2024, 3, 4, 0, 5, 7),
    "02/30/2024": None, "2024-02-30": None, "13/13/2024": None, "45000": None, "2024": None,
    "9999-12-31": None, "0001-01-01 00:00:00": None, "1/1/1600": None, "1677-09-21 00:12:43": None,
    "1677-09-21 00:12:44": datetime(1677, 9, 21, 0, 12, 44), "2262-04-11 23:47:16": datetime(2262, 4, 11, 23, 47, 16),
    "2262-04-11T23:47:17Z": None, "31 Dec 9999": None,
    "garbage": None, "": None, "2024-03-02 24:00:00": None, "April 31 blah": None,
}


def test_parse_datetime(spark):
    got = column(spark, list(PARSED), dates.parse_datetime)
    assert dict(zip(PARSED, got)) == PARSED


def test_parse_never_fails_on_mixed_text(spark):
    @settings(max_examples=3, deadline=None)
    @given(st.lists(st.text(alphabet="0123456789/-:. TZamprAJe+", max_size=22), min_size=40,
                    max_size=40))
    def check(values):
        assert len(column(spark, values, dates.parse_datetime)) == 40
    check()


LABELS = ["o'neil vpn/email p1x", "ÉCOLE été", "hello WORLD", "a\tb x", "3com", "日本 abc",
          "x﷐y", "mc-donald (it)"]


def test_title_case_is_pythons(spark):
    assert column(spark, LABELS, text.title_case) == [v.title() for v in LABELS]


def test_strip_is_pythons(spark):
    values = ["  a ", "\ta\n", "\xa0a b　", "a", "", " ", "é ", " é", "\x1ca", "a​", "~", "!"]
    assert column(spark, values, text.strip) == [v.strip() for v in values]


@pytest.mark.parametrize("word, level", [
    ("P1", "Critical"), ("urgent", "Critical"), ("1", "Critical"), ("SEV2", "High"),
    ("normal", "Medium"), ("s4", "Low"), ("vip desk", "Vip Desk"), ("", None), (None, None)])
def test_priority(spark, word, level):
    assert column(spark, [word], text.tidy_priority) == [level]


@pytest.mark.parametrize("word, state", [
    ("new", "Open"), ("IN PROGRESS", "Pending"), ("solved", "Resolved"), ("Completed", "Closed"),
    ("escalated", "Escalated"), ("", None)])
def test_status(spark, word, state):
    assert column(spark, [word], text.tidy_status) == [state]


def test_numbers(spark):
    values = ["5", ".5", "1e2", "-3.7", "1d", "1,000", "0x10", "1e400", "nan", None]
    assert column(spark, values, numbers.to_number) == [
        5.0, 0.5, 100.0, -3.7, None, None, None, None, None, None]
    assert column(spark, values, numbers.to_count) == [5, 0, 100, -3, 0, 0, 0, 0, 0, 0]


def test_na_tokens_compare_untrimmed(spark):
    values = ["n/a", "NA", " NA", "", "None", "none", "null", "x"]
    got = column(spark, values, lambda v: F.when(text.present("v"), v))
    assert got == [None, None, " NA", None, None, "none", None, "x"]


def test_hours_minutes(spark):
    rows = spark.createDataFrame([(0, 1.8), (1, -0.5), (2, None), (3, 51.0)], "i int, h double")
    got = [r[1] for r in sorted(rows.select("i", numbers.hours_minutes(F.col("h"))).collect())]
    assert got == ["1h 48m", "-1h 30m", "n/a", "51h 0m"]


def test_one_decimal_rounds_halves_away_from_zero(spark):
    rows = spark.createDataFrame([(0, 0.25), (1, -0.25), (2, None), (3, 1234.0)], "i int, x double")
    got = [r[1] for r in sorted(rows.select("i", numbers.one_decimal(F.col("x"))).collect())]
    assert got == ["0.3", "-0.3", None, "1234.0"]


def test_hour_boundaries(spark):
    got = spark.sql("select timestamp_ntz'2024-01-01 00:59:59' a, timestamp_ntz'2024-01-01 01:00:00' b"
                    ).select(dates.hour_boundaries(F.col("a"), F.col("b"))).head()[0]
    assert got == 1


def test_monday_week_is_strftime_w(spark):
    days = spark.sql("select explode(sequence(date'2019-12-25', date'2030-01-10')) d")
    for day, week in days.select("d", dates.monday_week(F.col("d"))).collect():
        assert week == int(day.strftime("%W"))
