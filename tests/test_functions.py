"""Column expressions against hand-written rows and Python/C references."""

from __future__ import annotations

import datetime as dt
import decimal

from pyspark.sql import functions as F

from servstar.functions import expr as X


def _one(spark, col, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_round_half_up_ties(spark):
    out = _one(spark, X.round_half_up("x", 2), [(1.005,), (2.675,), (0.125,), (-0.125,), (None,)],
               "x double")
    # computed on the binary value: 1.005 and 2.675 sit just below the tie
    assert out[:4] == [1.0, 2.68, 0.13, -0.12]
    assert out[4] is None


def test_half_point_variants(spark):
    data = [(1.25,), (1.75,), (2.25,), (3.1,), (4.74,)]
    up = _one(spark, X.half_point("x"), data, "x double")
    even = _one(spark, X.half_point_even("x"), data, "x double")
    assert up == [1.5, 2.0, 2.5, 3.0, 4.5]
    # Python: round(x * 2) / 2 breaks ties to even
    assert even == [round(x * 2) / 2 for (x,) in data]


def test_monday_week_number_matches_strftime(spark):
    days = spark.sql("SELECT explode(sequence(DATE'1995-01-01', DATE'2001-12-31')) AS d")
    got = days.select("d", X.monday_week_number("d").alias("w")).collect()
    assert len(got) == 2557
    bad = [(r.d, r.w) for r in got if int(r.d.strftime("%W")) != r.w]
    assert bad == []


def test_calendar_attributes(spark):
    d = dt.date(2024, 3, 9)  # a Saturday
    row = spark.createDataFrame([(d,)], "d date").select(
        X.smart_date_key("d").alias("k"), X.quarter_label("d").alias("q"),
        X.weekend_flag("d").alias("we"), F.date_format("d", "EEEE").alias("dow"),
        F.date_format("d", "MMMM").alias("mon")).first()
    assert (row.k, row.q, row.we, row.dow, row.mon) == (20240309, "Q1", 1, "Saturday", "March")


def test_sla_category_bounds(spark):
    hours = [24, 24.01, 72, 72.5, 168, 168.01, 2160]
    out = _one(spark, X.sla_category("h"), [(decimal.Decimal(str(h)),) for h in hours],
               "h decimal(9,2)")
    assert out == ["Same Day", "Standard", "Standard", "Extended", "Extended",
                   "Long Term", "Long Term"]


def test_satisfaction_band_edges(spark):
    vals = [(4.0,), (3.9999,), (3.0,), (2.99,), (None,)]
    assert _one(spark, X.satisfaction_band("a"), vals, "a double") == \
        ["High", "Medium", "Medium", "Low", "Low"]
    assert _one(spark, X.satisfaction_band("a", " Satisfaction"), vals[:1], "a double") == \
        ["High Satisfaction"]


def test_breach_minutes_rules(spark):
    D = decimal.Decimal
    rows = [(0, D("3000.00"), D("24.00")),   # over: 3000 - 1440
            (1, D("100.00"), D("24.00")),    # compliant -> 0
            (None, D("5000.00"), D("24.00")),  # NULL flag -> 0
            (0, None, D("24.00")),           # open, flag 0 -> NULL
            (0, D("100.00"), D("24.00"))]    # flag 0 but under: negative, no clamp
    out = _one(spark, X.breach_minutes("f", "r", "h"), rows,
               "f int, r decimal(10,2), h decimal(9,2)")
    assert out == [D("1560.00"), D("0.00"), D("0.00"), None, D("-1340.00")]


def test_labels(spark):
    row = spark.createDataFrame([("Ministry of Health", "January", 2024, 1234567)],
                                "n string, m string, y int, t long").select(
        X.strip_prefix("n").alias("n"), X.period_label("m", "y").alias("p"),
        X.thousands("t").alias("t")).first()
    assert (row.n, row.p, row.t) == ("Health", "Jan 2024", "1,234,567")


def test_minutes_and_deadline(spark):
    row = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 8, 0), dt.datetime(2024, 1, 2, 9, 30, 30),
          decimal.Decimal("72.00"))], "a timestamp_ntz, b timestamp_ntz, h decimal(9,2)").select(
        X.minutes_between("a", "b").alias("m"), X.add_hours("a", "h").alias("d")).first()
    assert row.m == decimal.Decimal("1530.50")
    assert row.d == dt.datetime(2024, 1, 4, 8, 0)


def test_event_priority_mod4(spark):
    out = _one(spark, X.event_priority("k"), [(0,), (1,), (2,), (3,), (4,), (99,)], "k long")
    assert out == ["NORMAL", "HIGH", "LOW", "URGENT", "NORMAL", "URGENT"]


def test_sla_hours_for_priority(spark):
    out = _one(spark, X.sla_hours_for_priority("p"),
               [(p,) for p in X.SLA_DAYS_BY_PRIORITY] + [("bogus",)], "p string")
    assert [None if v is None else int(v) for v in out] == \
        [d * 24 for d in X.SLA_DAYS_BY_PRIORITY.values()] + [None]


def test_frame_rounding_breaks_ties_to_even(spark):
    """As Python rounds: 3.125 to 3.12, 0.375 to 0.38; the SQL rule takes both up."""
    df = spark.createDataFrame([(3.125,), (0.375,), (-0.125,), (2.5,), (None,)], "x double")
    even = [r[0] for r in df.select(X.round_half_even("x", 2)).collect()]
    assert even == [None if v is None else round(v, 2) for v in (3.125, 0.375, -0.125, 2.5, None)]
    assert df.select(X.round_half_up("x", 2)).first()[0] == 3.13


def test_no_result_depends_on_the_session_time_zone(spark):
    """2024-03-10 02:30 doesn't exist in Los Angeles: minutes and event texts are the same there."""
    from servstar.streaming import events as ev
    other = spark.newSession()
    rows = [("2024-03-09 00:00:00", "2024-03-10 02:30:00"), ("2024-03-10 01:59:59.5", "2024-03-10 03:00:00"),
            ("2024-03-12 00:00:00", "2024-03-10 00:00:00"), (None, "2024-03-10 00:00:00")]

    def run(session):
        df = session.createDataFrame(rows, "a string, b string").select(
            F.to_timestamp_ntz("a").alias("a"), F.to_timestamp_ntz("b").alias("b"))
        df = df.select(X.minutes_between("a", "b").alias("m"), X.add_hours("a", F.lit(26.5)).alias("d"),
                       ev.iso_text("a").alias("t"), ev.iso_text("b").alias("timestamp"))
        return [tuple(r) for r in df.withColumn("back", F.to_timestamp_ntz("timestamp")).collect()]

    utc = run(spark)
    other.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    assert run(other) == utc
    assert [None if r[0] is None else float(r[0]) for r in utc] == [1590.0, 60.0, -2880.0, None]
    assert [r[3] for r in utc][:2] == ["2024-03-10T02:30:00", "2024-03-10T03:00:00"] and utc[1][2] == "2024-03-10T01:59:59.500000"
