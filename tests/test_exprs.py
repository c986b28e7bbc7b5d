"""Scalar expression rules (P*, F2/F3, D*) on tiny frames."""

from pyspark.sql import functions as F

from channelmart.functions import dates as D
from channelmart.functions import exprs as X


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr.alias("x")).collect()]


def test_first_non_empty(spark):
    out = one(spark, X.first_non_empty("a", "b", default="dflt"),
              [("", "b1"), (None, None), ("a1", "b1"), ("0", None)], "a string, b string")
    assert out == ["b1", "dflt", "a1", "0"]


def test_compact_to_iso(spark):
    assert one(spark, X.compact_to_iso("d"), [("20240105",)], "d string") == ["2024-01-05"]


def test_default_channel(spark):
    out = one(spark, X.default_channel("c"),
              [("Brand PMax",), ("my Performance Max x",), ("a performance_max",), ("Search",), (None,)],
              "c string")
    assert out == ["Cross-network"] * 3 + ["Paid Search", "Paid Search"]


def test_named_campaign_and_real_ad_group(spark):
    out = one(spark, X.is_named_campaign("c"), [("(not set)",), (" \t\n",), ("x",), ("",)], "c string")
    assert out == [False, False, True, False]
    out = one(spark, X.is_real_ad_group("c"), [("(not set)",), ("",), (" ",), ("g",)], "c string")
    assert out == [False, False, True, True]


def test_safe_ratio_zero_cases(spark):
    out = one(spark, X.safe_ratio("a", "b"), [(1.0, 0.0), (0.0, 0.0), (3.0, 2.0), (-1.0, 0.0)], "a double, b double")
    assert out == [0.0, 0.0, 1.5, 0.0]
    out = one(spark, X.safe_ratio("a", "b", scale=100), [(1.0, 4.0)], "a double, b double")
    assert out == [25.0]


def test_rint_half_even(spark):
    out = one(spark, X.rint_places("x", 0), [(0.5,), (1.5,), (2.5,), (-0.5,)], "x double")
    assert out == [0.0, 2.0, 2.0, -0.0]
    out = one(spark, X.rint_places("x", 6), [(0.1234565,)], "x double")
    assert out == [round(0.1234565, 6)]


def test_parse_and_shift(spark):
    data = [("2024-03-05 02:10:00",), ("2024-03-05T05:00:00",), ("  2024-3-5 4:5:6  ",),
            ("2024-03-05 99:99:99",), ("",), (None,), ("garbage-text-here",), ("2024-03-05 03:00:00.123Z",)]
    out = one(spark, X.parse_and_shift("s"), data, "s string")
    assert out == ["2024-03-04", "2024-03-05", "2024-03-05", "2024-03-05", "", "", "garbage-te", "2024-03-05"]


def test_booking_agent(spark):
    rows = [("Sleepover Direct", "176"), ("sleepover", "176.9"), ("SLEEPOVER", "12"), ("Sleepover", "x"),
            ("Sleepover", None), ("Sleepover", "inf"), ("Web", "176"), ("", "176")]
    df = spark.createDataFrame(rows, "s string, c string")
    out = [r[0] for r in df.select(X.booking_agent(F.col("s"), F.col("c"), F.lit("agent"))).collect()]
    assert out == ["Sleepover.com", "Sleepover.com", "Sleepover e-mail/phone", "Sleepover e-mail/phone",
                   "Sleepover e-mail/phone", "Sleepover e-mail/phone", "Web", "agent"]


def test_money_text(spark):
    out = one(spark, X.money_text("x"), [(None,), ("12.5",), ("0.125",)], "x string")
    assert out == ["0.00", "12.50", "0.12"]


def test_date_rules():
    assert D.yesterday("2024-03-01") == "2024-02-29"
    assert D.resolve_range(None, None, "2024-03-15") == ("2024-03-01", "2024-03-14")
    assert D.resolve_range("2024-01-01", None, "2024-03-15") == ("2024-03-01", "2024-03-14")
    assert D.resolve_range("2024-01-01", "2024-01-31", "2024-03-15") == ("2024-01-01", "2024-01-31")
    assert D.resolve_range(None, None, "2024-03-01") == ("2024-02-01", "2024-02-29")
    assert D.last_n_days("2024-01-31", 7) == [f"2024-01-{d}" for d in range(24, 31)]
    assert D.table_suffix("2024-01-03", 2) == "20240101"


def test_stay_limit(spark):
    out = one(spark, D.stay_limit(F.col("d")), [("2024-02-28",), ("2024-02-28T00:00",), ("bad",)], "d string")
    assert out == ["2024-02-29", "2024-02-29", "bad"]
