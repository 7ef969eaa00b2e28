import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from daypanel.functions import calendar, numeric, text


def test_julian_day_both_ways(spark):
    row = spark.sql("select date '2015-03-14' as d").select(
        calendar.julian_day("d").alias("jd"),
        calendar.date_from_julian(F.lit(2457096)).alias("back"),
        calendar.julian_from_ymd(F.lit(2015), F.lit(3), F.lit(14)).alias("ymd"),
        calendar.ymd_from_julian(F.lit(2457096)).alias("parts"),
    ).first()
    assert (row.jd, row.back, row.ymd) == (2457096, dt.date(2015, 3, 14), 2457096)
    assert tuple(row.parts) == (2015, 3, 14)
    assert calendar.to_julian("2015-03-14") == calendar.to_julian(dt.date(2015, 3, 14)) == 2457096


def test_every_day_of_four_centuries(spark):
    first, last = calendar.to_julian("1800-01-01"), calendar.to_julian("2199-12-31")
    days = spark.range(first, last + 1).select(F.col("id").cast("int").alias("jd"))
    wrong = calendar.with_date_parts(days, "jd").where(
        (calendar.julian_day(F.to_date("date")) != F.col("jd"))
        | (F.concat_ws("-", "date_year", "date_month", "date_day") != F.col("date"))
    )
    assert days.count() == (dt.date(2199, 12, 31) - dt.date(1800, 1, 1)).days + 1
    assert wrong.count() == 0


def test_date_parts_are_padded_text(spark):
    df = spark.createDataFrame([(2457096, "x")], "date_julian int, v string")
    out = calendar.with_date_parts(df)
    assert out.columns == ["date", "date_year", "date_month", "date_day", "date_julian", "v"]
    assert tuple(out.first()) == ("2015-03-14", "2015", "03", "14", 2457096, "x")


def test_impossible_date_fails(spark):
    with pytest.raises(Exception):
        spark.range(1).select(calendar.julian_from_ymd(F.lit(2015), F.lit(2), F.lit(30))).collect()


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_parsing_is_strict(spark, ansi):
    session = spark.newSession()
    session.conf.set("spark.sql.ansi.enabled", ansi)
    df = session.createDataFrame([("2020-07-19", "20200719")], "iso string, compact string")
    assert tuple(df.select(calendar.parse_day("iso"), calendar.parse_day("compact", "yyyyMMdd")).first()) == (
        dt.date(2020, 7, 19), dt.date(2020, 7, 19))
    for bad in ("2020-13-01", "19/07/2020", "2020-07-19x", ""):
        broken = session.createDataFrame([(bad,)], "iso string")
        assert broken.select(calendar.try_parse_day("iso")).first()[0] is None
        with pytest.raises(Exception, match="not a date"):
            broken.select(calendar.parse_day("iso")).collect()
    assert session.createDataFrame([(None,)], "iso string").select(calendar.parse_day("iso")).first()[0] is None


def test_rounding(spark):
    top, bottom = numeric.INT64_MAX, numeric.INT64_MIN
    cases = {
        2.5: 3, -2.5: -3, 0.49999999999999994: 0, None: None, -0.5: -1, -0.0: 0, 1.4999999999999998: 1,
        4503599627370495.5: 4503599627370496, 4503599627370497.0: 4503599627370497, 9.2e18: 9200000000000000000,
        1e300: top, -1e300: bottom, float("inf"): top, float("-inf"): bottom, float("nan"): 0,
    }
    df = spark.createDataFrame([(v,) for v in cases], "v double")
    got = [r[0] for r in df.select(numeric.round_half_away(F.col("v"))).collect()]
    assert got == list(cases.values())


def test_rounding_like_decimal_arithmetic(spark):
    rng = random.Random(0)
    values = [rng.choice([-1, 1]) * rng.choice([rng.random(), rng.randrange(10**6) / 4, rng.uniform(0, 1e15)]) for _ in range(5000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(numeric.round_half_away(F.col("v"))).collect()]
    assert got == [int(Decimal(v).quantize(Decimal(1), ROUND_HALF_UP)) for v in values]


def test_empty_and_null(spark):
    df = spark.createDataFrame([("",), (None,), ("a",)], "t string")
    got = df.select(text.empty_to_null(F.col("t")), text.null_to_empty(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [(None, ""), (None, ""), ("a", "a")]


def test_day_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select((F.col("id") + 2457090).cast("int").alias("date_julian")).write.parquet(path)
    view = calendar.with_date_parts(calendar.on_days(spark.read.parquet(path), "2015-03-14"))
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(date_julian,2457096)" in plan
    assert [r.date for r in view.collect()] == ["2015-03-14"]
