import random

import pytest
from pyspark.sql import functions as F

from daypanel.operators import panel

SPLITS = [None, 1, 2, 3, 366]


@pytest.mark.parametrize("split", SPLITS)
def test_delta_looks_at_the_calendar_day_before(spark, rows, split):
    df = spark.createDataFrame(
        [("A", 1, 10, 1), ("A", 2, 15, 1), ("A", 4, 20, 1), ("B", 2, 3, None), ("B", 3, 9, 7)],
        "entity string, jd int, cases long, fips long",
    )
    out = panel.prev_day_delta(df, ["entity"], "jd", {"cases": "cases_new"}, split_days=split)
    assert rows(out, "entity", "jd", "cases_new") == [
        ("A", 1, None), ("A", 2, 5), ("A", 4, None), ("B", 2, None), ("B", 3, 6),
    ]
    # The row without a code is dropped after it served as "yesterday".
    assert rows(out.where("fips is not null"), "entity", "jd", "cases_new")[-1] == ("B", 3, 6)


@pytest.mark.parametrize("split", SPLITS)
def test_delta_rows_without_key_match_nothing(spark, rows, split):
    df = spark.createDataFrame(
        [(None, 1, 1), (None, 2, 2), (None, 2, 5), ("A", 1, 4), ("A", None, 4), ("A", 2, None), ("A", 3, 8)],
        "entity string, jd int, v long",
    )
    out = panel.prev_day_delta(df, ["entity"], "jd", {"v": "d"}, split_days=split)
    assert out.count() == 7
    assert rows(out.where("d is not null")) == []


@pytest.mark.parametrize("split", SPLITS)
def test_fill_between_and_up_to_the_global_horizon(spark, rows, split):
    df = spark.createDataFrame(
        [("A", 1, 5, 0.5, 7, None, "x"), ("A", 2, 6, 0.6, 8, 1, "y"), ("A", 4, 7, 0.7, 9, 2, "z"),
         ("B", 2, 1, 0.1, 1, None, "p"), ("B", 3, 2, 0.2, 2, None, "q")],
        "entity string, jd int, delta long, pct double, idx long, idx_opt int, carried string",
    )
    out = panel.forward_fill_gaps(
        df, ["entity"], "jd", zero=["delta"], null=["pct"], advance=["idx", "idx_opt"], filled="added", split_days=split
    )
    assert out.columns == [*df.columns, "added"]
    assert out.drop("added").dtypes == df.dtypes
    assert rows(out) == [
        ("A", 1, 5, 0.5, 7, None, "x", False),
        ("A", 2, 6, 0.6, 8, 1, "y", False),
        ("A", 3, 0, None, 9, 2, "y", True),
        ("A", 4, 7, 0.7, 9, 2, "z", False),
        ("B", 2, 1, 0.1, 1, None, "p", False),
        ("B", 3, 2, 0.2, 2, None, "q", False),
        ("B", 4, 0, None, 3, None, "q", True),
    ]


def test_fill_never_cuts_and_refuses_unknown_columns(spark, rows):
    df = spark.createDataFrame([("A", 1), ("A", 3), ("A", 6)], "e string, jd int")
    out = panel.forward_fill_gaps(df, ["e"], "jd", horizon=F.lit(4))
    assert rows(out) == [("A", d) for d in range(1, 7)]
    with pytest.raises(ValueError, match="typo"):
        panel.forward_fill_gaps(df, ["e"], "jd", zero=["typo"])


def test_fill_to_a_horizon_per_group(spark, rows):
    df = spark.createDataFrame([("s", "A", 1), ("s", "B", 3), ("t", "C", 1), ("t", "D", 2)], "g string, e string, jd int")
    limited = panel.with_group_horizon(df, ["g"], "jd")
    out = panel.forward_fill_gaps(limited, ["g", "e"], "jd", horizon="horizon").drop("horizon")
    assert rows(out) == [
        ("s", "A", 1), ("s", "A", 2), ("s", "A", 3), ("s", "B", 3), ("t", "C", 1), ("t", "C", 2), ("t", "D", 2),
    ]


@pytest.mark.parametrize("split", [None, 366])
def test_fill_refuses_rows_without_key(spark, split):
    df = spark.createDataFrame([("A", 1), (None, 2)], "e string, jd int")
    with pytest.raises(Exception, match="NULL in panel key"):
        panel.forward_fill_gaps(df, ["e"], "jd", split_days=split).collect()


@pytest.mark.parametrize("split", [None, 366])
def test_fill_refuses_a_second_row_for_a_day(spark, split):
    df = spark.createDataFrame([("A", 1), ("A", 1), ("B", 2)], "e string, jd int")
    with pytest.raises(Exception, match="duplicate panel key.*A, 1"):
        panel.forward_fill_gaps(df, ["e"], "jd", split_days=split).collect()


@pytest.mark.parametrize("split", [1, 7, 30, 366])
def test_blocks_change_nothing(spark, rows, split):
    """A random panel in which one entity holds a third of all rows, against a brute-force loop."""
    rng = random.Random(split)
    days = {("hot", d) for d in rng.sample(range(-50, 1150), 400)}
    days |= {(f"e{rng.randrange(40)}", rng.randrange(-50, 1150)) for _ in range(800)}
    data = {k: rng.randrange(1000) for k in days}
    top = max(d for _, d in data)
    df = spark.createDataFrame([(e, d, v) for (e, d), v in data.items()], "e string, jd int, v long")

    deltas = panel.prev_day_delta(df, ["e"], "jd", {"v": "d"}, split_days=split)
    want = [(e, d, v, v - data[e, d - 1] if (e, d - 1) in data else None) for (e, d), v in data.items()]
    assert rows(deltas) == sorted(want, key=lambda t: t[:2])

    filled = panel.forward_fill_gaps(df, ["e"], "jd", split_days=split)
    want = []
    for e in {e for e, _ in data}:
        last = None
        for d in range(min(d for x, d in data if x == e), top + 1):
            last = data.get((e, d), last)
            want.append((e, d, last))
    assert rows(filled) == sorted(want)


def test_a_hot_entity_is_spread_over_tasks(spark):
    """Also when the input already lies together by entity, which a window alone would accept."""
    session = spark.newSession()
    session.conf.set("spark.sql.adaptive.enabled", "false")
    session.conf.set("spark.sql.shuffle.partitions", "8")
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    days = session.range(40_000).select(
        (F.col("id") / 50_000).cast("int").alias("e"), F.col("id").cast("int").alias("jd"), F.col("id").alias("v")
    )
    together = days.repartition(8, "e")
    assert together.groupBy(F.spark_partition_id()).count().count() == 1
    for out in (
        panel.prev_day_delta(together, ["e"], "jd", {"v": "d"}, split_days=100),
        panel.with_next_day(together, ["e"], "jd", split_days=100),
    ):
        per_task = out.groupBy(F.spark_partition_id()).count().collect()
        assert len(per_task) == 8 and max(r["count"] for r in per_task) < 40_000 / 4


def test_per_capita(spark, rows):
    df = spark.createDataFrame(
        [(1, 7.5, 10, 1000), (2, None, 10, 1000), (3, None, None, 1000), (4, None, 10, None), (5, None, 10, 0)],
        "id int, absolute_pop100k_x double, absolute_x long, pop long",
    )
    out = panel.per_capita(df, {"absolute_x": "absolute_pop100k_x"}, "pop")
    assert rows(out, "id", "absolute_pop100k_x") == [(1, 7.5), (2, 1000.0), (3, 0.0), (4, None), (5, None)]
    missing = panel.per_capita(df.drop("absolute_pop100k_x"), {"absolute_x": "rate"}, "pop")
    assert rows(missing, "id", "rate")[0] == (1, 1000.0)


def test_rollup_skips_nulls(spark, rows):
    df = spark.createDataFrame([("d", 1, None), ("d", None, None)], "date string, positive long, pending long")
    assert rows(panel.daily_rollup(df, ["date"], ["positive", "pending"])) == [("d", 1, None)]


def test_units(spark, rows):
    df = spark.createDataFrame([(3.0, 0.07)], "a double, b double")
    out = panel.convert_units(df, {"x": ("a", "/", 10.0), "y": ("b", "*", 100.0)})
    assert rows(out) == [(3.0 / 10.0, 0.07 * 100.0, 3.0, 0.07)]
    with pytest.raises(ValueError):
        panel.convert_units(df, {"x": ("a", "+", 1.0)})


@pytest.mark.parametrize("split", [None, 3])
def test_delta_refuses_duplicates(spark, split):
    df = spark.createDataFrame([("a", 1, 15), ("a", 2, 99), ("a", 2, 20), (None, 2, 1), (None, 2, 2)], "e string, jd int, v int")
    with pytest.raises(Exception, match="duplicate panel key"):
        panel.prev_day_delta(df, ["e"], "jd", {"v": "d"}, split_days=split).collect()
    unkeyed = panel.prev_day_delta(df.where("e is null"), ["e"], "jd", {"v": "d"}, split_days=split)
    assert [r["d"] for r in unkeyed.collect()] == [None, None]
