import pytest

from daypanel.operators import quality


def test_unique_ignores_null_keys(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "a"), (None, "a")], "k int, s string")
    assert rows(quality.unique_violations(df, ["k", "s"])) == [(1, "a", 2)]


def test_not_null_and_range(spark, rows):
    df = spark.createDataFrame([(1, None), (None, -1), (3, 4294967296)], "a int, b long")
    assert rows(quality.not_null_violations(df, ["a", "b"])) == [("a", 1), ("b", 1)]
    assert rows(quality.range_violations(df, {"b": quality.UNSIGNED_32})) == [("b", 2)]


def test_gate_names_the_rule(spark):
    df = spark.createDataFrame([(1, "x"), (1, None)], "k int, v string")
    with pytest.raises(quality.QualityError, match="t: .*duplicate key.*row_count.*2"):
        quality.publish_gate(df, "t", ["k"])
    with pytest.raises(quality.QualityError, match='NULL in required column.*"v"'):
        quality.publish_gate(df, "t", ["v"], ["k", "v"])
    quality.publish_gate(df, "t", ["v"], ["k"])


def test_expectations(spark, rows):
    df = spark.createDataFrame([("2020-07-19", 52, None)], "date string, neg long, pos long")
    checks = [
        quality.Expectation("h", "date = '2020-07-19'", "neg", 52),
        quality.Expectation("h", "date = '2020-07-19'", "pos", None),
        quality.Expectation("h", "date = '2020-07-19'", "neg", None),
        quality.Expectation("h", "date = '2020-07-20'", "neg", 52),
    ]
    out = quality.point_expectations({"h": df}, checks)
    assert [r.passed for r in out.collect()] == [True, True, False, False]
