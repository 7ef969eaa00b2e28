import random

from pyspark.sql import functions as F

from daypanel.operators import dims


def test_last_wins_against_fan_out(spark, rows):
    lookup = spark.createDataFrame([(1, 100, 1), (1, 200, 2), (2, None, 3), (None, 5, 4)], "fips int, pop long, ord int")
    assert rows(dims.last_wins_lookup(lookup, "fips", "pop", "ord")) == [(1, 200)]
    facts = spark.createDataFrame([("a", 1), ("b", 2), ("c", None), ("d", 9)], "e string, fips int")
    want = [("a", 1, 100), ("a", 1, 200), ("b", 2, None), ("c", None, None), ("d", 9, None)]
    for how in ({"spread_nulls": True}, {"spread_nulls": False}, {"lookup_is_larger": True}):
        assert rows(dims.lookup_left_join(facts, lookup, "fips", ["pop"], **how)) == want


def test_null_keys_are_spread_over_tasks(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    session.conf.set("spark.sql.adaptive.enabled", "false")
    session.conf.set("spark.sql.shuffle.partitions", "8")
    facts = session.range(8000).select(F.when(F.col("id") % 3 == 0, F.col("id")).alias("fips"), "id")
    lookup = session.range(100).select(F.col("id").alias("fips"), F.lit(1).alias("pop"))
    joined = dims.lookup_left_join(facts, lookup, "fips", ["pop"], spread_nulls=True)
    per_task = joined.where("fips is null").groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) == 8 and joined.count() == 8000
    assert max(r["count"] for r in per_task) < 2 * 8000 * 2 / 3 / 8


def test_lookups_read_only_what_is_needed(spark, tmp_path):
    spark.range(50).select("id", F.lit("wide").alias("w"), (F.col("id") % 7).alias("fips"), F.lit(None).cast("long").alias("pop")).write.parquet(f"{tmp_path}/f")
    facts = spark.read.parquet(f"{tmp_path}/f")
    lookup = spark.createDataFrame([(1, 70)], "fips long, people long")
    for out in (dims.lookup_left_join(facts, lookup, "fips", ["people"]).select("id", "people"),
                dims.population_fallback(facts, lookup, "fips", "pop", "people").select("id", "pop")):
        assert "w:string" not in out._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]


def test_population_fallback(spark, rows):
    df = spark.createDataFrame([("a", 1, None), ("b", 1, 5), ("c", None, None)], "e string, fips int, pop long")
    lookup = spark.createDataFrame([(1, 70)], "fips int, people long")
    assert rows(dims.population_fallback(df, lookup, "fips", "pop", "people")) == [("a", 1, 70), ("b", 1, 5), ("c", None, None)]


def test_upsert_continues_ids_in_order_of_first_appearance(spark, rows):
    base = spark.createDataFrame([(1, "a", "A"), (2, "b", "B")], "locid long, key string, label string")
    facts = spark.createDataFrame(
        [("y", 1, "late"), ("x", 0, "X"), ("y", 0, "Y"), ("z", 1, "Z"), ("a", 0, "other")], "key string, src int, label string"
    )
    out = dims.upsert_dimension(base, facts, "key", "locid", ["label"], ["src"])
    assert rows(out, "locid", "key", "label") == [(1, "a", "A"), (2, "b", "B"), (3, "x", "X"), (4, "y", "Y"), (5, "z", "Z")]


def test_upsert_into_an_empty_dimension(spark, rows):
    base = spark.createDataFrame([], "locid long, key string, label string")
    facts = spark.createDataFrame([("q", 2, "Q"), ("p", 1, "P")], "key string, src int, label string")
    assert rows(dims.upsert_dimension(base, facts, "key", "locid", ["label"], ["src"])) == [(1, "p", "P"), (2, "q", "Q")]


def test_dense_ids_over_many_partitions(spark):
    values = list(range(5000))
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v, v % 7) for v in values], "v int, w int").repartition(13)
    got = dims.assign_dense_ids(df, ["w", "v"], "id", 10).collect()
    want = {(w, v): i for i, (w, v) in enumerate(sorted((v % 7, v) for v in values), 11)}
    assert len(got) == 5000 and all(want[r.w, r.v] == r.id for r in got)


def test_denormalize(spark, rows):
    fact = spark.createDataFrame([(1, 10), (2, 20), (9, 90)], "locid long, v int")
    dim = spark.createDataFrame([(1, "x"), (2, "y")], "locid long, xtype string")
    out = dims.denormalize(fact, dim, "locid", {"xtype": "location_type"})
    assert out.columns == ["location_type", "locid", "v"]
    assert rows(out) == [("x", 1, 10), ("y", 2, 20)]
