"""The shapes of the plans that large tables get."""

import re

import pytest
from pyspark.sql import functions as F

from daypanel.operators import dims, panel
from daypanel.plans.views import view
from daypanel.plans.schemas import SCHEMAS


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    """Shuffles by key, in plan order; a scalar subquery's single-row exchange is not one of them."""
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan_of(df))


def names(exchange):
    return [re.sub(r"#\d+L?$", "", part) for part in exchange.split(", ")[:-1]]


@pytest.fixture(scope="module")
def large(spark):
    """A session that plans as it would for tables too large to broadcast."""
    session = spark.newSession()
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    return session


@pytest.fixture(scope="module")
def tables(large, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    stored = {}
    for name, schema in SCHEMAS.items():
        path = str(folder / name)
        row = tuple({"string": "x", "double": 1.0}.get(f.dataType.simpleString(), 1) for f in schema)
        writer = large.createDataFrame([row], schema).write
        writer.partitionBy(*(["dataset"] if name == "cdataset_raw" else [])).parquet(path)
        stored[name] = large.read.schema(schema).parquet(path).select(*schema.names)
    return stored


def test_delta_shuffles_once_for_all_measures(tables):
    raw = tables["nytcounties_raw"]
    out = panel.prev_day_delta(raw, ["state", "county"], "date_julian", {"cases": "a", "deaths": "b"})
    assert [names(e) for e in exchanges(out)] == [["state", "county"]]
    assert plan_of(out).count("Window [") == 1


def test_gap_filling_shuffles_wide_rows_once(tables):
    raw = tables["cdataset_raw"]
    out = panel.forward_fill_gaps(raw, ["dataset", "locid"], "date_julian")
    assert [names(e) for e in exchanges(out)] == [["dataset", "locid"]]
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan_of(out))
    assert len(scans) == 2 and min(s.count(":") for s in scans) == 1  # the rows, and the days for the horizon


def test_unsplit_window_reuses_an_existing_distribution(large):
    df = large.range(100).select(F.col("id").alias("e"), F.col("id").cast("int").alias("jd")).repartition("e")
    assert len(exchanges(panel.prev_day_delta(df, ["e"], "jd", {"jd": "d"}, split_days=None))) == 1


def test_unsplit_filling_and_delta_share_one_shuffle(tables):
    raw = tables["nytcounties_raw"]
    filled = panel.forward_fill_gaps(raw, ["state", "county"], "date_julian", split_days=None)
    out = panel.prev_day_delta(filled, ["state", "county"], "date_julian", {"cases": "new"}, split_days=None)
    assert [names(e) for e in exchanges(out)] == [["state", "county"]]


def test_rollup_is_partially_aggregated(tables):
    plan = plan_of(view("covidtracking_us", tables))
    assert "partial_sum(positive#" in plan and plan.count("HashAggregate(") == 2 and plan.count("Exchange") == 1


def test_views_read_what_a_query_needs(tables):
    plan = plan_of(view("nytcounties", tables).select("date", "cases_new"))
    assert "ReadSchema: struct<date_julian:int,county:string,state:string,fips:bigint,cases:bigint>" in plan
    plan = plan_of(view("cdataset", tables).where("dataset = 'x'").select("date", "absolute_confirmed", "country"))
    assert "ReadSchema: struct<locid:bigint,date_julian:int,absolute_confirmed:bigint>" in plan
    assert "PartitionFilters: [isnotnull(dataset" in plan


def test_a_view_without_lookups_needs_no_shuffle(tables):
    for name in ("harveycodata", "rtlive", "covidtracking", "owid"):
        assert "Exchange" not in plan_of(view(name, tables)), name


def test_lookups_aggregate_before_the_shuffle(large):
    df = large.range(10).select(F.col("id").alias("k"), F.col("id").alias("v"), F.col("id").alias("o"))
    plan = plan_of(dims.last_wins_lookup(df, "k", "v", "o"))
    assert "HashAggregate" in plan and "partial_max_by" in plan and "SortAggregate" not in plan
