"""Commits, reports, stored dates and permanent views of published builds."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from daypanel.operators import panel
from daypanel.operators.quality import Expectation, QualityError
from daypanel.plans import store
from daypanel.plans.build import Landing, Tolerance, build_and_register
from daypanel.plans.catalog_views import publish_catalog
from daypanel.plans.views import VIEWS, view
from daypanel.sources import contracts
from tests.test_build import _series, _text, ungated


@pytest.fixture(scope="module")
def series(spark):
    return [_series(spark, [("d1", "x", "2020-03-14", 10, None), ("d1", "a", "2020-03-12", 7, None), ("d2", "y", "2020-03-13", 1, 1000)])]


@pytest.fixture(scope="module")
def root(spark, series, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("store"))
    ungated(spark, Landing(_text(tmp_path_factory.mktemp("landing")), series), folder)
    return folder


def pushed(df):
    return re.findall(r"PushedFilters: \[([^\]]*)\]", df._jdf.queryExecution().executedPlan().toString())


def scanned(df):
    """Rows that the Parquet scans of a DataFrame gave out."""
    df.collect()
    plan, rows = df._jdf.queryExecution().executedPlan(), 0

    def walk(node):
        nonlocal rows
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.startswith("Scan parquet"):
            rows += node.metrics().apply("numOutputRows").value()
        if "QueryStage" in name:
            walk(node.plan())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan)
    return rows


def test_of_two_builds_at_a_time_one_is_published(spark, tmp_path):
    root = str(tmp_path)
    first, at = store.begin(spark, root)
    second, at_too = store.begin(spark, root)
    assert at == at_too == 0
    assert store.publish(spark, root, first, at) == 1
    with pytest.raises(store.PublishConflict):
        store.publish(spark, root, second, at_too)
    assert store.published_build(spark, root) == first and store.commits(spark, root) == [1]
    third, at = store.begin(spark, root)
    assert store.publish(spark, root, third, at) == 2 and store.published_build(spark, root, 1) == first
    with pytest.raises(LookupError):
        store.published_build(spark, root, 3)


def test_a_build_that_was_overtaken_is_not_published(spark, series, root, tmp_path, monkeypatch):
    begin, other = store.begin, {}

    def overtaken(session, folder):
        mine = begin(session, folder)
        other["id"] = begin(session, folder)[0]
        store.publish(session, folder, other["id"], mine[1])
        return mine

    monkeypatch.setattr(store, "begin", overtaken)
    with pytest.raises(store.PublishConflict):
        ungated(spark, Landing(_text(tmp_path), series), str(tmp_path / "s"))
    assert store.published_build(spark, str(tmp_path / "s")) == other["id"]


def test_expired_builds_go_and_running_ones_stay(spark, tmp_path):
    root, ids = str(tmp_path), []
    for k in range(4):
        build_id, at = store.begin(spark, root)
        spark.range(k + 1).write.parquet(store.table_path(root, build_id, "t"))
        if k < 3:
            store.publish(spark, root, build_id, at)
        ids.append(build_id)
    assert store.expire(spark, root, 2) == [ids[0]] and store.commits(spark, root) == [2, 3]
    left = {p.name for p in (tmp_path / "builds").iterdir()}
    assert left == set(ids[1:])  # the last one still runs
    store.give_up(spark, root, ids[3])
    assert store.expire(spark, root, 1) == sorted([ids[1], ids[3]]) and store.published_build(spark, root) == ids[2]
    with pytest.raises(ValueError):
        store.expire(spark, root, 0)


def test_views_of_the_catalog_are_those_of_the_library(spark, root):
    assert set(publish_catalog(spark, root, "kept_panels")) == set(VIEWS)
    other, tables = spark.newSession(), store.open_tables(spark, root)
    for name in VIEWS:
        ours, theirs = view(name, tables), other.sql(f"select * from kept_panels.{name}")
        assert (ours.columns, ours.dtypes) == (theirs.columns, theirs.dtypes), name
        assert Counter(map(tuple, ours.collect())) == Counter(map(tuple, theirs.collect())), name
    publish_catalog(spark, root, "kept_panels")  # once more, over tables that are there


def test_text_dates_reach_the_files_of_every_view(spark, root):
    publish_catalog(spark, root, "pruned_panels")
    dated = store.open_dated(spark, root)
    for name in VIEWS:
        for df in (spark.sql(f"select * from pruned_panels.{name} where date = '2020-03-15'"), view(name, dated).where("date = '2020-03-15'")):
            filters = pushed(df)
            assert any("EqualTo(date,2020-03-15)" in f for f in filters), name
            if name == "nytcounties":
                assert any("EqualTo(date_next,2020-03-15)" in f for f in filters)
    span = pushed(spark.sql("select * from pruned_panels.nytcounties where date between '2020-03-14' and '2020-03-15'"))
    assert any("GreaterThanOrEqual(date_next,2020-03-14)" in f for f in span)


def test_a_day_filter_reads_few_row_groups(spark, series, tmp_path):
    days = [f"2020-{m:02d}-{d:02d}" for m in range(1, 13) for d in range(1, 28)]
    many = [{"date": d, "county": f"c{k}", "state": "K", "fips": k, "cases": k, "deaths": 0} for d in days for k in range(4)]
    session = spark.newSession()
    session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    session.conf.set("spark.sql.shuffle.partitions", "40")
    root = str(tmp_path / "s")
    ungated(session, Landing(_text(tmp_path, nytcounties_raw=many), series), root)
    whole = view("nytcounties", store.open_dated(spark, root))
    day = whole.where("date = '2020-07-19'")
    assert scanned(whole) >= 2 * len(many)
    assert scanned(day) < len(many) / 2 and day.count() == 4 and {r["cases_new"] for r in day.collect()} == {0}


def test_stored_panels_in_buckets_need_no_shuffle(spark, tmp_path):
    rows = spark.range(400).select((F.col("id") % 7).alias("e"), (F.col("id") / 7).cast("int").alias("day"), F.col("id").alias("n")).where("n % 5 > 0")
    stored = store.write_bucketed(rows, "bucketed_panel", str(tmp_path / "t"), ["e"], "day", 4)
    delta = panel.prev_day_delta(stored, ["e"], "day", {"n": "n_new"})
    filled = panel.forward_fill_gaps(stored, ["e"], "day", horizon=F.lit(60))
    both = panel.prev_day_delta(panel.forward_fill_gaps(stored, ["e"], "day", horizon=F.lit(60)), ["e"], "day", {"n": "n_new"})
    for df, same in ((delta, panel.prev_day_delta(rows, ["e"], "day", {"n": "n_new"})), (filled, panel.forward_fill_gaps(rows, ["e"], "day", horizon=F.lit(60))), (both, None)):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        if same is not None:
            assert Counter(map(tuple, df.collect())) == Counter(map(tuple, same.collect()))


def _ragged(tmp_path, lines):
    text = _text(tmp_path)
    path = tmp_path / "nytcounties_raw"
    path.write_text("\n".join([",".join(contracts.NYTCOUNTIES.header), *lines]) + "\n")
    return text


def test_damaged_rows_are_put_aside(spark, series, tmp_path, rows):
    lines = ["2020-03-14,H,K,20079,1,0", "2020-03-15,H,K,20079,4,1,more,\"a,b\"", "2020-03-15,U,K", "2020-03-16,H,K,20079,x,y", ",H,K,1,1,1", "2020-03-17,H,K,20079,,1"]
    text = _ragged(tmp_path, lines)
    root = str(tmp_path / "s")
    tables = ungated(spark, Landing(text, series, tolerance={"nytcounties_raw": Tolerance(True, 0.5)}), root)
    assert rows(tables["nytcounties_raw"], "date_julian", "cases") == [(2458923, 1), (2458924, 4)]
    report = store.open_report(spark, root)
    found = rows(report["rejects"], "source", "line", "reason")
    assert [r[:2] for r in found[:2]] == [("nytcounties_raw", "2020-03-15,U,K"), ("nytcounties_raw", "2020-03-16,H,K,20079,x,y")]
    assert {r[2] for r in found} == {"too few fields", "not of the type: cases, deaths", "missing or out of range: cases"}
    assert all("nytcounties_raw" in r["file"] for r in report["rejects"].collect())
    counts = {(r["source"], r["measure"]): r["value"] for r in report["build_report"].collect()}
    assert [counts["nytcounties_raw", m] for m in ("rows_read", "rejects", "blank_leads", "rows_stored")] == [6, 3, 1, 2]
    assert counts["owid_raw", "blank_leads"] == 1 and counts["location_map", "repeated_keys"] == 1
    with pytest.raises(QualityError, match="3 of 6 rows rejected"):
        ungated(spark, Landing(text, series, tolerance={"nytcounties_raw": Tolerance(True, 0.4)}), root)
    with pytest.raises(QualityError, match="4 of 6 rows rejected"):  # surplus fields are damage, too
        ungated(spark, Landing(text, series, tolerance={"nytcounties_raw": Tolerance(False, 0.5)}), root)
    with pytest.raises(Exception):
        ungated(spark, Landing(text, series), root)
    assert store.commits(spark, root) == [1]


def test_a_tolerant_lookup_keeps_its_order(spark, series, tmp_path):
    text = _text(tmp_path)
    tolerant = Landing(text, series, tolerance={"loc_lookup": Tolerance(), "location_map": Tolerance()})
    tables = ungated(spark, tolerant, str(tmp_path / "s"))
    strict = ungated(spark, Landing(text, series), str(tmp_path / "s"))
    for name in ("loc_lookup", "cdataset_loc", "cdataset_raw"):
        assert Counter(map(tuple, tables[name].collect())) == Counter(map(tuple, strict[name].collect())), name


def test_gates_go_by_what_was_written(spark, series, tmp_path, monkeypatch):
    from daypanel.plans import build as job

    def counted_again(*_):
        raise AssertionError("a table was read for a gate")

    monkeypatch.setattr(job, "row_counts", counted_again)
    monkeypatch.setattr(job, "point_expectations", counted_again)
    landing = Landing(_text(tmp_path), series)
    held = [Expectation("harveycodata", "date = '2020-08-15'", "harveyco_neg_results", 28), Expectation("harveycodata", "date = '2020-07-19'", "harveyco_pos_results", None)]
    build_and_register(spark, landing, str(tmp_path / "s"), minimum_rows={"cdataset": 5, "harveycodata": 3, "loc_lookup": 3}, expectations=held)
    with pytest.raises(QualityError, match="too few rows: {'harveycodata': 3}"):
        ungated(spark, landing, str(tmp_path / "s"), minimum_rows={"harveycodata": 4})
    with pytest.raises(QualityError, match="unexpected value: .*harveyco_neg_results is 28 in 1 rows, not 27"):
        ungated(spark, landing, str(tmp_path / "s"), expectations=[Expectation("harveycodata", "date = '2020-08-15'", "harveyco_neg_results", 27)])
    with pytest.raises(QualityError, match="in 0 rows"):
        ungated(spark, landing, str(tmp_path / "s"), expectations=[Expectation("harveycodata", "date = '1999-01-01'", "harveyco_neg_results", None)])


def test_without_new_locations_no_fact_is_read_for_them(spark, tmp_path, monkeypatch, rows):
    from daypanel.plans import build as job, case_facts

    asked = []
    extend = case_facts.extend_locations
    monkeypatch.setattr(case_facts, "extend_locations", lambda base, facts: asked.append(facts) or extend(base, facts))
    known = [_series(spark, [("d1", "a", "2020-03-14", 10, None), ("d2", "b", "2020-03-12", 7, None)])]
    tables = job.build(spark, Landing(_text(tmp_path), known), str(tmp_path / "s"), **job.UNGATED)
    assert not asked and rows(tables["cdataset_loc"], "locid") == [(1,), (2,), (3,)]
    some = [_series(spark, [("d1", "a", "2020-03-14", 10, None), ("d1", "z", "2020-03-12", 7, None)])]
    tables = job.build(spark, Landing(_text(tmp_path), some), str(tmp_path / "s"), **job.UNGATED)
    assert rows(tables["cdataset_loc"], "locid") == [(1,), (2,), (3,), (4,)]
    assert any("EqualTo(is_new,true)" in f for f in pushed(asked[0].where("is_new")))
