"""The batch job: landed sources in, checked and published tables out.

Every run rebuilds everything into a new folder (full refresh).  Each text source is scanned once,
in the strict ingest session, and written as its stored table; what follows reads those tables.  What a source lost on the way, and the
figures that gates ask for, are observed while its rows pass by.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from daypanel.functions.calendar import day_text
from daypanel.operators.quality import (
    Expectation, QualityError, expectation_counts, failed_expectations, point_expectations, publish_gate, row_count_gate, stop_on,
)
from daypanel.operators.summaries import row_counts
from daypanel.plans import case_facts, store
from daypanel.plans.views import VIEWS, register_views, view
from daypanel.sources.case_series import scan_case_series
from daypanel.sources.contract import (
    FILE, JUDGED, LINE, REASON, ROW_ORDER, SourceContract, judge_contract, judged_schema, normalise, scan_contract, with_row_order,
)
from daypanel.sources.contracts import CONTRACTS, LOC_LOOKUP, LOCATION_MAP

# The least rows a complete build of the public sources has.
MINIMUM_ROWS = {"cdataset": 1250000, "covidtracking": 9000, "loc_lookup": 4000, "rtlive": 8000, "harveycodata": 80}
# Published figures of the single-county source that a build must reproduce.
HARVEY_EXPECTATIONS = [
    Expectation("harveycodata", f"date = '{day}'", column, value)
    for day, figures in {
        "2020-07-19": {"kdhe_neg_results": 52, "kdhe_pos_results": 1, "harveyco_neg_results": None,
                       "harveyco_pos_results": None},
        "2020-08-15": {"kdhe_neg_results": 49, "kdhe_pos_results": 21, "harveyco_neg_results": 28,
                       "harveyco_pos_results": 4},
        "2020-06-30": {"harveyco_recovered": 20, "harveyco_confirmed": 41},
    }.items()
    for column, value in figures.items()
]


#: Options of :func:`build` for sources that are not the whole public ones.
UNGATED = {"minimum_rows": {}, "expectations": ()}


@dataclass(frozen=True)
class Tolerance:
    """allow_extra: rows with surplus trailing fields are sound.  share: a greater part of rejected rows fails the build."""

    allow_extra: bool = False
    share: float = 0.0


@dataclass(frozen=True)
class Landing:
    """Where the sources lie: a path per contract name, and the case series in their order of precedence.

    multi_line: names of the contracts whose files may hold quoted line breaks.
    tolerance: for contracts whose damaged rows are put aside instead of failing the build, see :class:`Tolerance`.
    """

    text: Mapping[str, str]
    case_series: Sequence[DataFrame] = field(default_factory=tuple)
    multi_line: frozenset[str] = frozenset()
    tolerance: Mapping[str, Tolerance] = field(default_factory=dict)

    @classmethod
    def of_folder(cls, spark: SparkSession, folder: str, case_series: Sequence[str], fmt: str = "parquet",
                  multi_line: Sequence[str] = ()) -> Landing:
        """Text sources in ``folder/<contract name>``, case series in ``folder/case_series/<name>``."""
        unknown = set(multi_line) - set(CONTRACTS)
        if unknown:
            raise ValueError(f"no such text source: {sorted(unknown)}")
        text = {name: f"{folder}/{name}" for name in CONTRACTS}
        series = [scan_case_series(spark, f"{folder}/case_series/{name}", fmt) for name in case_series]
        return cls(text, series, frozenset(multi_line))


def build(spark: SparkSession, landing: Landing, root: str, minimum_rows: Mapping[str, int] = MINIMUM_ROWS,
          expectations: Sequence[Expectation] = HARVEY_EXPECTATIONS) -> dict[str, DataFrame]:
    """Build, check and publish all tables under ``root``; returns the published tables.

    The row-count and expected-value gates are those of the public sources unless others are given; ``**UNGATED`` switches them off.

    A broken rule raises and leaves the published build as it was, and so does a build that another one overtook
    (:class:`daypanel.plans.store.PublishConflict`).  What the build read, left out and stored is kept with it, see
    :func:`daypanel.plans.store.open_report`.
    """
    build_id, follows = store.begin(spark, root)
    try:
        tables = _build(spark, landing, root, build_id, minimum_rows, expectations)
        store.publish(spark, root, build_id, follows)
    except BaseException:
        store.give_up(spark, root, build_id)
        raise
    return tables


def _build(spark: SparkSession, landing: Landing, root: str, build_id: str, minimum_rows: Mapping[str, int],
           expectations: Sequence[Expectation]) -> dict[str, DataFrame]:
    tables = {"build_meta": store.write_meta(spark, store.table_path(root, build_id, "build_meta"))}
    report: list[tuple[str, str, int]] = []
    # The text sources do not depend on each other, and the cases on two of them: their jobs share the cluster instead of queueing.
    with ThreadPoolExecutor(len(CONTRACTS) + 1) as pool:
        ingested = {name: pool.submit(_ingest, spark, c, landing, root, build_id, report, expectations) for name, c in CONTRACTS.items()}
        cases = pool.submit(_build_cases, landing.case_series, ingested, root, build_id, report)
        staged = {name: done.result() for name, done in ingested.items()}
        built = cases.result()
    tables |= {name: df for name, df in staged.items() if name in store.SCHEMAS}
    tables["loc_lookup"] = _write(staged["loc_lookup"].drop(*ROW_ORDER), root, build_id, "loc_lookup")
    tables |= built
    _write_report(spark, landing, root, build_id, report)
    stored = {source: value for source, measure, value in report if measure == "rows_stored"}
    gates(tables, minimum_rows, [e for e in expectations if e.table not in _IN_PASS], stored)
    return tables


def _write_report(spark: SparkSession, landing: Landing, root: str, build_id: str, report: list[tuple[str, str, int]]) -> None:
    rows = spark.createDataFrame(sorted(report), store.REPORTS["build_report"])
    store.write_table(rows, store.table_path(root, build_id, "build_report"))
    empty = spark.createDataFrame([], store.REPORTS["rejects"])
    kept = [_sorted_out(spark, root, build_id, CONTRACTS[name], True) for name in sorted(landing.tolerance)]
    store.write_table(reduce(DataFrame.unionByName, kept, empty), store.table_path(root, build_id, "rejects"))


def gates(tables: Mapping[str, DataFrame], minimum_rows: Mapping[str, int],
          expectations: Sequence[Expectation], stored: Mapping[str, int] | None = None) -> None:
    """Row-count and point-value gates over the tables and views.

    stored: rows per stored table, counted when they were written.  What these tell, and the number of rows of views that have a row
    for every stored one, is not counted again.
    """
    def named(name: str) -> DataFrame:
        return view(name, tables) if name in VIEWS else tables[name]

    known = {n: (stored or {}).get(_ROW_FOR_ROW.get(n, n)) for n in minimum_rows}
    few = {n: rows for n, rows in known.items() if rows is not None and rows < minimum_rows[n]}
    if few:
        raise QualityError(f"too few rows: {few}, at least {({n: minimum_rows[n] for n in few})}")
    open_ = {n: least for n, least in minimum_rows.items() if known[n] is None}
    if open_:
        counted = row_count_gate(row_counts({n: named(n) for n in open_}), open_)
        stop_on("too few rows", counted.where(~F.col("passed")))
    if expectations:
        wanted = {e.table for e in expectations}
        found = point_expectations({n: named(n) for n in wanted}, expectations)
        stop_on("unexpected value", found.where(~F.col("passed")))


def build_and_register(spark: SparkSession, landing: Landing, root: str, **gate_options) -> list[str]:
    """Build, publish, and make tables and views available to ``spark.sql``."""
    build(spark, landing, root, **gate_options)
    return register_views(spark, store.open_tables(spark, root), store.open_dated(spark, root))


_FILES_PER_DAY = 8
#: Views with one row for every row of a stored table.
_ROW_FOR_ROW = {"cdataset": "cdataset_raw", "covidtracking": "covidtracking_raw", "harveycodata": "harveycodata_raw", "rtlive": "rtlive_raw",
                "owid": "owid_raw"}
#: Of these, those that only compute columns: their expected values are looked for while the stored rows are written.
_IN_PASS = {v: _ROW_FOR_ROW[v] for v in ("covidtracking", "harveycodata", "rtlive", "owid")}


def _ingest(spark: SparkSession, contract: SourceContract, landing: Landing, root: str, build_id: str, report: list[tuple[str, str, int]],
            expectations: Sequence[Expectation]) -> DataFrame:
    # Written by the strict session, read back by the caller's.
    ordered = contract in (LOC_LOOKUP, LOCATION_MAP)
    path, lines = landing.text[contract.name], contract.name in landing.multi_line
    if contract.name in landing.tolerance:
        scanned = _triaged(spark, contract, landing, root, build_id, report)
        if ordered:
            scanned = with_row_order(scanned)
    else:
        scanned = scan_contract(spark, contract, path, ordered, lines)
    seen, kept = Observation(), Observation()
    first = F.col(contract.fields[0].header)
    rows = normalise(contract, scanned.observe(seen, F.count("*").alias("rows_read"), F.count_if(first.isNull()).alias("blank_leads")))
    schema = rows.schema
    wanted = [e for e in expectations if _IN_PASS.get(e.table) == contract.name]
    rows = rows.observe(kept, F.count("*").alias("rows_stored"))
    judged = Observation()
    if wanted:
        seen_as = view(wanted[0].table, {contract.name: rows}).observe(judged, *expectation_counts(wanted))
        rows = seen_as.select(*schema.names)
    if contract.date_field:
        rows = _by_day(_dated(rows, contract.name), contract)
    location = store.table_path(root, build_id, f"{contract.name}_staged" if ordered else contract.name)
    store.write_table(rows, location, required=contract.required, hidden=["date", "date_next"] if contract.date_field else ())
    found = {**(seen.get if contract.name not in landing.tolerance else {"blank_leads": seen.get["blank_leads"]}), **kept.get}
    report += [(contract.name, measure, value) for measure, value in found.items()]
    missed = failed_expectations(wanted, judged.get) if wanted else []
    if missed:
        raise QualityError(f"unexpected value: {missed}")
    stored = store.read_table(spark, location, schema)
    # The location map may repeat a key: its last row is the one that is looked up.
    if contract is not LOCATION_MAP:
        publish_gate(stored, contract.name, contract.key)
    return stored


def _dated(rows: DataFrame, name: str) -> DataFrame:
    """With the day as text, which SQL filters on dates prune by, and the next day where a view looks for the day before."""
    texts = {"date": day_text(case_facts.DAY)}
    if name in store.DELTA_TABLES:
        texts["date_next"] = day_text(F.col(case_facts.DAY) + 1)
    return rows.withColumns(texts)


def _by_day(rows: DataFrame, contract: SourceContract) -> DataFrame:
    """Rows as they are laid out: a day is in few files, whose dictionaries tell a filter so, and in few row groups of each.

    By hash: ranges would be found by a sample, which reads the source once more and counts it twice.  A hot day is spread over several tasks.
    """
    spread = F.pmod(F.xxhash64(*contract.key), F.lit(_FILES_PER_DAY))
    return rows.repartition(F.col(case_facts.DAY), spread).sortWithinPartitions(*dict.fromkeys([case_facts.DAY, *contract.key]))


def _triaged(spark: SparkSession, contract: SourceContract, landing: Landing, root: str, build_id: str, report: list[tuple[str, str, int]]) -> DataFrame:
    """The sound rows of a source that may hold others; it is read once and both kinds are kept side by side."""
    tolerance = landing.tolerance[contract.name]
    if contract.name in landing.multi_line:
        raise ValueError(f"{contract.name}: rejects are told by line, so its rows cannot hold line breaks")
    rows = judge_contract(spark, contract, landing.text[contract.name], tolerance.allow_extra)
    seen = Observation()
    rows = rows.observe(seen, F.count("*").alias("rows_read"), F.count_if(F.col(REASON).isNotNull()).alias("rejects"))
    path = store.table_path(root, build_id, f"{contract.name}_triaged")
    rows.withColumn("rejected", F.col(REASON).isNotNull()).write.partitionBy("rejected").parquet(path)
    n, bad = seen.get["rows_read"], seen.get["rejects"]
    report += [(contract.name, "rows_read", n), (contract.name, "rejects", bad)]
    if bad > tolerance.share * n:
        raise QualityError(f"{contract.name}: {bad} of {n} rows rejected, at most {tolerance.share:.2%} may be")
    return _sorted_out(spark, root, build_id, contract, False)


def _sorted_out(spark: SparkSession, root: str, build_id: str, contract: SourceContract, rejected: bool) -> DataFrame:
    path = store.table_path(root, build_id, f"{contract.name}_triaged")
    schema = judged_schema(contract).add("rejected", "boolean")
    rows = spark.read.schema(schema).parquet(path).where(F.col("rejected") == rejected)
    if rejected:
        return rows.select(F.lit(contract.name).alias("source"), F.col(FILE).alias("file"), F.col(LINE).alias("line"), F.col(REASON).alias("reason"))
    return rows.select(*contract.schema.names, *JUDGED)


def _write(df: DataFrame, root: str, build_id: str, name: str, required: Sequence[str] = (), hidden: Sequence[str] = ()) -> DataFrame:
    path = store.table_path(root, build_id, name)
    return store.write_table(df, path, store.PARTITIONS.get(name, ()), required=required, hidden=hidden)


def _build_cases(case_series: Sequence[DataFrame], ingested: Mapping[str, Future], root: str,
                 build_id: str, report: list[tuple[str, str, int]]) -> dict[str, DataFrame]:
    def counted(name: str, df: DataFrame, *more: Column, **write) -> DataFrame:
        seen = Observation()
        out = _write(df.observe(seen, F.count("*").alias("rows_stored"), *more), root, build_id, name, **write)
        report.extend((name.removesuffix("_staged"), measure, value) for measure, value in seen.get.items())
        return out

    location_rows = ingested[LOCATION_MAP.name].result()
    # Written once: every later step reads the same rows, and the sources no more.  Rows of unknown locations are found on the way.
    # The days to fill are found on the way too, so the wide rows are shuffled and sorted for it once.
    series = case_facts.find_next_days(case_facts.prepare_sources(case_series))
    flagged = case_facts.flag_unknown(series, location_rows)
    series = counted("case_series_staged", flagged, F.count_if(case_facts.IS_NEW).alias("rows_of_new_keys"))
    stop_on("case series", case_facts.series_violations(case_facts.series_spans(series)))
    locations = case_facts.base_locations(location_rows)
    if dict(((s, m), v) for s, m, v in report)["case_series", "rows_of_new_keys"]:
        locations = case_facts.extend_locations(locations, series)
    series = series.drop(case_facts.IS_NEW)
    # Written once, with the key that the facts are looked up by; the stored dimension leaves it out.
    locations = _write(locations, root, build_id, "cdataset_loc_staged")
    dimension = locations.select(*case_facts.CDATASET_LOC)
    dimension = counted("cdataset_loc", dimension, required=case_facts.CDATASET_LOC_REQUIRED)
    publish_gate(dimension, "cdataset_loc", ["locid"])
    fips = case_facts.fips_population(ingested[LOC_LOOKUP.name].result())
    keys = counted("location_keys_staged", case_facts.location_keys(locations, fips))
    by_measure = {(source, measure): value for source, measure, value in report}
    report.append(("location_map", "repeated_keys", by_measure["cdataset_loc", "rows_stored"] - by_measure["location_keys", "rows_stored"]))
    # Finding the next days refused duplicate keys, and no two sources cover the same days: the key is unique.
    facts = case_facts.by_day(_dated(case_facts.facts(series, keys), "cdataset_raw"), case_facts.day_sizes(series))
    facts = counted("cdataset_raw", facts, required=case_facts.CDATASET_RAW_REQUIRED, hidden=["date"])
    return {"cdataset_loc": dimension, "cdataset_raw": facts}
