"""Reading delimited text against a contract: exact header, declared types, no inference.

A source is read in :func:`daypanel.session.ingest_session`.  Spark compares header names by the rules of
the session that executes a plan, which need not be the strict one, so headers are checked when a scan is
made: a small job opens every file once and reads no further than its first rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from daypanel.functions.calendar import ISO_DATE, julian_day, parse_day
from daypanel.functions.numeric import INT64_MAX, UINT32_MAX, require_range, require_value, round_half_away
from daypanel.functions.text import empty_to_null, null_to_empty
from daypanel.session import ingest_session

TEXT, INT, REAL, U32, U64 = "text", "int", "real", "u32", "u64"

_TYPES = {TEXT: T.StringType(), INT: T.LongType(), REAL: T.DoubleType(), U32: T.LongType(), U64: T.LongType()}
_UNSIGNED = {U32: UINT32_MAX, U64: INT64_MAX}

ROW_ORDER = ["__file", "__block", "__row"]
_CORRUPT = "_corrupt_record"
# Beside the fields of a judged row: where it stood, its line, and why it is no sound row (NULL if it is one).
FILE, BLOCK, PLACE, LINE, REASON = JUDGED = ["_file", "_block", "_place", "_line", "_reason"]
_ONE_FILE = str(1 << 36)
_REFUSED = "CSV header does not conform"


class HeaderError(ValueError):
    """A file's header is not the contract's."""


@dataclass(frozen=True)
class Field:
    """One header column: its type, whether an empty field is allowed, and the stored name."""

    header: str
    kind: str
    optional: bool = False
    name: str | None = None

    @property
    def stored(self) -> str:
        return self.name or self.header


@dataclass(frozen=True)
class SourceContract:
    """What a text source must look like and how it is stored.

    layout: stored columns in table order.  ``date_julian`` is derived from ``date_field``.
    ignored: trailing header columns that are checked but not decoded.
    """

    name: str
    fields: tuple[Field, ...]
    layout: tuple[str, ...]
    key: tuple[str, ...]
    required: tuple[str, ...] = ()
    ignored: tuple[str, ...] = ()
    date_field: str | None = None
    date_format: str = ISO_DATE
    empty_as_null: tuple[str, ...] = ()
    rounded: tuple[str, ...] = ()
    separator: str = ","
    doubled_quotes: bool = True

    @property
    def header(self) -> list[str]:
        return [f.header for f in self.fields] + list(self.ignored)

    @property
    def schema(self) -> T.StructType:
        columns = [T.StructField(f.header, _TYPES[f.kind]) for f in self.fields]
        return T.StructType(columns + [T.StructField(h, T.StringType()) for h in self.ignored])


def scan_contract(spark: SparkSession, contract: SourceContract, path: str, with_order: bool = False,
                  multi_line: bool = False) -> DataFrame:
    """The source's rows under their header names.

    Another header (names, order or letter case) in any file raises at once.  A row that is too short or
    too long, or a field that does not fit its type fails the job that reads it, whichever columns
    that job needs.
    with_order: add ``ROW_ORDER``, columns that sort the rows as they stand in the files.
    """
    check_headers(spark, contract, path, multi_line)
    reader = _reader(ingest_session(spark), contract, multi_line).schema(contract.schema)
    df = _needing_all(reader.option("mode", "FAILFAST").csv(path))
    return _with_order(df) if with_order else df


def check_headers(spark: SparkSession, contract: SourceContract, path: str, multi_line: bool = False) -> None:
    """Raise :class:`HeaderError` if a file's header differs from the contract's in names, order or letter case.

    Runs a job in a strict session of its own: one task per file, which stops after its first row.
    """
    strict = ingest_session(spark)
    # A file counts as much as a task may read, so no task opens two.
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        strict.conf.set(key, _ONE_FILE)
    strict.conf.unset("spark.sql.files.maxPartitionNum")
    rows = _needing_all(_reader(strict, contract, multi_line).schema(contract.schema).csv(path))
    try:
        rows.limit(1).agg(F.count("*")).collect()  # the limit holds in every task before it holds for all
    except (PySparkException, Py4JJavaError) as e:
        if _REFUSED in str(e):
            raise HeaderError(f"{path}: the header is not that of {contract.name}: {','.join(contract.header)}") from e
        raise


def normalise(contract: SourceContract, df: DataFrame) -> DataFrame:
    """Scanned rows as stored: renamed, dated, checked, and laid out by name.

    Rows whose first field is empty are dropped, see :func:`blank_lead_count`.
    """
    order = [F.col(c) for c in ROW_ORDER if c in df.columns]
    kept = df.where(F.col(contract.fields[0].header).isNotNull())
    columns = {f.stored: _stored(contract, f) for f in contract.fields}
    if contract.date_field:
        source = next(f for f in contract.fields if f.stored == contract.date_field)
        columns["date_julian"] = julian_day(parse_day(F.col(source.header), contract.date_format))
    return kept.select(*[columns[c].alias(c) for c in contract.layout], *order)


def read_contract(spark: SparkSession, contract: SourceContract, path: str, with_order: bool = False,
                  multi_line: bool = False) -> DataFrame:
    """Scan and normalise in one step."""
    return normalise(contract, scan_contract(spark, contract, path, with_order, multi_line))


def blank_lead_count(contract: SourceContract, df: DataFrame) -> DataFrame:
    """How many scanned rows :func:`normalise` drops for their empty first field."""
    return df.agg(F.count_if(F.col(contract.fields[0].header).isNull()).alias("dropped_rows"))


def drop_blank_lead(df: DataFrame, first: str) -> DataFrame:
    """Keep the rows whose first field is neither NULL nor empty."""
    return df.where(empty_to_null(F.col(first)).isNotNull())


def triage_contract(spark: SparkSession, contract: SourceContract, path: str,
                    allow_extra: bool = False) -> tuple[DataFrame, DataFrame]:
    """Split a source into decodable rows and rejects (``_corrupt_record``: the raw line).

    The header is still enforced.  allow_extra: a row with surplus trailing fields is kept and the
    surplus ignored, as long as it decodes otherwise.
    """
    check_headers(spark, contract, path)
    rows = _needing_all(_permissive(spark, contract).csv(path))
    bad = F.col(_CORRUPT).isNotNull()
    if allow_extra:
        bad = bad & _undecodable(contract)
    good = rows.where(~bad).select(*contract.schema.names)
    return good, rows.where(bad).select(F.col(contract.fields[0].header).alias("first_field"), _CORRUPT)


def judge_contract(spark: SparkSession, contract: SourceContract, path: str, allow_extra: bool = False) -> DataFrame:
    """Every row of a source in one scan: its fields, and ``JUDGED``, which says where it stood and why it is no sound row.

    A rejected row's fields are what could be decoded.  A row that lacks a required field or has one out of its range is rejected too.  Rows with an
    empty first field are sound: they are dropped later, as in any scan.
    """
    check_headers(spark, contract, path)
    rows = _needing_all(_permissive(spark, contract).csv(path))
    flagged = F.col(_CORRUPT).isNotNull()
    n_fields = _field_count(contract)
    width = len(contract.header)
    lost = [F.when(c, F.lit(name)) for name, c in _lost_fields(contract).items()]
    broken = {f.header: _out_of_contract(f) for f in contract.fields}
    broken = [F.when(c, F.lit(name)) for name, c in broken.items() if c is not None]
    dropped = F.col(contract.fields[0].header).isNull()
    reason = (
        F.when(flagged & (n_fields < width), F.lit("too few fields"))
        .when(flagged & (F.size(F.array_compact(F.array(*lost))) > 0 if lost else F.lit(False)),
              F.concat(F.lit("not of the type: "), F.array_join(F.array(*lost), ", ")))
        .when(flagged & (n_fields > width) & F.lit(not allow_extra), F.lit("too many fields"))
        .when(flagged & (n_fields == width), F.lit("malformed"))
    )
    if broken:
        missing = F.array_join(F.array(*broken), ", ")
        reason = F.coalesce(reason, F.when(~dropped & (missing != ""), F.concat(F.lit("missing or out of range: "), missing)))
    return rows.select(
        *contract.schema.names, F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(PLACE), F.when(reason.isNotNull(), F.coalesce(_CORRUPT, F.to_json(F.struct(*contract.schema.names)))).alias(LINE),
        reason.alias(REASON))


def judged_schema(contract: SourceContract) -> T.StructType:
    kinds = (T.StringType(), T.LongType(), T.LongType(), T.StringType(), T.StringType())
    return T.StructType([*contract.schema.fields, *[T.StructField(n, k) for n, k in zip(JUDGED, kinds)]])


def with_row_order(rows: DataFrame) -> DataFrame:
    """Judged rows with ``ROW_ORDER``."""
    return rows.withColumnsRenamed(dict(zip((FILE, BLOCK, PLACE), ROW_ORDER)))


def _permissive(spark: SparkSession, contract: SourceContract):
    schema = contract.schema.add(_CORRUPT, T.StringType())
    return (
        _reader(ingest_session(spark), contract, False)
        .schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT)
    )


def _out_of_contract(f: Field) -> Column | None:
    """Whether a field lacks a value it must have or lies outside its range; None if it may be anything."""
    c = F.col(f.header)
    rules = [] if f.optional or f.kind == TEXT else [c.isNull()]
    if f.kind in _UNSIGNED:
        rules.append(~c.between(0, _UNSIGNED[f.kind]))
    return reduce(or_, [F.coalesce(r, F.lit(False)) for r in rules]) if rules else None


def _reader(strict: SparkSession, contract: SourceContract, multi_line: bool):
    reader = strict.read.option("header", True).option("enforceSchema", False).option("sep", contract.separator)
    for key, value in _quoting(contract).items():
        reader = reader.option(key, value)
    return reader.option("multiLine", multi_line)


def _quoting(contract: SourceContract) -> dict[str, str]:
    # A doubled quote inside a quoted field is one quote; a backslash is always just a backslash.
    return {"quote": '"', "escape": '"' if contract.doubled_quotes else "\u0000"}


def _needing_all(df: DataFrame) -> DataFrame:
    """``df`` itself, but with every column needed.

    The reader only converts the columns that a query needs and would miss a malformed value in any
    other.  To keep rows with at least no value is to keep them all: it looks at nothing, yet the
    optimizer sees every column in it.
    """
    return df.na.drop(thresh=0)


def _undecodable(contract: SourceContract) -> Column:
    """Whether a flagged row is wrong beyond having surplus fields: too short, or a field that lost its value."""
    return reduce(or_, _lost_fields(contract).values(), _field_count(contract) < len(contract.header))


def _field_count(contract: SourceContract) -> Column:
    # Quoted stretches may hold separators, which do not count.
    plain = f"\\Q{contract.separator}\\E"  # not as a regular expression
    return F.size(F.split(F.regexp_replace(F.col(_CORRUPT), '"[^"]*"', ""), plain, -1))


def _lost_fields(contract: SourceContract) -> dict[str, Column]:
    """For each field that is no text: whether a flagged row has something there that did not become a value."""
    as_text = T.StructType([T.StructField(h, T.StringType()) for h in contract.header])
    text = F.from_csv(F.col(_CORRUPT), as_text.simpleString(), {"sep": contract.separator, **_quoting(contract)})
    return {f.name: text[f.name].isNotNull() & F.col(f.name).isNull() for f in contract.schema if not isinstance(f.dataType, T.StringType)}


def _with_order(df: DataFrame) -> DataFrame:
    return df.select(
        "*",
        F.col("_metadata.file_path").alias(ROW_ORDER[0]),
        F.col("_metadata.file_block_start").alias(ROW_ORDER[1]),
        F.monotonically_increasing_id().alias(ROW_ORDER[2]),
    )


def _stored(contract: SourceContract, f: Field) -> Column:
    c = F.col(f.header)
    label = f"{contract.name}.{f.header}"
    if f.kind == TEXT:
        if not contract.doubled_quotes:
            # A quote inside a quoted field ends the quoting and the rest is taken as it stands; the reader
            # leaves such a field raw, with its first quote, which no other field can start with.
            c = F.regexp_replace(c, '(?s)^"([^"]*)"(.*)$', "$1$2")
        if f.stored in contract.empty_as_null:
            return empty_to_null(c)
        return c if f.optional else null_to_empty(c)
    if f.kind in _UNSIGNED:
        c = require_range(c, 0, _UNSIGNED[f.kind], label)
    if not f.optional:
        c = require_value(c, _TYPES[f.kind].simpleString(), label)
    return round_half_away(c) if f.stored in contract.rounded else c
