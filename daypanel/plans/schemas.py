"""Row types of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

from daypanel.plans.case_facts import (
    ADVANCE_ON_FILL, CDATASET_LOC, CDATASET_LOC_REQUIRED, CDATASET_RAW, CDATASET_RAW_REQUIRED, COUNTS, DAY,
)
from daypanel.sources.contract import SourceContract
from daypanel.sources.contracts import CONTRACTS, LOCATION_MAP

_INTEGERS = {"locid", "us_county_fips", "factbook_population", *COUNTS, *ADVANCE_ON_FILL}


def _of_contract(contract: SourceContract) -> T.StructType:
    kinds = {f.name: f.dataType for f in contract.schema}
    types = {f.stored: T.LongType() if f.stored in contract.rounded else kinds[f.header] for f in contract.fields}
    types[DAY] = T.IntegerType()
    return T.StructType([T.StructField(c, types[c], c not in contract.required) for c in contract.layout])


def _facts(name: str) -> T.DataType:
    if name == DAY:
        return T.IntegerType()
    if name == "dataset":
        return T.StringType()
    return T.LongType() if name in _INTEGERS else T.DoubleType()


SCHEMAS: dict[str, T.StructType] = {
    "build_meta": T.StructType([T.StructField(c, T.StringType(), False) for c in ("field", "value")]),
    **{name: _of_contract(c) for name, c in CONTRACTS.items() if c is not LOCATION_MAP},
    "cdataset_loc": T.StructType([
        T.StructField(c, T.LongType() if c in _INTEGERS else T.StringType(), c not in CDATASET_LOC_REQUIRED)
        for c in CDATASET_LOC
    ]),
    "cdataset_raw": T.StructType([T.StructField(c, _facts(c), c not in CDATASET_RAW_REQUIRED) for c in CDATASET_RAW]),
}

#: Panels from which a view takes the difference to the day before.
DELTA_TABLES = ("nytcounties_raw",)
#: What a build says about itself, beside the stored tables.
REPORTS: dict[str, T.StructType] = {
    "build_report": T.StructType([T.StructField("source", T.StringType()), T.StructField("measure", T.StringType()), T.StructField("value", T.LongType())]),
    "rejects": T.StructType([T.StructField(c, T.StringType()) for c in ("source", "file", "line", "reason")]),
}
