"""Case-series tables: read by column name, some columns may be missing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Columns of a case-series table.  The second group may be absent from a table.
MANDATORY = T.StructType(
    [T.StructField(c, T.StringType()) for c in """
        dataset location_key date location_type location_label country_code country region""".split()]
    + [T.StructField(c, T.IntegerType()) for c in """
        date_year date_month date_day day_index_0 day_index_1 day_index_10 day_index_100 day_index_1k day_index_10k
        day_index_peak day_index_peak_confirmed day_index_peak_deaths""".split()]
    + [T.StructField(c, T.LongType()) for c in """
        absolute_confirmed absolute_deaths absolute_infected delta_confirmed delta_deaths delta_infected
        factbook_population""".split()]
    + [T.StructField(c, T.DoubleType()) for c in """
        location_lat location_long relative_deaths relative_infected delta_pct_confirmed delta_pct_deaths
        delta_pct_infected peak_pct_confirmed peak_pct_deaths peak_pct_infected
        factbook_area factbook_death_rate factbook_median_age""".split()]
)
OPTIONAL = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("province", "administrative")]
    + [T.StructField(c, T.LongType()) for c in ("absolute_recovered", "delta_recovered")]
    + [T.StructField(c, T.DoubleType()) for c in """
        relative_recovered delta_pct_recovered peak_pct_recovered
        absolute_pop100k_confirmed absolute_pop100k_deaths absolute_pop100k_recovered absolute_pop100k_infected
        delta_pop100k_confirmed delta_pop100k_deaths delta_pop100k_recovered delta_pop100k_infected""".split()]
)

SOURCE = "source_ord"


def scan_case_series(spark: SparkSession, location: str | None = None, fmt: str = "parquet", **options) -> DataFrame:
    """A case-series table: a Parquet folder, or any format Spark has a reader for (``fmt="jdbc"`` with its options)."""
    reader = spark.read.format(fmt).options(**options)
    return reader.load(location) if location else reader.load()


def align_schema(df: DataFrame, mandatory: T.StructType, optional: T.StructType) -> DataFrame:
    """The declared columns by name and type: absent optional ones are NULL, surplus ones are left out.

    An absent mandatory column is an error.
    """
    have = set(df.columns)
    missing = [f.name for f in mandatory if f.name not in have]
    if missing:
        raise ValueError(f"columns missing from case series: {missing}")
    columns = [
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in [*mandatory, *optional]
    ]
    return df.select(*columns)


def union_sources(sources: Sequence[DataFrame]) -> DataFrame:
    """All rows of the sources in one table, by column name; ``source_ord`` tells them apart."""
    if not sources:
        raise ValueError("no case series given")
    tagged = [df.withColumn(SOURCE, F.lit(i)) for i, df in enumerate(sources)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
