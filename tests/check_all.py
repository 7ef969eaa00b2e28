"""Run every query against its SQL counterpart: ``python tests/check_all.py [folder] [name ...]``."""

import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from tests.compare import connect, differences  # noqa: E402

if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(queries())
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", os.environ.get("CHECK_TZ", "UTC")).getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con, oracle, failed = connect(sf_dir), oracle_sql(), []
    for name in wanted:
        start = time.time()
        try:
            df = queries()[name](spark, sf_dir)
            bad = differences(df, con, oracle[name]) if name in oracle else [f"no SQL; {df.count()} rows"]
        except Exception as e:
            bad = [f"{type(e).__name__}: {str(e)[:1500]}"]
        print(f"{'ok ' if not bad else 'BAD'} {name} {time.time() - start:.1f}s", *bad, sep="\n    ", flush=True)
        failed += [name] if bad else []
    print(f"{len(wanted) - len(failed)} of {len(wanted)} agree; differing: {failed}")
