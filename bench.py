"""Times the registered queries and prints one JSON line.

BENCH_SF_DIR names the test tables, BENCH_CPUS the local cores. Each query runs
once untimed on the smallest tables, which loads classes and compiles code, and
then once timed on the full tables with its result written to no sink. DuckDB's
time for the same SQL, on as many threads, is beside it as information.
"""

from __future__ import annotations

import contextlib
import json
import os
import sys
import time
from pathlib import Path

from ledgerspark.catalogue.oracles import ORACLES
from ledgerspark.catalogue.queries import QUERIES
from ledgerspark.session import local_session

HEADLINE = [
    "cascade_totals", "cascade_allocate", "technical_result", "direct_premium", "product_dim",
    "current_policies", "line_map", "distinct_after_rank", "financial_facts", "managed_result",
    "latest_order", "employee_master", "absence_calendar", "rolling_months", "semi_policies",
    "fx_rates", "sync_status_of_orders", "sync_claim", "sync_envelope", "publish_roundtrip",
    "stream_sync",
]


def run(spark, name: str, folder: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - began, 3)


def duckdb_time(name: str, folder: str, cpus: int) -> float | None:
    """Seconds DuckDB takes to make the same rows, None without DuckDB or SQL."""
    with contextlib.suppress(ImportError, KeyError):
        import duckdb

        con = duckdb.connect(config={"threads": cpus})
        con.execute("SET TimeZone='UTC'")
        for file in Path(folder).glob("*.parquet"):
            con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
        sql, began = ORACLES[name], time.perf_counter()
        con.execute(f"CREATE TEMP TABLE result AS {sql}")
        return round(time.perf_counter() - began, 3)
    return None


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    warm_up = Path(folder).parent / "sf0.001"
    times, other = {}, {}
    for name in sys.argv[1:] or HEADLINE:
        if warm_up.exists():
            run(spark, name, str(warm_up))
        times[name] = run(spark, name, folder)
        other[name] = duckdb_time(name, folder, cpus)
        print(f"{name} {times[name]} duckdb {other[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "duckdb": other,
        "sf": Path(folder).name,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
