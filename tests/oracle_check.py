"""Compare queries with their SQL on DuckDB: python tests/oracle_check.py [folder] [query ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgerspark.catalogue.oracles import ORACLES  # noqa: E402
from ledgerspark.catalogue.queries import QUERIES  # noqa: E402


def sorted_rows(rows: list[tuple], columns: list[str]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def difference(spark: SparkSession, folder: str, name: str) -> str | None:
    """First difference between a query and its SQL, or None."""
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    expected = con.execute(ORACLES[name])
    names = [d[0] for d in expected.description]
    want = sorted_rows(expected.fetchall(), names)
    df = QUERIES[name](spark, folder)
    got = sorted_rows([tuple(r) for r in df.collect()], df.columns)
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(set(df.columns) ^ set(names))}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for g, w in zip(got, want):
        if repr(g) != repr(w):
            return f"{g} expected {w}"
    return None if got else "no rows to compare"


if __name__ == "__main__":
    from ledgerspark.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = local_session()
    session.sparkContext.setLogLevel("ERROR")
    for query in sys.argv[2:] or QUERIES:
        began = time.time()
        try:
            outcome = difference(session, folder, query) or "ok"
        except Exception as error:  # report and go on with the next query
            outcome = f"{type(error).__name__}: {str(error)[:900]}"
        print(f"{query:24s} {time.time() - began:6.1f}s {outcome}", flush=True)
