"""python tests/llm/oracle.py folder [query ...]: queries of the llm folder against their SQL."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from ledgerspark.llm.queries import ORACLES, QUERIES  # noqa: E402


def compare(spark, folder: str, name: str) -> str | None:
    con = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    expected = con.execute(ORACLES[name])
    names = [d[0] for d in expected.description]
    want = sorted(expected.fetchall(), key=repr)
    df = QUERIES[name](spark, folder)
    if set(df.columns) != set(names):
        return f"columns {set(df.columns) ^ set(names)}"
    got = sorted((tuple(r) for r in df.select(*names).collect()), key=repr)
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} differ, first {wrong[0]}" if wrong else None


if __name__ == "__main__":
    from ledgerspark.session import local_session

    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    for name in sys.argv[2:] or QUERIES:
        began = time.time()
        if name in ORACLES:
            print(name, compare(spark, sys.argv[1], name) or "ok", round(time.time() - began, 1), flush=True)
        else:
            df = QUERIES[name](spark, sys.argv[1])
            rows = df.collect()
            print(name, len(rows), df.columns, rows[:3], round(time.time() - began, 1), flush=True)
