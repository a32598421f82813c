from datetime import date, datetime
from random import Random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerspark.functions import calendar
from ledgerspark.functions.values import switch_at
from ledgerspark.operators.flatten import explode_left, explode_where
from ledgerspark.operators.matching import join_null_safe, match_any_key, rolling_months_join
from ledgerspark.operators.pick import latest_link
from ledgerspark.operators.rank import rank_within
from ledgerspark.params import Params
from ledgerspark.sources.snapshots import shifted, snapshot_asof
from ledgerspark.sources.tables import not_deleted, read_table, typed_mapping


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


NESTED = "id int, arr array<struct<k:string,v:int>>"


def nested(spark):
    return spark.createDataFrame(
        [(1, [("a", 1), ("b", 2)]), (2, []), (3, None), (4, [("b", 5)])], NESTED
    )


def test_explode_left_keeps_rows_without_elements(spark, rows):
    out = explode_left(nested(spark), "arr", "e").select("id", "e.k")
    assert rows(out) == [(1, "a"), (1, "b"), (2, None), (3, None), (4, "b")]
    out = explode_left(nested(spark), "arr", "e", lambda e: e["k"] == "a").select("id", "e.v")
    assert rows(out) == [(1, 1), (2, None), (3, None), (4, None)]


def test_explode_where_is_inner(spark, rows):
    out = explode_where(nested(spark), "arr", "e", lambda e: e["k"] == "b").select("id", "e.v")
    assert rows(out) == [(1, 2), (4, 5)]


def test_match_any_key_equals_in_join(spark, rows):
    left = spark.createDataFrame([("1",), ("2",), ("3",), (None,), ("0",)], "k string")
    right = spark.createDataFrame(
        [("a", "1", "S2"), ("b", "2", "S2"), ("c", None, "S3"), ("d", "9", None), ("e", None, None)],
        "id string, own string, alt string",
    )
    keys = [F.concat(F.lit("S"), F.col("own")), F.coalesce("alt", F.lit("0"))]
    out = match_any_key(left, F.concat(F.lit("S"), F.col("k")), right, keys).select("k", "id")
    left.createOrReplaceTempView("l")
    right.createOrReplaceTempView("r")
    expected = spark.sql(
        "SELECT k, id FROM l JOIN r ON 'S' || k IN ('S' || own, coalesce(alt, '0'))"
    )
    assert rows(out) == rows(expected) == [("1", "a"), ("2", "a"), ("2", "b"), ("3", "c")]
    assert "CartesianProduct" not in plan(out) and "NestedLoop" not in plan(out)


def test_rolling_months_join_equals_range_join(spark, rows):
    bounds = spark.createDataFrame([(date(2024, 3, 1), date(2024, 4, 1))], "a date, b date")
    spine = calendar.month_spine(bounds, F.col("a"), F.col("b"))
    months = [date(2023, 12, 1), date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1),
              date(2024, 4, 1), date(2024, 5, 1)]
    data = spark.createDataFrame([(m,) for m in months], "p date")
    out = rolling_months_join(data, spine, "p").select("p", "fec_inicio")
    data.createOrReplaceTempView("d")
    spine.createOrReplaceTempView("s")
    expected = spark.sql("SELECT p, fec_inicio FROM d JOIN s ON p BETWEEN fec_inicio_ant AND fec_fin")
    assert rows(out) == rows(expected)
    assert out.count() == 6
    first, last = F.lit(date(2024, 3, 1)), F.lit(date(2024, 4, 1))
    by_array = data.select("p", F.explode(calendar.window_months(F.col("p"), first, last)))
    assert rows(by_array) == rows(expected)


def test_month_spine_columns(spark, rows):
    bounds = spark.createDataFrame([(date(2024, 1, 1), date(2024, 2, 1))], "a date, b date")
    out = calendar.month_spine(bounds, F.col("a"), F.col("b"))
    assert rows(out)[0] == (
        "202401", "202311", 2024, 1, date(2024, 1, 1), date(2024, 1, 31),
        date(2023, 11, 1), date(2023, 11, 30),
    )
    empty = calendar.month_spine(bounds, F.col("b"), F.col("a"))
    assert empty.count() == 0


def test_months_desc_newest_first(spark):
    one = spark.createDataFrame([(2023, date(2024, 2, 17))], "y int, d date")
    out = calendar.months_desc(one, F.col("y"), F.col("d")).orderBy("posicion").collect()
    assert out[0] == (1, date(2024, 2, 1)) and out[-1] == (14, date(2023, 1, 1))


def test_default_periods():
    assert Params.for_day(date(2024, 6, 30)).start == date(2023, 1, 1)
    july = Params.for_day(date(2024, 7, 9))
    assert (july.start, july.end, july.current) == (
        date(2024, 1, 1), date(2024, 7, 1), date(2024, 7, 1)
    )
    assert july.table("prima") == "tmp_oppo_prima"
    with pytest.raises(ValueError):
        Params(date(2024, 2, 1), date(2024, 1, 1), date(2024, 1, 1))


def test_switch_at(spark, rows):
    days = [date(2024, 3, 1), date(2024, 4, 1), date(2024, 5, 1), None]
    df = spark.createDataFrame([(d,) for d in days], "p date")
    out = df.select("p", switch_at(F.col("p"), date(2024, 4, 1), F.lit("old"), F.lit("new")))
    assert dict(out.collect()) == {days[0]: "old", days[1]: "new", days[2]: "new", None: "new"}


def test_join_null_safe(spark, rows):
    a = spark.createDataFrame([(1, None), (1, "x"), (2, "x")], "k int, n string")
    b = spark.createDataFrame([(1, None, 10), (2, "x", 20)], "k int, n string, v int")
    assert rows(join_null_safe(a, b, ["k", "n"])) == [(1, None, 10), (2, "x", 20)]
    assert rows(join_null_safe(a, b, ["k", "n"], nullable=[])) == [(2, "x", 20)]


@pytest.mark.parametrize("hot_rows", [10_000, 40, 3])
def test_rank_within_equals_row_number(spark, rows, hot_rows):
    rng = Random(7)
    data = [
        (None if rng.random() < 0.1 else "hot" if rng.random() < 0.6 else f"k{rng.randint(0, 20)}",
         None if rng.random() < 0.1 else rng.randint(0, 30), rng.randint(0, 3))
        for _ in range(600)
    ]
    df = spark.createDataFrame(data, "k string, a int, b int")
    out = rank_within(df, ["k"], ["a", "b"], "rn", hot_rows)
    window = Window.partitionBy("k").orderBy("a", "b")
    assert rows(out) == rows(df.withColumn("rn", F.row_number().over(window)))


def test_rank_ties_do_not_depend_on_the_plan(spark, rows):
    df = spark.createDataFrame([("k", 1, c) for c in "cabdb"], "k string, a int, c string")
    ways = [rank_within(df, ["k"], ["a"], "rn", hot_rows) for hot_rows in (100, 2, 1)]
    assert [rows(w) for w in ways] == [[("k", 1, c, n) for n, c in enumerate("abbcd", 1)]] * 3
    assert {w.schema["rn"].dataType.simpleString() for w in ways} == {"bigint"}


def test_latest_link_order_and_plan(spark, rows):
    df = spark.createDataFrame(
        [(1, None, 9), (1, datetime(2024, 1, 1), 1), (1, datetime(2024, 1, 1), 2), (2, None, 3)],
        "k int, ts timestamp, id int",
    )
    out = latest_link(df, "k", "ts", "id")
    assert rows(out.select("k", "id")) == [(1, 2), (2, 3)]
    assert "WindowGroupLimit [k" in plan(out) and "Partial" in plan(out)


def test_snapshot_asof(spark, rows):
    df = spark.createDataFrame(
        [("a", datetime(2024, 1, 1, 10), 1, False), ("a", datetime(2024, 1, 2), 2, False),
         ("b", datetime(2024, 1, 1, 4), 3, True), ("c", datetime(2024, 1, 3), 4, False)],
        "k string, ts timestamp, v int, gone boolean",
    )
    as_of = F.lit(datetime(2024, 1, 1, 5))
    assert rows(snapshot_asof(df, ["k"], "ts", shifted(as_of), deleted="gone").select("k", "v")) == [("a", 1)]
    assert rows(snapshot_asof(df, ["k"], "ts", as_of).select("k", "v")) == [("b", 3)]


def test_typed_mapping_and_soft_delete(spark, rows, tmp_path):
    df = spark.createDataFrame([("1", 0), ("x", 0), ("3", 1), ("4", None)], "a string, anulado int")
    out = typed_mapping(not_deleted(df), [("a", "string", "n", "int")], bad_values_to_null=True)
    assert rows(out) == [(1,), (None,)]
    df.write.parquet(f"{tmp_path}/t")
    assert read_table(spark, f"{tmp_path}/t", df.select("a").schema).columns == ["a"]


def test_filters_reach_the_scan(spark):
    from ledgerspark.plans import absence

    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select(
        F.col("o_custkey").alias("emp_id"), F.col("o_orderdate").alias("aus_fechadesde"),
        F.col("o_orderdate").alias("aus_fechacontrol"), F.col("o_custkey").alias("anulado"),
    )
    text = plan(absence.open_absences(orders, date(1998, 1, 1)))
    assert "GreaterThanOrEqual(o_orderdate" in text and "Python" not in text
