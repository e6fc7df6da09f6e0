from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tripfold.operators.skew import FLOOR_CONF, find_hot_keys, with_chunk
from tripfold.operators.trips import trip_history


def orders_of(kind, i):
    moment = datetime(2024, 1, 1) + timedelta(minutes=i)
    return {
        "bigint": i,
        "decimal(38,0)": Decimal(10**30 + i),
        "string": f"4959033827149025660855{i:010d}",
        "timestamp_ntz": moment,
        "decimal(38,2)": Decimal(10**30 + i),
        "timestamp": moment + timedelta(microseconds=i),
        "struct<a:int,at:timestamp_ntz>": (7, datetime(2024, 1, 1) + timedelta(microseconds=i)),
        "struct<digits:int,number:string>": (10 + (i == 599), f"{i:010d}" if i < 599 else "9" * 11),
        "date": (datetime(2024, 1, 1) + timedelta(days=i)).date(),
        "struct<at:timestamp_ntz,n:int>": (moment, 1),
    }[kind]


@pytest.mark.parametrize(
    "kind",
    [
        "bigint",
        "decimal(38,0)",
        "decimal(38,2)",
        "string",
        "timestamp_ntz",
        "timestamp",
        "date",
        "struct<at:timestamp_ntz,n:int>",
        "struct<a:int,at:timestamp_ntz>",
        "struct<digits:int,number:string>",
    ],
)
def test_chunks_follow_the_order(spark, hot_floor, kind):
    data = [("hot", orders_of(kind, i)) for i in range(600)] + [
        (f"k{i % 100}", orders_of(kind, i)) for i in range(300)
    ]
    df = spark.createDataFrame(data, f"k string, s {kind}")
    hot = find_hot_keys(df, "k", "s")
    assert list(hot.bounds) == ["hot"]
    chunked = with_chunk(df, "k", "s", hot)
    assert chunked.where("k <> 'hot' and (chunk <> 0 or is_hot)").count() == 0
    parts = (
        chunked.where("k = 'hot'").groupBy("chunk").agg(F.min("s"), F.max("s"), F.count("*").alias("n"))
    ).orderBy("chunk").collect()
    assert len(parts) >= 3 and sum(r["n"] for r in parts) == 600
    assert max(r["n"] for r in parts) < 400
    for left, right in zip(parts, parts[1:], strict=False):
        assert left[2] < right[1]


def test_nothing_hot(spark, hot_floor):
    df = spark.range(1000).selectExpr("cast(id as string) as k", "id as s")
    hot = find_hot_keys(df, "k", "s")
    assert not hot
    assert with_chunk(df, "k", "s", hot).where("chunk <> 0").count() == 0


def test_empty(spark, hot_floor):
    df = spark.createDataFrame([], "k string, s bigint")
    assert not find_hot_keys(df, "k", "s")


def test_one_order_is_one_chunk(spark, hot_floor):
    df = spark.range(1000).selectExpr("'hot' as k", "7L as s")
    hot = find_hot_keys(df, "k", "s")
    assert with_chunk(df, "k", "s", hot).select("chunk").distinct().count() == 1


@pytest.mark.parametrize("floor", ["1", "1000000"])
def test_exact_repeats_give_one_row_whether_split_or_not(spark, floor):
    from helpers import end, event_log, numbered, start

    events = numbered([start("a", "05-25 13:19"), end("a", "05-25 13:40", 2), start("a", "05-25 13:19")])
    spark.conf.set(FLOOR_CONF, floor)
    try:
        history = trip_history(event_log(spark, events * 300))
        assert sorted(r.sequence for r in history.collect()) == [0, 1, 2]
    finally:
        spark.conf.unset(FLOOR_CONF)


def test_only_rows_of_hot_trips_are_made_distinct(spark, hot_floor):
    """Exact repeats of cold and of hot trips give one row each; the rows of cold trips are shuffled once."""
    rows = [(t, "end", n, Decimal(n)) for t, most in (("hot", 400), ("a", 2), (None, 2)) for n in range(most) for _ in range(2)]
    events = spark.createDataFrame(rows, "trip_id string, kind string, sequence bigint, fare_amount decimal(18,2)")
    history = trip_history(events, [], ["fare_amount"])
    assert {r["trip_id"]: r["n"] for r in history.groupBy("trip_id").agg(F.count("*").alias("n")).collect()} == {"hot": 400, "a": 2, None: 2}
    plan = history._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan
