import random

import pytest
from helpers import brute_force, end, event_log, numbered, start

from tripfold.operators.kpi import daily_kpis
from tripfold.operators.trips import (
    assemble_trips,
    change_feed,
    completed_trips,
    first_completion,
    modified,
    open_trips,
    trip_history,
)
from tripfold.schemas import END_FIELDS, START_FIELDS

DAY = "2024-05-25"
S, E = start("a", "05-25 13:19", 10), end("a", "05-25 13:40", 12.5)


def kpis(trips):
    rows = daily_kpis(trips).collect()
    return [(str(r[0]), *r[1:]) for r in rows]


def documented(spark, events):
    return first_completion(trip_history(event_log(spark, numbered(events))))


@pytest.mark.parametrize(
    "events, expected",
    [
        ([S, E], [(DAY, 12.5, 1, 12.5, 12.5, 12.5)]),
        ([E, S], [(DAY, 12.5, 1, 12.5, 12.5, 12.5)]),
        ([S], []),
        ([E], []),
        ([S, E, end("a", "05-25 14:00", 20)], [(DAY, 12.5, 1, 12.5, 12.5, 12.5)]),
        ([S, E, E], [(DAY, 12.5, 1, 12.5, 12.5, 12.5)]),
        ([], []),
        ([S, end("a", "05-25 13:40", None)], [(DAY, None, 1, None, None, None)]),
    ],
    ids=["pair", "end first", "start only", "end only", "correction", "duplicate", "empty", "no fare"],
)
def test_documented_kpis(spark, events, expected):
    assert kpis(documented(spark, events)) == expected


def test_changed_start_before_the_end(spark):
    row = documented(spark, [S, start("a", "05-25 13:21", 10), E]).first()
    assert str(row["pickup_datetime"]) == "2024-05-25 13:21:00"


def test_group_overwrite_replaces_nulls_too(spark):
    events = [start("a", "05-25 13:19", 10, "1"), start("a", "05-25 13:20"), E]
    row = documented(spark, events).first()
    assert row["vendor_id"] is None and row["estimated_fare_amount"] is None
    final = assemble_trips(event_log(spark, numbered(events))).first()
    assert final["vendor_id"] is None and final["has_start"] and final["has_end"]


def test_change_feed_mode_counts_every_change(spark):
    log = event_log(spark, numbered([S, E, end("a", "05-25 14:00", 20)]))
    assert kpis(modified(change_feed(trip_history(log)))) == [(DAY, 32.5, 2, 16.25, 20.0, 12.5)]


def test_unchanged_write_leaves_no_change(spark):
    feed = change_feed(trip_history(event_log(spark, numbered([S, E, E, S])))).orderBy("sequence")
    assert [r["event_name"] for r in feed.collect()] == ["INSERT", "MODIFY"]


def test_current_state_takes_the_last_end(spark):
    log = event_log(spark, numbered([S, E, end("a", "05-25 14:00", 20)]))
    assert kpis(completed_trips(assemble_trips(log))) == [(DAY, 20.0, 1, 20.0, 20.0, 20.0)]
    assert open_trips(assemble_trips(log)).count() == 0


def random_log(seed, trips=60, most=9, hot=0):
    """Random starts and ends; payloads repeat often, so many writes change nothing."""
    rng = random.Random(seed)

    def event(trip):
        if rng.random() < 0.5:
            return start(trip, f"05-2{rng.randint(1, 3)} 10:00", rng.randint(1, 2))
        return end(trip, "05-25 11:00", rng.choice([None, 1, 2.5, 7]))

    events = [event(f"t{t}") for t in range(trips) for _ in range(rng.randint(1, most))]
    events += [event("hot") for _ in range(hot)]
    rng.shuffle(events)
    return numbered(events)


def check_against_brute_force(spark, events, log=None):
    log = event_log(spark, events) if log is None else log
    first, changes, state = brute_force(events)
    history = trip_history(log)
    assert sorted(map(tuple, first_completion(history).collect()), key=str) == sorted(first, key=str)
    feed = change_feed(history).select("trip_id", "sequence", "event_name")
    assert sorted(map(tuple, feed.collect())) == sorted(changes)
    none = {"start": (None,) * len(START_FIELDS), "end": (None,) * len(END_FIELDS)}
    final = {
        (t, *s.get("start", none["start"]), *s.get("end", none["end"]), "start" in s, "end" in s)
        for t, s in state.items()
    }
    assert {tuple(r) for r in assemble_trips(log).collect()} == final


@pytest.mark.parametrize("seed", [1, 2])
def test_random_logs(spark, seed):
    check_against_brute_force(spark, random_log(seed))


def test_row_order_does_not_matter(spark):
    events = random_log(3, trips=20)
    shuffled = events[:]
    random.Random(0).shuffle(shuffled)
    check_against_brute_force(spark, events, event_log(spark, shuffled).repartition(5))


def test_hot_trip_is_split_and_equal(spark, hot_floor):
    from tripfold.operators.skew import find_hot_keys

    events = random_log(4, trips=80, most=5, hot=600)
    log = event_log(spark, events)
    hot = find_hot_keys(log, "trip_id", "sequence")
    assert list(hot.bounds) == ["hot"] and len(hot.bounds["hot"]) >= 2
    check_against_brute_force(spark, events, log)


def test_narrow_fields_give_the_same_kpis(spark):
    log = event_log(spark, random_log(5))
    narrow = (["pickup_datetime"], ["fare_amount"])
    full = kpis(completed_trips(assemble_trips(log)))
    assert sorted(kpis(completed_trips(assemble_trips(log, *narrow)))) == sorted(full)
    text = log.withColumn("sequence", log.sequence.cast("string"))
    padded = text.selectExpr("*", "lpad(sequence, 9, '0') as s").drop("sequence").withColumnRenamed("s", "sequence")
    assert sorted(kpis(completed_trips(assemble_trips(padded, *narrow)))) == sorted(full)
    some = kpis(first_completion(trip_history(log, *narrow), *narrow))
    assert sorted(some) == sorted(kpis(first_completion(trip_history(log))))


def test_carried_state_continues_the_history(spark):
    """A log cut in two, with the state in between carried over, gives the same history."""
    events = random_log(6)
    cut = len(events) // 2
    early, late = event_log(spark, events[:cut]), event_log(spark, events[cut:])
    from pyspark.sql import functions as F

    from tripfold.operators.trips import event_writes

    carry = event_writes(early).groupBy("trip_id").agg(
        F.max("start_write").alias("start_write"), F.max("end_write").alias("end_write")
    )
    parts = [trip_history(early), trip_history(late, carry=carry)]
    got = [tuple(r) for h in parts for r in first_completion(h).collect()]
    assert sorted(got, key=str) == sorted(brute_force(events)[0], key=str)
    feed = [tuple(r)[:3] for h in parts for r in change_feed(h).collect()]
    assert sorted(feed) == sorted(brute_force(events)[1])
