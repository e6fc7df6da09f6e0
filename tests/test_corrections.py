import random
from collections import Counter
from datetime import date
from decimal import Decimal

import pytest
from helpers import end, event_log, numbered, start
from test_stream import Crash, deliver, rows, run, wired
from test_trips import random_log

from tripfold.operators import corrections
from tripfold.operators.kpi import daily_kpis
from tripfold.operators.trips import assemble_trips, completed_trips
from tripfold.sources.kpi_store import KpiStore
from tripfold.streaming.jobs import CORRECTED, TripJob, run_batch


def expected(spark, events):
    return rows(daily_kpis(completed_trips(assemble_trips(event_log(spark, events)))))


@pytest.mark.parametrize("seed, compact_every", [(21, 50), (22, 1)])
def test_stream_equals_batch_in_any_order(spark, tmp_path, seed, compact_every):
    """Whatever comes late: starts, ends, corrections to another day or fare, older writes."""
    events = random_log(seed, trips=25, most=6)
    random.Random(seed).shuffle(events)
    job = TripJob(str(tmp_path / "job"), "p", CORRECTED, compact_every=compact_every)
    cuts = sorted(random.Random(2).sample(range(len(events)), 4))
    for n, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(events)], strict=True)):
        deliver(spark, tmp_path, n, wired(events[a:b]))
    run(spark, tmp_path, job, files=1)
    store = job.store(spark)
    assert rows(store.kpis()) == expected(spark, events) == rows(store.published())
    deliver(spark, tmp_path, 9, wired(events))  # all of it again
    run(spark, tmp_path, job)
    assert rows(store.kpis()) == expected(spark, events) == rows(store.published())


def test_a_trip_moves_to_another_day(spark, tmp_path):
    job = TripJob(str(tmp_path), "p", CORRECTED)

    def batch(*events):
        return run_batch(spark.createDataFrame(wired(events), "data string, sequence bigint"), job)

    log = numbered([start("a", "05-25 13:19"), end("a", "05-25 13:40", 12.5), start("b", "05-25 08:00"), end("b", "05-25 09:00", 3)])
    assert [tuple(r)[1:] for r in batch(*log).collect()] == [(15.5, 2, 7.75, 12.5, 3.0)]
    assert [tuple(r)[1:] for r in batch({**end("a", "05-25 13:40", 2), "sequence": 9}).collect()] == [(5.0, 2, 2.5, 3.0, 2.0)]
    moved = batch({**start("a", "05-24 13:19"), "sequence": 10}, {**start("b", "05-24 08:00"), "sequence": 11})
    assert [(str(r.pickup_date), *tuple(r)[1:]) for r in moved.collect()] == [("2024-05-24", 5.0, 2, 2.5, 3.0, 2.0)]
    published = job.store(spark).published()
    assert rows(published) == rows(moved) and published.count() == 1  # the day that has no trip any more is gone
    assert batch({**end("a", "05-25 13:40", 99), "sequence": 1}).first()["total_fare"] == 5.0  # older than what counts


@pytest.mark.parametrize("step", ["append_changes", "publish", "compact"])
def test_crash_and_restart(spark, tmp_path, monkeypatch, step):
    events = random_log(23, trips=12, most=5)
    half = len(events) // 2
    job = TripJob(str(tmp_path / "job"), "p", CORRECTED, compact_every=1)
    deliver(spark, tmp_path, 0, wired(events[half:]))
    run(spark, tmp_path, job)
    deliver(spark, tmp_path, 1, wired(events[:half]))
    original = getattr(KpiStore, step)

    def crash(*args):
        original(*args)
        raise Crash(step)

    monkeypatch.setattr(KpiStore, step, crash)
    with pytest.raises(Exception, match="Crash"):
        run(spark, tmp_path, job)
    monkeypatch.undo()
    run(spark, tmp_path, job)
    assert rows(job.store(spark).kpis()) == expected(spark, events) == rows(job.store(spark).published())


def test_signed_rows_of_many_batches(spark, tmp_path):
    """Batches that add and take back at random, merged at random times, against a count by hand."""
    rng = random.Random(8)
    store, counted = KpiStore(spark, str(tmp_path), "p"), Counter()
    schema = "pickup_date date, fare decimal(18,2), n bigint"
    for batch in range(8):
        changes = Counter()
        for _ in range(6):
            key = (date(2024, 5, rng.choice([1, 2, 3])), rng.choice([None, *(Decimal(f"{x}.50") for x in range(4))]))
            changes[key] += rng.choice([1, 1, 2])
        for key in rng.sample(sorted(counted, key=str), min(len(counted), 4)):
            changes[key] -= counted[key]
        counted = Counter({k: n for k in counted | changes for n in [counted[k] + changes[k]] if n > 0})
        store.append_changes(spark.createDataFrame([(*k, n) for k, n in changes.items() if n], schema), batch)
        if rng.random() < 0.4:
            store.compact(batch)
        fares = [k for k, n in counted.items() for _ in range(n)]
        days = {}
        for day, fare in fares:
            days.setdefault(day, []).append(fare)
        by_hand = []
        for day, found in days.items():
            known = [float(f) for f in found if f is not None]
            by_hand.append((day, sum(known) if known else None, len(found), sum(known) / len(known) if known else None, max(known, default=None), min(known, default=None)))
        got = {r.pickup_date: r for r in store.kpis().collect()}
        assert set(got) == set(days)
        for day, total, n, average, most, least in by_hand:
            r = got[day]
            assert (r.count_trips, r.average_fare, r.max_fare, r.min_fare) == (n, average, most, least) and (r.total_fare or 0) == (total or 0)


def test_one_shuffle(spark):
    trips = corrections.current_trips(event_log(spark, random_log(24)), None)
    assert trips._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
