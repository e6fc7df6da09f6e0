import random

import pytest
from helpers import brute_force, end, envelope, event_log, numbered, start, wire
from test_trips import random_log

from tripfold.operators.kpi import daily_kpis
from tripfold.operators.staging import parse_bodies, to_bodies
from tripfold.operators.trips import (
    assemble_trips,
    change_feed,
    completed_trips,
    first_completion,
    modified,
    trip_history,
)
from tripfold.sources.kpi_store import KpiStore
from tripfold.sources.readers import read_bodies, read_envelopes
from tripfold.streaming import jobs, states
from tripfold.streaming.jobs import (
    CHANGE_FEED,
    DOCUMENTED,
    TripJob,
    run_batch,
    start_message_stream,
    start_stream,
)


def rows(df):
    return sorted((tuple(map(str, r)) for r in df.collect()), key=str)


def deliver(spark, root, n, datas):
    """Lands one file of envelopes; `datas` are (data, sequence) pairs."""
    (root / "log").mkdir(exist_ok=True)
    frame = spark.createDataFrame(
        [(d, None, s) for d, s in datas], "data string, partition_key string, sequence bigint"
    )
    target = root / "log" / f"{n:04d}.json"
    target.write_text("\n".join(frame.toJSON().collect()))


def wired(events):
    return [(wire(e), e["sequence"]) for e in events]


def run(spark, root, job, files=None):
    reader = spark.readStream
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    query = start_stream(read_envelopes(reader, str(root / "log")), job)
    query.awaitTermination()
    return query


def expected_kpis(spark, events, mode):
    history = trip_history(event_log(spark, events))
    return rows(daily_kpis(first_completion(history) if mode == DOCUMENTED else modified(change_feed(history))))


@pytest.mark.parametrize("mode", [DOCUMENTED, CHANGE_FEED])
def test_stream_equals_batch_for_any_split(spark, tmp_path, mode):
    events = random_log(11, trips=25, most=6)
    cuts = sorted(random.Random(1).sample(range(len(events)), 3))
    job = TripJob(str(tmp_path / "job"), "p", mode, compact_every=2)
    for n, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(events)], strict=True)):
        part = events[a:b]
        random.Random(n).shuffle(part)  # any order within a delivery
        deliver(spark, tmp_path, n, wired(part))
        run(spark, tmp_path, job)  # every run resumes from the checkpoint
    store = job.store(spark)
    assert rows(store.kpis()) == expected_kpis(spark, events, mode)
    assert rows(store.published()) == rows(store.kpis())
    if mode == DOCUMENTED:
        got = [tuple(r) for r in job.completed(spark).collect()]
        assert sorted(got, key=str) == sorted(brute_force(events)[0], key=str)


def test_redelivered_events_count_once(spark, tmp_path):
    events = numbered([start("a", "05-25 13:19"), end("a", "05-25 13:40", 12.5), start("b", "05-25 13:19")])
    job = TripJob(str(tmp_path / "job"), "p")
    deliver(spark, tmp_path, 0, wired(events))
    run(spark, tmp_path, job)
    deliver(spark, tmp_path, 1, wired(events + [{**end("a", "05-25 14:00", 20), "sequence": 9}]))
    run(spark, tmp_path, job)
    assert job.store(spark).kpis().first()["count_trips"] == 1
    assert job.completed(spark).count() == 1


def test_older_write_in_a_later_batch_does_not_win(spark, tmp_path):
    newer = {**start("a", "05-25 13:21"), "sequence": 5}
    older = {**start("a", "05-24 10:00"), "sequence": 1}
    job = TripJob(str(tmp_path / "job"), "p")
    for n, event in enumerate([newer, older, {**end("a", "05-25 13:40", 3), "sequence": 6}]):
        deliver(spark, tmp_path, n, wired([event]))
        run(spark, tmp_path, job)
    assert [str(r["pickup_datetime"]) for r in job.completed(spark).collect()] == ["2024-05-25 13:21:00"]


class Crash(Exception):
    pass


@pytest.mark.parametrize("step", ["landed", "counters", "rejected", "state_in", "state", "carry", "completed", "append", "publish", "compact", "_retire"])
def test_crash_and_restart(spark, tmp_path, monkeypatch, step):
    """Stops the second batch right after each of its writes; the restart counts nothing twice."""
    events = random_log(12, trips=12, most=5)
    half = len(events) // 2
    job = TripJob(str(tmp_path / "job"), "p", compact_every=1)
    deliver(spark, tmp_path, 0, wired(events[:half]))
    run(spark, tmp_path, job)
    deliver(spark, tmp_path, 1, wired(events[half:]))

    def crash_after(owner, name, matches=lambda *a: True):
        original = getattr(owner, name)

        def wrapped(*args, **kwargs):
            result = original(*args, **kwargs)
            if matches(*args):
                raise Crash(step)
            return result

        monkeypatch.setattr(owner, name, wrapped)

    if step in ("append", "publish", "compact", "_retire"):
        crash_after(KpiStore, step)
    elif step == "state":  # inside the state query, before it commits
        crash_after(states, "save_wanted")
    elif step == "state_in":
        crash_after(states, "rename")
    elif step == "carry":
        crash_after(TripJob, "_carry")
    else:
        crash_after(jobs, "write_once", lambda _, path: f"/{step}/" in path)
    with pytest.raises(Exception, match="Crash"):
        run(spark, tmp_path, job)
    monkeypatch.undo()

    run(spark, tmp_path, job)
    assert rows(job.store(spark).kpis()) == expected_kpis(spark, events, DOCUMENTED)
    deliver(spark, tmp_path, 2, wired(events))  # and again as a whole
    run(spark, tmp_path, job)
    assert rows(job.store(spark).kpis()) == expected_kpis(spark, events, DOCUMENTED)


def test_bad_records_and_empty_batches(spark, tmp_path):
    job = TripJob(str(tmp_path / "job"), "p")
    good = numbered([start("a", "05-25 13:19"), end("a", "05-25 13:40", 12.5)])
    deliver(spark, tmp_path, 0, [("%%%", 7), (envelope("{}"), 8)])
    progress = run(spark, tmp_path, job).lastProgress
    assert progress.observedMetrics["batch"].asDict() == {
        "records": 2, "success": 0, "failed": 2, "skipped": 0, "warnings": 0,
    }
    assert job.store(spark).kpis().count() == 0
    deliver(spark, tmp_path, 1, wired(good))
    bad_fare = {"trip_id": "b", "dropoff_datetime": "2024-05-25 13:40:00", "fare_amount": "abc"}
    deliver(spark, tmp_path, 2, wired([{**start("b", "05-25 10:00"), "sequence": 3}]) + [(envelope(bad_fare), 4)])
    run(spark, tmp_path, job)
    run(spark, tmp_path, job)  # nothing new
    row = job.store(spark).kpis().first()
    assert (row["count_trips"], row["total_fare"], row["average_fare"]) == (2, 12.5, 12.5)
    reasons = sorted(r["reason"] for r in job.quarantine(spark).collect())
    assert reasons == ["bad_base64", "bad_fare", "missing_trip_id"]


def test_two_files_per_batch(spark, tmp_path):
    events = random_log(13, trips=10, most=4)
    job = TripJob(str(tmp_path / "job"), "p")
    quarter = len(events) // 4 + 1
    for n in range(4):
        deliver(spark, tmp_path, n, wired(events[n * quarter : (n + 1) * quarter]))
    run(spark, tmp_path, job, files=1)
    assert rows(job.store(spark).kpis()) == expected_kpis(spark, events, DOCUMENTED)


def test_running_stream(spark, tmp_path):
    events = random_log(17, trips=6, most=3)
    job = TripJob(str(tmp_path / "job"), "p")
    deliver(spark, tmp_path, 0, wired(events))
    source = read_envelopes(spark.readStream, str(tmp_path / "log"))
    query = start_stream(source, job, processingTime="1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert rows(job.store(spark).kpis()) == expected_kpis(spark, events, DOCUMENTED)


def test_run_batch(spark, tmp_path):
    events = random_log(14, trips=10)
    frame = spark.createDataFrame(wired(events), "data string, sequence bigint")
    kpis = run_batch(frame, TripJob(str(tmp_path), "p"))
    assert rows(kpis) == expected_kpis(spark, events, DOCUMENTED)


def test_every_batch_counts(spark, tmp_path):
    """Two batches, a stream that starts over, and another pipeline, all on one root."""
    def frame(trip, n):
        events = numbered([start(trip, "05-25 13:19"), end(trip, "05-25 13:40", n)])
        return spark.createDataFrame(wired(events), "data string, sequence bigint")

    job = TripJob(str(tmp_path / "job"), "p")
    assert run_batch(frame("a", 1), job).first()["total_fare"] == 1
    assert run_batch(frame("b", 2), job).first()["total_fare"] == 3
    deliver(spark, tmp_path, 0, wired(numbered([start("c", "05-25 13:19"), end("c", "05-25 13:40", 4)])))
    run(spark, tmp_path, job)
    assert job.store(spark).kpis().first()["total_fare"] == 7
    jobs.remove_checkpoint(spark, job, "ingest")  # reads the log again: events that are known count once
    deliver(spark, tmp_path, 1, wired(numbered([start("d", "05-25 13:19"), end("d", "05-25 13:40", 8)])))
    run(spark, tmp_path, job)
    other = TripJob(str(tmp_path / "job"), "q")
    assert run_batch(frame("a", 16), other).first()["total_fare"] == 31
    assert run_batch(frame("e", 32), job).first()["total_fare"] == 63


def test_an_unfinished_batch_is_not_passed_over(spark, tmp_path, monkeypatch):
    events = numbered([start("a", "05-25 13:19"), end("a", "05-25 13:40", 1)])
    frame = spark.createDataFrame(wired(events), "data string, sequence bigint")
    job = TripJob(str(tmp_path / "job"), "p")
    monkeypatch.setattr(KpiStore, "append", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run_batch(frame, job, run_id="first")
    monkeypatch.undo()
    with pytest.raises(ValueError, match="first"):
        run_batch(frame, job)
    assert run_batch(frame, job, run_id="first").first()["count_trips"] == 1
    assert run_batch(frame, job, run_id="first").first()["count_trips"] == 1


def test_store_keeps_no_stale_day_and_no_base_twice(spark, tmp_path):
    from tripfold.operators.kpi import dated, partials

    def fares(*days):
        rows = [(f"2024-05-{d} 10:00:00", "1.00") for d in days]
        return partials(dated(spark.createDataFrame(rows, "p string, f string").selectExpr("cast(p as timestamp_ntz) as pickup_datetime", "cast(f as decimal(18,2)) as fare_amount")))

    for adaptive in ("true", "false"):
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        store = KpiStore(spark, str(tmp_path / adaptive), "p")
        store.append(fares(24, 25), 0)
        store.publish()
        store.append(fares(24, 26), 0)
        store.publish([0])
        assert rows(store.published()) == rows(store.kpis()) and store.published().count() == 2
        store.compact(0)
        store.compact(0)
        assert store.kpis().count() == 2
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_hot_trip_in_a_stream(spark, tmp_path, hot_floor):
    events = random_log(15, trips=20, most=3, hot=400)
    half = len(events) // 2
    job = TripJob(str(tmp_path / "job"), "p", CHANGE_FEED)
    for n, part in enumerate([events[:half], events[half:]]):
        deliver(spark, tmp_path, n, wired(part))
        run(spark, tmp_path, job)
    assert rows(job.store(spark).kpis()) == expected_kpis(spark, events, CHANGE_FEED)


def test_change_feed_mode_quarantines_dateless_trips(spark, tmp_path):
    events = numbered([end("a", "05-25 13:40", 1), end("a", "05-25 13:41", 2), start("a", "05-25 13:19")])
    frame = spark.createDataFrame(wired(events), "data string, sequence bigint")
    job = TripJob(str(tmp_path), "p", CHANGE_FEED)
    assert run_batch(frame, job).first()["count_trips"] == 1
    assert [(r["stage"], r["reason"]) for r in job.quarantine(spark).collect()] == [("kpi", "bad_pickup_datetime")]


def test_message_stream(spark, tmp_path):
    events = random_log(16, trips=15)
    trips = completed_trips(assemble_trips(event_log(spark, events)))
    bodies = [r["body"] for r in to_bodies(trips).collect()]
    source = tmp_path / "messages"
    source.mkdir()
    root = str(tmp_path / "job")

    def fold():
        stream = parse_bodies(read_bodies(spark.readStream, str(source)))
        start_message_stream(stream, root, "p").awaitTermination()

    (source / "0.txt").write_text("\n".join([*bodies[:5], "{bad", '{"trip_id": "x"}']))
    fold()
    (source / "1.txt").write_text("\n".join(bodies[5:]))
    fold()
    assert rows(KpiStore(spark, f"{root}/kpi", "p").kpis()) == rows(daily_kpis(trips))
    staged = spark.read.parquet(f"{root}/messages/pipeline_id=p/batch=0").where("reason is not null")
    assert sorted(r["reason"] for r in staged.collect()) == ["bad_json", "bad_pickup_datetime"]


def test_change_record_stream(spark, tmp_path):
    """Change records to messages to KPIs, as a stream."""
    from pyspark.sql import functions as F

    from tripfold.operators.staging import messages_to_staging, unwrap_changes, wrap_trips
    from tripfold.sources.readers import read_change_batches

    feed = change_feed(trip_history(event_log(spark, random_log(18, trips=10))))
    record = F.struct(
        F.col("event_name").alias("eventName"),
        F.struct(F.from_json("image", "map<string,map<string,string>>").alias("NewImage")).alias("dynamodb"),
    )
    wrap_trips(feed.drop("sequence")).select(F.array(record).alias("Records")).write.json(str(tmp_path / "changes"))
    records = read_change_batches(spark.readStream, str(tmp_path / "changes"))
    staged = messages_to_staging(unwrap_changes(records))
    start_message_stream(staged, str(tmp_path / "job"), "p").awaitTermination()
    assert rows(KpiStore(spark, str(tmp_path / "job/kpi"), "p").kpis()) == rows(daily_kpis(modified(feed)))


def test_unknown_mode():
    with pytest.raises(ValueError):
        TripJob("x", "p", "other")
