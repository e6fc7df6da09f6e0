import random

import pytest
from helpers import event_log, numbered, start
from pyspark.sql import DataFrameWriter
from test_trips import random_log

from tripfold.operators.trips import assemble_trips
from tripfold.sources import trip_table
from tripfold.sources.trip_table import TripTable


def rows(df):
    return sorted((tuple(map(str, r)) for r in df.collect()), key=str)


@pytest.fixture
def table(spark, tmp_path):
    name = f"t_{tmp_path.name}"
    yield TripTable(spark, str(tmp_path), name, slots=5, buckets=4)
    spark.sql(f"drop table if exists {name}")


def test_any_split_and_order(spark, table, tmp_path):
    events = random_log(31, trips=25, most=6)
    random.Random(3).shuffle(events)
    for n in range(4):
        table.update(event_log(spark, events[n::4]))
    table.update(event_log(spark, events[:7]))  # again
    table.update(event_log(spark, []))
    assert rows(table.trips()) == rows(assemble_trips(event_log(spark, events)))
    spark.sql(f"drop table {table.name}")  # another session finds the files
    table.update(event_log(spark, events[:3]))
    assert rows(table.trips()) == rows(assemble_trips(event_log(spark, events)))


def test_only_touched_slots_are_rewritten(spark, table, tmp_path):
    events = random_log(32, trips=40)
    table.update(event_log(spark, events))
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "trips").rglob("*.parquet")}
    one = [e for e in events if e["trip_id"] == events[0]["trip_id"]]
    table.update(event_log(spark, one))
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "trips").rglob("*.parquet")}
    changed = {p.parent.name for p in set(before) ^ set(after)}
    assert len({p.parent.name for p in before}) == 5 and len(changed) == 1
    assert not (tmp_path / "pending").exists() and not any((tmp_path / "staged").iterdir())


def test_old_rows_are_not_shuffled(spark, table):
    events = random_log(33, trips=40)
    table.update(event_log(spark, events))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = table.updated(event_log(spark, events))._jdf.queryExecution().executedPlan().toString()
        scan = table.trips()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    old, new = plan.split("Scan parquet")[0], plan
    assert plan.count("Exchange hashpartitioning") == 1 and "Exchange" not in scan  # the events'
    branch = plan[: plan.index("Scan parquet")].rsplit("SortMergeJoin", 1)[1]
    assert "Exchange" not in branch and "Bucketed: true" in plan, (old, new)


@pytest.mark.parametrize("step", ["create_file", "_insert", "remove"])
def test_an_update_that_was_cut_off(spark, table, monkeypatch, step):
    events = random_log(34, trips=20)
    table.update(event_log(spark, events[:20]))
    owner = TripTable if step == "_insert" else trip_table
    original = getattr(owner, step)

    def cut(*args, **kwargs):
        if step == "create_file":
            original(*args, **kwargs)
        raise InterruptedError

    monkeypatch.setattr(owner, step, cut)
    with pytest.raises(InterruptedError):
        table.update(event_log(spark, events[20:]))
    monkeypatch.undo()
    table.update(event_log(spark, events[20:30]))
    assert rows(table.trips()) == rows(assemble_trips(event_log(spark, events)))


def test_new_slots_are_written_once(spark, table, tmp_path, monkeypatch):
    events = random_log(35, trips=40)
    table.update(event_log(spark, events[:30]))
    staged, original = {}, trip_table.create_file

    def files(folder):
        return {(p.parent.name, p.name): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}

    def seen(session, path, text, *args):
        staged.update(files(tmp_path / "staged"))
        return original(session, path, text, *args)

    monkeypatch.setattr(trip_table, "create_file", seen)
    table.update(event_log(spark, events))
    assert files(tmp_path / "trips") == staged and {slot for slot, _ in staged} == {f"slot={n}" for n in range(5)}
    assert rows(table.trips()) == rows(assemble_trips(event_log(spark, events)))


def test_old_rows_stay_in_their_buckets_with_more_shuffle_partitions(spark, table, monkeypatch):
    events, plans, original = random_log(36, trips=40), [], DataFrameWriter.insertInto

    def insert(self, *args, **kwargs):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return original(self, *args, **kwargs)

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        table.update(event_log(spark, events[:30]))
        monkeypatch.setattr(DataFrameWriter, "insertInto", insert)
        table.update(event_log(spark, events))
        assert spark.conf.get("spark.sql.shuffle.partitions") == "16"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(plans) == 1 and "SortMergeJoin" in plans[0] and plans[0].count("Exchange hashpartitioning") == 1
    assert rows(table.trips()) == rows(assemble_trips(event_log(spark, events)))


def test_a_slot_that_only_the_last_event_names(spark, table):
    many = numbered([start("a", "05-25 13:19", est=n) for n in range(700)] + [start(t, "05-25 13:19") for t in "bcdefghijklmn"])
    log = event_log(spark, many[:701]).coalesce(1)
    wanted = {r.slot for r in log.select(table._slot()).distinct().collect()}
    assert set(table._touched(log)) == wanted
    assert len(table._touched(event_log(spark, many))) == 5
    for part in (many[:701], many):
        table.update(event_log(spark, part))
    assert rows(table.trips()) == rows(assemble_trips(event_log(spark, many)))
