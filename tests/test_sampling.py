from helpers import end, event_log, numbered, start

from tripfold.operators.sampling import interleaved, matched_sample, shuffled


def log(spark, trips=30):
    events = []
    for t in range(trips):
        events += [start(f"t{t}", "05-25 13:19"), end(f"t{t}", "05-25 13:40", t)]
    return event_log(spark, numbered(events + [start("only", "05-25 13:19"), end("late", "05-25 13:40", 1)]))


def test_sample_keeps_both_sides(spark):
    sample = matched_sample(log(spark), 10, seed=1)
    kinds = {}
    for r in sample.collect():
        kinds.setdefault(r["trip_id"], set()).add(r["kind"])
    assert len(kinds) == 10 and all(k == {"start", "end"} for k in kinds.values())
    assert sorted(sample.collect()) == sorted(matched_sample(log(spark), 10, seed=1).collect())
    other = {r["trip_id"] for r in matched_sample(log(spark), 10, seed=2).collect()}
    assert other != set(kinds)


def test_sample_larger_than_the_data(spark):
    assert matched_sample(log(spark), 1000).select("trip_id").distinct().count() == 30


def test_shuffle_changes_only_the_order(spark):
    events = log(spark).selectExpr("*", "cast(sequence as string) as id")
    mixed = shuffled(events, tie="id", seed=5)
    assert sorted(mixed.drop("sequence").collect(), key=str) == sorted(events.drop("sequence").collect(), key=str)
    assert mixed.select("sequence").distinct().count() == events.count()
    order = [r["id"] for r in mixed.orderBy("sequence").collect()]
    assert order != sorted(order, key=int)
    assert order == [r["id"] for r in shuffled(events, tie="id", seed=5).orderBy("sequence").collect()]


def test_interleaved_numbers_have_no_gaps(spark):
    events = log(spark).selectExpr("*", "cast(sequence as string) as id")
    found = interleaved(events, tie="id", seed=5).collect()
    order = [r["id"] for r in shuffled(events, tie="id", seed=5).orderBy("sequence").collect()]
    assert [r["sequence"] for r in sorted(found, key=lambda r: r["sequence"])] == list(range(1, len(order) + 1))
    assert [r["id"] for r in sorted(found, key=lambda r: r["sequence"])] == order
    again = events.union(events)  # rows that cannot be told apart
    assert sorted(r["sequence"] for r in interleaved(again, tie="id").collect()) == list(range(1, 2 * len(order) + 1))
    assert interleaved(events.limit(0), tie="id").count() == 0
