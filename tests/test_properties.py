"""KPIs do not depend on how trips were batched, ordered or delivered."""

from datetime import date
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tripfold.operators.kpi import finalize, merge_partials, partials
from tripfold.sources.kpi_store import KpiStore

FARE = st.one_of(st.none(), st.decimals("-9999.99", "9999.99", places=2))
TRIP = st.tuples(st.integers(1, 3), FARE, st.integers(0, 3))  # day, fare, batch
SLOW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def table(trips):
    """Expected KPIs per day."""
    days = {}
    for day, fare, _ in trips:
        days.setdefault(day, []).append(fare)
    result = []
    for day, fares in days.items():
        known = [f for f in fares if f is not None]
        total = sum(known, Decimal(0)) if known else None
        row = [date(2024, 5, day), None, len(fares), None, None, None]
        if known:
            row[1:] = [float(total), len(fares), float(total) / len(known), float(max(known)), float(min(known))]
        result.append(tuple(row))
    return sorted(result)


def frame(spark, trips):
    return spark.createDataFrame(
        [(date(2024, 5, d), f) for d, f, _ in trips], "pickup_date date, fare decimal(18,2)"
    )


@SLOW
@given(trips=st.lists(TRIP, min_size=1, max_size=20))
def test_any_split_merges_to_the_same_table(spark, trips):
    parts = [partials(frame(spark, [t for t in trips if t[2] == b])) for b in range(4)]
    assert sorted(map(tuple, finalize(merge_partials(*parts)).collect())) == table(trips)


@SLOW
@given(trips=st.lists(TRIP, min_size=1, max_size=12), replayed=st.integers(0, 3), upto=st.integers(0, 3))
def test_store_survives_replay_and_compaction(spark, tmp_path_factory, trips, replayed, upto):
    store = KpiStore(spark, str(tmp_path_factory.mktemp("store")), "p")
    for batch in [0, 1, 2, 3, replayed]:
        store.append(partials(frame(spark, [t for t in trips if t[2] == batch])), batch)
    store.compact(upto)
    assert sorted(map(tuple, store.kpis().collect())) == table(trips)
