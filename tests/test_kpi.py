from datetime import date
from decimal import Decimal

import pytest

from tripfold.operators.kpi import finalize, merge_partials, partials
from tripfold.schemas import KPI_SCHEMA, PARTIAL_SCHEMA
from tripfold.sources.kpi_store import KpiStore

DAY = date(2024, 5, 25)


def fares(spark, values, day=DAY):
    rows = [(day, None if v is None else Decimal(str(v))) for v in values]
    return spark.createDataFrame(rows, "pickup_date date, fare decimal(18,2)")


def rows(df):
    return sorted(tuple(r)[1:] for r in df.collect())


def merged(spark, batches):
    return rows(finalize(merge_partials(*[partials(fares(spark, b)) for b in batches])))


@pytest.mark.parametrize(
    "batches, expected",
    [
        ([[10, 20], [30]], (60.0, 3, 20.0, 30.0, 10.0)),
        ([[10], [20, 30]], (60.0, 3, 20.0, 30.0, 10.0)),
        ([[10, None], [20]], (30.0, 3, 15.0, 20.0, 10.0)),
        ([[None], [20]], (20.0, 2, 20.0, 20.0, 20.0)),
        ([[None], [None]], (None, 2, None, None, None)),
        ([[-5, 0, 5]], (0.0, 3, 0.0, 5.0, -5.0)),
        ([["0.1"] * 10], (1.0, 10, 0.1, 0.1, 0.1)),
    ],
)
def test_merge(spark, batches, expected):
    assert merged(spark, batches) == [expected]


def test_schemas(spark):
    part = partials(fares(spark, [1]))
    assert [f.dataType for f in part.schema] == [f.dataType for f in PARTIAL_SCHEMA]
    assert [f.dataType for f in finalize(part).schema] == [f.dataType for f in KPI_SCHEMA]
    assert finalize(part).columns == KPI_SCHEMA.names


def test_dateless_trips_never_reach_the_table(spark):
    assert partials(fares(spark, [1, 2], day=None)).count() == 0


def test_new_day_is_a_new_row(spark):
    parts = partials(fares(spark, [10])), partials(fares(spark, [5], date(2024, 5, 26)))
    assert merge_partials(*parts).count() == 2


def test_store_replay_counts_once(spark, tmp_path):
    store = KpiStore(spark, str(tmp_path), "p")
    assert store.kpis().count() == 0
    for _ in range(2):
        store.append(partials(fares(spark, [10])), 0)
    assert rows(store.kpis()) == [(10.0, 1, 10.0, 10.0, 10.0)]
    store.append(partials(fares(spark, [])), 0)  # a replay that finds nothing leaves nothing
    assert store.kpis().count() == 0


def test_store_keeps_pipelines_apart(spark, tmp_path):
    for name in ("p", "q"):
        KpiStore(spark, str(tmp_path), name).append(partials(fares(spark, [10])), 0)
    assert rows(KpiStore(spark, str(tmp_path), "p").kpis()) == [(20.0, 2, 10.0, 10.0, 10.0)]


def test_store_ignores_unfinished_folders(spark, tmp_path):
    store = KpiStore(spark, str(tmp_path), "p")
    store.append(partials(fares(spark, [10])), 0)
    store.append(partials(fares(spark, [20])), 1)
    (tmp_path / "partials/pipeline_id=p/batch_id=1/_SUCCESS").unlink()
    assert rows(store.kpis()) == [(10.0, 1, 10.0, 10.0, 10.0)]


def test_compaction_changes_nothing(spark, tmp_path):
    store = KpiStore(spark, str(tmp_path), "p")
    for n in range(12):
        store.append(partials(fares(spark, [n, None])), n)
    before = rows(store.kpis())
    store.compact(4)
    assert rows(store.kpis()) == before
    store.compact(10)
    assert rows(store.kpis()) == before
    assert len(store._live_paths("partials", "base", "p")) == 2
    (tmp_path / "base/pipeline_id=p/v=10/_SUCCESS").unlink()  # falls back to the older base
    assert rows(store.kpis()) == before


def test_publish_rewrites_touched_days_only(spark, tmp_path):
    store = KpiStore(spark, str(tmp_path), "p")
    store.append(partials(fares(spark, [10])), 0)
    store.publish([0])
    untouched = sorted((tmp_path / "published/pickup_date=2024-05-25").glob("*.parquet"))
    store.append(partials(fares(spark, [5], date(2024, 5, 26))), 1)
    store.publish([1])
    assert sorted((tmp_path / "published/pickup_date=2024-05-25").glob("*.parquet")) == untouched
    assert rows(store.published()) == rows(store.kpis()) and store.published().count() == 2
    store.append(partials(fares(spark, [30])), 2)
    store.publish([2])
    store.publish()
    assert rows(store.published()) == [(5.0, 1, 5.0, 5.0, 5.0), (40.0, 2, 20.0, 30.0, 10.0)]
