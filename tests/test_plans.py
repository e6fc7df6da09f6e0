"""Physical plans: what is read, how often rows move, and what runs where."""

import re
from pathlib import Path

import pytest

from tripfold.operators.envelope import decode_envelopes, encode_envelopes
from tripfold.operators.events import good_events, route_events
from tripfold.operators.trips import assemble_trips, completed_trips
from tripfold.plans.catalog import QUERIES
from tripfold.plans.tables import order_events, user_events

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no generated tables here")

LAZY = sorted(set(QUERIES) - {
    "csv_scan", "envelope_batches", "change_batches", "kpi_incremental", "kpi_published",
    "message_stream_kpi", "stream_kpi", "stream_kpi_change_feed",
})


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text: str) -> int:
    return len(re.findall(r"Exchange hashpartitioning", text))


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_pair_joins(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for banned in ("Python", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition, REPART"):
        assert banned not in text
    # one row: counters; bounded rows: a top-n, and the counts of the ranges of an order
    assert "Exchange SinglePartition" not in text or name in ("batch_counters", "matched_sample", "interleave")


def test_flagship_reads_and_moves_little(spark):
    text = plan(QUERIES["kpi_daily"](spark, SF_DIR))
    assert shuffles(text) == 2 and "Join" not in text
    schemas = re.findall(r"ReadSchema: struct<([^>]*)", text)
    columns = {c.split(":")[0] for s in schemas for c in s.split(",")}
    assert "o_custkey" not in columns and "l_tax" not in columns and "o_totalprice" not in columns


def test_first_completion_moves_rows_once(spark):
    assert shuffles(plan(QUERIES["first_completion"](spark, SF_DIR))) == 1


def test_plain_sequences_fold_by_hash(spark):
    trips = completed_trips(assemble_trips(user_events(spark, SF_DIR), ["pickup_datetime"], ["fare_amount"], unique_sequence=True))
    assert "SortAggregate" not in plan(trips) and "HashAggregate" in plan(trips)


def test_json_is_parsed_once(spark):
    rows = good_events(route_events(decode_envelopes(encode_envelopes(order_events(spark, SF_DIR)))))
    assert len(re.findall(r"JsonToStructs|from_json", plan(rows))) == 2  # one per branch of the union
    assert shuffles(plan(rows)) == 0
