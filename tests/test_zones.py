"""Wall-clock times do not move with the session's time zone."""

import pytest
from helpers import end, event_log, numbered, start, wire

from tripfold.operators.envelope import decode_envelopes, encode_envelopes
from tripfold.operators.events import good_events, route_events
from tripfold.operators.kpi import daily_kpis
from tripfold.operators.staging import cast_staging, to_staging, wrap_trips
from tripfold.operators.trips import assemble_trips, completed_trips


@pytest.fixture(params=["UTC", "America/New_York", "Asia/Kolkata"])
def zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


def test_skipped_hour_and_midnight(spark, zone):
    # 02:30 does not exist in New York on 10 March 2024
    events = numbered(
        [start("a", "03-10 02:30", 10), end("a", "03-10 03:10", 1), start("b", "03-10 23:59"), end("b", "03-11 00:01", 2)]
    )
    log = event_log(spark, events)
    decoded = good_events(route_events(decode_envelopes(encode_envelopes(log))))
    direct = spark.createDataFrame([(wire(e), e["sequence"]) for e in events], "data string, sequence bigint")
    for rows in (log, decoded, good_events(route_events(decode_envelopes(direct)))):
        trips = completed_trips(assemble_trips(rows))
        kpi = daily_kpis(trips).collect()
        assert [(str(r["pickup_date"]), r["count_trips"], r["total_fare"]) for r in kpi] == [("2024-03-10", 2, 3.0)]
        staged = cast_staging(to_staging(trips)).orderBy("trip_id").collect()
        assert [r["pickup_datetime"] for r in staged] == ["2024-03-10 02:30:00", "2024-03-10 23:59:00"]
        assert {str(r["pickup_date"]) for r in staged} == {"2024-03-10"}
        assert "2024-03-10 02:30:00" in wrap_trips(trips).orderBy("trip_id").first()["image"]
