import pytest
from helpers import end, envelope, event_log, numbered, start, wire
from pyspark.sql import functions as F

from tripfold.operators.envelope import decode_envelopes, encode_envelopes
from tripfold.operators.events import good_events, quarantine, route_events
from tripfold.operators.metrics import batch_counters, observed, reasons
from tripfold.session import CODE_BYTES, CODE_CONF, CODE_DEFAULT


def route(spark, datas):
    rows = [(d, None, i) for i, d in enumerate(datas)]
    return route_events(
        decode_envelopes(spark.createDataFrame(rows, "data string, partition_key string, sequence bigint"))
    )


def outcomes(spark, datas):
    rows = route(spark, datas).orderBy("sequence").collect()
    return [(r["reason"], r["kind"], r["trip_id"]) for r in rows]


PICKUP = "2024-05-25 13:19:00"


def test_decode_reasons(spark):
    cases = [
        (None, "bad_base64"),
        ("%%%", "bad_base64"),
        (envelope(b"\xff"), "bad_utf8"),
        (envelope("{bad"), "bad_json"),
        (envelope(""), "bad_json"),
        (envelope('{"trip_id": NaN}'), "bad_json"),
        (envelope('{"trip_id": "a"} x'), "bad_json"),
        (envelope('{"trip_id": "a"},{"b": 1}'), "bad_json"),
        (envelope("[1]"), "not_object"),
        (envelope("5"), "not_object"),
        (envelope("null"), "not_object"),
        (envelope("{}"), "missing_trip_id"),
    ]
    assert [r for r, _, _ in outcomes(spark, [d for d, _ in cases])] == [r for _, r in cases]


def test_lenient_json_is_not_accepted(spark):
    texts = ["{'trip_id': 'a'}", '{trip_id: "a"}', '{"trip_id": "a"', '{"trip_id": "a"}}', '{"trip_id": 01}']
    assert {r for r, _, _ in outcomes(spark, [envelope(t) for t in texts])} == {"bad_json"}


def test_last_of_repeated_keys_wins(spark):
    text = f'{{"trip_id": "a", "trip_id": "b", "pickup_datetime": "{PICKUP}"}}'
    assert outcomes(spark, [envelope(text)]) == [(None, "start", "b")]


def test_unusual_but_valid_documents(spark):
    texts = [
        f' {{"trip_id": "a", "pickup_datetime": "{PICKUP}"}} ',
        f'{{"trip_id": "a", "pickup_datetime": "{PICKUP}", "extra": {{"deep": [1, {{"x": null}}]}}}}',
        f'{{"trip_id": "a", "vendor_id": [1, 2], "pickup_datetime": "{PICKUP}"}}',
        f'{{"trip_id": "a", "vendor_id": {{"k": 1}}, "pickup_datetime": "{PICKUP}"}}',
    ]
    assert outcomes(spark, [envelope(t) for t in texts]) == [(None, "start", "a")] * 4


def test_events_without_a_sequence_cannot_be_ordered(spark):
    rows = spark.createDataFrame([(wire(start("a", "05-25 13:19")), None)], "data string, sequence bigint")
    assert route_events(decode_envelopes(rows)).first()["reason"] == "missing_sequence"


def test_decode_only(spark):
    rows = spark.createDataFrame([("eyJ0IjoxfQ==",)], "data string")
    assert decode_envelopes(rows).first()["reason"] is None


def test_falsy_ids_are_missing(spark):
    falsy = ['""', "null", "0", "0.0", "-0", "0e3", "false", "[]", "{}"]
    truthy = [('"0"', "0"), ("7", "7"), ("true", "true"), ('"é"', "é"), ("[1]", "[1]")]
    texts = [f'{{"trip_id": {v}, "pickup_datetime": "{PICKUP}"}}' for v in falsy + [t for t, _ in truthy]]
    texts.append(f'{{"pickup_datetime": "{PICKUP}"}}')
    got = outcomes(spark, [envelope(t) for t in texts])
    expected = [("missing_trip_id", None, None)] * len(falsy)
    expected += [(None, "start", id_) for _, id_ in truthy] + [("missing_trip_id", None, None)]
    assert got == expected


def test_routing(spark):
    got = outcomes(
        spark,
        [
            envelope({"trip_id": "a", "pickup_datetime": PICKUP}),
            envelope({"trip_id": "a", "dropoff_datetime": PICKUP}),
            envelope({"trip_id": "a", "pickup_datetime": PICKUP, "dropoff_datetime": PICKUP}),
            envelope({"trip_id": "a", "pickup_datetime": "", "dropoff_datetime": PICKUP}),
            envelope({"trip_id": "a"}),
            envelope({"trip_id": "a", "pickup_datetime": None, "dropoff_datetime": 0}),
            envelope({"trip_id": "a", "pickup_datetime": "25/05/2024"}),
        ],
    )
    assert got == [
        (None, "start", "a"),
        (None, "end", "a"),
        (None, "start", "a"),
        (None, "end", "a"),
        ("missing_datetimes", None, "a"),
        ("missing_datetimes", None, "a"),
        ("bad_pickup_datetime", None, "a"),
    ]


def test_start_with_both_times_loses_the_end_fields(spark):
    both = {"trip_id": "a", "pickup_datetime": PICKUP, "dropoff_datetime": PICKUP, "fare_amount": 3}
    row = good_events(route(spark, [envelope(both)])).first()
    assert row["kind"] == "start" and row["fare_amount"] is None and row["dropoff_datetime"] is None


@pytest.mark.parametrize(
    "pickup, expected",
    [
        ("2024-05-25 13:19:00", "2024-05-25 13:19:00"),
        ("2024-05-25T13:19:00", "2024-05-25 13:19:00"),
        ("2024-05-25", "2024-05-25 00:00:00"),
        ("2024-05-25 xx", "2024-05-25 00:00:00"),
        ("2024-05", "2024-05-01 00:00:00"),
        ("2024-05-25T23:30:00-05:00", "2024-05-25 23:30:00"),
    ],
)
def test_pickup_times(spark, pickup, expected):
    rows = good_events(route(spark, [envelope({"trip_id": "a", "pickup_datetime": pickup})]))
    assert str(rows.first()["pickup_datetime"]) == expected


def test_numbers_and_fare_warnings(spark):
    fares = ['" 7 "', "12.50", "1e2", '"abc"', '"NaN"', '""', "null", "12.345", '"true"']
    datas = [
        envelope(f'{{"trip_id": "{i}", "dropoff_datetime": "{PICKUP}", "fare_amount": {f}, "trip_type": "2"}}')
        for i, f in enumerate(fares)
    ]
    rows = route(spark, datas).orderBy("sequence").collect()
    fare = [None if r["fare_amount"] is None else float(r["fare_amount"]) for r in rows]
    assert fare == [7.0, 12.5, 100.0, None, None, None, None, 12.35, None]
    assert [r["warning"] for r in rows] == [None] * 3 + ["bad_fare"] * 3 + [None, "rounded_fare", "bad_fare"]
    assert all(r["reason"] is None and r["trip_type"] == 2 for r in rows)


def test_poison_record_leaves_its_neighbours(spark):
    events = numbered([start("a", "05-25 13:19"), start("b", "05-25 13:19")])
    routed = route(spark, [wire(events[0]), "%%%", wire(events[1])])
    assert {r["trip_id"] for r in good_events(routed).collect()} == {"a", "b"}
    bad = quarantine(routed, "ingest").collect()
    assert [(r["stage"], r["reason"], r["raw"], r["sequence"]) for r in bad] == [
        ("ingest", "bad_base64", "%%%", "1")
    ]


def test_missing_estimated_dropoff_is_null(spark):
    row = good_events(route(spark, [wire(start("a", "05-25 13:19"))])).first()
    assert row["estimated_dropoff_datetime"] is None


def test_roundtrip(spark):
    events = event_log(spark, numbered([start("a", "05-25 13:19", 10, "1"), end("ä", "05-25 13:40", 12.5)]))
    back = good_events(route_events(decode_envelopes(encode_envelopes(events))))
    assert sorted(back.collect()) == sorted(events.collect())


def test_counters(spark):
    datas = [wire(start("a", "05-25 13:19")), "%%%", envelope("{}"), envelope("{}")]
    routed = route(spark, datas)
    assert batch_counters(routed).first().asDict() == {
        "records": 4,
        "success": 1,
        "failed": 3,
        "skipped": 0,
        "warnings": 0,
    }
    assert {r["reason"]: r["rows"] for r in reasons(routed).collect()} == {
        "bad_base64": 1,
        "missing_trip_id": 2,
    }
    rows, observation = observed(routed, "batch")
    rows.write.format("noop").mode("overwrite").save()
    assert observation.get["failed"] == 3


def test_records_array_source(spark, tmp_path):
    from tripfold.sources.readers import read_change_batches, read_envelope_batches, read_envelopes

    record = {"kinesis": {"data": "eyJ0IjoxfQ==", "partitionKey": "k", "sequenceNumber": "49"}}
    lines = ['{"Records": []}', "{}", __import__("json").dumps({"Records": [record, record]})]
    (tmp_path / "r.json").write_text("\n".join(lines))
    rows = read_envelope_batches(spark.read, str(tmp_path)).collect()
    assert [tuple(r) for r in rows] == [("eyJ0IjoxfQ==", "k", (2, "49"))] * 2

    flat = tmp_path / "flat"
    flat.mkdir()
    (flat / "e.json").write_text('{"data": "x", "partition_key": "k", "sequence": 3}')
    assert [tuple(r) for r in read_envelopes(spark.read, str(flat)).collect()] == [("x", "k", 3)]

    changes = tmp_path / "changes"
    changes.mkdir()
    image = {"fare_amount": {"N": "1.50"}, "x": {"NULL": True}}
    change = {"eventName": "MODIFY", "dynamodb": {"NewImage": image}}
    (changes / "c.json").write_text(__import__("json").dumps({"Records": [change, {"eventName": "REMOVE"}]}))
    rows = read_change_batches(spark.read, str(changes))
    assert [r["event_name"] for r in rows.collect()] == ["MODIFY", "REMOVE"]
    assert rows.where(F.col("image").isNull()).count() == 1


def test_delivered_sequences_have_numeric_order(spark):
    from tripfold.functions.scalars import sequence_order

    texts = ["10", "9", "0011", "4" * 56, "", "x1", None, "000"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("s", sequence_order(F.col("t")))
    good = rows.where("s is not null").orderBy("s").collect()
    assert [r["t"] for r in good] == ["000", "9", "10", "0011", "4" * 56]
    assert {r["t"] for r in rows.where("s is null").collect()} == {"", "x1", None}


def test_fractions_of_a_second_stay(spark):
    event = {"trip_id": "a", "pickup_datetime": "2024-05-25 13:19:00.25"}
    events = good_events(route(spark, [envelope(event)]))
    assert str(events.first()["pickup_datetime"]) == "2024-05-25 13:19:00.250000"
    back = good_events(route_events(decode_envelopes(encode_envelopes(events))))
    assert back.collect() == events.collect()


def test_end_fields_are_validated(spark):
    fields = {"trip_id": "a", "tip_amount": "abc", "payment_type": "x", "trip_distance": "1.234"}
    rows = route(spark, [envelope({**fields, "dropoff_datetime": t}) for t in (PICKUP, "25/05/2024")]).orderBy("sequence").collect()
    assert [(r["reason"], r["warning"]) for r in rows] == [
        (None, "rounded_trip_distance,bad_tip_amount,bad_payment_type"),
        ("bad_dropoff_datetime", None),
    ]


def test_csv_source(spark, tmp_path):
    from tripfold.sources.readers import CORRUPT, read_ends_csv, read_starts_csv

    header = "trip_id,pickup_location_id,dropoff_location_id,vendor_id,pickup_datetime,estimated_dropoff_datetime,estimated_fare_amount"
    starts = tmp_path / "starts.csv"
    lines = ["t1,1,2,1,2024-05-25 13:19:00,,12.50", "t2,1,2,1,not a date,,1", "t3,1", ",1,2,1,2024-05-25 13:19:00,,1"]
    starts.write_text("\n".join([header, *lines]) + "\n")
    rows = {r["trip_id"]: r for r in read_starts_csv(spark.read, str(starts)).collect()}
    assert str(rows["t1"]["pickup_datetime"]) == "2024-05-25 13:19:00" and float(rows["t1"]["estimated_fare_amount"]) == 12.5
    assert {k: r["reason"] for k, r in rows.items()} == {
        "t1": None, "t2": "bad_pickup_datetime", "t3": "bad_line", None: "missing_trip_id",
    }
    assert rows["t1"][CORRUPT] is None and rows["t3"][CORRUPT].startswith("t3,")

    header = "dropoff_datetime,rate_code,passenger_count,trip_distance,fare_amount,tip_amount,payment_type,trip_type,trip_id"
    ends = tmp_path / "ends.csv"  # the documented order; a column with gaps has its integers as 1.0
    ends.write_text(f"{header}\n2024-05-25 13:40:00,1,2.0,3.5,12.50,abc,1.0,,t1\n")
    row = read_ends_csv(spark.read, str(ends)).first()
    assert row["trip_id"] == "t1" and row["passenger_count"] == 2 and float(row["fare_amount"]) == 12.5
    assert row["payment_type"] == 1 and row["trip_type"] is None and row["warning"] == "bad_tip_amount"

    other = tmp_path / "other.csv"
    other.write_text("vendor_id,id\n1,2\n")
    with pytest.raises(ValueError):
        read_starts_csv(spark.read, str(other))


def test_csv_files_with_different_headers(spark, tmp_path):
    import gzip

    from tripfold.sources.readers import read_ends_csv

    folder = tmp_path / "ends"
    folder.mkdir()
    (folder / "a.csv").write_text("trip_id,dropoff_datetime,fare_amount\na,2024-05-25 13:40:00,1.5\n")
    (folder / "b.csv").write_text('﻿fare_amount,"other, thing",dropoff_datetime,trip_id\n2.5,"x,y",2024-05-25 13:41:00,b\na line cut short\n')
    (folder / "c.csv.gz").write_bytes(gzip.compress(b"dropoff_datetime,trip_id\n2024-05-25 13:42:00,c\n"))
    (folder / "d.csv").write_text("")
    (folder / "_hidden.csv").write_text("nothing\n")
    found = {r.trip_id: (str(r.dropoff_datetime)[-8:], r.fare_amount and float(r.fare_amount), r.reason) for r in read_ends_csv(spark.read, str(folder)).collect()}
    assert found["a"] == ("13:40:00", 1.5, None) and found["b"] == ("13:41:00", 2.5, None) and found["c"] == ("13:42:00", None, None)
    assert len(found) == 4 and [f[2] for k, f in found.items() if k not in ("a", "b", "c")] == ["missing_trip_id"]
    (folder / "e.csv").write_text("no,id\n1,2\n")
    with pytest.raises(ValueError, match="trip_id"):
        read_ends_csv(spark.read, str(folder))


def test_routing_is_compiled(spark):
    """As one method the projection has more bytecode than HotSpot ever compiles, and was interpreted for each row."""
    before = spark.conf.get(CODE_CONF)
    try:
        spark.conf.set(CODE_CONF, CODE_DEFAULT)
        datas = [envelope('{"trip_id": "0", "pickup_datetime": "2024-05-25 13:19:00"}'), envelope('{"trip_id": 0, "pickup_datetime": 5}')]
        routed = route(spark, datas)
        assert spark.conf.get(CODE_CONF) == CODE_BYTES
        assert [(r["reason"], r["trip_id"]) for r in routed.orderBy("sequence").collect()] == [(None, "0"), ("missing_trip_id", None)]
        spark.conf.set(CODE_CONF, "20000")
        route(spark, datas)
        assert spark.conf.get(CODE_CONF) == "20000"  # a session's own limit stays
    finally:
        spark.conf.set(CODE_CONF, before)
