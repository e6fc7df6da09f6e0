from helpers import end, event_log, numbered, start

from tripfold.operators.metrics import batch_counters
from tripfold.operators.staging import (
    cast_staging,
    messages_to_staging,
    parse_bodies,
    to_bodies,
    to_staging,
    unwrap_changes,
    wrap_trips,
)
from tripfold.operators.trips import assemble_trips, completed_trips
from tripfold.schemas import STAGING_FIELDS


def records(spark, *rows):
    return spark.createDataFrame(list(rows), "event_name string, image string")


def test_unwrap(spark):
    image = '{"fare_amount":{"N":"1.50"},"vendor_id":{"NULL":true},"trip_id":{"S":"a"},"x":{"N":"1"}}'
    row = messages_to_staging(unwrap_changes(records(spark, ("MODIFY", image)))).first()
    assert row["fare_amount"] == "1.50" and row["trip_id"] == "a"
    assert row["vendor_id"] is None and row["pickup_datetime"] is None
    assert [c for c in row.asDict() if c in STAGING_FIELDS] == list(STAGING_FIELDS)


def test_only_modify_with_an_image(spark):
    rows = records(
        spark,
        ("INSERT", '{"trip_id":{"S":"a"}}'),
        ("REMOVE", None),
        (None, None),
        ("MODIFY", None),
        ("MODIFY", "{}"),
        ("MODIFY", '{"trip_id":{}}'),
        ("MODIFY", '{"trip_id":5}'),
        ("MODIFY", "[]"),
        ("MODIFY", '{"trip_id":{"S":"a"}} behind'),
        ("MODIFY", '{"trip_id":{"S":"a"}}'),
    )
    unwrapped = unwrap_changes(rows)
    assert sorted(str(r["reason"]) for r in unwrapped.collect()) == sorted(
        ["empty_image", "empty_image", "bad_image", "bad_image", "bad_image", "bad_image", "None"]
    )
    counts = batch_counters(unwrapped).first()
    assert (counts["success"], counts["failed"], counts["skipped"]) == (1, 4, 2)


def test_bodies(spark):
    bodies = [
        '{"trip_id": "a", "fare_amount": "12.50", "extra": 1}',
        '{"trip_id": "b", "vendor_id": true, "rate_code": 2}',
        "{bad",
        "",
        "[1]",
        "7",
    ]
    rows = parse_bodies(spark.createDataFrame([(b,) for b in bodies], "body string")).collect()
    assert [r["reason"] for r in rows] == [None, None, "bad_json", "bad_json", "not_object", "not_object"]
    assert rows[0]["fare_amount"] == "12.50" and rows[0]["tip_amount"] is None
    assert rows[1]["vendor_id"] == "true" and rows[1]["rate_code"] == "2"


def test_cast(spark):
    values = [
        ("12.50", "2024-05-25 13:19:00"),
        ("abc", "2024-05-25T13:19:00"),
        ("true", "2024-05"),
        (None, "2024"),
        ("NaN", "25/05/2024"),
        ("1", None),
    ]
    staged = to_staging(spark.createDataFrame(values, "fare_amount string, pickup_datetime string"))
    assert staged.columns == list(STAGING_FIELDS)
    rows = cast_staging(staged).collect()
    assert [None if r["fare"] is None else float(r["fare"]) for r in rows] == [12.5, None, None, None, None, 1]
    assert [str(r["pickup_date"]) for r in rows] == [
        "2024-05-25", "2024-05-25", "2024-05-01", "2024-01-01", "None", "None",
    ]
    assert [r["reason"] for r in rows] == [None] * 4 + ["bad_pickup_datetime"] * 2
    assert [r["warning"] for r in rows] == [None, "bad_fare", "bad_fare", None, None, None]


def test_casts_do_not_depend_on_ansi(spark):
    staged = to_staging(spark.createDataFrame([("abc", "x")], "fare_amount string, pickup_datetime string"))
    for flag in ("false", "true"):
        spark.conf.set("spark.sql.ansi.enabled", flag)
        assert cast_staging(staged).first()["fare"] is None
    spark.conf.unset("spark.sql.ansi.enabled")


def test_wrap_and_body_roundtrips(spark):
    log = event_log(spark, numbered([start("a", "05-25 13:19", 10), end("a", "05-25 13:40", 12.5)]))
    trips = completed_trips(assemble_trips(log))
    staged = to_staging(trips).first().asDict()
    assert staged["pickup_datetime"] == "2024-05-25 13:19:00" and staged["fare_amount"] == "12.50"
    body = parse_bodies(to_bodies(trips)).first().asDict()
    assert {f: body[f] for f in STAGING_FIELDS} == staged
    images = wrap_trips(trips).selectExpr("'MODIFY' as event_name", "image")
    unwrapped = messages_to_staging(unwrap_changes(images)).first().asDict()
    assert {f: unwrapped[f] for f in STAGING_FIELDS} == staged
