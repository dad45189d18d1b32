from conftest import at, same_rows
from pyspark.sql import functions as F

from roadwatch.schemas import CAMERA_EVENT, ENVELOPE
from roadwatch.sources import messages



def _encoded(events):
    headers = {
        "producer_id": F.lit(1),
        "speed_limit": F.lit(110),
        "dist_next": F.lit(1),
        "processing_timestamp": F.lit("2024-01-01 09:00:00.25").cast("timestamp"),
    }
    return messages.encode(events, headers, F.lit("camera_event_a"))


def _events(spark):
    rows = [
        ("e1", 2, "UTT 229", 1, at("08:00:00.123456"), 140.9),
        ("e2", 1, 'q"uote', 1, at("08:00:01"), None),
        ("e3", None, "X", 1, at("08:00:02"), 1.0),
    ]
    return spark.createDataFrame(rows, CAMERA_EVENT)


def test_decode_gives_back_what_was_encoded(spark):
    sent = _encoded(_events(spark))
    received = messages.decode(sent)
    same_rows(received.select(CAMERA_EVENT.fieldNames()), _events(spark))
    assert received.select("producer_id", "speed_limit", "dist_next").distinct().collect() == [
        (1, 110, 1)
    ]
    moment = received.selectExpr("cast(processing_timestamp AS string)").first()[0]
    assert moment == "2024-01-01 09:00:00.25"


def test_with_headers_keeps_the_envelope(spark):
    sent = _encoded(_events(spark))
    typed = messages.with_headers(sent, {"speed_limit": "int"})
    assert typed.columns == ["key", "value", "headers", "topic", "speed_limit"]
    assert typed.first()["speed_limit"] == 110


def test_bad_messages_give_null(spark):
    good = b'{"event_id":"e","camera_id":1,"speed_reading":12.5}'
    rows = [
        (b"jsondata", good, [("speed_limit", b"110")], "t", 0, 0, None),
        (b"jsondata", good, [("speed_limit", b"fast"), ("processing_timestamp", b"?")], "t", 0, 1, None),
        (b"jsondata", b"{broken", [("speed_limit", b"90")], "t", 0, 2, None),
        (b"jsondata", b'{"event_id":"e","camera_id":"one"}', [], "t", 0, 3, None),
        (None, None, None, "t", 0, 4, None),
    ]
    got = messages.decode(spark.createDataFrame(rows, ENVELOPE)).collect()
    assert [(r.event_id, r.camera_id, r.speed_reading, r.speed_limit) for r in got] == [
        ("e", 1, 12.5, 110),
        ("e", 1, 12.5, None),
        (None, None, None, 90),
        ("e", None, None, None),
        (None, None, None, None),
    ]
    assert all(r.processing_timestamp is None for r in got)


def test_dead_letters_name_their_reasons(spark):
    good = b'{"event_id":"e","camera_id":1,"speed_reading":12.5}'
    sound = [("producer_id", b"1"), ("speed_limit", b"110"), ("dist_next", b"1"), ("processing_timestamp", b"2024-01-01 00:00:00")]
    rows = [
        (b"jsondata", good, sound, "t", 0, 0, None),
        (b"jsondata", good, [*sound[:1], ("speed_limit", b"fast"), *sound[2:]], "t", 0, 1, None),
        (b"jsondata", b"{broken", sound[:3], "t", 0, 2, None),
        (b"jsondata", b'{"event_id":"e","camera_id":"one"}', sound, "t", 0, 3, None),
        (None, None, None, "t", 0, 4, None),
        (b"jsondata", b"{}", sound, "t", 0, 5, None),
    ]
    sent = spark.createDataFrame(rows, ENVELOPE)
    left_out = {r.offset: r.reasons for r in messages.rejected(sent).collect()}
    assert left_out == {
        1: ["bad header speed_limit"],
        2: ["no JSON", "missing header processing_timestamp"],
        3: ["no JSON"],
        4: ["no JSON", *[f"missing header {name}" for name, _ in sound]],
    }
    assert messages.accepted(sent).columns == sent.columns
    assert sorted(r.offset for r in messages.accepted(sent).collect()) == [0, 5]
    assert messages.rejected(sent.limit(0)).count() == 0


def test_reasons_read_each_message_once(spark):
    """Neither the value nor headers made on the way are worked out again in the filter on the reasons."""
    made = F.transform("headers", lambda h: F.struct(F.upper(h["key"]).alias("key"), h["value"]))
    sent = spark.createDataFrame([], ENVELOPE).withColumn("headers", made)
    for frame in (messages.with_reasons(sent).filter("size(reasons) > 0"), messages.rejected(sent), messages.accepted(sent)):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") <= 1
        assert plan.count("upper(") <= 1


def test_publish_order_skips_events_without_a_batch(spark):
    assert [r.event_id for r in messages.in_publish_order(_events(spark)).collect()] == ["e2", "e1"]
    by_plate = messages.in_publish_order(_events(spark), key=["car_plate"])
    assert sorted(r.event_id for r in by_plate.collect()) == ["e1", "e2"]


def test_envelope_files_read_as_table_and_stream(spark, tmp_path):
    messages.publish_files(_encoded(_events(spark)), f"{tmp_path}/topics")
    folder = f"{tmp_path}/topics/topic=camera_event_a"
    table = messages.decode(messages.envelope_table(spark, folder))
    same_rows(table.select(CAMERA_EVENT.fieldNames()), _events(spark))
    stream = messages.decode(messages.envelope_stream(spark, folder, max_files=1))
    assert stream.isStreaming
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{tmp_path}/out")
        .option("checkpointLocation", f"{tmp_path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    same_rows(
        spark.read.parquet(f"{tmp_path}/out").select(CAMERA_EVENT.fieldNames()), _events(spark)
    )
