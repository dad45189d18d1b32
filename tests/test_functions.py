import pytest
from conftest import at
from pyspark.sql import functions as F

from roadwatch.functions.messages import header_value, iso_timestamp
from roadwatch.functions.speed import average_speed, boundary_column, boundary_seconds
from roadwatch.functions.times import bin_start, event_day, hour_of_day, mixed_timestamp


def test_boundary_of_one_kilometre():
    assert boundary_seconds(1, 110) == 33
    assert boundary_seconds(1, 90) == 40


def test_boundary_column_agrees_with_plain_function(spark):
    rows = [(d, limit) for d in range(0, 40) for limit in (30, 50, 70, 90, 110)]
    frame = spark.createDataFrame(rows, "d int, l int")
    for d, limit, got in frame.select("d", "l", boundary_column(F.col("d"), F.col("l"))).collect():
        assert got == boundary_seconds(d, limit)
    zero = spark.createDataFrame([(1, 0)], "d int, l int")
    assert zero.select(boundary_column(F.col("d"), F.col("l"))).first()[0] is None


def test_average_speed_of_no_time_is_null(spark):
    frame = spark.createDataFrame([(1, 0.0), (1, 40.0)], "d int, t double")
    speeds = [r[0] for r in frame.select(average_speed(F.col("d"), F.col("t"))).collect()]
    assert speeds[0] is None
    assert speeds[1] == pytest.approx(90.0)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-01-02 03:04:05.678901", "2024-01-02 03:04:05.678901"),
        ("2024-01-02T03:04:05Z", "2024-01-02 03:04:05"),
        ("2024-01-02T05:04:05+02:00", "2024-01-02 03:04:05"),
        ("2024-01-02", "2024-01-02 00:00:00"),
        ("01/02/2024 03:04:05", "2024-01-02 03:04:05"),
        ("01/02/2024", "2024-01-02 00:00:00"),
        ("not a time", None),
        (None, None),
    ],
)
def test_mixed_timestamp(spark, text, expected):
    frame = spark.createDataFrame([(text,)], "t string")
    got = frame.select(mixed_timestamp("t").alias("t")).selectExpr("cast(t AS string)").first()[0]
    assert got == expected


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_truncation_is_in_utc_whatever_the_session_zone(spark, zone):
    rows = [(at("2024-03-10 23:59:59.999999"),), (at("1969-12-31 23:07:30"),)]
    frame = spark.createDataFrame(rows, "ts timestamp")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = frame.select(
            event_day(F.col("ts")).cast("string"),
            hour_of_day(F.col("ts")),
            F.unix_seconds(F.col("ts")) - F.unix_seconds(bin_start(F.col("ts"))),
            iso_timestamp(F.col("ts")),
        ).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(got[0]) == ("2024-03-10", 23, 299, "2024-03-10T23:59:59.999999+00:00")
    assert tuple(got[1]) == ("1969-12-31", 23, 150, "1969-12-31T23:07:30.000000+00:00")


def test_bins_equal_the_tumbling_window(spark):
    frame = spark.range(0, 5000).selectExpr("timestamp_micros(id * 977000003) AS ts")
    differing = frame.filter(bin_start(F.col("ts")) != F.window("ts", "5 minutes")["start"])
    assert differing.count() == 0


def test_header_values(spark):
    rows = [
        ([("a", b"7"), ("a", b"8"), ("t", b"2024-01-01T00:00:00.5+00:00")],),
        ([("a", b"x"), ("t", b"soon")],),
        ([("a", b"\xff")],),
        (None,),
    ]
    frame = spark.createDataFrame(rows, "headers array<struct<key string, value binary>>")
    got = frame.select(
        header_value("a", "int"), header_value("a"), header_value("t", "timestamp").cast("string")
    ).collect()
    assert [tuple(r) for r in got] == [
        (7, "7", "2024-01-01 00:00:00.5"),
        (None, "x", None),
        (None, None, None),
        (None, None, None),
    ]


def test_intermediate_folders_go_when_the_process_ends(spark, monkeypatch):
    from pathlib import Path

    from roadwatch import session

    monkeypatch.setattr(session, "_folders", [])
    folder = session.shared_folder(spark, "gone")
    spark.range(3).write.parquet(folder)
    assert Path(folder).exists()
    session._remove_folders()
    assert not Path(folder).exists()
