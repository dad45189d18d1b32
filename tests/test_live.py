from conftest import at, same_rows
from pyspark.sql import functions as F
from test_store import violation, violations

from roadwatch.operators import live
from roadwatch.sources.tables import read_violations
from roadwatch.sources import batches

SINCE = "2024-01-01 09:00:00"


def since():
    return F.lit(SINCE).cast("timestamp")


def test_a_changed_document_comes_whole(spark):
    rows = violations(
        spark,
        violation("P", updated="08:00:00"),
        violation("P", end="08:00:01", updated="09:00:01"),
        violation("P", end="07:00:00", kind="average", start="06:59:00", camera=2,
                  updated="07:00:00", origin="historic"),
        violation("P", updated="08:00:00", day=at("2024-01-02 00:00:00").date()),
        violation("Q", updated="09:00:00"),
        violation("H", updated="10:00:00", origin="historic"),
        violation(None, updated="10:00:00"),
    )
    got = live.changed_documents(rows, since())
    same_rows(got, rows.filter("(car_plate = 'P' AND date = '2024-01-01') OR car_plate IS NULL"))


def test_changed_documents_without_a_day_or_without_any(spark):
    rows = violations(spark, violation("P", updated="09:30:00", day=None), violation("Q"))
    same_rows(live.changed_documents(rows, since()), rows.filter("date IS NULL"))
    never = F.lit("2030-01-01 00:00:00").cast("timestamp")
    assert live.changed_documents(rows, never).count() == 0


def test_changed_documents_reads_only_the_days_concerned(spark, tmp_path):
    second = at("2024-01-02 00:00:00").date()
    rows = violations(spark, violation("P", updated="08:00:00"),
                      violation("P", updated="09:30:00", day=second))
    batches.write_batch(rows, str(tmp_path), 0, ["date"])
    got = live.changed_documents(read_violations(spark, str(tmp_path)), since())
    same_rows(got, rows.filter("date = '2024-01-02'"))
    plan = got._jdf.queryExecution().toString()
    assert any("dynamicpruning" in part[:120] for part in plan.split("PartitionFilters: [")[1:])


def arrivals(spark):
    """Camera 1 over two hours, camera 2 earlier that day, and rows without camera or time."""
    rows = [violation(end=f"{8 + m // 60:02d}:{m % 60:02d}:59", speed=float(m)) for m in range(121)]
    rows += [violation(end=f"03:{m:02d}:00", camera=2, speed=float(m)) for m in range(0, 60, 7)]
    rows += [violation(end="01:00:00", camera=2), violation(end="04:00:00", camera=None)]
    frame = live.arrivals(violations(spark, *rows))
    blank = frame.limit(1).withColumn("arrival_time", F.lit(None).cast("timestamp"))
    return frame.unionByName(blank).cache()


def test_trailing_hour_is_inclusive_and_per_camera(spark):
    rows = arrivals(spark)
    recent = live.trailing_hour(rows)
    bins = recent.filter("camera_id = 1").select("arrival_time").distinct()
    assert bins.count() == 13
    assert recent.filter("camera_id = 2").count() == 9
    assert recent.filter("camera_id IS NULL").count() == 1
    assert recent.filter("arrival_time IS NULL").count() == 0
    assert recent.columns == rows.columns


def test_trailing_hour_beyond_the_camera_bound(spark):
    rows = arrivals(spark)
    same_rows(live.trailing_hour(rows, max_cameras=1), live.trailing_hour(rows))


def test_live_statistics_equal_statistics_of_the_trailing_hour(spark):
    rows = arrivals(spark)
    same_rows(live.live_statistics(rows), live.bin_statistics(live.trailing_hour(rows)))
    last = live.live_statistics(rows).filter("camera_id = 1").orderBy("start_time").first()
    # The bin from 09:00 holds minutes 60 to 64 of the readings.
    assert (last.total_violations, last.avg_speed, last.p90_speed) == (5, 62.0, 64.0)


def test_high_water_mark(spark):
    rows = live.arrivals(violations(spark, violation(updated="09:30:00"), violation(updated="08:00:00")))
    mark = live.high_water_mark(rows, since()).selectExpr("cast(since AS string)", "cast(next_since AS string)")
    assert tuple(mark.first()) == (SINCE, "2024-01-01 09:30:00")
    none = live.high_water_mark(rows.limit(0), since()).selectExpr("cast(next_since AS string)")
    assert none.first()[0] == SINCE
