import pytest
from test_store import violation, violations

from conftest import at
from roadwatch.operators import hotspots
from roadwatch.plans.bindings import CAMERA_ROWS
from roadwatch.schemas import CAMERA

RANGE = ("2024-01-01", "2024-01-03")


@pytest.fixture
def cameras(spark):
    return spark.createDataFrame(CAMERA_ROWS, CAMERA)


def day(number):
    return at(f"2024-01-0{number} 00:00:00").date()


def test_threshold_is_exclusive_on_both_sides(spark, cameras):
    rows = []
    for camera, count in ((1, 99), (2, 100), (3, 101)):
        rows += [violation(f"{camera}-{i}", camera=camera) for i in range(count)]
    cells = hotspots.hotspots(violations(spark, *rows), cameras, *RANGE, hour=8).collect()
    assert {r.camera_id: (r.violation_count, r["class"]) for r in cells} == {
        1: (99, "normal"), 2: (100, None), 3: (101, "hotspot"),
    }
    assert hotspots.hotspots(violations(spark, *rows), cameras, *RANGE, hour=9).count() == 0


def test_hours_add_up_over_the_half_open_range(spark):
    rows = violations(
        spark,
        violation(end="2024-01-01 08:10:00", day=day(1), speed=100.0),
        violation(end="2024-01-02 08:20:00", day=day(2), speed=110.0),
        violation(end="2024-01-03 08:30:00", day=day(3), speed=500.0),
        violation(end="2024-01-02 09:00:00", day=day(2), kind="average", start="2024-01-02 08:59:00", camera=2),
    )
    cells = [tuple(r) for r in hotspots.hourly_camera_stats(rows, *RANGE).collect()]
    assert cells == [(8, 1, 2, 105.0), (9, 2, 1, 120.0)]
    segments = [tuple(r) for r in hotspots.hourly_segment_stats(rows, *RANGE).collect()]
    assert segments == [(9, 1, 2, "average", 1, 120.0)]


def test_segments_lie_between_their_cameras(spark, cameras):
    rows = violations(spark, violation(kind="average", start="07:59:00", camera=3, speed=99.999))
    cell = hotspots.segment_hotspots(rows, cameras, *RANGE).first()
    assert cell.mid_lat == (CAMERA_ROWS[1][1] + CAMERA_ROWS[2][1]) / 2
    assert cell.mid_lon == (CAMERA_ROWS[1][2] + CAMERA_ROWS[2][2]) / 2
    assert cell.exceeded_speed == 100.0
