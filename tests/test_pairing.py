import random
from datetime import timedelta

import pytest
from conftest import at, same_rows
from pyspark.sql import functions as F

from roadwatch.operators import pairing
from roadwatch.operators.detection import average_violations, instant_violations
from roadwatch.operators.pairing import (
    PAIR_COLUMNS,
    as_trips,
    chain_pairs,
    matched,
    network_pairs,
    segment_pairs,
    unmatched,
)

SIGHTING = """event_id string, car_plate string, camera_id int, timestamp timestamp,
speed_reading double, speed_limit int, dist_next int"""


def sightings(spark, rows):
    return spark.createDataFrame(rows, SIGHTING)


def camera(spark, number, rows, limit=110, distance=1):
    return sightings(
        spark, [(e, p, number, t, s, limit, distance) for e, p, t, s in rows]
    )


def brute_force(start, end, window):
    """The definition: every start against every end, by Spark's own full outer join."""
    s = start.select([F.col(c).alias(f"s_{c}") for c in start.columns])
    e = end.select([F.col(c).alias(f"e_{c}") for c in end.columns])
    joined = s.join(
        e,
        F.expr(
            f"""s_car_plate = e_car_plate AND
            s_timestamp BETWEEN e_timestamp - interval {window} seconds AND e_timestamp"""
        ),
        "full_outer",
    )
    return joined.selectExpr(
        "s_car_plate AS car_plate_start", "e_car_plate AS car_plate_end",
        "s_timestamp AS timestamp_start", "e_timestamp AS timestamp_end",
        "s_camera_id AS camera_id_start", "e_camera_id AS camera_id_end",
        "s_event_id AS event_id_start", "e_event_id AS event_id_end",
        "s_dist_next AS dist_next", "e_speed_limit AS speed_limit",
    )


def random_camera(spark, number, seed, rows=400, span=4000, plates=6):
    """Sightings with ties, gaps in plate and time, and one plate on a third of the rows."""
    draw = random.Random(seed)
    made = []
    for i in range(rows):
        plate = "hot" if draw.random() < 0.33 else draw.choice([f"p{k}" for k in range(plates)] + [None])
        moment = at("00:00:00") + timedelta(seconds=draw.randrange(span), microseconds=draw.choice([0, 0, 1, 999_999]))
        if draw.random() < 0.05:
            moment = None
        made.append((f"{number}-{i}", plate, moment, 100.0))
    return camera(spark, number, made)


@pytest.mark.parametrize("window", [1, 33, 1000, 7200])
def test_pairs_equal_the_full_outer_join(spark, window):
    start, end = random_camera(spark, 1, 7), random_camera(spark, 2, 8)
    wanted = brute_force(start, end, window)
    same_rows(segment_pairs(start, end, window), wanted)
    same_rows(segment_pairs(start, end, window, keep="matched"), matched(wanted))
    same_rows(segment_pairs(start, end, window, keep="unmatched"), unmatched(wanted))


def test_sightings_before_the_epoch(spark):
    start = camera(spark, 1, [("a", "X", at("1969-12-31 23:59:50"), 1.0)])
    end = camera(spark, 2, [("b", "X", at("1970-01-01 00:00:10"), 1.0)])
    same_rows(segment_pairs(start, end, 33), brute_force(start, end, 33))


def test_network_equals_chain(spark, monkeypatch):
    frames = [random_camera(spark, n, 20 + n) for n in (1, 2, 3, 4)]
    windows = [33, 40, 900]
    rows = [(f"s{n}", n, n + 1, w) for n, w in zip((1, 2, 3), windows, strict=True)]
    table = spark.createDataFrame(rows, "segment string, camera_id_start int, camera_id_end int, window int")
    every = frames[0]
    for frame in frames[1:]:
        every = every.unionByName(frame)
    for keep in ("all", "matched", "unmatched"):
        chain = chain_pairs(frames, windows, keep)
        same_rows(network_pairs(every, rows, 900, keep).select(*PAIR_COLUMNS), chain)
        same_rows(network_pairs(every, table, 900, keep).select(*PAIR_COLUMNS), chain)
    monkeypatch.setattr(pairing, "BROADCAST_SEGMENTS", 1)
    same_rows(network_pairs(every, table, 900).select(*PAIR_COLUMNS), chain_pairs(frames, windows))


def test_plan_holds_only_the_part_asked_for(spark):
    start, end = random_camera(spark, 1, 1), random_camera(spark, 2, 2)
    plan = lambda keep: segment_pairs(start, end, 33, keep)._jdf.queryExecution().toString()
    assert "first_start" not in plan("matched")
    assert "bucket_end" not in plan("unmatched")


def plan_of(rows):
    """The initial and the final plan of an executed query."""
    rows.collect()
    return rows._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("form", ["rows", "table"])
def test_sightings_are_not_shuffled_by_camera(spark, tmp_path, form):
    """With sightings above the broadcast threshold, in the initial and in the final plan."""
    path = str(tmp_path / "sightings")
    random_camera(spark, 1, 5).unionByName(random_camera(spark, 2, 6)).write.parquet(path)
    rows = [("s", 1, 2, 900)]
    schema = "segment string, camera_id_start int, camera_id_end int, window int"
    segments = rows if form == "rows" else spark.createDataFrame(rows, schema)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    try:
        plan = plan_of(as_trips(network_pairs(spark.read.parquet(path), segments, 900, "matched")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(camera_id" not in plan
    assert "hashpartitioning(car_plate" in plan
    broadcasts = [part for part in plan.split("BroadcastExchange")[1:] if "FileScan" in part.split("+- ")[1]]
    assert not broadcasts


def test_lone_sightings_need_one_aggregate_and_one_join(spark):
    start, end = random_camera(spark, 1, 1), random_camera(spark, 2, 2)
    plan = plan_of(segment_pairs(start, end, 33, keep="unmatched")).split("Initial Plan")[-1]
    assert plan.count("Join") == 1 and "Window" not in plan


def test_no_window_finds_only_sightings_at_the_same_instant(spark):
    start, end = random_camera(spark, 1, 5), random_camera(spark, 2, 6)
    same_rows(segment_pairs(start, end, 0), brute_force(start, end, 0))


def shuffled_rows(spark, rows):
    """Rows that the aggregate sends to its busiest task, and the rows of the result per task."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = rows.groupBy(F.spark_partition_id()).count().select("count").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    return max(r[0] for r in sizes), sum(r[0] for r in sizes)


def test_no_task_holds_all_of_a_busy_plate(spark):
    rows = [(f"a{i}", "hot", at("00:00:00") + timedelta(seconds=i), 1.0) for i in range(4000)]
    lone = segment_pairs(camera(spark, 1, rows), camera(spark, 2, []), 33, keep="unmatched")
    most, total = shuffled_rows(spark, lone)
    assert total == 4000 and most < 2500


def test_copies_of_one_sighting(spark):
    """Copies and sightings without a plate are all lone, each as often as it was seen."""
    copies = camera(spark, 1, [("a", "hot", at("00:00:00"), 1.0)] * 400).repartition(16)
    blank = camera(spark, 1, [(None, None, None, 1.0)] * 300).repartition(16)
    both, none = copies.unionByName(blank), camera(spark, 2, [])
    same_rows(segment_pairs(both, none, 33, keep="unmatched"), brute_force(both, none, 33))
    end = camera(spark, 2, [("b", "hot", at("00:00:33"), 1.0)])
    same_rows(segment_pairs(both, end, 33), brute_force(both, end, 33))


def test_inclusive_bounds(spark):
    start = camera(spark, 1, [
        ("s1", "exact", at("08:00:00"), 110.0),
        ("s2", "inside", at("08:00:00"), 109.9),
        ("s3", "beyond", at("08:00:00"), 50.0),
        ("s4", "same", at("08:00:00"), 50.0),
    ])
    end = camera(spark, 2, [
        ("e1", "exact", at("08:00:33"), 50.0),
        ("e2", "inside", at("08:00:32.8"), 50.0),
        ("e3", "beyond", at("08:00:33.000001"), 50.0),
        ("e4", "same", at("08:00:00"), 50.0),
    ])
    assert [r.event_id for r in instant_violations(start, end).collect()] == ["s1"]
    pairs = segment_pairs(start, end, 33)
    found = average_violations(as_trips(matched(pairs))).collect()
    # 33 s is 109.09 km/h and 32.8 s is 109.76 km/h: paired, yet no violation and not dropped.
    assert [(r.car_plate, r.average_speed) for r in found] == [("same", None)]
    assert {r.car_plate_start for r in matched(pairs).collect()} == {"exact", "inside", "same"}
    lone = unmatched(pairs).collect()
    assert {r.event_id_start or r.event_id_end for r in lone} == {"s3", "e3"}


def test_exactly_at_the_limit_is_a_violation(spark):
    start = camera(spark, 2, [("s", "P", at("08:00:00"), 1.0)])
    end = camera(spark, 3, [("e", "P", at("08:00:40"), 1.0)], limit=90)
    trips = as_trips(segment_pairs(start, end, 40, keep="matched"))
    assert [r.average_speed for r in average_violations(trips).collect()] == [90.0]


def test_distance_comes_from_the_start_and_limit_from_the_end(spark):
    start = camera(spark, 1, [("s", "P", at("08:00:00"), 1.0)], limit=30, distance=2)
    end = camera(spark, 2, [("e", "P", at("08:01:00"), 1.0)], limit=100, distance=9)
    row = average_violations(as_trips(segment_pairs(start, end, 72, keep="matched"))).first()
    assert (row.dist_next, row.speed_limit, row.average_speed) == (2, 100, 120.0)


def test_one_car_through_three_cameras(spark):
    plate = "UTT 229"
    frames = [
        camera(spark, 1, [("a", plate, at("08:00:00"), 140.9)]),
        camera(spark, 2, [("b", plate, at("08:00:26.887170"), 134.1)]),
        camera(spark, 3, [("c", plate, at("08:00:54.958092"), 130.8)], limit=90, distance=0),
    ]
    assert instant_violations(*frames).count() == 3
    trips = as_trips(chain_pairs(frames, [33, 40], keep="matched"))
    speeds = {r.camera_id_end: r.average_speed for r in average_violations(trips).collect()}
    assert speeds[2] == 133.89285632420857
    assert speeds[3] == pytest.approx(128.24658958816858, abs=1e-6)
    # The middle camera's sighting has a partner in each of its two segments.
    assert chain_pairs(frames, [33, 40], keep="unmatched").count() == 0


def test_missing_reading_or_limit_is_no_violation(spark):
    rows = sightings(spark, [
        ("a", "P", 1, at("08:00:00"), None, 110, 1),
        ("b", "P", 1, at("08:00:00"), 300.0, None, 1),
    ])
    assert instant_violations(rows).count() == 0
