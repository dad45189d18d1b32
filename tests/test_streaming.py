import os
import random
from datetime import timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import at, same_rows
from pyspark.sql import functions as F
from test_pairing import SIGHTING, brute_force, camera, random_camera

from roadwatch.operators import store
from roadwatch.operators.detection import average_violations, instant_violations
from roadwatch.operators.live import arrivals, bin_statistics, live_statistics
from roadwatch.operators.pairing import as_trips, chain_pairs, matched, segment_pairs, unmatched
from roadwatch.operators.records import instant_records
from roadwatch.sources import batches
from roadwatch.sources.tables import read_violations
from roadwatch.streaming import jobs, sinks

ARROW = pa.schema([
    ("event_id", pa.string()), ("car_plate", pa.string()), ("camera_id", pa.int32()),
    ("timestamp", pa.timestamp("us", tz="UTC")), ("speed_reading", pa.float64()),
    ("speed_limit", pa.int32()), ("dist_next", pa.int32()),
])


def inbox(folder, number, batches, limit=110, distance=1, speed=120.0):
    """One file per micro-batch, in order of modification time."""
    folder.mkdir(parents=True, exist_ok=True)
    for i, batch in enumerate(batches):
        rows = [(e, p, number, at(t), speed, limit, distance) for e, p, t in batch]
        table = pa.Table.from_arrays(
            [pa.array(list(column), kind) for column, kind in zip(zip(*rows), ARROW.types)],
            schema=ARROW,
        )
        path = folder / f"batch-{i}.parquet"
        pq.write_table(table, path)
        os.utime(path, (1_700_000_000 + 10 * i,) * 2)
    return str(folder)


def stream(spark, path, files=1):
    return spark.readStream.schema(SIGHTING).option("maxFilesPerTrigger", files).parquet(path)


@pytest.fixture(autouse=True)
def few_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def run(rows, folder, out):
    progress = jobs.finish(
        jobs.start(rows, lambda b, n: batches.write_batch(b, out, n), f"{folder}/checkpoint", once=True)
    )
    return progress[0], batches.read_batches(rows.sparkSession, out, rows.schema)


def test_lateness(spark, tmp_path):
    start = inbox(tmp_path / "start", 1, [
        [("a1", "X", "10:00:00"), ("a2", "Y", "12:00:00")],
        [("a4", "Q4", "14:00:00")],
        [("a5late", "P", "09:00:00"), ("a6late", "U", "09:00:00"), ("a7", "V", "13:40:00")],
        [("a8late", "W", "09:30:00"), ("a9", "K", "15:00:00")],
    ])
    end = inbox(tmp_path / "end", 2, [
        [("b1", "X", "10:00:30"), ("b2", "Z", "12:00:00")],
        [("b4", "Q4", "14:00:00")],
        [("b5late", "P", "09:00:10"), ("b7", "V", "13:40:20")],
        [("b9", "K", "15:00:10")],
    ])
    pairs = segment_pairs(
        jobs.watermarked(stream(spark, start)), jobs.watermarked(stream(spark, end)), 33
    )
    progress, got = run(pairs, tmp_path, f"{tmp_path}/out")
    assert {(r.event_id_start, r.event_id_end) for r in got.collect()} == {
        ("a1", "b1"), ("a4", "b4"), ("a7", "b7"), ("a9", "b9"), ("a2", None), (None, "b2"),
    }
    assert jobs.late_rows(progress) == 4


def files_of(frame, path):
    frame.write.parquet(path)
    return path


def emitted(pairs, window, mark):
    """What a stream gives out: all matches, lone rows that the watermark has passed, and lone
    rows without a plate."""
    return pairs.filter(
        F.coalesce("car_plate_start", "car_plate_end").isNull() |
        (F.col("timestamp_start").isNotNull() & F.col("timestamp_end").isNotNull())
        | (F.col("timestamp_end").isNull()
           & (F.col("timestamp_start") <= F.lit(mark - timedelta(seconds=window))))
        | (F.col("timestamp_start").isNull() & (F.col("timestamp_end") <= F.lit(mark)))
    )


def test_stream_equals_batch(spark, tmp_path):
    timed = F.col("timestamp").isNotNull()
    start = random_camera(spark, 1, 3, rows=200).filter(timed)
    end = random_camera(spark, 2, 4, rows=200).filter(timed)
    frames = [
        jobs.watermarked(stream(spark, files_of(frame, f"{tmp_path}/{name}"), files=100), "1 minute")
        for name, frame in (("start", start), ("end", end))
    ]
    pairs = segment_pairs(*frames, 120)
    _, got = run(pairs, tmp_path, f"{tmp_path}/out")
    latest = [f.agg(F.max(F.date_trunc("millisecond", "timestamp"))).first()[0] for f in (start, end)]
    mark = min(latest) - timedelta(minutes=1)
    wanted = emitted(brute_force(start, end, 120), 120, mark)
    assert wanted.count() > 200
    same_rows(got, wanted)


def test_restart_after_a_plate_became_busy(spark, tmp_path):
    """The second half holds a plate on most rows; stopping between the halves changes nothing."""
    timed = F.col("timestamp").isNotNull()
    halves = [[random_camera(spark, n, seed + n, rows=60).filter(timed) for seed in (30, 40)] for n in (1, 2)]
    for camera_halves in halves:
        camera_halves[1] = camera_halves[1].withColumn(
            "car_plate", F.expr("if(pmod(hash(event_id), 4) > 0, 'busy', car_plate)")
        )

    def pairs_of(folder):
        frames = [stream(spark, f"{folder}/{n}", files=100) for n in (1, 2)]
        return segment_pairs(*[jobs.watermarked(f, "2 hours") for f in frames], 120)

    def add(folder, half):
        for n, camera_halves in zip((1, 2), halves, strict=True):
            camera_halves[half].coalesce(1).write.mode("append").parquet(f"{folder}/{n}")

    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    add(one, 0), add(one, 1), add(two, 0)
    _, whole = run(pairs_of(one), f"{tmp_path}/a", f"{tmp_path}/a-out")
    run(pairs_of(two), f"{tmp_path}/b", f"{tmp_path}/b-out")
    add(two, 1)
    _, restarted = run(pairs_of(two), f"{tmp_path}/b", f"{tmp_path}/b-out")
    same_rows(matched(restarted), matched(whole))
    assert matched(whole).filter("car_plate_start = 'busy'").count() > 10


def test_pair_sink_gives_average_violations_and_the_drop_log(spark, tmp_path):
    paths = [
        inbox(tmp_path / "1", 1, [[("a", "P", "08:00:00"), ("x", "L", "08:00:00"), ("n", "N", "12:00:00")]]),
        inbox(tmp_path / "2", 2, [[("b", "P", "08:00:30"), ("y", "M", "08:00:00"), ("o", "N", "12:00:00")]]),
        inbox(tmp_path / "3", 3, [[("c", "P", "08:01:00"), ("m", "N", "12:00:00")]], limit=90, distance=0),
    ]
    fixed = F.lit("2024-01-02 00:00:00").cast("timestamp")

    def detect():
        return jobs.start_pairs(
            [stream(spark, p) for p in paths], [33, 40], f"{tmp_path}/store",
            f"{tmp_path}/checkpoint", once=True, processed_at=fixed,
        )

    jobs.finish(detect())
    first = read_violations(spark, f"{tmp_path}/store/average").collect()
    assert sorted((r.car_plate, r.camera_id_end, r.speed_reading) for r in first if r.car_plate == "P") == [
        ("P", 2, 120.0), ("P", 3, 120.0),
    ]
    log = store.latest_dropped(sinks.read_dropped(spark, f"{tmp_path}/store/dropped")).collect()
    # The middle camera's lone sighting is lone in both segments and logged once.
    assert sorted((r.event_id, r.camera_id) for r in log) == [("x", 1), ("y", 2)]
    jobs.finish(detect())
    assert len(read_violations(spark, f"{tmp_path}/store/average").collect()) == len(first)


def test_a_silent_camera_holds_back_its_own_segments_alone(spark, tmp_path):
    paths = [
        inbox(tmp_path / "1", 1, [[("lone", "L", "08:00:00"), ("n", "N", "12:00:00")]]),
        inbox(tmp_path / "2", 2, [[("o", "N", "12:00:00")]]),
        inbox(tmp_path / "3", 3, [[("old", "O", "01:00:00")]], limit=90, distance=0),
    ]
    for form, wanted in ((jobs.start_pairs, set()), (jobs.start_segments, {"lone"})):
        folder = f"{tmp_path}/{form.__name__}"
        queries = form([stream(spark, p) for p in paths], [33, 40], folder, f"{folder}/checkpoint", once=True)
        jobs.finish(*(queries if isinstance(queries, list) else [queries]))
        log = sinks.read_dropped(spark, f"{folder}/dropped")
        assert {r.event_id for r in log.collect()} - {"old"} == wanted
        # Both segments' batches are kept apart: the trip of N is in the store.
        assert read_violations(spark, f"{folder}/average").filter("car_plate = 'N'").count() == 1


def test_state_holds_what_may_still_pair(spark, tmp_path):
    start = inbox(tmp_path / "start", 1, [[("a", "X", "10:00:00"), ("b", "Y", "11:29:30")], [("c", "Z", "12:00:00")]])
    end = inbox(tmp_path / "end", 2, [[("d", "X", "10:00:10"), ("e", "W", "11:29:59")], [("f", None, "12:00:00")]])
    frames = [jobs.watermarked(stream(spark, path)) for path in (start, end)]
    run(segment_pairs(*frames, 33), tmp_path, f"{tmp_path}/out")
    left, right = (side.count() for side in jobs.join_state(spark, f"{tmp_path}/checkpoint"))
    # The watermark is 11:30: a start may pair for 33 s more, an end has seen all that could be its start.
    assert (left, right) == (2, 0)


def test_instant_detection_keeps_late_rows(spark, tmp_path):
    path = inbox(tmp_path / "in", 1, [
        [("a", "P", "12:00:00")], [("b", "Q", "14:00:00")], [("late", "R", "03:00:00")],
    ])
    jobs.finish(jobs.start_instant([stream(spark, path)], f"{tmp_path}/store", f"{tmp_path}/cp", once=True))
    got = read_violations(spark, f"{tmp_path}/store/instant")
    assert {r.car_plate for r in got.collect()} == {"P", "Q", "R"}


def test_live_stream_gives_out_bins_that_the_watermark_has_passed(spark, tmp_path):
    path = inbox(tmp_path / "in", 1, [
        [("a", "P", "08:00:00"), ("b", "P", "08:04:59"), ("c", "P", "08:05:00"), ("d", "P", "08:40:00")],
    ])
    rows = arrivals(instant_records(instant_violations(stream(spark, path))))
    _, got = run(jobs.live_stream(rows), tmp_path, f"{tmp_path}/out")
    table = spark.read.schema(SIGHTING).parquet(path)
    whole = bin_statistics(arrivals(instant_records(instant_violations(table))))
    same_rows(got, whole.filter("minute(start_time) < 10"))


def test_live_sink_refreshes_from_the_store(spark, tmp_path):
    root = f"{tmp_path}/instant"
    flagged = instant_violations(camera(spark, 1, [("a", "P", at("08:00:00"), 120.0)]))
    sinks.instant_sink(root)(flagged, 0)
    out, since = f"{tmp_path}/live", F.lit("2024-01-01 00:00:00").cast("timestamp")
    refresh = sinks.live_sink([root], out, since)
    refresh(flagged, 0)
    refresh(flagged, 0)
    assert [r.total_violations for r in sinks.live_view(spark, out).collect()] == [1]
    assert sinks.live_mark(spark, out).first().next_since.year > 2024
    more = instant_violations(camera(spark, 1, [("b", "Q", at("08:00:01"), 125.0)]))
    sinks.in_turn(sinks.instant_sink(root), refresh)(more, 1)
    assert [r.total_violations for r in sinks.live_view(spark, out).collect()] == [2]
    first, second = sinks.live_mark(spark, out, before=1).first(), sinks.live_mark(spark, out).first()
    assert second.since == first.next_since < second.next_since


def test_a_refresh_reads_and_replaces_the_days_of_its_batch_alone(spark, tmp_path):
    root, out = f"{tmp_path}/instant", f"{tmp_path}/live"
    refresh = sinks.live_sink([root], out, F.lit("2024-01-01 00:00:00").cast("timestamp"))
    sink = sinks.in_turn(sinks.instant_sink(root), refresh)
    days = ["2024-01-01", "2024-01-02", "2024-01-03"]
    for number, day in enumerate(days):
        times = [at(f"{day} 08:{m:02d}:00") for m in range(0, 60, 3)]
        sink(instant_violations(camera(spark, 1, [(f"{day}{t}", "P", t, 111.0 + i) for i, t in enumerate(times)])), number)
    # Whatever becomes of the other days' rows, a refresh of the last day does not look at them.
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "live" / "bins").rglob("*.parquet") if days[2] not in str(p)}
    for file in (tmp_path / "instant" / f"date={days[0]}").rglob("*.parquet"):
        file.write_bytes(b"gone")
    sink(instant_violations(camera(spark, 1, [("late", "P", at(f"{days[2]} 08:58:00"), 150.0)])), 3)
    assert len(before) == 2 and all(p.stat().st_mtime_ns == t for p, t in before.items())
    got = sinks.live_view(spark, out)
    table = read_violations(spark, root, start=days[1])
    wanted = live_statistics(arrivals(store.distinct_violations(table)))
    rounded = F.round("avg_speed", 8).alias("avg_speed")
    same_rows(*(f.select(*[c for c in f.columns if c != "avg_speed"], rounded) for f in (got, wanted)))
    assert got.count() == 12


def test_a_failing_sink_fails_the_query(spark, tmp_path):
    path = inbox(tmp_path / "in", 1, [[("a", "P", "12:00:00")]])

    def broken(rows, batch):
        raise ValueError("store is down")

    with pytest.raises(Exception, match="store is down"):
        jobs.finish(jobs.start(stream(spark, path), broken, f"{tmp_path}/cp", once=True))


def test_state_settings_leave_choices_of_the_session_alone(spark):
    key = "spark.sql.streaming.join.stateFormatVersion"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "2")
    jobs.prepare(spark)
    assert spark.conf.get(key) == "2"
    spark.conf.unset(key) if before is None else spark.conf.set(key, before)
