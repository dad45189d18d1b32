from conftest import at, same_rows
from pyspark.sql import functions as F

from roadwatch.functions.times import mixed_timestamp
from roadwatch.operators import store
from roadwatch.operators.hotspots import hourly_camera_stats
from roadwatch.operators.records import (
    average_records,
    dropped_records,
    historic_records,
    instant_records,
    unparsed_history,
)
from roadwatch.schemas import DROPPED_PAIR, HISTORIC_RAW, VIOLATION
from roadwatch.sources.tables import append_history, read_historic, read_violations
from roadwatch.sources import batches
from roadwatch.streaming import sinks

DAY = at("2024-01-01 00:00:00").date()


def violation(plate="P", end="08:00:00", kind="instant", updated="09:00:00", origin="stream",
              speed=120.0, camera=1, start=None, day=DAY):
    first = camera - 1 if start else None
    return (plate, day, kind, first, camera, at(start) if start else None, at(end), speed,
            at(updated), origin)


def violations(spark, *rows):
    return spark.createDataFrame(rows, VIOLATION)


def test_a_pair_over_midnight_belongs_to_its_end_day_or_when_historic_to_its_start_day(spark):
    trip = spark.createDataFrame(
        [("P", 1, 2, at("23:59:50"), at("2024-01-02 00:00:15"), 140.0)],
        """car_plate string, camera_id_start int, camera_id_end int, timestamp_start timestamp,
        timestamp_end timestamp, average_speed double""",
    )
    streamed = average_records(trip).first()
    assert str(streamed.date) == "2024-01-02"
    assert (streamed.type, streamed.speed_reading, streamed.origin) == ("average", 140.0, "stream")
    text = spark.createDataFrame(
        [("P", 1, 2, "2024-01-01 23:59:50", "01/02/2024 00:00:15", 140.0)], HISTORIC_RAW
    )
    historic = historic_records(text).first()
    assert str(historic.date) == "2024-01-01"
    assert historic.updated_at == historic.timestamp_end
    assert (historic.type, historic.origin) == ("average", "historic")


def test_instant_records_have_no_start(spark):
    flagged = spark.createDataFrame(
        [("P", 2, at("08:00:00"), 130.0)],
        "car_plate string, camera_id int, timestamp timestamp, speed_reading double",
    )
    records = instant_records(flagged)
    row = records.first()
    assert records.columns == VIOLATION.fieldNames()
    assert (row.camera_id_start, row.timestamp_start, row.camera_id_end) == (None, None, 2)
    assert row.updated_at is not None


def test_historic_file(spark, tmp_path):
    path = tmp_path / "historic.csv"
    path.write_text(
        "car_plate,camera_id_start,camera_id_end,timestamp_start,timestamp_end,speed_reading\n"
        "A,1,2,2024-01-01T08:00:00,2024-01-01 08:00:30.5,120.5\n"
        "B,2,3,01/05/2024 08:00:00,01/05/2024 08:00:31,99\n"
    )
    rows = {r.car_plate: r for r in historic_records(read_historic(spark, str(path))).collect()}
    assert (rows["A"].timestamp_end - rows["A"].timestamp_start).total_seconds() == 30.5
    assert str(rows["B"].date) == "2024-01-05"


def test_the_same_violation_is_kept_once_with_its_first_write(spark):
    rows = violations(
        spark,
        violation(updated="09:00:00"),
        violation(updated="08:30:00"),
        violation(updated="08:30:00", speed=121.0),
        violation(updated="07:00:00", origin="historic"),
    )
    got = {(r.origin, r.speed_reading): r.updated_at.minute for r in
           store.distinct_violations(rows).collect()}
    assert got == {("stream", 120.0): 30, ("stream", 121.0): 30, ("historic", 120.0): 0}


def test_daily_document(spark):
    rows = violations(
        spark,
        violation(end="08:00:54", camera=3, updated="09:00:02"),
        violation(end="08:00:26", camera=2, kind="average", start="08:00:00", updated="09:00:09"),
        violation(end="08:00:00", updated="09:00:01"),
        violation(end="08:00:00", updated="09:00:05"),
        violation(plate="Q"),
    )
    documents = {r.car_plate: r for r in store.daily_documents(rows).collect()}
    document = documents["P"]
    assert [v.camera_id_end for v in document.violations] == [1, 2, 3]
    assert document.updated_at.second == 9
    assert document.violations[0].updated_at.second == 1
    assert len(documents["Q"].violations) == 1 and document.part == 0


def long_day(spark, entries):
    """One car with `entries` violations on a day and others with few."""
    return spark.range(2 * entries).selectExpr(
        "if(id % 2 = 0, 'busy', concat('p', id % 500)) AS car_plate",
        "DATE '2024-01-01' AS date", "'instant' AS type", "cast(NULL AS int) AS camera_id_start",
        "1 AS camera_id_end", "cast(NULL AS timestamp) AS timestamp_start",
        "timestamp_micros(1704067200000000 + id * 100000) AS timestamp_end", "120.0D AS speed_reading",
        "timestamp_micros(1704170000000000 + id) AS updated_at", "'stream' AS origin",
    )


def test_a_long_day_is_one_document(spark):
    documents = store.daily_documents(long_day(spark, 60_000))
    sizes = documents.select("car_plate", "part", F.size("violations").alias("n")).collect()
    assert len(sizes) == len({r.car_plate for r in sizes})
    assert [(r.part, r.n) for r in sizes if r.car_plate == "busy"] == [(0, 60_000)]


def test_parts_are_the_callers_choice(spark):
    plain = long_day(spark, 1000)
    documents = store.daily_documents(plain, parts=10)
    busy = [r.n for r in documents.filter("car_plate = 'busy'").select(F.size("violations").alias("n")).collect()]
    assert len(busy) == 10 and sum(busy) == 1000 and max(busy) < 200
    same_rows(store.entries_of(documents).drop("document_updated_at").select(plain.columns), plain)


def test_many_copies_of_one_violation_stay_one_entry(spark):
    rows = violations(spark, violation(), violation(plate="Q"))
    copies = rows.crossJoin(spark.range(300)).drop("id")
    documents = store.daily_documents(copies)
    assert sorted((r.car_plate, len(r.violations)) for r in documents.collect()) == [("P", 1), ("Q", 1)]


def test_empty_documents_survive_only_the_outer_explode(spark):
    documents = store.daily_documents(violations(spark, violation()))
    empty = documents.select(
        F.lit("E").alias("car_plate"), "date", "part",
        F.array().cast(documents.schema["violations"].dataType).alias("violations"), "updated_at",
    )
    both = documents.unionByName(empty)
    assert [r.car_plate for r in store.entries_of(both).collect()] == ["P"]
    kept = {r.car_plate: r.type for r in store.entries_of(both, keep_empty=True).collect()}
    assert kept == {"P": "instant", "E": None}


PAIR = """car_plate_start string, car_plate_end string, timestamp_start timestamp,
timestamp_end timestamp, camera_id_start int, camera_id_end int, event_id_start string,
event_id_end string"""


def test_dropped_side(spark):
    rows = [
        ("S", None, at("08:00:00"), None, 1, None, "s1", None),
        (None, "E", None, at("08:00:01"), None, 2, None, "e1"),
        ("S", None, at("08:00:02"), None, 1, None, "s2", ""),
        (None, "E", None, at("08:00:03"), None, 2, None, ""),
    ]
    got = dropped_records(spark.createDataFrame(rows, PAIR)).collect()
    assert [(r.event_id, r.car_plate, r.camera_id) for r in got] == [
        ("s1", "S", 1), ("e1", "E", 2), ("s2", "S", 1), (None, None, None),
    ]


def test_last_write_of_an_event_wins(spark):
    rows = spark.createDataFrame(
        [
            ("e", "OLD", 1, at("08:00:00"), at("09:00:00")),
            ("e", "NEW", 2, at("08:00:01"), at("09:30:00")),
            ("f", "F", 2, at("08:00:01"), at("09:30:00")),
        ],
        DROPPED_PAIR,
    )
    assert {r.event_id: r.car_plate for r in store.latest_dropped(rows).collect()} == {
        "e": "NEW", "f": "F",
    }


def test_retention_counts_from_ingestion(spark):
    rows = spark.createDataFrame(
        [
            ("old", "P", 1, at("08:00:00"), at("2023-01-01 07:59:59")),
            ("edge", "P", 1, at("08:00:00"), at("2023-01-01 08:00:00")),
        ],
        DROPPED_PAIR,
    )
    as_of = F.lit("2024-01-01 08:00:00").cast("timestamp")
    assert [r.event_id for r in store.retained(rows, as_of).collect()] == ["edge"]


def test_drop_log_reads_from_a_day_of_ingestion(spark, tmp_path):
    pairs = spark.createDataFrame(
        [("S", None, at("08:00:00"), None, 1, None, "s1", None),
         ("S", None, at("2024-01-02 08:00:00"), None, 1, None, "s2", None)], PAIR)
    sinks.dropped_sink(str(tmp_path), F.col("timestamp_start"))(pairs, 0)
    assert sinks.read_dropped(spark, str(tmp_path)).count() == 2
    late = sinks.read_dropped(spark, str(tmp_path), ingested_from="2024-01-02").collect()
    assert [r.event_id for r in late] == ["s2"]


def test_a_batch_that_runs_again_leaves_the_store_as_it_was(spark, tmp_path):
    root = str(tmp_path / "store")
    rows = violations(spark, violation(), violation(plate="Q", day=at("2024-01-02 00:00:00").date()))
    batches.write_batch(rows, root, 7, ["date"])
    before = read_violations(spark, root).collect()
    batches.write_batch(rows, root, 7, ["date"])
    assert sorted(read_violations(spark, root).collect()) == sorted(before)
    batches.write_batch(rows.withColumn("updated_at", F.current_timestamp()), root, 8, ["date"])
    same_rows(store.distinct_violations(read_violations(spark, root)), rows)


def test_range_reads_only_the_days_asked_for(spark, tmp_path):
    root = str(tmp_path / "store")
    days = [at(f"2024-01-0{d} 00:00:00").date() for d in (1, 2, 3)]
    batches.write_batch(violations(spark, *[violation(day=d) for d in days]), root, 0, ["date"])
    ranged = read_violations(spark, root, start="2024-01-01", end="2024-01-03")
    assert sorted(str(r.date) for r in ranged.collect()) == ["2024-01-01", "2024-01-02"]
    plan = ranged._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    hours = hourly_camera_stats(read_violations(spark, root, start="2024-01-01", end="2024-01-02"), "2024-01-01", "2024-01-02")
    assert "PartitionFilters: [isnotnull(date" in hours._jdf.queryExecution().toString()


def other_day(number):
    return at(f"2024-01-{number:02d} 00:00:00").date()


def test_compaction_replaces_what_it_has_read(spark, tmp_path):
    root = str(tmp_path / "store")
    rows = violations(spark, violation(), violation(plate="Q"), violation(plate="R", end="08:00:01"))
    batches.write_batch(rows, root, 0, ["date"])
    batches.write_batch(rows, root, 1, ["date"])
    sinks.compact_violations(spark, root)
    same_rows(read_violations(spark, root), rows)
    assert [p.name[:10] for p in (tmp_path / "store").glob("date=*/batch=*")] == ["batch=comp"]
    more = violations(spark, violation(plate="S", day=other_day(2)))
    batches.write_batch(more, root, 2, ["date"])
    batches.write_batch(rows, root, 1, ["date"])  # A batch that was compacted runs again: copies until the next time.
    whole = rows.unionByName(more)
    same_rows(store.distinct_violations(read_violations(spark, root)), store.distinct_violations(whole))
    sinks.compact_violations(spark, root)
    sinks.compact_violations(spark, root)
    same_rows(read_violations(spark, root), whole)
    assert len(list((tmp_path / "store").glob("date=*/batch=*"))) == 2
    batches.write_batch(more, root, 3, ["date"])
    assert read_violations(spark, root).count() == 5


def test_stores_without_rows(spark, tmp_path):
    root = str(tmp_path / "store")
    rows = violations(spark, violation())
    assert read_violations(spark, root).count() == 0
    batches.write_batch(rows.limit(0), root, 0, ["date"])
    assert read_violations(spark, root).count() == 0
    sinks.compact_violations(spark, root)
    batches.write_batch(rows, root, 1, ["date"])
    same_rows(read_violations(spark, root), rows)


def test_rows_without_a_day_are_kept(spark, tmp_path):
    root = str(tmp_path / "store")
    rows = violations(spark, violation()).unionByName(violations(spark, violation(plate="U")).withColumn("date", F.lit(None).cast("date")))
    batches.write_batch(rows, root, 0, ["date"])
    sinks.compact_violations(spark, root)
    same_rows(read_violations(spark, root), rows)


def test_a_batch_overwrites_its_own_partitions_only(spark, tmp_path):
    root = str(tmp_path / "store")
    day = at("2024-01-01 00:00:00").date()
    batches.write_batch(violations(spark, violation(day=day)), root, 0, ["date"])
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "store").rglob("*.parquet")}
    batches.write_batch(violations(spark, violation(plate="Q", day=day)), root, 1, ["date"])
    batches.write_batch(violations(spark, violation(plate="R", day=day)), root, 1, ["date"])
    assert sorted(r.car_plate for r in read_violations(spark, root).collect()) == ["P", "R"]
    assert all(p.stat().st_mtime_ns == t for p, t in before.items())


def test_latest_batch_of_a_writer(spark, tmp_path):
    root = str(tmp_path / "store")
    rows = spark.createDataFrame([("a",)], "name string")
    for batch in (2, 9, 10):
        batches.write_batch(rows.withColumn("name", F.lit(f"b{batch}")), root, batch)
    batches.write_batch(rows, root, 99, writer="other")
    assert [r.name for r in batches.read_latest(spark, root, rows.schema).collect()] == ["b10"]
    assert batches.read_latest(spark, f"{root}-none", rows.schema).count() == 0


def test_expired_days_of_the_drop_log_are_deleted(spark, tmp_path):
    root = tmp_path / "log"
    times = ["2023-01-01 07:00:00", "2023-01-02 07:00:00", "2023-01-03 07:00:00"]
    pairs = spark.createDataFrame([("S", None, at(t), None, 1, None, t, None) for t in times], PAIR)
    sinks.dropped_sink(str(root), F.col("timestamp_start"))(pairs, 0)
    kept = {p: p.stat().st_mtime_ns for p in root.glob("ingested_on=2023-01-0[23]/*/*.parquet")}
    assert len(kept) == 2
    assert sinks.expire_dropped(spark, str(root), "2024-01-02 12:00:00") == 1
    assert sorted(p.name for p in root.glob("ingested_on=*")) == ["ingested_on=2023-01-02", "ingested_on=2023-01-03"]
    assert {p: p.stat().st_mtime_ns for p in kept} == kept
    assert sorted(r.event_id for r in sinks.read_dropped(spark, str(root)).collect()) == times[1:]
    assert sinks.expire_dropped(spark, str(root), "2024-01-02 12:00:00") == 0
    assert sinks.expire_dropped(spark, f"{root}-none", "2024-01-02 12:00:00") == 0


def test_loads_of_history_and_batches_of_streams_are_numbered_apart(spark, tmp_path):
    root = str(tmp_path / "store")
    streamed, old = violations(spark, violation()), violations(spark, violation(origin="historic"))
    batches.write_batch(streamed, root, 0, ["date"])
    for _ in range(2):
        append_history(old, root, 0)
    same_rows(read_violations(spark, root), streamed.unionByName(old))


def test_times_in_many_forms(spark):
    forms = ["1/5/2024 8:00", "01/05/2024 08:00:00.123", "01/05/2024 08:00 PM", "5 Jan 2024 08:00", "2024-01-05 08:00:00",
             "January 5, 2024", "20240105 080000", "2024/1/5 8:00:01", "not a time", None]
    text = spark.createDataFrame([("P", 1, 2, f, f, 1.0) for f in forms], HISTORIC_RAW)
    hours = [r[0] for r in text.select(F.date_format(mixed_timestamp("timestamp_end"), "MM-dd HH:mm")).collect()]
    assert hours == ["01-05 08:00", "01-05 08:00", "01-05 20:00", "01-05 08:00", "01-05 08:00",
                     "01-05 00:00", "01-05 08:00", "01-05 08:00", None, None]
    assert [r.timestamp_end for r in unparsed_history(text).collect()] == ["not a time"]
