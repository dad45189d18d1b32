"""Every operator as a named query over the given tables."""

from pyspark.sql import functions as F

from roadwatch.functions.messages import utf8
from roadwatch.functions.speed import boundary_column
from roadwatch.operators import dimensions, hotspots, live, pairing, records, series, store
from roadwatch.operators.detection import instant_violations
from roadwatch.plans import bindings as b
from roadwatch.schemas import CAMERA
from roadwatch.session import shared_folder
from roadwatch.sources import messages
from roadwatch.sources.batches import read_batches, write_batch
from roadwatch.sources.tables import (
    append_history,
    read_cameras,
    read_historic,
    read_vehicles,
    read_violations,
    save_table,
)
from roadwatch.streaming import jobs, sinks

RANGE = ("2024-01-05", "2024-01-25")
THRESHOLD = 10
SINCE = "2024-01-20 00:00:00"
AS_OF = "2025-01-16 00:00:00"
EXPIRY = "2025-01-16 12:00:00"
SERIES_BIN = 21_600


def _since():
    return F.lit(SINCE).cast("timestamp")


# --- messages ----------------------------------------------------------------


def _published(spark, sf_dir):
    """All events as messages. Signups lack a batch, which keeps them from being published."""
    events = b.table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    day = F.datediff(F.col("ts"), F.lit(b.FIRST_DAY).cast("date"))
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(F.col("event_type") != "signup", day).alias("batch_id"),
        F.col("user_id").cast("string").alias("car_plate"),
        F.lit(1).alias("camera_id"),
        ts.alias("timestamp"),
        F.col("value").alias("speed_reading"),
        (ts + F.expr("interval 5 seconds")).alias("processed_at"),
        F.col("event_type"),
    )


def _envelopes(events, topic):
    return messages.encode(
        events,
        {
            "producer_id": F.lit(1),
            "speed_limit": F.lit(110),
            "dist_next": F.lit(1),
            "processing_timestamp": F.col("processed_at"),
        },
        topic,
    )


def _damaged(spark, sf_dir):
    """Messages damaged on the way: signups lose a header, errors are garbled."""
    sent = _envelopes(_published(spark, sf_dir), F.col("event_type"))
    garbled = F.col("topic") == "error"
    no_number = F.transform(
        "headers",
        lambda h: F.when(
            h["key"].isin("speed_limit", "processing_timestamp"),
            F.struct(h["key"].alias("key"), F.encode(F.lit("n/a"), "UTF-8").alias("value")),
        ).otherwise(h),
    )
    return sent.withColumns(
        {
            "value": F.when(garbled, F.encode(F.lit('{"event_id": '), "UTF-8")).otherwise(
                F.col("value")
            ),
            "headers": F.when(garbled, no_number)
            .when(
                F.col("topic") == "signup",
                F.filter("headers", lambda h: h["key"] != "dist_next"),
            )
            .otherwise(F.col("headers")),
        }
    )


def envelope_decode(spark, sf_dir):
    """Decoding, of sound and of damaged messages."""
    return b.presentable(messages.decode(_damaged(spark, sf_dir)))


def envelope_rejects(spark, sf_dir):
    """Messages per topic and reasons; those without any are accepted, the others dead letters."""
    received = _damaged(spark, sf_dir)
    both = messages.rejected(received).unionByName(
        messages.accepted(received).withColumn("reasons", F.array().cast("array<string>"))
    )
    return both.groupBy("topic", F.array_join("reasons", "; ").alias("reasons")).agg(F.count("*").alias("n_messages"))


def envelope_roundtrip(spark, sf_dir):
    ordered = messages.in_publish_order(_published(spark, sf_dir))
    sent = _envelopes(ordered, F.concat(F.lit("camera_"), F.col("event_type")))
    return sent.select(
        utf8(F.col("key")).alias("message_key"),
        utf8(F.col("value")).alias("message_value"),
        F.array_join(
            F.transform("headers", lambda h: F.concat(h["key"], F.lit("="), utf8(h["value"]))),
            ";",
        ).alias("message_headers"),
        "topic",
    )


# --- dimensions and history --------------------------------------------------


def camera_dim(spark, sf_dir):
    """Cameras from a CSV file, saved as a dimension, with the number of their sightings."""
    folder = shared_folder(spark, "cameras")
    b.cameras(spark).write.csv(f"{folder}/csv", header=True)
    save_table(read_cameras(spark, f"{folder}/csv"), f"{folder}/cameras")
    cameras = spark.read.schema(CAMERA).parquet(f"{folder}/cameras")
    seen = b.sightings(spark, sf_dir).groupBy(F.col("camera_id").alias("id")).agg(
        F.count("*").alias("sightings")
    )
    return dimensions.with_id(cameras, "camera_id").join(seen, "id", "left")


def _latest_vehicles(spark, sf_dir):
    return dimensions.latest_vehicles(
        b.vehicles(spark, sf_dir), order=("registration_date", "entry")
    )


def vehicle_latest(spark, sf_dir):
    return b.presentable(_latest_vehicles(spark, sf_dir))


def vehicle_deregister(spark, sf_dir):
    kept = dimensions.without_deregistered(
        _latest_vehicles(spark, sf_dir), b.deregistered(spark, sf_dir)
    )
    return b.presentable(kept)


def violation_owner(spark, sf_dir):
    violations = b.stored_stream(spark, sf_dir)
    owned = dimensions.with_owner(violations, _latest_vehicles(spark, sf_dir))
    return b.presentable(owned)



def violation_owner_bucketed(spark, sf_dir):
    """The same from two tables in buckets of plates."""
    folder = shared_folder(spark, "buckets")
    unique = folder.rsplit("-", 1)[1]
    violations, vehicles = (
        dimensions.save_by_plate(rows, f"{name}_{unique}", f"{folder}/{name}", 8)
        for name, rows in (("violations", b.stored_stream(spark, sf_dir)), ("vehicles", _latest_vehicles(spark, sf_dir)))
    )
    # Whatever their size, the buckets are joined as they lie there.
    return b.presentable(dimensions.with_owner(violations, vehicles.hint("merge")))


def historic_load(spark, sf_dir):
    return b.presentable(records.historic_records(b.historic_rows(spark, sf_dir)))


def orphan_cameras(spark, sf_dir):
    known = b.cameras(spark).filter(F.col("position") < 154)
    return dimensions.orphan_cameras(b.stream_records(spark, sf_dir), known)


def camera_bounds(spark, sf_dir):
    """Bounds of the cameras that have violations."""
    used = b.stream_records(spark, sf_dir).select(F.col("camera_id_end").alias("camera_id"))
    return dimensions.bounds(b.cameras(spark).join(used.distinct(), "camera_id", "left_semi"))


def unique_key_check(spark, sf_dir):
    """Repeated plates in the raw register, and repeated days among the documents (none)."""
    plates = dimensions.repeated_keys(b.vehicles(spark, sf_dir), ["car_plate"]).select(
        F.lit("vehicle").alias("entity"), "car_plate", F.lit(None).cast("date").alias("date"), "copies"
    )
    documents = store.daily_documents(b.stored(spark, sf_dir))
    days = dimensions.repeated_keys(documents, ["car_plate", "date"]).select(
        F.lit("document").alias("entity"), "car_plate", "date", "copies"
    )
    return plates.unionByName(days)


# --- detection ---------------------------------------------------------------


def instant_violation(spark, sf_dir):
    return b.presentable(
        b.instants(spark, sf_dir).select(
            "event_id", "car_plate", "camera_id", "timestamp", "speed_reading", "speed_limit"
        )
    )


def segment_boundary(spark, sf_dir):
    """Time at the limit of the camera, for a distance that varies by sighting."""
    distance = F.col("speed_reading") * F.lit(0.1)
    return b.sightings(spark, sf_dir).select(
        "event_id",
        boundary_column(F.col("dist_next"), F.col("speed_limit")).alias("window_seconds"),
        boundary_column(distance, F.col("speed_limit")).alias("boundary_seconds"),
    )


def segment_full_outer(spark, sf_dir):
    first, second, _ = b.events_by_camera(spark, sf_dir)
    return b.presentable(pairing.segment_pairs(first, second, b.WINDOWS[0]))


def segment_match(spark, sf_dir):
    first, second, _ = b.events_by_camera(spark, sf_dir)
    pairs = pairing.segment_pairs(first, second, b.WINDOWS[0], keep="matched")
    return b.presentable(pairing.as_trips(pairs))


def segment_chain(spark, sf_dir):
    """All segments in one join, from a segment table."""
    return b.presentable(b.pairs(spark, sf_dir))


def average_violation(spark, sf_dir):
    """A one-day window, of which only trips within the six hours at the limit violate it."""
    return b.presentable(b.averages(spark, sf_dir, windows=[86_400, 86_400]))


def dropped_pairs(spark, sf_dir):
    """One row per segment that a sighting found no partner in."""
    return b.presentable(b.dropped(spark, sf_dir))


def retention_filter(spark, sf_dir):
    log = store.latest_dropped(b.dropped(spark, sf_dir))
    return b.presentable(store.retained(log, F.lit(AS_OF).cast("timestamp")))


# --- sinks -------------------------------------------------------------------


def violation_upsert(spark, sf_dir):
    """Both sinks; the average violations come again in a later batch, as after a restart."""
    root = shared_folder(spark, "violations")
    later = F.lit("2024-03-01 00:00:00").cast("timestamp")
    sinks.instant_sink(f"{root}/instant", b.processed("timestamp"))(b.instants(spark, sf_dir), 0)
    sinks.average_sink(f"{root}/average", b.processed("timestamp_end"))(b.averages(spark, sf_dir), 0)
    again = read_violations(spark, f"{root}/average").withColumn("updated_at", later)
    write_batch(again, f"{root}/average", 1, ["date"])
    stored = read_violations(spark, f"{root}/instant", f"{root}/average")
    return b.presentable(store.distinct_violations(stored))


def store_life_cycle(spark, sf_dir):
    """Batches, a compaction of them, one batch more, and one that runs again."""
    root = shared_folder(spark, "cycle")
    records = b.stored_stream(spark, sf_dir)
    day = F.datediff("date", F.lit(b.FIRST_DAY).cast("date"))
    for batch in (0, 1):
        write_batch(records.filter(F.pmod(day, F.lit(3)) == batch), root, batch, ["date"])
    sinks.compact_violations(spark, root)
    last = records.filter(F.pmod(day, F.lit(3)) == 2)
    write_batch(last.limit(1), root, 2, ["date"])
    write_batch(last, root, 2, ["date"])
    return b.presentable(read_violations(spark, root))


def dropped_pairs_log(spark, sf_dir):
    """The drop log; an event that is lone in two segments is one row."""
    root = shared_folder(spark, "dropped")
    sinks.dropped_sink(root, b.ingested())(b.pairs(spark, sf_dir, "unmatched"), 0)
    return b.presentable(store.latest_dropped(sinks.read_dropped(spark, root)))


def retention_drop(spark, sf_dir):
    """The drop log after the days beyond retention are deleted: what is left, and how many days went."""
    root = shared_folder(spark, "expiring")
    sinks.dropped_sink(root, b.ingested())(b.pairs(spark, sf_dir, "unmatched"), 0)
    gone = sinks.expire_dropped(spark, root, EXPIRY)
    left = store.latest_dropped(sinks.read_dropped(spark, root))
    return b.presentable(left.withColumn("days_gone", F.lit(gone).cast("long")))


# --- documents ---------------------------------------------------------------


def daily_document(spark, sf_dir):
    """One row per car and day, its violations rendered as text in time order."""
    documents = store.daily_documents(b.stored(spark, sf_dir))
    text = F.transform(
        "violations",
        lambda v: F.concat_ws(
            "|",
            F.date_format(v["timestamp_end"], "yyyy-MM-dd HH:mm:ss.SSSSSS"),
            v["type"],
            F.coalesce(v["camera_id_start"].cast("string"), F.lit("-")),
            v["camera_id_end"].cast("string"),
            v["origin"],
        ),
    )
    return b.presentable(
        documents.select(
            "car_plate",
            "date",
            F.size("violations").cast("bigint").alias("entries"),
            F.array_join(text, ";").alias("violations"),
            "updated_at",
        )
    )


def daily_explode(spark, sf_dir):
    """Documents back to rows, empty ones kept: customers' cars without any violation."""
    documents = store.daily_documents(b.stored(spark, sf_dir))
    no_entries = documents.schema["violations"].dataType
    quiet = b.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("quiet-"), F.col("c_custkey").cast("string")).alias("car_plate"),
        F.lit("2024-01-01").cast("date").alias("date"),
        F.lit(None).cast(no_entries).alias("violations"),
        F.lit(None).cast("timestamp").alias("updated_at"),
    )
    documents = documents.drop("part").unionByName(quiet)
    dropping = store.entries_of(documents).select(
        F.lit("drop empty").alias("mode"), *_ENTRY_COLUMNS
    )
    keeping = store.entries_of(documents, keep_empty=True).select(
        F.lit("keep empty").alias("mode"), *_ENTRY_COLUMNS
    )
    return b.presentable(dropping.unionByName(keeping))


_ENTRY_COLUMNS = ["car_plate", "date", "type", "camera_id_start", "camera_id_end",
                  "timestamp_start", "timestamp_end", "origin"]


# --- live view ---------------------------------------------------------------


def changed_documents(spark, sf_dir):
    return b.presentable(live.changed_documents(b.stored(spark, sf_dir), _since()))


def _live_rows(spark, sf_dir):
    return live.arrivals(live.changed_documents(b.stored(spark, sf_dir), _since()))


def trailing_hour(spark, sf_dir):
    return b.presentable(live.trailing_hour(_live_rows(spark, sf_dir), horizon_seconds=43_200))


def live_stats(spark, sf_dir):
    stats = live.live_statistics(_live_rows(spark, sf_dir), horizon_seconds=43_200)
    return b.presentable(stats.withColumn("avg_speed", F.round("avg_speed", 8)))


def high_water_mark(spark, sf_dir):
    rows = live.arrivals(live.changed_documents(b.stored(spark, sf_dir), _since()))
    return b.presentable(live.high_water_mark(rows, _since()))


# --- series ------------------------------------------------------------------


def _points(spark, sf_dir):
    """The shaded series: counts of both types and the speed of instant violations."""
    rows = live.arrivals(b.stream_records(spark, sf_dir))
    stats = live.bin_statistics(rows, bin_seconds=SERIES_BIN).withColumn(
        "avg_speed", F.round("avg_speed", 8)
    )
    points = series.long_form(stats, ["total_violations", "avg_speed"])
    return points.filter((F.col("measure") != "avg_speed") | (F.col("type") == "instant"))


_SERIES = ["camera_id", "type", "measure"]


def series_peak_low(spark, sf_dir):
    points = _points(spark, sf_dir)
    return b.presentable(series.peak_and_low(points, _SERIES, "start_time", "value"))


def series_spikes(spark, sf_dir):
    flagged = series.spikes_and_drops(_points(spark, sf_dir), _SERIES, "start_time", "value")
    return b.presentable(
        flagged.withColumns(
            {"diff": F.round("diff", 6), "threshold": F.round("threshold", 6)}
        )
    )


# --- hotspots ----------------------------------------------------------------


def _rounded(rows):
    return rows.withColumn("exceeded_speed", F.round("exceeded_speed", 6))


def hourly_camera_stats(spark, sf_dir):
    return _rounded(hotspots.hourly_camera_stats(b.stored_stream(spark, sf_dir, *RANGE), *RANGE))


def hourly_segment_stats(spark, sf_dir):
    return _rounded(hotspots.hourly_segment_stats(b.stored_stream(spark, sf_dir, *RANGE), *RANGE))


def hotspot_cells(spark, sf_dir):
    return hotspots.hotspots(
        b.stored_stream(spark, sf_dir, *RANGE), b.cameras(spark), *RANGE, threshold=THRESHOLD
    )


def segment_midpoint(spark, sf_dir):
    return hotspots.segment_hotspots(b.stored_stream(spark, sf_dir, *RANGE), b.cameras(spark), *RANGE)


# --- streams -----------------------------------------------------------------


def _run(spark, name, rows, sink):
    checkpoint = shared_folder(spark, f"{name}-checkpoint")
    return jobs.finish(jobs.start(rows, sink, checkpoint, once=True))


def segment_full_outer_stream(spark, sf_dir):
    root = shared_folder(spark, "pairs")
    first, second, _ = b.camera_frames(b.event_stream(spark, sf_dir))
    pairs = pairing.segment_pairs(
        jobs.watermarked(first),
        jobs.watermarked(second),
        b.WINDOWS[0],
    )
    _run(spark, "pairs", pairs, lambda rows, batch: write_batch(rows, root, batch))
    return b.presentable(read_batches(spark, root, pairs.schema))


def segment_chain_stream(spark, sf_dir):
    """One query for both outputs: average violations and the drop log."""
    root = shared_folder(spark, "chain")
    checkpoint = shared_folder(spark, "chain-checkpoint")
    frames = b.camera_frames(b.event_stream(spark, sf_dir))
    fixed = F.lit("2024-03-01 00:00:00").cast("timestamp")
    jobs.finish(
        jobs.start_pairs(
            frames,
            b.WINDOWS,
            root,
            checkpoint,
            once=True,
            processed_at=fixed,
        )
    )
    average = store.distinct_violations(read_violations(spark, f"{root}/average")).select(
        F.lit("average").alias("output"),
        F.lit(None).cast("string").alias("event_id"),
        "car_plate",
        "camera_id_start",
        F.col("camera_id_end").alias("camera_id"),
        "timestamp_start",
        F.col("timestamp_end").alias("timestamp"),
        "speed_reading",
    )
    dropped = store.latest_dropped(sinks.read_dropped(spark, f"{root}/dropped")).select(
        F.lit("dropped").alias("output"),
        "event_id",
        "car_plate",
        F.lit(None).cast("int").alias("camera_id_start"),
        "camera_id",
        F.lit(None).cast("timestamp").alias("timestamp_start"),
        "timestamp",
        F.lit(None).cast("double").alias("speed_reading"),
    )
    return b.presentable(average.unionByName(dropped))


def instant_violation_stream(spark, sf_dir):
    """The whole way of a message: encoded, kept as files, streamed, decoded, judged, stored."""
    folder = shared_folder(spark, "instant")
    sent = b.sightings(spark, sf_dir)
    headers = {name: F.col(name) for name in
               ("producer_id", "speed_limit", "dist_next", "processing_timestamp")}
    topic = F.concat(F.lit("camera_event_"), F.col("camera_id").cast("string"))
    messages.publish_files(messages.encode(sent, headers, topic), f"{folder}/topics")
    frames = [
        messages.decode(
            messages.envelope_stream(spark, f"{folder}/topics/topic=camera_event_{camera}")
        )
        for camera in b.EVENT_TYPES
    ]
    jobs.finish(
        jobs.start_instant(
            frames,
            folder,
            f"{folder}/checkpoint",
            once=True,
            processed_at=F.lit("2024-03-01 00:00:00").cast("timestamp"),
        )
    )
    stored = read_violations(spark, f"{folder}/instant")
    return b.presentable(store.distinct_violations(stored))


def live_stats_stream(spark, sf_dir):
    root = shared_folder(spark, "live")
    flagged = instant_violations(*b.camera_frames(b.event_stream(spark, sf_dir)))
    rows = live.arrivals(records.instant_records(flagged))
    stats = jobs.live_stream(rows, bin_seconds=SERIES_BIN)
    _run(spark, "live", stats, lambda rows, batch: write_batch(rows, root, batch))
    stored = read_batches(spark, root, stats.schema)
    return b.presentable(stored.withColumn("avg_speed", F.round("avg_speed", 8)))


def live_refresh_stream(spark, sf_dir):
    """Instant violations into the store in several batches, and the live view refreshed behind each."""
    folder = shared_folder(spark, "refresh")
    events = b.table(spark, sf_dir, "events")
    events.repartitionByRange(3, "ts").write.parquet(f"{folder}/events")
    reader = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
    flagged = instant_violations(*b.camera_frames(reader.parquet(f"{folder}/events")))
    fixed = F.lit("2024-03-01 00:00:00").cast("timestamp")
    sink = sinks.in_turn(
        sinks.instant_sink(f"{folder}/instant", fixed),
        sinks.live_sink([f"{folder}/instant"], f"{folder}/live", _since()),
    )
    _run(spark, "refresh", flagged, sink)
    view = sinks.live_view(spark, f"{folder}/live")
    return b.presentable(view.withColumn("avg_speed", F.round("avg_speed", 8)))


def _late_uploads(spark, sf_dir):
    """Sightings that arrive in uploads of 15 days, slow cars' one upload late; each upload is one run.

    Returns the pairs that came out, and the reports of all runs.
    """
    folder = shared_folder(spark, "late")
    upload = F.floor(F.col("batch_id") / F.lit(15)) + F.when(
        F.col("speed_reading") < 20, 1
    ).otherwise(0)
    frames = b.events_by_camera(spark, sf_dir)[:2]
    schema, inboxes = frames[0].schema, [f"{folder}/start", f"{folder}/end"]
    staged = []
    for inbox, frame in zip(inboxes, frames, strict=True):
        frame.withColumn("upload", upload.cast("int")).write.partitionBy("upload").parquet(f"{inbox}-staged")
        staged.append(spark.read.parquet(f"{inbox}-staged"))
    pairs, progress = None, []
    numbers = staged[0].select("upload").union(staged[1].select("upload")).distinct().orderBy("upload").collect()
    for (number,) in numbers:
        for inbox, rows in zip(inboxes, staged, strict=True):
            rows.filter(F.col("upload") == number).select(*schema.names).write.mode("append").parquet(inbox)
        streams = [jobs.watermarked(spark.readStream.schema(schema).parquet(inbox)) for inbox in inboxes]
        pairs = pairing.segment_pairs(*streams, b.WINDOWS[0])
        sink = lambda rows, batch: write_batch(rows, f"{folder}/pairs", batch)
        progress += jobs.finish(jobs.start(pairs, sink, f"{folder}/checkpoint", once=True))[0]
    return read_batches(spark, f"{folder}/pairs", pairs.schema), progress


def late_rows_stream(spark, sf_dir):
    """What comes in behind the watermark is left out of pairs and drop log alike."""
    return b.presentable(_late_uploads(spark, sf_dir)[0])


def late_count_stream(spark, sf_dir):
    """How many sightings came in behind the watermark, by the queries' own reports."""
    late = jobs.late_rows(_late_uploads(spark, sf_dir)[1])
    return spark.range(1).select(F.lit(late).cast("long").alias("late_rows"))


def state_rows_stream(spark, sf_dir):
    """Sightings per side that the pair query still holds when its input is used up."""
    checkpoint, root = shared_folder(spark, "held-checkpoint"), shared_folder(spark, "held")
    first, second, _ = b.camera_frames(b.event_stream(spark, sf_dir))
    pairs = pairing.segment_pairs(jobs.watermarked(first), jobs.watermarked(second), b.WINDOWS[0])
    jobs.finish(jobs.start(pairs, lambda rows, batch: write_batch(rows, root, batch), checkpoint, once=True))
    return pairing.union_all(
        [side.groupBy("side").agg(F.count("*").alias("held")) for side in jobs.join_state(spark, checkpoint)]
    )


def silent_camera_stream(spark, sf_dir):
    """Lone sightings at the first camera when the third fell silent: one query for all, and one per segment."""
    found = []
    for form, begin in (("joint", jobs.start_pairs), ("per segment", jobs.start_segments)):
        folder = shared_folder(spark, "silent")
        first, second, third = b.camera_frames(b.event_stream(spark, sf_dir))
        frames = [first, second, third.filter(F.col("timestamp") < F.lit(SINCE).cast("timestamp"))]
        queries = begin(frames, b.WINDOWS, folder, f"{folder}/checkpoint", once=True)
        jobs.finish(*(queries if isinstance(queries, list) else [queries]))
        log = store.latest_dropped(sinks.read_dropped(spark, f"{folder}/dropped")).filter("camera_id = 1")
        found.append(log.agg(F.count("*").alias("lone_rows")).select(F.lit(form).alias("form"), "lone_rows"))
    return pairing.union_all(found)


# --- bootstrap ---------------------------------------------------------------


def bootstrap_vehicles(spark, sf_dir):
    """The register from a CSV file to the saved dimension, loaded twice."""
    folder = shared_folder(spark, "register")
    raw = b.vehicles(spark, sf_dir).filter("car_plate IS NOT NULL")
    text = F.date_format("registration_date", "M/d/yyyy")
    raw.withColumn("registration_date", text).drop("entry").write.csv(f"{folder}/csv", header=True)
    for _ in range(2):
        register = read_vehicles(spark, f"{folder}/csv")
        latest = register.groupBy("car_plate").agg(
            F.max("registration_date").alias("registration_date"), F.count("*").alias("entries")
        )
        save_table(latest, f"{folder}/vehicles")
    return b.presentable(spark.read.schema(latest.schema).parquet(f"{folder}/vehicles"))


def bootstrap_history(spark, sf_dir):
    """History from a CSV file into the violation store beside a stream's rows; the load runs twice."""
    folder = shared_folder(spark, "history")
    b.historic_rows(spark, sf_dir).write.csv(f"{folder}/csv", header=True)
    root = f"{folder}/store"
    write_batch(b.stored_stream(spark, sf_dir), root, 0, ["date"])
    for _ in range(2):
        text = read_historic(spark, f"{folder}/csv")
        append_history(records.historic_records(text), root, 0)
    return b.presentable(read_violations(spark, root))


QUERIES = {
    "envelope_decode": envelope_decode,
    "envelope_rejects": envelope_rejects,
    "envelope_roundtrip": envelope_roundtrip,
    "camera_dim": camera_dim,
    "vehicle_latest": vehicle_latest,
    "historic_load": historic_load,
    "violation_upsert": violation_upsert,
    "store_life_cycle": store_life_cycle,
    "dropped_pairs_log": dropped_pairs_log,
    "retention_filter": retention_filter,
    "retention_drop": retention_drop,
    "instant_violation": instant_violation,
    "segment_match": segment_match,
    "average_violation": average_violation,
    "dropped_pairs": dropped_pairs,
    "segment_boundary": segment_boundary,
    "segment_full_outer": segment_full_outer,
    "segment_chain": segment_chain,
    "hotspots": hotspot_cells,
    "segment_midpoint": segment_midpoint,
    "hourly_camera_stats": hourly_camera_stats,
    "hourly_segment_stats": hourly_segment_stats,
    "changed_documents": changed_documents,
    "violation_owner": violation_owner,
    "violation_owner_bucketed": violation_owner_bucketed,
    "vehicle_deregister": vehicle_deregister,
    "orphan_cameras": orphan_cameras,
    "live_stats": live_stats,
    "trailing_hour": trailing_hour,
    "daily_document": daily_document,
    "daily_explode": daily_explode,
    "camera_bounds": camera_bounds,
    "high_water_mark": high_water_mark,
    "series_peak_low": series_peak_low,
    "series_spikes": series_spikes,
    "unique_key_check": unique_key_check,
    "segment_full_outer_stream": segment_full_outer_stream,
    "segment_chain_stream": segment_chain_stream,
    "late_rows_stream": late_rows_stream,
    "late_count_stream": late_count_stream,
    "state_rows_stream": state_rows_stream,
    "silent_camera_stream": silent_camera_stream,
    "instant_violation_stream": instant_violation_stream,
    "live_stats_stream": live_stats_stream,
    "live_refresh_stream": live_refresh_stream,
    "bootstrap_vehicles": bootstrap_vehicles,
    "bootstrap_history": bootstrap_history,
}
