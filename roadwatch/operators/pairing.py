"""Pairing the sightings of a car at two cameras: a full outer interval join.

A start sighting pairs with every end sighting of the same car that follows it
within the window, both ends included. Sightings without a partner come out with
the other side NULL.

Streams use the native stream-stream join. Batch frames are cut into time
buckets first, so that no task ever holds all sightings of one plate:

* pairs come from an equi-join on (plate, segment, bucket), where an end sighting
  is copied into each bucket its window reaches;
* lone sightings need no pairs: the first and last times of a sighting's slot and of
  the neighbouring one, which combine before the shuffle, say whether it has a partner.
"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadwatch.functions.times import SECOND

PAIR_COLUMNS = [
    "car_plate_start",
    "car_plate_end",
    "timestamp_start",
    "timestamp_end",
    "camera_id_start",
    "camera_id_end",
    "event_id_start",
    "event_id_end",
    "dist_next",
    "speed_limit",
]

_SIGHTING = ["car_plate", "timestamp", "camera_id", "event_id"]


def union_all(frames):
    return reduce(DataFrame.unionByName, frames)


def segment_pairs(start, end, window_seconds, keep="all"):
    """Full outer pairs of two consecutive cameras; works on batch and streaming frames.

    `keep` is "all", "matched" or "unmatched"; a batch plan then holds only the
    part that is needed.
    """
    if start.isStreaming or end.isStreaming:
        pairs = stream_pairs(start, end, window_seconds)
        return {"all": lambda rows: rows, "matched": matched, "unmatched": unmatched}[keep](pairs)
    points = union_all(
        [
            _points(start, is_start=True, window=window_seconds),
            _points(end, is_start=False, window=window_seconds),
        ]
    )
    return _batch_pairs(points, bucket_seconds(window_seconds), keep).select(*PAIR_COLUMNS)


def chain_pairs(sightings, windows, keep="all"):
    """Pairs over cameras in road order; a middle camera ends one segment and starts the next.

    `sightings` has one frame per camera, `windows` one value per segment.
    """
    return union_all(
        segment_pairs(start, end, window, keep)
        for start, end, window in zip(sightings[:-1], sightings[1:], windows, strict=True)
    )


def network_pairs(sightings, segments, longest_window, keep="all"):
    """Batch pairs for any number of segments in one join, with the segment as first column.

    `segments` holds (segment, camera_id_start, camera_id_end, window), window in
    seconds and at most `longest_window`: a list of rows, or a table. The sightings are
    read once for all segments and are never shuffled by camera; the plan does not grow
    with the number of cameras, as it does in `chain_pairs`.
    """
    seen = sightings.select(*_SIGHTING, "dist_next", "speed_limit")
    points = _by_literal(seen, segments) if isinstance(segments, list) else _by_table(seen, segments)
    return _batch_pairs(points, bucket_seconds(longest_window), keep)


def _by_literal(seen, segments):
    """Sightings once per role of their camera, looked up in a map that is part of the plan."""
    roles = {}
    for segment, first, last, window in segments:
        for camera, is_start in ((first, True), (last, False)):
            role = F.struct(
                F.lit(segment).alias("segment"),
                F.lit(int(window)).alias("window"),
                F.lit(is_start).alias("is_start"),
            )
            roles.setdefault(camera, []).append(role)
    entries = [part for camera, found in roles.items() for part in (F.lit(camera), F.array(*found))]
    known = F.explode(F.try_element_at(F.create_map(*entries), F.col("camera_id")))
    return seen.select("*", known.alias("role")).select("*", "role.*").drop("role")


# A segment table of at most so many rows is broadcast; that is below 10 MB.
BROADCAST_SEGMENTS = 100_000
COPIES = 64


def _by_table(seen, segments):
    """Sightings once per role of their camera, joined with a table of segments.

    The table is broadcast after its rows have been counted up to a bound. A larger one is
    copied a few times, so that the shuffle has the plate in its key as well as the camera.
    """
    roles = segments.selectExpr(
        "segment", "window", "camera_id_start AS camera_id", "true AS is_start"
    ).unionByName(
        segments.selectExpr(
            "segment", "window", "camera_id_end AS camera_id", "false AS is_start"
        )
    )
    if segments.limit(BROADCAST_SEGMENTS + 1).count() <= BROADCAST_SEGMENTS:
        return seen.join(F.broadcast(roles), "camera_id")
    copied = roles.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    # Rows without a plate are dealt out by event.
    dealt = F.pmod(F.xxhash64(F.coalesce("car_plate", "event_id"), "timestamp"), F.lit(COPIES))
    return seen.withColumn("copy", dealt.cast("int")).join(copied, ["camera_id", "copy"]).drop("copy")


def bucket_seconds(window_seconds):
    """Bucket width: four windows, but no wider than an hour or one window.

    Wider buckets copy fewer rows, narrower ones split a busy plate further.
    """
    return max(int(window_seconds), min(4 * int(window_seconds), 3600), 1)


def matched(pairs):
    """Pairs with both sides present."""
    return pairs.filter("timestamp_start IS NOT NULL AND timestamp_end IS NOT NULL")


def as_trips(pairs):
    """The columns of matched pairs that detection needs, under one plate."""
    return pairs.selectExpr(
        "car_plate_start AS car_plate",
        "timestamp_start",
        "timestamp_end",
        "camera_id_start",
        "camera_id_end",
        "dist_next",
        "speed_limit",
    )


def unmatched(pairs):
    """Sightings without a partner."""
    return pairs.filter("timestamp_start IS NULL OR timestamp_end IS NULL")


# --- batch -------------------------------------------------------------------


def _points(sightings, is_start, window):
    """Sightings in one role of a segment; the other role's header stays NULL."""
    no_header = "cast(NULL AS int) AS"
    return sightings.selectExpr(
        *_SIGHTING,
        "dist_next" if is_start else f"{no_header} dist_next",
        f"{no_header} speed_limit" if is_start else "speed_limit",
        "0 AS segment",
        f"{int(window)} AS window",
        f"{str(is_start).lower()} AS is_start",
    )


def _batch_pairs(points, width, keep):
    points = points.selectExpr(
        "*", "unix_micros(timestamp) AS us", f"cast(window AS bigint) * {SECOND} AS reach"
    )
    width *= SECOND
    if keep == "matched":
        return _joined(points, width, "inner")
    if keep == "unmatched":
        return _lone(points)
    # A start is in one bucket only, so the join itself tells lone starts.
    return _joined(points, width, "left").unionByName(_lone(points, ends_only=True))


def _bucket(micros, width):
    """Start of the bucket, in microseconds, as SQL."""
    return f"({micros} - pmod({micros}, {width}L))"


def _buckets(first, last, width):
    """Starts of all buckets from one instant to another, as SQL."""
    return f"sequence({_bucket(first, width)}, {_bucket(last, width)}, {width}L)"


def _joined(points, width, how):
    def side(name, *columns):
        renamed = [f"{c} AS {c}_{name}" for c in ("segment", "us", *_SIGHTING)]
        kept = points.filter("is_start" if name == "start" else "NOT is_start")
        return kept.selectExpr(*renamed, *columns)

    starts = side("start", "dist_next", f"{_bucket('us', width)} AS bucket_start")
    ends = side(
        "end",
        "speed_limit",
        "reach",
        f"explode({_buckets('(us - reach)', 'us', width)}) AS bucket_end",
    )
    condition = """
        car_plate_start = car_plate_end AND segment_start = segment_end
        AND bucket_start = bucket_end AND us_start BETWEEN us_end - reach AND us_end
    """
    return starts.join(ends, F.expr(condition), how).selectExpr(
        "segment_start AS segment", *PAIR_COLUMNS
    )


def _lone(points, ends_only=False):
    """Points without a partner, or only the ends among them, without looking at pairs.

    A slot is as long as the window, so the partners of a point lie in its own slot or in one
    neighbour, and the first and last times there say exactly whether there are any. One
    aggregate, which combines copies and busy plates before its shuffle, and one left join.
    Points without a plate or a time cannot pair and find no slot.
    """
    key = ["car_plate", "segment", "slot"]
    slotted = points.selectExpr("*", "greatest(reach, 1L) AS slot_width").selectExpr(
        "*", "us - pmod(us, slot_width) AS slot"
    )
    # Starts count for their own slot and the next one, ends for their own and the one before.
    partners = slotted.filter("is_start") if ends_only else slotted
    asked = slotted.filter("NOT is_start") if ends_only else slotted
    seen = partners.filter("car_plate IS NOT NULL AND us IS NOT NULL").selectExpr(
        "car_plate", "segment", "us", "is_start",
        """inline(array(named_struct('slot', slot, 'own', true),
            named_struct('slot', slot + if(is_start, slot_width, -slot_width), 'own', false)))""",
    )
    times = {
        "first_start": "min(us) FILTER (WHERE is_start AND own)",
        "earlier_start": "max(us) FILTER (WHERE is_start AND NOT own)",
        "last_end": "max(us) FILTER (WHERE NOT is_start AND own)",
        "later_end": "min(us) FILTER (WHERE NOT is_start AND NOT own)",
    }
    summary = seen.groupBy(*key).agg(*[F.expr(sql).alias(name) for name, sql in times.items()])
    lone = asked.join(summary, key, "left").filter(
        """NOT coalesce(if(is_start, last_end >= us, first_start <= us), false)
           AND NOT coalesce(if(is_start, later_end <= us + reach, earlier_start >= us - reach), false)"""
    )
    start_side = [f"if(is_start, {c}, NULL) AS {c}_start" for c in _SIGHTING]
    end_side = [f"if(is_start, NULL, {c}) AS {c}_end" for c in _SIGHTING]
    headers = [
        "if(is_start, dist_next, NULL) AS dist_next",
        "if(is_start, NULL, speed_limit) AS speed_limit",
    ]
    return lone.selectExpr("segment", *start_side, *end_side, *headers).select(
        "segment", *PAIR_COLUMNS
    )


# --- streams -----------------------------------------------------------------


def stream_pairs(start, end, window_seconds):
    """Stream-stream full outer interval join; both sides must carry a watermark.

    One native join keeps each sighting in the state once: a start until the watermark is a window
    past it, an end until the watermark is past it. So a plate's state is its sightings of
    the watermark's tolerance and one window, however long the query runs. A stream join takes two missing
    keys for equal; with the explicit tests a sighting without a plate stays out of the state
    and comes out as lone at once.
    """
    same_car = "s.car_plate = e.car_plate AND s.car_plate IS NOT NULL AND e.car_plate IS NOT NULL"
    earliest = f"e.timestamp - interval {int(window_seconds)} seconds"
    condition = f"{same_car} AND s.timestamp >= {earliest} AND s.timestamp <= e.timestamp"
    sides = [
        f"{alias}.{name} AS {name}_{side}"
        for name in _SIGHTING
        for alias, side in (("s", "start"), ("e", "end"))
    ]
    return (
        start.alias("s")
        .join(end.alias("e"), F.expr(condition), "full_outer")
        .selectExpr(*sides, "s.dist_next", "e.speed_limit")
        .select(*PAIR_COLUMNS)
    )
