"""The given tables seen as sightings, vehicles and history.

`events` stands for camera sightings: views at camera 1, clicks at camera 2,
purchases at camera 3. Distances are set so that a trip at the limit takes six
hours, which suits the density of the data. Signups stand for historic
violations, `orders` for the vehicle register and customers with a negative
balance for deregistered cars.
"""

from pyspark.sql import functions as F

from roadwatch.functions.speed import boundary_seconds
from roadwatch.operators.detection import average_violations, instant_violations
from roadwatch.operators.pairing import as_trips, network_pairs, union_all
from roadwatch.operators.records import (
    average_records,
    dropped_records,
    historic_records,
    instant_records,
)
from roadwatch.schemas import CAMERA
from roadwatch.session import shared_folder, use_utc
from roadwatch.sources.batches import write_batch
from roadwatch.sources.tables import read_violations

# The camera table.
CAMERA_ROWS = [
    (1, 2.157730731, 102.6601002, 152.5, 110),
    (2, 2.162418757, 102.6524549, 153.5, 110),
    (3, 2.167352891, 102.6449144, 154.5, 90),
]
EVENT_TYPES = {1: "view", 2: "click", 3: "purchase"}
LIMITS = {camera: limit for camera, _, _, _, limit in CAMERA_ROWS}
DISTANCES = {1: 660, 2: 540, 3: 0}
SEGMENTS = [(1, 2), (2, 3)]
WINDOWS = [boundary_seconds(DISTANCES[a], LIMITS[b]) for a, b in SEGMENTS]
FIRST_DAY = "2024-01-01"


def cameras(spark):
    return spark.createDataFrame(CAMERA_ROWS, CAMERA)


# The columns in use of the given tables.
TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string,
                 o_orderdate timestamp_ntz, o_orderpriority string""",
    "customer": "c_custkey bigint, c_acctbal double",
}


def table(spark, sf_dir, name):
    return use_utc(spark).read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def event_stream(spark, sf_dir):
    """`events` as a stream. The glob lets the path be one file or a folder of files."""
    reader = use_utc(spark).readStream.schema(TABLES["events"])
    return reader.parquet(f"{sf_dir}/event[s].parquet")


def _per_camera(values):
    cases = " ".join(f"WHEN '{EVENT_TYPES[camera]}' THEN {v}" for camera, v in values.items())
    return f"CASE event_type {cases} END"


def as_sightings(events, camera=None):
    """Decoded sightings of one camera or of all three."""
    kept = list(EVENT_TYPES.values()) if camera is None else [EVENT_TYPES[camera]]
    number = _per_camera({camera: camera for camera in EVENT_TYPES})
    return events.filter(F.col("event_type").isin(kept)).selectExpr(
        "cast(event_id AS string) AS event_id",
        f"datediff(ts, DATE '{FIRST_DAY}') AS batch_id",
        "cast(user_id AS string) AS car_plate",
        f"{number} AS camera_id",
        "cast(ts AS timestamp) AS timestamp",
        "value AS speed_reading",
        f"{number} AS producer_id",
        f"{_per_camera(LIMITS)} AS speed_limit",
        f"{_per_camera(DISTANCES)} AS dist_next",
        "cast(ts AS timestamp) + interval 5 seconds AS processing_timestamp",
    )


def sightings(spark, sf_dir):
    return as_sightings(table(spark, sf_dir, "events"))


def camera_frames(events):
    """One frame per camera in road order, from the batch table or the stream."""
    return [as_sightings(events, camera) for camera in EVENT_TYPES]


def events_by_camera(spark, sf_dir):
    return camera_frames(table(spark, sf_dir, "events"))


def processed(column):
    """Write time of a record: five seconds after the sighting."""
    return F.col(column) + F.expr("interval 5 seconds")


def segments(windows=WINDOWS):
    """The road segments: name, cameras and window."""
    return [(f"{a}-{c}", a, c, window) for (a, c), window in zip(SEGMENTS, windows, strict=True)]


def pairs(spark, sf_dir, keep="all", windows=WINDOWS):
    return network_pairs(
        sightings(spark, sf_dir), segments(windows), max(windows), keep
    )


def instants(spark, sf_dir):
    return instant_violations(sightings(spark, sf_dir))


def averages(spark, sf_dir, windows=WINDOWS):
    return average_violations(as_trips(pairs(spark, sf_dir, "matched", windows)))


def dropped(spark, sf_dir):
    """Unmatched pairs as drop-log rows, taken in five seconds after the sighting."""
    return dropped_records(pairs(spark, sf_dir, "unmatched"), ingested())


def ingested():
    return F.coalesce("timestamp_end", "timestamp_start") + F.expr("interval 5 seconds")


def stream_records(spark, sf_dir):
    """Violation rows as the streaming queries write them."""
    return union_all(
        [
            instant_records(instants(spark, sf_dir), processed("timestamp")),
            average_records(averages(spark, sf_dir), processed("timestamp_end")),
        ]
    )


def historic_rows(spark, sf_dir):
    """History as text in mixed formats, ten minutes from start to end."""
    ts = F.col("ts")
    start = ts - F.expr("interval 10 minutes")
    iso = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    zoned = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
    slash = "MM/dd/yyyy HH:mm:ss"

    def text(column):
        return (
            F.when(F.col("value") < 20, F.date_format(column, iso))
            .when(F.col("value") < 50, F.date_format(column, zoned))
            .otherwise(F.date_format(column, slash))
        )

    return table(spark, sf_dir, "events").filter(F.col("event_type") == "signup").select(
        F.col("user_id").cast("string").alias("car_plate"),
        F.lit(1).alias("camera_id_start"),
        F.lit(2).alias("camera_id_end"),
        text(start).alias("timestamp_start"),
        text(ts).alias("timestamp_end"),
        F.col("value").alias("speed_reading"),
    )


def all_records(spark, sf_dir):
    return stream_records(spark, sf_dir).unionByName(
        historic_records(historic_rows(spark, sf_dir))
    )


_STORES = {}


def store_of(spark, sf_dir, records, name):
    """Root of the records as a store partitioned by date, written once per application and shared.

    `records` is one of the functions above.
    """
    known = (spark.sparkContext.applicationId, sf_dir, name)
    if known not in _STORES:
        root = shared_folder(spark, f"store-{name}")
        write_batch(records(spark, sf_dir), root, 0, ["date"])
        _STORES[known] = root
    return _STORES[known]


def stored(spark, sf_dir, start=None, end=None):
    """All violations from the shared store, dates in [start, end)."""
    return read_violations(spark, store_of(spark, sf_dir, all_records, "all"), start=start, end=end)


def stored_stream(spark, sf_dir, start=None, end=None):
    """Violations of streams alone from the shared store."""
    root = store_of(spark, sf_dir, stream_records, "stream")
    return read_violations(spark, root, start=start, end=end)


def vehicles(spark, sf_dir):
    """The raw register: a plate once per order, with gaps in two columns."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("car_plate"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("owner_name"),
        F.col("o_orderkey").cast("string").alias("owner_addr"),
        F.nullif("o_orderstatus", F.lit("P")).alias("vehicle_type"),
        F.col("o_orderdate").cast("timestamp").alias("registration_date"),
        F.col("o_orderkey").alias("entry"),
    )


def deregistered(spark, sf_dir):
    return table(spark, sf_dir, "customer").filter(F.col("c_acctbal") < 0).select(
        F.col("c_custkey").cast("string").alias("car_plate")
    )


def presentable(rows):
    """Times without a zone, as the given tables have them."""
    zoned = [name for name, kind in rows.dtypes if kind == "timestamp"]
    return rows.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})
