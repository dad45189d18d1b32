"""Camera messages: broker and file sources, decoding and encoding."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadwatch.functions.messages import header, header_value, iso_timestamp
from roadwatch.schemas import CAMERA_EVENT, ENVELOPE, EVENT_HEADERS

MESSAGE_KEY = "jsondata"


def broker_stream(spark, topic, servers, starting_offsets="latest", max_offsets=None):
    """Subscribe to one topic with headers. Needs the Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("includeHeaders", "true")
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load()


def envelope_stream(spark, path, max_files=None):
    """The file twin of `broker_stream`: envelopes kept as parquet."""
    reader = spark.readStream.schema(ENVELOPE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def envelope_table(spark, path):
    return spark.read.schema(ENVELOPE).parquet(path)


def with_headers(envelopes, headers=EVENT_HEADERS):
    """Pull named headers into typed columns beside the envelope's own."""
    return envelopes.withColumns(
        {name: header_value(name, kind) for name, kind in headers.items()}
    )


def decode(envelopes, headers=EVENT_HEADERS, payload=CAMERA_EVENT):
    """Envelope rows to one flat row per sighting, payload columns first."""
    body = F.from_json(F.col("value").cast("string"), payload).alias("body")
    values = [header_value(name, kind).alias(name) for name, kind in headers.items()]
    return envelopes.select(body, *values).select("body.*", *headers)


def with_reasons(envelopes, headers=EVENT_HEADERS, payload=CAMERA_EVENT):
    """Envelopes with `reasons`, why `decode` would leave something of a message NULL; empty for a sound one.

    A value that is no JSON or has a field of another type, a header that is not there, a header
    whose text is not of its type. What a message leaves out of its value is no fault.

    The reasons come out of a generator of one row: a plain column would be put into every filter and
    projection on it, and what the headers and the value are made of into each of its mentions there.
    """
    whole = T.StructType([*payload.fields, T.StructField("_corrupt", T.StringType())])
    body = F.from_json(F.col("value").cast("string"), whole, {"columnNameOfCorruptRecord": "_corrupt"})
    no_json = F.col("value").isNull() | body["_corrupt"].isNotNull()
    found = [F.when(no_json, F.lit("no JSON"))]
    for name, kind in headers.items():
        sent = F.coalesce(F.array_contains("headers.key", name), F.lit(False))
        found.append(F.when(~sent, F.lit(f"missing header {name}")))
        found.append(F.when(sent & header_value(name, kind).isNull(), F.lit(f"bad header {name}")))
    once = F.explode_outer(F.array(F.array_compact(F.array(*found))))
    return envelopes.drop("reasons").select("*", once.alias("reasons"))


def rejected(envelopes, headers=EVENT_HEADERS, payload=CAMERA_EVENT):
    """The dead letters: messages with a reason, as they came. With `accepted` they make up the input."""
    return with_reasons(envelopes, headers, payload).filter(F.size("reasons") > 0)


def accepted(envelopes, headers=EVENT_HEADERS, payload=CAMERA_EVENT):
    """The messages that `decode` reads in full, as they came."""
    return with_reasons(envelopes, headers, payload).filter(F.size("reasons") == 0).drop("reasons")


def encode(events, headers, topic, payload=CAMERA_EVENT, key=None):
    """Event rows to envelope rows.

    `headers` maps a header name to the column it carries; timestamps are
    rendered as ISO-8601 in UTC. `key` is a text column; by default all messages have the
    same key, and with it one partition of a topic.
    """
    entries = []
    for name, value in headers.items():
        if EVENT_HEADERS.get(name) == "timestamp":
            value = iso_timestamp(value)
        entries.append(header(name, value))
    body = F.to_json(
        F.struct(*payload.fieldNames()),
        {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"},
    )
    return events.select(
        F.encode(F.lit(MESSAGE_KEY) if key is None else key, "UTF-8").alias("key"),
        F.encode(body, "UTF-8").alias("value"),
        F.array(*entries).alias("headers"),
        topic.alias("topic"),
    )


def in_publish_order(events, key=()):
    """Batches in order of their id within each message key; events without one are not published.

    A broker keeps order per partition, and a message's key decides the partition. So events are
    dealt out by the columns that make up the key, and sorted within. Without any there is
    one order for all; then events of a batch go together to a range of their own.
    """
    published = events.filter(F.col("batch_id").isNotNull())
    order = ["batch_id", "timestamp", "event_id"]
    dealt = published.repartition(*key) if key else published.repartitionByRange(*order)
    return dealt.sortWithinPartitions(*order)


def publish(envelopes, servers):
    """Write envelope rows to the broker. Needs the Kafka connector on the class path."""
    (
        envelopes.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("includeHeaders", "true")
        .save()
    )


def publish_files(envelopes, path):
    """Write envelope rows as parquet, one folder per topic."""
    envelopes.write.mode("append").partitionBy("topic").parquet(path)
