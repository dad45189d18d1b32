"""Columns for reading and building broker messages.

A bad message never stops a query: every conversion yields NULL instead.
"""

from pyspark.sql import functions as F


def utf8(raw):
    """Bytes to text; NULL for bytes that are not UTF-8."""
    return F.try_validate_utf8(raw.cast("string"))


def header_value(name, kind="string", headers="headers"):
    """First header with this name, converted to `int`, `timestamp` or text."""
    named = F.filter(headers, lambda header: header["key"] == name)
    text = utf8(F.get(named, F.lit(0))["value"])
    if kind == "int":
        return text.try_cast("int")
    if kind == "timestamp":
        return F.try_to_timestamp(text)
    return text


def header(name, value):
    """One header entry from a column, rendered as text."""
    return F.struct(
        F.lit(name).alias("key"), F.encode(value.cast("string"), "UTF-8").alias("value")
    )


def iso_timestamp(ts):
    """ISO-8601 text in UTC with microseconds and offset."""
    zoned = F.convert_timezone(F.current_timezone(), F.lit("UTC"), ts.cast("timestamp_ntz"))
    return F.date_format(zoned, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
