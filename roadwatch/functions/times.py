"""Time columns. All truncation is in UTC, whatever the session zone."""

from pyspark.sql import functions as F

SECOND = 1_000_000
DAY = 86_400

# Formats tried after ISO-8601, in order; numbers need no leading zeros. Month comes first in
# slash dates.
MIXED_FORMATS = [
    "M/d/yyyy[ H:mm[:ss[.SSSSSS]]]",
    "M/d/yyyy h:mm[:ss] a",
    "yyyy/M/d[ H:mm[:ss[.SSSSSS]]]",
    "yyyyMMdd[ HHmmss]",
    "d MMM yyyy[ H:mm[:ss]]",
    "d MMMM yyyy[ H:mm[:ss]]",
    "MMM d, yyyy[ H:mm[:ss]]",
    "MMMM d, yyyy[ H:mm[:ss]]",
]


def mixed_timestamp(text, formats=MIXED_FORMATS):
    """Parse text whose rows differ in format; NULL where none fits."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(
        F.try_to_timestamp(text),
        *[F.try_to_timestamp(text, F.lit(pattern)) for pattern in formats],
    )


def event_day(ts):
    """Calendar day (UTC) of an instant, as DATE."""
    seconds = F.unix_seconds(ts)
    return F.date_from_unix_date(F.floor(seconds / F.lit(DAY)).cast("int"))


def hour_of_day(ts):
    """Hour 0-23 (UTC) of an instant."""
    return F.floor(F.pmod(F.unix_seconds(ts), F.lit(DAY)) / F.lit(3600)).cast("int")


def bin_start(ts, seconds=300):
    """Start of the fixed-size bin an instant falls into."""
    elapsed = F.unix_seconds(ts)
    return F.timestamp_seconds(elapsed - F.pmod(elapsed, F.lit(seconds)))


def elapsed_seconds(start, end):
    """Fractional seconds between two instants, in double arithmetic on epoch seconds."""
    return end.cast("double") - start.cast("double")
