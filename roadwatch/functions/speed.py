"""Speed, distance and travel time."""

import math

from pyspark.sql import functions as F


def boundary_seconds(distance_km, speed_limit):
    """Whole seconds in which a car at the limit covers the distance, rounded up."""
    return math.ceil(distance_km / speed_limit * 3600)


def boundary_column(distance_km, speed_limit):
    """`boundary_seconds` over columns; NULL for a zero limit."""
    return F.ceil(F.try_divide(distance_km.cast("double"), speed_limit) * F.lit(3600))


def limit_seconds(distance_km, speed_limit):
    """Exact travel time at the limit, in seconds; NULL for a zero limit."""
    return F.try_divide(F.lit(3600) * distance_km.cast("double"), speed_limit)


def average_speed(distance_km, duration):
    """Kilometres per hour; NULL when the duration is zero."""
    return F.try_divide(distance_km.cast("double"), duration / F.lit(3600))


def midpoint(a, b):
    return (a + b) / F.lit(2)
