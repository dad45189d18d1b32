import random
import statistics
from datetime import timedelta

import pytest
from conftest import at

from roadwatch.operators import series

START = at("08:00:00")


def points(spark, **named):
    rows = [
        (name, START + timedelta(minutes=5 * i), float(v))
        for name, values in named.items()
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, "name string, t timestamp, y double")


def flags(spark, **named):
    got = series.spikes_and_drops(points(spark, **named), ["name"], "t", "y").orderBy("t").collect()
    return {
        name: (
            [i for i, r in enumerate(x for x in got if x.name == name) if r.spike],
            [i for i, r in enumerate(x for x in got if x.name == name) if r.drop],
        )
        for name in named
    }


def test_spikes_and_drops(spark):
    assert flags(
        spark,
        clear=[1] * 9 + [9, 1],
        strict=[1] * 8 + [9, 1],
        single=[5],
        two=[5, 50],
        ramp=[5, 10, 15],
        flat=[3, 3, 3],
    ) == {
        "clear": ([9], [10]),
        "strict": ([], []),
        "single": ([], []),
        "two": ([], []),
        "ramp": ([1, 2], []),
        "flat": ([], []),
    }


def test_regions_stop_at_the_ends(spark):
    values = [0, 50, 0] + [0] * 20 + [50]
    rows = series.spikes_and_drops(points(spark, a=values), ["name"], "t", "y", reach=2)
    flagged = [r for r in rows.orderBy("t").collect() if r.spike or r.drop]
    spans = [
        tuple((m.replace(tzinfo=None) - START.replace(tzinfo=None)).total_seconds() // 300 for m in (r.region_start, r.region_end))
        for r in flagged
    ]
    assert [s[1] - s[0] for s in spans] == [3.0, 4.0, 2.0]


@pytest.mark.parametrize("seed", range(3))
def test_thresholds_against_plain_python(spark, seed):
    draw = random.Random(seed)
    values = [draw.choice([1, 2, 3, 40]) for _ in range(60)]
    steps = [b - a for a, b in zip(values, values[1:])]
    limit = 2 * statistics.stdev(steps)
    spikes, drops = flags(spark, a=values)["a"]
    assert spikes == [i + 1 for i, d in enumerate(steps) if d > limit]
    assert drops == [i + 1 for i, d in enumerate(steps) if d < -limit]


def test_peak_and_low_take_the_earliest(spark):
    row = series.peak_and_low(points(spark, a=[2, 7, 1, 7, 1]), ["name"], "t", "y").selectExpr(
        "peak", "low", "minute(peak_time) AS p", "minute(low_time) AS l"
    ).first()
    assert tuple(row) == (7.0, 1.0, 5, 10)


def test_long_form(spark):
    stats = spark.sql("SELECT 1 AS camera_id, 'instant' AS type, now() AS start_time, 4L AS n, 1.5D AS s")
    got = series.long_form(stats, ["n", "s"]).select("measure", "value").collect()
    assert [tuple(r) for r in got] == [("n", 4.0), ("s", 1.5)]
