import pytest
from conftest import at
from pyspark.sql import functions as F

from roadwatch.operators import dimensions
from roadwatch.plans.bindings import CAMERA_ROWS
from roadwatch.schemas import CAMERA
from roadwatch.sources.tables import read_cameras, read_vehicles, save_table
from test_store import violation, violations


@pytest.fixture
def cameras(spark):
    return spark.createDataFrame(CAMERA_ROWS, CAMERA)


def test_camera_file_to_table(spark, tmp_path):
    path = tmp_path / "camera.csv"
    lines = ["camera_id,latitude,longitude,position,speed_limit"]
    path.write_text("\n".join(lines + [",".join(map(str, row)) for row in CAMERA_ROWS]) + "\n")
    save_table(dimensions.with_id(read_cameras(spark, str(path)), "camera_id"), f"{tmp_path}/out")
    stored = spark.read.parquet(f"{tmp_path}/out")
    assert stored.columns == ["id", "latitude", "longitude", "position", "speed_limit"]
    assert sorted(map(tuple, stored.collect())) == CAMERA_ROWS


def test_latest_vehicle_is_the_last_value_per_column(spark, tmp_path):
    path = tmp_path / "vehicle.csv"
    path.write_text(
        "car_plate,owner_name,owner_addr,vehicle_type,registration_date\n"
        "p,o1,a1,,2020-01-01 00:00:00\n"
        "p,,a2,v2,2021-06-01T00:00:00\n"
        ",ghost,,,2022-01-01\n"
        "q,only,,,01/31/2019\n"
        "r,dated,x,y,\n"
    )
    rows = dimensions.latest_vehicles(read_vehicles(spark, str(path))).collect()
    got = {r.car_plate: r for r in rows}
    assert set(got) == {"p", "q", "r"}
    assert (got["p"].owner_name, got["p"].owner_addr, got["p"].vehicle_type) == ("o1", "a2", "v2")
    assert str(got["p"].registration_date.date()) == "2021-06-01"
    assert got["q"].vehicle_type is None
    assert (got["r"].owner_name, got["r"].registration_date) == ("dated", None)


def test_ties_are_settled_by_further_order_columns(spark):
    rows = spark.createDataFrame(
        [("p", "a", at("08:00:00"), 2), ("p", "b", at("08:00:00"), 1)],
        "car_plate string, owner_name string, registration_date timestamp, entry int",
    )
    latest = dimensions.latest_vehicles(rows, order=("registration_date", "entry"))
    assert latest.columns == ["car_plate", "owner_name", "registration_date"]
    assert latest.first().owner_name == "a"


def test_owner_and_deregistration(spark):
    vehicles = spark.createDataFrame([("P", "Ann"), ("Q", "Bob")], "car_plate string, owner_name string")
    rows = violations(spark, violation("P"), violation("P", end="08:00:01"), violation("Z"))
    owned = dimensions.with_owner(rows, vehicles)
    assert sorted((r.car_plate, r.owner_name or "-") for r in owned.collect()) == [
        ("P", "Ann"), ("P", "Ann"), ("Z", "-"),
    ]
    gone = spark.createDataFrame([("Q",), ("Q",)], "car_plate string")
    assert [r.car_plate for r in dimensions.without_deregistered(vehicles, gone).collect()] == ["P"]


def test_orphans_count_either_end_of_a_segment(spark, cameras):
    rows = violations(
        spark,
        violation(camera=9),
        violation(camera=10, kind="average", start="07:59:00"),
        violation(camera=1),
    )
    got = dict(map(tuple, dimensions.orphan_cameras(rows, cameras).collect()))
    assert got == {9: 2, 10: 1}


def test_repeated_keys(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), (None, 1), (None, 1)], "k string, d int")
    got = {(r.k, r.d): r.copies for r in dimensions.repeated_keys(rows, ["k", "d"]).collect()}
    assert got == {("a", 1): 2, (None, 1): 2}


def test_bounds(cameras):
    box = dimensions.bounds(cameras).first()
    assert (box.min_lat, box.max_lat) == (2.157730731, 2.167352891)
    assert (box.min_lon, box.max_lon) == (102.6449144, 102.6601002)
    assert box.center_lat == (2.157730731 + 2.167352891) / 2
    assert box.center_lon == (102.6449144 + 102.6601002) / 2


def test_bucketed_owner_join_needs_no_shuffle(spark, tmp_path):
    rows = spark.createDataFrame([("P", 1), ("P", 2), ("Q", 3), (None, 4)], "car_plate string, n int")
    register = spark.createDataFrame([("P", "ann"), ("R", "bob")], "car_plate string, owner_name string")
    left = dimensions.save_by_plate(rows, "bucketed_rows", str(tmp_path / "rows"), 4)
    right = dimensions.save_by_plate(register, "bucketed_register", str(tmp_path / "register"), 4)
    joined = dimensions.with_owner(left, right.hint("merge"))
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.n, r.owner_name) for r in joined.collect()) == [(1, "ann"), (2, "ann"), (3, None), (4, None)]
    plain = dimensions.with_owner(rows, register)
    assert sorted(plain.collect(), key=str) == sorted(joined.collect(), key=str)
