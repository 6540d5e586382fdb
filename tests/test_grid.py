import random
import re

import pytest
from pyspark.sql import functions as F

from plans import initial
from windrow import fixed
from windrow.sources import grid as g


def brute_nearest(values, at):
    return min(values, key=lambda v: (abs(v - at), -v))


def points(spark, rows):
    return spark.createDataFrame(rows, "code string, name string, lat double, lon double")


def axes_grid(spark, lats, lons):
    rows = [(a, o) for a in lats for o in lons]
    return spark.createDataFrame(rows, "latitude double, longitude double")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_nearest_equals_brute_force_on_irregular_axes(spark, seed):
    rnd = random.Random(seed)
    lats = sorted({round(rnd.uniform(-90, 90), 2) for _ in range(25)})
    lons = sorted({round(rnd.uniform(0, 360), 2) for _ in range(30)})
    stations = [(f"S{i}", "", rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(60)]
    found = g.nearest_points(points(spark, stations), axes_grid(spark, lats, lons)).collect()
    got = {r["code"]: (r["latitude"], r["longitude"]) for r in found}
    assert got == {
        c: (brute_nearest(lats, lat), brute_nearest(lons, lon % 360)) for c, _, lat, lon in stations
    }


def test_ties_take_the_larger_and_edges_do_not_wrap(spark):
    stations = [("tie", "", 0.5, 1.5), ("west", "", -89.0, -0.1), ("on", "", 1.0, 2.0)]
    found = g.nearest_points(points(spark, stations), axes_grid(spark, [0.0, 1.0], [0.0, 1.0, 2.0, 300.0]))
    got = {r["code"]: (r["latitude"], r["longitude"]) for r in found.collect()}
    assert got == {"tie": (1.0, 2.0), "west": (0.0, 300.0), "on": (1.0, 2.0)}


def test_two_stations_may_share_a_point(spark):
    stations = [("a", "", 0.1, 0.1), ("b", "", 0.2, 0.2)]
    grid = axes_grid(spark, [0.0, 5.0], [0.0, 5.0]).withColumns(
        {"time": F.lit("2022-01-01").cast("timestamp"), **{v: F.lit(1.0) for v in fixed.ARCHIVE_VARIABLES}}
    )
    rows = g.extract_points(grid, points(spark, stations), "2022-01-01", "2022-01-01").collect()
    assert sorted(r["airport"] for r in rows) == ["a", "b"]


def test_the_time_slice_includes_both_ends(spark, sf):
    from windrow.plans import samples

    grid = samples.grid(spark, sf)
    every = g.extract_points(grid, g.stations_frame(spark), "1995-01-01", "2001-12-31")
    times = sorted(r["time"] for r in every.collect())
    low, high = times[1], times[-2]
    some = g.extract_points(grid, g.stations_frame(spark), str(low), str(high))
    assert sorted(r["time"] for r in some.collect()) == [t for t in times if low <= t <= high]


def test_time_bounds_and_columns_reach_the_scan(spark, sf):
    from windrow.plans import samples

    rows = g.extract_points(
        samples.grid(spark, sf),
        g.stations_frame(spark),
        "1996-01-01",
        "1996-06-30",
        variables=["surface_pressure"],
    )
    text = initial(rows)
    assert "GreaterThanOrEqual(l_shipdate,1996-01-01T00:00)" in text
    assert "l_extendedprice" not in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_coordinates_of_few_points_reach_the_scan(spark, tmp_path):
    grid = axes_grid(spark, [0.0, 1.0, 2.0], [0.0, 1.0, 2.0]).withColumns(
        {"time": F.lit("2022-01-01").cast("timestamp"), **{v: F.lit(1.0) for v in fixed.ARCHIVE_VARIABLES}}
    )
    grid.write.parquet(str(tmp_path / "grid"))
    stored = spark.read.parquet(str(tmp_path / "grid"))
    rows = g.extract_points(stored, points(spark, [("a", "", 1.1, 1.9), ("b", "", 0.1, 0.0)]), "2022-01-01", "2022-01-01")
    scan = initial(rows).split("FileScan parquet")[1]
    assert re.search(r"DataFilters: \[.*latitude#\d+ IN \(0.0,1.0\).*longitude#\d+ IN \(0.0,2.0\)", scan)
    assert {(r["airport"], r["latitude"], r["longitude"]) for r in rows.collect()} == {("a", 1.0, 2.0), ("b", 0.0, 0.0)}


def test_no_stations_give_no_rows(spark, sf):
    from windrow.plans import samples

    none = g.stations_frame(spark).limit(0)
    assert g.extract_points(samples.grid(spark, sf), none, "1995-01-01", "2001-12-31").isEmpty()


def test_longer_station_lists_are_broadcast_then_shuffled(spark, sf, monkeypatch):
    from windrow import session
    from windrow.plans import samples

    grid, stations = samples.grid(spark, sf), g.stations_frame(spark)

    def extract():
        rows = g.extract_points(grid, stations, "1995-01-01", "2001-12-31")
        return sorted(map(tuple, rows.collect())), rows._jdf.queryExecution().optimizedPlan().toString().split("Join")[1]

    listed, _ = extract()
    monkeypatch.setattr(g, "LISTED_POINTS", 2)
    hinted, plan = extract()
    assert hinted == listed and "rightHint=(strategy=broadcast)" in plan
    monkeypatch.setattr(g, "is_small", lambda df, n=2: session.is_small(df, min(n, 2)))
    shuffled, plan = extract()
    assert shuffled == listed and "rightHint=(strategy=broadcast)" not in plan.split("\n")[0]


def test_a_missing_variable_is_an_error(spark):
    grid = axes_grid(spark, [0.0], [0.0]).withColumn("time", F.current_timestamp())
    with pytest.raises(ValueError, match="2m_temperature"):
        g.extract_points(grid, g.stations_frame(spark), "2022-01-01", "2022-01-02")


def test_values_that_are_not_degrees_are_an_error(spark):
    with pytest.raises(Exception, match="not in degrees"):
        g.nearest_points(g.stations_frame(spark), axes_grid(spark, [4500.0], [0.0])).collect()


def test_event_records(spark):
    reading = spark.createDataFrame(
        [("JFK", 40.75, 286.25, 273.15, 3.0, 4.0, 0.002, 101000.0, 12.0)],
        "airport string, latitude double, longitude double, 2m_temperature double, "
        "10m_u_component_of_wind double, 10m_v_component_of_wind double, total_precipitation double, "
        "surface_pressure double, convective_available_potential_energy double",
    ).withColumn("time", F.lit("2022-01-02 05:00:00").cast("timestamp"))
    event = g.to_events(reading).first()
    assert event["event_id"] == "JFK_2022-01-02T05:00:00"
    assert (event["temperature_c"], event["wind_speed_ms"]) == (0.0, 5.0)
    assert event["wind_speed_kts"] == pytest.approx(9.7192)
    assert event["precipitation_mm"] == pytest.approx(2.0)
    assert list(event.asDict()) == list(fixed.EVENT_COLUMNS)


def test_a_stored_archive_is_read_where_its_points_are(spark, tmp_path):
    """No axis is read from the archive, and only the tiles of the points are listed."""
    rnd = random.Random(9)
    path, lats, lons = str(tmp_path / "archive"), [-12.5, 30.0, 33.0, 41.0, 44.9], [0.0, 118.5, 240.0, 284.0, 286.5]
    rows = [
        (f"2022-01-{d:02d} 00:00:00", a, o, *[rnd.random() for _ in fixed.ARCHIVE_VARIABLES])
        for d in range(1, 5)
        for a in lats
        for o in lons
    ]
    names = ["time", "latitude", "longitude", *fixed.ARCHIVE_VARIABLES]
    grid = spark.createDataFrame(rows, names).withColumn("time", F.to_timestamp("time"))
    g.write_archive(grid, path)
    archive, axes = g.read_archive(spark, path, grid.schema)
    assert {(r.axis, r.mark) for r in axes.collect()} == {("latitude", x) for x in lats} | {("longitude", x) for x in lons}
    stations = g.stations_frame(spark)
    found = g.extract_points(archive, stations, "2022-01-02", "2022-01-03", axes=axes)
    plain = g.extract_points(grid, stations, "2022-01-02", "2022-01-03")
    assert found.count() > 0 and found.exceptAll(plain).isEmpty() and plain.exceptAll(found).isEmpty()
    assert found.columns == plain.columns
    points = {(r.latitude, r.longitude) for r in g.nearest_points(stations, grid, axes).collect()}
    wanted = {(int(a // g.TILE), int(o // g.TILE)) for a, o in points}
    listed = re.findall(r"lat_tile=(-?\d+)/lon_tile=(-?\d+)", " ".join(found.inputFiles()))
    assert wanted <= {(int(a), int(o)) for a, o in listed}
    plan = initial(found)
    assert "PartitionFilters" in plan and "lat_tile" in plan.split("PartitionFilters")[1][:400]
