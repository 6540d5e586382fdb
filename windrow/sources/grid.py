"""Station series from a gridded archive held as a long table.

The archive has one row per (time, latitude, longitude). For each station the nearest
grid latitude and the nearest grid longitude are found on their own, then the rows of that
point are joined out of the grid.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrow import fixed, schemas
from windrow.functions import weather
from windrow.operators.quality import require_columns
from windrow.session import is_small
from windrow.sinks.tables import write_table

#: Width in degrees of the cells an axis is cut into: at most 721 of them.
_CELL = 1.0
#: Side in degrees of the directories of a stored archive.
TILE = 5
#: Stations up to which the coordinates of their points are listed in the scan filter.
LISTED_POINTS = 1000


def stations_frame(spark: SparkSession, rows: Sequence[tuple] = fixed.STATIONS) -> DataFrame:
    return spark.createDataFrame(list(rows), schemas.STATIONS)


def axis_values(grid: DataFrame) -> DataFrame:
    """(axis, mark): the distinct latitudes and longitudes, from one scan of two columns."""
    coordinates = F.array(
        *[F.struct(F.lit(a).alias("axis"), F.col(a).alias("mark")) for a in ("latitude", "longitude")]
    )
    return grid.select(F.inline(coordinates)).where("mark is not null").distinct()


def nearest_on_axes(targets: DataFrame, axes: DataFrame) -> DataFrame:
    """For each (code, axis, value) the nearest mark of that axis; the larger one on a tie.

    Targets and marks are sorted together inside one-degree cells, where the nearest mark
    on each side is the last and the next one. A cell without a mark on a side takes it
    from the closest cell that has any.
    """
    marks = axes.select(F.lit(None).cast("string").alias("code"), "axis", F.col("mark").alias("value"), "mark")
    wanted = targets.select("code", "axis", "value", F.lit(None).cast("double").alias("mark"))
    degrees = F.when(F.col("value").between(-360.0, 360.0), F.col("value")).otherwise(
        F.raise_error(F.concat("axis", F.lit(" is not in degrees: "), F.col("value").cast("string")))
    )
    both = marks.unionByName(wanted).withColumn("cell", F.floor(degrees / _CELL))

    # At most 721 cells per axis, one row each.
    line = Window.partitionBy("axis").orderBy("cell")
    cells = (
        both.groupBy("axis", "cell")
        .agg(F.min("mark").alias("lo"), F.max("mark").alias("hi"))
        .select(
            "axis",
            "cell",
            F.max("hi").over(line.rowsBetween(Window.unboundedPreceding, -1)).alias("from_below"),
            F.min("lo").over(line.rowsBetween(1, Window.unboundedFollowing)).alias("from_above"),
        )
    )

    inside = Window.partitionBy("axis", "cell").orderBy("value", F.col("mark").isNull())
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    onwards = inside.rowsBetween(0, Window.unboundedFollowing)
    placed = both.select(
        "code",
        "axis",
        "value",
        "cell",
        F.last("mark", ignorenulls=True).over(upto).alias("below"),
        F.first("mark", ignorenulls=True).over(onwards).alias("above"),
    ).where("code is not null")
    below = F.coalesce("below", "from_below")
    above = F.coalesce("above", "from_above")
    nearest = F.when(above.isNull() | (F.col("value") - below < above - F.col("value")), below)
    # A left join infers no filter below the union, so both uses read one axis scan.
    return placed.join(F.broadcast(cells), ["axis", "cell"], "left").select(
        "code", "axis", nearest.otherwise(above).alias("nearest")
    )


def _tiles(latitude, longitude) -> dict:
    return {"lat_tile": F.floor(latitude / TILE).cast("int"), "lon_tile": F.floor(longitude / TILE).cast("int")}


def write_archive(grid: DataFrame, path: str) -> None:
    """An archive in directories of ``TILE`` by ``TILE`` degrees, and its axes in a table beside it.

    The axes come from the two coordinate columns of what was written, once; extractions then
    read them instead of the archive, and only the tiles of their points.
    """
    tiled = grid.withColumns(_tiles(F.col("latitude"), F.col("longitude")))
    write_table(tiled, path, ("lat_tile", "lon_tile"))
    stored = grid.sparkSession.read.schema(tiled.schema).parquet(path)
    write_table(axis_values(stored).coalesce(1), _axes(path), ())


def read_archive(spark: SparkSession, path: str, schema) -> tuple[DataFrame, DataFrame]:
    """The archive, its ``schema`` and tiles, and its axes."""
    fields = [*schema.fields, T.StructField("lat_tile", T.IntegerType()), T.StructField("lon_tile", T.IntegerType())]
    axes = spark.read.schema("axis string, mark double").parquet(_axes(path))
    return spark.read.schema(T.StructType(fields)).parquet(path), axes


def _axes(path: str) -> str:
    return f"{path.rstrip('/')}-axes"


def nearest_points(stations: DataFrame, grid: DataFrame, axes: DataFrame | None = None) -> DataFrame:
    """(code, latitude, longitude) of the grid point nearest to each station, axis by axis."""
    wanted = F.array(
        F.struct(F.lit("latitude").alias("axis"), F.col("lat").alias("value")),
        F.struct(F.lit("longitude").alias("axis"), weather.longitude_360(F.col("lon")).alias("value")),
    )
    found = nearest_on_axes(stations.select("code", F.inline(wanted)), axis_values(grid) if axes is None else axes)
    return found.groupBy("code").agg(
        *[F.max(F.when(F.col("axis") == a, F.col("nearest"))).alias(a) for a in ("latitude", "longitude")]
    )


def _until(time: str, end: str):
    """Up to a time, itself included; a date alone stands for its whole day."""
    if ":" in end:
        return F.col(time) <= F.lit(end).cast("timestamp")
    return F.col(time) < F.lit(str(date.fromisoformat(end.strip()) + timedelta(days=1))).cast("timestamp")


def extract_points(
    grid: DataFrame,
    stations: DataFrame,
    start: str,
    end: str,
    variables: Sequence[str] = fixed.ARCHIVE_VARIABLES,
    time: str = "time",
    axes: DataFrame | None = None,
) -> DataFrame:
    """The station rows of the grid between two times, both included; a date means its whole day.

    The time bounds and the wanted columns reach the scan. With a short station list the
    points are looked up first (a job over the two axis columns) and their coordinates
    reach the scan too, so that files and row groups without them are skipped. A longer
    list is broadcast, and one too long for that is joined by shuffle. Of a tiled archive
    (``read_archive``) only the tiles of a short list's points are listed and read, and with its
    ``axes`` the points are found without it.
    """
    require_columns(grid, [time, "latitude", "longitude", *variables])
    sliced = grid.where(F.col(time) >= F.lit(start).cast("timestamp")).where(_until(time, end))
    points = nearest_points(stations, grid, axes)
    if is_small(stations, LISTED_POINTS):
        found = points.collect()
        if "lat_tile" in grid.columns:
            tiles = {(r["latitude"] // TILE, r["longitude"] // TILE) for r in found}
            for name, of in (("lat_tile", 0), ("lon_tile", 1)):
                sliced = sliced.where(F.col(name).isin(sorted({int(t[of]) for t in tiles})))
        for axis in ("latitude", "longitude"):
            sliced = sliced.where(F.col(axis).isin(sorted({r[axis] for r in found})))
        points = F.broadcast(grid.sparkSession.createDataFrame(found, points.schema))
    elif is_small(stations):
        points = F.broadcast(points)
    narrow = sliced.select(time, "latitude", "longitude", *variables)
    return narrow.join(points, ["latitude", "longitude"]).select(
        F.col("code").alias("airport"), time, "latitude", "longitude", *variables
    )


def with_event_columns(points: DataFrame) -> DataFrame:
    """Archive names to event names, and the converted measures; other columns stay."""
    return points.withColumnsRenamed(fixed.ARCHIVE_NAMES).withColumns(
        {
            "event_id": weather.event_key(),
            "temperature_c": weather.celsius(),
            "wind_speed_ms": weather.wind_speed(),
            "wind_speed_kts": weather.knots(weather.wind_speed()),
            "precipitation_mm": weather.millimetres(),
        }
    )


def to_events(points: DataFrame) -> DataFrame:
    """Station rows of the archive as event records."""
    return with_event_columns(points).select(*fixed.EVENT_COLUMNS)
