"""Merging the many small directories of a streamed bronze table, date by date.

A merge writes one directory for each date and then, in a table next to bronze, which batches of
which runs it holds: that row is the commit. Readers take a date's merged directory and the
batches that it does not hold, so a merge that fails changes nothing that is read, and one that
runs beside the stream disturbs neither. What a merge has replaced is removed by the next one,
so a reader has that long to finish. The newest batch of a run is not merged, since it may be
written again, unless it is known to be committed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow import schemas
from windrow.session import broadcast_if_small, materialise
from windrow.sources.tables import read_if_there

#: The run that merged directories are filed under; their batch is the merge's number.
MERGED = "merged"

#: Batches of a date from which a merge takes it up.
LEAST = 8

_HELD = "event_date date, generation bigint, run_id string, upto bigint"
_PLACE = r"/event_date=([0-9-]+)/run_id=([^/]+)/batch_id=(\d+)/[^/]*$"


def _register(path: str) -> str:
    return f"{path.rstrip('/')}-merged"


def held(spark: SparkSession, path: str) -> DataFrame | None:
    """(event_date, run_id, upto) by each date's last merge; its own number stands under ``MERGED``."""
    rows = read_if_there(spark, _register(path), _HELD)
    if rows is None:
        return None
    last = F.max("generation").alias("generation")
    return rows.join(rows.groupBy("event_date").agg(last), ["event_date", "generation"]).drop("generation")


def live(rows: DataFrame, by: DataFrame | None) -> DataFrame:
    """Of bronze rows with run_id and batch_id, those that count: merged ones, and batches that no merge holds."""
    if by is None:
        return rows.where(F.col("run_id") != MERGED)
    by = broadcast_if_small(by.select(F.col("event_date").alias("_date"), F.col("run_id").alias("_run"), "upto"))
    merged = F.col("run_id") == MERGED
    counts = F.when(merged, F.col("batch_id").eqNullSafe(F.col("upto"))).otherwise(
        F.col("upto").isNull() | (F.col("batch_id") > F.col("upto"))
    )
    same = (F.col("event_date") == F.col("_date")) & (F.col("run_id") == F.col("_run"))
    return rows.join(by, same, "left").where(counts).drop("_date", "_run", "upto")


def directories(spark: SparkSession, path: str) -> DataFrame | None:
    """(event_date, run_id, batch_id, directory) of what is stored; contents are not read."""
    files = read_if_there(spark, path, None, "binaryFile")
    if files is None:
        return None
    part = lambda i: F.regexp_extract("path", _PLACE, i)
    found = files.where(part(1) != "").select(
        part(1).cast("date").alias("event_date"),
        part(2).alias("run_id"),
        part(3).cast("bigint").alias("batch_id"),
        F.regexp_replace("path", "/[^/]*$", "").alias("directory"),
    )
    return found.distinct()


def clear(spark: SparkSession, path: str) -> int:
    """Remove the directories that a committed merge has replaced; returns how many."""
    by, there = held(spark, path), directories(spark, path)
    if by is None or there is None:
        return 0
    older = F.when(F.col("run_id") == MERGED, F.col("batch_id") < F.col("upto")).otherwise(F.col("batch_id") <= F.col("upto"))
    names = there.join(by, ["event_date", "run_id"]).where(older).select("directory")
    hadoop, count = spark.sparkContext._jsc.hadoopConfiguration(), 0
    for row in names.toLocalIterator():
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(row.directory)
        place.getFileSystem(hadoop).delete(place, True)
        count += 1
    return count


def merge(
    spark: SparkSession, path: str, schema, least: int = LEAST, committed: tuple[str, int] | None = None
) -> int:
    """Merge the dates that have ``least`` directories to merge; returns the number of dates.

    One job reads those dates only, writes them with few files each, sorted by event, and the
    commit is a small file behind it. ``committed`` names a run and its newest batch that will not
    be written again.
    """
    clear(spark, path)
    there = directories(spark, path)
    if there is None:
        return 0
    plain = materialise(there.where(F.col("run_id") != MERGED).drop("directory"), "directories")
    newest = plain.groupBy("run_id").agg(F.max("batch_id").alias("newest"))
    closed = F.col("batch_id") < F.col("newest")
    if committed:
        closed = closed | ((F.col("run_id") == committed[0]) & (F.col("batch_id") <= committed[1]))
    ready = plain.join(newest, "run_id").where(closed).drop("newest")
    by = held(spark, path)
    if by is not None:
        ready = ready.join(by, ["event_date", "run_id"], "left").where("upto IS NULL OR batch_id > upto")
    full = ready.groupBy("event_date").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("event_date")
    new = ready.join(full, "event_date").groupBy("event_date", "run_id").agg(F.max("batch_id").alias("upto"))
    new = materialise(new, "merge-plan")
    dates = new.select("event_date").distinct()
    count = dates.count()
    if not count:
        return 0
    generation = 1
    if by is not None:
        last = read_if_there(spark, _register(path), _HELD).agg(F.max("generation")).first()[0]
        generation += last or 0
    rows = live(spark.read.schema(schema).option("basePath", path).parquet(path), by)
    rows = rows.join(broadcast_if_small(dates), "event_date", "left_semi")
    limit = new.select(F.col("event_date").alias("_date"), F.col("run_id").alias("_run"), F.col("upto"))
    same = (F.col("event_date") == F.col("_date")) & (F.col("run_id") == F.col("_run"))
    rows = rows.join(broadcast_if_small(limit), same, "left").where(
        (F.col("run_id") == MERGED) | (F.col("batch_id") <= F.col("upto"))
    )
    placed = rows.select(*schemas.BRONZE.names).withColumns(
        {"run_id": F.lit(MERGED), "batch_id": F.lit(generation).cast("bigint")}
    )
    (
        placed.hint("rebalance", "event_date")
        .sortWithinPartitions("event_date", "event_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date", "run_id", "batch_id")
        .parquet(path)
    )
    known = new
    if by is not None:
        known = known.unionByName(by.where(F.col("run_id") != MERGED).join(dates, "event_date", "left_semi").select(*new.columns))
    known = known.groupBy("event_date", "run_id").agg(F.max("upto").alias("upto"))
    own = dates.select("event_date", F.lit(MERGED).alias("run_id"), F.lit(generation).cast("bigint").alias("upto"))
    commit = known.unionByName(own).withColumn("generation", F.lit(generation).cast("bigint"))
    commit.select("event_date", "generation", "run_id", "upto").coalesce(1).write.mode("append").parquet(_register(path))
    return count
