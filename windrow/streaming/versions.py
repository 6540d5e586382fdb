"""Feature tables that are rebuilt, and scores that follow them.

Each build is a folder of its own, and a small pointer table gets a row for it once it is
whole. A stream over the pointers scores one version after another: a table that is replaced
under a file stream would be read twice or half.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from windrow import schemas
from windrow.sinks.tables import write_table
from windrow.sources.tables import read_if_there
from windrow.streaming.scoring import scored

POINTER = "version bigint, path string"
SCORES = "event_id string, airport string, timestamp_utc timestamp, prediction double, score double, version bigint"


def _pointers(base: str) -> str:
    return f"{base.rstrip('/')}/pointers"


def last_version(spark: SparkSession, base: str) -> int:
    """0 before the first."""
    rows = read_if_there(spark, _pointers(base), POINTER, "json")
    return 0 if rows is None else rows.agg(F.max("version")).first()[0] or 0


def publish(df: DataFrame, base: str) -> int:
    """Write ``df`` as the next version and point to it; a build that fails is written over by the next."""
    spark = df.sparkSession
    version = last_version(spark, base) + 1
    path = f"{base.rstrip('/')}/build-{version}"
    write_table(df, path, ())
    row = spark.createDataFrame([(version, path)], POINTER)
    row.coalesce(1).write.mode("append").json(_pointers(base))
    return version


def read_version(spark: SparkSession, base: str, version: int | None = None, schema=schemas.GOLD) -> DataFrame:
    """A version's rows; by default those of the last one."""
    rows = read_if_there(spark, _pointers(base), POINTER, "json")
    if rows is None:
        raise FileNotFoundError(f"No version at {base}")
    wanted = rows.where(F.col("version") == version) if version else rows.orderBy(F.desc("version"))
    found = wanted.first()
    if found is None:
        raise FileNotFoundError(f"No version {version} at {base}")
    return spark.read.schema(schema).parquet(found["path"])


def scores(spark: SparkSession, out: str) -> DataFrame | None:
    """Everything that was scored, with its version; None before the first."""
    return read_if_there(spark, out, SCORES)


def start_scoring(
    spark: SparkSession, base: str, model, out: str, checkpoint: str, only_new: bool = False, available_now: bool = True
) -> StreamingQuery:
    """Score every version that the pointers name, each in its own ``version=`` folder of ``out``.

    A batch that is tried again writes its versions over, so each event is there once a
    version. With ``only_new`` events that an earlier version scored are left out.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        # One small row a build.
        for pointer in batch.orderBy("version").collect():
            rows = scored(spark.read.schema(schemas.GOLD).parquet(pointer["path"]), model)
            if only_new and pointer["version"] > 1:
                before = scores(spark, out)
                if before is not None:
                    known = before.where(F.col("version") < pointer["version"]).select("event_id").distinct()
                    rows = rows.join(known, "event_id", "left_anti")
            (
                rows.withColumn("version", F.lit(pointer["version"]).cast("bigint"))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("version")
                .parquet(out)
            )

    stream = spark.readStream.schema(POINTER).json(_pointers(base))
    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
