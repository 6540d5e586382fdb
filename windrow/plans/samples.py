"""Weather events derived from the test tables, so that every query grows with them.

``events`` rows become hourly-style observations of three stations; ``lineitem`` rows
become a gridded archive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow import fixed
from windrow.session import use_utc
from windrow.sources.grid import to_events, with_event_columns


# Column types of the two tables, so that opening them starts no job.
_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.schema(_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def station_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as an archive reading at a station, with its sequence number and kind."""
    reading = F.regexp_extract("props", "([0-9]+)", 1).cast("double")
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("kind"),
        F.col("user_id").alias("sensor"),
        F.date_trunc("second", F.col("ts").cast("timestamp")).alias("time"),
        F.element_at(F.array(*[F.lit(s[0]) for s in fixed.STATIONS]), (F.col("user_id") % 3 + 1).cast("int")).alias(
            "airport"
        ),
        "value",
        reading.alias("reading"),
    )

    def by_station(i: int):
        choice = F.when(F.col("airport") == fixed.STATIONS[0][0], F.lit(fixed.STATIONS[0][i]))
        for s in fixed.STATIONS[1:]:
            choice = choice.when(F.col("airport") == s[0], F.lit(s[i]))
        return choice

    return events.select(
        "seq",
        "kind",
        "sensor",
        "reading",
        "airport",
        "time",
        by_station(2).alias("latitude"),
        by_station(3).alias("longitude"),
        (F.lit(263.15) + F.col("sensor") % 40).alias("2m_temperature"),
        (F.col("value") / 10).alias("10m_u_component_of_wind"),
        (F.col("reading") / 10).alias("10m_v_component_of_wind"),
        (F.col("reading") / 8000).alias("total_precipitation"),
        (F.lit(100000.0) + F.col("sensor")).alias("surface_pressure"),
        (F.col("value") * 20).alias("convective_available_potential_energy"),
    )


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_events(station_points(spark, sf_dir))


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as delivered: error events three times, some without an id, times as text."""
    copies = F.when(F.col("kind") == "error", 2).otherwise(0)
    delivered = with_event_columns(station_points(spark, sf_dir)).withColumn(
        "copy", F.explode(F.sequence(F.lit(0), copies))
    )
    part = F.concat(
        F.lit("part-"), F.lpad(F.floor(F.col("seq") / fixed.FLUSH_ROWS).cast("string"), 8, "0"), F.lit(".jsonl")
    )
    broken = (F.col("kind") == "error") & (F.col("reading") < 10)
    return delivered.select(
        F.when(~broken, F.col("event_id")).alias("event_id"),
        "airport",
        F.date_format("timestamp_utc", "yyyy-MM-dd HH:mm:ss").alias("timestamp_utc"),
        *fixed.EVENT_COLUMNS[3:],
        F.lit(fixed.TOPIC).alias("_kafka_topic"),
        (F.col("sensor") % 4).cast("int").alias("_kafka_partition"),
        (F.col("seq") + F.col("copy") * 1_000_000_000_000).alias("_kafka_offset"),
        F.date_format("timestamp_utc", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("_ingested_at_utc"),
        F.when(F.col("copy") == 0, part).otherwise("part-replay.jsonl").alias("_source_object"),
    )


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gridded archive: 40 latitudes by 64 longitudes, one reading per lineitem row."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("timestamp").alias("time"),
        (F.lit(33.0) + F.col("l_partkey") % 40 * 0.25).alias("latitude"),
        (F.lit(240.0) + F.col("l_orderkey") % 64 * 0.75).alias("longitude"),
        (F.lit(270.0) + F.col("l_quantity") / 10).alias("2m_temperature"),
        (F.col("l_discount") * 100).alias("10m_u_component_of_wind"),
        (F.col("l_tax") * 100).alias("10m_v_component_of_wind"),
        (F.col("l_quantity") / 8000).alias("total_precipitation"),
        (F.lit(100000.0) + F.col("l_linenumber")).alias("surface_pressure"),
        (F.col("l_extendedprice") / 100).alias("convective_available_potential_energy"),
    )
