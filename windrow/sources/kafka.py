"""Reading weather events from a topic. The connector jar comes with the cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrow import fixed, schemas


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str = fixed.TOPIC,
    max_offsets: int | None = None,
    **options: str,
) -> DataFrame:
    """A streaming reader that starts at the end of the topic.

    Progress is kept in the checkpoint of the query, not in a consumer group.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .options(**options)
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load()


def _parsed(records: DataFrame) -> DataFrame:
    """``_text``, and ``_fields``: a map of the top-level values, from one parse of each record.

    Null for what is no JSON object, and for records with a bare NaN, which only the reader by
    schema takes.
    """
    text = records.withColumn("_text", F.col("value").cast("string"))
    whole = text.withColumn("_whole", F.try_parse_json("_text"))
    return whole.withColumn("_fields", F.try_variant_get("_whole", "$", "map<string,variant>"))


def _unknown(schema: T.StructType) -> Column:
    return F.map_filter("_fields", lambda name, _: ~name.isin(*schema.names))


def decode(records: DataFrame, schema: T.StructType = schemas.EVENT) -> DataFrame:
    """Topic records to events with their delivery columns, and ``_rest`` for unknown fields.

    ``_rest`` is null where the schema knows all fields of a record. A value that does not
    suit its type, and a record that is no JSON, are errors.
    On a stream the ingest time is that of the micro-batch, so a retried batch repeats it.
    """
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    # One walk over a record's fields, not one look from the top for each column.
    columns = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in schema.fields)
    event = F.variant_get("_whole", "$", f"struct<{columns}>")
    by_schema = F.from_json("_text", schema, {"mode": "FAILFAST"})
    rest = F.transform_values(_unknown(schema), lambda _, value: F.variant_get(value, "$", "string"))
    # Of a record that only the reader by schema takes, the rest is parsed once more.
    odd = F.map_filter(F.from_json("_text", schemas.REST.dataType), lambda name, _: ~name.isin(*schema.names))
    parsed = F.col("_fields").isNotNull()
    return (
        _parsed(records)
        .select(
            F.when(parsed, event).otherwise(by_schema).alias("e"),
            F.when(parsed, rest).otherwise(odd).alias("r"),
            F.col("topic").alias("_kafka_topic"),
            F.col("partition").alias("_kafka_partition"),
            F.col("offset").alias("_kafka_offset"),
            now.alias("_ingested_at_utc"),
        )
        .select("e.*", *fixed.DELIVERY_COLUMNS, F.when(F.size("r") > 0, F.col("r")).alias(schemas.REST.name))
    )


def new_fields(records: DataFrame, schema: T.StructType = schemas.EVENT) -> DataFrame:
    """Fields that the schema does not know, by the type they came with: how often, and where first and last.

    One parse of each record and one aggregate; names and types are few, so the shuffle is small.
    """
    found = _parsed(records).select("partition", "offset", F.explode(_unknown(schema)).alias("field_name", "value"))
    return found.groupBy("field_name", F.schema_of_variant("value").alias("field_type")).agg(
        F.count("*").alias("record_count"),
        F.min(F.struct("partition", "offset")).alias("first"),
        F.max(F.struct("partition", "offset")).alias("last"),
    ).select(
        "field_name",
        "field_type",
        "record_count",
        *[F.col(f"{at}.{c}").alias(f"{at}_{c}") for at in ("first", "last") for c in ("partition", "offset")],
    )
