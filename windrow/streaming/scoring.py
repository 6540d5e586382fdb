"""Scoring feature rows as they arrive, with a saved model."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegressionModel, RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from windrow import schemas
from windrow.operators.training import assemble, score

_KINDS = {c.__name__: c for c in (RandomForestClassificationModel, LogisticRegressionModel)}


def load_model(path: str):
    """A saved model, of the class that its own metadata names."""
    spark = SparkSession.active()
    metadata = spark.read.text(f"{path.rstrip('/')}/metadata")
    name = metadata.select(F.get_json_object("value", "$.class")).first()[0]
    return _KINDS[name.rsplit(".", 1)[-1]].load(path)


def read_gold_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schemas.GOLD)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def scored(features: DataFrame, model) -> DataFrame:
    """Key columns with prediction and score; works on a batch and on a stream."""
    return score(model, assemble(features)).select(
        "event_id", "airport", "timestamp_utc", "prediction", "score"
    )


def start_scoring(features: DataFrame, model, path: str, checkpoint: str) -> StreamingQuery:
    """Append scored rows to a Parquet table; the file sink writes each batch once."""
    return (
        scored(features, model)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
