"""The table of experiment runs, and ranking over it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow import schemas


def runs_frame(spark: SparkSession, records: Sequence[dict]) -> DataFrame:
    rows = [
        (
            r["run_id"],
            r["run_name"],
            {k: str(v) for k, v in r["params"].items()},
            {k: v for k, v in r["metrics"].items() if v is not None},
        )
        for r in records
    ]
    plain = "run_id string, run_name string, params map<string,string>, metrics map<string,double>"
    return spark.createDataFrame(rows, plain).select(
        "run_id", "run_name", F.current_timestamp().alias("logged_at"), "params", "metrics"
    )


def log_runs(spark: SparkSession, records: Sequence[dict], path: str) -> None:
    """Append all runs of one session in one write."""
    runs_frame(spark, records).coalesce(1).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RUNS).parquet(path)


def run_metrics(runs: DataFrame, names: Sequence[str] = ("accuracy", "f1", "auc")) -> DataFrame:
    return runs.select("run_id", "run_name", *[F.col("metrics")[n].alias(n) for n in names])


def best_run(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc("f1"), F.desc("accuracy"), "run_name").limit(1)


def top_runs(runs: DataFrame, n: int = 5, tie: str = "run_id") -> DataFrame:
    return runs.orderBy(F.desc("f1"), tie).limit(n)
