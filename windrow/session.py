"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a side may be broadcast. Only narrow rows (ids, codes,
#: coordinates) go through ``broadcast_if_small``, so this stays below 100 MB.
BROADCAST_ROWS = 500_000


def build_session(app: str = "windrow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults every job here expects; ``conf`` overrides them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # A value that does not parse is an error, not a null.
        "spark.sql.ansi.enabled": "true",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Calendar columns and text times are in UTC, whatever the caller's session says."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. A machine-local folder is used
    only when Spark itself runs in this one process.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder all executors share.")
        root = tempfile.mkdtemp(prefix="windrow-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{work_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, file_rows: int = 0) -> DataFrame:
    """Cut the lineage with a written table, so that a lost executor costs a re-read.

    ``file_rows`` bounds the rows of a file: few tasks may write, yet many can read.
    """
    path = work_path(df.sparkSession, name)
    df.write.option("maxRecordsPerFile", file_rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Has ``df`` at most ``max_rows`` rows; counts no further than that."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting; beyond the bound Spark plans a shuffled join."""
    return F.broadcast(df) if is_small(df, max_rows) else df
