"""Binary files written and read by Spark's own writers and readers.

Tasks hand over whole files as rows; Spark's text writer puts each into a directory of its own
below the target, through the job's commit protocol and whatever file system the path names.
The writer ends a row with a separator, so a file's last byte is handed over as the separator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The last byte of every file written here.
END = b"\0"


def write(files: DataFrame, path: str, name: str, content: str) -> None:
    """One file per row; ``content`` must end in ``END``, ``name`` is its directory."""
    body = F.expr(f"substring(`{content}`, 1, length(`{content}`) - {len(END)})").cast("string")
    # The rows of a task go to one file for each name; names are unique.
    files.select(F.col(name).alias("name"), body.alias("value")).write.partitionBy("name").option(
        "lineSep", END.decode()
    ).text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(name, content) of each file; an empty table where nothing was written."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true")
    return found.load(path).select(F.regexp_extract("path", "/name=([^/]+)/[^/]+$", 1).alias("name"), "content")
