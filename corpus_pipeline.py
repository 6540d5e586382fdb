"""From raw documents to token ids: five stages, each over all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of documents. Between stages the rows are a stored table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.llm import common, mixing, near_dups, pieces, queries, secrets, toxicity
from windrow.session import materialise, work_path

#: No statement: a learned model, drawn roundings and a tokenizer are beyond SQL.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled rows of all documents, then drops what it predicts to be toxic."""
    model = toxicity.fit(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model, "text")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8 or more; the smallest id of a group stays."""
    return near_dups.one_of_each(docs, "doc_id", "text")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, without the characters of its secrets."""
    ledger = work_path(spark, "secret-ledger")
    secrets.update_ledger(docs, ledger, "text")
    found = materialise(secrets.findings_by_content(spark, ledger), "findings")
    columns = docs.columns
    rows = docs.select(F.struct("*").alias("_doc"), F.col("text").alias("_text"), secrets.blob("text").alias("_blob"))
    # Few contents have findings, but one may have very many: their sizes are summed.
    width = F.size("findings") * 64 + 160
    rows = rows.join(common.broadcast_if_bounded(found, width), F.col("_blob") == F.col("blob"), "left")
    clean = secrets.redact("_text")
    changed = {"text": clean, "n_chars": F.when(F.size("findings") > 0, F.length(clean).cast("long")).otherwise(F.col("_doc.n_chars"))}
    return rows.select(*[changed.get(c, F.col(f"_doc.`{c}`")).alias(c) for c in columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks; some of them not at all."""
    return mixing.repeated(docs, "doc_id", "source", "text")


#: Of what an encoder remembers alone: the executors' JVMs have grown by the stages before.
ENCODER_SHARE = 0.4


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return queries.digest_ids(pieces.encode(docs, "doc_id", "text", model, ENCODER_SHARE))


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
