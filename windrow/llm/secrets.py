"""Secret scans with an incremental ledger of contents.

Every stored version of a file is named by the SHA-256 of its bytes. The ledger records which
rule versions have read which content and what they found; a run scans only pairs of content
and rule version that are not in it yet, and joins the findings back to every path.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.llm import common
from windrow.session import materialise

#: New contents up to which their names, some 200 bytes each, are sent to where the texts stand.
FEW = 50_000

FINDING = "array<struct<start:int,place:int,end:int,kind:string>>"
LEDGER = f"blob string, rules array<string>, findings {FINDING}"


@dataclass(frozen=True)
class Rule:
    """``least`` characters are asked of ``group`` of a match; shorter matches are dropped."""

    kind: str
    version: int
    pattern: str
    least: int
    group: int = 0

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


#: The three base rules, in the order in which kinds are listed.
RULES = (
    Rule(
        "assign",
        1,
        r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        8,
        2,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 16),
    Rule("hex", 1, r"[0-9a-f]+", 32),
)


def _spans(text: str, rules: Sequence[tuple[int, Rule, re.Pattern]]) -> list[tuple]:
    found = []
    for place, rule, pattern in rules:
        for m in pattern.finditer(text):
            if m.end(rule.group) - m.start(rule.group) >= rule.least:
                found.append((m.start(), place, m.end(), rule.kind))
    return sorted(found)


def _scanner(rules: Sequence[Rule]):
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compiled = {r.name: (i, r, re.compile(r.pattern)) for i, r in enumerate(rules)}
        for batch in batches:
            found = [
                [dict(zip(("start", "place", "end", "kind"), s)) for s in _spans(t, [compiled[x] for x in todo])]
                for t, todo in zip(batch["text"], batch["rules"])
            ]
            yield pd.DataFrame({"blob": batch["blob"], "rules": batch["rules"], "findings": found})

    return scan


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER).parquet(ledger)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def update_ledger(versions: DataFrame, ledger: str, text: str, rules: Sequence[Rule] = RULES) -> None:
    """Scan what the ledger has not seen and append it; one row for each content scanned.

    Names alone are compared with the ledger; a run in which nothing is new moves no text, and
    few new contents are looked for where they stand. A content is scanned once however many
    paths hold it: copies meet in a partial aggregate before the shuffle. A job that fails
    leaves no row, so its contents are scanned by the next run; rows that are there twice do
    no harm.
    """
    spark = versions.sparkSession
    names = F.array(*[F.lit(r.name) for r in rules])
    seen = read_ledger(spark, ledger).groupBy("blob").agg(F.flatten(F.collect_list("rules")).alias("seen"))
    todo = versions.select(blob(text).alias("blob")).distinct().join(seen, "blob", "left")
    todo = todo.select("blob", F.array_except(names, F.coalesce("seen", F.array().cast("array<string>"))).alias("rules"))
    todo = materialise(todo.where(F.size("rules") > 0), "unseen")
    if todo.isEmpty():
        return
    contents = versions.select(blob(text).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    few = todo.limit(FEW + 1).count() <= FEW
    if few:
        contents = contents.join(F.broadcast(todo.select("blob")), "blob", "left_semi")
    contents = contents.dropDuplicates(["blob"])
    rows = contents.join(F.broadcast(todo) if few else todo, "blob").select("blob", "text", "rules")
    common.in_small_batches(rows).mapInPandas(_scanner(rules), LEDGER).write.mode("append").parquet(ledger)


def findings_by_content(spark: SparkSession, ledger: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(blob, findings) of every content in which the given rule versions found something."""
    rows = read_ledger(spark, ledger).select("blob", "rules", F.explode("findings").alias("f"))
    # A rule's older version may have left findings too: a row counts for the versions that wrote it.
    current = F.lit(False)
    for rule in rules:
        current |= (F.col("f.kind") == rule.kind) & F.array_contains("rules", rule.name)
    found = rows.where(current).groupBy("blob")
    return found.agg(F.sort_array(F.collect_set("f")).alias("findings"))


def blob(text: str):
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)


def findings_by_path(
    versions: DataFrame, ledger: str, paths: Sequence[str], text: str, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """The ``paths`` columns and ``findings`` of every row, from the ledger only.

    The join is on the content's name. A content that a third of all rows share makes that
    key hot on the side of the paths, whose rows are narrow, and adaptive execution splits it.
    """
    found = findings_by_content(versions.sparkSession, ledger, rules)
    held = versions.select(*[F.col(p).alias(f"_p{i}") for i, p in enumerate(paths)], blob(text).alias("_blob"))
    return held.join(found, F.col("_blob") == F.col("blob"), "left").select(
        *[F.col(f"_p{i}").alias(p) for i, p in enumerate(paths)],
        F.coalesce("findings", F.array().cast(FINDING)).alias("findings"),
    )


def scan(
    versions: DataFrame, ledger: str, paths: Sequence[str], text: str, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """Bring the ledger up to date with ``versions`` and return the findings of each of its rows.

    One row out per row in: ``paths`` and ``findings`` (start, place of the rule in the list,
    end, kind), sorted. Offsets count code points, ends are exclusive. A null text counts as
    empty; empty texts and tables give no findings; repeated rows each get theirs. Only the
    named columns are read, so further columns of any name do not matter.
    """
    update_ledger(versions, ledger, text, rules)
    return findings_by_path(versions, ledger, paths, text, rules)


def redact(text: str, findings: str = "findings", mask: str = "[REDACTED]"):
    """A column: the text with each stretch of found characters replaced; overlapping finds are one stretch."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(done, f):
        gap = F.substring(F.col(text), done["at"] + 1, f["start"] - done["at"])
        fresh = F.concat(done["out"], gap, F.lit(mask))
        return F.struct(
            F.greatest(done["at"], f["end"]).alias("at"),
            F.when(f["start"] >= done["at"], fresh).otherwise(done["out"]).alias("out"),
        )

    rest = lambda d: F.concat(d["out"], F.substring(F.col(text), d["at"] + 1, F.length(F.col(text))))
    return F.when(F.coalesce(F.size(findings), F.lit(0)) <= 0, F.col(text)).otherwise(F.aggregate(findings, start, step, rest))
