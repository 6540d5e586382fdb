"""Accuracy, weighted F1 and area under ROC as aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.operators.ordered import cumulative


def confusion(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    return df.groupBy(*by, F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("n")
    )


def accuracy_f1(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and support-weighted F1 from (label, prediction, n) rows, per ``by`` group."""
    zero = F.lit(0).cast("long")
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(zero)
    sides = F.array(
        F.struct(
            F.col("label").alias("cls"),
            F.col("n").alias("actual"),
            zero.alias("predicted"),
            hit.alias("hits"),
        ),
        F.struct(
            F.col("prediction").alias("cls"),
            zero.alias("actual"),
            F.col("n").alias("predicted"),
            zero.alias("hits"),
        ),
    )
    per_class = (
        counts.select(*by, F.inline(sides))
        .groupBy(*by, "cls")
        .agg(*[F.sum(c).alias(c) for c in ("actual", "predicted", "hits")])
    )
    f1 = 2 * F.col("hits") / (F.col("actual") + F.col("predicted"))
    rows = F.sum("actual")
    return per_class.groupBy(*by).agg(
        (F.sum("hits") / rows).alias("accuracy"),
        (F.sum(f1 * F.col("actual")) / rows).alias("f1"),
    )


def area_under_roc(
    df: DataFrame,
    label: str = "label",
    score: str = "score",
    buckets: int | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Exact area under ROC: the share of (positive, negative) pairs in the right order, ties half.

    Null when one class is missing. ``by`` gives one row per group.
    """
    sums = {
        "_pos": F.count(F.when(F.col(label) == 1, 1)),
        "_neg": F.count(F.when(F.col(label) == 0, 1)),
    }
    steps = cumulative(df.select(*by, label, score), score, sums, buckets, by)
    # Both totals come with the bucket offsets, so both uses of the counts share one shuffle.
    pairs = F.max("_pos_total").cast("double") * F.max("_neg_total").cast("double")
    area = F.sum(F.col("_pos").cast("double") * (F.col("_neg_below") + F.col("_neg") / 2))
    return steps.groupBy(*by).agg(F.when(pairs > 0, area / pairs).alias("auc"))


def score_rules(df: DataFrame, rules: dict, label: str = "label") -> DataFrame:
    """Accuracy and F1 of several 0/1 rules in one pass over the rows.

    The rows collapse to one count per combination of label and rule results before they
    are spread over the runs.
    """
    flags = {f"_r{i}": rule for i, rule in enumerate(rules.values())}
    combos = (
        df.select(F.col(label).alias("label"), *[c.cast("double").alias(n) for n, c in flags.items()])
        .groupBy("label", *flags)
        .agg(F.count("*").alias("n"))
    )
    runs = F.array(
        *[
            F.struct(F.lit(name).alias("run_name"), F.col(flag).alias("prediction"))
            for name, flag in zip(rules, flags, strict=True)
        ]
    )
    counts = combos.select("label", "n", F.inline(runs))
    return accuracy_f1(counts, by=("run_name",))
