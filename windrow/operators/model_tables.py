"""Saved models as tables, and scores from those tables by plain column expressions.

A model scored this way needs no MLlib where it is used, and its scores are a second, independent
reading of what the training wrote. A model is as small as its settings, so its rows come
to the driver and become one expression for each tree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow import fixed


def forest_nodes(spark: SparkSession, path: str) -> DataFrame:
    """tree, node, prediction, shares (of the classes among its train rows), feature, threshold, below, above.

    A leaf has null feature, threshold and children; a row goes below when its value is at most the threshold.
    """
    stored = spark.read.parquet(f"{path.rstrip('/')}/data").select("treeID", "nodeData.*")
    total = F.aggregate("impurityStats", F.lit(0.0), lambda a, x: a + x)
    inner = F.col("leftChild") >= 0
    return stored.select(
        F.col("treeID").alias("tree"),
        F.col("id").alias("node"),
        "prediction",
        F.transform("impurityStats", lambda x: x / total).alias("shares"),
        F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.when(inner, F.col("leftChild")).alias("below"),
        F.when(inner, F.col("rightChild")).alias("above"),
        F.when(inner, F.col("split.numCategories")).alias("categories"),
    )


def regression_terms(spark: SparkSession, path: str) -> DataFrame:
    """feature, coefficient; the intercept has no feature. For a model of two classes."""
    stored = spark.read.parquet(f"{path.rstrip('/')}/data").first()
    if stored["isMultinomial"]:
        raise ValueError("only models of two classes are read as terms")
    rows = [(i, float(c)) for i, c in enumerate(stored["coefficientMatrix"].toArray()[0])]
    return spark.createDataFrame([*rows, (None, float(stored["interceptVector"][0]))], "feature int, coefficient double")


def _kind(spark: SparkSession, path: str) -> str:
    metadata = spark.read.text(f"{path.rstrip('/')}/metadata")
    return metadata.select(F.get_json_object("value", "$.class")).first()[0].rsplit(".", 1)[-1]


def _votes(nodes: Sequence, features: Sequence[str], class_index: int) -> Column:
    """One tree: the share of a class in the leaf that a row comes to."""
    by_id = {n["node"]: n for n in nodes}

    def reached(node) -> Column:
        if node["feature"] is None:
            return F.lit(float(node["shares"][class_index]))
        if node["categories"] is not None and node["categories"] >= 0:
            raise ValueError("splits on categories are not read")
        goes_below = F.col(features[node["feature"]]) <= F.lit(node["threshold"])
        return F.when(goes_below, reached(by_id[node["below"]])).otherwise(reached(by_id[node["above"]]))

    return reached(by_id[0])


def score_by_tables(df: DataFrame, path: str, features: Sequence[str] = fixed.FEATURE_COLUMNS) -> DataFrame:
    """``df`` with ``prediction`` and ``score``, the probability of class 1, of the model saved at ``path``.

    A model that was trained on class 0 alone has a null score. Features are read as doubles;
    rows with gaps must be gone before this.
    """
    spark = df.sparkSession
    names = [f"_f{i}" for i in range(len(features))]
    rows = df.select("*", *[F.col(c).cast("double").alias(n) for c, n in zip(features, names)])
    if _kind(spark, path) == "LogisticRegressionModel":
        terms = regression_terms(spark, path).collect()
        margin = F.lit(next(t["coefficient"] for t in terms if t["feature"] is None))
        for t in terms:
            if t["feature"] is not None:
                margin = margin + F.lit(t["coefficient"]) * F.col(names[t["feature"]])
        rows = rows.withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)))
        return rows.withColumn("prediction", (F.col("score") > 0.5).cast("double")).drop(*names)
    trees: dict[int, list] = {}
    for n in forest_nodes(spark, path).collect():
        trees.setdefault(n["tree"], []).append(n)
    classes = len(next(iter(trees.values()))[0]["shares"])
    if classes < 2:
        return rows.select(*df.columns, F.lit(0.0).alias("prediction"), F.lit(None).cast("double").alias("score"))
    for k in range(classes):
        sum_of = None
        for t in sorted(trees):
            vote = _votes(trees[t], names, k)
            sum_of = vote if sum_of is None else sum_of + vote
        rows = rows.withColumn(f"_v{k}", sum_of)
    votes = [F.col(f"_v{k}") for k in range(classes)]
    most = F.greatest(*votes)
    # The smallest class among those with most votes.
    best = F.coalesce(*[F.when(v == most, F.lit(float(k))) for k, v in enumerate(votes)])
    every = votes[0]
    for v in votes[1:]:
        every = every + v
    scored = rows.withColumns({"prediction": best, "score": votes[1] / every})
    return scored.drop(*names, *[f"_v{k}" for k in range(classes)])
