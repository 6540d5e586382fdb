"""Training, scoring and comparing MLlib classifiers."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager, nullcontext
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow import fixed
from windrow.functions.weather import is_train
from windrow.operators.metrics import accuracy_f1, area_under_roc, confusion

_SIDES = (("train_rows", True), ("test_rows", False))


def assemble(df: DataFrame, features: Sequence[str] = fixed.FEATURE_COLUMNS) -> DataFrame:
    """Add ``features``; all inputs are doubles. Rows with gaps must be gone before this."""
    typed = df.withColumns({c: F.col(c).cast("double") for c in (*features, "label") if c in df.columns})
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(typed)


def model_rows(df: DataFrame, key: str = "event_id", partitions: int | None = None) -> DataFrame:
    """(key, features, label) in a fixed partition and row order.

    Forest training samples per partition, so the forest is the same again only when rows
    lie the same way; ``partitions`` is part of the model settings.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    narrow = df.select(key, *fixed.FEATURE_COLUMNS, "label")
    laid_out = narrow.repartition(n, key).sortWithinPartitions(key)
    return assemble(laid_out).select(key, "features", "label")


@contextmanager
def kept_rows(df: DataFrame, key: str = "event_id", partitions: int | None = None) -> Iterator[DataFrame]:
    """``model_rows`` with the side of each row, kept for every comparison made in the block.

    The key has done its work by then: it gives the order and the side, and is not kept.
    """
    rows = model_rows(df, key, partitions).withColumn("_train", is_train(key)).drop(key)
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield rows
    finally:
        rows.unpersist()


def estimator(spec: dict):
    """The classifier a run specification describes."""
    kind = spec["model_type"]
    if kind == "random_forest":
        return RandomForestClassifier(
            labelCol="label",
            featuresCol="features",
            numTrees=spec["numTrees"],
            maxDepth=spec["maxDepth"],
            seed=spec.get("seed", fixed.MODEL_SEED),
        )
    if kind == "logistic_regression":
        return LogisticRegression(
            labelCol="label", featuresCol="features", maxIter=spec["maxIter"], regParam=spec["regParam"]
        )
    raise ValueError(f"Unknown model type: {kind}")


def score(model, rows: DataFrame) -> DataFrame:
    """Predictions with the probability of class 1 as a plain ``score`` column.

    A model trained on class 0 alone knows no class 1; its score is null.
    """
    return model.transform(rows).withColumn("score", F.get(vector_to_array("probability"), 1))


def evaluate(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, weighted F1 and exact area under ROC, per ``by`` group.

    The area is null when a class is missing.
    """
    quality = accuracy_f1(confusion(scored, by=by), by)
    auc = area_under_roc(scored, by=by)
    if not by:
        return quality.withColumn("auc", auc.scalar())
    return quality.join(auc, list(by), "left")


def fit_and_evaluate(
    df: DataFrame,
    specs: Sequence[dict],
    key: str = "event_id",
    partitions: int | None = None,
    parallelism: int = 2,
    kept: DataFrame | None = None,
) -> list[tuple[dict, object]]:
    """Fit each specification on the same split and evaluate them together.

    Returns one (run record, model) per specification. With one class among the train rows
    all rows are used on both sides. Each fit is a chain of distributed jobs over the kept
    train rows; ``parallelism`` fits run at a time, since the short jobs of one leave a
    cluster idle. Pass 1 when one fit fills it. The scored rows of all runs are evaluated
    in one pass that keeps the runs apart. ``kept`` are the ``kept_rows`` of ``df``, when several
    comparisons share them.
    """
    if not specs:
        return []
    if len({s["run_name"] for s in specs}) < len(specs):
        raise ValueError("runs of one comparison need names of their own")
    scored = None
    with kept_rows(df, key, partitions) if kept is None else nullcontext(kept) as rows:
        try:
            # One job keeps the rows, counts both sides and looks at the train labels.
            sides = rows.groupBy("_train").agg(
                F.count("*").alias("n"), (F.min("label") < F.max("label")).alias("two_classes")
            )
            side = {r["_train"]: r for r in sides.collect()}
            if True in side and side[True]["two_classes"]:
                train, test = rows.where("_train"), rows.where("not _train")
                sizes = {name: side[s]["n"] if s in side else 0 for name, s in _SIDES}
            else:
                train = test = rows
                sizes = {name: sum(r["n"] for r in side.values()) for name, _ in _SIDES}
            fit = inheritable_thread_target(df.sparkSession)(lambda spec: estimator(spec).fit(train))
            with ThreadPool(min(parallelism, len(specs))) as pool:
                models = dict(zip([s["run_name"] for s in specs], pool.map(fit, specs, chunksize=1), strict=True))
            for name, model in models.items():
                run = score(model, test).select(F.lit(name).alias("run_name"), "label", "prediction", "score")
                scored = run if scored is None else scored.unionByName(run)
            scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
            measured = {r["run_name"]: r.asDict() for r in evaluate(scored, by=("run_name",)).collect()}
        finally:
            if scored is not None:
                scored.unpersist()
    if not measured:
        raise ValueError("no test rows to evaluate")
    shared = {
        **sizes,
        "feature_cols": ",".join(fixed.FEATURE_COLUMNS),
        "spark_version": df.sparkSession.version,
    }
    return [(_record(spec, shared, measured[spec["run_name"]]), models[spec["run_name"]]) for spec in specs]


def _record(spec: dict, shared: dict, measured: dict) -> dict:
    return {
        "run_id": uuid.uuid4().hex,
        "run_name": spec["run_name"],
        "params": {**{k: v for k, v in spec.items() if k != "run_name"}, **shared},
        "metrics": {m: measured[m] for m in ("accuracy", "f1", "auc")},
    }


def run_experiments(df: DataFrame, specs: Sequence[dict] = fixed.EXPERIMENTS, **options) -> list[dict]:
    """One record per specification; options as for ``fit_and_evaluate``."""
    return [record for record, _ in fit_and_evaluate(df, specs, **options)]


def train_and_evaluate(df: DataFrame, spec: dict = fixed.FINAL_FOREST, **options) -> tuple[dict, object]:
    """One run: its record and the model fitted on the train rows."""
    return fit_and_evaluate(df, [spec], **options)[0]


def best_spec(records: Sequence[dict], specs: Sequence[dict] = fixed.EXPERIMENTS) -> dict:
    """The specification of the best run: highest F1, then accuracy, then name."""
    best = min(records, key=lambda r: (-r["metrics"]["f1"], -r["metrics"]["accuracy"], r["run_name"]))
    return next(s for s in specs if s["run_name"] == best["run_name"])


def fit_final(df: DataFrame, spec: dict = fixed.FINAL_FOREST, key: str = "event_id", partitions: int | None = None):
    """Fit on all rows: the fixed forest, or whatever specification is handed in."""
    rows = model_rows(df, key, partitions).drop(key).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return estimator(spec).fit(rows)
    finally:
        rows.unpersist()


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)
