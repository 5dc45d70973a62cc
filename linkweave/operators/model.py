"""Classifiers over pair features, boosted trees with early stopping among them: fit, score, importances, save and load."""

from __future__ import annotations

import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweave.functions.text import split_name
from linkweave.sources.scratch import written
from linkweave.sources.tables import in_order

#: Families of models that ``fit`` knows.
FAMILIES = ("boosted", "forest", "linear")
#: Names of the splits, in the order of their shares.
SPLITS = ("train", "dev", "val")


#: Distinct rows that one task of a fit holds, and distinct rows of features up to which their scores are broadcast.
ROWS_EACH, MOST_SENT = 1 << 16, 1 << 17


def with_split(df: DataFrame, column: str = "s1_id", **options) -> DataFrame:
    """``df`` with train, dev or val by entity, so an entity's pairs stay together."""
    return df.withColumn("split", split_name(column, **options))


def prefix_split(df: DataFrame, share: float = 0.6, column: str = "s1_id") -> DataFrame:
    """``df`` with train for the first ``share`` of entities in order of id, else val."""
    return _cut(df, share, column, F.col(column))


def shuffled_split(df: DataFrame, share: float = 0.6, seed: int = 42, column: str = "s1_id") -> DataFrame:
    """``df`` with train for ``share`` of the entities in an order that a seeded hash decides, else val."""
    return _cut(df, share, column, F.md5(F.concat(F.lit(f"{seed}:"), F.col(column))))


def _cut(df: DataFrame, share: float, column: str, key: Column) -> DataFrame:
    placed = in_order(df.select(column, key.alias("_key")).where(F.col(column).isNotNull()).distinct(), ["_key", column], "_place")
    cut = int(placed.count() * share)
    side = placed.select(F.col(column).alias("_entity"), F.when(F.col("_place") < cut, "train").otherwise("val").alias("split"))
    return df.join(side, F.col(column) == F.col("_entity"), "left").drop("_entity")


def fit(rows: DataFrame, features: list[str], label: str = "target", trees: int = 500, depth: int = 5, rate: float = 0.1, seed: int = 42, family: str = "boosted", weight: str | None = None) -> PipelineModel:
    """A model of ``family`` (boosted, forest or linear) fitted on the train split; with a dev split, boosting stops adding trees when dev loss stops falling.

    Missing feature values count as -1. ``trees``, ``depth`` and ``seed`` are for trees,
    ``rate`` for boosting; a linear model takes up to 100 steps on scaled features. Equal rows
    are fitted as one with their number as weight, but for a forest, which draws rows. ``weight``
    names a column that says for how many rows each one stands.
    """
    data = rows.fillna(-1.0, features).withColumn(label, F.col(label).cast("double"))
    named = {"labelCol": label, "featuresCol": "features"}
    if family == "boosted":
        trained = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=rate, seed=seed, validationTol=0.001, **named)
    elif family == "forest":
        trained = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, **named)
    elif family == "linear":
        trained = LogisticRegression(maxIter=100, regParam=0.001, **named)
    else:
        raise ValueError(f"unknown family {family}")
    if "split" in rows.columns:
        held = data.where("split IN ('train', 'dev')").withColumn("is_dev", F.col("split") == "dev")
        if family == "boosted" and not held.where("is_dev").isEmpty():
            data, trained = held, trained.setValidationIndicatorCol("is_dev")
        else:
            data = data.where("split = 'train'")
    if weight and family == "forest":
        data, trained = data.withColumn("_weight", F.col(weight).cast("double")), trained.setWeightCol("_weight")
    if family != "forest":
        keys = [c for c in (*features, label, "is_dev") if c in data.columns]
        data = written(data.groupBy(*dict.fromkeys(keys)).agg((F.sum(weight) if weight else F.count("*")).cast("double").alias("_weight")), "weighted-rows")
        # Each level of each tree is a job over all of its tasks.
        tasks = -(-data.count() // ROWS_EACH)
        data = data.coalesce(1) if tasks <= 1 else data.repartition(tasks, *features)
        trained = trained.setWeightCol("_weight")
    # Boosting reads the dev rows again for each tree.
    data = data.persist()
    found = Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features"), trained]).fit(data)
    data.unpersist()
    return found


def fit_best(rows: DataFrame, features: list[str], label: str = "target", families: tuple[str, ...] = FAMILIES, **options) -> tuple[PipelineModel, str, dict[str, float]]:
    """The model of the family with the least log loss on the dev split, its name, and the loss of each; ties go to the family named first."""
    models = {f: fit(rows, features, label, family=f, **options) for f in families}
    losses = {}
    for name, found in models.items():
        p = F.least(F.greatest("p", F.lit(1e-6)), F.lit(1 - 1e-6))
        loss = F.when(F.col(label) == 1, -F.log(p)).otherwise(-F.log(1 - p))
        losses[name] = score(found, rows.where("split = 'dev'"), features).agg(F.avg(loss)).first()[0]
    if None in losses.values():
        raise ValueError("no rows in the dev split")
    best = min(families, key=lambda f: (losses[f], families.index(f)))
    return models[best], best, losses


def score(model: PipelineModel, rows: DataFrame, features: list[str]) -> DataFrame:
    """``rows`` with ``p``, the probability of a match; equal features are scored once where they are few enough to be sent to the rows."""
    filled = rows.fillna(-1.0, features)
    scored = lambda df: model.transform(df).withColumn("p", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")
    kinds = written(filled.select(*features).distinct(), "kinds")
    if kinds.count() > MOST_SENT:
        return scored(filled)
    sent = written(scored(kinds), "kinds-scored")
    return filled.join(F.broadcast(sent), features).select(*filled.columns, "p")


def importances(model: PipelineModel, features: list[str]) -> list[tuple[str, float]]:
    """Features by importance (of a linear model: the size of the coefficient), ties by name."""
    last = model.stages[-1]
    values = last.featureImportances.toArray() if hasattr(last, "featureImportances") else abs(last.coefficients.toArray())
    return sorted(zip(features, map(float, values), strict=True), key=lambda x: (-x[1], x[0]))


def save(model: PipelineModel, path: str, threshold: float, features: list[str], metrics: dict) -> None:
    """The model, and beside it the threshold, features and metrics as one JSON row."""
    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.active()
    row = json.dumps({"threshold": threshold, "features": features, "metrics": metrics}, sort_keys=True)
    spark.createDataFrame([(row,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def load(spark, path: str) -> tuple[PipelineModel, dict]:
    return PipelineModel.load(f"{path}/model"), json.loads(spark.read.text(f"{path}/metadata").first()[0])
