"""Two-stage scoring with Spark ML: out-of-fold first scores feed the second stage."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import features, metrics

FOLDS = 5
#: What the second stage takes: the first stage's features, its score, and its own.
STAGE2_NAMES = [*features.STAGE1, "score1", *features.STAGE2]


def assembled(rows: DataFrame, names: list[str]) -> DataFrame:
    """rows with a vector of the named columns, in order; a model of fewer leading columns reads its part."""
    cast = rows.withColumns({f"__{n}": F.coalesce(F.col(n).cast("double"), F.lit(0.0)) for n in names})
    return VectorAssembler(inputCols=[f"__{n}" for n in names], outputCol="__x").transform(cast).drop(*[f"__{n}" for n in names])


def train(rows: DataFrame, names: list[str], trees: int = 20, depth: int = 5, step: float = 0.1, stop: str | None = None) -> Model:
    """Boosted trees on label y; stop names a boolean column of the rows that early stopping watches."""
    gbt = GBTClassifier(labelCol="y", featuresCol="__x", maxIter=trees, maxDepth=depth, maxBins=256, stepSize=step, minInstancesPerNode=20, featureSubsetStrategy="0.85", subsamplingRate=0.8, seed=42)
    if stop:
        gbt = gbt.setValidationIndicatorCol(stop)
    return gbt.fit(assembled(rows, names).withColumn("y", F.col("y").cast("double")))


def score(rows: DataFrame, model: Model, names: list[str], out: str) -> DataFrame:
    made = model.transform(assembled(rows, names[: model.numFeatures]))
    return made.withColumn(out, vector_to_array("probability")[1]).drop("__x", "rawPrediction", "probability", "prediction")


def importance_table(spark, model: Model, names: list[str], k: int = 20) -> DataFrame:
    """feature, gain of the k features that gain most; at most k rows."""
    return spark.createDataFrame(importance(model, names, k), "feature string, gain double")


def out_of_fold(rows: DataFrame, names: list[str], entity: str = "entity", out: str = "score1", **kw) -> DataFrame:
    """rows with the score of a model that has not seen their entity."""
    rows = rows.withColumn("__fold", metrics.fold(F.col(entity)))
    parts = []
    for k in range(FOLDS):
        model = train(rows.where(F.col("__fold") != k), names, **kw)
        parts.append(score(rows.where(F.col("__fold") == k), model, names, out))
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union.drop("__fold")


def importance(model: Model, names: list[str], k: int = 20) -> list[tuple[str, float]]:
    gain = model.featureImportances.toArray()
    return sorted(zip(names, map(float, gain), strict=False), key=lambda x: (-x[1], x[0]))[:k]


def pair_scorer(load):
    """A UDF of (left text, right text) from a scorer that load() makes once a worker; any model that scores lists of pairs fits in."""

    @F.pandas_udf("double")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        scorer = load()
        for left, right in batches:
            yield pd.Series(scorer(left.tolist(), right.tolist()), dtype="float64")

    return run
