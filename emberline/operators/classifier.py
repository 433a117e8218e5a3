"""A triage classifier with its column transformer: fitted, stored, loaded and applied to rows it was not fitted on."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import Imputer, MinMaxScaler, RobustScaler, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scoring import triage_state, validation_state

_SCALERS = {"minmax": MinMaxScaler, "robust": lambda **k: RobustScaler(withCentering=True, **k), "standard": lambda **k: StandardScaler(withMean=True, **k)}


def feature_matrix(rows: DataFrame, columns: list[str], belief: str | None = None, least_belief: float = 0.5) -> DataFrame:
    """rows with their feature columns as doubles, NaN as null, and `label`: 1 if the belief is least_belief or more, 0 if less or unknown."""
    out = rows.withColumns({c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns})
    return out if belief is None else out.withColumn("label", F.coalesce((F.col(belief) >= least_belief).cast("double"), F.lit(0.0)))


def fit(matrix: DataFrame, scaling: dict[str, str], trees: int = 20, depth: int = 5, seed: int = 3) -> PipelineModel:
    """A forest on feature_matrix() rows. scaling: kind (minmax, robust, standard) by column; missing values become the median of their column."""
    filled = {c: f"_filled_{c}" for c in scaling}
    stages = [Imputer(strategy="median", inputCols=list(filled), outputCols=list(filled.values()))]
    for kind in sorted(set(scaling.values())):
        stages.append(VectorAssembler(inputCols=[filled[c] for c, k in scaling.items() if k == kind], outputCol=f"_{kind}"))
        stages.append(_SCALERS[kind](inputCol=f"_{kind}", outputCol=f"_scaled_{kind}"))
    stages.append(VectorAssembler(inputCols=[f"_scaled_{k}" for k in sorted(set(scaling.values()))], outputCol="_features"))
    stages.append(RandomForestClassifier(featuresCol="_features", labelCol="label", probabilityCol="_probability", rawPredictionCol="_raw", predictionCol="_prediction", numTrees=trees, maxDepth=depth, seed=seed))
    return Pipeline(stages=stages).fit(matrix)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def scored(model: PipelineModel, matrix: DataFrame) -> DataFrame:
    """matrix with `score`, the model's probability of label 1; a label is not needed. A forest that met label 0 alone has no
    place for label 1: its probability is 0."""
    probability = vector_to_array("_probability")
    out = model.transform(matrix).withColumn("score", F.when(F.size(probability) == 1, 0.0).otherwise(F.get(probability, F.lit(1))))
    return out.select(*matrix.columns, "score")


def assessed(rows: DataFrame, strength: Column, size: Column, forced_size: int, threshold: float, low: float, high: float) -> DataFrame:
    """rows (score) with the score set back by `strength` and held within 0 and 1, `forced` if more than forced_size groups, and the
    states that follow. A null score stays null: its states are N/A, or those of a forced row."""
    score = F.least(F.greatest(F.col("score") - strength, F.lit(0.0)), F.lit(1.0))
    rows = rows.withColumn("score", F.when(F.col("score").isNotNull(), score)).withColumn("forced", size > forced_size)
    return rows.withColumns({"triage": triage_state(F.col("score"), threshold, F.col("forced")), "validation": validation_state(F.col("score"), low, high, F.col("forced"))})
