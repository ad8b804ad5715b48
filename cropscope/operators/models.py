"""Spark ML models (M1-M11, K3, S9): yield regressors and the disease classifier.

Every model is a ``Pipeline`` that assembles its own feature vector from named
columns, so the input column list travels with the saved model (D2) and
scoring is one ``transform`` over the whole table (M9), not a job per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.rules import risk_code_label
from ..sources import commits

TASK_ROWS = 1 << 15  # training rows of one task


def linear_yield_pipeline(features: Sequence[str], label: str = "yield") -> Pipeline:
    """M8: assembler + unregularised least squares (100 iterations, tol 1e-6). Fit it
    with :func:`fit`, which leaves incomplete rows out of the fit only."""
    asm = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    lr = LinearRegression(featuresCol="features", labelCol=label, **K.LINEAR)
    return Pipeline(stages=[asm, lr])


def yield_forest_pipeline(features: Sequence[str] = K.YIELD_FEATURES_6,
                          category: str = "region", label: str = "yield") -> Pipeline:
    """M1 + M2 + M3 + M7: region index (unseen regions kept), 6-wide vector,
    random-forest regressor (100 trees, depth 5, seed 42)."""
    idx = StringIndexer(inputCol=category, outputCol=f"{category}_index", handleInvalid="keep")
    asm = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    rf = RandomForestRegressor(featuresCol="features", labelCol=label, **K.YIELD_FOREST)
    return Pipeline(stages=[idx, asm, rf])


def disease_forest_pipeline(features: Sequence[str] = K.DISEASE_FEATURES,
                            label: str = "disease_risk") -> Pipeline:
    """M4 + M5 + M6 + M7: 3-wide vector, standardised (mean and std), random
    forest classifier (50 trees, depth 5, seed 42)."""
    asm = VectorAssembler(inputCols=list(features), outputCol="raw_features",
                          handleInvalid="keep")
    scaler = StandardScaler(inputCol="raw_features", outputCol="features",
                            withStd=True, withMean=True)
    rf = RandomForestClassifier(featuresCol="features", labelCol=label, **K.DISEASE_FOREST)
    return Pipeline(stages=[asm, scaler, rf])


def disease_training_rows(spark):
    """The five literal training rows (a test fixture, not a data source)."""
    return spark.createDataFrame(
        [(float(n), float(h), float(w), int(c)) for n, h, w, c in K.DISEASE_TRAINING_ROWS],
        "ndvi double, humidity double, leaf_wetness double, disease_risk int")


def save(model: PipelineModel, path: str) -> str:
    """K3: write the fitted pipeline, overwriting."""
    model.write().overwrite().save(path)
    return path


def load(path: str) -> PipelineModel:
    """Load once per job, then score whole tables."""
    return PipelineModel.load(path)


def save_version(spark: SparkSession, model: PipelineModel, root: str) -> int:
    """K3 for a model that is read while it is renewed: a folder of its own per version,
    ``root/v=N``, which counts once its number is committed. Nothing is overwritten; a
    save that broke off leaves a folder without a record, and its number is not used again."""
    used = [int(n[2:]) for n in commits.names(spark, root) if n.startswith("v=")]
    version = max(used, default=0) + 1
    model.write().save(f"{root}/v={version}")
    commits.commit(spark, f"{root}/_versions", version)
    return version


def load_version(spark: SparkSession, root: str, version: int | None = None) -> PipelineModel:
    """A committed version of a model, the last one unless another is named."""
    known = commits.committed(spark, f"{root}/_versions")
    if version is None and known:
        version = known[-1]
    if version not in known:
        raise FileNotFoundError(f"no committed version {version or ''} of a model in {root}")
    return PipelineModel.load(f"{root}/v={version}")


def _complete(columns: Sequence[str], df: DataFrame) -> Column:
    """Every one of ``columns`` that ``df`` holds is there and not NaN."""
    ok = F.lit(True)
    for c in columns:
        if c in df.columns:
            v = F.col(c)
            number = dict(df.dtypes)[c] in ("double", "float")
            ok = ok & v.isNotNull() & (~F.isnan(v) if number else F.lit(True))
    return ok


def feature_columns(stages) -> list[str]:
    """Input columns of the assembler in a pipeline or a fitted model."""
    return [c for s in stages if isinstance(s, VectorAssembler) for c in s.getInputCols()]


def fit(pipeline: Pipeline, df: DataFrame, label: str = "yield") -> PipelineModel:
    """Fit on the rows whose features and label are complete. Those rows are cached for
    the fit (Spark ML passes over its input many times) and released after it. More than
    ``TASK_ROWS`` are dealt out evenly first: a file of few row groups is few partitions, and
    a forest reads each of its partitions whole in one task, at every level."""
    train = df.where(_complete([*feature_columns(pipeline.getStages()), label], df))
    rows = train.count()
    if rows > TASK_ROWS:
        train = train.repartition(-(-rows // TASK_ROWS))
    train = train.cache()
    try:
        return pipeline.fit(train)
    finally:
        train.unpersist()


def predict(model: PipelineModel, df: DataFrame, out: str = "prediction") -> DataFrame:
    """Every row of ``df`` with its prediction; NULL where a feature is missing."""
    ok = _complete(feature_columns(model.stages), df)
    made = [c for c in model.transform(df.limit(0)).columns if c not in df.columns]
    scored = model.transform(df.withColumn("_ok", ok))
    value = F.when(F.col("_ok"), F.col("prediction").cast("double"))
    return scored.withColumn("_out", value).drop(*made, "_ok").withColumnRenamed("_out", out)


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """M9: one ``transform`` over the whole table; ``keep`` + prediction of every row."""
    return predict(model, df).select(*keep, "prediction")


def score_risk(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """M9 + M10: classifier prediction and its text label."""
    return score(model, df, keep).withColumn("risk_label", risk_code_label("prediction"))
