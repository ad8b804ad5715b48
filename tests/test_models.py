"""Spark ML: linear model equals least squares, forests score every row."""

import pytest
from pyspark.sql import functions as F

from cropscope.functions import constants as K
from cropscope.operators import models
from cropscope.session import shared_path


def test_disease_classifier_on_literal_rows(spark):
    train = models.disease_training_rows(spark)
    model = models.disease_forest_pipeline().fit(train)
    path = models.save(model, shared_path(spark, "test_disease"))
    smoke = spark.createDataFrame([(0.48, 82.0, 7.8)], "ndvi double, humidity double, leaf_wetness double")
    out = models.score_risk(models.load(path), smoke, ["ndvi"]).collect()[0]
    assert out.prediction in {0.0, 1.0, 2.0, 3.0}
    assert out.risk_label in set(K.RISK_CODE_LABELS.values())


def test_linear_one_feature_equals_regr_slope(spark):
    rows = [(float(i), 0.5 + 2.0 * i + (0.1 if i % 3 else -0.2)) for i in range(30)]
    df = spark.createDataFrame(rows, "mean_ndvi double, yield double")
    model = models.linear_yield_pipeline(["mean_ndvi"]).fit(df)
    lr = model.stages[-1]
    ref = df.agg(F.regr_slope("yield", "mean_ndvi").alias("s"),
                 F.regr_intercept("yield", "mean_ndvi").alias("i")).first()
    assert lr.coefficients[0] == pytest.approx(ref.s, rel=1e-9)
    assert lr.intercept == pytest.approx(ref.i, rel=1e-9)
    # residuals are orthogonal to the feature
    res = model.transform(df).select(F.sum((F.col("yield") - F.col("prediction")) * F.col("mean_ndvi"))).first()[0]
    assert abs(res) < 1e-6


def test_yield_forest_scores_all_rows(spark):
    rows = [(float(i) / 10, 100.0 + i, 20.0 + i % 5, 6.5, 100.0, ["North", "South"][i % 2], 1.0 + i / 10)
            for i in range(40)]
    df = spark.createDataFrame(rows, "mean_ndvi double, rainfall double, temperature double, soil_ph double, "
                                     "fertilizer double, region string, yield double")
    model = models.yield_forest_pipeline().fit(df)
    unseen = df.limit(3).withColumn("region", F.lit("West"))      # unseen region is kept, not an error
    out = models.score(model, df.unionByName(unseen), ["region"])
    assert out.count() == 43 and out.where(F.col("prediction").isNull()).count() == 0


def test_scoring_keeps_rows_with_missing_features(spark):
    train = spark.createDataFrame([(float(i), 1.0 + i) for i in range(10)] + [(None, 3.0)],
                                  "mean_ndvi double, yield double")
    model = models.fit(models.linear_yield_pipeline(["mean_ndvi"]), train)
    rows = spark.createDataFrame([(1, 0.5), (2, None), (3, float("nan"))], "k int, mean_ndvi double")
    got = {r.k: r.prediction for r in models.score(model, rows, ["k"]).collect()}
    assert got[1] == pytest.approx(1.5) and got[2] is None and got[3] is None


def test_reader_gets_the_last_committed_version(spark):
    from cropscope.session import shared_path
    df = spark.createDataFrame([(0.1, 1.0), (0.2, 2.0), (0.3, 3.0)], "ndvi double, yield double")
    make = lambda k: models.fit(models.linear_yield_pipeline(["ndvi"]),
                                df.withColumn("yield", df["yield"] * k))
    at = lambda m: round(models.score(m, df, ["ndvi"]).first().prediction, 6)
    root = shared_path(spark, "model_store")
    with pytest.raises(FileNotFoundError):
        models.load_version(spark, root)
    assert models.save_version(spark, make(1.0), root) == 1
    assert models.save_version(spark, make(2.0), root) == 2
    make(9.0).write().save(f"{root}/v=3")              # a save that broke off before its record
    assert at(models.load_version(spark, root)) == 2.0
    assert at(models.load_version(spark, root, 1)) == 1.0
    assert models.save_version(spark, make(4.0), root) == 4
    assert at(models.load_version(spark, root)) == 4.0
    with pytest.raises(FileNotFoundError):
        models.load_version(spark, root, 3)


def test_training_rows_are_dealt_out(spark, monkeypatch):
    """Whatever partitions the rows came in, no task of a fit has more than its share."""
    monkeypatch.setattr(models, "TASK_ROWS", 100)
    df = spark.range(1000).coalesce(1).select((F.col("id") / 10).alias("ndvi"), F.col("id").alias("yield"))
    pipe, seen = models.linear_yield_pipeline(["ndvi"]), []
    fit = pipe.fit
    monkeypatch.setattr(pipe, "fit", lambda train: seen.append(train.rdd.glom().map(len).collect()) or fit(train))
    model = models.fit(pipe, df)
    assert sum(seen[0]) == 1000 and len(seen[0]) == 10 and max(seen[0]) <= 200
    assert model.stages[-1].coefficients[0] == pytest.approx(10.0)
