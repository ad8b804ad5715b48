"""Per-field agronomy views (C2, P8-P13, P20, P30) and the training frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ndvi import health_class, health_index
from ..functions.rules import (disease_advice, disease_risk_class, disease_risk_score,
                               domain_violations, stress_advice, stress_class,
                               water_stress_basic, water_stress_climate, yield_class)


def water_stress_basic_view(fields: DataFrame) -> DataFrame:
    """Batch-job stress per field."""
    return fields.select("field_id", "mean_ndvi", "temperature",
                         water_stress_basic("mean_ndvi", "temperature").alias("water_stress"))


def water_stress_climate_view(fields: DataFrame) -> DataFrame:
    """P9 + P10: page stress per field with class and advice."""
    s = water_stress_climate("mean_ndvi", "temperature", "rainfall")
    return (fields.select("field_id", s.alias("water_stress"))
            .withColumn("stress_class", stress_class("water_stress"))
            .withColumn("advice", stress_advice("water_stress")))


def stress_class_counts(fields: DataFrame) -> DataFrame:
    """Fields per stress class, for both stress forms (the thresholds 7 and 4
    are shared though the scales differ, D13)."""
    forms = (("basic", water_stress_basic("mean_ndvi", "temperature")),
             ("climate", water_stress_climate("mean_ndvi", "temperature", "rainfall")))
    both = fields.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("stress_form"), stress_class(s).alias("stress_class"))
        for name, s in forms])))  # one scan
    return (both.groupBy("stress_form", "stress_class")
            .agg(F.count(F.lit(1)).alias("n_fields")))


def disease_risk_view(fields: DataFrame) -> DataFrame:
    """P11 + P12 + P13 with per-field humidity, leaf wetness and temperature."""
    score = disease_risk_score("mean_ndvi", "humidity", "leaf_wetness", "temperature")
    return (fields.select("field_id", score.alias("risk_score"))
            .withColumn("risk_class", disease_risk_class("risk_score"))
            .withColumn("advice", disease_advice("risk_class")))


def health_view(fields: DataFrame) -> DataFrame:
    """P6 + P7 per field."""
    return (fields.select("field_id", health_index("mean_ndvi").alias("health_index"))
            .withColumn("health_class", health_class("health_index")))


def yield_class_view(labels: DataFrame, key: str = "scene_id") -> DataFrame:
    """P20 per labelled scene."""
    return labels.select(key, "yield", yield_class("yield").alias("yield_class"))


def domain_check(params: DataFrame, columns: dict[str, str], key: str = "field_id") -> DataFrame:
    """Names of the parameters outside their allowed range, per row."""
    v = domain_violations(columns)
    return params.select(key, v.alias("violations")).withColumn(
        "n_violations", F.size("violations"))


def train_frame(scene_stats: DataFrame, labels: DataFrame, climate: DataFrame,
                key: str = "scene_id") -> DataFrame:
    """J1 + J2: per-scene features joined with yield labels (inner equi-join on
    the scene) and with the environment parameters of the scene's nation.

    Both scene-level sides hold one row per scene; AQE picks a broadcast at
    run time when one side turns out small and a sort-merge join otherwise.
    The parameter table is joined the same way.
    """
    feats = scene_stats.select(key, "mean_ndvi")
    j = feats.join(labels.select(key, "yield", "region", "nation_id"), key, "inner")
    j = j.join(climate, "nation_id", "inner")
    return j.select(key, "mean_ndvi", "rainfall", "temperature", "soil_ph", "fertilizer",
                    "region", "yield")
