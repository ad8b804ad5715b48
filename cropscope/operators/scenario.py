"""What-if scenario scoring (J3, G10): scenario requests against their fields.

A scenario is a row of a request table keyed by its field, as the page sends one
setting per click. Requests meet their field's humidity and leaf wetness by an
equi-join, are scored by one ``transform`` of a fitted yield model and then by the
rules; nothing is paired beyond the join and nothing is embedded in the plan.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.ndvi import health_index
from ..functions.rules import (disease_risk_class, disease_risk_score, profit_floored,
                               roi_guarded, scenario_advice, water_stress_climate)
from . import models


def scenario_report(scenarios: DataFrame, fields: DataFrame, model: PipelineModel,
                    labor_cost=K.DEFAULT_LABOR_COST, crop_price=K.DEFAULT_CROP_PRICE,
                    unit_cost: float = 1.0) -> DataFrame:
    """G10 per request: predicted yield, health, climate stress, rule disease risk (field
    humidity and leaf wetness, scenario temperature), floored profit, guarded ROI and the
    first matching advice.

    ``scenarios`` holds field_id, scenario_id, ndvi, rainfall, temperature, fertilizer and
    whatever else the model's features need. A request for an unknown field stays, with
    NULL where the field's values would enter. The fertilizer is an amount (kg/ha); its
    cost is amount x ``unit_cost`` (default 1.0, which reproduces the original page, D11)."""
    asked = scenarios.join(fields.select("field_id", "humidity", "leaf_wetness"), "field_id",
                           "left")
    out = models.predict(model, asked, "predicted_yield").select(
        "field_id", "scenario_id", "predicted_yield",
        health_index("ndvi").alias("health_index"),
        water_stress_climate("ndvi", "temperature", "rainfall").alias("water_stress"),
        disease_risk_score("ndvi", "humidity", "leaf_wetness", "temperature").alias("risk_score"),
        (F.col("fertilizer") * F.lit(float(unit_cost))).alias("fertilizer_cost"))
    out = out.withColumn("risk_class", disease_risk_class("risk_score"))
    out = (out.withColumn("profit", profit_floored("predicted_yield", "fertilizer_cost",
                                                   labor_cost, crop_price))
           .withColumn("roi", roi_guarded("predicted_yield", "fertilizer_cost", crop_price))
           .withColumn("advice", scenario_advice("predicted_yield", "water_stress", "risk_class")))
    return out.drop("fertilizer_cost")
