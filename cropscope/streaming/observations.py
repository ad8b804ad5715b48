"""Streaming operators (T1, T2): new observations arrive as files.

T1 scores each arriving observation with the crop-health, stress and risk
rules and appends it to the history table (file sink, exactly-once through
its checkpoint). A file that is delivered again under another name adds
nothing: event ids are remembered for a stated time. T2 folds each micro-batch
into a mergeable state per field (``field_state``): count, latest NDVI, trends.
Both run with ``trigger(availableNow=True)``: everything present
is processed, then the query stops, which makes batch and stream comparable.
Checkpoints and sinks live under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import constants as K
from ..functions.ndvi import health_class, health_index
from ..functions.rules import disease_risk_class, disease_risk_score, water_stress_climate
from ..operators import models
from ..session import shared_path
from ..sources import commits
from . import field_state


def read_events_stream(spark: SparkSession, data_dir: str,
                       file_glob: str = "events.parquet",
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """File-source stream over the events table (explicit schema)."""
    reader = (spark.readStream.format("parquet").schema(schemas.EVENTS)
              .option("pathGlobFilter", file_glob))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(data_dir)


def observations_from_events(events: DataFrame) -> DataFrame:
    """The observation binding applied to a (streaming or batch) events frame."""
    return events.select(F.col("user_id").alias("field_id"), "event_id", "ts",
                         F.least(F.col("value") / 100.0, F.lit(1.0)).alias("ndvi"))


def score_observations(obs: DataFrame, params: dict | None = None,
                       model: PipelineModel | None = None, keep=()) -> DataFrame:
    """T1 projection: health, health class, climate stress and rule risk with
    one parameter set (the sidebar values; defaults when not given), and the yield a
    fitted model predicts (its features are ``ndvi`` and the parameters)."""
    p = dict(K.DEFAULTS)
    p.update(params or {})
    extra = []
    if model is not None:
        feats = models.feature_columns(model.stages)
        given = obs.withColumns({c: F.lit(float(p[c])) for c in feats if c not in obs.columns})
        obs, extra = models.predict(model, given, "predicted_yield"), ["predicted_yield"]
    h = health_index("ndvi")
    stress = water_stress_climate("ndvi", F.lit(p["temperature"]), F.lit(p["rainfall"]))
    score = disease_risk_score("ndvi", p["humidity"], p["leaf_wetness"], p["temperature"])
    return (obs.select("field_id", "event_id", "ts", "ndvi", h.alias("health_index"),
                       stress.alias("water_stress"), score.alias("risk_score"), *extra, *keep)
            .withColumn("health_class", health_class("health_index"))
            .withColumn("risk_class", disease_risk_class("risk_score")))


def latest_state(obs: DataFrame) -> DataFrame:
    """T2 in one batch: observations and latest NDVI per field."""
    return field_state.latest(field_state.fold(obs))


def once_per_event(obs: DataFrame, horizon: str = "7 days") -> DataFrame:
    """Each event id once (T1, K6). An id is remembered for ``horizon`` of processing time
    after it came, so no event is too late to be taken, however old its ``ts``; a delivery
    repeated later than that is appended again. Rows without an id are told apart by
    all their values."""
    row = F.sha2(F.to_json(F.struct(*[c for c in obs.columns if c != "ingested_at"])), 256)
    key = F.coalesce(F.col("event_id").cast("string"), F.concat(F.lit("row "), row))
    return (obs.withColumn("_event", key).withWatermark("ingested_at", horizon)
            .dropDuplicatesWithinWatermark(["_event"]).drop("_event"))


def run_scored_history(spark: SparkSession, data_dir: str, out_path: str | None = None,
                       params: dict | None = None, model: PipelineModel | None = None,
                       file_glob: str = "events.parquet", max_files_per_trigger: int | None = None,
                       horizon: str = "7 days") -> str:
    """T1 + K6: stream -> one row per event -> score -> append to a Parquet history table,
    with the processing time in ``ingested_at`` (P32). Returns the table path once
    every available file is processed."""
    out_path = out_path or shared_path(spark, "history")
    ckpt = out_path.rstrip("/") + "_checkpoint"
    events = read_events_stream(spark, data_dir, file_glob, max_files_per_trigger)
    obs = once_per_event(observations_from_events(events).withColumn(
        "ingested_at", F.current_timestamp()), horizon)
    scored = score_observations(obs, params, model, keep=("ingested_at",))
    q = (scored.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start(out_path))
    q.awaitTermination()
    return out_path


def read_history(spark: SparkSession, path: str, with_yield: bool = False) -> DataFrame:
    """The history table; empty when no file has come yet."""
    kind = schemas.HISTORY if with_yield else schemas.HISTORY_WITHOUT_YIELD
    if not commits.names(spark, path):
        return spark.createDataFrame([], kind)
    return spark.read.schema(kind).parquet(path)


def run_latest_state(spark: SparkSession, data_dir: str, out_path: str | None = None,
                     file_glob: str = "events.parquet", max_files_per_trigger: int | None = None,
                     compact_every: int = 10) -> str:
    """Every micro-batch folded into the state table at ``out_path`` (its path is
    returned). Nothing a reader sees is ever overwritten with other content."""
    out_path = out_path or shared_path(spark, "latest_state")
    obs = observations_from_events(
        read_events_stream(spark, data_dir, file_glob, max_files_per_trigger))
    q = (obs.writeStream
         .foreachBatch(lambda b, n: field_state.write_epoch(b, n, out_path, compact_every))
         .option("checkpointLocation", out_path.rstrip("/") + "_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return out_path


def read_latest_state(spark: SparkSession, path: str) -> DataFrame:
    """Count and latest observation per field after the last committed epoch."""
    return field_state.latest(field_state.read(spark, path))


def read_trends(spark: SparkSession, path: str) -> DataFrame:
    """A8, W2 on the stream: yearly trends per field after the last committed epoch."""
    return field_state.trends(field_state.read(spark, path))
