"""Registered queries: one per operator group of the inventory.

Each entry takes ``(spark, data_dir)`` and returns a DataFrame over the whole
test tables of ``data_dir`` (bindings in ``sources.bindings``). Output
conventions shared with the SQL oracle: doubles rounded to 6 decimals, dates
as ``yyyy-MM-dd`` text, timestamps as ``yyyy-MM-dd HH:mm:ss.SSSSSS`` text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K
from ..functions.ndvi import ndvi_masked
from ..functions.paths import day_number
from ..operators import agronomy, economics, models, scenario, scene, status, trend
from ..session import materialize, shared_path
from ..sources import bindings as B
from ..sources import checked, files
from ..streaming import observations as stream

Query = Callable[[SparkSession, str], DataFrame]


# --- output conventions --------------------------------------------------------

_TWO_52 = 4503599627370496.0  # from here on every double is an integer


def _round_half_away(y: Column) -> Column:
    """Nearest integer, halves away from zero; NaN and infinities pass through."""
    a = F.abs(y)
    return F.when(a >= _TWO_52, y).otherwise(F.signum(y) * F.floor(a + F.lit(0.5)))


def round_digits(x: Column, digits) -> Column:
    """Round the binary value of ``x`` to ``digits`` >= 0 decimals: scale,
    round half away from zero, unscale."""
    p = F.pow(F.lit(10.0), digits if isinstance(digits, Column) else F.lit(int(digits)))
    return _round_half_away(x.cast("double") * p) / p


def present(df: DataFrame) -> DataFrame:
    """Output conventions: doubles rounded to 6 decimals after a first rounding
    to 9 decimals (absorbs last-bit differences between engines and summation
    orders, so an exact decimal tie rounds the same way everywhere; -0.0
    becomes 0.0), dates and timestamps as text.

    The rounding runs as small staged projections over plain columns, so every
    intermediate is computed once and the generated code stays small.
    """
    fields = df.schema.fields
    doubles = [f.name for f in fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    t = {n: f"__r{i}_" for i, n in enumerate(doubles)}
    cur = df.select("*", *[(F.col(f"`{n}`").cast("double") * F.lit(1e9)).alias(t[n] + "y")
                           for n in doubles])
    cur = cur.select("*", *[(_round_half_away(F.col(t[n] + "y")) / F.lit(1e9) * F.lit(1e6))
                            .alias(t[n] + "z") for n in doubles])
    out = []
    for f in fields:
        c = F.col(f"`{f.name}`")
        if f.name in t:
            c = _round_half_away(F.col(t[f.name] + "z")) / F.lit(1e6) + F.lit(0.0)
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        out.append(c.alias(f.name))
    return cur.select(*out)


# --- scene statistics --------------------------------------------------------------

def q_scene_health_report(spark, d):
    """Flagship: P2 -> A1 + A2 -> P6 + P7 per scene."""
    return present(scene.scene_health_report(B.band_samples(spark, d)))


def q_health_class(spark, d):
    return present(agronomy.health_view(B.fields(spark, d)))


def q_ndvi_masked_stats(spark, d):
    px = scene.with_ndvi_masked(B.band_samples(spark, d))
    return present(scene.scene_ndvi_stats_with_median(px))


def q_ndvi_masked_pixels_summary(spark, d):
    px = scene.with_ndvi_masked(B.band_samples(spark, d))
    return present(scene.masked_pixel_summary(px))


def q_scene_stats_long(spark, d):
    stats = scene.scene_ndvi_stats(scene.with_ndvi_guarded(B.band_samples(spark, d)))
    return present(scene.stats_long(stats))


def q_band_stats(spark, d):
    return present(scene.band_stats_wide(*B.band_columns(spark, d)))


def q_band_pair_choice(spark, d):
    pairs = scene.band_pair_choice(B.image_bands(spark, d))
    text = F.concat_ws(",", F.col("red_band").cast("string"), F.col("nir_band").cast("string"))
    return present(pairs.select("scene_id", "band_count", "pixels",
                                F.when(F.col("red_band").isNotNull(), text).alias("band_pair")))


def q_scene_metadata(spark, d):
    meta = scene.scene_metadata(B.band_samples(spark, d))
    return present(meta.select("scene_id", "path", "width", "height", "crs",
                               *[F.col(f"bounds.{c}").alias(f"bounds_{c}")
                                 for c in ("left", "bottom", "right", "top")]))


def q_scene_date_series(spark, d):
    s = scene.scene_date_series(B.band_samples(spark, d))
    return present(s.select("scene_id", F.array_join(F.transform(
        "dates", lambda x: F.date_format(x, "yyyy-MM-dd")), ",").alias("dates"),
        "n_dates", "pixels"))


# --- trends and history -------------------------------------------------------------

def q_ndvi_daily_mean(spark, d):
    px = trend.with_masked_ndvi(B.band_samples(spark, d))
    return present(trend.image_means(px, "scene_id", ("capture_date",)))


def q_trend_per_1000_days(spark, d):
    px = trend.with_masked_ndvi(B.band_samples(spark, d))
    return present(trend.field_trend_per_1000_days(px))


def q_trend_per_image(spark, d):
    """A6 + A7 where a field has several images a day: nation-wide fields would be too
    few, so the field is the scene's number modulo 7 and the image its order."""
    px = trend.with_masked_ndvi(B.band_samples(spark, d)).withColumn(
        "field", F.col("scene_id") % 7).withColumn("image", F.col("pixel_row"))
    return present(trend.field_trend_per_1000_days(px, "field", image=("image",)))


def q_trend_per_year(spark, d):
    return present(trend.trend_per_year(B.observations(spark, d)))


def q_trend_first_ten(spark, d):
    return present(trend.trend_first_ten(B.observations(spark, d)))


def q_latest_observation(spark, d):
    return present(trend.latest_observation(B.observations(spark, d)))


def q_history_series(spark, d):
    """C4: NDVI, health and predicted yield over time."""
    scored = models.predict(ndvi_yield_model(spark, d), B.observations(spark, d),
                            "predicted_yield")
    return present(trend.history_series(scored))


# --- agronomy rules -------------------------------------------------------------------

def q_water_stress_basic(spark, d):
    return present(agronomy.water_stress_basic_view(B.fields(spark, d)))


def q_water_stress_climate(spark, d):
    return present(agronomy.water_stress_climate_view(B.fields(spark, d)))


def q_stress_class_counts(spark, d):
    return present(agronomy.stress_class_counts(B.fields(spark, d)))


def q_disease_risk_rules(spark, d):
    return present(agronomy.disease_risk_view(B.fields(spark, d)))


def q_yield_class(spark, d):
    return present(agronomy.yield_class_view(B.scene_labels(spark, d)))


def q_domain_check(spark, d):
    cols = {"rainfall": "rainfall", "temperature": "temperature", "humidity": "humidity",
            "leaf_wetness": "leaf_wetness", "ndvi": "mean_ndvi"}
    out = agronomy.domain_check(B.fields(spark, d), cols)
    return present(out.select("field_id", F.array_join("violations", ",").alias("violations"),
                              "n_violations"))


# --- economics --------------------------------------------------------------------------

def q_economics_plain(spark, d):
    return present(economics.economics_plain(B.yields(spark, d)))


def q_economics_guarded(spark, d):
    return present(economics.economics_guarded(B.yields(spark, d)))


def q_roi_histogram(spark, d):
    return present(economics.roi_histogram(B.yields(spark, d)))


def q_cost_breakdown(spark, d):
    return present(economics.cost_breakdown(B.yields(spark, d)))


# --- joins, scenarios, status -----------------------------------------------------------

def train_frame(spark, d) -> DataFrame:
    stats = scene.scene_ndvi_stats(scene.with_ndvi_guarded(B.band_samples(spark, d)))
    return agronomy.train_frame(stats, B.scene_labels(spark, d), B.climate(spark, d))


def q_train_frame(spark, d):
    return present(train_frame(spark, d))


def stored_train_frame(spark, d) -> DataFrame:
    """The training frame (one row per scene) written once to shared storage:
    fitting and scoring then read it instead of scanning the pixels twice."""
    return materialize(train_frame(spark, d), "train_frame")


def ndvi_yield_model(spark, d):
    """One-feature linear yield model on the training frame, its feature named ``ndvi``."""
    frame = stored_train_frame(spark, d).withColumnRenamed("mean_ndvi", "ndvi")
    return models.fit(models.linear_yield_pipeline(["ndvi"]), frame)


def q_scenario_grid(spark, d):
    return present(scenario.scenario_report(B.scenarios(spark, d), B.fields(spark, d),
                                            ndvi_yield_model(spark, d)))


def q_run_summary(spark, d):
    return present(status.run_summary(status.image_status(B.image_bands(spark, d))))


def q_failed_images(spark, d):
    return present(status.failed_images(status.image_status(B.image_bands(spark, d))))


def path_listing(spark, d, keep=()) -> DataFrame:
    """Raster path text made from lineitem: field = supplier, date = ship date,
    suffix and name varied by the return flag / line status / line number. ``keep`` names
    columns to keep."""
    li = B.table(spark, d, "lineitem")
    date_txt = F.when(F.col("l_linenumber") == 7, F.lit("unknown")) \
        .otherwise(F.date_format("l_shipdate", "yyyyMMdd"))
    suffix = (F.when(F.col("l_returnflag") == "R", F.lit(".TIF"))
              .when(F.col("l_returnflag") == "A", F.lit("_NDVI.tif"))
              .when(F.col("l_linestatus") == "F", F.lit(".tiff"))
              .when(F.col("l_linenumber") == 6, F.lit(".png"))
              .otherwise(F.lit(".tif")))
    path = F.concat(F.lit("/data/time_series/"), F.col("l_suppkey").cast("string"), F.lit("/"),
                    date_txt, F.lit("_"), F.col("l_linenumber").cast("string"), suffix)
    return li.select(path.alias("path"), *keep)


def q_path_fields(spark, d):
    from ..functions import paths as P
    lst = path_listing(spark, d)
    out = lst.select(
        "path",
        P.parent_name("path").alias("field_id"),
        P.base_name("path").alias("filename"),
        P.is_raster("path").alias("is_raster"),
        (P.is_raster("path") & ~P.is_ndvi_output("path")).alias("is_ndvi_input"),
        P.is_series_raster("path").alias("is_series"),
        P.date_text("path").alias("date_text"),
        P.parse_date_text(P.date_text("path")).alias("capture_date"),
        F.when(P.is_raster("path") & ~P.is_ndvi_output("path"),
               P.ndvi_output_path("path")).alias("output_path"))
    # NULL for unparseable date text; double so NULL survives every client's int types
    out = out.withColumn("day_number", day_number("capture_date").cast("double"))
    return present(out)


def label_frames(spark, d) -> tuple[DataFrame, DataFrame]:
    labels = B.scene_labels(spark, d)
    fname = F.concat(F.col("scene_id").cast("string"), F.lit("_NDVI.tif")).alias("filename")
    short = labels.select(fname, "yield")
    s = B.table(spark, d, "supplier").select(F.col("s_suppkey").alias("scene_id"), "s_acctbal")
    wide = (labels.join(s, "scene_id").where(F.col("s_acctbal") > 0)
            .join(B.climate(spark, d), "nation_id")
            .select(fname, "yield", "rainfall", "temperature", "soil_ph", "fertilizer", "region"))
    return short, wide


def q_label_sections(spark, d):
    short, wide = label_frames(spark, d)
    path = files.write_label_sections(short, wide, shared_path(spark, "labels_csv"))
    return present(files.read_label_sections(spark, path))


def q_ndvi_batch_output(spark, d):
    """G1 + K1: masked NDVI written in scene buckets, read back, summarised."""
    px = B.band_samples(spark, d)
    out = px.select("scene_id", "pixel_row", "pixel_col",
                    ndvi_masked("red", "nir").alias("ndvi"),
                    scene.ndvi_is_masked("red", "nir").alias("is_masked"))
    path = files.write_ndvi(out, shared_path(spark, "ndvi"))
    back = files.read_ndvi(spark, path)
    return present(back.groupBy("scene_id").agg(
        F.count(F.lit(1)).alias("pixels"), F.count_if("is_masked").alias("masked_pixels"),
        F.avg("ndvi").alias("mean_ndvi")))


def q_ndvi_batch_job(spark, d):
    """G1 on long band rows, one row per image: status and band pair of the run, pixels
    and mean NDVI of what the job wrote (0 and NULL where the image failed)."""
    from . import jobs
    bands = B.image_bands(spark, d).withColumns({"pixel_row": F.lit(0), "pixel_col": F.lit(0)})
    path = shared_path(spark, "ndvi_batch")
    summary, failed = jobs.ndvi_batch_job(bands, path)
    written = files.read_ndvi(spark, path).groupBy("scene_id").agg(
        F.count(F.lit(1)).alias("pixels"), F.count_if("is_masked").alias("masked_pixels"),
        F.avg("ndvi").alias("mean_ndvi")).withColumn("status", F.lit("done"))
    rows = written.unionByName(failed.withColumn("status", F.lit("failed")).drop("band_count"),
                               allowMissingColumns=True)
    rows = rows.fillna(0, ["pixels", "masked_pixels"])
    return present(rows.join(summary, "status"))


# --- models -----------------------------------------------------------------------------


def q_yield_linear_1(spark, d):
    tf = stored_train_frame(spark, d)
    model = models.fit(models.linear_yield_pipeline(["mean_ndvi"]), tf)
    return present(models.score(model, tf, ["scene_id"]))


def q_yield_linear_versioned(spark, d):
    """A model store with an older version and a save that broke off; the reader
    scores with the last committed version."""
    tf = stored_train_frame(spark, d)
    root = shared_path(spark, "yield_models")
    pipe = models.linear_yield_pipeline(["mean_ndvi"])
    models.save_version(spark, models.fit(pipe, tf.withColumn("yield", F.col("yield") * 2)), root)
    version = models.save_version(spark, models.fit(pipe, tf), root)
    models.save(models.fit(pipe, tf.withColumn("yield", F.col("yield") + 1)), f"{root}/v={version + 1}")
    got = models.score(models.load_version(spark, root), tf, ["scene_id"])
    return present(got.withColumn("version", F.lit(version).cast("long")))


def q_yield_linear_5(spark, d):
    tf = stored_train_frame(spark, d)
    feats = ["mean_ndvi", "rainfall", "temperature", "soil_ph", "fertilizer"]
    model = models.fit(models.linear_yield_pipeline(feats), tf)
    return present(models.score(model, tf, ["scene_id"]))


def q_yield_forest(spark, d):
    tf = stored_train_frame(spark, d)
    model = models.fit(models.yield_forest_pipeline(), tf)
    path = models.save(model, shared_path(spark, "yield_forest"))
    return present(models.score(models.load(path), tf, ["scene_id"]))


def q_disease_forest(spark, d):
    from ..functions.rules import disease_risk_class, disease_risk_score
    f = B.fields(spark, d)
    cls = disease_risk_class(disease_risk_score("mean_ndvi", "humidity", "leaf_wetness",
                                                "temperature"))
    code = (F.when(F.col("leaf_wetness") == 0, 0)  # a dry leaf carries no risk
            .when(cls == K.RISK_LABELS[0], 1).when(cls == K.RISK_LABELS[1], 2)
            .when(cls == K.RISK_LABELS[2], 3).otherwise(0))
    train = f.select("field_id", F.col("mean_ndvi").alias("ndvi"), "humidity", "leaf_wetness",
                     code.alias("disease_risk"))
    model = models.fit(models.disease_forest_pipeline(), train, "disease_risk")
    path = models.save(model, shared_path(spark, "disease_forest"))
    return present(models.score_risk(models.load(path), train, ["field_id", "disease_risk"]))


def q_region_index(spark, d):
    """M1: index of each scene's region, the most frequent region first."""
    from pyspark.ml.feature import StringIndexer
    labels = B.scene_labels(spark, d).select("scene_id", "region")
    model = StringIndexer(inputCol="region", outputCol="region_index",
                          handleInvalid="keep").fit(labels)
    return present(model.transform(labels))


def q_disease_scaled_features(spark, d):
    """M4 + M5: the standardised three-wide vector of the classifier, by component."""
    from pyspark.ml.functions import vector_to_array
    f = B.fields(spark, d).withColumnRenamed("mean_ndvi", "ndvi").withColumn(
        "disease_risk", F.lit(0))
    stages = models.disease_forest_pipeline().getStages()[:2]
    from pyspark.ml import Pipeline
    scaled = Pipeline(stages=stages).fit(f).transform(f)
    v = vector_to_array("features")
    return present(scaled.select("field_id", *[v[i].alias(f"scaled_{n}")
                                               for i, n in enumerate(K.DISEASE_FEATURES)]))


def q_yield_forest_step(spark, d):
    """The forest learns a yield that steps with the region's rainfall
    nations; after save and load its prediction is on the label's side of the step."""
    tf = stored_train_frame(spark, d).withColumn(
        "yield", F.when(F.col("rainfall") > 165.0, 3.0).otherwise(1.0))
    path = models.save(models.fit(models.yield_forest_pipeline(), tf),
                       shared_path(spark, "yield_forest_step"))
    return present(models.score(models.load(path), tf, ["scene_id"]).select(
        "scene_id", (F.col("prediction") > 2.0).alias("high_yield")))


def q_disease_forest_step(spark, d):
    """The classifier learns four risk codes that step with leaf wetness;
    after save and load the label text is that of the code."""
    w = F.col("leaf_wetness")
    train = B.fields(spark, d).select(
        "field_id", F.col("mean_ndvi").alias("ndvi"), "humidity", "leaf_wetness",
        F.when(w < 6, 0).when(w < 12, 1).when(w < 18, 2).otherwise(3).alias("disease_risk"))
    path = models.save(models.fit(models.disease_forest_pipeline(), train, "disease_risk"),
                       shared_path(spark, "disease_forest_step"))
    return present(models.score_risk(models.load(path), train, ["field_id"])
                   .select("field_id", "risk_label"))


# --- CSV jobs (S6): Spark writes the table as CSV, the job reads it back ------------------------

def q_water_stress_csv(spark, d):
    """G4 over a CSV field table written from the part table."""
    from . import jobs
    from .. import schemas
    path = shared_path(spark, "field_data_csv")
    (B.fields(spark, d).select(F.col("field_id").cast("string").alias("field_id"),
                               "mean_ndvi", "temperature")
     .write.mode("overwrite").option("header", True).csv(path))
    return present(jobs.water_stress_job(spark, path, schemas.FIELDS))


def q_economics_csv(spark, d):
    """G5 over a CSV yield table written from lineitem: profit/ROI per field."""
    from . import jobs
    from .. import schemas
    path = shared_path(spark, "yield_data_csv")
    (B.yields(spark, d).select(F.col("field_id").cast("string").alias("field_id"),
                               "yield", "fertilizer_cost")
     .write.mode("overwrite").option("header", True).csv(path))
    econ, _hist = jobs.economics_job(spark, path, schemas.YIELDS)
    return present(econ)


def bad_yield_lines(spark, d) -> str:
    """A CSV yield table with planted faults; its path. Orders divisible by 13 have short
    lines, third lines of orders divisible by 5 a yield that is no number, orders divisible by 11
    a cost that is none."""
    li = B.table(spark, d, "lineitem")
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    key = (order * 10 + line).cast("string")
    whole = F.concat_ws(
        ",", key,
        F.when((line == 3) & (order % 5 == 0), "n/a")
        .otherwise(((F.col("l_quantity") - 5.0) / 10.0).cast("string")),
        F.when(order % 11 == 0, "unknown").otherwise((F.col("l_tax") * 3000.0).cast("string")))
    path = shared_path(spark, "bad_yields_csv")
    (li.select(F.when(order % 13 == 0, F.concat(key, F.lit(",short"))).otherwise(whole).alias("value"))
     .write.text(path))
    return path


def bad_label_lines(spark, d) -> str:
    """Stacked label sections with planted faults; the path. Scenes divisible by 4 have a
    yield, and wide rows of scenes divisible by 6 a rainfall, that is no number."""
    short, wide = label_frames(spark, d)
    n = F.regexp_extract("filename", r"^(\d+)", 1).cast("long")
    text = lambda c, every, bad: F.when(n % every == 0, bad).otherwise(
        F.col(c).cast("string")).alias(c)
    return files.write_label_sections(
        short.select("filename", text("yield", 4, "bad")),
        wide.select("filename", text("yield", 4, "bad"), text("rainfall", 6, "wet"),
                    "temperature", "soil_ph", "fertilizer", "region"),
        shared_path(spark, "bad_labels_csv"))


def checked_yields(spark, d) -> tuple[DataFrame, DataFrame]:
    from .. import schemas
    return checked.read_table_csv(spark, bad_yield_lines(spark, d), schemas.YIELDS, "field_id",
                                  header=False)


def q_failure_records(spark, d):
    """Everything that failed in a run over faulty inputs, and why."""
    bands = B.image_bands(spark, d).withColumn("value", F.when(
        ~((F.col("band") == 3) & (F.col("scene_id") % 3 == 0)), F.col("value")))
    parts = {"yields": checked_yields(spark, d)[1],
             "labels": checked.read_label_sections(spark, bad_label_lines(spark, d))[1],
             "images": checked.image_failures(bands)}
    out = None
    for name, bad in parts.items():
        bad = bad.withColumn("source", F.lit(name))
        out = bad if out is None else out.unionByName(bad)
    return present(out)


def q_economics_good_rows(spark, d):
    """G5 over the same faulty CSV: the good rows give what they always give."""
    return present(economics.economics_plain(checked_yields(spark, d)[0]))


def q_labels_good_rows(spark, d):
    """S7 over the faulty label file: its good rows, the fullest of each file name."""
    return present(checked.read_label_sections(spark, bad_label_lines(spark, d))[0])


def q_roi_histogram_csv(spark, d):
    """The histogram and mean that the CSV job returns beside its rows."""
    from . import jobs
    from .. import schemas
    path = shared_path(spark, "yield_data_csv")
    (B.yields(spark, d).select(F.col("field_id").cast("string").alias("field_id"),
                               "yield", "fertilizer_cost")
     .write.mode("overwrite").option("header", True).csv(path))
    return present(jobs.economics_job(spark, path, schemas.YIELDS)[1])


# --- tiles, run metrics, series ------------------------------------------------------------

def tile_bands(spark, d) -> DataFrame:
    """The pixel table as long band rows: red is band 3, near infrared band 4."""
    px = B.band_samples(spark, d)
    return px.select("scene_id", F.col("pixel_row"), F.col("pixel_col"), F.inline(F.array(
        F.struct(F.lit(3).alias("band"), F.col("red").alias("value")),
        F.struct(F.lit(4).alias("band"), F.col("nir").alias("value")))))


def q_tile_ndvi_stats(spark, d):
    """S5, P4, P1 on tiles: what the tiles of each scene give and what was written from them."""
    from . import jobs
    path = shared_path(spark, "tile_ndvi")
    stats = jobs.ndvi_tile_job(tile_bands(spark, d), path)
    written = files.read_ndvi(spark, path).groupBy("scene_id").agg(
        F.count(F.lit(1)).alias("written_pixels"), F.sum("ndvi").alias("written_sum"))
    return present(stats.join(written, "scene_id"))


def q_ndvi_run_metrics(spark, d):
    """Images done and failed, pixels and masked pixels as the write saw them.
    Images are orders, their pixels the parts of a band's line."""
    from . import jobs
    li = B.table(spark, d, "lineitem")
    bands = li.select((F.col("l_orderkey") % 1000).alias("scene_id"), F.col("l_linenumber").alias("band"),
                      F.col("l_orderkey").alias("pixel_row"), F.lit(0).alias("pixel_col"),
                      (F.col("l_discount") - 0.02).alias("value"))
    seen = Observation()
    summary, _ = jobs.ndvi_batch_job(bands, shared_path(spark, "run_metrics"), observed=seen)
    return present(jobs.run_metrics(summary, seen))


def series_tables(spark, d) -> tuple[DataFrame, DataFrame]:
    """A listing and a pixel table that name the same images but for some: line numbers above
    5 have no pixels, and first lines of orders divisible by 7 are not listed."""
    li = path_listing(spark, d, ("l_orderkey", "l_linenumber", "l_discount", "l_tax"))
    listing = li.where((F.col("l_linenumber") != 1) | (F.col("l_orderkey") % 7 != 0)).select("path")
    px = li.where(F.col("l_linenumber") <= 5).where(F.col("path").endswith(".tif"))
    return listing, px.select("path", ndvi_masked("l_discount", "l_tax").alias("ndvi"))


def q_series_trend(spark, d):
    """S3 -> G3: the trend of every field from the images of its folder."""
    from . import jobs
    return present(jobs.series_trend_job(*series_tables(spark, d))[0])


def q_series_unmatched(spark, d):
    """Images without pixels or date, and pixels of images not listed."""
    from . import jobs
    return present(jobs.series_trend_job(*series_tables(spark, d))[1])


# --- composite page reports ----------------------------------------------------------------

def scene_env(spark, d) -> DataFrame:
    """Per-scene environment: the scene's nation parameters."""
    return (B.scene_labels(spark, d).join(B.climate(spark, d), "nation_id")
            .select("scene_id", "rainfall", "temperature", "soil_ph", "fertilizer"))


def q_field_report_raw(spark, d):
    """5-feature linear yield model fitted on the training frame."""
    from . import jobs
    tf = stored_train_frame(spark, d).withColumn("ndvi", F.col("mean_ndvi"))
    model = models.fit(models.linear_yield_pipeline(list(K.YIELD_FEATURES_5)), tf)
    report = materialize(scene.scene_health_report(B.band_samples(spark, d)), "health_report")
    return present(jobs.field_report_raw(report, scene_env(spark, d), model))


def q_field_report_ndvi(spark, d):
    """Masked NDVI images, 1-feature linear yield model."""
    from . import jobs
    tf = stored_train_frame(spark, d)
    model = models.fit(models.linear_yield_pipeline(["mean_ndvi"]), tf)
    px = scene.with_ndvi_masked(B.band_samples(spark, d))
    return present(jobs.field_report_ndvi(px, model, scene_env(spark, d)))


def q_history_report(spark, d):
    from . import jobs
    return present(jobs.history_report(B.observations(spark, d), ndvi_yield_model(spark, d)))


def q_band_diagnostic(spark, d):
    from . import jobs
    wide, bands = B.band_columns(spark, d)
    # every fifth scene lacks its fourth band
    wide = wide.withColumn("b4", F.when(F.col("scene_id") % 5 != 0, F.col("b4")))
    return present(jobs.band_diagnostic(wide, bands))


def q_yield_forest_from_labels(spark, d):
    """G6 end to end: stacked label file (S7) -> join with per-scene features on
    the file name (J1) -> region index + forest (M1-M3, M7) -> save (K3) ->
    load (S9) -> score (M9). The labels step with the rainfall, so the prediction's side of
    the step can be told. Labels without environment values do not train; they are in
    the result with NULL."""
    from . import jobs
    short, wide = label_frames(spark, d)
    short = short.withColumn("yield", F.lit(1.0))
    wide = wide.withColumn("yield", F.when(F.col("rainfall") > 165.0, 3.0).otherwise(1.0))
    labels = files.read_label_sections(spark, files.write_label_sections(
        short, wide, shared_path(spark, "labels_for_training")))
    stats = scene.scene_ndvi_stats(scene.with_ndvi_guarded(B.band_samples(spark, d)))
    feats = materialize(stats.select(F.concat(F.col("scene_id").cast("string"),
                                              F.lit("_NDVI.tif")).alias("filename"),
                                     "mean_ndvi"), "label_features")
    path = shared_path(spark, "yield_forest_model")
    jobs.training_job(feats, labels, path, key="filename")
    scored = models.score(models.load(path), feats.join(labels, "filename", "inner"),
                          ["filename"])
    high = F.when(F.col("prediction").isNotNull(), (F.col("prediction") > 2.0).cast("string"))
    return present(scored.select("filename", high.alias("high_yield")))


# --- streaming ---------------------------------------------------------------------------

def q_stream_scored_history(spark, d):
    path = stream.run_scored_history(spark, d, model=ndvi_yield_model(spark, d))
    # ingested_at is processing time: kept in the table, left out of the result
    return present(stream.read_history(spark, path, with_yield=True).drop("ingested_at"))


def q_stream_latest_state(spark, d):
    return present(stream.read_latest_state(spark, stream.run_latest_state(spark, d)))


def q_stream_trends(spark, d):
    """A8, W2 on the stream: the events as several files, one micro-batch each, folded into
    the mergeable state and compacted on the way."""
    src = shared_path(spark, "event_files")
    B.table(spark, d, "events").repartition(6, F.xxhash64("event_id")).write.parquet(src)
    path = stream.run_latest_state(spark, src, file_glob="*.parquet", max_files_per_trigger=1,
                                   compact_every=4)
    return present(stream.read_trends(spark, path))


QUERIES: dict[str, Query] = {
    "scene_health_report": q_scene_health_report,
    "health_class": q_health_class,
    "ndvi_masked_stats": q_ndvi_masked_stats,
    "ndvi_masked_pixels_summary": q_ndvi_masked_pixels_summary,
    "scene_stats_long": q_scene_stats_long,
    "band_stats": q_band_stats,
    "band_pair_choice": q_band_pair_choice,
    "scene_metadata": q_scene_metadata,
    "scene_date_series": q_scene_date_series,
    "ndvi_daily_mean": q_ndvi_daily_mean,
    "trend_per_1000_days": q_trend_per_1000_days,
    "trend_per_image": q_trend_per_image,
    "trend_per_year": q_trend_per_year,
    "trend_first_ten": q_trend_first_ten,
    "latest_observation": q_latest_observation,
    "history_series": q_history_series,
    "water_stress_basic": q_water_stress_basic,
    "water_stress_climate": q_water_stress_climate,
    "stress_class_counts": q_stress_class_counts,
    "disease_risk_rules": q_disease_risk_rules,
    "economics_plain": q_economics_plain,
    "economics_guarded": q_economics_guarded,
    "roi_histogram": q_roi_histogram,
    "cost_breakdown": q_cost_breakdown,
    "yield_class": q_yield_class,
    "domain_check": q_domain_check,
    "train_frame": q_train_frame,
    "run_summary": q_run_summary,
    "failed_images": q_failed_images,
    "path_fields": q_path_fields,
    "label_sections": q_label_sections,
    "ndvi_batch_output": q_ndvi_batch_output,
    "ndvi_batch_job": q_ndvi_batch_job,
    "scenario_grid": q_scenario_grid,
    "yield_linear_1": q_yield_linear_1,
    "yield_linear_5": q_yield_linear_5,
    "yield_forest": q_yield_forest,
    "disease_forest": q_disease_forest,
    "region_index": q_region_index,
    "disease_scaled_features": q_disease_scaled_features,
    "yield_forest_step": q_yield_forest_step,
    "disease_forest_step": q_disease_forest_step,
    "yield_forest_from_labels": q_yield_forest_from_labels,
    "water_stress_csv": q_water_stress_csv,
    "economics_csv": q_economics_csv,
    "field_report_raw": q_field_report_raw,
    "field_report_ndvi": q_field_report_ndvi,
    "history_report": q_history_report,
    "band_diagnostic": q_band_diagnostic,
    "stream_scored_history": q_stream_scored_history,
    "stream_latest_state": q_stream_latest_state,
    "stream_trends": q_stream_trends,
    "failure_records": q_failure_records,
    "economics_good_rows": q_economics_good_rows,
    "labels_good_rows": q_labels_good_rows,
    "roi_histogram_csv": q_roi_histogram_csv,
    "tile_ndvi_stats": q_tile_ndvi_stats,
    "ndvi_run_metrics": q_ndvi_run_metrics,
    "series_trend": q_series_trend,
    "series_unmatched": q_series_unmatched,
    "yield_linear_versioned": q_yield_linear_versioned,
}
