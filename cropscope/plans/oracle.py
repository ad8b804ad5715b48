"""Independent SQL statements of the registered queries, for DuckDB.

Run against the same Parquet tables (pre-registered as views). Same output
conventions as ``queries.present``: doubles rounded to 6 decimals, dates and
timestamps as text. Queries without an entry here (model fits) are checked by
row count and by their pytest properties.
"""

from __future__ import annotations

# --- bindings (same meaning as sources.bindings) -------------------------------------

BAND_SAMPLES = """band_samples AS (
  SELECT l_suppkey AS scene_id, CAST(l_shipdate AS DATE) AS capture_date,
         l_orderkey AS pixel_row, l_linenumber AS pixel_col,
         l_discount AS red, l_tax AS nir
  FROM lineitem)"""

GUARDED = """guarded AS (
  SELECT scene_id, capture_date,
         greatest(-1.0::DOUBLE, least(1.0::DOUBLE, (nir - red) /
           CASE WHEN nir + red = 0 THEN 0.01::DOUBLE ELSE nir + red END)) AS ndvi
  FROM band_samples)"""

MASKED = """masked AS (
  SELECT scene_id, capture_date,
         NOT (red > 0 AND nir > 0) AS is_masked,
         CASE WHEN red > 0 AND nir > 0
              THEN greatest(-1.0::DOUBLE, least(1.0::DOUBLE, (nir - red) / (nir + red)))
              ELSE -1.0::DOUBLE END AS ndvi
  FROM band_samples)"""

FIELDS = """fields AS (
  SELECT p_partkey AS field_id, (p_retailprice - 950) / 50 AS mean_ndvi,
         CAST(p_size AS DOUBLE) AS temperature,
         CAST(p_partkey % 400 AS DOUBLE) AS rainfall,
         CAST(p_partkey % 101 AS DOUBLE) AS humidity,
         CAST(p_partkey % 25 AS DOUBLE) AS leaf_wetness
  FROM part)"""

YIELDS = """yields AS (
  SELECT l_orderkey AS field_id, (l_quantity - 5) / 10 AS yield,
         l_tax * 3000 AS fertilizer_cost
  FROM lineitem)"""

OBSERVATIONS = """observations AS (
  SELECT user_id AS field_id, event_id, ts, least("value" / 100, 1.0::DOUBLE) AS ndvi
  FROM events)"""

SCENE_LABELS = """scene_labels AS (
  SELECT s_suppkey AS scene_id, s_acctbal / 3000 AS yield, r_name AS region,
         s_nationkey AS nation_id
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey)"""

CLIMATE = """climate AS (
  SELECT n_nationkey AS nation_id,
         50 + CAST(n_nationkey AS DOUBLE) * 10 AS rainfall,
         12 + CAST((n_nationkey * 7) % 25 AS DOUBLE) AS temperature,
         5 + CAST((n_nationkey * n_nationkey) % 19 AS DOUBLE) / 10 AS soil_ph,
         80 + CAST(n_regionkey AS DOUBLE) * 5 AS fertilizer
  FROM nation)"""

SCENE_STATS = """scene_stats AS (
  SELECT scene_id, avg(ndvi) AS mean_ndvi, min(ndvi) AS min_ndvi, max(ndvi) AS max_ndvi,
         stddev_pop(ndvi) AS std_ndvi,
         count(*) FILTER (WHERE ndvi > -1 AND ndvi < 1) AS valid_pixels,
         count(*) AS total_pixels
  FROM guarded GROUP BY scene_id)"""

TRAIN_FRAME = """train_frame AS (
  SELECT s.scene_id, s.mean_ndvi, c.rainfall, c.temperature, c.soil_ph, c.fertilizer,
         l.region, l.yield
  FROM scene_stats s JOIN scene_labels l ON s.scene_id = l.scene_id
                     JOIN climate c ON l.nation_id = c.nation_id)"""

IMAGE_BANDS = """image_bands AS (
  SELECT l_orderkey AS scene_id, l_linenumber AS band, l_extendedprice AS value
  FROM lineitem)"""

BAND_CHOICE = """band_choice AS (
  SELECT scene_id, count(DISTINCT band) AS band_count, count(*) AS pixels,
         list(DISTINCT band) AS held
  FROM image_bands GROUP BY scene_id),
chosen AS (
  SELECT scene_id, band_count, pixels,
         CASE WHEN list_has_all(held, [4, 8]) THEN 4 WHEN list_has_all(held, [3, 4]) THEN 3
              WHEN list_has_all(held, [1, 2]) THEN 1 END AS red_band,
         CASE WHEN list_has_all(held, [4, 8]) THEN 8 WHEN list_has_all(held, [3, 4]) THEN 4
              WHEN list_has_all(held, [1, 2]) THEN 2 END AS nir_band
  FROM band_choice)"""


def _slope(name: str, src: str, field: str, day: str, value: str, scale: str) -> str:
    """CTE ``name(field, n_points, t)``: least-squares slope of value over day by the
    database's own regression aggregate, times ``scale``; 0 without two usable days.
    Days count from near the data, so that its sums keep their digits."""
    return f"""{name} AS (
  SELECT {field}, count(*) AS n_points,
         CASE WHEN count(DISTINCT CASE WHEN {value} IS NOT NULL THEN {day} END) < 2 THEN 0.0
              ELSE regr_slope({value}, {day}) END * {scale} AS t
  FROM {src} GROUP BY {field})"""


NDVI_COEF = """coef AS (SELECT regr_slope(yield, mean_ndvi) AS s, regr_intercept(yield, mean_ndvi) AS i
         FROM train_frame)"""

DAY_TS = "datediff('day', DATE '2020-01-01', CAST(ts AS DATE))"
DAY_CAPTURE = "datediff('day', DATE '1995-01-01', capture_date)"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


HEALTH_CLASS = """CASE WHEN {h} IS NULL THEN NULL WHEN isnan({h}) THEN 'Poor'
     WHEN {h} > 0.7 THEN 'Excellent' WHEN {h} > 0.5 THEN 'Good'
     WHEN {h} > 0.3 THEN 'Moderate' ELSE 'Poor' END"""

CLIMATE_STRESS = """greatest(0.0::DOUBLE, least(10.0::DOUBLE,
   greatest(0.0::DOUBLE, least(1.0::DOUBLE, ({t} - 10) / 30))
 * greatest(0.0::DOUBLE, least(1.0::DOUBLE, 1 - {r} / 300))
 / greatest(0.01::DOUBLE, least(1.0::DOUBLE, ({n} + 1) / 2))))"""

BASIC_STRESS = """CASE WHEN ({n} + 1) / 2 < 0.01 THEN 10.0::DOUBLE
     ELSE (1 - ({n} + 1) / 2) * (({t} - 10) / 30) * (({t} - 10) / 30) * 10 END"""

STRESS_CLASS = """CASE WHEN {s} IS NULL THEN NULL WHEN {s} > 7 THEN 'severe'
     WHEN {s} > 4 THEN 'moderate' ELSE 'normal' END"""

RISK_SCORE = """((1 - {n}) * ({h} / 100) * ({w} / 10) *
   CASE WHEN {t} BETWEEN 22 AND 28 THEN 1.5::DOUBLE WHEN {t} > 30 THEN 0.7::DOUBLE
        ELSE 1.0::DOUBLE END)"""

RISK_CLASS = """CASE WHEN {s} IS NULL THEN NULL WHEN {s} < 0.15 THEN 'Low risk'
     WHEN {s} < 0.3 THEN 'Moderate risk' ELSE 'High risk' END"""

PROFIT_FLOORED = "greatest({y} * {p} - ({f} + {l}), -({f} + {l}))"
ROI_GUARDED = "CASE WHEN {f} <= 0 THEN 0.0::DOUBLE ELSE greatest(({y} * {p} - {f}) / {f} * 100, -100.0::DOUBLE) END"

TS_TEXT = "strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"


def _f(template: str, **kw) -> str:
    return template.format(**kw)


SQL: dict[str, str] = {}

SQL["scene_health_report"] = _with(BAND_SAMPLES, GUARDED, SCENE_STATS) + f"""
SELECT scene_id, round(mean_ndvi, 6) AS mean_ndvi, round(min_ndvi, 6) AS min_ndvi,
       round(max_ndvi, 6) AS max_ndvi, round(std_ndvi, 6) AS std_ndvi,
       valid_pixels, total_pixels,
       round(valid_pixels / total_pixels, 6) AS healthy_share,
       round((mean_ndvi + 1) / 2, 6) AS health_index,
       {_f(HEALTH_CLASS, h='((mean_ndvi + 1) / 2)')} AS health_class
FROM scene_stats"""

SQL["health_class"] = _with(FIELDS) + f"""
SELECT field_id, round((mean_ndvi + 1) / 2, 6) AS health_index,
       {_f(HEALTH_CLASS, h='((mean_ndvi + 1) / 2)')} AS health_class
FROM fields"""

SQL["ndvi_masked_stats"] = _with(BAND_SAMPLES, MASKED) + """
SELECT scene_id, round(min(ndvi), 6) AS min_ndvi, round(max(ndvi), 6) AS max_ndvi,
       round(avg(ndvi), 6) AS mean_ndvi, round(stddev_pop(ndvi), 6) AS std_ndvi,
       count(ndvi) AS pixels, round(median(ndvi), 6) AS median_ndvi
FROM masked GROUP BY scene_id"""

SQL["ndvi_masked_pixels_summary"] = _with(BAND_SAMPLES, MASKED) + """
SELECT scene_id, count(*) AS total_pixels,
       count(*) FILTER (WHERE is_masked) AS masked_pixels,
       count(*) FILTER (WHERE ndvi > -1 AND ndvi < 1) AS valid_pixels,
       round(avg(ndvi), 6) AS mean_ndvi,
       round(avg(CASE WHEN NOT is_masked THEN ndvi END), 6) AS mean_ndvi_unmasked,
       round(count(*) FILTER (WHERE ndvi > -1 AND ndvi < 1) / count(*), 6) AS valid_share
FROM masked GROUP BY scene_id"""

SQL["scene_stats_long"] = _with(BAND_SAMPLES, GUARDED, SCENE_STATS) + """
SELECT scene_id, metric, round(value, 6) AS value FROM (
  SELECT scene_id, 'mean_ndvi' AS metric, mean_ndvi AS value FROM scene_stats
  UNION ALL SELECT scene_id, 'min_ndvi', min_ndvi FROM scene_stats
  UNION ALL SELECT scene_id, 'max_ndvi', max_ndvi FROM scene_stats
  UNION ALL SELECT scene_id, 'std_ndvi', std_ndvi FROM scene_stats
  UNION ALL SELECT scene_id, 'healthy_share', valid_pixels / total_pixels FROM scene_stats)"""

SQL["band_stats"] = """
WITH band_long AS (
  SELECT l_suppkey AS scene_id, 1 AS band, l_discount AS value FROM lineitem
  UNION ALL SELECT l_suppkey, 2, l_tax FROM lineitem
  UNION ALL SELECT l_suppkey, 3, l_quantity FROM lineitem
  UNION ALL SELECT l_suppkey, 4, l_extendedprice FROM lineitem)
SELECT scene_id, band, round(min(value), 6) AS min_value, round(max(value), 6) AS max_value,
       round(avg(value), 6) AS mean_value
FROM band_long GROUP BY scene_id, band"""

SQL["band_pair_choice"] = _with(IMAGE_BANDS, BAND_CHOICE) + """
SELECT scene_id, band_count, pixels,
       CAST(red_band AS VARCHAR) || ',' || CAST(nir_band AS VARCHAR) AS band_pair
FROM chosen"""

SQL["scene_metadata"] = _with(BAND_SAMPLES) + """
SELECT scene_id, CAST(scene_id AS VARCHAR) AS path,
       CAST(max(pixel_col) - min(pixel_col) + 1 AS BIGINT) AS width,
       CAST(max(pixel_row) - min(pixel_row) + 1 AS BIGINT) AS height,
       'EPSG:4326' AS crs,
       round(CAST(min(pixel_col) AS DOUBLE), 6) AS bounds_left,
       round(CAST(min(pixel_row) AS DOUBLE), 6) AS bounds_bottom,
       round(CAST(max(pixel_col) + 1 AS DOUBLE), 6) AS bounds_right,
       round(CAST(max(pixel_row) + 1 AS DOUBLE), 6) AS bounds_top
FROM band_samples GROUP BY scene_id"""

SQL["scene_date_series"] = _with(BAND_SAMPLES) + """,
days AS (SELECT scene_id, capture_date, count(*) AS px FROM band_samples
         GROUP BY scene_id, capture_date)
SELECT scene_id, string_agg(strftime(capture_date, '%Y-%m-%d'), ',' ORDER BY capture_date) AS dates,
       count(*) AS n_dates, CAST(sum(px) AS BIGINT) AS pixels
FROM days GROUP BY scene_id"""

SQL["ndvi_daily_mean"] = _with(BAND_SAMPLES, MASKED) + """
SELECT scene_id, strftime(capture_date, '%Y-%m-%d') AS capture_date,
       round(avg(ndvi), 6) AS mean_ndvi, count(*) AS pixels
FROM masked GROUP BY scene_id, capture_date"""

SQL["trend_per_1000_days"] = _with(BAND_SAMPLES, MASKED) + """,
pts AS (SELECT scene_id, capture_date, avg(ndvi) AS mean_ndvi FROM masked
        GROUP BY scene_id, capture_date),
""" + _slope("tr", "pts", "scene_id", DAY_CAPTURE, "mean_ndvi", "1000") + """
SELECT scene_id, n_points, round(t, 6) AS ndvi_trend,
       CASE WHEN t > 0 THEN 'green' ELSE 'red' END AS colour
FROM tr"""

_TREND_YEAR = """
SELECT field_id, n_points, round(t, 6) AS trend_per_year,
       CASE WHEN t > 0 THEN 'improving' ELSE 'declining' END AS direction,
       round(abs(t), 6) AS abs_trend, n_points >= 2 AS shown
FROM ty"""

SQL["trend_per_year"] = _with(OBSERVATIONS, _slope("ty", "observations", "field_id", DAY_TS,
                                                   "ndvi", "365")) + _TREND_YEAR

SQL["trend_per_image"] = _with(BAND_SAMPLES) + """,
px AS (SELECT l_suppkey % 7 AS field, CAST(l_shipdate AS DATE) AS capture_date,
              l_orderkey AS image,
              CASE WHEN l_discount > 0 AND l_tax > 0
                   THEN greatest(-1.0::DOUBLE, least(1.0::DOUBLE,
                          (l_tax - l_discount) / (l_tax + l_discount)))
                   ELSE -1.0::DOUBLE END AS ndvi FROM lineitem),
pts AS (SELECT field, capture_date, image, avg(ndvi) AS mean_ndvi FROM px
        GROUP BY field, capture_date, image),
""" + _slope("tr", "pts", "field", DAY_CAPTURE, "mean_ndvi", "1000") + """
SELECT field, n_points, round(t, 6) AS ndvi_trend,
       CASE WHEN t > 0 THEN 'green' ELSE 'red' END AS colour
FROM tr"""

SQL["trend_first_ten"] = _with(OBSERVATIONS, """first_ten AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY field_id ORDER BY ts, event_id) AS rn
  FROM observations) WHERE rn <= 10)""", _slope("ty", "first_ten", "field_id", DAY_TS,
                                              "ndvi", "365")) + _TREND_YEAR

SQL["latest_observation"] = _with(OBSERVATIONS) + f"""
SELECT field_id, n_obs, {_f(TS_TEXT, c='ts')} AS ts, event_id, round(ndvi, 6) AS ndvi
FROM (SELECT *, row_number() OVER (PARTITION BY field_id ORDER BY ts DESC, event_id DESC) AS rn,
             count(*) OVER (PARTITION BY field_id) AS n_obs
      FROM observations) WHERE rn = 1"""

SQL["history_series"] = _with(OBSERVATIONS, BAND_SAMPLES, GUARDED, SCENE_STATS, SCENE_LABELS,
                              CLIMATE, TRAIN_FRAME, NDVI_COEF) + f"""
SELECT field_id, {_f(TS_TEXT, c='ts')} AS ts, event_id, round(ndvi, 6) AS ndvi,
       round((ndvi + 1) / 2, 6) AS health_index, round(i + s * ndvi, 6) AS predicted_yield
FROM observations CROSS JOIN coef ORDER BY field_id, ts, event_id"""

SQL["water_stress_basic"] = _with(FIELDS) + f"""
SELECT field_id, round(mean_ndvi, 6) AS mean_ndvi, round(temperature, 6) AS temperature,
       round({_f(BASIC_STRESS, n='mean_ndvi', t='temperature')}, 6) AS water_stress
FROM fields"""

_CLIMATE_STRESS_FIELDS = _f(CLIMATE_STRESS, n="mean_ndvi", t="temperature", r="rainfall")

SQL["water_stress_climate"] = _with(FIELDS) + f""",
s AS (SELECT field_id, {_CLIMATE_STRESS_FIELDS} AS ws FROM fields)
SELECT field_id, round(ws, 6) AS water_stress, {_f(STRESS_CLASS, s='ws')} AS stress_class,
       CASE WHEN ws > 7 THEN 'Severe water stress! Increase irrigation by 30%'
            WHEN ws > 4 THEN 'Moderate stress - consider 15% irrigation increase'
            ELSE 'Optimal water conditions' END AS advice
FROM s"""

SQL["stress_class_counts"] = _with(FIELDS) + f"""
SELECT stress_form, stress_class, count(*) AS n_fields FROM (
  SELECT 'basic' AS stress_form,
         {_f(STRESS_CLASS, s='(' + _f(BASIC_STRESS, n='mean_ndvi', t='temperature') + ')')}
           AS stress_class FROM fields
  UNION ALL
  SELECT 'climate', {_f(STRESS_CLASS, s='(' + _CLIMATE_STRESS_FIELDS + ')')} FROM fields)
GROUP BY stress_form, stress_class"""

SQL["disease_risk_rules"] = _with(FIELDS) + f""",
r AS (SELECT field_id, {_f(RISK_SCORE, n='mean_ndvi', h='humidity', w='leaf_wetness',
                            t='temperature')} AS score FROM fields),
c AS (SELECT field_id, score, {_f(RISK_CLASS, s='score')} AS risk_class FROM r)
SELECT field_id, round(score, 6) AS risk_score, risk_class,
       CASE WHEN contains(risk_class, 'High') THEN 'Apply fungicide treatment'
            WHEN contains(risk_class, 'Moderate') THEN 'Monitor closely and improve airflow'
       END AS advice
FROM c"""

SQL["economics_plain"] = _with(YIELDS) + """
SELECT field_id, round(yield, 6) AS yield, round(fertilizer_cost, 6) AS fertilizer_cost,
       round(yield * 180 - (fertilizer_cost + 150), 6) AS profit,
       round(CASE WHEN fertilizer_cost = 0 THEN NULL
                  ELSE (yield * 180 - fertilizer_cost) / fertilizer_cost * 100 END, 6) AS roi
FROM yields"""

SQL["economics_guarded"] = _with(YIELDS) + f""",
e AS (SELECT field_id, yield, fertilizer_cost,
             {_f(PROFIT_FLOORED, y='yield', f='fertilizer_cost', l='150', p='180')} AS profit,
             {_f(ROI_GUARDED, y='yield', f='fertilizer_cost', p='180')} AS roi
      FROM yields)
SELECT field_id, round(yield, 6) AS yield, round(fertilizer_cost, 6) AS fertilizer_cost,
       round(profit, 6) AS profit, round(roi, 6) AS roi,
       CASE WHEN roi < 50 THEN 'low' WHEN roi < 100 THEN 'moderate' ELSE 'excellent' END
         AS roi_class_a,
       CASE WHEN roi > 200 THEN 'excellent' WHEN roi > 100 THEN 'good' ELSE 'low' END
         AS roi_class_b
FROM e"""

SQL["roi_histogram"] = _with(YIELDS) + """,
roi AS (SELECT (yield * 180 - fertilizer_cost) / fertilizer_cost * 100 AS x
        FROM yields WHERE fertilizer_cost <> 0),
st AS (SELECT min(x) AS lo, max(x) AS hi, avg(x) AS mean FROM roi),
counts AS (SELECT CAST(least(20, floor((x - lo) / (hi - lo) * 20) + 1) AS INTEGER) AS bin,
                  count(*) AS n
           FROM roi, st GROUP BY 1),
bins AS (SELECT CAST(range AS INTEGER) AS bin FROM range(1, 21))
SELECT b.bin, round(lo + (b.bin - 1) * ((hi - lo) / 20), 6) AS bin_lo,
       round(lo + b.bin * ((hi - lo) / 20), 6) AS bin_hi,
       coalesce(c.n, 0) AS n, round(mean, 6) AS mean_value
FROM bins b CROSS JOIN st LEFT JOIN counts c ON b.bin = c.bin"""

SQL["cost_breakdown"] = _with(YIELDS) + """
SELECT field_id, 'Revenue' AS item, round(yield * 180, 6) AS amount FROM yields
UNION ALL SELECT field_id, 'Fertilizer Cost', round(fertilizer_cost, 6) FROM yields
UNION ALL SELECT field_id, 'Labor Cost', round(150.0::DOUBLE, 6) FROM yields"""

SQL["yield_class"] = _with(SCENE_LABELS) + """
SELECT scene_id, round(yield, 6) AS yield,
       CASE WHEN yield > 2.5 THEN 'Optimal' ELSE 'Below Average' END AS yield_class
FROM scene_labels"""

SQL["domain_check"] = _with(FIELDS) + """,
v AS (SELECT field_id, concat_ws(',',
        CASE WHEN NOT coalesce(rainfall BETWEEN 0 AND 300, false) THEN 'rainfall' END,
        CASE WHEN NOT coalesce(temperature BETWEEN 10 AND 40, false) THEN 'temperature' END,
        CASE WHEN NOT coalesce(humidity BETWEEN 0 AND 100, false) THEN 'humidity' END,
        CASE WHEN NOT coalesce(leaf_wetness BETWEEN 0 AND 24, false) THEN 'leaf_wetness' END,
        CASE WHEN NOT coalesce(mean_ndvi BETWEEN -1 AND 1, false) THEN 'ndvi' END) AS violations
      FROM fields)
SELECT field_id, violations,
       CAST(CASE WHEN violations = '' THEN 0
            ELSE length(violations) - length(replace(violations, ',', '')) + 1 END AS INTEGER)
         AS n_violations
FROM v"""

SQL["train_frame"] = _with(BAND_SAMPLES, GUARDED, SCENE_STATS, SCENE_LABELS, CLIMATE,
                           TRAIN_FRAME) + """
SELECT scene_id, round(mean_ndvi, 6) AS mean_ndvi, round(rainfall, 6) AS rainfall,
       round(temperature, 6) AS temperature, round(soil_ph, 6) AS soil_ph,
       round(fertilizer, 6) AS fertilizer, region, round(yield, 6) AS yield
FROM train_frame"""

SQL["run_summary"] = _with(IMAGE_BANDS, BAND_CHOICE) + """
SELECT CASE WHEN red_band IS NOT NULL THEN 'done' ELSE 'failed' END AS status,
       count(*) AS n_images
FROM chosen GROUP BY 1"""

SQL["failed_images"] = _with(IMAGE_BANDS, BAND_CHOICE) + """
SELECT scene_id, band_count FROM chosen WHERE red_band IS NULL"""

SQL["path_fields"] = """
WITH listing AS (
  SELECT '/data/time_series/' || CAST(l_suppkey AS VARCHAR) || '/' ||
         CASE WHEN l_linenumber = 7 THEN 'unknown' ELSE strftime(l_shipdate, '%Y%m%d') END ||
         '_' || CAST(l_linenumber AS VARCHAR) ||
         CASE WHEN l_returnflag = 'R' THEN '.TIF' WHEN l_returnflag = 'A' THEN '_NDVI.tif'
              WHEN l_linestatus = 'F' THEN '.tiff' WHEN l_linenumber = 6 THEN '.png'
              ELSE '.tif' END AS path
  FROM lineitem),
p AS (
  SELECT path, string_split(path, '/')[-2] AS field_id,
         string_split(path, '/')[-1] AS filename,
         regexp_matches(lower(path), '\\.tiff?$') AS is_raster,
         ends_with(path, '.tif') AS is_series,
         string_split(string_split(path, '/')[-1], '_')[1] AS date_text
  FROM listing)
SELECT path, field_id, filename, is_raster,
       is_raster AND NOT contains(filename, '_NDVI') AS is_ndvi_input,
       is_series, date_text,
       strftime(CAST(try_strptime(date_text, '%Y%m%d') AS DATE), '%Y-%m-%d') AS capture_date,
       CASE WHEN is_raster AND NOT contains(filename, '_NDVI')
            THEN regexp_replace(path, '\\.(tiff?)$', '_NDVI.\\1', 'i') END AS output_path,
       CAST(datediff('day', DATE '1970-01-01', CAST(try_strptime(date_text, '%Y%m%d') AS DATE))
         AS DOUBLE) AS day_number
FROM p"""

SQL["label_sections"] = _with(SCENE_LABELS, CLIMATE) + """
SELECT CAST(l.scene_id AS VARCHAR) || '_NDVI.tif' AS filename, round(l.yield, 6) AS yield,
       round(CASE WHEN s.s_acctbal > 0 THEN c.rainfall END, 6) AS rainfall,
       round(CASE WHEN s.s_acctbal > 0 THEN c.temperature END, 6) AS temperature,
       round(CASE WHEN s.s_acctbal > 0 THEN c.soil_ph END, 6) AS soil_ph,
       round(CASE WHEN s.s_acctbal > 0 THEN c.fertilizer END, 6) AS fertilizer,
       CASE WHEN s.s_acctbal > 0 THEN l.region END AS region
FROM scene_labels l JOIN supplier s ON l.scene_id = s.s_suppkey
                    JOIN climate c ON l.nation_id = c.nation_id"""

SQL["ndvi_batch_output"] = _with(BAND_SAMPLES, MASKED) + """
SELECT scene_id, count(*) AS pixels, count(*) FILTER (WHERE is_masked) AS masked_pixels,
       round(avg(ndvi), 6) AS mean_ndvi
FROM masked GROUP BY scene_id"""

SQL["ndvi_batch_job"] = _with(IMAGE_BANDS, BAND_CHOICE) + """,
px AS (SELECT c.scene_id, max(value) FILTER (WHERE band = red_band) AS r,
              max(value) FILTER (WHERE band = nir_band) AS n
       FROM chosen c JOIN image_bands i ON i.scene_id = c.scene_id
       WHERE red_band IS NOT NULL GROUP BY c.scene_id),
done AS (SELECT scene_id, count(*) AS pixels,
                count(*) FILTER (WHERE NOT (r > 0 AND n > 0)) AS masked_pixels,
                avg(CASE WHEN r > 0 AND n > 0 THEN (n - r) / (n + r) ELSE -1.0 END) AS mean_ndvi
         FROM px GROUP BY scene_id),
s AS (SELECT c.scene_id, CASE WHEN red_band IS NULL THEN 'failed' ELSE 'done' END AS status,
             coalesce(d.pixels, 0) AS pixels, coalesce(d.masked_pixels, 0) AS masked_pixels,
             d.mean_ndvi
      FROM chosen c LEFT JOIN done d ON d.scene_id = c.scene_id)
SELECT status, scene_id, pixels, masked_pixels, round(mean_ndvi, 6) AS mean_ndvi,
       count(*) OVER (PARTITION BY status) AS n_images FROM s"""

SQL["scenario_grid"] = _with(FIELDS, BAND_SAMPLES, GUARDED, SCENE_STATS, SCENE_LABELS, CLIMATE,
                             TRAIN_FRAME, NDVI_COEF) + f""",
req AS (SELECT l_partkey AS field_id, l_orderkey * 10 + l_linenumber AS scenario_id,
               l_quantity * 6 AS rainfall, 10 + l_quantity % 30 AS temperature,
               l_discount * 3000 AS fertilizer, l_tax * 20 - 0.6::DOUBLE AS ndvi
        FROM lineitem),
r AS (SELECT q.*, coef.i + coef.s * q.ndvi AS pred,
             {_f(CLIMATE_STRESS, n='q.ndvi', t='q.temperature', r='q.rainfall')} AS ws,
             {_f(RISK_SCORE, n='q.ndvi', h='f.humidity', w='f.leaf_wetness', t='q.temperature')}
               AS score
      FROM req q LEFT JOIN fields f ON f.field_id = q.field_id CROSS JOIN coef),
c AS (SELECT *, {_f(RISK_CLASS, s='score')} AS risk_class FROM r)
SELECT field_id, scenario_id, round(pred, 6) AS predicted_yield,
       round((ndvi + 1) / 2, 6) AS health_index, round(ws, 6) AS water_stress,
       round(score, 6) AS risk_score, risk_class,
       round({_f(PROFIT_FLOORED, y='pred', f='fertilizer', l='150', p='180')}, 6) AS profit,
       round({_f(ROI_GUARDED, y='pred', f='fertilizer', p='180')}, 6) AS roi,
       CASE WHEN pred < 2.0 THEN 'Low yield predicted - consider soil amendments'
            WHEN ws > 6 THEN 'High water stress - optimize irrigation'
            WHEN contains(risk_class, 'High')
              THEN 'Disease risk high - apply preventative measures' END AS advice
FROM c"""

SQL["yield_linear_1"] = _with(BAND_SAMPLES, GUARDED, SCENE_STATS, SCENE_LABELS, CLIMATE,
                              TRAIN_FRAME) + """,
coef AS (SELECT regr_slope(yield, mean_ndvi) AS s, regr_intercept(yield, mean_ndvi) AS i
         FROM train_frame)
SELECT scene_id, round(i + s * mean_ndvi, 6) AS prediction FROM train_frame, coef"""

# least squares by successive orthogonalisation: each feature is freed of the earlier ones
_ORTHO = """,
z0 AS (SELECT *, (mean_ndvi - avg(mean_ndvi) OVER ()) AS z1,
              (rainfall - avg(rainfall) OVER ()) AS a2, (temperature - avg(temperature) OVER ()) AS a3,
              (soil_ph - avg(soil_ph) OVER ()) AS a4, (fertilizer - avg(fertilizer) OVER ()) AS a5,
              avg(yield) OVER () AS ybar FROM train_frame),
z2 AS (SELECT *, a2 - z1 * (sum(a2 * z1) OVER () / sum(z1 * z1) OVER ()) AS z2 FROM z0),
z3 AS (SELECT *, a3 - z1 * (sum(a3 * z1) OVER () / sum(z1 * z1) OVER ())
                    - z2 * (sum(a3 * z2) OVER () / sum(z2 * z2) OVER ()) AS z3 FROM z2),
z4 AS (SELECT *, a4 - z1 * (sum(a4 * z1) OVER () / sum(z1 * z1) OVER ())
                    - z2 * (sum(a4 * z2) OVER () / sum(z2 * z2) OVER ())
                    - z3 * (sum(a4 * z3) OVER () / sum(z3 * z3) OVER ()) AS z4 FROM z3),
z5 AS (SELECT *, a5 - z1 * (sum(a5 * z1) OVER () / sum(z1 * z1) OVER ())
                    - z2 * (sum(a5 * z2) OVER () / sum(z2 * z2) OVER ())
                    - z3 * (sum(a5 * z3) OVER () / sum(z3 * z3) OVER ())
                    - z4 * (sum(a5 * z4) OVER () / sum(z4 * z4) OVER ()) AS z5 FROM z4),
fitted AS (SELECT *, ybar + z1 * (sum(yield * z1) OVER () / sum(z1 * z1) OVER ())
                          + z2 * (sum(yield * z2) OVER () / sum(z2 * z2) OVER ())
                          + z3 * (sum(yield * z3) OVER () / sum(z3 * z3) OVER ())
                          + z4 * (sum(yield * z4) OVER () / sum(z4 * z4) OVER ())
                          + z5 * (sum(yield * z5) OVER () / sum(z5 * z5) OVER ()) AS pred
           FROM z5)"""

SQL["yield_linear_5"] = _with(BAND_SAMPLES, GUARDED, SCENE_STATS, SCENE_LABELS, CLIMATE,
                              TRAIN_FRAME) + _ORTHO + """
SELECT scene_id, round(pred, 6) AS prediction FROM fitted"""

SQL["region_index"] = _with(SCENE_LABELS) + """,
o AS (SELECT region, row_number() OVER (ORDER BY count(*) DESC, region) - 1 AS k
      FROM scene_labels GROUP BY region)
SELECT scene_id, region, round(k, 6) AS region_index FROM scene_labels JOIN o USING (region)"""

SQL["disease_scaled_features"] = _with(FIELDS) + """
SELECT field_id,
       round((mean_ndvi - avg(mean_ndvi) OVER ()) / stddev_samp(mean_ndvi) OVER (), 6) AS scaled_ndvi,
       round((humidity - avg(humidity) OVER ()) / stddev_samp(humidity) OVER (), 6)
         AS scaled_humidity,
       round((leaf_wetness - avg(leaf_wetness) OVER ()) / stddev_samp(leaf_wetness) OVER (), 6)
         AS scaled_leaf_wetness
FROM fields"""

SQL["yield_forest_step"] = _with(BAND_SAMPLES, GUARDED, SCENE_STATS, SCENE_LABELS, CLIMATE,
                                 TRAIN_FRAME) + """
SELECT scene_id, rainfall > 165 AS high_yield FROM train_frame"""

SQL["disease_forest_step"] = _with(FIELDS) + """
SELECT field_id, CASE WHEN leaf_wetness < 6 THEN 'No risk' WHEN leaf_wetness < 12 THEN 'Low risk'
                      WHEN leaf_wetness < 18 THEN 'Medium risk' ELSE 'High risk' END AS risk_label
FROM fields"""

SQL["field_report_raw"] = _with(BAND_SAMPLES, GUARDED, SCENE_STATS, SCENE_LABELS, CLIMATE,
                                TRAIN_FRAME) + _ORTHO + f""",
r AS (SELECT f.*, s.min_ndvi, s.max_ndvi, s.std_ndvi, s.valid_pixels / s.total_pixels AS share,
             (f.mean_ndvi + 1) / 2 AS h,
             {_f(CLIMATE_STRESS, n='f.mean_ndvi', t='f.temperature', r='f.rainfall')} AS ws,
             {_f(RISK_SCORE, n='f.mean_ndvi', h='65.0', w='5.0', t='f.temperature')} AS score,
             {_f(ROI_GUARDED, y='f.pred', f='f.fertilizer', p='180')} AS roi
      FROM fitted f JOIN scene_stats s ON s.scene_id = f.scene_id),
c AS (SELECT *, {_f(RISK_CLASS, s='score')} AS risk_class FROM r)
SELECT scene_id, round(mean_ndvi, 6) AS mean_ndvi, round(min_ndvi, 6) AS min_ndvi,
       round(max_ndvi, 6) AS max_ndvi, round(std_ndvi, 6) AS std_ndvi,
       round(share, 6) AS healthy_share, round(h, 6) AS health_index,
       round(pred, 6) AS predicted_yield,
       CASE WHEN pred > 2.5 THEN 'Optimal' ELSE 'Below Average' END AS yield_class,
       round(ws, 6) AS water_stress, round(score, 6) AS risk_score,
       round(fertilizer, 6) AS fertilizer_cost, {_f(STRESS_CLASS, s='ws')} AS stress_class,
       CASE WHEN ws > 7 THEN 'Severe water stress! Increase irrigation by 30%'
            WHEN ws > 4 THEN 'Moderate stress - consider 15% irrigation increase'
            ELSE 'Optimal water conditions' END AS stress_advice,
       risk_class,
       CASE WHEN contains(risk_class, 'High') THEN 'Apply fungicide treatment'
            WHEN contains(risk_class, 'Moderate') THEN 'Monitor closely and improve airflow'
       END AS risk_advice,
       round({_f(PROFIT_FLOORED, y='pred', f='fertilizer', l='150', p='180')}, 6) AS profit,
       round(roi, 6) AS roi,
       CASE WHEN roi < 50 THEN 'low' WHEN roi < 100 THEN 'moderate' ELSE 'excellent' END
         AS roi_class,
       round(pred * 180, 6) AS revenue, round(150.0::DOUBLE, 6) AS labor_cost
FROM c"""

SQL["stream_scored_history"] = _with(OBSERVATIONS, BAND_SAMPLES, GUARDED, SCENE_STATS,
                                     SCENE_LABELS, CLIMATE, TRAIN_FRAME, NDVI_COEF) + f""",
s AS (SELECT field_id, event_id, ts, ndvi, (ndvi + 1) / 2 AS h,
             {_f(CLIMATE_STRESS, n='ndvi', t='25.0', r='100.0')} AS ws,
             {_f(RISK_SCORE, n='ndvi', h='65.0', w='5.0', t='25.0')} AS score,
             coef.i + coef.s * ndvi AS pred
      FROM observations CROSS JOIN coef)
SELECT field_id, event_id, {_f(TS_TEXT, c='ts')} AS ts, round(ndvi, 6) AS ndvi,
       round(pred, 6) AS predicted_yield, round(h, 6) AS health_index, round(ws, 6) AS water_stress,
       round(score, 6) AS risk_score, {_f(HEALTH_CLASS, h='h')} AS health_class,
       {_f(RISK_CLASS, s='score')} AS risk_class
FROM s"""

SQL["stream_latest_state"] = SQL["latest_observation"]

SQL["water_stress_csv"] = _with(FIELDS) + f"""
SELECT CAST(field_id AS VARCHAR) AS field_id, round(mean_ndvi, 6) AS mean_ndvi,
       round(temperature, 6) AS temperature,
       round({_f(BASIC_STRESS, n='mean_ndvi', t='temperature')}, 6) AS water_stress
FROM fields"""

SQL["economics_csv"] = _with(YIELDS) + """
SELECT CAST(field_id AS VARCHAR) AS field_id, round(yield, 6) AS yield,
       round(fertilizer_cost, 6) AS fertilizer_cost,
       round(yield * 180 - (fertilizer_cost + 150), 6) AS profit,
       round(CASE WHEN fertilizer_cost = 0 THEN NULL
                  ELSE (yield * 180 - fertilizer_cost) / fertilizer_cost * 100 END, 6) AS roi
FROM yields"""

SQL["field_report_ndvi"] = _with(BAND_SAMPLES, GUARDED, SCENE_STATS, SCENE_LABELS, CLIMATE,
                                 TRAIN_FRAME, MASKED) + f""",
coef AS (SELECT regr_slope(yield, mean_ndvi) AS s, regr_intercept(yield, mean_ndvi) AS i
         FROM train_frame),
ms AS (SELECT scene_id, min(ndvi) AS min_ndvi, max(ndvi) AS max_ndvi, avg(ndvi) AS mean_ndvi,
              median(ndvi) AS median_ndvi, stddev_pop(ndvi) AS std_ndvi
       FROM masked GROUP BY scene_id),
env AS (SELECT l.scene_id, c.temperature, c.fertilizer
        FROM scene_labels l JOIN climate c ON l.nation_id = c.nation_id),
r AS (SELECT ms.*, (mean_ndvi + 1) / 2 AS h, coef.i + coef.s * mean_ndvi AS pred,
             env.temperature, env.fertilizer
      FROM ms CROSS JOIN coef JOIN env ON ms.scene_id = env.scene_id),
q AS (SELECT *, {_f(BASIC_STRESS, n='mean_ndvi', t='temperature')} AS ws,
             {_f(RISK_SCORE, n='mean_ndvi', h='65.0', w='5.0', t='temperature')} AS score,
             {_f(ROI_GUARDED, y='pred', f='fertilizer', p='180')} AS roi
      FROM r)
SELECT scene_id, round(min_ndvi, 6) AS min_ndvi, round(max_ndvi, 6) AS max_ndvi,
       round(mean_ndvi, 6) AS mean_ndvi, round(median_ndvi, 6) AS median_ndvi,
       round(std_ndvi, 6) AS std_ndvi, round(h, 6) AS health_index,
       round(pred, 6) AS predicted_yield, round(ws, 6) AS water_stress,
       round(score, 6) AS risk_score, {_f(HEALTH_CLASS, h='h')} AS health_class,
       {_f(STRESS_CLASS, s='ws')} AS stress_class, {_f(RISK_CLASS, s='score')} AS risk_class,
       round({_f(PROFIT_FLOORED, y='pred', f='fertilizer', l='150', p='180')}, 6) AS profit,
       round(roi, 6) AS roi,
       CASE WHEN roi > 200 THEN 'excellent' WHEN roi > 100 THEN 'good' ELSE 'low' END
         AS roi_class
FROM q"""

SQL["history_report"] = _with(OBSERVATIONS, BAND_SAMPLES, GUARDED, SCENE_STATS, SCENE_LABELS,
                              CLIMATE, TRAIN_FRAME, NDVI_COEF, """first_ten AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY field_id ORDER BY ts, event_id) AS rn
  FROM observations) WHERE rn <= 10)""",
    _slope("yr", "observations", "field_id", DAY_TS, "ndvi", "365"),
    _slope("ft", "first_ten", "field_id", DAY_TS, "ndvi", "365")) + f""",
latest AS (SELECT field_id, n_obs, ts, event_id, ndvi FROM (
  SELECT *, row_number() OVER (PARTITION BY field_id ORDER BY ts DESC, event_id DESC) AS rn,
         count(*) OVER (PARTITION BY field_id) AS n_obs FROM observations) WHERE rn = 1)
SELECT l.field_id, l.n_obs, {_f(TS_TEXT, c='l.ts')} AS ts, l.event_id, round(l.ndvi, 6) AS ndvi,
       round(yr.t, 6) AS trend_per_year,
       CASE WHEN yr.t > 0 THEN 'improving' ELSE 'declining' END AS direction,
       round(abs(yr.t), 6) AS abs_trend, round(ft.t, 6) AS trend_first_ten,
       round(coef.i + coef.s * l.ndvi, 6) AS predicted_yield
FROM latest l CROSS JOIN coef JOIN yr ON l.field_id = yr.field_id JOIN ft ON l.field_id = ft.field_id
WHERE l.n_obs >= 2"""

SQL["band_diagnostic"] = _with(BAND_SAMPLES) + """,
band_long AS (
  SELECT l_suppkey AS scene_id, 1 AS band, l_discount AS value FROM lineitem
  UNION ALL SELECT l_suppkey, 2, l_tax FROM lineitem
  UNION ALL SELECT l_suppkey, 3, l_quantity FROM lineitem
  UNION ALL SELECT l_suppkey, 4, l_extendedprice FROM lineitem WHERE l_suppkey % 5 <> 0),
bs AS (SELECT scene_id, band, min(value) AS min_value, max(value) AS max_value,
              avg(value) AS mean_value FROM band_long GROUP BY scene_id, band),
bc AS (SELECT scene_id, count(DISTINCT band) AS band_count FROM band_long GROUP BY scene_id),
meta AS (SELECT scene_id, CAST(max(pixel_col) - min(pixel_col) + 1 AS BIGINT) AS width,
                CAST(max(pixel_row) - min(pixel_row) + 1 AS BIGINT) AS height
         FROM band_samples GROUP BY scene_id)
SELECT bs.scene_id, bs.band, round(min_value, 6) AS min_value, round(max_value, 6) AS max_value,
       round(mean_value, 6) AS mean_value, band_count, width, height
FROM bs JOIN bc ON bs.scene_id = bc.scene_id LEFT JOIN meta ON bs.scene_id = meta.scene_id"""


# --- failure records, tiles, run metrics, series, versions, trends on the stream ---------

BAD_YIELDS = """bad_yields AS (
  SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS id, l_orderkey % 13 = 0 AS short_line,
         l_linenumber = 3 AND l_orderkey % 5 = 0 AS bad_yield, l_orderkey % 11 = 0 AS bad_cost,
         (l_quantity - 5) / 10 AS yield, l_tax * 3000 AS fertilizer_cost
  FROM lineitem)"""

SQL["failure_records"] = _with(BAD_YIELDS, SCENE_LABELS, IMAGE_BANDS, BAND_CHOICE) + """,
wide_labels AS (SELECT scene_id FROM scene_labels JOIN supplier ON s_suppkey = scene_id
                WHERE s_acctbal > 0),
bad_labels AS (
  SELECT scene_id, 'yield' AS name, 'bad' AS value FROM scene_labels WHERE scene_id % 4 = 0
  UNION ALL SELECT scene_id, 'yield', 'bad' FROM wide_labels WHERE scene_id % 4 = 0
  UNION ALL SELECT scene_id, 'rainfall', 'wet' FROM wide_labels WHERE scene_id % 6 = 0)
SELECT 'yields' AS source, id AS key, 'read' AS stage, CAST(NULL AS VARCHAR) AS name,
       id || ',short' AS value, 'wrong number of columns' AS reason FROM bad_yields WHERE short_line
UNION ALL SELECT 'yields', id, 'parse', 'yield', 'n/a', 'not a double'
FROM bad_yields WHERE bad_yield AND NOT short_line
UNION ALL SELECT 'yields', id, 'parse', 'fertilizer_cost', 'unknown', 'not a double'
FROM bad_yields WHERE bad_cost AND NOT short_line
UNION ALL SELECT 'labels', CAST(scene_id AS VARCHAR) || '_NDVI.tif', 'parse', name, value, 'not a double'
FROM bad_labels
UNION ALL SELECT 'images', CAST(scene_id AS VARCHAR), 'bands', 'band_count',
       CAST(band_count AS VARCHAR), 'no red and near-infrared band' FROM chosen WHERE red_band IS NULL
UNION ALL SELECT 'images', CAST(scene_id AS VARCHAR), 'bands', 'band', '3', 'band without a number'
FROM chosen WHERE red_band = 3 AND scene_id % 3 = 0"""

SQL["economics_good_rows"] = _with(BAD_YIELDS) + """
SELECT id AS field_id, round(yield, 6) AS yield, round(fertilizer_cost, 6) AS fertilizer_cost,
       round(yield * 180 - (fertilizer_cost + 150), 6) AS profit,
       round(CASE WHEN fertilizer_cost = 0 THEN NULL
                  ELSE (yield * 180 - fertilizer_cost) / fertilizer_cost * 100 END, 6) AS roi
FROM bad_yields WHERE NOT (short_line OR bad_yield OR bad_cost)"""

SQL["labels_good_rows"] = _with(SCENE_LABELS, CLIMATE) + """,
rows AS (
  SELECT l.*, c.*, s.s_acctbal > 0 AND l.scene_id % 6 <> 0 AS wide
  FROM scene_labels l JOIN supplier s ON l.scene_id = s.s_suppkey
                      JOIN climate c ON l.nation_id = c.nation_id
  WHERE l.scene_id % 4 <> 0)
SELECT CAST(scene_id AS VARCHAR) || '_NDVI.tif' AS filename, round(yield, 6) AS yield,
       round(CASE WHEN wide THEN rainfall END, 6) AS rainfall,
       round(CASE WHEN wide THEN temperature END, 6) AS temperature,
       round(CASE WHEN wide THEN soil_ph END, 6) AS soil_ph,
       round(CASE WHEN wide THEN fertilizer END, 6) AS fertilizer,
       CASE WHEN wide THEN region END AS region
FROM rows"""

SQL["tile_ndvi_stats"] = _with(BAND_SAMPLES) + """,
px AS (SELECT scene_id, pixel_row, pixel_col, max(red) AS red, max(nir) AS nir
       FROM band_samples GROUP BY scene_id, pixel_row, pixel_col),
masked AS (
  SELECT scene_id, NOT (red > 0 AND nir > 0) AS is_masked,
         CASE WHEN red > 0 AND nir > 0 THEN (nir - red) / (nir + red) ELSE -1.0::DOUBLE END AS ndvi
  FROM px)
SELECT scene_id, count(*) AS total_pixels, count(*) FILTER (WHERE is_masked) AS masked_pixels,
       count(*) FILTER (WHERE ndvi > -1 AND ndvi < 1) AS valid_pixels,
       round(min(ndvi), 6) AS min_ndvi, round(max(ndvi), 6) AS max_ndvi,
       round(avg(ndvi), 6) AS mean_ndvi, count(*) AS written_pixels,
       round(sum(ndvi), 6) AS written_sum
FROM masked GROUP BY scene_id"""

SQL["ndvi_run_metrics"] = """
WITH image_bands AS (
  SELECT l_orderkey % 1000 AS scene_id, l_linenumber AS band, l_orderkey AS pixel_row,
         l_discount - 0.02 AS value FROM lineitem),""" + BAND_CHOICE + """,
px AS (SELECT i.scene_id, pixel_row, max(value) FILTER (WHERE band = red_band) AS r,
              max(value) FILTER (WHERE band = nir_band) AS n
       FROM image_bands i JOIN chosen c ON c.scene_id = i.scene_id
       WHERE band = red_band OR band = nir_band GROUP BY i.scene_id, pixel_row)
SELECT (SELECT count(*) FROM chosen WHERE red_band IS NOT NULL) AS done,
       (SELECT count(*) FROM chosen WHERE red_band IS NULL) AS failed,
       count(*) AS pixels,
       count(*) FILTER (WHERE NOT coalesce(r > 0 AND n > 0, false)) AS masked_pixels
FROM px"""

SERIES = """li AS (
  SELECT l_orderkey, l_linenumber, l_discount AS red, l_tax AS nir, CAST(l_suppkey AS VARCHAR) AS field,
         CASE WHEN l_linenumber <> 7 THEN CAST(l_shipdate AS DATE) END AS day,
         '/data/time_series/' || CAST(l_suppkey AS VARCHAR) || '/' ||
         CASE WHEN l_linenumber = 7 THEN 'unknown' ELSE strftime(l_shipdate, '%Y%m%d') END ||
         '_' || CAST(l_linenumber AS VARCHAR) ||
         CASE WHEN l_returnflag = 'R' THEN '.TIF' WHEN l_returnflag = 'A' THEN '_NDVI.tif'
              WHEN l_linestatus = 'F' THEN '.tiff' WHEN l_linenumber = 6 THEN '.png'
              ELSE '.tif' END AS path
  FROM lineitem),
images AS (SELECT DISTINCT path, field, day FROM li
           WHERE ends_with(path, '.tif') AND NOT (l_linenumber = 1 AND l_orderkey % 7 = 0)),
means AS (SELECT path, avg(CASE WHEN red > 0 AND nir > 0 THEN (nir - red) / (nir + red) ELSE -1.0 END) AS v
          FROM li WHERE ends_with(path, '.tif') AND l_linenumber <= 5 GROUP BY path)"""

SQL["series_trend"] = _with(SERIES, """pts AS (
  SELECT field AS field_id, day, v FROM images JOIN means USING (path) WHERE day IS NOT NULL)""",
    _slope("tr", "pts", "field_id", "datediff('day', DATE '1995-01-01', day)", "v", "1000")) + """
SELECT field_id, n_points, round(t, 6) AS ndvi_trend,
       CASE WHEN t > 0 THEN 'green' ELSE 'red' END AS colour FROM tr"""

SQL["series_unmatched"] = _with(SERIES) + """
SELECT path, field AS field_id, CASE WHEN v IS NULL THEN 'image without pixels'
                                     ELSE 'name without a date' END AS reason
FROM images LEFT JOIN means USING (path) WHERE v IS NULL OR day IS NULL
UNION ALL SELECT path, NULL, 'pixels of no listed image'
FROM means WHERE path NOT IN (SELECT path FROM images)"""

SQL["yield_linear_versioned"] = SQL["yield_linear_1"].replace(
    "SELECT scene_id, round(i", "SELECT CAST(2 AS BIGINT) AS version, scene_id, round(i")

SQL["yield_forest_from_labels"] = _with(SCENE_LABELS, CLIMATE) + """
SELECT CAST(scene_id AS VARCHAR) || '_NDVI.tif' AS filename,
       CASE WHEN s_acctbal > 0 THEN CAST(rainfall > 165 AS VARCHAR) END AS high_yield
FROM scene_labels l JOIN supplier ON s_suppkey = scene_id
                    JOIN climate c ON l.nation_id = c.nation_id"""

SQL["roi_histogram_csv"] = SQL["roi_histogram"]

SQL["stream_trends"] = _with(OBSERVATIONS, """first_ten AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY field_id ORDER BY ts, event_id) AS rn
  FROM observations) WHERE rn <= 10)""",
    _slope("yr", "observations", "field_id", DAY_TS, "ndvi", "365"),
    _slope("ft", "first_ten", "field_id", DAY_TS, "ndvi", "365")) + """
SELECT yr.field_id, yr.n_points AS n_obs, round(yr.t, 6) AS trend_per_year,
       round(ft.t, 6) AS trend_first_ten,
       CASE WHEN yr.t > 0 THEN 'improving' ELSE 'declining' END AS direction
FROM yr JOIN ft ON yr.field_id = ft.field_id"""


def _split_last_arg(args: str) -> tuple[str, str]:
    depth = 0
    for i in range(len(args) - 1, -1, -1):
        ch = args[i]
        if ch == ")":
            depth += 1
        elif ch == "(":
            depth -= 1
        elif ch == "," and depth == 0:
            return args[:i], args[i + 1:]
    raise ValueError(f"round() without digits: {args}")


def _output_rounding(sql: str) -> str:
    """Rewrite every ``round(e, d)`` as the output rounding of ``queries.present``:
    round ``e`` to 9 decimals, then to ``d``, then add 0.0 (turns -0.0 into
    0.0)."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        while j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_"):
            j = sql.find("round(", j + 6)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + 5
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        expr, digits = _split_last_arg(_output_rounding(sql[j + 6:k]))
        out.append(sql[i:j])
        out.append(f"(round(round(CAST(({expr}) AS DOUBLE), 9), {digits.strip()}) + 0.0)")
        i = k + 1


SQL = {k: _output_rounding(v) for k, v in SQL.items()}
