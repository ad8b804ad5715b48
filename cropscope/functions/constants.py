"""Fixed values that must equal the original application's for equal results.

FIXED VALUES - thresholds, multipliers, defaults, labels and advice texts,
stated as plain text in the order the rules use them. Change none of them
without changing the meaning of the rule.
"""

# --- NDVI -------------------------------------------------------------------
NDVI_MIN = -1.0
NDVI_MAX = 1.0
NDVI_MASKED_FILL = -1.0          # masked / undefined pixel value after the fill
NDVI_ZERO_DENOMINATOR = 0.01     # guarded form replaces a zero denominator

# --- health index and class (health = (ndvi + 1) / 2) ---------------------
HEALTH_EXCELLENT = 0.7           # > 0.7
HEALTH_GOOD = 0.5                # > 0.5
HEALTH_MODERATE = 0.3            # > 0.3, else poor
HEALTH_LABELS = ("Excellent", "Good", "Moderate", "Poor")

# --- water stress ----------------------------------------------------------
TEMP_BASE = 10.0                 # temperature normalisation: (t - 10) / 30
TEMP_SPAN = 30.0
RAIN_SPAN = 300.0                # rainfall normalisation: 1 - rain / 300
STRESS_NDVI_FLOOR = 0.01         # basic form: normalised NDVI below this -> 10
STRESS_MAX = 10.0
STRESS_SEVERE = 7.0              # > 7
STRESS_MODERATE = 4.0            # > 4, else normal
STRESS_LABELS = ("severe", "moderate", "normal")
STRESS_ADVICE = (
    "Severe water stress! Increase irrigation by 30%",
    "Moderate stress - consider 15% irrigation increase",
    "Optimal water conditions",
)

# --- disease risk (rules) --------------------------------------------------
DISEASE_TEMP_LOW = 22.0          # 22 <= t <= 28 -> x 1.5
DISEASE_TEMP_HIGH = 28.0
DISEASE_IDEAL_FACTOR = 1.5
DISEASE_HOT_TEMP = 30.0          # t > 30 -> x 0.7
DISEASE_HOT_FACTOR = 0.7
RISK_LOW = 0.15                  # < 0.15
RISK_MODERATE = 0.3              # < 0.3, else high
RISK_LABELS = ("Low risk", "Moderate risk", "High risk")
DISEASE_ADVICE = (
    "Apply fungicide treatment",              # class text contains "High"
    "Monitor closely and improve airflow",    # class text contains "Moderate"
)

# --- disease classifier codes ---------------------------------------------
RISK_CODE_LABELS = {0: "No risk", 1: "Low risk", 2: "Medium risk", 3: "High risk"}
RISK_CODE_UNKNOWN = "Unknown"

# --- economics -------------------------------------------------------------
DEFAULT_LABOR_COST = 150.0
DEFAULT_CROP_PRICE = 180.0
ROI_FLOOR = -100.0               # guarded ROI never below -100 %
ROI_A_LOW = 50.0                 # page A: < 50 low, < 100 moderate, else excellent
ROI_A_MODERATE = 100.0
ROI_A_LABELS = ("low", "moderate", "excellent")
ROI_B_EXCELLENT = 200.0          # page B: > 200 excellent, > 100 good, else low
ROI_B_GOOD = 100.0
ROI_B_LABELS = ("excellent", "good", "low")
COST_ITEMS = ("Revenue", "Fertilizer Cost", "Labor Cost")
HISTOGRAM_BINS = 20

# --- yield and scenario ----------------------------------------------------
YIELD_OPTIMAL = 2.5              # > 2.5 Optimal, else Below Average
YIELD_LABELS = ("Optimal", "Below Average")
SCENARIO_LOW_YIELD = 2.0         # < 2.0 first
SCENARIO_HIGH_STRESS = 6.0       # > 6 second
SCENARIO_ADVICE = (
    "Low yield predicted - consider soil amendments",
    "High water stress - optimize irrigation",
    "Disease risk high - apply preventative measures",
)

# --- trends ----------------------------------------------------------------
TREND_DAYS_FIELD = 1000.0        # field trend job: slope per 1000 days
TREND_DAYS_YEAR = 365.0          # page trend: slope per year
TREND_LABELS = ("improving", "declining")
TREND_COLOURS = ("green", "red")
TREND_FIRST_N = 10               # page B keeps the first ten observations
DATE_TEXT_FORMAT = "yyyyMMdd"

# --- parameter domains (slider ranges) and defaults -------------------------
DOMAINS = {
    "rainfall": (0.0, 300.0),
    "temperature": (10.0, 40.0),
    "soil_ph": (4.0, 9.0),
    "fertilizer": (0.0, 300.0),
    "humidity": (0.0, 100.0),
    "leaf_wetness": (0.0, 24.0),
    "crop_price": (100.0, 300.0),
    "labor_cost": (50.0, 500.0),
    "ndvi": (-1.0, 1.0),
}
DEFAULTS = {
    "rainfall": 100.0,
    "temperature": 25.0,
    "soil_ph": 6.5,
    "fertilizer": 100.0,
    "ndvi": 0.4,
    "humidity": 65.0,
    "leaf_wetness": 5.0,
    "crop_price": 180.0,
    "labor_cost": 150.0,
}

# --- raster file names -----------------------------------------------------
NDVI_OUTPUT_MARKER = "_NDVI"

# --- band pairs (red, nir); an image gets the first whose bands it holds -------
BAND_PAIRS = ((4, 8), (3, 4), (1, 2))

# --- models ----------------------------------------------------------------
YIELD_FOREST = {"numTrees": 100, "maxDepth": 5, "seed": 42}
DISEASE_FOREST = {"numTrees": 50, "maxDepth": 5, "seed": 42}
LINEAR = {"maxIter": 100, "regParam": 0.0, "elasticNetParam": 0.0, "tol": 1e-6,
          "fitIntercept": True, "solver": "auto"}
YIELD_FEATURES_6 = ("mean_ndvi", "rainfall", "temperature", "soil_ph", "fertilizer",
                    "region_index")
YIELD_FEATURES_5 = ("ndvi", "rainfall", "temperature", "soil_ph", "fertilizer")
DISEASE_FEATURES = ("ndvi", "humidity", "leaf_wetness")
DISEASE_TRAINING_ROWS = (
    # ndvi, humidity, leaf_wetness, disease_risk
    (0.65, 75, 6.2, 1),
    (0.42, 85, 8.1, 2),
    (0.38, 90, 9.5, 3),
    (0.71, 60, 4.3, 0),
    (0.53, 78, 7.0, 1),
)
