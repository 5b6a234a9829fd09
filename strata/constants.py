"""Fixed values that must equal the reference behaviour.

Everything in this module is data, not logic: label sets, bin edges,
weights and feature lists that the reference pins. They are kept together
here, in their natural order, so that they can be audited at a glance.
"""

# --- fixed values -----------------------------------------------------------

# Data sources that mark a record as a mortality record.
MORTALITY_SOURCES = ("NVSS, Mortality", "NVSS", "Death Certificate")

# Raw columns removed during cleaning (absent names are ignored).
DROP_COLUMNS = (
    "LocationDesc",
    "DataValueFootnoteSymbol",
    "DatavalueFootnote",
    "LowConfidenceLimit",
    "HighConfidenceLimit",
    "Response",
    "ResponseID",
)

# Columns that receive an integer label encoding (suffix "_enc").
ENCODE_COLUMNS = (
    "LocationAbbr",
    "DataValueType",
    "StratificationCategory1",
    "Stratification1",
)

# Risk bins: right-closed upper edges and their labels.
RISK_UPPER_EDGES = (100_000.0, 250_000.0, 500_000.0)
RISK_LABELS = ("Low", "Moderate", "High", "Very High")

# Minimum number of rows a cleaned table must exceed.
MIN_CLEAN_ROWS = 100

# Minimum support for ranked state/topic and demographic questions.
MIN_SUPPORT = 100

# Weights of the implemented priority score (burden, mortality,
# reliability, year-over-year relative change).
PRIORITY_WEIGHTS = {"burden": 0.40, "mortality": 0.30, "reliability": 0.20, "yoy": 0.10}

# Documented-only score weights (burden, mortality, growth, disparity,
# reliability).
DOCUMENTED_WEIGHTS = {
    "burden": 0.35,
    "mortality": 0.25,
    "growth": 0.20,
    "disparity": 0.10,
    "reliability": 0.10,
}

# Demographic groups charted by the exploratory layer, in display order.
FOCUS_GROUPS = (
    "Overall",
    "Male",
    "Female",
    "Black, non-Hispanic",
    "White, non-Hispanic",
    "Hispanic",
)

# Year lower bound of the state x year heatmap.
HEATMAP_FIRST_YEAR = 2010

# Number of topics followed by the trend chart.
TOP_TOPICS = 6

# Limits of the ranked questions.
TOP_STATE_TOPICS = 50
TOP_DEMOGRAPHIC_GROUPS = 100

# Mortality model features (kept only when present).
MORTALITY_FEATURES = (
    "YearStart",
    "disease_duration",
    "value_normalized",
    "topic_Arthritis",
    "topic_Cancer",
    "topic_Cardiovascular Disease",
    "topic_Chronic Kidney Disease",
    "topic_Tobacco",
    "topic_Nutrition, Physical Activity, and Weight Status",
)

# Risk classifier features (kept only when present).
RISK_FEATURES = (
    "YearStart",
    "disease_duration",
    "is_mortality",
    "LocationAbbr_enc",
    "DataValueType_enc",
    "topic_Alcohol",
    "topic_Arthritis",
    "topic_Asthma",
    "topic_Cancer",
    "topic_Cardiovascular Disease",
    "topic_Chronic Kidney Disease",
    "topic_Chronic Obstructive Pulmonary Disease",
    "topic_Diabetes",
    "topic_Disability",
    "topic_Immunization",
    "topic_Mental Health",
    "topic_Nutrition, Physical Activity, and Weight Status",
    "topic_Older Adults",
    "topic_Oral Health",
    "topic_Overarching Conditions",
    "topic_Reproductive Health",
    "topic_Tobacco",
)

# Model hyper-parameters.
KMEANS_K = 3
KMEANS_STARTS = 20
SEED = 42
CV_FOLDS = 5
LOGISTIC_MAX_ITER = 1000
FOREST_TREES = 300
FOREST_DEPTH = 10
PROBABILITY_THRESHOLD = 0.5
TINY_CLASS_ROWS = 10

# Two-sided 5% critical value of the standard normal distribution.
Z_CRITICAL_05 = 1.959963984540054
SIGNIFICANCE_LEVEL = 0.05

# Tokens that a CSV reader treats as missing (in addition to empty text).
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)
