"""Fixed values.

These must equal the values of the analysis this library re-implements for
its results to match; they are stated here once, in natural order.
"""

# --- fixed values -----------------------------------------------------------
# float32 machine epsilon (PSI smoothing) and float64 machine epsilon (IV smoothing)
EPS_PSI = 1.1920928955078125e-07
EPS_IV = 2.220446049250313e-16

# numeric feature with at most this many distinct values is not binned
MAX_UNBINNED_DISTINCT = 10
# number of quantile bins
QUANTILE_BINS = 10
# missing numeric value in an unbinned feature / missing text value
MISSING_NUMERIC_BIN = 9999999
MISSING_TEXT_BIN = "NA"
# text of the missing bin of a binned numeric feature (sorted last)
MISSING_BIN_LABEL = "nan"

# fill values of the modelling table
NUMERICAL_FILL = 0
CATEGORICAL_FILL = "NAN"

# name of the code shared by the least frequent, missing and unseen categories
LEAST_PERC = "least_perc"

# labels with fewer rows than this are "non significant" in the IV review
SIGNIFICANT_LABEL_ROWS = 100
# IV review thresholds: very high bin IV, minimal useful feature IV
HIGH_BIN_IV = 24
USEFUL_IV = 0.02

# IV rule of thumb: lower edge inclusive
IV_BANDS = (
    (0.5, "too good to be true"),
    (0.3, "strong"),
    (0.1, "medium"),
    (0.02, "weak"),
)
IV_BAND_BELOW = "useless"

# default column roles
DEFAULT_PRIMARY_KEYS = ("cif_id", "user_id", "date", "next_7_day_labels", "cif",
                        "kais", "party_id", "customer_id", "CBIN_CUST_ID")
DEFAULT_DATE_KEYS = ("date", "month", "week", "as_of_dt")

# audit columns removed from transaction features
AUDIT_COLUMNS = ("job_run_dt", "dsf_data_origin_country", "edsf_data_unit", "batchid", "job_nm")

# windows in days: look-ahead labels [0, 8], with gap [3, 10]; history [-60, -1]
LOOKAHEAD_DAYS = (0, 8)
LOOKAHEAD_GAP_DAYS = (3, 10)
HISTORY_DAYS = (-60, -1)

# pivot column for "no history"
NO_HISTORY = "null"

# sampling and splitting
SAMPLE_ROWS = 20000
SAMPLE_SEED = 111
ROWS_PER_LABEL = 200
TEST_PERCENT = 20
SPLIT_SEED = 33

# remark texts
REMARK_MISSING = "missing_rate==1"
REMARK_ZERO = "zero_rate==1"
REMARK_CARDINALITY = "cardinality==1"
REMARK_SELECTED = "is model selected"
REMARK_NOT_SELECTED = "is not model selected"
REMARK_PKEY = "is primary key"
REMARK_DKEY = "is date key"
REMARK_LABEL = "is label"
DROPPED_FROM_MODEL = "NA:dropped_from_model_input"
NOT_APPLICABLE = "not_applicable"
