"""Column lists, label maps and limits that decide the results."""

# Upstream spellings and the canonical name each one is renamed to.
RENAME_COLUMNS = {
    "loan_amount": "loan_amnt",
    "annual_income": "annual_inc",
}

TARGET = "default"
STATUS_COLUMN = "loan_status"
DATE_COLUMN = "issue_d"
ID_COLUMNS = ("loan_id",)

# Loan status to label; statuses not listed here are unresolved and left out.
STATUS_TO_DEFAULT = {
    "Fully Paid": 0,
    "Charged Off": 1,
    "Default": 1,
    "Late (31-120 days)": 1,
    "Late (16-30 days)": 1,
}

# Columns of a cleaned table, in order.
CANONICAL_COLUMNS = [
    "loan_amnt",
    "annual_inc",
    "int_rate",
    "term",
    "dti",
    "grade",
    "sub_grade",
    "emp_length",
    "home_ownership",
    "issue_d",
    "default",
]

# Columns a cleaned row must have a value in.
REQUIRED_COLUMNS = ["loan_amnt", "annual_inc", "int_rate", "term", "issue_d", "default"]

# Columns that only exist after the outcome is known and so must not be in cleaned data.
FORBIDDEN_COLUMNS = [
    "collection_recovery_fee",
    "last_credit_pull_d",
    "last_pymnt_amnt",
    "last_pymnt_d",
    "loan_status",
    "next_pymnt_d",
    "out_prncp",
    "out_prncp_inv",
    "recoveries",
    "total_pymnt",
    "total_pymnt_inv",
]

# Prefix of one-hot columns that would leak the label into the matrix.
LEAKAGE_PREFIX = "loan_status_"

# Ambiguous or post-origination columns dropped before modelling.
LEAKAGE_COLUMNS = [
    "collection_recovery_fee",
    "debt_settlement_flag",
    "debt_settlement_flag_date",
    "desc",
    "earliest_cr_line",
    "emp_title",
    "hardship_amount",
    "hardship_dpd",
    "hardship_end_date",
    "hardship_flag",
    "hardship_last_payment_amount",
    "hardship_length",
    "hardship_loan_status",
    "hardship_payoff_balance_amount",
    "hardship_reason",
    "hardship_start_date",
    "hardship_status",
    "hardship_type",
    "id",
    "last_credit_pull_d",
    "last_fico_range_high",
    "last_fico_range_low",
    "last_pymnt_amnt",
    "last_pymnt_d",
    "member_id",
    "mths_since_last_delinq",
    "mths_since_last_major_derog",
    "mths_since_last_record",
    "mths_since_rcnt_il",
    "mths_since_recent_bc",
    "mths_since_recent_bc_dlq",
    "mths_since_recent_inq",
    "mths_since_recent_revol_delinq",
    "next_pymnt_d",
    "out_prncp",
    "out_prncp_inv",
    "payment_plan_start_date",
    "recoveries",
    "settlement_amount",
    "settlement_date",
    "settlement_percentage",
    "settlement_status",
    "settlement_term",
    "total_pymnt",
    "total_pymnt_inv",
    "total_rec_int",
    "total_rec_late_fee",
    "total_rec_prncp",
    "url",
]

VALID_GRADES = ["A", "B", "C", "D", "E", "F", "G"]

# Cell texts read as missing in CSV input.
CSV_MISSING = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# Column suffix of the null indicator of a one-hot group.
NULL_CATEGORY = "<NA>"
MISSING_TOKEN = "__MISSING__"
RARE_TOKEN = "__OTHER__"
RARE_MIN_COUNT = 100
RARE_MIN_FRACTION = 0.005

# Encoding strategy by number of distinct values (null counted).
ONE_HOT_MAX = 10
TARGET_MEAN_MAX = 100

# Skewness above which a numeric column gets a log plan, and the shift past its minimum.
SKEW_THRESHOLD = 1.0
SHIFT_EPSILON = 1e-6

# Upper bounds (exclusive) of the Low and Medium risk bands.
BAND_LOW = 0.10
BAND_MEDIUM = 0.25

# Stability index: share floor and label bounds.
PSI_EPSILON = 1e-6
PSI_MODERATE = 0.10
PSI_SIGNIFICANT = 0.25

# Guardrail limits.
MAX_BASELINE_AUC = 0.95
MAX_AUC_GAP = 0.10
MAX_SINGLE_IMPORTANCE = 0.30
MAX_TIME_SHARE = 0.25

# Search grid of the boosted-tree tuning job.
TUNING_GRID = {
    "n_estimators": [200, 400],
    "max_depth": [4, 6],
    "learning_rate": [0.05, 0.1],
    "subsample": [0.8, 1.0],
    "colsample_bytree": [0.8, 1.0],
}

# Feature plan: what each input column becomes in the feature matrix.
FEATURE_SPEC = {
    "version": "v1",
    "target": {"name": "default", "allowed_values": [0, 1]},
    "features": {
        "datetime": {
            "issue_d": {
                "derive": ["year", "month", "quarter"],
                "derived_features": ["issue_d_year", "issue_d_month", "issue_d_quarter"],
            }
        },
        "engineered": {"loan_age_months": {"source": ["issue_d"]}},
        "categorical": {
            "emp_length": {"encoding_strategy": "target_mean"},
            "grade": {"encoding_strategy": "one_hot"},
            "home_ownership": {"encoding_strategy": "one_hot"},
            "sub_grade": {"encoding_strategy": "target_mean"},
            "term": {"encoding_strategy": "one_hot"},
        },
        "numerical": {
            "annual_inc": {"planned_transformation": "log", "shift_for_transformation": 0.0},
            "dti": {"planned_transformation": "none", "shift_for_transformation": 0.0},
            "int_rate": {"planned_transformation": "none", "shift_for_transformation": 0.0},
            "loan_amnt": {"planned_transformation": "none", "shift_for_transformation": 0.0},
        },
    },
    "exclusions": {"target": "default", "id_cols": ["id", "member_id"]},
}
