"""Defaults shared by the operators; every function also takes them as arguments."""

# Fixed values.
SEED = 42
INACTIVE_DAYS = 90
FEATURE_LAG_DAYS = 60
TRAILING_DAYS = 365
HORIZON_WEEKS = 26
HOLDOUT_WEEKS = 26
CHURN_TEST_SHARE = 0.25
EPS = 1e-9

# Columns the churn models may see, all taken from the lagged snapshot.
CHURN_FEATURES = [
    "lag_frequency_365d",
    "lag_monetary_365d",
    "lag_tenure_days",
    "lag_avg_interpurchase_days",
    "lag_clv_proxy",
]

# Columns watched for drift.
DRIFT_FEATURES = [
    "recency_days",
    "frequency_365d",
    "monetary_365d",
    "tenure_days",
    "avg_interpurchase_days",
    "clv_proxy",
]

# Columns used by K-Means and by the Cox model.
BEHAVIOUR_FEATURES = ["recency_days", "frequency_365d", "monetary_365d", "tenure_days"]
