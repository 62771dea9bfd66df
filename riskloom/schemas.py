"""Column lists and types shared by the operators (fixed values of the data model)."""

from __future__ import annotations

KEY = "loan_app_id"
LABEL = "default_flag"
SCORE = "pd_score"

# One row per trade.
TRADE_COLUMNS = [
    "loan_app_id",
    "name",
    "dob",
    "bureau",
    "score_v3",
    "trade_ref_num",
    "product_type",
    "date_opened",
    "current_balance",
    "sanctioned_amount",
    "dpd",
]

# One row per bank transaction.
TRANSACTION_COLUMNS = [
    "loan_app_id",
    "bank_name",
    "acct_num",
    "txn_date",
    "txn_amount",
    "txn_type",
    "txn_desc",
    "bal_after",
]

# Numeric features a model may use.
MODEL_FEATURES = [
    "score_v3",
    "num_trades",
    "max_dpd",
    "avg_dpd",
    "total_current_balance",
    "total_sanctioned_amount",
    "dpd_30_plus",
    "dpd_60_plus",
    "dpd_90_plus",
    "txn_count",
    "total_credits",
    "total_debits",
    "salary_credits_count",
    "emi_txn_count",
    "cash_withdrawal_count",
    "avg_balance",
    "min_balance",
    "max_balance",
]
