"""Fixed values and the rules a run can override."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

# The closed sets that validity checks compare with.
PRODUCT_TYPES = ("personal", "auto", "mortgage", "student")
LOAN_STATUSES = ("active", "closed", "default")
LOAN_CHANNELS = ("branch", "online", "partner", "mobile")
PAYMENT_METHODS = ("ach", "card", "check", "wire", "cash")
ALLOCATION_STATUSES = ("allocated", "unallocated", "loan_rejected", "unidentified")

# Columns of the two source files and the columns that must be filled.
LOAN_FILE_COLUMNS = (
    "loan_id", "customer_id", "product_type", "principal_amount", "interest_rate",
    "term_months", "origination_date", "origination_channel", "status", "borrower_info",
)
PAYMENT_FILE_COLUMNS = (
    "payment_id", "loan_id", "amount", "payment_timestamp", "payment_method_type",
    "payment_method_last_four", "payment_method_bank", "metadata_source", "metadata_user_agent",
)
LOAN_CRITICAL_COLUMNS = (
    "loan_id", "customer_id", "product_type", "principal_amount",
    "interest_rate", "term_months", "origination_date", "status",
)
PAYMENT_CRITICAL_COLUMNS = ("payment_id", "loan_id", "amount", "payment_timestamp")
TRACKED_LOAN_COLUMNS = LOAN_FILE_COLUMNS[1:]


@dataclass(frozen=True)
class Rules:
    """Business thresholds; every operator that needs one takes this as an argument."""

    acceptance_threshold: float = 0.99
    max_null_rate: float = 0.10
    delinquency_days: int = 30
    anomaly_tolerance: float = 0.10
    open_date: date = date(9999, 12, 31)
    stale_after_hours: float = 24.0


DEFAULT_RULES = Rules()
