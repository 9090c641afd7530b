"""One declared schema per table, and the cast of a DataFrame to it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

POSITION = "_pos"
POSITION_TYPE = T.StructType([T.StructField("file", T.StringType()),
                              T.StructField("block", T.LongType()),
                              T.StructField("row", T.LongType())])
SIMPLE_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(),
    "double": T.DoubleType(), "boolean": T.BooleanType(), "date": T.DateType(),
    "timestamp": T.TimestampType(), "position": POSITION_TYPE,
}


def _column_type(name: str) -> T.DataType:
    if name.startswith("decimal("):
        precision, scale = name[len("decimal("):-1].split(",")
        return T.DecimalType(int(precision), int(scale))
    return SIMPLE_TYPES[name]


def _columns(text: str) -> T.StructType:
    """Schema from `name type [not null]` entries; usable before any session exists."""
    fields = []
    for entry in text.split(", "):
        name, dtype, *rest = entry.split(" ")
        fields.append(T.StructField(name, _column_type(dtype), nullable=rest != ["not", "null"]))
    return T.StructType(fields)


RAW_LOAN = _columns(
    "loan_id string, customer_id string, product_type string, principal_amount string, "
    "interest_rate string, term_months string, origination_date string, "
    "origination_channel string, status string, borrower_info string, "
    f"_source_file string, _last_updated_ts timestamp, {POSITION} position"
)
RAW_PAYMENT = _columns(
    "payment_id string, loan_id string, amount string, payment_timestamp string, "
    "payment_method_type string, payment_method_last_four string, payment_method_bank string, "
    "metadata_source string, metadata_user_agent string, "
    f"_source_file string, _last_updated_ts timestamp, {POSITION} position"
)
RAW_AUDIT = _columns(
    "batch_ts timestamp not null, source_file string not null, source_table string not null, "
    "total_rows_in_file bigint, total_rows_inserted bigint, distinct_keys bigint, "
    "duplicate_key_count bigint, true_duplicate_count bigint, diff_amount_same_id_count bigint, "
    "_last_updated_ts timestamp"
)
LND_LOAN = _columns(
    "loan_id string not null, customer_id string, product_type string, "
    "principal_amount decimal(18,2), interest_rate decimal(8,4), term_months int, "
    "origination_date date, origination_channel string, status string, borrower_info string, "
    "row_effective_from timestamp not null, row_effective_to date not null, "
    "is_current_flag boolean not null, _source_file string, _last_updated_ts timestamp, "
    "_row_hash string"
)
LND_PAYMENT = _columns(
    "lnd_payment_sk bigint, payment_id string not null, loan_id string, amount decimal(18,2), "
    "payment_timestamp timestamp, payment_method_type string, payment_method_last_four string, "
    "payment_method_bank string, metadata_source string, metadata_user_agent string, "
    "payment_allocation_status string, _source_file string, _last_updated_ts timestamp"
)
LND_ERR_LOAN = _columns(
    "loan_id string, customer_id string, product_type string, principal_amount string, "
    "interest_rate string, term_months string, origination_date string, "
    "origination_channel string, status string, borrower_info string, _source_file string, "
    "_last_updated_ts timestamp, _rejection_reason string, _rejected_at timestamp"
)
LND_ERR_PAYMENT = _columns(
    "payment_id string, loan_id string, amount string, payment_timestamp string, "
    "payment_method_type string, payment_method_last_four string, payment_method_bank string, "
    "metadata_source string, metadata_user_agent string, _source_file string, "
    "_last_updated_ts timestamp, _rejection_reason string, _rejected_at timestamp, "
    "_reject_kind string"
)
LND_DQ_AUDIT = _columns(
    "run_id string, table_name string, check_name string, check_result string, "
    "metric_value double, threshold double, breach_flag boolean, detail string, "
    "checked_at timestamp"
)
STG_LOAN_PAYMENT = _columns(
    "loan_id string, customer_id string, product_type string, principal_amount decimal(18,2), "
    "interest_rate decimal(8,4), term_months int, origination_date date, "
    "origination_channel string, loan_status string, borrower_info string, "
    "row_effective_from timestamp, payment_id string, payment_amount decimal(18,2), "
    "payment_timestamp timestamp, payment_method_type string, payment_method_last_four string, "
    "payment_method_bank string, metadata_source string, metadata_user_agent string, "
    "expected_emi decimal(18,2), days_since_payment int, final_due_date date, "
    "is_delinquent boolean, is_payment_anomalous boolean, loan_balance_type string, "
    "_last_updated_ts timestamp, lnd_payment_sk bigint"
)
DIM_CUSTOMER = _columns(
    "customer_id string not null, credit_score int, employment_type string, "
    "annual_income decimal(18,2), years_employed int, _source_loan_id string, "
    "_last_updated_ts timestamp"
)
DIM_DATE = _columns(
    "date_id int not null, full_date date not null, year int, quarter int, month int, "
    "month_name string, week_of_year int, day_of_month int, day_of_week int, day_name string, "
    "is_weekend boolean, is_month_end boolean"
)
FCT_LOAN = _columns(
    "loan_id string, customer_id string, product_type string, principal_amount decimal(18,2), "
    "interest_rate decimal(8,4), term_months int, origination_date date, "
    "origination_date_id int, origination_channel string, loan_status string, "
    "loan_balance_type string, expected_emi decimal(18,2), final_due_date date, "
    "is_delinquent boolean, last_payment_amount decimal(18,2), last_payment_timestamp timestamp, "
    "days_since_last_payment int, total_payment_count bigint, total_paid_amount decimal(28,2), "
    "credit_score int, employment_type string, annual_income decimal(18,2), "
    "_last_updated_ts timestamp"
)
FCT_PAYMENT = _columns(
    "lnd_payment_sk bigint, payment_id string, loan_id string, customer_id string, "
    "product_type string, payment_amount decimal(18,2), payment_timestamp timestamp, "
    "payment_date_id int, payment_method_type string, payment_method_bank string, "
    "metadata_source string, expected_emi decimal(18,2), is_payment_anomalous boolean, "
    "days_since_payment int, loan_status string, _last_updated_ts timestamp, "
    "loan_balance_type string"
)
MART_DELINQUENCY = _columns(
    "product_type string, run_date date, total_active_loans bigint, delinquent_loans bigint, "
    "delinquency_rate_pct decimal(6,2), avg_days_since_payment decimal(8,1), "
    "avg_principal_delinquent decimal(18,2), _last_updated_ts timestamp"
)
# deviation_pct is wider than a percentage needs: a tiny instalment makes it huge.
MART_PAYMENT_ANOMALY = _columns(
    "payment_id string, loan_id string, customer_id string, product_type string, "
    "payment_amount decimal(18,2), expected_emi decimal(18,2), deviation_pct decimal(24,2), "
    "payment_method_type string, payment_timestamp timestamp, loan_status string, "
    "anomaly_reason string, _last_updated_ts timestamp"
)
MART_OBSERVABILITY = _columns(
    "run_date date, source_name string, raw_rows_in_batch bigint, raw_distinct_keys bigint, "
    "raw_duplicate_key_count bigint, raw_true_duplicate_count bigint, "
    "raw_diff_amount_same_id bigint, lnd_rows_accepted bigint, lnd_rows_rejected bigint, "
    "acceptance_rate_pct decimal(6,2), dq_checks_run bigint, dq_checks_failed bigint, "
    "dq_breach_flag boolean, fct_rows bigint, latest_batch_ts timestamp, "
    "freshness_hours decimal(8,2), payments_allocated bigint, payments_unallocated bigint, "
    "payments_loan_rejected bigint, payments_unidentified bigint, pipeline_status string, "
    "_last_updated_ts timestamp"
)

# layer -> table -> schema
TABLES: dict[str, dict[str, T.StructType]] = {
    "raw": {"raw_loan": RAW_LOAN, "raw_payment": RAW_PAYMENT, "raw_audit": RAW_AUDIT},
    "lnd": {
        "lnd_loan": LND_LOAN, "lnd_payment": LND_PAYMENT, "lnd_err_loan": LND_ERR_LOAN,
        "lnd_err_payment": LND_ERR_PAYMENT, "lnd_dq_audit": LND_DQ_AUDIT,
    },
    "stg": {"stg_loan_payment": STG_LOAN_PAYMENT},
    "dim": {"dim_customer": DIM_CUSTOMER, "dim_date": DIM_DATE},
    "fct": {"fct_loan": FCT_LOAN, "fct_payment": FCT_PAYMENT},
    "mart": {
        "mart_delinquency": MART_DELINQUENCY, "mart_payment_anomaly": MART_PAYMENT_ANOMALY,
        "mart_data_observability": MART_OBSERVABILITY,
    },
}
UNIQUE_KEYS = {"dim_date": ("date_id",)}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns in order, cast; columns `df` lacks become NULL."""
    present = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def required_columns_filled(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Fail the write at the first row that leaves a NOT NULL column empty.

    The check runs inside the job that writes, so it costs no extra pass.
    """
    required = [f.name for f in schema.fields if not f.nullable]
    if not required:
        return df
    filled: Column = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])
    message = F.concat(F.lit("NULL in required column, one of: "), F.lit(", ".join(required)))
    first = required[0]
    checked = F.when(filled, F.col(first)).otherwise(F.raise_error(message))
    return df.withColumn(first, checked.cast(schema[first].dataType))
