"""The registered queries stated in SQL over the same tables.

`CTE` holds named steps with the steps they need; `sql(body, *steps)` writes the WITH list in
dependency order. The derivation of lending rows is the one in `checks/views.py`.
"""

from __future__ import annotations

CTE: dict[str, tuple[tuple[str, ...], str]] = {}
ORACLE: dict[str, str] = {}


def step(name: str, needs: tuple[str, ...], text: str) -> None:
    CTE[name] = (needs, text)


def sql(body: str, *steps: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for other in CTE[name][0]:
            add(other)
        if name not in ordered:
            ordered.append(name)

    for s in steps:
        add(s)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n][1]})" for n in ordered) + "\n" + body


def choose(number: str, values: list[str]) -> str:
    listed = ", ".join("'" + v + "'" for v in values)
    return f"([{listed}])[({number})::INT + 1]"


def blank(c: str) -> str:
    return f"NULLIF(TRIM({c}, chr(32) || chr(9) || chr(10) || chr(13)), '')"


LOAN_COLUMNS = ["loan_id", "customer_id", "product_type", "principal_amount", "interest_rate",
                "term_months", "origination_date", "origination_channel", "status",
                "borrower_info"]
PAYMENT_COLUMNS = ["payment_id", "loan_id", "amount", "payment_timestamp", "payment_method_type",
                   "payment_method_last_four", "payment_method_bank", "metadata_source",
                   "metadata_user_agent"]
PAYMENT_ORDER = ("l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, "
                 "l_linestatus, _copy")
LINE_KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, _copy"
LOANS, PAYS = ", ".join(LOAN_COLUMNS), ", ".join(PAYMENT_COLUMNS)
AS_OF = "DATE '2001-11-05'"
BATCH = "TIMESTAMP '2001-11-05 06:00:00'"
OPEN = "DATE '9999-12-31'"

step("loan_file", (), f"""
SELECT CASE WHEN k % 211 = 5 THEN '   ' ELSE 'L' || lpad(k::VARCHAR, 12, '0') END AS loan_id,
  CASE WHEN cust % 97 = 13 THEN '' ELSE ' C' || lpad(cust::VARCHAR, 9, '0') || ' ' END
    AS customer_id,
  CASE WHEN k % 9 = 8 AND k % 5 = 0 THEN '' ELSE {choose("k % 9", ["personal", "MORTGAGE ",
    "Student", " auto", "PERSONAL", "Mortgage", "student", "Auto", "boat"])} END AS product_type,
  CASE WHEN _copy = 1 AND k % 41 = 2 THEN 'N/A' WHEN k % 97 = 3 THEN 'not_a_number'
    WHEN k % 89 = 4 THEN '0.00' WHEN k % 83 = 7 THEN '' WHEN k % 53 = 6 THEN '-$' || amount
    WHEN k % 3 = 0 THEN '$' || amount WHEN k % 3 = 1 THEN format('{{:,.2f}}', o_totalprice)
    ELSE ' ' || amount END AS principal_amount,
  CASE WHEN k % 71 = 9 THEN 'n/a' WHEN k % 67 = 8 THEN ''
    ELSE CAST(CAST((k % 20) * 0.75 AS DECIMAL(8,2)) AS VARCHAR) END AS interest_rate,
  CASE WHEN k % 79 = 10 THEN '12.0' WHEN k % 73 = 11 THEN ''
    ELSE {choose("k % 6", ["12", "24", "36", "60", "120", "360"])} END AS term_months,
  CASE WHEN k % 193 = 12 THEN 'someday' WHEN k % 199 = 14 THEN ''
    WHEN k % 197 = 15 THEN '2023-02-30' WHEN k % 191 = 16 THEN strftime(_day, '%B %-d, %Y')
    WHEN k % 181 = 17 THEN strftime(_day, '%d/%m/%Y') WHEN k % 4 = 0 THEN strftime(_day, '%Y-%m-%d')
    WHEN k % 4 = 1 THEN strftime(_day, '%d-%b-%Y') WHEN k % 4 = 2 THEN strftime(_day, '%m/%d/%Y')
    ELSE strftime(_day, '%Y%m%d') END AS origination_date,
  CASE prio WHEN '1-URGENT' THEN 'Online' WHEN '2-HIGH' THEN 'BRANCH '
    WHEN '3-MEDIUM' THEN 'partner' WHEN '5-LOW' THEN 'fax' ELSE chr(9) || 'Mobile' END
    AS origination_channel,
  CASE WHEN k % 307 = 20 THEN ' ' WHEN _copy = 1 THEN 'ACTIVE' WHEN o_orderstatus = 'O' THEN 'Active'
    WHEN o_orderstatus = 'P' THEN 'active ' WHEN k % 2 = 0 THEN 'CLOSED' ELSE ' Default' END AS status,
  CASE WHEN cust % 41 = 0 THEN '{{"credit_score": ' WHEN cust % 43 = 1 THEN ''
    WHEN cust % 61 = 5 THEN '[1, 2]' ELSE '{{"credit_score": ' || score || ', ' || job
    || '"annual_income": ' || income || ', "years_employed": ' || years || '}}' END AS borrower_info,
  k AS _k, _copy, _day
FROM (
  SELECT *, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS amount,
    CAST(CAST(((cust % 1000) * 137 + 12000) / 4 AS DECIMAL(18,2)) AS VARCHAR) AS income,
    CASE WHEN cust % 47 = 2 THEN '"712"' WHEN cust % 59 = 4 THEN '"high"'
      ELSE CAST(300 + cust % 551 AS VARCHAR) END AS score,
    CASE WHEN cust % 53 = 3 THEN '3.7' ELSE CAST(cust % 40 AS VARCHAR) END AS years,
    CASE WHEN cust % 67 = 6 THEN '' WHEN cust % 71 = 7 THEN '"employment": null, '
      ELSE '"employment": "' || {choose("cust % 4", ["Salaried", "self-employed", " RETIRED ",
        "unemployed"])} || '", ' END AS job
  FROM (
    SELECT o_orderkey AS k, o_custkey AS cust, o_orderpriority AS prio, o_orderstatus, o_totalprice,
      CAST(o_orderdate AS DATE) AS _day,
      unnest(CASE WHEN o_orderpriority = '1-URGENT' THEN [0, 1] ELSE [0] END) AS _copy
    FROM orders))""")

step("loans_raw", ("loan_file",), f"""
SELECT {", ".join(f"{blank(c)} AS {c}" for c in LOAN_COLUMNS)}, _k, _copy, _day FROM loan_file""")

# The last copy of each loan id; rows without an id all stay.
step("loans_last", ("loans_raw",), """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, CASE WHEN loan_id IS NULL THEN 1 ELSE
    row_number() OVER (PARTITION BY loan_id ORDER BY _k DESC, _copy DESC) END AS rn
  FROM loans_raw) WHERE rn = 1""")

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
MONEY = "NULLIF(NULLIF(regexp_replace(principal_amount, '[$,\\s]', '', 'g'), ''), '-')"


def number(text: str, dtype: str) -> str:
    return f"CASE WHEN regexp_matches({text}, '{NUMBER}') THEN TRY_CAST({text} AS {dtype}) END"


def day_of(text: str) -> str:
    return f"""CAST(CASE
    WHEN regexp_matches({text}, '^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}$') THEN try_strptime({text}, '%Y-%m-%d')
    WHEN regexp_matches({text}, '^\\d{{1,2}}-[A-Za-z]{{3}}-\\d{{4}}$') THEN try_strptime({text}, '%d-%b-%Y')
    WHEN regexp_matches({text}, '^\\d{{1,2}}/\\d{{1,2}}/\\d{{4}}$')
      THEN coalesce(try_strptime({text}, '%m/%d/%Y'), try_strptime({text}, '%d/%m/%Y'))
    WHEN regexp_matches({text}, '^\\d{{8}}$') THEN try_strptime({text}, '%Y%m%d')
    WHEN regexp_matches({text}, '^[A-Za-z]+ \\d{{1,2}}, \\d{{4}}$') THEN try_strptime({text}, '%B %d, %Y')
  END AS DATE)"""


def instant_of(text: str) -> str:
    """UTC timestamp: explicit offsets are subtracted, naive text is UTC already."""
    return f"""CASE
    WHEN regexp_matches({text}, '^\\d{{8}}T\\d{{6}}Z$') THEN try_strptime({text}, '%Y%m%dT%H%M%SZ')
    WHEN regexp_matches({text}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}T.*[+-]\\d{{2}}:\\d{{2}}$')
      THEN TRY_CAST(left({text}, -6) AS TIMESTAMP)
        - (CASE WHEN right({text}, 6)[1] = '-' THEN -1 ELSE 1 END)
        * (to_hours(CAST(right({text}, 5)[1:2] AS INT)) + to_minutes(CAST(right({text}, 2) AS INT)))
    WHEN regexp_matches({text}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN TRY_CAST(rtrim({text}, 'Z') AS TIMESTAMP)
  END"""


step("loans_judged", ("loans_last",), f"""
SELECT *, CASE
    WHEN loan_id IS NULL THEN 'loan_id=None: loan_id is missing'
    WHEN interest_rate IS NOT NULL AND rate IS NULL
      THEN 'loan_id=' || loan_id || ': interest_rate is no decimal: ''' || interest_rate || ''''
    WHEN term_months IS NOT NULL AND term IS NULL
      THEN 'loan_id=' || loan_id || ': term_months is no whole number: ''' || term_months || ''''
    WHEN money IS NOT NULL AND principal IS NULL
      THEN 'loan_id=' || loan_id || ': principal_amount is no sum of money: ''' || principal_amount || ''''
    WHEN origination_date IS NOT NULL AND originated IS NULL
      THEN 'loan_id=' || loan_id || ': origination_date is no date: ''' || origination_date || ''''
  END AS reason
FROM (
  SELECT *, {number("interest_rate", "DECIMAL(8,4)")} AS rate,
    CASE WHEN regexp_matches(term_months, '^[+-]?\\d+$') THEN TRY_CAST(term_months AS INT) END AS term,
    {MONEY} AS money, {number(MONEY, "DECIMAL(18,2)")} AS principal,
    {day_of("origination_date")} AS originated
  FROM loans_last)""")

HASHED = ["customer_id", "product_type", "principal_amount", "interest_rate", "term_months",
          "origination_date", "origination_channel", "status", "borrower_info"]
HASH = "md5(" + " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), 'None')" for c in HASHED) + ")"

step("loans_clean", ("loans_judged",), f"""
SELECT *, {HASH} AS _row_hash FROM (
  SELECT loan_id, customer_id, lower(product_type) AS product_type, principal AS principal_amount,
    rate AS interest_rate, term AS term_months, originated AS origination_date,
    lower(origination_channel) AS origination_channel, lower(status) AS status, borrower_info,
    _k, _day
  FROM loans_judged WHERE reason IS NULL)""")

step("loan_errors", ("loans_judged",), f"""
SELECT {LOANS}, 'loans.csv' AS _source_file, reason AS _rejection_reason
FROM loans_judged WHERE reason IS NOT NULL""")

step("lnd_loan", ("loans_clean",), f"""
SELECT {LOANS}, {BATCH} AS row_effective_from, {OPEN} AS row_effective_to, TRUE AS is_current_flag,
  'loans.csv' AS _source_file, _row_hash FROM loans_clean""")

step("earlier_history", ("loans_clean",), f"""
SELECT *, {HASH} AS _row_hash, TIMESTAMP '2001-01-01 06:00:00' AS row_effective_from,
  {OPEN} AS row_effective_to, TRUE AS is_current_flag, 'loans.csv' AS _source_file
FROM (
  SELECT * EXCLUDE (_row_hash) REPLACE (
    CASE WHEN _k % 11 = 0 THEN 'pending' ELSE status END AS status,
    CAST(CASE WHEN _k % 11 = 0 THEN principal_amount + 100 ELSE principal_amount END
      AS DECIMAL(18,2)) AS principal_amount)
  FROM loans_clean WHERE _day < DATE '2001-01-01')""")

step("scd2_actions", ("loans_clean", "earlier_history"), """
SELECT i.*, CASE WHEN h.loan_id IS NULL THEN 'new' WHEN h._row_hash = i._row_hash THEN 'unchanged'
  ELSE 'changed' END AS action
FROM loans_clean i LEFT JOIN earlier_history h ON h.loan_id = i.loan_id""")

step("payment_file", (), f"""
SELECT CASE WHEN l_suppkey % 89 = 1 THEN '' ELSE 'P' || lpad(l_orderkey::VARCHAR, 12, '0')
    || l_linenumber END AS payment_id,
  CASE WHEN l_orderkey % 103 = 8 THEN NULL WHEN l_orderkey % 101 = 7
    THEN 'L' || lpad((l_orderkey + 500000000000)::VARCHAR, 12, '0')
    ELSE 'L' || lpad(l_orderkey::VARCHAR, 12, '0') END AS loan_id,
  CASE WHEN l_partkey % 211 = 3 THEN '-' || amount WHEN l_partkey % 223 = 4 THEN 'abc'
    WHEN l_partkey % 227 = 5 THEN '' WHEN _copy = 1 AND l_suppkey % 2 = 0 THEN amount || '0'
    ELSE amount END AS amount,
  CASE WHEN l_suppkey % 97 = 6 THEN 'yesterday' WHEN l_suppkey % 83 = 9 THEN ''
    WHEN l_linenumber = 1 THEN shipped || CASE WHEN _copy = 1 AND l_suppkey % 3 = 0
      THEN 'T05:00:00-05:00' ELSE 'T10:00:00Z' END
    WHEN l_linenumber = 2 THEN shipped || 'T22:30:00-05:00'
    WHEN l_linenumber = 3 THEN shipped || 'T01:15:00+08:00'
    WHEN l_linenumber = 4 THEN shipped || 'T08:05:09'
    WHEN l_linenumber = 5 THEN shipped WHEN l_linenumber = 6 THEN shipped || 'T12:00:00.250Z'
    ELSE replace(shipped, '-', '') || 'T101010Z' END AS payment_timestamp,
  {choose("l_linenumber % 6", ["ACH", "card", "Check ", " WIRE", "cash", "crypto"])}
    AS payment_method_type,
  CASE WHEN l_linenumber % 6 = 1 THEN lpad((l_partkey % 10000)::VARCHAR, 4, '0') END
    AS payment_method_last_four,
  CASE WHEN l_linenumber % 6 <> 1 THEN 'Bank ' || (l_suppkey % 7) || ' ' END AS payment_method_bank,
  CASE WHEN l_linestatus = 'O' THEN 'web' ELSE 'mobile_app' END AS metadata_source,
  CASE WHEN l_linestatus = 'F' THEN 'App/' || l_linenumber END AS metadata_user_agent,
  {PAYMENT_ORDER}
FROM (
  SELECT *, strftime(l_shipdate, '%Y-%m-%d') AS shipped,
    CAST(CAST(CAST(floor(l_extendedprice * 5) AS BIGINT) / 100 AS DECIMAL(18,2)) AS VARCHAR) AS amount,
    unnest(CASE WHEN l_discount > 0.095 THEN [0, 1] ELSE [0] END) AS _copy
  FROM lineitem)""")

step("payments_raw", ("payment_file",), f"""
SELECT {", ".join(f"{blank(c)} AS {c}" for c in PAYMENT_COLUMNS)}, {PAYMENT_ORDER}
FROM payment_file""")

step("payments_first", ("payments_raw",), f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY payment_id, amount, payment_timestamp
    ORDER BY {PAYMENT_ORDER}) AS rn FROM payments_raw) WHERE rn = 1""")

step("payments_judged", ("payments_first",), f"""
SELECT *, CASE
    WHEN payment_id IS NULL THEN 'payment_id is missing'
    WHEN amount IS NOT NULL AND paid IS NULL THEN 'payment_id=' || payment_id
      || ': amount is no number: ''' || amount || ''''
    WHEN paid < 0 THEN 'payment_id=' || payment_id || ': amount is below zero: '''
      || amount || ''''
    WHEN payment_timestamp IS NOT NULL AND paid_at IS NULL THEN 'payment_id=' || payment_id
      || ': payment_timestamp is no instant: ''' || payment_timestamp || ''''
  END AS reason
FROM (SELECT *, {number("amount", "DECIMAL(18,2)")} AS paid,
        {instant_of("payment_timestamp")} AS paid_at FROM payments_first)""")

step("payments_typed", ("payments_judged",), f"""
SELECT payment_id, loan_id, paid AS amount, paid_at AS payment_timestamp,
  lower(payment_method_type) AS payment_method_type, payment_method_last_four,
  payment_method_bank, metadata_source, metadata_user_agent, {PAYMENT_ORDER}
FROM payments_judged WHERE reason IS NULL""")

step("payments_clean", ("payments_typed",), f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY payment_id, amount, payment_timestamp
    ORDER BY {PAYMENT_ORDER}) AS rn FROM payments_typed) WHERE rn = 1""")

step("payment_errors", ("payments_judged",), f"""
SELECT {PAYS}, 'payments.jsonl' AS _source_file, reason AS _rejection_reason
FROM payments_judged WHERE reason IS NOT NULL""")

step("allocated", ("payments_clean", "loans_clean", "loans_raw"), """
SELECT *, CASE WHEN loan_id IS NULL THEN 'unidentified'
    WHEN loan_id IN (SELECT loan_id FROM loans_clean) THEN 'allocated'
    WHEN loan_id NOT IN (SELECT loan_id FROM loans_raw WHERE loan_id IS NOT NULL) THEN 'unallocated'
    ELSE 'loan_rejected' END AS payment_allocation_status
FROM payments_clean""")

step("booked", ("payments_clean",), """
SELECT * FROM payments_clean WHERE l_shipdate < TIMESTAMP '2001-01-01 00:00:00'""")

step("fresh", ("allocated", "booked"), """
SELECT a.* FROM allocated a WHERE NOT EXISTS (
  SELECT 1 FROM booked b WHERE b.payment_id = a.payment_id
    AND b.amount IS NOT DISTINCT FROM a.amount
    AND b.payment_timestamp IS NOT DISTINCT FROM a.payment_timestamp)""")

FLAT = "round(CAST(principal_amount AS DOUBLE) / NULLIF(term_months, 0), 2)"
MONTHLY = "(CAST(interest_rate AS DOUBLE) / 12.0 / 100.0)"
GROWTH = f"pow(1.0 + {MONTHLY}, CAST(term_months AS DOUBLE))"
EMI = f"""CAST(CASE WHEN interest_rate IS NULL OR interest_rate = 0 THEN {FLAT}
    ELSE round(CAST(principal_amount AS DOUBLE) * {MONTHLY} * {GROWTH} / ({GROWTH} - 1.0), 2) END
    AS DECIMAL(18,2))"""
BALANCE = """CASE WHEN principal_amount < 0 THEN 'credit_balance'
    WHEN principal_amount = 0 THEN 'zero_balance' ELSE 'debit_balance' END"""
DUE = "CAST(origination_date + to_months(term_months) AS DATE)"


def late(status: str, last: str) -> str:
    return f"""CASE WHEN {status} <> 'active' THEN FALSE
    WHEN {last} IS NULL AND date_diff('day', origination_date, {AS_OF}) > 30 THEN TRUE
    WHEN {last} IS NOT NULL AND date_diff('day', CAST({last} AS DATE), {AS_OF}) > 30 THEN TRUE
    ELSE FALSE END"""


step("terms", ("lnd_loan",), f"""
SELECT *, {EMI} AS expected_emi, {DUE} AS final_due_date, {BALANCE} AS loan_balance_type
FROM lnd_loan""")

step("stg", ("terms", "allocated"), f"""
SELECT *, {late("loan_status", "payment_timestamp")} AS is_delinquent,
  CASE WHEN payment_amount IS NULL THEN FALSE ELSE
    abs(CAST(payment_amount AS DOUBLE) - CAST(expected_emi AS DOUBLE))
      / NULLIF(CAST(expected_emi AS DOUBLE), 0) > 0.10 END AS is_payment_anomalous,
  CAST(date_diff('day', CAST(payment_timestamp AS DATE), {AS_OF}) AS INT) AS days_since_payment
FROM (
  SELECT l.* EXCLUDE (status, row_effective_to, is_current_flag, _source_file, _row_hash),
    l.status AS loan_status, p.payment_id, p.amount AS payment_amount, p.payment_timestamp,
    p.payment_method_type, p.payment_method_last_four, p.payment_method_bank, p.metadata_source,
    p.metadata_user_agent
  FROM terms l LEFT JOIN allocated p ON p.loan_id = l.loan_id)""")

# Kind of a JSON value decides how it becomes a number.
step("borrowers", ("loans_raw",), """
SELECT _k, _copy, borrower_info, ok,
  CASE WHEN ok THEN CASE
    WHEN json_type(borrower_info, '$.credit_score') = 'VARCHAR'
      THEN CASE WHEN regexp_matches(json_extract_string(borrower_info, '$.credit_score'), '^[+-]?\\d+$')
        THEN TRY_CAST(json_extract_string(borrower_info, '$.credit_score') AS INT) END
    ELSE CAST(trunc(TRY_CAST(json_extract_string(borrower_info, '$.credit_score') AS DOUBLE)) AS INT)
  END END AS credit_score,
  CASE WHEN ok THEN lower(trim(NULLIF(json_extract_string(borrower_info, '$.employment'), ''))) END
    AS employment_type,
  CASE WHEN ok THEN CAST(json_extract_string(borrower_info, '$.annual_income') AS DECIMAL(18,2)) END
    AS annual_income,
  CASE WHEN ok THEN CAST(trunc(TRY_CAST(json_extract_string(borrower_info, '$.years_employed')
    AS DOUBLE)) AS INT) END AS years_employed,
  borrower_info IS NOT NULL AND NOT ok AS borrower_warning
FROM (SELECT *, coalesce(json_valid(borrower_info) AND left(borrower_info, 1) = '{', FALSE) AS ok
      FROM loans_raw)""")

step("dim_customer", ("loans_clean", "borrowers"), """
SELECT c.customer_id, b.credit_score, b.employment_type, b.annual_income, b.years_employed,
  c.loan_id AS _source_loan_id
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
        ORDER BY origination_date DESC NULLS LAST, loan_id) AS rn
      FROM loans_clean WHERE customer_id IS NOT NULL) c
JOIN borrowers b ON b._k = c._k AND b._copy = 0
WHERE c.rn = 1""")


def calendar(lower: str, upper: str) -> str:
    return f"""
SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_id, d AS full_date,
  CAST(year(d) AS INT) AS year, CAST(quarter(d) AS INT) AS quarter, CAST(month(d) AS INT) AS month,
  monthname(d) AS month_name, CAST(week(d) AS INT) AS week_of_year,
  CAST(day(d) AS INT) AS day_of_month, CAST(isodow(d) AS INT) AS day_of_week, dayname(d) AS day_name,
  isodow(d) >= 6 AS is_weekend, d = last_day(d) AS is_month_end
FROM (SELECT CAST(unnest(generate_series({lower}, {upper}, INTERVAL 1 DAY)) AS DATE) AS d)"""


step("dim_date", (), calendar("DATE '1961-11-05'", "DATE '2041-11-05'"))

step("paid", ("allocated",), """
SELECT loan_id, max(amount) AS last_payment_amount, max(payment_timestamp) AS last_payment_timestamp,
  count(payment_id) AS total_payment_count, CAST(sum(amount) AS DECIMAL(28,2)) AS total_paid_amount
FROM allocated WHERE loan_id IS NOT NULL GROUP BY loan_id""")

LOAN_FACT_KEYS = """loan_id, customer_id, product_type, principal_amount, interest_rate, term_months,
  origination_date, origination_channel, loan_status, loan_balance_type, expected_emi,
  final_due_date"""

step("fct_loan", ("terms", "paid", "dim_customer", "dim_date"), f"""
SELECT f.*, d.date_id AS origination_date_id, c.credit_score, c.employment_type, c.annual_income
FROM (
  SELECT l.* EXCLUDE (status, borrower_info, row_effective_from, row_effective_to,
      is_current_flag, _source_file, _row_hash), l.status AS loan_status,
    p.last_payment_amount, p.last_payment_timestamp,
    CAST(date_diff('day', CAST(p.last_payment_timestamp AS DATE), {AS_OF}) AS INT)
      AS days_since_last_payment,
    coalesce(p.total_payment_count, 0) AS total_payment_count, p.total_paid_amount,
    {late("l.status", "p.last_payment_timestamp")} AS is_delinquent
  FROM terms l LEFT JOIN paid p ON p.loan_id = l.loan_id) f
LEFT JOIN dim_customer c ON c.customer_id = f.customer_id
LEFT JOIN dim_date d ON d.full_date = f.origination_date""")

step("fct_payment", ("stg", "dim_date"), """
SELECT s.payment_id, s.loan_id, s.customer_id, s.product_type, s.payment_amount,
  s.payment_timestamp, d.date_id AS payment_date_id, s.payment_method_type, s.payment_method_bank,
  s.metadata_source, s.expected_emi, s.is_payment_anomalous, s.days_since_payment, s.loan_status,
  s.loan_balance_type
FROM stg s LEFT JOIN dim_date d ON d.full_date = CAST(s.payment_timestamp AS DATE)
WHERE s.payment_id IS NOT NULL""")

step("mart_delinquency", ("fct_loan",), f"""
SELECT coalesce(product_type, 'unknown') AS product_type, {AS_OF} AS run_date,
  count(*) AS total_active_loans, count(*) FILTER (is_delinquent) AS delinquent_loans,
  CAST(round(count(*) FILTER (is_delinquent) * 100.0 / count(*), 2) AS DECIMAL(6,2))
    AS delinquency_rate_pct,
  CAST(round(avg(days_since_last_payment) FILTER (is_delinquent), 1) AS DECIMAL(8,1))
    AS avg_days_since_payment,
  CAST(round(avg(CAST(principal_amount AS DOUBLE)) FILTER (is_delinquent), 2) AS DECIMAL(18,2))
    AS avg_principal_delinquent
FROM fct_loan WHERE loan_status = 'active' AND loan_balance_type = 'debit_balance'
GROUP BY product_type""")

step("loan_stats", ("loans_raw",), """
SELECT count(loan_id) AS distinct_keys, count(*) FILTER (n > 1) AS duplicate_key_count,
  CAST(sum(CASE WHEN n > 1 THEN n - 1 ELSE 0 END) AS BIGINT) AS true_duplicate_count,
  CAST(0 AS BIGINT) AS diff_amount_same_id_count, CAST(sum(n) AS BIGINT) AS total_rows
FROM (SELECT loan_id, count(*) AS n FROM loans_raw GROUP BY loan_id)""")

step("payment_stats", ("payments_raw",), """
SELECT count(payment_id) AS distinct_keys, count(*) FILTER (n > 1) AS duplicate_key_count,
  CAST(sum(surplus) AS BIGINT) AS true_duplicate_count,
  CAST(sum(several) AS BIGINT) AS diff_amount_same_id_count, CAST(sum(n) AS BIGINT) AS total_rows
FROM (SELECT payment_id, count(*) AS n,
        count(*) - count(DISTINCT amount || '|' || payment_timestamp) AS surplus,
        CASE WHEN count(DISTINCT amount) > 1 THEN 1 ELSE 0 END AS several
      FROM payments_raw GROUP BY payment_id)""")


def audit(stats: str, source_file: str, source_table: str) -> str:
    return f"""SELECT {BATCH} AS batch_ts, '{source_file}' AS source_file,
  '{source_table}' AS source_table, total_rows AS total_rows_in_file,
  total_rows AS total_rows_inserted, distinct_keys, duplicate_key_count, true_duplicate_count,
  diff_amount_same_id_count FROM {stats}"""


def check(run: str, table: str, name: str, result: str, metric: str, threshold: str, breach: str,
          detail: str, source: str, where: str = "TRUE") -> str:
    return f"""SELECT {run} AS run_id, '{table}' AS table_name, '{name}' AS check_name,
  {result} AS check_result, CAST({metric} AS DOUBLE) AS metric_value,
  CAST({threshold} AS DOUBLE) AS threshold, {breach} AS breach_flag, {detail} AS detail
  FROM {source} WHERE {where}"""


def gate(breach: str) -> str:
    return f"CASE WHEN {breach} THEN 'FAIL' ELSE 'PASS' END"


def volume(run: str, table: str, total: str, source: str) -> str:
    rate = f"coalesce(CAST({total} - errors AS DOUBLE) / NULLIF({total}, 0), 0.0)"
    return check(run, table, "volume_acceptance_rate", gate(f"{rate} < 0.99"), rate, "0.99",
                 f"{rate} < 0.99", f"'accepted ' || ({total} - errors) || ' of ' || {total} || ' rows'", source)


def completeness(run: str, table: str, column: str, total: str, source: str) -> str:
    rate = f"CAST(null_{column} AS DOUBLE) / {total}"
    return check(run, table, f"completeness_{column}", gate(f"{rate} > 0.10"), rate, "0.10",
                 f"{rate} > 0.10", f"'empty ' || null_{column} || ' of ' || {total} || ' in {column}'", source,
                 f"{total} > 0")


CRITICAL = ["loan_id", "customer_id", "product_type", "principal_amount", "interest_rate",
            "term_months", "origination_date", "status"]
DOMAINS = {"product_type": "'personal', 'auto', 'mortgage', 'student'",
           "status": "'active', 'closed', 'default'",
           "origination_channel": "'branch', 'online', 'partner', 'mobile'"}
PAYMENT_CRITICAL = ["payment_id", "loan_id", "amount", "payment_timestamp"]
STATUSES = ["allocated", "unallocated", "loan_rejected", "unidentified"]

step("loan_measures", ("lnd_loan", "loan_errors", "loans_raw"), f"""
SELECT count(*) AS rows,
  {", ".join(f"count(*) FILTER ({c} IS NULL) AS null_{c}" for c in CRITICAL)},
  {", ".join(f"count(*) FILTER ({c} IS NOT NULL AND {c} NOT IN ({d})) AS invalid_{c}"
             for c, d in DOMAINS.items())},
  (SELECT count(*) FROM loan_errors) AS errors, (SELECT count(*) FROM loans_raw) AS raw_rows,
  (SELECT count(*) FROM (SELECT loan_id FROM lnd_loan GROUP BY loan_id HAVING count(*) > 1)) AS dups
FROM lnd_loan""")


def loan_checks() -> str:
    run = "'dq_lnd_loan_2001-11-05'"
    rows = [volume(run, "lnd_loan", "raw_rows", "loan_measures"),
            check(run, "lnd_loan", "uniqueness_loan_id", gate("dups > 0"), "dups", "0.0", "dups > 0",
                  "'loan_ids held twice: ' || dups", "loan_measures")]
    rows += [completeness(run, "lnd_loan", c, "rows", "loan_measures") for c in CRITICAL]
    rows += [check(run, "lnd_loan", f"validity_{c}",
                   f"CASE WHEN invalid_{c} > 0 THEN 'WARN' ELSE 'PASS' END", f"invalid_{c}", "0.0",
                   "FALSE", f"'outside the closed set, ' || invalid_{c} || ' {c} values'", "loan_measures")
             for c in DOMAINS]
    return " UNION ALL ".join(rows)


step("loan_checks", ("loan_measures",), loan_checks())

step("payment_measures", ("allocated", "payment_errors", "payments_raw"), f"""
SELECT count(*) AS rows,
  {", ".join(f"count(*) FILTER ({c} IS NULL) AS null_{c}" for c in PAYMENT_CRITICAL)},
  count(*) FILTER (payment_method_type NOT IN ('ach', 'card', 'check', 'wire', 'cash')) AS invalid,
  {", ".join(f"count(*) FILTER (payment_allocation_status = '{s}') AS {s}" for s in STATUSES)},
  (SELECT count(*) FROM payment_errors) AS errors, (SELECT count(*) FROM payments_raw) AS raw_rows,
  (SELECT count(*) FROM (SELECT 1 FROM allocated GROUP BY payment_id, amount, payment_timestamp
     HAVING count(*) > 1)) AS dups,
  (SELECT count(*) FROM (SELECT 1 FROM allocated GROUP BY payment_id
     HAVING count(DISTINCT amount) > 1)) AS split
FROM allocated""")


def payment_checks() -> str:
    run, t, m = "'dq_lnd_payment_2001-11-05'", "lnd_payment", "payment_measures"
    summary = " || ', ' || ".join(f"'{s}=' || {s}" for s in STATUSES)
    rows = [
        volume(run, t, "raw_rows", m),
        check(run, t, "uniqueness_payment_id_amount_timestamp", gate("dups > 0"), "dups", "0.0",
              "dups > 0", "'booked twice (id, amount, instant): ' || dups", m),
        check(run, t, "info_split_settlement_payment_ids", "'INFO'", "split", "0.0", "FALSE",
              "'ids paid in parts: ' || split", m),
        *[completeness(run, t, c, "rows", m) for c in PAYMENT_CRITICAL],
        check(run, t, "validity_payment_method_type",
              "CASE WHEN invalid > 0 THEN 'WARN' ELSE 'PASS' END", "invalid", "0.0", "FALSE",
              "'outside the closed set, ' || invalid || ' payment methods'", m),
        check(run, t, "allocation_status_summary", "'INFO'", "allocated", "rows", "FALSE", summary, m),
    ]
    return " UNION ALL ".join(rows)


step("payment_checks", ("payment_measures",), payment_checks())
step("all_checks", ("loan_checks", "payment_checks"),
     "SELECT * FROM loan_checks UNION ALL SELECT * FROM payment_checks")

step("strays", ("payments_clean", "loans_raw"), """
SELECT p.* FROM payments_clean p WHERE p.loan_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM loans_raw r WHERE r.loan_id = p.loan_id)""")

# --- the queries ---------------------------------------------------------------------------

ORACLE["clean_money"] = sql(f"""
SELECT _k, _copy, {number(MONEY, "DECIMAL(18,2)")} AS principal,
  {MONEY} IS NOT NULL AND ({number(MONEY, "DECIMAL(18,2)")}) IS NULL AS is_bad
FROM loans_raw""", "loans_raw")
ORACLE["clean_strings"] = sql(f"SELECT _k, _copy, {LOANS} FROM loans_raw", "loans_raw")
ORACLE["parse_dates"] = sql(f"""
SELECT _k, _copy, {day_of("origination_date")} AS origination_date,
  origination_date IS NOT NULL AND ({day_of("origination_date")}) IS NULL AS is_bad
FROM loans_raw""", "loans_raw")
ORACLE["parse_timestamps"] = sql(f"""
SELECT {LINE_KEYS}, {instant_of("payment_timestamp")} AS payment_timestamp,
  payment_timestamp IS NOT NULL AND ({instant_of("payment_timestamp")}) IS NULL AS is_bad
FROM payments_raw""", "payments_raw")
ORACLE["normalise_categories"] = sql("""
SELECT _k, _copy, lower(product_type) AS product_type,
  lower(origination_channel) AS origination_channel, lower(status) AS status
FROM loans_raw""", "loans_raw")
ORACLE["lnd_loan_clean"] = sql(f"SELECT {LOANS}, _k FROM loans_clean", "loans_clean")
ORACLE["loan_rejects"] = sql("SELECT * FROM loan_errors", "loan_errors")
ORACLE["lnd_payment_clean"] = sql(f"SELECT {PAYS}, {LINE_KEYS} FROM payments_typed",
                                  "payments_typed")
ORACLE["payment_rejects"] = sql("SELECT * FROM payment_errors", "payment_errors")


def json_text(c: str) -> str:
    return f"coalesce('\"' || {c} || '\"', 'null')"


step("payment_lines", ("payment_file",), f"""
SELECT {PAYMENT_ORDER}, trim(CASE WHEN l_suppkey % 79 = 2 THEN 'not valid json line'
    WHEN l_suppkey % 73 = 3 THEN '   ' WHEN l_suppkey % 67 = 11 THEN '[1, 2]'
    ELSE '{{"payment_id": ' || {json_text("payment_id")} || ', "loan_id": ' || {json_text("loan_id")}
      || ', "amount": ' || CASE WHEN regexp_matches(amount, '^-?\\d+\\.\\d+$') THEN amount
         ELSE {json_text("amount")} END
      || ', "timestamp": ' || {json_text("payment_timestamp")} || ', "payment_method": '
      || CASE WHEN l_suppkey % 71 = 4 THEN '"cash"' WHEN l_suppkey % 61 = 5 THEN '""'
         WHEN l_suppkey % 59 = 7 THEN 'null'
         ELSE '{{"type": ' || {json_text("payment_method_type")} || ', "details": {{"last_four": '
           || {json_text("payment_method_last_four")} || ', "bank": '
           || {json_text("payment_method_bank")} || '}}}}' END
      || CASE WHEN l_suppkey % 53 = 8 THEN '' ELSE ', "metadata": {{"source": '
           || {json_text("metadata_source")} || ', "user_agent": '
           || {json_text("metadata_user_agent")} || '}}' END || '}}' END) AS value
FROM payment_file""")

step("parsed_lines", ("payment_lines",), """
SELECT *, CASE WHEN NOT json_valid(value) THEN 'malformed JSON'
    WHEN json_type(value) <> 'OBJECT' THEN 'wrong parent'
    WHEN json_type(value, '$.payment_method') = 'VARCHAR'
      AND json_extract_string(value, '$.payment_method') <> '' THEN 'wrong parent'
  END AS problem
FROM payment_lines WHERE length(value) > 0""")

PATHS = ["$.payment_id", "$.loan_id", "$.amount", "$.timestamp", "$.payment_method.type",
         "$.payment_method.details.last_four", "$.payment_method.details.bank",
         "$.metadata.source", "$.metadata.user_agent"]
ORACLE["json_flatten"] = sql(f"""
SELECT {", ".join(blank(f"json_extract_string(value, '{p}')") + f" AS {c}"
                  for c, p in zip(PAYMENT_COLUMNS, PATHS))}, {LINE_KEYS}
FROM parsed_lines WHERE problem IS NULL""", "parsed_lines")
ORACLE["json_reject_route"] = sql(f"""
SELECT {LINE_KEYS}, problem, value FROM parsed_lines WHERE problem IS NOT NULL""", "parsed_lines")
ORACLE["json_borrower"] = sql("""
SELECT _k, _copy, credit_score, employment_type, annual_income, years_employed, borrower_warning
FROM borrowers""", "borrowers")
ORACLE["row_hash"] = sql("SELECT loan_id, _k, _row_hash FROM loans_clean", "loans_clean")
ORACLE["latest_batch_scan"] = """
SELECT *, CAST(ts AS DATE) AS batch_day FROM events
WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)"""
ORACLE["dedup_last_wins"] = sql(
    "SELECT loan_id, status, principal_amount, _k, _copy FROM loans_last", "loans_last")
ORACLE["dedup_first_wins"] = sql(f"""
SELECT payment_id, loan_id, amount, payment_timestamp, {LINE_KEYS} FROM payments_first""",
                                 "payments_first")
ORACLE["dedup_cleaned_key"] = sql(f"""
SELECT payment_id, loan_id, amount, payment_timestamp, {LINE_KEYS} FROM payments_clean""",
                                  "payments_clean")
ORACLE["split_settlement_rows"] = sql(f"""
SELECT payment_id, amount, payment_timestamp, {LINE_KEYS},
  payment_id IS NOT NULL AND row_number() OVER (PARTITION BY payment_id ORDER BY {PAYMENT_ORDER}) > 1
    AS is_split_settlement
FROM payments_first""", "payments_first")
ORACLE["surrogate_keys"] = sql(f"""
SELECT (SELECT max(l_orderkey) FROM lineitem) + row_number() OVER (ORDER BY {PAYMENT_ORDER})
    AS lnd_payment_sk, payment_id, amount, payment_timestamp, {LINE_KEYS}
FROM payments_clean""", "payments_clean")
ORACLE["scd2_changes"] = sql("SELECT loan_id, _row_hash, action FROM scd2_actions", "scd2_actions")
ORACLE["scd2_merge"] = sql(f"""
SELECT {LOANS}, row_effective_from,
  CASE WHEN changed THEN {AS_OF} ELSE row_effective_to END AS row_effective_to,
  NOT changed AS is_current_flag, _source_file, _row_hash
FROM (SELECT h.*, h.loan_id IN (SELECT loan_id FROM scd2_actions WHERE action = 'changed') AS changed
      FROM earlier_history h)
UNION ALL
SELECT {LOANS}, {BATCH}, {OPEN}, TRUE, 'loans.csv', _row_hash
FROM scd2_actions WHERE action <> 'unchanged'""", "scd2_actions", "earlier_history")
ORACLE["ledger_anti_join"] = sql(f"""
SELECT payment_id, loan_id, amount, payment_timestamp, {LINE_KEYS} FROM fresh""", "fresh")
ORACLE["payment_allocation"] = sql(f"""
SELECT payment_id, loan_id, amount, payment_allocation_status, {LINE_KEYS} FROM allocated""",
                                   "allocated")
ORACLE["lnd_payment"] = sql(f"""
SELECT (SELECT coalesce(max(l_orderkey), 0) FROM booked)
    + row_number() OVER (ORDER BY {PAYMENT_ORDER}) AS lnd_payment_sk,
  {PAYS}, payment_allocation_status, 'payments.jsonl' AS _source_file FROM fresh""", "fresh", "booked")
ORACLE["batch_counters"] = sql("""
SELECT 'loan' AS source, 'rows_in' AS counter, (SELECT count(*) FROM loans_raw) AS n
UNION ALL SELECT 'loan', 'rows_deduplicated', (SELECT count(*) FROM loans_last)
UNION ALL SELECT 'loan', 'rows_rejected', (SELECT count(*) FROM loan_errors)
UNION ALL SELECT 'loan', 'rows_' || a.action,
  (SELECT count(*) FROM scd2_actions s WHERE s.action = a.action)
  FROM (VALUES ('new'), ('changed'), ('unchanged')) a(action)
UNION ALL SELECT 'payment', 'rows_in', (SELECT count(*) FROM payments_raw)
UNION ALL SELECT 'payment', 'rows_deduplicated', (SELECT count(*) FROM payments_first)
UNION ALL SELECT 'payment', 'rows_rejected', (SELECT count(*) FROM payment_errors)
UNION ALL SELECT 'payment', 'rows_clean', (SELECT count(*) FROM payments_clean)
UNION ALL SELECT 'payment', 'rows_inserted', (SELECT count(*) FROM fresh)
UNION ALL SELECT 'payment', 'rows_split_settlement',
  (SELECT count(payment_id) - count(DISTINCT payment_id) FROM payments_first)""",
                               "loan_errors", "scd2_actions", "payment_errors", "fresh")
ORACLE["emi"] = sql(f"""
SELECT loan_id, principal_amount, interest_rate, term_months, {EMI} AS expected_emi
FROM loans_clean""", "loans_clean")
ORACLE["emi_strict"] = sql(f"""
SELECT loan_id, CASE WHEN principal_amount >= 0 AND interest_rate >= 0 AND term_months > 0
    THEN {EMI} END AS expected_emi,
  CASE WHEN principal_amount IS NULL OR interest_rate IS NULL OR term_months IS NULL THEN NULL
    WHEN principal_amount < 0 THEN 'principal is below zero: ' || principal_amount
    WHEN interest_rate < 0 THEN 'rate is below zero: ' || interest_rate
    WHEN term_months <= 0 THEN 'term is not positive: ' || term_months END AS emi_error
FROM loans_clean""", "loans_clean")
OFF = """coalesce(abs(CAST(payment_amount AS DOUBLE) - CAST(expected_emi AS DOUBLE))
    / NULLIF(CAST(expected_emi AS DOUBLE), 0) > {}, FALSE)"""
ORACLE["payment_anomaly_flag"] = sql(f"""
SELECT loan_id, payment_id, payment_amount, payment_timestamp, expected_emi,
  {OFF.format(0.05)} AS anomalous_5, {OFF.format("0.10")} AS anomalous_10,
  {OFF.format(0.25)} AS anomalous_25
FROM stg""", "stg")
ORACLE["delinquency_flag"] = sql("""
SELECT loan_id, payment_id, loan_status, origination_date, payment_timestamp, payment_amount,
  is_delinquent FROM stg""", "stg")
ORACLE["delinquency_due_date"] = sql(f"""
SELECT loan_id, due_date, last_paid, {", ".join(f'''CASE WHEN due_date > {AS_OF} THEN FALSE
  ELSE date_diff('day', due_date, {AS_OF}) > {g} AND (last_paid IS NULL OR last_paid < due_date) END
  AS overdue_{g}''' for g in (0, 30, 60))}
FROM (SELECT l.loan_id, l.final_due_date AS due_date,
        CAST(p.last_payment_timestamp AS DATE) AS last_paid
      FROM terms l LEFT JOIN paid p ON p.loan_id = l.loan_id)""", "terms", "paid")
ORACLE["balance_type"] = sql(f"""
SELECT loan_id, principal_amount, {BALANCE} AS loan_balance_type FROM loans_clean""", "loans_clean")
ORACLE["raw_audit_loan"] = sql(audit("loan_stats", "loans.csv", "raw_loan"), "loan_stats")
ORACLE["raw_audit_payment"] = sql(audit("payment_stats", "payments.jsonl", "raw_payment"),
                                  "payment_stats")
ORACLE["latest_audit"] = sql(
    audit("loan_stats", "loans.csv", "raw_loan") + " UNION ALL "
    + audit("payment_stats", "payments.jsonl", "raw_payment"), "loan_stats", "payment_stats")
ORACLE["dq_audit_loan"] = sql("SELECT * FROM loan_checks", "loan_checks")
ORACLE["dq_audit_payment"] = sql("SELECT * FROM payment_checks", "payment_checks")
ORACLE["dq_volume"] = sql(
    "SELECT * EXCLUDE (run_id) FROM all_checks WHERE check_name LIKE 'volume%' UNION ALL "
    "SELECT * EXCLUDE (run_id) FROM ("
    + volume("''", "lnd_loan by landed rows", "rows", "loan_measures") + ")",
    "all_checks", "loan_measures")
for _name, _prefix in (("dq_completeness", "completeness"), ("dq_validity", "validity"),
                       ("allocation_summary", "allocation")):
    ORACLE[_name] = sql(
        f"SELECT * EXCLUDE (run_id) FROM all_checks WHERE check_name LIKE '{_prefix}%'",
        "all_checks")
ORACLE["dq_loan_uniqueness"] = sql("""
SELECT loan_id, count(*) AS row_count FROM loans_raw GROUP BY loan_id HAVING count(*) > 1""",
                                   "loans_raw")
ORACLE["dq_payment_uniqueness"] = sql("""
SELECT payment_id, amount, payment_timestamp, count(*) AS row_count FROM payments_typed
GROUP BY ALL HAVING count(*) > 1""", "payments_typed")
ORACLE["split_settlements"] = sql("""
SELECT payment_id, min(amount) AS min_amount, max(amount) AS max_amount, count(*) AS row_count
FROM payments_clean GROUP BY payment_id HAVING count(DISTINCT amount) > 1""", "payments_clean")
ORACLE["orphan_payments"] = sql(f"""
SELECT payment_id, loan_id, amount, payment_timestamp, {LINE_KEYS} FROM payments_clean p
WHERE loan_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM loans_clean l WHERE l.loan_id = p.loan_id)""",
                                "payments_clean", "loans_clean")
AGE = "date_diff('microsecond', max(ts), TIMESTAMP '2024-02-01 00:00:00') / 3.6e9"
ORACLE["freshness"] = f"""
SELECT event_type AS source_name, max(ts) AS latest_batch_ts,
  CAST(round({AGE}, 2) AS DECIMAL(18,2)) AS freshness_hours, round({AGE}, 2) > 24 AS is_stale
FROM events GROUP BY event_type
UNION ALL SELECT 'events', max(ts), CAST(round({AGE}, 2) AS DECIMAL(18,2)), round({AGE}, 2) > 24
FROM events"""
ORACLE["stg_loan_payment"] = sql("SELECT * FROM stg", "stg")
ORACLE["dim_customer"] = sql("SELECT * FROM dim_customer", "dim_customer")
step("spine", ("loans_clean",), calendar("(SELECT min(origination_date) FROM loans_clean)",
                                         "(SELECT max(origination_date) FROM loans_clean)"))
ORACLE["dim_date"] = sql("""
SELECT d.*, (SELECT count(*) FROM loans_clean l WHERE l.origination_date = d.full_date)
  AS loans_originated FROM spine d""", "spine", "loans_clean")
ORACLE["fct_loan"] = sql("SELECT * FROM fct_loan", "fct_loan")
ORACLE["fct_loan_reference"] = sql(f"""
SELECT f.*, d.date_id AS origination_date_id, c.credit_score, c.employment_type, c.annual_income
FROM (SELECT {LOAN_FACT_KEYS}, is_delinquent, max(payment_amount) AS last_payment_amount,
        max(payment_timestamp) AS last_payment_timestamp,
        min(days_since_payment) AS days_since_last_payment,
        count(payment_id) AS total_payment_count,
        CAST(sum(payment_amount) AS DECIMAL(28,2)) AS total_paid_amount
      FROM stg GROUP BY {LOAN_FACT_KEYS}, is_delinquent) f
LEFT JOIN dim_customer c ON c.customer_id = f.customer_id
LEFT JOIN dim_date d ON d.full_date = f.origination_date""", "stg", "dim_customer", "dim_date")
ORACLE["fct_payment"] = sql("SELECT * FROM fct_payment", "fct_payment")
ORACLE["mart_delinquency"] = sql("SELECT * FROM mart_delinquency", "mart_delinquency")
ORACLE["mart_payment_anomaly"] = sql("""
SELECT payment_id, loan_id, customer_id, product_type, payment_amount, expected_emi,
  CAST(round(abs(a - e) / e * 100.0, 2) AS DECIMAL(24,2)) AS deviation_pct, payment_method_type,
  payment_timestamp, loan_status,
  CASE WHEN a < e * (1.0 - 0.10) THEN 'UNDERPAYMENT' WHEN a > e * (1.0 + 0.10) THEN 'OVERPAYMENT'
    ELSE 'ANOMALOUS' END AS anomaly_reason
FROM (SELECT *, CAST(payment_amount AS DOUBLE) AS a, CAST(expected_emi AS DOUBLE) AS e
      FROM fct_payment)
WHERE is_payment_anomalous AND loan_status IS NOT NULL AND loan_balance_type <> 'credit_balance'""",
                                     "fct_payment")


def health(name: str, stats: str, raw: str, errors: str, facts: str, checks: str, alloc: bool) -> str:
    failed = f"(SELECT count(*) FROM {checks} WHERE check_result = 'FAIL')"
    raw_n, err_n = f"(SELECT count(*) FROM {raw})", f"(SELECT count(*) FROM {errors})"
    counts = ", ".join(
        (f"(SELECT {s} FROM payment_measures)" if alloc else "CAST(NULL AS BIGINT)")
        + f" AS payments_{s}" for s in STATUSES)
    return f"""SELECT {AS_OF} AS run_date, '{name}' AS source_name, {raw_n} AS raw_rows_in_batch,
  distinct_keys AS raw_distinct_keys, duplicate_key_count AS raw_duplicate_key_count,
  true_duplicate_count AS raw_true_duplicate_count,
  diff_amount_same_id_count AS raw_diff_amount_same_id,
  {raw_n} - {err_n} AS lnd_rows_accepted, {err_n} AS lnd_rows_rejected,
  CAST(round(({raw_n} - {err_n}) * 100.0 / {raw_n}, 2) AS DECIMAL(6,2)) AS acceptance_rate_pct,
  (SELECT count(*) FROM {checks}) AS dq_checks_run, {failed} AS dq_checks_failed,
  {failed} > 0 AS dq_breach_flag, (SELECT count(*) FROM {facts}) AS fct_rows,
  {BATCH} AS latest_batch_ts, CAST(12.5 AS DECIMAL(8,2)) AS freshness_hours, {counts},
  CASE WHEN {failed} > 0 THEN 'FAIL' ELSE 'PASS' END AS pipeline_status FROM {stats}"""


ORACLE["mart_observability"] = sql(
    health("loan", "loan_stats", "loans_raw", "loan_errors", "fct_loan", "loan_checks", False)
    + " UNION ALL "
    + health("payment", "payment_stats", "payments_raw", "payment_errors", "fct_payment",
             "payment_checks", True),
    "loan_stats", "payment_stats", "fct_loan", "fct_payment", "loan_checks", "payment_checks")
ORACLE["top_product"] = sql("""
SELECT product_type, delinquency_rate_pct FROM mart_delinquency
ORDER BY delinquency_rate_pct DESC, product_type LIMIT 1""", "mart_delinquency")
ORACLE["run_counters"] = sql("""
SELECT count(*) AS total_rows, count(*) FILTER (is_delinquent) AS delinquent_rows,
  count(*) FILTER (is_payment_anomalous) AS anomalous_rows, count(payment_id) AS payment_rows
FROM stg""", "stg")


def id_set(label: str, source: str) -> str:
    n = "CAST(replace(loan_id, 'L', '') AS BIGINT)"
    return f"""SELECT '{label}' AS id_set, min({n}) AS min_num, max({n}) AS max_num,
  count(DISTINCT loan_id) AS distinct_ids, max({n}) - count(DISTINCT loan_id) AS gap FROM {source}"""


ORACLE["id_range"] = sql(id_set("orphan", "strays") + " UNION ALL "
                         + id_set("raw_loan", "loans_raw"), "strays", "loans_raw")
ORACLE["orphan_sample"] = sql("""
SELECT loan_id, amount, payment_method_type, CAST(payment_timestamp AS DATE) AS pay_date, payment_id
FROM strays ORDER BY loan_id, payment_id, amount NULLS FIRST, pay_date NULLS FIRST,
  payment_method_type LIMIT 10""", "strays")
ORACLE["nearest_ids"] = sql("""
SELECT o.loan_id AS orphan_id, o.n AS orphan_num,
  max(r.n) FILTER (r.n < o.n) AS closest_below, min(r.n) FILTER (r.n > o.n) AS closest_above
FROM (SELECT DISTINCT loan_id, CAST(replace(loan_id, 'L', '') AS BIGINT) AS n FROM strays) o
CROSS JOIN (SELECT DISTINCT CAST(replace(loan_id, 'L', '') AS BIGINT) AS n FROM loans_raw
            WHERE loan_id IS NOT NULL) r
GROUP BY o.loan_id, o.n""", "strays", "loans_raw")
