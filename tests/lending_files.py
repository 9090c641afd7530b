"""Small source files with every kind of row the pipeline must cope with."""

LOAN_HEADER = ("loan_id,customer_id,product_type,principal_amount,interest_rate,term_months,"
               "origination_date,origination_channel,status,borrower_info\n")


def borrower(**facts):
    """A quoted CSV field that holds a JSON object."""
    body = ", ".join(f'""{k}"": ' + (f'""{v}""' if isinstance(v, str) else str(v)) for k, v in facts.items())
    return '"{' + body + '}"'


def loan(number, customer, product, principal, rate, term, day, channel, status, **facts):
    key = f"LN-{number}" if number else ""
    return f"{key},CU-{customer},{product},{principal},{rate},{term},{day},{channel},{status},{borrower(**facts)}"


# Loans 3002 and 3007 come twice, the former changed. Four rows are rejected: no whole number of
# months, no such day, no loan id, no decimal rate.
LOANS = [
    loan(3001, 71, "auto", "18400.00", "6.9", 48, "2022-02-03", "partner", "active", credit_score=690, employment="contract"),
    loan(3002, 72, "Student", '"$7,250.50"', "3.2", 96, "2021/9/14", "online", "ACTIVE", credit_score=612, annual_income=18500),
    loan(3003, 73, "mortgage", "312000", "4.25", 240, "14 March 2018", "mobile", "closed", employment="civil servant"),
    loan(3004, 71, "PERSONAL", "3600.00", "0", 18, "05.11.2023", "branch", "active", years_employed=6),
    loan(3005, 74, "personal", "9100", "11.4", "thirty-six", "2022-07-01", "online", "active"),
    loan(3006, 75, "auto", "22000.00", "5.5", 60, "2022-02-30", "branch", "active"),
    loan(None, 76, "auto", "15000.00", "7.0", 36, "2021-03-04", "partner", "active"),
    loan(3002, 72, "Student", '"$7,250.50"', "3.2", 96, "2021/9/14", "online", "Closed", credit_score=612, annual_income=18500),
    loan(3007, 77, "student", "5400", "2.75", 120, "2020-10-05", "online", "default", credit_score=540),
    loan(3007, 77, "student", "5400", "2.75", 120, "2020-10-05", "online", "default", credit_score=540),
    loan(3008, 78, "mortgage", "98000.75", "5.1", 180, "2019-12-31", "branch", "Active", annual_income=51000),
    loan(3009, 79, "personal", "1200.00", "14.9x", 12, "2023-06-18", "mobile", "active"),
]


def payment(number, loan_number, amount, at, method="ach", meta=', "metadata": {"source": "app"}'):
    loan_id = f'"LN-{loan_number}"' if loan_number else "null"
    return (f'{{"payment_id": "PX-{number}", "loan_id": {loan_id}, "amount": {amount}, "timestamp": "{at}", '
            f'"payment_method": {{"type": "{method}", "details": {{"last_four": "77{number:02d}", "bank": null}}}}{meta}}}')


# Line 6 is cut off. PX-3 comes twice; PX-1 is paid in parts; PX-9 is below zero.
PAYMENTS = [
    payment(1, 3001, "440.10", "2022-03-05T08:15:00Z"),
    payment(2, 3001, "440.10", "2022-04-05T23:30:00-07:00", "CARD"),
    payment(3, 3004, "200.00", "2024-02-20T12:00:00+05:30"),
    payment(4, 3008, "50", "2020-02-01", "cash"),
    payment(5, 3003, "12000.00", "2018-05-01T00:00:00Z", "wire"),
    '{"payment_id": "PX-0", "amount":',
    payment(3, 3004, "200.00", "2024-02-20T12:00:00+05:30"),
    payment(6, 9999, "75.25", "2023-08-09T10:11:12Z"),
    payment(7, 3005, "310.00", "2022-08-02T00:00:00Z"),
    payment(8, None, "20.00", "2023-01-02T03:04:05Z"),
    payment(1, 3001, "441.00", "2022-03-05T08:15:00Z"),
    payment(9, 3007, "-5.00", "2021-01-05T00:00:00Z"),
    payment(10, 3002, "90.75", "2022-01-10T10:00:00", "check", meta=""),
]


def write(folder, loans=LOANS, payments=PAYMENTS):
    """Write both files into a pathlib folder; returns their paths as text."""
    folder.mkdir(parents=True, exist_ok=True)
    loan_path, payment_path = folder / "loans.csv", folder / "payments.jsonl"
    loan_path.write_text(LOAN_HEADER + "\n".join(loans) + "\n")
    payment_path.write_text("\n".join(payments) + "\n")
    return str(loan_path), str(payment_path)
