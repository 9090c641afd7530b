"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the number of local threads. Each query runs
once and writes its whole result to the no-op sink. With BENCH_WARM=1 all run a second time.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import REGISTRY  # noqa: E402
from ledgerlake.session import local_session  # noqa: E402

HEADLINE = [
    "lnd_loan_clean", "scd2_merge", "json_flatten", "dedup_first_wins", "lnd_payment",
    "raw_audit_payment", "dq_audit_payment", "stg_loan_payment", "fct_loan",
    "mart_delinquency", "mart_payment_anomaly", "nearest_ids",
]


def seconds(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session("ledgerlake-bench", cpus=cpus, partitions=int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/nation.parquet").count()
    cold = {name: seconds(spark, name, folder) for name in names}
    report = {
        "metric": "headline queries, total wall time of the first run of each",
        "value": round(sum(cold.values()), 3), "unit": "sec", "queries": cold,
        "sf": os.path.basename(folder.rstrip("/")),
    }
    if os.environ.get("BENCH_WARM") == "1":
        report["warm"] = {name: seconds(spark, name, folder) for name in names}
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
