"""Time the headline queries and print one JSON line.

The billing tables are derived from the driver's tables first and stored; `tables_sec` is that
time. `prepare` is the job's stored frames, which the queries of records, charges and trailers read.
Each query is then run once, all rows computed and dropped. `outbound_lines` is the whole job from the
tables, its own frames included.
"""

from __future__ import annotations

import json
import os
import time

from outledger.runtime import local_session
from outledger.testbed import adapter, catalog

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "rate_rollup", "countries_in_run", "invoices_in_run", "representative_line",
    "ar_total_per_invoice", "role_playing_dims", "outbound_journal", "missing_contracts",
    "account_exception", "outbound_lines", "revtax_default", "revtax_in", "revtax_cn",
    "revtax_co", "trailer", "rejects", "anniversaries", "dml_change_set",
]


def main() -> None:
    spark = local_session(CPUS, "bench", **{"spark.ui.showConsoleProgress": "false"})
    start = time.time()
    tables = adapter.billing_tables(spark, FOLDER)
    for name in adapter.SQL:
        tables[name]
    tables["je_source"]
    tables_sec = time.time() - start
    start = time.time()
    catalog._parts(tables)
    seconds = {"prepare": round(time.time() - start, 3)}
    for name in HEADLINE:
        start = time.time()
        frame = catalog.spark_query(name)(spark, FOLDER)
        frame.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "tables_sec": round(tables_sec, 3),
            }
        )
    )


if __name__ == "__main__":
    main()
