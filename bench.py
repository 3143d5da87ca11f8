"""Times the layer builders and the gold queries; prints one JSON line.

``BENCH_SF_DIR`` names the data folder and ``BENCH_CPUS`` the threads. Documents
are derived and stored first; that time is reported apart as ``setup``. Every
query then runs ``BENCH_RUNS`` times and its best time counts.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from abonados.plans import checks as K
from abonados.session import build_session
from contract.catalogue import QUERIES
from contract.store import tables

HEADLINE = ("b1_", "b2_", "b3_", "g")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    start = time.perf_counter()
    tables(spark, sf_dir, K.BRONZE, K.ANALYTICS)
    setup = time.perf_counter() - start
    seconds = {}
    for name, query in QUERIES.items():
        if not name.startswith(HEADLINE):
            continue
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(Path(sf_dir).name.removeprefix("sf")),
                "setup": round(setup, 3),
            }
        )
    )


if __name__ == "__main__":
    main()
