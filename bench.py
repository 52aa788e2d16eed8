"""Time every registered query and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the tables and the local cores.  Each query is
run once untimed at the smallest scale, so that class loading is not measured, and
then once in full; all result rows are produced, none are collected.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from carrack.registry import QUERIES  # noqa: E402
from carrack.session import session  # noqa: E402


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    warm = Path(folder).parent / "sf0.001"
    seconds = {}
    for name, query in QUERIES.items():
        if warm.is_dir():
            drain(query(spark, str(warm)))
        started = time.monotonic()
        drain(query(spark, folder))
        seconds[name] = round(time.monotonic() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total time of all registered queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
