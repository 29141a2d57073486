"""Timings on a table with a hot tenant: ``python bench_skew.py [COPIES]``; prints one JSON line.

The events of ``BENCH_SF_DIR`` are copied COPIES times (default 20) with new ids, once as
they are and once with every third event moved to one tenant, a third of those to one of
its users. The same queries run on both.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

from pulsemart.config import HealthConfig
from pulsemart.operators import usage
from pulsemart.operators.cleaning import clean_events
from pulsemart.session import cut_lineage, local_session, temporary_tables
from pulsemart.sources.driver_tables import RawTables

CFG = HealthConfig()
QUERIES = {
    "event_windows": lambda events: usage.event_windows(events, CFG),
    "pp_trend": lambda events: usage.pp_trend(events, CFG),
    "weekly_activity": lambda events: usage.weekly_activity(events, CFG),
}


def copied(events, copies: int, hot: bool):
    rows = events.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    rows = rows.withColumn("event_id", F.concat_ws("-", "event_id", "copy"))
    if hot:
        drawn = F.xxhash64("event_id")
        moved = F.pmod(drawn, F.lit(3)) == 0
        rows = rows.withColumn("tenant_id", F.when(moved, F.lit("ten_1")).otherwise(F.col("tenant_id")))
        rows = rows.withColumn("user_id", F.when(F.pmod(drawn, F.lit(9)) == 0, F.lit("usr_5")).otherwise(F.col("user_id")))
    return rows.drop("copy")


def main() -> None:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 20
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench-skew")
    seconds: dict[str, float] = {}
    with temporary_tables():
        clean = clean_events(RawTables(spark, sf_dir)["events"], CFG)
        for kind in ("even", "hot"):
            events = cut_lineage(copied(clean, copies, kind == "hot"), "skew")
            for name, query in QUERIES.items():
                for _ in range(2):
                    start = time.perf_counter()
                    query(events).write.format("noop").mode("overwrite").save()
                seconds[f"{name}:{kind}"] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "skew_seconds", "unit": "sec", "copies": copies, "queries": seconds}))


if __name__ == "__main__":
    main()
