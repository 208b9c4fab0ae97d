"""Time the catalogue: prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default: all) the local
threads. Each query runs once to warm up and then BENCH_RUNS times (default 2; once if that
takes over a second) into a sink that discards the rows; the fastest counts. ``join_shaped`` times the gate written as aggregate, two
joins and a window, for comparison with the single-window gate.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievework.catalogue import QUERIES
from sievework.catalogue.gate_queries import LINE_KEY
from sievework.catalogue.registry import line_quantities
from sievework.session import create_session


def gate_with_joins(spark, sf_dir) -> DataFrame:
    """The same counts as gate_rule_counts by aggregate, inner join, anti join and window."""
    lines = line_quantities(spark, sf_dir)
    keys = (
        lines.groupBy(*LINE_KEY)
        .agg(F.count_distinct("quantity").alias("n"))
        .filter("n > 1")
        .select(*LINE_KEY)
    )
    clashing = lines.join(keys, LINE_KEY).select(F.lit("conflicting_duplicate").alias("rule"))
    order = Window.partitionBy(*LINE_KEY, "quantity").orderBy("l_returnflag", "l_linestatus")
    ranked = lines.join(keys, LINE_KEY, "left_anti").select(F.row_number().over(order).alias("r"))
    rule = F.when(F.col("r") > 1, "exact_duplicate").otherwise("accepted")
    rest = ranked.select(rule.alias("rule"))
    return clashing.unionAll(rest).groupBy("rule").count()


def seconds(make, spark, sf_dir, runs: int) -> float:
    times = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        make(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
        if len(times) > 1 and times[-1] > 1:
            break
    return round(min(times[1:]), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = create_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or list(QUERIES)
    timings = {name: seconds(QUERIES[name], spark, sf_dir, runs) for name in names}
    shape = seconds(gate_with_joins, spark, sf_dir, runs)
    report = {
        "metric": "catalogue_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
        "join_shaped": {"gate_with_joins": shape},
    }
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
