"""Rows, seconds, shuffle bytes and scans of every registered query.

Usage: python -m checks.measure [sf_dir [name ...]]   (prints a Markdown table)
"""

from __future__ import annotations

import sys
import time

from pyspark.sql import SparkSession

from carebasin.session import build_session
from checks import QUERIES


def shuffled(spark: SparkSession) -> dict[int, int]:
    """Shuffle bytes written so far, by stage."""
    gateway = spark.sparkContext._gateway
    empty = gateway.jvm.java.util.ArrayList()
    quantiles = gateway.new_array(gateway.jvm.double, 0)
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = store.stageList(empty, False, False, quantiles, empty)
    return {
        stages.apply(i).stageId(): stages.apply(i).shuffleWriteBytes()
        for i in range(stages.size())
    }


def main(arguments: list[str]) -> None:
    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.1"
    spark = build_session(
        "measure", "local[8]",
        **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
           "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "16g",
           "spark.ui.retainedStages": "100000"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    print("| query | rows | seconds | shuffle KB | scans |\n| --- | --- | --- | --- | --- |")
    for name in arguments[1:] or QUERIES:
        query = QUERIES[name]
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        before, start = shuffled(spark), time.perf_counter()
        frame = query(spark, sf_dir)
        frame.write.format("noop").mode("overwrite").save()
        seconds = time.perf_counter() - start
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        moved = sum(n for stage, n in shuffled(spark).items() if stage not in before)
        plan = frame._jdf.queryExecution().executedPlan().toString()
        scans = plan.split("Initial Plan")[0].count("FileScan")
        print(f"| {name} | {frame.count()} | {seconds:.2f} | {moved // 1024} | {scans} |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
