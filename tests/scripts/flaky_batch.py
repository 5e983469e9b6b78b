"""Batch layer with one task that fails on its first attempt.

Run in its own process (``local[4,2]``: 4 threads, 2 attempts per task).
Prints the served risk summary as JSON; the caller compares it with the
expected counts.
"""

import json
import os
import sys

from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, sys.argv[1])

from riverwatch.operators.decode import decode_kafka_batch  # noqa: E402
from riverwatch.plans.batch import run_batch  # noqa: E402
from riverwatch.plans.serving import ServingLayer  # noqa: E402
from riverwatch.sources import readings as R  # noqa: E402


MARKERS = sys.argv[3] + "/failures"


@F.udf(T.BooleanType())
def fail_first_attempt(_):
    ctx = TaskContext.get()
    if ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
        os.makedirs(MARKERS, exist_ok=True)
        with open(f"{MARKERS}/stage{ctx.stageId()}", "w"):
            pass
        raise RuntimeError("injected task failure")
    return True


def main() -> None:
    sf_dir, out = sys.argv[2], sys.argv[3]
    spark = (SparkSession.builder.master("local[4,2]")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.checkpoint.dir", out + "/ckpt")
             .getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    events = R.load_table(spark, sf_dir, "events").repartition(4)
    flaky = events.filter(fail_first_attempt(F.col("event_id")))
    run_batch(spark, decode_kafka_batch(R.messages_from_events(flaky)), out + "/views", run_id="r")
    rows = ServingLayer(spark, out + "/views").query("risk_summary").collect()
    print(json.dumps({r.flood_risk_level: r["count"] for r in rows}))
    spark.stop()


if __name__ == "__main__":
    main()
