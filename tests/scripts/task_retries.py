"""Run in its own process: a session whose tasks are retried, and input
whose tasks fail on their first attempt (as if their executor was lost).
Prints one JSON line with the observed results."""

import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tidepool.operators import mutate  # noqa: E402
from tidepool.sources.table import ParquetTable  # noqa: E402

ATTEMPTS = os.environ.get("TP_TASK_ATTEMPTS", "3")
spark = (SparkSession.builder.master(f"local[4,{ATTEMPTS}]")   # attempts per task
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tp-retry-ckpt-"))


@F.udf("long")
def flaky(x):
    """Test-only: every task's first attempt dies."""
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("simulated executor loss")
    return x


N = 2000
rows = (spark.range(0, N, numPartitions=4)
        .select(F.md5(F.col("id").cast("string")).alias("Id"),
                (F.col("id") % 3).cast("string").alias("p"),
                flaky(F.col("id")).alias("v")))
root = tempfile.mkdtemp(prefix="tp-retry-")
t = ParquetTable.create_as(spark, f"{root}/t", rows, ["p"])
appended = t.append(rows.withColumn("Id", F.concat(F.lit("copy-"), "Id")))
t.replace_where("p = '1'", rows.filter("p = '1'").withColumn("v", F.col("v") + 1))
after = t.read()
ids = mutate.assign_identity(rows.select("v"), "seq", order_by=["v"]).select("seq", "v")
seq = sorted((r["seq"], r["v"]) for r in ids.collect())
in_p1 = sum(1 for i in range(N) if i % 3 == 1)
print(json.dumps({
    # original + copies, minus both copies of partition p=1, plus its new rows
    "rows": after.count(), "expected_rows": 2 * N - 2 * in_p1 + in_p1,
    "distinct_ids": after.select("Id").distinct().count(),
    "appended": appended,
    "replaced_sum": after.filter("p = '1'").agg(F.sum("v")).first()[0],
    "expected_replaced_sum": sum(i + 1 for i in range(N) if i % 3 == 1),
    "seq_dense": [s for s, _ in seq] == list(range(1, N + 1)),
    "seq_ordered": [v for _, v in seq] == list(range(N)),
}))
