"""Skew check for SCD 2: a synthetic change feed where one key holds a third
of all rows, run with and without the hot-key split. Prints wall time and the
largest post-shuffle task (rows) of each. Not a registered query: it measures
the operator under a skew the test tables do not have.

Usage: python tools/skew_demo.py [rows]"""

from __future__ import annotations

import sys
import time

sys.path.insert(0, ".")
from pyspark.sql import functions as F  # noqa: E402

from lakeshore.operators import cdc  # noqa: E402
from lakeshore.session import local_session  # noqa: E402


def main(n: int = 6_000_000) -> None:
    spark = local_session(8, shuffle_partitions=32)
    feed = (spark.range(n, numPartitions=32)
            .select(F.when(F.col("id") % 3 == 0, F.lit(0))
                    .otherwise(F.col("id") % 100_000 + 1).alias("k"),
                    (F.col("id") * 7919 % n).alias("s"),
                    F.concat(F.lit("v"), F.col("id").cast("string")).alias("v"),
                    F.when(F.col("id") % 13 == 0, F.lit("D")).otherwise(F.lit("U")).alias("op")))
    for label, rows_per_task in (("no split", None), ("split", n // 24)):
        t = time.time()
        hist = cdc.scd2(feed, ["k"], ["s"], "op = 'D'", rows_per_task=rows_per_task)
        sizes = hist.groupBy(F.spark_partition_id().alias("p")).count()
        biggest = sizes.agg(F.max("count")).first()[0]
        total = hist.count()
        print(f"{label:9s} rows={total} largest_task_rows={biggest} "
              f"secs={time.time() - t:.1f}", flush=True)


if __name__ == "__main__":
    main(*(int(a) for a in sys.argv[1:]))
