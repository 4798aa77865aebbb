"""Ranks over a whole table without a window over all rows."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundscape.session import stored

WITHIN = (1 << 33) - 1  # the part of monotonically_increasing_id that counts within a partition


def with_rank(df: DataFrame, order: Sequence[str], out: str = "rank", partitions: int | None = None) -> DataFrame:
    """``df`` with the rank of each row, from 0, in the order of columns that tell all rows apart.

    Rows are sorted over range partitions and stored with their place there; adding the sizes of the
    partitions before gives the rank. Only those sizes, one number per partition, pass
    through the driver."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    placed = stored(
        placed.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND(F.lit(WITHIN))}), "ranks"
    )
    sizes = sorted((r["_part"], r["count"]) for r in placed.groupBy("_part").count().collect())
    starts = [(p, at - c) for (p, c), at in zip(sizes, accumulate(c for _, c in sizes), strict=True)]
    table = spark.createDataFrame(starts, "_part int, _start long")
    return placed.join(F.broadcast(table), "_part").withColumn(out, F.col("_start") + F.col("_at")).drop("_part", "_at", "_start")
