"""Running totals over sorted groups of any size.

A window function would bring a whole group into one task. Here the rows are range-partitioned by group and
order, so that a large group spans partitions; each partition sums up on its own, and the totals of the
partitions before it are added as an offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tomeflow.functions.durable import stored


def running_total(df: DataFrame, group: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """``df`` with ``out``: the sum of ``value`` (long) over the rows of the group up to and with this one.

    Group and order together must identify a row. Null group values form groups like others; nulls sort first.
    An empty table gives an empty table.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = stored(df.repartitionByRange(n, *group, *order).withColumn("_part", F.spark_partition_id()), "ordered")
    totals = placed.groupBy("_part", *group).agg(F.sum(value).alias("_total"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("_offset", F.coalesce(F.sum("_total").over(before), F.lit(0))).drop("_total")
    within = Window.partitionBy("_part", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    part = placed.withColumn("_within", F.sum(value).over(within))
    same = [F.col("a._part") == F.col("b._part"), *(F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}")) for g in group)]
    joined = part.alias("a").join(offsets.alias("b"), same)
    return joined.select(*(F.col(f"a.{c}") for c in df.columns), (F.col("a._within") + F.col("b._offset")).alias(out))
