"""First, best and n-th rows of groups and of whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..schemas import quoted
from ..session import cut_lineage

# From this k on, Spark no longer plans a per-task limit in front of the shuffle.
GROUP_LIMIT_THRESHOLD = "spark.sql.optimizer.windowGroupLimitThreshold"
# Lower bits of monotonically_increasing_id, which count rows within a partition.
PLACE_BITS = 33


def top_per_group(
    df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str | None = None
) -> DataFrame:
    """The first ``k`` rows of each group.

    Each task keeps its own best ``k`` rows of a group before the shuffle, so a
    group that holds most of the table still moves at most ``k`` rows per task.
    Very large ``k`` takes an extra round per input partition instead.
    """
    keep = rank or "__rank"
    groups = [F.col(quoted(key)) for key in keys]

    def best(rows: DataFrame, by: list[Column]) -> DataFrame:
        position = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        return rows.withColumn(keep, position).where(F.col(keep) <= k)

    if k >= int(df.sparkSession.conf.get(GROUP_LIMIT_THRESHOLD)):
        salted = df.withColumn("__salt", F.spark_partition_id())
        df = best(salted, [*groups, F.col("__salt")]).drop(keep, "__salt")
    ranked = best(df, groups)
    return ranked if rank else ranked.drop(keep)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first in ``order``."""
    return top_per_group(df, keys, order, 1)


def number_rows(
    df: DataFrame, order: list[Column], position: str = "pos", total: str = "total"
) -> DataFrame:
    """Position in a total order, and the number of rows.

    Rows are sorted over range partitions and stored with the number Spark gives
    them there: the range in the upper bits, the place within it in the lower
    ones. Adding the sizes of the ranges before it makes that the position, so
    one shuffle is all it takes, and only the range sizes meet in one task.
    ``order`` should be unique.
    """
    placed = cut_lineage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("__at", F.monotonically_increasing_id())
    )
    ranges = placed.withColumn("__range", F.shiftright("__at", PLACE_BITS))
    sizes = ranges.groupBy("__range").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        "__range",
        F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__shift"),
        F.sum("__size").over(Window.partitionBy()).alias(total),
    )
    place = F.col("__at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)) + 1
    return (
        ranges.join(F.broadcast(shifts), "__range")
        .withColumn(position, F.col("__shift") + place)
        .drop("__range", "__shift", "__at")
    )
