"""Partitioned landing of tables: write, list, register."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import path_key
from ..schemas import quoted
from .retirement import folders_below

DAY_LAYOUT = ("load_date",)
PLAYER_DAY_LAYOUT = ("load_date", "player_key")


def with_player_key(df: DataFrame, player: str = "source_nickname") -> DataFrame:
    return df.withColumn("player_key", path_key(F.col(quoted(player)).cast("string")))


def write_partitions(
    df: DataFrame,
    path: str,
    partition_by: tuple[str, ...] = DAY_LAYOUT,
    sort_by: tuple[str, ...] = ("player_key",),
    mode: str = "append",
) -> None:
    """Snappy Parquet by partition folder.

    ``rebalance`` gathers each folder's rows into few files and lets adaptive
    execution cut a folder that holds most of the rows into many tasks. Rows
    are sorted inside files so that scans for one player skip row groups.
    ``mode="overwrite"`` replaces only the partitions present in ``df``.
    """
    levels = [F.col(quoted(name)) for name in partition_by]
    order = [F.col(quoted(name)) for name in (*partition_by, *sort_by) if name in df.columns]
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        # Without adaptive execution this would put a whole day into one task.
        df = df.hint("rebalance", *levels)
    (
        df.sortWithinPartitions(*order)
        .write.mode(mode)
        .option("compression", "snappy")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def list_partitions(
    landed: DataFrame, day: str = "load_date", player: str = "player_key"
) -> DataFrame:
    """Player-days that have rows; duplicates collapse before the shuffle."""
    return landed.select(
        F.col(quoted(day)).alias("load_date"), F.col(quoted(player)).alias("player_key")
    ).distinct()


def read_partitions(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read.option("pathGlobFilter", "*.parquet")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def register_partition(spark: SparkSession, table: str, location: str, **levels: str) -> None:
    """Add one folder to a catalog table; one that is there already is fine."""
    spec = ", ".join(f"{quoted(name)} = '{value}'" for name, value in levels.items())
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION '{location}'")


def register_all(spark: SparkSession, table: str) -> None:
    """Add every folder below the table's location."""
    spark.catalog.recoverPartitions(table)


def register_new(spark: SparkSession, table: str, root: str, level: str = "load_date") -> list[str]:
    """Add the folders of ``root`` that the catalog table doesn't know; their values.

    Spark lists the files and compares folders with partitions; only what is new reaches the driver.
    """
    known = spark.sql(f"SHOW PARTITIONS {table}").select(F.col("partition").alias("folder"))
    new = folders_below(spark, root, f"{level}=*").join(known, "folder", "left_anti")
    values = sorted(row["folder"].split("=", 1)[1] for row in new.select("folder").collect())
    for start in range(0, len(values), 100):
        added = " ".join(
            f"PARTITION ({quoted(level)} = '{value}') LOCATION '{root}/{level}={value}'"
            for value in values[start : start + 100]
        )
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {added}")
    # Files added to known partitions are found as well.
    spark.catalog.refreshTable(table)
    return values


def materialize_table(df: DataFrame, table: str, path: str | None = None) -> None:
    """Replace a catalog table by the result of ``df``; ``path`` keeps it outside the warehouse."""
    writer = df.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def materialize_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)
