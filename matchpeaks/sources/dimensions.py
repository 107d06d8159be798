"""Small tables every job needs: players, texts, asset manifest."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..fixed_values import TEMPLATES
from ..functions.text import normalised_key, template_parts
from ..schemas import ROSTER


def roster_of(spark: SparkSession, nicknames: list[str]) -> DataFrame:
    """Tracked players given in code, in display order.

    Made from an Arrow table, it has a known size, so joins with a short roster
    are planned as broadcasts and move in front of aggregations.
    """
    order = pa.array(range(1, len(nicknames) + 1), pa.int32())
    names = pa.array(nicknames, pa.string())
    return spark.createDataFrame(pa.table({"roster_ord": order, "nickname": names}))


def read_roster(spark: SparkSession, path: str) -> DataFrame:
    """Tracked players kept as JSON lines of ``roster_ord`` and ``nickname``."""
    return spark.read.schema(ROSTER).json(path)


def templates_of(spark: SparkSession, texts: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One row (metric, parts) per metric, of known size."""
    metrics, templates = (pa.array(column, pa.string()) for column in zip(*texts))
    rows = spark.createDataFrame(pa.table({"metric": metrics, "template": templates}))
    return rows.select("metric", template_parts(F.col("template")).alias("parts"))


def manifest_rows(text: DataFrame, base_dir: str | None = None, column: str = "value") -> DataFrame:
    """JSON objects ``{name: [file, …]}`` to rows (champion, champ_norm, pos, file).

    Entries that hold no list are dropped. Relative names get ``base_dir``.
    Of several names with one normalised key, the last listed one counts.
    """
    entries = F.map_entries(F.from_json(F.col(column), "map<string,string>"))
    listed = (
        text.select(F.posexplode(entries).alias("entry", "e"))
        .select("entry", F.col("e.key").alias("champion"), F.col("e.value").alias("listed"))
        .where(F.startswith(F.ltrim("listed"), F.lit("[")))
        .withColumn("champ_norm", normalised_key(F.col("champion")))
    )
    winner = listed.groupBy("champ_norm").agg(
        F.max(F.struct("entry", "champion")).getField("champion").alias("champion")
    )
    files = F.posexplode(F.from_json("listed", "array<string>")).alias("pos", "file")
    rows = listed.join(winner, ["champ_norm", "champion"], "left_semi").select(
        "champion", "champ_norm", files
    )
    if base_dir is not None:
        full = F.concat_ws("/", F.lit(base_dir.rstrip("/")), F.col("file"))
        absolute = F.startswith(F.col("file"), F.lit("/"))
        rows = rows.withColumn("file", F.when(absolute, F.col("file")).otherwise(full))
    return rows


def read_manifest(
    spark: SparkSession, path: str, base_dir: str | None = None, whole_file: bool = False
) -> DataFrame:
    """Manifest with one JSON object per line, or one object per file."""
    text = spark.read.text(path, wholetext=whole_file)
    return manifest_rows(text, base_dir)
