"""Image files per champion: manifest rows, lookup, seeded pick, leftovers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import normalised_key
from ..schemas import quoted

CHUNK = 1000


def skin_files(assets: DataFrame, column: str = "data") -> DataFrame:
    """Rows (champion, num, file) of ``map<champion, struct<skins: array<struct<num>>>>``."""
    champions = assets.select(F.explode(quoted(column)).alias("champion", "details"))
    skins = champions.select("champion", F.explode("details.skins").alias("skin"))
    return skins.select(
        "champion",
        F.col("skin.num").alias("num"),
        F.format_string("%s_%d.jpg", "champion", F.col("skin.num")).alias("file"),
    )


def collect_files(files: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Lists of files by champion, in ``num`` order, for rows (champion, num, file).

    A list covers ``chunk`` consecutive numbers, so its length is bounded and a
    champion with very many files is spread over as many rows and tasks as it
    needs. ``num`` is unique within a champion.
    """
    part = F.floor(F.col("num") / chunk).cast("bigint")
    listed = files.groupBy("champion", part.alias("chunk")).agg(
        F.sort_array(F.collect_list(F.struct("num", "file"))).alias("listed")
    )
    return listed.select(
        "champion", "chunk", F.transform("listed", lambda entry: entry["file"]).alias("files")
    )


def manifest_json(lists: DataFrame) -> DataFrame:
    """One JSON object per row; write with ``.write.text`` and read as manifest."""
    entry = F.create_map(F.col("champion"), F.col("files"))
    return lists.select(F.to_json(entry).alias("value"))


def pick_random(manifest: DataFrame, seed: int | str, key: str = "champ_norm") -> DataFrame:
    """One file per champion, each equally likely, the same for the same seed.

    The row with the least seeded digest wins, so no list is built and tasks
    send one candidate per champion.
    """
    named = F.concat_ws("|", F.lit(str(seed)), F.col(quoted(key)).cast("string"), "pos", "file")
    digest = F.md5(named)
    least = F.min(F.struct(digest.alias("digest"), "pos", "file"))
    return (
        manifest.groupBy(F.col(quoted(key)))
        .agg(least.alias("pick"))
        .select(F.col(quoted(key)), F.col("pick.file").alias("file"))
    )


def manifest_join(messages: DataFrame, picks: DataFrame, champion: str = "champion") -> DataFrame:
    """Attach the picked file by normalised champion name; NULL when there is none."""
    keyed = messages.withColumn("champ_norm", normalised_key(F.col(quoted(champion))))
    return keyed.join(picks, "champ_norm", "left")


def prune_unlisted(present: DataFrame, listed: DataFrame, key: str | list[str]) -> DataFrame:
    """Files that are present but not listed. Returned only; nothing is deleted."""
    keys = [key] if isinstance(key, str) else key
    names = listed.select(*[F.col(quoted(name)) for name in keys]).distinct()
    return present.join(names, keys, "left_anti")


def directory_manifest(files: DataFrame) -> DataFrame:
    """Manifest rows from file names alone: the champion is what precedes the last ``_``.

    ``pos`` only has to be the same each time, so it is a hash of the name.
    """
    champion = F.regexp_extract("file", r"^(.+)_[^_]*\.(?:jpg|png)$", 1)
    named = files.select(champion.alias("champion"), "file").where(F.col("champion") != "")
    return named.select(
        "champion",
        normalised_key(F.col("champion")).alias("champ_norm"),
        F.xxhash64("file").alias("pos"),
        "file",
    )


def present_files(
    spark: SparkSession, directory: str, pattern: str = "*.{jpg,png}"
) -> DataFrame:
    """File names below ``directory``; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(directory)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("file"))
