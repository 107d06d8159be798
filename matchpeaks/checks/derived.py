"""Match-shaped inputs that Spark derives from the ``events`` table, whole.

Each event becomes one match of its user. The column expressions use only
arithmetic that Spark and DuckDB share, so the SQL checks can state the same input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..metrics import GAME_COLUMNS
from ..session import spread

AS_OF = "2024-01-31"

# Expressions over: k (the number in props), v (value as integer), e (event id), u (user).
RAW_EXPRESSIONS = {
    "assists": "(k * 7 + e) % 23",
    "baronKills": "k % 3",
    "champLevel": "1 + (k + u) % 18",
    "damageDealtToObjectives": "k * 211 + v * 3",
    "damageDealtToTurrets": "k * 97 + e % 701",
    "damageSelfMitigated": "k * 301 + v * 11",
    "deaths": "CASE WHEN k % 19 = 5 THEN NULL ELSE k % 5 END",
    "doubleKills": "k % 4",
    "dragonKills": "CASE WHEN k % 17 = 0 THEN NULL ELSE (k + e) % 5 END",
    "firstBloodKill": "k = 42",
    "goldEarned": "5000 + k * 123 + v",
    "goldSpent": "4800 + k * 119",
    "inhibitorKills": "(k * 5) % 4",
    "killingSprees": "(k + 3 * u) % 7",
    "kills": "(k * 3 + e) % 31",
    "largestCriticalStrike": "v * 17 + k",
    "longestTimeSpentLiving": "k * 13 + e % 97",
    "magicDamageDealtToChampions": "v * 29",
    "neutralMinionsKilled": "(k * 11 + v) % 113",
    "objectivesStolen": "k % 2",
    "objectivesStolenAssists": "(k + u) % 2",
    "pentaKills": "CASE WHEN k = 99 THEN 1 ELSE 0 END",
    "physicalDamageDealtToChampions": "v * 31 + k * 7",
    "quadraKills": "CASE WHEN k > 97 THEN 1 ELSE 0 END",
    "summoner1Casts": "k % 11",
    "summoner1Id": "k % 6",
    "summoner2Casts": "(k + 2) % 9",
    "summoner2Id": "(k + e) % 6",
    "timeCCingOthers": "(k * 9 + u) % 211",
    "totalDamageDealt": "20000 + v * 301 + k * 41",
    "totalDamageDealtToChampions": "9000 + v * 101 + k * 23",
    "totalDamageShieldedOnTeammates": "k * v",
    "totalDamageTaken": "11000 + k * 203",
    "totalEnemyJungleMinionsKilled": "(k * 2 + e) % 41",
    "totalHealsOnTeammates": "k * 57",
    "totalMinionsKilled": "60 + (k * 13 + v) % 211",
    "totalTimeSpentDead": "CASE WHEN k % 10 = 0 THEN 2 * (k * 20) ELSE k % 300 END",
    "tripleKills": "CASE WHEN k > 90 THEN k % 3 ELSE 0 END",
    "turretKills": "(k * 3 + u) % 12",
    "visionScore": "(k * 4 + v) % 103",
    "visionWardsBoughtInGame": "k % 14",
    "wardsKilled": "(k + e) % 16",
    "wardsPlaced": "(k + v) % 37",
    "trueDamageDealtToChampions": "k * 19",
}

# 0 for some games, so that divisions by zero occur.
DURATION = "CASE WHEN k % 23 = 0 THEN 0 ELSE k * 20 END"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    return spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("k", k)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        "event_type",
        "k",
        F.col("value").cast("bigint").alias("v"),
        F.col("event_id").alias("e"),
        F.col("user_id").alias("u"),
        F.expr("timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', ts)").alias("ms"),
    )


def _participant(own: bool) -> dict[str, Column]:
    """The player's own values, or another participant's with fewer of them."""
    fields = {
        "participantId": F.lit(1 if own else 2).cast("bigint"),
        "riotIdGameName": F.concat(F.lit("User"), F.col("u")) if own else F.lit("Other"),
        "riotIdTagline": F.lit("T1"),
        "championName": F.col("event_type"),
    }
    for name, sql in RAW_EXPRESSIONS.items():
        kind = "boolean" if name == "firstBloodKill" else "bigint"
        value = F.expr(sql)
        if not own:
            value = value + 1 if name in ("kills", "assists", "deaths") else F.lit(None)
        fields[name] = value.cast(kind)
    return fields


def own_participants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Participant rows of the users themselves, one per event, raw column names."""
    return _inputs(spark, sf_dir).select(
        F.concat(F.lit("RU_"), F.col("e")).alias("metadata.matchId"),
        F.col("ms").alias("info.gameCreation"),
        F.expr(DURATION).cast("bigint").alias("info.gameDuration"),
        *[value.alias(f"participant.{name}") for name, value in _participant(own=True).items()],
        F.concat(F.lit("User"), F.col("u"), F.lit("#T1")).alias("source_nickname"),
    )


def documents(
    spark: SparkSession, sf_dir: str, a_file: int | None = None, days_later: int = 0, where: str = "true"
) -> DataFrame:
    """Match documents as JSON text with two participants each.

    ``error`` events lack ``info``, ``signup`` events lack one meta value, and
    ``view`` events with k = 50 have text that breaks off. Of the events ``where`` holds for, filed ``days_later``.

    With ``a_file``, events are dealt out in order of day, about so many a task, before they become
    text: a writer by day then needs neither a shuffle nor a sort of text.
    """
    found = _inputs(spark, sf_dir).withColumn("event_id", F.col("e")).where(where)
    found = found.withColumn("load_date", F.date_add(F.to_date(F.timestamp_millis("ms")), days_later))
    if a_file is None:
        found = spread(found)
    else:
        parts = max(spark.sparkContext.defaultParallelism, found.count() // a_file + 1)
        found = found.repartitionByRange(parts, "load_date", "e").sortWithinPartitions("load_date")
    pair = [
        F.struct(*[value.alias(name) for name, value in _participant(own).items()])
        for own in (True, False)
    ]
    info = F.struct(
        F.col("ms").alias("gameCreation"),
        F.expr(DURATION).cast("bigint").alias("gameDuration"),
        F.lit("CLASSIC").alias("gameMode"),
        F.lit(420).cast("bigint").alias("queueId"),
        F.when(F.col("event_type") != "signup", F.lit("14.1")).alias("gameVersion"),
        F.array(*pair).alias("participants"),
    )
    text = F.to_json(
        F.struct(
            F.struct(F.concat(F.lit("RU_"), F.col("e")).alias("matchId")).alias("metadata"),
            F.when(F.col("event_type") != "error", info).alias("info"),
            F.concat(F.lit("User"), F.col("u"), F.lit("#T1")).alias("source_nickname"),
        )
    )
    cut = (F.col("event_type") == "view") & (F.col("k") == 50)
    return found.select(
        "event_id",
        F.when(cut, F.substring(text, 1, 30)).otherwise(text).alias("text"),
        F.concat(F.lit("User"), F.col("u"), F.lit("#T1")).alias("source_nickname"),
        "load_date",
    )


def roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers as tracked players of the derived matches."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("roster_ord"),
        F.concat(F.lit("User"), F.col("c_custkey"), F.lit("#T1")).alias("nickname"),
    )


def event_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers as tracked users of the events themselves."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("roster_ord"), F.col("c_custkey").alias("nickname")
    )


def sql_raw() -> str:
    """DuckDB text of :func:`own_participants`, under short names."""
    columns = [
        f"({RAW_EXPRESSIONS[name.split('.')[1]]}) AS {short}"
        for short, name in GAME_COLUMNS.items()
        if name.split(".")[1] in RAW_EXPRESSIONS
    ]
    return f"""
    inputs AS (
        SELECT event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
               event_id AS e, user_id AS u, epoch_us(ts) // 1000 AS ms, ts,
               CAST(trunc(value) AS BIGINT) AS v
        FROM events
    ),
    raw AS (
        SELECT 'User' || u || '#T1' AS source_nickname, 'RU_' || e AS match_id,
               event_type AS champion_name, ms AS game_creation_ts,
               CAST(ts AS DATE) AS game_day, {DURATION} AS game_duration,
               {", ".join(columns)}
        FROM inputs
    )"""
