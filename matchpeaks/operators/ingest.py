"""From nested match documents to participant rows, and what is still to load."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..fixed_values import INGEST_DAYS, MATCHES_PER_PLAYER_DAY, META_COLUMNS
from ..functions.dates import epoch_ms_to_date, ingest_days
from ..functions.text import is_player_id, path_key, strip_isolates
from ..schemas import quoted
from ..session import cut_lineage
from .ranking import PLACE_BITS, first_per_key, top_per_group

# Documents that one task takes: a few hundred MB of participant rows at ten a document.
DOCUMENTS_A_TASK = 25_000
# Documents whose rows are shuffled and written at once.
DOCUMENTS_A_ROUND = 2_000_000
# A match of a player, and when it began.
KEY = ["source_nickname", "match"]
CREATED = "__created"


def flatten_match(documents: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Meta values under their dotted names, next to the participant array."""
    meta = [F.col(name).alias(name) for name, _ in META_COLUMNS]
    extra = [F.col(quoted(name)) for name in keep]
    return documents.select(*meta, F.col("info.participants").alias("participants"), *extra)


def explode_participants(flat: DataFrame, array: str = "participants") -> DataFrame:
    """One row per participant; a document without participants gives none."""
    element: T.StructType = flat.schema[array].dataType.elementType
    fields = [
        F.col(f"p.{quoted(name)}").alias(f"participant.{name}") for name in element.fieldNames()
    ]
    others = [F.col(quoted(name)) for name in flat.columns if name != array]
    rows = flat.select(*others, F.explode(quoted(array)).alias("p"))
    # The participant's columns take the place of the array.
    at = flat.columns.index(array)
    return rows.select(*others[:at], *fields, *others[at:])


def add_source(df: DataFrame, player: str | Column) -> DataFrame:
    """The tracked player whose loading brought the row in."""
    value = F.lit(player) if isinstance(player, str) else player
    return df.withColumn("source_nickname", strip_isolates(value))


def participants_of(documents: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Participant rows of the documents that carry player and load day."""
    return explode_participants(flatten_match(documents, keep))


def distinct_participants(rows: DataFrame) -> DataFrame:
    """One row per tracked player, match and participant, whichever file came first.

    Copies are dropped by key alone; which one stays does not matter, they are
    the same landed document.
    """
    return rows.dropDuplicates(
        ["source_nickname", "metadata.matchId", "participant.participantId"]
    )


def check_roster(roster: DataFrame) -> None:
    """An id without a tag is an error, before anything is loaded."""
    wrong = roster.where(~F.coalesce(is_player_id(F.col("nickname")), F.lit(False)))
    row = wrong.select("nickname").first()
    if row is not None:
        raise ValueError(f"no player id: {row['nickname']!r}")


def own_day(documents: DataFrame) -> DataFrame:
    """Documents under the day their game began on, whichever folder they landed in."""
    return documents.withColumn("load_date", epoch_ms_to_date(F.col("info.gameCreation")))


def new_matches(documents: DataFrame, landed: DataFrame, row: str | None = None) -> DataFrame:
    """Documents whose (player, match) is not in ``landed`` yet, each once.

    Anti-join and repeats go by the same key, so documents are shuffled once. The player is
    compared by id; the path form of an id may belong to two players.

    With ``row``, a column of stored documents that is unique, only keys and rows are sorted; whole documents
    are shuffled once by row, hashed against the rows to keep, never sorted, and a task gets
    about ``DOCUMENTS_A_TASK`` of them, however many there are.
    """
    if row is None:
        keyed = with_match(documents)
        newest = [F.col("info.gameCreation").desc()]
        return first_per_key(keyed.join(known_keys(landed), KEY, "left_anti"), KEY, newest)
    fresh = cut_lineage(new_rows(keys_of(documents, row), landed, row).select(row))
    return at_rows(documents, fresh, row, fresh.count())


def with_match(documents: DataFrame) -> DataFrame:
    return documents.withColumn("match", F.col("metadata.matchId"))


def known_keys(landed: DataFrame) -> DataFrame:
    return landed.select("source_nickname", F.col("`metadata.matchId`").alias("match")).distinct()


def keys_of(documents: DataFrame, row: str) -> DataFrame:
    """What tells stored documents apart, without the documents: player, match, time, day and row."""
    return with_match(documents).select(*KEY, F.col("info.gameCreation").alias(CREATED), "load_date", row)


def new_rows(keys: DataFrame, landed: DataFrame, row: str) -> DataFrame:
    """Of :func:`keys_of` documents, those whose (player, match) is not in ``landed`` yet, each once."""
    narrow = keys.join(known_keys(landed), KEY, "left_anti")
    return first_per_key(narrow, KEY, [F.col(CREATED).desc(), F.col(row)])


def at_rows(documents: DataFrame, rows: DataFrame, row: str, count: int) -> DataFrame:
    """The documents at these ``count`` rows, with their match."""
    keyed = with_match(documents)
    if not count:
        return keyed.drop(row).limit(0)
    parts = max(documents.sparkSession.sparkContext.defaultParallelism, count // DOCUMENTS_A_TASK + 1)
    kept = rows.select(row).repartition(parts, row).hint("shuffle_hash")
    return keyed.repartition(parts, row).join(kept, row, "left_semi").drop(row)


def rounds_of(documents: DataFrame, rows: DataFrame, row: str) -> Iterator[DataFrame]:
    """What :func:`at_rows` gives, in parts that are to be written one after another.

    So the disk that shuffles take is that of a part. A part is a range of row numbers, of whole stored files; those of other
    parts are skipped by their bounds. It looks through about ``DOCUMENTS_A_ROUND`` documents, more where a file has more
    or cores would idle. Two counts for each stored file reach the driver.
    """
    cores = documents.sparkSession.sparkContext.defaultParallelism
    most = max(DOCUMENTS_A_ROUND, cores * DOCUMENTS_A_TASK)
    file = F.shiftright(row, PLACE_BITS).alias("file")
    looked_through = documents.groupBy(file).agg(F.count(F.lit(1)).alias("there"))
    kept = rows.groupBy(file).agg(F.count(F.lit(1)).alias("kept"))
    by_file = looked_through.join(kept, "file").select("file", "there", "kept").orderBy("file")
    parts: list[tuple[int, int, int, int]] = []
    for at, there, count in by_file.collect():
        if parts and parts[-1][2] + there <= most:
            first, _, before, found = parts.pop()
            parts.append((first, at, before + there, found + count))
        else:
            parts.append((at, at, there, count))
    for first, last, _, count in parts:
        inside = F.col(row).between(first << PLACE_BITS, (last + 1 << PLACE_BITS) - 1)
        yield at_rows(documents.where(inside), rows.where(inside), row, count)


def ingest_grid(roster: DataFrame, as_of=None, days: int = INGEST_DAYS) -> DataFrame:
    """Every player with each of the last ``days`` days; no join involved."""
    return roster.select("*", F.explode(ingest_days(as_of, days)).alias("load_date")).withColumn(
        "player_key", path_key(F.col("nickname").cast("string"))
    )


def missing_partitions(grid: DataFrame, landed: DataFrame) -> DataFrame:
    """Player-days of the grid that have not landed yet."""
    return grid.join(landed, ["load_date", "player_key"], "left_anti")


def limit_per_day(
    rows: DataFrame,
    player: str = "source_nickname",
    day: str = "load_date",
    newest: list[Column] | None = None,
    k: int = MATCHES_PER_PLAYER_DAY,
) -> DataFrame:
    """At most ``k`` newest matches per player and day."""
    newest = newest or [
        F.col("`info.gameCreation`").desc(),
        F.col("`metadata.matchId`").desc(),
    ]
    return top_per_group(rows, [player, day], newest, k)
