"""Wide record rows to ordered, de-duplicated, capped message rows."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, functions as F

from ..fixed_values import MESSAGES_PER_CHAMPION, TEMPLATES
from ..functions.text import (
    fill_template,
    has_value,
    match_link,
    meta_champion,
    meta_match,
    value_text,
)
from ..schemas import quoted
from ..session import cut_lineage
from ..sources.dimensions import templates_of
from .ranking import first_per_key, number_rows, top_per_group

MESSAGE_KEY = ["source_nickname", "metric", "match_id"]


def valid_nick(records: DataFrame) -> DataFrame:
    return records.where(F.col("source_nickname").isNotNull() & (F.col("source_nickname") != ""))


def unpivot_records(
    records: DataFrame, metrics: list[str], order: tuple[str, ...] = ("roster_ord",)
) -> DataFrame:
    """One row per player and non-empty metric, value and meta side by side.

    ``metric_ord`` is the position in ``metrics``, which is the message order.
    """
    entries = []
    for position, metric in enumerate(metrics, start=1):
        kind = records.schema[metric].dataType
        value = F.col(quoted(metric))
        shown = F.when(has_value(value, kind), value_text(value, kind))
        entries.append(
            F.struct(
                F.lit(position).alias("metric_ord"),
                F.lit(metric).alias("metric"),
                shown.alias("value"),
                F.col(quoted(f"{metric}_meta")).cast("string").alias("meta"),
            )
        )
    rows = records.select(
        *[F.col(quoted(name)) for name in order], "source_nickname", F.inline(F.array(*entries))
    )
    return rows.where(F.col("value").isNotNull())


def split_meta(rows: DataFrame) -> DataFrame:
    """Match and champion of the meta text, with placeholders for missing sides."""
    meta = F.col("meta")
    return rows.withColumns(
        {"match_id": meta_match(meta), "champion": meta_champion(meta)}
    ).drop("meta")


def dedupe_messages(rows: DataFrame, order: list[Column]) -> DataFrame:
    """First message per player, metric and match."""
    return first_per_key(rows, MESSAGE_KEY, order)


def cap_per_champion(
    rows: DataFrame, order: list[Column], k: int = MESSAGES_PER_CHAMPION
) -> DataFrame:
    """At most ``k`` messages per champion, over all players, in message order."""
    return top_per_group(rows, ["champion"], order, k)


def cap_in_order(
    rows: DataFrame, order: tuple[str, ...], k: int = MESSAGES_PER_CHAMPION
) -> DataFrame:
    """Repeats and cap by the row-by-row rule, for any input.

    A row is kept when fewer than ``k`` kept rows of its champion and no kept row
    of its player, metric and match precede it. ``order`` must be unique.

    Rows are the edges of a graph between champions and keys. Of the rows not yet
    decided, one that is the first of its key and among the first of its champion that the cap still has
    room for is kept, whatever the others come to. A row that only one undecided row stands in the way of is kept
    exactly when that one isn't; such chains are contracted by pointer doubling, so a
    chain of any length takes as many steps as its length has digits. What the decided rows
    settle leaves the graph, and the rest goes into the next round. A task sees the first
    ``k + 1`` rows of a champion and the first two of a key, never a whole champion.
    """
    columns = rows.columns
    by = [F.col(quoted(name)) for name in order]
    once = first_per_key(rows, [*MESSAGE_KEY, "champion"], by)
    once = cut_lineage(once.withColumn("__at", F.struct(*by)))
    # As structs, so that a null key or champion meets itself in joins.
    key, champion = F.struct(*MESSAGE_KEY), F.struct("champion")
    undecided = once.select(key.alias("__key"), champion.alias("__champion"), "__at")
    used, kept = None, []
    while True:
        now = cut_lineage(_decided(undecided, used, k))
        found = now.where("__kept")
        kept.append(found.select("__at"))
        counts = found.groupBy("__champion").agg(F.count(F.lit(1)).alias("__used"))
        if used is not None:
            both = used.unionByName(counts)
            counts = both.groupBy("__champion").agg(F.sum("__used").alias("__used"))
        used = cut_lineage(counts)
        full = used.where(F.col("__used") >= k).select("__champion")
        left = undecided.join(now.select("__at"), "__at", "left_anti")
        left = left.join(full, "__champion", "left_anti")
        undecided = cut_lineage(left.join(found.select("__key"), "__key", "left_anti"))
        if undecided.isEmpty():
            break
    every = functools.reduce(DataFrame.unionAll, kept)
    return once.join(every, "__at", "left_semi").select(*[F.col(quoted(name)) for name in columns])


def _decided(undecided: DataFrame, used: DataFrame | None, k: int) -> DataFrame:
    """Rows that this round decides, with ``__kept``; the very first row is always among them."""
    at = [F.col("__at")]
    heads = top_per_group(undecided, ["__champion"], at, k + 1, rank="__place")
    if used is None:
        heads = heads.withColumn("__room", F.lit(k).cast("bigint"))
    else:
        room = F.lit(k) - F.coalesce("__used", F.lit(0))
        heads = heads.join(used, "__champion", "left").withColumn("__room", room).drop("__used")
    firsts = top_per_group(undecided, ["__key"], at, 2, rank="__turn").select("__key", "__at", "__turn")
    both = cut_lineage(heads.join(firsts.drop("__key"), "__at"))
    free = F.col("__place") <= F.col("__room")
    sure = both.where(free & (F.col("__turn") == 1)).select("__at", F.lit(True).alias("__kept"))
    # One row in the way: the first of the key, or the only earlier one of a champion with room for one.
    ahead = firsts.where("__turn = 1").select("__key", F.col("__at").alias("__on"))
    of_key = both.where(free & (F.col("__turn") == 2)).join(ahead, "__key").select("__at", "__on")
    last = (F.col("__room") == 1) & (F.col("__place") == 2) & (F.col("__turn") == 1)
    leader = heads.where("__place = 1").select("__champion", F.col("__at").alias("__on"))
    of_champion = both.where(last).join(leader, "__champion").select("__at", "__on")
    links = cut_lineage(of_key.unionByName(of_champion).withColumn("__odd", F.lit(True)))
    while True:
        onward = links.select(
            F.col("__at").alias("__on"), F.col("__on").alias("__next"), F.col("__odd").alias("__more")
        )
        doubled = links.join(onward, "__on", "left")
        if doubled.where("__next is not null").isEmpty():
            break
        links = cut_lineage(
            doubled.select(
                "__at",
                F.coalesce("__next", "__on").alias("__on"),
                (F.col("__odd") != F.coalesce("__more", F.lit(False))).alias("__odd"),
            )
        )
    roots = sure.select(F.col("__at").alias("__on"))
    chained = links.join(roots, "__on").select("__at", (~F.col("__odd")).alias("__kept"))
    placed = both.select("__at", "__champion", "__key")
    return placed.join(sure.unionByName(chained), "__at")


def message_text(rows: DataFrame, texts: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """Fill each row's template. The texts are a list in code, hence small."""
    return (
        rows.join(templates_of(rows.sparkSession, texts), "metric")
        .withColumn(
            "text",
            fill_template(
                F.col("parts"),
                {
                    "nickname": F.col("source_nickname").cast("string"),
                    "matchId": match_link(F.col("match_id")),
                    "champion": F.col("champion"),
                    "value": F.col("value"),
                },
            ),
        )
        .drop("parts")
    )


def build_messages(
    records: DataFrame,
    texts: list[tuple[str, str]] = TEMPLATES,
    order: tuple[str, ...] = ("roster_ord",),
    k: int = MESSAGES_PER_CHAMPION,
    one_champion_per_match: bool = True,
) -> DataFrame:
    """Messages of a record table, in message order by ``order`` then ``metric_ord``.

    ``texts`` lists the metrics to report, in message order, with their templates.
    ``order`` must tell record rows apart. Dropping repeats before capping equals
    the row-by-row rule (cap first, then repeat) because a player has one
    champion per match: a repeat shares its champion with the row it repeats.
    Unset ``one_champion_per_match`` for tables where that does not hold.
    """
    by = [F.col(quoted(name)) for name in order] + [F.col("metric_ord")]
    metrics = [metric for metric, _ in texts]
    rows = split_meta(unpivot_records(valid_nick(records), metrics, order))
    if one_champion_per_match:
        kept = cap_per_champion(dedupe_messages(rows, by), by, k)
    else:
        kept = cap_in_order(rows, (*order, "metric_ord"), k)
    return message_text(kept, texts)


def message_order(messages: DataFrame, order: tuple[str, ...] = ("roster_ord",)) -> DataFrame:
    return messages.orderBy(*[F.col(quoted(name)) for name in order], "metric_ord")


def number_messages(messages: DataFrame, order: tuple[str, ...] = ("roster_ord",)) -> DataFrame:
    """Position and total of each message, as shown under it."""
    by = [F.col(quoted(name)) for name in order] + [F.col("metric_ord")]
    numbered = number_rows(messages, by)
    label = F.format_string("(%d/%d)", F.col("pos"), F.col("total"))
    return numbered.withColumn("label", label)
