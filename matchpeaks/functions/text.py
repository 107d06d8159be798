"""Text columns: ids, keys, links and message values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from ..fixed_values import (
    MATCH_ID_PREFIX,
    MATCH_LINK,
    META_SEPARATOR,
    PLAYER_LINK,
    UNKNOWN_CHAMPION,
    UNKNOWN_MATCH,
)


def strip_isolates(text: Column) -> Column:
    """Drop the invisible direction marks that copied names carry."""
    return F.regexp_replace(text, r"[\u2066-\u2069]", "")


def path_key(player: Column) -> Column:
    """Player id as a folder name."""
    return F.replace(strip_isolates(player), F.lit("#"), F.lit("_"))


def landing_path(prefix: str, day: Column, player: Column) -> Column:
    return F.concat_ws("/", F.lit(prefix), F.date_format(day, "yyyy-MM-dd"), path_key(player))


def is_player_id(player: Column) -> Column:
    return F.instr(player, "#") > 0


def player_name(player: Column) -> Column:
    """Part before the first ``#``; also the display name."""
    return F.substring_index(player, "#", 1)


def player_tag(player: Column) -> Column:
    """Part after the first ``#``; NULL when there is none."""
    return F.get(F.split(player, "#", 2), 1)


def own_row(source: Column, name: Column, tag: Column) -> Column:
    """True where the participant is the tracked player."""
    return F.concat(name, tag) == F.replace(source, F.lit("#"), F.lit(""))


def percent_encode(text: Column) -> Column:
    """URL path quoting: ``/`` and ``~`` stay, space becomes ``%20``."""
    encoded = F.url_encode(text)
    for found, wanted in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        encoded = F.replace(encoded, F.lit(found), F.lit(wanted))
    return encoded


def player_link(player: Column) -> Column:
    return F.format_string(PLAYER_LINK, percent_encode(player))


def normalised_key(name: Column) -> Column:
    """Case-free key without blanks, underscores and hyphens."""
    return F.lower(F.regexp_replace(name, r"(?U)[\s\x1c-\x1f_\-]+", ""))


def join_meta(match_id: Column, champion: Column) -> Column:
    """``match-_-champion``; NULL when either side is."""
    return F.concat(match_id.cast("string"), F.lit(META_SEPARATOR), champion.cast("string"))


def meta_match(meta: Column) -> Column:
    first = F.get(F.split(meta, META_SEPARATOR, 2), 0)
    return F.coalesce(F.nullif(first, F.lit("")), F.lit(UNKNOWN_MATCH))


def meta_champion(meta: Column) -> Column:
    second = F.get(F.split(meta, META_SEPARATOR, 2), 1)
    return F.coalesce(F.nullif(second, F.lit("")), F.lit(UNKNOWN_CHAMPION))


def match_link(match_id: Column, pattern: str = MATCH_LINK) -> Column:
    """Link whose target is the id without its region prefix."""
    number = F.regexp_replace(match_id, "^" + MATCH_ID_PREFIX, "")
    return F.format_string(pattern, number, match_id)


def template_parts(template: Column) -> Column:
    """Template cut before every ``{`` and after every ``}``."""
    return F.split(template, r"(?=\{)|(?<=\})")


def fill_template(parts: Column, values: dict[str, Column]) -> Column:
    """Put values into the cut template, all at once.

    Inserted text is never searched again, so a player called ``{value}`` is safe.
    """

    def fill(part: Column) -> Column:
        filled = part
        for name, value in values.items():
            filled = F.when(part == "{" + name + "}", value).otherwise(filled)
        return filled

    return F.array_join(F.transform(parts, fill), "")


def has_value(value: Column, kind: T.DataType) -> Column:
    """False for NULL, zero, NaN, false, the empty text and the text ``0``."""
    if isinstance(kind, T.StringType):
        return value.isNotNull() & ~value.isin("", "0")
    if isinstance(kind, T.BooleanType):
        return F.coalesce(value, F.lit(False))
    present = value.isNotNull() & (value != 0)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        present = present & ~F.isnan(value)
    return present


def value_text(value: Column, kind: T.DataType) -> Column:
    """Number as shown in a message: whole floats without a fraction, no exponent."""
    if isinstance(kind, T.BooleanType):
        return F.initcap(value.cast("string"))
    if not isinstance(kind, (T.FloatType, T.DoubleType)):
        return value.cast("string")
    value = value.cast("double")
    size = F.abs(value)
    plain = F.rtrim(value.try_cast("decimal(38, 20)").cast("string"), F.lit("0"))
    tiny = F.regexp_replace(
        F.regexp_replace(F.lower(value.cast("string")), r"\.0e", "e"), r"e-(\d)$", "e-0$1"
    )
    return (
        F.when(size == float("inf"), F.when(value > 0, "inf").otherwise("-inf"))
        .when(value == F.rint(value), value.try_cast("decimal(38, 0)").cast("string"))
        .when(size >= 1e-4, plain)
        .otherwise(tiny)
    )
