"""Table schemas as Spark types."""

from __future__ import annotations

from pyspark.sql import types as T

from .fixed_values import META_COLUMNS, PARTICIPANT_FIELDS


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_LONG = T.LongType()

PERKS = _struct(
    statPerks=_struct(offense=_LONG, flex=_LONG, defense=_LONG),
    styles=T.ArrayType(
        _struct(
            style=_LONG,
            description=T.StringType(),
            selections=T.ArrayType(_struct(perk=_LONG, var1=_LONG, var2=_LONG, var3=_LONG)),
        )
    ),
)

_KINDS = {
    "bigint": _LONG,
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "map<string,double>": T.MapType(T.StringType(), T.DoubleType()),
    "map<string,bigint>": T.MapType(T.StringType(), _LONG),
    "perks": PERKS,
}


def struct_of(fields: list[tuple[str, str]]) -> T.StructType:
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in fields])


PARTICIPANT = struct_of(PARTICIPANT_FIELDS)

# The nested document: metadata.matchId, info.<five fields>, info.participants[].
MATCH = T.StructType(
    [
        T.StructField(
            root,
            T.StructType(
                [
                    T.StructField(name.split(".")[1], _KINDS[kind])
                    for name, kind in META_COLUMNS
                    if name.startswith(root + ".")
                ]
                + (
                    [T.StructField("participants", T.ArrayType(PARTICIPANT))]
                    if root == "info"
                    else []
                )
            ),
        )
        for root in ("metadata", "info")
    ]
)

# One row per (source_nickname, match, participant), dotted names as landed.
RAW = struct_of(
    META_COLUMNS
    + [(f"participant.{name}", kind) for name, kind in PARTICIPANT_FIELDS]
    + [("source_nickname", "string")]
)

TRIGGER = T.StructType(
    [
        T.StructField("msg_id", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("payload", T.StringType()),
    ]
)

ROSTER = T.StructType(
    [T.StructField("roster_ord", T.IntegerType()), T.StructField("nickname", T.StringType())]
)


def quoted(name: str) -> str:
    """Column reference that keeps dots inside the name."""
    return "`" + name.replace("`", "``") + "`"
