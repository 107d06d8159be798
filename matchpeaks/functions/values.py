"""Numbers, JSON and maps as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..schemas import quoted


def truncated_ratio(top: Column, bottom: Column) -> Column:
    """Integer quotient; NULL instead of a division by zero."""
    return F.call_function("div", top, F.nullif(bottom, F.lit(0)))


def at_least_one(value: Column) -> Column:
    """``greatest(value, 1)`` that stays NULL for NULL."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(1)))


def count_if_id(id_column: Column, wanted: int, amount: Column) -> Column:
    return F.when(id_column == wanted, amount).otherwise(F.lit(0))


def better_first(value: Column, kind: T.DataType, agg: str) -> Column:
    """Key that sorts the better value first; applying it twice gives the value back."""
    if agg == "min":
        return value
    if isinstance(kind, T.BooleanType):
        return ~value
    if isinstance(kind, T.IntegralType):
        return F.bitwise_not(value)
    if isinstance(kind, T.NumericType):
        return -value
    raise TypeError(f"metrics are numbers or booleans, not {kind.simpleString()}")


def no_nan(value: Column, kind: T.DataType) -> Column:
    """NaN is no result: it neither sets nor guards a record."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(value), value)
    return value


def parse_document(text: Column, schema: T.StructType | str) -> Column:
    """JSON text to a struct; text that is no JSON object gives NULL fields."""
    return F.from_json(text, schema, {"mode": "PERMISSIVE"})


def parse_map(text: Column, value_type: str = "bigint") -> Column:
    return F.from_json(text, f"map<string,{value_type}>")


def map_value(entries: Column, key: str) -> Column:
    """Value of ``key``; NULL when the key is absent."""
    return F.try_element_at(entries, F.lit(key))


def struct_to_map(df: DataFrame, column: str, value_type: str) -> Column:
    """Turn a struct that a schema-less writer inferred back into a map.

    The writer gave every row all keys, so NULL means the key was not there.
    """
    source = quoted(column)
    pairs = [
        part
        for field in df.schema[column].dataType.fields
        for part in (
            F.lit(field.name),
            F.col(f"{source}.{quoted(field.name)}").try_cast(value_type),
        )
    ]
    if not pairs:
        return F.create_map().cast(f"map<string,{value_type}>")
    filled = F.map_filter(F.create_map(*pairs), lambda _, value: value.isNotNull())
    return F.when(F.col(source).isNotNull(), filled)
