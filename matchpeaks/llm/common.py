"""Reading tables, per-row Arrow maps, and the shared folder for stored intermediates."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from matchpeaks.session import scratch_dir

#: What counts as white space between words: space, tab, line feed, vertical tab, form feed, return.
SPACES = " \t\n\x0b\x0c\r"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, wherever they run; once for each application."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
        context.addPyFile(archive)
        _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back: a lost executor costs no recomputation."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(df: DataFrame, key: str = "doc_id", text: str = "text", also: dict[str, Column] | None = None) -> DataFrame:
    """Only the columns an operator needs, under fixed names, so that no other column can clash."""
    ship(df.sparkSession)
    more = [column.alias(name) for name, column in (also or {}).items()]
    return df.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), *more)


ARROW = {
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "string": pa.string(),
    "boolean": pa.bool_(),
    "binary": pa.binary(),
    "array<int>": pa.list_(pa.int32()),
    "array<bigint>": pa.list_(pa.int64()),
    "array<double>": pa.list_(pa.float64()),
    "array<string>": pa.list_(pa.string()),
}


def arrow_schema(schema: str) -> pa.Schema:
    """The Arrow schema of a flat "name type, name type" string; workers have no session to ask."""
    return pa.schema([(name, ARROW[kind]) for name, kind in map(str.split, schema.split(", "))])


def pairs(batches: Iterator[pa.RecordBatch], step: int = 256) -> Iterator[tuple]:
    """The values of each row, doc_id and text first, a few rows at a time as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            yield from zip(*(column.to_pylist() for column in batch.slice(at, step).columns))


def map_texts(df: DataFrame, row: Callable[..., Sequence], schema: str, setup: Callable | None = None, carried: int = 0) -> DataFrame:
    """One output row for each (doc_id, text).

    ``setup`` runs once in each task and its result is passed on to ``row``; the last ``carried``
    columns are put behind what ``row`` returns.
    """
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = (setup(),) if setup else ()
        rows: list[Sequence] = []
        for doc_id, text, *rest in pairs(batches):
            rows.append((*row(doc_id, text, *rest[: len(rest) - carried], *given), *rest[len(rest) - carried :]))
            if len(rows) == 2048:
                yield as_batch(rows, out)
                rows = []
        if rows:
            yield as_batch(rows, out)

    return df.mapInArrow(run, schema)


def as_batch(rows: Sequence[Sequence], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def add_columns(df: DataFrame, row: Callable[[str], Sequence], schema: str, text: str = "text", setup: Callable | None = None) -> tuple[DataFrame, dict[str, str]]:
    """Every row with all its columns and what ``row`` makes of its text; and the new columns' names.

    The rows stay where they are: no join, whatever the ids.
    """
    ship(df.sparkSession)
    made = arrow_schema(schema)
    names = {f.name: fresh(df, f"{f.name}_made") for f in made}
    new_fields = [StructField(names[f.name], f.dataType) for f in StructType.fromDDL(schema)]
    out = StructType([*df.schema.fields, *new_fields])
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = (setup(),) if setup else ()
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                rows = [row(x or "", *given) for x in part.column(at).to_pylist()]
                new = [pa.array(c, type=f.type) for c, f in zip(zip(*rows), made)]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], [*part.schema.names, *names.values()])

    return df.mapInArrow(run, out), names
