"""Landed match documents and the participant table."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..fixed_values import META_COLUMNS
from ..functions.values import parse_document, struct_to_map
from ..schemas import MATCH, RAW, quoted

CORRUPT = "_corrupt_record"

# Values of JSON fields that are whole numbers in another dress: 5.0, and "7" without leading zeros.
DRIFTED_NUMBERS = (
    (r'("\s*:\s*-?\d+)\.0+(?=\s*[,}\]])', "$1"),
    (r'("\s*:\s*)"(-?(?:0|[1-9]\d{0,17}))"(?=\s*[,}\]])', "$1$2"),
)

# What landing adds to a document, as folder levels or (the player) as a field.
# Declared types keep a player called "007" a text.
LANDING_LEVELS = T.StructType(
    [
        T.StructField("load_date", T.DateType()),
        T.StructField("source_nickname", T.StringType()),
    ]
)


def match_schema(levels: T.StructType = LANDING_LEVELS) -> T.StructType:
    fields = MATCH.fields + [T.StructField(CORRUPT, T.StringType())] + levels.fields
    return T.StructType(fields)


def read_matches(
    spark: SparkSession, paths, *, one_per_file: bool = False, levels=LANDING_LEVELS
) -> DataFrame:
    """Match documents under ``load_date=…`` folders.

    The player is a further folder level ``source_nickname=…`` or a field of the
    document. One document per line, or one per file. Text that is no document
    is kept in ``_corrupt_record``.
    """
    return mended(
        spark.read.schema(match_schema(levels))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", one_per_file)
        .json(paths)
    )


def mended(documents: DataFrame) -> DataFrame:
    """Documents that one value of another type spoiled, read again with whole numbers as such.

    ``5.0`` and ``"7"`` in the place of a whole number are that number. Only texts that the first
    reading put aside are touched. What still doesn't fit stays in ``_corrupt_record``.
    """
    text = F.col(CORRUPT)
    for drifted, whole in DRIFTED_NUMBERS:
        text = F.regexp_replace(text, drifted, whole)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    schema = T.StructType(MATCH.fields + [T.StructField(CORRUPT, T.StringType())])
    again = documents.withColumn("__again", F.from_json(text, schema, options))
    fits = F.col("__again").isNotNull() & F.col(f"__again.{CORRUPT}").isNull()
    fits = fits & (F.col("__again.metadata").isNotNull() | F.col("__again.info").isNotNull())
    parts = {
        name: F.when(fits, F.col(f"__again.{name}")).otherwise(F.col(name))
        for name in MATCH.fieldNames()
    }
    parts[CORRUPT] = F.when(~F.coalesce(fits, F.lit(False)), F.col(CORRUPT))
    return again.withColumns(parts).drop("__again")


def parse_matches(df: DataFrame, text: str = "text") -> DataFrame:
    """Documents held as JSON text in a column; other columns are kept.

    Generating the parsed struct as a row keeps later filters behind it, so a
    text is parsed once and not again for every filtered field. Text that gave
    no part of a document is kept in ``_corrupt_record``.
    """
    document = F.inline(F.array(parse_document(F.col(quoted(text)), MATCH)))
    nothing = F.col("metadata").isNull() & F.col("info").isNull()
    corrupt = F.when(nothing, F.col(quoted(text)))
    return df.select("*", document).withColumn(CORRUPT, corrupt).drop(text)


def _has_meta() -> Column:
    complete = F.col("metadata").isNotNull() & F.col("info").isNotNull()
    for name, _ in META_COLUMNS:
        complete = complete & F.col(name).isNotNull()
    return complete


def _complete(documents: DataFrame) -> Column:
    if CORRUPT not in documents.columns:
        return _has_meta()
    return _has_meta() & F.col(CORRUPT).isNull()


def valid_matches(documents: DataFrame) -> DataFrame:
    """Documents that have both parts and all six meta values, and no value that doesn't fit.

    A meta value that is an explicit null counts as missing.
    """
    return documents.where(_complete(documents))


def rejected_matches(documents: DataFrame) -> DataFrame:
    """Exactly the documents :func:`valid_matches` leaves out."""
    return documents.where(~F.coalesce(_complete(documents), F.lit(False)))


def read_participants(spark: SparkSession, path: str, schema: T.StructType = RAW) -> DataFrame:
    """The participant table; the fixed schema spares footer reads for inference."""
    return spark.read.schema(schema).parquet(path)


def days_of(documents: DataFrame) -> list[dt.date]:
    """The days that ``documents`` are of: as many values reach the driver as there are days."""
    days = documents.select("load_date").where("load_date is not null").distinct()
    return sorted(row["load_date"] for row in days.collect())


def landed_matches(spark: SparkSession, path: str, days: list[dt.date]) -> DataFrame:
    """Player and match of the table's rows on exactly these days: two columns of those folders.

    Listing the days, not a first and a last one, keeps one wild date from opening all folders between.
    """
    schema = T.StructType(
        [RAW["source_nickname"], RAW["metadata.matchId"], T.StructField("load_date", T.DateType())]
    )
    try:
        rows = spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], schema)
    return rows.where(F.col("load_date").isin(days)).select("source_nickname", "`metadata.matchId`")


def create_participant_table(
    spark: SparkSession, table: str, location: str, partition_by=("load_date",)
) -> None:
    """Catalog table of the participant schema, partitioned, at ``location``."""
    columns = RAW.fields + [
        T.StructField("load_date", T.DateType()),
        T.StructField("player_key", T.StringType()),
    ]
    ddl = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in columns)
    levels = ", ".join(quoted(name) for name in partition_by)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet "
        f"PARTITIONED BY ({levels}) LOCATION '{location}'"
    )


def conform_schema(df: DataFrame, schema: T.StructType = RAW) -> DataFrame:
    """Give rows of a schema-less writer the fixed schema.

    Missing columns become NULL, integers that drifted to double come back,
    structs become maps; columns outside the schema are dropped.
    """
    landed = {field.name.lower(): field for field in df.schema.fields}
    columns = []
    for field in schema.fields:
        found = landed.get(field.name.lower())
        if found is None:
            value = F.lit(None).cast(field.dataType)
        elif found.dataType == field.dataType:
            value = F.col(quoted(found.name))
        elif isinstance(field.dataType, T.MapType) and isinstance(found.dataType, T.StructType):
            value = struct_to_map(df, found.name, field.dataType.valueType.simpleString())
        elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            value = F.from_json(F.to_json(F.col(quoted(found.name))), field.dataType)
        else:
            value = F.col(quoted(found.name)).try_cast(field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def drop_duplicate_columns(df: DataFrame) -> DataFrame:
    """Keep the first of columns that share a name."""
    positions = [f"_c{i}" for i in range(len(df.columns))]
    first = {}
    for position, name in zip(positions, df.columns):
        first.setdefault(name, position)
    return df.toDF(*positions).select(*[F.col(p).alias(n) for n, p in first.items()])


def select_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Projected scan by exact names, dots included."""
    return df.select(*[F.col(quoted(name)) for name in columns])
