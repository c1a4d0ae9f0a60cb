"""Readers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.sources.records import file_records, is_header, parsed


def string_schema(metadata: Sequence[Mapping] | Sequence[str]) -> T.StructType:
    """All-string schema; column metadata is put in sequence order."""
    if metadata and not isinstance(metadata[0], str):
        ordered = sorted(metadata, key=lambda m: m["column_sequence_number"])
        metadata = [m["column_name"] for m in ordered]
    return T.StructType([T.StructField(name, T.StringType()) for name in metadata])


def read_delimited(
    spark: SparkSession, path, columns: Sequence, sep: str = ",", header: bool = True, multiline: bool = False
) -> DataFrame:
    """Delimited text with the configured columns, all as strings.

    With `multiline` quoted fields may hold line breaks; large files are shared by several tasks all the same.
    """
    if multiline:
        records = file_records(spark, path)
        return parsed((records.filter("not first") if header else records).select("value"), [f.name for f in string_schema(columns)], sep)
    return (
        spark.read.schema(string_schema(columns))
        .options(sep=sep, header=header, enforceSchema=True, quote='"', escape='"')
        .csv(path)
    )


def read_quoted_csv(spark: SparkSession, path) -> DataFrame:
    """CSV with a header, in which a quote inside quotes is doubled."""
    return spark.read.options(header=True, quote='"', escape='"').csv(path)


def read_parquet(
    spark: SparkSession, path, batch: object = None, batch_column: str = "batch_id", row_id: str | None = None
) -> DataFrame:
    """A Parquet table, or one batch of it by partition pruning.

    `row_id` adds the place of each row, its file's hash and its index there, as text: exact copies differ, the id
    is the same however often the table is read, and nothing is numbered or stored for it.
    """
    table = spark.read.parquet(*([path] if isinstance(path, str) else path))
    if row_id:
        place = F.concat(F.md5(F.col("_metadata.file_path")), F.lit(":"), F.col("_metadata.row_index").cast("string"))
        table = table.withColumn(row_id, place)
    return table if batch is None else table.filter(F.col(batch_column) == F.lit(batch))


def read_json(spark: SparkSession, path, schema: T.StructType | str | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema is not None else spark.read).json(path)


def read_json_ignoring_case(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """JSON lines whose field names match the wanted columns in any case, record by record.

    One scan without schema inference: a record becomes a map of variants, and the first of its fields whose
    lower-cased name fits is cast to the column's type. Absent fields are null; so is every column of a line that is
    no JSON. A line may hold an array of records; blank lines hold none. Names inside structs must fit as they are.
    """
    raw = spark.read.text(path).filter(F.trim("value") != "")
    one, several = F.from_json("value", "map<string,variant>"), F.from_json("value", "array<map<string,variant>>")
    record = F.explode(F.when(F.ltrim("value").startswith("["), several).otherwise(F.array(one)))
    fields = raw.select(record.alias("record")).select(F.map_entries("record").alias("fields"))

    def wanted(field: T.StructField) -> Column:
        fitting = F.filter("fields", lambda f: F.lower(f["key"]) == field.name.lower())
        return F.get(fitting, F.lit(0))["value"].cast(field.dataType).alias(field.name)

    return fields.select(*[wanted(f) for f in schema])


def read_text(spark: SparkSession, path) -> DataFrame:
    return spark.read.text(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    partition: tuple[str, object, object, int] | None = None,
) -> DataFrame:
    """A table or view; `partition` is (column, lower, upper, parts) for a parallel read."""
    if partition is None:
        return spark.read.jdbc(url, table, properties=dict(properties))
    column, lower, upper, parts = partition
    return spark.read.jdbc(
        url, table, column=column, lowerBound=lower, upperBound=upper, numPartitions=parts, properties=dict(properties)
    )


def read_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.table(f"`{database}`.`{table}`")


def literal_frame(spark: SparkSession, rows: Sequence[tuple], schema) -> DataFrame:
    """Small constant rows with a schema or a list of column names."""
    return spark.createDataFrame(list(rows), schema)


def with_file_name(df: DataFrame, name: str = "file_name") -> DataFrame:
    """Add the name of the file each row was read from."""
    return df.select("*", F.col("_metadata.file_name").alias(name))


def read_with_header_repair(spark: SparkSession, paths, columns: Sequence[str], sep: str = ",") -> DataFrame:
    """Delimited files of one feed of which some lack their header line.

    A file whose first line has more than `HEADER_TOLERANCE` fields outside the configured header
    is taken to have none. One scan reads the lines and drops the headers. Feeds with headers of
    their own are read by `records.read_feed`.
    """
    records = file_records(spark, paths, multiline=False)
    kept = records.filter(~(F.col("first") & is_header(F.col("value"), columns, sep)))
    return parsed(kept.select("value"), columns, sep)


def preview(df: DataFrame, n: int = 10, order: Sequence[str] | None = None) -> DataFrame:
    """The first rows, by a key where one is given."""
    return (df.orderBy(*order) if order else df).limit(n)


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))
