"""Trip files: CSV with a declared schema (SRC1), inferred CSV (SRC5), file inventory (SNK6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ebbflow.schemas import TRIP_SCHEMA


def read_trips_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Header CSV files (a folder, a glob or a list) read with the declared trip schema.

    PERMISSIVE mode: a malformed timestamp or a short row yields NULLs, which cleaning then drops.
    """
    return (
        spark.read.schema(TRIP_SCHEMA)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


CORRUPT = "_unread"


def read_trips_csv_quarantine(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(trips, quarantine) of header CSV files: the rows that the declared schema can read, and the others as they stand in the file (record, file_name).

    Without this, ``read_trips_csv`` reads what it cannot parse as NULL and cleaning drops it uncounted. Both frames are lazy over the same files.
    """
    schema = StructType([*TRIP_SCHEMA.fields, StructField(CORRUPT, StringType())])
    reader = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    rows = reader.csv(path)
    # every column is asked for, since the parser marks only what it is asked to parse
    parsed = F.length(F.concat_ws("", *[F.col(c).cast("string") for c in TRIP_SCHEMA.fieldNames()])) >= 0
    marked = rows.select("*", F.col("_metadata.file_name").alias("file_name")).where(parsed)
    trips = marked.where(F.col(CORRUPT).isNull()).select(*TRIP_SCHEMA.fieldNames())
    return trips, marked.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("record"), "file_name")


def read_trips_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Exploratory read: header CSV with inferred column types (costs an extra pass over the files)."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def shape_of(df: DataFrame) -> DataFrame:
    """(rows, columns) of a frame as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(len(df.columns)).cast("int").alias("columns")
    )


def file_inventory(df: DataFrame) -> DataFrame:
    """Rows per input file of a file-based DataFrame (file_name, rows)."""
    return df.select(F.col("_metadata.file_name").alias("file_name")).groupBy("file_name").agg(
        F.count(F.lit(1)).alias("rows")
    )


def write_trips_csv(trips: DataFrame, path: str) -> str:
    """Write trips as header CSV in the 13-column layout of the declared schema."""
    cols = []
    for field in TRIP_SCHEMA.fields:
        if field.name in trips.columns:
            cols.append(F.col(field.name).cast(field.dataType).alias(field.name))
        else:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
    (
        trips.select(*cols)
        .write.mode("errorifexists")
        .option("header", True)
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        .csv(path)
    )
    return path
