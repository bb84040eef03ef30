"""Reading, cleaning and writing flow records."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from flowlens.functions.catalog import NUMERIC_COLUMNS, PORT_COLUMNS

# Spellings of a start time that are accepted besides the ISO form.
TIME_PATTERNS = ["yyyy/MM/dd HH:mm:ss[.SSSSSS]", "yyyy/MM/dd HH:mm"]


def read_flows(spark: SparkSession, path, fmt: str = "binetflow", infer: bool = False) -> DataFrame:
    """Read a flow capture (headered CSV) or a parquet table.

    CSV columns stay strings unless ``infer`` is set: one pass over the file, and
    ``clean`` decides what a bad number becomes. Columns are taken from the header.
    """
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt not in ("binetflow", "csv"):
        raise ValueError(f"unknown format: {fmt!r}")
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if infer:
        return reader.option("inferSchema", True).csv(path)
    return reader.csv(path)


def as_timestamp(name: str) -> F.Column:
    text = F.col(name).cast("string")
    return F.coalesce(text.try_cast("timestamp"),
                      *[F.try_to_timestamp(text, F.lit(p)) for p in TIME_PATTERNS])


def as_number(name: str) -> F.Column:
    """Text or number to double; unparsable text and NaN become NULL."""
    value = F.col(name).try_cast("double")
    return F.when(~F.isnan(value), value)


def clean(df: DataFrame) -> DataFrame:
    """Coerce the known columns; absent ones are skipped, unknown ones pass through."""
    columns = []
    for field in df.schema.fields:
        name, kind = field.name, field.dataType
        if name == "StartTime" and not isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            columns.append(as_timestamp(name).alias(name))
        elif name in NUMERIC_COLUMNS or name in PORT_COLUMNS:
            whole = isinstance(kind, T.IntegralType)
            columns.append(F.col(name) if whole else as_number(name).alias(name))
        else:
            columns.append(F.col(f"`{name}`"))
    return df.select(*columns)


def write_flows(df: DataFrame, path: str, partition_by=()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def try_parquet(spark: SparkSession, path: str) -> DataFrame | None:
    """The parquet table, or None when it is absent or empty of files; any other failure is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def read_through(spark: SparkSession, csv: str, parquet: str, fmt: str = "binetflow") -> DataFrame:
    """Cleaned flows from parquet if it is readable, else from CSV, leaving parquet behind."""
    cached = try_parquet(spark, parquet)
    if cached is not None:
        return cached
    write_flows(clean(read_flows(spark, csv, fmt)), parquet)
    return spark.read.parquet(parquet)
