"""Output: CSV export, table replace, table append."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def export_csv(df: DataFrame, path: str) -> None:
    """Folder of CSV parts, each with a header line; replaces what is there."""
    df.write.mode("overwrite").option("header", True).csv(path)


def replace_table(df: DataFrame, path: str) -> None:
    """Drop and rewrite a Parquet table."""
    df.write.mode("overwrite").parquet(path)


def replace_catalog_table(df: DataFrame, name: str) -> None:
    """Drop and rewrite a table of the session catalog."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def table_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table, or no rows of ``schema`` where none has been written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def stamped(df: DataFrame) -> DataFrame:
    """Add the time of scoring."""
    return df.withColumn("created", F.current_timestamp())
