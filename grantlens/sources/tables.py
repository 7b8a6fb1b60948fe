"""Input tables: texts, text files, captured pages, SQL tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

# A character pair no text uses, to carry genuine replacement characters past
# the repair of broken bytes.
_KEPT_MARK = "\ufdd0\ufdd1"
_REPLACEMENT = "\ufffd"


def read_table(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Columns of a Parquet table."""
    return spark.read.parquet(path).select(*columns)


def read_text_files(spark: SparkSession, glob: str) -> DataFrame:
    """One row per file: path, whole text, length in characters.

    Bytes that are not UTF-8 are left out.  Files of no bytes at all have no row:
    Spark's file sources skip them.
    """
    return _whole_texts(spark.read.text(glob, wholetext=True))


def stream_text_files(
    spark: SparkSession, folder: str, pattern: str = "*.txt", files_per_batch: int = 10_000
) -> DataFrame:
    """The files of a folder as a stream with the columns of ``read_text_files``; new files come as new rows."""
    options = {"wholetext": True, "pathGlobFilter": pattern, "maxFilesPerTrigger": files_per_batch}
    return _whole_texts(spark.readStream.format("text").options(**options).load(folder))


def _whole_texts(files: DataFrame) -> DataFrame:
    marked = F.replace("value", F.lit(_REPLACEMENT), F.lit(_KEPT_MARK))
    repaired = F.replace(F.make_valid_utf8(marked), F.lit(_REPLACEMENT), F.lit(""))
    text = F.replace(repaired, F.lit(_KEPT_MARK), F.lit(_REPLACEMENT))
    return files.select(
        F.col("_metadata.file_path").alias("path"), text.alias("text")
    ).withColumn("n_chars", F.length("text"))


def read_sql_table(
    spark: SparkSession,
    url: str,
    schema: str,
    table: str,
    columns: Sequence[str],
    partition_column: str,
    bounds: tuple[int, int],
    partitions: int,
    **options: str,
) -> DataFrame:
    """Columns of a table in an SQL database, read in parallel ranges of a key."""
    return (
        spark.read.format("jdbc")
        .options(**sql_options(url, schema, table, partition_column, bounds, partitions))
        .options(**options)
        .load()
        .select(*columns)
    )


def sql_options(
    url: str,
    schema: str,
    table: str,
    partition_column: str,
    bounds: tuple[int, int],
    partitions: int,
) -> dict[str, str]:
    return {
        "url": url,
        "dbtable": f"{schema}.{table}",
        "partitionColumn": partition_column,
        "lowerBound": str(bounds[0]),
        "upperBound": str(bounds[1]),
        "numPartitions": str(partitions),
        "fetchsize": "10000",
    }
