"""File report as a stream: every file of a folder is reported once, as it comes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from grantlens.plans.scoring import FILE_REPORT, file_report, with_headings
from grantlens.sources.lexicon import Lexicon
from grantlens.sources.sinks import export_csv
from grantlens.sources.tables import stream_text_files


def report_batches(lexicon: Lexicon, out: str) -> Callable[[DataFrame, int], None]:
    """Function for ``foreachBatch`` that writes the report of each batch as CSV with headings.

    A batch has a folder of its own, so one that is run again after a failure replaces what it wrote.
    """

    def report(batch: DataFrame, batch_id: int) -> None:
        export_csv(with_headings(file_report(batch, lexicon)), f"{out}/batch={batch_id}")

    return report


def report_new_files(
    spark: SparkSession, folder: str, lexicon: Lexicon, out: str, state: str, **reading
) -> int:
    """Report the files that no earlier run with this ``state`` folder has reported; how many batches that took.

    Files are taken in batches of ``files_per_batch``, ``state`` holds which files are done.  Without
    new files nothing is written.  ``reading`` goes to ``stream_text_files``.
    """
    query = (
        stream_text_files(spark, folder, **reading)
        .writeStream.foreachBatch(report_batches(lexicon, out))
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(progress["numInputRows"] > 0 for progress in query.recentProgress)


def read_reports(spark: SparkSession, out: str, sample: DataFrame) -> DataFrame:
    """All reported rows, read back under the names and types of ``sample``, a report of any files."""
    return (
        spark.read.schema(sample.schema)
        .option("header", True)
        .option("enforceSchema", True)
        .option("recursiveFileLookup", True)
        .csv(out)
        .select(*FILE_REPORT)
    )
