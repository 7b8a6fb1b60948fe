"""Packing by powers of two: no padding, and no sequence that crosses documents.

The ids of a document, an end id last, are cut into as many whole sequences as fit,
and the rest into pieces whose lengths are the powers of two of its length in
binary, the longest first.  Every piece is a sequence of its own.  Sequences of one
length form a bucket, from which batches are drawn without padding.

Cutting needs nothing but the document, so nothing is shuffled; buckets become folders
when sequences are written.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from grantlens.llm.tokens import word_encoder
from grantlens.llm.workers import Lazy, tidied

SEQUENCE = 4096
END_ID = 2
# Sequences a task may number; tasks are numbered above that.
NUMBERS_PER_TASK = 1 << 40


def piece_lengths(n: int, longest: int = SEQUENCE) -> list[int]:
    """Lengths of the pieces of a document of ``n`` ids; ``longest`` is a power of two."""
    rest = n % longest
    return [longest] * (n // longest) + [
        1 << bit for bit in reversed(range(rest.bit_length())) if rest >> bit & 1
    ]


@tidied
def _pieces(batches: Iterator[pa.RecordBatch], encoder: Lazy, longest: int, end_id: int):
    encode, number = encoder().ids, TaskContext.get().partitionId() * NUMBERS_PER_TASK
    for batch in batches:
        rows, starts, lengths, totals, ids = [], [], [], [], []
        for row, cell in enumerate(batch.column(1)):
            document = np.append(encode(cell.as_py() or ""), np.uint32(end_id)).astype("<u4")
            start = 0
            for length in piece_lengths(len(document), longest):
                rows.append(row)
                starts.append(start)
                lengths.append(length)
                totals.append(len(document))
                ids.append(document[start : start + length].tobytes())
                start += length
        # Sequences of one length are numbered in a row.
        order = np.argsort(-np.array(lengths, np.int64), kind="stable")
        numbers = np.empty(len(order), np.int64)
        numbers[order] = np.arange(number, number + len(order))
        number += len(order)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(rows, pa.int64())),
                pa.array(starts, pa.int64()),
                pa.array(lengths, pa.int64()),
                pa.array(totals, pa.int64()),
                pa.array(numbers, pa.int64()),
                pa.array(ids, pa.binary()),
            ],
            ["doc_id", "start", "length", "doc_tokens", "sequence_id", "ids"],
        )


def pack(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    encoder: Lazy | None = None,
    longest: int = SEQUENCE,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, ids.

    ``ids`` are little-endian unsigned 32-bit numbers.  A piece fills its sequence, so
    its offset there is 0.  NULL text counts as empty; a document without ids is
    the end id alone.  Repeated rows are packed as often as they come, and NULL ids
    are carried along.  An empty table gives an empty result; other columns are not read.
    """
    if longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")
    encoder = encoder or word_encoder()
    schema = (
        f"doc_id {docs.schema[id].dataType.simpleString()}, start long, length long,"
        " doc_tokens long, sequence_id long, ids binary"
    )

    def pieces(batches):
        return _pieces(batches, encoder, longest, end_id)

    return docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        pieces, schema
    )


def write_buckets(packed: DataFrame, path: str) -> None:
    """Sequences as Parquet, one folder per length: rows of ``length=n`` stack to a matrix of n columns."""
    packed.write.partitionBy("length").parquet(path)


def piece_digests(packed: DataFrame) -> DataFrame:
    """Pieces with a checksum instead of their ids."""
    return packed.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        F.lit(0).cast("long").alias("offset"),
    )
