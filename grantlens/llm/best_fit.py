"""Packed token-id matrices: best fit decreasing, with a segment tree over capacities.

Documents are encoded, an end id last, and cut into whole rows as long as they fill one;
what is left of each is packed with others.  A task packs blocks of a bounded
number of ids: pieces go by length, the longest first, each into the row with the least room that
still holds it.  A segment tree over the possible rooms (0 to the length of a row) finds that
row in as many steps as the length has bits.

A packed row has its ids, the ends of its segments (cumulative, for attention that
must not cross documents) and positions that start again with each segment.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from grantlens.llm.tokens import word_encoder
from grantlens.llm.workers import Lazy

ROW = 2048
END_ID = 2
PAD_ID = 0
# Ids that a task holds before it packs them: 16 MB.
BLOCK_IDS = 4_000_000
NUMBERS_PER_TASK = 1 << 40


class Rooms:
    """Open rows by the room they have left."""

    def __init__(self, most: int):
        self.width = 1 << most.bit_length()
        self.tree = [0] * (2 * self.width)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def _count(self, room: int, by: int) -> None:
        at = room + self.width
        while at:
            self.tree[at] += by
            at >>= 1

    def put(self, row: int, room: int) -> None:
        self.rows[room].append(row)
        self._count(room, 1)

    def least(self, length: int) -> int | None:
        """The smallest room of ``length`` or more that some row has."""
        at = length + self.width
        if not self.tree[at]:
            # Up until a right neighbour holds a row, then down to its first one.
            while at > 1 and (at & 1 or not self.tree[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.width:
                at = 2 * at if self.tree[2 * at] else 2 * at + 1
        return at - self.width

    def take(self, room: int) -> int:
        self._count(room, -1)
        return self.rows[room].pop()


def best_fit_decreasing(lengths: list[int], row: int) -> list[list[int]]:
    """Rows of indices of ``lengths``, none longer than ``row``; each row fills in the order given."""
    rooms, packed = Rooms(row), []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        room = rooms.least(lengths[i])
        if room is None:
            packed.append([])
            number, room = len(packed) - 1, row
        else:
            number = rooms.take(room)
        packed[number].append(i)
        if room > lengths[i]:
            rooms.put(number, room - lengths[i])
    return packed


def _packed_batch(pieces: list, number: int, row: int, pad_id: int, id_type) -> pa.RecordBatch:
    """Rows of (doc_id, start, ids) pieces, numbered from ``number``."""
    columns: list[list] = [[] for _ in range(7)]
    for offset, members in enumerate(best_fit_decreasing([len(ids) for *_, ids in pieces], row)):
        lengths = [len(pieces[i][2]) for i in members]
        ids = np.full(row, pad_id, "<u4")
        used = sum(lengths)
        ids[:used] = np.concatenate([pieces[i][2] for i in members])
        positions = np.zeros(row, "<u4")
        positions[:used] = np.concatenate([np.arange(n) for n in lengths])
        for column, value in zip(
            columns,
            (
                number + offset,
                used,
                ids.tobytes(),
                positions.tobytes(),
                np.cumsum(lengths).tolist(),
                [pieces[i][0] for i in members],
                [pieces[i][1] for i in members],
            ),
        ):
            column.append(value)
    kinds = (
        pa.int64(), pa.int64(), pa.binary(), pa.binary(),
        pa.list_(pa.int64()), pa.list_(id_type), pa.list_(pa.int64()),
    )
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(columns, kinds)],
        ["row_id", "n_ids", "ids", "positions", "segment_ends", "doc_ids", "starts"],
    )


def pack_rows(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    encoder: Lazy | None = None,
    row: int = ROW,
    end_id: int = END_ID,
    pad_id: int = PAD_ID,
) -> DataFrame:
    """One row per packed row: row_id, n_ids, ids, positions, segment_ends, doc_ids, starts.

    ``ids`` and ``positions`` are ``row`` little-endian unsigned 32-bit numbers, padded with ``pad_id``
    and 0 after ``n_ids``; segment k belongs to ``doc_ids[k]`` and begins at its id ``starts[k]``.
    Every id of every document is in exactly one segment.  NULL text counts as
    empty: the end id alone.  Repeated rows are packed as often as they come, NULL ids are carried
    along, equal lengths go in order of the table.  An empty table gives an empty result.
    """
    encoder = encoder or word_encoder()
    kind = docs.schema[id].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, number = encoder().ids, TaskContext.get().partitionId() * NUMBERS_PER_TASK
        pieces, held, id_type = [], 0, None
        for batch in batches:
            id_type = batch.schema.types[0]
            for key, cell in zip(batch.column(0).to_pylist(), batch.column(1)):
                document = np.append(encode(cell.as_py() or ""), np.uint32(end_id)).astype("<u4")
                for start in range(0, len(document), row):
                    pieces.append((key, start, document[start : start + row]))
                held += len(document)
                if held >= BLOCK_IDS:
                    block = _packed_batch(pieces, number, row, pad_id, id_type)
                    yield block
                    number += block.num_rows
                    pieces, held = [], 0
        if pieces:
            yield _packed_batch(pieces, number, row, pad_id, id_type)

    return docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        pack,
        "row_id long, n_ids long, ids binary, positions binary, segment_ends array<long>,"
        f" doc_ids array<{kind}>, starts array<long>",
    )


def write_matrices(packed: DataFrame, path: str) -> None:
    """Packed rows as Parquet; the binaries of a file stack to matrices of ``row`` columns."""
    packed.write.parquet(path)


def row_digests(packed: DataFrame) -> DataFrame:
    """Packed rows with checksums instead of ids and positions."""
    return packed.select(
        "row_id",
        "n_ids",
        F.crc32("ids").alias("ids_crc32"),
        F.crc32("positions").alias("positions_crc32"),
        "segment_ends",
        "doc_ids",
        "starts",
    )
