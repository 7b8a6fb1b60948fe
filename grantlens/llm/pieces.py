"""Encoding and decoding with a SentencePiece vocabulary, as a max-plus parallel scan.

An encoding is the segmentation of a text into pieces with the largest sum of scores.  A piece that
no vocabulary has is a character spelt in bytes.  Texts are cut into chunks at fixed
places, wherever those fall.  The state at a cut is how far the piece across it reaches
into the next chunk, so a chunk is a matrix: entry (a, b) is the best score from a text
covered up to its character ``a`` to one covered ``b`` characters past its end.  Matrices are combined
by the max-plus product, which is associative: blocks of chunks of a document in
parallel, then the blocks, then back into the blocks.  That fixes the state at every cut, and each
chunk is segmented by itself, wherever it is.

Within a chunk many places are passed by every path, because no piece has the two
characters beside them in a row.  What lies between two such places, a word as a rule, is
segmented once and kept.

The scores are those of the vocabulary file.  For a unigram vocabulary the result is the library's own; for a
vocabulary of merges, whose scores are ranks, it is the segmentation with the best ranks, which is not
always the one that merging step by step arrives at.
"""

from __future__ import annotations

import itertools
import re
from array import array
from collections import ChainMap
from collections.abc import Iterator

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from sentencepiece import SentencePieceProcessor

from grantlens.llm.workers import Lazy
from grantlens.session import staged

SPACE = "▁"
# Marks what goes on without a space.
_INSIDE = "\x01"
CHUNK = 65_536
BLOCK = 64
# What a character outside the vocabulary costs beyond the worst piece.
UNKNOWN_COST = 10.0
# Words a worker keeps, and the longest it keeps; about 100 MB.
KEPT_WORDS = 300_000
KEPT_LENGTH = 48

Segmented = tuple[float, bytes]


class Vocabulary:
    def __init__(self, path: str):
        model = SentencePieceProcessor(model_file=path)
        numbers = range(model.vocab_size())
        self.bytes = {
            int(model.id_to_piece(i)[3:-1], 16): i for i in numbers if model.is_byte(i)
        }
        self.ids = {
            model.id_to_piece(i): i
            for i in numbers
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        }
        self.scores = {piece: model.get_score(i) for piece, i in self.ids.items()}
        self.unknown = min(self.scores.values()) - UNKNOWN_COST
        self.longest = max(map(len, self.ids))
        # Every beginning of a piece, so that a search ends where no piece goes on.
        beginnings = {piece[:n] for piece in self.ids for n in range(1, len(piece))}
        self.grown = dict.fromkeys(beginnings, -np.inf) | self.scores
        self.inside = {a + b for piece in self.ids for a, b in zip(piece, piece[1:])}
        self.words = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall
        # Words begin with their spaces if no piece has a space after something else.
        self.by_word = not any(pair[1] == SPACE and pair[0] != SPACE for pair in self.inside)
        self.alone = {piece for piece in self.ids if len(piece) == 1}
        self.matches = ahocorasick.Automaton()
        for piece, score in self.scores.items():
            self.matches.add_word(piece, (len(piece), score))
        self.matches.make_automaton()
        # Beside a line end every path passes, and before a stop or comma unless some piece has
        # what stands before it with it.
        apart = not any("\n" in pair for pair in self.inside)
        glued = {pair[0].replace(SPACE, " ") for pair in self.inside if pair[1] in ".,"}
        after_glued = re.escape("".join(sorted(glued | {" "})))
        self.sign_glued = re.compile(f"(?<=[{after_glued}])[.,]").search
        self.plain_words = self.by_word and apart
        self.kept_plain: dict[str, bytes] = {}
        self.kept: dict[str, Segmented] = {}
        self.spelt = {i: piece.replace(SPACE, " ").encode() for piece, i in self.ids.items()}
        self.spelt |= {i: bytes([byte]) for byte, i in self.bytes.items()}

    # ---- segmenting ------------------------------------------------------------------

    def forward(self, text: str, end: int, start: int = 0) -> tuple[list[float], list[int]]:
        """Best score and last piece's start for every end of a path from ``start``.

        Pieces begin before ``end``; they may reach beyond it, into the rest of ``text``.
        """
        far, grown, never = len(text), self.grown, -np.inf
        best, back = [never] * (far + 1), [0] * (far + 1)
        best[start] = 0.0
        for i in range(start, end):
            here = best[i]
            if here == never:
                continue
            score = grown.get(text[i])
            step = here + (self.unknown if score is None or score == never else score)
            if step > best[i + 1]:
                best[i + 1], back[i + 1] = step, i
            if score is None:
                continue
            for j in range(i + 2, far + 1):
                score = grown.get(text[i:j])
                if score is None:
                    break
                if here + score > best[j]:
                    best[j], back[j] = here + score, i
        return best, back

    def best_path(self, text: str) -> tuple[float, list[int]]:
        """Score and piece starts of a whole text, like ``forward``."""
        if not self.alone.issuperset(text):
            best, back = self.forward(text, len(text))
            return best[-1], back
        # Every character is a piece, so every end has a match; the longest come first.
        best, back = [0.0] + [-np.inf] * len(text), [0] * (len(text) + 1)
        for last, (size, score) in self.matches.iter(text):
            start = last + 1 - size
            score += best[start]
            if score > best[last + 1]:
                best[last + 1], back[last + 1] = score, start
        return best[-1], back

    def traced(self, text: str, back: list[int], start: int, stop: int) -> bytes:
        """Ids of the path from ``start`` to ``stop``."""
        parts: list[list[int]] = []
        while stop > start:
            piece = text[back[stop] : stop]
            known = self.ids.get(piece)
            parts.append([known] if known is not None else [self.bytes[b] for b in piece.encode()])
            stop = back[stop]
        return array("I", [i for part in reversed(parts) for i in part]).tobytes()

    def is_cut(self, text: str, at: int) -> bool:
        """Whether every path passes between two characters."""
        return text[at - 1 : at + 1] not in self.inside

    def word(self, text: str) -> Segmented:
        found = self.kept.get(text)
        if found is None:
            if len(text) > 1 and text[-1] in ".,:;!?" and self.is_cut(text, len(text) - 1):
                head, tail = self.word(text[:-1]), self.word(text[-1])
                found = head[0] + tail[0], head[1] + tail[1]
            else:
                score, back = self.best_path(text)
                found = score, self.traced(text, back, 0, len(text))
            if len(text) <= KEPT_LENGTH:
                if len(self.kept) >= KEPT_WORDS:
                    self.kept.clear()
                self.kept[text] = found
        return found

    def stretch(self, text: str) -> Segmented:
        """A stretch between two places that every path passes."""
        kept, word = self.kept, self.word
        found = [kept.get(w) or word(w) for w in (self.words(text) if self.by_word else [text])]
        return sum(score for score, _ in found), b"".join(ids for _, ids in found)

    def whole(self, text: str) -> bytes:
        """Ids of a text, the same as those of ``stretch``, by plain splitting where its signs allow."""
        if not text:
            return b""
        if (
            not self.plain_words
            or text[0] in "., \n"
            or "  " in text
            or _INSIDE in text
            or SPACE in text
            or self.sign_glued(text)
        ):
            return self.stretch(SPACE + text.replace(" ", SPACE))[1]
        marked = text.replace(".", f" {_INSIDE}.").replace(",", f" {_INSIDE},")
        tokens = marked.replace("\n", f" {_INSIDE}\n {_INSIDE}").split(" ")
        kept, distinct = self.kept_plain, set(tokens)
        new = distinct.difference(kept)
        if len(kept) + len(new) > KEPT_WORDS:
            kept.clear()
            new = distinct
        long = {}
        for token in new:
            piece = token[1:] if token.startswith(_INSIDE) else SPACE + token
            _, back = self.best_path(piece)
            (kept if len(token) <= KEPT_LENGTH else long)[token] = self.traced(piece, back, 0, len(piece))
        return b"".join(map((ChainMap(long, kept) if long else kept).__getitem__, tokens))

    # ---- chunks ----------------------------------------------------------------------

    def cuts(self, text: str, size: int) -> tuple[int, int] | None:
        """The first and the last place in a chunk that every path passes, whatever its state."""
        low = self.longest - 1
        first = next((i for i in range(low, size) if i and self.is_cut(text, i)), None)
        if first is None:
            return None
        return first, next(i for i in range(size - 1, first - 1, -1) if self.is_cut(text, i))

    def matrix(self, text: str, size: int) -> np.ndarray:
        """Max-plus matrix of a chunk: ``size`` characters and those just after them."""
        states, low = self.longest, -np.inf
        out = np.full((states, states), low)
        cuts = self.cuts(text, size)
        if cuts is None:
            for a in range(min(states, len(text) + 1)):
                if a >= size:
                    out[a, a - size] = 0.0
                else:
                    best, _ = self.forward(text, size, a)
                    reached = best[size : size + states]
                    out[a, : len(reached)] = reached
            return out
        first, last = cuts
        heads = [self.forward(text[:first], first, a)[0][first] for a in range(min(states, first + 1))]
        tail, _ = self.forward(text[last:], size - last)
        reached = np.array(tail[size - last : size - last + states])
        middle = self.stretch(text[first:last])[0]
        out[: len(heads), : len(reached)] = np.add.outer(heads, reached) + middle
        return out

    def segment(self, text: str, size: int, entry: int, leave: int) -> bytes:
        """Ids of a chunk whose states are known."""
        stop = size + leave
        if entry == 0 and leave == 0 and len(text) == size:
            return self.stretch(text)[1]
        if entry >= size:
            return b""
        cuts = self.cuts(text, size)
        if cuts is None:
            _, back = self.forward(text[:stop], size, entry)
            return self.traced(text, back, entry, stop)
        first, last = cuts
        _, head = self.forward(text[:first], first, entry)
        rest = text[last:stop]
        _, tail = self.forward(rest, size - last)
        return (
            self.traced(text, head, entry, first)
            + self.stretch(text[first:last])[1]
            + self.traced(rest, tail, 0, len(rest))
        )

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.spelt.__getitem__, ids.tolist())).decode("utf-8", "replace")

    def text(self, chunk: int, ids: bytes) -> str:
        """Text of a chunk, without the space before the first."""
        text = self.decode(np.frombuffer(ids, np.uint32))
        return text[1:] if chunk == 0 else text


def vocabulary(path: str | None = None) -> Lazy:
    """The vocabulary that workers use; the file has to be at that path on each of them."""
    return Lazy(Vocabulary, path or public_tokenizers.path("piece_bpe_32k.model"))


# ---- max-plus scan ---------------------------------------------------------------------


def product(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left[:, :, None] + right[None, :, :]).max(axis=1)


def combined(matrices: list[np.ndarray]) -> np.ndarray:
    """Product of all matrices, taken pairwise as a tree."""
    while len(matrices) > 1:
        pairs = [product(a, b) for a, b in zip(matrices[::2], matrices[1::2])]
        matrices = pairs + matrices[len(matrices) // 2 * 2 :]
    return matrices[0]


def states_between(matrices: list[np.ndarray], entry: int, leave: int) -> list[int]:
    """States before, between and after the matrices on a best path from ``entry`` to ``leave``."""
    reached = [np.full(len(matrices[0]), -np.inf)]
    reached[0][entry] = 0.0
    for matrix in matrices:
        reached.append((reached[-1][:, None] + matrix).max(axis=0))
    states = [leave]
    for before, matrix in zip(reached[-2::-1], reversed(matrices)):
        states.append(int(np.argmax(before + matrix[:, states[-1]])))
    return states[::-1]


def _square(cell: bytes) -> np.ndarray:
    flat = np.frombuffer(cell, np.float64)
    return flat.reshape(int(len(flat) ** 0.5), -1)


# ---- jobs ------------------------------------------------------------------------------


def _row_keys(task: int, several: int) -> Iterator[int]:
    """Keys of the rows a task reads; ``several`` is 1 for rows of several chunks, else 0."""
    return itertools.count((task << 40) + several, 2)


def _chunk_rows(docs: DataFrame, ahead: int) -> DataFrame:
    """(doc_id, row, chunk, n_chunks, size, body): chunks of normalised texts, with some of what follows.

    Rows are told apart by ``row``, never by their id; the result is to be staged.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = _row_keys(TaskContext.get().partitionId(), 1)
        for batch in batches:
            for row, cell in enumerate(batch.column(1)):
                key = next(keys)
                text = cell.as_py() or ""
                text = SPACE + text.replace(" ", SPACE) if text else ""
                starts = range(0, max(1, len(text)), CHUNK)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array([row] * len(starts), pa.int64())),
                        pa.array([key] * len(starts), pa.int64()),
                        pa.array(range(len(starts)), pa.int64()),
                        pa.array([len(starts)] * len(starts), pa.int64()),
                        pa.array([len(text[s : s + CHUNK]) for s in starts], pa.int64()),
                        pa.array([text[s : s + CHUNK + ahead] for s in starts], pa.string()),
                    ],
                    ["doc_id", "row", "chunk", "n_chunks", "size", "body"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(cut, f"doc_id {kind}, row long, chunk long, n_chunks long, size long, body string")


def _entry_states(chunks: DataFrame, words: Lazy) -> DataFrame:
    """(row, chunk, entry, leave) of documents of several chunks."""

    def matrices(batches):
        for batch in batches:
            cells = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            made = [words().matrix(body, size).tobytes() for size, body in cells]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(made, pa.binary())], ["row", "chunk", "matrix"]
            )

    def block_product(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("chunk")
        whole = combined([_square(cell) for cell in rows["matrix"].to_pylist()])
        return rows.slice(0, 1).select(["row", "block"]).append_column(
            "matrix", pa.array([whole.tobytes()], pa.binary())
        )

    def block_states(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("block")
        states = states_between([_square(cell) for cell in rows["matrix"].to_pylist()], 0, 0)
        found = rows.select(["row", "block"])
        found = found.append_column("from", pa.array(states[:-1], pa.int64()))
        return found.append_column("to", pa.array(states[1:], pa.int64()))

    def chunk_states(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("chunk")
        states = states_between(
            [_square(cell) for cell in rows["matrix"].to_pylist()],
            rows["from"][0].as_py(),
            rows["to"][0].as_py(),
        )
        found = rows.select(["row", "chunk"])
        found = found.append_column("entry", pa.array(states[:-1], pa.int64()))
        return found.append_column("leave", pa.array(states[1:], pa.int64()))

    made = staged(
        chunks.select("row", "chunk", "size", "body")
        .mapInArrow(matrices, "row long, chunk long, matrix binary")
        .withColumn("block", F.floor(F.col("chunk") / BLOCK)),
        "chunk-matrices",
    )
    # A text of 2 GB, the most a row can hold, has 2,048 blocks of 64 chunks.
    products = made.groupBy("row", "block").applyInArrow(
        block_product, "row long, block long, matrix binary"
    )
    blocks = products.groupBy("row").applyInArrow(
        block_states, "row long, block long, `from` long, `to` long"
    )
    return (
        made.join(blocks, ["row", "block"])
        .groupBy("row", "block")
        .applyInArrow(chunk_states, "row long, chunk long, entry long, leave long")
    )


def _encoded_schema(kind: str, with_text: bool) -> str:
    return f"doc_id {kind}, chunk long, n_chunks long, ids binary, row long" + ", text string" * with_text


def encode(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    words: Lazy | None = None,
    with_text: bool = False,
) -> DataFrame:
    """One row per chunk: doc_id, chunk, n_chunks, ids (little-endian unsigned 32-bit numbers), row.

    The ids of a document are those of its chunks in order; texts of up to ``CHUNK`` - 1
    characters are one chunk.  A space is put before a text and taken off again by decoding; NULL and empty
    texts are one chunk without ids.  ``with_text`` adds what the ids decode to.  ``row`` is
    one number per row of ``docs``, so that rows with a NULL id and rows that repeat an id are encoded
    each by itself, however long; it says nothing else and can differ from run to run.  An empty
    table gives an empty result; other columns are not read.
    """
    words = words or vocabulary()
    plain = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    ahead = words().longest - 1
    kind = plain.schema["doc_id"].dataType.simpleString()
    schema = _encoded_schema(kind, with_text)
    long_text = F.coalesce(F.length("text"), F.lit(0)) >= CHUNK
    several = staged(
        _chunk_rows(plain.where(long_text), ahead), "chunks"
    )
    placed = several.join(_entry_states(several, words), ["row", "chunk"])

    def result(keys, rows, chunks, counts, ids):
        columns = [keys, chunks, counts, pa.array(ids, pa.binary()), rows]
        if with_text:
            numbers = pa.array(chunks).to_pylist()
            columns.append(pa.array(map(words().text, numbers, ids), pa.string()))
        return pa.RecordBatch.from_arrays(
            columns, ["doc_id", "chunk", "n_chunks", "ids", "row", "text"][: len(columns)]
        )

    def whole(batches):
        """(doc_id, text) -> rows of one chunk."""
        keys = _row_keys(TaskContext.get().partitionId(), 0)
        for batch in batches:
            texts = [cell.as_py() or "" for cell in batch.column(1)]
            ids = list(map(words().whole, texts))
            n = len(ids)
            rows = pa.array(itertools.islice(keys, n), pa.int64())
            yield result(batch.column(0), rows, pa.array([0] * n, pa.int64()), pa.array([1] * n, pa.int64()), ids)

    def segment(batches):
        """(doc_id, row, chunk, n_chunks, size, body, entry, leave) -> rows of chunks."""
        for batch in batches:
            cells = zip(*[column.to_pylist() for column in batch.columns[4:]])
            ids = [words().segment(body, size, a, b) for size, body, a, b in cells]
            yield result(*batch.columns[:4], ids)

    return (
        plain.where(~long_text)
        .mapInArrow(whole, schema)
        .unionByName(
            placed.select(*several.columns, "entry", "leave").mapInArrow(segment, schema)
        )
    )


def decode_beside(encoded: DataFrame, words: Lazy | None = None) -> DataFrame:
    """The rows of ``encode`` with ``text`` beside their ids."""
    words = words or vocabulary()

    def spell(batches):
        for batch in batches:
            texts = map(words().text, batch.column(1).to_pylist(), batch.column(3).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "text"]
            )

    kind = encoded.schema["doc_id"].dataType.simpleString()
    rows = encoded.select("doc_id", "chunk", "n_chunks", "ids", "row")
    return rows.mapInArrow(spell, _encoded_schema(kind, True))


def decode(encoded: DataFrame, words: Lazy | None = None) -> DataFrame:
    """(doc_id, text) of every encoded row: texts put together from their chunks; NULL texts come back empty."""
    parts = decode_beside(encoded, words).groupBy("row", "doc_id").agg(
        F.sort_array(F.collect_list(F.struct("chunk", "text"))).alias("parts")
    )
    return parts.select("doc_id", F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"))
