"""Token counts of whole texts by rank-synchronous merging.

A text falls into pre-tokens: words with the spaces before them, beyond which no piece of the
vocabulary reaches.  The different pre-tokens of a batch lie one after another in flat arrays, cut
once more wherever no piece holds the two characters in a row.  In every round each sequence
applies its own pair of the lowest rank, all sequences at the same time; sequences without a pair
left leave the arrays, and their surviving symbols are counted: one for a piece, as many as it has
bytes for a character that no piece has.

The library merges one pair at a time, the best rank first and of equal ones the first place.  A
sequence applies its pair at all its places from the left, up to the first place that makes a
neighbouring pair of a better rank, so the order is the same.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from sentencepiece import SentencePieceProcessor

from grantlens.llm.workers import Lazy

SPACE = "▁"
LIMIT = 4096
# Characters of texts, and of different words, that are counted together.
TOGETHER = 1_000_000
# Words a worker keeps with their counts, and the longest it keeps; about 30 MB.
KEPT_WORDS = 250_000
KEPT_LENGTH = 32

_NEVER = np.iinfo(np.int32).max
# Each begins with a space, since one is put before a text.
_WORDS = re.compile(" +[^ ]*").findall


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)


class _Table:
    """Hash table of integer keys in arrays; ``missing`` for keys it does not hold."""

    def __init__(self, values: dict[int, int], missing: int):
        self.shift = 62 - max(1, len(values)).bit_length()
        self.keys = np.full(1 << (64 - self.shift), -1, np.int64)
        self.values = np.full(len(self.keys), missing, np.int32)
        self.missing = missing
        slots = self._slots(np.fromiter(values, np.int64, len(values))).tolist()
        for (key, value), slot in zip(values.items(), slots):
            while self.keys[slot] >= 0:
                slot = (slot + 1) % len(self.keys)
            self.keys[slot], self.values[slot] = key, value

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(self.shift)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slots = self._slots(keys)
        out, there = self.values[slots], self.keys[slots]
        # An empty slot ends the search; others go on with the next slot.
        open_ = np.flatnonzero((there != keys) & (there >= 0))
        while len(open_):
            slots[open_] = (slots[open_] + 1) % len(self.keys)
            there = self.keys[slots[open_]]
            out[open_] = self.values[slots[open_]]
            open_ = open_[(there != keys[open_]) & (there >= 0)]
        return out


def _run_of_spaces(ranks: dict[str, int]) -> int | None:
    """How many spaces of a long run become one piece at a time, from the left, if it is always the same number.

    That can be said where pieces of spaces come after all others of several characters: then
    the words beside a run have taken what they take of it before.
    """
    runs = {len(piece) for piece in ranks if piece and not piece.strip(SPACE)}
    last = max((rank for piece, rank in ranks.items() if len(piece) > 1), default=None)
    if len(runs) < 2 or any(ranks[SPACE * n] != last for n in runs if n > 1):
        return None
    most = max(runs)

    def merged(sizes: list[int]) -> list[int]:
        while (at := next((i for i in range(len(sizes) - 1) if sizes[i] + sizes[i + 1] in runs), None)) is not None:
            sizes[at : at + 2] = [sizes[at] + sizes[at + 1]]
        return sizes

    steady = all(merged([1] * (2 * most + n)) == [most, most, *merged([1] * n)] for n in range(most))
    return most if steady else None


class Counter:
    """Counts of a vocabulary of merges whose file the ``sentencepiece`` library reads."""

    def __init__(self, path: str):
        model = SentencePieceProcessor(model_file=path)
        if model.normalize(" Ⅷ  a ") != f"{SPACE * 2}Ⅷ{SPACE * 2}a{SPACE}":
            raise ValueError("the vocabulary normalises texts")
        numbers = range(model.vocab_size())
        if any(model.is_unused(i) for i in numbers):
            raise ValueError("the vocabulary has unused pieces")
        scores = {
            model.id_to_piece(i): model.get_score(i)
            for i in numbers
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
        }
        if any(b == SPACE != a for piece in scores for a, b in zip(piece, piece[1:])):
            raise ValueError("a piece of the vocabulary goes on after a space")
        # The rank of a piece is its place among the scores, the best first.
        order = {score: rank for rank, score in enumerate(sorted(set(scores.values()), reverse=True))}
        ranks = {piece: order[score] for piece, score in scores.items()}
        letters = sorted({letter for piece in scores for letter in piece})
        self.symbols = {symbol: i for i, symbol in enumerate(dict.fromkeys([*letters, *scores]))}
        self.base = len(self.symbols) + 1
        # One number past the symbols stands for every character that no piece has.
        self.unknown = len(self.symbols)
        self.letter = np.full(0x110000, self.unknown, np.int32)
        self.letter[[ord(c) for c in letters]] = [self.symbols[c] for c in letters]
        self.is_piece = np.array([symbol in scores for symbol in self.symbols] + [False])
        pairs, made = {}, {}
        for piece in scores:
            for at in range(1, len(piece)):
                left, right = self.symbols.get(piece[:at]), self.symbols.get(piece[at:])
                if left is not None and right is not None:
                    pairs[left * self.base + right] = ranks[piece]
                    made[left * self.base + right] = self.symbols[piece]
        self.rank, self.made = _Table(pairs, _NEVER), _Table(made, 0)
        self.run = _run_of_spaces(ranks)
        self.inside = _Table(
            {self.symbols[a] * self.base + self.symbols[b]: 1 for piece in scores for a, b in zip(piece, piece[1:])}, 0
        )
        self.kept: dict[str, int] = {}

    # ---- ragged arrays ---------------------------------------------------------------

    def counts(self, words: list[str]) -> np.ndarray:
        """Surviving symbols of each word; words are not empty."""
        lengths = np.array([len(word) for word in words], np.int64)
        points = _points("".join(words))
        symbols = self.letter[points]
        word = np.repeat(np.arange(len(words)), lengths)
        first = np.ones(len(points), bool)
        first[1:] = (word[1:] != word[:-1]) | (self.inside(symbols[:-1].astype(np.int64) * self.base + symbols[1:]) == 0)
        size = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        weight = np.where(self.is_piece[symbols], 1, size)
        begin = np.flatnonzero(first)
        survivors = self._merge(symbols.astype(np.int64), weight, begin)
        out = np.zeros(len(words), np.int64)
        np.add.at(out, word[begin], survivors)
        return out

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return self.rank(left * self.base + right)

    def _merge(self, symbols: np.ndarray, weight: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Total weight of what is left of each sequence; ``begin`` are their first places."""
        out = np.zeros(len(begin), np.int64)
        number = np.arange(len(begin))
        lengths = np.diff(np.append(begin, len(symbols)))
        rank = np.full(len(symbols), _NEVER, np.int32)
        rank[:-1] = self._ranks(symbols[:-1], symbols[1:])
        rank[begin[1:] - 1] = _NEVER
        while len(begin):
            best = np.minimum.reduceat(rank, begin)
            done = best == _NEVER
            if done.any():
                out[number[done]] = np.add.reduceat(weight, begin)[done]
                stay = np.repeat(~done, lengths)
                symbols, weight, rank = symbols[stay], weight[stay], rank[stay]
                number, best, lengths = number[~done], best[~done], lengths[~done]
                begin = np.cumsum(lengths) - lengths
                if not len(begin):
                    break
            owner = np.repeat(np.arange(len(begin)), lengths)
            at = self._places(symbols, rank, best, owner)
            symbols[at] = self.made(symbols[at] * self.base + symbols[at + 1])
            weight[at] = 1
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            lengths = lengths - np.bincount(owner[at], minlength=len(begin))
            begin = np.cumsum(lengths) - lengths
            # Only pairs on either side of a merged symbol are new.
            new = at - np.arange(len(at))
            symbols, weight, rank = symbols[stay], weight[stay], rank[stay]
            changed = np.zeros(len(symbols), bool)
            changed[new] = True
            changed[new[new > 0] - 1] = True
            changed[-1] = False
            changed = np.flatnonzero(changed)
            rank[changed] = self._ranks(symbols[changed], symbols[changed + 1])
            rank[begin + lengths - 1] = _NEVER
        return out

    def _places(self, symbols: np.ndarray, rank: np.ndarray, best: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Places where the best pair of each sequence is applied in a round."""
        at = np.flatnonzero(rank == best[owner])
        if len(at) == len(best):
            return at
        # Of places that overlap every second one counts, from the left.
        head = np.ones(len(at), bool)
        head[1:] = (np.diff(at) > 1) | (owner[at[1:]] != owner[at[:-1]])
        run = np.flatnonzero(head)
        step = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
        at = at[step % 2 == 0]
        of = owner[at]
        made = self.made(symbols[at] * self.base + symbols[at + 1]).astype(np.int64)
        before = np.maximum(at - 1, 0)
        left = symbols[before]
        # What stands before a place may have been merged just now.
        joined = np.flatnonzero((np.diff(at) == 2) & (of[1:] == of[:-1])) + 1
        left[joined] = made[joined - 1]
        better = np.where((at > 0) & (owner[before] == of), self._ranks(left, made), _NEVER) <= best[of]
        after = np.minimum(at + 2, len(symbols) - 1)
        better |= np.where((at + 2 < len(symbols)) & (owner[after] == of), self._ranks(made, symbols[after]), _NEVER) <= best[of]
        if not better.any():
            return at
        # Places after the first that makes a better pair wait.
        stops = np.cumsum(better) - better
        start = np.ones(len(at), bool)
        start[1:] = of[1:] != of[:-1]
        own = np.flatnonzero(start)
        return at[stops == np.repeat(stops[own], np.diff(np.append(own, len(at))))]

    # ---- texts -----------------------------------------------------------------------

    def totals(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        split = [_split(text, self.run) for text in texts]
        kept = self.kept
        new = set().union(*split).difference(kept)
        for words in _bounded(new):
            kept.update(zip(words, self.counts([SPACE + word.replace(" ", SPACE) for word in words]).tolist()))
        found = [sum(map(kept.__getitem__, words)) for words in split]
        for word in new:
            if len(word) > KEPT_LENGTH:
                del kept[word]
        while len(kept) > KEPT_WORDS:
            kept.popitem()
        return found


def _split(text: str, run: int | None) -> list[str]:
    """Pre-tokens without the space that each begins with; of long runs of spaces ``run`` at a time."""
    if not text:
        return []
    text = text.replace(SPACE, " ")
    if text[0] != " " and "  " not in text:
        return text.split(" ")
    words = _WORDS(" " + text)
    if run is None or " " * run not in text:
        return [word[1:] for word in words]
    found = []
    for word in words:
        whole = max(0, (len(word) - len(word.lstrip(" ")) - 1) // run)
        found += [" " * (run - 1)] * whole
        found.append(word[whole * run + 1 :])
    return found


def _bounded(words: Iterable[str]) -> Iterator[list[str]]:
    """Words in lists of about ``TOGETHER`` characters."""
    some, size = [], 0
    for word in words:
        some.append(word)
        size += len(word) + 1
        if size >= TOGETHER:
            yield some
            some, size = [], 0
    if some:
        yield some


def counter(path: str | None = None) -> Lazy:
    """The counter that workers use; the file has to be at that path on each of them."""
    return Lazy(Counter, path or public_tokenizers.path("piece_bpe_32k.model"))


def _batches(cells: pa.Array) -> Iterator[list[str]]:
    """Texts in lists of about ``TOGETHER`` characters."""
    some, size = [], 0
    for cell in cells:
        text = cell.as_py() or ""
        some.append(text)
        size += len(text)
        if size >= TOGETHER:
            yield some
            some, size = [], 0
    if some:
        yield some


def token_counts(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    count: Lazy | None = None,
    limit: int = LIMIT,
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit.

    NULL text counts as empty, an empty text has no tokens.  Special strings in a text are text like any other.
    Repeated rows give a row each, and NULL ids are carried along.  An empty table gives
    an empty result; other columns are not read.
    """
    count = count or counter()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals = [n for texts in _batches(batch.column(2)) for n in count().totals(texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(totals, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    given = docs.select(
        F.col(id).alias("doc_id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(text).alias("text"),
    )
    kind = docs.schema[id].dataType.simpleString()
    return given.mapInArrow(counted, f"doc_id {kind}, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit
    )
