"""Token ids of whole texts, the same as the tokenizer gives, word by word.

The tokenizer splits at white space before anything else, so the ids of a text are
the ids of its words in a row.  Words come back often; their ids are kept.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from grantlens.llm.workers import Lazy

# Words a worker keeps, those it met first, and the longest it keeps; about 35 MB.
KEPT_WORDS = 120_000
KEPT_LENGTH = 48

# Four control characters that str.split takes for white space and the tokenizer does not.
_CONTROLS = re.compile("[\x1c-\x1f]").search
_ASCII_WORDS = re.compile("[^ \t\n\r\x0b\x0c]+").findall
# What the tokenizer splits a text of letters up to U+00FF into before it merges, but for numbers, which go with each other.
_PLAIN_PIECES = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]+"
    "|[^\\s0-9a-z\xaa\xb2\xb3\xb5\xb9\xba\xbc-\xbe\xc0-\xd6\xd8-\xf6\xf8-\xff]+"
).findall
# A stop or comma beside another sign, with which it may form one piece.
_SIGNS_TOGETHER = re.compile(r"[.,](?:(?=[^\w\s]|_)|(?<=[^\w\s][.,])|(?<=_[.,]))").search


def _byte_letters() -> dict[int, int]:
    """Letter of each byte in the vocabulary: its own if it can be seen, else one from U+0100 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in seen]
    return {byte: byte for byte in seen} | {byte: 0x100 + i for i, byte in enumerate(hidden)}


class _Kept(dict):
    """Ids of words as bytes; a word that is not there yet is encoded when it is asked for."""

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer, self.merged, self.letters = tokenizer, tokenizer.model.tokenize, _byte_letters()
        # Words too long to stay after their text.
        self.long: list[str] = []

    def __missing__(self, word: str) -> bytes:
        if word.isalpha() and (word.isascii() or max(word) <= "\xff"):
            # Letters in normal form are one piece in lower case: they need the merges alone.
            shown = word.lower()
            if not shown.isascii():
                shown = shown.encode().decode("latin-1").translate(self.letters)
            found = [token.id for token in self.merged(shown)]
        else:
            found = self.tokenizer.encode(word, add_special_tokens=False).ids
        ids = self[word] = array("I", found).tobytes()
        if len(word) > KEPT_LENGTH:
            self.long.append(word)
        return ids


class WordEncoder:
    """Encoder for a byte-level vocabulary file of the ``tokenizers`` library that lowers case and drops white space."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.kept = _Kept(self.tokenizer)

    def _words(self, text: str) -> list[str]:
        """Stretches of a text whose ids in a row are its ids.

        In a plain text letters go up to U+00FF, so each has one lower case and is in normal
        form; then words are the pieces that the tokenizer makes, or join a few of them, and there are
        fewer different ones.
        """
        if _CONTROLS(text):
            return _ASCII_WORDS(text)
        if not text.isascii() and len(text.encode("latin-1", "ignore")) < len(text) or "<|" in text:
            return text.split()
        if _SIGNS_TOGETHER(text):
            return _PLAIN_PIECES(text.lower())
        return text.lower().replace(",", " , ").replace(".", " . ").split()

    def ids(self, text: str) -> np.ndarray:
        """Ids of a text as unsigned 32-bit numbers."""
        kept = self.kept
        ids = np.frombuffer(b"".join(map(kept.__getitem__, self._words(text))), np.uint32)
        while kept.long:
            del kept[kept.long.pop()]
        while len(kept) > KEPT_WORDS:
            kept.popitem()
        return ids


def word_encoder(path: str | None = None) -> Lazy:
    """The encoder that workers use; the file has to be at that path on each of them."""
    return Lazy(WordEncoder, path or public_tokenizers.path("word_bpe_49k.json"))
