"""Token counts against the library's."""

import random

import public_tokenizers
from hypothesis import given, settings, strategies as st
from sentencepiece import SentencePieceProcessor

from grantlens.llm import counts
from tests.llm.conftest import ODD

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = SentencePieceProcessor(model_file=PATH)
COUNTER = counts.Counter(PATH)
PARTS = ["a", "ab", " the ", "  e rn\n\t", "ing", " ▁.,", "'/$\\}{)(<>=*", "éßü", "日本語🙂Ⅷ", "<s>", "</s>", "0123", "\r\n", "\x00"]


def _check(text):
    assert COUNTER.totals([text]) == [len(MODEL.encode(text))], repr(text)


@settings(max_examples=1500, deadline=None)
@given(st.one_of(st.text(max_size=40), st.lists(st.sampled_from([*PARTS, " " * 16, " " * 17])).map("".join)))
def test_counts_are_the_librarys(text):
    _check(text)


def test_repeated_and_long_stretches():
    draw = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEF+/="
    _check(" " * 50_001)
    _check(" " * 20_003 + "a b" + " " * 17 + "c" + " " * 16 + "d" + " " * 33)
    _check("ab" * 30_000)
    _check("=" * 9_999 + "." * 3_001)
    _check("".join(draw.choice(letters) for _ in range(60_000)))
    for _ in range(300):
        text = "".join(draw.choice(draw.choice(PARTS)) for _ in range(draw.randrange(80)))
        _check(text * draw.randrange(1, 6))


def test_counts_stay_right_when_words_are_forgotten(monkeypatch):
    monkeypatch.setattr(counts, "KEPT_WORDS", 20)
    monkeypatch.setattr(counts, "KEPT_LENGTH", 6)
    monkeypatch.setattr(counts, "TOGETHER", 50)
    counter, draw = counts.Counter(PATH), random.Random(4)
    for _ in range(60):
        texts = [" ".join(draw.choice(["alpha", "Beta,", "gammadelta", "…"]) + str(draw.randrange(30)) for _ in range(9)) for _ in range(3)]
        assert counter.totals(texts) == [len(MODEL.encode(text)) for text in texts]


def test_odd_and_empty_tables(odd_docs, no_docs):
    rows = counts.token_counts(odd_docs).collect()
    expected = [
        (id, len((text or "").encode()), len(MODEL.encode(text or "")), len(MODEL.encode(text or "")) > 4096)
        for id, text, _, _ in ODD
    ]
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, expected))
    assert any(row.over_limit for row in rows) and counts.token_counts(no_docs).count() == 0
