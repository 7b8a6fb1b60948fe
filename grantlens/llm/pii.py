"""Personal data by anchor expansion.

An Aho-Corasick automaton runs once over a text and stops only at anchors: at-signs,
address schemes, and cues of identifiers (two digits with at most one separator, a dot
before a digit, a plus before a digit, a country code of an account number).  At each
anchor a small parser expands to both sides as far as the kind allows and checks
what it found (label structure, octet range, length, check digits).  Text without
anchors costs nothing but the automaton, and every parser reads a stretch of text at
most once, so a text of any length takes time in proportion to it.

Base kinds, each leftmost and not overlapping itself; what fails its check is dropped
and not retried:

- ``email``: local part, ``@``, two labels or more;
- ``ip``: four numbers joined by dots, none above 255;
- ``card``: 14 to 19 digits, single spaces or hyphens between them, passing Luhn;
- ``phone``: ``+``, then 10 to 15 digits with spaces, dots, hyphens, brackets.

Further kinds: ``iban`` (account numbers whose remainder modulo 97 is 1) and ``url``
(addresses that carry a user and a password).  They never replace a base span.

Positions are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from grantlens.llm.workers import Lazy, tidied

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "url")
DIGITS = "0123456789"
# Account number lengths by country.
IBAN_LENGTHS = {
    "AT": 20, "BE": 16, "CH": 21, "CZ": 24, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27,
    "GB": 22, "GR": 27, "HU": 28, "IE": 22, "IT": 27, "LU": 20, "NL": 18, "NO": 15, "PL": 28,
    "PT": 25, "RO": 24, "SE": 24,
}
SCHEMES = ("http://", "https://", "ftp://", "sftp://", "ssh://", "postgres://", "mysql://")

Span = tuple[int, int, str]

_LOCAL_BACK = re.compile(r"[A-Za-z0-9._%+-]*")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED_BACK = re.compile(r"[0-9.]*")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD_BACK = re.compile(r"[0-9](?:[ -]?[0-9])*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9])*")
_USER = re.compile(r"[^\s/@:]+:[^\s/@]+@[^\s/@]+")
_NOT_DIGIT = re.compile(r"[^0-9]")


def _automaton() -> ahocorasick.Automaton:
    """Automaton of all anchors; the value is (kind of parser, length of the anchor)."""
    found = ahocorasick.Automaton()
    found.add_word("@", ("email", 1))
    for digit in DIGITS:
        found.add_word(f".{digit}", ("ip", 2))
        found.add_word(f"+{digit}", ("phone", 2))
        for other in DIGITS:
            for between in ("", " ", "-"):
                found.add_word(f"{digit}{between}{other}", ("card", 2 + len(between)))
    for country in IBAN_LENGTHS:
        found.add_word(country, ("iban", 2))
    for scheme in SCHEMES:
        found.add_word(scheme, ("url", len(scheme)))
    found.make_automaton()
    return found


anchors = Lazy(_automaton)


def _back(pattern: re.Pattern, text: str, start: int, end: int) -> int:
    """Where the longest run of ``pattern`` begins that ends at ``end``, at ``start`` or later.

    Read in blocks from the right, so that only the run itself is looked at.
    """
    size = 64
    while True:
        low = max(start, end - size)
        run = pattern.match(text[low:end][::-1]).end()
        if run < end - low or low == start:
            return end - run
        size *= 4


def _luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _octet(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) < 3 or (len(digits) == 3 and digits <= "255")


def _email(text: str, at: int, done: int) -> tuple[int, list[Span]]:
    start = _back(_LOCAL_BACK, text, done, at)
    domain = _DOMAIN.match(text, at + 1) if start < at else None
    if domain is None:
        return done, []
    return domain.end(), [(start, domain.end(), "email")]


def _ips(text: str, at: int, done: int) -> tuple[int, list[Span]]:
    """All addresses of the chain of dotted numbers around the dot at ``at``."""
    if at < done or at == 0 or text[at - 1] not in DIGITS:
        return done, []
    # From here to the left only digits and single dots belong to the chain.
    start = _back(_DOTTED_BACK, text, done, at)
    if (gap := text.rfind("..", start, at)) >= 0:
        start = gap + 2
    start += text.startswith(".", start)
    chain = _CHAIN.match(text, start)
    ends, found, begin = chain.end(), [], start
    numbers = chain.group().split(".")
    for i in range(0, len(numbers) - 3, 4):
        four = numbers[i : i + 4]
        end = begin + sum(map(len, four)) + 3
        if all(map(_octet, four)):
            found.append((begin, end, "ip"))
        begin = end + 1
    return ends, found


def _cards(text: str, at: int, done: int) -> tuple[int, list[Span]]:
    start = at
    if at > done and text[at - 1] in "0123456789 -":
        # The chain may have begun before this pair: reversed, it reads the same way.
        size = 64
        while True:
            low = max(done, at + 1 - size)
            run = _CARD_BACK.match(text[low : at + 1][::-1]).end()
            if run < at + 1 - low or low == done:
                break
            size *= 4
        start = at + 1 - run
    chain = _CARD.match(text, start)
    digits = _NOT_DIGIT.sub("", chain.group())
    good = 14 <= len(digits) <= 19 and _luhn(digits)
    return chain.end(), [(start, chain.end(), "card")] if good else []


def _phone(text: str, at: int, done: int) -> tuple[int, list[Span]]:
    run = _PHONE.match(text, at)
    if run is None:
        return done, []
    end = at + len(run.group().rstrip(" ().-"))
    if end - at < 4:  # plus, digit, something, digit
        return done, []
    digits = len(_NOT_DIGIT.sub("", text[at:end]))
    return end, [(at, end, "phone")] if 10 <= digits <= 15 else []


def _iban(text: str, at: int, done: int) -> tuple[int, list[Span]]:
    if at and text[at - 1].isalnum():
        return done, []
    size = IBAN_LENGTHS[text[at : at + 2]]
    # An account number with a space between any two characters is the longest there is.
    run = _IBAN.match(text, at, at + 2 * size)
    if run is None:
        return done, []
    end, n = at, 0
    while end < run.end() and n < size:
        n += text[end] != " "
        end += 1
    if n < size or (end < len(text) and text[end].isalnum()):
        return done, []
    plain = text[at:end].replace(" ", "")
    number = int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4]))
    return (end, [(at, end, "iban")]) if number % 97 == 1 else (done, [])


def _url(text: str, at: int, done: int) -> tuple[int, list[Span]]:
    scheme = next(s for s in sorted(SCHEMES, key=len, reverse=True) if text.startswith(s, at))
    login = _USER.match(text, at + len(scheme))
    if login is None:
        return done, []
    return login.end(), [(at, login.end(), "url")]


PARSERS = {
    "email": _email, "ip": _ips, "card": _cards, "phone": _phone, "iban": _iban, "url": _url,
}


def find_spans(text: str) -> list[Span]:
    """(start, end, kind) of all personal data of a text, by start, then by kind as listed."""
    done, spans = dict.fromkeys(KINDS, 0), []
    for last, (kind, length) in anchors().iter(text):
        at = last + 1 - length
        if at >= done[kind]:
            done[kind], found = PARSERS[kind](text, at, done[kind])
            spans += found
    spans.sort(key=lambda span: (span[0], KINDS.index(span[2]), span[1]))
    return spans


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """Text with each stretch of personal data replaced by its kind in angle brackets.

    Spans that overlap are one stretch, named by the first of them.
    """
    out, done, i = [], 0, 0
    while i < len(spans):
        start, end, kind = spans[i]
        i += 1
        while i < len(spans) and spans[i][0] < end:
            end = max(end, spans[i][1])
            i += 1
        out += [text[done:start], f"<{kind}>"]
        done = end
    return "".join(out) + text[done:]


def _span_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) -> the columns of ``spans_of``."""
    for batch in batches:
        counts, shas, everything = [[] for _ in BASE_KINDS], [], []
        for cell in batch.column(1):
            spans = find_spans(cell.as_py() or "")
            base = [span for span in spans if span[2] in BASE_KINDS]
            for column, kind in zip(counts, BASE_KINDS):
                column.append(sum(span[2] == kind for span in base))
            shas.append(hashlib.sha256(joined(base).encode()).hexdigest())
            everything.append(joined(spans))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                *[pa.array(column, pa.int64()) for column in counts],
                pa.array(shas, pa.string()),
                pa.array(everything, pa.string()),
            ],
            ["doc_id", *[f"n_{kind}" for kind in BASE_KINDS], "base_sha256", "spans"],
        )


@tidied
def _redact_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the text, the last column; NULL stays NULL."""
    for batch in batches:
        texts = [
            None if (text := cell.as_py()) is None else redacted(text, find_spans(text))
            for cell in batch.column(batch.num_columns - 1)
        ]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(texts, pa.string())], schema=batch.schema
        )


def spans_of(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone (base spans),
    base_sha256 (of the base spans) and spans (all, ``kind:start:end`` joined by commas).

    NULL text counts as empty, and an empty text has no spans.  NULL ids are carried
    along; repeated rows give repeated rows; other columns are not read.  An
    empty table gives an empty result.
    """
    schema = (
        f"doc_id {docs.schema[id].dataType.simpleString()}, n_email long, n_ip long, n_card long,"
        " n_phone long, base_sha256 string, spans string"
    )
    return docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        _span_batches, schema
    )


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with personal data replaced in ``text``; all columns, in their order.

    NULL text stays NULL; rows are never dropped or added.
    """
    others = [name for name in docs.columns if name != text]
    ordered = docs.select(*others, text)
    return ordered.mapInArrow(_redact_batches, ordered.schema).select(*docs.columns)
