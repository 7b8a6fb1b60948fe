"""Anchor expansion against plain patterns, on drawn texts."""

import re

import pytest
from hypothesis import given, settings, strategies as st

from grantlens.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, found):
    if kind == "ip":
        return all(int(part) <= 255 for part in found.split("."))
    digits = [int(c) for c in found if c.isdigit()]
    if kind == "phone":
        return 10 <= len(digits) <= 15
    if kind == "card":
        doubled = [d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return True


def brute(text):
    found = [
        (m.start(), m.end(), kind)
        for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text)
        if passes(kind, m.group())
    ]
    return sorted(found, key=lambda span: (span[0], pii.KINDS.index(span[2])))


def base(text):
    return [span for span in pii.find_spans(text) if span[2] in pii.BASE_KINDS]


@settings(max_examples=1500, deadline=None)
@given(st.sampled_from(["0123456789", "01.", "012 -", "@a.-", "+1 ().-", "a@.b1+ -é_%"]).flatmap(lambda a: st.text(a, max_size=90)))
def test_base_spans(text):
    assert base(text) == brute(text)


# Plain patterns take quadratic time on these, so what they hold is stated.
@pytest.mark.parametrize(
    "text, found",
    [("1" * 300_000, 0), ("1." * 200_000, 50_000), ("a@" * 200_000, 0), ("+1" + " " * 300_000, 0), ("1-" * 150_000, 0)],
)
def test_long_runs_take_linear_time(text, found):
    assert len(base(text)) == found
    assert base(text[:400]) == brute(text[:400])


def test_further_kinds():
    text = "pay DE89 3704 0044 0532 0130 00 or DE89370400440532013001 via https://me:pw@host.example/x"
    kinds = [(text[a:b], kind) for a, b, kind in pii.find_spans(text)]
    assert ("DE89 3704 0044 0532 0130 00", "iban") in kinds
    assert ("https://me:pw@host.example", "url") in kinds
    assert [kind for _, kind in kinds].count("iban") == 1


def test_redaction_joins_overlaps():
    text = "é mail a.b@c.de, https://u:p@h.example now"
    assert pii.redacted(text, pii.find_spans(text)) == "é mail <email>, <url> now"


def test_odd_rows(odd_docs, no_docs):
    found = {r.doc_id: r for r in pii.spans_of(odd_docs).collect()}
    assert found[3].spans == "" and found[8].n_email == 1
    assert pii.spans_of(odd_docs).count() == odd_docs.count()
    assert pii.spans_of(no_docs).count() == pii.redact(no_docs).count() == 0
    clean = pii.redact(odd_docs)
    assert clean.columns == odd_docs.columns
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[3] is None and texts[8].endswith("word <email>") and texts[6] == "one two three"
