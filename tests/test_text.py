import html
import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from grantlens.functions import text as tx

MIXED = "Paid €1,234.50 on 12 May; 3-4 items, x5, 7_8"
ODD = "Café naïve ½ 12² straße a_b ٣٤ 1.2.3 ,5 x.7 €9 x€9 (3) -4 $5"


def python_numbers(text):
    """Pieces of decimal digits only, where signs part pieces and a separator before a digit joins them."""
    pieces = [""]
    for i, char in enumerate(text):
        after = text[i + 1 : i + 2]
        if char in ".," and after.isascii() and after.isdigit():
            continue
        if char.isalnum():
            pieces[-1] += char
        else:
            pieces.append("")
    return sum(piece.isdecimal() for piece in pieces)


def test_tokens_split_hyphens_and_keep_unicode(one):
    assert one(tx.tokens, "well-known Café ½ 12² a_b") == ["well", "known", "Café", "½", "12²", "a_b"]
    assert one(tx.tokens, None) == []
    assert one(tx.tokens, "") == []


def test_upper_case_is_full_mapping(one):
    assert one(F.upper, "straße") == "STRASSE"


@pytest.mark.parametrize(
    "text, stripped",
    [("the ozoneNone", "the oz"), ("gone", "g"), ("None", ""), (None, ""), ("a b", "a b")],
)
def test_trailing_strip_is_a_character_set(one, text, stripped):
    assert one(lambda t: tx.rstrip_chars(t, "None"), text) == stripped


def test_capitals_are_counted_as_given(one):
    assert one(tx.capital_count, "Ab CÉ d") == 2
    assert one(tx.digit_count, MIXED) == 6 + 2 + 2 + 1 + 2


@pytest.mark.parametrize("text", [MIXED, ODD, "", "2,000.5 and 3"])
def test_numbers(one, text):
    assert one(tx.number_count, text) == python_numbers(text)
    assert one(tx.number_count, MIXED) == 6


@pytest.mark.parametrize(
    "word, counts",
    [("A", False), ("2009", False), ("12²", False), ("½½", True), ("X5", True), ("٣٤", False)],
)
def test_countable_words(one, word, counts):
    assert one(tx.is_countable, word) is counts
    assert (len(word) > 1 and not word.isdigit()) is counts


def test_month_is_dropped_inside_words(one):
    assert one(tx.drop_month, "Mayor MAY may") == " or   may"


def test_tags_do_not_cross_lines(one):
    assert one(tx.strip_tags, " <p>a<br>b</p>\nc  ") == "ab c"
    assert one(tx.strip_tags, "<a\nhref>x") == "<a href>x"


def test_dates(one):
    assert str(one(tx.slash_date, "1/2/2016")) == "2016-02-01"
    assert str(one(tx.slash_date, "01/02/2016")) == "2016-02-01"
    assert one(tx.slash_date, "soon") is None
    assert one(tx.slash_date, "31/02/2016") is None
    assert one(tx.day_month_year, "launched on 17 July 2014 at") == "17 July 2014"
    assert str(one(tx.phrase_date, "17  July 2014")) == "2014-07-17"
    assert one(tx.phrase_date, "3 of 5") is None


def test_amounts_and_integers(one):
    assert one(tx.amount, "1 000") == 1000
    assert one(tx.amount, "1 000") is None
    assert one(tx.amount, "n/a") is None
    assert one(tx.amount, "") is None
    assert one(tx.first_integer, "about 12 of 30") == "12"
    assert one(tx.first_integer, "none") is None


def test_url_part(one):
    assert one(lambda t: tx.url_part(t, 2), "https://h/apply/open-calls/c-1") == "open-calls"
    assert one(lambda t: tx.url_part(t, 9), "a/b") is None


def test_entities(one):
    assert one(tx.unescaped, "a &amp;lt; &#233;&#x20AC; &#zz &lt;&apos;&nbsp;") == "a &lt; é€ &#zz <'\u00a0"
    assert one(tx.unescaped, "plain") == "plain"
    assert one(tx.unescaped, None) is None


ENTITY_PARTS = ["&eacute;", "&euro;", "&notit;", "&amp;amp;", "&#", "&#x41;", "&", ";", "x", "&NotEqualTilde;", "&lt", "é"]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(ENTITY_PARTS)).map("".join), min_size=20, max_size=60))
def test_entities_as_the_standard_library_resolves_them(spark, texts):
    rows = spark.createDataFrame([(text, [text, None, text[1:]]) for text in texts], "t string, a array<string>")
    for row in rows.select("t", tx.unescaped(rows["t"]).alias("u"), "a", tx.each_unescaped(rows["a"]).alias("b")).collect():
        assert row.u == html.unescape(row.t)
        assert row.b == [None if text is None else html.unescape(text) for text in row.a]


def test_characters_of_a_class_are_counted_one_by_one(one):
    for text in ("", None, "AAA", "1A2", "é", "\U0001f600Z9\n9", "ÀÉß", "٣3", "\r\nA\u2028B"):
        assert one(tx.capital_count, text) == sum("A" <= c <= "Z" for c in text or "")
        assert one(tx.digit_count, text) == sum("0" <= c <= "9" for c in text or "")
