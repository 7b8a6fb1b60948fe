"""Text expressions used by the scoring and page jobs.

Every function takes and returns a Column, so the whole expression stays inside
the JVM, but for entities, whose names the standard library knows.  NULL text counts as empty text.
"""

from __future__ import annotations

import html

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

# ---- fixed values -----------------------------------------------------------
# Characters of a word: letters, numbers of every kind, underscore.
WORD_CHARS = r"\p{L}\p{N}_"
WORD_PATTERN = r"[\p{L}\p{N}_]+"
# A character that separates or pads (what a Unicode-aware strip removes).
SPACE_CHARS = r"[\t-\r\x1c-\x1f \u0085\p{Z}]"
# A separator before a digit belongs to the number: 1,234.50 is one number.
NUMBER_SEPARATOR = r"[.,](?=[0-9])"
# A run of digits that touches no other letter or number.  Underscore counts as
# punctuation here, so 7_8 is two numbers.
NUMBER_PATTERN = r"(?<![\p{L}\p{N}])\p{Nd}+(?![\p{L}\p{N}])"
# Tags do not run across a line break.
TAG_PATTERN = r"<[^\n]*?>"
# The month is dropped wherever it stands, inside words too.
MONTH_PATTERN = "(May|MAY)"
# Characters that carry a digit value without being decimal digits
# (superscripts, subscripts, circled and dingbat digits, Ethiopic digits, ...).
OTHER_DIGITS = (
    r"\x{b2}-\x{b3}\x{b9}\x{1369}-\x{1371}\x{19da}\x{2070}\x{2074}-\x{2079}"
    r"\x{2080}-\x{2089}\x{2460}-\x{2468}\x{2474}-\x{247c}\x{2488}-\x{2490}"
    r"\x{24ea}\x{24f5}-\x{24fd}\x{24ff}\x{2776}-\x{277e}\x{2780}-\x{2788}"
    r"\x{278a}-\x{2792}\x{10a40}-\x{10a43}\x{10e60}-\x{10e68}"
    r"\x{11052}-\x{1105a}\x{1f100}-\x{1f10a}"
)
ALL_DIGITS_PATTERN = rf"^[\p{{Nd}}{OTHER_DIGITS}]+$"
# -----------------------------------------------------------------------------


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def tokens(text: Column) -> Column:
    """All words of a text, in order, as an array."""
    return F.regexp_extract_all(or_empty(text), F.lit(WORD_PATTERN), F.lit(0))


def counted_words(text: Column) -> Column:
    """Distinct upper-cased words of a text and how often each occurs, as an array of (word, n)."""
    words = F.sort_array(F.transform(tokens(text), lambda word: F.upper(word)))

    def runs(words: Column) -> Column:
        begins = F.filter(
            F.transform(
                words,
                lambda word, i: F.struct(
                    word.alias("word"), i.alias("at"), ((i == 0) | (F.get(words, i - 1) != word)).alias("first")
                ),
            ),
            lambda run: run["first"],
        )
        return F.struct(begins.alias("begins"), F.size(words).alias("n"))

    # Each value is made once for the lambda that uses it.
    made = F.transform(F.array(words), runs)
    return F.flatten(
        F.transform(
            made,
            lambda found: F.transform(
                found["begins"],
                lambda run, j: F.struct(
                    run["word"].alias("word"),
                    (F.coalesce(F.get(found["begins"], j + 1)["at"], found["n"]) - run["at"]).cast("long").alias("n"),
                ),
            ),
        )
    )


def is_countable(word: Column) -> Column:
    """A word counts when it is longer than one character and not all digits."""
    return (F.length(word) > 1) & ~word.rlike(ALL_DIGITS_PATTERN)


def rstrip_chars(text: Column, chars: str) -> Column:
    """Strip any trailing characters out of a set (not a suffix)."""
    return F.rtrim(or_empty(text), F.lit(chars))


def capital_count(text: Column) -> Column:
    return _length_of("A-Z", text)


def digit_count(text: Column) -> Column:
    return _length_of("0-9", text)


def _length_of(chars: str, text: Column) -> Column:
    """How many characters of an ASCII class a text has.  Others go by runs: counting matches would make a
    string of each character that counts."""
    return F.length(F.regexp_replace(or_empty(text), f"[^{chars}]+", ""))


def number_count(text: Column) -> Column:
    joined = F.regexp_replace(or_empty(text), NUMBER_SEPARATOR, "")
    return F.regexp_count(joined, F.lit(NUMBER_PATTERN))


def drop_month(text: Column) -> Column:
    return F.regexp_replace(or_empty(text), MONTH_PATTERN, " ")


def strip_space(text: Column) -> Column:
    """Trim every kind of white space, line breaks and no-break spaces included."""
    return F.regexp_replace(text, f"^{SPACE_CHARS}+|{SPACE_CHARS}+$", "")


def strip_tags(markup: Column) -> Column:
    """Drop tags, turn line breaks into spaces, trim."""
    without_tags = F.regexp_replace(markup, TAG_PATTERN, "")
    return strip_space(F.replace(without_tags, F.lit("\n"), F.lit(" ")))


def first_integer(text: Column) -> Column:
    """First run of digits as text, NULL when there is none."""
    return first_match(text, r"(\p{Nd}+)")


def day_month_year(text: Column) -> Column:
    """First phrase such as ``17 July 2014``, NULL when there is none."""
    return first_match(text, rf"(\p{{Nd}}+{SPACE_CHARS}[{WORD_CHARS}]+{SPACE_CHARS}+\p{{Nd}}+)")


def phrase_date(text: Column) -> Column:
    """Date of a day-month-year phrase, NULL when the month is not a month name."""
    one_space = F.regexp_replace(text, f"{SPACE_CHARS}+", " ")
    return F.try_to_timestamp(one_space, F.lit("d MMMM yyyy")).cast("date")


def slash_date(text: Column) -> Column:
    """Date written day/month/year, padded or not; NULL when it is not one."""
    return F.try_to_timestamp(text, F.lit("d/M/yyyy")).cast("date")


def amount(text: Column) -> Column:
    """Whole amount written with blanks between thousands; NULL when it is not one."""
    return F.replace(text, F.lit(" "), F.lit("")).try_cast("int")


def url_part(url: Column, from_end: int) -> Column:
    """Path part counted from the end of the address: 1 is the last."""
    return F.try_element_at(F.split(url, "/"), F.lit(-from_end))


def found(text: Column, pattern: str, group: int = 1) -> Column:
    """Group of the first match; '' when nothing matches, NULL for NULL text."""
    return F.regexp_extract(text, pattern, group)


def first_match(text: Column, pattern: str, group: int = 1) -> Column:
    """Group of the first match, NULL when nothing (or nothing but '') matches."""
    return F.nullif(found(text, pattern, group), F.lit(""))


def all_matches(text: Column, pattern: str, group: int = 1) -> Column:
    """Group of every match; an empty array for none or for NULL text."""
    return F.regexp_extract_all(or_empty(text), F.lit(pattern), F.lit(group))


def _entities_resolved(kind: str):
    """Function over batches that resolves entities like the standard library; batches without any pass untouched."""

    def resolve(cells: pa.Array) -> pa.Array:
        flat = cells if kind == "string" else cells.flatten()
        if not pc.any(pc.match_substring(flat, "&")).as_py():
            return cells

        def one(text):
            return text if text is None or "&" not in text else html.unescape(text)

        values = cells.to_pylist()
        if kind == "string":
            return pa.array([one(text) for text in values], cells.type)
        return pa.array([texts and [one(text) for text in texts] for texts in values], cells.type)

    # Names of types are for readers here, which the decorator would take for its own.
    resolve.__annotations__ = {"cells": pa.Array, "return": pa.Array}
    return F.arrow_udf(resolve, kind)


def unescaped(text: Column) -> Column:
    """Text with its entities resolved, named and numeric."""
    return _entities_resolved("string")(text)


def each_unescaped(texts: Column) -> Column:
    """Array with the entities of every text resolved."""
    return _entities_resolved("array<string>")(texts)
