"""Organisation name expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Company-form words that may end a name.  The list is this library's own and a
# parameter of ``strip_suffix``; dots inside a form ("S.A.") are optional.
COMPANY_FORMS = (
    "ab", "ag", "aps", "as", "asa", "bv", "bvba", "co", "company", "corp",
    "corporation", "cvba", "doo", "eood", "ev", "gmbh", "gmbh & co kg",
    "inc", "incorporated", "kft", "kg", "kgaa", "lda", "limited", "llc", "llp",
    "lp", "ltd", "ltda", "nv", "ohg", "ood", "oy", "oyj", "plc", "pte", "pty",
    "pvt", "sa", "sagl", "sarl", "sas", "sasu", "scrl", "se", "sl", "slu",
    "snc", "spa", "spol", "sprl", "srl", "sro", "ug", "zrt",
)

# ---- fixed values -----------------------------------------------------------
NAME_CHARS = "a-zA-Z0-9& "
# -----------------------------------------------------------------------------


def suffix_pattern(forms: Sequence[str] = COMPANY_FORMS) -> str:
    """One pattern for any run of company forms at the end of a name."""
    longest_first = sorted(forms, key=lambda form: (-len(form), form))
    choices = "|".join(_form_pattern(form) for form in longest_first)
    return rf"(?i)(?:(?:^|[\s,.]+)(?:{choices})\.?)+[\s,.]*$"


def _form_pattern(form: str) -> str:
    words = [
        r"\.?".join(re.escape(char) for char in word) for word in form.split()
    ]
    return r"\.?\s+".join(words)


def strip_suffix(name: Column, forms: Sequence[str] = COMPANY_FORMS) -> Column:
    """Name without its trailing company forms; '' when nothing else is left."""
    bare = F.regexp_replace(name, suffix_pattern(forms), "")
    return F.regexp_replace(bare, r"^\s+|[\s,.;]+$", "")


def clean_name(
    name: Column,
    substitutions: Sequence[tuple[str, str]] = (),
    stop_words: Sequence[str] = (),
) -> Column:
    """Plain-letter form of a name.

    Keeps ASCII letters, digits, ampersands and blanks; replaces whole words by
    the given substitutions; lower-cases the last word and removes stop words
    from it.
    """
    plain = F.trim(F.regexp_replace(name, f"[^{NAME_CHARS}]", ""))
    for word, replacement in substitutions:
        plain = F.regexp_replace(
            plain,
            rf"(?i)\b{re.escape(word.strip().lower())}\b",
            replacement.strip().lower().replace("\\", "\\\\").replace("$", "\\$"),
        )
    words = F.split(plain, " ")
    last = F.lower(F.element_at(words, -1))
    if stop_words:
        choices = "|".join(re.escape(word.strip().lower()) for word in stop_words)
        last = F.regexp_replace(last, rf"\b(?:{choices})\b", "")
    kept = F.slice(words, F.lit(1), F.size(words) - 1)
    return F.trim(F.array_join(F.concat(kept, F.array(last)), " "))
