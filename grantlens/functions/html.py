"""Expressions that cut values out of HTML by plain text search.

For what depends on where an element stands see ``elements``.  Every pattern is linear in the length of the text.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from grantlens.functions import text as tx


def after(html: Column, marker: str) -> Column:
    """What follows a marker text, up to its next place if any; '' without one."""
    return F.split_part(html, F.lit(marker), F.lit(2))


def before(html: Column, marker: str) -> Column:
    """What precedes the first place of a marker text; everything without one."""
    return F.substring_index(html, marker, 1)


def list_items(html: Column) -> Column:
    """HTML of the items of a list."""
    return tx.all_matches(html, r"(?s)<li\b[^>]*>.*?</li\s*>", 0)
