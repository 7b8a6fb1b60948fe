"""Prefix join: which values start with which keys.

A ``startswith`` condition alone would compare every key with every value.  Here
each value is cut to the lengths that keys with the same first characters have,
and the cut pieces meet the keys by equality, so only true matches are formed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from grantlens.operators.joins import BROADCAST_BYTES, fits_broadcast, lookup_join

# Characters of a key that decide which lengths a value is cut to.
ANCHOR_CHARS = 3


def prefix_join(
    keys: DataFrame,
    values: DataFrame,
    key_col: str,
    value_col: str,
    max_bytes: int = BROADCAST_BYTES,
    small: bool | None = None,
) -> DataFrame:
    """Pairs (key, value) where the value starts with the key, letter case ignored.

    Keys are taken literally (no wildcards); empty and NULL keys match nothing.
    Both inputs count as sets.  With keys that fit in memory (measured, or said
    so by ``small``) the values are never shuffled for the match.
    """
    wanted = keys.select(key_col).distinct().select(
        key_col, F.lower(key_col).alias("_key")
    ).where(F.length("_key") > 0)
    if small is None:
        small = fits_broadcast(wanted, max_bytes)
    pieces = _pieces(values.select(value_col).distinct(), value_col, wanted, small)
    # Keys that differ in letter case only share their matches.
    return lookup_join(pieces, wanted, "_key", "inner", small=small).select(
        key_col, value_col
    )


def _pieces(values: DataFrame, value_col: str, wanted: DataFrame, small: bool) -> DataFrame:
    """Beginnings of each value in the lengths worth testing."""
    lengths = wanted.groupBy(_anchor(F.col("_key")).alias("_anchor")).agg(
        F.collect_set(F.length("_key")).alias("_lengths")
    )
    lowered = values.select(value_col, F.lower(value_col).alias("_value"))
    anchored = lowered.withColumn("_anchor", F.explode(_anchors(F.col("_value"))))
    met = lookup_join(anchored, lengths, "_anchor", "inner", small=small)
    size = F.length("_value")
    return met.select(
        value_col,
        F.explode(
            F.transform(
                F.filter("_lengths", lambda length: length <= size),
                lambda length: F.substring(F.col("_value"), F.lit(1), length),
            )
        ).alias("_key"),
    )


def _anchor(key: Column) -> Column:
    return F.substring(key, 1, ANCHOR_CHARS)


def _anchors(value: Column) -> Column:
    """Anchors a matching key may have: the key may be shorter than an anchor."""
    return F.array_distinct(
        F.array(*[F.substring(value, 1, size) for size in range(1, ANCHOR_CHARS + 1)])
    )
