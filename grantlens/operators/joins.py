"""Joins that stay even when one key holds a large part of the rows.

``lookup_join`` is the one the plans use: it broadcasts the lookup side only
after measuring it, and otherwise goes through ``salted_join``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

BROADCAST_BYTES = 64 * 1024 * 1024
# A key is hot when it holds at least this share of the rows ...
HOT_SHARE = 0.002
# ... so at most this many keys can be hot, and the list of them is safe to send
# to every task.
HOT_KEYS = int(1 / HOT_SHARE)
SALTS = 64


def measured_bytes(df: DataFrame) -> int:
    """Upper estimate of the in-memory size of a frame, from one aggregate over it."""
    variable = [
        F.sum(F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0)))
        if isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType))
        else F.sum(F.coalesce(F.octet_length(field.name), F.lit(0)))
        for field in df.schema.fields
        if isinstance(field.dataType, (T.StringType, T.BinaryType, T.ArrayType, T.StructType, T.MapType))
    ]
    row = df.agg(F.count(F.lit(1)), *variable).first()
    per_row = 32 + 8 * len(df.columns)
    return row[0] * per_row + sum(value or 0 for value in row[1:])


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= max_bytes


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: str,
    how: str = "inner",
    max_bytes: int = BROADCAST_BYTES,
    small: bool | None = None,
) -> DataFrame:
    """Join ``rows`` to ``lookup`` on one column, whatever the size of the lookup.

    The lookup is measured first, so it should be a table or a cheap plan over
    one; pass ``small`` where a measurement already answers the question.
    """
    if small is None:
        small = fits_broadcast(lookup, max_bytes)
    if small:
        return rows.join(F.broadcast(lookup), on, how)
    return salted_join(rows, lookup, on, how)


def hot_keys(rows: DataFrame, on: str) -> DataFrame:
    """Keys that hold at least ``HOT_SHARE`` of the rows, as fixed rows.

    One pass with a frequency sketch.  The estimate only steers where rows are
    sent, never which rows join; it is taken once and kept as values, so that
    both sides of a join and every repeated task see the same keys.  The sketch takes no binary
    keys; these go through it as hex.
    """
    binary = isinstance(rows.schema[on].dataType, T.BinaryType)
    item = F.unhex("top.item") if binary else F.col("top.item")
    keys = rows.where(F.col(on).isNotNull()).select((F.hex(on) if binary else F.col(on)).alias("key"))
    counted = keys.agg(
        F.expr(f"approx_top_k(key, {HOT_KEYS}, {20 * HOT_KEYS})").alias("top"),
        F.count(F.lit(1)).alias("total"),
    )
    found = (
        counted.select(F.explode("top").alias("top"), "total")
        .where(F.col("top.count") >= F.col("total") * HOT_SHARE)
        .select(item.alias(on))
    )
    return rows.sparkSession.createDataFrame(found.collect(), found.schema)


def salted_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: str,
    how: str = "inner",
    salts: int = SALTS,
) -> DataFrame:
    """Shuffle join that spreads hot keys of ``rows`` over many tasks.

    Equal rows are first folded into one row with a count (combined before the
    shuffle), so a large group of copies travels as one row; rows of a hot key
    are then spread by a hash of their other columns, against copies of the few
    lookup rows with that key; the fold is undone last.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"rows must be kept on the left side, not {how}")
    hot = hot_keys(rows, on)
    folded = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_copies"))
    joined = salted_join_folded(folded, lookup, on, how, hot, salts)
    return unfold(joined, "_copies")


def salted_join_folded(
    folded: DataFrame,
    lookup: DataFrame,
    on: str,
    how: str,
    hot: DataFrame,
    salts: int = SALTS,
) -> DataFrame:
    """``salted_join`` for rows that are already distinct, with the hot keys given."""
    hot = F.broadcast(hot.withColumn("_hot", F.lit(True)))
    others = [name for name in folded.columns if name != on]
    spread = F.pmod(F.xxhash64(*others), F.lit(salts)).cast("int")
    left = folded.join(hot, on, "left").withColumn(
        # Rows without a key meet nothing, so they may go anywhere as well.
        "_salt", F.when(F.col("_hot") | F.col(on).isNull(), spread).otherwise(F.lit(0))
    )
    right = lookup.join(hot, on, "left").withColumn(
        "_salt",
        F.explode(
            F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
                F.array(F.lit(0))
            )
        ),
    )
    return left.drop("_hot").join(right.drop("_hot"), [on, "_salt"], how).drop("_salt")


def unfold(df: DataFrame, copies: str, block: int = 100_000) -> DataFrame:
    """Repeat each row as often as its count says, in blocks so no array grows large."""
    blocks = df.withColumn(
        "_start",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col(copies) - 1, F.lit(block).cast("long"))),
    )
    in_block = F.least(F.lit(block).cast("long"), F.col(copies) - F.col("_start"))
    return blocks.withColumn(
        "_i", F.explode(F.sequence(F.lit(1).cast("long"), in_block))
    ).drop("_start", "_i", copies)
