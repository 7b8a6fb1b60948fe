"""Exact sets of whole-number ids as bitmaps, so that long id lists can be sent to wide rows.

A bucket covers 32,768 neighbouring ids and takes 4 KB at most, whatever share of them is in the set:
64 MB hold half a billion ids where a list of ids would hold under two million.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

BUCKET_BYTES = 4096
# Bytes of a row beside its bits: the bucket's number and what Spark keeps with a row.
ROW_BYTES = 64


def is_whole(df: DataFrame, id_col: str) -> bool:
    return isinstance(df.schema[id_col].dataType, T.IntegralType)


def id_bitmaps(ids: DataFrame, id_col: str) -> DataFrame:
    """(bucket, bits) of the ids; repeated ids count once, a NULL id is in no set.

    Bits are gathered before the shuffle, so a task hands on one row for each bucket it met.
    """
    number = F.col(id_col).cast("long")
    return (
        ids.where(number.isNotNull())
        .groupBy(F.bitmap_bucket_number(number).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))
    )


def bitmaps_fit(ids: DataFrame, id_col: str, max_bytes: int) -> bool:
    """Whether the bitmaps of the ids take no more than this, found without building them."""
    bucket = F.bitmap_bucket_number(F.col(id_col).cast("long"))
    buckets = ids.where(F.col(id_col).isNotNull()).select(bucket).distinct().count()
    return buckets * (BUCKET_BYTES + ROW_BYTES) <= max_bytes


def has_bit(bits: Column, id: Column) -> Column:
    """Whether the bit of an id is set in the bitmap of its bucket; false for a NULL of either."""
    place = F.bitmap_bit_position(id.cast("long"))
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10)
    bit = F.call_function("shiftright", byte.cast("long"), place.bitwiseAND(F.lit(7)).cast("int"))
    return F.coalesce(bit.bitwiseAND(F.lit(1)) == 1, F.lit(False))


def with_membership(rows: DataFrame, bitmaps: DataFrame, id_col: str, flag: str) -> DataFrame:
    """Rows with a flag that tells whether their id is in the set; bitmaps are sent to the rows.

    For bitmaps whose size ``bitmaps_fit`` has found to fit.
    """
    met = rows.withColumn("_bucket", F.bitmap_bucket_number(F.col(id_col).cast("long"))).join(
        F.broadcast(bitmaps.select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits"))),
        "_bucket",
        "left",
    )
    return met.withColumn(flag, has_bit(F.col("_bits"), F.col(id_col))).select(*rows.columns, flag)
