"""Ids per name, as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from grantlens.operators.joins import BROADCAST_BYTES, fits_broadcast
from grantlens.session import staged


def group_ids(rows: DataFrame, group_col: str, id_col: str) -> DataFrame:
    """(group, id, copies): every id of every group, and how often it comes.

    One shape at every size: a group is as many rows as it has ids, so no task holds
    a whole group.  NULL is a group like any other, and an id like any other.
    """
    return rows.groupBy(group_col, id_col).agg(F.count(F.lit(1)).alias("copies"))


def split_repeated(rows: DataFrame, key: str, max_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, DataFrame]:
    """Rows whose key no other row has, and all others, those without a key among them.

    Rows are wide and keys narrow, so repeated keys are sent to the rows; if they are too many for
    that, all rows count as others.
    """
    counted = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    repeated = staged(counted.where("_n > 1").select(key, F.lit(True).alias("_repeated")), "repeated-keys")
    if not fits_broadcast(repeated, max_bytes):
        return rows.where(F.lit(False)), rows
    marked = rows.join(F.broadcast(repeated), key, "left")
    others = F.col("_repeated").isNotNull() | F.col(key).isNull()
    return marked.where(~others).select(*rows.columns), marked.where(others).select(*rows.columns)
