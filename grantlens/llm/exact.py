"""Exact duplicates by digest, frequent digests apart from the rest.

Texts are equal when their normalised forms are: every run of ASCII white space
is one space.  The normalised text is reduced to its SHA-256 once; from then on
only ids and digests travel.

1. Frequency sketches of the Misra-Gries family name the digests that may hold
   ``HEAVY_SHARE`` of all rows or more.  They never miss one, and there are ``MERGES`` of
   them at most, so that no task takes in a sketch of every task.
2. Those candidates, a fixed number at most, are counted exactly.  Their smallest
   id and their size are the verified winners; the list is broadcast and settles
   its rows where they are read, without a shuffle.
3. All other rows are shuffled by digest.  None of their groups is large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from grantlens.llm.select import without
from grantlens.session import staged

HEAVY_SHARE = 0.002
HEAVY_KEYS = int(1 / HEAVY_SHARE)
# Counters of a sketch.  Its error is 3.5 counters' worth of rows, far under the share.
COUNTERS = 16 * HEAVY_KEYS
MERGES = 256


def normalised(text: Column) -> Column:
    """Text with one space for every run of ASCII white space; NULL is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def frequent_keys(rows: DataFrame, key: str) -> DataFrame:
    """Every value of a whole-number column that holds ``HEAVY_SHARE`` of the rows, and
    perhaps some that hold half of that; about ``2 * HEAVY_KEYS`` at most.

    ``rows`` is a table: it is counted first.  Each group of scan tasks names what holds
    half the share there.  A value with the whole share misses less than half of
    its rows in groups where it stays unnamed, so the sum of what is named shows it.
    """
    half = HEAVY_SHARE / 2
    total = rows.count()
    named = (
        rows.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGES)).alias("part"))
        .agg(
            F.expr(f"approx_top_k(`{key}`, {2 * HEAVY_KEYS}, {COUNTERS})").alias("top"),
            F.count(F.lit(1)).alias("n"),
        )
        .select(F.explode("top").alias("top"), "n")
        .where(F.col("top.count") >= F.col("n") * half)
    )
    return (
        named.groupBy(F.col("top.item").alias(key))
        .agg(F.sum("top.count").alias("rows"))
        .where(F.col("rows") >= total * half)
        .select(key)
    )


def mark_copies(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    NULL text counts as empty, and empty texts are copies of each other.  Of equal
    texts the row with the smallest id stays.  A NULL id is larger than all others:
    such a row stays only in a group without any id.  A row that is repeated with
    its id counts each time, and its repetitions are marked alike.  Other columns
    are not read.  An empty table gives an empty result.
    """
    digests = staged(
        docs.select(
            F.col(id).alias("doc_id"), F.sha2(normalised(F.col(text)), 256).alias("text_sha256")
        ).withColumn("short", F.xxhash64("text_sha256")),
        "digests",
    )
    candidates = frequent_keys(digests, "short")
    winners = (
        digests.join(F.broadcast(candidates), "short", "left_semi")
        .groupBy("text_sha256")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    # At most one row per candidate, each of them counted: written, so that both uses see the same.
    winners = F.broadcast(staged(winners, "winners"))
    columns = ("doc_id", "keep_id", "group_size", "text_sha256")
    heavy = digests.join(winners, "text_sha256").select(*columns)
    same = Window.partitionBy("text_sha256")
    rest = (
        digests.join(winners, "text_sha256", "left_anti")
        .withColumns(
            {
                "keep_id": F.min("doc_id").over(same),
                "group_size": F.count(F.lit(1)).over(same),
            }
        )
        .select(*columns)
    )
    return heavy.unionByName(rest).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; ids must be unique."""
    gone = mark_copies(docs, id, text).where(~F.col("kept")).select(F.col("doc_id").alias(id))
    return without(docs, gone, id)
