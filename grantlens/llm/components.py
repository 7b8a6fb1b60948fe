"""Connected components of links, without gathering a component anywhere."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from grantlens.session import staged


# An id with one in this many links or more is hot, so that there are no more hot ids than that.
HOT_IDS = 500


def _toward_smallest(links: DataFrame, only_smaller: bool, hot_links: int) -> DataFrame:
    """Every (u, v), v < u, replaced by links to the smallest id that u knows.

    With ``only_smaller`` an id hands on what is smaller than itself, else what is larger.
    The smallest neighbour comes from an aggregate.  Ids with ``hot_links`` neighbours or more are few, and
    theirs is sent to the links; the links of the others meet it by a join.
    """
    if only_smaller:
        known = links
    else:
        known = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = known.groupBy("u").agg(
        F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("n")
    )
    hot = F.broadcast(least.where(F.col("n") >= hot_links).select("u", "m"))
    others = least.where(F.col("n") < hot_links).select("u", "m")
    met = known.join(hot, "u").unionByName(known.join(hot, "u", "left_anti").join(others, "u"))
    if only_smaller:
        handed = met.select(F.col("v").alias("a"), "m").unionByName(
            least.select(F.col("u").alias("a"), "m")
        )
    else:
        handed = met.where("v > u").select(F.col("v").alias("a"), "m")
    return handed.where("a <> m").select(
        F.greatest("a", "m").alias("u"), F.least("a", "m").alias("v")
    ).distinct()


def connected(links: DataFrame, label: str, rounds: int = 60) -> DataFrame:
    """(id, component): the smallest id reachable over ``links`` (a, b), for ids with a link.

    Alternates between handing on larger and smaller neighbours until every id links to
    its smallest one only; every step is written to the shared folder.  Repeated links, links to
    itself and NULL ids are allowed and change nothing.
    """
    now = staged(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        label,
    )
    mark = F.struct(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long"))).alias("mark")
    before = now.agg(mark).first()["mark"]
    for _ in range(rounds):
        # The first half knows every link from both ends; the second starts from no more than it had.
        hot_links = max(2, math.ceil(2 * before[0] / HOT_IDS))
        larger = staged(_toward_smallest(now, False, hot_links), label)
        now = staged(_toward_smallest(larger, True, hot_links), label)
        after = now.agg(mark).first()["mark"]
        if after == before:
            smallest = now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
            return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(smallest)
        before = after
    raise RuntimeError(f"links did not settle in {rounds} rounds")
