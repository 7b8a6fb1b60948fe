"""Patent tables written in buckets, so that yearly counts shuffle no links.

Links and dated documents lie in the same buckets of the document, owners in buckets of the
owner.  They are written once per load of patents and read by every report.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from grantlens.operators.joins import SALTS, hot_keys
from grantlens.session import new_path

BUCKETS = 64


@dataclass(frozen=True)
class BucketedPatents:
    """Names of the three tables of a load in the session catalog.

    ``owners(_owner, organization)``, ``links(_doc, _salt, _owner, _copies)``,
    ``years(_doc, _salt, year, _dated)``.
    """

    owners: str
    links: str
    years: str

    def table(self, spark: SparkSession, which: str) -> DataFrame:
        return spark.read.table(getattr(self, which))


def _write(df: DataFrame, name: str, buckets: int, by: list[str]) -> str:
    """One file a bucket: rows are sent to their buckets before they are written."""
    path = new_path(df.sparkSession, name)
    (
        df.repartition(buckets, *by)
        .write.format("parquet")
        .bucketBy(buckets, *by)
        .sortBy(*by)
        .option("path", path)
        .mode("overwrite")
        .saveAsTable(name)
    )
    return name


def write_patents(patents, name: str, buckets: int = BUCKETS) -> BucketedPatents:
    """Tables ``{name}_owners``, ``{name}_links`` and ``{name}_years`` of a ``Patents``.

    Equal links are one row with a number of copies.  Links of a document that holds very many of
    them, and links without a document, are spread over ``SALTS`` parts by their owner; the dates
    of such a document are repeated for each.  So no bucket grows with one document.  Documents
    without an id meet nothing and are left out.  Tables of the same name are replaced.
    """
    links = patents.link_rows()
    hot = F.broadcast(hot_keys(links, "_doc").withColumn("_hot", F.lit(True)))
    spread = F.pmod(F.xxhash64("_owner"), F.lit(SALTS)).cast("int")
    folded = links.groupBy("_doc", "_owner").agg(F.count(F.lit(1)).alias("_copies"))
    salted = folded.join(hot, "_doc", "left").select(
        "_doc",
        F.when(F.col("_hot") | F.col("_doc").isNull(), spread).otherwise(F.lit(0)).alias("_salt"),
        "_owner",
        "_copies",
    )
    dated = patents.doc_years().where(F.col("_doc").isNotNull())
    years = dated.groupBy("_doc", "year").agg(F.count(F.lit(1)).alias("_dated"))
    parts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    repeated = years.join(hot, "_doc", "left").select(
        "_doc", F.explode(parts).alias("_salt"), "year", "_dated"
    )
    return BucketedPatents(
        owners=_write(patents.owner_rows(), f"{name}_owners", buckets, ["_owner"]),
        links=_write(salted, f"{name}_links", buckets, ["_doc", "_salt"]),
        years=_write(repeated, f"{name}_years", buckets, ["_doc", "_salt"]),
    )


def bucketed_counts(
    spark: SparkSession, tables: BucketedPatents, organizations: DataFrame | None = None
) -> DataFrame:
    """Documents per organisation and year, as ``plans.matching.yearly_counts`` gives them.

    Links meet dates bucket by bucket; the first shuffle is of counts per owner and year.  With
    ``organizations`` (one row each) only those, and only positive counts, are returned.
    """
    how = "left" if organizations is None else "inner"
    links, years = tables.table(spark, "links"), tables.table(spark, "years")
    none = F.lit(0).cast("long")
    per_owner = (
        # Buckets are read by one task each, so neither side has to be sent as a whole.
        links.hint("merge").join(years, ["_doc", "_salt"], how)
        .groupBy("_owner", "year")
        .agg(F.sum(F.col("_copies") * F.coalesce("_dated", none)).alias("_n"))
    )
    owners = tables.table(spark, "owners")
    if organizations is not None:
        owners = owners.join(organizations, "organization", "left_semi")
    return (
        owners.join(per_owner, "_owner", how)
        .groupBy("organization", "year")
        .agg(F.sum(F.coalesce("_n", none)).alias("count"))
    )
