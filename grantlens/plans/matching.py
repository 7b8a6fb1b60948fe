"""Grant organisations matched to patent owners.

    members (name, gan) -> names -> cleaned names
        -> prefix join with owner organisations
        -> patents per organisation and year
        -> one row per grant, name, organisation and year
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from grantlens.functions import names as nm
from grantlens.operators.groups import group_ids
from grantlens.operators.joins import BROADCAST_BYTES, fits_broadcast, lookup_join
from grantlens.operators.prefix import prefix_join
from grantlens.session import staged
from grantlens.sources.bucketed import BucketedPatents, bucketed_counts

# ---- fixed values -----------------------------------------------------------
EXCLUDED_TYPES = ("Patient organisations",)
EXCLUDED_NAMES = ("%Univers%", "%Univerz%", "%College%")
# -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Patents:
    """Owners, links and dated documents of one kind of patent data.

    ``owners(id, organization)``, ``links(owner_id, doc_id)``, ``docs(id, date)``;
    the named columns say where to find them.
    """

    owners: DataFrame
    links: DataFrame
    docs: DataFrame
    owner_id: str = "assignee_id"
    doc_id: str = "patent_id"
    date: str = "date"

    def owner_rows(self) -> DataFrame:
        return self.owners.select(F.col("id").alias("_owner"), "organization")

    def link_rows(self) -> DataFrame:
        return self.links.select(
            F.col(self.owner_id).alias("_owner"), F.col(self.doc_id).alias("_doc")
        )

    def doc_years(self) -> DataFrame:
        return self.docs.select(
            F.col("id").alias("_doc"), F.year(self.date).alias("year")
        )


def participant_members(
    participants: DataFrame,
    excluded_types: Sequence[str] = EXCLUDED_TYPES,
    excluded_names: Sequence[str] = EXCLUDED_NAMES,
) -> DataFrame:
    """(name, gan) of participants that are neither patients' bodies nor schools.

    A participant without a type or a name is left out as well.
    """
    kept = ~F.col("type").isin(*excluded_types)
    for pattern in excluded_names:
        kept = kept & ~F.col("name").ilike(pattern)
    return participants.where(kept).select("name", "gan")


def leader_members(projects: DataFrame, leader: str | Column = "project_leader") -> DataFrame:
    """(name, gan) of project leaders: the second entry names the organisation.

    Projects without leader entries are left out; a single entry gives a NULL name.
    """
    entries = F.col(leader) if isinstance(leader, str) else leader
    return projects.where(F.size(entries) > 0).select(
        F.trim(F.get(entries, F.lit(1))).alias("name"), "gan"
    )


def grouped_members(members: DataFrame) -> DataFrame:
    """(name, gan, copies) in name order."""
    return group_ids(members, "name", "gan").orderBy("name", "gan")


def yearly_counts(
    patents: Patents,
    organizations: DataFrame | None = None,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Documents per organisation and year.

    Counts links, not distinct documents: two owners of one organisation that
    share a document count it twice.  Without ``organizations`` every owner
    appears, with year NULL and count 0 where it has no dated documents.  With
    ``organizations`` (one row each) only those are read and only positive
    counts returned.

    Links are counted per owner and year before they meet the owner names, so an
    owner with very many documents is a handful of rows by then.
    """
    how = "left" if organizations is None else "inner"
    owners = patents.owner_rows()
    links = patents.link_rows()
    if organizations is not None:
        owners = lookup_join(owners, organizations, "organization", "left_semi", max_bytes)
        wanted = owners.select("_owner").distinct()
        links = lookup_join(links, wanted, "_owner", "left_semi", max_bytes)
    years = patents.doc_years().withColumn("_dated", F.lit(1).cast("long"))
    per_owner = (
        lookup_join(links, years, "_doc", how, max_bytes)
        .groupBy("_owner", "year")
        .agg(F.sum(F.coalesce("_dated", F.lit(0).cast("long"))).alias("_n"))
    )
    return (
        owners.join(per_owner, "_owner", how)
        .groupBy("organization", "year")
        .agg(F.sum(F.coalesce("_n", F.lit(0).cast("long"))).alias("count"))
    )


def ordered_counts(counts: DataFrame) -> DataFrame:
    return counts.orderBy("organization", F.asc_nulls_last("year"))


def name_matches(
    members: DataFrame,
    organizations: DataFrame,
    forms: Sequence[str] = nm.COMPANY_FORMS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(name, organization) where the organisation starts with the name less its
    company form."""
    names = (
        members.select("name")
        .where(F.length("name") > 0)
        .distinct()
        .withColumn("_clean", nm.strip_suffix(F.col("name"), forms))
        .where(F.length("_clean") > 0)
    )
    small = fits_broadcast(names, max_bytes)
    pairs = prefix_join(names, organizations, "_clean", "organization", small=small)
    return lookup_join(pairs, names, "_clean", "inner", small=small).select(
        "name", "organization"
    )


def match_report(
    members: DataFrame,
    patents: Patents,
    forms: Sequence[str] = nm.COMPANY_FORMS,
    max_bytes: int = BROADCAST_BYTES,
    written: BucketedPatents | None = None,
) -> DataFrame:
    """(gans, participant_name, organization, year, count), one row per grant of a
    matched name, organisation and year.

    The matched pairs are kept in the shared folder, as they are measured and
    read twice.  Grants join as rows, never as one list per name.  Where the patents are
    ``written`` in buckets, counts come from there.
    """
    owners = patents.owners.select("organization").where(F.col("organization").isNotNull())
    hits = staged(name_matches(members, owners, forms, max_bytes), "name-matches")
    organizations = hits.select("organization").distinct()
    if written is None:
        counts = yearly_counts(patents, organizations, max_bytes)
    else:
        counts = bucketed_counts(members.sparkSession, written, organizations)
    # Both joins are left to the adaptive plan, which knows the sizes by then and
    # splits the partition of a name with very many grants.
    dated = hits.join(counts, "organization")
    report = members.where(F.length("name") > 0).join(dated, "name")
    return report.select(
        F.col("gan").cast("int").alias("gans"),
        F.col("name").alias("participant_name"),
        "organization",
        F.col("year").cast("int").alias("year"),
        F.col("count").cast("int").alias("count"),
    )


def all_reports(reports: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """Reports by (source, data) as one table with both names as columns."""
    tagged = [
        report.select(
            F.lit(source).alias("source_type"), F.lit(data).alias("data_type"), "*"
        )
        for (source, data), report in reports.items()
    ]
    result = tagged[0]
    for other in tagged[1:]:
        result = result.unionByName(other)
    return result
