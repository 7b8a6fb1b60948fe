"""Bucketed patent tables: the same counts as the tables they come from, without shuffled links."""

import re

import pytest

from grantlens.operators import joins
from grantlens.plans import matching
from grantlens.plans.matching import Patents
from grantlens.sources import bucketed


@pytest.fixture
def patents(spark):
    owners = [(i, f"Org {i % 7}") for i in range(40)] + [(40, None), (None, "No id"), (3, "Twice")]
    links = [(i % 45, i % 60) for i in range(300)] + [(i % 40, 7) for i in range(200)]
    links += [(5, None), (None, 4), (None, None), (5, 999), (2, 8), (2, 8)]
    docs = [(i, f"20{10 + i % 5}-01-01" if i % 9 else None) for i in range(70)]
    docs += [(None, "2011-01-01"), (4, "2013-05-05"), (4, "2013-06-06")]
    return Patents(
        spark.createDataFrame(owners, "id int, organization string"),
        spark.createDataFrame(links, "assignee_id int, patent_id int"),
        spark.createDataFrame(docs, "id int, date string").selectExpr("id", "CAST(date AS DATE) AS date"),
    )


def rows(df):
    return sorted(((r.organization, r.year, r["count"]) for r in df.collect()), key=str)


def test_same_counts(spark, patents):
    tables = bucketed.write_patents(patents, "same_counts", buckets=4)
    assert rows(bucketed.bucketed_counts(spark, tables)) == rows(matching.yearly_counts(patents))
    some = spark.createDataFrame([("Org 1",), ("Twice",), ("Nobody",)], "organization string")
    expected = rows(matching.yearly_counts(patents, some))
    assert expected and rows(bucketed.bucketed_counts(spark, tables, some)) == expected


def test_same_report(spark, patents):
    members = spark.createDataFrame([("Org 1 Ltd", 1), ("Org 1 Ltd", 1), ("Twice", 2)], "name string, gan int")
    written = bucketed.write_patents(patents, "same_report", buckets=4)
    plain = matching.match_report(members, patents).collect()
    same = matching.match_report(members, patents, written=written).collect()
    assert plain and sorted(same, key=str) == sorted(plain, key=str)


def test_a_second_load_replaces_the_first(spark, patents):
    bucketed.write_patents(patents, "replaced", buckets=4)
    fewer = Patents(patents.owners, patents.links.limit(0), patents.docs)
    tables = bucketed.write_patents(fewer, "replaced", buckets=4)
    assert rows(bucketed.bucketed_counts(spark, tables)) == rows(matching.yearly_counts(fewer))


def test_a_document_with_very_many_links_lies_in_many_buckets(spark, patents):
    tables = bucketed.write_patents(patents, "hot_document", buckets=8)
    hot = tables.table(spark, "links").where("_doc = 7")
    assert hot.select("_salt").distinct().count() > 8
    assert hot.selectExpr("input_file_name() AS f").distinct().count() > 4
    assert tables.table(spark, "years").where("_doc = 7").count() == joins.SALTS


def test_links_and_dates_are_not_shuffled(spark, patents):
    tables = bucketed.write_patents(patents, "not_shuffled", buckets=4)
    plan = bucketed.bucketed_counts(spark, tables)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    depth = lambda line: re.search(r"[A-Za-z]", line).start()
    at = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line and "_salt" in line)
    below = []
    for line in lines[at + 1 :]:
        if not re.search(r"[A-Za-z]", line) or depth(line) <= depth(lines[at]):
            break
        below.append(line)
    assert sum("Scan parquet" in line for line in below) == 2
    assert not any("Exchange" in line for line in below)
