"""Exact copies and shared lines against plain loops."""

import hashlib
import re
from collections import defaultdict

import pytest

from grantlens.llm import exact, lines


def digest(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()


@pytest.mark.parametrize("share", [0.002, 0.2])
def test_copies(spark, monkeypatch, share):
    """A third of the rows alike, with the list of frequent digests long and short."""
    monkeypatch.setattr(exact, "HEAVY_SHARE", share)
    monkeypatch.setattr(exact, "HEAVY_KEYS", int(1 / share))
    monkeypatch.setattr(exact, "COUNTERS", 16 * int(1 / share))
    texts = ["hot  text"] * 100 + [f"t{i % 90}\t x" for i in range(200)] + [None, "", " "]
    rows = [(7 * i % 303, text) for i, text in enumerate(texts)]
    groups = defaultdict(list)
    for i, text in rows:
        groups[digest(text)].append(i)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact.mark_copies(docs).collect()}
    assert got == {
        (i, min(ids), len(ids), i == min(ids), sha) for sha, ids in groups.items() for i in ids
    }


def test_odd_copies(odd_docs, no_docs):
    found = exact.mark_copies(odd_docs).collect()
    assert len(found) == odd_docs.count()
    by_id = {r.doc_id: r for r in found}
    assert by_id[4].keep_id == 3 and not by_id[4].kept and by_id[None].kept
    assert by_id[7].group_size == 2 and by_id[7].kept
    assert exact.mark_copies(no_docs).count() == 0
    kept = exact.drop_copies(odd_docs)
    assert kept.columns == odd_docs.columns and kept.where("doc_id = 4").count() == 0


def test_frequent_keys_are_few_and_complete(spark):
    rows = spark.range(20_000).selectExpr("IF(id % 3 = 0, -1, id) AS k").repartition(7)
    found = [r.k for r in exact.frequent_keys(rows, "k").collect()]
    assert -1 in found and len(found) <= 2 * exact.HEAVY_KEYS


def brute_texts(rows, sites):
    """Texts in the order of the rows, by plain loops."""
    trim = lambda line: re.sub(r"[\x20\x09-\x0D]+", " ", line).strip(" ")
    size = lambda line: len(trim(line).split(" ")) if trim(line) else 0
    parts = [(text or "").split("\n") for _, text, _ in rows]

    def on_many_sites(which):
        spread = defaultdict(set)
        for i in which:
            for line in filter(size, parts[i]):
                spread[trim(line)].add(rows[i][2] or "")
        return {
            line for line, where in spread.items() if len(where) >= sites * (2 if size(line) < 4 else 1)
        }

    spread = on_many_sites(range(len(rows)))
    words = lambda ls: sum(map(size, ls))
    hosts = [
        i for i, own in enumerate(parts)
        if 100 * words(x for x in own if trim(x) in spread) <= 50 * words(own)
    ]
    gone = spread & on_many_sites(hosts)
    return [
        text if text is None else "\n".join(x for x in own if trim(x) not in gone)
        for (_, text, _), own in zip(rows, parts)
    ]


def brute_lines(rows, sites):
    """Texts by id."""
    return {i: text for (i, _, _), text in zip(rows, brute_texts(rows, sites))}


@pytest.mark.parametrize("sites", [3, 30])
def test_shared_lines(spark, sites):
    rows = []
    for i in range(400):
        own = f"document {i} has words of its own here\nand a second line of document {i} too"
        common = "this line is on many sites" if i % 2 else "this  line is on\tmany sites "
        near_by = f"line of group {i % 40} that few share"
        rows.append((i, "\n".join([common, own, near_by, "", "short"]), f"s{i % 60}" if i % 7 else None))
    rows += [(1000 + i, "this line is on many sites", f"s{i}") for i in range(40)] + [(2000, None, "s1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.text for r in lines.clean_lines(docs, sites=sites).collect()}
    assert got == brute_lines(rows, sites)
    # Whatever its share of a document, as soon as others hold it among text of their own.
    assert got[1000] == "" and all("many sites" not in (text or "") for text in got.values())


def test_copies_keep_their_lines_and_short_lines_need_more_sites(spark):
    copied = "\n".join(f"line {j} of a text that many copied" for j in range(6))
    rows = [(i, f"{copied}\nand {i}", f"s{i}") for i in range(20)]
    rows += [(100 + i, f"own words of page {i} are here\nRead more\nAll rights", f"s{i}") for i in range(5)]
    rows += [(200 + i, f"other words of page {i} are here\nRead more", f"s{50 + i}") for i in range(3)]
    # Rows without an id and rows that repeat one go by their own texts.
    rows += [(None, "a page without any id at all\nRead more", "s90"), (100, "a second text with this id\nRead more", "s91")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = sorted(r.text for r in lines.clean_lines(docs, sites=5).collect())
    assert got == sorted(brute_texts(rows, 5))
    assert sum(text.startswith(copied) for text in got) == 20
    assert not any("Read more" in text for text in got) and sum("All rights" in text for text in got) == 5


def test_odd_lines(odd_docs, no_docs):
    clean = lines.clean_lines(odd_docs)
    assert clean.columns == odd_docs.columns
    assert sorted(map(str, clean.collect())) == sorted(map(str, odd_docs.collect()))
    assert lines.clean_lines(no_docs).count() == lines.line_report(no_docs).count() == 0
