"""The pipeline against its operators' plain versions, and every query of the package against SQL."""

import re

import pytest

import __spark_entry__
import corpus_pipeline
from checks.compare import bag, connect
from grantlens.llm import pii, quality
from grantlens.llm.oracle import ORACLE
from grantlens.llm.queries import QUERIES
from grantlens.session import tune

from .test_exact_lines import brute_lines
from .test_near import brute
from .test_quality import counts


def test_everything_is_registered():
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    numbers = {int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES}
    assert numbers == set(range(1, 14)) and set(ORACLE) <= set(QUERIES)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near", "pii", "packing"]


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_agrees_with_sql(spark, small_tables, name):
    result = QUERIES[name](tune(spark), small_tables)
    found = connect(small_tables).execute(ORACLE[name])
    names = [column[0] for column in found.description]
    assert sorted(names) == sorted(result.columns)
    assert bag(result.collect(), result.columns) == bag(found.fetchall(), names)


def test_stages(spark, small_tables):
    """Each stage on what its predecessor kept, by plain loops over its rows."""
    tune(spark)
    docs = spark.read.parquet(f"{small_tables}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = corpus_pipeline.staged(stage(spark, docs, small_tables), f"test-{name}")
        after = docs.collect()
        if name != "packing":
            assert docs.columns == columns
            assert all(r.n_chars == len(r.text) for r in after)
        if name == "quality":
            # So few labels certify no cutoff: the base rules alone decide.
            passes = lambda n, _c, _s, _l, again: n >= 50 and 100 * again <= 50 * n
            assert {r.doc_id for r in after} == {i for i, r in before.items() if passes(*counts(r.text))}
        elif name == "lines":
            rows = [(i, r.text, r.source) for i, r in before.items()]
            assert {r.doc_id: r.text for r in after} == brute_lines(rows, corpus_pipeline.lines.SITES)
        elif name == "near":
            expected = brute([(i, r.text) for i, r in before.items()])
            assert {r.doc_id for r in after} == {i for i, (_, _, stays) in expected.items() if stays}
        elif name == "pii":
            assert {r.doc_id: r.text for r in after} == {
                i: pii.redacted(r.text, pii.find_spans(r.text)) for i, r in before.items()
            }
        else:
            assert {r.doc_id for r in after} == set(before)
        kept.append(len({r.doc_id for r in after}))
    assert kept == sorted(kept, reverse=True) and quality.LEAST_WORDS == 50


def test_stages_take_odd_and_empty_tables(spark, small_tables, odd_docs, no_docs):
    """Plain columns, NULLs, repeated rows and columns named like those made on the way."""
    for docs, least in ((odd_docs, 1), (no_docs, 0)):
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.staged(stage(spark, docs, small_tables), "test-odd")
        assert docs.count() >= least
