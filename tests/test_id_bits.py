import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from grantlens.operators.id_bits import bitmaps_fit, id_bitmaps, is_whole, with_membership

EDGES = [0, 1, -1, 32767, 32768, 32769, -32767, -32768, -32769, 2**31, -(2**31), 2**63 - 1, -(2**63), None]
IDS = st.lists(st.one_of(st.sampled_from(EDGES), st.integers(-70_000, 70_000), st.none()), max_size=60)


@settings(max_examples=15, deadline=None)
@given(IDS, IDS)
def test_membership_is_that_of_a_set(spark, ids, asked):
    have = spark.createDataFrame([(i,) for i in ids], "id bigint")
    rows = spark.createDataFrame(list(enumerate(asked + ids)), "at int, id bigint")
    marked = with_membership(rows, id_bitmaps(have, "id"), "id", "inside").collect()
    members = {i for i in ids if i is not None}
    assert len(marked) == len(asked) + len(ids)
    assert all(row.inside == (row.id in members) for row in marked)


def test_bitmaps_are_measured(spark):
    close = spark.range(100_000)
    wide = spark.range(100).select((F.col("id") * 1_000_000).alias("id"))
    assert bitmaps_fit(close, "id", 21_000) and not bitmaps_fit(wide, "id", 21_000)
    assert id_bitmaps(close, "id").count() == 5


@pytest.mark.parametrize("kind, whole", [("int", True), ("bigint", True), ("string", False), ("double", False)])
def test_only_whole_numbers_have_bits(spark, kind, whole):
    assert is_whole(spark.createDataFrame([], f"id {kind}"), "id") == whole
