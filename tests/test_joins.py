import pytest
from pyspark.sql import functions as F

from grantlens.operators import groups, joins
from grantlens.operators.prefix import prefix_join


def bag(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def hot_rows(spark):
    """One key holds half the rows, mostly copies; some keys are NULL."""
    return spark.range(2000).selectExpr(
        "CASE WHEN id < 1000 THEN 'hot' WHEN id % 50 = 0 THEN NULL ELSE concat('k', id % 300) END AS k",
        "id % 7 AS v",
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, hot_rows, how):
    lookup = spark.range(200).selectExpr(
        "CASE WHEN id = 0 THEN 'hot' ELSE concat('k', id) END AS k", "id * 2 AS w"
    )
    plain = hot_rows.join(lookup, "k", how)
    salted = joins.salted_join(hot_rows, lookup, "k", how).select(plain.columns)
    assert bag(salted) == bag(plain)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_on_binary_keys(spark, hot_rows, how):
    """The frequency sketch refuses binary values."""
    rows = hot_rows.withColumn("k", F.unhex(F.md5("k")))
    lookup = spark.range(200).selectExpr(
        "unhex(md5(CASE WHEN id = 0 THEN 'hot' ELSE concat('k', id) END)) AS k", "id * 2 AS w"
    )
    hot = joins.hot_keys(rows, "k")
    assert hot.schema["k"].dataType == rows.schema["k"].dataType
    assert bag(hot.where("k = unhex(md5('hot'))")) == bag(spark.sql("SELECT unhex(md5('hot')) AS k"))
    plain = rows.join(lookup, "k", how)
    assert bag(joins.salted_join(rows, lookup, "k", how).select(plain.columns)) == bag(plain)


def test_only_frequent_keys_are_hot(hot_rows):
    hot = {row.k for row in joins.hot_keys(hot_rows, "k").collect()}
    assert "hot" in hot
    assert len(hot) <= joins.HOT_KEYS


def test_right_side_joins_are_refused(hot_rows):
    with pytest.raises(ValueError):
        joins.salted_join(hot_rows, hot_rows, "k", "full")


def test_lookup_join_broadcasts_only_what_fits(spark, hot_rows):
    lookup = spark.range(5).selectExpr("concat('k', id) AS k", "id AS w")
    small = joins.lookup_join(hot_rows, lookup, "k")
    large = joins.lookup_join(hot_rows, lookup, "k", max_bytes=0)
    assert bag(small) == bag(large.select(small.columns))
    assert "_salt" in large._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" not in small._jdf.queryExecution().optimizedPlan().toString()


def test_measured_bytes_grow_with_rows_and_text(spark):
    short = spark.range(10).selectExpr("id", "'x' AS t", "array('a', 'b') AS a")
    long = spark.range(10).selectExpr("id", "repeat('x', 1000) AS t", "array('a', 'b') AS a")
    assert joins.measured_bytes(short) < joins.measured_bytes(long)
    assert joins.measured_bytes(long) > 10_000


def test_unfold_repeats_rows_in_blocks(spark):
    rows = spark.createDataFrame([("a", 7), ("b", 1)], "k string, n bigint")
    assert bag(joins.unfold(rows, "n", block=3)) == bag(
        spark.createDataFrame([("a",)] * 7 + [("b",)], "k string")
    )


@pytest.mark.parametrize("small", [True, False])
def test_prefix_join(spark, small):
    keys = spark.createDataFrame(
        [("Acme",), ("a",), ("ACME l",), ("acme",), ("",), (None,), ("50%",), ("zz",)], "k string"
    )
    values = spark.createDataFrame(
        [("ACME LIMITED",), ("acme inc",), ("Other",), ("500",), ("50% off",), (None,), ("",)],
        "v string",
    )
    pairs = {tuple(row) for row in prefix_join(keys, values, "k", "v", small=small).collect()}
    expected = {
        (k.k, v.v)
        for k in keys.collect()
        for v in values.collect()
        if k.k and v.v and v.v.lower().startswith(k.k.lower())
    }
    assert pairs == expected


def test_prefix_join_equals_comparing_all(spark):
    words = [f"{a}{b}{c}" for a in "abA" for b in "xyé" for c in ("", "z", "zz", "q")]
    keys = spark.createDataFrame([(word,) for word in words], "k string")
    values = spark.createDataFrame([(word + tail,) for word in words for tail in ("", "m", "zé")], "v string")
    naive = keys.distinct().join(
        values.distinct(), F.startswith(F.lower("v"), F.lower("k"))
    ).where("k <> ''")
    assert bag(prefix_join(keys, values, "k", "v")) == bag(naive)


def test_prefix_join_has_no_wide_comparison(spark):
    keys = spark.createDataFrame([("ab",)], "k string")
    values = spark.createDataFrame([("abc",)], "v string")
    plan = prefix_join(keys, values, "k", "v")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_ids_of_a_group_are_rows_with_nulls_and_copies(spark):
    rows = spark.createDataFrame(
        [("Acme", 1), ("Acme", 2), ("Acme", 2), ("Acme", None), (None, 5), ("B", 6)],
        "name string, gan int",
    )
    found = {tuple(row) for row in groups.group_ids(rows, "name", "gan").collect()}
    assert found == {("Acme", 1, 1), ("Acme", 2, 2), ("Acme", None, 1), (None, 5, 1), ("B", 6, 1)}
