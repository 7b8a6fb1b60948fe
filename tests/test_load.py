from pyspark.sql import functions as F

from grantlens.operators import load
from grantlens.sources import sinks


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_first_row_per_key_by_order_column(spark):
    batch = spark.createDataFrame(
        [(1, 30, "late"), (1, 10, "first"), (2, 5, "only"), (1, 20, "mid")], "k int, at int, v string"
    )
    assert rows(load.first_per_key(batch, "k", ["at"])) == [(1, 10, "first"), (2, 5, "only")]


def test_insert_if_absent_twice_is_once(spark):
    target = spark.createDataFrame([(2,)], "k int")
    batch = spark.createDataFrame([(1, 1), (1, 2), (2, 3), (None, 4), (None, 5)], "k int, at int")
    new = load.insert_if_absent(batch, target, "k", ["at"])
    assert rows(new) == [(1, 1)]
    again = load.insert_if_absent(batch, target.unionByName(new.select("k")), "k", ["at"])
    assert again.count() == 0
    kept = load.insert_if_absent(batch, target, "k", ["at"], null_keys="keep")
    assert rows(kept) == [(1, 1), (None, 4), (None, 5)]


def test_children_need_a_parent(spark):
    children = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    parents = spark.createDataFrame([(1,), (1,)], "k int")
    kept, rejects = load.guard_children(children, parents, "k")
    assert rows(kept) == [(1, "a"), (1, "b")]
    assert rows(rejects.select("v", "reason")) == [("c", "no parent row"), ("d", "no parent row")]


def test_rejects_carry_the_first_reason(spark):
    raw = spark.createDataFrame([("1", "1/2/2016"), ("x", "x"), ("2", None)], "n string, d string")
    good, rejects = load.split_rejects(
        raw,
        {
            "number": F.col("n").try_cast("int").isNotNull(),
            "date": F.try_to_timestamp("d", F.lit("d/M/yyyy")).isNotNull(),
        },
    )
    assert rows(good) == [("1", "1/2/2016")]
    assert rows(rejects.select("n", "reason")) == [("2", "date"), ("x", "number")]


def test_tables_are_replaced_and_exported(spark, tmp_path):
    path, csv = str(tmp_path / "t"), str(tmp_path / "csv")
    first = spark.createDataFrame([(1, "a")], "k int, v string")
    second = spark.createDataFrame([(2, 'b "q", c')], "k int, v string")
    for df in (first, second):
        sinks.replace_table(df, path)
        sinks.export_csv(df, csv)
    assert rows(spark.read.parquet(path)) == [(2, 'b "q", c')]
    back = spark.read.option("header", True).option("escape", '"').schema("k int, v string").csv(csv)
    assert rows(back.select("k")) == [(2,)]
    sinks.append_table(first, path)
    assert spark.read.parquet(path).count() == 2


def test_catalog_table_is_replaced(spark, tmp_path):
    spark.sql(f"CREATE DATABASE results LOCATION '{tmp_path}/db'")
    try:
        for value in ("a", "b"):
            sinks.replace_catalog_table(spark.createDataFrame([(value,)], "v string"), "results.t")
        assert rows(spark.table("results.t")) == [("b",)]
    finally:
        spark.sql("DROP DATABASE results CASCADE")


def test_a_hot_key_is_one_row_before_the_shuffle(spark):
    batch = spark.range(20_000).selectExpr("CASE WHEN id % 2 = 0 THEN 0 ELSE id END AS k", "id AS at")
    first = load.first_per_key(batch, "k", ["at"])
    assert first.where("k = 0").first()["at"] == 0
    assert first.count() == 10_001
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_whole_rows_are_not_sorted_for_the_first_of_a_key(spark):
    batch = spark.range(1000).selectExpr("id % 300 AS k", "id AS at", "array(cast(id AS string)) AS w")
    plan = load.first_per_key(batch, "k", ["at"])._jdf.queryExecution().optimizedPlan().toString()
    assert "shuffle_hash" in plan
    # Whole rows are compared among those of one key and place only.
    wide = [line for line in plan.splitlines() if "Aggregate [" in line and "w#" in line]
    assert wide and all("Aggregate [k#" in line and ", at#" in line.partition("]")[0] for line in wide)



def test_rows_tied_for_first_are_told_apart_by_the_others(spark):
    batch = spark.createDataFrame(
        [(1, None, "b", ["x"]), (1, None, "a", ["y"]), (1, 0, "0", None), (None, 2, "n", None), (None, 2, None, ["z"]), (2, 1, "s", None)],
        "k int, at int, v string, w array<string>",
    )
    assert rows(load.first_per_key(batch, "k", ["at"])) == rows(
        spark.createDataFrame([(1, None, "a", ["y"]), (None, 2, None, ["z"]), (2, 1, "s", None)], batch.schema)
    )
    new = load.insert_if_absent(batch, spark.createDataFrame([(2,)], "k int"), "k", ["at"])
    assert rows(new) == [(1, None, "a", ["y"])]
