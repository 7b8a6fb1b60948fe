import dataclasses

import pytest
from pyspark.sql import functions as F

from checks import inputs
from grantlens.operators.score import score_documents
from grantlens.plans import scoring
from grantlens.sources import lexicon as lx, sinks
from grantlens.sources.tables import read_text_files, sql_options
from grantlens.streaming.scoring import score_batches


@pytest.fixture(scope="module")
def finance(spark):
    given = spark.sql(
        "SELECT * FROM VALUES ('THE', 2011, 0, 0, 1), ('OF', 2009, 0, 0, 1), ('AND', 0, 2009, 1, 1), "
        "('THAT', 0, 0, 2, 1), ('FROM', 0, 0, 3, 2), ('A', 0, 2009, 0, 1), ('2009', 0, 2009, 0, 1), "
        "('und', 0, 2009, 0, 1) AS t(word, negative, positive, modal_number, syllables)"
    )
    cells = given.select(
        *[
            (F.col(name) if name in given.columns else F.lit("0")).cast("string").alias(name)
            for name in lx.FINANCE_COLUMNS
        ]
    )
    return lx.finance_lexicon(lx.type_finance(cells))


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(
        [(1, "The cost of that, and more. A 2009 UND und"), (2, "xyzzy"), (3, ""), (4, None), (5, "the ozoneNone")],
        "id int, text string",
    )


def by_id(df):
    return {row.id: row for row in df.collect()}


def test_finance_profile(texts, finance):
    rows = by_id(scoring.finance_profile(texts, finance, "id"))
    assert set(rows) == {1, 2, 3, 4, 5}
    first = rows[1]
    assert first.word_count == 6 and first.vocabulary == 5
    assert first.negative == 2 / 6 * 100 and first.positive == 3 / 6 * 100
    assert first.modal_strong == first.modal_moderate == 1 / 6 * 100 and first.modal_weak == 0.0
    assert first.avg_syllables_per_word == 1.0
    assert first.avg_word_length == (3 + 2 + 4 + 3 + 3 + 3) / 6
    assert (first.alphabetic, first.digits, first.numbers) == (5, 4, 1)
    assert rows[5].word_count == 1
    for empty in (rows[2], rows[3], rows[4]):
        assert empty.word_count == empty.vocabulary == 0 and empty.positive == 0.0


def test_profile_without_broadcast_is_the_same(texts, finance):
    stored = scoring.stored_texts(texts)
    sent = score_documents(stored, [finance], "id")
    shuffled = score_documents(stored, [finance], "id", max_bytes=0)
    assert by_id(sent) == by_id(shuffled)


def test_profile_plan_is_one_broadcast_and_one_shuffle(texts, finance):
    df = score_documents(texts, [finance], "id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 1
    assert plan.count("Exchange hashpartitioning") == 1
    assert "SortMergeJoin" not in plan and "Python" not in plan


def test_inquirer_profile(spark, texts):
    lexicon = inputs.inquirer(spark)
    row = by_id(scoring.inquirer_profile(texts, lexicon, "id"))[1]
    assert row.word_count == 6
    assert set(lx.INQUIRER_CATEGORIES) < set(row.asDict())
    assert all(0 <= row[name] <= 100 for name in lx.INQUIRER_CATEGORIES)


@pytest.mark.parametrize("max_bytes", [1 << 20, 0])
def test_pending_lists_each_document_once(spark, texts, max_bytes):
    both = spark.createDataFrame([(1,)], "id int")
    first = spark.createDataFrame([(1,), (2,), (2,)], "id int")
    rows = by_id(scoring.pending(texts, {"a": first, "b": both}, "id", max_bytes))
    assert set(rows) == {2, 3, 4, 5}
    assert (rows[2].needs_a, rows[2].needs_b) == (False, True)
    assert (rows[3].needs_a, rows[3].needs_b) == (True, True)


def test_scoring_again_appends_nothing(spark, texts, finance, tmp_path):
    inquirer = inputs.inquirer(spark)
    paths = str(tmp_path / "analysis"), str(tmp_path / "sentiment")
    one = texts.where("id = 1")
    sinks.append_table(sinks.stamped(scoring.finance_profile(one, finance, "id")), paths[0])
    sinks.append_table(sinks.stamped(scoring.inquirer_profile(texts.where("id < 3"), inquirer, "id")), paths[1])
    for _ in range(2):
        scoring.append_pending(texts, finance, inquirer, *paths, "id")
    for path in paths:
        table = spark.read.parquet(path)
        assert sorted(row.id for row in table.collect()) == [1, 2, 3, 4, 5]
        assert table.where("created is null").count() == 0


def test_stream_of_texts_is_scored_once(spark, texts, finance, tmp_path):
    inquirer = inputs.inquirer(spark)
    source = str(tmp_path / "in")
    paths = str(tmp_path / "analysis"), str(tmp_path / "sentiment")
    sinks.append_table(sinks.stamped(scoring.finance_profile(texts.limit(0), finance, "id")), paths[0])
    sinks.append_table(sinks.stamped(scoring.inquirer_profile(texts.limit(0), inquirer, "id")), paths[1])
    for batch in ("id < 3", "id > 1"):
        texts.where(batch).write.mode("append").parquet(source)
        stream = spark.readStream.schema(texts.schema).parquet(source)
        query = (
            stream.writeStream.foreachBatch(score_batches(finance, inquirer, *paths, "id"))
            .option("checkpointLocation", str(tmp_path / "state"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    for path in paths:
        ids = sorted(row.id for row in spark.read.parquet(path).select("id").collect())
        assert ids == [1, 2, 3, 4, 5]


def test_file_report(spark, finance, tmp_path):
    (tmp_path / "a.txt").write_bytes("The Mayor of May �".encode() + b"\xff\xe2\x82X\n")
    (tmp_path / "b.txt").write_text("\n")
    files = read_text_files(spark, str(tmp_path / "*.txt"))
    report = scoring.file_report(files, finance)
    assert report.columns == list(scoring.FILE_REPORT)
    rows = {row.file_name.rsplit("/", 1)[1]: row for row in report.collect()}
    text = "The Mayor of May �X\n"
    assert rows["a.txt"].file_size == len(text)
    assert rows["a.txt"].word_count == 2
    assert rows["a.txt"].alphabetic == len("THE") + len("OR") + len("OF") + len("X")
    assert rows["b.txt"].file_size == 1 and rows["b.txt"].word_count == 0
    sinks.export_csv(scoring.with_headings(report), str(tmp_path / "out"))
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert back.columns == list(scoring.FILE_REPORT.values())
    assert back.count() == 2


@pytest.mark.parametrize("kind", ["int", "bigint"])
def test_pending_is_the_same_on_each_way(spark, kind):
    """NULL ids are open; rows that share an id are kept or left out together."""
    docs = spark.createDataFrame(
        [(1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "e"), (None, "f"), (0, "g"), (-5, "h"), (-32768, "i")],
        f"id {kind}, text string",
    )
    first = spark.createDataFrame([(1,), (2,), (2,), (None,), (-5,)], f"id {kind}")
    second = spark.createDataFrame([(2,), (None,), (0,), (-32768,), (-5,)], f"id {kind}")
    ways = [{}, {"max_list_bytes": 0}, {"max_bytes": 0}]
    bags = [
        sorted(map(str, scoring.pending(docs, {"a": first, "b": second}, "id", **way).collect()))
        for way in ways
    ]
    assert bags[0] == bags[1] == bags[2] and len(bags[0]) == 7


def test_texts_stay_in_place_with_many_finished_ids(spark):
    docs = spark.range(20_000).select((F.col("id") * 1000 - 5_000_000).alias("id"), F.lit("t").alias("text"))
    done = spark.range(-2_000_000, 8_000_000)
    opened = scoring.pending(docs, {"a": done}, "id")
    plan = opened._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert opened.count() == 10_000


@pytest.mark.parametrize("max_bytes", [1 << 26, 0])
def test_words_that_differ_in_case_are_one(spark, texts, finance, max_bytes):
    again = finance.words.withColumn("word", F.lower("word"))
    twice = dataclasses.replace(finance, words=finance.words.unionByName(again))
    stored = scoring.stored_texts(texts)
    expected = by_id(score_documents(stored, [finance], "id"))
    assert by_id(score_documents(stored, [twice], "id", max_bytes=max_bytes)) == expected


def test_the_first_run_makes_the_tables(spark, texts, finance, tmp_path):
    inquirer = inputs.inquirer(spark)
    paths = [str(tmp_path / "a"), str(tmp_path / "s")]
    for _ in range(2):
        scoring.append_pending(texts, finance, inquirer, *paths, "id")
    for path in paths:
        assert sorted(row.id for row in spark.read.parquet(path).collect()) == [1, 2, 3, 4, 5]


def test_sql_tables_are_read_in_ranges():
    options = sql_options("jdbc:x", "grants", "patent", "id", (1, 900), 30)
    assert options["dbtable"] == "grants.patent"
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "30"


def test_words_are_counted_where_a_text_is_read(spark, tmp_path):
    from grantlens.functions import text as tx
    from grantlens.operators.groups import split_repeated
    from grantlens.operators.score import _counted_words

    texts = [(1, "a A b ß ss"), (2, ""), (3, None), (4, "of the of"), (4, "of the of"), (4, "x"), (None, "of"), (None, "of")]
    path = str(tmp_path / "docs")
    spark.createDataFrame(texts, "doc_id int, text string").write.parquet(path)
    docs = spark.read.parquet(path)
    alone, others = split_repeated(docs, "doc_id")
    assert sorted(row.doc_id for row in alone.collect()) == [1, 2, 3] and others.count() == 5
    assert split_repeated(docs, "doc_id", max_bytes=-1)[1].count() == len(texts)
    counted = _counted_words(docs, ["doc_id"], "doc_id", "text")
    together = (
        docs.select("doc_id", F.explode_outer(tx.tokens(F.col("text"))).alias("word"))
        .withColumn("word", F.upper("word"))
        .groupBy("doc_id", "word")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("n", F.when(F.col("word").isNotNull(), F.col("n")))
    )
    assert sorted(map(str, counted.collect())) == sorted(map(str, together.collect()))
    # Only texts that share an id are counted over a shuffle.
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1 and "sort_array" in plan


def test_unlisted_words_go_before_the_aggregate(spark, capsys):
    """Only listed words reach the aggregate, and no document is lost: not one without words, nor one without an id."""
    lexicon = inputs.finance(spark)
    rows = [(1, "the of the xyz 12"), (1, "the of the xyz 12"), (2, "xyz qqq"), (3, ""), (4, None), (5, " .,"), (None, "of the"), (6, "Erth 2009 2011 A")]
    docs = spark.createDataFrame(rows, "id long, text string")
    scored = score_documents(docs, [lexicon], "id")
    got = sorted((str(r.id), r.finance.word_count, r.finance.vocabulary) for r in scored.collect())
    assert got == [("1", 6, 2), ("2", 0, 0), ("3", 0, 0), ("4", 0, 0), ("5", 0, 0), ("6", 1, 1), ("None", 2, 2)]
    scored.explain()
    plan = capsys.readouterr().out
    assert plan.index("ObjectHashAggregate") < plan.index("Filter (isnull(word") < plan.index("BroadcastHashJoin")
    # Characters are counted without a string for each of them.
    assert "[^A-Z]+" in plan and "[A-Z], 0)" not in plan
