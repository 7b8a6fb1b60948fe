import pytest
from pyspark.sql import functions as F

from grantlens.sources import lexicon as lx

HEADER = ",".join(lx.FINANCE_COLUMNS)


def line(word, doc_count=10, negative=0, positive=0, modal=0, syllables=1):
    return f"{word},1,5,0.1,0.2,0.3,{doc_count},{negative},{positive},0,0,0,0,0,{modal},0,0,{syllables},src"


@pytest.fixture
def finance_file(tmp_path):
    path = tmp_path / "finance.csv"
    path.write_text(
        "\n".join(
            [HEADER, line("THE", 10, positive=2009), line("AND", modal=1), line("THAT", modal=2),
             line("FROM", modal=3), line("und", positive=2009), line("THE", 5, negative=2011)]
        )
        + "\n"
    )
    return str(path)


def test_last_duplicate_wins_and_keys_are_upper_cased(spark, finance_file):
    words = {row.word: row for row in lx.load_finance(spark, finance_file).collect()}
    assert set(words) == {"THE", "AND", "THAT", "FROM", "UND"}
    assert words["THE"].negative and not words["THE"].positive
    assert words["THE"].stop_word and not words["UND"].stop_word
    modal = [(row.strong_modal, row.moderate_modal, row.weak_modal) for row in map(words.get, ("AND", "THAT", "FROM", "UND"))]
    assert modal == [(True, False, False), (False, True, False), (False, False, True), (False, False, False)]


def test_order_survives_small_splits(spark, tmp_path):
    path = tmp_path / "long.csv"
    lines = [line(f"W{i % 100}", doc_count=i) for i in range(3000)]
    path.write_text("\n".join([HEADER, *lines]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        counts = {row.word: row.doc_count for row in lx.load_finance(spark, str(path)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert counts == {f"W{i}": 2900 + i for i in range(100)}


def test_metadata_counts_every_line(spark, finance_file):
    row = lx.finance_metadata(spark, finance_file).first()
    assert row.total_documents == 55
    assert row.header == HEADER
    assert row.categories == list(lx.FINANCE_CATEGORIES) and "moderate_modal" not in row.categories
    assert len(row.stop_words) == 120


def test_bad_number_stops_the_load(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text(HEADER + "\n" + line("X", doc_count="many") + "\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        lx.load_finance(spark, str(path)).collect()


def test_inquirer_flags_and_last_cell(spark, tmp_path):
    path = tmp_path / "inquirer.csv"
    path.write_text(
        ",".join(lx.INQUIRER_COLUMNS) + "\n"
        + "good,src,Positiv,,,,,,,,,,,\n"
        + 'odd,"src",,,,,,,,,,,,Passive\n'
    )
    words = {row.word: row for row in lx.load_inquirer(spark, str(path)).collect()}
    assert words["GOOD"].positiv and not words["GOOD"].passive
    assert words["ODD"].passive and not words["ODD"].positiv
    assert words["ODD"].source == '"src"'


def test_category_words(spark, finance_file):
    words = lx.category_words(lx.load_finance(spark, finance_file), lx.FINANCE_CATEGORIES)
    assert {tuple(row) for row in words.collect()} == {
        ("negative", "THE", 0), ("positive", "UND", 0), ("strong_modal", "AND", 0), ("weak_modal", "FROM", 0)
    }


def test_stop_words_are_distinct():
    assert len(set(lx.STOP_WORDS)) == len(lx.STOP_WORDS) == 120


def test_short_line_stops_the_load(spark, tmp_path):
    path = tmp_path / "short.csv"
    path.write_text(HEADER + "\n" + line("X") + "\nshort,1\n")
    with pytest.raises(Exception, match="fewer cells"):
        lx.load_finance(spark, str(path)).collect()
