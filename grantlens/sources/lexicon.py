"""Word lists (lexicons): load, type, describe.

A lexicon is one word per row with true/false category columns.  Two file
layouts exist, both plain comma-separated text without quoting and with one
header line.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# ---- fixed values -----------------------------------------------------------
# Cells of the finance layout, by position.
FINANCE_COLUMNS = {
    "word": "string",
    "sequence_number": "int",
    "word_count": "int",
    "word_proportion": "double",
    "average_proportion": "double",
    "std_dev_prop": "double",
    "doc_count": "int",
    "negative": "int",
    "positive": "int",
    "uncertainty": "int",
    "litigious": "int",
    "constraining": "int",
    "superfluous": "int",
    "interesting": "int",
    "modal_number": "int",
    "irregular_verb": "int",
    "harvard_iv": "int",
    "syllables": "int",
    "source": "string",
}
# Cells of the inquirer layout, by position; every cell after the second is a flag.
INQUIRER_COLUMNS = (
    "word", "source", "positiv", "negativ", "pstv", "affil", "ngtv", "hostile",
    "strong", "power", "weak", "submit", "active", "passive",
)
# Finance category columns that hold the year a word was listed, 0 for never.
FINANCE_YEARS = ("negative", "positive", "uncertainty", "litigious", "constraining")
# Values of modal_number.
STRONG_MODAL, MODERATE_MODAL, WEAK_MODAL = 1, 2, 3
# Category order of the finance metadata (moderate modal is not among them).
FINANCE_CATEGORIES = (
    "negative", "positive", "uncertainty", "litigious", "constraining",
    "strong_modal", "weak_modal",
)
INQUIRER_CATEGORIES = INQUIRER_COLUMNS[2:]
# Output name -> lexicon column, in report order.
FINANCE_FLAGS = {
    "positive": "positive",
    "negative": "negative",
    "uncertainty": "uncertainty",
    "litigious": "litigious",
    "modal_weak": "weak_modal",
    "modal_moderate": "moderate_modal",
    "modal_strong": "strong_modal",
    "constraining": "constraining",
}
INQUIRER_FLAGS = {name: name for name in INQUIRER_CATEGORIES}
STOP_WORDS = tuple(
    """
    ME MY MYSELF WE OUR OURS OURSELVES YOU YOUR YOURS YOURSELF YOURSELVES HE HIM
    HIS HIMSELF SHE HER HERS HERSELF IT ITS ITSELF THEY THEM THEIR THEIRS
    THEMSELVES WHAT WHICH WHO WHOM THIS THAT THESE THOSE AM IS ARE WAS WERE BE
    BEEN BEING HAVE HAS HAD HAVING DO DOES DID DOING AN THE AND BUT IF OR BECAUSE
    AS UNTIL WHILE OF AT BY FOR WITH ABOUT BETWEEN INTO THROUGH DURING BEFORE
    AFTER ABOVE BELOW TO FROM UP DOWN IN OUT ON OFF OVER UNDER AGAIN FURTHER THEN
    ONCE HERE THERE WHEN WHERE WHY HOW ALL ANY BOTH EACH FEW MORE MOST OTHER SOME
    SUCH NO NOR NOT ONLY OWN SAME SO THAN TOO VERY CAN JUST SHOULD NOW
    """.split()
)
# -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Lexicon:
    """A typed word list and how to score with it.

    ``flags`` maps output names to true/false columns of ``words``.  With
    ``measures`` the score also has word length, vocabulary and syllables.
    """

    name: str
    words: DataFrame
    flags: Mapping[str, str]
    measures: bool = False


def finance_lexicon(words: DataFrame) -> Lexicon:
    return Lexicon("finance", words, FINANCE_FLAGS, measures=True)


def inquirer_lexicon(words: DataFrame) -> Lexicon:
    return Lexicon("inquirer", words, INQUIRER_FLAGS)


def read_lines(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Cells of every line but the header, as text, plus the ``line`` position.

    The file is read in splits; file, split offset and row order within the split
    give the position, so the order survives parallel reading.
    """
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("quote", "")
        .csv(path)
        .select(
            "*",
            F.struct(
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("offset"),
                F.monotonically_increasing_id().alias("row"),
            ).alias("line"),
        )
    )


def last_per_word(lines: DataFrame) -> DataFrame:
    """One row per upper-cased word: the line that comes last wins."""
    cells = [name for name in lines.columns if name not in ("word", "line")]
    return (
        lines.withColumn("word", F.upper("word"))
        .groupBy("word")
        .agg(F.max_by(F.struct(*cells), F.col("line")).alias("kept"))
        .select("word", "kept.*")
    )


def type_finance(lines: DataFrame) -> DataFrame:
    """Finance cells with types, category flags and the stop-word flag.

    A cell that is not of its type stops the load, and so does a number that is not
    there, as on a line that is too short.
    """
    missing = F.raise_error(F.lit("a line of the lexicon has fewer cells than it needs"))
    typed = lines.select(
        *[
            F.col(name) if kind == "string" else F.coalesce(F.col(name).cast(kind), missing).alias(name)
            for name, kind in FINANCE_COLUMNS.items()
        ]
    )
    flags = {name: F.col(name) != 0 for name in FINANCE_YEARS}
    flags["strong_modal"] = F.col("modal_number") == STRONG_MODAL
    flags["moderate_modal"] = F.col("modal_number") == MODERATE_MODAL
    flags["weak_modal"] = F.col("modal_number") == WEAK_MODAL
    return with_stop_word_flag(typed.withColumns(flags))


def type_inquirer(lines: DataFrame) -> DataFrame:
    """Inquirer cells as flags: a filled cell is true."""
    filled = [
        F.coalesce(F.length(name) > 0, F.lit(False)).alias(name)
        for name in INQUIRER_CATEGORIES
    ]
    return with_stop_word_flag(lines.select("word", "source", *filled))


def with_stop_word_flag(words: DataFrame) -> DataFrame:
    listed = ", ".join(f"'{word}'" for word in STOP_WORDS)
    return words.withColumn("stop_word", F.expr(f"upper(word) IN ({listed})"))


def load_finance(spark: SparkSession, path: str) -> DataFrame:
    return type_finance(last_per_word(read_lines(spark, path, tuple(FINANCE_COLUMNS))))


def load_inquirer(spark: SparkSession, path: str) -> DataFrame:
    return type_inquirer(last_per_word(read_lines(spark, path, INQUIRER_COLUMNS)))


def finance_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Header line, category names, stop words and total document count.

    The count covers every line, also those a later duplicate replaces.
    """
    lines = read_lines(spark, path, tuple(FINANCE_COLUMNS))
    header = (
        spark.read.text(path)
        .where(F.col("_metadata.file_block_start") == 0)
        .limit(1)
        .first()
    )
    return total_documents(lines).select(
        F.lit(header[0] if header else None).alias("header"),
        F.array(*map(F.lit, FINANCE_CATEGORIES)).alias("categories"),
        F.array(*map(F.lit, STOP_WORDS)).alias("stop_words"),
        "total_documents",
    )


def total_documents(lines: DataFrame) -> DataFrame:
    return lines.agg(F.sum(F.col("doc_count").cast("long")).alias("total_documents"))


def category_words(words: DataFrame, categories: Sequence[str]) -> DataFrame:
    """One row per category and word that has it, with a count that starts at 0."""
    return (
        words.unpivot(["word"], list(categories), "category", "flag")
        .where("flag")
        .select("category", "word", F.lit(0).alias("count"))
    )
