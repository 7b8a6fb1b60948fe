"""Lexicon scores per document.

One pass over the texts serves any number of lexicons:

    texts -> words (explode) -> broadcast join with the merged lexicon
          -> listed words only -> one aggregate per document

Words of a document sit together in one task, so the partial aggregate leaves
one row per document for the only shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from grantlens.functions import text as tx
from grantlens.operators.groups import split_repeated
from grantlens.operators.joins import (
    BROADCAST_BYTES,
    fits_broadcast,
    hot_keys,
    salted_join_folded,
)
from grantlens.session import staged
from grantlens.sources.lexicon import Lexicon

CHAR_STATS = ("alphabetic", "digits", "numbers")


def char_stats(text: Column) -> dict[str, Column]:
    """Letter, digit and number counts of the text as given (capitals only)."""
    return {
        "alphabetic": tx.capital_count(text),
        "digits": tx.digit_count(text),
        "numbers": tx.number_count(text),
    }


def merged_words(lexicons: Sequence[Lexicon]) -> DataFrame:
    """All lexicons as one table keyed by word: what one occurrence of the word adds to
    each count, NULL where a lexicon does not list it.  Words that differ in case only
    are one word; of their rows the one with the largest values counts.

    Words that can never count (one letter, all digits) are left out here, once,
    instead of being tested for every token.
    """
    tables = []
    for lexicon in lexicons:
        adds = [column.alias(f"{lexicon.name}_{name}") for name, column in _adds(lexicon).items()]
        one = lexicon.words.groupBy(F.upper("word").alias("word")).agg(
            F.max(F.struct(*adds)).alias("_adds")
        )
        tables.append(one.select("word", "_adds.*"))
    merged = reduce(lambda left, right: left.join(right, "word", "full"), tables)
    return merged.where(tx.is_countable(F.col("word")))


def _adds(lexicon: Lexicon) -> dict[str, Column]:
    adds = {"word_count": F.lit(1)}
    adds |= {name: F.col(column).cast("int") for name, column in lexicon.flags.items()}
    if lexicon.measures:
        adds |= {"syllables": F.col("syllables"), "letters": F.length(F.upper("word"))}
    return adds


def score_documents(
    docs: DataFrame,
    lexicons: Sequence[Lexicon],
    id_col: str,
    text_col: str = "text",
    keep: Sequence[str] = (),
    with_char_stats: bool = True,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per document: id, ``keep`` columns, character counts, and one struct
    of scores per lexicon.  Documents without any listed word score zero.
    """
    stats = char_stats(F.col(text_col)) if with_char_stats else {}
    measured = docs.select(
        id_col, *keep, *[column.alias(name) for name, column in stats.items()], text_col
    )
    keys = [id_col, *keep, *stats]
    # Written once: it is measured, then joined.
    lexicon = staged(merged_words(lexicons), "merged-words")
    if fits_broadcast(lexicon, max_bytes):
        # Ids are only compared within this join, so any unique number will do.
        numbered = lexicon.withColumn("word_id", F.monotonically_increasing_id())
        # Words not listed go before the aggregate; a row without a word keeps each document.
        hits = _ended_words(measured, keys, text_col).join(F.broadcast(numbered), "word", "left")
        hits = hits.where("word IS NULL OR word_id IS NOT NULL")
        times = None
    else:
        # A lexicon too large to send around: count each word per document
        # first, in place, then join on the word with frequent words spread out.  A row is then
        # one word of a document, and its vocabulary a plain count.
        words = measured.select(F.explode_outer(tx.tokens(F.col(text_col))).alias("word"))
        words = words.withColumn("word", F.upper("word"))
        counted = _counted_words(measured, keys, id_col, text_col)
        hits = salted_join_folded(counted, lexicon, "word", "left", hot_keys(words, "word"))
        times = F.col("n")

    sums = [column for lexicon in lexicons for column in _sums(lexicon, times)]
    totals = hits.groupBy(*keys).agg(*sums)
    return totals.select(
        *keys, *[_scores(lexicon).alias(lexicon.name) for lexicon in lexicons]
    )


def _ended_words(measured: DataFrame, keys: Sequence[str], text_col: str) -> DataFrame:
    """(keys, word): the words of a document as they come, and one NULL after the last."""
    ended = F.concat(tx.tokens(F.col(text_col)), F.array(F.lit(None).cast("string")))
    return measured.select(*keys, F.explode(ended).alias("word")).withColumn("word", F.upper("word"))


def _counted_words(
    measured: DataFrame, keys: Sequence[str], id_col: str, text_col: str
) -> DataFrame:
    """(keys, word, n): words of a document counted where its text is read; only texts that share an id are
    counted together by a shuffle.  A text without words has one row, its word NULL."""
    alone, others = split_repeated(measured, id_col)
    in_place = alone.select(*keys, F.inline_outer(tx.counted_words(F.col(text_col))))
    together = (
        others.select(*keys, F.explode_outer(tx.tokens(F.col(text_col))).alias("word"))
        .withColumn("word", F.upper("word"))
        .groupBy(*keys, "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return in_place.unionByName(together)


def _sums(lexicon: Lexicon, times: Column | None) -> list[Column]:
    """Counts of one document; ``times`` is how often a row's word occurs, if not once."""
    columns = []
    for name in _adds(lexicon):
        added = F.col(f"{lexicon.name}_{name}")
        total = F.sum(added if times is None else added * times)
        columns.append(F.coalesce(total, F.lit(0)).alias(f"{lexicon.name}_{name}"))
    if lexicon.measures:
        listed = F.col(f"{lexicon.name}_word_count").isNotNull()
        if times is None:
            vocabulary = F.size(F.collect_set(F.when(listed, F.col("word_id"))))
        else:
            vocabulary = F.count_if(listed).cast("int")
        columns.append(vocabulary.alias(f"{lexicon.name}_vocabulary"))
    return columns


def _scores(lexicon: Lexicon) -> Column:
    name = lexicon.name
    words = F.col(f"{name}_word_count")

    def per_word(total: str) -> Column:
        return F.coalesce(F.try_divide(F.col(f"{name}_{total}"), words), F.lit(0.0))

    columns = [words.cast("int").alias("word_count")]
    columns += [(per_word(flag) * 100).alias(flag) for flag in lexicon.flags]
    if lexicon.measures:
        columns += [
            per_word("syllables").alias("avg_syllables_per_word"),
            per_word("letters").alias("avg_word_length"),
            F.col(f"{name}_vocabulary").alias("vocabulary"),
        ]
    return F.struct(*columns)
