"""Lines that many sites share are taken out of documents.

1. Every line with a word is reduced to a hash; white space does not count.  A HyperLogLog
   sketch of its sites is kept per hash; sketches are merged by the aggregate, first in
   each task, so a line that is everywhere is one small row per task.
2. A sketch that is clearly under or over the threshold decides.  Lines near it get an exact
   count of their distinct sites.  The threshold is ``SITES``, and ``SHORT_SITES`` times as much for
   lines of less than ``LEAST_WORDS`` words, which also meet by chance.
3. Lines that reach it are widespread, be it as boilerplate or because whole texts were copied.
   What parts the two is where they stand: a host is a document of which widespread lines are at
   most ``MOST_PERCENT``, so that there is other text around them.  Sites of hosts alone
   are counted again, in the same way, and lines that reach the threshold there are boilerplate.
4. Boilerplate leaves all documents, hosts or not, whatever its share of them.  Copies of a text are
   no hosts of its lines and keep them; copies are for other operators.

Everything is made of Spark's own expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from grantlens.operators.joins import fits_broadcast, lookup_join
from grantlens.session import staged

SPACE = " \t\n\x0b\f\r"
SITES = 8
LEAST_WORDS = 4
SHORT_SITES = 2
MOST_PERCENT = 50
# 2**LG_K counters: the standard error is 1.04 / 2**(LG_K / 2), that is 6.5 %.
LG_K = 8
# Within five standard errors of the threshold a count is made exactly.
NEAR = 5 * 1.04 / 2 ** (LG_K / 2)


def _once(value: Column, use) -> Column:
    """``use(value)``, with the value computed one time however often it is used."""
    return F.transform(F.array(value), use)[0]


def _split(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _trimmed(line: Column) -> Column:
    return F.regexp_replace(F.btrim(line, F.lit(SPACE)), "[\\x20\\x09-\\x0D]+", " ")


def _words(trimmed: Column) -> Column:
    """Words of a line whose white space is single spaces."""
    spaces = F.length(trimmed) - F.length(F.translate(trimmed, " ", ""))
    return F.when(trimmed == "", 0).otherwise(spaces + 1)


def _body(text: Column) -> Column:
    """Tells apart the texts of rows that share an id."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def line_rows(docs: DataFrame, id: str, text: str, site: str) -> DataFrame:
    """(doc_id, body, pos, line, site, n_words, doc_words) of lines with a word; hashes for texts."""
    parts = F.transform(
        _split(F.col("text")),
        lambda part: _once(
            _trimmed(part),
            lambda line: F.struct(
                F.xxhash64(line).alias("line"), _words(line).cast("int").alias("n_words")
            ),
        ),
    )
    # Words of the document are counted inside the generator; beside it they would be counted
    # again for every line.
    lines = _once(
        parts,
        lambda all: _once(
            F.aggregate(all, F.lit(0).cast("long"), lambda n, at: n + at["n_words"]),
            lambda n: F.transform(all, lambda at: F.struct(at.alias("at"), n.alias("doc_words"))),
        ),
    )
    exploded = docs.select(
        F.col(id).alias("doc_id"),
        _body(F.col(text)).alias("body"),
        F.xxhash64(F.coalesce(F.col(site).cast("string"), F.lit(""))).alias("site"),
        F.col(text).alias("text"),
    ).select("doc_id", "body", "site", F.posexplode(lines).alias("pos", "found"))
    return exploded.select(
        "doc_id", "body", "pos", "found.at.line", "site", "found.at.n_words", "found.doc_words"
    ).where("n_words > 0")


def widespread(rows: DataFrame, sites: int = SITES) -> DataFrame:
    """(line): hashes of lines on as many distinct sites as their length asks for."""
    wanted = F.when(F.col("n_words") < LEAST_WORDS, SHORT_SITES * sites).otherwise(sites)
    sketched = staged(
        rows.groupBy("line", "n_words")
        .agg(F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"))
        .select("line", wanted.alias("wanted"), F.hll_sketch_estimate("sketch").alias("sites"))
        .where(F.col("sites") >= F.col("wanted") * (1 - NEAR)),
        "spread-lines",
    )
    sure = F.col("sites") > F.col("wanted") * (1 + NEAR)
    near = sketched.where(~sure).select("line")
    exact = (
        lookup_join(rows.select("line", "site", "n_words"), near, "line", "left_semi")
        .distinct()
        .groupBy("line", "n_words")
        .agg(F.count(F.lit(1)).alias("sites"))
        .where(F.col("sites") >= wanted)
    )
    return sketched.where(sure).select("line").unionByName(exact.select("line"))


def hosted(found: DataFrame) -> DataFrame:
    """(line, n_words, site) of widespread lines in documents that are mostly other text."""
    # One row per text and site; never more lines than the text has.
    texts = found.groupBy("doc_id", "body", "site", "doc_words").agg(
        F.collect_set(F.struct("pos", "line", "n_words")).alias("lines")
    )
    words = F.aggregate("lines", F.lit(0).cast("long"), lambda n, line: n + line["n_words"])
    return (
        texts.where(100 * words <= MOST_PERCENT * F.col("doc_words"))
        .select("site", F.explode("lines").alias("at"))
        .select("at.line", "at.n_words", "site")
    )


def _cleaned(docs: DataFrame, id: str, text: str, site: str, sites: int) -> DataFrame:
    """(row, text, n_lines, n_removed): rows of ``docs`` whole, and their text without boilerplate."""
    rows = staged(line_rows(docs, id, text, site), "lines")
    spread = staged(widespread(rows, sites), "widespread")
    at_spread = staged(lookup_join(rows, spread, "line", "left_semi"), "found-lines")
    boilerplate = staged(widespread(staged(hosted(at_spread), "hosted"), sites), "boilerplate")
    # Positions of one text: never more than it has lines.
    found = staged(
        lookup_join(at_spread.select("line", "doc_id", "body", "pos"), boilerplate, "line", "left_semi")
        .groupBy(F.col("doc_id").alias("found_id"), F.col("body").alias("found_body"))
        .agg(F.collect_set("pos").alias("found")),
        "boilerplate-lines",
    )
    # The columns of the table are kept apart, so that none can clash with those made here.
    whole = docs.select(
        F.col(id).alias("doc_id"),
        _body(F.col(text)).alias("body"),
        F.col(text).alias("text"),
        F.struct(*docs.columns).alias("row"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("body") == F.col("found_body"))
    joined = whole.join(F.broadcast(found) if fits_broadcast(found) else found, same, "left")
    lines = joined.select("row", "text", "found", _split(F.col("text")).alias("lines"))
    # array_except works by hashing, so a text of very many lines takes time in proportion to them.
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("found"))
    cleaned = F.array_join(F.transform(left, lambda pos: F.get("lines", pos)), "\n")
    goes = F.col("found").isNotNull()
    return lines.select(
        "row",
        F.when(goes, cleaned).otherwise(F.col("text")).alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.when(goes, F.size("found")).otherwise(0).cast("long").alias("n_removed"),
    )


def clean_lines(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    site: str = "source",
    sites: int = SITES,
) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``; all columns.

    NULL text stays NULL, and an empty one has one line, which stays.  A NULL site counts as the empty
    one.  Lines without a word stay.  A line that a text repeats goes each time, and a
    document of boilerplate alone is left empty.  Rows without an id, and rows that repeat
    one, are cleaned each by its own text.  An empty table gives an empty result.
    """
    cleaned = _cleaned(docs, id, text, site, sites)
    return cleaned.select(
        *[
            F.col("text").alias(name) if name == text else F.col("row")[name].alias(name)
            for name in docs.columns
        ]
    )


def line_report(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    site: str = "source",
    sites: int = SITES,
) -> DataFrame:
    """doc_id, n_lines, n_removed and text of every row, by the rules of ``clean_lines``."""
    cleaned = _cleaned(docs, id, text, site, sites)
    return cleaned.select(F.col("row")[id].alias("doc_id"), "n_lines", "n_removed", "text")
