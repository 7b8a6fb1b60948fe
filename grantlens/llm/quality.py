"""Quality rules whose cutoffs are certified on labelled documents.

Every text gets a few counts, and from them one level per rule: the larger, the
worse.  Cutoffs are not set by hand.  For each stratum (a language):

1. Documents without a label say how rare a level is: the share of them that reach it.  Rejecting
   documents with a level that ``q`` or fewer reach, by any rule, gives one nested path of
   rejections as ``q`` grows from 0.001 to 0.1 in steps of 0.001.  No label is used for it.
2. Along the path, documents labelled good are tested: the exact binomial tail says whether so
   few rejections of them would be likely if the true share were ``MAX_FALSE`` or more.  A
   step is certified while that tail stays under the error level.  Steps are tested in order, which
   needs no correction; over strata the level is divided by their number, so all guarantees
   hold together with probability ``1 - ERROR``.
3. The last certified step gives the strictest cutoff of every rule.  Milder ones reject part of the
   same documents, so the guarantee covers them too: each rule takes the one that parts bad
   from good documents best, and a rule that parts nothing gets none.

A stratum needs about 220 good labels if there are four of them; with fewer, nothing is certified,
and neither is anything where all documents have labels.

Everything is made of Spark's own expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from grantlens.llm.select import without
from grantlens.operators.joins import lookup_join
from grantlens.session import staged

SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
# Base rules: fewer words, or a larger share of repeated words, fail.
LEAST_WORDS = 50
MOST_REPEATED = 50
# Good documents a stratum may lose to all rules together, and the chance that a guarantee fails.
MAX_FALSE = 0.02
ERROR = 0.05
# A rejected good document counts as so many rejected bad ones when cutoffs are compared.
GOOD_WEIGHT = 10.0
LEVELS = 100
# Steps of the path, and steps in a whole.
STEPS = 100
STEPS_OF_ONE = 1000
# Rule -> value per level.  A value of the last level or more counts as the last.
RULES = {
    "symbols": 0.01,
    "repeats": 0.01,
    "copied_lines": 0.01,
    "capitals": 0.01,
    "exclaims": 0.01,
    "long_words": 0.25,
}


def _once(value: Column, use) -> Column:
    """``use(value)``, with the value computed one time however often it is used."""
    return F.transform(F.array(value), use)[0]


def _covered(windows: Column) -> Column:
    """Words in windows of three that occur again, from (hash, position) in order of hash."""

    def again(window, i):
        before, after = F.get(windows, i - 1)["h"], F.get(windows, i + 1)["h"]
        return F.coalesce(before == window["h"], F.lit(False)) | F.coalesce(
            after == window["h"], F.lit(False)
        )

    places = F.sort_array(F.transform(F.filter(windows, again), lambda window: window["p"]))
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))

    def add(state, place):
        fresh = F.least(F.lit(3), place - state["last"])
        return F.struct(place.alias("last"), (state["n"] + fresh).alias("n"))

    return F.aggregate(places, start, add, lambda state: state["n"])


def repeated_words(words: Column) -> Column:
    """Words of an array in any window of three words that occurs twice or more in it."""

    def windows(w):
        return F.sort_array(
            F.transform(
                F.sequence(F.lit(0), F.size(w) - 3),
                lambda i: F.struct(
                    F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"),
                    i.alias("p"),
                ),
            )
        )

    counted = _once(words, lambda w: F.when(F.size(w) > 3, _once(windows(w), _covered)))
    return F.coalesce(counted, F.lit(0).cast("long"))


def _count(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def text_counts(docs: DataFrame, id: str, text: str, stratum: str) -> DataFrame:
    """doc_id, stratum and the counts of every text, in one pass over the table."""
    # Each layer is named, so that later ones refer to it instead of repeating it.
    value = F.coalesce(F.col(text), F.lit(""))
    words = F.split(F.btrim(value, F.lit(SPACE)), "[\\x20\\x09-\\x0D]+")
    lines = F.filter(F.split(value, "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != "")
    counted = F.struct(
        _once(
            words,
            lambda w: F.struct(
                F.when(w[0] == "", 0).otherwise(F.size(w)).cast("long").alias("n_words"),
                repeated_words(w).alias("n_repeat_words"),
            ),
        ).alias("by_word"),
        _once(
            lines,
            lambda x: F.struct(
                F.size(x).cast("long").alias("n_lines"),
                (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            ),
        ).alias("by_line"),
    )
    return docs.select(
        F.col(id).alias("doc_id"),
        F.coalesce(F.col(stratum), F.lit("")).alias("stratum"),
        counted.alias("counted"),
        F.length(F.translate(value, SPACE, "")).cast("long").alias("word_chars"),
        _count(value, SYMBOLS).alias("n_symbols"),
        _count(value, "!").alias("n_exclaims"),
        F.length(F.regexp_replace(value, "[^\\p{Lu}]+", "")).cast("long").alias("n_capitals"),
    ).select(
        "doc_id",
        "stratum",
        "counted.by_word.*",
        "counted.by_line.*",
        "word_chars",
        "n_symbols",
        "n_exclaims",
        "n_capitals",
    )


def base_failed() -> Column:
    n_words = F.col("n_words")
    return (n_words < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * n_words)


def levels() -> Column:
    """Level of each rule's value, from 0 to ``LEVELS``, as a struct."""
    values = {
        "symbols": F.try_divide("n_symbols", "word_chars"),
        "repeats": F.try_divide("n_repeat_words", "n_words"),
        "copied_lines": F.try_divide("n_dup_lines", "n_lines"),
        "capitals": F.try_divide("n_capitals", "word_chars"),
        "exclaims": F.try_divide("n_exclaims", "n_words"),
        "long_words": F.try_divide("word_chars", "n_words"),
    }
    return F.struct(
        *[
            F.least(
                F.lit(LEVELS), F.floor(F.coalesce(values[rule], F.lit(0.0)) / F.lit(step)).cast("int")
            ).alias(rule)
            for rule, step in RULES.items()
        ]
    )


def binomial_tail(k: Column, n: Column, p: Column) -> Column:
    """P(X <= k) for X ~ Binomial(n, p) and 0 <= k < n, summed exactly from its terms.

    The largest term, that of k, is taken by logarithms; the others follow from it by
    their ratios, downwards.
    """
    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(
        F.array().cast("array<bigint>")
    )
    choose = F.aggregate(
        steps, F.lit(0.0), lambda total, i: total + F.log((n - i + 1).cast("double") / i)
    )
    top = choose + k * F.log(p) + (n - k) * F.log1p(-p)
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def below(state, i):
        j = k - i + 1
        term = state["term"] * j.cast("double") / (n - j + 1) * (1 - p) / p
        return F.struct(term.alias("term"), (state["sum"] + term).alias("sum"))

    return F.exp(top + F.aggregate(steps, start, below, lambda state: F.log(state["sum"])))


def certified_cutoffs(
    counts: DataFrame,
    labels: DataFrame,
    max_false: float = MAX_FALSE,
    error: float = ERROR,
    id: str = "doc_id",
) -> DataFrame:
    """(stratum, rule, cutoff): the useful levels that the labels certify.

    ``labels`` has the id and ``quality``, 1 for good and 0 for bad; documents with other values and
    NULL are left out, and so are documents that fail the base rules.  All other labelled
    documents are tested, and all documents that no label names make the path.  The
    result has at most one row per stratum and rule, and none for a stratum with too few
    good documents to certify anything.
    """
    known = labels.where(F.col("quality").isin(0, 1)).select(
        F.col(id).alias("doc_id"), F.col("quality").cast("int").alias("_good")
    )
    passed = counts.where(~base_failed()).select("doc_id", "stratum", levels().alias("levels"))
    by_levels = F.sum("good").alias("good"), F.sum("bad").alias("bad"), F.sum("free").alias("free")
    labelled = passed.join(known, "doc_id").select(
        "stratum", "levels", F.col("_good").alias("good"), (1 - F.col("_good")).alias("bad"), F.lit(0).alias("free")
    )
    named = labels.select(F.col(id).alias("doc_id")).distinct()
    free = lookup_join(passed, named, "doc_id", "left_anti").select(
        "stratum", "levels", F.lit(0).alias("good"), F.lit(0).alias("bad"), F.lit(1).alias("free")
    )
    folded = staged(labelled.unionByName(free).groupBy("stratum", "levels").agg(*by_levels), "levels")
    stacked = F.array(
        *[F.struct(F.lit(rule).alias("rule"), F.col(f"levels.{rule}").alias("level")) for rule in RULES]
    )
    # At most strata x rules x levels rows.
    rule = Window.partitionBy("stratum", "rule")
    reached = rule.orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, 0)
    rarity = F.expr(f"({STEPS_OF_ONE} * free_reached + n_free - 1) DIV n_free")
    steps = staged(
        folded.select("stratum", F.explode(stacked).alias("at"), "good", "bad", "free")
        .groupBy("stratum", "at.rule", "at.level")
        .agg(*by_levels)
        .select(
            "stratum",
            "rule",
            "level",
            *[F.sum(name).over(reached).alias(f"{name}_reached") for name in ("good", "bad", "free")],
            *[F.sum(name).over(rule).alias(f"n_{name}") for name in ("good", "bad", "free")],
        )
        .where((F.col("level") > 0) & (F.col("n_free") > 0))
        .withColumn("step", F.greatest(F.lit(1).cast("long"), rarity)),
        "steps",
    )
    # A document is rejected from the first step on that rejects any of its levels.
    along = Window.partitionBy("stratum").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    rejected = (
        folded.where(F.col("good") + F.col("bad") > 0)
        .select("stratum", "levels", "good", F.explode(stacked).alias("at"))
        .select("stratum", "levels", "good", "at.*")
        .join(steps.select("stratum", "rule", "level", "step"), ["stratum", "rule", "level"])
        .groupBy("stratum", "levels")
        .agg(F.min("step").alias("step"), F.first("good").alias("good"))
        .where(F.col("step") <= STEPS)
        .groupBy("stratum", "step")
        .agg(F.sum("good").alias("good"))
        .select("stratum", "step", F.sum("good").over(along).alias("k"))
    )
    per_stratum = (
        folded.groupBy("stratum")
        .agg(F.sum("good").alias("n"), F.sum(F.col("good") + F.col("bad")).alias("known"))
        .where("known > 0")
        # One row per stratum.
        .withColumn("strata", F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))))
    )
    share = F.lit(max_false)
    certified = (
        rejected.join(per_stratum, "stratum")
        .where(F.col("k") < F.col("n") * share)
        .where(binomial_tail(F.col("k"), F.col("n"), share) <= F.lit(error) / F.col("strata"))
        .groupBy("stratum")
        .agg(F.max("step").alias("last"))
    )
    gain = F.try_divide("bad_reached", "n_bad") - GOOD_WEIGHT * F.try_divide("good_reached", "n_good")
    return (
        steps.join(certified, "stratum")
        .where(F.col("step") <= F.col("last"))
        .withColumn("gain", gain)
        .where("gain > 0")
        .groupBy("stratum", "rule")
        .agg(F.max_by("level", F.struct("gain", "level")).alias("cutoff"))
    )


def judge(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    stratum: str = "lang",
) -> DataFrame:
    """One row per row of ``docs``: its counts, ``base_failed``, the rules it breaks and ``kept``.

    NULL text has no words and fails the base rules, like an empty one.  A NULL stratum
    is a stratum of its own.  Rows that repeat an id are judged each on its own
    text; NULL ids meet no label.  Without labels only the base rules reject.  An
    empty table gives an empty result.  Columns other than the three named are not read.
    """
    counts = staged(text_counts(docs, id, text, stratum), "counts")
    cutoffs = certified_cutoffs(counts, labels, id=id)
    by_stratum = staged(
        cutoffs.groupBy("stratum").agg(
            F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs")
        ),
        "cutoffs",
    )
    at = levels()
    broken = F.array_compact(
        F.array(
            *[
                F.when(F.col("at")[rule] >= F.col("cutoffs")[rule], F.lit(rule))
                for rule in RULES
            ]
        )
    )
    judged = lookup_join(counts.withColumn("at", at), by_stratum, "stratum", "left")
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        F.coalesce(F.array_join(broken, ","), F.lit("")).alias("broken_rules"),
    ).withColumn("kept", ~F.col("base_failed") & (F.col("broken_rules") == ""))


def keep_good(docs: DataFrame, labels: DataFrame, id: str = "doc_id") -> DataFrame:
    """The documents that pass, with all their columns."""
    gone = judge(docs, labels, id).where(~F.col("kept")).select(F.col("doc_id").alias(id))
    return without(docs, gone, id)
