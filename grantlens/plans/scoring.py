"""Scoring jobs: profiles, incremental scoring, file report."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from grantlens.functions import text as tx
from grantlens.operators.id_bits import bitmaps_fit, id_bitmaps, is_whole, with_membership
from grantlens.operators.joins import BROADCAST_BYTES, fits_broadcast, measured_bytes
from grantlens.operators.score import CHAR_STATS, score_documents
from grantlens.session import staged
from grantlens.sources.lexicon import FINANCE_FLAGS, Lexicon
from grantlens.sources.sinks import append_table, stamped, table_or_empty

# ---- fixed values -----------------------------------------------------------
# Stored texts may end in the printed form of a missing value; these trailing
# characters are stripped as a set.
TRAILING_CHARS = "None"
# Column -> heading of the per-file report.
FILE_REPORT = {
    "file_name": "file name",
    "file_size": "file size",
    "word_count": "number of words",
    "positive": "% positive",
    "negative": "% negative",
    "uncertainty": "% uncertainty",
    "litigious": "% litigious",
    "modal_weak": "% modal-weak",
    "modal_moderate": "% modal moderate",
    "modal_strong": "% modal strong",
    "constraining": "% constraining",
    "alphabetic": "# of alphanumeric",
    "digits": "# of digits",
    "numbers": "# of numbers",
    "avg_syllables_per_word": "avg # of syllables per word",
    "avg_word_length": "average word length",
    "vocabulary": "vocabulary",
}
# -----------------------------------------------------------------------------


def stored_texts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Texts as the scoring jobs read them: trailing characters stripped, NULL empty."""
    return docs.withColumn(text_col, tx.rstrip_chars(F.col(text_col), TRAILING_CHARS))


def finance_profile(
    docs: DataFrame, lexicon: Lexicon, id_col: str, text_col: str = "text"
) -> DataFrame:
    """Finance lexicon profile with character counts, one row per document."""
    scored = score_documents(stored_texts(docs, text_col), [lexicon], id_col, text_col)
    return finance_columns(scored, lexicon.name, id_col)


def inquirer_profile(
    docs: DataFrame, lexicon: Lexicon, id_col: str, text_col: str = "text"
) -> DataFrame:
    """Inquirer lexicon profile, one row per document."""
    scored = score_documents(
        stored_texts(docs, text_col), [lexicon], id_col, text_col, with_char_stats=False
    )
    return scored.select(id_col, f"{lexicon.name}.*")


def finance_columns(scored: DataFrame, name: str, id_col: str) -> DataFrame:
    return scored.select(
        id_col,
        f"{name}.word_count",
        *[f"{name}.{flag}" for flag in FINANCE_FLAGS],
        *CHAR_STATS,
        f"{name}.avg_syllables_per_word",
        f"{name}.avg_word_length",
        f"{name}.vocabulary",
    )


def pending(
    docs: DataFrame,
    targets: Mapping[str, DataFrame],
    id_col: str,
    max_bytes: int = BROADCAST_BYTES,
    max_list_bytes: int | None = None,
) -> DataFrame:
    """Documents missing from at least one target, with a ``needs_<target>`` flag each.

    Every row of ``docs`` is judged by its id: rows that share one are kept or left out
    together, and a NULL id is in no target.  Texts are wide, so they are moved only
    as a last resort: short lists of finished ids, else bitmaps of whole-number ids, else lists of
    open ids are sent to the texts instead.  The result is the same on each way.
    ``max_list_bytes`` is the size up to which finished ids are sent as a list, else ``max_bytes``.
    """
    done = {
        name: target.select(id_col).distinct().withColumn(f"done_{name}", F.lit(True))
        for name, target in targets.items()
    }
    most = max_bytes if max_list_bytes is None else max_list_bytes
    if most > 0 and sum(map(measured_bytes, done.values())) <= most:
        return _open_rows(docs, {name: F.broadcast(ids) for name, ids in done.items()}, id_col)
    share = max_bytes // max(1, len(targets))
    if all(
        is_whole(frame, id_col) for frame in (docs, *targets.values())
    ) and all(bitmaps_fit(target, id_col, share) for target in targets.values()):
        return _open_by_bits(docs, targets, id_col)
    with_id, without_id = docs.where(F.col(id_col).isNotNull()), docs.where(F.col(id_col).isNull())
    open_ids = _open_rows(with_id.select(id_col).distinct(), done, id_col)
    if fits_broadcast(open_ids, max_bytes):
        open_ids = F.broadcast(open_ids)
    needs = {f"needs_{name}": F.lit(True) for name in done}
    return with_id.join(open_ids, id_col).unionByName(without_id.withColumns(needs))


def _open_rows(rows: DataFrame, done: Mapping[str, DataFrame], id_col: str) -> DataFrame:
    for ids in done.values():
        rows = rows.join(ids, id_col, "left")
    needs = {f"needs_{name}": F.col(f"done_{name}").isNull() for name in done}
    either = " or ".join(f"done_{name} is null" for name in done)
    return (
        rows.where(either).withColumns(needs).drop(*[f"done_{name}" for name in done])
    )


def _open_by_bits(docs: DataFrame, targets: Mapping[str, DataFrame], id_col: str) -> DataFrame:
    rows = docs
    for name, target in targets.items():
        bitmaps = staged(id_bitmaps(target, id_col), "id-bits")
        rows = with_membership(rows, bitmaps, id_col, f"needs_{name}")
    needs = [f"needs_{name}" for name in targets]
    opened = rows.withColumns({need: ~F.col(need) for need in needs}).where(" or ".join(needs))
    return opened.select(id_col, *[name for name in docs.columns if name != id_col], *needs)


def score_pending(
    docs: DataFrame,
    finance: Lexicon,
    inquirer: Lexicon,
    finance_target: DataFrame,
    inquirer_target: DataFrame,
    id_col: str,
    text_col: str = "text",
    stage: bool = False,
) -> dict[str, DataFrame]:
    """New rows for both targets: each document scored once, for what it lacks.

    ``stage`` writes the scored rows to the shared folder first, so that writing
    both targets reads the texts once.
    """
    targets = {finance.name: finance_target, inquirer.name: inquirer_target}
    todo = pending(docs.select(id_col, text_col), targets, id_col)
    needs = [f"needs_{name}" for name in targets]
    scored = score_documents(
        stored_texts(todo, text_col), [finance, inquirer], id_col, text_col, keep=needs
    )
    if stage:
        scored = staged(scored, "scored")
    finance_rows = scored.where(f"needs_{finance.name}")
    inquirer_rows = scored.where(f"needs_{inquirer.name}")
    return {
        finance.name: finance_columns(finance_rows, finance.name, id_col),
        inquirer.name: inquirer_rows.select(id_col, f"{inquirer.name}.*"),
    }


def append_pending(
    docs: DataFrame,
    finance: Lexicon,
    inquirer: Lexicon,
    finance_path: str,
    inquirer_path: str,
    id_col: str,
    text_col: str = "text",
) -> None:
    """Score what is missing and append it; running it again adds nothing.

    The first run makes the tables.
    """
    spark = docs.sparkSession
    rows = score_pending(
        docs,
        finance,
        inquirer,
        table_or_empty(spark, finance_path, docs.select(id_col).schema),
        table_or_empty(spark, inquirer_path, docs.select(id_col).schema),
        id_col,
        text_col,
        stage=True,
    )
    append_table(stamped(rows[finance.name]), finance_path)
    append_table(stamped(rows[inquirer.name]), inquirer_path)


def file_report(
    files: DataFrame, lexicon: Lexicon, name_col: str = "path", text_col: str = "text"
) -> DataFrame:
    """Report per file: length of the raw text, then the profile of the upper-cased
    text without the month."""
    prepared = files.select(
        F.col(name_col).alias("file_name"),
        F.length(tx.or_empty(F.col(text_col))).alias("file_size"),
        F.upper(tx.drop_month(F.col(text_col))).alias(text_col),
    )
    scored = score_documents(
        prepared, [lexicon], "file_name", text_col, keep=["file_size"]
    )
    flat = scored.select(
        "file_name", "file_size", *CHAR_STATS, f"{lexicon.name}.*"
    )
    return flat.select(*FILE_REPORT)


def with_headings(report: DataFrame) -> DataFrame:
    """The report under its printed headings, for CSV export."""
    return report.withColumnsRenamed(FILE_REPORT)
