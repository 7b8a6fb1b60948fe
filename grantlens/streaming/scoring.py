"""Incremental scoring of a stream of texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from grantlens.plans.scoring import append_pending
from grantlens.sources.lexicon import Lexicon


def score_batches(
    finance: Lexicon,
    inquirer: Lexicon,
    finance_path: str,
    inquirer_path: str,
    id_col: str,
    text_col: str = "text",
) -> Callable[[DataFrame, int], None]:
    """Function for ``foreachBatch`` that scores each batch into both tables.

    Documents already scored are skipped, so a batch that is run again after a
    failure adds nothing.
    """

    def score(batch: DataFrame, batch_id: int) -> None:
        append_pending(
            batch, finance, inquirer, finance_path, inquirer_path, id_col, text_col
        )

    return score
