"""Leave out rows by a list of ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from grantlens.operators.joins import fits_broadcast
from grantlens.session import staged


def without(docs: DataFrame, gone: DataFrame, id: str) -> DataFrame:
    """Rows of ``docs`` whose id is not in ``gone``, which has that column only.

    The list is written and measured: if it fits it is sent to the rows, which then
    stay in place.  Rows with a NULL id are in no list and stay.
    """
    gone = staged(gone.where(F.col(id).isNotNull()).distinct(), "gone")
    listed = F.broadcast(gone) if fits_broadcast(gone) else gone
    return docs.join(listed, id, "left_anti").select(*docs.columns)
