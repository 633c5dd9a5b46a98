"""Cell calling and cell lists."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import cells as op

log = logging.getLogger(__name__)


def call_cells(counts: DataFrame, expected: int = 3000, force: int | None = None) -> DataFrame:
    """Called cells ``(barcode, reads)``; ``force`` overrides the expected number."""
    return op.call_by_rank(counts, expected) if force is None else op.top_cells(counts, force)


def resolve_mode(external: object | None, expected: int | None) -> str:
    """``external`` or ``expected_cells``; giving both is an error."""
    if external not in (None, "") and expected is not None:
        raise ValueError("an external cell list and an expected cell number are mutually exclusive")
    return "external" if external not in (None, "") else "expected_cells"


def resolve_cell_list(
    available: DataFrame,
    *,
    explicit: DataFrame | None = None,
    called: DataFrame | None = None,
    external: DataFrame | None = None,
) -> DataFrame:
    """The cells of a matrix, as ``cell, ord``: explicit list, else called, else external, else all.

    Lists carry ``cell`` and an order column ``ord``. A listed cell without data
    is an error.
    """
    if called is not None and external is not None:
        raise ValueError("called cells and an external cell list are mutually exclusive")
    for chosen in (explicit, called, external):
        if chosen is not None:
            return op.require_data(chosen.select("cell", "ord"), available)
    log.warning("no cell list given: using every cell with data")
    cells = available.select("cell").distinct()
    return cells.withColumn("ord", F.col("cell"))
