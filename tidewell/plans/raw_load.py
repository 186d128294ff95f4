"""One table's load from landing to its change log."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame

from tidewell.functions.hashing import add_row_hashes
from tidewell.operators.cdc import classify_changes, initial_changes
from tidewell.operators.sets import dedup
from tidewell.operators.transforms import ColumnSpec, lineage_columns, transform_map
from tidewell.sources.tables import current_rows, stage


def hashed_source(source: DataFrame, specs: Sequence[ColumnSpec], keys: Sequence[str] = (),
                  strict: bool = False) -> DataFrame:
    """Mapped columns plus row hashes: the form compared with the target."""
    return add_row_hashes(transform_map(source, specs), keys, strict=strict)


def change_log(source: DataFrame, history: DataFrame | None, specs: Sequence[ColumnSpec], keys: Sequence[str] = (),
               incremental: bool = False, batch_id: str = "", loaded_at: datetime | None = None,
               dedup_key: Sequence[str] | None = None, dedup_exclude: Sequence[str] | None = None,
               deduplicate: bool = False, strict: bool = False, staged: bool = False) -> DataFrame:
    """Change rows with hashes, operation and lineage, ready to append.

    ``history`` is the table the log is folded into, with its hash columns and, if it
    keeps versions, their validity; None on the first load.  The log itself is refused: it still
    holds replaced and deleted rows, which would be found again by every load.  The comparison reads the source twice.  ``staged`` first writes
    the hashed rows to the shared scratch folder: for a query against a live
    database, or where hashing twice costs more than the copy.
    """
    if history is not None and "change_op" in history.columns:
        raise ValueError("compare with the folded history, not with the change log")
    hashed = stage(hashed_source(source, specs, keys, strict), enabled=staged)
    if history is None:
        changes = initial_changes(hashed)
    else:
        changes = classify_changes(hashed, current_rows(history), keyed=any(k.strip() for k in keys),
                                   incremental=incremental)
    if deduplicate:
        changes = dedup(changes, dedup_key, dedup_exclude)
    return lineage_columns(changes, batch_id, loaded_at)
