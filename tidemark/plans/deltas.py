"""Merge on read: a keyed table as base rows and the changes that came after them.

A cycle appends what it changed, as rows with its number that hold a key's new image or say that the key
is gone. A read takes the newest row of each key with one aggregate, and needs none where nothing came after the base.
How many rows a hash bucket has in its base and in its changes is kept with the commit: a bucket whose changes outgrow its base is
folded, that is rewritten as a base, so all rewriting together stays in proportion to the changes. Many
small sets of changes are packed into one.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CYCLE, GONE = "_cycle", "_gone"
FOLD, PACK, APPEND = "fold", "pack", "append"
MOST_SETS = 8  # sets of changes of a bucket that a read takes together


def newest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The row of the latest cycle for each key; of one cycle, the row that is there. Null keys are equal."""
    rest = [c for c in rows.columns if c not in keys]
    at = F.struct(F.col(CYCLE), ~F.col(GONE)) if GONE in rows.columns else F.col(CYCLE)
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), at).alias("_row"))
    return latest.select(*[F.col("_row").getField(c).alias(c) if c in rest else F.col(c) for c in rows.columns])


def next_step(part: dict[str, Any] | None, rows: int) -> str:
    """What to do with a bucket that gets ``rows`` changed rows."""
    if part is None or part["base"] is None or part["more"] + rows > part["rows"]:
        return FOLD
    return PACK if len(part["sets"]) + 1 > MOST_SETS else APPEND


def after_step(step: str, part: dict[str, Any] | None, folder: str, rows: int) -> dict[str, Any]:
    """The bucket's record once ``folder`` holds what the step wrote there: ``rows`` rows."""
    if step == FOLD:
        return {"base": folder, "rows": rows, "sets": [], "more": 0}
    sets = [folder] if step == PACK else [*part["sets"], folder]
    more = rows if step == PACK else part["more"] + rows
    return {"base": part["base"], "rows": part["rows"], "sets": sets, "more": more}
