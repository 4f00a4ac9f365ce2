"""Reading the change log: whole, page by page, or as a queue of pending rows."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.keys import key_join, key_to_text, key_types_of, text_to_key
from ..operators.ranks import with_rank
from ..operators.select import nth_key, ordinal
from ..operators.stamps import Stamps, unstamped
from ..spec import ChangeSpec, SpecError
from .scratch import Scratch


def scan_changes(changes: DataFrame, spec: ChangeSpec) -> DataFrame:
    """The whole change log; every column can be bound, and unused ones are pruned."""
    return spec.canonical(changes)


def up_to(key: str, border: Any) -> Column:
    """Rows of a page: keys up to its border. Rows without a key are in every page, to be refused there."""
    return (F.col(key) <= F.lit(border)) | F.col(key).isNull()


def page_borders(
    changes: DataFrame, key: str, rows: int, scratch: Scratch | None = None
) -> Iterator[Column]:
    """The last key of each page of ``rows`` rows, in key order.

    One range exchange of the key column finds all of them; they are kept as a table with a row
    per page and read one partition at a time.
    """
    if rows <= 0:
        raise ValueError("batch_size must be positive")
    ranked = with_rank(changes.select(key).where(F.col(key).isNotNull()), [key], scratch)
    page = F.ceil(F.col("rank") / rows).alias("page")
    kind = changes.schema[key].dataType.simpleString()
    borders = ranked.groupBy(page).agg(key_to_text(F.max(key), kind).alias("border"))
    for row in borders.orderBy("page").toLocalIterator():
        yield text_to_key(row["border"], kind)


def first_rows(
    changes: DataFrame, key: str, rows: int | None, scratch: Scratch | None = None, pin: bool = False
) -> DataFrame:
    """The page of the first ``rows`` keys; all rows where ``rows`` is None.

    The border is found by counting keys in ranges, for keys that are numbers, dates or instants; others are ranked. ``pin``
    writes the key column first, for changes that are costly to compute. Keys are unique where a log is replayed. If one
    repeats at the border, all its rows are in the page, and the cycle refuses them.
    """
    if rows is None:
        return changes
    if rows <= 0:
        raise ValueError("batch_size must be positive")
    keys = changes.select(key).where(F.col(key).isNotNull())
    if pin:
        keys = (scratch or Scratch(changes.sparkSession)).write(keys)
    if ordinal(key, changes.schema[key].dataType) is not None:
        border = nth_key(keys, key, rows)
        return changes if border is None else changes.where(up_to(key, border))
    ranked = with_rank(keys, [key], scratch)
    kind = changes.schema[key].dataType.simpleString()
    last = ranked.where(F.col("rank") <= rows).agg(key_to_text(F.max(key), kind)).first()[0]
    return changes.where(up_to(key, text_to_key(last, kind))) if last is not None else changes


def keyset_page(
    changes: DataFrame,
    spec: ChangeSpec,
    last_key: Any = None,
    rows: int | None = None,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Rows after ``last_key`` in key order, and those without a key; the comparison reaches the scan."""
    log = spec.canonical(changes)
    if last_key is not None:
        key = F.col(spec.order_key)
        log = log.where((key > F.lit(last_key)) | key.isNull())
    return first_rows(log, spec.order_key, rows, scratch)


def queue_page(
    changes: DataFrame,
    spec: ChangeSpec,
    quarantine: DataFrame | None = None,
    rows: int | None = None,
    scratch: Scratch | None = None,
    done: DataFrame | Stamps | None = None,
) -> DataFrame:
    """Pending rows in key order, without those whose business key is quarantined.

    ``done`` has the order keys stamped since the log was written, where the stamps are
    kept beside the log instead of in it: as a list of keys, or as ranges that the scan leaves out.
    """
    if not spec.processed_column:
        raise SpecError("queue mode needs processed_column")
    log = spec.canonical(changes)
    flag = log.schema[spec.processed_column].dataType
    log = log.where(F.col(spec.processed_column) == F.lit(spec.pending).cast(flag))
    if isinstance(done, Stamps):
        log = unstamped(log, spec.order_key, done)
    elif done is not None:
        log = key_join(log, done, [spec.order_key], "left_anti", null_safe=False)
    if quarantine is not None and spec.quarantine:
        keys = list(spec.business_keys)
        log = key_join(log, key_types_of(quarantine, log, keys), keys, "left_anti")
    return first_rows(log, spec.order_key, rows, scratch, pin=done is not None or quarantine is not None)


def late_changes(changes: DataFrame, spec: ChangeSpec, last_key: Any) -> DataFrame:
    """Rows that arrived with a key that keyset paging has already passed; never read."""
    return spec.canonical(changes).where(F.col(spec.order_key) <= F.lit(last_key))
