"""Link rows of new target rows, their cascade, and ids of inserted rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import Scratch
from ..spec import ChangeSpec, SpecError
from .image import LINKED, REMOVED_ID
from .names import INSERTED, LINK_FAILED, OUTCOME
from .ranks import with_rank
from .replay import link_values


def _need_link(spec: ChangeSpec):
    if spec.link is None:
        raise SpecError("the spec has no link")
    return spec.link


def _link_rows(rows: DataFrame, spec: ChangeSpec, id_column: str) -> DataFrame:
    link = _need_link(spec)
    rows = rows.select(F.col(id_column).alias("_new_id"))
    rows, values, broken = link_values(spec, rows, "_new_id")
    return rows.where(broken.isNull()).select(
        F.col("_new_id").alias(link.id_column), *[v.alias(name) for name, v in values.items()]
    )


def links_new(outcomes: DataFrame, spec: ChangeSpec) -> DataFrame:
    """One link per inserted row; the link's own id is the change that created it."""
    return _link_rows(outcomes.where(F.col(OUTCOME) == INSERTED), spec, spec.order_key)


def link_failures(outcomes: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Inserted rows that were kept without a link."""
    return outcomes.where(F.col(OUTCOME) == LINK_FAILED)


def links_cascade(links: DataFrame, target: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Links whose target row still exists."""
    parent = _need_link(spec).parent_column
    ids = target.select(F.col(spec.id_column).cast(links.schema[parent].dataType).alias("_id"))
    return links.join(ids, links[parent] == ids["_id"], "left_semi")


def merge_links(links: DataFrame | None, image: DataFrame, spec: ChangeSpec) -> DataFrame:
    """New link snapshot from the image alone: old links of removed rows go, new ones come."""
    fresh = _link_rows(image.where(F.col(LINKED)), spec, spec.id_column)
    if links is None:
        return fresh
    parent = _need_link(spec).parent_column
    gone = image.where(F.col(REMOVED_ID).isNotNull())
    gone = gone.select(F.col(REMOVED_ID).cast(links.schema[parent].dataType).alias("_id"))
    return links.join(gone, links[parent] == gone["_id"], "left_anti").unionByName(fresh)


def link_changes(image: DataFrame, spec: ChangeSpec, gone: str) -> DataFrame:
    """Links of new rows, and for each removed row the parent id alone, with ``gone`` set."""
    fresh = _link_rows(image.where(F.col(LINKED)), spec, spec.id_column).withColumn(gone, F.lit(False))
    parent = _need_link(spec).parent_column
    removed = image.where(F.col(REMOVED_ID).isNotNull())
    removed = removed.select(F.col(REMOVED_ID).cast(fresh.schema[parent].dataType).alias(parent), F.lit(True).alias(gone))
    return fresh.unionByName(removed, allowMissingColumns=True)


def new_ids(outcomes: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Id given to each inserted row: the key of the change that created it.

    Unique, known without coordination, and the same whenever the log is replayed.
    """
    inserted = outcomes.where(F.col(OUTCOME).isin(INSERTED, LINK_FAILED))
    return inserted.select(
        F.col(spec.order_key).alias(spec.order_key),
        *spec.business_keys,
        F.col(spec.order_key).alias(spec.id_column),
    )


def dense_ids(
    outcomes: DataFrame, spec: ChangeSpec, start: int = 1, scratch: Scratch | None = None
) -> DataFrame:
    """Ids without gaps, in change order, as a sequence would give them."""
    ids = new_ids(outcomes, spec).drop(spec.id_column)
    ranked = with_rank(ids, [spec.order_key], scratch)
    return ranked.select(
        spec.order_key, *spec.business_keys, (F.col("rank") + (start - 1)).alias(spec.id_column)
    )
