"""Final target image after a replay, and the new target snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..spec import ChangeSpec
from .keys import key_join
from .names import (
    CREATES,
    DELETE,
    DELETED,
    EFFECTIVE,
    INSERT,
    KIND,
    OLD_ID,
    ORDER,
    OUTCOME,
    TARGET_SEED,
    UPDATE,
    own,
    value_column,
)
from .replay import classify
from .skew import DEFAULT_SKEW, SkewPolicy

ALIVE, LINKED, REMOVED_ID = "_alive", "_linked", "_removed_id"


def _writers(spec: ChangeSpec) -> dict[tuple[tuple[str, bool], ...], list[str]]:
    """Target columns by the kinds of changes that set them, and whether null leaves the column as it is.

    Each group has one last writer, so a column that null leaves alone is a group by itself.
    """
    groups: dict[tuple, list[str]] = {}
    mappings = {INSERT: spec.insert, UPDATE: spec.update} | ({DELETE: spec.delete} if spec.delete else {})
    for name in spec.target:
        who = tuple((kind, name in m.keep_null) for kind, m in mappings.items() if name in m.columns)
        alone = name if any(keeps for _, keeps in who) else None
        groups.setdefault((who, alone), []).append(name)
    return {(*who, *([(alone, True)] if alone else [])): names for (who, alone), names in groups.items()}


def _packed(columns: list[str]) -> Column:
    return F.struct(*[F.col(value_column(c)).alias(c) for c in columns])


def _summary(rows: DataFrame, spec: ChangeSpec, keep_old: bool) -> DataFrame:
    """One row per key: last delete, last creation, last value of each column group.

    Rows arrive sorted by key, so this runs as a sort aggregate without another sort, and
    where no key is hot without another exchange. Otherwise each slice is reduced to one row
    before it moves.
    """
    removes = (F.col(own(OUTCOME)) == DELETED) & F.lit(spec.delete is None)
    aggregates = [
        F.max(F.when(removes, F.col(ORDER))).alias("_gone"),
        F.max(F.when(F.col(own(CREATES)), F.col(ORDER))).alias("_made"),
        F.max_by(F.col(own(KIND)) == INSERT, F.when(F.col(own(CREATES)), F.col(ORDER))).alias("_by_insert"),
    ]
    for i, (who, columns) in enumerate(_writers(spec).items()):
        writes = F.lit(False)
        for kind, keeps in who:
            sets = F.col(own(EFFECTIVE)) & (F.col(own(KIND)) == kind)
            writes = writes | (sets & F.col(value_column(columns[0])).isNotNull() if keeps else sets)
        at = F.when(writes, F.col(ORDER))
        aggregates.append(F.max(at).alias(f"_at{i}"))
        aggregates.append(F.max_by(_packed(columns), at).alias(f"_set{i}"))
    if keep_old:
        old = F.struct(F.col(OLD_ID).alias("_id"), *[F.col(value_column(c)).alias(c) for c in spec.target])
        aggregates.append(F.first(F.when(F.col(own(KIND)) == TARGET_SEED, old), ignorenulls=True).alias("_old"))
    return rows.groupBy(*spec.business_keys).agg(*aggregates)


def _resolve(summary: DataFrame, spec: ChangeSpec, keep_old: bool) -> DataFrame:
    gone, made = F.col("_gone"), F.col("_made")
    after = lambda at: at.isNotNull() & (gone.isNull() | (at > gone))
    born = after(made)
    kept = gone.isNull() & F.col("_old").isNotNull() if keep_old else F.lit(False)
    groups = _writers(spec)
    where = {c: i for i, columns in enumerate(groups.values()) for c in columns}
    values = []
    for name in spec.target:
        i = where[name]
        value = F.when(after(F.col(f"_at{i}")), F.col(f"_set{i}").getField(name))
        if keep_old:
            value = value.when(kept & ~born, F.col("_old").getField(name))
        values.append(value.alias(name))
    new_id = F.when(born, made)
    removed = F.lit(None).cast(summary.schema["_made"].dataType)
    if keep_old:
        new_id = new_id.when(kept, F.col("_old").getField("_id"))
        removed = F.when(gone.isNotNull(), F.col("_old").getField("_id"))
    written = gone.isNotNull() | made.isNotNull()
    for i in range(len(groups)):
        written = written | F.col(f"_at{i}").isNotNull()
    return summary.where(written).select(
        new_id.alias(spec.id_column),
        *spec.business_keys,
        *values,
        (born | kept).alias(ALIVE),
        # Only inserts are linked, not rows that an update has made.
        F.coalesce(born & F.col("_by_insert"), F.lit(False)).alias(LINKED),
        removed.alias(REMOVED_ID),
    )


def is_image_row(spec: ChangeSpec) -> Column:
    """Classified rows that the image is made of: those that took effect, deletes, and the target's own rows."""
    removes = (F.col(own(OUTCOME)) == DELETED) & F.lit(spec.delete is None)
    return F.coalesce(removes | F.col(own(EFFECTIVE)) | (F.col(own(KIND)) == TARGET_SEED), F.lit(False))


def changed_rows(image: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Id, key and columns of every row of the image, and whether it is still there."""
    return image.select(spec.id_column, *spec.business_keys, *spec.columns, ALIVE)


def image_of(rows: DataFrame, spec: ChangeSpec, with_target: bool) -> DataFrame:
    """Row per business key that the log wrote to: its final values, or that it is gone."""
    return _resolve(_summary(rows, spec, with_target), spec, with_target)


def final_image(
    changes: DataFrame,
    spec: ChangeSpec,
    target: DataFrame | None = None,
    quarantine: DataFrame | None = None,
    skew: SkewPolicy | None = DEFAULT_SKEW,
) -> DataFrame:
    """The log's net effect: id, key, columns, and the flags that snapshots need."""
    target = None if target is None else spec.with_log_keys(target)
    rows = classify(changes, spec, target, quarantine, skew, known_only=True)
    return image_of(rows, spec, target is not None)


def merge_image(target: DataFrame | None, image: DataFrame, spec: ChangeSpec) -> DataFrame:
    """New target snapshot: untouched rows plus the live rows of the image."""
    live = image.where(F.col(ALIVE)).select(spec.id_column, *spec.business_keys, *spec.columns)
    if target is None:
        return spec.with_target_keys(live)
    keys = list(spec.business_keys)
    kept = key_join(spec.with_log_keys(target), image, keys, "left_anti", null_safe=spec.nullable_keys)
    return spec.with_target_keys(kept.unionByName(live))


def apply_final(
    changes: DataFrame,
    spec: ChangeSpec,
    target: DataFrame | None = None,
    quarantine: DataFrame | None = None,
    skew: SkewPolicy | None = DEFAULT_SKEW,
) -> DataFrame:
    """Target table after the whole log: inserts, updates and deletes in one pass."""
    return merge_image(target, final_image(changes, spec, target, quarantine, skew), spec)
