"""Replay of a change log as a set operation.

Every change has the outcome it would have if all changes were applied one at a time in
key order. Two facts about the rows before it decide that: whether its target row exists
(the last change that created or removed it tells), and whether an insert for its business
key already failed. Both are windows over one partitioning and one sort.

The starting state joins in as seed rows that sort before all changes of their key, so
rows, target and quarantine meet in a single exchange and null keys compare as equal.

Hot keys are cut into slices of consecutive changes. A first pass over their rows alone runs
the presence window per slice, leaving "depends on what came before" open; a slice then
boils down to one summary row, the summaries are chained in order, level by level where there are many, and
what each slice inherits is joined back. The windows proper run per key and slice, in one
exchange for all keys, hot or not. No task ever holds all changes of a hot key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.binds import bind
from ..sources.scratch import Scratch
from ..spec import ChangeSpec, SpecError
from .keys import key_join, key_types_of
from .mapping import given, prepare, unknown_op
from .names import (
    CREATES,
    DELETE,
    DELETED,
    DETAIL,
    EFFECTIVE,
    FAILED,
    INSERT,
    INSERT_FAILED,
    INSERTED,
    KIND,
    LINK_FAILED,
    OLD_ID,
    OP,
    ORDER,
    OUTCOME,
    PRESENT,
    QUARANTINE_SEED,
    QUARANTINED,
    REASON,
    RESULT,
    SKIPPED_BADROW,
    SKIPPED_QUARANTINED,
    TARGET_SEED,
    UPDATE,
    UPDATED,
    own,
    value_column,
)
from .skew import DEFAULT_SKEW, SLICE, HotKeys, SkewPolicy, find_hot_keys, match_keys, with_slice

QUARANTINED_DETAIL = "business key is quarantined"
DECISIVE, LINK_REASON = own("decisive"), own("link_reason")
PRESENT_IN, FAILED_IN = own("present_in"), own("failed_in")


def _params(spec: ChangeSpec) -> dict[str, str]:
    """Columns that hold the link parameters while link expressions are evaluated."""
    return {name.lower(): own(f"link_{name}") for name in spec.link.params}


def link_values(spec: ChangeSpec, df: DataFrame, new_id: str) -> tuple[DataFrame, dict[str, Column], Column]:
    """``df`` with the link parameters, the link values for the id column ``new_id``, and the
    rule they break (null if none).
    """
    link, held = spec.link, _params(spec)
    df = df.withColumns({held[n.lower()]: F.lit(v) for n, v in link.params.items()}) if held else df
    held[link.new_id.lower()] = new_id
    values, found = {}, []
    for name, expression in link.columns.items():
        declared = link.schema[name]
        raw = given(F.expr(bind(expression, lambda n: held[n.lower()])), declared, spec)
        value = raw.try_cast(declared.type)
        bad = value.isNull() if not declared.nullable else (raw.isNotNull() & value.isNull())
        if declared.length is not None:
            bad = bad | (F.char_length(value) > declared.length)
        found.append(F.when(bad, F.lit(f"link:{name}")))
        values[name] = value
    return df, values, F.coalesce(*found)


def _decisive(spec: ChangeSpec) -> Column:
    """True or false where a row settles whether the target row exists, else null.

    With quarantine on, an insert that failed makes its key inert, so what it would say
    about presence is never used. With it off, an insert that failed as a duplicate found
    the row there, and one that failed as invalid settles nothing.
    """
    ok = F.col(own(REASON)).isNull()
    kind = F.col(own(KIND))
    rule = F.when(kind == TARGET_SEED, F.lit(True))
    if spec.delete is None:
        rule = rule.when(kind == DELETE, F.lit(False))
    if spec.quarantine:
        rule = rule.when(kind == INSERT, F.lit(True))
    else:
        rule = rule.when((kind == INSERT) & ok, F.lit(True))
    if spec.on_missing == "upsert":
        rule = rule.when((kind == UPDATE) & ok, F.lit(True))
    return rule


def _insert_fails(spec: ChangeSpec, present: Column) -> Column:
    fails = F.col(own(REASON)).isNotNull()
    if spec.on_duplicate == "fail":
        fails = fails | present
    # A quarantine seed acts as an insert that failed before the first change.
    return F.coalesce(
        ((F.col(own(KIND)) == INSERT) & fails) | (F.col(own(KIND)) == QUARANTINE_SEED), F.lit(False)
    )


def _before(partition: list[str]):
    ordered = Window.partitionBy(*partition).orderBy(F.col(ORDER).asc_nulls_first())
    return ordered.rowsBetween(Window.unboundedPreceding, -1)


def _local_presence(rows: DataFrame, spec: ChangeSpec, partition: list[str]) -> DataFrame:
    rows = rows.withColumn(DECISIVE, _decisive(spec))
    return rows.withColumn(own(PRESENT), F.last(DECISIVE, ignorenulls=True).over(_before(partition)))


@dataclass(frozen=True)
class Carried:
    """What each slice of a hot key inherits; one row per slice."""

    states: DataFrame
    null_safe: bool


def _classify(
    rows: DataFrame, spec: ChangeSpec, partition: list[str], carried: Carried | None = None
) -> DataFrame:
    """Outcome of every row, from windows over ``partition``."""
    rows = _local_presence(rows, spec, partition)
    inherited = F.lit(False)
    if carried is not None:
        rows = match_keys(rows, carried.states, partition, "left", carried.null_safe)
        rows = rows.withColumn(own(PRESENT), F.coalesce(F.col(own(PRESENT)), F.col(PRESENT_IN)))
        inherited = F.coalesce(F.col(FAILED_IN), F.lit(False))
    rows = rows.withColumn(own(PRESENT), F.coalesce(F.col(own(PRESENT)), F.lit(False)))
    rows = rows.withColumn(own(INSERT_FAILED), _insert_fails(spec, F.col(own(PRESENT))))
    if spec.quarantine:
        earlier = F.max(own(INSERT_FAILED)).over(_before(partition))
        rows = rows.withColumn(QUARANTINED, F.coalesce(earlier, F.lit(False)) | inherited)
    else:
        rows = rows.withColumn(QUARANTINED, F.lit(False))
    return _outcomes(rows, spec)


def _outcomes(rows: DataFrame, spec: ChangeSpec) -> DataFrame:
    kind, reason, present = F.col(own(KIND)), F.col(own(REASON)), F.col(own(PRESENT))
    touches = present if spec.on_missing == "noop" else F.lit(True)
    inserted, link_detail = F.lit(INSERTED), F.lit(None).cast("string")
    if spec.link is not None:
        rows, _, broken = link_values(spec, rows, ORDER)
        rows = rows.withColumn(LINK_REASON, broken).drop(*_params(spec).values())
        link_detail = F.col(LINK_REASON)
        inserted = F.when(link_detail.isNull(), INSERTED).otherwise(LINK_FAILED)
    outcome = (
        F.when(kind.isNull(), SKIPPED_BADROW)
        .when(F.col(QUARANTINED), SKIPPED_QUARANTINED)
        .when(F.col(own(INSERT_FAILED)), FAILED)
        .when((kind == UPDATE) & touches & reason.isNotNull(), FAILED)
        .when((kind == DELETE) & present & reason.isNotNull(), FAILED)
        .when(kind == INSERT, inserted)
        .when(kind == DELETE, DELETED)
        .when(kind == UPDATE, UPDATED)
    )
    rows = rows.withColumn(own(OUTCOME), outcome)
    done = F.col(own(OUTCOME))
    detail = (
        F.when(done == SKIPPED_BADROW, unknown_op(F.col(own(OP)), spec))
        .when(done == SKIPPED_QUARANTINED, QUARANTINED_DETAIL)
        .when(done == LINK_FAILED, link_detail)
        .when(done == FAILED, F.coalesce(reason, F.lit("duplicate:" + ",".join(spec.business_keys))))
    )
    effective = done.isin(INSERTED, LINK_FAILED) | ((done == UPDATED) & touches)
    if spec.delete is not None:
        effective = effective | ((done == DELETED) & present)
    effective = F.coalesce(effective, F.lit(False))
    rows = rows.withColumn(own(DETAIL), detail).withColumn(own(EFFECTIVE), effective)
    return rows.withColumn(own(CREATES), F.col(own(EFFECTIVE)) & ~present)


def _carry(rows: DataFrame, spec: ChangeSpec, keys: list[str], hot: HotKeys) -> DataFrame:
    """State that each slice of a hot key inherits from the slices before it."""
    local = _local_presence(rows, spec, [*keys, SLICE])
    # How the slice ends depends on how it starts only while no row has settled presence.
    at = F.struct(F.col(ORDER).isNotNull(), F.col(ORDER))
    summary = local.groupBy(*keys, SLICE).agg(
        F.max_by(DECISIVE, F.when(F.col(DECISIVE).isNotNull(), at)).alias(_ENDS),
        F.max(_insert_fails(spec, F.coalesce(F.col(own(PRESENT)), F.lit(True)))).alias(_IF_THERE),
        F.max(_insert_fails(spec, F.coalesce(F.col(own(PRESENT)), F.lit(False)))).alias(_IF_ABSENT),
    )
    return _chained(summary, keys, hot.most, max(2, hot.chain), hot.null_safe, hot.scratch)


_ENDS, _IF_THERE, _IF_ABSENT, _GROUP = own("ends"), own("if_there"), own("if_absent"), own("group")


def _chained(
    summary: DataFrame, keys: list[str], most: int, chain: int, null_safe: bool, scratch: Scratch
) -> DataFrame:
    """What each slice inherits, from a summary per slice: how it ends (null: as it starts), and whether an
    insert fails in it if the row is there, or absent, when it starts.

    A task chains ``chain`` slices at most. Where a key has more, groups of them are summed up in the same form and chained
    in turn, until one group is left; what a group inherits then goes to its slices. As the way up and the way down
    both read them, summaries are written where there is more than one level: hot rows are summed up once.
    """
    if most > chain:
        summary = scratch.write(summary)
    group = F.floor(F.col(SLICE) / chain).cast("int")
    within = [*keys, _GROUP]
    summary = summary.withColumn(_GROUP, group)
    earlier = Window.partitionBy(*within).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    before = F.last(_ENDS, ignorenulls=True).over(earlier)
    fails = lambda start: F.when(F.coalesce(before, F.lit(start)), F.col(_IF_THERE)).otherwise(F.col(_IF_ABSENT))
    summary = summary.withColumns({own("before"): before, own("f1"): fails(True), own("f0"): fails(False)})
    if most <= chain:
        carried = summary.withColumns({PRESENT_IN: F.lit(False), FAILED_IN: F.lit(False)})
    else:
        at = F.when(F.col(_ENDS).isNotNull(), F.col(SLICE))
        above = summary.groupBy(*keys, F.col(_GROUP).alias(SLICE)).agg(
            F.max_by(_ENDS, at).alias(_ENDS), F.max(own("f1")).alias(_IF_THERE), F.max(own("f0")).alias(_IF_ABSENT)
        )
        groups = _chained(above, keys, -(-most // chain), chain, null_safe, scratch).withColumnRenamed(SLICE, _GROUP)
        carried = match_keys(summary, groups, within, "inner", null_safe)
    failed = F.when(F.col(PRESENT_IN), F.col(own("f1"))).otherwise(F.col(own("f0")))
    return carried.select(
        *keys,
        SLICE,
        F.coalesce(F.col(own("before")), F.col(PRESENT_IN)).alias(PRESENT_IN),
        (F.col(FAILED_IN) | F.coalesce(F.max(failed).over(earlier), F.lit(False))).alias(FAILED_IN),
    )


def _seeds(
    rows: DataFrame, spec: ChangeSpec, target: DataFrame | None, quarantine: DataFrame | None, near: bool
) -> list[DataFrame]:
    """Starting state of the keys that occur in the log; ``near`` if it has no others."""
    keys = list(spec.business_keys)
    out = []
    if target is None and quarantine is None:
        return out
    touched = rows.where(F.col(own(KIND)).isNotNull()).select(*keys).distinct()
    if target is not None:
        there = target if near else key_join(target, touched, keys, "left_semi", spec.nullable_keys)
        out.append(
            there.select(
                *keys,
                F.col(spec.id_column).alias(OLD_ID),
                F.lit(TARGET_SEED).alias(own(KIND)),
                *[F.col(c).alias(value_column(c)) for c in spec.target],
            )
        )
    if quarantine is not None and spec.quarantine:
        blocked = key_types_of(quarantine, rows, keys).distinct()
        blocked = blocked if near else key_join(blocked, touched, keys, "left_semi")
        out.append(blocked.select(*keys, F.lit(QUARANTINE_SEED).alias(own(KIND))))
    return out


def classify(
    changes: DataFrame,
    spec: ChangeSpec,
    target: DataFrame | None = None,
    quarantine: DataFrame | None = None,
    skew: SkewPolicy | HotKeys | None = DEFAULT_SKEW,
    known_only: bool = False,
    near: bool = False,
) -> DataFrame:
    """Outcome of every change; the seed rows of the starting state are still among them.

    ``skew`` is a policy, or the hot keys already found. ``known_only`` leaves out rows with an unknown operation, which
    change nothing. ``near`` tells that target and quarantine hold keys of the log only.
    """
    changes = spec.canonical(changes)
    keys = list(spec.business_keys)
    rows = prepare(changes, spec)
    if known_only:
        rows = rows.where(F.col(own(KIND)).isNotNull())
    frame = rows.withColumn(OLD_ID, F.lit(None).cast(rows.schema[ORDER].dataType))
    for seed in _seeds(rows, spec, target, quarantine, near):
        frame = frame.unionByName(seed, allowMissingColumns=True)

    hot = find_hot_keys(changes, keys, spec.order_key, skew) if isinstance(skew, SkewPolicy) else skew
    if hot is None:
        return _classify(frame, spec, keys)
    sliced = with_slice(frame, hot, keys, ORDER)
    carried = _carry(sliced.where(F.col(SLICE).isNotNull()), spec, keys, hot)
    sliced = sliced.withColumn(SLICE, F.coalesce(SLICE, F.lit(0)))
    return _classify(sliced, spec, [*keys, SLICE], Carried(carried, hot.null_safe))


def is_seed() -> Column:
    return F.coalesce(F.col(own(KIND)).isin(TARGET_SEED, QUARANTINE_SEED), F.lit(False))


def without_seeds(rows: DataFrame) -> DataFrame:
    return rows.where(~is_seed())


def replay(
    changes: DataFrame,
    spec: ChangeSpec,
    target: DataFrame | None = None,
    quarantine: DataFrame | None = None,
    skew: SkewPolicy | None = DEFAULT_SKEW,
) -> DataFrame:
    """Input columns plus ``present``, ``outcome``, ``detail`` and ``effective`` per change.

    ``present`` tells whether the target row existed just before the change, for rows that
    were not skipped.
    """
    changes = spec.canonical(changes)
    return outcomes_of(classify(changes, spec, target, quarantine, skew), changes.columns, spec)


def outcomes_of(rows: DataFrame, columns: list[str], spec: ChangeSpec) -> DataFrame:
    """``columns`` of the change rows and what became of each."""
    taken = [c for c in columns if c.lower() in RESULT]
    if taken:
        raise SpecError(f"rename {taken} of the change log: results have columns of that name")
    # An unknown operation is settled before its key is even read.
    known = F.col(own(KIND)).isNotNull()
    special = {
        PRESENT: F.when(known, F.col(own(PRESENT))),
        INSERT_FAILED: F.col(own(INSERT_FAILED)) & ~F.col(QUARANTINED),
    }
    # The order key travels once: its own column is rebuilt from the sort column.
    kept = [F.col(ORDER).alias(c) if c == spec.order_key else F.col(f"`{c}`") for c in columns]
    return without_seeds(rows).select(*kept, *[special.get(c, F.col(own(c))).alias(c) for c in RESULT])


def flag_quarantined(
    changes: DataFrame,
    spec: ChangeSpec,
    quarantine: DataFrame | None = None,
    **options,
) -> DataFrame:
    """Order key, business key and whether the change met a quarantined key."""
    rows = replay(changes, spec, None, quarantine, **options).where(F.col(KIND).isNotNull())
    return rows.select(
        spec.order_key, *spec.business_keys, (F.col(OUTCOME) == SKIPPED_QUARANTINED).alias("quarantined")
    )
