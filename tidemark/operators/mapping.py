"""Row-local work: routing by operation, reshaping, validity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.binds import bind
from ..spec import ChangeSpec, Mapping
from ..spec import Column as ColumnRule
from .keys import any_null
from .names import DELETE, INSERT, KIND, OP, ORDER, REASON, UPDATE, own, value_column


def op_text(spec: ChangeSpec) -> Column:
    """Operation flag as text; null becomes empty text."""
    return F.coalesce(F.col(spec.op_column).cast("string"), F.lit(""))


def kind_of(op: Column, spec: ChangeSpec) -> Column:
    """I, U or D by exact comparison, the first match winning; null for any other flag."""
    return (
        F.when(op == spec.op_insert, INSERT)
        .when(op == spec.op_update, UPDATE)
        .when(op == spec.op_delete, DELETE)
    )


def route(changes: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Add the operation text and its routed kind."""
    changes = spec.canonical(changes)
    return changes.withColumn(OP, op_text(spec)).withColumn(KIND, kind_of(F.col(OP), spec))


def bad_ops(changes: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Rows with an unknown operation flag, and what history says about them."""
    rows = route(changes, spec).where(F.col(KIND).isNull())
    return rows.select(
        F.col(spec.order_key).alias(spec.order_key),
        unknown_op(F.col(OP), spec).alias("detail"),
    )


def unknown_op(op: Column, spec: ChangeSpec) -> Column:
    return F.concat(F.lit(f"unknown {spec.op_column} value '"), op, F.lit("'"))


def _bound(expression: str, names: dict[str, str]) -> Column:
    return F.expr(bind(expression, lambda n: names[n.lower()]))


def given(value: Column, declared: ColumnRule, spec: ChangeSpec) -> Column:
    """A value as the rules see it: empty text counts as null, unless the spec says otherwise."""
    return F.nullif(value, F.lit("")) if spec.empty_is_null and declared.type == "string" else value


def _raw(name: str, kind: str) -> str:
    return own(f"raw_{kind}_{name}")


def _reason(mapping: Mapping, spec: ChangeSpec, names: dict[str, str], values: dict[str, str]) -> Column:
    """First rule the row breaks, or null."""
    found = []
    for name in mapping.columns:
        declared = spec.target[name]
        raw = F.col(values[name])
        value = raw.try_cast(declared.type)
        may_be_null = declared.nullable or name in mapping.keep_null
        bad = (raw.isNotNull() & value.isNull()) if may_be_null else value.isNull()
        if declared.length is not None:
            bad = bad | (F.char_length(value) > declared.length)
        found.append(F.when(bad, F.lit(f"invalid:{name}")))
    for reason, expression in mapping.checks.items():
        found.append(F.when(_bound(expression, names), F.lit(f"invalid:{reason}")))
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def prepare(changes: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Input columns plus order key, kind, reshaped values and the reason a row is invalid.

    One projection for all rows: both mappings are evaluated side by side, an expression
    that they share only once. Columns nobody reads are pruned by Catalyst.
    """
    changes = spec.canonical(changes)
    names = {spec.as_of_bind.lower(): own("as_of")} | spec.check_source(changes)
    rows = changes.select(
        *[F.col(f"`{c}`") for c in changes.columns],
        (F.current_timestamp() if spec.as_of is None else F.lit(spec.as_of)).alias(own("as_of")),
        F.col(spec.order_key).alias(ORDER),
        op_text(spec).alias(own(OP)),
    ).withColumn(own(KIND), kind_of(F.col(own(OP)), spec))

    raw: dict[str, Column] = {}
    at: dict[str, dict[str, str]] = {INSERT: {}, UPDATE: {}, DELETE: {}}
    deletes = spec.delete.columns if spec.delete else {}
    for name in spec.target:
        ins, upd = spec.insert.columns.get(name), spec.update.columns.get(name)
        if ins is not None and ins == upd:
            both = _raw(name, "IU")
            value = given(_bound(ins, names), spec.target[name], spec)
            raw[both] = F.when(F.col(own(KIND)).isin(INSERT, UPDATE), value)
            at[INSERT][name] = at[UPDATE][name] = both
            ins = upd = None
        for kind, expression in ((INSERT, ins), (UPDATE, upd), (DELETE, deletes.get(name))):
            if expression is not None:
                only = _raw(name, kind)
                raw[only] = F.when(F.col(own(KIND)) == kind, given(_bound(expression, names), spec.target[name], spec))
                at[kind][name] = only
    rows = rows.withColumns(raw) if raw else rows

    values = {}
    for name, declared in spec.target.items():
        sources = dict.fromkeys(at[kind][name] for kind in at if name in at[kind])
        casts = [F.col(s).try_cast(declared.type) for s in sources]
        values[value_column(name)] = F.coalesce(*casts) if casts else F.lit(None).cast(declared.type)

    insert_reason = _reason(spec.insert, spec, names, at[INSERT])
    if not spec.nullable_keys:
        blank = [F.when(F.col(k).isNull(), F.lit(f"invalid:{k}")) for k in spec.business_keys]
        insert_reason = F.coalesce(*blank, insert_reason)
    reason = F.when(F.col(own(KIND)) == INSERT, insert_reason).when(
        F.col(own(KIND)) == UPDATE, _reason(spec.update, spec, names, at[UPDATE])
    )
    if spec.delete:
        reason = reason.when(F.col(own(KIND)) == DELETE, _reason(spec.delete, spec, names, at[DELETE]))
    return rows.withColumns({**values, own(REASON): reason}).drop(*raw)


def _mapped(changes: DataFrame, spec: ChangeSpec, kind: str, mapping: Mapping) -> DataFrame:
    rows = prepare(changes, spec).where(F.col(own(KIND)) == kind)
    return rows.select(
        F.col(ORDER).alias(spec.order_key),
        *[F.col(k).alias(k) for k in spec.business_keys],
        *[F.col(value_column(c)).alias(c) for c in spec.target if c in mapping.columns],
        F.col(own(REASON)).isNull().alias("ok"),
    )


def map_insert(changes: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Target rows that the insert rows stand for, with their validity."""
    return _mapped(changes, spec, INSERT, spec.insert)


def map_update(changes: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Column values that the update rows set, with their validity."""
    return _mapped(changes, spec, UPDATE, spec.update)


def map_delete(changes: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Business keys named by the delete rows."""
    rows = route(changes, spec).where(F.col(KIND) == DELETE)
    return rows.select(
        F.col(spec.order_key).alias(spec.order_key), *[F.col(k).alias(k) for k in spec.business_keys]
    )


def row_validity(changes: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Order key, kind and the rule each row breaks (null where it is valid)."""
    return prepare(changes, spec).select(
        F.col(ORDER).alias(spec.order_key),
        F.col(own(KIND)).alias(KIND),
        F.col(own(REASON)).alias(REASON),
    )


def check_violations(changes: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Count of rows that break the change log's own rules on flags and keys."""
    changes = spec.canonical(changes)
    kind = kind_of(op_text(spec), spec)
    counts = [
        F.count_if(kind.isNull()).alias("bad_op"),
        F.count_if(any_null(spec.business_keys)).alias("null_key"),
        F.count_if(F.col(spec.order_key).isNull()).alias("null_order"),
    ]
    if spec.processed_column:
        flag, kept = F.col(spec.processed_column), changes.schema[spec.processed_column].dataType
        allowed = flag.isin(*[F.lit(v).cast(kept) for v in (spec.pending, spec.done)])
        counts.append(F.count_if(~F.coalesce(allowed, F.lit(False))).alias("bad_flag"))
    return changes.agg(*counts)
