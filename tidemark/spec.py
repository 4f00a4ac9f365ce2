"""What to replay: columns of the change log, mappings, target rules and policies."""

from __future__ import annotations

from collections.abc import Mapping as MappingABC
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame

from .functions.binds import bind_names, clean


class SpecError(ValueError):
    """The spec is inconsistent, or does not fit the change log it is used with."""


@dataclass(frozen=True)
class Column:
    """Declared type of a target or link column; a value that does not fit fails its row."""

    type: str
    nullable: bool = False
    length: int | None = None


@dataclass(frozen=True)
class Mapping:
    """Target column -> Spark SQL expression over the change row, written with ``:NAME``.

    ``checks`` adds conditions that reject a row: reason -> boolean expression. ``keep_null`` names
    columns of an update that stay as they are where its expression gives null.
    """

    columns: MappingABC[str, str]
    checks: MappingABC[str, str] = field(default_factory=dict)
    keep_null: tuple[str, ...] = ()

    def expressions(self) -> list[str]:
        return [*self.columns.values(), *self.checks.values()]


@dataclass(frozen=True)
class Link:
    """Row written to the link table after each good insert.

    Values see only the new row's id (``:NEW_ID``) and ``params``.
    """

    columns: MappingABC[str, str]
    schema: MappingABC[str, Column]
    params: MappingABC[str, Any] = field(default_factory=dict)
    id_column: str = "link_id"
    new_id: str = "NEW_ID"

    @property
    def parent_column(self) -> str:
        """The column that refers to the target row."""
        for name, expression in self.columns.items():
            if clean(expression).lower() == f":{self.new_id.lower()}":
                return name
        raise SpecError(f"no link column is set to :{self.new_id}")

    def validate(self) -> None:
        for name, value in self.params.items():
            if value is None or isinstance(value, str) and not value.strip():
                raise SpecError(f"the link parameter '{name}' is blank")
        given = {name.lower() for name in self.params}
        for name, expression in self.columns.items():
            if name not in self.schema:
                raise SpecError(f"link column '{name}' has no declared type")
            for bind in bind_names(clean(expression)):
                if bind.lower() != self.new_id.lower() and bind.lower() not in given:
                    raise SpecError(f"link column '{name}' needs the parameter '{bind}'")
        _ = self.parent_column


@dataclass(frozen=True)
class ChangeSpec:
    business_keys: tuple[str, ...]
    target: MappingABC[str, Column]
    insert: Mapping
    update: Mapping
    # What a delete sets in its row, which then stays; None removes the row.
    delete: Mapping | None = None
    order_key: str = "change_id"
    op_column: str = "operation"
    op_insert: str = "I"
    op_update: str = "U"
    op_delete: str = "D"
    id_column: str = "id"
    nullable_keys: bool = False
    empty_is_null: bool = True
    link: Link | None = None
    quarantine: bool = True
    history: bool = True
    on_duplicate: str = "fail"
    on_missing: str = "noop"
    processed_column: str | None = None
    pending: Any = 0
    done: Any = 1
    mark_policy: str = "keep_quarantined"
    # Names of business key columns in the target, where they differ from those in the log.
    target_keys: MappingABC[str, str] = field(default_factory=dict)
    # The instant that :AS_OF stands for, the same in target, history and quarantine; a cycle sets it.
    as_of: datetime | None = None
    as_of_bind: str = "AS_OF"

    def __post_init__(self) -> None:
        object.__setattr__(self, "business_keys", tuple(self.business_keys))
        if not self.business_keys or any(not k.strip() for k in self.business_keys):
            raise SpecError("business_keys must name at least one column")
        if self.on_duplicate not in ("fail", "upsert"):
            raise SpecError("on_duplicate must be 'fail' or 'upsert'")
        if self.on_missing not in ("noop", "upsert"):
            raise SpecError("on_missing must be 'noop' or 'upsert'")
        if self.mark_policy not in ("keep_quarantined", "applied_done"):
            raise SpecError("mark_policy must be 'keep_quarantined' or 'applied_done'")
        if set(self.target_keys) - set(self.business_keys):
            raise SpecError("target_keys must rename business keys")
        in_target = [self.target_keys.get(k, k).lower() for k in self.business_keys]
        if len({*in_target, self.id_column.lower()}) <= len(in_target):
            raise SpecError("two columns of the target have one name")
        reserved = {k.lower() for k in self.business_keys} | {self.id_column.lower(), *in_target}
        for what, mapping in self.mappings().items():
            if what == "insert" and mapping.keep_null or set(mapping.keep_null) - set(mapping.columns):
                raise SpecError(f"{what}: keep_null must name columns that an update sets")
            for name, expression in mapping.columns.items():
                if name.lower() in reserved:
                    raise SpecError(f"the {what} mapping must not set '{name}'")
                if name not in self.target:
                    raise SpecError(f"{what} column '{name}' has no declared type")
                try:
                    clean(expression)
                except ValueError:
                    raise SpecError(f"{what} column '{name}' has an empty expression") from None
        if self.on_missing == "upsert":
            sets = set(self.update.columns) - set(self.update.keep_null)
            unset = [c for c, d in self.target.items() if not d.nullable and c not in sets]
            if unset:
                raise SpecError(f"on_missing='upsert' needs update expressions for {unset}")
        if self.link is not None:
            if self.on_duplicate != "fail":
                raise SpecError("a link needs on_duplicate='fail': an upsert returns no new id")
            self.link.validate()

    def with_target_keys(self, rows: DataFrame) -> DataFrame:
        """Rows with the business keys called as in the target."""
        return rows.withColumnsRenamed(dict(self.target_keys)) if self.target_keys else rows

    def with_log_keys(self, rows: DataFrame) -> DataFrame:
        """Rows of the target with the business keys called as in the log."""
        return rows.withColumnsRenamed({v: k for k, v in self.target_keys.items()}) if self.target_keys else rows

    def mappings(self) -> dict[str, Mapping]:
        """The mappings by the operation that uses them."""
        found = {"insert": self.insert, "update": self.update}
        return found if self.delete is None else {**found, "delete": self.delete}

    @property
    def columns(self) -> list[str]:
        """Target columns other than the business key and the id."""
        return list(self.target)

    def check_source(self, changes: DataFrame) -> dict[str, str]:
        """Fail before planning on missing or ambiguous names; return lower name -> name."""
        names: dict[str, str] = {}
        for name in changes.columns:
            if name.lower() in names:
                raise SpecError(f"the change log has two columns named '{name}'")
            names[name.lower()] = name
        needed = {"order_key": [self.order_key], "op_column": [self.op_column]}
        needed["business_keys"] = list(self.business_keys)
        if self.processed_column:
            needed["processed_column"] = [self.processed_column]
        for label, columns in needed.items():
            for column in columns:
                if column.lower() not in names:
                    raise SpecError(f"{label}: the change log has no column '{column}'")
        for what, mapping in self.mappings().items():
            for expression in mapping.expressions():
                for name in bind_names(clean(expression)):
                    if name.lower() not in names and name.lower() != self.as_of_bind.lower():
                        raise SpecError(f"{what} binds :{name}, but the change log has no such column")
        return names

    def canonical(self, changes: DataFrame) -> DataFrame:
        """The change log with the columns this spec names spelled as the spec does."""
        self.check_source(changes)
        named = {c.lower(): c for c in (self.order_key, self.op_column, *self.business_keys)}
        if self.processed_column:
            named[self.processed_column.lower()] = self.processed_column
        renames = {c: named[c.lower()] for c in changes.columns if named.get(c.lower(), c) != c}
        return changes.withColumnsRenamed(renames) if renames else changes
