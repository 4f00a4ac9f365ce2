"""Versioned tables and the commit record that makes a cycle all-or-nothing.

A cycle writes new Parquet folders and then one commit record that names, for each table,
the folders in force. Readers follow the highest record only, so a cycle that stops
half-way leaves nothing visible. Every attempt has folders of its own: one that lost the
race to commit cannot touch what the winner wrote.

Target and links are cut into hash buckets of base rows and later changes (see ``deltas``); a cycle adds its changes.
History, quarantine and late rows grow by segments that are never rewritten by a cycle; a record that was
written again in a later segment is the one that is read.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field, replace
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.keys import key_join, text_to_key
from .deltas import APPEND, CYCLE, FOLD, GONE, after_step, newest, next_step
from .files import Files

BUCKET = "bucket"
BUCKETED = ("target", "links")
SEGMENTED = ("history", "quarantine", "marks", "late")
COMMITS = "_commits"


_MARKED = [T.StructField(CYCLE, T.IntegerType()), T.StructField(GONE, T.BooleanType())]


def _at(folder: str, bucket: str | int) -> str:
    return f"{folder}/{BUCKET}={bucket}"


class CommitConflict(RuntimeError):
    """Another run committed the same version first."""


@dataclass(frozen=True)
class Commit:
    version: int = 0
    attempt: str = ""
    buckets: int = 64
    last_key: str | None = None
    key_type: str | None = None
    rows: int = 0
    late: int = 0
    counts: dict[str, int] = field(default_factory=dict)
    streams: dict[str, int] = field(default_factory=dict)
    schemas: dict[str, str] = field(default_factory=dict)
    keys: dict[str, list[str]] = field(default_factory=dict)
    parts: dict[str, dict[str, dict[str, Any]]] = field(default_factory=dict)
    segments: dict[str, list[dict[str, Any]]] = field(default_factory=dict)
    ranges: dict[str, list[Any]] = field(default_factory=dict)

    def last_key_literal(self) -> Column | None:
        """The resume point with its own type."""
        return None if self.last_key is None else text_to_key(self.last_key, self.key_type)

    def next(self) -> Commit:
        """A new attempt at the following version."""
        return replace(self, version=self.version + 1, attempt=uuid.uuid4().hex[:12])

    def folder(self, table: str) -> str:
        """Where this attempt writes a table."""
        return f"{table}/v={self.version}-{self.attempt}"

    def folders(self) -> set[str]:
        """The folders this commit needs."""
        parts = [p for table in self.parts.values() for p in table.values()]
        used = {folder for p in parts for folder in (p["base"], *p["sets"]) if folder is not None}
        used |= {s["path"] for table in self.segments.values() for s in table}
        return {"/".join(path.split("/")[:2]) for path in used}


def _comparable(text: str, kind: str) -> Any:
    """An order key's text (see ``key_to_text``) as a value that sorts like the key."""
    if kind in ("float", "double"):
        return float(text)
    if kind == "timestamp" or kind.endswith("int") or kind.startswith("decimal"):
        return Decimal(text)
    return text.encode()


def overlapping(segments: list[dict[str, Any]], kind: str) -> list[list[dict[str, Any]]]:
    """Segments in groups whose key ranges (low to high) meet, directly or by others between them."""
    groups: list[list[dict[str, Any]]] = []
    furthest = None
    for segment in sorted(segments, key=lambda s: _comparable(s["low"], kind)):
        high = _comparable(segment["high"], kind)
        if furthest is not None and _comparable(segment["low"], kind) <= furthest:
            groups[-1].append(segment)
            furthest = max(furthest, high)
        else:
            groups.append([segment])
            furthest = high
    return groups


class Store:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark = spark
        self.files = Files(spark, root)
        self._buckets = buckets

    # -- commits -----------------------------------------------------------

    def versions(self) -> list[int]:
        names = self.files.names(COMMITS)
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != ".")

    def commit_of(self, version: int) -> Commit:
        return Commit(**json.loads(self.files.read_text(COMMITS, f"{version:012d}.json")))

    def latest(self) -> Commit:
        versions = self.versions()
        return self.commit_of(versions[-1]) if versions else Commit(buckets=self._buckets)

    def publish(self, commit: Commit) -> None:
        text = json.dumps(asdict(commit), sort_keys=True)
        if not self.files.publish(text, COMMITS, f"{commit.version:012d}.json"):
            raise CommitConflict(f"version {commit.version} is already committed")

    # -- reading -----------------------------------------------------------

    def _schema(self, commit: Commit, table: str, *more: T.StructField) -> T.StructType:
        return T.StructType([*T.StructType.fromJson(json.loads(commit.schemas[table])).fields, *more])

    def _files(self, schema: T.StructType, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[self.files.path(p) for p in paths])

    def read(
        self, table: str, commit: Commit | None = None, only: list[int] | None = None, near: DataFrame | None = None
    ) -> DataFrame | None:
        """A table as of a commit, or None if it was never written.

        Of a bucketed table ``only`` picks buckets, and ``near`` the rows whose key is in it: they are picked before the
        newest are looked for.
        """
        commit = commit or self.latest()
        if table not in commit.schemas:
            return None
        if table in BUCKETED:
            return self._read_buckets(commit, table, only, near)
        segments = commit.segments.get(table, [])
        if table != "history":
            return self._files(self._schema(commit, table), [s["path"] for s in segments])
        return self._read_history(commit, segments)

    def _read_buckets(self, commit: Commit, table: str, only: list[int] | None, near: DataFrame | None) -> DataFrame:
        parts, keys = commit.parts.get(table, {}), commit.keys[table]
        wanted = parts if only is None else {str(b): parts[str(b)] for b in only if str(b) in parts}
        schema = self._schema(commit, table)
        close = lambda rows: rows if near is None else key_join(rows, near, keys, "left_semi")
        whole = [_at(p["base"], b) for b, p in wanted.items() if not p["sets"]]
        changed = [_at(f, b) for b, p in wanted.items() if p["sets"] for f in (p["base"], *p["sets"])]
        rows = close(self._files(schema, whole))
        if not changed:
            return rows
        found = newest(close(self._files(T.StructType([*schema.fields, *_MARKED]), changed)), keys)
        found = found.where(~F.col(GONE)).select(*schema.names)
        return found if not whole else rows.unionByName(found)

    def _read_history(self, commit: Commit, segments: list[dict[str, Any]]) -> DataFrame:
        """Records of all segments. Only where key ranges meet can a later cycle have written a record again."""
        schema = self._schema(commit, "history")
        groups = overlapping(segments, commit.key_type)
        rows = self._files(schema, [g[0]["path"] for g in groups if len(g) == 1])
        met = [s["path"] for g in groups if len(g) > 1 for s in g]
        if not met:
            return rows
        again = newest(self._files(T.StructType([*schema.fields, _MARKED[0]]), met), commit.keys["history"])
        return rows.unionByName(again.drop(CYCLE)) if len(met) < len(segments) else again.drop(CYCLE)

    # -- writing -----------------------------------------------------------

    def bucket_of(self, commit: Commit, *columns: str) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(commit.buckets)).cast("int")

    def write_changes(
        self, commit: Commit, table: str, rows: DataFrame, keys: list[str], counts: dict[int, tuple[int, int]]
    ) -> Commit:
        """Add changed rows, with ``GONE`` where the key's row goes; ``commit`` is the one being built.

        ``counts`` has, for each bucket they fall into, the number of rows and of those that stay. Buckets that are folded
        or packed are read back and written together with the rest, in one write. Rebalancing puts a bucket into as
        few files as its size allows: AQE splits large buckets over several tasks and packs small ones together.
        """
        parts = commit.parts.get(table, {})
        schema = T.StructType([f for f in rows.schema.fields if f.name != GONE])
        steps = {b: next_step(parts.get(str(b)), n) for b, (n, _) in counts.items()}
        redone = [b for b, step in steps.items() if step != APPEND and str(b) in parts]
        folded = [b for b, step in steps.items() if step == FOLD]
        bucket = self.bucket_of(commit, *keys)
        rows = rows.withColumns({CYCLE: F.lit(commit.version), BUCKET: bucket})
        if redone:
            paths = [_at(f, b) for b in redone for p in [parts[str(b)]] for f in ([p["base"]] if steps[b] == FOLD else []) + p["sets"]]
            before = self._files(T.StructType([*schema.fields, *_MARKED]), paths)
            again = rows.where(F.col(BUCKET).isin(redone)).drop(BUCKET)
            met = newest(before.unionByName(again), keys).withColumn(BUCKET, bucket)
            rows = rows.where(~F.col(BUCKET).isin(redone)).unionByName(met)
        if folded:
            # A base needs no rows that say that a key is gone.
            rows = rows.where(~F.col(GONE) | ~F.col(BUCKET).isin(folded))
        folder = commit.folder(table)
        rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(self.files.path(folder))
        there = {n.split("=")[1] for n in self.files.names(folder) if n.startswith(f"{BUCKET}=")}
        sizes = {b: (kept if steps[b] == FOLD else n) for b, (n, kept) in counts.items()}
        if redone:
            written = self.spark.read.parquet(self.files.path(folder)).where(F.col(BUCKET).isin(redone))
            sizes |= {r[0]: r[1] for r in written.groupBy(BUCKET).count().collect()}
        after = dict(parts)
        for b, step in steps.items():
            if str(b) in there:
                after[str(b)] = after_step(step, parts.get(str(b)), folder, sizes[b])
            elif step == FOLD:
                after.pop(str(b), None)
        return self.with_table(replace(commit, parts={**commit.parts, table: after}), table, schema, keys)

    @staticmethod
    def with_table(commit: Commit, table: str, schema: T.StructType, keys: list[str] | None = None) -> Commit:
        """The commit with a table's columns, and its keys where rows are found by them."""
        named = commit.keys if keys is None else {**commit.keys, table: list(keys)}
        return replace(commit, keys=named, schemas={**commit.schemas, table: schema.json()})

    def write_segment(self, commit: Commit, table: str, rows: DataFrame, name: str = "new") -> tuple[Commit, DataFrame, dict[str, Any]]:
        """Write rows as a segment of the commit being built; not yet part of its list."""
        path = f"{commit.folder(table)}/{name}"
        rows.write.parquet(self.files.path(path))
        written = self.spark.read.schema(rows.schema).parquet(self.files.path(path))
        return self.with_table(commit, table, rows.schema), written, {"path": path}

    def compact_history(self, most: int = 1) -> Commit:
        """Rewrite each group of more than ``most`` history segments whose key ranges meet as one, sorted by key.

        The segments that are replaced stay until :meth:`vacuum` finds that no commit needs them.
        """
        base = self.latest()
        groups = overlapping(base.segments.get("history", []), base.key_type)
        if all(len(g) <= most for g in groups):
            return base
        commit, kept = base.next(), []
        keys = commit.keys["history"]
        schema = T.StructType([*self._schema(commit, "history").fields, _MARKED[0]])
        for i, group in enumerate(groups):
            if len(group) <= most:
                kept += group
                continue
            rows = newest(self._files(schema, [s["path"] for s in group]), keys)
            path = f"{commit.folder('history')}/part={i}"
            rows.repartitionByRange(*keys).sortWithinPartitions(*keys).write.parquet(self.files.path(path))
            last = max(group, key=lambda s: _comparable(s["high"], base.key_type))
            kept.append({"path": path, "low": group[0]["low"], "high": last["high"]})
        commit = self.with_segments(commit, "history", kept)
        self.publish(commit)
        return commit

    @staticmethod
    def with_segments(commit: Commit, table: str, segments: list[dict[str, Any]]) -> Commit:
        return replace(commit, segments={**commit.segments, table: segments})

    def vacuum(self, keep: int = 2) -> list[str]:
        """Drop commits older than the last ``keep``, and folders that no kept commit uses.

        Folders of a version still to come belong to a cycle at work and stay.
        """
        if keep < 1:
            raise ValueError("keep must be at least 1")
        versions = self.versions()
        kept, old = versions[-keep:], versions[:-keep]
        if not versions:
            return []
        used = set().union(*[self.commit_of(v).folders() for v in kept])
        dropped = []
        for version in old:
            self.files.delete(COMMITS, f"{version:012d}.json")
        for table in (*BUCKETED, *SEGMENTED):
            for name in self.files.names(table):
                written = int(name.removeprefix("v=").split("-")[0])
                if written <= versions[-1] and f"{table}/{name}" not in used:
                    self.files.delete(table, name)
                    dropped.append(f"{table}/{name}")
        return dropped
