"""One replay cycle over stored state, and the loops built from it.

A cycle reads the key columns of its page once and the page itself once more, for the replay. What the replay finds is
written once, as a narrow audit row per change and a row per effective change with its values. The
audit rows are the history segment; counters, quarantine and stamps read them back, and the target image reads the others.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import audit, stamps
from ..operators.image import ALIVE, changed_rows, image_of, is_image_row
from ..operators.keys import key_join, key_to_text, key_types_of, text_to_key
from ..operators.links import link_changes
from ..operators.names import CREATES, EFFECTIVE, FAILED, KIND, OLD_ID, ORDER, OUTCOME, own, value_column
from ..operators.replay import classify, is_seed
from ..operators.skew import DEFAULT_SKEW, SkewPolicy, find_hot_keys
from ..operators.stamps import Stamps
from ..sources.changelog import keyset_page, page_borders, queue_page, up_to
from ..sources.scratch import Scratch
from ..spec import ChangeSpec
from .deltas import CYCLE, GONE
from .store import BUCKET, Commit, Store

Step = Callable[[str], None]

class OrderKeyError(ValueError):
    """The order key is null or repeated; paging over it would lose or repeat rows."""


@dataclass(frozen=True)
class CycleResult:
    """Counters of a cycle, as they are logged; ``rows_read`` counts every row."""

    version: int
    rows_read: int
    inserted: int
    updated: int
    deleted: int
    failed: int
    total: int
    last_key: str | None


def _key_stats(keys: DataFrame, spec: ChangeSpec, *more) -> dict[str, Any]:
    """Size and range of the rows, and ``more``; rows without an order key are refused."""
    key = F.col(spec.order_key)
    kind = keys.schema[spec.order_key].dataType.simpleString()
    row = keys.agg(
        F.count("*").alias("rows"),
        F.count_if(key.isNull()).alias("blank"),
        key_to_text(F.min(key), kind).alias("low"),
        key_to_text(F.max(key), kind).alias("high"),
        *more,
    ).first()
    if row["blank"]:
        raise OrderKeyError(f"{row['blank']} change rows have no {spec.order_key}")
    return row.asDict()


def _refuse_repeated(rows: DataFrame, spec: ChangeSpec) -> None:
    repeated = rows.groupBy(spec.order_key).count().where("count > 1").limit(1).collect()
    if repeated:
        raise OrderKeyError(f"{spec.order_key}={repeated[0][0]} occurs more than once")


def run_cycle(
    store: Store,
    spec: ChangeSpec,
    page: DataFrame,
    *,
    base: Commit | None = None,
    queue: bool = False,
    skew: SkewPolicy | None = DEFAULT_SKEW,
    as_of: datetime | None = None,
    verify_unique: bool = True,
    stream: tuple[str, int] | None = None,
    late: DataFrame | None = None,
    stats: dict[str, Any] | None = None,
    on_step: Step | None = None,
) -> CycleResult | None:
    """Replay ``page`` over the latest state and commit target, links, quarantine, history,
    marks and resume point together. Returns None if there was nothing to read.

    ``stats`` has the size and range of the page, where they are known. ``on_step`` is called with
    the name of each finished write; tests use it to stop a cycle half-way.
    """
    base = base or store.latest()
    done = on_step or (lambda _: None)
    as_of = as_of or datetime.now(timezone.utc)
    spec = replace(spec, as_of=as_of)
    page = spec.canonical(page)
    keys = list(spec.business_keys)
    scratch = Scratch(store.spark)
    commit = base.next()
    try:
        page, narrow = _key_columns(store, base, spec, page, scratch)
        known = "target" in base.schemas
        buckets = [F.collect_set(store.bucket_of(base, *keys)).alias("buckets")] if known else []  # at most `buckets`
        if stats is None or known:
            stats = _key_stats(narrow, spec, *buckets)
        if late is not None:
            commit, too_late = _write_late(store, base, commit, late)
            if not too_late and not stats["rows"]:
                return None
        elif not stats["rows"]:
            return None
        if stream is not None:
            commit = replace(commit, streams={**base.streams, stream[0]: stream[1]})
        if not stats["rows"]:
            store.publish(commit)
            return CycleResult(commit.version, 0, 0, 0, 0, 0, commit.rows, commit.last_key)

        target = None
        if known:
            target = store.read("target", base, stats["buckets"], spec.with_target_keys(narrow))
            target = _with_new_columns(spec.with_log_keys(target), spec)
        held = store.read("quarantine", base) if spec.quarantine else None
        if held is not None:
            held = key_join(key_types_of(held, narrow, keys).distinct(), narrow, keys, "left_semi")
        hot = None
        if skew is not None and stats["rows"] >= skew.hot_rows:  # a smaller page has no hot key
            hot = find_hot_keys(narrow, keys, spec.order_key, skew, scratch)
        rows = classify(page, spec, target, held, hot, near=True)

        commit, records, changes = _write_outcomes(store, commit, spec, rows, as_of, stats)
        if verify_unique:
            _refuse_repeated(records, spec)
        done("history")
        failed = (F.col(OUTCOME) == FAILED) & (F.col("operation") == spec.op_insert)
        counts = audit.run_counts(records, F.count_if(failed).alias("_failed_inserts")).first().asDict()
        commit, fresh = _write_quarantine(store, commit, spec, records.where(failed), counts.pop("_failed_inserts"), as_of)
        done("quarantine")
        commit = _write_target(store, commit, spec, changes, known, scratch, done)
        if queue:
            commit = _write_marks(store, base, commit, spec, records, held, fresh, scratch)
            done("marks")

        commit = replace(
            commit,
            rows=base.rows + stats["rows"],
            last_key=_furthest(store, base, page, spec, stats["high"]),
            key_type=page.schema[spec.order_key].dataType.simpleString(),
            counts=counts,
        )
        store.publish(commit)
    finally:
        scratch.drop()
        store.files.delete(*_changes_folder(commit).split("/"))
    return CycleResult(commit.version, total=commit.rows, last_key=commit.last_key, **counts)


def _key_columns(store: Store, base: Commit, spec: ChangeSpec, page: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The page with the key types that the target has, and its key columns, written where they are used more than once."""
    if "target" not in base.schemas:
        return page, page.select(*dict.fromkeys([spec.order_key, *spec.business_keys]))
    stored = spec.with_log_keys(store.read("target", base, only=[]))
    types = {k: stored.schema[k].dataType for k in spec.business_keys}
    casts = {k: F.col(k).cast(t) for k, t in types.items() if page.schema[k].dataType != t}
    page = page.withColumns(casts) if casts else page
    return page, scratch.write(page.select(*dict.fromkeys([spec.order_key, *spec.business_keys])))


def _with_new_columns(target: DataFrame, spec: ChangeSpec) -> DataFrame:
    """The stored target, with nulls in columns that the spec did not have when it was written."""
    new = {c: F.lit(None).cast(declared.type) for c, declared in spec.target.items() if c not in target.columns}
    return target.withColumns(new) if new else target


def _furthest(store: Store, base: Commit, page: DataFrame, spec: ChangeSpec, high: str) -> str:
    """The resume key after a cycle: it never goes back, though a queue may take late rows."""
    kind = page.schema[spec.order_key].dataType.simpleString()
    if base.last_key is None or base.key_type != kind:
        return high
    keys = F.greatest(text_to_key(high, kind), text_to_key(base.last_key, kind))
    return store.spark.range(1).select(key_to_text(keys, kind)).first()[0]


FEEDS, AUDIT, IMAGE = "feeds", "audit", "image"


def _changes_folder(commit: Commit) -> str:
    """Where the rows for the target image lie until the cycle is over."""
    return f"{commit.folder('history')}/{FEEDS}={IMAGE}"


def _write_outcomes(store, commit, spec, rows, as_of, stats):
    """The replay, written once: audit rows as a new history segment, and rows for the target image beside it.

    Returns the commit, the audit rows and the image rows. Files are clustered by the hash of the business key, as
    the replay leaves its rows, and have bloom filters on it, so that a key's trace skips most of them.
    """
    known = F.col(own(KIND)).isNotNull()
    feeds = F.array_compact(F.array(F.when(~is_seed(), AUDIT), F.when(is_image_row(spec), IMAGE)))
    rows = rows.withColumn(FEEDS, F.explode(feeds))
    audited, imaged = F.col(FEEDS) == AUDIT, F.col(FEEDS) == IMAGE
    of_key = {k: F.when(known, F.col(k)) for k in spec.business_keys}
    if spec.order_key in of_key:
        of_key[spec.order_key] = F.when(audited, F.col(ORDER)).otherwise(F.col(spec.order_key))
    records = {spec.order_key: F.col(ORDER)} | of_key | audit.record_columns(as_of) | {CYCLE: F.lit(commit.version)}
    image = [ORDER, OLD_ID, *[own(c) for c in (KIND, OUTCOME, CREATES, EFFECTIVE)], *[value_column(c) for c in spec.target]]
    shared = set(spec.business_keys)
    out = rows.select(
        *[(c if n in shared else F.when(audited, c)).alias(n) for n, c in records.items()],
        *[F.when(imaged, F.col(c)).alias(c) for c in image],
        FEEDS,
    )
    folder = commit.folder("history")
    writer = out.write.partitionBy(FEEDS)
    for k in spec.business_keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{k}", "true")
    writer.parquet(store.files.path(folder))

    of = lambda names: T.StructType([f for f in out.schema.fields if f.name in names])
    there = store.files.names(folder)
    read = store.spark.read
    changes = of([*spec.business_keys, *image])
    if f"{FEEDS}={IMAGE}" in there:
        changes = read.schema(changes).parquet(store.files.path(_changes_folder(commit)))
    else:
        changes = store.spark.createDataFrame([], changes)
    schema = of([n for n in records if n != CYCLE])
    path = f"{folder}/{FEEDS}={AUDIT}"
    found = read.schema(schema).parquet(store.files.path(path))
    if spec.history:
        commit = store.with_table(commit, "history", schema, [spec.order_key])
        segment = {"path": path, "low": stats["low"], "high": stats["high"]}
        commit = store.with_segments(commit, "history", [*commit.segments.get("history", []), segment])
    return commit, found, changes


def _write_late(store, base, commit, late):
    """Rows that came after their key had been passed, as they came; and how many."""
    count = late.count()
    if not count:
        return commit, 0
    commit, _, segment = store.write_segment(commit, "late", late)
    commit = store.with_segments(commit, "late", [*base.segments.get("late", []), segment])
    return replace(commit, late=base.late + count), count


def _write_quarantine(store, commit, spec, failed, count, as_of):
    """Keys whose insert failed in this cycle; they cannot be held already. Returns them, None if there are none."""
    if not spec.quarantine:
        return commit, None
    names = list(spec.business_keys)
    fresh = failed.select(*names).distinct().withColumn("quarantined_at", F.lit(as_of))
    if not count:
        return store.with_table(commit, "quarantine", fresh.schema), None
    commit, written, segment = store.write_segment(commit, "quarantine", fresh)
    commit = store.with_segments(commit, "quarantine", [*commit.segments.get("quarantine", []), segment])
    return commit, written.select(*names)


def _write_target(store, commit, spec, changes, known, scratch, done):
    keys = list(spec.business_keys)
    # Written because the counts that decide about folding, the target and the links read it.
    image = scratch.write(image_of(changes, spec, known))
    rows = changed_rows(image, spec).withColumnRenamed(ALIVE, GONE).withColumn(GONE, ~F.col(GONE))
    tables = {"target": (spec.with_target_keys(rows), [spec.target_keys.get(k, k) for k in keys])}
    if spec.link is not None:
        tables["links"] = (link_changes(image, spec, GONE), [spec.link.parent_column])
    sizes = None
    for table, (changed, by) in tables.items():
        some = changed.select(F.lit(table).alias("table"), store.bucket_of(commit, *by).alias(BUCKET), (~F.col(GONE)).alias("kept"))
        sizes = some if sizes is None else sizes.unionByName(some)
    counts: dict[str, dict[int, tuple[int, int]]] = {table: {} for table in tables}
    for r in sizes.groupBy("table", BUCKET).agg(F.count("*").alias("n"), F.count_if("kept").alias("kept")).collect():
        counts[r["table"]][r[BUCKET]] = (r["n"], r["kept"])  # at most a row per table and bucket
    for table, (changed, by) in tables.items():
        commit = store.write_changes(commit, table, changed, by, counts[table])
        done(table)
    return commit


def _write_marks(store, base, commit, spec, records, held, fresh, scratch):
    names = list(spec.business_keys)
    blocked = [df for df in (held, fresh) if df is not None]
    after = None
    if blocked:
        after = blocked[0] if len(blocked) == 1 else key_types_of(held, fresh, names).unionByName(fresh)
    stamped = audit.marks(records, after, spec)
    before = base.segments.get("marks", [])
    if not stamps.has_bits(records.schema[spec.order_key].dataType):
        commit, _, segment = store.write_segment(commit, "marks", stamped)
        return store.with_segments(commit, "marks", [*before, segment])
    commit, fresh, segment = store.write_segment(commit, "marks", stamps.bits_of(stamped, spec.order_key))
    segment["rows"] = fresh.count()
    segments = [*before, segment]
    ranges = [tuple(r) for r in base.ranges.get("marks", [])]
    # Older bits are merged in once the new ones are of their order, or their segments many: rewriting stays in proportion.
    if segment["rows"] * MERGE_SHARE >= sum(s["rows"] for s in before) or len(segments) > MERGE_SEGMENTS:
        bits = scratch.write(stamps.merged(store.read("marks", replace(commit, segments={"marks": segments}))))
        ranges, short = stamps.longest(stamps.joined([*ranges, *stamps.longest_ranges(bits)]))
        left = stamps.full_blocks(stamps.without_ranges(bits, [*ranges, *short]), short)
        commit, rest, segment = store.write_segment(commit, "marks", left, "merged")
        segment["rows"] = rest.count()
        segments = [segment] if segment["rows"] else []
    commit = replace(commit, ranges={**base.ranges, "marks": ranges})
    return store.with_segments(commit, "marks", segments)


#: When stamps are merged: new ones times this outnumber the old ones, or there are more segments than that.
MERGE_SHARE, MERGE_SEGMENTS = 4, 8


def stamps_of(store: Store, base: Commit) -> Stamps | None:
    """What queue cycles have stamped so far."""
    if "marks" not in base.schemas:
        return None
    rest = store.read("marks", base) if base.segments.get("marks") else None
    return Stamps([tuple(r) for r in base.ranges.get("marks", [])], rest)


def _pinned(page: DataFrame, scratch: Scratch, batch_size: int | None, pin: bool | None) -> DataFrame:
    return scratch.write(page) if (batch_size is not None if pin is None else pin) else page


def run_keyset(
    store: Store,
    spec: ChangeSpec,
    changes: DataFrame,
    batch_size: int | None = None,
    restart: bool = False,
    max_cycles: int | None = None,
    pin: bool | None = None,
    **options: Any,
) -> list[CycleResult]:
    """Replay the log past the committed key until it is exhausted.

    The result does not depend on ``batch_size``; None takes the whole rest as one cycle,
    which is what a cluster wants. ``restart`` reads from the beginning over the state that
    is there. ``pin`` copies each page before it is used: a cycle reads its page several
    times, so a source that changes meanwhile, such as a database table, needs it. By default
    only pages cut by ``batch_size`` are pinned.
    """
    results: list[CycleResult] = []
    key = spec.order_key
    after = None if restart else store.latest().last_key_literal()
    while max_cycles is None or len(results) < max_cycles:
        rest = keyset_page(changes, spec, after)
        stats = _key_stats(rest.select(key), spec)
        if not stats["rows"]:
            break
        # One page holds all: its cycle looks for repeated keys in what it has written.
        whole = {"stats": stats} if batch_size is None and not pin else {"verify_unique": False}
        if options.get("verify_unique", True) and "stats" not in whole:
            _refuse_repeated(rest, spec)
        # Rows that arrive while the run is on, behind its last border, are the next round's.
        kind = rest.schema[key].dataType.simpleString()
        end = text_to_key(stats["high"], kind)
        borders = Scratch(store.spark)
        try:
            pages = page_borders(rest.where(up_to(key, end)), key, batch_size, borders) if batch_size is not None else [end]
            for border in pages:
                scratch = Scratch(store.spark)
                try:
                    page = keyset_page(changes, spec, after).where(up_to(key, border))
                    page = _pinned(page, scratch, batch_size, pin)
                    result = run_cycle(store, spec, page, **{**options, **whole})
                finally:
                    scratch.drop()
                after = border
                if result is not None:
                    results.append(result)
                if max_cycles is not None and len(results) >= max_cycles:
                    break
        finally:
            borders.drop()
    return results


def _waiting(store, base, spec, changes, batch_size, scratch) -> DataFrame:
    """Rows of the next queue cycle.

    Ranges of keys that are all stamped are left out by the scan; the rest of the log is matched with the stamps on
    its key columns alone. What is left is usually little: whole rows are then fetched by their keys, and only from the key
    range they span. Rows without a key come along, to be refused.
    """
    done = stamps_of(store, base)
    page = queue_page(changes, spec, store.read("quarantine", base), batch_size, scratch, done)
    if done is None:
        return page
    key = spec.order_key
    waiting = scratch.write(page.select(key))
    span = waiting.agg(F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high")).first()
    if not span["n"]:
        return page.limit(0)
    within = F.col(key).between(F.lit(span["low"]), F.lit(span["high"])) | F.col(key).isNull()
    log = spec.canonical(changes).where(within)
    return key_join(log, waiting, [key], "left_semi")


def run_queue(
    store: Store,
    spec: ChangeSpec,
    changes: DataFrame,
    batch_size: int | None = None,
    max_cycles: int | None = None,
    pin: bool | None = None,
    **options: Any,
) -> list[CycleResult]:
    """Replay pending rows until no eligible one is left.

    The stamps are kept beside the log. With quarantine on, which rows of a failed key get a
    history record depends on the cycle they fall into: rows after the failure are recorded
    as skipped within its cycle and hidden from later ones.
    """
    results: list[CycleResult] = []
    while max_cycles is None or len(results) < max_cycles:
        base = store.latest()
        scratch = Scratch(store.spark)
        try:
            page = _waiting(store, base, spec, changes, batch_size, scratch)
            page = _pinned(page, scratch, batch_size, pin)
            result = run_cycle(store, spec, page, base=base, queue=True, **options)
        finally:
            scratch.drop()
        if result is None:
            break
        results.append(result)
    return results


def pending(store: Store, spec: ChangeSpec, changes: DataFrame) -> DataFrame:
    """Rows not yet stamped, those of quarantined keys included."""
    return queue_page(changes, spec, done=stamps_of(store, store.latest()))


def requeue(store: Store, spec: ChangeSpec, cleared: DataFrame) -> Commit:
    """Take keys out of quarantine; in queue mode their pending rows flow again."""
    base = store.latest()
    held = store.read("quarantine", base)
    if held is None:
        return base
    commit = base.next()
    rest = audit.quarantine_clear(held, cleared, spec)
    commit, _, segment = store.write_segment(commit, "quarantine", rest)
    commit = store.with_segments(commit, "quarantine", [segment])
    store.publish(commit)
    return commit
