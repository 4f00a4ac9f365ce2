"""Cheapest repair of a conversation's structure, by bidirectional search over the edit lattice.

A node of the lattice says how many rows are dealt with and where the repaired roles stand in the grammar
``(s?(ua)+)?``; edges keep, rerole or delete the next row, or insert one. A forward and a reverse heap search it from
both ends until no path as cheap as the best crossing can be left out, and the least audit (the edits' initials)
among all cheapest paths is then read off.

Conversations may be of any length. Rows are sorted by conversation over all tasks and cut into blocks. A
conversation inside a block is searched whole. Of one that meets a block's border, each block gives the cheapest way
between every two places of the grammar, and these are chained in order, row by row of blocks. An insertion belongs to the row
after it; so two audits of the same rows are never one the beginning of the other, and the least whole is made of
least parts.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import stored

BLANKS = " \t\n\x0b\x0c\r"
BLOCK_BITS = 12  # rows of a block, as a power of two
NO_WAY = 1 << 60

# Places in the grammar: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTED = (START, ASSISTANT)
#: Where a row with the role initial s, u, a or another one leads from each place; -1 where it may not stand.
KEEPS = ((SYSTEM, USER, -1, -1), (-1, USER, -1, -1), (-1, -1, ASSISTANT, -1), (-1, USER, -1, -1))
#: Where the one role leads that may be given or inserted, and its name.
LEADS = (USER, USER, ASSISTANT, USER)
GIVES = ("user", "user", "assistant", "user")
COMES = ((), (), (START, SYSTEM, ASSISTANT), (USER,))  # the same, backwards
LEGAL = {(0, 1), (1, 2), (2, 1)}  # initials that may stand side by side
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5  # costs


class Row(NamedTuple):
    """What the search has to know of a row: its role's initial, whether it has to go, and what it costs to leave it."""

    initial: int
    goes: bool
    extra: int


def cheapest(rows: list[Row], begin: int, ends: tuple[int, ...], tail: bool) -> tuple[int, str, int] | None:
    """Cost, least audit and last place of the cheapest way through all rows from ``begin`` to one of ``ends``.

    ``tail`` allows insertions after the last row. None if there is no way.
    """
    n = len(rows)

    def onward(node: int) -> list[tuple[str, int, int]]:
        """Edges (letter, cost, node) from a node, in the order of their letters."""
        i, q = node >> 2, node & 3
        out = []
        if i < n:
            out.append(("D", DELETE, node + 4))
        if i < n or tail:
            out.append(("I", INSERT, (i << 2) + LEADS[q]))
        if i < n and not rows[i].goes:
            row = rows[i]
            if (to := KEEPS[q][row.initial]) >= 0:
                out.append(("K", KEEP + row.extra, (i + 1 << 2) + to))
            out.append(("R", REROLE + row.extra, (i + 1 << 2) + LEADS[q]))
        return out

    def back(node: int) -> list[tuple[int, int]]:
        """Edges (cost, node) into a node."""
        i, q = node >> 2, node & 3
        out = [(INSERT, (i << 2) + p) for p in COMES[q]] if i < n or tail else []
        if i:
            row = rows[i - 1]
            out.append((DELETE, node - 4))
            if not row.goes:
                base = i - 1 << 2
                out += [(KEEP + row.extra, base + p) for p in range(4) if KEEPS[p][row.initial] == q]
                out += [(REROLE + row.extra, base + p) for p in COMES[q]]
        return out

    last = {(n << 2) + q for q in ends}
    near, far = {begin: 0}, dict.fromkeys(last, 0)
    front, rear = [(0, begin)], [(0, node) for node in sorted(last)]
    seen: dict[int, int] = {}  # settled from the front, with their cost
    met: dict[int, int] = {}  # settled from the rear
    best = 0 if begin in last else NO_WAY
    while front and rear and front[0][0] + rear[0][0] <= best:
        if front[0][0] <= rear[0][0]:
            cost, node = heapq.heappop(front)
            if node in seen:
                continue
            seen[node] = cost
            for _, step, to in onward(node):
                if cost + step < near.get(to, NO_WAY):
                    near[to] = cost + step
                    heapq.heappush(front, (cost + step, to))
                best = min(best, cost + step + far.get(to, NO_WAY))
        else:
            cost, node = heapq.heappop(rear)
            if node in met:
                continue
            met[node] = cost
            for step, to in back(node):
                if cost + step < far.get(to, NO_WAY):
                    far[to] = cost + step
                    heapq.heappush(rear, (cost + step, to))
                best = min(best, cost + step + near.get(to, NO_WAY))
    if best >= NO_WAY:
        return None
    met |= dict.fromkeys(last, 0)
    # Nodes settled from the front that lie on a cheapest way, later ones first (keeping costs nothing, but goes on a row).
    good: set[int] = set()
    for node in sorted(seen, key=lambda x: (seen[x], x >> 2), reverse=True):
        if seen[node] + met.get(node, NO_WAY) == best:
            good.add(node)
            continue
        for _, step, to in onward(node):
            there = seen[node] + step
            if there + met.get(to, NO_WAY) == best or (to in good and seen[to] == there):
                good.add(node)
                break
    node, cost, audit = begin, 0, []
    while not (node in last and cost == best):
        for letter, step, to in onward(node):
            there = cost + step
            if there + met.get(to, NO_WAY) == best or (to in good and seen[to] == there):
                node, cost = to, there
                audit.append(letter)
                break
    return best, "".join(audit), node & 3


# -- rows in order -----------------------------------------------------------


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) with a twentieth each dropped, emptied, cut short, repeated or given to the user.

    Which is decided by the CRC-32 of ``conv_id:turn``. Nulls read as one blank there and in role and text.
    """
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    text = F.when(kind == 1, "").when(kind == 2, F.translate(text_of("text"), ".!?", "")).otherwise(text_of("text"))
    role = F.when(kind == 4, "user").otherwise(text_of("role"))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies"))
    return rows.withColumn("copies", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).drop("copies")


def in_order(turns: DataFrame) -> DataFrame:
    """Rows with their ``pos``, which grows by conversation, turn (nulls first), role and text. Written once.

    One range exchange sorts all rows; a long conversation spreads over several tasks.
    """
    keys = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text").repartitionByRange(*keys).sortWithinPartitions(*keys)
    return stored(rows.withColumn("pos", F.monotonically_increasing_id()))


def _initial() -> Column:
    first = F.substring("role", 1, 1)
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)


def faults(ordered: DataFrame) -> DataFrame:
    """conv_id, pos, initial and fault (blank, duplicate, truncated or null) of every row; texts are not carried."""
    ends = F.rtrim("text", F.lit(BLANKS))
    narrow = ordered.select(
        "conv_id",
        "pos",
        "role",
        _initial().alias("initial"),
        F.sha2("text", 256).alias("digest"),
        (ends == "").alias("blank"),
        (~F.substring(ends, -1, 1).isin(".", "!", "?")).alias("open"),
    )
    first = narrow.groupBy("conv_id", "role", "digest").agg(F.min("pos").alias("first")).select("first")
    met = narrow.join(first.hint("shuffle_hash"), F.col("pos") == F.col("first"), "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("open"), "truncated")
    return met.select("conv_id", "pos", "initial", fault.alias("fault"))


# -- the search, block by block ----------------------------------------------

COUNTED = ("blank", "duplicate", "truncated")
_COUNTS = ", ".join(f"{c} long" for c in COUNTED)


def _runs(rows: Iterator[tuple], bits: int) -> Iterator[tuple[list[tuple], bool]]:
    """Rows (conv_id, pos, ...) of one conversation in one block, and whether they are sure to be all of it."""
    run: list[tuple] = []
    first = True  # of its block
    for row in rows:
        if run and (row[1] >> bits != run[-1][1] >> bits):
            yield run, False
            run, first = [], True
        elif run and row[0] != run[-1][0]:
            yield run, not first
            run, first = [], False
        run.append(row)
    if run:
        yield run, False


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def _batches_of(rows: Iterator[tuple], schema: pa.Schema, size: int = 2_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _typed(rows: DataFrame, fields: str) -> T.StructType:
    """A Spark schema: conv_id as in ``rows``, and ``fields``."""
    return T.StructType([T.StructField("conv_id", rows.schema["conv_id"].dataType), *T.StructType.fromDDL(fields).fields])


def searched(marked: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """One row per conversation and block: counts, and the cheapest ways through it.

    ``marked`` is what :func:`faults` gives. Rows of a block (2 ** ``bits`` at most) are searched in one task.
    """
    schema = _typed(marked, f"pos long, whole boolean, first int, last int, illegal long, {_COUNTS}, ways array<struct<q: int, to: int, cost: bigint, audit: string>>")
    arrow = to_arrow_schema(schema)

    def one(run: list[tuple], whole: bool) -> tuple:
        rows = [Row(i, f in ("blank", "duplicate"), TRUNCATED if f == "truncated" else 0) for _, _, i, f in run]
        ways = []
        if whole:
            cost, audit, to = cheapest(rows, START, ACCEPTED, True)
            ways.append({"q": START, "to": to, "cost": cost, "audit": audit})
        else:
            for q in range(4):
                for to in range(4):
                    if (found := cheapest(rows, q, (to,), False)) is not None:
                        ways.append({"q": q, "to": to, "cost": found[0], "audit": found[1]})
        illegal = sum((a.initial, b.initial) not in LEGAL for a, b in zip(rows, rows[1:]))
        counts = [sum(f == name for _, _, _, f in run) for name in COUNTED]
        return (run[0][0], run[0][1], whole, rows[0].initial, rows[-1].initial, illegal, *counts, ways)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches_of((one(r, whole) for r, whole in _runs(_rows_of(batches), bits)), arrow)

    dealt = marked.repartition(F.shiftright("pos", bits)).sortWithinPartitions("pos")
    return dealt.mapInArrow(run, schema)


class Chain:
    """The cheapest ways from a conversation's begin to each place, block after block.

    ``tips`` holds, for a place, the cost, the rank of its audit among those of the places, and the parts as a linked list:
    (parts before, pos, place before, audit of the block).
    """

    def __init__(self, name):
        self.name = name
        self.tips: dict[int, tuple] = {START: (0, 0, None)}
        self.counts = [0] * (1 + len(COUNTED))
        self.last: int | None = None

    def add(self, pos: int, whole: bool, first: int, last: int, *rest) -> None:
        *counts, ways = rest
        self.counts = [a + b for a, b in zip(self.counts, counts, strict=True)]
        self.counts[0] += self.last is not None and (self.last, first) not in LEGAL
        self.last = last
        found: dict[int, tuple] = {}
        for way in ways:
            if (tip := self.tips.get(way["q"])) is not None:
                key = (tip[0] + way["cost"], tip[1], way["audit"])
                if way["to"] not in found or key < found[way["to"]][0]:
                    found[way["to"]] = (key, (tip[2], pos, way["q"], way["audit"]))
        order = sorted(found, key=lambda q: found[q][0][1:])
        self.tips = {q: (found[q][0][0], order.index(q), found[q][1]) for q in order}

    def close(self) -> tuple[int, str, list[tuple[int, int, str]]]:
        """Cost, the insertions at the end, and the parts (pos, place, audit) in order."""
        after = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}  # insertions that lead to an accepted place
        q = min(self.tips, key=lambda q: (self.tips[q][0] + INSERT * after[q], self.tips[q][1]))
        cost, _, parts = self.tips[q]
        out = []
        while parts is not None:
            parts, *part = parts
            out.append(tuple(part))
        return cost + INSERT * after[q], "I" * after[q], out[::-1]


def chained(blocks: DataFrame) -> DataFrame:
    """One row per conversation and block: where the grammar stands at its first row (``place``), and the edits of its rows.

    The last row of a conversation also has its totals: cost, illegal and the faults.
    """
    schema = _typed(blocks, f"pos long, place int, audit string, cost long, illegal long, {_COUNTS}")
    arrow = to_arrow_schema(schema)

    def closed(chain: Chain) -> Iterator[tuple]:
        cost, tail, parts = chain.close()
        for pos, place, audit in parts[:-1]:
            yield (chain.name, pos, place, audit, *[None] * (2 + len(COUNTED)))
        pos, place, audit = parts[-1]
        yield (chain.name, pos, place, audit + tail, cost, *chain.counts)

    def each(rows: Iterator[tuple]) -> Iterator[tuple]:
        chain = None
        for name, pos, whole, first, last, *rest in rows:
            if chain is None or chain.name != name:
                if chain is not None:
                    yield from closed(chain)
                chain = Chain(name)
            chain.add(pos, whole, first, last, *rest)
        if chain is not None:
            yield from closed(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches_of(each(_rows_of(batches)), arrow)

    # A conversation is chained in one task, a row per block at a time.
    return blocks.repartition("conv_id").sortWithinPartitions("pos").mapInArrow(run, schema)


# -- what comes out ----------------------------------------------------------


class Edited(NamedTuple):
    """An edit: the row's turn, and its role and text afterwards (None where it goes). ``seq`` orders edits at one row."""

    conv_id: object
    pos: int
    seq: int
    edit: str
    turn: int | None
    role: str | None
    text: str | None


class Planned(NamedTuple):
    """What :func:`chained` gives for a block; totals are None but in the conversation's last one."""

    conv_id: object
    pos: int
    place: int
    audit: str
    cost: int | None
    illegal: int | None
    blank: int | None
    duplicate: int | None
    truncated: int | None


def _together(ordered: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows, and before the first row of each block what is planned for it."""
    rows = ordered.withColumns({"initial": _initial(), "kind": F.lit(1)})
    both = rows.unionByName(plan.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    return both.select("kind", "turn", "role", "text", "initial", *Planned._fields)


def _edits(rows: Iterator[tuple]) -> Iterator[Edited | Planned]:
    """The sorted stream of :func:`_together`: each plan as it is, then the edits it stands for."""
    place, audit, at, end = START, "", 0, 0
    for kind, turn, role, text, initial, *planned in rows:
        name, pos = planned[0], planned[1]
        if kind == 0:
            plan = Planned(*planned)
            place, audit, at, end = plan.place, plan.audit, 0, len(plan.audit.rstrip("I"))
            yield plan
            continue
        seq = 0
        while at < len(audit):
            letter = audit[at]
            at += 1
            if letter == "I":
                yield Edited(name, pos, seq, "I", None, GIVES[place], "")
                place = LEADS[place]
            elif letter == "D":
                yield Edited(name, pos, seq, "D", turn, None, None)
            elif letter == "K":
                yield Edited(name, pos, seq, "K", turn, role, text)
                place = KEEPS[place][initial]
            else:
                yield Edited(name, pos, seq, "R", turn, GIVES[place], text)
                place = LEADS[place]
            seq += 1
            # A row's edit is its last one, but for insertions at the end of the conversation.
            if letter != "I" and at < end:
                break


def edited(ordered: DataFrame, plan: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """The edits of all rows: conv_id, pos, seq, edit, turn, role, text; those but ``D`` are the repaired conversations.

    Blocks are edited side by side, also those of one long conversation.
    """
    schema = _typed(ordered, "pos long, seq int, edit string, turn long, role string, text string")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches_of((x for x in _edits(_rows_of(batches)) if isinstance(x, Edited)), arrow, 200)

    dealt = _together(ordered, plan).repartition(F.shiftright("pos", bits)).sortWithinPartitions("pos", "kind")
    return dealt.mapInArrow(run, schema)


class Digest:
    """Running figures of one conversation."""

    def __init__(self, name):
        self.name, self.hash, self.any = name, hashlib.sha256(), False
        self.audit: list[str] = []
        self.low: int | None = None
        self.high: int | None = None
        self.turns = 0
        self.totals: tuple = ()

    def add(self, step: Edited | Planned) -> None:
        if isinstance(step, Planned):
            self.audit.append(step.audit)
            self.totals = step[4:]
            return
        if step.turn is not None and step.turn != self.high:
            self.low = step.turn if self.low is None else self.low
            self.high = step.turn
            self.turns += 1
        if step.edit != "D":
            self.hash.update(f"{chr(10) if self.any else ''}{step.role}:{step.text}".encode())
            self.any = True

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        cost, illegal, *counts = self.totals
        return (self.name, gaps, *counts, illegal, cost, "".join(self.audit), self.hash.hexdigest())


def digests(ordered: DataFrame, plan: DataFrame) -> DataFrame:
    """One row per conversation that has rows: gaps, faults, illegal, cost, audit and the hash of the repaired text.

    A hash runs over a conversation's rows in order, so they pass through one task, one at a time.
    """
    schema = _typed(ordered, f"gaps long, {_COUNTS}, illegal long, cost long, audit string, repaired_sha256 string")
    arrow = to_arrow_schema(schema)

    def each(rows: Iterator[tuple]) -> Iterator[tuple]:
        digest = None
        for step in _edits(rows):
            if digest is None or digest.name != step.conv_id:
                if digest is not None:
                    yield digest.row()
                digest = Digest(step.conv_id)
            digest.add(step)
        if digest is not None:
            yield digest.row()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches_of(each(_rows_of(batches)), arrow)

    return _together(ordered, plan).repartition("conv_id").sortWithinPartitions("pos", "kind").mapInArrow(run, schema)


def plan_of(ordered: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """The cheapest edits of ordered rows, block by block; written once."""
    return stored(chained(searched(faults(ordered), bits)))


def repair(turns: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """Repaired conversations of ``turns`` (conv_id, turn, role, text): see :func:`edited`."""
    ordered = in_order(turns)
    return edited(ordered, plan_of(ordered, bits), bits)


def repair_report(turns: DataFrame, after: DataFrame | None = None, bits: int = BLOCK_BITS) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text): faults of its rows and its cheapest repair.

    ``after`` holds the rows to repair where they are not ``turns`` itself. A conversation without rows there, or
    with none at all to keep, has an empty text; without rows all figures are 0 and the audit is empty. Rows of a null
    conv_id are one conversation. Null turns come first; equal turns are taken by role and text, and equal rows are each a
    row, of which the first is no duplicate. An empty table gives no rows. Other columns are not read.
    """
    ordered = in_order(turns if after is None else after)
    found = digests(ordered, plan_of(ordered, bits)).withColumnRenamed("conv_id", "_conv")
    every = turns.select("conv_id").distinct()
    met = every.join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("gaps", *COUNTED, "illegal", "cost")}
    texts = {"audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256))}
    return met.withColumns(zero | texts)
