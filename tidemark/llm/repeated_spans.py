"""Removal of byte spans that occur elsewhere, by column-wise construction over many documents.

Every window of ``WINDOW`` bytes names an anchor: of its ``GRAM``-byte grams the one with the least hash.
Equal windows name equal anchors at equal places, so texts are cut into segments, each the windows in a
row that name one anchor, and segments of an anchor are laid side by side, aligned at it.

A collection of aligned segments is then sorted column by column from the right. Each round puts one more
symbol before every segment's suffix: the symbols in the present order (the column's Burrows-Wheeler
transform) give the next order by a stable partition, and the common prefixes of neighbours follow from
the last ones by range minima. Where a suffix shares ``WINDOW`` bytes with a neighbour, its window is
repeated. Rounds only go through arrays in sequence, and a collection holds whole anchors, so collections
are as many tasks as there are.

Every segment is sent once to where its anchor's segments meet, as hashes and its place, without bytes; equal
segments of one text are sent as one. So it is known exactly which anchors occur once: no more is done for those.
A segment that occurs as it is more than once is repeated as a whole. Only for anchors of different segments are
bytes needed, those of each distinct segment once: tasks find them by a table of bits, of fixed size, and what it
lets through wrongly is dropped where the anchor's segments meet. Anchors with more than ``most`` distinct segments
would be a large collection; the windows of those are dealt by their own hash instead.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import flat_text, pieces_of, stored
from .decontamination import _mixed, _powers

WINDOW, GRAM = 200, 100
SPAN = WINDOW - GRAM + 1  # grams in a window, and windows that a gram can be in
SLOT_BITS, BLOCK_BITS = 28, 18
PLACE_BITS = 28
SIZE_BITS = 7  # for what a segment's bytes exceed a window by, and for the anchor's place in it: both below ``SPAN``
MEMBER_BITS = 22
COLLECTION = 20_000
CHUNK = 1 << 17
MISSING = 0xFF  # in no UTF-8 text

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


class Rolling:
    """Hashes of the parts of a byte string."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        terms = (data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n)
        self.total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms)))
        self.inverse = _powers(_INVERSE, n + 1)

    def parts(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.total[end] - self.total[begin]) * self.inverse[begin] + (end - begin).astype(np.uint64))


def least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` values in a row: least of a block's end and of the next block's start."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


class Segments:
    """The segments of many texts: text, anchor hash, content hash, first byte, bytes, and the anchor's place in it.

    Hashes of all places are many times the texts' size, so they are made for about ``CHUNK`` bytes of whole
    texts at a time, and only the segments are kept.
    """

    def __init__(self, data: np.ndarray, starts: np.ndarray):
        parts = []
        first = 0
        while first < len(starts) - 1:
            after = max(first + 1, int(np.searchsorted(starts, starts[first] + CHUNK, side="right")) - 1)
            own = starts[first : after + 1]
            if len(found := _segments(data[own[0] : own[-1]], own - own[0])):
                found[0] += first
                found[1] += own[0]
                parts.append(found)
            first = after
        none = np.zeros(0, np.int64)
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [none] * 4 + [none.view(np.uint64)] * 2
        self.text, self.begin, self.size, self.place, self.anchor, self.content = columns


def _segments(data: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """Text, first byte, bytes, anchor's place, anchor and content hash of each segment; empty if there is none."""
    n = len(data) - WINDOW + 1
    if n <= 0:
        return []
    rolling = Rolling(data)
    at = np.arange(len(data) - GRAM + 1)
    grams = rolling.parts(at, at + GRAM)
    low = np.uint64((1 << PLACE_BITS) - 1)
    least = least_in_windows(grams & ~low | at.astype(np.uint64), SPAN)
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[:n]
    inside = at[:n] + WINDOW <= starts[1:][owner]
    where = np.flatnonzero(inside)
    if not len(where):
        return []
    chosen = (least[where] & low).astype(np.int64)
    new = np.flatnonzero(np.diff(chosen, prepend=-1) != 0)
    first, last = where[new], where[np.append(new[1:], len(where)) - 1]
    size = last + WINDOW - first
    return [owner[first], first, size, chosen[new] - first, grams[chosen[new]], rolling.parts(first, first + size)]


def equal_in_text(found: Segments) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first of the equal segments of each text, whether it has more of them, and all segments that are not the only one."""
    order = np.lexsort((found.content, found.anchor, found.text))
    same = [np.diff(c[order]) == 0 for c in (found.text, found.anchor, found.content)]
    new = np.flatnonzero(np.concatenate(([True], ~np.logical_and.reduce(same)))) if len(order) else order
    times = np.diff(np.append(new, len(order)))
    return order[new], times > 1, np.sort(order[np.repeat(times > 1, times)])


def dealt_segments(docs: DataFrame) -> DataFrame:
    """The distinct segments of each of ``docs`` (text_key, text): hashes and text, and in ``at`` the first byte, whether the
    text has it again, the size beyond a window and the anchor's place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text", 1 << 20):
            data, starts = flat_text(batch.column(1))
            found = Segments(data, starts)
            first, several, _ = equal_in_text(found)
            text = found.text[first]
            at = ((found.begin[first] - starts[text]) << 1 | several) << SIZE_BITS | (found.size[first] - WINDOW)
            columns = [found.anchor[first].view(np.int64), found.content[first].view(np.int64)]
            columns = [*map(pa.array, columns), batch.column(0).take(pa.array(text)), pa.array(at << SIZE_BITS | found.place[first])]
            yield pa.RecordBatch.from_arrays(columns, names=["anchor", "content", "text_key", "at"])

    return docs.select("text_key", "text").mapInArrow(run, "anchor long, content long, text_key long, at long")


def begin_of(at: Column) -> Column:
    return F.shiftright(at, 2 * SIZE_BITS + 1)


def size_of(at: Column) -> Column:
    return F.shiftright(at, SIZE_BITS).bitwiseAND((1 << SIZE_BITS) - 1) + WINDOW


def several_of(at: Column) -> Column:
    return F.shiftright(at, 2 * SIZE_BITS).bitwiseAND(1)


def met_segments(docs: DataFrame) -> DataFrame:
    """Those of ``dealt_segments`` whose anchor occurs again: ``alone`` if the segment as it is does not, ``mixed`` if
    the anchor has others, ``chosen`` in one text (or in its repeated rows) for each distinct segment."""
    times = F.sum(1 + several_of(F.col("at")))
    by_anchor, by_content = Window.partitionBy("anchor"), Window.partitionBy("anchor", "content")
    dealt = dealt_segments(docs).repartition("anchor").sortWithinPartitions("anchor", "content")
    met = dealt.withColumn("of_anchor", times.over(by_anchor)).filter("of_anchor > 1").withColumn("times", times.over(by_content))
    met = met.withColumn("chosen", F.col("text_key") == F.min("text_key").over(by_content))
    met = met.withColumn("alone", F.col("times") == 1).withColumn("mixed", F.col("times") < F.col("of_anchor"))
    return met.select("anchor", "content", "text_key", "at", "alone", "mixed", "chosen")


def _slots(text_key: np.ndarray, begin: np.ndarray) -> list[np.ndarray]:
    """The two slots of a place in a text."""
    mixed = _mixed(text_key.view(np.uint64) + (begin.astype(np.uint64) + np.uint64(1)) * _BASE)
    return [(mixed >> np.uint64(64 - k * SLOT_BITS) & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64) for k in (1, 2)]


def place_bits(wanted: DataFrame) -> np.ndarray:
    """Packed bits: the slots of the places of ``wanted`` (text_key, begin)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = np.concatenate(_slots(*(c.to_numpy() for c in batch.columns)))
            yield pa.RecordBatch.from_arrays([pa.array(slots >> BLOCK_BITS), pa.array(slots)], names=["block", "slot"])

    def pack(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(1 << BLOCK_BITS, bool)
        block = 0
        for part in rows:
            block = part.column(0)[0].as_py()
            out[part.column(1).to_numpy() & ((1 << BLOCK_BITS) - 1)] = True
        packed = zlib.compress(np.packbits(out, bitorder="little").tobytes(), 1)
        yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([packed])], names=["block", "bits"])

    slots = wanted.select("text_key", "begin").mapInArrow(run, "block long, slot long")
    table = np.zeros((1 << (SLOT_BITS - BLOCK_BITS), 1 << (BLOCK_BITS - 3)), np.uint8)
    for r in slots.groupBy("block").applyInArrow(pack, "block long, bits binary").collect():
        table[r.block] = np.frombuffer(zlib.decompress(r.bits), np.uint8)
    return table.ravel()


def runs_and_bytes(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """Of ``docs`` (text_key, text): runs (text_key, a, b) of segments that the same text has again, and segments
    (anchor, content, bytes) whose place is in ``bits``."""
    shared = docs.sparkSession.sparkContext.broadcast(zlib.compress(bits.tobytes(), 1))
    types = {"text_key": pa.int64(), "a": pa.int64(), "b": pa.int64(), "anchor": pa.int64(), "content": pa.int64(), "bytes": pa.binary()}

    def rows(n: int, **columns: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns.get(name, pa.nulls(n, t)) for name, t in types.items()], names=list(types))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(zlib.decompress(shared.value), np.uint8)
        for batch in pieces_of(batches, "text", 1 << 20):
            data, starts = flat_text(batch.column(1))
            found = Segments(data, starts)
            first, _, at = equal_in_text(found)
            if len(at):
                ends = found.begin[at] + found.size[at]
                new = (found.text[at[1:]] != found.text[at[:-1]]) | (found.begin[at[1:]] > ends[:-1])
                new = np.flatnonzero(np.concatenate(([True], new)))
                some, last = at[new], np.append(new[1:], len(at)) - 1
                start = starts[found.text[some]]
                yield rows(
                    len(some),
                    text_key=batch.column(0).take(pa.array(found.text[some])),
                    a=pa.array(found.begin[some] - start),
                    b=pa.array(ends[last] - start),
                )
            keys, begin = batch.column(0).to_numpy()[found.text[first]], found.begin[first] - starts[found.text[first]]
            hit = [(table[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 for slot in _slots(keys, begin)]
            some = first[np.flatnonzero(hit[0] & hit[1])]
            if len(some):
                ends = found.begin[some] + found.size[some]
                yield rows(
                    len(some),
                    anchor=pa.array(found.anchor[some].view(np.int64)),
                    content=pa.array(found.content[some].view(np.int64)),
                    bytes=pa.array([data[a:b].tobytes() for a, b in zip(found.begin[some], ends, strict=True)], pa.binary()),
                )

    schema = "text_key long, a long, b long, anchor long, content long, bytes binary"
    return docs.select("text_key", "text").mapInArrow(run, schema)


def repeated_windows(texts: list[bytes], places: list[int]) -> np.ndarray:
    """For segments with their anchors' places: which of the ``SPAN`` columns before the anchor begin a repeated window.

    The columns are inserted from the last to the first; ``order`` holds the segments sorted by what
    stands from the present column on, ``common`` how many symbols each shares with the one before.
    """
    n, width = len(texts), SPAN - 1 + WINDOW
    columns = np.full((width, n), MISSING, np.uint8)
    for row, (text, place) in enumerate(zip(texts, places, strict=True)):
        begin = SPAN - 1 - place
        columns[begin : begin + len(text), row] = np.frombuffer(text, np.uint8)
    order = np.arange(n)
    common = np.zeros(n, np.int32)
    found = np.zeros((n, SPAN), bool)
    for column in range(width - 1, -1, -1):
        symbols = columns[column][order]
        moved = np.argsort(symbols, kind="stable")
        ordered = symbols[moved]
        same = np.flatnonzero(ordered[1:] == ordered[:-1]) + 1
        new = np.zeros(n, np.int32)
        if len(same):
            new[same] = 1 + _range_minima(common, moved[same - 1] + 1, moved[same] + 1)
        order, common = order[moved], new
        if column < SPAN:
            long_ = common >= WINDOW
            found[order, column] = long_ | np.append(long_[1:], False)
    first = SPAN - 1 - np.asarray(places)  # windows begin between here and ``WINDOW`` before the segment's end
    last = first + np.array([len(text) for text in texts]) - WINDOW
    column = np.arange(SPAN)
    return found & (column >= first[:, None]) & (column <= last[:, None])


def _range_minima(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Minimum of ``values`` from each begin to before its end; ranges are not empty."""
    size = end - begin
    power = np.frexp(size)[1] - 1
    out = np.empty(len(begin), values.dtype)
    level = values
    for p in range(int(power.max()) + 1):
        if p:
            half = 1 << (p - 1)
            level = np.minimum(level[:-half], level[half:]) if len(level) > half else level[:0]
        at = np.flatnonzero(power == p)
        if len(at):
            out[at] = np.minimum(level[begin[at]], level[end[at] - (1 << p)])
    return out


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """First and last of each run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False]))))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist(), strict=True))


def compared(wanted: DataFrame, segments: DataFrame) -> DataFrame:
    """Repeated spans (text_key, a, b) in those of ``wanted`` (anchor, content, text_key, at, alone) that are alone.

    ``segments`` has the bytes of all of them, and may have others (anchor, content, bytes).
    """

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        """Collections of whole anchors, each with all its distinct segments."""
        rows: dict = {}
        texts: dict = {}
        last = None
        for batch in batches:
            for anchor, content, key, at, alone, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if anchor != last and len(rows) >= COLLECTION:
                    yield [(*row, texts[name]) for name, row in rows.items()]
                    rows, texts = {}, {}
                elif anchor != last and not rows:
                    texts = {}  # of anchors that nothing is wanted of
                last = anchor
                if raw is None:
                    rows[anchor, content] = (key, at, alone)
                else:
                    texts[anchor, content] = raw
        if rows:
            yield [(*row, texts[name]) for name, row in rows.items()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in collect(batches):
            flags = repeated_windows([raw for *_, raw in rows], [at & ((1 << SIZE_BITS) - 1) for _, at, *_ in rows])
            text_key, begin, end = [], [], []
            for (key, at, alone, _), own in zip(rows, flags, strict=True):
                if alone:
                    zero = (at >> (2 * SIZE_BITS + 1)) - (SPAN - 1 - (at & ((1 << SIZE_BITS) - 1)))  # where column 0 is in the text
                    for a, b in _runs(own):
                        text_key.append(key)
                        begin.append(zero + a)
                        end.append(zero + b + WINDOW)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (text_key, begin, end)], names=["text_key", "a", "b"])

    rows = wanted.select("anchor", "content", "text_key", "at", "alone")
    rows = rows.unionByName(segments.select("anchor", "content", "bytes"), allowMissingColumns=True)
    return rows.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, "text_key long, a long, b long")


def compared_by_hash(wanted: DataFrame, segments: DataFrame) -> DataFrame:
    """The same, by the hashes of all windows of the segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for anchor, content, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                begin = np.arange(len(raw) - WINDOW + 1)
                window = Rolling(np.frombuffer(raw, np.uint8)).parts(begin, begin + WINDOW).view(np.int64)
                columns = [np.full(len(begin), anchor), np.full(len(begin), content), window, begin]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["anchor", "content", "window", "a"])

    one_each = segments.select("anchor", "content", "bytes").dropDuplicates(["anchor", "content"])
    windows = one_each.mapInArrow(run, "anchor long, content long, window long, a long")
    twice = windows.groupBy("anchor", "window").agg(F.count("*").alias("times")).filter("times > 1").select("anchor", "window")
    met = windows.join(twice, ["anchor", "window"], "left_semi").join(wanted.filter("alone"), ["anchor", "content"])
    begin = begin_of(F.col("at")) + F.col("a")
    return met.select("text_key", begin.alias("a"), (begin + WINDOW).alias("b"))


def repeated_spans(docs: DataFrame, most: int = 100_000) -> DataFrame:
    """Spans (text_key, a, b; bytes, b excluded) of ``docs`` (text_key, text) whose windows occur elsewhere too."""
    met = stored(met_segments(docs))
    begin = begin_of(F.col("at"))
    whole = met.filter(~F.col("alone") & (several_of(F.col("at")) == 0))
    whole = whole.select("text_key", begin.alias("a"), (begin + size_of(F.col("at"))).alias("b"))
    wanted = met.filter("mixed and chosen").select("anchor", "content", "text_key", "at", "alone")
    found = stored(runs_and_bytes(docs, place_bits(wanted.select("text_key", begin.alias("begin")))))
    runs, segments = found.filter("bytes is null").select(whole.columns), found.filter("bytes is not null")
    hot = F.broadcast(stored(wanted.groupBy("anchor").count().filter(F.col("count") > most).select("anchor")))
    spans = whole.unionByName(runs)
    spans = spans.unionByName(compared(*(x.join(hot, "anchor", "left_anti") for x in (wanted, segments))))
    return spans.unionByName(compared_by_hash(*(x.join(hot, "anchor", "left_semi") for x in (wanted, segments))))


def with_member(texts: DataFrame, spans: DataFrame, member: bool) -> DataFrame:
    """The rows of ``texts`` whose key may be in ``spans``, or those whose key is not, by a table of bits."""
    slot = (F.xxhash64("text_key").bitwiseAND((1 << MEMBER_BITS) - 1)).alias("slot")
    bits = np.zeros(1 << MEMBER_BITS, bool)
    bits[spans.select(slot).distinct().toArrow().column(0).to_numpy()] = True
    shared = texts.sparkSession.sparkContext.broadcast(np.packbits(bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(shared.value).view(bool)
        for batch in batches:
            some = batch.filter(pa.array(bits[batch.column(0).to_numpy()] == member))
            yield some.select(["doc_id", "text_key", "text"])

    return texts.select(slot, "doc_id", "text_key", "text").mapInArrow(run, "doc_id long, text_key long, text string")


def text_key() -> Column:
    """Stands for a row's id and text; equal rows share it."""
    return F.xxhash64("doc_id", "text")


def without_repeats(docs: DataFrame, most: int = 100_000) -> DataFrame:
    """What is left of every row of ``docs`` (doc_id, text): one row out for each row in, with ``kept`` bytes.

    Each byte goes that a ``WINDOW``-byte string covers which also starts anywhere else, in the same text or
    another; all occurrences go. A null text is empty. Repeated rows are occurrences of each other.
    ``most`` bounds how many distinct segments of one anchor are compared in one collection.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("text_key", text_key())
    spans = repeated_spans(texts, most).repartition("text_key").distinct().groupBy("text_key")
    spans = stored(spans.agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("spans")))
    met, others = with_member(texts, spans, True), with_member(texts, spans, False)
    rows = met.join(spans.hint("shuffle_hash"), "text_key", "left").select("doc_id", "text", "spans")
    rows = rows.unionByName(others.select("doc_id", "text"), allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text", 4 << 20):
            n_bytes, removed, n_spans, kept, digest = [], [], [], [], []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw = text.encode()
                parts, at, gone, runs = [], 0, 0, 0
                for span in spans or ():
                    a, b = span["a"], span["b"]
                    if a > at or runs == 0:
                        runs += 1
                        parts.append(raw[at:a])
                        gone += b - a
                        at = b
                    elif b > at:
                        gone += b - at
                        at = b
                parts.append(raw[at:])
                left = b"".join(parts)
                n_bytes.append(len(raw))
                removed.append(gone)
                n_spans.append(runs)
                kept.append(left)
                digest.append(hashlib.sha256(left).hexdigest())
            columns = [pa.array(x, pa.int64()) for x in (n_bytes, removed, n_spans)]
            columns = [batch.column(0), *columns, pa.array(kept, pa.binary()), pa.array(digest, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])

    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
