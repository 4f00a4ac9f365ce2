"""Benchmark decontamination by winnowing.

Every text becomes a row of words; each k words give a hash, and of every ``WINDOW - K + 1`` hashes in a
row the least is kept as a fingerprint. Two texts that share ``WINDOW`` words share the fingerprint of
that span, so fingerprints of documents and benchmark items are joined and each hit is extended to both
sides, word by word. A shared run of ``WINDOW`` words or more is an occurrence. Items shorter than a
window are one window each: for every such length, all spans of a document of that length are hashed.

A fingerprint travels with the words around it, as many as a window can reach, so no text is read twice.
Fingerprints that no item has are dropped early by a bitmap of fixed size; what passes wrongly finds no
partner in the join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import flat_text, pieces_of, stored
from .frequencies import row_ids

WINDOW, K = 13, 5
BITMAP_BITS = 22

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _powers(base: np.uint64, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    if count:
        out[0] = 1
    return np.multiply.accumulate(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _STEP
    x = (x ^ (x >> np.uint64(29))) * _BASE
    return x ^ (x >> np.uint64(32))


class Words:
    """Lower-cased words of many texts: where each begins and ends, whose it is, and its hash."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, letters: np.ndarray | None = None):
        """``letters``: for each byte, whether it belongs to a word; digits, letters and all above ASCII by default."""
        self.data = _LOWER[data]
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = (_WORD if letters is None else letters)[self.data]
        border = np.zeros(len(data) + 1, bool)  # a text begins here
        border[starts] = True
        self.begin = np.flatnonzero(inside[1:] & (~inside[:-1] | border))
        self.end = np.flatnonzero(inside[:-1] & (~inside[1:] | border))
        self.first = np.searchsorted(self.begin, starts)  # of each text, the first word
        self.text = np.repeat(np.arange(len(starts) - 1), np.diff(self.first))
        weights = _powers(_BASE, int((self.end - self.begin).max()) if len(self.begin) else 0)
        spans = self.end - self.begin
        place = np.arange(int(spans.sum())) - np.repeat(np.cumsum(spans) - spans, spans)
        letters = self.data[inside[1:-1]].astype(np.uint64) + np.uint64(1)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(letters * weights[place])))
        at = np.cumsum(spans)
        self.hash = _mixed(total[at] - total[at - spans])

    def grams(self, k: int) -> np.ndarray:
        """Hash of the k words from each word on; those that leave their text hold the largest number."""
        n = len(self.hash)
        out = np.full(n, np.iinfo(np.uint64).max, np.uint64)
        if n >= k:
            sums = np.full(n - k + 1, k, np.uint64)
            for j in range(k):
                sums = sums * _STEP + self.hash[j : n - k + 1 + j]
            sums = _mixed(sums) >> np.uint64(1)
            same = self.text[k - 1 :] == self.text[: n - k + 1]
            out[: n - k + 1][same] = sums[same]
        return out

    def fingerprints(self) -> tuple[np.ndarray, np.ndarray]:
        """Words at which a kept k-gram begins, and the hashes: the least of every ``WINDOW - K + 1`` in a row."""
        grams = self.grams(K)
        width = WINDOW - K + 1
        if len(grams) < width:
            kept = grams < np.iinfo(np.uint64).max
        else:
            least = np.lib.stride_tricks.sliding_window_view(grams, width).min(axis=1)
            padded = np.concatenate((np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)))
            most = np.lib.stride_tricks.sliding_window_view(padded, width).max(axis=1)
            kept = (grams == most) & (grams < np.iinfo(np.uint64).max)
        at = np.flatnonzero(kept)
        return at, grams[at]

    def joined(self, a: int, b: int) -> str:
        """The words from a to before b, with blanks between."""
        return b" ".join([self.data[i:j].tobytes() for i, j in zip(self.begin[a:b], self.end[a:b], strict=True)]).decode()


def _slot(hashes: np.ndarray, length: int) -> np.ndarray:
    """Place in the bitmap of hashes of grams of a length."""
    return (_mixed(hashes + np.uint64(length)) >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)


GRAMS = "length int, gram long, before string, span string, after string, at int"


def _gram_columns(words: Words, at: np.ndarray, grams: np.ndarray, length: int, reach: int) -> list[pa.Array]:
    """Grams with the words around them, nearest first before and after."""
    before, span, after, place = [], [], [], []
    for i in at.tolist():
        first, last = words.first[words.text[i]], words.first[words.text[i] + 1]
        before.append(words.joined(max(first, i - reach), i))
        span.append(words.joined(i, i + length))
        after.append(words.joined(i + length, min(last, i + length + reach)))
        place.append(i - first)
    return [
        pa.array(np.full(len(at), length, np.int32)),
        pa.array(grams.view(np.int64)),
        pa.array(before, pa.string()),
        pa.array(span, pa.string()),
        pa.array(after, pa.string()),
        pa.array(place, pa.int32()),
    ]


_NAMES = ["length", "gram", "before", "span", "after", "at"]


def item_grams(items: DataFrame) -> DataFrame:
    """Fingerprints of every item (item, text): of shorter ones the whole as one gram, ``length`` words long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text", 4 << 20):
            words = Words(*flat_text(batch.column(1)))
            sizes = np.diff(words.first)
            names = batch.column(0)
            at, grams = words.fingerprints()
            long_ones = sizes[words.text[at]] >= WINDOW
            groups = [(at[long_ones], grams[long_ones], K, WINDOW - K)]
            for length in np.unique(sizes[(sizes > 0) & (sizes < WINDOW)]).tolist():
                at = words.first[:-1][sizes == length]
                groups.append((at, words.grams(length)[at], length, 0))
            for at, grams, length, reach in groups:
                owner = pa.array(words.text[at])
                columns = [names.take(owner), *_gram_columns(words, at, grams, length, reach)]
                kind = pa.array(np.full(len(at), WINDOW if reach else length, np.int32))
                yield pa.RecordBatch.from_arrays([kind, *columns], names=["kind", "item", *_NAMES])

    return items.select("item", "text").mapInArrow(run, f"kind int, item string, {GRAMS}")


def document_grams(docs: DataFrame, bitmap: np.ndarray, kinds: list[int]) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its number of words, and its grams that an item may have."""
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(bitmap))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, ids = np.unpackbits(shared.value).view(bool), row_ids()
        for batch in pieces_of(batches, "text", 4 << 20):
            words = Words(*flat_text(batch.column(1)))
            rows = np.fromiter(ids, np.int64, batch.num_rows)
            empty = [pa.nulls(batch.num_rows, t) for t in _TYPES]
            counts = pa.array(np.diff(words.first))
            names = ["row", "doc_id", "n_words", "kind", *_NAMES]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows), batch.column(0), counts, pa.nulls(batch.num_rows, pa.int32()), *empty], names=names
            )
            for kind in kinds:
                length, reach = (K, WINDOW - K) if kind == WINDOW else (kind, 0)
                if kind == WINDOW:
                    at, grams = words.fingerprints()
                else:
                    grams = words.grams(kind)
                    at = np.flatnonzero(grams < np.iinfo(np.uint64).max)
                    grams = grams[at]
                passed = bits[_slot(grams, kind)]
                at, grams = at[passed], grams[passed]
                if len(at):
                    columns = _gram_columns(words, at, grams, length, reach)
                    none = pa.nulls(len(at), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rows[words.text[at]]), none, none, pa.array(np.full(len(at), kind, np.int32)), *columns],
                        names=names,
                    )

    schema = f"row long, doc_id long, n_words long, kind int, {GRAMS}"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


_TYPES = [pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32()]


def _words(column: str) -> Column:
    return F.when(F.col(column) == "", F.array().cast("array<string>")).otherwise(F.split(column, " "))


def _common(a: Column, b: Column) -> Column:
    """How many elements two arrays have in common from the start on."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    return F.when(F.forall(same, lambda x: x), F.least(F.size(a), F.size(b))).otherwise(F.array_position(same, False) - 1)


def occurrences(grams: DataFrame, items: DataFrame) -> DataFrame:
    """Where an item's words occur: row, item, and the first and last word of each shared run that has a window."""
    reach = WINDOW - K
    columns = ["kind", "gram", "before", "span", "after"]
    # Items with the same words around a gram are compared once.
    contexts = items.groupBy(*columns).agg(F.collect_set("item").alias("items"))
    contexts = contexts.select("kind", "gram", "span", F.col("before").alias("b"), F.col("after").alias("a"), "items")
    met = grams.filter("kind is not null").join(contexts, ["kind", "gram", "span"])
    left = _common(F.reverse(_words("before")), F.reverse(_words("b")))
    right = _common(_words("after"), _words("a"))
    run = met.select("row", "kind", "at", "length", "items", left.alias("left"), right.alias("right"))
    run = run.filter((F.col("kind") < WINDOW) | (F.col("left") + F.col("right") >= reach))
    return run.select(
        "row",
        F.explode("items").alias("item"),
        (F.col("at") - F.col("left")).alias("first"),
        (F.col("at") + F.col("length") + F.col("right") - 1).alias("last"),
    )


def item_bitmap(items: DataFrame) -> tuple[np.ndarray, list[int]]:
    """The bitmap of all items' grams, and the lengths of windows that there are. At most 2^``BITMAP_BITS`` numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, grams = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            for kind in np.unique(kinds).tolist():
                slots = np.unique(_slot(grams[kinds == kind], kind))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(slots), kind, np.int32)), pa.array(slots)], names=["kind", "slot"]
                )

    found = items.select("kind", "gram").mapInArrow(run, "kind int, slot long").distinct().toArrow()
    bitmap = np.zeros(1 << BITMAP_BITS, bool)
    bitmap[found.column(1).to_numpy()] = True
    return bitmap, sorted(set(found.column(0).to_pylist()))


def contamination(docs: DataFrame, benchmark: DataFrame, share: int = 20) -> DataFrame:
    """Words of every row of ``docs`` (doc_id, text) that lie in a window of a ``benchmark`` item (item_id, text).

    One row out for each row in, null text read as no words. Items without words or with a null text never
    occur; an item with a null id is not listed, though its words are hit. Items that share an id are one.
    A document is contaminated if at least one in ``share`` words is hit. Other columns are not read.
    """
    named = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").filter("text is not null")
    items = stored(item_grams(named.withColumn("item", F.coalesce("item", F.lit("")))))
    bitmap, kinds = item_bitmap(items)
    grams = stored(document_grams(docs, bitmap, kinds))
    runs = stored(occurrences(grams, items))
    listed = runs.filter("item <> ''").groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items"))
    # Hit words: each run adds what lies behind the furthest end so far. Runs are as many as a text's words at most.
    spans = runs.groupBy("row", "first").agg(F.max("last").alias("last"))
    spans = spans.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("spans"))
    start = F.struct(F.lit(-1).cast("long").alias("to"), F.lit(0).cast("long").alias("n"))

    def add(state, span):
        new = F.greatest(F.lit(0).cast("long"), span["last"] - F.greatest(state["to"], span["first"] - 1))
        return F.struct(F.greatest(state["to"], span["last"]).alias("to"), (state["n"] + new).alias("n"))

    hits = spans.select("row", F.aggregate("spans", start, add, lambda s: s["n"]).alias("n_hit"))
    rows = grams.filter("kind is null").select("row", "doc_id", "n_words")
    whole = rows.join(hits, "row", "left").join(listed, "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    items_ = F.coalesce("items", F.array().cast("array<string>"))
    return whole.select(
        "row",
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        items_.alias("items"),
        ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"),
    )
