"""Product codes of vectors, with the candidates of a coarse grid cell memoised.

Vectors are cut into equal parts, and each part is coded by the nearest entry of its codebook. A part's point
falls into a cell of a coarse grid. The distances from an entry to the nearest and the farthest point of the
cell bound its distance to all points there, so an entry whose least distance exceeds another one's greatest
is dominated over the whole cell. What is left is kept per cell in a table of the worker, and only those
entries are evaluated exactly. All numbers are integers: a vector's code does not depend on how rows are dealt.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import head_of, stored

SCALE = 256
LIMIT = 1 << 24  # scaled components are smaller than this in amount
HELD = 1 << 18  # cells that a worker keeps, over all parts
ROWS = 4_096  # vectors worked on at a time
LABELS = 100_000  # labels whose totals are broadcast


def scaled(vector: Column) -> Column:
    """Components as integers: floor(256 * x)."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))


def sound(vector: Column) -> Column:
    """Whether all components are there, finite and within the range of the integer grid."""
    inside = lambda x: F.coalesce(F.abs(x.cast("double")) < LIMIT // SCALE, F.lit(False)) & ~F.isnan(x.cast("double"))
    return vector.isNotNull() & F.coalesce(F.forall(vector, inside), F.lit(False))


def kept_vectors(rows: DataFrame, parts: int) -> tuple[DataFrame, np.ndarray | None]:
    """Rows that can be coded (vec_id, label, v), and the first codebook entries as (entry, component).

    The first vectors in the order of vec_id (nulls last; equal ids in the order of their components) give the
    entries and the length that all vectors have; rows of another length are left out. No entries: None.
    """
    wide = rows.select("vec_id", "label", F.when(sound(F.col("embedding")), scaled(F.col("embedding"))).alias("v"))
    wide = wide.where(F.col("v").isNotNull())
    order = [F.col("vec_id").asc_nulls_last(), F.col("v")]
    first = wide.select("vec_id", "v").orderBy(*order).limit(1).collect()
    if not first:
        return wide, None
    size = len(first[0].v)
    if size % parts:
        raise ValueError(f"vectors of {size} components do not fall into {parts} equal parts")
    wide = wide.where(F.size("v") == size)
    return wide, np.array(first[0].v, np.int64)


def first_entries(wide: DataFrame, entries: int) -> np.ndarray:
    """The vectors of the least vec_ids, at most ``entries`` of them."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("v")]
    top = wide.select("vec_id", "v").orderBy(*order).limit(entries).collect()
    return np.array([r.v for r in top], np.int64)


class Grid:
    """The entries to evaluate, per part and cell of its grid, for one state of the codebooks (part, entry, component)."""

    def __init__(self, books: np.ndarray):
        self.books = books
        parts, entries, width = books.shape
        # A cell is about half as wide as entries lie apart: the side of a box that holds 1 entry of a spread's worth.
        spread = books.max(axis=(1, 2)) - books.min(axis=(1, 2)) + 1
        apart = spread / max(entries, 1) ** (1.0 / max(width, 1))
        self.shift = np.maximum(np.floor(np.log2(np.maximum(apart / 2, 1))).astype(np.int64), 0)
        self.memo: list[dict[bytes, np.ndarray]] = [{} for _ in range(parts)]
        self.held = 0

    def _candidates(self, part: int, cells: np.ndarray) -> list[np.ndarray]:
        """Entries not dominated over the box of each cell."""
        book, side = self.books[part], np.int64(1) << self.shift[part]
        out = []
        for some in np.array_split(cells, max(1, len(cells) * book.size // (1 << 21))):
            low = (some * side)[:, None, :]
            high = low + (side - 1)
            under, over = low - book[None], book[None] - high
            near = np.maximum(np.maximum(under, over), 0)
            far = np.maximum(np.abs(under), np.abs(over))
            least, most = (near * near).sum(axis=2), (far * far).sum(axis=2)
            stay = least <= most.min(axis=1)[:, None]
            out += np.split(np.nonzero(stay)[1], np.cumsum(stay.sum(axis=1))[:-1])
        return out

    def nearest(self, part: int, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each point's nearest entry, the lower one of a tie, and the squared distance."""
        if not points.shape[1]:
            return np.zeros(len(points), np.int64), np.zeros(len(points), np.int64)
        cells, cell_of = np.unique(points >> self.shift[part], axis=0, return_inverse=True)
        cell_of = cell_of.reshape(-1)
        memo, keys = self.memo[part], [c.tobytes() for c in cells]
        unknown = [k for k, key in enumerate(keys) if key not in memo]
        if unknown:
            if self.held + len(unknown) > HELD:
                for m in self.memo:
                    m.clear()
                self.held = 0
                unknown = list(range(len(keys)))
            self.held += len(unknown)
            for k, found in zip(unknown, self._candidates(part, cells[unknown]), strict=True):
                memo[keys[k]] = found
        listed = [memo[key] for key in keys]
        sizes = np.array([len(x) for x in listed], np.int64)
        starts = np.cumsum(sizes) - sizes
        # every point with every candidate of its cell, in the order of entries
        counts = sizes[cell_of]
        ends = np.cumsum(counts)
        begins = ends - counts
        row = np.repeat(np.arange(len(points)), counts)
        entry = np.concatenate(listed)[np.arange(ends[-1]) - np.repeat(begins - starts[cell_of], counts)]
        gap = points[row] - self.books[part][entry]
        distance = (gap * gap).sum(axis=1)
        least = np.minimum.reduceat(distance, begins)
        at = np.where(distance == least[row], entry, len(self.books[part]))
        return np.minimum.reduceat(at, begins), least

    def codes(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (row, part) and the squared distance of each row."""
        parts, _, width = self.books.shape
        codes = np.zeros((len(vectors), parts), np.int64)
        error = np.zeros(len(vectors), np.int64)
        for p in range(parts):
            codes[:, p], distance = self.nearest(p, np.ascontiguousarray(vectors[:, p * width : (p + 1) * width]))
            error += distance
        return codes, error


_grids: dict[str, Grid] = {}


def grid_of(books: np.ndarray) -> Grid:
    """The worker's grid for these codebooks; those of earlier rounds go."""
    key = hashlib.sha256(books.tobytes()).hexdigest()
    if key not in _grids:
        _grids.clear()
        _grids[key] = Grid(books)
    return _grids[key]


def _matrices(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            flat = part.column(part.schema.get_field_index("v")).flatten()
            yield part, flat.to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(part.num_rows, size)


def next_books(wide: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks after a round: each entry becomes the floor of the mean of its points; unused ones stay.

    Every task sums its own rows, so that a row per task, part and entry is exchanged; what comes to the driver
    is one row per part and entry.
    """
    parts, entries, width = books.shape
    shared = wide.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid = grid_of(shared.value)
        sums, counts = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
        for _, vectors in _matrices(batches, parts * width):
            codes, _ = grid.codes(vectors)
            slot = (codes + np.arange(parts) * entries).reshape(-1)
            np.add.at(sums, slot, vectors.reshape(-1, width))
            counts += np.bincount(slot, minlength=len(counts))
        used = np.flatnonzero(counts)
        values = pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1) * width, pa.int32()), pa.array(sums[used].reshape(-1)))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used]), values], names=["slot", "n", "sums"])

    partial = wide.select("v").mapInArrow(run, "slot long, n long, sums array<long>")
    totals = partial.groupBy("slot").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)])
    after = books.reshape(parts * entries, width).copy()
    for row in totals.collect():  # at most parts * entries
        after[row.slot] = [row[f"s{i}"] // row.n for i in range(width)]
    return after.reshape(books.shape)


def coded(wide: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code and error of every row."""
    parts, _, width = books.shape
    shared = wide.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid = grid_of(shared.value)
        for batch, vectors in _matrices(batches, parts * width):
            codes, error = grid.codes(vectors)
            code = pa.array([bytes(c).hex() for c in codes.astype(np.uint8)], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), code, pa.array(error)], names=["vec_id", "label", "code", "error"]
            )

    kinds = {f.name: f.dataType.simpleString() for f in wide.schema.fields}
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
    return wide.select("vec_id", "label", "v").mapInArrow(run, schema)


def books_text(books: np.ndarray) -> str:
    return ",".join(map(str, books.reshape(-1).tolist()))


def learn(wide: DataFrame, parts: int, entries: int, rounds: int) -> np.ndarray:
    """Codebooks (part, entry, component) after ``rounds`` rounds over all rows."""
    first = first_entries(wide, entries)
    books = first.reshape(len(first), parts, -1).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        books = next_books(wide, books)
    return books


def with_label_error(rows: DataFrame) -> DataFrame:
    """``rows`` (stored; label, error) with the error summed over equal labels, nulls together; null beyond a long.

    Totals of the labels with the most rows are broadcast, at most ``LABELS`` of them, so that a label with a third of all rows
    stays where its rows are; rows of rarer labels meet their totals by an exchange.
    """
    totals = stored(rows.groupBy("label").agg(F.count("*").alias("n"), F.try_sum("error").alias("label_error")))
    head, least = head_of(totals, "n", LABELS)
    near = head.select(F.col("label").alias("_label"), F.struct("label_error").alias("_found"))
    met = rows.join(F.broadcast(near), F.col("label").eqNullSafe(F.col("_label")), "left")
    common = met.where(F.col("_found").isNotNull()).select(*rows.columns, F.col("_found.label_error").alias("label_error"))
    rare = totals.where(F.col("n") < least).select(F.col("label").alias("_label"), "label_error")
    rest = met.where(F.col("_found").isNull()).select(*rows.columns)
    rest = rest.join(rare.hint("shuffle_hash"), F.col("label").eqNullSafe(F.col("_label")), "inner").drop("_label")
    return common.unionByName(rest.select(*rows.columns, "label_error"))


def product_codes(rows: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every row of ``rows`` (vec_id, embedding, label) that can be coded.

    Rows whose vector is null, or holds a null, a NaN, an infinity or a component of 65,536 or more in amount, are
    dropped, and so are those of another length than the vector of the least vec_id; that length must fall into
    ``parts`` equal parts (else ValueError). Empty vectors have error 0. Repeated rows and ids count each by
    itself; null ids sort last; ties go to the lower entry. An empty table, or one without a sound row, gives no rows.
    With fewer than ``entries`` rows the codebooks are as short. Other columns are not read.
    """
    if not 0 < entries <= 256:
        raise ValueError("an entry's index must fit into two hex digits")
    wide, first = kept_vectors(rows, parts)
    kind = rows.schema["vec_id"].dataType.simpleString()
    if first is None:
        empty = f"vec_id {kind}, code string, error long, label_error long, codebooks_sha256 string"
        return rows.sparkSession.createDataFrame([], empty)
    books = learn(wide, parts, entries, rounds)
    found = with_label_error(stored(coded(wide, books)))
    digest = hashlib.sha256(books_text(books).encode()).hexdigest()
    return found.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
