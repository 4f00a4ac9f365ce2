"""Jaccard self-join on word n-grams by token-combination prefixes, and the components of its links.

All n-grams have one order: by how often they occur (from a table of counters that grows with the texts, up to a limit),
then by hash. Two sets of a high Jaccard share n-grams at the start of that order. So a set is indexed by the
first of its n-grams: rare ones each by itself, frequent ones by pairs within classes of n-grams. Each
class whose first pair needs two n-grams makes the prefix one n-gram longer. Sets that meet are verified.

Equal sets are one vertex. First each set is paired with one other only, the least one that it shares an index entry with,
and what links is merged; then again, with one of another component, in another order each round, as long as this links many.
After that, sets of different components that still share an entry are all paired. So a group of copies costs pairs in
proportion to its size, and no link between components is missed. Sets that share a passage meet in each of its n-grams: of
the entries that hold the same sets, one is kept.

An n-gram is rare if its counter is at most ``RARE`` above the median of all, which is what others add to it: an entry of one
n-gram holds no more sets than that. A counter is there for about each ``TEXT_BYTES`` of text, so that few n-grams are taken as
frequent, and indexed by pairs, for what they share a counter with. Beyond the limit the median grows, and so does its scatter.

Two sets that meet in entries of frequent pairs alone share no rare n-gram, as all rare ones come before: they have no more in
common than the smaller number of frequent n-grams, and meet only if that is enough.

Pairs are thinned by bits before sets are compared: each n-gram flips one bit of its set's parity bits, so
two sets differ in at least as many n-grams as in bits. No close pair is lost by that. After the first round each set carries
its bits folded to ``FOLDED`` words, so that hubs are near and the join of all sets leaves out pairs that are far apart. In
that join each set also carries the entries before the present one: a pair is not made again where it has just met.
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
from .components import components
from .decontamination import Words
from .frequencies import row_ids

SKETCH_BITS, MOST_SKETCH_BITS, BLOCK_BITS = 22, 25, 16
TEXT_BYTES = 64
MEMBER_BITS = 22
CLASS_SIZE = 8
RARE = 32
HUB_ROUNDS, MOST_HUB_ROUNDS = 2, 10
WORTH = 20  # a round is followed by one more if it found one in so many of all links
BEFORE = 8  # entries of a set that tell whether a pair has met already
PAIRED = np.uint64(1)  # the bit of an entry that tells pairs from single n-grams
MOST_PARITY_BITS = 1 << 16
FOLDED = 4  # words of 64 bits; a row of parity bits has as many or a multiple
WORDS = [f"bits{k}" for k in range(FOLDED)]

_SPACE = np.ones(256, bool)
_SPACE[[32, *range(9, 14)]] = False


def grams_of(batch: pa.RecordBatch, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of each text of the last column, and where each text's begin; shorter texts have one."""
    words = Words(*flat_text(batch.column(batch.num_columns - 1)), letters=_SPACE)
    sizes = np.diff(words.first)
    valid = np.zeros(len(words.hash), bool)
    grams = words.grams(n)
    place = np.arange(len(words.hash)) - words.first[:-1][words.text]
    valid = place + n <= sizes[words.text]
    for k in range(1, n):
        at = words.first[:-1][sizes == k]
        grams[at] = words.grams(k)[at] ^ np.uint64(k)
        valid[at] = True
    counts = np.where(sizes >= n, sizes - n + 1, np.minimum(sizes, 1))
    return grams[valid], np.concatenate(([0], np.cumsum(counts)))


def _slots(hashes: np.ndarray, bits: int) -> np.ndarray:
    return ((hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def sketch_bits(docs: DataFrame) -> int:
    """The power of two of counters for ``docs``: one for ``TEXT_BYTES`` bytes or fewer, within limits."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(max(SKETCH_BITS, (size // TEXT_BYTES).bit_length()), MOST_SKETCH_BITS)


def count_sketch(docs: DataFrame, n: int) -> np.ndarray:
    """How many n-grams fall on each counter, at most 65,535; tasks send the counters that they have used."""
    bits = sketch_bits(docs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(1 << bits, np.uint32)
        for batch in pieces_of(batches, "text", 2 << 20):
            np.add.at(totals, _slots(grams_of(batch, n)[0], bits), np.uint32(1))
        for block, part in enumerate(totals.reshape(-1, 1 << BLOCK_BITS)):
            used = np.flatnonzero(part)
            if len(used):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block]),
                        pa.array([zlib.compress(np.diff(used, prepend=0).astype(np.uint16).tobytes(), 1)]),
                        pa.array([zlib.compress(part[used].tobytes(), 1)]),
                    ],
                    names=["block", "used", "n"],
                )

    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BLOCK_BITS, np.int64)
        block = 0
        for part in parts:
            for b, used, n_ in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                block = b
                at = np.cumsum(np.frombuffer(zlib.decompress(used), np.uint16).astype(np.int64))
                total[at] += np.frombuffer(zlib.decompress(n_), np.uint32)
        yield pa.RecordBatch.from_arrays(
            [pa.array([block]), pa.array([np.minimum(total, 0xFFFF).astype(np.uint16).tobytes()])], names=["block", "n"]
        )

    sent = docs.select("text").mapInArrow(count, "block long, used binary, n binary")
    out = np.zeros((1 << (bits - BLOCK_BITS), 1 << BLOCK_BITS), np.uint16)
    for r in sent.groupBy("block").applyInArrow(add, "block long, n binary").collect():
        out[r.block] = np.frombuffer(r.n, np.uint16)
    return out.ravel()


def rare_count(sketch: np.ndarray) -> int:
    """The highest counter of a rare n-gram."""
    return RARE + int(np.median(sketch))


def class_counts(size: int, percent: int) -> list[int]:
    """Into how many classes frequent n-grams fall for a set of this size; two if a partner may be counted otherwise."""

    def one(m: int) -> int:
        return 1 << max(0, (m // CLASS_SIZE).bit_length() - 1)

    least, most = -(-percent * size // 100), 100 * size // percent
    return sorted({one(least), one(size), one(most)})


def signatures(ordered: np.ndarray, rare: np.ndarray, percent: int) -> np.ndarray:
    """Index entries of a set whose hashes come in the common order; ``rare`` tells which stand by themselves."""
    size = len(ordered)
    if 100 * size < percent * (size + 1):  # no other set can be that close
        return np.zeros(0, np.uint64)
    need = size - -(-percent * size // 100) + 1
    out = []
    for classes in class_counts(size, percent):
        kind = (ordered % np.uint64(classes)).astype(np.int64)
        frequent = np.flatnonzero(~rare)
        first = np.zeros(size, bool)
        if len(frequent):
            first[frequent[np.unique(kind[frequent], return_index=True)[1]]] = True
        covered = np.cumsum(~first)
        end = int(np.searchsorted(covered, need)) + 1
        out.append(ordered[:end][rare[:end]] & ~PAIRED)
        frequent = frequent[frequent < end]
        if len(frequent) > 1:
            order = frequent[np.argsort(kind[frequent], kind="stable")]
            bounds = np.flatnonzero(np.diff(kind[order])) + 1
            for group in np.split(order, bounds):
                if len(group) > 1:
                    a, b = np.triu_indices(len(group), 1)
                    x, y = ordered[group[a]], ordered[group[b]]
                    pair = (np.minimum(x, y) * np.uint64(0xD6E8FEB86659FD93)) ^ (np.maximum(x, y) + np.uint64(classes))
                    out.append(pair * np.uint64(0x9E3779B97F4A7C15) | PAIRED)
    return np.unique(np.concatenate(out))


def parity(own: np.ndarray) -> np.ndarray:
    """Which of about two bits per n-gram are hit an odd number of times, as 64-bit numbers.

    The slot in half as many bits is the slot without its top bit: halves of a row add up to the shorter row.
    """
    bits = min(max(256, 1 << (2 * len(own)).bit_length()), MOST_PARITY_BITS)
    mixed = (own * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(40)
    slots = (mixed & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(slots, minlength=bits) & 1).view(np.int64)


def folded(parities: list[np.ndarray]) -> np.ndarray:
    """Each row of parity bits added up to ``FOLDED`` words: the bits that a shorter row would have."""
    rows = [np.bitwise_xor.reduce(p.reshape(-1, FOLDED), axis=0) for p in parities]
    return np.array(rows, np.int64).reshape(-1, FOLDED)


def indexed(docs: DataFrame, sketch: np.ndarray, n: int, percent: int) -> DataFrame:
    """Every row of ``docs`` with its set's size, number of frequent n-grams, digest, parity bits (also folded) and index entries."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)
    bits, most = len(sketch).bit_length() - 1, rare_count(sketch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, ids = shared.value, row_ids()
        for batch in pieces_of(batches, "text", 2 << 20):
            grams, starts = grams_of(batch, n)
            sizes, often_, digests, parities, entries = [], [], [], [], []
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                own = np.unique(grams[a:b])
                often = counts[_slots(own, bits)]
                order = np.argsort(often, kind="stable")
                sizes.append(len(own))
                often_.append(int(np.count_nonzero(often > most)))
                digests.append(hashlib.md5(own.tobytes(), usedforsecurity=False).digest())
                parities.append(parity(own))
                entries.append(signatures(own[order], often[order] <= most, percent).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.fromiter(ids, np.int64, len(sizes))),
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(often_, pa.int64()),
                    pa.array(digests, pa.binary()),
                    _lists(parities),
                    _lists(entries),
                    *(pa.array(words) for words in folded(parities).T),
                ],
                names=["row", "doc_id", "n", "frequent", "digest", "parity", "entries", *WORDS],
            )

    schema = "row long, doc_id long, n long, frequent long, digest binary, parity array<bigint>, entries array<bigint>"
    schema += "".join(f", {word} long" for word in WORDS)
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0] + [len(x) for x in rows]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64)))


def sets_of(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """The sets of the vertices in ``wanted`` (vertex, digest, doc_id of one row): vertex and n-gram hashes."""
    slots = wanted.select((F.xxhash64("doc_id").bitwiseAND((1 << MEMBER_BITS) - 1)).alias("slot")).distinct().toArrow()
    member = np.zeros(1 << MEMBER_BITS, bool)
    member[slots.column(0).to_numpy()] = True
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(member))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        member = np.unpackbits(shared.value).view(bool)
        for batch in batches:
            some = batch.filter(pa.array(member[batch.column(0).to_numpy()]))
            for part in pieces_of(iter([some]), "text", 2 << 20):
                grams, starts = grams_of(part, n)
                own = [np.unique(grams[a:b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
                digests = [hashlib.md5(x.tobytes(), usedforsecurity=False).digest() for x in own]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digests, pa.binary()), _lists([x.view(np.int64) for x in own])], names=["digest", "grams"]
                )

    slot = F.xxhash64("doc_id").bitwiseAND((1 << MEMBER_BITS) - 1).alias("slot")
    found = docs.select(slot, "text").mapInArrow(run, "digest binary, grams array<bigint>")
    named = wanted.select("vertex", "digest").join(found, "digest")
    return named.groupBy("vertex").agg(F.first("grams").alias("grams"))


def bits_apart(x: str, y: str) -> Column:
    """In how many parity bits two sets differ; the longer row of bits is folded onto the shorter one."""

    def shortened(long_: Column, short: Column) -> Column:
        half = F.zip_with(
            F.slice(long_, 1, F.greatest(F.size(short), F.lit(1))),
            F.slice(long_, F.size(short) + 1, F.greatest(F.size(short), F.lit(1))),
            lambda a, b: a.bitwiseXOR(b),
        )
        return F.when(F.size(long_) > F.size(short), half).otherwise(long_)

    apart = F.zip_with(shortened(F.col(x), F.col(y)), shortened(F.col(y), F.col(x)), lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    return F.aggregate(apart, F.lit(0), lambda total, n: total + n)


def may_link(pairs: DataFrame, vertices: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (a, b) but for those that sizes or parity bits rule out."""
    a = vertices.select(F.col("vertex").alias("a"), F.col("n").alias("na"), F.col("parity").alias("pa"))
    b = vertices.select(F.col("vertex").alias("b"), F.col("n").alias("nb"), F.col("parity").alias("pb"))
    sizes = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
    bits = bits_apart("pa", "pb") * (100 + percent) <= (F.col("na") + F.col("nb")) * (100 - percent)
    return pairs.join(a, "a").join(b, "b").filter(sizes & bits).select("a", "b")


def verified(pairs: DataFrame, docs: DataFrame, vertices: DataFrame, n: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets, found again from the texts, are close enough."""
    pairs = stored(may_link(pairs, vertices, percent))
    met = pairs.select(F.col("a").alias("vertex")).union(pairs.select("b")).distinct()
    wanted = stored(vertices.select("vertex", "digest", "doc_id").join(met, "vertex", "left_semi"))
    sets = stored(sets_of(docs, wanted, n))
    a = sets.select(F.col("vertex").alias("a"), F.col("grams").alias("ga"))
    b = sets.select(F.col("vertex").alias("b"), F.col("grams").alias("gb"))
    common = F.size(F.array_intersect("ga", "gb")).cast("long")
    united = F.size("ga") + F.size("gb") - common
    return stored(pairs.join(a, "a").join(b, "b").filter(common * 100 >= united * percent).select("a", "b"))


def may_meet(a: dict[str, Column], b: dict[str, Column], percent: int) -> Column:
    """Whether sets of these sizes (n) and numbers of frequent n-grams can be close enough, having met in ``entry``."""
    sizes = F.least(a["n"], b["n"]) * 100 >= F.greatest(a["n"], b["n"]) * percent
    common = F.least(a["frequent"], b["frequent"]) * (100 + percent) >= (a["n"] + b["n"]) * percent
    return sizes & ((F.col("entry").bitwiseAND(F.lit(1)) == 0) | common)


def folded_near(percent: int) -> Column:
    """Whether the folded bits of a pair (the second set's columns end in _b) leave it open that the sets are close enough."""
    apart = sum((F.bit_count(F.col(w).bitwiseXOR(F.col(f"{w}_b"))) for w in WORDS), F.lit(0))
    return apart * (100 + percent) <= (F.col("n") + F.col("n_b")) * (100 - percent)


def without_same_members(entries: DataFrame) -> DataFrame:
    """``entries`` (entry, vertex, ...) of one entry for each set of two or more vertices: none of pairs, if there is one.

    Vertex sets are known by their size and 128 bits of hashes.
    """
    vertex = [F.xxhash64("vertex", F.lit(k)) for k in range(2)]
    members = entries.groupBy("entry").agg(F.count("*").alias("times"), *(F.bit_xor(v).alias(f"members{k}") for k, v in enumerate(vertex)))
    first = F.min(F.struct(F.col("entry").bitwiseAND(F.lit(1)).alias("paired"), "entry")).alias("first")
    kept = members.filter("times > 1").groupBy("times", "members0", "members1").agg(first).select("first.entry")
    return entries.join(kept, "entry")


def with_earlier(placed: DataFrame) -> DataFrame:
    """``placed`` with the ``BEFORE`` entries of the set that come before each one (``earlier``), pairs of n-grams last.

    Sets that share one of them meet there, or earlier still, under conditions that are the same or weaker.
    """
    order = Window.partitionBy("vertex").orderBy(F.col("entry").bitwiseAND(F.lit(1)), "entry").rowsBetween(-BEFORE, -1)
    return placed.withColumn("earlier", F.collect_list("entry").over(order))


def one_hub(placed: DataFrame, tried: DataFrame | None, percent: int, turn: int = 0) -> DataFrame:
    """A pair (a, b) for each set b that shares an entry with a set of another label: the first such hub of its entries.

    ``placed`` has entry, vertex, n, frequent and label; an entry's hub is its first vertex, by number in turn 0 and by
    a hash in each later one. If it has the folded bits too, hubs that these rule out are not taken, so that a set is
    paired with one that it may link with, whichever entries they share. Pairs in ``tried``, in either order, are not given again.
    """
    rank = F.xxhash64("vertex", F.lit(turn)) if turn else F.col("vertex")
    words = [w for w in WORDS if w in placed.columns]
    own = ["n", "frequent", *words]
    hubs = placed.groupBy("entry").agg(F.min(F.struct(rank.alias("rank"), "vertex", "label", *own)).alias("hub"))
    hubs = hubs.select("entry", "hub.rank", *[F.col(f"hub.{c}").alias(f"{c}_b") for c in ("vertex", "label", *own)])
    fit = may_meet({c: F.col(c) for c in ("n", "frequent")}, {c: F.col(f"{c}_b") for c in ("n", "frequent")}, percent)
    if words:
        fit &= folded_near(percent)
    met = placed.join(hubs, "entry").filter((F.col("label") != F.col("label_b")) & fit)
    pairs = met.select(F.col("vertex_b").alias("a"), F.col("vertex").alias("b"), "rank")
    if tried is not None:
        both = tried.unionByName(tried.select(F.col("b").alias("a"), F.col("a").alias("b")))
        pairs = pairs.distinct().join(both, ["a", "b"], "left_anti")
    return stored(pairs.groupBy("b").agg(F.min(F.struct("rank", "a")).alias("first")).select("first.a", "b"))


def near_duplicates(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """Set size and component of every row of ``docs`` (doc_id, text): one row out for each row in.

    Words lie between ASCII white space, A-Z read as a-z. Rows link if their sets of word n-grams have a
    Jaccard of at least ``percent`` hundredths; a component is named after its least doc_id. A null or
    wordless text has an empty set and links with nothing. Repeated rows link as copies do. A row with a
    null doc_id takes part, but names no component; one without a named partner has a null component.
    """
    sketch = count_sketch(docs, n)
    rows = stored(indexed(docs, sketch, n, percent))
    filled = rows.filter("n > 0")
    same = [F.first(c).alias(c) for c in ("n", "frequent", "parity", "entries", *WORDS)]
    vertices = stored(filled.groupBy("digest").agg(F.min("row").alias("vertex"), F.min("doc_id").alias("doc_id"), *same))
    entries = vertices.select(F.explode("entries").alias("entry"), "vertex", "n", "frequent").repartition("entry")
    entries = stored(without_same_members(entries))
    links = tried = None
    linked = 0
    placed = entries.withColumn("label", F.col("vertex"))
    for turn in range(MOST_HUB_ROUNDS):
        pairs = one_hub(placed, tried, percent, turn)
        tried = pairs if tried is None else tried.unionByName(pairs)
        found = verified(pairs, docs, vertices, n, percent)
        links = found if links is None else links.unionByName(found)
        labels = stored(components(links)).withColumnRenamed("node", "vertex")
        placed = placed.drop("label").join(labels, "vertex", "left").withColumn("label", F.coalesce("label", "vertex"))
        # Only entries that sets of different components share are looked at again.
        mixed = placed.groupBy("entry").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high")
        placed = placed.join(mixed.select("entry"), "entry", "left_semi")
        placed = stored(placed if turn else placed.join(vertices.select("vertex", *WORDS), "vertex"))
        now = found.count()
        linked += now
        if turn + 1 >= HUB_ROUNDS and now * WORTH <= linked:
            break
    placed = with_earlier(placed)
    right = placed.select("entry", *[F.col(c).alias(f"{c}_b") for c in ("vertex", "n", "frequent", "label", "earlier", *WORDS)])
    apart = (F.col("vertex") < F.col("vertex_b")) & (F.col("label") != F.col("label_b"))
    fit = may_meet({c: F.col(c) for c in ("n", "frequent")}, {c: F.col(f"{c}_b") for c in ("n", "frequent")}, percent)
    fit &= folded_near(percent) & ~F.arrays_overlap("earlier", "earlier_b")
    pairs = placed.join(right, "entry").filter(apart & fit).select(F.col("vertex").alias("a"), F.col("vertex_b").alias("b"))
    both = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = verified(pairs.distinct().join(both, ["a", "b"], "left_anti"), docs, vertices, n, percent)
    labels = components(links.unionByName(more)).withColumnRenamed("node", "vertex")
    named = vertices.select("digest", "vertex", "doc_id").join(labels, "vertex", "left")
    named = stored(named.select("digest", "doc_id", F.coalesce("label", "vertex").alias("label")))
    names = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    by_set = named.join(names, "label").select("digest", "component_id")
    full = filled.select("doc_id", F.col("n").alias("n_shingles"), "digest").join(by_set, "digest").drop("digest")
    empty = rows.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.unionByName(empty)
