"""Context-tree weighting over bytes, beside a smoothed unigram score.

A byte is eight binary decisions. Each decision has a tree of contexts: the 0 to ``DEPTH`` bytes before
it. Every context keeps a Krichevsky-Trofimov estimate from the training text, and the weighted mixture
over all prunings of the tree gives the probability of a decision. After training the model is fixed, so a
byte's log probability depends on its gram only: the byte and the ``DEPTH`` bytes before it. Bytes before the
start of a text count as zero.

Grams are counted over all texts, and those of equal ``TOP`` + 1 bytes before them meet in one task, with all contexts
deeper than ``TOP``. Their weighted probabilities are summed up for the contexts of ``TOP`` bytes, at most 2^16 with 255
decisions each, whose mixture the driver makes. Then every gram that occurs gets its log probability, and texts look
grams up as they do words: the frequent ones in a broadcast table, the others by a join.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import flat_text, head_of, pieces_of, row_sums, stored
from .frequencies import REST, add_rest, merged_totals, pairs_array, row_ids

DEPTH, TOP = 5, 2
HELD_GRAMS = 3 << 19  # grams of its pieces that a task holds before it passes them on
TOGETHER = 1 << 17  # grams whose contexts are weighted at a time, or one group
TEXT_BITS = 64 - 8 * (DEPTH + 1)  # what a gram leaves of a number
TEXTS = 1 << TEXT_BITS
SMOOTHING = 0.1


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z as a-z."""
    return text.encode().lower().split()


def grams_of(data: np.ndarray, starts: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """For each byte: the ``depth`` bytes before it and itself, as one number whose lowest byte it is."""
    sizes = np.diff(starts)
    grams = data.astype(np.int64)
    for back in range(1, depth + 1):
        before = np.zeros(len(data), np.int64)
        before[back:] = data[:-back] if back < len(data) else 0
        for k in range(back):
            before[starts[:-1][sizes > k] + k] = 0
        grams |= before << (8 * back)
    return grams


def triples_of(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each byte: the byte two before it, the one before it, and itself, as one number."""
    return grams_of(data, starts, TOP).astype(np.uint32)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov block probability."""
    return _lgamma(zeros + 0.5) + _lgamma(ones + 0.5) - np.log(np.pi) - _lgamma(zeros + ones + 1.0)


def _lgamma(x: np.ndarray) -> np.ndarray:
    """Log gamma of positive numbers: Stirling's series after moving up by eight."""
    shift = np.log(x)
    for k in range(1, 8):
        shift = shift + np.log(x + k)
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - shift


def decisions(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Zeros and ones at the 255 decisions, in heap order, from counts of the 256 bytes (last axis)."""
    levels = [counts]
    while levels[0].shape[-1] > 1:
        low = levels[0]
        levels.insert(0, low[..., 0::2] + low[..., 1::2])
    zeros = np.concatenate([x[..., 0::2] for x in levels[1:]], axis=-1)
    ones = np.concatenate([x[..., 1::2] for x in levels[1:]], axis=-1)
    return zeros, ones


def byte_logs(one: np.ndarray) -> np.ndarray:
    """Log10 probability of each byte from the probability of a one at each decision."""
    logs = np.zeros((*one.shape[:-1], 1))
    first = 0
    for level in range(8):
        width = 1 << level
        p = one[..., first : first + width]
        logs = np.stack([logs + np.log10(1 - p), logs + np.log10(p)], axis=-1).reshape(*one.shape[:-1], 2 * width)
        first += width
    return logs


@dataclass
class ContextTree:
    """A decision's probability of a one by the two bytes before it: ``share`` plus ``rest`` times what deeper contexts say.

    Contexts never seen share a row per last byte; deeper ones than were fitted say one half.
    """

    rows: np.ndarray  # 65536 -> row
    share: np.ndarray  # row, decision
    rest: np.ndarray

    @property
    def logs(self) -> np.ndarray:
        """Log10 probability of each byte in each row, without deeper contexts."""
        return byte_logs(self.share + self.rest * 0.5)

    def score(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Log10 probability of each text, without deeper contexts."""
        triple = triples_of(data, starts)
        return row_sums(self.logs[self.rows[triple >> 8], data], starts)


def fit_tree(triples: np.ndarray, times: np.ndarray, deeper: tuple[np.ndarray, np.ndarray] | None = None) -> ContextTree:
    """The weighted tree of triple counts; works through the contexts in blocks.

    ``deeper`` has, by context and decision (context << 8 | heap number), the log product of the weighted
    probabilities of the contexts one byte longer. Without it the contexts of two bytes are leaves.
    """
    order = np.argsort(triples)
    triples, times = triples[order].astype(np.int64), times[order].astype(np.float64)
    contexts, begin = np.unique(triples >> 8, return_index=True)
    ends = np.append(begin[1:], len(triples))
    parents = np.zeros((256, 256))
    np.add.at(parents, ((triples >> 8) & 255, triples & 255), times)
    zero1, one1 = decisions(parents)
    zero0, one0 = decisions(parents.sum(axis=0))
    below1 = np.zeros((256, 255))  # log product of the children's weighted probabilities
    share, rest = np.empty((256 + len(contexts), 255)), np.zeros((256 + len(contexts), 255))
    if deeper is not None:
        order = np.argsort(deeper[0])
        keys, logs = deeper[0][order], deeper[1][order]
    for a in range(0, len(contexts), 2_048):
        b = min(a + 2_048, len(contexts))
        counts = np.zeros((b - a, 256))
        span = slice(begin[a], ends[b - 1])
        counts[np.searchsorted(contexts, triples[span] >> 8) - a, triples[span] & 255] = times[span]
        zeros, ones = decisions(counts)
        weighted = log_kt(zeros, ones)
        share[256 + a : 256 + b] = (ones + 0.5) / (zeros + ones + 1)
        if deeper is not None:
            below = np.zeros((b - a, 255))
            span = slice(*np.searchsorted(keys, [contexts[a] << 8, (contexts[b - 1] + 1) << 8]))
            below[np.searchsorted(contexts, keys[span] >> 8) - a, (keys[span] & 255) - 1] = logs[span]
            weighted, stop = mixture(weighted, below)
            share[256 + a : 256 + b] *= stop
            rest[256 + a : 256 + b] = 1 - stop
        np.add.at(below1, contexts[a:b] & 255, weighted)
    kt1, kt0 = log_kt(zero1, one1), log_kt(zero0, one0)
    weighted1, stop1 = mixture(kt1, below1)
    _, stop0 = mixture(kt0, weighted1.sum(axis=0))
    here1, here0 = (one1 + 0.5) / (zero1 + one1 + 1), (one0 + 0.5) / (zero0 + one0 + 1)
    share[:256], rest[:256] = 0, 1
    for at, last in ((slice(0, 256), np.arange(256)), *((slice(256 + a, 256 + a + 2_048), contexts[a : a + 2_048] & 255) for a in range(0, len(contexts), 2_048))):
        share[at] = stop0 * here0 + (1 - stop0) * (stop1[last] * here1[last] + (1 - stop1[last]) * share[at])
        rest[at] *= (1 - stop0) * (1 - stop1[last])
    rows = (np.arange(65_536) & 255).astype(np.int32)
    rows[contexts] = 256 + np.arange(len(contexts))
    return ContextTree(rows, share, rest)


def mixture(kt: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log weighted probability of a context, half its own and half its children's, and the own part's share of it."""
    weighted = np.logaddexp(kt, below) - np.log(2)
    return weighted, np.exp(kt - np.log(2) - weighted)


class DeepContexts:
    """The contexts of more than ``TOP`` bytes of whole groups of grams, each with its decisions."""

    def __init__(self, grams: np.ndarray, times: np.ndarray, depth: int = DEPTH):
        byte = grams & 255
        level = np.arange(8)
        node = (1 << level) | (byte[:, None] >> (8 - level))
        self.bit = (byte[:, None] >> (7 - level)) & 1
        keys, at = np.unique(((grams >> 8 << 8)[:, None] | node).ravel(), return_inverse=True)
        self.at = at.reshape(-1, 8)  # decision of a gram -> entry of the deepest level
        n = np.repeat(times.astype(np.float64), 8)
        ones = np.bincount(self.at.ravel(), n * self.bit.ravel(), len(keys))
        zeros = np.bincount(self.at.ravel(), n, len(keys)) - ones
        self.weighted = log_kt(zeros, ones)
        here = (ones + 0.5) / (zeros + ones + 1)
        levels = []
        for d in range(depth - 1, TOP, -1):
            keys, up = np.unique(keys & ((1 << (8 * d + 8)) - 1), return_inverse=True)
            zeros, ones = np.bincount(up, zeros, len(keys)), np.bincount(up, ones, len(keys))
            self.weighted, stop = mixture(log_kt(zeros, ones), np.bincount(up, self.weighted, len(keys)))
            levels.append((up, stop * (ones + 0.5) / (zeros + ones + 1), 1 - stop))
        self.keys = keys  # of the shortest contexts here: context << 8 | decision
        self.one, path = here, np.arange(len(here))  # probability of a one at each entry of the deepest level
        share, rest = np.zeros(len(here)), np.ones(len(here))
        for up, own, pass_on in levels:
            path = up[path]
            share, rest = own[path] + pass_on[path] * share, rest * pass_on[path]
        self.one = share + rest * here
        self.top = keys[path]

    def logs(self, tree: ContextTree) -> np.ndarray:
        """Log10 probability of each gram."""
        row, node = tree.rows[(self.top >> 8) & 0xFFFF], (self.top & 255) - 1
        one = tree.share[row, node] + tree.rest[row, node] * self.one
        one = one[self.at]
        return np.log10(np.where(self.bit == 1, one, 1 - one)).sum(axis=1)


def group_of(gram: Column) -> Column:
    return F.shiftright(gram, 8).bitwiseAND((1 << (8 * TOP + 8)) - 1)


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows that come sorted by their last column, cut where it changes."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < TOGETHER:
            continue
        whole = pa.Table.from_batches(held)
        group = whole.column(whole.num_columns - 1).to_numpy()
        to = int(np.searchsorted(group, group[-1]))  # the last group may go on
        if to:
            yield whole.slice(0, to)
        held, rows = whole.slice(to).to_batches(), whole.num_rows - to
    if rows:
        yield pa.Table.from_batches(held)


def by_group(grams: DataFrame) -> DataFrame:
    """``grams`` (gram, n) with the contexts of each ``TOP`` + 1 bytes together."""
    return grams.select("gram", "n", "times", group_of(F.col("gram")).alias("group")).repartition("group").sortWithinPartitions("group")


def weighted_below(grams: DataFrame) -> DataFrame:
    """For each context of ``TOP`` bytes and decision (``key``): log product of its children's weighted probabilities."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in whole_groups(batches):
            found = DeepContexts(some.column(0).to_numpy(), some.column(1).to_numpy())
            keys, at = np.unique(found.keys & ((1 << (8 * TOP + 8)) - 1), return_inverse=True)
            logs = np.bincount(at, found.weighted, len(keys))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(logs)], names=["key", "log"])

    return by_group(grams.filter("n > 0")).mapInArrow(run, "key long, log double").groupBy("key").agg(F.sum("log").alias("log"))


def gram_logs(grams: DataFrame, tree: ContextTree) -> DataFrame:
    """``grams`` (gram, n, times) with the log10 probability of each."""
    shared = grams.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in whole_groups(batches):
            logs = DeepContexts(some.column(0).to_numpy(), some.column(1).to_numpy()).logs(shared.value)
            table = pa.table({"token": some.column(0), "times": some.column(2), "log": pa.array(logs)})
            yield from table.to_batches(max_chunksize=TOGETHER)

    return by_group(grams).mapInArrow(run, "token long, times long, log double")


def fit_grams(grams: DataFrame) -> ContextTree:
    """The mixture over the contexts of at most ``TOP`` bytes, from ``grams`` (gram, n, times)."""
    triple = F.col("gram").bitwiseAND((1 << (8 * TOP + 8)) - 1).alias("triple")
    triples = grams.filter("n > 0").groupBy(triple).agg(F.sum("n").alias("n")).toArrow()  # at most 2^24 rows
    deeper = weighted_below(grams).toArrow()  # at most 2^16 * 255 rows
    columns = [c.to_numpy() for c in (*triples.columns, *deeper.columns)]
    return fit_tree(*columns[:2], (columns[2], columns[3]))


def corpus_totals(docs: DataFrame) -> DataFrame:
    """Totals ``n`` over the texts of ``docs`` (held_out, text) to learn from, of words (``token``) and of grams (``gram``).

    Grams of all texts are there; ``times`` counts them in all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: list[pa.RecordBatch] = []
        parts: list[tuple[np.ndarray, ...]] = []

        def merge() -> None:
            if parts:
                own, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                sums = (np.bincount(at, np.concatenate([p[k] for p in parts]), len(own)).astype(np.int64) for k in (1, 2))
                ready.append(_totals(None, own, *sums))
                parts.clear()

        def texts() -> Iterator[list[str]]:
            for batch in pieces_of(batches, "text", 2 << 20):
                learned = pc.invert(batch.column(0).fill_null(True))
                data, starts = flat_text(batch.column(1))
                grams = grams_of(data, starts)
                of_learned = np.repeat(learned.to_numpy(zero_copy_only=False), np.diff(starts))
                for some, counts in ((of_learned, 1), (~of_learned, 0)):
                    own, times = np.unique(grams[some], return_counts=True)
                    parts.append((own, times * counts, times))
                if sum(len(p[0]) for p in parts) > HELD_GRAMS:
                    merge()
                yield batch.column(1).filter(learned).fill_null("").to_pylist()

        for totals in merged_totals(texts(), words_of):
            yield from ready
            ready.clear()
            n = np.fromiter(totals.values(), np.int64, len(totals))
            yield _totals(list(totals), None, n, n)
        merge()
        yield from ready

    counted = docs.select("held_out", "text").mapInArrow(run, "token binary, gram long, n long, times long")
    return counted.groupBy("token", "gram").agg(F.sum("n").alias("n"), F.sum("times").alias("times"))


def _totals(tokens: list[bytes] | None, grams: np.ndarray | None, n: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
    columns = [pa.nulls(len(n), pa.binary()) if tokens is None else pa.array(tokens, pa.binary())]
    columns += [pa.nulls(len(n), pa.int64()) if grams is None else pa.array(grams), pa.array(n), pa.array(times)]
    return pa.RecordBatch.from_arrays(columns, names=["token", "gram", "n", "times"])


def gram_sums(data: np.ndarray, starts: np.ndarray, table: np.ndarray, log_of: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Per text: the sum of its grams' logs in the table, and the grams that are not there, each with how often.

    A gram and its text's number within ``TEXTS`` are sorted as one number.
    """
    totals, tokens, times, ends = [], [], [], [np.zeros(1, np.int64)]
    for first in range(0, max(len(starts) - 1, 1), TEXTS):
        own = starts[first : first + TEXTS + 1]
        n = len(own) - 1
        grams = grams_of(data[own[0] : own[-1]], own - own[0]).astype(np.uint64)
        both = np.sort(grams << np.uint64(TEXT_BITS) | np.repeat(np.arange(n, dtype=np.uint64), np.diff(own)))
        both, often = _counted(both)
        grams, text = (both >> np.uint64(TEXT_BITS)).astype(np.int64), (both & np.uint64(TEXTS - 1)).astype(np.int64)
        place = np.searchsorted(table, grams)
        known = np.zeros(len(grams), bool)
        inside = place < len(table)
        known[inside] = table[place[inside]] == grams[inside]
        totals.append(np.bincount(text[known], log_of[place[known]] * often[known].astype(np.float64), n))
        left = np.flatnonzero(~known)
        left = left[np.argsort(text[left], kind="stable")]
        tokens.append(grams[left])
        times.append(often[left])
        ends.append(ends[-1][-1] + np.searchsorted(text[left], np.arange(1, n + 1)))
    pairs = pa.StructArray.from_arrays([pa.array(np.concatenate(tokens)), pa.array(np.concatenate(times), pa.int64())], ["token", "times"])
    return np.concatenate(totals), pa.ListArray.from_arrays(pa.array(np.concatenate(ends).astype(np.int32)), pairs)


def _counted(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of a sorted array, and how often each is there."""
    new = np.flatnonzero(np.concatenate((np.ones(min(len(ordered), 1), bool), ordered[1:] != ordered[:-1])))
    return ordered[new], np.diff(np.append(new, len(ordered)))


def score(docs: DataFrame, most: int = 150_000, most_grams: int = 2_000_000) -> DataFrame:
    """Scores of every row of ``docs`` (doc_id, held_out, text), learned from those that are not held out.

    One row out for each row in. ``held_out`` null counts as held out in training and comes back as false.
    A null text is empty: one token (the end), score 0. Without training rows N and V are 0. ``most`` bounds
    the words whose counts are broadcast, ``most_grams`` the grams; all others are joined. Repeated rows all count
    in training and get equal results; other columns are not read.
    """
    spark = docs.sparkSession
    train = docs.filter(~F.col("held_out"))
    totals = stored(corpus_totals(docs))
    words = totals.filter("token is not null").select("token", "n").filter("n > 0")
    seen = words.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    ends = train.select(F.lit(1)).count()
    train_tokens, vocabulary = (seen.n or 0) + ends, seen.v + (ends > 0)
    norm = float(np.log10(train_tokens + SMOOTHING * (vocabulary + 1)))
    end_log = float(np.log10(ends + SMOOTHING))
    grams = totals.filter("gram is not null").select("gram", "n", "times")
    logs = stored(gram_logs(grams, fit_grams(grams)))
    often, least_often = head_of(logs, "times", most_grams)
    table = often.select("token", F.col("log").cast("float")).toArrow().sort_by("token")
    head, least = head_of(words, "n", most)
    shared = spark.sparkContext.broadcast((*(c.to_numpy() for c in table.columns), {r.token: r.n for r in head.collect()}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (table, log_of, known), ids = shared.value, row_ids()
        logs = {w: float(np.log10(n + SMOOTHING)) for w, n in known.items()}
        for batch in pieces_of(batches, "text", 2 << 20):
            n_tokens, n_known, base, rest = [], [], [], []
            for text in batch.column(2).fill_null("").to_pylist():
                found = words_of(text)
                total, hits, unknown = end_log, int(ends > 0), []
                for word, times in Counter(found).items():
                    if (log := logs.get(word)) is None:
                        unknown.append((word, times))
                    else:
                        total += log * times
                        hits += times
                n_tokens.append(len(found) + 1)
                n_known.append(hits)
                base.append(total)
                rest.append(unknown)
            total, rare = gram_sums(*flat_text(batch.column(2)), table, log_of)
            columns = [
                pa.array([next(ids) for _ in base], pa.int64()),
                batch.column(0),
                batch.column(1),
                pa.array(n_tokens, pa.int64()),
                pa.array(n_known, pa.int64()),
                pa.array(base, pa.float64()),
                pa.array(total, pa.float64()),
                pairs_array(rest),
                rare,
            ]
            names = ["row", "doc_id", "held_out", "n_tokens", "head_known", "head_score", "head_grams", "rest", "rare"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = (
        "row long, doc_id long, held_out boolean, n_tokens long, head_known long, head_score double, head_grams double, "
        + REST
        + ", rare array<struct<token: bigint, times: bigint>>"
    )
    rows = stored(docs.select("doc_id", F.coalesce("held_out", F.lit(False)).alias("held_out"), "text").mapInArrow(run, schema))
    count = F.coalesce("n", F.lit(0))
    sums = {
        "tail_known": F.when(count > 0, F.col("times")).otherwise(0),
        "tail_score": F.log10(count + SMOOTHING) * F.col("times"),
    }
    whole = add_rest(rows.drop("rare"), words.filter(F.col("n") < least), sums)
    others = logs.filter(F.col("times") < least_often).select("token", "log")
    rare = add_rest(rows.select("row", F.col("rare").alias("rest")), others, {"tail_grams": F.col("log") * F.col("times")})
    whole = whole.join(rare, "row")
    n_tokens = F.col("n_tokens")
    return whole.select(
        "doc_id",
        "held_out",
        n_tokens,
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("head_score") + F.coalesce("tail_score", F.lit(0.0)) - n_tokens * norm).alias("base_score"),
        (F.col("head_grams") + F.coalesce("tail_grams", F.lit(0.0))).alias("score"),
    )
