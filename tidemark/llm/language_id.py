"""Language identification by cross-parsing entropy.

One suffix automaton per language is built over a bounded sample of labelled text. A text is parsed
greedily by each of them: a phrase is the longest match that starts where the last phrase ended. The
language that needs the fewest phrases, each costing log2 of its sample's length, wins. A byte that a
language's sample lacks costs the same in every language, and no less than 8 bits or any phrase.

Text is read as bytes: A-Z as a-z, everything in ASCII that is no letter as one symbol. Texts are parsed
whole, in blocks of ``BLOCK`` bytes at whose borders a phrase ends, so that many blocks advance together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import flat_text, pieces_of

BLOCK = 2_048
COST = 26  # bits of a table entry below the phrases that the step ends
UNDETERMINED = "und"
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


@dataclass(frozen=True)
class LanguageSamples:
    """Labelled text per language, in order of the language; bounded by the parameters of :func:`sample_labelled`."""

    languages: tuple[str, ...]
    texts: tuple[tuple[str, ...], ...]


def sample_labelled(labelled: DataFrame, size: int = 65_536, rows: int = 256) -> LanguageSamples:
    """Of each language about ``size`` bytes of text with letters, drawn by the hash of the rows' ids.

    ``labelled`` has doc_id, lang and text; rows that lack one of them are not drawn, nor are texts without
    a letter. Rows are taken whole, ``rows`` at most; of one that is longer than an eighth of ``size`` a
    part of that length is taken, from a place that the hash gives. A language of which nothing with a
    letter is drawn is not learned. This is the only bounded sample here: every text is judged whole.
    """
    share = max(1, size // 8)
    usable = labelled.filter("doc_id is not null and lang is not null").filter(F.col("text").rlike(r"\p{L}"))
    order = Window.partitionBy("lang").orderBy("_hash", "doc_id", "_text")
    keys = usable.select(
        "doc_id", "lang", F.xxhash64("doc_id").alias("_hash"), F.xxhash64("text").alias("_text"), F.octet_length("text").alias("_size")
    )
    drawn = keys.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= rows).collect()
    taken: dict[str, int] = {}
    places: dict[tuple, int] = {}
    for r in sorted(drawn, key=lambda r: (r.lang, r._n)):
        if taken.get(r.lang, 0) < size:
            taken[r.lang] = taken.get(r.lang, 0) + min(r._size, share)
            places[r.lang, r.doc_id, r._text] = r._n
    start = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("place")), F.greatest(F.length("text") - share + 1, F.lit(1))).cast("int")
    part = F.when(F.octet_length("text") <= share, F.col("text")).otherwise(F.col("text").substr(start + 1, F.lit(share)))
    ids = sorted({key[1] for key in places})
    texts = usable.filter(F.col("doc_id").isin(ids)).select("doc_id", "lang", F.xxhash64("text").alias("_text"), part.alias("t"))
    found: dict[str, dict[int, str]] = {}
    for r in texts.collect():
        place = places.get((r.lang, r.doc_id, r._text))
        cut = r.t.encode()[:share].decode(errors="ignore")
        if place is not None and any(c.isalpha() for c in cut):
            found.setdefault(r.lang, {})[place] = cut
    languages = tuple(sorted(found))
    return LanguageSamples(languages, tuple(tuple(found[x][n] for n in sorted(found[x])) for x in languages))


def fold(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z as a-z and other ASCII as a blank."""
    return _FOLD[data]


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


def automaton(words: list[list[int]]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of several strings; state 0 is the start, no transition leads to it."""
    step: list[dict[int, int]] = [{}]
    link, length = [-1], [0]

    def clone(p: int, c: int, q: int) -> int:
        step.append(dict(step[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        new = len(step) - 1
        link[q] = new
        while p >= 0 and step[p].get(c) == q:
            step[p][c] = new
            p = link[p]
        return new

    for word in words:
        last = 0
        for c in word:
            q = step[last].get(c)
            if q is not None:
                last = q if length[q] == length[last] + 1 else clone(last, c, q)
                continue
            step.append({})
            link.append(0)
            length.append(length[last] + 1)
            new, p = len(step) - 1, last
            while p >= 0 and c not in step[p]:
                step[p][c] = new
                p = link[p]
            if p >= 0:
                q = step[p][c]
                link[new] = q if length[q] == length[p] + 1 else clone(p, c, q)
            last = new
    return step


class Parser:
    """Counts the phrases of many texts against each language's automaton."""

    def __init__(self, samples: LanguageSamples):
        coded = [[fold(np.frombuffer(t.encode(), np.uint8)) for t in texts] for texts in samples.texts]
        seen = sorted({int(b) for texts in coded for t in texts for b in np.unique(t)})
        self.codes = np.zeros(256, np.int32)  # 0: in no sample
        for code, byte in enumerate(seen, 1):
            self.codes[byte] = code
        width = len(seen) + 1
        self.tables = [self._table(automaton([self.codes[t].tolist() for t in texts]), width) for texts in coded]
        self.costs = np.array([np.log2(2 + sum(len(t) for t in texts)) for texts in coded])
        self.lacking = np.ones((len(coded), width), bool)  # language, code
        for own, texts in zip(self.lacking, coded, strict=True):
            for t in texts:
                own[self.codes[t]] = False
        self.unseen = max(8.0, self.costs.max(initial=0.0))  # bits of a byte that a sample lacks

    @staticmethod
    def _table(step: list[dict[int, int]], width: int) -> np.ndarray:
        """Where a symbol leads, as state times ``width``; the bits from ``COST`` hold the phrases it ends."""
        if len(step) * width >= 1 << COST:
            raise ValueError("the sample of a language is too large; lower its rows or characters")
        start = np.zeros(width, np.int32)
        for c, to in step[0].items():
            start[c] = to * width
        miss = start + (1 << COST)
        miss[start == 0] = 2 << COST  # a phrase ends, and the symbol is a phrase by itself
        table = np.tile(miss, (len(step), 1))
        table[0] = np.where(start > 0, start, 1 << COST)
        for state, out in enumerate(step):
            if out:
                table[state, list(out)] = [to * width for to in out.values()]
        return table.ravel()

    def phrases(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Phrases per text (rows) and language (columns)."""
        codes = self.codes[_FOLD][data]
        sizes = np.diff(starts)
        blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(sizes)), blocks)
        index = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        begin = starts[:-1][owner] + index * BLOCK
        length = np.minimum(BLOCK, starts[1:][owner] - begin)
        order = np.argsort(-length, kind="stable")
        begin, length, owner = begin[order], length[order], owner[order]
        lanes = np.searchsorted(-length, -np.arange(1, BLOCK + 1), side="right")  # those that reach each step
        out = np.zeros((len(sizes), len(self.tables)))
        mask = (1 << COST) - 1
        for column, steps in enumerate(self.tables):
            state = np.zeros(len(begin), np.int32)
            ended = np.zeros(len(begin), np.int32)
            for t in range(int(length[0]) if len(length) else 0):
                n = lanes[t]
                found = steps[state[:n] + codes[begin[:n] + t]]
                ended[:n] += found >> COST
                state[:n] = found & mask
            out[:, column] = np.bincount(owner, ended + 1.0, len(sizes))
        return out


    def cost(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Bits per text (rows) and language (columns)."""
        codes = self.codes[_FOLD][data]
        filled = np.flatnonzero(np.diff(starts))
        lacked = np.zeros((len(starts) - 1, len(self.tables)))
        for column, own in enumerate(self.lacking):
            if len(filled):
                lacked[filled, column] = np.add.reduceat(own[codes], starts[:-1][filled], dtype=np.int64)
        return (self.phrases(data, starts) - lacked) * self.costs + lacked * self.unseen


_parsers: dict[LanguageSamples, Parser] = {}


def parser_of(samples: LanguageSamples) -> Parser:
    if samples not in _parsers:
        _parsers.clear()
        _parsers[samples] = Parser(samples)
    return _parsers[samples]


def predict(parser: Parser, languages: tuple[str, ...], texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """The language of each text, and by what share the next best language needs more."""
    data, starts = flat_text(texts)
    if not languages or not len(texts):
        return [UNDETERMINED] * len(texts), np.zeros(len(texts))
    cost = parser.cost(data, starts)
    best = cost.argmin(axis=1)
    if len(languages) == 1:
        return [languages[0]] * len(texts), np.ones(len(texts))
    two = np.partition(cost, 1, axis=1)[:, :2]
    return [languages[i] for i in best], np.clip(1 - two[:, 0] / np.maximum(two[:, 1], 1e-9), 0, 1)


def identify(docs: DataFrame, samples: LanguageSamples) -> DataFrame:
    """Language of every row of ``docs`` (doc_id, held_out, text): one row out for each row in.

    A null text and a text without a letter are ``und`` with score 0, as is everything if no language
    was learned. Of languages that cost the same the first by name wins, with score 0. Repeated rows get
    equal results; columns other than the three are not read.
    """
    languages = samples.languages
    shared = docs.sparkSession.sparkContext.broadcast(samples)
    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select("doc_id", "held_out", letter.alias("letter"), F.when(letter, F.col("text")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = parser_of(shared.value) if languages else None
        for batch in pieces_of(batches, "text", 16 << 20):
            named, score = predict(parser, languages, batch.column(3))
            letters = batch.column(2).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([x if ok else UNDETERMINED for x, ok in zip(named, letters, strict=True)], pa.string()),
                    pa.array(np.where(letters, score, 0.0), pa.float64()),
                ],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return rows.mapInArrow(run, SCHEMA)
