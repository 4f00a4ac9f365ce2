"""Token counts of a byte-level BPE tokenizer, without the ids.

Texts fall into pre-tokens that are merged each by itself. So every distinct pre-token of the corpus is
counted once, and a document's tokens are the sum over its pre-token frequencies. The frequent
pre-tokens' counts are broadcast, all others joined.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import flat_text, head_of, pieces_of, stored
from .frequencies import REST, add_rest, merged_totals, pairs_array, row_ids

# Fixed value: the pattern by which byte-level tokenizers split text.
PATTERN = r"'(?:s|t|re|ve|m|ll|d)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Splitter:
    """Pre-tokens of a text, and the number of its special tokens, for a tokenizers file of the byte-level kind."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pre = spec["pre_tokenizer"] or {}
        if pre.get("type") != "ByteLevel" or not pre.get("use_regex", True) or pre.get("add_prefix_space"):
            raise ValueError("a byte-level pre-tokenizer without a prefix blank is needed")
        added = spec["added_tokens"]
        if spec["normalizer"] or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("normalizers and added tokens that take in their surroundings are not covered")
        self.special = re.compile("|".join(re.escape(t["content"]) for t in sorted(added, key=lambda t: -len(t["content"]))))
        self.pattern = regex.compile(PATTERN)
        self.has_special = bool(added)

    def parts(self, text: str) -> tuple[list[str], int]:
        if not self.has_special or not self.special.search(text):
            return self.pattern.findall(text), 0
        parts = self.special.split(text)
        return [p for part in parts for p in self.pattern.findall(part)], len(parts) - 1


_splitters: dict[str, Splitter] = {}


def splitter_of(path: str) -> Splitter:
    if path not in _splitters:
        _splitters[path] = Splitter(path)
    return _splitters[path]


def pretoken_totals(docs: DataFrame, path: str) -> DataFrame:
    """Every distinct pre-token of ``docs`` (text) as ``token`` in UTF-8, with its number ``n``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter_of(path).parts
        texts = (b.column(0).fill_null("").to_pylist() for b in pieces_of(batches, "text", 2 << 20))
        for totals in merged_totals(texts, lambda text: split(text)[0]):
            yield pa.RecordBatch.from_arrays(
                [pa.array([t.encode() for t in totals], pa.binary()), pa.array(totals.values(), pa.int64())],
                names=["token", "n"],
            )

    return docs.select("text").mapInArrow(run, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


_tokenizers: dict = {}


def tokenizer_of(path: str):
    """The library's tokenizer, loaded once per worker and kept to one thread: Spark runs the workers side by side."""
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _tokenizers[path] = tokenizer
    return _tokenizers[path]


def with_pieces(totals: DataFrame, path: str) -> DataFrame:
    """``totals`` with the number of ``pieces`` of each pre-token, counted by the tokenizer itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_of(path)
        for batch in batches:
            texts = [t.decode() for t in batch.column(0).to_pylist()]
            found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(e) for e in found], pa.int64())],
                names=["token", "n", "pieces"],
            )

    return totals.mapInArrow(run, "token binary, n long, pieces long")


def token_counts(docs: DataFrame, path: str, limit: int = 512, most: int = 150_000) -> DataFrame:
    """Tokens of every row of ``docs`` (doc_id, text): one row out for each row in.

    ``path`` is a tokenizers file that every executor can open. A null text is empty: 0 tokens. Special
    strings inside texts count as one token each, as by the library's default. ``most`` bounds the
    pre-tokens whose counts are broadcast. Repeated rows get equal results; other columns are not read.
    """
    pieces = stored(with_pieces(pretoken_totals(docs, path), path))
    head, least = head_of(pieces, "n", most)
    known = {r.token.decode(): r.pieces for r in head.select("token", "pieces").collect()}
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, known, ids = splitter_of(path).parts, shared.value, row_ids()
        for batch in pieces_of(batches, "text", 2 << 20):
            tokens, rest = [], []
            for text in batch.column(1).fill_null("").to_pylist():
                found, total = split(text)
                unknown = []
                for token, times in Counter(found).items():
                    if (n := known.get(token)) is None:
                        unknown.append((token.encode(), times))
                    else:
                        total += n * times
                tokens.append(total)
                rest.append(unknown)
            sizes = np.diff(flat_text(batch.column(1))[1])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([next(ids) for _ in tokens], pa.int64()),
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pairs_array(rest),
                ],
                names=["row", "doc_id", "n_bytes", "head_tokens", "rest"],
            )

    schema = f"row long, doc_id long, n_bytes long, head_tokens long, {REST}"
    rows = stored(docs.select("doc_id", "text").mapInArrow(run, schema))
    tail = pieces.filter(F.col("n") < least).select("token", "pieces")
    whole = add_rest(rows, tail, {"tail_tokens": F.col("times") * F.col("pieces")})
    n_tokens = F.col("head_tokens") + F.coalesce("tail_tokens", F.lit(0))
    return whole.select("doc_id", "n_bytes", n_tokens.alias("n_tokens"), (n_tokens > limit).alias("over_limit"))
