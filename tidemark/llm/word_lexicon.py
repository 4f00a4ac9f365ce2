"""Word-level BPE with a lexicon of frequent words as a minimal acyclic transducer.

The frequent words of the corpus, encoded once, are compiled into an automaton whose states share their
suffixes. Its edges carry numbers that add up to the number of the word, and that number finds the word's ids.
The automaton is a file of flat arrays that every executor memory-maps. All distinct words of a batch walk
through it at once; a word that is not in it is merged exactly, pair by pair.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import flat_text, head_of, pieces_of, shared_folder, stored

# Fixed value: the pattern of words, applied to lower-case text.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SLICE = 8 << 20  # bytes of text whose distinct words are looked up together
HELD = 200_000  # merged words that a worker keeps
NONE = 1 << 40
FIRST_GAP = "\u0530"  # the first characters that Unicode tables of different age may disagree on


class Unsupported(ValueError):
    """The tokenizer file asks for something that this codec does not do."""


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where it is printable, else one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class WordBpe:
    """Words of a text, and the ids of a word by its exact merges, for a tokenizers file with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, added = spec["model"], spec["added_tokens"]
        steps = [s["type"] for s in (spec["normalizer"] or {}).get("normalizers", [])]
        parts = [s["type"] for s in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        if model["type"] != "BPE" or steps != ["NFC", "Replace", "Lowercase"] or parts != ["Split", "ByteLevel"]:
            raise Unsupported("a BPE over the bytes of composed, lower-case words is needed")
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if split["pattern"] != {"Regex": WORDS} or not split["invert"] or spec["decoder"] or spec["post_processor"]:
            raise Unsupported("another pattern of words, a decoder or a post-processor")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise Unsupported("added tokens that take in their surroundings")
        if any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")):
            raise Unsupported("dropout, unknown tokens, prefixes, byte fallback or whole words first")
        vocab: dict[str, int] = model["vocab"]
        end = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in added}
        self.cut = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")")
        self.surface = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for text, i in [*vocab.items(), *self.special.items()]:
            self.surface[i] = text
        chars = byte_characters()
        self.inner = [vocab[c] for c in chars]
        self.last = [vocab[c + end] for c in chars]
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[vocab[left] << 20 | vocab[right]] = rank
            self.made.append(vocab[left + right])
        self.pattern = regex.compile(WORDS)
        self.path, self.library = path, None

    def words(self, chunk: str) -> list[str]:
        """Words of a text without special tokens and blanks, which no word contains."""
        if not chunk.isascii():
            if max(chunk) >= FIRST_GAP and any(unicodedata.category(c) == "Cn" for c in chunk):
                return self._newer_words(chunk)
            if not unicodedata.is_normalized("NFC", chunk):
                chunk = unicodedata.normalize("NFC", chunk)
        # Letters are lowered one by one: the last sigma of a word is like any other.
        lower = "".join(c.lower() for c in chunk) if "Σ" in chunk else chunk.lower()
        return self.pattern.findall(lower)

    def _newer_words(self, chunk: str) -> list[str]:
        """Words of a text with characters that Python's tables lack: the library's own tables decide."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        normal = self.library.normalizer.normalize_str(chunk)
        return [normal[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def chunks(self, text: str) -> list[str]:
        """The text cut at blanks; special tokens are chunks that begin with a blank."""
        if "<" not in text or not self.cut.search(text):
            return text.split(" ")
        out: list[str] = []
        for i, part in enumerate(self.cut.split(text)):
            out += [" " + part] if i % 2 else part.split(" ")
        return out

    def merge(self, word: str) -> list[int]:
        """Ids of a word: the adjacent pair of the least rank, leftmost first, is merged until none is left."""
        raw = word.encode()
        ids = [self.inner[b] for b in raw[:-1]]
        ids.append(self.last[raw[-1]])
        if len(ids) > 64:
            return self._merge_long(ids)
        get, made = self.rank.get, self.made
        ranks = [get(a << 20 | b, NONE) for a, b in zip(ids, ids[1:])]
        while ranks:
            low = min(ranks)
            if low == NONE:
                break
            i = ranks.index(low)
            ids[i : i + 2] = (made[low],)
            del ranks[i]
            if i < len(ranks):
                ranks[i] = get(ids[i] << 20 | ids[i + 1], NONE)
            if i:
                ranks[i - 1] = get(ids[i - 1] << 20 | ids[i], NONE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same by a heap of pairs over linked symbols, for words of any length."""
        get, made, n = self.rank.get, self.made, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := get(ids[i] << 20 | ids[i + 1], NONE)) != NONE]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or get(ids[i] << 20 | ids[j], NONE) != rank:
                continue  # the pair is gone
            ids[i], ids[j] = made[rank], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := get(ids[i] << 20 | ids[k], NONE)) != NONE:
                    heapq.heappush(heap, (r, i))
            if (h := before[i]) >= 0 and (r := get(ids[h] << 20 | ids[i], NONE)) != NONE:
                heapq.heappush(heap, (r, h))
        return [i for i in ids if i >= 0]

    def decode(self, ids: Iterable[int]) -> str:
        """The surfaces of the ids joined by blanks, as this kind of file without a decoder gives them."""
        surface = self.surface
        return " ".join([surface[i] for i in ids if 0 <= i < len(surface)])


# -- the lexicon -------------------------------------------------------------


def minimal_automaton(words: list[bytes]) -> tuple[list[tuple[int, int, int]], list[bool], int]:
    """Edges (state, byte, state), final states and the start of the least automaton of sorted distinct words.

    After each word, the states below the place where the next one parts from it can no longer change;
    each is replaced by an equal state (same edges, same finality) if there is one.
    """
    known: dict[tuple, int] = {}
    edges: list[tuple[int, int, int]] = []
    final: list[bool] = []
    path: list[tuple[bool, list[tuple[int, int]]]] = [(False, [])]  # open states of the last word

    def close(state: tuple[bool, list[tuple[int, int]]]) -> int:
        key = (state[0], *state[1])
        number = known.get(key)
        if number is None:
            number = known[key] = len(final)
            final.append(state[0])
            edges.extend((number, byte, to) for byte, to in state[1])
        return number

    before = b""
    for word in [*words, b""]:
        same = 0
        while same < min(len(word), len(before)) and word[same] == before[same]:
            same += 1
        while len(path) > same + 1:
            number = close(path.pop())
            path[-1][1].append((before[len(path) - 1], number))
        path += [(False, []) for _ in word[same:]]
        if word:
            path[-1] = (True, path[-1][1])
        before = word
    return edges, final, close(path[0])


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """The transducer of ``entries`` (word -> ids) as one block of arrays."""
    words = sorted(w for w in entries if w)
    edges, final, start = minimal_automaton(words)
    # States are numbered after the states they lead to, so counts of words are complete when they are read.
    below = [int(f) for f in final]
    adds = []
    for state, _, to in edges:
        adds.append(below[state])
        below[state] += below[to]
    table = np.array([(s << 8 | b, t, n) for (s, b, t), n in zip(edges, adds, strict=True)], np.int64).reshape(-1, 3)
    table = table[np.argsort(table[:, 0])]
    ids = [entries[w] for w in words]
    offsets = np.cumsum([0] + [len(i) for i in ids])
    flat = np.array([i for one in ids for i in one], np.int32)
    parts = [table[:, 0], table[:, 1].astype(np.int32), table[:, 2].astype(np.int32)]
    parts += [np.array(final, np.uint8), offsets.astype(np.int64), flat]
    head = np.array([start, *[len(p) for p in parts]], np.int64)
    return b"".join([head.tobytes(), *[p.tobytes() + b"\0" * (-p.nbytes % 8) for p in parts]])


class Lexicon:
    """The memory-mapped transducer."""

    def __init__(self, path: str):
        block = np.memmap(path, np.uint8, "r")
        head = block[:56].view(np.int64)
        self.start, sizes, at = int(head[0]), head[1:], 56
        found = []
        for size, kind in zip(sizes, (np.int64, np.int32, np.int32, np.uint8, np.int64, np.int32), strict=True):
            length = int(size) * np.dtype(kind).itemsize
            found.append(block[at : at + length].view(kind))
            at += length + -length % 8
        self.keys, self.targets, self.adds, self.final, self.offsets, self.ids = found

    def find(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 where it is not in the lexicon. All words take one step at a time."""
        number = np.full(len(words), -1, np.int64)
        if not len(self.keys):
            return number
        sizes = np.array([len(w) for w in words], np.int64)
        flat = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        at = np.cumsum(sizes) - sizes
        alive = np.flatnonzero(sizes > 0)
        state = np.full(len(alive), self.start, np.int64)
        total = np.zeros(len(alive), np.int64)
        step = 0
        while len(alive):
            done = sizes[alive] == step
            ended = done & (self.final[state] == 1)
            number[alive[ended]] = total[ended]
            alive, state, total = alive[~done], state[~done], total[~done]
            key = state << 8 | flat[at[alive] + step]
            edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[edge] == key
            alive, edge = alive[hit], edge[hit]
            state, total = self.targets[edge].astype(np.int64), total[hit] + self.adds[edge]
            step += 1
        return number


# -- encoding ----------------------------------------------------------------


def gathered(starts: np.ndarray, sizes: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all members of the picked runs, in order, and where each pick begins (one more at the end)."""
    lengths = sizes[picks]
    ends = np.concatenate(([0], np.cumsum(lengths)))
    return np.repeat(starts[picks] - ends[:-1], lengths) + np.arange(ends[-1]), ends


class Encoder:
    """Ids of many texts at a time. Merged words are kept, up to ``HELD`` of them."""

    def __init__(self, bpe: WordBpe, lexicon: Lexicon):
        self.bpe, self.lexicon = bpe, lexicon
        self.merged: dict[str, list[int]] = {}

    def _of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, one after the other, and where each begins."""
        lexicon, merged = self.lexicon, self.merged
        number = lexicon.find([w.encode() for w in words])
        seen = number >= 0
        starts = np.where(seen, lexicon.offsets[np.maximum(number, 0)], 0)
        sizes = np.where(seen, lexicon.offsets[np.maximum(number, -1) + 1] - starts, 0)
        unseen: list[int] = []
        base = len(lexicon.ids)
        for k in np.flatnonzero(~seen).tolist():
            word = words[k]
            ids = merged.get(word)
            if ids is None:
                if len(merged) >= HELD:
                    merged.clear()
                ids = merged[word] = self.bpe.merge(word)
            starts[k], sizes[k] = base + len(unseen), len(ids)
            unseen += ids
        flat = np.concatenate((lexicon.ids, np.array(unseen, np.int32)))
        places, ends = gathered(starts, sizes, np.arange(len(words)))
        return flat[places], ends

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text. Chunks between blanks, then their words, are each looked at once."""
        bpe = self.bpe
        index: dict[str, int] = {}
        picks = []
        for text in texts:
            picks.append(np.array([index.setdefault(c, len(index)) for c in bpe.chunks(text)], np.int64))
        names: dict[str, int] = {}
        members: list[int] = []
        sizes = []
        for chunk in index:
            found = [chunk] if chunk[:1] == " " else bpe.words(chunk)
            members += [names.setdefault(w, len(names)) for w in found]
            sizes.append(len(found))
        words = list(names)
        special = [(k, bpe.special[w[1:]]) for k, w in enumerate(words) if w[0] == " "]
        for k, _ in special:
            words[k] = "!"  # any word of one id, whose id is put right below
        ids, starts = self._of_words(words)
        for k, i in special:
            ids[starts[k]] = i
        lengths = np.diff(starts)
        # ids of each chunk, then of each text
        each = np.array(sizes, np.int64)
        places, word_ends = gathered(starts[:-1], lengths, np.array(members, np.int64))
        chunk_ends = word_ends[np.concatenate(([0], np.cumsum(each)))]
        chunk_ids = ids[places]
        out = []
        for pick in picks:
            places, _ = gathered(chunk_ends[:-1], np.diff(chunk_ends), pick)
            out.append(chunk_ids[places])
        return out


_bpes: dict[str, WordBpe] = {}
_encoders: dict[tuple[str, str], Encoder] = {}


def bpe_of(path: str) -> WordBpe:
    if path not in _bpes:
        _bpes[path] = WordBpe(path)
    return _bpes[path]


def encoder_of(path: str, lexicon: str) -> Encoder:
    """The encoder of a worker; the lexicon is the executor's own copy of the file, mapped once."""
    if (path, lexicon) not in _encoders:
        _encoders[path, lexicon] = Encoder(bpe_of(path), Lexicon(SparkFiles.get(lexicon)))
    return _encoders[path, lexicon]


def word_totals(docs: DataFrame, path: str) -> DataFrame:
    """Every distinct word of ``docs`` (text) with its number ``n``; special tokens are no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = bpe_of(path)

        def words_of(chunks: Counter) -> pa.RecordBatch:
            totals: Counter = Counter()
            for chunk, n in chunks.items():
                if chunk[:1] != " ":
                    for word in bpe.words(chunk):
                        totals[word] += n
            return pa.RecordBatch.from_arrays(
                [pa.array(totals, pa.string()), pa.array(totals.values(), pa.int64())], names=["word", "n"]
            )

        held: Counter = Counter()
        for batch in pieces_of(batches, "text", SLICE):
            for text in batch.column(0).fill_null("").to_pylist():
                held.update(bpe.chunks(text))
                if len(held) > HELD:
                    yield words_of(held)
                    held = Counter()
        yield words_of(held)

    return docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _shared_file(spark: SparkSession, block: bytes) -> str:
    """Write a block to the shared folder and have Spark hand it to every executor, late ones too; its name there."""
    name = f"lexicon-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/tidemark-llm/{name}")
    where = where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where)
    stream = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, False)
    try:
        stream.write(bytearray(block))
    finally:
        stream.close()
    spark.sparkContext.addFile(where.toString())
    return name


def build_lexicon(docs: DataFrame, path: str, most: int = 100_000) -> str:
    """Compile the ``most`` most frequent words of ``docs`` (text); the name of the file that executors map.

    Counts cover all texts. ``most`` bounds what the driver merges and the file holds; which words are in it
    decides speed alone, as all others are merged where they occur.
    """
    head, _ = head_of(stored(word_totals(docs, path)), "n", most)
    bpe = WordBpe(path)
    entries = {r.word.encode(): bpe.merge(r.word) for r in head.select("word").collect()}
    return _shared_file(docs.sparkSession, compile_lexicon(entries))


def token_digests(docs: DataFrame, path: str, lexicon: str | None = None) -> DataFrame:
    """Token count, and hashes of ids and of the decoded text, of every row of ``docs`` (doc_id, text).

    One row out for each row in; repeated rows get equal results, other columns are not read. A null text is
    read as empty: no tokens, and the hashes of nothing. Special strings inside texts are one token each, as by
    the library's default. Words may be of any length. ``path`` is a file that every executor can open.
    """
    lexicon = lexicon or build_lexicon(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path, lexicon)
        for batch in pieces_of(batches, "text", SLICE):
            found = encoder.encode(batch.column(1).fill_null("").to_pylist())
            digests = [hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest() for ids in found]
            decoded = [hashlib.sha256(encoder.bpe.decode(ids.tolist()).encode()).hexdigest() for ids in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(ids) for ids in found], pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(decoded, pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", lexicon: str | None = None) -> DataFrame:
    """``docs`` with the ids of ``text`` as a new array column ``ids``, which must not exist yet. Null reads as empty."""
    if ids in docs.columns:
        raise ValueError(f"there is a column {ids} already")
    lexicon = lexicon or build_lexicon(docs.select(F.col(text).alias("text")), path)

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = encoder_of(path, lexicon)
        for column in columns:
            batch = pa.RecordBatch.from_arrays([column], names=["text"])
            found = [x for part in pieces_of(iter([batch]), "text", SLICE) for x in encoder.encode(part.column(0).fill_null("").to_pylist())]
            ends = np.cumsum([0] + [len(x) for x in found]).astype(np.int32)
            flat = np.concatenate(found) if found else np.zeros(0, np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32)))

    return docs.withColumn(ids, F.arrow_udf(run, "array<int>")(F.col(text)))


def decode(docs: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the text of the id arrays in ``ids`` as a new column.

    Ids that the vocabulary lacks are left out, as by the library; a null array gives null.
    """
    if text in docs.columns:
        raise ValueError(f"there is a column {text} already")

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = bpe_of(path)
        for column in columns:
            yield pa.array([None if x is None else bpe.decode([i for i in x if i is not None]) for x in column.to_pylist()], pa.string())

    return docs.withColumn(text, F.arrow_udf(run, "string")(F.col(ids)))
