"""SentencePiece encoding and decoding for merge-type (BPE) models with byte fallback.

A unit of text is covered from the left with the longest pieces that an Aho-Corasick automaton finds.
A piece may follow another only if merging the two texts anew gives just these two; where none fits, the
last piece is taken back, and a bitfield keeps positions from which no cover exists. The result is what
the merges give, without queueing them.

No piece has a blank after another character, and characters outside all pieces become bytes; so
texts are cut at both, and each distinct unit is encoded once per worker.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces_of

BLANK = "▁"
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


UNKNOWN = " \u2047 "  # fixed value: how the unknown id is shown


class Unsupported(ValueError):
    """The model is not of the kind that this module covers."""


class Edges(NamedTuple):
    """The parts at the two ends of a token, from the whole token down to a character, each with its rank."""

    left: list[tuple[str, tuple[float, int]]]
    right: list[tuple[str, tuple[float, int]]]
    in_order: bool  # its merges come in order of rank


_NEVER = (float("inf"), 0)


class Pieces:
    """The vocabulary of a model file and what the encoder derives from it."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = model.get_piece_size()
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(count)]
        self.end = model.eos_id()
        self.bytes_ = {int(model.id_to_piece(i)[1:-1], 16): i for i in range(count) if model.is_byte(i)}
        if len(self.bytes_) != 256:
            raise Unsupported("a model with byte fallback is needed")
        normal = [i for i in range(count) if not special[i] and not model.is_byte(i)]
        self.ids = {model.id_to_piece(i): i for i in normal}
        self.text = {i: piece for piece, i in self.ids.items()}
        self.rank = {i: (-model.get_score(i), i) for i in normal}
        if any(BLANK in piece.lstrip(BLANK) for piece in self.ids):
            raise Unsupported("a piece has a blank after another character")
        self.known = {piece for piece in self.ids if len(piece) == 1}
        if any(c not in self.known for piece in self.ids for c in piece):
            raise Unsupported("a piece has a character that is no piece")
        self.surface = {i: piece.replace(BLANK, " ").encode() for piece, i in self.ids.items()}
        self.surface.update({i: bytes([b]) for b, i in self.bytes_.items()})
        self.surface[model.unk_id()] = UNKNOWN.encode()
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        self.fits: dict[tuple[int, int], bool] = {}
        self.inside = {piece[k - 1 : k + 1] for piece in self.ids for k in range(1, len(piece))}
        self.parts: dict[str, list[int]] = {}
        self.grown: dict[int, Edges | None] = {}
        for probe in ("Ab, é  c\n", "  x一 y "):
            if [*self.encode(probe), self.end] != model.encode(probe, add_eos=True):
                raise Unsupported("the model normalises text, or merges otherwise")

    def merge(self, text: str, steps: list[tuple[int, str, str]] | None = None) -> list[int]:
        """The merges as such: join the best-ranked neighbours, the leftmost of equals, until none can be joined.

        ``steps`` gets the id, the left and the right part of each join.
        """
        parts = list(text)
        while True:
            best, at, to = None, -1, -1
            for k in range(len(parts) - 1):
                i = self.ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.rank[i] < best):
                    best, at, to = self.rank[i], k, i
            if best is None:
                return [self.ids[p] for p in parts]
            if steps is not None:
                steps.append((to, parts[at], parts[at + 1]))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def edges(self, token: int) -> Edges | None:
        """How the token's text grows at its two ends as it is merged; None if it does not merge to the token."""
        if token not in self.grown:
            text = self.text[token]
            steps: list[tuple[int, str, str]] = []
            if self.merge(text, steps) != [token]:
                self.grown[token] = None
            else:
                parts = {self.text[to]: (left, right) for to, left, right in steps}
                left, right = [text], [text]
                while left[-1] in parts:
                    left.append(parts[left[-1]][0])
                while right[-1] in parts:
                    right.append(parts[right[-1]][1])
                ranks = [self.rank[to] for to, _, _ in steps]
                self.grown[token] = Edges(
                    [(x, self.rank[self.ids[x]]) for x in left],
                    [(x, self.rank[self.ids[x]]) for x in right],
                    ranks == sorted(ranks),
                )
        return self.grown[token]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two stay as they are when their joined text is merged anew."""
        key = (left, right)
        fits = self.fits.get(key)
        if fits is None:
            if len(self.fits) > 1_000_000:
                self.fits.clear()
            fits = self.fits[key] = self._remerge(left, right)
        return fits

    def _remerge(self, left: int, right: int) -> bool:
        """Merge the joined text, as far as the border between the two is concerned.

        While both sides grow in order of rank, the border lies between one of the left token's right ends
        and one of the right token's left ends. The two stay apart if at each such moment the next growth of
        a side comes before a join over the border. Where a side does not grow in that order, all is merged.
        """
        a, b = self.grown[left], self.grown[right]
        if not (a.in_order and b.in_order):
            return self.merge(self.text[left] + self.text[right]) == [left, right]
        i, j = len(a.right) - 1, len(b.left) - 1
        ids, rank = self.ids, self.rank
        while True:
            joined = ids.get(a.right[i][0] + b.left[j][0])
            grow_a = a.right[i - 1][1] if i else _NEVER
            grow_b = b.left[j - 1][1] if j else _NEVER
            if joined is not None and rank[joined] < grow_a and rank[joined] <= grow_b:
                return False
            if not i and not j:
                return True
            if grow_a <= grow_b:
                i -= 1
            else:
                j -= 1

    def cover(self, unit: str) -> list[int]:
        """Tokens of a text whose characters are all pieces."""
        size = len(unit)
        found: list[list[tuple[int, int]]] = [[] for _ in unit]
        for end, match in self.automaton.iter(unit):
            found[end + 1 - match[0]].append(match)
        grown, fits = self.grown, self.fits
        failed = 0  # bit p: no cover leads on from position p
        path: list[int] = []
        tried: list[int] = []  # of the matches at the start of each token on the path, how many are still to be tried
        at, last = 0, -1
        here = found[0]
        left = len(here)
        while at < size:
            choice = -1
            while left:
                left -= 1
                length, i = here[left]
                if failed and failed >> (at + length) & 1:
                    continue
                if (grown[i] if i in grown else self.edges(i)) is None:
                    continue
                if last >= 0:
                    fit = fits.get((last, i))
                    if not (self.compatible(last, i) if fit is None else fit):
                        continue
                choice = i
                break
            if choice >= 0:
                path.append(choice)
                tried.append(left)
                last = choice
                at += length
                if at < size:
                    here = found[at]
                    left = len(here)
                continue
            failed |= 1 << at
            at -= len(self.text[path.pop()])
            left = tried.pop()
            here = found[at]
            last = path[-1] if path else -1
        return path

    def encode_unit(self, unit: str) -> list[int]:
        """Tokens of a text in which blanks stand first only: cut where no piece has the two characters side by side."""
        inside = self.inside
        cuts = [k for k in range(1, len(unit)) if unit[k - 1 : k + 1] not in inside]
        if not cuts:
            return self._part(unit)
        out: list[int] = []
        begin = 0
        for end in [*cuts, len(unit)]:
            part = unit[begin:end]
            begin = end
            tokens = self.parts.get(part)
            if tokens is None:
                if len(self.parts) > 200_000:
                    self.parts.clear()
                tokens = self.parts[part] = self._part(part)
            out += tokens
        return out

    def _part(self, part: str) -> list[int]:
        return self.cover(part) if part[0] in self.known else [self.bytes_[b] for b in part.encode()]

    def encode(self, text: str) -> list[int]:
        """Tokens of a whole text, without the end id."""
        if not text:
            return []
        units = _UNITS.findall(BLANK + text.replace(" ", BLANK))
        return [i for unit in units for i in self.encode_unit(unit)]

    def decode(self, ids: list[int]) -> str:
        """Text of the ids; control ids have none, and the unknown one is shown as a mark between blanks.

        The blank of a piece that comes first is dropped, as encoding has put it there. Each byte that is no part of
        a character gives one replacement character.
        """
        surface = self.surface
        first = next((i for i in ids if i in surface), None)
        runs: list[list[bytes]] = [[]]  # a control id parts the bytes around it
        for i in ids:
            if i in surface:
                runs[-1].append(surface[i])
            else:
                runs.append([])
        text = "".join([b"".join(run).decode("utf-8", "replace-each") for run in runs])
        return text[1:] if first in self.text and text[:1] == " " else text


_UNITS = re.compile(f"\n|{BLANK}*[^{BLANK}\n]+|{BLANK}+")
codecs.register_error("replace-each", lambda error: ("\ufffd" * (error.end - error.start), error.end))


class Units(dict):
    """Unit -> its ids in decimal, joined by blanks; what is missing gets encoded, and decoded once.

    Once ``most`` units are held they become the old ones, of which those that are met again are kept.
    """

    def __init__(self, pieces: Pieces, prefix: str, most: int):
        self.pieces, self.prefix, self.most = pieces, prefix, most
        self.old: dict[str, str] = {}
        self.exact = True  # all units so far decode to themselves

    def __missing__(self, word: str) -> str:
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        joined = self.old.get(word)
        if joined is None:
            unit = self.prefix + word
            ids = self.pieces.encode_unit(unit)
            raw = b"".join([self.pieces.surface[i] for i in ids])
            self.exact &= raw == unit.replace(BLANK, " ").encode()
            joined = " ".join(map(str, ids))
        self[word] = joined
        return joined


class Codec:
    """Encodes texts with the units of the last ones kept, up to twice ``most`` of them."""

    def __init__(self, path: str, most: int = 400_000):
        self.pieces = Pieces(path)
        self.after_blank = Units(self.pieces, BLANK, most)
        self.bare = Units(self.pieces, "", most // 4)

    def units(self, text: str) -> list[str]:
        """Decimal ids of the units of a text, in order."""
        if not text:
            return []
        out: list[str] = []
        blank, bare = self.after_blank.__getitem__, self.bare.__getitem__
        first = True
        for line in text.replace(BLANK, " ").split("\n"):
            if not first:
                out.append(bare("\n"))
            if "  " in line or line[-1:] == " " or first and line[:1] in ("", " "):
                whole = (BLANK if first else "") + line.replace(" ", BLANK)
                out += [blank(u[1:]) if u[0] == BLANK != u[1:2] else bare(u) for u in _UNITS.findall(whole)]
            else:
                words = line.split(" ")
                if not first:
                    head = words.pop(0)
                    if head:
                        out.append(bare(head))
                out += map(blank, words)
            first = False
        return out

    def digest(self, text: str) -> tuple[int, str, str]:
        """Ids with the end id: their number, the hash of their decimals, and the hash of the decoded text.

        Each distinct unit was decoded when it was encoded. As long as all gave themselves, so does the text.
        """
        units = self.units(text)
        joined = " ".join([*units, str(self.pieces.end)])
        if self.after_blank.exact and self.bare.exact:
            decoded = text.replace(BLANK, " ")
        else:
            decoded = self.pieces.decode([int(i) for i in joined.split()])
        return (
            joined.count(" ") + 1,
            hashlib.sha256(joined.encode()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest(),
        )

    def ids(self, text: str) -> np.ndarray:
        return np.fromstring(" ".join(self.units(text)), np.int32, sep=" ")


_codecs: dict[str, Codec] = {}


def codec_of(path: str) -> Codec:
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def token_digests(docs: DataFrame, model: str) -> DataFrame:
    """Token count and hashes of every row of ``docs`` (doc_id, text): one row out for each row in.

    ``model`` is a path that every executor can open. A null text is read as empty: the end id alone.
    Repeated rows get equal results; columns other than the two are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(model)
        for batch in pieces_of(batches, "text", 8 << 20):
            rows = [codec.digest(text) for text in batch.column(1).fill_null("").to_pylist()]
            count, ids, decoded = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(count, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def encode(docs: DataFrame, model: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of ``text`` (end id last) as a new array column ``ids``, which must not exist yet.

    A null text is read as empty.
    """
    if ids in docs.columns:
        raise ValueError(f"there is a column {ids} already")

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = codec_of(model)
        end = np.array([codec.pieces.end], np.int32)
        for column in columns:
            parts = [np.append(codec.ids(x), end) for x in column.fill_null("").to_pylist()]
            ends = np.cumsum([0] + [len(x) for x in parts]).astype(np.int32)
            flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    return docs.withColumn(ids, F.arrow_udf(run, "array<int>")(F.col(text)))


def decode(docs: DataFrame, model: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the text of the id arrays in ``ids`` as a new column. A null array gives null."""
    if text in docs.columns:
        raise ValueError(f"there is a column {text} already")

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = codec_of(model).pieces
        for column in columns:
            yield pa.array([None if x is None else pieces.decode(x) for x in column.to_pylist()], pa.string())

    return docs.withColumn(text, F.arrow_udf(run, "string")(F.col(ids)))
