"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from math import log10

import numpy as np

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def quality_base(text: str | None) -> tuple:
    text = text or ""
    words = SPACE_WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if SPACE_WORD.search(x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def contamination(texts: list[str | None], items: list[tuple[object, str | None]]) -> list[tuple]:
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: word.findall((t or "").translate(ASCII_LOWER))
    windows: dict[tuple, set] = {}
    for item, text in items:
        w = split(text)
        k = min(13, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + k]), set()).add(item)
    out = []
    for text in texts:
        w = split(text)
        hit: set[int] = set()
        found: set = set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if own := windows.get(tuple(w[i : i + k])):
                    hit |= set(range(i, i + k))
                    found |= own
        ids = sorted(str(x) for x in found if x is not None)
        out.append((len(w), len(hit), ids, bool(hit) and 20 * len(hit) >= len(w)))
    return out


def shingles(text: str | None) -> set:
    w = SPACE_WORD.findall((text or "").translate(ASCII_LOWER))
    return {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) > 2 else ({tuple(w)} if w else set())


def components(rows: list[tuple[int | None, str | None]]) -> list[tuple[int, object]]:
    sets = [shingles(text) for _, text in rows]
    label = list(range(len(rows)))

    def root(i: int) -> int:
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 90 * len(a | b):
                label[root(i)] = root(j)
    least: dict[int, int] = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return [(len(s), least.get(root(i)) if s else rows[i][0]) for i, s in enumerate(sets)]


def without_repeats(texts: list[str | None], window: int = 200) -> list[tuple]:
    raw = [(t or "").encode() for t in texts]
    times = Counter(b[i : i + window] for b in raw for i in range(len(b) - window + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - window + 1):
            if times[b[i : i + window]] > 1:
                gone[i : i + window] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int(np.count_nonzero(gone & ~np.concatenate(([False], gone[:-1])))) if len(b) else 0
        out.append((len(b), int(gone.sum()), spans, sha(kept)))
    return out


def pattern_spans(text: str | None) -> list[tuple[str, int, int]]:
    text = text or ""
    digits = lambda s: re.sub(r"[^0-9]", "", s)

    def luhn(s: str) -> bool:
        doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(s))]
        return sum(d // 10 + d % 10 for d in doubled) % 10 == 0

    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0])):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(digits(m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def unigram_scores(rows: list[tuple[bool, str | None]]) -> list[tuple]:
    split = lambda t: SPACE_WORD.findall((t or "").translate(ASCII_LOWER))
    train = Counter()
    for held_out, text in rows:
        if not held_out:
            train.update([*split(text), None])
    n, v = sum(train.values()), len(train)
    out = []
    for _, text in rows:
        tokens = [*split(text), None]
        score = sum(log10((train[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)
        out.append((len(tokens), sum(train[t] > 0 for t in tokens), n, score))
    return out


def context_tree_scores(train: list[bytes], texts: list[bytes]) -> list[float]:
    """Log10 probabilities by the recursion over contexts of 0, 1 and 2 bytes, one decision at a time."""
    from math import exp, lgamma, log, pi

    counts: dict[tuple, list[int]] = {}

    def bits(data: bytes):
        padded = b"\0\0" + data
        for i in range(len(data)):
            node = 1
            for k in range(7, -1, -1):
                bit = padded[i + 2] >> k & 1
                yield padded[i : i + 2], node, bit
                node = 2 * node + bit

    for data in train:
        for context, node, bit in bits(data):
            for depth in range(3):
                counts.setdefault((node, context[2 - depth :]), [0, 0])[bit] += 1

    def kt(key: tuple) -> float:
        a, b = counts.get(key, (0, 0))
        return lgamma(a + 0.5) + lgamma(b + 0.5) - log(pi) - lgamma(a + b + 1)

    children: dict[tuple, list[tuple]] = {}
    for node, context in counts:
        if context:
            children.setdefault((node, context[1:]), []).append((node, context))

    def weighted(key: tuple) -> float:
        if len(key[1]) == 2:
            return kt(key)
        a, b = kt(key), sum(weighted(c) for c in children.get(key, ()))
        top = max(a, b)
        return top + log(exp(a - top) + exp(b - top)) - log(2)

    memo: dict[tuple, float] = {}

    def stop(key: tuple) -> float:
        if key not in memo:
            memo[key] = exp(kt(key) - log(2) - weighted(key)) if key in counts else 0.5
        return memo[key]

    def one(node: int, context: bytes) -> float:
        p = 0.5
        for depth in (2, 1, 0):
            key = (node, context[2 - depth :])
            a, b = counts.get(key, (0, 0))
            here = (b + 0.5) / (a + b + 1)
            p = here if depth == 2 else stop(key) * here + (1 - stop(key)) * p
        return p

    out = []
    for data in texts:
        total = 0.0
        for context, node, bit in bits(data):
            p = one(node, context)
            total += log10(p if bit else 1 - p)
        out.append(total)
    return out


def phrases(text: bytes, samples: list[bytes], block: int) -> int:
    """Greedy longest matches in any of the samples; a byte that is in none is a phrase."""
    total = 0
    for begin in range(0, len(text), block):
        part, at = text[begin : begin + block], 0
        while at < len(part):
            size = 1
            while at + size < len(part) and any(part[at : at + size + 1] in s for s in samples):
                size += 1
            total += 1
            at += size
    return total
