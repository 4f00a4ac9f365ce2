"""Personal data: fixed patterns, and a skip-chain conditional random field for what they miss.

The patterns find e-mail addresses, IP addresses, card and phone numbers. The field's nodes are these
spans, whose labels are fixed, and all other stretches of a text that look like one of them loosely.
Neighbours in the text are joined by chain potentials; the next stretch with the same text or digits, or
with the same last digits, is joined by a skip potential however far it is. Loopy belief propagation over
a document's nodes then gives labels that agree, and a stretch is added if its label is sure enough.

Weights come from pseudo-likelihood on all texts with a digit or an @. What the patterns miss has no label there.
To each text are added its own spans in loose forms, labelled by kind, and other digits in the same forms and in
those of dates and plain numbers, labelled as nothing. A quarter of the texts is held out; on it the least
probability is chosen from which an added stretch is as good as never wrong. Nodes are counted by their features and
neighbours' labels, held-out additions by their probability, so that few rows come to the driver, whatever the corpus.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pieces_of

KINDS = ("email", "ip", "card", "phone")
LABELS = (*KINDS, "other")
OTHER = len(KINDS)

Span = tuple[str, int, int]

# The patterns' character sets and bounds.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[Span]:
    """Each @ with the longest run of local characters before it, not before the last address's end, and a domain."""
    out: list[Span] = []
    free, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            begin = at
            while begin > free and text[begin - 1] in _LOCAL:
                begin -= 1
            if begin < at:
                out.append(("email", begin, domain.end()))
                free = domain.end()
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns, by kind and start."""
    if not _ANY.search(text):
        return []
    out = emails(text)
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p := part.lstrip("0")) < 4 and int(p or 0) < 256 for part in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return out


_LOOSE = re.compile(
    r"[+(]?[0-9][0-9\x20().-]{5,}[0-9]"
    r"|(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9.])"
    r"|[A-Za-z0-9._%+-]{1,64}\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]{1,64}(?:\x20?(?:\.|[\[(](?:dot|DOT)[\])])\x20?[A-Za-z0-9-]{1,64})+"
)
# Words that announce a kind, at the end of the text before a stretch.
_CUES = tuple(
    re.compile(rf"(?:{words})[\W_]*\Z", re.IGNORECASE)
    for words in (
        "e-?mail|mail to|correo|courriel",
        r"\bip|host|server|address",
        "card|visa|karte|carte|tarjeta",
        "tel|phone|call|fax|mobile|telefon|telefono",
    )
)
LEAST_DIGITS = 7


@dataclass
class Node:
    begin: int
    end: int
    label: int  # of a fixed span, or -1
    features: np.ndarray
    keys: tuple[str, ...]


FEATURES = 18
SURE = 0.95  # where no held-out case tells


def features_of(text: str, begin: int, end: int) -> np.ndarray:
    raw = text[begin:end]
    digits = digits_of(raw)
    n = len(digits)
    parts = raw.split(".")
    quad = len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts)
    before = text[max(0, begin - 24) : begin]
    values = [
        1,
        "@" in raw,
        n == 0,
        0 < n < 7,
        7 <= n < 9,
        9 <= n < 13,
        13 <= n < 20,
        raw.startswith("+"),
        n >= 20,
        quad,
        quad and all(len(p) < 4 and int(p) < 256 for p in parts),
        13 <= n < 20 and luhn(digits),
        any(c.isalpha() for c in raw),
        "(" in raw or "-" in raw or " " in raw,
        *[bool(cue.search(before)) for cue in _CUES],
    ]
    return np.array(values, float)


def nodes_of(text: str, base: list[Span]) -> list[Node]:
    """The fixed spans and the loose stretches apart from them, in order."""
    taken = sorted((a, b, KINDS.index(kind)) for kind, a, b in base)
    found = [(a, b, label) for a, b, label in taken]
    at = 0
    for m in _LOOSE.finditer(text):
        a, b = m.span()
        while at < len(taken) and taken[at][1] <= a:
            at += 1
        if at < len(taken) and taken[at][0] < b:
            continue
        if "@" not in m[0] and "at" not in m[0].lower() and m[0].count(".") != 3 and len(digits_of(m[0])) < LEAST_DIGITS:
            continue
        found.append((a, b, -1))
    nodes = []
    for a, b, label in sorted(found):
        digits = digits_of(text[a:b])
        keys = (text[a:b].lower(),)
        if len(digits) >= LEAST_DIGITS:
            keys += (f"d{digits}", f"s{digits[-LEAST_DIGITS:]}")
        nodes.append(Node(a, b, label, features_of(text, a, b), keys))
    return nodes


NEAR = 80


def edges_of(nodes: list[Node]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Chain edges between neighbours not far apart, and skip edges to the next node that shares a key."""
    chain = [(i, i + 1) for i in range(len(nodes) - 1) if nodes[i + 1].begin - nodes[i].end <= NEAR]
    skip = set()
    last: dict[str, int] = {}
    for i, node in enumerate(nodes):
        for key in node.keys:
            if key in last:
                skip.add((last[key], i))
            last[key] = i
    return chain, sorted(skip)


@dataclass(frozen=True)
class Field:
    """Weights: features by labels, and labels by labels for chain and skip edges."""

    node: np.ndarray
    chain: np.ndarray
    skip: np.ndarray
    sure: float = SURE

    def marginals(self, nodes: list[Node], edges: tuple[list, list] | None = None) -> np.ndarray:
        """Label probabilities of the nodes by loopy sum-product, fixed nodes as evidence.

        The nodes are one text's in order, or have ``edges`` given.
        """
        score = np.array([n.features for n in nodes]) @ self.node
        fixed = np.array([n.label for n in nodes])
        for i in np.flatnonzero(fixed >= 0):
            score[i] = -1e3
            score[i, fixed[i]] = 0
        score -= score.max(axis=1, keepdims=True)
        phi = np.exp(score)
        chain, skip = edges_of(nodes) if edges is None else edges
        if not chain and not skip:
            return phi / phi.sum(axis=1, keepdims=True)
        pairs = np.array(chain + skip)
        psi = np.exp(np.concatenate([np.repeat(self.chain[None], len(chain), 0), np.repeat(self.skip[None], len(skip), 0)]))
        source = np.concatenate([pairs[:, 0], pairs[:, 1]])
        target = np.concatenate([pairs[:, 1], pairs[:, 0]])
        psi = np.concatenate([psi, psi.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(pairs)) + len(pairs), np.arange(len(pairs))])
        message = np.full((len(source), len(LABELS)), 1 / len(LABELS))
        for _ in range(30):
            logs = np.log(message)
            belief = np.log(phi + 1e-300)
            np.add.at(belief, target, logs)
            out = belief[source] - logs[back]
            out = np.exp(out - out.max(axis=1, keepdims=True))
            new = np.einsum("ei,eij->ej", out, psi)
            new = 0.5 * message + 0.5 * new / new.sum(axis=1, keepdims=True)
            moved = np.abs(new - message).max()
            message = new
            if moved < 1e-4:
                break
        belief = np.log(phi + 1e-300)
        np.add.at(belief, target, np.log(message))
        belief = np.exp(belief - belief.max(axis=1, keepdims=True))
        return belief / belief.sum(axis=1, keepdims=True)


def added_spans(field: Field, text: str, base: list[Span], sure: float) -> list[Span]:
    """Stretches apart from the fixed spans whose label the field is sure of."""
    if not base and not _LOOSE.search(text):
        return []
    nodes = nodes_of(text, base)
    if all(n.label >= 0 for n in nodes):
        return []
    found = field.marginals(nodes)
    out = []
    for node, p in zip(nodes, found, strict=True):
        if node.label < 0 and (label := int(p.argmax())) != OTHER and p[label] >= sure:
            out.append((KINDS[label], node.begin, node.end))
    return out


def fit(
    features: np.ndarray, labels: np.ndarray, chain: np.ndarray, skip: np.ndarray, counts: np.ndarray, steps: int = 400
) -> Field:
    """Pseudo-likelihood: each node's label given its features and how many neighbours have each label.

    A row stands for ``counts`` equal nodes.
    """
    x = np.hstack([features, chain, skip])
    weights = np.zeros((x.shape[1], len(LABELS)))
    target = np.eye(len(LABELS))[labels]
    share = counts[:, None] / max(1, counts.sum())
    speed = np.zeros_like(weights)
    for _ in range(steps):
        z = x @ weights
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        gradient = x.T @ (share * (p - target)) + 1e-3 * weights
        speed = 0.9 * speed - 0.2 * gradient
        weights = weights + speed
    a, b = FEATURES, FEATURES + len(LABELS)
    pair = lambda w: (w + w.T) / 2
    return Field(weights[:a], pair(weights[a:b]), pair(weights[b:]))


def loose_form(rng: random.Random, kind: str, raw: str) -> str:
    """A span in a form that the patterns do not read."""
    if kind == "email":
        local, domain = raw.rsplit("@", 1)
        dot = rng.choice((".", " [dot] ", "(dot)"))
        return local + rng.choice((" [at] ", "(at)", " (at) ", "[AT]")) + domain.replace(".", dot)
    digits = digits_of(raw)
    if kind == "card":
        return rng.choice((".", "  ")).join(digits[k : k + 4] for k in range(0, len(digits), 4))
    cut = sorted(rng.sample(range(2, len(digits) - 2), 2))
    return rng.choice((" ", "-", ".")).join((digits[: cut[0]], digits[cut[0] : cut[1]], digits[cut[1] :]))


def planted(text: str, base: list[Span]) -> tuple[str, dict[int, int]]:
    """What is put after the text: loose forms of its own spans and other digits; label by place in what is added."""
    rng = random.Random(zlib.crc32(text.encode()))
    other = lambda form: "".join(str(rng.randint(0, 9)) if "0" <= c <= "9" else c for c in form)
    added = [
        (OTHER, f"{rng.randint(1900, 2099)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}"),
        (OTHER, other("1" * rng.randint(7, 24))),
        (OTHER, other(rng.choice(("1 234 567 890", "123-4567", "12 345 678", "1234567.89", "(123) 456-7890")))),
        (OTHER, f"{rng.randint(256, 999)}.{rng.randint(0, 99)}.{rng.randint(0, 99)}.{rng.randint(0, 99)}"),
    ]
    for kind, a, b in base:
        if kind != "ip":
            form = loose_form(rng, kind, text[a:b])
            added.append((KINDS.index(kind), form))
            if kind != "email":
                added.append((OTHER, other(form)))
    rng.shuffle(added)
    labels, out, at = {}, [], 0
    for label, form in added:
        between = rng.choice((" and ", " or ", " see ", "; ", " and so on" * (NEAR // 8) + " "))
        at += len(between)
        labels[at] = label
        out += [between, form, " then"]
        at += len(form) + len(" then")
    return "".join(out), labels


def planted_nodes(text: str) -> tuple[list[Node], list[int]]:
    """Nodes of the text with planted stretches, and their labels; -1 for what nothing is known about."""
    base, end = base_spans(text), len(text)
    more, labels = planted(text, base)
    # What is added begins as no pattern can go on, so its spans are found apart.
    base += [(kind, end + a, end + b) for kind, a, b in base_spans(more)]
    nodes = nodes_of(text + more, base)
    return nodes, [n.label if n.label >= 0 else labels.get(n.begin - end, -1) for n in nodes]


def telling_texts(docs: DataFrame) -> DataFrame:
    """All texts with a digit or an @: no other has a span of its own, or anything like one."""
    return docs.select("text").filter(F.col("text").rlike("[0-9@]"))


def held_out() -> Column:
    return F.crc32(F.col("text").cast("binary")) % 4 == 0


def node_counts(texts: DataFrame) -> tuple[np.ndarray, ...]:
    """Features, label, neighbours' labels and number of the labelled nodes of all texts.

    Features are yes or no, and a node has at most two neighbours in the chain and six by skips: the different rows
    are few. Tasks add up theirs; a row per kind of node comes to the driver.
    """
    width = FEATURES + 1 + 2 * len(LABELS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in pieces_of(batches, "text", 8 << 20):
            for text in batch.column(0).to_pylist():
                nodes, labels = planted_nodes(text)
                around = np.zeros((len(nodes), 2, len(LABELS)), np.int8)
                for kind, pairs in enumerate(edges_of(nodes)):
                    for i, j in pairs:
                        if labels[j] >= 0:
                            around[i, kind, labels[j]] += 1
                        if labels[i] >= 0:
                            around[j, kind, labels[i]] += 1
                for node, label, near in zip(nodes, labels, around, strict=True):
                    if label >= 0:
                        counts[node.features.astype(np.int8).tobytes() + bytes((label,)) + near.tobytes()] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["x", "n"]
        )

    found = texts.mapInArrow(run, "x binary, n long").groupBy("x").agg(F.sum("n").alias("n")).collect()
    found = sorted((bytes(r.x), r.n) for r in found)
    x = np.frombuffer(b"".join(x for x, _ in found), np.int8).reshape(-1, width).astype(float)
    cut = np.cumsum([FEATURES, 1, len(LABELS)])
    counts = np.array([n for _, n in found], float)
    return x[:, : cut[0]], x[:, cut[0]].astype(int), x[:, cut[1] : cut[2]], x[:, cut[2] :], counts


_LIMITS = np.arange(60, 100) / 100


def sure_of(texts: DataFrame, field: Field, wrong: float = 0.005) -> float:
    """The least probability, 0.6 or more, from which at most a share ``wrong`` of the additions to ``texts`` is false.

    Additions are counted by how many of the limits they reach.
    """
    shared = texts.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field, counts = shared.value, np.zeros((2, len(_LIMITS) + 1), np.int64)
        for batch in pieces_of(batches, "text", 1 << 20):
            # The texts of a piece are one graph without edges between texts.
            nodes, labels, chain, skip = [], [], [], []
            for text in batch.column(0).to_pylist():
                own, known = planted_nodes(text)
                for edges, new in zip((chain, skip), edges_of(own), strict=True):
                    edges += [(i + len(nodes), j + len(nodes)) for i, j in new]
                nodes += own
                labels += known
            if not nodes:
                continue
            p, label = field.marginals(nodes, (chain, skip)), np.array(labels)
            guess = p.argmax(axis=1)
            added = (np.array([n.label for n in nodes]) < 0) & (label >= 0) & (guess != OTHER)
            reached = np.searchsorted(_LIMITS, p.max(axis=1)[added], side="right")
            np.add.at(counts, ((guess == label)[added].astype(int), reached), 1)
        right, reached = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(right == 1, pa.bool_()), pa.array(reached, pa.int32()), pa.array(counts[right, reached], pa.int64())],
            names=["right", "reached", "n"],
        )

    found = texts.mapInArrow(run, "right boolean, reached int, n long").groupBy("right", "reached").agg(F.sum("n").alias("n"))
    counts = np.zeros((2, len(_LIMITS) + 1), np.int64)
    for r in found.collect():
        counts[int(r.right), r.reached] = r.n
    for k, least in enumerate(_LIMITS, 1):
        false, true = counts[:, k:].sum(axis=1)
        if false + true and false <= wrong * (false + true):
            return float(least)
    return SURE


def fit_field(docs: DataFrame) -> Field:
    texts = telling_texts(docs)
    field = fit(*node_counts(texts.filter(~held_out())))
    return replace(field, sure=sure_of(texts.filter(held_out()), field))


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def find(docs: DataFrame, field: Field, sure: float | None = None) -> DataFrame:
    """Personal data of every row of ``docs`` (doc_id, text): one row out for each row in.

    The counts and the hash are of the patterns' spans; ``spans`` has the field's too. Places are code
    points, ends excluded. ``sure`` is the field's own unless given. A null text is empty. Repeated rows get equal results; other columns are not read.
    """
    sure = field.sure if sure is None else sure
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for batch in pieces_of(batches, "text", 8 << 20):
            counts, digests, spans = [], [], []
            for text in batch.column(1).fill_null("").to_pylist():
                base = in_order(base_spans(text))
                counts.append([sum(s[0] == kind for s in base) for kind in KINDS])
                digests.append(hashlib.sha256(written(base).encode()).hexdigest())
                spans.append(written(in_order(base + added_spans(field, text, base, sure))))
            columns = [pa.array([c[k] for c in counts], pa.int64()) for k in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns, pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def mask(text: str, spans: list[Span]) -> str:
    """The text with each stretch of spans replaced by the name of the first of them."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def masked(docs: DataFrame, field: Field, sure: float | None = None, text: str = "text") -> DataFrame:
    """``docs`` with all spans in ``text`` replaced by their kind in angle brackets; a null text stays null."""
    sure = field.sure if sure is None else sure
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        field = shared.value
        for column in columns:
            out = []
            for x in column.to_pylist():
                base = base_spans(x) if x else []
                out.append(mask(x, base + added_spans(field, x, base, sure)) if x else x)
            yield pa.array(out, pa.string())

    return docs.withColumn(text, F.arrow_udf(run, "string")(F.col(text)))
