"""Personal data in texts: patterns, and a skip-chain conditional random field on top.

The patterns find what has the full form of an address or number. The field labels the tokens that
hold a digit or an at sign: neighbours in the text share a potential, and so do tokens that repeat
the same digits or address at any distance. What a pattern has found is given; loopy message
passing carries it to the repetitions that lack the full form.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.registry import query, table
from plumbline.llm.sample import least_hashed
from plumbline.llm.text import chunks

KINDS = ["email", "ip", "card", "phone"]
# The field is fitted on at most so many documents that hold a digit or an at sign, chosen by a
# hash, and of each on at most so many code points.
SAMPLE_DOCUMENTS = 1_500
SAMPLE_CHARS = 4_000
ROUNDS = 30
# A token outside the patterns is added if its label is at least this sure.
SURE = 0.9
# Digits that a repeated number shares with the first.
SHARED_DIGITS = 7

# Fixed patterns of the result. Possessive parts and the look-behind change no match: they only
# keep long runs from being tried again at each of their characters.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

_MARKED = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"[^\x20\t-\r]+")
_EDGE = "\"'.,;:!?<>[]{}"

Span = tuple[int, int]


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[Span]:
    """Found from each at sign outwards, which is what a search from the left finds."""
    out, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            out.append((start, end))
        at = text.find("@", max(at + 1, end if domain else 0))
    return out


def patterns(text: str) -> dict[str, list[Span]]:
    """The spans of each kind: code points, the end exclusive."""
    if not _MARKED.search(text):
        return {kind: [] for kind in KINDS}

    def card(m: re.Match) -> bool:
        digits = _digits(m[0])
        return 13 <= len(digits) <= 19 and luhn(digits)

    def ip(m: re.Match) -> bool:
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))

    return {
        "email": emails(text),
        "ip": [m.span() for m in _IP.finditer(text) if ip(m)],
        "card": [m.span() for m in _CARD.finditer(text) if card(m)],
        "phone": [m.span() for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15],
    }


_FEATURES = [
    "always",
    "at sign",
    "domain",
    "letters",
    "plus",
    "bracket",
    "hyphen",
    "three dots",
    "one dot",
    "luhn",
    "equals",
    "1-3 digits",
    "4-6 digits",
    "7-9 digits",
    "10-12 digits",
    "13-19 digits",
    "20 digits",
    "other digits",
]


def features(token: str) -> list[int]:
    """Which of _FEATURES a token has."""
    digits = _digits(token)
    n = len(digits)
    out = [0]
    tests = (
        "@" in token,
        "@" in token and "." in token[token.rindex("@") :],
        any(map(str.isalpha, token)),
        token[0] == "+",
        "(" in token or ")" in token,
        "-" in token,
        token.count(".") == 3,
        token.count(".") == 1,
        13 <= n <= 19 and luhn(digits),
        "=" in token,
        1 <= n <= 3,
        4 <= n <= 6,
        7 <= n <= 9,
        10 <= n <= 12,
        13 <= n <= 19,
        n >= 20,
        n > 0 and n != len(token),
    )
    return out + [k for k, test in enumerate(tests, 1) if test]


class Graph:
    """Tokens of some texts as nodes, with the edges between them."""

    def __init__(self, texts: list[str], found: list[dict[str, list[Span]]]):
        self.doc: list[int] = []
        self.spans: list[Span] = []
        self.given: list[int] = []  # label by the patterns, 0 for none
        self.rows: list[list[int]] = []
        chain: list[tuple[int, int]] = []
        skip: list[tuple[int, int]] = []
        for d, (text, spans) in enumerate(zip(texts, found, strict=True)):
            if not _MARKED.search(text):
                continue
            marks = sorted(
                (start, end, k) for k, kind in enumerate(KINDS, 1) for start, end in spans[kind]
            )
            last: dict[str, int] = {}
            before, m = -1, 0
            for token in _TOKEN.finditer(text):
                word = token[0]
                if not _MARKED.search(word):
                    before = -1
                    continue
                left = len(word) - len(word.lstrip(_EDGE))
                word = word.strip(_EDGE)
                if not word:
                    before = -1
                    continue
                start = token.start() + left
                end = start + len(word)
                while m < len(marks) and marks[m][1] <= start:
                    m += 1
                # The first span that overlaps; spans of one start are in the order of KINDS.
                label = next((k for a, b, k in marks[m : m + 4] if a < end and start < b), 0)
                node = len(self.doc)
                self.doc.append(d)
                self.spans.append((start, end))
                self.given.append(label)
                self.rows.append(features(word))
                if before >= 0:
                    chain.append((before, node))
                before = node
                for key in self._keys(word):
                    # To the nearest one before, not to all: as many edges as nodes.
                    if key in last:
                        skip.append((last[key], node))
                    last[key] = node
        self.chain = np.array(chain, dtype=np.int64).reshape(-1, 2)
        self.skip = np.array(skip, dtype=np.int64).reshape(-1, 2)

    @staticmethod
    def _keys(word: str) -> list[str]:
        """What similar tokens share: the last digits of a number, or an address."""
        keys = []
        digits = _digits(word)
        if len(digits) >= SHARED_DIGITS:
            keys.append(f"d{digits[-SHARED_DIGITS:]}")
        if "@" in word:
            keys.append(f"a{word.lower()}")
        return keys

    def matrix(self) -> np.ndarray:
        out = np.zeros((len(self.rows), len(_FEATURES)))
        for n, row in enumerate(self.rows):
            out[n, row] = 1
        return out


class Field:
    """Weights of the potentials: of features, of neighbours and of similar tokens."""

    def __init__(self):
        n = len(KINDS) + 1
        self.node = np.zeros((len(_FEATURES), n))
        self.chain = np.zeros((n, n))
        self.skip = np.zeros((n, n))

    def fit(self, graph: Graph, steps: int = 300, rate: float = 0.3, decay: float = 1e-3) -> Field:
        """By gradient ascent on the pseudo-likelihood: each label given those next to it."""
        x, y = graph.matrix(), np.array(graph.given)
        if not len(y):
            return self
        n = len(KINDS) + 1
        one = np.eye(n)[y]
        chain, skip = graph.chain, graph.skip
        before, after, alike = (np.zeros((len(y), n)) for _ in range(3))
        np.add.at(before, chain[:, 1], one[chain[:, 0]])
        np.add.at(after, chain[:, 0], one[chain[:, 1]])
        for a, b in ((0, 1), (1, 0)):
            np.add.at(alike, skip[:, a], one[skip[:, b]])
        alike /= np.maximum(1, alike.sum(axis=1, keepdims=True))
        for _ in range(steps):
            # ``skip`` is symmetric: similar tokens have no order.
            score = x @ self.node + before @ self.chain + after @ self.chain.T + alike @ self.skip
            p = np.exp(score - score.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            error = (one - p) / np.sqrt(len(y))
            self.node += rate * (x.T @ error / np.sqrt(len(y)) - decay * self.node) * 3
            step = before.T @ error + error.T @ after
            self.chain += rate * (step / np.sqrt(len(y)) - decay * self.chain) * 3
            step = alike.T @ error
            self.skip += rate * ((step + step.T) / 2 / np.sqrt(len(y)) - decay * self.skip) * 3
        # Agreement is what similar tokens are linked for: never against it.
        agree = np.maximum(np.diag(self.skip), 4.0)
        self.skip[np.diag_indices(n)] = agree
        self.skip[0, 0] = 0.0
        return self

    def marginals(self, graph: Graph) -> np.ndarray:
        """Label probabilities of all nodes by loopy message passing, the given labels fixed."""
        n_labels = len(KINDS) + 1
        given = np.array(graph.given, dtype=np.int64)
        unary = graph.matrix() @ self.node
        fixed = given > 0
        unary[fixed] = -50.0
        unary[fixed, given[fixed]] = 0.0
        source = np.concatenate([graph.chain[:, 0], graph.chain[:, 1], graph.skip[:, 0], graph.skip[:, 1]])
        target = np.concatenate([graph.chain[:, 1], graph.chain[:, 0], graph.skip[:, 1], graph.skip[:, 0]])
        c, s = len(graph.chain), len(graph.skip)
        opposite = np.concatenate(
            [np.arange(c, 2 * c), np.arange(c), np.arange(2 * c + s, 2 * (c + s)), np.arange(2 * c, 2 * c + s)]
        ).astype(np.int64)
        potential = np.concatenate(
            [
                np.broadcast_to(self.chain, (c, n_labels, n_labels)),
                np.broadcast_to(self.chain.T, (c, n_labels, n_labels)),
                np.broadcast_to(self.skip, (2 * s, n_labels, n_labels)),
            ]
        )
        messages = np.zeros((len(source), n_labels))
        belief = unary.copy()
        for _ in range(ROUNDS if len(source) else 0):
            out = (belief[source] - messages[opposite])[:, :, None] + potential
            top = out.max(axis=1)
            new = top + np.log(np.exp(out - top[:, None, :]).sum(axis=1))
            new -= new.max(axis=1, keepdims=True)
            change = np.abs(new - messages).max()
            messages = 0.5 * messages + 0.5 * new
            belief = unary.copy()
            np.add.at(belief, target, messages)
            if change < 1e-3:
                break
        p = np.exp(belief - belief.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


def added(graph: Graph, field: Field, found: list[dict[str, list[Span]]]) -> list[list]:
    """(kind, start, end) of each text that the field adds: sure tokens that repeat a token that
    a pattern has found, and that no pattern's span overlaps."""
    out: list[list] = [[] for _ in found]
    if not len(graph.skip):
        return out
    p = field.marginals(graph)
    given = np.array(graph.given)
    reached, edges = given > 0, graph.skip
    while True:  # along the repetitions; each is linked to the one before
        more = reached.copy()
        more[edges[reached[edges[:, 0]], 1]] = True
        more[edges[reached[edges[:, 1]], 0]] = True
        if (more == reached).all():
            break
        reached = more
    best = p.argmax(axis=1)
    chosen = (given == 0) & reached & (best > 0) & (p.max(axis=1) >= SURE)
    for node in np.flatnonzero(chosen).tolist():
        start, end = graph.spans[node]
        taken = found[graph.doc[node]]
        if not any(a < end and start < b for kind in KINDS for a, b in taken[kind]):
            out[graph.doc[node]].append((KINDS[best[node] - 1], start, end))
    return out


def train(documents: DataFrame) -> Field:
    """A field fitted on what the patterns find in a bounded sample."""
    n = F.length("text")
    place = F.pmod(F.xxhash64("doc_id"), F.greatest(n - F.lit(SAMPLE_CHARS), F.lit(0)) + 1) + 1
    passage = F.substring("text", place.cast("int"), F.lit(SAMPLE_CHARS)).alias("passage")
    found = documents.select("doc_id", passage).filter(F.col("passage").rlike("[0-9@]"))
    rows = least_hashed(found, ["doc_id", "passage"], SAMPLE_DOCUMENTS, seed=9).collect()
    texts = [row["passage"] for row in rows]
    found = [patterns(text) for text in texts]
    return Field().fit(Graph(texts, found))


def personal_data(documents: DataFrame, field: Field) -> DataFrame:
    """``doc_id`` and ``found``, a list of (kind, start, end, base) in the order of KINDS and
    places; ``base`` says that a pattern found it.

    Null and empty texts hold nothing. Rows with one doc_id are answered one by one. An empty
    table gives no rows. Only ``doc_id`` and ``text`` are read.
    """
    one = pa.struct(
        [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, raw in chunks(batches):
            texts = [text.decode() for text in raw]
            found = [patterns(text) for text in texts]
            more = added(Graph(texts, found), field, found)
            rows = []
            for base, extra in zip(found, more, strict=True):
                spans = [(KINDS.index(kind), a, b, True) for kind in KINDS for a, b in base[kind]]
                spans += [(KINDS.index(kind), a, b, False) for kind, a, b in extra]
                rows.append(
                    [
                        {"kind": KINDS[k], "start": a, "end": b, "base": is_base}
                        for k, a, b, is_base in sorted(spans)
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(rows, pa.list_(one))],
                names=["doc_id", "found"],
            )

    return documents.select("doc_id", "text").mapInArrow(
        run,
        "doc_id bigint, found array<struct<kind: string, start: bigint, end: bigint, base: boolean>>",
    )


@query("op7_personal_data_skip_chain")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = personal_data(documents, train(documents))
    base = F.filter("found", lambda x: x["base"])
    kinds = F.transform(base, lambda x: x["kind"])

    def joined(spans):
        return F.array_join(
            F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ","
        )

    return found.select(
        "doc_id",
        *[
            (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("bigint").alias(f"n_{kind}")
            for kind in KINDS
        ],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    )
