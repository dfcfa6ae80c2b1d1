"""Language of a text by a bidirectional gated recurrent network over its bytes.

The network reads the bytes of each run between white space in both directions and labels every
byte position; the probabilities of all positions of a document are pooled. It starts anew at
white space, so that equal runs are computed once. Long runs are read in parts of ``PART`` bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.registry import query, table
from plumbline.llm.sample import least_hashes
from plumbline.llm.text import SPACED, Words, chunks, kept
from plumbline.session import materialize

# The network is fitted on at most so many documents of each language, and of each on a passage of
# at most so many code points at a place that a hash of its id chooses.
SAMPLE_DOCUMENTS = 250
SAMPLE_CHARS = 1200
HIDDEN = 12
PART = 24
STEPS = 500
BATCH = 256
UNKNOWN = "und"
# Below this mean probability no language is recognized; among four, chance alone gives 0.25.
MIN_SCORE = 0.3
# Runs that a worker remembers with their sums.
CACHED_RUNS = 400_000
# Bytes of text that are looked at together; hashing them takes some 40 bytes for each.
READ_BYTES = 1 << 20


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Two gated recurrent layers, one for each direction, and a softmax at every position.

    ``x`` holds what each byte adds to the gates (update, reset, candidate), ``u`` the recurrent
    weights; ``v`` and ``c`` map both states to the languages.
    """

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 7):
        self.languages, self.hidden = languages, hidden
        rng, n = np.random.RandomState(seed), len(languages)
        self.weights = {
            "v": rng.normal(0, 0.3, (2 * hidden, n)).astype("f4"),
            "c": np.zeros(n, "f4"),
        }
        for side in "fb":
            self.weights["x" + side] = rng.normal(0, 0.3, (257, 3 * hidden)).astype("f4")
            self.weights["u" + side] = rng.normal(0, 0.3, (hidden, 3 * hidden)).astype("f4")

    def _states(self, codes: np.ndarray, side: str, trace: list | None = None) -> np.ndarray:
        """States after every position, ``codes`` being (position, row) with 256 for no byte."""
        x, u, h = self.weights["x" + side], self.weights["u" + side], self.hidden
        state = np.zeros((codes.shape[1], h), "f4")
        states = np.empty((*codes.shape, h), "f4")
        steps = range(len(codes)) if side == "f" else range(len(codes) - 1, -1, -1)
        for t in steps:
            given = x[codes[t]]
            there = (codes[t] < 256)[:, None]
            back = state @ u
            gates = _sigmoid(given[:, : 2 * h] + back[:, : 2 * h])
            z, r = gates[:, :h], gates[:, h:]
            new = np.tanh(given[:, 2 * h :] + r * back[:, 2 * h :])
            before, state = state, np.where(there, new + z * (state - new), state)
            states[t] = state
            if trace is not None:
                trace.append((t, there, before, z, r, new, back[:, 2 * h :]))
        return states

    def positions(self, codes: np.ndarray) -> np.ndarray:
        """Probabilities of the languages at every position."""
        states = np.concatenate([self._states(codes, "f"), self._states(codes, "b")], axis=2)
        scores = states @ self.weights["v"] + self.weights["c"]
        scores = np.exp(scores - scores.max(axis=2, keepdims=True))
        return scores / scores.sum(axis=2, keepdims=True)

    def gradients(self, codes: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy of all positions, by backpropagation through time."""
        h, w = self.hidden, self.weights
        traces: dict[str, list] = {"f": [], "b": []}
        states = np.concatenate([self._states(codes, s, traces[s]) for s in "fb"], axis=2)
        scores = states @ w["v"] + w["c"]
        scores = np.exp(scores - scores.max(axis=2, keepdims=True))
        error = scores / scores.sum(axis=2, keepdims=True)
        error[:, np.arange(len(labels)), labels] -= 1
        there = codes < 256
        error *= (there / max(1, there.sum()))[:, :, None]
        out = {
            "v": np.einsum("tbh,tbl->hl", states, error),
            "c": error.sum(axis=(0, 1)),
        }
        into = error @ w["v"].T
        for k, side in enumerate("fb"):
            u = w["u" + side]
            dx, du = np.zeros_like(w["x" + side]), np.zeros_like(u)
            carried = np.zeros((codes.shape[1], h), "f4")
            for t, on, before, z, r, new, back in reversed(traces[side]):
                d = carried + into[t][:, k * h : (k + 1) * h]
                d_on = np.where(on, d, 0)
                d_new = d_on * (1 - z) * (1 - new * new)
                d_z = d_on * (before - new) * z * (1 - z)
                d_r = d_new * back * r * (1 - r)
                given = np.concatenate([d_z, d_r, d_new], axis=1)
                recurrent = np.concatenate([d_z, d_r, d_new * r], axis=1)
                np.add.at(dx, codes[t], given)
                du += before.T @ recurrent
                carried = np.where(on, d * z + recurrent @ u.T, d)
            dx[256] = 0
            out["x" + side], out["u" + side] = dx, du
        return out

    def fit(self, codes: np.ndarray, labels: np.ndarray, steps: int = STEPS, seed: int = 11):
        """Adam on batches of runs drawn with equal shares of the languages."""
        rng = np.random.RandomState(seed)
        of = [np.flatnonzero(labels == k) for k in range(len(self.languages))]
        mean = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for step in range(1, steps + 1):
            rows = np.concatenate([rng.choice(o, max(1, BATCH // len(of))) for o in of])
            part = codes[:, rows]
            part = part[: max(1, int((part < 256).sum(axis=0).max()))]
            rate = 0.02 * min(1.0, 2 * (1 - (step - 1) / steps))
            for k, g in self.gradients(part, labels[rows]).items():
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.99 * square[k] + 0.01 * g * g
                scaled = mean[k] / (1 - 0.9**step)
                self.weights[k] -= rate * scaled / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
        return self


def _parts(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs cut into parts of at most PART bytes."""
    n = -(-(ends - starts) // PART)
    if (n == 1).all():
        return starts, ends
    first = np.repeat(starts, n)
    step = np.arange(len(first)) - np.repeat(np.cumsum(n) - n, n)
    cut = first + step * PART
    return cut, np.minimum(cut + PART, np.repeat(ends, n))


def _codes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(position, run) bytes of runs, 256 after their end."""
    width = int((ends - starts).max(initial=1))
    at = starts + np.arange(width)[:, None]
    return np.where(at < ends, buffer[np.minimum(at, len(buffer) - 1)], 256).astype(np.int16)


def sample(documents: DataFrame) -> list[tuple[str, str]]:
    """(language, passage) rows to learn from, bounded by SAMPLE_DOCUMENTS and SAMPLE_CHARS.

    A first pass counts the ids of each language, so that about twice as many rows as are taken
    go to the window, whatever the number of tasks.
    """
    n = F.length("text")
    place = F.pmod(F.xxhash64("doc_id"), F.greatest(n - F.lit(SAMPLE_CHARS), F.lit(0)) + 1) + 1
    known = documents.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    key = F.xxhash64("doc_id", F.lit(3))
    counts = known.groupBy("lang").agg(F.approx_count_distinct(key).alias("ids")).collect()
    most = [
        (F.lit(row["lang"]), F.lit(least_hashes(row["ids"], SAMPLE_DOCUMENTS))) for row in counts
    ]
    if most:
        limits = F.create_map(*[column for pair in most for column in pair])
        known = known.filter(key <= F.try_element_at(limits, F.col("lang")))
    order = Window.partitionBy("lang").orderBy(key, "doc_id", "passage")
    return [
        (row["lang"], row["passage"])
        for row in known.select(
            "doc_id",
            "lang",
            F.substring("text", place.cast("int"), F.lit(SAMPLE_CHARS)).alias("passage"),
        )
        .withColumn("n", F.row_number().over(order))
        .filter(F.col("n") <= SAMPLE_DOCUMENTS)
        .orderBy("lang", "n")
        .collect()
    ]


def train(documents: DataFrame, steps: int = STEPS) -> Network | None:
    """A network fitted on the labelled rows of ``documents``; None if there is none to learn."""
    rows = [(lang, text.encode()) for lang, text in sample(documents)]
    languages = sorted({lang for lang, _ in rows})
    if not languages:
        return None
    network = Network(languages)
    words = Words([text for _, text in rows], SPACED)
    if not len(words):
        return network
    label = np.array([languages.index(lang) for lang, _ in rows])[words.doc]
    n = -(-(words.ends - words.starts) // PART)
    codes = _codes(words.buffer, *_parts(words.starts, words.ends))
    label = np.repeat(label, n)
    if len(np.unique(label)) < len(languages):  # a language of blank passages
        keep = np.unique(label)
        network = Network([languages[k] for k in keep])
        label = np.searchsorted(keep, label)
    return network.fit(codes, label, steps)


class _Known:
    """What a network says of runs, kept for runs that come again."""

    def __init__(self, network: Network):
        self.network, n = network, len(network.languages)
        self.hashes = np.empty(0, np.uint64)
        self.values = np.empty((0, 2 * n), "f4")

    def of(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """For the distinct runs: sums of probabilities and counts of labels; and the index of
        each run among them."""
        unique, first, index = np.unique(words.hashes, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.hashes, unique), max(0, len(self.hashes) - 1))
        new = self.hashes[at] != unique if len(self.hashes) else np.ones(len(unique), bool)
        values = np.empty((len(unique), self.values.shape[1]), "f4")
        values[~new] = self.values[at[~new]]
        if new.any():
            rows = first[new]
            values[new] = self._compute(words.buffer, words.starts[rows], words.ends[rows])
            if len(self.hashes) + new.sum() > CACHED_RUNS:
                self.hashes, self.values = unique, values
            else:
                hashes = np.concatenate([self.hashes, unique[new]])
                order = np.argsort(hashes)
                self.hashes = hashes[order]
                self.values = np.concatenate([self.values, values[new]])[order]
        return values, index

    def _compute(self, buffer, starts, ends) -> np.ndarray:
        owner = np.repeat(np.arange(len(starts)), -(-(ends - starts) // PART))
        starts, ends = _parts(starts, ends)
        n = len(self.network.languages)
        out = np.zeros((owner[-1] + 1, 2 * n), "f4")
        order = np.argsort(ends - starts, kind="stable")
        for some in np.array_split(order, max(1, len(order) // 4096)):
            codes = _codes(buffer, starts[some], ends[some])
            there = (codes < 256)[:, :, None]
            probabilities = self.network.positions(codes)
            best = probabilities.argmax(axis=2)[:, :, None] == np.arange(n)
            sums = np.concatenate(
                [(probabilities * there).sum(axis=0), (best & there).sum(axis=0)], axis=1
            )
            np.add.at(out, owner[some], sums)
        return out


def identify(documents: DataFrame, network: Network | None) -> DataFrame:
    """``doc_id, lang_pred, score, n_positions, labels`` of every row of ``documents``.

    ``score`` is the mean probability of the predicted language over all byte positions outside
    white space; ``labels`` counts the positions by their own label. A text that is null or has no
    letter is ``und`` with score 0, and so is every text if there is no network. Ties go to the
    first language by name. Rows with one doc_id are answered one by one; only ``doc_id`` and
    ``text`` are read.
    """
    languages = network.languages if network else []
    weights = [w.tobytes() for w in network.weights.values()] if network else []
    digest = hashlib.sha256(b"".join(weights)).hexdigest()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = kept(f"runs of {digest}", lambda: _Known(network)) if network else None
        for keys, texts in chunks(batches, READ_BYTES):
            n = len(texts)
            lettered = np.array([any(map(str.isalpha, t.decode())) for t in texts], dtype=bool)
            pooled = np.zeros((n, 2 * len(languages)))
            words = Words(texts, SPACED)
            if known and len(words):
                values, index = known.of(words)
                for k in range(2 * len(languages)):
                    pooled[:, k] = np.bincount(words.doc, values[index, k], minlength=n)
            size = np.bincount(words.doc, words.ends - words.starts, minlength=n)
            p, counts = pooled[:, : len(languages)], pooled[:, len(languages) :]
            best = p.argmax(axis=1) if languages else np.zeros(n, int)
            score = p[np.arange(n), best] / np.maximum(size, 1) if languages else np.zeros(n)
            ok = lettered & bool(languages)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int64()),
                    pa.array([languages[b] if o else UNKNOWN for b, o in zip(best, ok)]),
                    pa.array(np.where(ok, np.clip(score, 0, 1), 0.0)),
                    pa.array(size.astype(np.int64)),
                    pa.array(
                        [
                            ",".join(f"{lang}:{int(c)}" for lang, c in zip(languages, row) if c)
                            for row in counts
                        ]
                    ),
                ],
                names=["doc_id", "lang_pred", "score", "n_positions", "labels"],
            )

    return documents.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, lang_pred string, score double, n_positions bigint, labels string"
    )


def held_out():
    """Rows that are kept from learning. A null doc_id is taken as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2


def recognized(documents: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """``documents`` without those that are ``und`` or score below ``min_score``; all columns as
    they are. Rows that share a doc_id, or have none, are judged one by one."""
    network = train(documents.filter(~held_out()))
    row = F.xxhash64("doc_id", "text")
    rejected = materialize(
        identify(documents.select(row.alias("doc_id"), "text"), network)
        .filter((F.col("lang_pred") == UNKNOWN) | (F.col("score") < min_score))
        .select(F.col("doc_id").alias("_rejected"))
        .distinct(),
        "language-rejects",
    )
    return documents.join(rejected, row == F.col("_rejected"), "left_anti")


@query("op9_language_id_gru")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    network = train(documents.filter(~held_out()))
    found = identify(documents, network)
    return found.select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", "n_positions", "labels"
    )
