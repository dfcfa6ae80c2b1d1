"""Alignment of two tokenizers: which tokens of one cover the text of which tokens of the other.

Where tokens end is read from the spans that the libraries give, character offsets of the one and
byte spans of the other. These are coarse: tokens that share a character, and byte tokens, all
point at the whole character. Within such a character the decoded bytes of the tokens say where
each ends.

A text is cut before a single blank or line break between two other characters. No token of
either vocabulary goes across, so equal pieces are encoded and aligned once.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.registry import query, table
from plumbline.llm.text import chunks, joined, kept
from plumbline.session import materialize

# Pieces of text that a worker remembers, and how many are encoded as one text.
CACHED_PIECES = 600_000
JOINED_PIECES = 200
# Text that is aligned at once.
READ_BYTES = 1 << 20

BLANK = "▁"  # how the second vocabulary writes a blank
# Stands before joined pieces, so that each of them, the first too, has a character before it.
_ANCHOR = " a"


class Vocabulary:
    """Bytes of every token, joined, with their lengths."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = np.array(tokens, dtype=object)
        self.lengths = np.array([len(token) for token in tokens], dtype=np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(self.tokens[ids])


def _byte_level_alphabet() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte: printable Latin-1 ones for
    themselves, the others by the characters from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(others)}


@dataclass
class Tokens:
    """Tokens of one text: ids and the bytes at which they end."""

    ids: np.ndarray
    ends: np.ndarray


def _refined(coarse: np.ndarray, whole: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Ends in bytes: those of spans where a token ends with its character, and from the last such
    place on by decoded bytes where it does not."""
    sums = np.cumsum(lengths)
    last = np.maximum.accumulate(np.where(whole, np.arange(len(coarse)), -1))
    base = np.where(last >= 0, coarse[last] - sums[last], 0)
    return base + sums


class ByteLevel:
    """A byte-level vocabulary of the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True  # their strings are plain text
        byte_of = _byte_level_alphabet()
        found = self._tokenizer.get_vocab(with_added_tokens=True)
        tokens = [b""] * (max(found.values()) + 1)
        for token, number in found.items():
            known = all(c in byte_of for c in token)
            tokens[number] = bytes(byte_of[c] for c in token) if known else token.encode()
        self.vocabulary = Vocabulary(tokens)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(tokens.ids, dtype=np.int64) for tokens in found]

    def encode(self, text: str) -> Tokens:
        found = self._tokenizer.encode(text, add_special_tokens=False)
        ids = np.array(found.ids, dtype=np.int64)
        spans = np.fromiter(chain.from_iterable(found.offsets), np.int64, 2 * len(ids)).reshape(-1, 2)
        points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
        width = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        begins = np.concatenate([[0], np.cumsum(width)])
        # A token is whole if the next one begins with another character.
        whole = np.append(spans[1:, 0] >= spans[:-1, 1], True) if len(ids) else np.empty(0, bool)
        return Tokens(ids, _refined(begins[spans[:, 1]], whole, self.vocabulary.lengths[ids]))


class Pieces:
    """A sentencepiece vocabulary with byte fallback, which puts a blank before a text."""

    def __init__(self, path: str):
        import sentencepiece

        self._processor = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self._processor.vocab_size()
        names = [self._processor.id_to_piece(k) for k in range(size)]
        is_byte = [self._processor.is_byte(k) for k in range(size)]
        self.vocabulary = Vocabulary(
            [
                bytes([int(name[3:5], 16)]) if byte else name.replace(BLANK, " ").encode()
                for name, byte in zip(names, is_byte, strict=True)
            ]
        )
        if any(BLANK in name.lstrip(BLANK) or "\n" in name for name in names):
            raise ValueError("the vocabulary has tokens over more than one word")

    def encode(self, text: str) -> Tokens:
        """Of a text that begins with a blank, which the model adds itself."""
        found = self._processor.encode(text[1:], return_type="proto").pieces
        flat = [value for p in found for value in (p.id, p.begin, p.end)]
        table = np.array(flat, dtype=np.int64).reshape(-1, 3)
        ids, begins, ends = table.T
        # Of the byte tokens of a character only the last one has a span.
        return Tokens(ids, _refined(ends + 1, ends > begins, self.vocabulary.lengths[ids]))


@dataclass
class Learned:
    """Some pieces as tokens of both sides: for each piece how many tokens, groups and links, the
    groups as text, and its links one after another."""

    counts: np.ndarray  # pieces x (first tokens, second tokens, groups, links)
    groups: list[bytes | None]  # None: the tokens of the piece do not give its bytes back
    links: np.ndarray  # first id << 32 | second id


class Aligner:
    """Pieces of texts as tokens of both vocabularies, each aligned once."""

    def __init__(self, first: str, second: str):
        self._first, self._second = ByteLevel(first), Pieces(second)
        top = max(len(v.vocabulary.tokens) for v in (self._first, self._second))
        self._decimal = np.array([str(k) for k in range(top)], dtype=object)
        self.clear()

    _irregular = re.compile(r"[ \n]{2}|[^\S \n]|\x00")
    _cut = re.compile(r"(?<=\S)(?=[ \n]\S)")
    _joinable = re.compile(r"[ \n]\S(?s:.*\S)?")

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.groups: list[bytes | None] = []
        self._parts: list[Learned] = []
        self.counts = np.empty((0, 4), dtype=np.int64)
        self.links = np.empty(0, dtype=np.int64)
        self.bounds = np.zeros(1, dtype=np.int64)

    def pieces(self, text: str) -> list[str]:
        """A blank and the text, cut where no token goes across."""
        text = f" {text}"
        if self._irregular.search(text) or text == " ":
            return self._cut.split(text)
        return text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")[1:]

    def learn(self, pieces: Iterable[str]) -> None:
        missing = [piece for piece in pieces if piece not in self.number]
        joinable = [piece for piece in missing if self._joinable.fullmatch(piece)]
        known = set(joinable)
        for first in range(0, len(joinable), JOINED_PIECES):
            self._add(joinable[first : first + JOINED_PIECES])
        for piece in missing:
            if piece not in known:
                self._add([piece])
        if self._parts:
            self.counts = np.concatenate([self.counts, *[part.counts for part in self._parts]])
            self.links = np.concatenate([self.links, *[part.links for part in self._parts]])
            self.bounds = np.concatenate([[0], np.cumsum(self.counts[:, 3])])
            self._parts = []

    def _add(self, pieces: list[str]) -> None:
        learned = self._aligned(pieces)
        if learned is None and len(pieces) > 1:
            for piece in pieces:
                self._add([piece])
            return
        if learned is None:
            learned = Learned(np.zeros((1, 4), dtype=np.int64), [None], np.empty(0, dtype=np.int64))
        for piece in pieces:
            self.number[piece] = len(self.number)
        self.groups += learned.groups
        self._parts.append(learned)

    def _aligned(self, pieces: list[str]) -> Learned | None:
        """The pieces as tokens of both sides; None if these do not give the bytes back."""
        text = _ANCHOR + "".join(pieces)
        sizes = np.array([len(piece.encode()) for piece in pieces])
        piece_ends = len(_ANCHOR) + np.cumsum(sizes)
        sides = []
        for side in (self._first, self._second):
            found = side.encode(text)
            if side.vocabulary.decode(found.ids) != text.encode():
                return None
            own = found.ends > len(_ANCHOR)
            sides.append(Tokens(found.ids[own], found.ends[own]))
        a, b = sides
        ends = np.intersect1d(a.ends, b.ends, assume_unique=True)
        counts = np.empty((len(pieces), 4), dtype=np.int64)
        for k, places in enumerate((a.ends, b.ends, ends)):
            counts[:, k] = np.diff(np.searchsorted(places, piece_ends, side="right"), prepend=0)
        a_starts, b_starts = (np.concatenate([[len(_ANCHOR)], s.ends[:-1]]) for s in sides)
        # The tokens of the other side that overlap each token are neighbours.
        low = np.searchsorted(b.ends, a_starts, side="right")
        overlaps = np.searchsorted(b_starts, a.ends, side="left") - low
        of_a = np.repeat(np.arange(len(a.ids)), overlaps)
        of_b = np.arange(len(of_a)) - np.repeat(np.cumsum(overlaps) - overlaps, overlaps)
        of_b += low[of_a]
        counts[:, 3] = np.bincount(
            np.searchsorted(piece_ends, a.ends[of_a], side="left"), minlength=len(pieces)
        )
        return Learned(counts, self._texts(a, b, ends, piece_ends), a.ids[of_a] << 32 | b.ids[of_b])

    def _texts(self, a: Tokens, b: Tokens, ends: np.ndarray, piece_ends: np.ndarray) -> list[bytes]:
        """The groups of each piece as ``first ids|second ids``, joined by semicolons."""
        group = np.searchsorted(ends, np.concatenate([a.ends, b.ends]), side="left")
        side = np.repeat([0, 1], [len(a.ids), len(b.ids)])
        order = np.lexsort((side, group))
        group, side = group[order], side[order]
        marks = np.where(group[1:] != group[:-1], ";", np.where(side[1:] != side[:-1], "|", ","))
        parts = np.empty(2 * len(order), dtype=object)
        parts[0::2] = self._decimal[np.concatenate([a.ids, b.ids])[order]]
        parts[1:-1:2] = marks
        parts = parts.tolist()
        stops = np.searchsorted(ends[group], piece_ends, side="right").tolist()
        return [
            "".join(parts[2 * first : 2 * last - 1]).encode()
            for first, last in zip([0, *stops], stops, strict=False)
        ]


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the values between bounds, which may be equal."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[bounds])


def _chunk(aligner: Aligner, texts: list[bytes], with_groups: bool) -> dict[str, np.ndarray | list]:
    """What is known of some documents by themselves, and which pairs are linked in which."""
    split = [[] if t == b"" or BLANK in (s := t.decode()) else aligner.pieces(s) for t in texts]
    if len(aligner.number) > CACHED_PIECES:
        aligner.clear()
    aligner.learn(dict.fromkeys(chain.from_iterable(split)))
    numbers = [np.fromiter(map(aligner.number.__getitem__, own), np.int64, len(own)) for own in split]
    groups, digests = [], []
    for k, own in enumerate(numbers):
        parts = [aligner.groups[n] for n in own.tolist()]
        if None in parts:
            numbers[k], parts = own[:0], []
        joined = b";".join(parts)
        digests.append(hashlib.sha256(joined).hexdigest() if parts else "")
        groups.append(joined.decode() if with_groups else None)
    flat = np.concatenate([*numbers, np.empty(0, dtype=np.int64)])
    bounds = np.concatenate([[0], np.cumsum([len(own) for own in numbers])])
    counts = aligner.counts[flat]
    # Each document's pieces once, and then its pairs.
    doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
    once, times = np.unique(doc << 32 | flat, return_counts=True)
    doc, piece = once >> 32, once & 0xFFFFFFFF
    width = aligner.counts[piece, 3]
    at = np.arange(int(width.sum())) - np.repeat(np.cumsum(width) - width, width)
    links = aligner.links[at + np.repeat(aligner.bounds[piece], width)]
    pairs, number = np.unique(links, return_inverse=True)
    keys, first = np.unique(np.repeat(doc, width) << 32 | number, return_inverse=True)
    occurring = np.bincount(first, weights=np.repeat(times, width), minlength=len(keys))
    return {
        **{name: _sums(counts[:, k], bounds) for k, name in enumerate(("n_a", "n_b", "n_groups", "n_links"))},
        "groups_sha256": digests,
        "groups": groups,
        "pair": pairs,
        "held": np.bincount(keys & 0xFFFFFFFF, minlength=len(pairs)),
        "bounds": np.searchsorted(keys >> 32, np.arange(len(texts) + 1)),
        "link": keys & 0xFFFFFFFF,
        "times": occurring.astype(np.int64),
    }


# What is known of a document by itself: numbers and texts, and the pairs of its chunk that it holds,
# as their places there and how often it holds each, in 32 bits each.
_SHOWN = {
    "doc_id": pa.int64(),
    "n_a": pa.int64(),
    "n_b": pa.int64(),
    "n_groups": pa.int64(),
    "n_links": pa.int64(),
    "groups_sha256": pa.string(),
    "groups": pa.string(),
}
_HELD = {"link": pa.binary(), "times": pa.binary()}
# And of a pair of a chunk: its place, its ids and how many of the chunk's documents hold it.
_PAIR = {"place": pa.int32(), "pair": pa.int64(), "held": pa.int64()}
_KINDS = {"chunk": pa.int64(), **_SHOWN, **_HELD, **_PAIR}
_SQL_KINDS = {pa.int64(): "bigint", pa.int32(): "int", pa.string(): "string", pa.binary(): "binary"}


def _parts(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The numbers between bounds, in 32 bits each, as bytes."""
    offsets = (4 * bounds).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values.astype("<i4"))]
    )


def aligned_chunks(documents: DataFrame, first: str, second: str, with_groups: bool) -> DataFrame:
    """Rows of chunks, some text that is aligned at once: one row for each document, with what it
    holds of its chunk's pairs of ids, and one for each of these pairs, where ``pair`` is not null.

    A row is no longer than its document, so what holds many rows at once, as a writer of files and
    their reader do, holds no chunks.
    """
    schema = pa.schema(list(_KINDS.items()))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = kept(f"alignment of {first} and {second}", lambda: Aligner(first, second))
        number = TaskContext.get().partitionId() << 33

        def rows(n: int, columns: dict[str, pa.Array]) -> pa.RecordBatch:
            columns = {"chunk": pa.array(np.full(n, number)), **columns}
            arrays = [columns[name] if name in columns else pa.nulls(n, kind) for name, kind in _KINDS.items()]
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        for batch in batches:  # a batch bounds the rows, a chunk the bytes
            for keys, texts in chunks([batch], READ_BYTES):
                found = {"doc_id": keys, **_chunk(aligner, texts, with_groups)}
                own = {name: pa.array(found[name], kind) for name, kind in _SHOWN.items()}
                held = {name: _parts(found[name], found["bounds"]) for name in _HELD}
                yield rows(len(keys), own | held)
                pairs = {"place": np.arange(len(found["pair"])), "pair": found["pair"], "held": found["held"]}
                yield rows(len(found["pair"]), {name: pa.array(pairs[name], kind) for name, kind in _PAIR.items()})
                number += 1

    fields = ", ".join(f"{name} {_SQL_KINDS[kind]}" for name, kind in _KINDS.items())
    return documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, fields)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``a_id``, ``b_id``, the number of documents that hold them linked (``documents``), and
    whether no other id is linked with ``a_id`` in more (``best``).

    An id has no more partners than the second vocabulary has tokens, which bounds the window.
    """
    counted = aligned.filter("pair is not null").groupBy("pair").agg(F.sum("held").alias("documents"))
    own = Window.partitionBy("a_id")
    return counted.select(
        F.shiftright("pair", 32).alias("a_id"),
        F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b_id"),
        "documents",
    ).withColumn("best", F.col("documents") == F.max("documents").over(own))


def _with_counts(aligned: DataFrame, with_groups: bool) -> DataFrame:
    """A row per document, with the sums over its links."""
    counts = pair_counts(aligned).select(
        (F.shiftleft("a_id", 32) + F.col("b_id")).alias("pair"), "documents", "best"
    )
    pairs = aligned.filter("pair is not null").select("chunk", "place", "pair")
    known = pairs.join(counts, "pair").select("chunk", "place", "documents", "best")
    shown = [name for name in _SHOWN if with_groups or name != "groups"]
    fields = [*[(name, _SHOWN[name]) for name in shown], ("n_best", pa.int64()), ("count_sum", pa.int64())]
    schema = pa.schema(fields)

    def summed(chunk: pa.Table, known: pa.Table) -> pa.Table:
        link, times = (chunk.column(name).combine_chunks() for name in _HELD)
        bounds = np.concatenate([[0], np.cumsum(np.array(pc.binary_length(link), np.int64) // 4)])
        link, times = (np.frombuffer(joined(side), "<i4") for side in (link, times))
        values = np.zeros((2, known.num_rows), dtype=np.int64)
        place = known.column("place").to_numpy()
        values[0, place] = known.column("best").to_numpy()
        values[1, place] = known.column("documents").to_numpy()
        sums = [pa.array(_sums(side[link] * times, bounds)) for side in values]
        columns = [chunk.column(name).combine_chunks() for name in shown]
        return pa.Table.from_arrays([*columns, *sums], schema=schema)

    sides = (
        aligned.filter("pair is null").select("chunk", *shown, *_HELD).groupBy("chunk"),
        known.withColumnRenamed("chunk", "of_chunk").groupBy("of_chunk"),
    )
    return sides[0].cogroup(sides[1]).applyInArrow(
        summed, ", ".join(f"{name} {_SQL_KINDS[kind]}" for name, kind in fields)
    )


def align(documents: DataFrame, first: str, second: str, with_groups: bool = False) -> DataFrame:
    """One row per document: how its tokens by the byte-level vocabulary ``first`` and by the
    sentencepiece vocabulary ``second`` cover each other.

    Both encode a blank and the text. Where tokens of both end, these are cut into groups; tokens
    whose bytes overlap are linked. ``n_best`` counts the links whose pair of ids is linked in as
    many documents of the table as any pair of the same first id, ``count_sum`` sums these numbers.
    ``groups_sha256`` is the digest of the groups as text, ``a1,a2|b1;a3|b2,b3``; ``with_groups``
    adds that text as ``groups``.

    Texts are encoded and aligned once, in their tasks, and written with their pairs. These are
    counted in each chunk of a megabyte before the shuffle, and the counts come back to the
    chunk and not to each document. Memory follows the chunk, or the longest text.

    Null and empty texts, and those whose tokens on either side do not give the blank and the text
    back (as those that hold U+2581, which reads as a blank), have no tokens: zeros and an empty
    digest. Rows with one doc_id, or none, count one by one; an empty table gives no rows; columns
    besides ``doc_id`` and ``text`` are not read.
    """
    aligned = materialize(aligned_chunks(documents, first, second, with_groups), "aligned")
    return _with_counts(aligned, with_groups)


def tokenizer_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@query("op11_tokenizer_alignment_spans")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"), *tokenizer_paths())
