"""Packing of token sequences by the sum-of-squares rule.

Each document, or what is left of it after its full windows, goes to the fill level for which the
sum of squares of the counts of partly filled windows grows least. The counts are an array over
the fill levels; ties go to the fullest window.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from plumbline.llm.registry import query, table
from plumbline.llm.text import chunks, kept

CONTEXT = 2048
END_ID = 1
# A task closes its windows after so many tokens; its memory does not grow with its input.
ROUND_TOKENS = 1 << 22
# Pieces of text whose ids a worker remembers.
CACHED_PIECES = 500_000
# New pieces that are encoded as one text.
JOINED_PIECES = 200

Piece = tuple[int, int, int]  # document of the round, first id, number of ids


class Encoder:
    """Ids of texts. Texts are cut where no token can span, and equal pieces are encoded once.

    The cut is before a single blank or line break between two other characters: the tokenizer's
    own pattern starts a new pre-token there, and no look-ahead reaches across. So pieces that
    begin with such a character may stand one after another in any order: many new ones are
    encoded as one text, whose tokens are dealt out by the bytes they stand for.
    """

    _cut = re.compile(r"(?<=\S)(?=[ \n]\S)")
    _joinable = re.compile(r"[ \n]\S(?s:.*\S)?")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        special = {n: t.content for n, t in self._tokenizer.get_added_tokens_decoder().items()}
        # Byte-level tokens are written with a character for each byte.
        sizes = {n: len(t) for t, n in self._tokenizer.get_vocab().items()}
        sizes |= {n: len(content.encode()) for n, content in special.items()}
        self._bytes = np.zeros(max(sizes) + 1, dtype=np.int64)
        self._bytes[list(sizes)] = list(sizes.values())
        self._number = _Numbers()
        self._ids = np.empty(0, dtype="<u4")
        self._starts = self._sizes = self._used = np.empty(0, dtype=np.int64)

    def _forget(self) -> None:
        """Keep the pieces that were met more than once lately: no more than half, the most used.

        Words that a text has for itself go, and the frequent ones need not be encoded again.
        """
        keep = np.argsort(-self._used, kind="stable")[: CACHED_PIECES // 2]
        keep = np.sort(keep[self._used[keep] > 1])
        known = list(self._number)
        self._number = _Numbers()
        self._number.update((known[k], n) for n, k in enumerate(keep.tolist()))
        sizes, starts = self._sizes[keep], self._starts[keep]
        ends = np.cumsum(sizes)
        self._ids = self._ids[np.arange(sizes.sum()) + np.repeat(starts - (ends - sizes), sizes)]
        self._starts, self._sizes, self._used = ends - sizes, sizes, self._used[keep] // 2

    def _pieces(self, text: str) -> list[str]:
        # Regular texts have one blank or line break between words and no other white space.
        if "\0" in text or text.replace("\n", " ") != " ".join(text.split()):
            return self._cut.split(text)
        return text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, by one pass over the pieces of all."""
        split = [self._pieces(text) for text in texts]
        if len(self._number) > CACHED_PIECES:
            self._forget()
        pieces = np.array([len(own) for own in split])
        flat = np.fromiter(
            map(self._number.__getitem__, chain.from_iterable(split)), np.int64, int(pieces.sum())
        )
        del split
        self._learn(self._number.take_new())
        self._used += np.bincount(flat, minlength=len(self._used))
        sizes = self._sizes[flat]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = self._ids[np.arange(ends[-1]) + np.repeat(self._starts[flat] - ends[:-1], sizes)]
        cuts = ends[np.cumsum(pieces)]
        return np.split(ids, cuts[:-1])

    def _learn(self, pieces: list[str]) -> None:
        """Encode new pieces, which are numbered on from those that are known."""
        joinable = [bool(self._joinable.fullmatch(piece)) for piece in pieces]
        order = sorted(range(len(pieces)), key=joinable.__getitem__)
        single = len(pieces) - sum(joinable)
        parts = [self._one_by_one([pieces[k] for k in order[:single]])]
        for first in range(single, len(order), JOINED_PIECES):
            parts.append(self._joined([pieces[k] for k in order[first : first + JOINED_PIECES]]))
        sizes = np.concatenate([own for _, own in parts])
        new = np.empty((2, len(pieces)), dtype=np.int64)
        new[:, order] = len(self._ids) + np.cumsum(sizes) - sizes, sizes
        self._ids = np.concatenate([self._ids, *[ids for ids, _ in parts]])
        self._starts = np.concatenate([self._starts, new[0]])
        self._sizes = np.concatenate([self._sizes, new[1]])
        self._used = np.concatenate([self._used, np.zeros(len(pieces), dtype=np.int64)])

    def _one_by_one(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all the pieces, and how many each has."""
        encoded = self._tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        ids = [e.ids for e in encoded]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), "<u4", int(sizes.sum())), sizes

    def _joined(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``_one_by_one``, for joinable pieces: encoded as one text."""
        found = self._tokenizer.encode_batch_fast(["".join(pieces)], add_special_tokens=False)
        ids = np.array(found[0].ids, dtype="<u4")
        ends = np.cumsum(self._bytes[ids])
        piece_ends = np.cumsum([len(piece.encode()) for piece in pieces])
        cuts = np.searchsorted(ends, piece_ends) + 1
        if not np.array_equal(ends[np.minimum(cuts, len(ends)) - 1], piece_ends):
            return self._one_by_one(pieces)  # tokens that do not stand for their own bytes
        return ids, np.diff(cuts, prepend=0)


class _Numbers(dict):
    """Numbers texts in the order in which they are first asked for."""

    def __init__(self) -> None:
        super().__init__()
        self._new: list[str] = []

    def __missing__(self, text: str) -> int:
        number = self[text] = len(self)
        self._new.append(text)
        return number

    def take_new(self) -> list[str]:
        """Those numbered since the last call."""
        new, self._new = self._new, []
        return new


class Packer:
    """Windows of one capacity, filled online."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self._counts = np.zeros(capacity + 1, dtype=np.int64)
        self._open: list[list[list[Piece]]] = [[] for _ in range(capacity + 1)]
        self.full: list[list[Piece]] = []

    def add(self, doc: int, size: int) -> None:
        start = 0
        while size - start >= self.capacity:
            self.full.append([(doc, start, self.capacity)])
            start += self.capacity
        if start < size:
            self._place((doc, start, size - start))

    def _place(self, piece: Piece) -> None:
        size = piece[2]
        counts = self._counts
        grown = 2 * counts[size:] + 1
        grown[-1] = 0  # full windows don't count
        shrunk = 2 * counts[: self.capacity - size + 1] - 1
        cost = np.where(shrunk > 0, grown - shrunk, np.iinfo(np.int64).max)
        cost[0] = grown[0]  # a new window
        level = len(cost) - 1 - int(np.argmin(cost[::-1]))
        window = self._open[level].pop() if level else []
        if level:
            counts[level] -= 1
        window.append(piece)
        if level + size == self.capacity:
            self.full.append(window)
        else:
            counts[level + size] += 1
            self._open[level + size].append(window)

    def close(self) -> list[list[Piece]]:
        """All windows. The emptiest are cut to fill the fullest; of the one that is left, each
        power of two makes a sequence, which needs no padding."""
        rest = [window for level in reversed(self._open) for window in level]
        done, first, last = self.full, 0, len(rest) - 1
        fill = [sum(piece[2] for piece in window) for window in rest]
        while first < last:
            gap = self.capacity - fill[first]
            doc, start, size = rest[last].pop()
            taken = min(gap, size)
            rest[first].append((doc, start, taken))
            fill[first] += taken
            fill[last] -= taken
            if taken < size:
                rest[last].append((doc, start + taken, size - taken))
            if fill[first] == self.capacity:
                done.append(rest[first])
                first += 1
            if not fill[last]:
                last -= 1
        if first == last:
            done.extend(_powers_of_two(rest[first], fill[first]))
        self.__init__(self.capacity)
        return done


def _powers_of_two(window: list[Piece], fill: int) -> Iterator[list[Piece]]:
    pieces = window[::-1]
    for bit in reversed(range(fill.bit_length())):
        if not fill >> bit & 1:
            continue
        sequence, room = [], 1 << bit
        while room:
            doc, start, size = pieces.pop()
            taken = min(room, size)
            sequence.append((doc, start, taken))
            room -= taken
            if taken < size:
                pieces.append((doc, start + taken, size - taken))
        yield sequence


def pack(
    documents: DataFrame, tokenizer: str, context: int = CONTEXT, keep_ids: bool = True
) -> DataFrame:
    """One row per piece of a document: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset`` and, unless ``keep_ids`` is false, the piece's ``ids``.

    Each task packs its own rows, so nothing is shuffled; a task that is run again gives the same
    sequences. Null and empty texts are the end id alone; a text over the context fills whole
    windows first; rows with one doc_id are packed one by one; an empty table gives no rows.
    Only ``doc_id`` and ``text`` are read, whatever other columns there are.
    """
    fields = [
        ("doc_id", "bigint", pa.int64()),
        ("start", "bigint", pa.int64()),
        ("length", "bigint", pa.int64()),
        ("ids_crc32", "bigint", pa.int64()),
        ("doc_tokens", "bigint", pa.int64()),
        ("sequence_id", "bigint", pa.int64()),
        ("offset", "bigint", pa.int64()),
    ]
    if keep_ids:
        fields.append(("ids", "array<int>", pa.list_(pa.int32())))
    schema = pa.schema([(name, kind) for name, _, kind in fields])

    def sequences(docs: list[tuple[int, np.ndarray]], windows, base: int):
        columns: list[list] = [[] for _ in fields]
        for n, window in enumerate(windows):
            offset = 0
            for index, start, length in window:
                doc_id, ids = docs[index]
                piece = ids[start : start + length]
                row = [doc_id, start, length, zlib.crc32(piece.tobytes()), len(ids), base + n]
                row += [offset] + ([piece.astype(np.int32)] if keep_ids else [])
                for column, value in zip(columns, row, strict=True):
                    column.append(value)
                offset += length
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(f"ids of {tokenizer}", lambda: Encoder(tokenizer))
        packer = Packer(context)
        docs: list[tuple[int, np.ndarray]] = []
        held = 0
        next_id = TaskContext.get().partitionId() << 33
        end = np.array([END_ID], dtype="<u4")
        for keys, texts in chunks(batches):
            for doc_id, own in zip(keys, encoder.encode_all([t.decode() for t in texts]), strict=True):
                ids = np.concatenate([own, end])
                packer.add(len(docs), len(ids))
                docs.append((doc_id, ids))
                held += len(ids)
                if held >= ROUND_TOKENS:
                    windows = packer.close()
                    yield sequences(docs, windows, next_id)
                    next_id += len(windows)
                    docs, held = [], 0
        if docs:
            yield sequences(docs, packer.close(), next_id)

    return documents.select("doc_id", "text").mapInArrow(
        run, ", ".join(f"`{name}` {kind}" for name, kind, _ in fields)
    )


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op10_pack_sum_of_squares")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path(), keep_ids=False)
