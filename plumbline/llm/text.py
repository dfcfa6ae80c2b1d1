"""Words of texts as arrays: found, hashed and counted without a loop over the words."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15 | 1
_SEED = 20_011
_MASK = (1 << 64) - 1

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Bytes of a word, after lower-casing: all but ASCII white space.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
# Bytes of a word, after lower-casing: ASCII digits and letters, and all of other scripts.
PLAIN = np.zeros(256, dtype=bool)
PLAIN[0x30:0x3A] = PLAIN[0x61:0x7B] = PLAIN[0x80:] = True

CHUNK_BYTES = 4 << 20


def kept(name: str, make: Callable[[], object]) -> object:
    """An object that a Python worker keeps from task to task; ``name`` says what it is made of.

    Functions sent by value have globals of their own in each task, so it hangs on a module.
    """
    holder = sys.modules.setdefault("_plumbline_kept", ModuleType("_plumbline_kept"))
    if getattr(holder, "name", None) != name:
        holder.name = holder.value = None  # goes before the new one comes
        holder.value = make()
        holder.name = name
    return holder.value


def chunks(
    batches: Iterable[pa.RecordBatch], limit: int = CHUNK_BYTES
) -> Iterator[tuple[list, list[bytes]]]:
    """Ids and texts (null: empty) of some rows at a time, bounded by bytes of text.

    A text longer than the limit makes a chunk of its own; no text is cut.
    """
    ids: list = []
    texts: list[bytes] = []
    size = 0
    for batch in batches:
        for key, text in zip(
            batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True
        ):
            text = text or b""
            if ids and size + len(text) > limit:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(key)
            texts.append(text)
            size += len(text)
    if ids:
        yield ids, texts


def joined(stored: pa.BinaryArray) -> memoryview:
    """All bytes of an array without nulls."""
    if not len(stored):
        return memoryview(b"")
    offsets = np.frombuffer(stored.buffers()[1], np.int32)[stored.offset : stored.offset + len(stored) + 1]
    return memoryview(stored.buffers()[2] or b"")[int(offsets[0]) : int(offsets[-1])]


class Words:
    """The words of some texts, in order: ``hashes`` (64 bits), ``doc`` (index of the text)."""

    def __init__(self, texts: list[bytes], kind: np.ndarray):
        buffer = LOWER[np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)]
        inside = np.concatenate([[False], kind[buffer], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.buffer, self.starts, self.ends = buffer, edges[0::2], edges[1::2]
        begins = np.concatenate([[0], np.cumsum([len(text) + 1 for text in texts])[:-1]])
        self.doc = np.searchsorted(begins, self.starts, side="right") - 1
        self.hashes = _hash_ranges(buffer, self.starts, self.ends)

    def __len__(self) -> int:
        return len(self.starts)

    def bounds(self, n_texts: int) -> np.ndarray:
        """Where the words of each text begin; one more entry for the end."""
        return np.searchsorted(self.doc, np.arange(n_texts + 1))


def _random_words(seed: int, n: int) -> np.ndarray:
    state = np.random.RandomState(seed)
    return state.randint(0, 1 << 32, n, dtype=np.uint64) << np.uint64(32) | state.randint(
        0, 1 << 32, n, dtype=np.uint64
    )


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _hash_ranges(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes of ranges, from running sums."""
    powers = np.full(len(buffer) + 1, _BASE, dtype=np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers)
    inverse = np.full(len(buffer) + 1, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
    inverse[0] = 1
    inverse = np.cumprod(inverse)
    sums = np.zeros(len(buffer) + 1, dtype=np.uint64)
    np.cumsum(_random_words(_SEED, 256)[buffer] * powers[:-1], out=sums[1:])
    values = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(values + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
