"""Texts as sets of five-word shingles: sketches that find similar sets, and the sets themselves.

Words are as in op6: runs without ASCII white space, A-Z in lower case. A text of fewer than five
words, but not none, has one shingle; a text without words has none.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from plumbline.llm.text import SPACED, Words, chunks, mix

SHINGLE = 5
# Two sets of similarity s agree in a band with probability s ** ROWS, so that at 0.8 all bands
# differ for one pair in 580.
BANDS, ROWS = 16, 5
# Bytes of text that are looked at together.
READ_BYTES = 1 << 20

_STEP = np.uint64(0x9E3779B97F4A7C15)
_random = np.random.RandomState(11)
_MASKS, _FACTORS = (
    _random.randint(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for _ in range(2)
)


def hashes_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, Words]:
    """(shingles, bounds, words): the hashes of all shingles, repeats included, and where those of
    each text begin."""
    words = Words(texts, SPACED)
    bounds = words.bounds(len(texts))
    counts = np.diff(bounds)
    n = np.maximum(np.minimum(counts, 1), counts - SHINGLE + 1)
    ends = np.concatenate([[0], np.cumsum(n)])
    doc = np.repeat(np.arange(len(texts)), n)
    first = bounds[doc] + np.arange(ends[-1]) - ends[doc]
    last = np.minimum(first + SHINGLE, bounds[doc + 1])
    value = (last - first).astype(np.uint64)
    for k in range(SHINGLE):
        at = first + k
        inside = at < last
        word = words.hashes[np.where(inside, at, 0)] if len(words) else np.empty(0, np.uint64)
        value = np.where(inside, mix(value * _STEP + word), value)
    return value, ends, words


def _per_text(values: np.ndarray, bounds: np.ndarray, ufunc: np.ufunc, dtype) -> np.ndarray:
    """``ufunc`` over the values of each text, and 0 for texts without any."""
    result = np.zeros((len(bounds) - 1, *values.shape[1:]), dtype=dtype)
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        result[some] = ufunc.reduceat(values, bounds[some], axis=0, dtype=dtype)
    return result


def sketch(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nodes, bits, bands) of some texts: a hash of the word sequence, the fingerprint of the
    shingles, and the keys of the bands, a row for each text."""
    shingles, bounds, words = hashes_of(texts)
    sequence = words.bounds(len(texts))
    place = (np.arange(len(words)) - sequence[words.doc]).astype(np.uint64)
    nodes = mix(
        _per_text(mix(words.hashes ^ mix(place + _STEP)), sequence, np.add, np.uint64)
        + np.diff(sequence).astype(np.uint64) * _STEP
    )
    n = np.diff(bounds)
    fingerprints = np.zeros(len(texts), dtype=np.uint64)
    for byte in range(8):
        part = ((shingles >> np.uint64(8 * byte)) & np.uint64(255)).astype(np.uint8)
        bits = np.unpackbits(part[:, None], axis=1, bitorder="little")
        full = 2 * _per_text(bits, bounds, np.add, np.int64) > n[:, None]
        packed = np.packbits(full, axis=1, bitorder="little")[:, 0].astype(np.uint64)
        fingerprints |= packed << np.uint64(8 * byte)
    bands = np.empty((len(texts), BANDS), dtype=np.uint64)
    for band in range(BANDS):
        key = np.full(len(texts), band + 1, dtype=np.uint64)
        for k in range(band * ROWS, (band + 1) * ROWS):
            least = _per_text((shingles ^ _MASKS[k]) * _FACTORS[k], bounds, np.minimum, np.uint64)
            key = mix(key * _STEP + least)
        bands[:, band] = key
    return nodes, fingerprints, bands


def sketches(rows: DataFrame) -> DataFrame:
    """(key, node, bits, bands) for (key: bigint, text); texts without words have no bands."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in chunks(batches, READ_BYTES):
            nodes, bits, bands = sketch(texts)
            some = [bool(text.split()) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int64()),
                    pa.array(nodes.view(np.int64)),
                    pa.array(bits.view(np.int64)),
                    pa.array(
                        [b if s else [] for b, s in zip(bands.view(np.int64), some, strict=True)],
                        pa.list_(pa.int64()),
                    ),
                ],
                names=["key", "node", "bits", "bands"],
            )

    return rows.select("key", "text").mapInArrow(
        run, "key bigint, node bigint, bits bigint, bands array<bigint>"
    )


def sets(rows: DataFrame) -> DataFrame:
    """(key, shingles) for (key: bigint, text): the different shingles, as 64-bit hashes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in chunks(batches, READ_BYTES):
            values, bounds, _ = hashes_of(texts)
            values = values.view(np.int64)
            found = [np.unique(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(found, pa.list_(pa.int64()))],
                names=["key", "shingles"],
            )

    return rows.select("key", "text").mapInArrow(run, "key bigint, shingles array<bigint>")
