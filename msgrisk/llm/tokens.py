"""Words of a batch of texts as Arrow and NumPy arrays, and keyed 64-bit hashes of byte strings.

A word is a run of bytes other than space and tab to carriage return, with A-Z lower-cased. A null text
has no words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once, so that memory does not follow the size of an Arrow batch.
PIECE_BYTES = 6 << 20
_BYTES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 2**64)


class Words(NamedTuple):
    """ids: word number of every token; starts: first token of each text, and the end; vocab: the words."""

    ids: np.ndarray
    starts: np.ndarray
    vocab: pa.Array


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that all bits depend on all bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def raw(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (n + 1, from 0) and bytes of a string or binary array without nulls."""
    if not len(array):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    offsets = np.frombuffer(array.buffers()[1], np.int64 if wide else np.int32)[array.offset:array.offset + len(array) + 1]
    data = array.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets.astype(np.int64) - int(offsets[0]), data[int(offsets[0]):int(offsets[-1])]


def hash64(array: pa.Array) -> np.ndarray:
    """A 64-bit hash of each entry, equal on every machine."""
    offsets, data = raw(array)
    if not len(data):
        return mix(np.zeros(len(array), np.uint64))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * powers(_BASE, len(data)), out=sums[1:])
    back = powers(_BASE_INVERSE, len(data) + 1)
    lengths = np.diff(offsets).astype(np.uint64)
    return mix((sums[offsets[1:]] - sums[offsets[:-1]]) * back[offsets[:-1]] + lengths)


def pieces(batches: Iterable[pa.RecordBatch], text_col: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about `limit` bytes of text each; one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False)
        group = (np.cumsum(sizes, dtype=np.int64) - sizes) // limit
        cuts = np.flatnonzero(np.diff(group)) + 1
        for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield batch.slice(int(start), int(end - start))


def words(texts: pa.Array, lower: bool = True) -> Words:
    """Words of each text, in order. With lower=False, A-Z stay as they are."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "")
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    starts = split.offsets.to_numpy().astype(np.int64)
    starts = starts - starts[0]
    coded = split.flatten().dictionary_encode()
    ids, vocab = coded.indices.to_numpy(), coded.dictionary.cast(pa.binary())
    blank = pc.index(vocab, pa.scalar(b"", pa.binary())).as_py()
    if blank >= 0:
        kept = ids != blank
        before = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(kept, out=before[1:])
        ids, starts = ids[kept], before[starts]
    return Words(ids, starts, vocab)


def tails(array: pa.Array, n: int) -> np.ndarray:
    """The last n bytes of each entry as one number, zero where the entry is shorter."""
    offsets, data = raw(array)
    out = np.zeros(len(array), np.uint64)
    for k in range(1, n + 1):
        at = offsets[1:] - k
        inside = at >= offsets[:-1]
        out[inside] |= data[at[inside]].astype(np.uint64) << np.uint64(8 * (k - 1))
    return out


def owners(starts: np.ndarray) -> np.ndarray:
    """The text number of every token."""
    return np.repeat(np.arange(len(starts) - 1), np.diff(starts))
