"""Words of many texts at once, as numpy arrays; used inside tasks.

A word is a maximal run of ASCII letters, ASCII digits and characters beyond ASCII, in lower case.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_BYTE = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64)
_P = np.uint64(0x9E3779B97F4A7C15)
# Longer words are hashed one by one.
_STEPS = 48
CHUNK_BYTES = 2_000_000
# Texts of a chunk, so that their numbers fit into 16 bits.
CHUNK_TEXTS = 1 << 15


class Words(NamedTuple):
    doc: np.ndarray  # index of the text, ascending
    start: np.ndarray  # byte offsets into `data`
    end: np.ndarray
    hash: np.ndarray
    prefix: dict[int, np.ndarray]  # hash of the first k bytes; of the whole word if it is shorter
    data: np.ndarray
    offset: np.ndarray  # where each text starts in `data`, and where the last one ends


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def folded(text: str | None) -> str:
    """Lower case, character by character, so that offsets stay."""
    low = (text or "").lower()
    if len(low) != len(text or ""):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    return low


def chunks(batch: pa.RecordBatch, column: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batch with about `most` bytes of text and a bounded number of texts; a longer text is alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    at, room = 0, 0
    for i, n in enumerate(sizes):
        if i > at and (room + n > most or i - at >= CHUNK_TEXTS):
            yield batch.slice(at, i - at)
            at, room = i, 0
        room += int(n) + 1
    if at < batch.num_rows:
        yield batch.slice(at)


def words_of(texts: list[str | None], prefixes: tuple[int, ...] = ()) -> Words:
    parts = [folded(t).encode("utf-8", "replace") for t in texts]
    offset = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=offset[1:])
    data = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8) if parts else np.zeros(0, np.uint8)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = _IS_WORD[data]
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    doc = np.searchsorted(offset, start, side="right") - 1
    hashes, prefix = _hashes(data, start, end, prefixes)
    return Words(doc, start, end, hashes, prefix, data, offset)


def _hashes(data, start, end, prefixes):
    length = end - start
    # Longest first, so that each step works on a leading slice.
    order = np.argsort((_STEPS - np.minimum(length, _STEPS)).astype(np.uint8), kind="stable")
    first, size = start[order], length[order]
    h = np.full(len(start), 7, np.uint64)
    kept = {}
    live = np.searchsorted(-np.minimum(size, _STEPS), -np.arange(_STEPS), side="left")
    for step in range(_STEPS):
        n = live[step]
        if n:
            h[:n] = h[:n] * _P + _BYTE[data[first[:n] + step]]
        if step + 1 in prefixes:
            kept[step + 1] = h.copy()
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    h = mixed(h)[back]
    for i in np.flatnonzero(length > _STEPS):
        h[i] = xxhash.xxh64_intdigest(data[start[i] : end[i]].tobytes())
    return h, {k: mixed(v)[back] for k, v in kept.items()}


def joined(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n words in a row."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = hashes[: len(hashes) - n + 1].copy()
    for k in range(1, n):
        out = out * _P + hashes[k : len(hashes) - n + 1 + k]
    return mixed(out)


def shingles(words: Words, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of all runs of n words, in order; a text of fewer words has one, of all its words."""
    h = joined(words.hash, n)
    doc = words.doc[: len(h)]
    whole = doc == words.doc[n - 1 : n - 1 + len(h)]
    doc, h = doc[whole], h[whole]
    count = np.bincount(words.doc, minlength=len(words.offset) - 1)
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        first = np.searchsorted(words.doc, short)
        extra = np.array([joined(words.hash[a : a + count[d]], count[d])[0] for a, d in zip(first, short)], np.uint64)
        at = np.searchsorted(doc, short)
        doc, h = np.insert(doc, at, short), np.insert(h, at, extra)
    return doc, h


def list_column(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
