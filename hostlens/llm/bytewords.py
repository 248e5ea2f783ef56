"""Words of many texts at once, as numpy arrays over their UTF-8 bytes."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Kinds of bytes: part of a word, between words, and between words that no phrase may span.
INSIDE, BLANK, CUT = 0, 1, 2

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_kinds(blank: bytes, cut: bytes) -> np.ndarray:
    kinds = np.full(256, INSIDE, np.uint8)
    kinds[np.frombuffer(blank, np.uint8)] = BLANK
    kinds[np.frombuffer(cut, np.uint8)] = CUT
    return kinds


class Words(NamedTuple):
    ids: np.ndarray  # of each word, its place in ``words``
    words: pa.Array  # the distinct words (binary), A-Z lower-cased
    piece: np.ndarray  # of each word, a number that changes at every cut
    start: np.ndarray  # of each word, its first byte in the joined texts


def split_words(texts: list[bytes], kinds: np.ndarray) -> Words:
    """The words of ``texts``, which are joined by one line feed each."""
    data = LOWER[np.frombuffer(b"\n".join(texts), np.uint8)]
    kind = kinds[data]
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = kind == INSIDE
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.zeros(len(start) + 1, np.int32)
    np.cumsum(end - start, out=offsets[1:])
    packed = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[kind == INSIDE]))])
    coded = packed.dictionary_encode()
    piece = np.cumsum(kind == CUT, dtype=np.int32)[start] if len(start) else np.zeros(0, np.int32)
    return Words(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary, piece, start)


def byte_rows(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]
