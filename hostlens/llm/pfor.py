"""A binary file of token ids in patched frame-of-reference blocks.

A block holds up to 4096 ids: its minimum is subtracted, the differences are packed at the width that a
percentile of them fits into, and the larger ones (exceptions) are listed apart by place and upper bits.

File, little-endian: magic, n_ids, n_blocks, n_docs (u64 each); the start of each block, and of the end
of the last (u64); doc_id, length of each document (i64 each); the blocks. Block: n (u32), minimum (u32),
width (u8), width of an exception's upper bits (u8), n_exceptions (u16), the packed ids, the exceptions'
places (u16), their packed upper bits.
"""

from __future__ import annotations

import struct
from functools import lru_cache

import numpy as np

MAGIC, BLOCK = 0x31524F464B4F54, 4096


@lru_cache(256)
def _places(n: int, width: int) -> tuple[np.ndarray, ...]:
    """For n values of a width: the 64-bit word and the bit where each starts, and the first value of each word."""
    at = np.arange(n) * width
    return at >> 6, (at & 63).astype(np.uint64), np.flatnonzero(np.diff(at >> 6, prepend=-1))


def pack_bits(values: np.ndarray, width: int) -> bytes:
    """Non-negative ints, ``width`` bits each (32 at most), lowest bit first."""
    if not width or not len(values):
        return b""
    word, bit, first = _places(len(values), width)
    v = values.astype(np.uint64)
    out = np.zeros(int(word[-1]) + 2, np.uint64)
    out[:-1] = np.bitwise_or.reduceat(v << bit, first)
    over = np.flatnonzero(bit + np.uint64(width) > 64)
    out[word[over] + 1] |= v[over] >> (np.uint64(64) - bit[over])
    return out.astype("<u8").tobytes()[: -(-len(values) * width // 8)]


def unpack_bits(data: bytes, n: int, width: int) -> np.ndarray:
    if not width or not n:
        return np.zeros(n, np.int64)
    word, bit, _ = _places(n, width)
    words = np.frombuffer(bytes(data[: -(-n * width // 8)]).ljust(8 * (int(word[-1]) + 2), b"\0"), "<u8")
    high = np.where(bit > 0, words[word + 1] << (np.uint64(64) - np.maximum(bit, np.uint64(1))), np.uint64(0))
    return (((words[word] >> bit) | high) & np.uint64((1 << width) - 1)).astype(np.int64)


def encode_block(ids: np.ndarray, percentile: float = 90.0) -> bytes:
    low = int(ids.min())
    rest = ids.astype(np.int64) - low
    k = min(len(rest) - 1, int(len(rest) * percentile / 100))
    width = int(np.partition(rest, k)[k]).bit_length()
    out = np.flatnonzero(rest >> width)
    upper = int(rest.max() >> width).bit_length()
    head = struct.pack("<IIBBH", len(rest), low, width, upper, len(out))
    return head + pack_bits(rest & ((1 << width) - 1), width) + out.astype("<u2").tobytes() + pack_bits(rest[out] >> width, upper)


def decode_block(data: memoryview) -> np.ndarray:
    n, low, width, upper, n_out = struct.unpack_from("<IIBBH", data)
    a = 12 + -(-n * width // 8)
    ids = unpack_bits(data[12:a], n, width)
    if n_out:
        out = np.frombuffer(data[a : a + 2 * n_out], "<u2")
        ids[out] |= unpack_bits(data[a + 2 * n_out :], n_out, upper) << width
    return ids + low


def encode_file(ids: np.ndarray, doc_ids: np.ndarray, lengths: np.ndarray, percentile: float = 90.0) -> bytes:
    blocks = [encode_block(ids[i : i + BLOCK], percentile) for i in range(0, len(ids), BLOCK)]
    starts = np.concatenate([[0], np.cumsum([len(b) for b in blocks])]) + 32 + 8 * (len(blocks) + 1) + 16 * len(doc_ids)
    head = struct.pack("<QQQQ", MAGIC, len(ids), len(blocks), len(doc_ids))
    return b"".join([head, starts.astype("<u8").tobytes(), doc_ids.astype("<i8").tobytes(), lengths.astype("<i8").tobytes(), *blocks])


def decode_file(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, doc_ids, lengths."""
    view = memoryview(data)
    magic, n_ids, n_blocks, n_docs = struct.unpack_from("<QQQQ", view)
    if magic != MAGIC:
        raise ValueError("not a file of token ids")
    at = 32 + 8 * (n_blocks + 1)
    starts = np.frombuffer(view[32:at], "<u8").astype(np.int64)
    doc_ids, lengths = (np.frombuffer(view[at + 8 * n_docs * k : at + 8 * n_docs * (k + 1)], "<i8") for k in (0, 1))
    ids = np.concatenate([decode_block(view[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)] or [np.zeros(0, np.int64)])
    if len(ids) != n_ids or lengths.sum() != n_ids:
        raise ValueError("a file of token ids is damaged")
    return ids.astype(np.uint32), doc_ids, lengths


def read_block(data: bytes, k: int) -> np.ndarray:
    """One block by the index, without the others."""
    start, end = struct.unpack_from("<QQ", data, 32 + 8 * k)
    return decode_block(memoryview(data)[start:end])
