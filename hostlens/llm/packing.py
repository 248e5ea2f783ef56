"""Packing of documents into token sequences by best-fit decreasing.

Every document is its ids and an end id. What fills whole windows is cut off first; the rests, longest
first, each go to the open window with the least room that still takes them, which a segment tree over
the rooms 0..window finds. Rests meet in bins of bounded size (by a hash of the document), so bins are
packed side by side and a bin's memory doesn't grow with the corpus.

Nulls and odd cases: a null or empty text is its end id alone; rows that share a doc_id are packed one by
one; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostlens.llm.common import chunks, shuffle_parts
from hostlens.llm.tokens import TokenIds
from hostlens.session import materialize

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class OpenWindows:
    """Windows by the room they have left, under a segment tree whose nodes tell whether any lies below."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.any = [False] * (2 * self.leaves)
        self.at: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]

    def _mark(self, room: int) -> None:
        tree, i = self.any, room + self.leaves
        tree[i] = bool(self.at[room])
        while i > 1:
            i >>= 1
            tree[i] = tree[2 * i] or tree[2 * i + 1]

    def push(self, room: int, window: int, filled: int) -> None:
        self.at[room].append((window, filled))
        if len(self.at[room]) == 1:
            self._mark(room)

    def pop(self, least: int) -> tuple[int, int, int] | None:
        """Takes the window with the least room of ``least`` or more."""
        tree, i = self.any, least + self.leaves
        if not tree[i]:
            while i > 1 and (i & 1 or not tree[i + 1]):  # up, until a right neighbour has some
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if tree[2 * i] else 2 * i + 1
        room = i - self.leaves
        window, filled = self.at[room].pop()
        if not self.at[room]:
            self._mark(room)
        return room, window, filled


def best_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The window and the offset there of each piece; no length passes ``size``."""
    windows, where, offset, n = OpenWindows(size), np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    for k in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[k])
        got = windows.pop(length)
        if got is None:
            got, n = (size, n, 0), n + 1
        room, where[k], offset[k] = got
        if room > length:
            windows.push(room - length, int(where[k]), int(offset[k]) + length)
    return where, offset


def _pieces(path: str, window: int, end_id: int, keep_ids: bool):
    """Whole windows of each document and its rest, cut from one pass over the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = TokenIds.of(path, True), np.array([end_id], "<u4")
        for b in chunks(batches):
            rows = {k: [] for k in ("doc_id", "h", "start", "length", "ids_crc32", "doc_tokens", "whole")}
            ids_of = []
            for doc_id, h, ids in zip(b["doc_id"].to_pylist(), b["h"].to_pylist(), coder.encode(b["text"].to_pylist()), strict=True):
                raw = memoryview(np.concatenate([ids.astype("<u4"), end]).tobytes())
                n = len(ids) + 1
                for start in range(0, n, window):
                    piece = raw[4 * start : 4 * (start + window)]
                    for k, v in zip(rows, (doc_id, h, start, len(piece) // 4, zlib.crc32(piece), n, len(piece) == 4 * window), strict=True):
                        rows[k].append(v)
                    if keep_ids:
                        ids_of.append(bytes(piece))
            yield pa.RecordBatch.from_pydict(rows | ({"ids": ids_of} if keep_ids else {}))

    return run


def _pack(window: int, stride: int):
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("h", "ascending"), ("doc_id", "ascending"), ("start", "ascending"), ("row", "ascending")])
        whole, length = t["whole"].to_numpy(), t["length"].to_numpy()
        where, offset = np.zeros(len(t), np.int64), np.zeros(len(t), np.int64)
        where[whole] = np.arange(whole.sum())
        where[~whole], offset[~whole] = best_fit_decreasing(length[~whole], window)
        where[~whole] += whole.sum()
        out = t.drop_columns(["h", "whole", "bin", "row"])
        return out.append_column("sequence_id", pa.array(t["bin"].to_numpy() * stride + where)).append_column("offset", pa.array(offset))

    return run


def pack(docs: DataFrame, tokenizer: str, window: int = 1024, end_id: int = 0, keep_ids: bool = False, bin_pieces: int = 20_000) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ``ids``, little-endian uint32).

    ``bin_pieces`` is about how many pieces a task packs together, whatever rows are equal: pieces are dealt over
    bins by a number of their own, which is stored with them.
    """
    spark = docs.sparkSession
    cut = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("h"))
    ids = ", ids binary" if keep_ids else ""
    cut = cut.mapInArrow(_pieces(tokenizer, window, end_id, keep_ids), "doc_id long, h long, start long, length long, ids_crc32 long, doc_tokens long, whole boolean" + ids)
    # stored once, so that a task that is run again deals the pieces as before
    cut = materialize(cut.withColumn("row", F.monotonically_increasing_id()), "packing-pieces")
    # A document has a piece per window at least, so its characters tell how many bins are needed.
    chars = docs.agg(F.sum(F.length("text")), F.count("*")).first()
    bins = max(1, int(((chars[0] or 0) / (2 * window) + chars[1]) / bin_pieces))
    bins = bins if bins < shuffle_parts(spark) else -(-bins // shuffle_parts(spark)) * shuffle_parts(spark)
    cut = cut.withColumn("bin", F.pmod(F.xxhash64("h", "row"), F.lit(bins)).cast("long"))
    schema = PIECES.split(", sequence_id")[0] + ids + ", sequence_id long, offset long"
    return cut.groupBy("bin").applyInArrow(_pack(window, 1 << 32), schema)
