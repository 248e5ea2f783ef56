"""Removal of repeated word windows, by super-k-mers.

A window is ``window`` consecutive words. Its minimiser is the smallest hash among its runs of ``mer``
words; consecutive windows that share it travel as one packed string to the minimiser's bin, so a word is
sent about three times instead of twenty. Equal windows have equal minimisers and meet in one bin, where
sorting window hashes brings them together and comparing their bytes makes the count exact.

Skew: minimisers that come up in more than a small share of all strings (found by one counting pass) are
given up, their windows are dealt by their own hash; and of equal strings within a chunk of documents only
the earliest is sent, as the others are known to repeat it.

Nulls and odd cases: a null or empty text has no words; null ids come last in order; rows that share a
doc_id are ordered by a hash of their text, and equal rows are one document given twice (they don't repeat
each other, each gets the same result); an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostlens.llm.common import chunks, doc_key, shuffle_parts, text_bytes
from hostlens.session import materialize

#: Windows that a bin is meant to hold, and bytes of text that are hashed at a time.
BIN_WINDOWS, STEP = 600_000, 1 << 20
_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)


@lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.cumprod(np.append(np.uint64(1), np.full(n, b, np.uint64)), dtype=np.uint64) for b in (_BASE, _INVERSE))


_most = [STEP]


def slice_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each slice data[start:end], from running sums over the bytes."""
    if len(data) > 4 * STEP and len(data) > _most[0]:  # a single very long text
        up, down = _powers.__wrapped__(len(data))
    else:
        _most[0] = max(_most[0], -(-len(data) // STEP) * STEP)
        up, down = _powers(_most[0])
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    h ^= h >> np.uint64(32)  # mixed, so that its order says nothing about the text
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """Minimum of each n neighbours."""
    done = 1
    while done < n:
        step = min(done, n - done)
        x = np.minimum(x[:-step], x[step:])
        done += step
    return x


class Strings:
    """The super-k-mers of a chunk of documents, in document order."""

    def __init__(self, words: list[list[bytes]], window: int, mer: int, hot: np.ndarray):
        self.data = b" ".join(w for ws in words for w in ws)
        per = np.fromiter(map(len, words), np.int64, len(words))
        lengths = np.fromiter((len(w) for ws in words for w in ws), np.int64, int(per.sum()))
        self.ends = np.cumsum(lengths + 1) - 1
        self.starts = self.ends - lengths
        n = len(lengths)
        self.doc = np.zeros(0, np.int64)
        if n < window:
            self.first = self.count = self.key = self.doc
            return
        mers = slice_hashes(self.data, self.starts[: n - mer + 1], self.ends[mer - 1 :])
        key = sliding_min(mers, window - mer + 1)
        doc = np.repeat(np.arange(len(words)), per)
        if len(hot):
            at = np.minimum(np.searchsorted(hot, key), len(hot) - 1)
            own = np.flatnonzero(hot[at] == key)
            key[own] = slice_hashes(self.data, self.starts[own], self.ends[own + window - 1])
        inside = doc[: n - window + 1] == doc[window - 1 :]
        new = inside.copy()
        new[1:] &= ~inside[:-1] | (key[1:] != key[:-1])
        self.first = np.flatnonzero(new)  # the first window of each string
        gone = np.concatenate([[0], np.cumsum(inside)])
        self.count = np.diff(np.append(gone[self.first], gone[-1]))
        self.key, self.doc = key[self.first], doc[self.first]
        self.place = self.first - np.concatenate([[0], np.cumsum(per)])[self.doc]
        self.window = window

    def texts(self) -> list[bytes]:
        a, b = self.starts[self.first].tolist(), self.ends[self.first + self.count + self.window - 2].tolist()
        return [self.data[i:j] for i, j in zip(a, b, strict=True)]


def _docs_in_order(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list[list[bytes]]]:
    """Ids, row marks and words of a chunk's documents by their order, equal rows once."""
    ids, rows = b["_id"].to_numpy(), b["_row"].to_numpy()
    order = np.lexsort((rows, ids))
    keep = order[np.concatenate([[True], (np.diff(ids[order]) != 0) | (np.diff(rows[order]) != 0)])] if len(order) else order
    texts = b["text"].to_pylist()
    return ids[keep], rows[keep], [text_bytes(texts[i]).split() for i in keep.tolist()]


def _frequent(window: int, mer: int, share: float):
    """Minimisers by strings, of each task those that make up half of ``share`` or more; key 0 holds the total of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, total, windows = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0, 0
        for b in chunks(batches, 2 * STEP):
            s = Strings(_docs_in_order(b)[2], window, mer, keys[:0])
            one, n = np.unique(s.key, return_counts=True)
            windows, total = windows + int(s.count.sum()), total + len(s.key)
            often = n * 64 >= n.mean() if len(n) else n > 0
            keys, at = np.unique(np.concatenate([keys, one[often]]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([counts, n[often]]), len(keys)).astype(np.int64)
            if len(keys) > 4 / share + 100_000:  # forget the rarest, as a space-saving summary does
                stay = counts > max(1, total * share / 4)
                keys, counts = keys[stay], counts[stay]
        stay = counts >= max(2, total * share / 2)
        yield pa.RecordBatch.from_pydict({"key": np.append(keys[stay].view(np.int64), 0), "n": np.append(counts[stay], total), "windows": np.append(np.zeros(stay.sum(), np.int64), windows)})

    return run


def _send(window: int, mer: int, hot: np.ndarray, bins: int):
    """Per chunk and bin one packed row: strings with id, row mark, place; and the windows that are known to repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=6)
        for b in chunks(batches, 2 * STEP):
            ids, rows, words = _docs_in_order(b)
            s = Strings(words, window, mer, hot)
            if not len(s.first):
                continue
            texts, seen, fresh = s.texts(), {}, np.zeros(len(s.first), bool)
            for i, t in enumerate(texts):
                if seen.setdefault(t, i) == i:
                    fresh[i] = True
            bin_of = (s.key % np.uint64(bins)).astype(np.int64)
            order = np.lexsort((np.arange(len(bin_of)), bin_of))
            cuts = np.searchsorted(bin_of[order], np.arange(bins + 1))
            out = {"bin": [], "packed": []}
            for k in range(bins):
                of = order[cuts[k] : cuts[k + 1]]
                if not len(of):
                    continue
                new, old = of[fresh[of]], of[~fresh[of]]
                at = np.concatenate([new, old])
                numbers = b"".join(x.tobytes() for x in (np.diff(ids[s.doc[at]], prepend=0), rows[s.doc[at]], s.place[at].astype("<u4"), s.count[at].astype("<u4")))
                text = b"\n".join([texts[i] for i in new.tolist()])
                out["bin"].append(k)
                out["packed"].append(struct.pack("<QQ", len(new), len(old)) + press.compress(numbers + text))
            yield pa.RecordBatch.from_pydict(out, pa.schema([("bin", pa.int32()), ("packed", pa.binary())]))

    return run


def _unpack(packed: bytes) -> tuple[np.ndarray, bytes, int]:
    n_new, n_old = struct.unpack_from("<QQ", packed)
    n, data = n_new + n_old, zstandard.ZstdDecompressor().decompress(packed[16:])
    ids, rows = np.frombuffer(data, "<i8", 2 * n).reshape(2, n)
    rest = np.frombuffer(data, "<u4", 2 * n, 16 * n).reshape(2, n).astype(np.int64)
    return np.concatenate([np.cumsum(ids)[None], rows[None], rest]), data[24 * n :], n_new


def repeats_of(numbers: np.ndarray, texts: list[bytes], window: int) -> np.ndarray:
    """Which windows of the strings also start earlier; strings are in order, windows follow each other."""
    count = numbers[3]
    from_ = np.concatenate([[0], np.cumsum(count)])
    hashes, a, b = np.zeros(int(from_[-1]), np.uint64), np.zeros(int(from_[-1]), np.int64), np.zeros(int(from_[-1]), np.int64)
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (size < STEP or to == at):
            size += len(texts[to]) + 1
            to += 1
        data = b"\n".join(texts[at:to])
        raw = np.frombuffer(data, np.uint8)
        cut = np.flatnonzero((raw == 32) | (raw == 10))
        start, end = np.concatenate([[0], cut + 1]), np.append(cut, len(data))
        words = count[at:to] + window - 1
        head = np.concatenate([[0], np.cumsum(words)])[:-1]
        w = np.repeat(head - (from_[at:to] - from_[at]), count[at:to]) + np.arange(from_[to] - from_[at])
        base = np.repeat(start[head], count[at:to])
        s, e = start[w], end[w + window - 1]
        hashes[from_[at] : from_[to]] = slice_hashes(data, s, e)
        a[from_[at] : from_[to]], b[from_[at] : from_[to]] = s - base, e - base
        at = to
    of = np.repeat(np.arange(len(texts)), count)
    order = np.argsort(hashes, kind="stable")
    same = np.concatenate([[False], hashes[order][1:] == hashes[order][:-1]])
    lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    first = np.empty(len(order), np.int64)
    first[order] = order[lead]
    again = np.flatnonzero(first != np.arange(len(order)))
    if not len(again):
        return np.zeros(len(order), bool)
    # Neighbouring windows that repeat neighbouring windows are compared as one stretch of bytes.
    f = first[again]
    new = np.concatenate([[True], (np.diff(again) != 1) | (np.diff(f) != 1) | (np.diff(of[again]) != 0) | (np.diff(of[f]) != 0)])
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(again)) - 1
    wrong = []
    for i, j, k, m in zip(again[heads].tolist(), again[tails].tolist(), f[heads].tolist(), f[tails].tolist(), strict=True):
        if texts[of[i]][a[i] : b[j]] != texts[of[k]][a[k] : b[m]]:
            wrong.append(hashes[i : j + 1])
    out = np.zeros(len(order), bool)
    place = numbers[2][of] + np.arange(len(of)) - from_[of]
    # the same place of the same document, given twice, is no repeat of itself
    out[again] = (numbers[0][of[again]] != numbers[0][of[f]]) | (numbers[1][of[again]] != numbers[1][of[f]]) | (place[again] != place[f])
    if wrong:  # different windows with one hash
        met: dict[bytes, int] = {}
        for i in np.flatnonzero(np.isin(hashes, np.concatenate(wrong))).tolist():
            j = met.setdefault(texts[of[i]][a[i] : b[i]], i)
            out[i] = j != i and (numbers[0][of[i]], numbers[1][of[i]], place[i]) != (numbers[0][of[j]], numbers[1][of[j]], place[j])
    return out


RANGES = "_id long, _row long, start long, n long"


def _meet(window: int):
    """Repeated windows of one bin per task, as ranges of starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_bin: dict[int, list[bytes]] = {}
        for b in batches:
            for k, packed in zip(b["bin"].to_pylist(), b["packed"].to_pylist(), strict=True):
                by_bin.setdefault(k, []).append(packed)
        for k in list(by_bin):
            numbers, texts, known = [], [], []
            for packed in by_bin.pop(k):
                n, text, new = _unpack(packed)
                numbers.append(n[:, :new])
                known.append(n[:, new:])
                texts += text.split(b"\n") if new else []
            numbers, known = np.concatenate(numbers, 1), np.concatenate(known, 1)
            order = np.lexsort(numbers[2::-1])
            numbers, texts = numbers[:, order], [texts[i] for i in order.tolist()]
            again = repeats_of(numbers, texts, window)
            of = np.repeat(np.arange(len(texts)), numbers[3])
            at = np.flatnonzero(again)
            head = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(of[at]) != 0)])[: len(at)]
            heads = np.flatnonzero(head)
            n = np.diff(np.append(heads, len(at)))
            s, w = of[at[heads]], at[heads]
            from_ = np.concatenate([[0], np.cumsum(numbers[3])])
            found = np.stack([numbers[0][s], numbers[1][s], numbers[2][s] + w - from_[s], n])
            for part in (found, known):
                yield pa.RecordBatch.from_pydict(dict(zip(("_id", "_row", "start", "n"), part, strict=True)))

    return run


def repeated_windows(docs: DataFrame, window: int = 20, mer: int = 4) -> DataFrame:
    """_id, _row, start, n: n windows from word ``start`` on also start earlier (docs as from keyed())."""
    spark = docs.sparkSession
    share = 1 / (4 * shuffle_parts(spark))
    counted = docs.mapInArrow(_frequent(window, mer, share), "key long, n long, windows long").groupBy("key").agg(F.sum("n").alias("n"), F.sum("windows").alias("windows"))
    counted = materialize(counted, "substring-minimisers")
    total = counted.where("key = 0").first()
    bins = max(shuffle_parts(spark), -(-(total.windows if total else 0) // BIN_WINDOWS))
    # no more than 2 / share minimisers can pass
    hot = counted.where((F.col("key") != 0) & (F.col("n") >= (total.n if total else 0) * share / 2)).toArrow()["key"].to_numpy().view(np.uint64)
    sent = docs.mapInArrow(_send(window, mer, np.sort(hot), bins), "bin int, packed binary")
    return sent.repartitionById(bins, "bin").mapInArrow(_meet(window), RANGES)


def keyed(docs: DataFrame) -> DataFrame:
    """_id (null ids last) and _row, which tells rows that share an id apart."""
    return docs.select(*doc_key(), "doc_id", "text")


def _finish(window: int, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            out = {k: [] for k in ("doc_id", "n_words", "n_removed", "kept_sha256", *["kept"] * keep_text)}
            for doc_id, text, ranges in zip(b["doc_id"].to_pylist(), b["text"].to_pylist(), b["ranges"], strict=True):
                words = text_bytes(text).split()
                gone = 0
                if ranges.is_valid:
                    r = ranges.values
                    start = r.field("start").to_numpy()
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + r.field("n").to_numpy() + window - 1, -1)
                    cover = np.cumsum(edge[:-1]) > 0
                    gone = int(cover.sum())
                    kept = b" ".join([words[i] for i in np.flatnonzero(~cover).tolist()])
                else:
                    kept = b" ".join(words)
                for k, v in zip(out, (doc_id, len(words), gone, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "surrogatepass")), strict=False):
                    out[k].append(v)
            yield pa.RecordBatch.from_pydict(out, pa.schema([(k, pa.string() if k[:4] == "kept" else pa.int64()) for k in out]))

    return run


def remove_repeats(docs: DataFrame, window: int = 20, mer: int = 4, keep_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and ``kept``, the words that stay) of every row.

    A word goes if any window over it also starts earlier: in a smaller doc_id, or earlier in its document.
    """
    docs = keyed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    ranges = materialize(repeated_windows(docs.select("_id", "_row", "text"), window, mer), "substring-ranges")
    per = ranges.groupBy("_id", "_row").agg(F.collect_list(F.struct("start", "n")).alias("ranges"))
    rows = docs.join(per.hint("shuffle_hash"), ["_id", "_row"], "left").select("doc_id", "text", "ranges")
    return rows.mapInArrow(_finish(window, keep_text), "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * keep_text)
