"""Near-duplicate documents by DartMinHash signatures, banded joining and exact checks.

The elements of a document are its runs of five words. Each element throws darts (points of a Poisson
process that its hash decides) into its region: its weight wide, open upwards in rank. A dart also has one
of ``bands * rows`` coordinates; the lowest dart of each coordinate is the signature, and two documents
agree in a coordinate with the probability of their weighted Jaccard similarity. Rows of the signature
make bands; documents that share a band's key are candidates.

Copies are found first, by a digest of their words, and everything below is done on distinct texts. In a
bucket no pairs are listed: every member is compared with the bucket's leader, exactly, by the words.
Where this leaves a bucket in several classes, other leaders follow, and at last the members outside the
bucket's largest class are compared with the bucket's other classes, in blocks of texts and without a row
per pair. So no candidate pair of different classes goes unchecked, however large a bucket is.

Nulls and odd cases: texts without words are a class each; a text of fewer than five words is one element;
rows that share a doc_id are documents of their own; null ids have the class of their text; an empty
table gives an empty result. Texts are told apart by 64-bit digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostlens.llm.common import chunks, text_bytes
from hostlens.llm.substring import slice_hashes
from hostlens.session import materialize

#: A pair of similarity 0.8 shares no band with a probability of (1 - 0.8**7)**44 = 3e-5.
ROWS, BANDS, SHINGLE, SIMILARITY = 7, 44, 5, 0.8
#: Texts of one class that are compared with as many others at a time.
TOGETHER = 64
_C1, _C2, _NONE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(2**64 - 1)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _C2
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(words: list[list[bytes]], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words (of all words, if fewer), and the document of each."""
    data = b" ".join(w for ws in words for w in ws)
    per = np.fromiter(map(len, words), np.int64, len(words))
    lengths = np.fromiter((len(w) for ws in words for w in ws), np.int64, int(per.sum()))
    ends = np.cumsum(lengths + 1) - 1
    n = np.where(per > 0, np.maximum(per - size + 1, 1), 0)
    doc = np.repeat(np.arange(len(words)), n)
    first = np.arange(len(doc)) + (np.cumsum(per) - per - (np.cumsum(n) - n))[doc]
    return slice_hashes(data, (ends - lengths)[first], ends[first + np.minimum(per, size)[doc] - 1]) if len(doc) else np.zeros(0, np.uint64), doc


def darts(h: np.ndarray, doc: np.ndarray, weight: np.ndarray, n_docs: int, coordinates: int) -> np.ndarray:
    """The lowest dart of each coordinate (documents x coordinates); none: all bits set.

    A region is cut at weights 1, 2, 4, ...; each part throws its own darts, and those above the weight
    don't count, so a heavier element keeps the darts of a lighter one.
    """
    out = np.full(n_docs * coordinates, _NONE)
    size = np.bincount(doc, weight, n_docs)
    low, wide, parts = 0.0, 1.0, []
    while len(h):
        parts.append((mix(h + np.array([len(parts)], np.uint64) * _C2), doc, weight, np.full(len(h), low), np.full(len(h), wide)))
        low, wide = low + wide, max(1.0, low + wide)
        stay = weight > low
        h, doc, weight = h[stay], doc[stay], weight[stay]
    if not parts:
        return out.reshape(n_docs, coordinates)
    h, doc, weight, low, wide = (np.concatenate(x) for x in zip(*parts, strict=True))
    k = np.zeros(len(h), np.uint64)

    def wait(at):
        u = (mix(h[at] + (k[at] + np.uint64(1)) * _C1) >> np.uint64(11)).astype(np.float64) * 2.0**-53
        return -np.log1p(-u) / wide[at]

    rank = wait(slice(None))
    least = coordinates * (np.log(coordinates) + 3) / np.maximum(size, 1)  # ranks up to here fill all coordinates of most documents
    while True:
        at = np.flatnonzero(rank <= least[doc])
        while len(at):
            y = mix((h[at] ^ _C2) + (k[at] + np.uint64(1)) * _C1)
            # the rank, its last bits replaced by those of the dart
            value = (rank[at].view(np.uint64) & ~np.uint64(0xFFFFF)) | (y & np.uint64(0xFFFFF))
            cell = doc[at] * coordinates + ((y >> np.uint64(24)) % np.uint64(coordinates)).astype(np.int64)
            in_ = low[at] + wide[at] * (mix(y) >> np.uint64(11)).astype(np.float64) * 2.0**-53 < weight[at]
            np.minimum.at(out, cell[in_], value[in_])
            k[at] += np.uint64(1)
            rank[at] += wait(at)
            at = at[rank[at] <= least[doc[at]]]
        open_ = (out.reshape(n_docs, coordinates) == _NONE).any(1) & (size > 0)
        if not open_.any():
            return out.reshape(n_docs, coordinates)
        least = np.where(open_, least * 1.7, -1.0)


def band_keys(signature: np.ndarray, rows: int, bands: int) -> np.ndarray:
    keys = np.repeat(np.arange(bands, dtype=np.uint64)[None], len(signature), 0)
    cells = signature.reshape(len(signature), bands, rows)
    for r in range(rows):
        keys = mix(keys * _C1 + cells[:, :, r])
    return keys.view(np.int64)


def weighted(h: np.ndarray, doc: np.ndarray, counted: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Elements with weight 1, or each once with its count."""
    if not counted:
        return h, doc, np.ones(len(h))  # an element that comes again throws the same darts
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    first = np.flatnonzero(np.concatenate([[True], (np.diff(doc) != 0) | (h[1:] != h[:-1])])) if len(h) else np.zeros(0, int)
    return h[first], doc[first], np.diff(np.append(first, len(h))).astype(float)


def distinct_count(h: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Different elements of each document, told apart by 44 bits of their hashes."""
    x = np.sort((doc.astype(np.uint64) << np.uint64(44)) | (h >> np.uint64(20)))
    new = np.concatenate([[True], x[1:] != x[:-1]])[: len(x)]
    return np.bincount((x[new] >> np.uint64(44)).astype(np.int64), minlength=n_docs)


def _sign(rows: int, bands: int, size: int, counted: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, 1 << 20):
            words = [text_bytes(t).split() for t in b["text"].to_pylist()]
            digest = [int.from_bytes(hashlib.md5(b" ".join(w)).digest()[:8], "little", signed=True) if w else None for w in words]
            new = {d: i for i, d in reversed(list(enumerate(digest))) if d is not None}  # the first of equal texts
            at = sorted(new.values())
            h, doc = shingles([words[i] for i in at], size)
            keys = band_keys(darts(*weighted(h, doc, counted), len(at), rows * bands), rows, bands)
            lists, n = [None] * len(words), [None] * len(words)
            for i, k, m in zip(at, keys, distinct_count(h, doc, len(at)).tolist(), strict=True):
                lists[i], n[i] = k, m
            yield pa.RecordBatch.from_pydict({"doc_id": b["doc_id"], "_row": b["_row"], "v": pa.array(digest, pa.int64()), "n": pa.array(n, pa.int64()), "bands": pa.array(lists, pa.list_(pa.int64()))})

    return run


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted arrays without repetitions."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)


def _verify(size: int, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, None
        for b in chunks(batches):
            out: dict[str, list[int]] = {"a": [], "b": []}
            for u, v, s, t in zip(b["a"].to_pylist(), b["b"].to_pylist(), b["text_a"], b["text_b"], strict=True):
                if u != last:
                    last, left = u, np.unique(shingles([text_bytes(s.as_py()).split()], size)[0])
                if jaccard(left, np.unique(shingles([text_bytes(t.as_py()).split()], size)[0])) >= similarity:
                    out["a"].append(u)
                    out["b"].append(v)
            yield pa.RecordBatch.from_pydict(out, pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return run


def components(edges: DataFrame) -> DataFrame:
    """v, label for every end of an edge (a, b); equal labels where a path joins two ends.

    Each round moves every vertex to the neighbour (or itself) that comes first in the round's random
    order and keeps the edges between different targets, of which a constant share is left on average.
    """
    of = materialize(edges.select(F.explode(F.array("a", "b")).alias("v")).distinct().withColumn("label", F.col("v")), "components")
    k = 0
    while not edges.isEmpty():
        k += 1
        ends = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = lambda c: F.struct(F.xxhash64(c, F.lit(k)).alias("h"), F.col(c).alias("v"))  # noqa: E731, B023
        to = materialize(ends.groupBy("a").agg(F.least(F.min(order("b")), F.min(order("a")))["v"].alias("to")), "components")
        left, right = to.toDF("a", "to_a"), to.toDF("b", "to_b")
        edges = edges.join(left, "a").join(right, "b").where("to_a <> to_b")
        edges = materialize(edges.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "components")
        of = materialize(of.join(to.toDF("label", "to"), "label", "left").select("v", F.coalesce("to", "label").alias("label")), "components")
    return of


def _labelled(members: DataFrame, of: DataFrame | None) -> DataFrame:
    if of is None:
        return members.withColumn("label", F.col("v"))
    return members.join(of, "v", "left").withColumn("label", F.coalesce("label", "v"))


def _blocks(rows: DataFrame, by: str, texts: DataFrame) -> DataFrame:
    """``by``, block and a list of (v, label, text): the rows (by, v, label) in blocks of about TOGETHER."""
    per = rows.groupBy(by).agg(F.ceil(F.count("*") / TOGETHER).alias("n"))
    rows = rows.join(per, by).withColumn("block", F.pmod(F.xxhash64("v"), F.col("n"))).select(by, "block", "v", "label")
    return rows.join(texts, "v").groupBy(by, "block").agg(F.collect_list(F.struct("v", "label", "text")).alias("texts"))


def _verify_blocks(size: int, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            out: dict[str, list[int]] = {"a": [], "b": []}
            for left, right in zip(b["left"].to_pylist(), b["right"].to_pylist(), strict=True):
                h, of = shingles([text_bytes(x["text"]).split() for x in right], size)
                order = np.lexsort((h, of))
                h, of = h[order], of[order]
                once = np.concatenate([[True], (np.diff(of) != 0) | (h[1:] != h[:-1])])
                h, of = h[once], of[once]
                sizes, label = np.bincount(of, minlength=len(right)), np.array([x["label"] for x in right])
                for x in left:
                    own = np.unique(shingles([text_bytes(x["text"]).split()], size)[0])
                    at = np.minimum(np.searchsorted(own, h), len(own) - 1)
                    both = np.bincount(of[own[at] == h], minlength=len(right))
                    hit = np.flatnonzero((both >= similarity * (len(own) + sizes - both)) & (label != x["label"]))
                    for k in np.unique(label[hit], return_index=True)[1].tolist():  # one link is enough to join a class
                        out["a"].append(x["v"])
                        out["b"].append(right[hit[k]]["v"])
            yield pa.RecordBatch.from_pydict(out, pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return run


def undecided_links(rest: DataFrame, members: DataFrame, texts: DataFrame, size: int, similarity: float) -> DataFrame:
    """Links of ``rest`` (key, v, label, main: what lies outside a bucket's largest class) to the bucket's other classes.

    Each v meets the members of ``main`` (``members``: v, label), and the rest of a bucket meets itself, both in
    blocks of texts that are compared in numpy: there is no row per pair.
    """
    met = materialize(rest.select("main", "v", "label").distinct(), "near-met")
    main = members.join(met.select(F.col("main").alias("label")).distinct(), "label", "left_semi").select(F.col("label").alias("main"), "v", "label")
    left, right = (_blocks(x, "main", texts) for x in (met, main))
    against = left.withColumnRenamed("texts", "left").join(right.select("main", F.col("texts").alias("right")), "main")
    own = materialize(_blocks(rest.select("key", "v", "label"), "key", texts), "near-rest")
    among = own.select("key", "block", F.col("texts").alias("left")).join(own.toDF("key", "other", "right"), "key").where("block <= other")
    return against.select("left", "right").unionAll(among.select("left", "right")).mapInArrow(_verify_blocks(size, similarity), "a long, b long")


def classes(docs: DataFrame, similarity: float = SIMILARITY, size: int = SHINGLE, rows: int = ROWS, bands: int = BANDS,
            counted: bool = False, leaders: int = 3) -> DataFrame:
    """doc_id, class_id (the class's smallest doc_id), class_size, first and _row (a hash of the text) for every row.

    ``first`` marks one document of each class, the one of the smallest doc_id (rows equal to it, too).
    ``counted``: elements weigh as often as they occur in finding candidates; similarity is that of the sets either way.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("_row"), "text")
    signed = materialize(keyed.mapInArrow(_sign(rows, bands, size, counted), "doc_id long, _row long, v long, n long, bands array<long>"), "near-signatures")
    distinct = signed.where("bands IS NOT NULL").groupBy("v").agg(F.first("n").alias("n"), F.first("bands").alias("bands"))
    members = distinct.select("v", "n", F.explode("bands").alias("key"))
    shared = members.groupBy("key").agg(F.count("*").alias("times")).where("times > 1").drop("times")
    members = materialize(members.join(shared, "key"), "near-buckets")
    # the texts that any comparison can need
    ids = members.select("v").distinct()
    of_text = signed.where("bands IS NOT NULL").join(ids, "v", "left_semi").groupBy("v").agg(F.min(F.struct("doc_id", "_row")).alias("x")).select("v", "x.*")
    same = keyed["doc_id"].eqNullSafe(of_text["doc_id"]) & (keyed["_row"] == of_text["_row"])
    texts = materialize(keyed.join(of_text, same).select("v", "text").dropDuplicates(["v"]), "near-texts")

    def compared(pairs: DataFrame) -> DataFrame:
        pairs = pairs.select("a", "b").distinct().join(texts.toDF("b", "text_b"), "b").join(texts.toDF("a", "text_a"), "a")
        return pairs.select("a", "b", "text_a", "text_b").mapInArrow(_verify(size, similarity), "a long, b long")

    # Sets whose sizes differ by more than the similarity can't be similar (a little room for hashes that agree).
    near = similarity * 0.99
    edges, of = None, None
    for k in range(leaders + 1):
        now = _labelled(members, of)
        undecided = now.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min(F.struct(F.xxhash64("v", F.lit(k)), "v", "label", "n")).alias("lead")).where("low <> high")
        if k < leaders:
            pairs = now.join(undecided, "key").where("label <> lead.label").where((F.col("n") >= near * F.col("lead.n")) & (F.col("lead.n") >= near * F.col("n"))).select(F.col("lead.v").alias("a"), F.col("v").alias("b"))
            found = materialize(compared(pairs), "near-links")
        else:  # what no leader has brought together: all that is outside a bucket's largest class against other classes
            now = materialize(now.join(undecided.select("key"), "key", "left_semi"), "near-undecided")
            sizes = now.groupBy("key", "label").agg(F.count("*").alias("count"))
            main = sizes.groupBy("key").agg(F.max_by("label", F.struct("count", "label")).alias("main"))
            rest = materialize(now.join(main, "key").where("label <> main").select("key", "v", "label", "main"), "near-left")
            found = materialize(undecided_links(rest, _labelled(ids, of), texts, size, similarity), "near-links")
        edges = found if edges is None else edges.unionAll(found)
        if not found.isEmpty():
            of = components(edges)
        elif k == leaders or undecided.isEmpty():
            break
    out = _labelled(signed.where("v IS NOT NULL").select("doc_id", "_row", "v"), of)
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "_row")
    per = out.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"), F.min(place).alias("first"))
    out = out.join(per, "label").select("doc_id", "class_id", "class_size", (place == F.col("first")).alias("first"), "_row")
    return out.unionAll(signed.where("v IS NULL").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long"), F.lit(True), "_row"))
