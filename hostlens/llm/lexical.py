"""Ranked lexical search of a table of items in all documents, by dense matrix products.

The items come in blocks of bounded size. A block's vocabulary is the distinct terms of its items, and nothing
else of a document is looked at: a first pass cuts the documents into tiles and stores each tile's hits of the
vocabulary (term, occurrences), document lengths and ids. Document frequencies are sums over these tiles. A second
pass multiplies, for a tile of the vocabulary at a time, the items' weights with the documents' impacts as dense
float64 matrices. Both hold integers, and a vocabulary tile has so few terms that a partial sum stays below 2**53,
so the products are exact; partial sums are added up as 64-bit integers. Each tile keeps an item's k largest
scores, ties to smaller ids; a task keeps no more than that of all its tiles.

Nulls and odd cases: a null or empty text has no term; a document without a term counts nowhere; documents that
share an id are ranked each, null ids after all others of the same score; items that share an id are ranked each;
an item without a term that some document holds has no row; an empty table on either side gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hostlens.llm.bytewords import byte_kinds, byte_rows, split_words
from hostlens.llm.common import chunks
from hostlens.session import materialize, scratch_path

#: Terms are runs of ASCII letters and digits and of anything beyond ASCII.
KINDS = byte_kinds(blank=bytes(b for b in range(128) if not chr(b).isalnum()), cut=b"")
#: Of a block of items: its items, and its terms (one item may have more).
ITEM_BLOCK, TERM_BLOCK = 1024, 1 << 15
#: Of a matrix: documents, and terms at most.
TILE_DOCS, TILE_TERMS = 2048, 1024
#: No term's impact in a document reaches this.
IMPACT = 10**6
LAST = 2**63 - 1


class Items(NamedTuple):
    first: int  # the number of the block's first item
    ids: list
    terms: pa.Array  # the vocabulary
    item: np.ndarray  # pairs of an item and one of its terms, by their places in the block
    term: np.ndarray


def item_blocks(rows, items: int = ITEM_BLOCK, terms: int = TERM_BLOCK) -> Iterator[Items]:
    """Blocks of (item_id, text) rows; what doesn't fit is the next block's."""
    first, ids, known, pairs = 0, [], {}, []

    def block() -> Items:
        p = np.array(pairs, np.int64).reshape(-1, 2)
        return Items(first, ids, pa.array(list(known), pa.binary()), p[:, 0], p[:, 1])

    for item_id, text in rows:
        own = split_words([(text or "").encode("utf-8", "replace")], KINDS).words.to_pylist()
        if ids and (len(ids) >= items or len(known) + len(own) > terms):
            yield block()
            first, ids, known, pairs = first + len(ids), [], {}, []
        pairs += [(len(ids), known.setdefault(w, len(known))) for w in own]
        ids.append(item_id)
    if ids:
        yield block()


TILES = "ids binary, lengths binary, doc binary, term binary, tf binary"


def _tiles(terms: pa.Array):
    """Documents with terms, by id (null ids last), and their hits of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in chunks(batches):
            for at in range(0, big.num_rows, TILE_DOCS):
                b = big.slice(at, TILE_DOCS)
                texts = byte_rows(b["text"])
                ends = np.cumsum([len(t) + 1 for t in texts])
                found = split_words(texts, KINDS)
                doc = np.searchsorted(ends, found.start, side="right")
                length = np.bincount(doc, minlength=len(texts))
                ids = pc.fill_null(b["doc_id"], LAST).to_numpy(zero_copy_only=False)
                order = np.argsort(ids, kind="stable")
                order = order[length[order] > 0]
                place = np.zeros(len(texts), np.int64)
                place[order] = np.arange(len(order))
                number = pc.fill_null(pc.index_in(found.words, terms), -1).to_numpy(zero_copy_only=False)[found.ids]
                key, tf = np.unique((place[doc] * len(terms) + number)[number >= 0], return_counts=True)
                out = {"ids": ids[order].astype("<i8"), "lengths": length[order].astype("<i8"), "doc": (key // max(len(terms), 1)).astype("<i4"),
                       "term": (key % max(len(terms), 1)).astype("<i4"), "tf": tf.astype("<i4")}
                if len(order):
                    yield pa.RecordBatch.from_pydict({k: [v.tobytes()] for k, v in out.items()})

    return run


def _read(row: dict) -> list[np.ndarray]:
    return [np.frombuffer(row[k], "<i8" if k in ("ids", "lengths") else "<i4").astype(np.int64) for k in ("ids", "lengths", "doc", "term", "tf")]


def _frequencies(terms: int):
    """term, n: documents that hold a term; -1 has the documents, -2 all terms of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs, total = np.zeros(terms, np.int64), 0, 0
        for b in batches:
            for row in b.to_pylist():
                _, length, _, term, _ = _read(row)
                df += np.bincount(term, minlength=terms)
                docs, total = docs + len(length), total + int(length.sum())
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"term": np.concatenate([held, [-1, -2]]).astype(np.int64), "n": np.concatenate([df[held], [docs, total]])})

    return run


def tile_top(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each row's k largest scores above 0, of equal ones those to the left."""
    if scores.shape[1] > k:
        least = np.partition(scores, -k, axis=1)[:, -k][:, None]
        above, tie = scores > least, scores == least
        tie &= np.cumsum(tie, axis=1) <= k - above.sum(1, keepdims=True)
        return np.nonzero((above | tie) & (scores > 0))
    return np.nonzero(scores > 0)


def _best(found: np.ndarray, k: int) -> np.ndarray:
    """Columns (item, score, id) with each item's k largest scores, ties to smaller ids."""
    found = found[:, np.lexsort((found[2], -found[1], found[0]))]
    head = np.flatnonzero(np.concatenate([[True], np.diff(found[0]) != 0])[: found.shape[1]])
    rank = np.arange(found.shape[1]) - np.repeat(head, np.diff(np.append(head, found.shape[1])))
    return found[:, rank < k]


def impacts(tf: np.ndarray, length: np.ndarray, docs: int, total: int) -> np.ndarray:
    """What occurrences count for in a document of that length."""
    wide = 90 * docs * int(length.max(initial=0)) >= 2**63
    m = 10 + (90 * (length.astype(object) if wide else length) * docs // total).astype(np.int64)
    return 10**9 * tf // (1000 * tf + 8 * m)


def _search(block: Items, weight: np.ndarray, docs: int, total: int, k: int):
    """item, score, id: the k best of each item in this task's tiles."""
    terms = len(block.terms)
    tile = max(1, min(TILE_TERMS, (2**53 - 1) // (IMPACT * max(1, int(weight.max(initial=1))))))
    by_term = np.argsort(block.term, kind="stable")
    item, term = block.item[by_term], block.term[by_term]
    edge = np.searchsorted(term, np.arange(0, terms + tile, tile))
    n_items = len(block.ids)

    def weights_of(t: int) -> np.ndarray:
        q, part = np.zeros((n_items, min(tile, terms - t * tile))), slice(edge[t], edge[t + 1])
        q[item[part], term[part] - t * tile] = weight[term[part]]
        return q

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.zeros((3, 0), np.int64)
        for b in batches:
            for row in b.to_pylist():
                ids, length, doc, hit, tf = _read(row)
                order = np.argsort(hit, kind="stable")
                doc, hit, tf = doc[order], hit[order], tf[order]
                impact = impacts(tf, length[doc], docs, total)
                at = np.searchsorted(hit, np.arange(0, terms + tile, tile))
                scores = np.zeros((n_items, len(ids)), np.int64)
                for t in range(-(-terms // tile)):
                    part = slice(at[t], at[t + 1])
                    d = np.zeros((min(tile, terms - t * tile), len(ids)))
                    d[hit[part] - t * tile, doc[part]] = impact[part]
                    scores += (weights_of(t) @ d).astype(np.int64)
                which, column = tile_top(scores, k)
                best = _best(np.concatenate([best, np.stack([which, scores[which, column], ids[column]])], 1), k)
        yield pa.RecordBatch.from_pydict(dict(zip(("item", "score", "id"), best, strict=True)))

    return run


def _search_block(docs: DataFrame, block: Items, k: int) -> DataFrame:
    """item, item_id, score, doc_id of one block of items, more than the k best of each."""
    spark = docs.sparkSession
    tiles = materialize(docs.mapInArrow(_tiles(block.terms), TILES), "lexical-tiles")
    counts = tiles.mapInArrow(_frequencies(len(block.terms)), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    n = dict(zip(counts["term"].to_pylist(), counts["n"].to_pylist(), strict=True))
    held = n.get(-1, 0)
    weight = np.array([math.floor(1000 * math.log((2 * held + 2) / (2 * n.get(t, 0) + 1))) for t in range(len(block.terms))], np.int64)
    found = tiles.mapInArrow(_search(block, weight, held, n.get(-2, 0), k), "item long, score long, id long")
    ids = spark.createDataFrame(list(enumerate(block.ids)), "item long, item_id long")
    return found.join(F.broadcast(ids), "item").select((F.col("item") + block.first).alias("item"), "item_id", "score", F.when(F.col("id") != LAST, F.col("id")).alias("doc_id"))


def search(spark: SparkSession, docs: DataFrame, items: DataFrame, k: int = 10, item_block: int = ITEM_BLOCK, term_block: int = TERM_BLOCK) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents of highest score above 0 for each item, ties to smaller ids."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").toLocalIterator()
    folder, blocks = scratch_path(spark, "lexical-found"), 0
    for block in item_blocks(rows, item_block, term_block):
        _search_block(docs, block, k).write.parquet(f"{folder}/block={blocks}")
        blocks += 1
    if not blocks:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    found = spark.read.parquet(folder).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return found.select("item_id", "rank", "doc_id", "score")
