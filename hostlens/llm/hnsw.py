"""Approximate nearest neighbours by inner product: a navigable small-world graph per shard.

Equal vectors are one node with its rows of the smallest ids, so a vector that a third of the rows share is one node.
Nodes are dealt over shards by a hash; each shard's graph has layers of ever fewer nodes, each stored as a
flat array of neighbour numbers. Every query searches every shard, from the top layer down with a beam in
the lowest one, and the shards' results are merged by exact scores.

Largest inner products become nearest neighbours by one more component, sqrt(m*m - |x|*|x|), that makes all
vectors of a shard equally long; a query has 0 there.

Nulls and odd cases: vectors that are null, zero or hold null or non-finite components take no part, nor do
null ids; rows equal in id and vector count once, others that share an id are rows of their own, as queries (each has
its own k rows) and as candidates
(also for each other); shorter vectors are read as filled up with zeros; ties go to the smaller id; a query gets
all that was found if that is fewer than k.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hostlens.llm.common import padded
from hostlens.llm.vectors import vector_rows
from hostlens.session import materialize

SHARD, LINKS, BUILD_BEAM, BEAM, BATCH = 8192, 16, 64, 128, 512
#: Queries that a shard's graph is sent for, and those that are searched at once.
QUERY_BLOCK, QUERY_STEP = 16384, 512


def beam_search(x: np.ndarray, links: np.ndarray, q: np.ndarray, entry: np.ndarray, beam: int, at_once: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` best nodes found for each query (-1: none) and their inner products, best first.

    x: nodes, links: a row of neighbours (-1: none) per node, entry: nodes to start from, a row per query.
    """
    rows = np.arange(len(q))
    seen = np.zeros((len(q), len(x) + 1), bool)  # the last column takes what -1 points to
    seen[:, -1] = True
    ids = np.full((len(q), beam), -1)
    score = np.full((len(q), beam), -np.inf, np.float32)
    open_ = np.zeros((len(q), beam), bool)
    n = min(entry.shape[1], beam)
    ids[:, :n] = entry[:, :n]
    seen[rows[:, None], ids[:, :n]] = True
    score[:, :n] = np.where(ids[:, :n] >= 0, np.einsum("qed,qd->qe", x[ids[:, :n]], q), -np.inf)
    open_[:, :n] = ids[:, :n] >= 0
    at_once = min(at_once, beam)
    while len(act := np.flatnonzero(open_.any(1))):
        s = np.where(open_[act], score[act], -np.inf)
        best = np.argpartition(-s, at_once - 1, axis=1)[:, :at_once] if at_once < beam else np.tile(np.arange(beam), (len(act), 1))
        use = np.take_along_axis(open_[act], best, 1)
        open_[act[:, None], best] = False
        near = np.where(use[:, :, None], links[ids[act[:, None], best]], -1).reshape(len(act), -1)
        near.sort(1)
        fresh = ~seen[act[:, None], near]
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        seen[act[:, None], near] = True
        r, c = np.nonzero(fresh)
        got = np.full(near.shape, -np.inf, np.float32)
        got[r, c] = np.einsum("nd,nd->n", x[near[r, c]], q[act[r]])
        all_s = np.concatenate([score[act], got], 1)
        top = np.argpartition(-all_s, beam - 1, axis=1)[:, :beam]
        ids[act] = np.take_along_axis(np.concatenate([ids[act], near], 1), top, 1)
        score[act] = np.take_along_axis(all_s, top, 1)
        open_[act] = np.take_along_axis(np.concatenate([open_[act], fresh], 1), top, 1) & np.isfinite(score[act])
    order = np.argsort(-score, axis=1, kind="stable")
    ids, score = np.take_along_axis(ids, order, 1), np.take_along_axis(score, order, 1)
    return np.where(np.isfinite(score), ids, -1), score


def spread_out(x: np.ndarray, of: np.ndarray, cand: np.ndarray, links: int) -> np.ndarray:
    """Of each row's candidates (nearest first) the ``links`` that are nearer to it than to one chosen before; the rest by nearness."""
    n, c = cand.shape
    there = cand >= 0
    v = x[cand]
    to = np.where(there, np.einsum("ncd,nd->nc", v, x[of]), -np.inf)
    between = np.einsum("ncd,ned->nce", v, v)
    chosen, count = np.zeros((n, c), bool), np.zeros(n, int)
    for k in range(c):
        ok = there[:, k] & (count < links) & ~((between[:, k] > to[:, k, None]) & chosen).any(1)
        chosen[ok, k] = True
        count += ok
    order = np.argsort(np.where(chosen, 0, np.where(there, 1, 2)), axis=1, kind="stable")[:, :links]
    out = np.take_along_axis(np.where(there, cand, -1), order, 1)
    return np.pad(out, ((0, 0), (0, links - out.shape[1])), constant_values=-1)


class Graph:
    """Layers of neighbours over unit-length rows; node i is on layers 0..level[i], nodes are ordered by falling level."""

    def __init__(self, x: np.ndarray, layers: list[np.ndarray] | None = None, links: int = LINKS, beam: int = BUILD_BEAM, seed: int = 5):
        self.x = x
        if layers is not None:
            self.layers = layers
            return
        level = (-np.log(np.random.default_rng(seed).random(len(x)) + 1e-12) / np.log(links)).astype(int)
        sizes = [int((level >= k).sum()) for k in range(int(level.max(initial=0)) + 1)]
        self.layers = [np.full((n, 2 * links if k == 0 else links), -1, np.int32) for k, n in enumerate(sizes)]
        for k in range(len(sizes) - 1, -1, -1):
            self._build(k, sizes[k], links, beam)

    def _enter(self, q: np.ndarray, above: int) -> np.ndarray:
        entry = np.zeros((len(q), 1), int)
        for k in range(len(self.layers) - 1, above, -1):
            ids, _ = beam_search(self.x[: len(self.layers[k])], self.layers[k], q, entry, 4, 2)
            entry = ids[:, :2]
        return entry

    def _build(self, k: int, n: int, links: int, beam: int) -> None:
        net, done = self.layers[k], 1
        most = net.shape[1]
        while done < n:
            new = np.arange(done, min(n, done + min(BATCH, max(8, done))))
            q = self.x[new]
            found, score = beam_search(self.x[:done], net[:done], q, np.minimum(self._enter(q, k), done - 1), beam)
            # those that come in together see one another, too
            own = q @ q.T
            np.fill_diagonal(own, -np.inf)
            own[np.triu_indices(len(new))] = -np.inf
            cand = np.concatenate([found, np.where(np.isfinite(own), new, -1)], 1)
            order = np.argsort(-np.concatenate([score, own], 1), axis=1, kind="stable")[:, :beam]
            out = spread_out(self.x, new, np.take_along_axis(cand, order, 1), links)
            net[new, : out.shape[1]] = out
            self._link_back(net, new, out, most)
            done = int(new[-1]) + 1

    def _link_back(self, net: np.ndarray, new: np.ndarray, out: np.ndarray, most: int) -> None:
        src, dst = np.repeat(new, out.shape[1])[out.ravel() >= 0], out.ravel()[out.ravel() >= 0]
        order = np.argsort(dst, kind="stable")
        src, dst = src[order], dst[order]
        nodes, first, count = np.unique(dst, return_index=True, return_counts=True)
        wide = np.full((len(nodes), most + int(count.max(initial=0))), -1)
        wide[:, :most] = net[nodes]
        free = (net[nodes] >= 0).sum(1)
        wide[np.repeat(np.arange(len(nodes)), count), np.repeat(free, count) + np.arange(len(dst)) - np.repeat(first, count)] = src
        full = free + count > most
        net[nodes[~full]] = wide[~full][:, :most]
        for at in range(0, int(full.sum()), 256):
            own, near = nodes[full][at : at + 256], wide[full][at : at + 256]
            near = near[:, : int((near >= 0).sum(1).max())]
            s = np.where(near >= 0, np.einsum("ncd,nd->nc", self.x[near], self.x[own]), -np.inf)
            near = np.take_along_axis(near, np.argsort(-s, axis=1, kind="stable")[:, : 2 * most], 1)
            net[own] = spread_out(self.x, own, near, most)

    def search(self, q: np.ndarray, beam: int = BEAM) -> np.ndarray:
        return beam_search(self.x, self.layers[0], q, self._enter(q, 0), beam)[0]


def _index(dim: int, seed: int):
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("h")
        v = padded(t["embedding"], dim)
        long = np.sqrt((v * v).sum(1))
        x = np.concatenate([v, np.sqrt(np.maximum((m := long.max()) ** 2 - long**2, 0))[:, None]], 1) / m
        g = Graph(x.astype(np.float32), seed=seed)
        held = t["held"].combine_chunks()
        ids, rows = (held.values.field(k) for k in ("vec_id", "row"))
        return pa.table({"shard": t["shard"][:1], "vectors": [v.tobytes()], "nodes": [x.astype(np.float32).tobytes()],
                         "sizes": [[len(x) for x in g.layers]], "links": [b"".join(x.tobytes() for x in g.layers)],
                         "id_from": [np.asarray(held.offsets).astype("<i8").tobytes()], "ids": [np.asarray(ids).astype("<i8").tobytes()], "rows": [np.asarray(rows).astype("<i8").tobytes()]})

    return run


INDEX = "shard long, vectors binary, nodes binary, sizes array<long>, links binary, id_from binary, ids binary, rows binary"


def build_index(df: DataFrame, k: int = 20, shard: int = SHARD, vec_id: str = "vec_id", embedding: str = "embedding", seed: int = 5) -> tuple[DataFrame, DataFrame, int]:
    """The stored index (a row per shard), the vectors and their dimension. A node keeps the k + 1 rows of the smallest ids of its vector: more can never be among k."""
    v = materialize(vector_rows(df, vec_id, embedding).where(F.exists("embedding", lambda x: x != 0)), "ann-vectors")
    dim = v.agg(F.max(F.size("embedding"))).first()[0] or 1
    place = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id", "row"))
    nodes = v.withColumn("place", place).where(F.col("place") <= k + 1).groupBy("embedding").agg(F.sort_array(F.collect_list(F.struct("vec_id", "row"))).alias("held"))
    nodes = materialize(nodes.withColumn("h", F.xxhash64("embedding")), "ann-nodes")
    n = max(1, -(-nodes.count() // shard))
    index = nodes.withColumn("shard", F.pmod("h", F.lit(n)).cast("long")).groupBy("shard").applyInArrow(_index(dim, seed), INDEX)
    return materialize(index, "ann-index"), v, dim


def _search(dim: int, k: int, beam: int):
    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                v = np.frombuffer(row["vectors"], np.float64).reshape(-1, dim)
                flat, layers = np.frombuffer(row["links"], np.int32), []
                for j, n in enumerate(row["sizes"]):
                    width = 2 * LINKS if j == 0 else LINKS
                    layers.append(flat[: n * width].reshape(n, width))
                    flat = flat[n * width :]
                g = Graph(np.frombuffer(row["nodes"], np.float32).reshape(len(v), -1), layers)
                start, ids, rows = (np.frombuffer(row[x], "<i8") for x in ("id_from", "ids", "rows"))
                all_ids, all_rows = (np.frombuffer(row[x], "<i8") for x in ("q_ids", "q_rows"))
                all_q = np.frombuffer(row["q_vecs"], np.float64).reshape(-1, dim)
                for at in range(0, len(all_q), QUERY_STEP):
                    q_ids, q_rows, q = (x[at : at + QUERY_STEP] for x in (all_ids, all_rows, all_q))
                    long = np.sqrt((q * q).sum(1))[:, None]
                    found = g.search(np.concatenate([q / long, np.zeros((len(q), 1))], 1).astype(np.float32), beam)
                    score = np.where(found >= 0, np.einsum("qcd,qd->qc", v[found], q), -np.inf)
                    order = np.argsort(-score, axis=1, kind="stable")[:, : k + 1]
                    out = {"query_row": [], "query_id": [], "vec_id": [], "row": [], "score": []}
                    for i, (own, own_row) in enumerate(zip(q_ids.tolist(), q_rows.tolist(), strict=True)):
                        hits = sorted((-score[i, c], int(ids[j]), int(rows[j])) for c in order[i] if found[i, c] >= 0
                                      for j in range(start[found[i, c]], start[found[i, c] + 1]) if rows[j] != own_row)[:k]
                        out["query_row"] += [own_row] * len(hits)
                        out["query_id"] += [own] * len(hits)
                        out["vec_id"] += [x for _, x, _ in hits]
                        out["row"] += [x for _, _, x in hits]
                        out["score"] += [-x for x, _, _ in hits]
                    yield pa.RecordBatch.from_pydict(out, pa.schema([(x, pa.float64() if x == "score" else pa.int64()) for x in out]))

    return run


def _pack_queries(dim: int):
    def run(t: pa.Table) -> pa.Table:
        return pa.table({"q_block": t["q_block"][:1], "q_ids": [t["vec_id"].to_numpy().astype("<i8").tobytes()], "q_rows": [t["row"].to_numpy().astype("<i8").tobytes()], "q_vecs": [padded(t["embedding"], dim).tobytes()]})

    return run


def nearest(df: DataFrame, is_query: Column | str, k: int = 20, shard: int = SHARD, beam: int = BEAM, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score (inner product, double) of the k nearest found for each query row."""
    index, v, dim = build_index(df, k, shard, vec_id, embedding)
    queries = v.where(is_query)
    shards = max(1, index.count())
    # A graph goes to as many blocks of queries as their size asks for, or as give every core a pair of a shard and a block.
    blocks = max(1, -(-queries.count() // QUERY_BLOCK), -(-df.sparkSession.sparkContext.defaultParallelism // shards))
    q = queries.withColumn("q_block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("long")).groupBy("q_block").applyInArrow(_pack_queries(dim), "q_block long, q_ids binary, q_rows binary, q_vecs binary")
    q = q.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<long>")))
    found = index.join(q, "shard").repartition("shard", "q_block").mapInArrow(_search(dim, k, beam), "query_row long, query_id long, vec_id long, row long, score double")
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
