"""Exact top-k search by distributed histogram selection.

Scores are integer inner products. Every pass scores all pairs of a query and a candidate and counts the scores of
each query in bins between known bounds; the bin that holds a query's k-th largest score becomes the next pass's
bounds, until it is one value wide. A last pass keeps the scores above that value and, among those equal to it, the
smallest ids that still fit. No scores are stored, nothing but counts is shuffled, and the driver sees three norms.

Queries and rows are packed into blocks of the smallest type that holds their components, and a pass is cut into cells
of up to HELD_BLOCKS query blocks by CELL_BLOCKS row blocks, one a task: a task holds its queries with their counts and
meets its row blocks one after the other, so that its memory follows neither the rows nor the queries, and what a pass
shuffles is a copy of the rows for each HELD_BLOCKS * QUERY_BLOCK queries and one of the queries for each column of cells.

A pair of blocks whose norms bound its scores below 2**24 or 2**53 is multiplied in float32 or float64, which
is exact there; any other one in 64-bit integers.

Nulls and odd cases: vectors that are null or hold null or non-finite components take no part, nor do null
ids; rows equal in id and vector count once, others that share an id are rows of their own, as queries (each
has its own k rows) and as candidates (also for each other); shorter vectors are read as filled up with zeros; a query gets all candidates if there are
fewer than k; no query or no candidate gives an empty result; a table whose largest norms multiply to 2**62 or
more is refused, as its scores may not fit a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hostlens.llm.common import padded, shuffle_parts
from hostlens.llm.vectors import vector_rows
from hostlens.session import materialize

BINS, QUERY_BLOCK, ROW_BLOCK = 1024, 1024, 2048
#: Query blocks that a task holds, and row blocks that it meets.
HELD_BLOCKS, CELL_BLOCKS = 8, 64
#: Bytes of a block's vectors as doubles: of more components it has fewer rows.
BLOCK_BYTES = 1 << 20
#: Types of packed components, and what no component may reach.
KINDS = (("tinyint", "<i1", 2**7 - 1), ("smallint", "<i2", 2**15 - 1), ("int", "<i4", 2**31 - 1), ("double", "<f8", float("inf")))
PACKED = "block long, ids binary, rows binary, vecs binary"


def _pack(dim: int, kind: str):
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("vec_id", "ascending"), ("row", "ascending")])
        m = padded(t["ints"], dim).astype(kind)
        return pa.table({"block": t["block"][:1], "ids": [t["vec_id"].to_numpy().astype("<i8").tobytes()], "rows": [t["row"].to_numpy().astype("<i8").tobytes()],
                         "vecs": [m.tobytes()]})

    return run


def vector_blocks(vectors: DataFrame, rows: int, dim: int, count: int, kind: str = "double") -> DataFrame:
    """block, ids, rows, vecs: about ``rows`` vectors each as packed arrays of Spark's type ``kind``."""
    n, packed = max(1, -(-count // rows)), next(p for name, p, _ in KINDS if name == kind)
    return (vectors.select("vec_id", "row", F.col("ints").cast(f"array<{kind}>"), F.pmod(F.xxhash64("row"), F.lit(n)).cast("long").alias("block"))
            .groupBy("block").applyInArrow(_pack(dim, packed), PACKED))


class _Block:
    """A packed block; of a query block also ``lo`` and ``need``, of each query."""

    def __init__(self, row: dict, dim: int, kind: str) -> None:
        self.block = row["block"]
        self.ids, self.rows, self.lo, self.need = (np.frombuffer(row.get(k) or b"", "<i8") for k in ("ids", "rows", "lo", "need"))
        x = np.frombuffer(row["vecs"], kind).reshape(-1, dim).astype(np.float64)
        self.kinds: dict[type, np.ndarray] = {np.float64: x}
        self.norm = np.sqrt((x * x).sum(1).max(initial=0))

    def of(self, kind: type) -> np.ndarray:
        if kind not in self.kinds:
            self.kinds[kind] = self.kinds[np.float64].astype(kind)
        return self.kinds[kind]


def inner_products(q: _Block, c: _Block) -> np.ndarray:
    """Inner products of whole numbers, exact in the type they come in."""
    bound = q.norm * c.norm * 1.000001 + 1
    kind = np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else np.int64
    return q.of(kind) @ c.of(kind).T


def _hits(q: _Block, c: _Block, least: np.ndarray, top: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of query and row, and score, of the pairs of two rows that reach their query's ``least``, in order.

    With ``top``, they need not go below the ``top`` largest scores of these rows.
    """
    s = inner_products(q, c)
    if 0 < top < s.shape[1]:
        least = np.maximum(least, np.partition(s, -top, 1)[:, -top].astype(np.int64))
    # Rounding a bound to the scores' type moves it past none of them.
    at = np.flatnonzero(s >= least.astype(s.dtype)[:, None])
    i, j = np.divmod(at, s.shape[1])
    other = q.rows[i] != c.rows[j]
    return i[other], j[other], s.reshape(-1)[at[other]].astype(np.int64)


class _Counts:
    """Counts by bin from the top, as far down as this task alone makes what is needed: the k-th value can't lie lower."""

    SCHEMA = "q_block long, query_row long, bin long, n long"

    def __init__(self, q: _Block, width: int, bins: int, span: int, top: int = 0) -> None:
        """``top``: if no score lies above the bins, one more than is needed, as a row may be the query itself."""
        self.q, self.width, self.span, self.least, self.new, self.top = q, width, span, q.lo, 0, top
        self.n = np.zeros((len(q.rows), bins), np.int32)

    def down(self) -> np.ndarray:
        return self.n[:, ::-1].cumsum(1)[:, ::-1]

    def meet(self, c: _Block) -> None:
        i, _, s = _hits(self.q, c, self.least, self.top if self.least is self.q.lo else 0)
        s -= self.q.lo[i]
        use = s < self.span
        np.add.at(self.n.reshape(-1), i[use] * self.n.shape[1] + s[use] // self.width, 1)
        self.new += np.count_nonzero(use)
        if self.new >= self.q.need.sum() // 2:
            full = (self.down() >= self.q.need[:, None]).sum(1)
            self.least, self.new = self.q.lo + np.maximum(full - 1, 0) * self.width, 0

    def found(self) -> pa.RecordBatch:
        q, bin_ = np.nonzero((self.n > 0) & (self.down() - self.n < self.q.need[:, None]))
        return pa.RecordBatch.from_pydict({"q_block": np.full(len(q), self.q.block), "query_row": self.q.rows[q], "bin": bin_, "n": self.n[q, bin_].astype(np.int64)})


class _Best:
    """The scores above ``lo`` and those equal to it, as far as they may be among a query's k best."""

    SCHEMA = "query_row long, query_id long, vec_id long, row long, score long"

    def __init__(self, q: _Block, k: int) -> None:
        self.q, self.k, self.held, self.size = q, k, [np.zeros((0, 4), np.int64)], 0

    def meet(self, c: _Block) -> None:
        i, j, s = _hits(self.q, c, self.q.lo)
        tie = np.flatnonzero(s == self.q.lo[i])
        of = i[tie]
        keep = np.ones(len(i), bool)
        keep[tie[np.arange(len(of)) - np.searchsorted(of, of) >= self.q.need[of]]] = False  # ids ascend within a block
        self.held.append(np.stack([i, c.ids[j], c.rows[j], s], 1)[keep])
        self.size += len(self.held[-1])
        if self.size > 4 * self.k * len(self.q.rows):
            self.held = [self.best()]
            self.size = len(self.held[0])

    def best(self) -> np.ndarray:
        x = np.concatenate(self.held)
        x = x[np.lexsort((x[:, 2], x[:, 1], -x[:, 3], x[:, 0]))]
        return x[np.arange(len(x)) - np.searchsorted(x[:, 0], x[:, 0]) < self.k]

    def found(self) -> pa.RecordBatch:
        q, ids, rows, s = self.best().T
        return pa.RecordBatch.from_pydict({"query_row": self.q.rows[q], "query_id": self.q.ids[q], "vec_id": ids, "row": rows, "score": s})


def _each_cell(dim: int, kind: str, begin):
    """Gives each row block of a cell to what ``begin`` makes of the cell's query blocks, which come first."""

    def run(batches):
        cell, held = None, []
        for b in batches:
            for at in range(b.num_rows):
                row = b.slice(at, 1).to_pylist()[0]
                if row["cell"] != cell:
                    yield from (h.found() for h in held)
                    cell, held = row["cell"], []
                block = _Block(row, dim, kind)
                if row["lo"] is not None:
                    held.append(begin(block))
                else:
                    for h in held:
                        h.meet(block)
        yield from (h.found() for h in held)

    return run


def _pack_state(t: pa.Table) -> pa.Table:
    t = t.sort_by([("query_id", "ascending"), ("query_row", "ascending")])
    return pa.table({"block": t["q_block"][:1], **{k: [t[k].to_numpy().astype("<i8").tobytes()] for k in ("lo", "need")}})


def top_k(df: DataFrame, is_query: Column | str, k: int = 20, scale: float = 64.0, vec_id: str = "vec_id", embedding: str = "embedding",
          query_block: int = QUERY_BLOCK, row_block: int = ROW_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest integer inner products of each query, ties to smaller ids.

    ``is_query`` marks query rows by ``vec_id``. Components become floor(scale * x).
    """
    ints = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x).cast("double"))
    norm = F.sqrt(F.aggregate("ints", F.lit(0.0), lambda a, x: a + x * x))
    v = materialize(vector_rows(df, vec_id, embedding).select("vec_id", "row", ints.alias("ints")).withColumn("norm", norm), "topk-vectors")
    queries = v.where(is_query)
    n, dim, most = v.agg(F.count("*"), F.max(F.size("ints")), F.max("norm")).first()
    n_q, most_q = queries.agg(F.count("*"), F.max("norm")).first()
    if not n or not n_q or not dim:
        dim, most, most_q = max(dim or 0, 1), most or 0.0, most_q or 0.0
    bound = int(np.ceil(most * most_q * 1.000001)) + 1 if most * most_q < 2**62 else 2**62
    if bound >= 2**62:
        raise ValueError("scores of 2**62 and more may not fit a long")
    kind, packed, _ = next(x for x in KINDS if most < x[2])
    row_block, query_block = (min(x, max(1, BLOCK_BYTES // (8 * dim))) for x in (row_block, query_block))
    blocks = materialize(vector_blocks(v, row_block, dim, n, kind), "topk-rows")
    q_blocks = materialize(vector_blocks(queries, query_block, dim, n_q, kind), "topk-queries")
    # Cells of one task each: at least as many as there are shuffle partitions, if there are blocks for them.
    down, across = (max(1, -(-x // y)) for x, y in ((n_q, query_block), (n, row_block)))
    block_of = F.pmod(F.xxhash64("row"), F.lit(down)).cast("long").alias("q_block")
    down = -(-down // HELD_BLOCKS)
    across = min(across, max(-(-across // CELL_BLOCKS), -(-shuffle_parts(v.sparkSession) // down)))

    def cells(first: Column, n: int, step: int) -> Column:
        return F.explode(F.sequence(first.cast("int"), (first + (n - 1) * step).cast("int"), F.lit(step))).alias("cell")

    row_cells = blocks.select(cells(F.pmod("block", F.lit(across)), down, across), "*", F.lit(None).cast("binary").alias("lo"), F.lit(None).cast("binary").alias("need"))

    def passed(state: DataFrame, begin, schema: str) -> DataFrame:
        """What ``begin`` finds of all pairs of queries with their ``state`` and rows."""
        packed_state = state.groupBy("q_block").applyInArrow(_pack_state, "block long, lo binary, need binary")
        q_cells = q_blocks.join(packed_state, "block").select(cells(F.pmod("block", F.lit(down)) * across, across, 1), *q_blocks.columns, "lo", "need")
        met = row_cells.unionAll(q_cells).repartitionById(down * across, "cell").sortWithinPartitions("cell", F.col("lo").isNull(), "block")
        return met.mapInArrow(_each_cell(dim, packed, begin), schema)

    state = queries.select(F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"), block_of).withColumns({"lo": F.lit(-bound).cast("long"), "need": F.lit(k).cast("long")})
    span, top = 2 * bound + 1, k + 1
    while True:
        width = -(-span // BINS)
        counted = passed(state, lambda q, w=width, s=span, t=top: _Counts(q, w, -(-s // w), s, t), _Counts.SCHEMA).groupBy("q_block", "query_row", "bin").agg(F.sum("n").alias("n"))
        from_top = Window.partitionBy("q_block", "query_row").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
        cut = counted.withColumn("down", F.sum("n").over(from_top)).withColumn("above", F.col("down") - F.col("n"))
        # The bin in which the count reaches what is needed; the lowest one if it never does.
        cut = (cut.join(state.select("query_row", "query_id", "lo", "need"), "query_row").where(F.col("above") < F.col("need"))
               .groupBy("q_block", "query_row", "query_id").agg(F.min_by(F.struct("lo", "need", "bin", "above"), "bin").alias("x")))
        state = materialize(cut.select("query_row", "query_id", "q_block", (F.col("x.lo") + F.col("x.bin") * width).alias("lo"),
                                       (F.col("x.need") - F.col("x.above")).alias("need")), "topk-state")
        if width == 1:
            break
        span, top = width, 0
    found = passed(state, lambda q: _Best(q, k), _Best.SCHEMA)
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
