"""The most frequent terms of each group, by a summary with an error bound and an exact recount.

Each task keeps, for every group, no more than ``size`` terms with lower bounds of their counts (Misra-Gries: what
is over the limit goes with the largest count that goes, which is taken off all others and added to the group's
error). Summaries are merged the same way, in two rounds. A term that is not in a group's last summary occurs at
most as often as its error says. The terms of the summaries are then counted exactly; a group is settled once its
k-th largest count is larger than its error, as no other term can come in then, or once the error is 0. Groups
that aren't settled are done again with summaries ``widen`` times as large, which hold all terms in the end.

Shuffled rows are bounded by groups x summary size for every task, not by the vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .joins import bounded_broadcast
from .topk import top_k_per_group

#: A summary's terms; a row without a term has the group's error.
SUMMARY = "grp string, term string, n long"
_SCHEMA = pa.schema([("grp", pa.string()), ("term", pa.string()), ("n", pa.int64())])


def shrunk(terms: pa.Table, error: int, size: int) -> tuple[pa.Table, int]:
    """At most ``size`` of the terms (term, n); what is taken off all counts is added to the error."""
    if terms.num_rows <= size:
        return terms, error
    n = terms["n"].to_numpy()
    off = int(np.partition(n, len(n) - size - 1)[len(n) - size - 1])
    left = n > off
    return pa.table({"term": terms["term"].filter(pa.array(left)), "n": n[left] - off}), error + off


def _added(parts: list[pa.Table]) -> pa.Table:
    t = pa.concat_tables(parts).group_by("term").aggregate([("n", "sum")])
    return pa.table({"term": t["term"], "n": t["n_sum"]})


def _rows(grp: str | None, terms: pa.Table, error: int) -> pa.RecordBatch:
    n = terms.num_rows + 1
    columns = [pa.array([grp] * n, pa.string()), pa.concat_arrays([*terms["term"].cast(pa.string()).chunks, pa.array([None], pa.string())]),
               pa.array(np.append(terms["n"].to_numpy(), error), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)


def _summaries(size: int):
    """A task's summaries of (grp, tokens) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, tuple[pa.Table, int]] = {}
        for b in batches:
            for grp in pc.unique(b["grp"]).to_pylist():
                mine = pc.is_null(b["grp"]) if grp is None else pc.fill_null(pc.equal(b["grp"], grp), False)
                counts = pc.value_counts(pc.drop_null(pc.list_flatten(b["tokens"].filter(mine))))
                new = pa.table({"term": counts.field("values"), "n": counts.field("counts").cast(pa.int64())})
                terms, error = held.get(grp, (new.slice(0, 0), 0))
                held[grp] = shrunk(_added([terms, new]), error, size)
        for grp, (terms, error) in held.items():
            yield _rows(grp, terms, error)

    return run


def _merge(size: int):
    def run(t: pa.Table) -> pa.Table:
        error = pc.sum(t["n"].filter(pc.is_null(t["term"]))).as_py() or 0
        terms, error = shrunk(_added([t.filter(pc.is_valid(t["term"])).select(["term", "n"])]), error, size)
        return pa.Table.from_batches([_rows(t["grp"][0].as_py(), terms, error)])

    return run


def frequent_terms(docs: DataFrame, group: str, tokens: str, k: int, size: int = 2000, widen: int = 8, spread: int = 64) -> DataFrame:
    """group, term, n: the ``k`` most frequent tokens of each group (all, if it has fewer), ties to smaller terms.

    ``tokens`` is an array column; nulls in it don't count. ``docs`` is read several times, so it should be stored.
    """
    rows = docs.select(F.col(group).cast("string").alias("grp"), F.col(tokens).alias("tokens"))
    size = max(size, k + 1)
    done = None
    while True:
        parts = rows.mapInArrow(_summaries(size), SUMMARY).withColumn("part", F.pmod(F.spark_partition_id(), F.lit(spread)))
        some = parts.groupBy("grp", "part").applyInArrow(_merge(size), SUMMARY)
        summary = materialize(some.groupBy("grp").applyInArrow(_merge(size), SUMMARY), "vocabulary-summary")
        side, _ = bounded_broadcast(summary.where("term is not null").select(F.col("grp").alias("__grp"), F.col("term").alias("__term")), materialized=True)
        each = rows.select("grp", F.explode("tokens").alias("term"))
        counts = each.join(side, F.col("grp").eqNullSafe(F.col("__grp")) & (F.col("term") == F.col("__term"))).groupBy("grp", "term").agg(F.count(F.lit(1)).alias("n"))
        top = materialize(top_k_per_group(counts, ["grp"], [F.col("n").desc(), F.col("term").asc()], k, spread_on="term", spread=spread), "vocabulary-top")
        errors = summary.where("term is null").select(F.col("grp").alias("__grp"), F.col("n").alias("error"))
        least = top.groupBy(F.col("grp").alias("__g")).agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("found"))
        proof = errors.join(least, F.col("__grp").eqNullSafe(F.col("__g")), "left").select(
            "__grp", ((F.col("error") == 0) | ((F.col("found") == k) & (F.col("least") > F.col("error")))).alias("settled"))
        proof = materialize(proof.select("__grp", F.coalesce("settled", F.lit(False)).alias("settled")), "vocabulary-proof")
        settled = top.join(proof.where("settled"), F.col("grp").eqNullSafe(F.col("__grp")), "left_semi")
        done = settled if done is None else done.unionAll(settled)
        open_groups = proof.where("not settled")
        if open_groups.isEmpty():
            return done.select(F.col("grp").alias(group), "term", "n")
        rows = rows.join(open_groups, F.col("grp").eqNullSafe(F.col("__grp")), "left_semi")
        size *= widen
