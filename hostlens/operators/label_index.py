"""Label indices as a table, without the labels passing the driver.

The index of a label is its place by count (largest first, ties by label), the numbers that ``StringIndexer`` gives.
Counts are combined on the map side; the labels are dealt out by ranges of (count, label), each range is numbered
where it lies, and the sizes of the ranges before it are added. The driver sees how many labels there are.

Where a model's bins bound the labels, ``bounded_indexers`` gives it ordinary fitted indexers, and refuses a column of
more labels before they are brought together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .joins import bounded_broadcast

_ROW = (1 << 33) - 1


def label_table(df: DataFrame, column: str) -> DataFrame:
    """label, n, index (0, 1, ...) of every distinct value of ``column`` that isn't null; stored."""
    spark = df.sparkSession
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    order = [F.col("n").desc(), F.col("label").asc()]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # what monotonically_increasing_id() gives: the partition in the upper bits, the row within it in the lower 33
    dealt = counts.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    dealt = materialize(dealt, "labels-dealt")
    part = F.shiftright("at", 33).alias("part")
    sizes = dealt.groupBy(part).agg(F.count(F.lit(1)).alias("size"))
    before = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = F.broadcast(sizes.select("part", F.coalesce(before, F.lit(0)).alias("before")))  # a row per range
    place = F.col("before") + F.col("at").bitwiseAND(F.lit(_ROW))
    return materialize(dealt.withColumn("part", part).join(offsets, "part").select("label", "n", place.cast("double").alias("index")), "labels-indexed")


def index_by_table(df: DataFrame, columns: Sequence[str], suffix: str = "_index", handle_invalid: str = "keep",
                   tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """Adds the index of each column's label. Null and unseen labels get the number of labels (``keep``), their
    rows go (``skip``), or the job fails on the first of them (``error``)."""
    for c in columns:
        table = tables[c] if tables else label_table(df, c)
        n = table.count()
        side, _ = bounded_broadcast(table.select(F.col("label").alias("__label"), F.col("index").alias(c + suffix)), materialized=True)
        df = df.join(side, F.col(c).cast("string") == F.col("__label"), "inner" if handle_invalid == "skip" else "left").drop("__label")
        if handle_invalid == "keep":
            df = df.withColumn(c + suffix, F.coalesce(c + suffix, F.lit(float(n))))
        elif handle_invalid == "error":
            said = F.concat(F.lit(f"unseen label in {c}: "), F.coalesce(F.col(c).cast("string"), F.lit("NULL")))
            df = df.withColumn(c + suffix, F.when(F.col(c + suffix).isNull(), F.raise_error(said).cast("double")).otherwise(F.col(c + suffix)))
    return df


def bounded_indexers(df: DataFrame, columns: Sequence[str], most: int, suffix: str = "_index",
                     handle_invalid: str = "keep") -> list[StringIndexerModel]:
    """Fitted ``StringIndexer`` models of columns that have no more than ``most`` values, the one for unseen labels
    included. One pass counts all columns, and no more than ``most + 1`` labels of a column ever reach the driver."""
    room = most - (handle_invalid == "keep")
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("label")) for c in columns])
    counts = df.select(F.explode(cells).alias("x")).where("x.label is not null").groupBy("x.column", "x.label").agg(F.count(F.lit(1)).alias("n"))
    first = F.row_number().over(Window.partitionBy("column").orderBy(F.col("n").desc(), F.col("label").asc()))
    found: dict[str, list[str]] = {c: [] for c in columns}
    for r in counts.withColumn("place", first).where(F.col("place") <= room + 1).orderBy("column", "place").collect():
        found[r["column"]].append(r["label"])
    for c, labels in found.items():
        if len(labels) > room:
            raise ValueError(f"column {c} has more than {most} values (maxBins), the one for unseen labels included")
    return [StringIndexerModel.from_labels(labels, c, c + suffix, handle_invalid) for c, labels in found.items()]
