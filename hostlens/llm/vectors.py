"""The rows of a table of vectors that take part in a search."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def vector_rows(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, row (a number of its own for each row; to be stored at once), embedding (array of double).

    Vectors that are null or hold null or non-finite components take no part, nor do null ids. Rows that are equal
    in id and vector count once; others that share an id, or a vector, are rows of their own.
    """
    ok = F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"))
            .where(F.col("vec_id").isNotNull() & ok).distinct().withColumn("row", F.monotonically_increasing_id()))
