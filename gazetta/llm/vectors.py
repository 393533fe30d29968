"""What the two vector searches share: valid vectors, blocks of rows as blobs, and the merge of partial results."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Every how many ids a row is a query.
EVERY = 50
BLOCK = "dim int, ids binary, vectors binary"


def finite(col: Column) -> Column:
    """True for vectors with at least one component whose components are all numbers."""
    ok = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce((F.size(col) > 0) & F.forall(col, ok), F.lit(False))


def valid(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v array<double>) of the rows that take part."""
    rows = df.where(F.col(id_col).isNotNull() & finite(F.col(vector_col)))
    return rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))


def packed(pdf: pd.DataFrame) -> tuple[int, bytes, bytes]:
    """Dimension, ids and vectors of rows of equal dimension, ordered by id."""
    pdf = pdf.sort_values("id")
    v = np.stack(pdf["v"].to_numpy()).astype(np.float64)
    return v.shape[1], pdf["id"].to_numpy(np.int64).tobytes(), v.tobytes()


def unpacked(row) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row["ids"], np.int64), np.frombuffer(row["vectors"], np.float64).reshape(-1, row["dim"])


def best(found: DataFrame, k: int) -> DataFrame:
    """The k best of (query_id, vec_id, score) for each query, ties to the smaller vec_id, with their rank."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
