"""Exact top-k by inner product: a ball tree in each shard, searched best bound first, with the kth score shared."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table
from .vectors import BLOCK, EVERY, best, packed, unpacked, valid

K = 5
#: Rows of a shard on average, queries of a block, and most rows of a leaf.
SHARD, QUERIES, LEAF = 4096, 512, 64


class BallTree:
    """Balls around the rows of a shard: split between two far rows, at the median."""

    def __init__(self, vectors: np.ndarray):
        self.order = np.arange(len(vectors))
        self.nodes: list[tuple[np.ndarray, float, int, int, int]] = []  # centre, radius, first row, end, right child or 0
        self._grow(vectors, 0, len(vectors))
        self.rows = vectors[self.order]

    def _grow(self, vectors: np.ndarray, lo: int, hi: int) -> int:
        own = vectors[self.order[lo:hi]]
        centre = own.mean(0)
        away = np.sqrt(((own - centre) ** 2).sum(1))
        me = len(self.nodes)
        self.nodes.append((centre, float(away.max()), lo, hi, 0))
        if hi - lo > LEAF and away.max() > 0:
            a = own[away.argmax()]
            b = own[((own - a) ** 2).sum(1).argmax()]
            mid = (hi - lo) // 2
            self.order[lo:hi] = self.order[lo:hi][np.argpartition(own @ (b - a), mid)]
            self._grow(vectors, lo, lo + mid)
            right = self._grow(vectors, lo + mid, hi)
            self.nodes[me] = (centre, float(away.max()), lo, hi, right)
        return me


class Best:
    """The k best so far of each query of a block."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int, floors: np.ndarray):
        self.ids, self.queries, self.k = ids, queries, k
        self.norms = np.sqrt((queries * queries).sum(1))
        #: No row below a query's floor can be among its k best.
        self.floors, self.found = floors.copy(), [[] for _ in ids]

    def search(self, tree: BallTree, ids: np.ndarray) -> int:
        """Branch and bound over one shard for all queries at once; returns the number of scores computed."""
        ids, work = ids[tree.order], 0
        everyone = np.arange(len(self.ids))
        heap, counter = [(0.0, 0, 0, everyone)], 0
        while heap:
            _, _, at, active = heapq.heappop(heap)
            centre, radius, lo, hi, right = tree.nodes[at]
            bound = self.queries[active] @ centre + self.norms[active] * radius
            bound += 1e-9 * (1 + np.abs(bound))
            active, bound = active[bound >= self.floors[active]], bound[bound >= self.floors[active]]
            if not len(active):
                continue
            if right:
                for child in (at + 1, right):
                    c, r, *_ = tree.nodes[child]
                    up = self.queries[active] @ c + self.norms[active] * r
                    up += 1e-9 * (1 + np.abs(up))
                    if (ok := up >= self.floors[active]).any():
                        counter += 1
                        heapq.heappush(heap, (-float(up[ok].max()), counter, child, active[ok]))
                continue
            work += len(active) * (hi - lo)
            scores = self.queries[active] @ tree.rows[lo:hi].T
            scores[self.ids[active][:, None] == ids[None, lo:hi]] = -np.inf
            floor = self.floors[active]
            if hi - lo > self.k:
                floor = np.maximum(floor, np.partition(scores, -self.k, axis=1)[:, -self.k])
            for q, row in self._rows(active, scores, floor):
                got = self.found[q]
                got += zip((-scores[row[0], row[1]]).tolist(), ids[lo + row[1]].tolist())
                got.sort()
                del got[self.k :]
                if len(got) == self.k:
                    self.floors[q] = max(self.floors[q], -got[-1][0])
        return work

    @staticmethod
    def _rows(active, scores, floor):
        a, b = np.nonzero((scores >= floor[:, None]) & (scores > -np.inf))
        at = np.flatnonzero(np.diff(a, prepend=-1))
        for s, e in zip(at.tolist(), [*at[1:].tolist(), len(a)]):
            yield int(active[a[s]]), (a[s:e], b[s:e])


def whole_numbers(v: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(scale * v)


def exact_top_k(df: DataFrame, k: int = K, every: int = EVERY, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each id divisible by `every`, the k other rows of highest integer inner product.

    Vectors become floor(scale * x); sums are exact as long as they stay below 2 ** 53. Ties go to the smaller vec_id; fewer
    than k candidates are all returned. Null vectors and vectors with null or non-finite components take no part, nor do
    rows without id; vectors meet only those of their own length. A row that repeats an id is a candidate again, but
    query rows of one id are one query, that of the smallest vector among those of a length. Other columns are not read. An empty table gives an empty result. Each block of queries meets its first shard alone; the kth scores found there are floors that all other shards share.
    """
    rows = valid(df, id_col, vector_col).withColumn("dim", F.size("v"))
    n = rows.count()
    shards = max(1, -(-n // SHARD))
    blocks = max(1, -(-n // (every * QUERIES)))

    def pack(key: str):
        def one(pdf: pd.DataFrame) -> pd.DataFrame:
            d, ids, v = packed(pdf)
            return pd.DataFrame({key: [int(pdf[key].iloc[0])], "dim": [d], "ids": [ids], "vectors": [whole_numbers(np.frombuffer(v, np.float64), scale).tobytes()]})

        return one

    at = lambda m, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(m)).cast("int")
    shard_rows = cut(rows.withColumn("shard", at(shards, 1)).groupBy("dim", "shard").applyInPandas(pack("shard"), f"shard int, {BLOCK}"))
    query_rows = rows.where(F.col("id") % every == 0).groupBy("id", "dim").agg(F.min("v").alias("v")).withColumn("block", at(blocks, 2)).groupBy("dim", "block").applyInPandas(pack("block"), f"block int, {BLOCK}")
    query_rows = cut(query_rows.select("block", "dim", F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors")))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for b in batches:
            for row in b.to_pylist():
                if now != (row["block"], row["dim"]):
                    if state:
                        yield found(state, now)
                    now = (row["block"], row["dim"])
                    q = np.frombuffer(row["q_vectors"], np.float64).reshape(-1, row["dim"])
                    floors = np.frombuffer(row["floors"], np.float64) if row["floors"] else np.full(len(q), -np.inf)
                    state = Best(np.frombuffer(row["q_ids"], np.int64), q, k, floors)
                ids, v = unpacked(row)
                state.search(BallTree(v), ids)
        if state:
            yield found(state, now)

    def found(state: Best, now) -> pa.RecordBatch:
        sizes = [len(x) for x in state.found]
        flat = [y for x in state.found for y in x]
        floors = np.where([s == k for s in sizes], state.floors, -np.inf)
        head = np.cumsum([0, *sizes])
        return pa.record_batch(
            [pa.array([now[0]], pa.int32()), pa.array([now[1]], pa.int32()), pa.array([floors.tobytes()], pa.binary()), pa.array([np.repeat(state.ids, sizes).tolist()], pa.list_(pa.int64())), pa.array([[i for _, i in flat]], pa.list_(pa.int64())), pa.array([[int(-s) for s, _ in flat]], pa.list_(pa.int64()))],
            names=["block", "dim", "floors", "query_id", "vec_id", "score"],
        ) if len(head) else None

    out = "block int, dim int, floors binary, query_id array<long>, vec_id array<long>, score array<long>"
    home = F.pmod(F.col("block"), F.lit(shards))
    cols = ["block", "dim", "q_ids", "q_vectors", "floors", "ids", "vectors"]
    first = query_rows.withColumn("shard", home).withColumn("floors", F.lit(None).cast("binary")).join(shard_rows, ["dim", "shard"])
    first = cut(first.select(cols).mapInArrow(search, out))
    known = query_rows.join(first.select("block", "dim", "floors"), ["block", "dim"], "left")
    others = known.withColumn("shard", F.explode(F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != home)))
    rest = others.join(shard_rows, ["dim", "shard"]).select(cols).sortWithinPartitions("dim", "block").mapInArrow(search, out)
    both = first.unionByName(rest).select(F.explode(F.arrays_zip("query_id", "vec_id", "score")).alias("x")).select("x.*")
    return best(both, k)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(table(spark, sf_dir, "embeddings"))
