"""Approximate nearest neighbours: inverted lists, scanned dimension by dimension with early abandonment."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table
from .vectors import BLOCK, EVERY, best, packed, unpacked, valid

K = 5
#: Rows that fit the list centres, drawn by a hash of the id; most lists; share of the lists probed: vectors that hardly
#: cluster have their neighbours in many lists, and the fewer the rows, the more.
SAMPLE, LISTS, PROBE_SHARE = 16384, 1024, 0.75
#: Most rows of a list's piece and of a block of queries, on average; columns of a block of dimensions.
PIECE, QUERIES, COLUMNS = 2048, 256, 16
#: Lengths of vectors in one table; each is searched apart.
MOST_LENGTHS = 16
#: How sure a test must be before it abandons a candidate: larger is surer.
SURE = 2.1


def rotation(dim: int, seed: int = 5) -> np.ndarray:
    """A random orthogonal matrix: after it, any few columns estimate a whole distance."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def centres(v: np.ndarray, k: int, seed: int = 5, rounds: int = 12) -> np.ndarray:
    """k-means on unit vectors; an empty list moves to a random row."""
    random = np.random.default_rng(seed)
    c = v[random.permutation(len(v))[:k]]
    for _ in range(rounds):
        near = np.concatenate([(v[i : i + 4096] @ c.T).argmax(1) for i in range(0, len(v), 4096)])
        sums = np.zeros_like(c)
        np.add.at(sums, near, v)
        empty = np.bincount(near, minlength=len(c)) == 0
        sums[empty] = v[random.integers(0, len(v), empty.sum())]
        c = sums / np.maximum(np.sqrt((sums * sums).sum(1, keepdims=True)), 1e-12)
    return c


def unit(v: np.ndarray) -> np.ndarray:
    top = np.abs(v).max(1, keepdims=True)  # first by the largest component, so that no square overflows or vanishes
    v = v / top
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision; equal rows give equal results, wherever they stand."""
    a, b = unit(a), unit(b)
    return np.clip((a * b).sum(1), -1.0, 1.0)


def scan(queries: np.ndarray, rows: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row) that no test abandoned. queries, rows: rotated unit vectors; limits: squared distance of each query's kth so far.

    Over d of D columns, D / d times the partial squared distance estimates the whole; a pair is abandoned
    when it exceeds the limit by more than the estimate's likely error, SURE / sqrt(d).
    """
    dim = rows.shape[1]
    d = min(COLUMNS, dim)
    part = np.maximum(((queries[:, :d] ** 2).sum(1)[:, None] + (rows[:, :d] ** 2).sum(1)[None]) - 2 * queries[:, :d] @ rows[:, :d].T, 0)
    test = lambda p, d, lim: p * (dim / d) <= lim * (1 + SURE / np.sqrt(d)) ** 2 + 1e-6 if d < dim else p <= lim + 1e-6
    q, r = np.nonzero(test(part, d, limits[:, None]))
    left = part[q, r]
    while d < dim and len(q):
        to = min(d + COLUMNS, dim)
        left = left + ((queries[q, d:to] - rows[r, d:to]) ** 2).sum(1)
        d = to
        ok = test(left, d, limits[q])
        q, r, left = q[ok], r[ok], left[ok]
    return q, r


class Search:
    """One block of queries over the pieces that it meets."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, turn: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.turned = (unit(vectors) @ turn).astype(np.float32)
        self.limits = np.full(len(ids), np.inf)
        self.found: list[list[tuple[float, int]]] = [[] for _ in ids]

    def visit(self, ids: np.ndarray, vectors: np.ndarray, turn: np.ndarray) -> None:
        turned = (unit(vectors) @ turn).astype(np.float32)
        head = min(len(ids), 4 * self.k)  # a few rows first: they set limits for the rest
        for lo, hi in ((0, head), (head, len(ids))):
            q, r = scan(self.turned, turned[lo:hi], self.limits)
            r += lo
            other = self.ids[q] != ids[r]
            q, r = q[other], r[other]
            scores = np.concatenate([cosine(self.vectors[q[i : i + 8192]], vectors[r[i : i + 8192]]) for i in range(0, len(q), 8192)] or [np.zeros(0)])
            at = np.flatnonzero(np.diff(q, prepend=-1))
            for s, e in zip(at.tolist(), [*at[1:].tolist(), len(q)]):
                x = int(q[s])
                got = self.found[x] = sorted(self.found[x] + list(zip((-scores[s:e]).tolist(), ids[r[s:e]].tolist())))[: self.k]
                if len(got) == self.k:
                    self.limits[x] = 2 + 2 * got[-1][0]  # of unit vectors, the squared distance is 2 - 2 cos


def nearest(df: DataFrame, k: int = K, every: int = EVERY, id_col: str = "vec_id", vector_col: str = "embedding", probe_share: float = PROBE_SHARE) -> DataFrame:
    """(query_id, rank, vec_id, score): for each id divisible by `every`, its k nearest other rows found, by cosine.

    Lists are fitted on at most SAMPLE rows; every row is in a list. A query probes its nearest lists, and more until they
    hold at least k other rows, so that k are found if there are so many. Scores are exact cosines of the original vectors;
    ties go to the smaller vec_id. Null and zero vectors, those with null or non-finite components and rows without id take
    no part; vectors meet only those of their own length, each length has its own lists. A row that repeats an id is a
    neighbour again, but query rows of one id are one query, that of the smallest vector among those of a length. Other columns are not read. An empty table gives an empty result.
    """
    rows = valid(df, id_col, vector_col).where(F.exists("v", lambda x: x != 0))
    dims = rows.groupBy(F.size("v").alias("d")).count().orderBy("d").limit(MOST_LENGTHS + 1).collect()
    if len(dims) > MOST_LENGTHS:
        raise ValueError(f"more than {MOST_LENGTHS} lengths of vectors")
    found = [_nearest(rows.where(F.size("v") == r["d"]), r["d"], r["count"], k, every, probe_share) for r in dims]
    return reduce(DataFrame.unionByName, found) if found else df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")


def _nearest(rows: DataFrame, dim: int, n: int, k: int, every: int, probe_share: float) -> DataFrame:
    """nearest() over n rows (id, v) of one length."""
    draw = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.where(draw < 1.1 * SAMPLE / n).orderBy(F.xxhash64("id", F.lit(3)), "id").limit(SAMPLE).select("v").toPandas()["v"] if n > SAMPLE else rows.orderBy("id").select("v").toPandas()["v"]
    lists = int(min(LISTS, max(1, np.sqrt(n))))
    centre = centres(unit(np.stack(sample.to_numpy()).astype(float)), lists)
    lists, turn = len(centre), rotation(dim)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = np.asarray(b.column("v").flatten()).reshape(-1, dim)
            yield pa.record_batch([pa.array((unit(v) @ centre.T).argmax(1).astype(np.int32)), b.column("id"), b.column("v")], names=["list", "id", "v"])

    members = cut(rows.mapInArrow(assign, "list int, id long, v array<double>"))
    sizes = np.zeros(lists, np.int64)
    for r in members.groupBy("list").count().collect():  # at most LISTS rows
        sizes[r["list"]] = r["count"]
    pieces = F.array(*[F.lit(int(max(1, -(-s // PIECE)))) for s in sizes])
    piece = F.pmod(F.xxhash64("id", F.lit(1)), F.get(pieces, F.col("list"))).cast("int")

    def pack(*keys: str):
        def one(pdf: pd.DataFrame) -> pd.DataFrame:
            d, ids, v = packed(pdf)
            return pd.DataFrame({**{key: [int(pdf[key].iloc[0])] for key in keys}, "dim": [d], "ids": [ids], "vectors": [v]})

        return one

    index = members.withColumn("piece", piece).groupBy("list", "piece").applyInPandas(pack("list", "piece"), f"list int, piece int, {BLOCK}")
    probes = int(min(lists, max(1, np.ceil(probe_share * lists))))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = np.asarray(b.column("v").flatten()).reshape(-1, dim)
            near = np.argsort(-(unit(v) @ centre.T), axis=1, kind="stable")
            held = np.cumsum(sizes[near], axis=1)
            count = np.maximum(probes, 1 + (held < k + 1).sum(1))
            q = np.repeat(np.arange(len(v)), np.minimum(count, lists))
            yield pa.record_batch([pa.array(np.concatenate([near[i, :c] for i, c in enumerate(count)] or [np.zeros(0)]).astype(np.int32)), b.column("id").take(pa.array(q)), b.column("v").take(pa.array(q))], names=["list", "id", "v"])

    blocks = max(1, -(-n // (every * QUERIES)))
    asked = members.where(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v")).mapInArrow(probe, "list int, id long, v array<double>")
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id", F.lit(2)), F.lit(blocks)).cast("int"))
    asked = asked.groupBy("list", "block").applyInPandas(pack("list", "block"), f"list int, block int, {BLOCK}")
    pairs = asked.select("list", "block", F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors")).join(index, "list")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                ids, v = unpacked(row)
                s = Search(np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["q_vectors"], np.float64).reshape(-1, dim), turn, k)
                s.visit(ids, v, turn)
                flat = [y for x in s.found for y in x]
                yield pa.record_batch([pa.array(np.repeat(s.ids, [len(x) for x in s.found])), pa.array([i for _, i in flat], pa.int64()), pa.array([-c for c, _ in flat], pa.float64())], names=["query_id", "vec_id", "score"])

    return best(pairs.mapInArrow(search, "query_id long, vec_id long, score double"), k)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))
