"""Links between fingerprints by pigeonhole blocks, and connected components of a graph of links.

Neither gathers a group in one task: large buckets are compared in pairs of pieces, and a node with
very many links is joined by a broadcast of the bounded list of such nodes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, drop_cut, hot_rows, join_by_counts

#: A bucket with more members is compared in pairs of pieces of about half this size.
PIECE = 512
#: Slots of buckets that are counted first; of even slots each holds a small part of what makes a bucket large.
SLOTS = 1 << 16


def block_count(n: int, radius: int) -> int:
    """Blocks so that the kept ones hold enough bits for n fingerprints; the links found are the same for any count."""
    blocks = radius + 1
    while (blocks - radius) * (64 // blocks) < np.log2(max(n, 2)) - 8 and blocks < 3 * radius:
        blocks += 1
    return blocks


def block_keys(radius: int, blocks: int) -> list[tuple[int, int]]:
    """(number, mask) of each choice of blocks: of two fingerprints within the radius, some choice is equal."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    masks = [((1 << b) - 1) & ~((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [(i, sum(masks[j] for j in c)) for i, c in enumerate(combinations(range(blocks), blocks - radius))]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def bucketed(nodes: DataFrame, radius: int, n: int) -> DataFrame:
    """nodes (node, fp) in buckets by blocks of their fingerprints: rows (bucket, part, node, fp)."""
    blocks = block_keys(radius, block_count(n, radius))
    return by_keys(nodes, [F.col("fp").bitwiseAND(F.lit(_signed(m))) for _, m in blocks], n, "fp")


#: Roles of rows in parts of large buckets: any row, a row in the first of its parts, the bucket's least node.
OTHER, FIRST, HUB = 0, 1, 2


def by_keys(nodes: DataFrame, keys: list[Column], n: int, *own: str, hubs: bool = False) -> DataFrame:
    """nodes (node, own) in a bucket for each key: rows (bucket, part, node, own), sorted by the first two within partitions.

    Buckets with one member go; a large bucket of k pieces becomes k (k - 1) / 2 parts, one for each pair of pieces.
    With hubs, the least node of a large bucket is in each of its parts as well, and a column `role` tells the rows apart.
    """
    each = F.array(*[F.struct(F.lit(i).alias("i"), k.alias("k")) for i, k in enumerate(keys)])
    rows = nodes.select("node", *own, F.explode(each).alias("k")).select(F.xxhash64("k.i", "k.k").alias("bucket"), "node", *own)
    most = max(PIECE, hot_rows(n * len(keys)))
    # Only buckets in slots with so many rows can be large: the others are not counted one by one.
    slot = F.pmod("bucket", F.lit(SLOTS))
    full = F.broadcast(rows.groupBy(slot.alias("slot")).count().where(F.col("count") > most).select("slot"))
    hot = F.broadcast(rows.join(full, slot == F.col("slot"), "left_semi").groupBy("bucket").count().where(F.col("count") > most).select("bucket", F.ceil(2 * F.col("count") / most).cast("int").alias("pieces")))
    role = [F.lit(OTHER).alias("role")] if hubs else []
    small = rows.join(hot, "bucket", "left_anti").select("bucket", F.lit(-1).alias("part"), "node", *own, *role)
    return small.unionByName(in_parts(rows, hot, *own, hubs=hubs)).repartition("bucket", "part").sortWithinPartitions("bucket", "part")


def in_parts(rows: DataFrame, hot: DataFrame, *own: str, hubs: bool = False) -> DataFrame:
    """Rows (bucket, node, own) of the large buckets hot (bucket, pieces) in their parts, as by_keys() has them."""
    mine = F.pmod(F.xxhash64("node", F.lit(7)), F.col("pieces")).cast("int")
    other = F.explode(F.filter(F.sequence(F.lit(0), F.col("pieces") - 1), lambda j: j != F.col("mine")))
    part = (F.least("mine", "other") * F.col("pieces") + F.greatest("mine", "other")).alias("part")
    first = F.when(F.col("other") == F.when(F.col("mine") == 0, 1).otherwise(0), FIRST).otherwise(OTHER)
    role = [F.col("role")] if hubs else []
    wide = rows.join(hot, "bucket").withColumn("mine", mine).withColumn("other", other).withColumn("role", first)
    wide = wide.select("bucket", part, "node", *own, *role)
    if hubs:
        least = rows.join(hot, "bucket").groupBy("bucket", "pieces").agg(F.min(F.struct("node", *own)).alias("hub"))
        each = least.withColumn("mine", F.explode(F.sequence(F.lit(0), F.col("pieces") - 2))).withColumn("other", F.explode(F.sequence(F.col("mine") + 1, F.col("pieces") - 1)))
        wide = wide.unionByName(each.select("bucket", part, "hub.*", F.lit(HUB).alias("role")))
    return wide


def whole_groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Batches sorted by keys, dealt anew so that no group is cut."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(b.num_rows, bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        if held and any(held[-1].column(k)[-1].as_py() != b.column(k)[0].as_py() for k in keys):
            new[0] = True
        at = np.flatnonzero(new)
        if not len(at):
            held.append(b)
            continue
        if at[-1]:
            held.append(b.slice(0, at[-1]))
        if held:
            yield pa.Table.from_batches(held)
        held = [b.slice(at[-1])]
    if held:
        yield pa.Table.from_batches(held)


def find(up: np.ndarray | list, x: int) -> int:
    while up[x] != x:
        up[x] = up[up[x]]
        x = up[x]
    return x


def forest(fp: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of one bucket's fingerprints.

    From each open member, all unseen members within the radius join its component: every comparison
    is made against members that no component holds yet, so dense groups cost little.
    """
    left, out = np.arange(len(fp)), []
    while len(left) > 1:
        todo, left = [int(left[0])], left[1:]
        while todo and len(left):
            x = todo.pop()
            near = np.bitwise_count(fp[left] ^ fp[x]) <= radius
            if near.any():
                got = left[near]
                out += [(x, int(y)) for y in got]
                todo += got.tolist()
                left = left[~near]
    return out


#: Buckets up to this size are compared all at once, larger ones one by one.
TOGETHER = 64


def spanning(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Positions of the pairs that a spanning forest needs."""
    up: dict[int, int] = {}
    keep = []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        while (z := up.get(x, x)) != x:
            x = z
        while (z := up.get(y, y)) != y:
            y = z
        if x != y:
            up[max(x, y)] = min(x, y)
            keep.append(i)
    return np.array(keep, int)


def linked_groups(t: pa.Table, radius: int, keys: tuple[str, ...] = ("bucket", "part")) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers (a, b) of links that span each bucket's components, over a table of whole groups."""
    n = t.num_rows
    cols = [t.column(k).to_numpy() for k in keys]
    fp = t.column("fp").to_numpy().view(np.uint64)
    new = np.ones(n, bool)
    new[1:] = False
    for c in cols:
        new[1:] |= c[1:] != c[:-1]
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, n))
    small = np.repeat(np.where(sizes <= TOGETHER, sizes, 0), sizes)
    place = np.arange(n) - np.repeat(starts, sizes)
    left, right = [], []
    lag, rows = 1, np.flatnonzero(small > 1)
    while len(rows := rows[place[rows] + lag < small[rows]]):
        a = rows[np.bitwise_count(fp[rows] ^ fp[rows + lag]) <= radius]
        left.append(a)
        right.append(a + lag)
        lag += 1
    if left:
        a, b = np.concatenate(left), np.concatenate(right)
        keep = spanning(a, b)
        if len(keep):
            yield a[keep], b[keep]
    large = sizes > TOGETHER
    for s, k in zip(starts[large].tolist(), sizes[large].tolist()):
        if pairs := forest(fp[s : s + k], radius):
            p = np.array(pairs) + s
            yield p[:, 0], p[:, 1]


def hamming_links(nodes: DataFrame, radius: int, n: int) -> DataFrame:
    """Links (a, b), a < b, that connect what fingerprints within the radius connect. nodes: (node long, fp long), each fp once."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ("bucket", "part")):
            node = t.column("node").to_numpy()
            for a, b in linked_groups(t, radius):
                yield pa.record_batch([pa.array(np.minimum(node[a], node[b])), pa.array(np.maximum(node[a], node[b]))], names=["a", "b"])

    return bucketed(nodes, radius, n).mapInArrow(links, "a long, b long").distinct()


def connected_components(links: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, component) for every node of links (a, b): component is the smallest node reachable.

    Alternates large-star and small-star steps until nothing changes; each round ends in the shared folder.
    """

    def near(pairs: DataFrame, total: int) -> DataFrame:
        """Each (u, v) with m, the least of u and its neighbours."""
        least = cut(pairs.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count("*").alias("n_rows")))
        kept.append(least)
        return join_by_counts(pairs, least, "u", total)

    def totals(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    kept: list[DataFrame] = []
    edges = cut(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    state = totals(edges)
    for _ in range(rounds):
        if not state[0]:
            break
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = near(both, 2 * state[0]).where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a <> b").distinct()
        large = cut(large)
        down = near(large.select(F.col("b").alias("u"), F.col("a").alias("v")), state[0])
        small = down.where("v <> m").select(F.col("m").alias("a"), F.col("v").alias("b")).unionByName(down.select(F.col("m").alias("a"), F.col("u").alias("b"))).where("a <> b").distinct()
        new = cut(small)
        for x in (edges, large, *kept):
            drop_cut(x)
        kept.clear()
        edges, before, state = new, state, totals(new)
        if state == before:
            break
    ends = edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return ends.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
