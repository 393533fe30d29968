"""Helpers that the operators of this subpackage share: tables, lineage cuts, Arrow text buffers, hot keys."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Text handled at once by a Python worker, in bytes; one row may be longer.
SLICE_BYTES = 4 << 20
#: A key is hot from this many rows, and only if it holds at least one row in HOT_SHARE of the table:
#: so a table has at most HOT_SHARE hot keys, and a list of them is small enough to broadcast at any scale.
HOT_ROWS, HOT_SHARE = 300, 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; only where the session names none, as in tests, a local one is set."""
    sc = spark.sparkContext
    held = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir")
    if not held:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("on a cluster, spark.checkpoint.dir must name a folder that driver and executors share")
        held = tempfile.mkdtemp(prefix="gazetta-")
        sc.setCheckpointDir(held)
        held = sc.getCheckpointDir()
    return held


def cut(df: DataFrame) -> DataFrame:
    """Writes df to the shared folder and reads it again: lost executors cost no recomputation and the lineage ends here."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def drop_cut(df: DataFrame) -> None:
    """Deletes what cut() wrote, once nothing reads it any more."""
    if path := getattr(df, "_cut_path", None):
        jvm, spark = df.sparkSession.sparkContext._jvm, df.sparkSession
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Frees what finished plans hold on the driver: frames that nothing names, then the JVM's objects, upon which Spark drops their broadcasts and shuffles. Costs a full collection of the driver's heap, and no work."""
    gc.collect()
    spark.sparkContext._jvm.java.lang.System.gc()


def crc_bucket(key: str, n: int) -> Column:
    """crc32 of an id written as text, modulo n."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % n


def hot_rows(total: int) -> int:
    return max(HOT_ROWS, total // HOT_SHARE)


def join_by_counts(big: DataFrame, small: DataFrame, key: str, total: int, how: str = "inner") -> DataFrame:
    """big joined to small, which has one row per key and `n_rows`, the key's rows in big, and loses it.

    The at most HOT_SHARE hot keys are broadcast, so that their rows are never shuffled; the rest is joined by shuffling.
    """
    hot = F.broadcast(small.where(F.col("n_rows") >= hot_rows(total)).drop("n_rows"))
    cold = small.where(F.col("n_rows") < hot_rows(total)).drop("n_rows")
    return big.join(hot, key).unionByName(big.join(hot, key, "left_anti").join(cold.hint("merge"), key, how))


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the n + 1 offsets of its rows in them; null counts as empty."""
    col = pc.fill_null(col, "").cast(pa.large_binary())
    offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    return (data[offs[0] : offs[-1]], offs - offs[0]) if len(offs) else (data[:0], np.zeros(1, np.int64))


def sliced(batches: Iterator[pa.RecordBatch], text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches of at most `most` bytes of text, or of one row."""
    for b in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < b.num_rows:
            to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + most, "right")))
            yield b.slice(at, to - at)
            at = to


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased."""
    lut = np.arange(256, dtype=np.uint8)
    lut[65:91] += 32
    return lut[data]


#: Multiplier of the rolling word hash; odd, so that it has an inverse modulo 2 ** 64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hashes of spans of data, from prefix sums: linear in the bytes, whatever the spans."""
    n = len(data)
    if not len(starts):
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        power, back = np.full(n + 1, _BASE, np.uint64), np.full(n + 1, _INVERSE, np.uint64)
        power[0] = back[0] = 1
        power, back = np.cumprod(power, dtype=np.uint64), np.cumprod(back, dtype=np.uint64)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
        h = (sums[ends] - sums[starts]) * back[starts]
        return mixed(h ^ (ends - starts).astype(np.uint64))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all output bits."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return h ^ (h >> np.uint64(33))


def runs(inside: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the maximal spans of True bytes; no span crosses a row's end."""
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    at = offs[(offs > 0) & (offs < len(inside))]
    first[at] = inside[at]
    last = np.zeros(len(inside), bool)
    if len(inside):
        last[:-1] = inside[:-1] & (~inside[1:] | first[1:])
        last[-1] = inside[-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def row_sums(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, weights=values, minlength=n)


#: Labels that a sample may be drawn for, and bytes of text that a label gives at most.
MOST_LABELS, LABEL_BYTES = 1000, 6 << 20


def bounded_sample(df: DataFrame, label: str, key: str, per_label: int, size: Column | None = None, most_bytes: int = LABEL_BYTES) -> DataFrame:
    """At most per_label rows of each label, drawn by a hash of the key: the same rows at every run. With a size, as many of them as hold most_bytes together.

    More than MOST_LABELS labels are an error.
    """
    counts = {r[0]: r[1] for r in df.groupBy(label).count().limit(MOST_LABELS + 1).collect()}
    if len(counts) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} values of {label}")
    if not counts:
        return df
    draw = F.pmod(F.xxhash64(F.col(key), F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 1.1 * per_label / n))])
    order = Window.partitionBy(label).orderBy(F.xxhash64(F.col(key), F.lit(11)), key)
    drawn = df.where(draw < F.coalesce(share[F.col(label)], F.lit(0.0))).withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= per_label)
    if size is not None:
        drawn = drawn.withColumn("_held", F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, 0))).where((F.col("_rank") == 1) | (F.col("_held") <= most_bytes)).drop("_held")
    return drawn.drop("_rank")


#: Bits of a filter by hashed keys: of this size whatever the data.
FILTER_BITS = 1 << 24


def maybe_in(wanted: DataFrame, wanted_hash: Column, own_hash: Column) -> Column:
    """True if own_hash is, or by a collision seems to be, among wanted's hashes: it spares rows the join that follows.

    A table of FILTER_BITS bits, as a scalar subquery a part of the plan; the more keys, the less it holds back.
    """
    slot = lambda h: h.bitwiseAND(F.lit(FILTER_BITS - 1))
    bit = lambda h: F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int"))
    words = wanted.select(slot(wanted_hash).alias("s")).groupBy(F.shiftright("s", 6).alias("w")).agg(F.bit_or(bit(F.col("s"))).alias("v"))
    every = wanted.sparkSession.range(FILTER_BITS // 64).select(F.col("id").alias("w")).join(words, "w", "left").select("w", F.coalesce("v", F.lit(0).cast("long")).alias("v"))
    bits = every.agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "v"))), lambda x: x["v"]).alias("bits")).scalar()
    word = F.get(bits, F.shiftright(slot(own_hash), 6).cast("int"))
    return word.bitwiseAND(bit(own_hash)) != 0


def left_join_few(docs: DataFrame, few: DataFrame) -> DataFrame:
    """docs (id, text, _row) with few's further columns, joined on id and hash of the text (_id, _body). Documents that few lacks are not shuffled; few is read twice."""
    own = F.xxhash64(F.col("id").cast("long"), F.xxhash64("text"))
    hit = F.coalesce(maybe_in(few, F.xxhash64("_id", "_body"), own), F.lit(False))
    same = (F.col("id").cast("long") == F.col("_id")) & (F.xxhash64("text") == F.col("_body"))
    joined = docs.where(hit).join(few.hint("merge"), same, "left").drop("_id", "_body")
    nothing = {f.name: F.lit(None).cast(f.dataType) for f in few.schema if f.name not in ("_id", "_body")}
    return joined.unionByName(docs.where(~hit).withColumns(nothing))


class Packed:
    """A table as an operator handles it: `df` has the columns `own` under the operator's names and all others in one, `_row`.

    So no name of a user's column, with points, in another case or the same twice, meets one of the operator's.
    """

    def __init__(self, df: DataFrame, **own: str):
        self.names = list(df.columns)
        self.own = {name: self._place(col) for name, col in own.items()}
        flat = df.toDF(*[f"c{i}" for i in range(len(self.names))])
        rest = [F.col(f"c{i}") for i in range(len(self.names)) if i not in self.own.values()]
        self.df = flat.select(*[F.col(f"c{i}").alias(name) for name, i in self.own.items()], F.struct(*rest, F.lit(0).alias("_")).alias("_row"))

    def _place(self, col: str) -> int:
        same = [i for i, c in enumerate(self.names) if c == col] or [i for i, c in enumerate(self.names) if c.lower() == col.lower()]
        if not same:
            raise ValueError(f"no column {col} among {self.names}")
        return same[0]

    def back(self, out: DataFrame, **new: Column) -> DataFrame:
        """The table's columns in their order, own ones as `out` has them; `new` replaces columns of its names or follows."""
        by_place = {i: name for name, i in self.own.items()}
        old = [(new[c] if c in new else F.col(by_place[i]) if i in by_place else F.col("_row").getField(f"c{i}")).alias(c) for i, c in enumerate(self.names)]
        return out.select(*old, *[v.alias(c) for c, v in new.items() if c not in self.names])


def with_fields(df: DataFrame, ddl: str) -> StructType:
    """df's schema and more fields."""
    return StructType([*df.schema.fields, *StructType.fromDDL(ddl).fields])
