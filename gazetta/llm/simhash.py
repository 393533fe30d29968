"""SimHash near-duplicates: fingerprints, pigeonhole links, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Packed, cut, join_by_counts, left_join_few, table
from .components import connected_components, hamming_links

#: The contract's shingle length in words, hash seed and bits that may differ.
SHINGLE, SEED, RADIUS = 3, 42, 3


def fingerprint(text: str | bytes | None, words: int = SHINGLE) -> int:
    """SimHash of a text: bit i is set if it is set in over half of the shingles' hashes."""
    parts = (text.encode() if isinstance(text, str) else text or b"").lower().split()
    if not parts:
        return 0
    line = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(words, len(parts))
    digest = xxhash.xxh64_digest
    return majority(b"".join([digest(line[s:e], SEED) for s, e in zip(starts[: len(parts) - k + 1].tolist(), ends[k - 1 :].tolist())]))


def majority(digests: bytes) -> int:
    """Of big-endian 64-bit hashes, the bits set in over half."""
    bits = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    counts = np.concatenate([np.bincount(bits[:, i], minlength=256) for i in range(8)]) if len(bits) > 4096 else None
    if counts is None:
        ones = np.unpackbits(bits, axis=1).sum(0, dtype=np.int64)
    else:  # long texts: counts of byte values hold all that is needed
        ones = (counts.reshape(8, 256) @ np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1)).ravel()
    return int.from_bytes(np.packbits(2 * ones > len(bits)).tobytes(), "big")


def hashed(texts: pa.Array, words: int) -> pa.Array:
    """Fingerprints of a string column, as longs; null counts as empty."""
    fps = np.array([fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", words) for t in texts.cast(pa.binary())], np.uint64)
    return pa.array(fps.view(np.int64))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE) -> DataFrame:
    """(doc_id, fp long), one row for each row of docs; null text counts as empty."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([b.column(0), hashed(b.column(1), words)], names=["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(each, "doc_id long, fp long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, words: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint, component_id, copies), one row for each row of docs.

    Documents link if their fingerprints differ in at most `radius` bits; component_id is the smallest id
    reachable. copies: rows with the same fingerprint. Equal fingerprints are one node of the graph, so copies
    cost nothing. Null and empty texts have fingerprint 0 and link like any other; repeated rows each get their row;
    a row without id gets its component but never names one. An empty table gives an empty result.
    """
    fps = cut(fingerprints(docs, id_col, text_col, words))
    classes = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("node"), F.count("*").alias("n_rows")))
    total, n = fps.count(), classes.count()
    named = classes.where("node IS NOT NULL")
    found = connected_components(hamming_links(named.select("node", "fp"), radius, n))
    ends = classes.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"), F.col("n_rows").alias("copies"), "n_rows")
    out = join_by_counts(fps, ends, "fp", total)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "copies")


def keep_one(docs: DataFrame, radius: int = RADIUS, words: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without those that a near-duplicate stands for; all columns stay, whatever their names.

    Rows are grouped by their own fingerprints, and of each group the row of smallest id stays, of several the one whose text
    has the smallest hash, of rows that repeat both one. So rows of one id with unrelated texts all stay. Rows without id
    stay. Null and empty texts are one group. Only the rows that go, and those that repeat, are shuffled with their texts.
    """
    packed = Packed(docs, id=id_col, text=text_col)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([b.column(0), b.column(1), hashed(b.column(2), words)], names=["id", "body", "fp"])

    given = packed.df.where("id IS NOT NULL").select(F.col("id").cast("long").alias("id"), F.xxhash64("text").alias("body"), "text")
    rows = cut(given.mapInArrow(each, "id long, body long, fp long"))
    classes = cut(rows.groupBy("fp").agg(F.min(F.struct("id", "body")).alias("best"), F.count("*").alias("n_rows")))
    found = connected_components(hamming_links(classes.select(F.col("fp").alias("node"), "fp"), radius, classes.count()))
    named = classes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("head", F.coalesce("component", "fp"))
    heads = named.groupBy("head").agg(F.min("best").alias("first"), F.count("*").alias("n_rows"))
    ends = join_by_counts(named.select("fp", "head", F.col("n_rows").alias("rows")), heads, "head", classes.count()).select("fp", "first", F.col("rows").alias("n_rows"))
    decided = join_by_counts(rows, ends, "fp", rows.count()).withColumn("gone", F.struct("id", "body") != F.col("first"))
    few = cut(decided.groupBy(F.col("id").alias("_id"), F.col("body").alias("_body")).agg(F.max("gone").alias("gone"), F.count("*").alias("n")).where("gone OR n > 1").drop("n"))
    held = left_join_few(packed.df, few)
    fresh = held.where("gone IS NULL")
    once = held.where("NOT gone").dropDuplicates(["id", "text"])
    return packed.back(fresh.unionByName(once))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
