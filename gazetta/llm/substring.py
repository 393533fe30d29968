"""Substring dedup: content-defined chunks by a gear rolling hash, deduplicated by digest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, Packed, cut, join_by_counts, left_join_few, mixed, sliced, table, utf8

#: A chunk has at least MIN bytes and ends after the first white space whose rolling hash has its MASK bits zero,
#: or after about MAX bytes. WINDOW: bytes that the hash remembers, at most MIN.
MIN, MAX, MASK, WINDOW = 24, 256, 0b11 << 22, 16
#: Repeated chunks go only in runs of at least this many bytes: shorter ones are everyday phrases.
RUN = 96
#: 64-bit random words of the gear hash, from a rule.
GEAR = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
DIGEST = "digest binary, doc_id long, body long, at int, end int, again boolean"


def gear(data: np.ndarray) -> np.ndarray:
    """Rolling hash at each byte: the sum of GEAR[b] shifted by the byte's age, over the last WINDOW bytes."""
    h = (GEAR[data] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    span = 1
    while span < WINDOW:
        h[span:] += h[:-span] << np.uint32(span)
        span *= 2
    return h


def cuts(data: np.ndarray, offs: np.ndarray) -> list[list[int]]:
    """Ends of the chunks of each row."""
    marks = np.flatnonzero(SPACE[data] & ((gear(data) & np.uint32(MASK)) == 0)) + 1
    lo = np.searchsorted(marks, offs[:-1], "right")
    hi = np.searchsorted(marks, offs[1:], "right")
    out, marks, raw, limits = [], marks.tolist(), data, offs.tolist()
    for r in range(len(offs) - 1):
        at, end, row = limits[r], limits[r + 1], []
        for m in [*marks[lo[r] : hi[r]], end]:
            while m - at > MAX:  # no mark for long: cut at a character's start
                p = at + MAX
                while p > at + MAX - 4 and raw[p] & 0xC0 == 0x80:
                    p -= 1
                row.append(p)
                at = p
            if m - at >= MIN or m == end and m > at:
                row.append(m)
                at = m
        out.append(row)
    return out


def chunks(docs: DataFrame) -> DataFrame:
    """One row for each chunk of docs (doc_id, text): digest, byte span, and whether the document had it before. body: hash of the whole text."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, "text"):
            data, offs = utf8(b.column("text"))
            raw, ids = data.tobytes(), b.column("doc_id").to_pylist()
            digests, doc, body, start, end, again = [], [], [], [], [], []
            for r, ends in enumerate(cuts(data, offs)):
                o, seen = int(offs[r]), set()
                h = xxhash.xxh64_intdigest(raw[o : offs[r + 1]], 42)
                h -= (h >> 63) << 64
                at = o
                for e in ends:
                    d = xxhash.xxh3_128_digest(raw[at:e])
                    digests.append(d)
                    again.append(d in seen)
                    seen.add(d)
                    start.append(at - o)
                    end.append(e - o)
                    at = e
                doc += [ids[r]] * len(ends)
                body += [h] * len(ends)
            yield pa.record_batch([pa.array(digests, pa.binary()), pa.array(doc, pa.int64()), pa.array(body, pa.int64()), pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array(again, pa.bool_())], names=["digest", "doc_id", "body", "at", "end", "again"])

    return docs.where("doc_id IS NOT NULL AND text <> ''").mapInArrow(each, DIGEST)


def repeated_spans(docs: DataFrame, run: int = RUN) -> DataFrame:
    """(doc_id, body, spans): for each document that repeats others or itself, its repeated byte spans, as structs (at, end, first).

    A chunk is repeated if a document of smaller id, `first`, or an earlier place of its own has it;
    adjoining repeated chunks form a run, and runs of fewer than `run` bytes stay.
    """
    # Ids and lengths only: the texts of the chunks are never moved.
    all_chunks = cut(chunks(docs))
    total = all_chunks.count()
    shared = cut(all_chunks.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n_rows")).where("n_rows > 1"))
    hits = join_by_counts(all_chunks, shared, "digest", total).where("again OR first < doc_id")
    spans = hits.groupBy("doc_id", "body").agg(F.array_sort(F.collect_set(F.struct("at", "end", "first"))).alias("spans"))  # a set: rows may repeat
    none = F.array().cast("array<struct<at:int,end:int,first:array<bigint>>>")
    item = lambda at, end, first: F.struct(at.alias("at"), end.alias("end"), first.alias("first"))
    last = lambda acc: F.element_at(acc, -1)
    joins = F.aggregate(
        "spans", none,
        lambda acc, x: F.when((F.size(acc) > 0) & (last(acc)["end"] == x["at"]), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(item(last(acc)["at"], x["end"], F.array_union(last(acc)["first"], F.array(x["first"])))))).otherwise(F.concat(acc, F.array(item(x["at"], x["end"], F.array(x["first"]))))),
    )
    return spans.select("doc_id", "body", F.filter(joins, lambda x: x["end"] - x["at"] >= run).alias("spans")).where(F.size("spans") > 0)


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = RUN) -> DataFrame:
    """docs with every repeated passage cut from its text, and column removed_spans (structs at, end in bytes, first: ids that keep the passage).

    Each passage stays in the document of smallest id, at its first place there. Documents without repeats, null and
    empty texts and rows without id come back as they are, removed_spans null. Rows that repeat both id and text count
    as one document and get the same text; an empty table gives an empty one.
    """
    packed = Packed(docs, id=id_col, text=text_col)
    plain = packed.df.select(F.col("id").cast("long").alias("doc_id"), "text")
    spans = repeated_spans(plain, run).select(F.col("doc_id").alias("_id"), F.col("body").alias("_body"), F.col("spans").alias("removed_spans"))
    held = left_join_few(packed.df, cut(spans))
    raw = F.col("text").cast("binary")
    ends = F.concat(F.transform("removed_spans", lambda x: x["at"]), F.array(F.octet_length("text")))
    starts = F.concat(F.array(F.lit(0)), F.transform("removed_spans", lambda x: x["end"]))
    pieces = F.zip_with(starts, ends, lambda s, e: F.decode(F.substring(raw, s + 1, e - s), "UTF-8"))
    left = held.withColumn("text", F.when(F.col("removed_spans").isNull(), F.col("text")).otherwise(F.array_join(pieces, "")))
    return packed.back(left, removed_spans=F.col("removed_spans"))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that lose a passage: what is left of them, and the ids of the documents that keep the passages."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = dedup_substrings(docs).where("removed_spans IS NOT NULL")
    gone = F.aggregate("removed_spans", F.lit(0), lambda n, x: n + x["end"] - x["at"])
    firsts = F.array_sort(F.array_distinct(F.flatten(F.transform("removed_spans", lambda x: x["first"]))))
    return done.select("doc_id", F.size("removed_spans").cast("long").alias("n_spans"), gone.cast("long").alias("removed_bytes"), firsts.alias("kept_in"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
