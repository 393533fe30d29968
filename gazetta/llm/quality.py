"""Quality classifier: supervised subword embeddings, averaged per document, with a softmax output."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, Packed, bounded_sample, crc_bucket, lowered, runs, sliced, span_hashes, table, utf8, with_fields

#: Hash slots, width of the vectors, length of character sequences in bytes.
SLOTS, WIDTH, GRAM = 1 << 17, 16, 4
#: Training texts per label at most, drawn by a hash of the id; passes over them; first learning rate.
PER_LABEL, EPOCHS, RATE = 2000, 4, 0.4
THRESHOLD = 0.7


def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slots, rows): each word between white space, whole, and each character sequence in it with its edges."""
    data = lowered(data)
    word = ~SPACE[data]
    starts, ends, rows = runs(word, offs)
    slots = (span_hashes(data, starts, ends) % np.uint64(SLOTS // 2)).astype(np.int32)
    b = np.where(word, data, np.uint8(32)).astype(np.uint32)
    n = len(b)
    padded = np.concatenate([np.full(1, 32, np.uint32), b, np.full(GRAM, 32, np.uint32)])
    h = np.zeros(n, np.uint32)
    for i in range(GRAM):
        h = h * np.uint32(0x01000193) ^ padded[i : n + i]
    at = np.flatnonzero(word)
    grams = (((h[at] * np.uint32(0x9E3779B1)) >> np.uint32(8)) % np.uint32(SLOTS // 2)).astype(np.int32) + SLOTS // 2
    return np.concatenate([slots, grams]), np.concatenate([rows, np.searchsorted(offs, at, "right") - 1])


@dataclass
class Model:
    """The trained network. As the output is linear in the averaged vectors, a slot's share of the logit is one number, `logit`."""

    logit: np.ndarray
    bias: float

    def scores(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        n = len(offs) - 1
        slots, rows = features(data, offs)
        size = np.bincount(rows, minlength=n)
        mean = np.bincount(rows, weights=self.logit[slots], minlength=n) / np.maximum(size, 1)
        return 1 / (1 + np.exp(-np.clip(mean + self.bias, -30, 30)))


def train(rows: list[tuple[int, str]], prior: float | None = None, seed: int = 7) -> Model:
    """Stochastic gradient descent on the cross entropy of (label, text). prior: share of label 1 where the sample's differs."""
    random = np.random.default_rng(seed)
    vectors = ((random.random((SLOTS, WIDTH)) - 0.5) / WIDTH).astype(np.float32)
    out, bias = np.zeros((WIDTH, 2), np.float32), np.zeros(2, np.float32)
    if len({y for y, _ in rows}) < 2:  # nothing to tell apart
        p = float(rows[0][0]) if rows else 0.5
        return Model(np.zeros(SLOTS), float(np.log((p + 1e-3) / (1 - p + 1e-3))))
    docs = []
    for y, text in rows:
        raw = text.encode()
        slots, _ = features(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        u, n = np.unique(slots, return_counts=True)
        docs.append((y, u, (n / max(1, len(slots))).astype(np.float32)))
    step, steps = 0, EPOCHS * len(docs)
    for _ in range(EPOCHS):
        for i in random.permutation(len(docs)):
            y, u, share = docs[i]
            rate = np.float32(RATE * (1 - step / steps))
            step += 1
            hidden = share @ vectors[u]
            z = hidden @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = out @ p
            out -= rate * np.outer(hidden, p)
            bias -= rate * p
            # A document's slots share one gradient; scaled up by their number, as each holds a small share of the mean.
            vectors[u] -= (rate * len(u) ** 0.5) * share[:, None] * back
    own = np.mean([y for y, _ in rows])
    shift = np.log(prior / (1 - prior)) - np.log(own / (1 - own)) if prior and 0 < prior < 1 else 0.0
    return Model((vectors @ (out[:, 1] - out[:, 0])).astype(np.float64), float(bias[1] - bias[0] + shift))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, per_label: int = PER_LABEL) -> Model:
    """A model from the quality labels of rows that `learn` allows, at most per_label texts of each label and LABEL_BYTES of text.

    Labels other than 0 and 1 and null texts are left out; of several labels of one document the largest counts, of several texts the smallest.
    """
    known = labels.where(learn & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    counts = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    drawn = bounded_sample(known, "quality", "doc_id", per_label)
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    rows = bounded_sample(texts, "quality", "doc_id", per_label, F.octet_length("text")).orderBy("doc_id").collect()
    total = sum(counts.values())
    return train([(r["quality"], r["text"]) for r in rows], counts.get(1, 0) / total if total else None)


def score(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """df with score and predicted, in place of columns of these names; all others stay, whatever their names.

    Null and empty texts get what the label shares alone say; long texts are read whole; repeated rows are scored alike; an empty table stays empty.
    """
    packed = Packed(df, text=text_col)
    schema = with_fields(packed.df, "score double, predicted int")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, "text", 2 << 20):
            s = model.scores(*utf8(b.column("text")))
            yield pa.record_batch([*b.columns, pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], names=schema.names)

    return packed.back(packed.df.mapInArrow(each, schema), score=F.col("score"), predicted=F.col("predicted"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = crc_bucket("doc_id", 4) == 2
    model = fit(docs, labels, ~held_out)
    return score(docs.select("doc_id", held_out.alias("held_out"), "text"), model).select("doc_id", "held_out", "score", "predicted")
