"""Mixing to target weights by soft membership: domain posteriors, then projected-gradient least squares for document rates."""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, Packed, bounded_sample, cut, drop_cut, sliced, table, utf8, with_fields

#: Hash slots of the classifier; training texts per domain at most, drawn by a hash of the id; full gradient steps.
SLOTS, PER_DOMAIN, STEPS = 1 << 12, 500, 300
#: The least rate of a document, so that none is lost; there is no upper bound.
FLOOR = 1.0
#: The solver ends when no domain is off its target by more than this share, or after ROUNDS passes over tokens and posteriors.
CLOSE, ROUNDS = 1e-4, 14
#: Where no growth is asked for: totals to try, as multiples of the least under which no domain shrinks, until all targets are met.
SLACK = (1.02, 1.1, 1.3, 2.0)
#: Target shares of the domains of `labels` (below): what reads well gains against the rest.
DOMAINS = {"good": 0.80, "poor": 0.12, "toxic": 0.08}


def tokens(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Words between white space, of each row."""
    word = ~SPACE[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    at = offs[:-1][offs[:-1] < len(data)]
    first[at] = word[at]
    total = np.concatenate([[0], np.cumsum(first)])
    return total[offs[1:]] - total[offs[:-1]]


def slots(data: np.ndarray) -> np.ndarray:
    """Slot of the three bytes that begin at each byte."""
    b = np.concatenate([data | (data < 91).astype(np.uint8) * (data > 64) * np.uint8(32), np.full(2, 32, np.uint8)]).astype(np.uint32)
    return (((b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)) * np.uint32(0x9E3779B1)) >> np.uint32(20)).astype(np.int32)


@dataclass
class Classifier:
    domains: list[str]
    weights: np.ndarray
    bias: np.ndarray

    def posteriors(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Softmax over the mean of the slots' weights; rows without text get the prior."""
        n, at = len(offs) - 1, slots(data)
        size = np.diff(offs)
        z = np.tile(self.bias, (n, 1))
        full = size > 0
        if full.any():
            for j in range(len(self.domains)):
                z[full, j] += np.add.reduceat(self.weights[:, j][at], offs[:-1][full]) / size[full]
        p = np.exp(z - z.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)


def train(rows: list[tuple[str, bytes, bytes]], prior: dict[str, float], domains: list[str]) -> Classifier:
    """Multinomial logistic regression by full gradient steps, from (domain, slots as uint16, their shares as float32); then shifted to the prior."""
    k = len(domains)
    w, bias = np.zeros((SLOTS, k), np.float32), np.zeros(k, np.float32)
    if rows:
        x, y = np.zeros((len(rows), SLOTS), np.float32), np.zeros((len(rows), k), np.float32)
        for i, (domain, slot, share) in enumerate(rows):
            x[i, np.frombuffer(slot, np.uint16)] = np.frombuffer(share, np.float32)
            y[i, domains.index(domain)] = 1
        each = y / np.maximum(y.sum(0), 1)[y.argmax(1)][:, None]  # every domain weighs the same
        weight = each.sum(1, keepdims=True) / max(1, (y.sum(0) > 0).sum())
        scale = (1 / np.sqrt(np.einsum("ij,ij->j", x, x) / len(x) + 1e-8)).astype(np.float32)
        x *= scale
        speed = np.zeros_like(w)
        for _ in range(STEPS):
            z = x @ w + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            g = weight * (p - y)
            speed = np.float32(0.9) * speed + x.T @ g + np.float32(1e-5) * w
            w -= np.float32(0.02) * speed
            bias -= np.float32(0.1) * g.sum(0)
        w *= scale[:, None]
    shift = np.log(np.array([max(prior.get(d, 0.0), 1e-6) for d in domains])) + np.log(k)
    return Classifier(domains, w.astype(np.float64), bias + shift)


def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(domain, slots, shares) of (domain, text): at most six bytes a slot, whatever the text's length."""
    for b in batches:
        out = []
        for text in b.column("text"):
            raw = np.frombuffer(text.as_py().encode(), np.uint8)
            n = np.bincount(slots(raw), minlength=SLOTS)
            at = np.flatnonzero(n)
            out.append((at.astype(np.uint16).tobytes(), (n[at] / max(1, len(raw))).astype(np.float32).tobytes()))
        yield pa.record_batch([b.column("domain"), pa.array([s for s, _ in out], pa.binary()), pa.array([v for _, v in out], pa.binary())], names=["domain", "slots", "shares"])


def rates(history: np.ndarray, p: np.ndarray, floor: float = FLOOR, cap: float = np.inf) -> np.ndarray:
    """Each document's rate after the steps so far: a step lowers it by its posteriors against the step, and projects it to [floor, cap]."""
    r = np.clip(np.ones(len(p)), floor, cap)
    for step in history:
        r = np.clip(r - p @ step, floor, cap)
    return r


def fit_rates(features: DataFrame, domains: list[str], targets: np.ndarray, floor: float = FLOOR, cap: float = np.inf) -> np.ndarray:
    """The steps of solve()."""
    return solve(features, targets, floor, cap)[0]


def solve(features: DataFrame, targets: np.ndarray, floor: float = FLOOR, cap: float = np.inf, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(steps, gaps): steps (rounds by domains) that lead all rates to the least-squares solution, and each domain's share by which it misses its target.

    Minimises the squared gaps of the expected tokens, over rates in [floor, cap]. The gradient in a document's rate is
    its tokens times its posteriors against the gaps; steps are scaled by tokens, so that long documents do not rule, and by
    the domains' Gram matrix over the rates between the bounds, and halved as long as they do not help. A pass over the features
    (tokens, p) yields only totals by domain; rates are replayed from the steps, so no state of the documents is kept.
    """
    k = len(targets)

    def totals(history: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros(k + 2 * k * k)
            for b in batches:
                t = b.column("tokens").to_numpy(zero_copy_only=False).astype(float)
                p = np.array(b.column("p").flatten()).reshape(-1, k)
                r = rates(history, p, floor, cap)
                sums[:k] += (r * t) @ p
                for at, free in ((k, (r > floor) & (r < cap)), (k + k * k, np.ones(len(r), bool))):
                    sums[at : at + k * k] += (p * (t * free)[:, None]).T.dot(p).ravel()
            yield pa.record_batch([pa.array(range(len(sums)), pa.int32()), pa.array(sums)], names=["i", "v"])

        v = np.zeros(k + 2 * k * k)
        for i, x in features.mapInArrow(each, "i int, v double").groupBy("i").agg(F.sum("v")).collect():
            v[i] = x
        return v[:k], v[k : k + k * k].reshape(k, k), v[k + k * k :].reshape(k, k)

    miss = lambda now: (now - targets) / np.maximum(targets, 1.0)
    history = np.zeros((0, k))
    now, free, every = totals(history)
    while rounds > 0 and np.abs(miss(now)).max() >= CLOSE:
        gram = free + (1e-3 if len(history) else 1.0) * every
        step = np.linalg.solve(gram + 1e-9 * np.trace(gram) * np.eye(k), now - targets)
        for _ in range(4):
            tried, rounds = np.vstack([history, step]), rounds - 1
            new, new_free, _ = totals(tried)
            if np.abs(miss(new)).max() < np.abs(miss(now)).max():
                break
            step = step / 2
        else:
            break
        slow = np.abs(miss(new)).max() > 0.7 * np.abs(miss(now)).max()
        history, now, free = tried, new, new_free
        if slow and len(history) > 4:
            break
    return history, miss(now)


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text", growth: float | None = None, floor: float = FLOOR, strict: bool = False) -> DataFrame:
    """docs with tokens long, posteriors array<double> (by sorted domain), rate double and copies int, in place of columns of these names; others stay.

    labelled: (id, domain), of which at most PER_DOMAIN texts a domain train the classifier. targets: domain to weight;
    they are scaled so that the expected tokens become `growth` times the present ones; unset, to the first total of SLACK that
    all domains reach to a share of CLOSE. Where posteriors and floor allow no such rates, the nearest are taken, and a
    warning, or with `strict` a ValueError, names each domain and by how much it is off. floor: the least rate; 0 allows any.
    copies rounds the rate up or down by a hash of id and text, so that its expectation is the rate.
    Null and empty texts have no tokens, get the prior as posteriors, and stay once. Long texts are read whole. Repeated rows
    count each; ids of labelled that docs lacks, null domains and domains without target are ignored; of several domains of an
    id the first in the alphabet counts, of several texts the smallest. Without labels all posteriors are equal; an empty table gives an empty one.
    """
    domains = sorted(targets)
    packed = Packed(docs, id=id_col, text=text_col)
    given = packed.df
    known = labelled.where(F.col("domain").isin(domains)).groupBy(F.col(id_col).alias("id")).agg(F.min("domain").alias("domain"))
    counts = {r["domain"]: r["count"] for r in known.groupBy("domain").count().collect()}
    drawn = bounded_sample(known, "domain", "id", PER_DOMAIN)
    texts = given.where(F.col("text").isNotNull()).select("id", "text").join(F.broadcast(drawn), "id").groupBy("id", "domain").agg(F.min("text").alias("text"))
    rows = texts.orderBy("id").select("domain", "text").mapInArrow(shares, "domain string, slots binary, shares binary").collect()
    model = train([tuple(r) for r in rows], {d: n / sum(counts.values()) for d, n in counts.items()}, domains)
    del rows

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, "text", 2 << 20):
            data, offs = utf8(b.column("text"))
            p = model.posteriors(data, offs)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, p.size + 1, p.shape[1]), pa.int32()), pa.array(p.ravel()))
            yield pa.record_batch([pa.array(tokens(data, offs), pa.int64()), flat], names=["tokens", "p"])

    compact = cut(given.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(each, "tokens long, p array<double>"))
    present = np.array(compact.agg(*[F.coalesce(F.sum(F.col("tokens") * F.get("p", F.lit(j))), F.lit(0.0)) for j in range(len(domains))]).first(), float)
    share = np.array([targets[d] for d in domains], float) / sum(targets.values())
    steps, gaps = np.zeros((0, len(domains))), np.zeros(len(domains))
    if present.sum() > 0:
        least = (max(1.0, floor) * present / np.maximum(share, 1e-9)).max()
        for total in [present.sum() * growth] if growth else [least * s for s in SLACK]:
            before = np.abs(gaps).max() or np.inf
            steps, gaps = solve(compact, share * total, floor)
            if CLOSE <= np.abs(gaps).max() < 0.8 * before:
                continue
            break  # met, or a larger total does not help
        if np.abs(gaps).max() >= CLOSE:
            said = "targets missed: " + ", ".join(f"{d} by {g:+.4%}" for d, g in zip(domains, gaps))
            if strict:
                raise ValueError(said)
            warnings.warn(said)
    drop_cut(compact)
    schema = with_fields(given, "tokens long, posteriors array<double>, rate double, copies int")
    key = F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, "text", 2 << 20):
            data, offs = utf8(b.column("text"))
            p = model.posteriors(data, offs)
            n = tokens(data, offs)
            r = np.where(n > 0, rates(steps, p, floor), 1.0)
            draw = (b.column("key").to_numpy().view(np.uint64) >> np.uint64(11)).astype(float) / float(1 << 53)
            copies = np.floor(r) + (draw < r - np.floor(r))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, p.size + 1, p.shape[1]), pa.int32()), pa.array(p.ravel()))
            yield pa.record_batch([*b.columns[:-1], pa.array(n, pa.int64()), flat, pa.array(r), pa.array(copies.astype(np.int32))], names=schema.names)

    out = given.withColumn("key", key).mapInArrow(apply, schema)
    return packed.back(out, **{c: F.col(c) for c in ("tokens", "posteriors", "rate", "copies")})


def domain_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the labels table: toxic, or good or poor by quality."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    return labels.select("doc_id", domain.alias("domain"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = mix(docs, domain_labels(table(spark, sf_dir, "labels")), DOMAINS)
    return out.select("doc_id", "tokens", *[F.get("posteriors", F.lit(i)).alias(f"p_{d}") for i, d in enumerate(sorted(DOMAINS))], "rate", "copies")
