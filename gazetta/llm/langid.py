"""Language identification of mixed texts: script ranges, per-word scores, and Viterbi with a switching penalty."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Packed, bounded_sample, crc_bucket, lowered, runs, sliced, table, utf8, with_fields

#: Hash slots of the letter sequences' scores; sequences of 3 and 4 bytes share them.
SLOTS = 1 << 16
#: Training texts per language at most, drawn by a hash of the id.
PER_LANGUAGE = 1500
#: Most bytes of text that a language gives.
FIT_BYTES = 2 << 20
#: What a change of language costs on the path, in nats; and a word in a script that its language lacks.
SWITCH, FOREIGN = 12.0, 30.0
#: Scripts by ranges of a character's first byte in UTF-8 (fixed values of the encoding): Latin; Greek; Cyrillic;
#: Armenian; Hebrew; Arabic, Syriac, Thaana, NKo; Indic, Thai, Lao; Tibetan to Khmer; Latin and Greek extended to
#: symbols; kana and CJK signs; Han; Yi to Hangul; private and compatibility; beyond the basic plane.
SCRIPTS = [0x00, 0xCD, 0xD0, 0xD5, 0xD6, 0xD8, 0xE0, 0xE1, 0xE2, 0xE3, 0xE4, 0xEA, 0xEE, 0xF0]
UNKNOWN = "und"


def letters(data: np.ndarray) -> np.ndarray:
    """True at bytes of letters: ASCII letters, and all beyond ASCII but general punctuation and C2's signs."""
    is_letter = (data >= 0x80) | ((data | 0x20) >= 97) & ((data | 0x20) <= 122)
    for lead, size in ((0xE2, 3), (0xC2, 2)):
        at = np.flatnonzero(data == lead)
        if lead == 0xE2:
            at = at[at + 1 < len(data)]
            at = at[data[at + 1] == 0x80]
        else:
            at = at[at + 1 < len(data)]
            at = at[~np.isin(data[at + 1], (0xAA, 0xB5, 0xBA))]
        for i in range(size):
            is_letter[np.minimum(at + i, len(data) - 1)] = False
    return is_letter


def word_features(data: np.ndarray, offs: np.ndarray):
    """Words as spans of letters: starts, ends, rows, script of each; and two slots for each byte."""
    data = lowered(data)
    is_letter = letters(data)
    starts, ends, rows = runs(is_letter, offs)
    b = np.where(is_letter, data, np.uint8(32)).astype(np.uint32)
    padded = np.concatenate([np.full(2, 32, np.uint32), b, np.full(2, 32, np.uint32)])
    n = len(b)
    three = padded[1 : n + 1] | padded[2 : n + 2] << 8 | padded[3 : n + 3] << 16
    four = three | padded[4 : n + 4] << 24
    slot = lambda x, salt: (((x ^ np.uint32(salt)) * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64) % SLOTS
    script = np.zeros(len(starts), np.int8)
    if len(starts):
        kind = (np.searchsorted(np.array(SCRIPTS), data, "right") - 1).astype(np.int8)
        kind[(data & 0xC0) == 0x80] = 0
        script = np.maximum.reduceat(kind, starts)
    return starts, ends, rows, script, slot(three, 0), slot(four, 0x5BD1E995)


def span_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of values over spans that do not overlap."""
    at = np.empty(2 * len(starts), np.int64)
    at[0::2], at[1::2] = starts, ends
    if len(at) and at[-1] == len(values):
        return np.add.reduceat(values, at[:-1], axis=0)[0::2]
    return np.add.reduceat(values, at, axis=0)[0::2]


@dataclass
class Model:
    """langs: sorted; weights: slot and language to log probability; scripts: script and language to whether it is used."""

    langs: list[str]
    weights: np.ndarray
    scripts: np.ndarray

    def word_scores(self, data: np.ndarray, offs: np.ndarray):
        """ends - starts, rows and scores by language of the words of a buffer."""
        starts, ends, rows, script, three, four = word_features(data, offs)
        if not len(starts):
            return np.zeros(0, np.int64), rows, np.zeros((0, self.weights.shape[1]), np.float32)
        per = self.weights[three]
        per += self.weights[four]
        scores = span_sums(per, starts, ends)
        used = self.scripts[script]
        scores = np.where(used | ~used.any(1, keepdims=True), scores, scores - np.float32(FOREIGN))
        return ends - starts, rows, scores


def train(rows: list[tuple[str, str]]) -> Model:
    """From (language, text): multinomial log probabilities with add-half smoothing."""
    langs = sorted({lang for lang, _ in rows})
    counts = np.full((SLOTS, max(1, len(langs))), 0.5)
    scripts = np.zeros((len(SCRIPTS), max(1, len(langs))))
    for i, lang in enumerate(langs):
        texts = [t.encode() for k, t in rows if k == lang]
        for at in range(0, len(texts), 200):
            part = texts[at : at + 200]
            data, offs = np.frombuffer(b"".join(part), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in part])])
            starts, ends, _, script, three, four = word_features(data, offs)
            inside = np.repeat(starts, ends - starts) + np.arange((ends - starts).sum()) - np.repeat(np.cumsum(ends - starts) - (ends - starts), ends - starts)
            counts[:, i] += np.bincount(three[inside], minlength=SLOTS) + np.bincount(four[inside], minlength=SLOTS)
            scripts[:, i] += np.bincount(script, minlength=len(SCRIPTS))
    weights = np.log(counts / counts.sum(0)).astype(np.float32)
    return Model(langs, weights - weights.mean(1, keepdims=True), scripts >= 0.01 * np.maximum(scripts.sum(0), 1))


def viterbi(scores: np.ndarray, lengths: np.ndarray, penalty: float = SWITCH) -> np.ndarray:
    """Best language of each word. scores: words of all documents, one document after another, by language; lengths: words of each.

    All documents advance together, the longest first, so that a step is one array operation.
    """
    first = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    sizes, at = lengths[order], first[order]
    alive = np.searchsorted(-sizes, -np.arange(1, (sizes[0] if len(sizes) else 0) + 1), "right")
    path = np.zeros(len(scores), np.int8 if scores.shape[1] < 128 else np.int32)
    origin, jumped = np.zeros(len(scores), path.dtype), np.zeros(scores.shape, bool)
    best = np.zeros((len(sizes), scores.shape[1]), np.float32)
    for t, n in enumerate(alive.tolist()):
        here = at[:n] + t
        b = best[:n]
        if t:
            top = b.argmax(1)
            other = b[np.arange(n), top][:, None] - np.float32(penalty)
            origin[here], jumped[here] = top, other > b
            b = np.maximum(b, other) - other
        best[:n] = b + scores[here]
    now = best.argmax(1)
    for t in range(len(alive) - 1, -1, -1):
        n = alive[t]
        here = at[:n] + t
        path[here] = now[:n]
        now[:n] = np.where(jumped[here, now[:n]], origin[here], now[:n])
    return path


def spans(model: Model, texts: list[str | None], penalty: float = SWITCH) -> list[list[tuple[str, int]]]:
    """For each text, its stretches of one language: (language, letters in bytes)."""
    raw = [(t or "").encode() for t in texts]
    data, offs = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in raw])])
    size, rows, scores = model.word_scores(data, offs)
    path = viterbi(scores, np.bincount(rows, minlength=len(raw)), penalty)
    out: list[list[tuple[str, int]]] = [[] for _ in raw]
    for r, lang, n in zip(rows.tolist(), path.tolist(), size.tolist()):
        if out[r] and out[r][-1][0] == model.langs[lang]:
            out[r][-1] = (model.langs[lang], out[r][-1][1] + n)
        else:
            out[r].append((model.langs[lang], n))
    return out


def fit(docs: DataFrame, learn: Column, per_language: int = PER_LANGUAGE) -> Model:
    """A model from at most per_language texts of each language, and FIT_BYTES of text, among the rows that `learn` allows."""
    known = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    return train([(r["lang"], r["text"]) for r in bounded_sample(known.select("doc_id", "lang", "text"), "lang", "doc_id", per_language, F.octet_length("text"), FIT_BYTES).select("lang", "text").collect()])


def predict(df: DataFrame, model: Model, text_col: str = "text", penalty: float = SWITCH) -> DataFrame:
    """df with lang_pred, score and shares (of each language on the path), in place of columns of these names; all others stay.

    lang_pred: the language of most letters on the path; score: its share of them. Null texts and texts without
    a letter get `und` and 0, as do all if nothing was learned. Ties go to the language first in the alphabet. Long texts are read whole, repeated rows get
    the same answer, an empty table stays empty.
    """
    packed = Packed(df, text=text_col)
    given = packed.df.withColumn("letter", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    schema = with_fields(packed.df, "lang_pred string, score double, shares map<string,double>")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sliced(batches, "text", 12 << 20):
            size, rows, scores, done = [], [], [], 0
            for b in sliced(iter([group]), "text", 2 << 20):
                s, r, w = model.word_scores(*utf8(b.column("text")))
                size.append(s)
                rows.append(r + done)
                scores.append(w)
                done += b.num_rows
            size, rows, k = np.concatenate(size), np.concatenate(rows), len(model.langs)
            path = viterbi(np.concatenate(scores), np.bincount(rows, minlength=done), penalty)
            held = np.bincount(rows * max(k, 1) + path, weights=size, minlength=done * max(k, 1)).reshape(done, max(k, 1))
            letter = group.column("letter").to_numpy(zero_copy_only=False) & bool(k)
            total = held.sum(1)
            share = held / np.maximum(total, 1)[:, None]
            names = np.array([*model.langs, UNKNOWN], object)
            lang = names[np.where(letter, held.argmax(1), len(model.langs))]
            shares = [[(model.langs[j], float(v)) for j, v in enumerate(row) if v > 0] if k and ok else [] for row, ok in zip(share, letter)]
            out = [pa.array(lang, pa.string()), pa.array(np.where(letter, share.max(1), 0.0)), pa.array(shares, pa.map_(pa.string(), pa.float64()))]
            yield pa.record_batch([*group.columns[:-1], *out], names=schema.names)

    return packed.back(given.mapInArrow(each, schema), **{c: F.col(c) for c in ("lang_pred", "score", "shares")})


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_bucket("doc_id", 5) == 0
    model = fit(docs, ~held_out)
    return predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model).select("doc_id", "held_out", "lang_pred", "score")
