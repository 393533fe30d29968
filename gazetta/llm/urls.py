"""URL filters: host and path rules, and logistic regression on hashed character sequences for the rest."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Packed, sliced, table, utf8, with_fields

SLOTS, STEPS, RATE, DECAY = 1 << 14, 400, 4.0, 1e-4
#: Lengths of the character sequences, in bytes.
GRAMS = (3, 4, 5)
#: (rule, verdict): host and path.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: A small labelled table: 1 is to block. Hosts and paths are invented.
LABELLED = tuple(
    [(h + p, 1) for h in ("casino-slots.example.com", "www.adult-cams.example.org", "m.adult-zone.example.com", "ads-banner.example.com", "adserver.example.org", "click-track.example.com", "porn-tube.example.com", "xxx-video.example.org", "cheap-pills.example.com", "free-loans.example.org", "win-prizes.example.com", "spam-seo.example.com", "malware-dl.example.org", "bet-poker.example.com") for p in ("/en/123", "/de/4567.html", "/fr/98/")]
    + [(h + p, 0) for h in ("www.library.example.org", "news.example.com", "blog.gardening.example.com", "m.weather.example.org", "docs.example.com", "university.example.org", "museum.example.com", "www.recipes.example.com", "forum.history.example.org", "hiking.example.org", "chess.example.com", "m.music.example.org", "www.theatre.example.com", "physics.example.org", "knitting.example.com", "blog.northern.example.org") for p in ("/en/123", "/de/4567.html", "/fr/98/", "/es/321")]
    + [("www.library.example.org/ads/banner", 1), ("news.example.com/casino/bonus", 1), ("docs.example.com/adult/gallery", 1), ("docs.example.com/guide/intro.html", 0), ("news.example.com/2024/politics", 0)]
)


def host(url: Column) -> Column:
    """After the first ://, up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    low = F.translate(rest(url), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract(low, r"^[^/?#]*", 0)


def path(url: Column) -> Column:
    """After the host, up to ?, # or the end."""
    return F.regexp_extract(rest(url), r"^[^/?#]*([^?#]*)", 1)


def rest(url: Column) -> Column:
    at = F.instr(F.coalesce(url, F.lit("")), "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def rule(host_col: Column, path_col: Column, rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """The longest rule that fits, or null: its host is the url's or a parent of it, its path begins the url's."""
    out = F.lit(None).cast("string")
    for text, _ in sorted(set(rules), key=lambda r: (len(r[0]), r[0])):
        h, slash, p = text.partition("/")
        out = F.when(((host_col == h) | host_col.endswith("." + h)) & path_col.startswith(slash + p), F.lit(text)).otherwise(out)
    return out


def shares(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slots, rows) of the character sequences of each row, its edges marked."""
    n, rows = len(data), np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    ends = offs[1:][rows] if n else np.zeros(0, int)
    padded = np.concatenate([data, np.zeros(max(GRAMS), np.uint8)]).astype(np.uint32)
    slots, owner = [], []
    for size in GRAMS:
        h = np.full(n, size, np.uint32)
        for i in range(size):
            h = h * np.uint32(0x01000193) ^ padded[i : n + i]
        ok = np.arange(n) + size <= ends
        slots.append((((h * np.uint32(0x9E3779B1)) >> np.uint32(12)) % np.uint32(SLOTS)).astype(np.int32)[ok])
        owner.append(rows[ok])
    return np.concatenate(slots), np.concatenate(owner)


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def block(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Probability that each row is to block; rows without characters get that of the bias."""
        n = len(offs) - 1
        slots, rows = shares(data, offs)
        z = np.bincount(rows, weights=self.weights[slots], minlength=n) / np.sqrt(np.maximum(np.bincount(rows, minlength=n), 1)) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(labelled: tuple[tuple[str, int], ...] = LABELLED) -> Model:
    """Full gradient steps on (host and path, 1 to block)."""
    y = np.array([k for _, k in labelled], float)
    x = np.zeros((len(labelled), SLOTS), np.float32)
    for i, (text, _) in enumerate(labelled):
        raw = np.frombuffer(text.encode(), np.uint8)
        slots, _ = shares(raw, np.array([0, len(raw)]))
        x[i] = np.bincount(slots, minlength=SLOTS) / np.sqrt(max(1, len(slots)))
    w, bias = np.zeros(SLOTS), 0.0
    for _ in range(STEPS):
        g = 1 / (1 + np.exp(-np.clip(x @ w + bias, -30, 30))) - y
        w -= RATE * (x.T @ g / len(y) + DECAY * w)
        bias -= RATE * g.mean() * 0.1
    return Model(w, float(bias))


def judge(pages: DataFrame, model: Model | None = None, rules: tuple[tuple[str, str], ...] = RULES, url_col: str = "url") -> DataFrame:
    """pages with host, path, rule and verdict: the longest fitting rule's, else the model's.

    Null urls and those without :// have empty host and path, fit no rule, and are allowed: nothing speaks against them.
    Columns of these names that pages has are replaced, all others stay, whatever their names. Urls of any length are read whole;
    repeated rows are judged alike; an empty table stays empty.
    """
    model = model or train()
    verdicts = dict(rules)
    packed = Packed(pages, url=url_col)
    parts = packed.df.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    given = parts.withColumn("rule", rule(F.col("host"), F.col("path"), rules)).withColumn("both", F.concat("host", "path"))
    schema = with_fields(given, "verdict string")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, "both"):
            data, offs = utf8(b.column("both"))
            p = np.where(np.diff(offs) > 0, model.block(data, offs), 0.0)
            said = [verdicts[r] if r is not None else ("block" if x >= 0.5 else "allow") for r, x in zip(b.column("rule").to_pylist(), p.tolist())]
            yield pa.record_batch([*b.columns, pa.array(said, pa.string())], names=schema.names)

    return packed.back(given.mapInArrow(each, schema), **{c: F.col(c) for c in ("host", "path", "rule", "verdict")})


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")
