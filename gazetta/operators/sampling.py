"""Draws that depend on a seed and the rows, never on their order; holdouts free of leaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X

PSEUDO = {"AMB": "ambiguous", "ILL": "illegible"}


def draw(seed: str, key: str) -> Column:
    return F.sha1(F.concat(F.lit(seed + ":"), F.col(key)).cast("binary"))


def stratified(df: DataFrame, stratum: str, key: str, quotas: dict[str, int], seed: str) -> DataFrame:
    """Up to its quota of rows of each stratum."""
    order = Window.partitionBy(stratum).orderBy(draw(seed, key), key)
    quota = F.element_at(X.literal_map(quotas), F.col(stratum))
    return df.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= F.coalesce(quota, F.lit(0))).drop("_n")


def halves(df: DataFrame, stratum: str, key: str, seed: str) -> DataFrame:
    """df with half: dev or heldout, of equal size in each stratum; an odd row goes."""
    w = Window.partitionBy(stratum)
    rows = df.withColumn("_n", F.row_number().over(w.orderBy(draw(seed, key), key))).withColumn("_h", F.floor(F.count("*").over(w) / 2))
    return rows.where(F.col("_n") <= 2 * F.col("_h")).withColumn("half", F.when(F.col("_n") <= F.col("_h"), "dev").otherwise("heldout")).drop("_n", "_h")


def simple(df: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    return df.orderBy(draw(seed, key), key).limit(n)


def strided(df: DataFrame, order: str, pages: int, page: int) -> DataFrame:
    """Evenly spaced pages of rows in a stated order, which must be dense integers from 0."""
    n = df.agg((F.max(order) + 1).alias("n"))
    stride = F.greatest(F.lit(1), F.floor(F.col("n") / pages))
    return df.crossJoin(F.broadcast(n)).where((F.col(order) % stride < page) & (F.floor(F.col(order) / stride) < pages)).drop("n")


def first_by_canonical(df: DataFrame, place: str, order: str) -> DataFrame:
    """The first row of each canonical string."""
    w = Window.partitionBy(X.canonical(F.col(place))).orderBy(order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def drop_reasons(pool: DataFrame, ids: DataFrame, seen: DataFrame) -> DataFrame:
    """pool (place, match_status, authority_id) with reason, the first that applies; null for usable rows. ids (uuid), seen (place)."""
    known = ids.select(F.upper("uuid").alias("_id"), F.lit(True).alias("_known")).distinct()
    old = seen.select(X.canonical(F.col("place")).alias("_c"), F.lit(True).alias("_seen")).distinct()
    j = pool.withColumn("_id", F.upper(F.trim("authority_id"))).withColumn("_c", X.canonical(F.col("place"))).join(known, "_id", "left").join(old, "_c", "left")
    reason = (
        F.when(F.coalesce(F.trim("place"), F.lit("")) == "", "no_place").when(F.trim("match_status") != "Verified", "not_verified").when(F.coalesce(F.trim("authority_id"), F.lit("")) == "", "no_authority_id")
        .when(F.col("_id").isin(list(PSEUDO)), F.lit(None)).when(F.col("_known").isNull(), "no_pa_record").when(F.col("_seen").isNotNull(), "seen_in_development")
    )
    return j.select(*pool.columns, reason.alias("reason"))


def label_of(authority_id: Column) -> Column:
    up = F.upper(F.trim(F.coalesce(authority_id, F.lit(""))))
    return F.when(up.isin(list(PSEUDO)), "ABSTAIN").otherwise(up)


def label_status(authority_id: Column, multiple: Column) -> Column:
    up = F.upper(F.trim(F.coalesce(authority_id, F.lit(""))))
    return F.when(up.isin(list(PSEUDO)), F.element_at(X.literal_map(PSEUDO), up)).when(F.lower(multiple) == "true", "mnt_verified_multi").otherwise("mnt_verified")


def classify(truth: Column) -> Column:
    """struct(label, status) of a curator's cell: an id, a refusal, or nothing."""
    v = F.trim(F.coalesce(truth, F.lit("")))
    low = F.lower(v)
    label = F.when(v == "", None).when(low.isin("amb", "ambiguous", "ill", "illegible"), "ABSTAIN").otherwise(v)
    status = F.when(v == "", "unlabelled").when(low.isin("ill", "illegible"), "illegible").when(low.isin("amb", "ambiguous"), "ambiguous").otherwise("verified")
    return F.struct(label.alias("label"), status.alias("status"))


def band_weights(pool: DataFrame, populations: DataFrame) -> DataFrame:
    """(band, strings, records, mean_total, sampled): a band's strings times the mean of its rows in the pool."""
    mean = pool.groupBy("band").agg(F.avg("total").alias("m"), F.count("total").alias("sampled"))
    j = populations.join(mean, "band", "left")
    m = F.coalesce("m", F.lit(0.0))
    return j.select("band", "strings", F.bround(F.col("strings") * m).cast("long").alias("records"), F.bround(m, 1).alias("mean_total"), F.coalesce("sampled", F.lit(0)).cast("long").alias("sampled"))


def holdout(mapping: DataFrame, raw: str, strings: DataFrame, place: str) -> DataFrame:
    """mapping without the rows whose raw string shares an index key with an evaluation string."""
    keys = strings.select(F.explode(X.index_keys(F.col(place))).alias("key")).distinct()
    hit = mapping.select(F.col(raw).alias("_raw")).distinct().select("_raw", F.explode(X.index_keys(F.col("_raw"))).alias("key")).join(keys, "key", "left_semi").select("_raw").distinct()
    return mapping.join(hit, F.col(raw) == F.col("_raw"), "left_anti")
