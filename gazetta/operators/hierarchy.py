"""Ancestors of every record, found level by level."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vocab as V


def ancestors(authority: DataFrame, hops: int = V.SCOPE_HOPS) -> DataFrame:
    """(uuid, hop, anc): a row for each ancestor within so many hops, itself excluded.

    A parent that the authority lacks is an ancestor still, and the last. Each round joins the frontier to the parents;
    a hierarchy is shallow, so a few rounds suffice, and cycles end with the hops.
    """
    edges = authority.where("parent IS NOT NULL AND parent <> ''").select(F.col("uuid").alias("child"), F.col("parent").alias("up"))
    frontier = edges.select(F.col("child").alias("uuid"), F.lit(1).alias("hop"), F.col("up").alias("anc"))
    out = frontier
    for hop in range(2, hops + 1):
        frontier = frontier.join(edges, F.col("anc") == F.col("child")).select("uuid", F.lit(hop).alias("hop"), F.col("up").alias("anc"))
        if not frontier.take(1):
            break
        out = out.unionByName(frontier)
    return out


def chains(authority: DataFrame, hops: int = V.SCOPE_HOPS) -> DataFrame:
    """(uuid, anc array): ancestors from the nearest to the farthest; empty for roots."""
    found = ancestors(authority, hops).groupBy("uuid").agg(F.transform(F.array_sort(F.collect_list(F.struct("hop", "anc"))), lambda x: x["anc"]).alias("anc"))
    return authority.select("uuid").join(found, "uuid", "left").select("uuid", F.coalesce("anc", F.array().cast("array<string>")).alias("anc"))


#: The supported levels, least and most, where none are asked for.
LEVELS = (V.LEVEL_LEAST, V.LEVEL_MOST)


def supported(level, levels: tuple[int, int] = LEVELS):
    return level.between(*levels)


def supported_leaf(authority: DataFrame, hops: int = V.SCOPE_HOPS, range_: tuple[int, int] = LEVELS) -> DataFrame:
    """(uuid, leaf): the record itself or its nearest ancestor of a supported level; null where the chain ends before."""
    levels = authority.select(F.col("uuid").alias("anc"), F.col("level").alias("anc_level"))
    up = ancestors(authority, hops - 1).join(levels, "anc").where(supported(F.col("anc_level"), range_))
    nearest = up.groupBy("uuid").agg(F.min_by("anc", "hop").alias("above"))
    return authority.join(nearest, "uuid", "left").select("uuid", F.when(supported(F.col("level"), range_), F.col("uuid")).otherwise(F.col("above")).alias("leaf"))
