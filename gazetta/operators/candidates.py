"""Candidates of terms: one join for each way to look a term up, each tagged with its origin.

All ways run over the distinct terms at once, so that a term's cost does not depend on how often it occurs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import vocab as V

FOUND = ["key", "uuid", "origin", "phase", "ord", "span"]


def distinct_terms(parsed: DataFrame) -> DataFrame:
    return parsed.select(F.explode("terms").alias("term")).distinct().withColumn("key", F.lower("term"))


def any_index(names: DataFrame, aliases: DataFrame) -> DataFrame:
    """(key, uuid) of all indexes together."""
    return names.select("key", "uuid").unionByName(aliases.select("key", "uuid")).distinct()


def found(rows: DataFrame, index: DataFrame, query: str, origin: str, phase: int, span: str | None = None) -> DataFrame:
    """rows (key, term, ord, <query>) joined to an index on the lower-case query."""
    hits = rows.withColumn("_q", F.lower(query)).join(index.withColumnRenamed("key", "_q"), "_q")
    return hits.select("key", "uuid", F.lit(origin).alias("origin"), F.lit(phase).alias("phase"), F.col("ord"), (F.col(span) if span else F.lit(None).cast("string")).alias("span"))


def exploded(terms: DataFrame, values: Column) -> DataFrame:
    return terms.select("*", F.posexplode(values).alias("ord", "q"))


def by_alias(terms: DataFrame, aliases: DataFrame) -> DataFrame:
    return found(terms.withColumn("ord", F.lit(0)), aliases.select("key", "uuid").distinct(), "term", "mnt", 1)


def by_name(terms: DataFrame, names: DataFrame) -> DataFrame:
    return found(terms.withColumn("ord", F.lit(0)), names.select("key", "uuid").distinct(), "term", "exact", 2)


def by_abbreviation(terms: DataFrame, names: DataFrame, countries: bool = False) -> DataFrame:
    return found(exploded(terms, X.expansions(F.col("term"), countries)), names.select("key", "uuid").distinct(), "q", "abbrev", 3)


def by_variant(terms: DataFrame, index: DataFrame) -> DataFrame:
    return found(exploded(terms, X.name_variants(F.col("term"))), index, "q", "variant", 4)


def _rewritten(terms: DataFrame) -> DataFrame:
    return terms.withColumn("r", X.rewrite(F.col("term"))).where("r IS NOT NULL").select("key", "term", F.lit(0).alias("ord"), F.col("r.cleaned").alias("q"), F.col("r.jurisdiction").alias("j"))


def by_rewrite(terms: DataFrame, names: DataFrame, index: DataFrame) -> DataFrame:
    """The freed form of a term; where it names a jurisdiction, only records of that one, and only by their names."""
    rows = _rewritten(terms)
    return _with_jurisdiction(rows, names, index, "transform", 5)


def _with_jurisdiction(rows: DataFrame, names: DataFrame, index: DataFrame, origin: str, phase: int) -> DataFrame:
    free = found(rows.where("j IS NULL"), index, "q", origin, phase, "q")
    bound = rows.where("j IS NOT NULL").withColumn("_q", F.lower("q")).withColumn("_j", F.lower("j"))
    held = names.select(F.col("key").alias("_q"), "uuid", F.lower("jurisdiction").alias("_j")).distinct()
    hits = bound.join(held, ["_q", "_j"])
    return free.unionByName(hits.select("key", "uuid", F.lit(origin).alias("origin"), F.lit(phase).alias("phase"), "ord", F.col("q").alias("span")))


def by_rewritten_variant(terms: DataFrame, index: DataFrame) -> DataFrame:
    rows = _rewritten(terms).select("key", "term", F.posexplode(X.name_variants(F.col("q"))).alias("ord", "q"))
    return found(rows, index, "q", "transform_variant", 6)


def by_preposition(terms: DataFrame, names: DataFrame, index: DataFrame) -> DataFrame:
    """What follows a preposition, itself and freed; only the first such part that finds anything counts."""
    parts = terms.select("key", "term", F.posexplode(X.after_prepositions(F.col("term"))).alias("part", "c")).withColumn("r", X.rewrite(F.col("c")))
    tries = F.array_compact(F.array(F.col("c"), F.col("r.cleaned")))
    rows = parts.select("key", "term", "part", F.col("r.jurisdiction").alias("j"), F.posexplode(tries).alias("t", "q")).withColumn("ord", F.col("part") * 2 + F.col("t"))
    hits = _with_jurisdiction(rows, names, index, "preposition", 7)
    first = Window.partitionBy("key")
    return hits.withColumn("_part", F.floor(F.col("ord") / 2)).withColumn("_first", F.min("_part").over(first)).where("_part = _first").select(*FOUND)


def deletions(word: Column) -> Column:
    """A word and all forms that lack one letter."""
    one = F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word))))
    return F.array_distinct(F.concat(F.array(word), one))


def one_edit(a: Column, b: Column) -> Column:
    """True for words one insertion, deletion, change or swap of neighbours apart."""
    n = F.length(a)
    differ = F.filter(F.sequence(F.lit(1), F.greatest(F.lit(1), n)), lambda i: F.substring(a, i, F.lit(1)) != F.substring(b, i, F.lit(1)))
    first = F.coalesce(F.get(differ, F.lit(0)), F.lit(0))
    swap = X.let(first, lambda i: (i > 0) & (F.concat(F.substring(b, F.lit(1), i - 1), F.substring(b, i + 1, F.lit(1)), F.substring(b, i, F.lit(1)), F.substring(b, i + 2, n)) == a))
    return (F.levenshtein(a, b) == 1) | ((n == F.length(b)) & swap)


def fuzzy_join(words: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(word, near): pairs one edit apart. Both sides are joined on their deletions, then verified: no comparison of all with all."""
    left = words.select("word", F.explode(deletions(F.col("word"))).alias("_d"))
    right = vocabulary.select(F.col("word").alias("near"), F.explode(deletions(F.col("word"))).alias("_d"))
    pairs = left.join(right, "_d").where("word <> near").select("word", "near").distinct()
    return pairs.where(one_edit(F.col("word"), F.col("near")))


def vocabulary(names: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Folded names that corrections may lead to; with a dictionary its terms too."""
    keys = names.select("key")
    if aliases is not None:
        keys = keys.unionByName(aliases.where("src = 'raw'").select("key"))
    return keys.where(~F.col("key").contains(",")).select(X.ascii_fold(F.col("key")).alias("word")).where("word <> ''").distinct()


def by_spelling(terms: DataFrame, authority: DataFrame, names: DataFrame, words: DataFrame, stop: DataFrame | None = None) -> DataFrame:
    """Records whose name is one edit from a term, or from its freed form. The span is the authority's spelling."""
    plain = terms.join(stop.select("key").distinct(), "key", "left_anti") if stop is not None else terms
    whole = plain.where(F.length("term") >= V.MIN_SPELLING_LENGTH).select("key", F.lit(0).alias("ord"), X.ascii_fold(F.col("term")).alias("word"))
    freed = _rewritten(terms).where(F.length("q") >= V.MIN_SPELLING_LENGTH).select("key", F.lit(1).alias("ord"), X.ascii_fold(F.col("q")).alias("word"))
    asked = whole.unionByName(freed)
    near = fuzzy_join(asked.select("word").distinct(), words)
    spelled = names.select(F.col("key").alias("near"), "uuid").distinct().join(authority.select("uuid", F.col("name").alias("span")), "uuid")
    hits = asked.join(near, "word").join(spelled, "near")
    return hits.select("key", "uuid", F.lit("spelling").alias("origin"), F.lit(8).alias("phase"), "ord", "span")


def by_cardinal(terms: DataFrame, index: DataFrame) -> DataFrame:
    freed = F.coalesce(X.rewrite(F.col("term"))["cleaned"], F.col("term"))
    rows = terms.withColumn("q", X.without_cardinal(freed)).where("q IS NOT NULL").withColumn("ord", F.lit(0))
    return found(rows, index, "q", "cardinal_strip", 9, "q")


def first_writer(hits: DataFrame) -> DataFrame:
    """(key, uuid, origin, span): of all ways to a record the first counts. Last resorts count only where nothing before found anything."""
    least = Window.partitionBy("key")
    early = F.min(F.when(F.col("phase") < 7, 1)).over(least)
    middle = F.min(F.when(F.col("phase") < 9, 1)).over(least)
    kept = hits.withColumn("_e", early).where("phase <> 7 OR _e IS NULL").withColumn("_m", middle).where("phase <> 9 OR _m IS NULL")
    order = F.struct("phase", "ord", F.coalesce("span", F.lit("")))
    return kept.groupBy("key", "uuid").agg(F.min_by("origin", order).alias("origin"), F.min_by("span", order).alias("span"))


def candidates(terms: DataFrame, authority: DataFrame, names: DataFrame, aliases: DataFrame, stop: DataFrame | None = None, dictionary: bool = False, countries: bool = False) -> DataFrame:
    """(key, uuid, origin, span) of distinct terms (term, key), by all ways."""
    index = any_index(names, aliases)
    ways = [
        by_alias(terms, aliases), by_name(terms, names), by_abbreviation(terms, names, countries), by_variant(terms, index),
        by_rewrite(terms, names, index), by_rewritten_variant(terms, index), by_preposition(terms, names, index),
        by_spelling(terms, authority, names, vocabulary(names, aliases if dictionary else None), stop), by_cardinal(terms, index),
    ]
    return first_writer(reduce(DataFrame.unionByName, ways))


def with_folding(own: DataFrame) -> DataFrame:
    """Candidates under each key as a lookup at match time finds them: its own, those of its form without hyphens, and
    those of keys of this batch that fold to the same ASCII form and differ from it."""
    keys = own.select("key").distinct()
    spaced = keys.withColumn("k2", X.spaced_hyphens(F.col("key")))
    direct = own.withColumn("rank", F.lit(0))
    dehyphened = spaced.where("k2 <> key").join(own.withColumnRenamed("key", "k2"), "k2").select("key", "uuid", "origin", "span", F.lit(1).alias("rank"))
    folded = own.withColumn("f", X.ascii_fold(F.col("key"))).where("f <> key").select("f", "uuid").distinct()
    via = keys.select("key", F.explode(F.array_distinct(F.array(X.ascii_fold(F.col("key")), X.ascii_fold(X.spaced_hyphens(F.col("key")))))).alias("f"))
    bridged = via.join(folded, "f").select("key", "uuid", F.lit("ascii_fold").alias("origin"), F.lit(None).cast("string").alias("span"), F.lit(2).alias("rank"))
    every = direct.unionByName(dehyphened).unionByName(bridged)
    return every.groupBy("key", "uuid").agg(F.min_by("origin", "rank").alias("origin"), F.min_by("span", "rank").alias("span"))


def whole_strings(parsed: DataFrame, index: DataFrame, authority: DataFrame) -> DataFrame:
    """(row_id, fs): rows whose whole string means one place that the authority has."""
    known = index.join(authority.select("uuid"), "uuid", "left_semi")
    return parsed.withColumn("key", X.canonical(F.col("place"))).join(known, "key").select("row_id", F.col("uuid").alias("fs"))
