"""Splits strings without commas into terms, from right to left, by the longest spans that an index knows.

All contiguous spans of the few words are looked up in one join of distinct spans; the walk itself is one expression a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import vocab as V

WALK = "struct<end:int,out:array<struct<text:string,tier:int>>,glue:array<string>>"
PIECES = "array<struct<text:string,tier:int>>"


def join_words(w: Column, start: Column, count: Column) -> Column:
    return F.array_join(F.slice(w, start + 1, count), " ")


def all_spans(w: Column) -> Column:
    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(w) - 1), lambda s: F.transform(F.sequence(s + 1, F.size(w)), lambda e: join_words(w, s, e - s))))


def is_jurisdiction(text: Column) -> Column:
    """True if every word is one for a jurisdiction."""
    w = F.transform(X.words(F.lower(text)), lambda x: F.regexp_replace(x, r"^\.+|\.+$", ""))
    return (F.size(w) > 0) & F.forall(w, lambda x: x.isin(V.JURISDICTION_WORDS))


def without_trailing(text: Column) -> Column:
    """Without jurisdiction words at the end; null if there are none or nothing else."""
    pattern = "(?iU)(\\s+\\.*(?:" + "|".join(V.JURISDICTION_WORDS) + ")\\.*)+$"
    cut = F.regexp_replace(text, pattern, "")
    return F.when((cut != text) & ~is_jurisdiction(text), cut)


def span_keys(span: Column) -> Column:
    """Keys to look a span up by, the most literal first."""
    low = F.lower(X.strip(span))
    countries = X.literal_map(V.COUNTRIES)
    freed = X.rewrite(span)["cleaned"]
    keys = F.array(low, X.spaced_hyphens(low), X.ascii_fold(low), F.lower(freed), X.ascii_fold(freed), F.lower(without_trailing(span)), F.lower(F.coalesce(F.element_at(countries, low), F.element_at(countries, F.replace(low, F.lit("."), F.lit(""))))))
    return F.array_distinct(F.filter(keys, lambda k: k.isNotNull() & (k != "") & ~k.rlike("[,;]")))


def oracle(authority: DataFrame, names: DataFrame, aliases: DataFrame) -> DataFrame:
    """(key, tier, level): names and canonical values are tier 1, raw strings tier 2; level: the broadest reading's, 0 if unknown."""
    levels = authority.select("uuid", "level")
    first = names.select("key", "uuid").unionByName(aliases.where("src = 'value'").select("key", "uuid")).withColumn("tier", F.lit(1))
    second = aliases.where("src = 'raw'").select("key", "uuid").withColumn("tier", F.lit(2))
    return first.unionByName(second).join(levels, "uuid", "left").groupBy("key", "tier").agg(F.coalesce(F.max("level"), F.lit(0)).alias("level"))


def resolved(spans: DataFrame, index: DataFrame) -> DataFrame:
    """(span, tier, level) of the spans that some key reaches: the first key of tier 1, else the first of tier 2."""
    keyed = spans.select("span", F.posexplode(span_keys(F.col("span"))).alias("ord", "key"))
    hits = keyed.join(index, "key")
    best = hits.groupBy("span").agg(F.min_by("level", F.when(F.col("tier") == 1, F.col("ord"))).alias("l1"), F.min(F.when(F.col("tier") == 1, F.col("ord"))).alias("o1"), F.min_by("level", F.when(F.col("tier") == 2, F.col("ord"))).alias("l2"))
    return best.select("span", F.when(F.col("o1").isNotNull(), 1).otherwise(2).alias("tier"), F.when(F.col("o1").isNotNull(), F.col("l1")).otherwise(F.col("l2")).alias("level"))


def tier_of(known: Column, text: Column) -> Column:
    return F.element_at(known, text)["tier"]


def walk(w: Column, known: Column) -> Column:
    """Pieces from left to right as (text, tier); tier 0 is a run of words that nothing knows."""
    n = F.size(w)
    start = F.struct(n.alias("end"), F.array().cast(PIECES).alias("out"), F.array().cast("array<string>").alias("glue")).cast(WALK)

    def flush(s: Column) -> Column:
        return F.when(F.size(s["glue"]) > 0, F.array_append(s["out"], F.struct(F.array_join(s["glue"], " ").alias("text"), F.lit(0).alias("tier")))).otherwise(s["out"])

    def step(s: Column, _: Column) -> Column:
        def options(e: Column) -> Column:
            starts = F.sequence(F.greatest(F.lit(0), e - V.SPAN_WORDS), e - 1)
            usable = lambda tier: F.get(F.filter(starts, lambda b: X.let(join_words(w, b, e - b), lambda t: (tier_of(known, t) == tier) & ~is_jurisdiction(t))), F.lit(0))
            return F.struct(usable(1).alias("a"), usable(2).alias("b"))

        def move(o: Column) -> Column:
            a, b, e = o["a"], o["b"], s["end"]
            named = X.let(join_words(w, b, e - b), lambda t: t.rlike(X.any_case(V.CARDINAL_PREFIX)) | t.rlike(X.any_case(V.PLACE_PREFIX)))
            raw = a.isNull() | (b.isNotNull() & (b < a) & (e < n) & named)
            at = F.when(raw, b).otherwise(a)
            miss = F.struct((e - 1).alias("end"), s["out"], F.concat(F.array(F.get(w, e - 1)), s["glue"]).alias("glue")).cast(WALK)
            hit = F.struct(at.alias("end"), F.array_append(flush(s), F.struct(join_words(w, at, e - at).alias("text"), F.when(raw, 2).otherwise(1).alias("tier"))).alias("out"), F.array().cast("array<string>").alias("glue")).cast(WALK)
            return F.when(at.isNull(), miss).otherwise(hit)

        return F.when(s["end"] > 0, X.let(options(s["end"]), move)).otherwise(s)

    return F.aggregate(F.sequence(F.lit(1), n), start, step, lambda s: F.reverse(flush(s)))


def absorbed(pieces: Column) -> Column:
    """Texts, with pieces that are only jurisdiction words joined to their left neighbour; a leading one to its right."""
    strings = F.array().cast("array<string>")

    def step(out: Column, p: Column) -> Column:
        joined = F.concat(F.slice(out, F.lit(1), F.size(out) - 1), F.array(F.concat_ws(" ", F.get(out, F.size(out) - 1), p["text"])))
        return F.when((F.size(out) > 0) & is_jurisdiction(p["text"]), joined).otherwise(F.array_append(out, p["text"]))

    def lead(t: Column) -> Column:
        first = F.concat(F.array(F.concat_ws(" ", F.get(t, F.lit(0)), F.get(t, F.lit(1)))), F.slice(t, F.lit(3), F.size(t)))
        return F.when((F.size(t) > 1) & is_jurisdiction(F.get(t, F.lit(0))), first).otherwise(t)

    return X.let(F.aggregate(pieces, strings, step), lead)


def gate(texts: Column, known: Column) -> Column:
    """Why the pieces are not accepted; null if they are."""
    stop = lambda t: F.exists(X.words(F.lower(t)), lambda x: F.regexp_replace(x, r"^[.,;:]+|[.,;:]+$", "").isin(V.SEGMENT_STOPWORDS))
    unknown = F.get(F.filter(texts, lambda t: tier_of(known, t).isNull()), F.lit(0))
    level = F.coalesce(F.element_at(known, F.get(texts, F.size(texts) - 1))["level"], F.lit(0))
    return (
        F.when(F.size(texts) < 2, "single_segment")
        .when(F.exists(texts, lambda t: (F.coalesce(tier_of(known, t), F.lit(0)) != 1) & stop(t)), "stopword")
        .when(F.exists(texts, lambda t: F.length(F.trim(F.replace(t, F.lit("."), F.lit("")))) < 2), "short_segment")
        .when(unknown.isNotNull(), F.concat(F.lit("unresolved:"), unknown))
        .when(level < V.TAIL_LEVEL, F.concat(F.lit("rightmost_level:"), level.cast("string")))
    )


def decisions(rows: DataFrame, authority: DataFrame, names: DataFrame, aliases: DataFrame) -> DataFrame:
    """rows (row_id, term) with reason and segments: cheap reasons first, so that spans are made only of rows that can pass."""
    rows = rows.withColumn("w", X.words(F.col("term"))).where(F.size("w") > 1)
    early = F.when(F.size("w") > V.INPUT_WORDS, "word_count").when(F.col("term").rlike(r"(?U)^\s*\d|\d{3,}"), "digits")
    rows = rows.withColumn("reason", early)
    spans = rows.where("reason IS NULL").select("row_id", F.explode(F.array_distinct(F.concat(all_spans(F.col("w")), F.array("term")))).alias("span"))
    facts = resolved(spans.select("span").distinct(), oracle(authority, names, aliases))
    known = spans.join(facts, "span").groupBy("row_id").agg(F.map_from_entries(F.collect_list(F.struct("span", F.struct("tier", "level")))).alias("known"))
    rows = rows.join(known, "row_id", "left").withColumn("known", F.coalesce("known", F.create_map().cast("map<string,struct<tier:int,level:int>>")))
    rows = rows.withColumn("reason", F.when(F.col("reason").isNull() & (tier_of(F.col("known"), F.col("term")) == 1), "whole_known").otherwise(F.col("reason")))
    rows = rows.withColumn("segments", F.when(F.col("reason").isNull(), absorbed(walk(F.col("w"), F.col("known")))))
    return rows.withColumn("reason", F.coalesce("reason", F.when(F.col("segments").isNotNull(), gate(F.col("segments"), F.col("known")))))


def segmented(parsed: DataFrame, authority: DataFrame, names: DataFrame, aliases: DataFrame) -> DataFrame:
    """parsed with the terms of accepted splits in place of the single term."""
    rows = parsed.where(F.size("terms") == 1).select("row_id", F.get("terms", F.lit(0)).alias("term"))
    split = decisions(rows, authority, names, aliases).where("reason IS NULL").select("row_id", "segments")
    return parsed.join(split, "row_id", "left").withColumn("terms", F.coalesce("segments", "terms")).drop("segments")


def log(parsed: DataFrame, authority: DataFrame, names: DataFrame, aliases: DataFrame) -> DataFrame:
    """(row_id, decision, reason, segment_count, segments, tiers, rightmost_level) of each string that was looked at."""
    rows = parsed.where(F.size("terms") == 1).select("row_id", F.get("terms", F.lit(0)).alias("term"))
    d = decisions(rows, authority, names, aliases)
    tiers = F.transform("segments", lambda t: F.coalesce(tier_of(F.col("known"), t).cast("string"), F.lit("glue")))
    level = F.coalesce(F.element_at("known", F.get("segments", F.size("segments") - 1))["level"], F.lit(0))
    return d.select("row_id", F.when(F.col("reason").isNull(), "accepted").otherwise("rejected").alias("decision"), F.coalesce("reason", F.lit("")).alias("reason"), F.coalesce(F.size("segments"), F.lit(0)).alias("segment_count"), F.coalesce(F.array_join("segments", "|"), F.lit("")).alias("segments"), F.coalesce(F.array_join(tiers, "|"), F.lit("")).alias("tiers"), F.when(F.col("segments").isNotNull(), level).alias("rightmost_level"))
