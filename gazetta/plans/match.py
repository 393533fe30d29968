"""The matcher: from strings and indexes to answers, ties and provenance."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import candidates as C
from ..operators import fold
from ..operators import hierarchy as H
from ..operators import matching as M
from ..operators import segment as S
from ..sources import tables as T
from ..sources.shared import cut, release


@dataclass
class Sources:
    """authority as in sources.derived.AUTHORITY; aliases (raw, value, uuid); frequencies (key, uuid, freq); stop (key)."""

    authority: DataFrame
    aliases: DataFrame
    frequencies: DataFrame | None = None
    stop: DataFrame | None = None
    dictionary: bool = False


@dataclass
class Matched:
    """results and decided have a row for each entry. strings: the outcomes of distinct strings, row_id being the first of their entries;
    entries have that as string. records: the authority with its classes."""

    results: DataFrame
    decided: DataFrame
    found: DataFrame
    chain: DataFrame
    strings: DataFrame
    entries: DataFrame
    records: DataFrame
    ties: DataFrame

    def kept(self) -> list[DataFrame]:
        return [self.found, self.chain, self.strings, self.entries, self.records, self.ties]

    def spread(self, of_strings: DataFrame) -> DataFrame:
        """A row for each entry from what holds for its string: row_id, guid and frequency are the entry's."""
        own = [c for c in ("guid", "frequency") if c in of_strings.columns]
        rows = of_strings.drop(*own).withColumnRenamed("row_id", "string")
        return self.entries.select("row_id", "string", *own).join(rows, "string").select(*of_strings.columns)

    def provenance(self, authority: DataFrame) -> DataFrame:
        """matching.level_provenance() of all entries, found once for each string."""
        return self.spread(M.level_provenance(self.strings.withColumn("guid", F.lit(None).cast("string")), authority, self.chain))

    def tied(self, authority: DataFrame) -> DataFrame:
        """matching.ties() with all candidates. Entries of one string share its tie."""
        sets = M.tie_sets(self.ties, self.records)
        others = self.entries.where("row_id <> string").join(sets.select("string", "tie").distinct(), "string").select(F.col("row_id").alias("string"), "tie", F.lit(None).cast("int").alias("rank"), F.lit(None).cast("string").alias("uuid"))
        return M.ties(self.results, authority, sets.unionByName(others))


def parse(entries: DataFrame) -> DataFrame:
    """entries with their terms, noise included."""
    return entries.withColumn("terms", X.split_terms(F.col("place")))


def match(entries: DataFrame, src: Sources, segment: bool = True, helper: str | None = None, countries: bool = False, levels: tuple[int, int] = H.LEVELS) -> Matched:
    """Answers for entries (row_id, place, guid, frequency).

    Distinct strings are decided once each. Their distinct terms are looked up once each; pairs of terms that occur keep the
    candidates that connect; these return to the strings, the rest is string by string, and the outcomes return to the rows.
    """
    spark = entries.sparkSession
    release(spark)
    entries = cut(entries)
    index = cut(T.alias_index(src.aliases))
    records = cut(M.classed(src.authority, index))
    authority = records.drop("rep")
    classes = cut(records.where("uuid = rep").drop("rep"))
    names = cut(T.name_index(classes))
    chain = cut(H.chains(authority))
    parsed = cut(parse(entries.groupBy("place").agg(F.min("row_id").alias("row_id"))))
    entries = cut(entries.join(parsed.select(F.col("place").alias("_place"), F.col("row_id").alias("string")), F.col("place").eqNullSafe(F.col("_place"))).drop("_place"))
    if segment:
        parsed = S.segmented(parsed, classes, names, index)
    parsed = cut(parsed.withColumn("terms", X.drop_noise(F.col("terms"))))
    release(spark)
    terms = cut(C.distinct_terms(parsed))
    found = cut(C.candidates(terms, classes, names, index, src.stop, src.dictionary, countries))
    often = M.class_frequencies(src.frequencies, records) if src.frequencies is not None else None
    cands = cut(M.candidate_rows(C.with_folding(found), M.record_columns(records, chain), often))
    release(spark)
    fs = C.whole_strings(parsed, T.whole_string_index(src.aliases), authority)
    strings = cut(parsed.join(fs, "row_id", "left"))
    context = M.helper_term(helper, authority, T.name_index(authority), chain) if helper else None
    outcomes = first = cut(fold.decided(strings, M.with_candidates(parsed, cands), src.stop, context))
    release(spark)
    rest = first.where(F.col("m.type") == fold.AGAIN).select("row_id")
    if rest.take(1):
        rows = M.with_members(cut(M.with_candidates(parsed.join(rest, "row_id", "left_semi"), cands)), records)
        more = fold.decided(strings.join(rest, "row_id", "left_semi"), rows, src.stop, context)
        outcomes = cut(first.where(F.col("m.type") != fold.AGAIN).unionByName(more))
    ties = cut(outcomes.where(F.col("m.type").isin(*M.TIES)).select(F.col("row_id").alias("string"), "tie"))
    decided_strings = cut(outcomes.select("row_id", "place", "terms", "fs", "m", "r"))
    decided = entries.join(decided_strings.select(F.col("row_id").alias("string"), "terms", "fs", "m", "r"), "string").drop("string")
    of_strings = M.result_rows(decided_strings.withColumns({"guid": F.lit(None).cast("string"), "frequency": F.lit(None).cast("string")}), authority, H.supported_leaf(authority, range_=levels), levels)
    release(spark)
    out = Matched(None, decided, found, chain, decided_strings, entries, records, ties)
    out.results = out.spread(cut(of_strings))
    return out


def levels_json(results: DataFrame, provenance: DataFrame, levels: tuple[int, int] = H.LEVELS) -> DataFrame:
    """(row_id, entry): one JSON document a row, its supported levels by number, the leaf-ward node of each."""
    node = F.struct("depth_from_leaf", F.col("level").alias("level"), F.struct(_blank("raw_term").alias("raw"), "uuid", "name", "jurisdiction", "match_method", _blank("origin").alias("origin")).alias("detail"))
    chain = provenance.groupBy("row_id").agg(F.array_sort(F.collect_list(node)).alias("chain"))
    rows = results.join(chain, "row_id", "left")
    inside = F.filter("chain", lambda x: x["level"].between(*levels))
    lowest = F.filter(inside, lambda x: ~F.exists(inside, lambda y: (y["level"] == x["level"]) & (y["depth_from_leaf"] < x["depth_from_leaf"])))
    order = F.array_sort(F.transform(lowest, lambda x: F.struct(x["level"].alias("level"), x["detail"].alias("detail"))), lambda a, b: a["level"] - b["level"])
    by_level = F.map_from_entries(F.transform(order, lambda x: F.struct(x["level"].cast("string"), x["detail"])))
    below = F.get(F.filter("chain", lambda x: (x["depth_from_leaf"] == 0) & ~F.coalesce(x["level"].between(*levels), F.lit(False))), F.lit(0))
    entry = F.struct(
        "original", "guid", F.expr("try_cast(frequency AS BIGINT)").alias("frequency"), "match_type", "confidence", "resolution_kind",
        (F.col("resolution_kind") == "tie").alias("ambiguous"), (F.col("resolution_kind") == "suspect").alias("parent_suspect"), F.col("candidates").alias("candidate_count"),
        _blank("supported_leaf_id").alias("leaf_uuid"), F.col("below_supported").alias("matched_below_supported"), "matched_level", "unsupported_in_candidates", "source_encoding_suspect", "source_shape",
        below["detail"].alias("matched_below"), by_level.alias("levels"),
    )
    return rows.select("row_id", F.to_json(entry, {"ignoreNullFields": "false"}).alias("entry"))


def _blank(c: str) -> Column:
    return F.when(F.col(c) != "", F.col(c))


def readable(results: DataFrame) -> DataFrame:
    """(row_id, block): a few lines of text a row."""
    dash = lambda c: F.coalesce(F.when(F.col(c).cast("string") != "", F.col(c).cast("string")), F.lit("-"))
    lines = [F.concat(F.lit(f"{label}: "), dash(c)) for label, c in (("original", "original"), ("match", "match_type"), ("name", "authority_name"), ("level", "level"), ("id", "authority_id"), ("skipped", "skipped_terms"))]
    return results.select("row_id", F.concat_ws("\n", *lines).alias("block"))
