"""Candidates brought to the rows, and the tables made of the fold's outcomes: results, ties, provenance, defects.

A term's candidates are rows until the fold, ordered by uuid, a candidate being
struct<uuid, n, top, origin, span, level, pop, hist, jur, toks, parent, anc, lat, lon, plat, plon, pname, name, freq, who, freq2>.
It stands for a class of n records of one name, parent, level, jurisdiction and history, which no way of looking up and no
step of the fold tells apart: uuid is the least of theirs, top their first by population, who the most frequent, freq and
freq2 the two highest frequencies. Records that have others below them, and those that an alias names, are classes of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import vocab as V
from ..sources.shared import cut


def none(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def classed(authority: DataFrame, index: DataFrame) -> DataFrame:
    """The authority with rep, the least uuid of each record's class. index: the aliases, as of tables.alias_index()."""
    single = authority.where("parent IS NOT NULL").select(F.col("parent").alias("uuid")).unionByName(index.select("uuid")).distinct().withColumn("_single", F.lit(True))
    rows = authority.join(single, "uuid", "left")
    kind = [F.coalesce("historical", F.lit("")) != "", F.coalesce("jurisdiction", F.lit("")), "level", "parent", "name", F.when(F.col("_single"), F.col("uuid"))]
    rows = cut(rows.withColumn("_kind", F.to_json(F.struct(*[F.col(k).alias(f"k{i}") if isinstance(k, str) else k.alias(f"k{i}") for i, k in enumerate(kind)]))))
    least = rows.groupBy("_kind").agg(F.min("uuid").alias("rep"))
    return rows.join(least, "_kind").drop("_kind", "_single")


def firsts(rows: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """The first n rows by keys, with their number _n from 1."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= n)


def record_columns(records: DataFrame, chain: DataFrame) -> DataFrame:
    """What the fold needs of each class of records (as of classed()), with its parent's place and name."""
    up = records.select(F.col("uuid").alias("parent"), F.col("lat").alias("plat"), F.col("lon").alias("plon"), F.col("name").alias("pname"))
    sizes = records.groupBy("rep").agg(F.count("*").alias("n"))
    population = F.coalesce("population", F.lit(0).cast("long"))
    first = firsts(records.select("rep", population.alias("pop"), "uuid"), ["rep"], [F.desc("pop"), "uuid"], V.MAX_CANDIDATES)
    top = first.groupBy("rep").agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", "pop", "uuid"))), lambda x: F.struct(x["pop"].alias("pop"), x["uuid"].alias("uuid"))).alias("top"))
    of = records.where("uuid = rep").join(sizes.join(top, "rep").withColumnRenamed("rep", "uuid"), "uuid")
    return of.join(up, "parent", "left").join(chain, "uuid", "left").select("uuid", "n", "top", "level", population.alias("pop"), (F.coalesce("historical", F.lit("")) != "").alias("hist"), F.coalesce("jurisdiction", F.lit("")).alias("jur"), X.name_tokens(F.col("name")).alias("toks"), "parent", "anc", "lat", "lon", "plat", "plon", "pname", "name")


def class_frequencies(frequencies: DataFrame, records: DataFrame) -> DataFrame:
    """(key, uuid, who, freq, freq2): of each class under a key the most frequent record, its frequency and the next one's."""
    rows = frequencies.groupBy("key", "uuid").agg(F.max("freq").cast("long").alias("freq")).join(records.select("uuid", "rep"), "uuid", "left").withColumn("rep", F.coalesce("rep", "uuid"))
    first = firsts(rows, ["key", "rep"], [F.desc("freq"), "uuid"], 2)
    at = lambda n, c: F.max(F.when(F.col("_n") == n, F.col(c)))
    return first.groupBy("key", F.col("rep").alias("uuid")).agg(at(1, "uuid").alias("who"), at(1, "freq").alias("freq"), at(2, "freq").alias("freq2"))


FIELDS = ["uuid", "n", "top", "origin", "span", "level", "pop", "hist", "jur", "toks", "parent", "anc", "lat", "lon", "plat", "plon", "pname", "name", "freq", "who", "freq2"]


def candidate_rows(found: DataFrame, columns: DataFrame, frequencies: DataFrame | None) -> DataFrame:
    """(key, c): a row for each candidate, with all that the fold needs of it. columns: of record_columns(); frequencies: of class_frequencies(). Records that the authority lacks stay."""
    rows = found.join(columns, "uuid", "left")
    zero = F.lit(0).cast("long")
    if frequencies is None:
        rows = rows.withColumns({"who": F.lit(None).cast("string"), "freq": zero, "freq2": zero})
    else:
        rows = rows.join(frequencies, ["key", "uuid"], "left")
    known = {"n": F.coalesce("n", F.lit(1).cast("long")), "pop": F.coalesce("pop", zero), "hist": F.coalesce("hist", F.lit(False)), "jur": F.coalesce("jur", F.lit("")), "anc": F.coalesce("anc", none("string")), "freq": F.coalesce("freq", zero), "freq2": F.coalesce("freq2", zero)}
    return rows.withColumns(known).select("key", F.struct(*FIELDS).alias("c"))


def with_members(rows: DataFrame, records: DataFrame) -> DataFrame:
    """rows of with_candidates() with ids, lats and lons of all records of a class, by uuid, where there are several."""
    asked = rows.where("c.n > 1").select(F.col("c.uuid").alias("rep")).distinct()
    own = records.join(asked, "rep").groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("uuid", "lat", "lon"))).alias("_m"))
    out = rows.join(own, F.col("c.uuid") == F.col("rep"), "left")
    lists = {"ids": "uuid", "lats": "lat", "lons": "lon"}
    c = F.struct("c.*", *[F.col(f"_m.{f}").alias(name) for name, f in lists.items()])
    return out.withColumn("c", F.when(F.col("c").isNotNull(), c)).select(*rows.columns)


def candidate_counts(rows: DataFrame) -> DataFrame:
    """(key, n, first): how many records a key has, and the first known level by uuid."""
    known = F.when(F.col("c.level").isNotNull(), F.struct("c.uuid", "c.level"))
    return rows.groupBy("key").agg(F.sum("c.n").cast("int").alias("n"), F.min(known).alias("f")).select("key", "n", F.col("f.level").alias("first"))


def connected(pairs: DataFrame, cands: DataFrame) -> DataFrame:
    """(k1, k2, uuid): of the terms k1 that stand beside k2 in some string, the candidates that the fold can connect with one of k2.

    They lie under a candidate of k2 or under the parent of one, or are themselves, or their parent is, above one: all else
    has no part in a chain of the two terms. Ids only are joined, once for each distinct pair.
    """
    ids = cands.select("key", F.col("c.uuid").alias("uuid"), F.col("c.parent").alias("parent"), F.slice("c.anc", 1, V.CHAIN_HOPS).alias("anc"))
    self_or_parent = F.explode(F.array_compact(F.array("uuid", "parent"))).alias("t")
    up = ids.select("key", "uuid", F.explode("anc").alias("t"))
    targets = ids.select(F.col("key").alias("k2"), self_or_parent).distinct()
    above = up.select(F.col("key").alias("k2"), "t").distinct()
    # From the term of fewer candidates to the other: a common name brings only what meets a rare one.
    many = cands.groupBy("key").agg(F.count("*").alias("n"))
    sized = cut(pairs.join(many.toDF("k1", "n1"), "k1").join(many.toDF("k2", "n2"), "k2"))
    few, wide = sized.where("n1 <= n2").select("k1", "k2"), sized.where("n1 > n2").select("k1", "k2")

    def meet(rows: DataFrame, others: DataFrame) -> DataFrame:
        rows = rows.withColumnRenamed("key", "k1")
        near = few.join(rows, "k1").join(others, ["k2", "t"], "left_semi").select("k1", "k2", "uuid")
        return near.unionByName(wide.join(others, "k2").join(rows, ["k1", "t"]).select("k1", "k2", "uuid"))

    below, over = meet(up, targets), meet(ids.select("key", "uuid", self_or_parent), above)
    return below.unionByName(over).distinct()


#: A string of more terms keeps all candidates of each: its pairs of terms would outnumber them.
MANY_TERMS = 32


def with_candidates(parsed: DataFrame, cands: DataFrame) -> DataFrame:
    """A row for each candidate of each term of parsed (row_id, terms), or one for a term without: (row_id, i, term, toks, n, first, c).

    Terms are numbered from the right. The first has all its candidates, as they are ranked if nothing connects; the others
    those that connect with another term of the string. n and first tell of all candidates. No candidates are gathered
    in a value: names that very many records share make many rows, which spill.
    """
    exploded = parsed.select("row_id", F.size("terms").alias("of"), F.posexplode(F.reverse("terms")).alias("i", "term")).withColumn("key", F.lower("term"))
    whole = (F.col("i") == 0) | (F.col("of") > MANY_TERMS)
    narrow = exploded.where(~whole).select("row_id", "i", F.col("key").alias("k1"))
    beside = exploded.where(F.col("of") <= MANY_TERMS).select("row_id", F.col("i").alias("j"), F.col("key").alias("k2"))
    asked = cut(narrow.join(beside, "row_id").where("i <> j").select("row_id", "i", "k1", "k2"))
    near = cut(connected(asked.select("k1", "k2").distinct(), cands))
    records = cands.select("key", F.col("c.uuid").alias("uuid"), "c")
    some = asked.join(near, ["k1", "k2"]).select("row_id", "i", F.col("k1").alias("key"), "uuid").distinct()  # connected with two terms, it comes twice
    full = exploded.where(whole).join(records, "key").select("row_id", "i", "c")
    own = full.unionByName(some.join(records, ["key", "uuid"]).select("row_id", "i", "c"))
    items = exploded.join(candidate_counts(cands), "key", "left").select("row_id", "i", "term", X.name_tokens(F.col("term")).alias("toks"), F.coalesce("n", F.lit(0)).alias("n"), "first")
    return items.join(own, ["row_id", "i"], "left")


def result_rows(decided_rows: DataFrame, authority: DataFrame, leaves: DataFrame, levels: tuple[int, int] = (V.LEVEL_LEAST, V.LEVEL_MOST)) -> DataFrame:
    """The 24 columns of an answer; record fields are blank unless it is resolved. Lists stay arrays. levels: those that count as supported."""
    m = decided_rows.select("row_id", "place", "guid", "frequency", "m", F.when(F.size("m.ids") > 0, F.col("m.ids")).otherwise(F.col("m.tied")).alias("all"))
    chain = F.coalesce("type_ahead", F.lit("")) if "type_ahead" in authority.columns else F.lit("")
    info = authority.join(leaves, "uuid", "left").select("uuid", F.coalesce("name", F.lit("")).alias("name"), chain.alias("chain"), F.coalesce("jurisdiction", F.lit("")).alias("jur"), "level", "leaf")
    each = m.select("row_id", F.posexplode("all").alias("p", "uuid")).join(info, "uuid", "left")
    item = F.struct("p", "uuid", "name", "chain", "jur", "level", "leaf")
    got = each.groupBy("row_id").agg(F.array_sort(F.collect_list(item)).alias("c"))
    df = m.join(got, "row_id", "left").withColumn("top", F.get("c", F.lit(0)))
    kind = F.coalesce(F.element_at(X.literal_map(V.KIND), F.col("m.type")), F.lit("resolved"))
    resolved = (kind == "resolved") & F.col("top").isNotNull()
    out_of_range = lambda lv: lv.isNotNull() & ~lv.between(*levels)
    blank = lambda c: F.when(resolved, F.coalesce(c, F.lit(""))).otherwise("")
    return df.select(
        "row_id", F.col("place").alias("original"), "guid", "frequency", F.col("m.type").alias("match_type"),
        F.coalesce(F.element_at(X.literal_map(V.CONFIDENCE), F.col("m.type")), F.lit("none")).alias("confidence"),
        F.col("m.depth").alias("match_depth"), F.size("all").alias("candidates"),
        blank(F.col("top.name")).alias("authority_name"), blank(F.col("top.chain")).alias("type_ahead"), blank(F.col("top.jur")).alias("jurisdiction"),
        F.when(resolved, F.col("top.level")).alias("level"), blank(F.col("top.uuid")).alias("authority_id"),
        F.col("all").alias("candidate_ids"), F.coalesce(F.transform("c", lambda x: F.when(F.coalesce(x["chain"], F.lit("")) != "", x["chain"]).otherwise(F.coalesce(x["name"], F.lit("")))), none("string")).alias("candidate_names"),
        F.size("m.skipped").alias("skipped_count"), F.array_join(F.concat("m.skipped", "m.notes"), "; ").alias("skipped_terms"), kind.alias("resolution_kind"),
        F.coalesce("top.uuid", F.lit("")).alias("matched_uuid"), F.col("top.level").alias("matched_level"), F.coalesce(out_of_range(F.col("top.level")), F.lit(False)).alias("below_supported"),
        F.coalesce("top.leaf", F.lit("")).alias("supported_leaf_id"), F.coalesce(F.exists(F.slice("c", 2, 1000), lambda x: out_of_range(x["level"])), F.lit(False)).alias("unsupported_in_candidates"),
        X.has_corruption(F.col("place")).alias("source_encoding_suspect"), X.shape_tags(F.col("place")).alias("source_shape"),
    )


TIES = ("chain_amb", "single_amb", "parent_amb")


def tie_sets(strings: DataFrame, records: DataFrame) -> DataFrame:
    """(string, tie, rank, uuid) of strings (string, tie as of the fold, classes): tie is the least string of the same set of
    records in the same order; a row for each record of that string, best first, and for every other string one without record.

    Strings of one tie are many where names are common, and so are its records: their product is never made.
    """
    sets = strings.where(F.size("tie") > 0).select("string", F.col("tie").alias("classes"), F.sha2(F.to_json("tie"), 256).alias("_set"))
    sets = cut(sets.join(sets.groupBy("_set").agg(F.min("string").alias("tie")), "_set").drop("_set"))
    of = sets.where("string = tie").select("string", "tie", F.explode("classes").alias("k")).select("string", "tie", "k.g", F.col("k.uuid").alias("rep"))
    members = records.select("rep", "uuid", F.col("population").alias("pop"))
    rows = of.join(members, "rep", "left").withColumns({"uuid": F.coalesce("uuid", "rep"), "pop": F.coalesce("pop", F.lit(0).cast("long"))})
    order = Window.partitionBy("string").orderBy("g", F.desc("pop"), "uuid")
    whole = rows.select("string", "tie", (F.row_number().over(order) - 1).alias("rank"), "uuid")
    return whole.unionByName(sets.where("string <> tie").select("string", "tie", F.lit(None).cast("int").alias("rank"), F.lit(None).cast("string").alias("uuid")))


def ties(results: DataFrame, authority: DataFrame, sets: DataFrame | None = None) -> DataFrame:
    """Every tie with all of its tied candidates: once for all rows of the same tie.

    sets (string, tie, rank, uuid), as of tie_sets(), by row ids: the row whose id is tie has a row for each candidate, best
    first; any other row has one, without candidate, which names that row. Without sets, from results alone: the
    candidates that an answer lists, which are the first few.
    """
    rows = results.where(F.col("match_type").isin(*TIES)).select("row_id", "original", "guid", "frequency", "match_type", "confidence", "match_depth", "candidate_ids")
    if sets is None:
        rows = rows.select("*", F.col("row_id").alias("tie"), F.posexplode("candidate_ids").alias("rank", "authority_id"))
    else:
        rows = rows.join(sets.select(F.col("string").alias("row_id"), "tie", "rank", F.col("uuid").alias("authority_id")), "row_id")
    info = authority.select(F.col("uuid").alias("authority_id"), F.col("name").alias("authority_name"), "level", "jurisdiction")
    return rows.drop("candidate_ids").join(info, "authority_id", "left").orderBy("row_id", "rank")


def level_provenance(decided_rows: DataFrame, authority: DataFrame, chain: DataFrame) -> DataFrame:
    """The best candidate's chain, leaf first: which term confirmed each level, and how it was found."""
    best = decided_rows.select("row_id", "guid", "m", F.get(F.when(F.size("m.ids") > 0, F.col("m.ids")).otherwise(F.col("m.tied")), F.lit(0)).alias("uuid")).where("uuid IS NOT NULL")
    nodes = best.join(chain, "uuid").select("row_id", "guid", "m", F.posexplode(F.array_distinct(F.concat(F.array("uuid"), F.slice("anc", 1, V.SCOPE_HOPS - 1)))).alias("depth_from_leaf", "node"))
    step = F.get(F.reverse(F.filter(F.col("m.steps"), lambda s: F.array_contains(s["uuids"], F.col("node")))), F.lit(0))
    rows = nodes.withColumn("s", step)
    origin = F.coalesce(F.get(F.col("s.origins"), (F.array_position(F.col("s.uuids"), F.col("node")) - 1).cast("int")), F.lit(""))
    info = authority.select(F.col("uuid").alias("node"), "level", "name", "jurisdiction")
    out = rows.withColumn("origin", origin).join(info, "node")
    method = F.when(F.col("s").isNull(), "inferred").otherwise(F.coalesce(F.element_at(X.literal_map(V.METHOD), F.col("origin")), F.lit("normalized")))
    return out.select("row_id", "guid", "depth_from_leaf", "level", F.col("node").alias("uuid"), "name", "jurisdiction", F.coalesce("s.term", F.lit("")).alias("raw_term"), method.alias("match_method"), "origin")


def defects(decided_rows: DataFrame, authority: DataFrame) -> DataFrame:
    """(term, uuid, auth_name, jurisdiction, rows): anchors that an alias maps to a place though they are words for kinds of places."""
    top = F.get("m.tied", F.lit(0))
    anchor = F.get("r", F.lit(0))
    rows = decided_rows.where((F.col("m.type") == "low_evidence") & (F.size("m.tied") > 0)).select(F.lower(anchor["term"]).alias("term"), top.alias("uuid"), F.get(F.filter(anchor["cands"], lambda c: c["uuid"] == top), F.lit(0))["origin"].alias("origin"))
    counts = rows.where("origin = 'mnt'").groupBy("term", "uuid").agg(F.count("*").alias("rows"))
    return counts.join(authority.select("uuid", F.col("name").alias("auth_name"), "jurisdiction"), "uuid", "left").select("term", "uuid", "auth_name", "jurisdiction", "rows")


def helper_term(text: str, authority: DataFrame, names: DataFrame, chain: DataFrame) -> tuple[str, int] | None:
    """(uuid, level) of one place string given as context: its last term's record under all terms to its right, the most populous, then the smallest id."""
    parts = [p.strip() for p in text.replace(";", ",").split(",") if p.strip()]
    confirmed = None
    best = None
    for part in reversed(parts):  # a handful of terms, each a lookup by key
        hits = names.where(F.col("key").isin(part.lower(), part.lower().replace("-", " "))).select("uuid").distinct()
        rows = hits.join(authority, "uuid").join(chain, "uuid", "left")
        if confirmed is not None:
            rows = rows.where(F.array_contains("anc", confirmed))
        top = rows.orderBy(F.desc(F.coalesce("population", F.lit(0))), "uuid").select("uuid", "level").first()
        if top is None:
            break
        confirmed, best = top["uuid"], (top["uuid"], top["level"] or 0)
    return best
