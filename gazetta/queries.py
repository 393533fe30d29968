"""The registered queries of the library proper and the SQL of the checking engine for each that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as X
from .functions import vocab as V
from .operators import candidates as C
from .operators import hierarchy as H
from .operators import matching as M
from .operators import metrics as E
from .operators import sampling as R
from .operators import segment as S
from .plans import match as P
from .sources import derived as D
from .sources import tables as T
from .sources.shared import still_there

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, derived: bool = False):
    """Registers a query by its function's name; derived: the SQL reads the derived authority and places."""

    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = (f"WITH {D.AUTHORITY_SQL.strip()},{D.PLACES_SQL} " if derived else "") + sql
        return f

    return keep


def joined(c: str | Column) -> Column:
    return F.array_join(c, "|")


@query("SELECT uuid, parent, name, level, jurisdiction, population, round(lat, 4) AS lat, round(lon, 4) AS lon FROM authority", derived=True)
def scan_authority(spark, d):
    return D.authority(spark, d).select("uuid", "parent", "name", "level", "jurisdiction", "population", F.round("lat", 4).alias("lat"), F.round("lon", 4).alias("lon"))


@query("SELECT row_id, place, guid, frequency, label FROM places", derived=True)
def scan_places(spark, d):
    return D.places(spark, d)


@query("SELECT DISTINCT key, uuid, jurisdiction FROM (SELECT unnest([lower(name), replace(lower(name), '-', ' ')]) AS key, uuid, jurisdiction FROM authority)", derived=True)
def name_index(spark, d):
    return T.name_index(D.authority(spark, d))


@query("SELECT lower(p_brand) AS key, 'C' || min(p_partkey) AS uuid, 'raw' AS src FROM part SEMI JOIN customer ON p_partkey = c_custkey GROUP BY 1")
def alias_index(spark, d):
    return T.alias_index(D.aliases(spark, d))


@query("SELECT lower(place) AS key, min(label) AS uuid FROM places WHERE label LIKE 'C%' AND place LIKE '%,%' GROUP BY 1 HAVING count(DISTINCT label) = 1", derived=True)
def whole_string_index(spark, d):
    rows = D.places(spark, d).where("label LIKE 'C%'")
    return T.whole_string_index(rows.select(F.col("place").alias("raw"), F.lit("").alias("value"), F.col("label").alias("uuid")))


@query("SELECT lower(p_name) AS key, 'C' || o_custkey AS uuid, count(*) AS freq FROM part JOIN orders ON p_partkey = o_custkey GROUP BY p_name, o_custkey")
def term_frequencies(spark, d):
    return D.term_frequencies(spark, d)


@query("SELECT row_id, array_to_string(list_filter(list_transform(regexp_split_to_array(place, '[,;]'), lambda x: trim(x)), lambda x: x <> ''), '|') AS terms FROM places", derived=True)
def split_terms(spark, d):
    return D.places(spark, d).select("row_id", joined(X.drop_noise(X.split_terms(F.col("place")))).alias("terms"))


@query("SELECT row_id, c AS canonical, 'mnt-' || substr(sha1(c), 1, 12) AS guid FROM (SELECT row_id, array_to_string(list_filter(list_transform(regexp_split_to_array(lower(place), '[,;]'), lambda x: trim(x)), lambda x: x <> ''), ', ') AS c FROM places)", derived=True)
def canonical_guid(spark, d):
    return D.places(spark, d).select("row_id", X.canonical(F.col("place")).alias("canonical"), X.place_guid(F.col("place")).alias("guid"))


@query("SELECT row_id, array_to_string(list_sort(list_distinct(list_filter(regexp_split_to_array(regexp_replace(lower(place), '[^a-z0-9 ]', ' ', 'g'), ' +'), lambda x: x <> ''))), '|') AS tokens FROM places", derived=True)
def tokens(spark, d):
    return D.places(spark, d).select("row_id", joined(F.array_sort(X.tokens(F.col("place")))).alias("tokens"))


def cases(key: str, items: list[str]) -> str:
    """SQL for one of several literals by a key."""
    return f"CASE {key} % {len(items)} " + " ".join(f"WHEN {i} THEN {'NULL' if x is None else chr(39) + x.replace(chr(39), chr(39) * 2) + chr(39)}" for i, x in enumerate(items)) + " END"


# Strings with what the rules make of them; {p} is the part's name.
REWRITES = [
    ("near {p}", "{p}", None), ("north of {p}", "{p}", None), ("County of {p}", "{p}", "County"), ("{p} County", "{p}", "County"),
    ("{p} Twp.", "{p}", "Township"), ("rural {p} area", "{p}", None), ("territory of {p}", "{p}", None), ("Mt. {p}", "Mount {p}", None),
    ("{p}", None, None), ("near City of {p} R.D. 2", "{p}", "City"), ("{p} Route 66", "{p}", None), ("{p} Co.", "{p}", "County"),
]


def templated(spark, d, templates: list[str]) -> DataFrame:
    part = D.table(spark, d, "part")
    text = F.lit(None).cast("string")
    for i, t in enumerate(templates):
        before, after = t.split("{p}") if "{p}" in t else (t, None)
        made = F.lit(t) if after is None else F.concat(F.lit(before), "p_name", F.lit(after))
        text = F.when(F.col("p_partkey") % len(templates) == i, made).otherwise(text)
    return part.select("p_partkey", "p_name", text.alias("term"))


def expected(key: str, items: list[str | None]) -> str:
    return f"replace({cases(key, items)}, '{{p}}', p_name)"


@query(f"SELECT p_partkey, {expected('p_partkey', [x[0] for x in REWRITES])} AS term, {expected('p_partkey', [x[1] for x in REWRITES])} AS cleaned, {cases('p_partkey', [x[2] for x in REWRITES])} AS jurisdiction FROM part")
def rewrite_terms(spark, d):
    df = templated(spark, d, [x[0] for x in REWRITES]).withColumn("r", X.rewrite(F.col("term")))
    return df.select("p_partkey", "term", F.col("r.cleaned").alias("cleaned"), F.col("r.jurisdiction").alias("jurisdiction"))


HINTS = [("{p} County", "County"), ("{p} Twp", "Township"), ("{p} Parish", "Parish"), ("{p} borough", "Borough"), ("County {p}", None), ("{p}", None)]


@query(f"SELECT p_partkey, {cases('p_partkey', [x[1] for x in HINTS])} AS hint FROM part")
def jurisdiction_hint(spark, d):
    return templated(spark, d, [x[0] for x in HINTS]).select("p_partkey", X.jurisdiction_hint(F.col("term")).alias("hint"))


VARIANTS = [("Saint {p}", "St {p}"), ("St. {p}", "Saint {p}"), ("Ft {p}", "Fort {p}"), ("DeKalb", "De Kalb"), ("La Porte", "LaPorte"), ("{p}", ""), ("lasalle", "la Salle"), ("Mount {p}", "Mt {p}")]


@query(f"SELECT p_partkey, {expected('p_partkey', [x[1] for x in VARIANTS])} AS variants FROM part")
def name_variants(spark, d):
    return templated(spark, d, [x[0] for x in VARIANTS]).select("p_partkey", joined(X.name_variants(F.col("term"))).alias("variants"))


PREPOSITIONS = [("home of x in {p}", "{p}|x in {p}"), ("one mile north of {p}", "{p}"), ("from {p}", "{p}"), ("{p}", ""), ("of {p}", ""), ("born at {p}", "{p}")]


@query(f"SELECT p_partkey, {expected('p_partkey', [x[1] for x in PREPOSITIONS])} AS found FROM part")
def after_prepositions(spark, d):
    return templated(spark, d, [x[0] for x in PREPOSITIONS]).select("p_partkey", joined(X.after_prepositions(F.col("term"))).alias("found"))


CARDINALS = [("north {p}", "{p}"), ("Upper East {p}", "{p}"), ("eastern {p}", None), ("{p}", None)]


@query(f"SELECT p_partkey, {expected('p_partkey', [x[1] for x in CARDINALS])} AS stripped FROM part")
def cardinal_strip(spark, d):
    return templated(spark, d, [x[0] for x in CARDINALS]).select("p_partkey", X.without_cardinal(F.col("term")).alias("stripped"))


SHAPES = [("{p}, {p2}", "doubled"), ("Koolik, Koolik", "adjacent|doubled"), ("Madison, route 6, Madison", "restated"), ("hospital, Nashville; Tenn.", "joined"), ("five miles north of Danville, Danville", "embedded"), ("{p}", "")]


@query("SELECT p_partkey, " + cases("p_partkey", [x[1] for x in SHAPES[1:]]) + " AS tags FROM part")
def shape_tags(spark, d):
    return templated(spark, d, [x[0] for x in SHAPES[1:]]).select("p_partkey", joined(X.shape_tags(F.col("term"))).alias("tags"))


CORRUPT = [("Vend+¦me", True), ("Besançon", False), ("GÇ x", True), ("{p}", False)]


@query("SELECT p_partkey, (p_partkey % 4) IN (0, 2) AS suspect FROM part")
def encoding_suspect(spark, d):
    return templated(spark, d, [x[0] for x in CORRUPT]).select("p_partkey", X.has_corruption(F.col("term")).alias("suspect"))


DESCRIPTIONS = [("the village", True), ("City", True), ("Grove City", False), ("{p}", False), ("station.", True), ("the", False)]


@query("SELECT p_partkey, (p_partkey % 6) IN (0, 1, 4) AS vague FROM part")
def description_gate(spark, d):
    return templated(spark, d, [x[0] for x in DESCRIPTIONS]).select("p_partkey", X.is_description(F.col("term")).alias("vague"))


_ABBREVIATIONS = ", ".join(f"('{k}', '{n}')" for k, names in V.ABBREVIATIONS.items() for n in names)


@query(f"SELECT c_custkey, t.k AS term, string_agg(t.n, '|' ORDER BY t.n) AS names FROM customer JOIN (VALUES {_ABBREVIATIONS}) t(k, n) ON c_custkey % 130 = (SELECT count(DISTINCT k2) FROM (VALUES {_ABBREVIATIONS}) u(k2, n2) WHERE k2 < t.k) GROUP BY ALL")
def abbreviations(spark, d):
    keys = F.array(*[F.lit(k) for k in sorted(V.ABBREVIATIONS)])
    df = D.table(spark, d, "customer").select("c_custkey", F.get(keys, (F.col("c_custkey") % 130).cast("int")).alias("term")).where("term IS NOT NULL")
    return df.select("c_custkey", "term", joined(F.array_sort(X.expansions(F.concat(F.upper("term"), F.lit("."))))).alias("names"))


@query("SELECT doc_id, CASE WHEN regexp_matches(t, '\\b(township|twp|town|city|village|borough|parish)\\b') THEN 'suffix' ELSE 'other' END AS kind, length(t) AS n FROM (SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(lower(strip_accents(text)), '\\([^)]*\\)', ' ', 'g'), '[''’]', '', 'g'), '[^\\p{L}\\p{N}]+', ' ', 'g')) AS t FROM documents)")
def normalized_terms(spark, d):
    df = D.table(spark, d, "documents").select("doc_id", X.normalized_term(F.lower("text")).alias("t"))
    return df.select("doc_id", F.when(F.col("t").rlike(r"\b(township|twp|town|city|village|borough|parish)\b"), "suffix").otherwise("other").alias("kind"), F.length("t").cast("long").alias("n"))


@query("SELECT a.uuid AS a, b.uuid AS b, round(2 * 6371.0 * asin(sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2))), 3) AS km FROM authority a JOIN authority b ON a.parent = b.parent AND a.level = 5 AND b.level = 5 AND a.uuid < b.uuid", derived=True)
def sibling_distances(spark, d):
    c = D.authority(spark, d).where("level = 5").select("uuid", "parent", "lat", "lon")
    j = c.toDF("a", "parent", "lat1", "lon1").join(c.toDF("b", "parent", "lat2", "lon2"), "parent").where("a < b")
    return j.select("a", "b", F.round(X.haversine_km(F.col("lat1"), F.col("lon1"), F.col("lat2"), F.col("lon2")), 3).alias("km"))


_CLOSURE = "anc AS (SELECT uuid, 1 AS hop, parent AS anc FROM authority WHERE parent IS NOT NULL UNION ALL SELECT x.uuid, x.hop + 1, a.parent FROM anc x JOIN authority a ON a.uuid = x.anc WHERE a.parent IS NOT NULL AND x.hop < 15)"


def with_closure(sql: str) -> str:
    return f"WITH RECURSIVE {D.AUTHORITY_SQL.strip()},{D.PLACES_SQL}, {_CLOSURE} {sql}"


@query(with_closure("SELECT uuid, hop, anc FROM anc"))
def ancestors(spark, d):
    return H.ancestors(D.authority(spark, d))


@query(with_closure("SELECT a.uuid, CASE WHEN a.level BETWEEN 3 AND 10 THEN a.uuid ELSE (SELECT min_by(anc, hop) FROM anc JOIN authority b ON b.uuid = anc.anc WHERE anc.uuid = a.uuid AND b.level BETWEEN 3 AND 10) END AS leaf FROM authority a"))
def supported_leaf(spark, d):
    return H.supported_leaf(D.authority(spark, d))


_TERMS = "terms AS (SELECT DISTINCT term, lower(term) AS key FROM (SELECT unnest(list_filter(list_transform(regexp_split_to_array(place, '[,;]'), lambda x: trim(x)), lambda x: x <> '')) AS term FROM places))"


def spark_terms(spark, d) -> DataFrame:
    return C.distinct_terms(D.places(spark, d).select("row_id", X.split_terms(F.col("place")).alias("terms")))


@query(f"WITH {D.AUTHORITY_SQL.strip()},{D.PLACES_SQL}, {_TERMS} SELECT t.key, a.uuid FROM terms t JOIN authority a ON lower(a.name) = t.key")
def exact_candidates(spark, d):
    return C.by_name(spark_terms(spark, d), T.name_index(D.authority(spark, d))).select("key", "uuid")


@query(f"WITH {D.AUTHORITY_SQL.strip()},{D.PLACES_SQL}, {_TERMS}, free AS (SELECT term, key, regexp_replace(term, '^(near|City of) ', '') AS q, term LIKE 'City of%' AS city FROM terms WHERE regexp_matches(term, '^(near|City of) ')) SELECT f.key, a.uuid, f.q AS span FROM free f JOIN authority a ON lower(a.name) = lower(f.q) AND (NOT city OR a.jurisdiction = 'City')")
def rewritten_candidates(spark, d):
    names = T.name_index(D.authority(spark, d))
    return C.by_rewrite(spark_terms(spark, d), names, C.any_index(names, T.alias_index(D.aliases(spark, d)))).select("key", "uuid", "span")


@query(f"WITH {D.AUTHORITY_SQL.strip()},{D.PLACES_SQL}, {_TERMS} SELECT t.key AS word, n.near FROM (SELECT DISTINCT key FROM terms) t JOIN (SELECT DISTINCT lower(name) AS near FROM authority) n ON damerau_levenshtein(t.key, n.near) = 1")
def fuzzy_join(spark, d):
    words = spark_terms(spark, d).select(F.col("key").alias("word")).distinct()
    return C.fuzzy_join(words, C.vocabulary(T.name_index(D.authority(spark, d))))


@query("SELECT key, CASE WHEN n > 1 AND f1 >= 10 AND f1 >= 5 * f2 THEN u1 END AS winner FROM (SELECT key, count(*) AS n, max(CASE WHEN r = 1 THEN freq END) AS f1, max(CASE WHEN r = 2 THEN freq END) AS f2, max(CASE WHEN r = 1 THEN uuid END) AS u1 FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY freq DESC, uuid) AS r FROM (SELECT lower(p_name) || '/' || (o_custkey % 200) AS key, 'C' || o_custkey AS uuid, count(*) AS freq FROM part JOIN orders ON p_partkey = o_custkey GROUP BY p_name, o_custkey)) GROUP BY key)")
def frequency_prior(spark, d):
    rows = D.term_frequencies(spark, d).withColumn("key", F.concat("key", F.lit("/"), (F.substring("uuid", F.lit(2), F.length("uuid")).cast("long") % 200).cast("string")))
    top = E.top_per_class(rows, "key", [F.desc("freq"), "uuid"], 2)
    per = top.groupBy("key").agg(F.count("*").alias("n"), F.max(F.when(F.col("rank") == 1, F.col("freq"))).alias("f1"), F.max(F.when(F.col("rank") == 2, F.col("freq"))).alias("f2"), F.max(F.when(F.col("rank") == 1, F.col("uuid"))).alias("u1"))
    return per.select("key", F.when((F.col("n") > 1) & (F.col("f1") >= V.FREQUENCY_LEAST) & (F.col("f1") >= V.FREQUENCY_RATIO * F.col("f2")), F.col("u1")).alias("winner"))


def sources(spark, d) -> P.Sources:
    return P.Sources(D.authority(spark, d), D.aliases(spark, d), D.term_frequencies(spark, d))


#: The last match of a session: its folder of tables and what it wrote, which the queries below share.
_LAST: dict[tuple[str, str], P.Matched] = {}


def matched(spark, d) -> P.Matched:
    """The match of a folder's places; results, ties, provenance and the rest read what one match wrote."""
    key = (spark.sparkContext.applicationId, d)
    held = _LAST.get(key)
    if held is None or not all(map(still_there, held.kept())):
        _LAST.clear()
        held = _LAST[key] = P.match(D.places(spark, d), sources(spark, d))
    return held


def flat(results: DataFrame) -> DataFrame:
    """Results as written: lists joined."""
    return results.withColumns({"candidate_ids": joined("candidate_ids"), "candidate_names": joined("candidate_names"), "source_shape": F.array_join("source_shape", ";")})


@query()
def match_results(spark, d):
    return flat(matched(spark, d).results)


# Whole chains: the place's homonyms under nations of that name, or one edit from it, in the region; cities before townships; one left wins.
_CHAINS = """, near AS (SELECT a.uuid AS u, b.uuid AS v FROM authority a JOIN authority b ON a.level = 6 AND b.level = 6 AND (a.uuid = b.uuid OR damerau_levenshtein(lower(a.name), lower(b.name)) = 1) AND a.parent = b.parent),
  leaf AS (SELECT 'C' || c_custkey AS uuid, 'N' || c_nationkey AS nation FROM customer),
  asked AS (SELECT row_id, place, p.label, l.nation, a.name FROM places p JOIN leaf l ON l.uuid = p.label JOIN authority a ON a.uuid = p.label WHERE row_id % 10 = 0),
  hits AS (SELECT q.row_id, c.uuid, c.jurisdiction, c.population FROM asked q JOIN near ON near.u = q.nation JOIN leaf x ON x.nation = near.v JOIN authority c ON c.uuid = x.uuid AND c.name = q.name),
  kept AS (SELECT *, count(*) FILTER (jurisdiction = 'City') OVER (PARTITION BY row_id) AS cities FROM hits),
  final AS (SELECT row_id, count(*) AS n, string_agg(uuid, '|' ORDER BY population DESC, uuid) AS ids FROM kept WHERE cities = 0 OR jurisdiction = 'City' GROUP BY row_id)
SELECT row_id, CASE WHEN n = 1 THEN 'chain_verified' ELSE 'chain_amb' END AS match_type, 3 AS match_depth, array_to_string(list_slice(string_split(ids, '|'), 1, 5), '|') AS candidate_ids FROM final"""


@query(f"WITH {D.AUTHORITY_SQL.strip()},{D.PLACES_SQL}{_CHAINS}")
def match_chains(spark, d):
    return flat(matched(spark, d).results).where("row_id % 10 = 0").select("row_id", "match_type", "match_depth", "candidate_ids")


@query()
def match_ties(spark, d):
    """All candidates of every tie; rows of the same tie share them, by the column tie."""
    m = matched(spark, d)
    return m.tied(D.authority(spark, d))


@query()
def level_provenance(spark, d):
    return matched(spark, d).provenance(D.authority(spark, d))


@query()
def levels_json(spark, d):
    m = matched(spark, d)
    return P.levels_json(m.results, m.provenance(D.authority(spark, d)))


@query()
def match_summary(spark, d):
    return E.summary(matched(spark, d).results)


@query()
def match_defects(spark, d):
    return M.defects(matched(spark, d).decided, D.authority(spark, d))


@query(
    f"""WITH {D.AUTHORITY_SQL.strip()},{D.PLACES_SQL} SELECT row_id, 'accepted' AS decision, replace(replace(place, ' NATION', '|NATION'), ' ' || r_name, '|' || r_name) AS segments
        FROM places JOIN customer ON c_custkey = row_id JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey WHERE row_id % 10 = 5"""
)
def segmentation(spark, d):
    authority = D.authority(spark, d)
    rows = D.places(spark, d).where("row_id % 10 = 5").select("row_id", X.split_terms(F.col("place")).alias("terms"))
    return S.log(rows, authority, T.name_index(authority), T.alias_index(D.aliases(spark, d))).select("row_id", "decision", "segments")


@query()
def segmentation_log(spark, d):
    """All places: every string of one term, accepted or rejected, with the reason. No SQL twin: SQL cannot walk the pieces."""
    authority = D.authority(spark, d)
    rows = D.places(spark, d).select("row_id", X.split_terms(F.col("place")).alias("terms"))
    return S.log(rows, authority, T.name_index(authority), T.alias_index(D.aliases(spark, d)))


# A made-up answer for each place, so that measures have all kinds of rows.
_ANSWERS = """, answers AS (SELECT row_id, guid, place AS original, frequency::BIGINT AS frequency, label, CASE WHEN row_id % 5 = 0 THEN '' WHEN row_id % 7 = 0 THEN 'C' || (row_id + 1) ELSE 'C' || row_id END AS authority_id,
  CASE WHEN row_id % 5 = 0 THEN CASE WHEN row_id % 2 = 0 THEN 'chain_amb' ELSE 'no_auth_match' END WHEN row_id % 3 = 0 THEN 'parent_resolved' ELSE 'chain_verified' END AS match_type,
  CASE WHEN row_id % 5 = 0 THEN NULL ELSE 4 + (row_id % 4)::INT END AS level, (row_id % 3)::INT AS skipped_count, ['head', 'mid', 'low', 'tail'][1 + (row_id % 4)::INT] AS band, CASE WHEN row_id % 10 <= 6 THEN 'verified' ELSE 'other' END AS status FROM places)"""


def answers(spark, d) -> DataFrame:
    k = F.col("row_id")
    return D.places(spark, d).select(
        "row_id", "guid", F.col("place").alias("original"), F.col("frequency").cast("long").alias("frequency"), "label",
        F.when(k % 5 == 0, "").when(k % 7 == 0, F.concat(F.lit("C"), k + 1)).otherwise(F.concat(F.lit("C"), k)).alias("authority_id"),
        F.when(k % 5 == 0, F.when(k % 2 == 0, "chain_amb").otherwise("no_auth_match")).when(k % 3 == 0, "parent_resolved").otherwise("chain_verified").alias("match_type"),
        F.when(k % 5 != 0, (4 + k % 4).cast("int")).alias("level"), (k % 3).cast("int").alias("skipped_count"),
        F.get(F.array(*map(F.lit, V.BANDS)), (k % 4).cast("int")).alias("band"), F.when(k % 10 <= 6, "verified").otherwise("other").alias("status"),
    )


def scored_sql(sql: str) -> str:
    return f"""WITH {D.AUTHORITY_SQL.strip()},{D.PLACES_SQL}{_ANSWERS}, scored AS (SELECT *, CASE WHEN label = 'ABSTAIN' THEN CASE WHEN authority_id = '' THEN 'correct' ELSE 'wrong' END WHEN authority_id = '' THEN 'abstain' WHEN authority_id = label THEN 'correct' ELSE 'wrong' END AS verdict FROM answers) {sql}"""


def scored(spark, d) -> DataFrame:
    a = answers(spark, d)
    return E.with_bucket(a.select("row_id", "guid", "original", "label", "band", "status", "frequency", "match_type"), a.select("guid", "authority_id"))


def is_place(c: Column) -> Column:
    return c.startswith("C")


def bands(spark) -> DataFrame:
    return spark.createDataFrame([("head", 10159, 6768439159), ("mid", 158187, 518656944), ("low", 838894, 162395897), ("tail", 250550, 1070162)], "band string, strings long, records long")


_BANDS = "(VALUES ('head', 10159, 6768439159), ('mid', 158187, 518656944), ('low', 838894, 162395897), ('tail', 250550, 1070162)) b(band, strings, records)"


@query(scored_sql("SELECT count(*) AS total_rows, sum(frequency)::BIGINT AS total_frequency, count(*) FILTER (authority_id <> '') AS matched_rows, (sum(frequency) FILTER (authority_id <> ''))::BIGINT AS matched_frequency, count(*) FILTER (authority_id = '' AND match_type = 'chain_amb') AS amb_rows, count(*) FILTER (authority_id = '' AND match_type <> 'chain_amb') AS unmatched_rows, round(count(*) FILTER (authority_id <> '') / count(*), 6) AS matched_row_rate FROM answers"))
def match_rate(spark, d):
    r = E.match_rate(answers(spark, d), is_place(F.col("authority_id")))
    return r.select("total_rows", "total_frequency", "matched_rows", "matched_frequency", "amb_rows", "unmatched_rows", F.round("matched_row_rate", 6).alias("matched_row_rate"))


@query(scored_sql("SELECT level, count(*) AS count, round(count(*) / sum(count(*)) OVER (), 6) AS pct, round(sum(CASE WHEN level BETWEEN 2 AND 5 THEN count(*) ELSE 0 END) OVER () / sum(count(*)) OVER (), 6) AS specificity FROM answers WHERE level IS NOT NULL GROUP BY level"))
def depth(spark, d):
    return E.depth(answers(spark, d)).select("level", "count", F.round("pct", 6).alias("pct"), F.round("specificity", 6).alias("specificity"))


def chained(spark, d) -> DataFrame:
    names = D.authority(spark, d).select(F.col("uuid").alias("authority_id"), F.col("name").alias("type_ahead"))
    return answers(spark, d).join(names, "authority_id")


_TOKENS = "list_distinct(list_filter(regexp_split_to_array(regexp_replace(lower({}), '[^a-z0-9 ]', ' ', 'g'), ' +'), lambda x: x <> ''))"


@query(scored_sql(f"SELECT row_id, len(o) > 0 AND list_has_all(t, o) AS contained, len(o) > 0 AND NOT list_has_any(o, t) AS disjoint FROM (SELECT row_id, {_TOKENS.format('original')} AS o, {_TOKENS.format('name')} AS t FROM answers JOIN authority ON uuid = authority_id)"))
def token_overlap(spark, d):
    return chained(spark, d).select("row_id", E.contained(F.col("original"), F.col("type_ahead")).alias("contained"), E.disjoint(F.col("original"), F.col("type_ahead")).alias("disjoint"))


@query(scored_sql("SELECT coalesce(method, 'none') AS method, count(*) AS rows, sum(frequency)::BIGINT AS frequency FROM (SELECT frequency, CASE WHEN skipped_count > 0 THEN 'explicit' WHEN n >= 2 AND level >= 6 THEN 'inferred' WHEN n >= 3 AND level >= 5 THEN 'inferred' END AS method FROM (SELECT *, len(list_filter(string_split(original, ','), lambda x: trim(x) <> '')) AS n FROM answers WHERE authority_id <> '')) GROUP BY 1"))
def partials(spark, d):
    df = answers(spark, d).where("authority_id <> ''").withColumn("method", F.coalesce(E.partial(F.col("original"), F.col("level"), F.col("skipped_count")), F.lit("none")))
    return df.groupBy("method").agg(F.count("*").alias("rows"), F.sum("frequency").cast("long").alias("frequency"))


@query(scored_sql("SELECT c AS count, round(c / m, 6) AS rate, f AS frequency, round(f / mf, 6) AS freq_rate FROM (SELECT count(*) FILTER (match_type = 'parent_resolved') AS c, count(*) AS m, (sum(frequency) FILTER (match_type = 'parent_resolved'))::BIGINT AS f, sum(frequency) AS mf FROM answers WHERE authority_id <> '')"))
def parent_resolved(spark, d):
    r = E.weighted(answers(spark, d).where("authority_id <> ''"), F.col("match_type") == "parent_resolved")
    return r.select("count", F.round("rate", 6).alias("rate"), "frequency", F.round("freq_rate", 6).alias("freq_rate"))


@query(scored_sql("""SELECT correct, wrong, false_pos, miss, round(correct / (correct + wrong + false_pos), 6) AS precision, round(correct / (correct + wrong + miss), 6) AS recall FROM (SELECT count(*) FILTER (k = 'c') AS correct, count(*) FILTER (k = 'w') AS wrong, count(*) FILTER (k = 'f') AS false_pos, count(*) FILTER (k = 'm') AS miss FROM (SELECT CASE WHEN authority_id = label THEN 'c' WHEN authority_id LIKE 'C%' AND label LIKE 'C%' THEN 'w' WHEN authority_id LIKE 'C%' THEN 'f' WHEN label LIKE 'C%' THEN 'm' ELSE 'c' END AS k FROM answers))"""))
def ground_truth(spark, d):
    r = E.confusion(answers(spark, d).withColumnRenamed("label", "truth"), is_place)
    return r.select("correct", "wrong", "false_pos", "miss", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))


@query(scored_sql("SELECT band, count(*) FILTER (verdict = 'correct') AS correct, count(*) FILTER (verdict = 'wrong') AS wrong, count(*) FILTER (verdict = 'abstain') AS abstain, count(*) AS scored, round(count(*) FILTER (verdict = 'correct') / count(*), 6) AS accuracy FROM scored WHERE label <> 'NONE' GROUP BY band"))
def band_scores(spark, d):
    return E.by_band(scored(spark, d)).withColumn("accuracy", F.round("accuracy", 6))


@query(scored_sql(f"SELECT round(sum(records * a) / sum(records), 6) AS record_accuracy FROM (SELECT band, avg(CASE WHEN verdict = 'correct' THEN 1.0 ELSE 0 END) AS a FROM scored WHERE label <> 'NONE' GROUP BY band) JOIN {_BANDS} USING (band)"))
def record_accuracy(spark, d):
    return E.record_accuracy(scored(spark, d), bands(spark)).select(F.round("record_accuracy", 6).alias("record_accuracy"))


@query(scored_sql(f"SELECT run, round(sum(strings * a) / 1257790, 6) AS term_accuracy, round(sum(records * a) / 7450562162, 6) AS record_accuracy, round(sum(records * c) / 7450562162, 6) AS coverage FROM (SELECT CASE WHEN row_id % 2 = 0 THEN 'even' ELSE 'odd' END AS run, band, avg(CASE WHEN verdict = 'correct' THEN 1.0 ELSE 0 END) AS a, avg(CASE WHEN authority_id <> '' THEN 1.0 ELSE 0 END) AS c FROM scored WHERE label <> 'NONE' GROUP BY ALL) JOIN {_BANDS} USING (band) GROUP BY run"))
def paired_runs(spark, d):
    df = scored(spark, d).withColumn("run", F.when(F.col("row_id") % 2 == 0, "even").otherwise("odd"))
    return E.paired(df, bands(spark)).select("run", *[F.round(c, 6).alias(c) for c in ("term_accuracy", "record_accuracy", "coverage")])


@query(scored_sql("SELECT status, count(*) AS strings, sum(frequency)::BIGINT AS records, count(*) FILTER (verdict = 'correct') AS correct, coalesce(sum(frequency) FILTER (verdict = 'correct'), 0)::BIGINT AS records_correct, count(*) FILTER (authority_id <> '') AS committed, count(*) FILTER (authority_id <> '' AND verdict = 'correct') AS committed_correct FROM scored GROUP BY status"))
def status_scores(spark, d):
    return E.by_status(scored(spark, d))


@query(scored_sql("SELECT s AS scored, c AS correct, round(c / s, 6) AS accuracy, round((c / s + 3.8416 / (2 * s) - 1.96 * sqrt(c / s * (1 - c / s) / s + 3.8416 / (4 * s * s))) / (1 + 3.8416 / s), 6) AS low FROM (SELECT count(*) AS s, count(*) FILTER (verdict = 'correct') AS c FROM scored WHERE verdict <> 'abstain')"))
def draw_scores(spark, d):
    sheet = scored(spark, d).select(F.when(F.col("verdict") == "correct", "y").when(F.col("verdict") == "wrong", "n").otherwise("?").alias("verdict"), "frequency")
    return E.head_score(sheet, pps=True).select("scored", "correct", F.round("accuracy", 6).alias("accuracy"), F.round("low", 6).alias("low"))


@query(scored_sql("SELECT row_id, row_number() OVER w AS rank, round(frequency / sum(frequency) OVER (), 8) AS pct, round(sum(frequency) OVER (w ROWS UNBOUNDED PRECEDING) / sum(frequency) OVER (), 8) AS cum_pct FROM answers WINDOW w AS (ORDER BY frequency DESC, row_id)"))
def running_share(spark, d):
    r = E.running_share(answers(spark, d).select("row_id", "frequency"), "row_id")
    return r.select("row_id", "rank", F.round("pct", 8).alias("pct"), F.round("cum_pct", 8).alias("cum_pct"))


@query(scored_sql("SELECT guid, original, frequency FROM answers WHERE authority_id <> '' ORDER BY frequency DESC, row_id LIMIT 20"))
def top_answers(spark, d):
    return answers(spark, d).where("authority_id <> ''").orderBy(F.desc("frequency"), "row_id").limit(20).select("guid", "original", "frequency")


@query(scored_sql("SELECT verdict, row_id, frequency, rank FROM (SELECT *, row_number() OVER (PARTITION BY verdict ORDER BY frequency DESC, row_id) AS rank FROM scored) WHERE rank <= 6"))
def examples_by_verdict(spark, d):
    return E.top_per_class(scored(spark, d).select("verdict", "row_id", "frequency"), "verdict", [F.desc("frequency"), "row_id"])


@query(scored_sql("SELECT band AS key, count(*) AS n, round(avg(CASE WHEN verdict = 'correct' THEN 1.0 ELSE 0 END), 6) AS correct, round(avg(CASE WHEN verdict = 'wrong' THEN 1.0 ELSE 0 END), 6) AS wrong FROM scored GROUP BY band HAVING count(*) >= 25"))
def shares_by_band(spark, d):
    return E.shares_by(scored(spark, d), F.col("band")).select("key", "n", F.round("correct", 6).alias("correct"), F.round("wrong", 6).alias("wrong"))


@query(scored_sql("SELECT band, row_id FROM (SELECT band, row_id, row_number() OVER (PARTITION BY band ORDER BY sha1('s1:' || guid), guid) AS n FROM answers) WHERE n <= CASE band WHEN 'head' THEN 20 WHEN 'mid' THEN 15 WHEN 'low' THEN 10 ELSE 5 END"))
def stratified_sample(spark, d):
    return R.stratified(answers(spark, d).select("band", "row_id", "guid"), "band", "guid", {"head": 20, "mid": 15, "low": 10, "tail": 5}, "s1").select("band", "row_id")


@query(scored_sql("SELECT row_id, CASE WHEN n <= h THEN 'dev' ELSE 'heldout' END AS half FROM (SELECT row_id, row_number() OVER (PARTITION BY band ORDER BY sha1('s2:' || guid), guid) AS n, count(*) OVER (PARTITION BY band) // 2 AS h FROM answers) WHERE n <= 2 * h"))
def sample_halves(spark, d):
    return R.halves(answers(spark, d).select("band", "row_id", "guid"), "band", "guid", "s2").select("row_id", "half")


@query("SELECT c_custkey FROM customer WHERE c_custkey % greatest(1, (SELECT max(c_custkey) + 1 FROM customer) // 10) < 3 AND c_custkey // greatest(1, (SELECT max(c_custkey) + 1 FROM customer) // 10) < 10")
def strided_sample(spark, d):
    return R.strided(D.table(spark, d, "customer").select("c_custkey"), "c_custkey", 10, 3)


@query(scored_sql("SELECT band, strings, round_even(strings * m, 0)::BIGINT AS records, round_even(m, 1) AS mean_total, n AS sampled FROM (SELECT band, avg(frequency) AS m, count(*) AS n FROM answers GROUP BY band) JOIN " + _BANDS + " USING (band)"))
def band_weights(spark, d):
    return R.band_weights(answers(spark, d).select("band", F.col("frequency").alias("total")), bands(spark).select("band", "strings"))


@query(scored_sql("SELECT coalesce(CASE WHEN row_id % 11 = 0 THEN 'not_verified' WHEN authority_id = '' THEN 'no_authority_id' WHEN authority_id NOT IN (SELECT uuid FROM authority) THEN 'no_pa_record' WHEN lower(original) IN (SELECT lower(place) FROM places WHERE row_id % 10 = 1) THEN 'seen_in_development' END, 'usable') AS reason, count(*) AS rows FROM answers WHERE row_id % 10 <= 2 GROUP BY 1"))
def drop_reasons(spark, d):
    pool = answers(spark, d).where("row_id % 10 <= 2").select(F.col("original").alias("place"), F.when(F.col("row_id") % 11 == 0, "Open").otherwise("Verified").alias("match_status"), "authority_id")
    df = R.drop_reasons(pool, D.authority(spark, d).select("uuid"), D.places(spark, d).where("row_id % 10 = 1").select("place"))
    return df.groupBy(F.coalesce("reason", F.lit("usable")).alias("reason")).agg(F.count("*").alias("rows"))


@query(scored_sql("SELECT coalesce(CASE WHEN row_id % 11 = 0 THEN 'not_verified' WHEN authority_id = '' THEN 'no_authority_id' WHEN authority_id NOT IN (SELECT uuid FROM authority) THEN 'no_pa_record' WHEN lower(original) IN (SELECT lower(place) FROM places WHERE row_id % 10 = 1) THEN 'seen_in_development' END, 'usable') AS reason, count(*) AS rows FROM answers GROUP BY 1"))
def drop_reasons_of_all(spark, d):
    pool = answers(spark, d).select(F.col("original").alias("place"), F.when(F.col("row_id") % 11 == 0, "Open").otherwise("Verified").alias("match_status"), "authority_id")
    df = R.drop_reasons(pool, D.authority(spark, d).select("uuid"), D.places(spark, d).where("row_id % 10 = 1").select("place"))
    return df.groupBy(F.coalesce("reason", F.lit("usable")).alias("reason")).agg(F.count("*").alias("rows"))


@query(f"WITH {D.AUTHORITY_SQL.strip()},{D.PLACES_SQL} SELECT row_id FROM places WHERE lower(place) NOT IN (SELECT lower(place) FROM places WHERE row_id % 3 = 0)")
def holdout(spark, d):
    p = D.places(spark, d)
    return R.holdout(p, "place", p.where("row_id % 3 = 0").select("place"), "place").select("row_id")


@query(f"WITH {D.AUTHORITY_SQL.strip()},{D.PLACES_SQL} SELECT min(row_id) AS row_id FROM places GROUP BY regexp_replace(lower(place), '; ?', ', ', 'g')")
def first_by_canonical(spark, d):
    return R.first_by_canonical(D.places(spark, d), "place", "row_id").select("row_id")


@query("SELECT coalesce(n.k, o.k) AS term, coalesce(n.v, o.v) AS rows FROM (SELECT p_brand AS k, count(*) AS v FROM part WHERE p_size <= 30 GROUP BY 1) o FULL JOIN (SELECT p_brand AS k, count(*) AS v FROM part WHERE p_size > 40 GROUP BY 1) n ON o.k = n.k")
def defect_upsert(spark, d):
    part = D.table(spark, d, "part")
    count = lambda df: df.groupBy(F.col("p_brand").alias("term")).agg(F.count("*").alias("rows"))
    return T.upsert(count(part.where("p_size <= 30")), count(part.where("p_size > 40")), ["term"])


@query("SELECT c_custkey AS k, CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'ABSTAIN' WHEN 2 THEN 'ABSTAIN' ELSE 'C' || c_custkey END AS label, CASE c_custkey % 5 WHEN 0 THEN 'unlabelled' WHEN 1 THEN 'ambiguous' WHEN 2 THEN 'illegible' ELSE 'verified' END AS status FROM customer")
def classify_truth(spark, d):
    k = F.col("c_custkey")
    cell = F.when(k % 5 == 0, " ").when(k % 5 == 1, "Amb").when(k % 5 == 2, "ill").otherwise(F.concat(F.lit("C"), k))
    return D.table(spark, d, "customer").select(k.alias("k"), R.classify(cell).alias("x")).select("k", "x.label", "x.status")


@query(with_closure("SELECT reach, count(*) AS rows FROM (SELECT p.row_id, CASE WHEN NOT p.named THEN 'absent' WHEN EXISTS (SELECT 1 FROM anc x JOIN authority a ON a.uuid = x.anc WHERE x.uuid = p.label AND list_contains(p.t, lower(a.name))) THEN 'reachable' ELSE 'unsupported' END AS reach FROM (SELECT q.row_id, q.label, list_transform(regexp_split_to_array(lower(place), '[,;]'), lambda x: trim(x)) AS t, contains(' ' || regexp_replace(lower(place), '[,;]', '', 'g') || ' ', ' ' || lower(name) || ' ') AS named FROM places q JOIN authority ON uuid = q.label) p) GROUP BY reach"))
def reachability(spark, d):
    authority = D.authority(spark, d)
    rows = D.places(spark, d).where("label LIKE 'C%'").select("row_id", "place", F.col("label").alias("truth"))
    return E.reachability(rows, authority, H.ancestors(authority)).groupBy("reach").agg(F.count("*").alias("rows"))


@query(scored_sql("SELECT row_id, CASE verdict WHEN 'wrong' THEN 0 WHEN 'abstain' THEN 1 ELSE 2 END AS place_in_sheet, frequency FROM scored"))
def review_table(spark, d):
    order = F.when(F.col("verdict") == "wrong", 0).when(F.col("verdict") == "abstain", 1).otherwise(2)
    return scored(spark, d).select("row_id", order.alias("place_in_sheet"), "frequency").orderBy("place_in_sheet", F.desc("frequency"), "row_id")


@query("SELECT doc_id, quality, toxic, CASE WHEN quality = 1 AND toxic = 0 THEN 'correct' ELSE 'wrong' END AS verdict FROM labels")
def label_verdicts(spark, d):
    return D.table(spark, d, "labels").select("doc_id", "quality", "toxic", E.bucket(F.when(F.col("quality") == 1, "1").otherwise("0"), F.when(F.col("toxic") == 0, "1").otherwise("x")).alias("verdict"))


@query(f"WITH {D.AUTHORITY_SQL.strip()},{D.PLACES_SQL} SELECT row_id, CASE WHEN regexp_matches(lower(place), '\\b(city|village)\\b') THEN 'jurisdiction suffix' WHEN regexp_matches(lower(place), '\\b(home|farm)\\b') THEN 'names a feature' WHEN upper(place) = place AND lower(place) <> place THEN 'all caps, no other marker' ELSE 'plain place string' END AS shape FROM places")
def place_shapes(spark, d):
    return D.places(spark, d).select("row_id", X.shape_of(F.col("place")).alias("shape"))


@query("SELECT c_custkey AS rank, CASE WHEN c_custkey % 4 = 0 THEN 'correct' WHEN c_custkey % 3 = 0 THEN 'wrong' END AS verdict, coalesce(c_custkey % 4 = 0 AND c_custkey % 3 = 0, false) AS conflict FROM customer")
def merge_verdicts(spark, d):
    k = F.col("c_custkey")
    sheet = D.table(spark, d, "customer").select(k.alias("rank"), F.when(k % 4 == 0, "correct").alias("verdict"))
    return E.merged_verdicts(sheet, D.table(spark, d, "customer").where("c_custkey % 3 = 0").select(k.alias("rank"), F.lit("wrong").alias("new")))


@query("SELECT c_custkey AS rank, CASE WHEN c_custkey % 3 = 0 THEN 'wrong' WHEN c_custkey % 4 = 0 THEN 'correct' END AS verdict, coalesce(c_custkey % 4 = 0 AND c_custkey % 3 = 0, false) AS conflict FROM customer")
def merge_verdicts_forced(spark, d):
    k = F.col("c_custkey")
    sheet = D.table(spark, d, "customer").select(k.alias("rank"), F.when(k % 4 == 0, "correct").alias("verdict"))
    return E.merged_verdicts(sheet, D.table(spark, d, "customer").where("c_custkey % 3 = 0").select(k.alias("rank"), F.lit("wrong").alias("new")), force=True)


@query(scored_sql("SELECT state, count(*) AS rows FROM (SELECT CASE WHEN row_id % 6 = 0 THEN 'unresolved' WHEN row_id % 4 = 0 THEN 'blank' WHEN 'C' || row_id = authority_id THEN 'same' ELSE 'differs' END AS state FROM answers) GROUP BY state"))
def answer_states(spark, d):
    old = answers(spark, d).select("row_id", "authority_id")
    new = old.where("row_id % 6 <> 0").select("row_id", F.when(F.col("row_id") % 4 == 0, " ").otherwise(F.concat(F.lit("C"), "row_id")).alias("authority_id"))
    return E.compared(old, new, "row_id", "authority_id").groupBy("state").agg(F.count("*").alias("rows"))


@query(scored_sql("SELECT guid, flag, frequency FROM (SELECT guid, frequency, unnest(list_filter([CASE WHEN authority_id = '' THEN 'no answer' END, CASE WHEN frequency >= 90 THEN 'frequent' END, CASE WHEN contains(original, ';') THEN 'joined' END], lambda x: x IS NOT NULL)) AS flag FROM answers)"))
def flagged_answers(spark, d):
    rules = {"no answer": F.col("authority_id") == "", "frequent": F.col("frequency") >= 90, "joined": F.col("original").contains(";")}
    return E.flagged(answers(spark, d).select("guid", "original", "frequency", "authority_id"), rules).select("guid", "flag", "frequency")


@query()
def shape_counts(spark, d):
    """Strings by each tag of their shape, as the matcher's results carry them."""
    return E.shape_histogram(matched(spark, d).results)


@query()
def match_failures(spark, d):
    """Why the matcher's answers miss the truth: the class of each row whose verdict is not correct."""
    m, authority = matched(spark, d), D.authority(spark, d)
    truth = D.places(spark, d).where("label LIKE 'C%'").select("row_id", F.col("label").alias("truth"))
    skipped = m.spread(m.strings.select("row_id", F.col("m.skipped").alias("skipped")))  # not from the results, whose notes on neighbours are long
    rows = m.results.select("row_id", F.col("authority_id").alias("answer"), "match_type").join(truth, "row_id").join(skipped, "row_id").select("row_id", "truth", "answer", "match_type", "skipped")
    verdict = F.when(F.col("answer") == "", "abstain").when(F.col("answer") == F.col("truth"), "correct").otherwise("wrong")
    return E.failure_class(rows.withColumn("verdict", verdict).where("verdict <> 'correct'"), authority, H.ancestors(authority)).groupBy("failure").agg(F.count("*").alias("rows"))
