"""The matcher on a small gazetteer: golden outcomes, provenance, files."""

import json

import pytest

from gazetta.operators import fold
from gazetta.operators import matching as M
from gazetta.plans import match as P
from gazetta.sources import tables as T
from gazetta.sources.derived import AUTHORITY

ROWS = [
    ("USA", None, "USA", 8, "Country", 0, 40.0, -100.0, ""), ("IA", "USA", "Iowa", 6, "State", 0, 42.0, -93.0, ""), ("VA", "USA", "Virginia", 6, "State", 0, 37.5, -79.0, ""),
    ("FL", "USA", "Florida", 6, "State", 0, 28.0, -82.0, ""), ("ADA", "IA", "Adams", 5, "County", 0, 41.03, -94.70, ""), ("UNI", "IA", "Union", 5, "County", 0, 41.03, -94.30, ""),
    ("CRO", "UNI", "Cromwell", 4, "City", 100, 41.04, -94.46, ""), ("ROA", "VA", "Roanoke", 4, "City", 90000, 37.3, -79.9, ""), ("SPA", "IA", "Springfield", 4, "City", 10, 42.0, -93.0, ""),
    ("SPB", "IA", "Springfield", 4, "City", 20, 42.1, -93.1, ""), ("CAC", "ADA", "Cameron", 4, "City", 5, 41.0, -94.7, ""), ("CAK", "IA", "Cameron", 5, "County", 5, 41.5, -93.5, ""),
    ("VIL", "FL", "The Village", 4, "City", 5, 28.1, -82.1, ""), ("HAM", "VA", "Hampton", 4, "City", 5, 37.0, -76.3, ""), ("MEX", None, "México", 8, "Country", 0, 23.0, -102.0, ""),
]
PLACES = [
    "Roanoke, Virginia, USA", "Roannke, Va", "Springfield, Iowa", "Cromwell, Adams County, Iowa", "nowhere, USA", "Utopia", "Springfield, Florida", "USA, Iowa", "a church in the village",
    "Hampton Hampton City Virginia USA", "qqq", "", "NULL, Cameron, Iowa", "Cameron, Adams, Iowa", "illegible", "Roanoke Depot, Virginia, XX",
]


@pytest.fixture(scope="module")
def matched(spark):
    authority = spark.createDataFrame(ROWS, AUTHORITY)
    aliases = spark.createDataFrame([("the village", "", "VIL"), ("Roanoke Depot, Virginia, XX", "", "ROA")], "raw string, value string, uuid string")
    stop = spark.createDataFrame([("illegible",)], "key string")
    places = spark.createDataFrame([(i, p, f"g{i}", str(i)) for i, p in enumerate(PLACES)], "row_id long, place string, guid string, frequency string")
    m = P.match(places, P.Sources(authority, aliases, stop=stop))
    return m, authority, {r.original: r for r in m.results.collect()}


@pytest.mark.parametrize(
    "place,kind,ids",
    [
        ("Roanoke, Virginia, USA", "chain_verified", ["ROA"]), ("Roannke, Va", "chain_verified", ["ROA"]), ("Springfield, Iowa", "chain_amb", ["SPB", "SPA"]),
        ("Cromwell, Adams County, Iowa", "chain_verified_proximity", ["CRO"]), ("nowhere, USA", "parent_resolved", ["USA"]), ("Utopia", "no_auth_match", []),
        ("Springfield, Florida", "parent_rejected", ["FL"]), ("USA, Iowa", "chain_verified", ["IA"]), ("a church in the village", "low_evidence", ["VIL"]),
        ("Hampton Hampton City Virginia USA", "chain_verified", ["HAM"]), ("qqq", "no_auth_match", []), ("", "no_terms", []), ("NULL, Cameron, Iowa", "chain_verified", ["CAK"]),
        ("Cameron, Adams, Iowa", "chain_verified", ["CAC"]), ("illegible", "illegible", []), ("Roanoke Depot, Virginia, XX", "mnt_full_string", ["ROA"]),
    ],
)
def test_outcomes(matched, place, kind, ids):
    r = matched[2][place]
    assert (r.match_type, list(r.candidate_ids)) == (kind, ids)


def test_columns_of_an_answer(matched):
    r = matched[2]["Cromwell, Adams County, Iowa"]
    assert (r.authority_id, r.level, r.match_depth, r.confidence, r.resolution_kind) == ("CRO", 4, 3, "medium", "resolved")
    assert "proximity: 34km, actual: Union County" in r.skipped_terms
    tie = matched[2]["Springfield, Iowa"]
    assert (tie.authority_id, tie.resolution_kind, tie.matched_uuid) == ("", "tie", "SPB")
    assert len(matched[0].results.columns) == 25


def test_provenance_ties_defects_and_json(matched):
    m, authority, _ = matched
    levels = [(r.level, r.raw_term, r.match_method, r.origin) for r in M.level_provenance(m.decided, authority, m.chain).where("guid = 'g1'").orderBy("depth_from_leaf").collect()]
    assert levels == [(4, "Roannke", "fuzzy", "spelling"), (6, "Va", "normalized", "abbrev"), (8, "", "inferred", "")]
    assert [r.authority_id for r in M.ties(m.results, authority).collect()] == ["SPB", "SPA"]
    entry = json.loads(P.levels_json(m.results, M.level_provenance(m.decided, authority, m.chain)).where("row_id = 0").first().entry)
    assert list(entry["levels"]) == ["4", "6", "8"] and entry["levels"]["4"]["uuid"] == "ROA" and entry["matched_below"] is None
    assert M.defects(m.decided, authority).columns == ["term", "uuid", "auth_name", "jurisdiction", "rows"]
    assert "match: chain_verified" in P.readable(m.results).where("row_id = 0").first().block


def test_ranking_rules():
    c = lambda u, jur="City", **k: {"uuid": u, "jur": jur, "level": 4, "pop": 0, "hist": False, "toks": ["x"], "anc": [], "origin": "exact", "freq": 0} | k
    term = lambda *cands, t="X": {"term": t, "toks": [t.lower()], "cands": list(cands)}
    both = [c("A"), c("B", "Township")]
    assert [x[4] for x in fold.ranked(both, term(*both), None, False)] == ["A"]
    assert len(fold.ranked(both, term(*both, t="X Township"), None, False)) == 2
    mixed = [c("A", "County"), c("B", origin="spelling"), c("C", "County", origin="spelling")]
    assert [x[4] for x in fold.ranked(mixed, term(*mixed), None, False)] == ["A", "B"]
    assert fold.ranked([c("A", level=6, pop=300000)], term(), 8, False)[0][:4] == (0, 0, 2, -300000)
    twins = fold.ranked([c("A", pop=5), c("B", pop=9)], term(), None, False)
    assert fold.tied(twins) == ["B", "A"]
    for pair, winner in (((100, 4), "A"), ((40, 20), None), ((9, 1), None), ((500, 0), "A"), ((9, 0), None)):
        assert fold.frequent([c("A", freq=pair[0]), c("B", freq=pair[1])], ["A", "B"]) == winner
    assert fold.contains(["pinellas", "park"], ["pinellas"]) and not fold.contains(["pinellas"], ["pinellas"])


def test_readers_and_writers(spark, tmp_path):
    f = tmp_path / "in.tsv"
    f.write_text("﻿# note\nplace\tguid\n#4 Mine, Pennsylvania\tg1\nUtah\t\n", encoding="utf-8")
    rows = T.entries(T.read_commented_tsv(spark, str(f))).collect()
    assert {(r.place, r.guid, r.frequency) for r in rows} == {("#4 Mine, Pennsylvania", "g1", ""), ("Utah", "", "")}
    assert T.read_commented_tsv(spark, str(f), everywhere=True).count() == 1
    with pytest.raises(ValueError):
        T.entries(spark.createDataFrame([(1,)], "x int"))
    assert T.find_column(["GUID", "Place_ID"], "authority_id") == "Place_ID"
    old = spark.createDataFrame([("a", 1), ("b", 2)], "term string, rows int")
    new = spark.createDataFrame([("b", 5), ("c", 7)], "term string, rows int")
    assert [tuple(r) for r in T.upsert(old, new, ["term"]).collect()] == [("a", 1), ("b", 5), ("c", 7)]
    T.write_tsv(old, str(tmp_path / "out"))
    assert T.read_tsv(spark, str(tmp_path / "out")).count() == 2
    mapping = spark.createDataFrame([("a, b", "", "U1"), ("A,b", "", "U2"), ("c; d", "", "U1")], "raw string, value string, uuid string")
    assert [tuple(r) for r in T.whole_string_index(mapping).collect()] == [("c, d", "U1")]


def test_stream(spark, tmp_path):
    from gazetta.streaming import live

    spark.createDataFrame([("Ely,  UK",), ("x",)], "place string").write.parquet(str(tmp_path / "s"))
    index = spark.createDataFrame([("ely, uk", "E")], "key string, uuid string")
    stream = spark.readStream.schema("place string").parquet(str(tmp_path / "s"))
    q = live.whole_string_answers(stream, index).writeStream.format("memory").queryName("answers").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert {(r.place, r.authority_id) for r in spark.table("answers").collect()} == {("Ely,  UK", "E"), ("x", None)}


def test_segmentation_of_all_places(spark):
    """The log holds every place of one term and several words, of whatever style, and only those."""
    from gazetta import queries
    from gazetta.sources import derived as D

    d = "/root/testdata/sf0.001"
    places = {r.row_id: r.place for r in D.places(spark, d).collect()}
    looked_at = {i for i, p in places.items() if "," not in p and ";" not in p and len(p.split()) > 1}
    log = {r.row_id: r for r in queries.segmentation_log(spark, d).collect()}
    assert set(log) == looked_at and {i % 10 for i in log} > {5}
    regions = {r.r_name.lower() for r in D.table(spark, d, "region").collect()}
    for i, r in log.items():
        assert (r.decision == "accepted") == (r.reason == "")
        if i % 10 == 5:
            assert r.decision == "accepted" and r.segments.replace("|", " ") == places[i]
        elif i % 10 == 7:
            assert places[i] in regions and (r.decision, r.reason) == ("rejected", "whole_known")
        else:
            assert i % 10 == 8 and (r.decision, r.reason) == ("rejected", "stopword")


def test_equal_strings_and_many_homonyms(spark):
    """Each row keeps its own id, what is kept of an outcome does not grow with the records of a name, and reachability joins no term to them."""
    from gazetta.operators import hierarchy as H
    from gazetta.operators import metrics as E

    authority = spark.createDataFrame([*ROWS, *[(f"S{i:02}", "IA", "Springfield", 4, "City", i, 42.0, -93.0, "") for i in range(60)]], AUTHORITY)
    aliases = spark.createDataFrame([("x y z", "", "VIL")], "raw string, value string, uuid string")
    texts = ["Springfield, Iowa", "Springfield", "Springfield, Iowa", None, "Springfield, Iowa", None]
    m = P.match(spark.createDataFrame([(i, p, f"g{i}", str(i)) for i, p in enumerate(texts)], "row_id long, place string, guid string, frequency string"), P.Sources(authority, aliases))
    got = {r.row_id: r for r in m.results.collect()}
    assert [(got[i].guid, got[i].frequency, got[i].original) for i in range(6)] == [(f"g{i}", str(i), p) for i, p in enumerate(texts)]
    assert {got[i].match_type for i in (0, 2, 4)} == {"chain_amb"} and got[0].candidate_ids[0] == got[4].candidate_ids[0] == "S59"
    for r in m.decided.where("place IS NOT NULL").collect():
        assert sum(len(s.uuids) for s in r.m.steps) <= 2 and sum(len(t.cands) for t in r.r) <= 1
    rows = spark.createDataFrame([(1, "Springfield, Iowa", "S07"), (2, "Springfield", "S08"), (3, "Ely, Iowa", "S09"), (4, "Springfield", "none")], "row_id long, place string, truth string")
    reach = E.reachability(rows, authority, H.ancestors(authority))
    assert {r.row_id: r.reach for r in reach.collect()} == {1: "reachable", 2: "unsupported", 3: "absent", 4: "absent"}
    assert "explode" not in reach._jdf.queryExecution().toString()


def test_ties_are_whole_and_classes_stand_for_their_records(spark):
    """A tie has all its records, once for all rows that share it; neighbours are measured to each record of a class; candidates are classes."""
    towns = [(f"{p}{i:02}", county, "Dale", 4, "City", i % 7, 41.0 + i / 50, lon + i / 90, "") for p, county, lon in (("DA", "ADA", -94.7), ("DU", "UNI", -94.3)) for i in range(40)]
    authority = spark.createDataFrame([*ROWS, *towns], AUTHORITY)
    aliases = spark.createDataFrame([("x y z", "", "VIL"), ("dale gate", "", "DA07")], "raw string, value string, uuid string")
    texts = ["Dale, Iowa", "Dale", "Dale, Iowa", "Dale, Iowa, USA", "Dale; Dale, Iowa"]
    m = P.match(spark.createDataFrame([(i, p, f"g{i}", str(i)) for i, p in enumerate(texts)], "row_id long, place string, guid string, frequency string"), P.Sources(authority, aliases))
    every = [u for _, u in sorted((-t[5], t[0]) for t in towns)]
    got = m.tied(authority).collect()
    assert {r.row_id: r.tie for r in got} == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0}
    assert [r.authority_id for r in sorted((r for r in got if r.row_id == 0), key=lambda r: r["rank"])] == every
    assert [(r["rank"], r.authority_id) for r in got if r.row_id != 0] == [(None, None)] * 4
    results = {r.row_id: r for r in m.results.collect()}
    assert list(results[4].candidate_ids) == every[:5] and results[4].candidates == 5
    counties = {r[0]: {"plat": r[6], "plon": r[7], "name": r[2]} for r in ROWS}
    notes = []
    for t in sorted(towns):
        km = min(fold.haversine(counties[t[1]], {"lat": x[6], "lon": x[7]}, "plat", "plon") for x in towns)
        if km <= 50:
            notes.append(f"Dale County (proximity: {km:.0f}km, actual: {counties[t[1]]['name']} County)")
    assert results[4].skipped_terms == "; ".join(notes) and len(notes) == 80
    classes = M.classed(authority, T.alias_index(aliases)).where("name = 'Dale'").groupBy("rep").count().collect()
    assert sorted(tuple(r) for r in classes) == [("DA00", 39), ("DA07", 1), ("DU00", 40)]
