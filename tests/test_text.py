"""Text rules: golden examples."""

import pytest
from pyspark.sql import functions as F

from gazetta.functions import text as X
from gazetta.operators import candidates as C
from gazetta.operators import segment as S


@pytest.fixture(scope="module")
def value(spark):
    def run(expr, *texts):
        names = [f"c{i}" for i in range(len(texts))]
        df = spark.createDataFrame([tuple(texts)], ", ".join(f"{n} string" for n in names))
        return df.select(expr(*[F.col(n) for n in names]).alias("v")).first()["v"]

    return run


@pytest.mark.parametrize("place,terms", [("Danville,VA ,  United States", ["Danville", "VA", "United States"]), ("Washington, D.C.", ["Washington D.C."]), (" ; ,", []), ("a;b", ["a", "b"])])
def test_terms(value, place, terms):
    assert list(value(X.split_terms, place)) == terms


def test_canonical_and_noise(value):
    assert value(X.canonical, "Danville,VA ,  United States") == "danville, va, united states"
    noise = lambda c: X.drop_noise(X.split_terms(c))
    assert list(value(noise, "Route 66, Utah, USA")) == ["Utah", "USA"]
    assert list(value(noise, "Route 66, RR 2")) == ["Route 66", "RR 2"]


@pytest.mark.parametrize("term,hint", [("Lawrence Twp.", "Township"), ("Mifflin Co.", "County"), ("County Line", None)])
def test_hint(value, term, hint):
    assert value(X.jurisdiction_hint, term) == hint


@pytest.mark.parametrize("term,cleaned,jurisdiction", [("near St. Charles", "Saint Charles", None), ("County of Essex", "Essex", "County"), ("Trevo(se)", "Trevose", None), ("Territory of Alaska", "Alaska", None), ("Utah", None, None), ("north of city of Ely area", "Ely", "City")])
def test_rewrite(value, term, cleaned, jurisdiction):
    r = value(X.rewrite, term)
    assert (r and r.cleaned, r and r.jurisdiction) == (cleaned, jurisdiction)


@pytest.mark.parametrize("term,variants", [("Saint Paul", ["St Paul"]), ("St. Paul", ["Saint Paul"]), ("DeKalb", ["De Kalb"]), ("De Kalb", ["DeKalb"]), ("Utah", [])])
def test_variants(value, term, variants):
    assert list(value(X.name_variants, term)) == variants


def test_prepositions(value):
    assert list(value(X.after_prepositions, "home of her daughter near Luana")) == ["Luana", "her daughter near Luana"]
    assert list(value(X.after_prepositions, "one mile north of Buffalo")) == ["Buffalo"]


@pytest.mark.parametrize("span,vague", [("the village", True), ("City", True), ("station", True), ("Grove City", False), ("Lake Village", False), ("", False)])
def test_descriptions(value, span, vague):
    assert value(X.is_description, span) == vague


@pytest.mark.parametrize("place,tags", [("Koolik, Koolik", ["adjacent", "doubled"]), ("Madison, route 6, Madison", ["restated"]), ("hospital, Nashville; Tenn.", ["joined"]), ("near Danville, Danville", ["embedded"]), ("a, b", [])])
def test_shapes(value, place, tags):
    assert list(value(X.shape_tags, place)) == tags


def test_corruption_and_folding(value):
    assert value(X.has_corruption, "near Vend+¦me, France") and not value(X.has_corruption, "Besançon")
    assert value(X.ascii_fold, "México Straße Ǆ") == "mexico strae dz"
    assert value(X.normalized_term, "St. Mary's (historical), Köln") == "st marys koln"


@pytest.mark.parametrize("a,b,near", [("birminghan", "birmingham", True), ("new yrok", "new york", True), ("abc", "abcd", True), ("abcd", "badc", False), ("same", "same", False)])
def test_one_edit(value, a, b, near):
    assert value(C.one_edit, a, b) == near


def test_segment_helpers(value):
    assert list(value(S.span_keys, "Hampton City")) == ["hampton city", "hampton"]
    assert value(S.without_trailing, "Hampton City") == "Hampton" and value(S.without_trailing, "City") is None
    assert value(S.is_jurisdiction, "Twp. County") and not value(S.is_jurisdiction, "Iowa")


def test_uuid_and_case(value):
    u = "0a1b2c3d-0000-1111-2222-333344445555"
    assert value(X.is_uuid, u) and value(X.looks_like_uuid, u) and not value(X.is_uuid, "C12")
    assert value(X.case_is_informative, "Lutheran church") and not value(X.case_is_informative, "UTAH 1")
    assert value(lambda c: X.index_keys(c), "Ely-on-Sea, UK") == ["ely-on-sea, uk", "ely on sea, uk", "ely-on-sea, uk"][:2]
