"""Text rules as column expressions: splitting, rewriting, tagging, measuring.

All of them run in the JVM. Patterns use (?U) where the meaning of \\s, \\w, \\b or \\d must cover all of Unicode.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab as V


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, which is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def any_case(pattern: str) -> str:
    return "(?iU)" + pattern


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def field(c: Column) -> Column:
    return F.coalesce(strip(c.cast("string")), F.lit(""))


def non_empty(parts: Column) -> Column:
    return F.filter(F.transform(parts, strip), lambda x: x != "")


def words(c: Column) -> Column:
    return F.filter(F.split(c, r"(?U)\s+"), lambda x: x != "")


def split_terms(place: Column) -> Column:
    """Terms between commas and semicolons, after names that hold a comma are joined."""
    whole = F.regexp_replace(place, any_case(V.COMPOUND[0]), V.COMPOUND[1])
    return non_empty(F.split(whole, "[,;]"))


def drop_noise(terms: Column) -> Column:
    """Without road numbers, unless nothing else is left."""
    kept = F.filter(terms, lambda t: ~t.rlike(any_case(V.NOISE)))
    return F.when(F.size(kept) == 0, terms).otherwise(kept)


def jurisdiction_hint(term: Column) -> Column:
    out = F.lit(None).cast("string")
    for pattern, label in reversed(V.JURISDICTION_SUFFIXES):
        out = F.when(term.rlike(any_case(pattern)), label).otherwise(out)
    return out


def canonical(place: Column) -> Column:
    return F.array_join(non_empty(F.split(F.lower(place), "[,;]")), ", ")


def tokens(c: Column) -> Column:
    """Distinct lower-case words of ASCII letters and digits."""
    return F.array_distinct(F.filter(F.split(F.regexp_replace(F.lower(c), "[^a-z0-9 ]", " "), " +"), lambda x: x != ""))


def _fold_table() -> tuple[str, str, list[tuple[str, str]]]:
    """Characters up to U+024F by what is left of them after decomposition: one letter, several, or none."""
    one_from, one_to, none, many = "", "", "", []
    for code in range(0x80, 0x250):
        c = chr(code)
        left = unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode()
        if len(left) == 1:
            one_from, one_to = one_from + c, one_to + left
        elif left:
            many.append((c, left))
        else:
            none += c
    return one_from + none, one_to, many


_FOLD = _fold_table()


def ascii_fold(c: Column) -> Column:
    """Lower-case ASCII: accents go, characters that do not decompose to ASCII vanish."""
    folded = F.translate(c, _FOLD[0], _FOLD[1])
    for a, b in _FOLD[2]:
        folded = F.replace(folded, F.lit(a), F.lit(b))
    return F.lower(F.regexp_replace(folded, r"[^\x00-\x7F]", ""))


def name_tokens(c: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(ascii_fold(F.coalesce(c, F.lit(""))), "[^a-z0-9]", " "), " +"), lambda x: x != "")


def spaced_hyphens(c: Column) -> Column:
    return F.replace(c, F.lit("-"), F.lit(" "))


def lookup_keys(c: Column) -> Column:
    """A name's keys in an index: lower case, and with spaces for hyphens."""
    return F.array_distinct(F.array(F.lower(c), spaced_hyphens(F.lower(c))))


def index_keys(raw: Column) -> Column:
    """Every key through which a raw string is reachable."""
    text = field(raw)
    whole = F.when(text.rlike("[,;]"), F.array(canonical(text))).otherwise(F.array().cast("array<string>"))
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(lookup_keys(text), whole)))


def place_guid(place: Column) -> Column:
    return F.concat(F.lit("mnt-"), F.substring(F.sha1(canonical(place).cast("binary")), 1, 12))


def first_change(c: Column, rules: list[tuple[str, str]]) -> Column:
    """c after the first pattern that occurs in it is replaced."""
    out = c
    for pattern, new in reversed(rules):
        out = F.when(c.rlike(any_case(pattern)), strip(F.regexp_replace(c, any_case(pattern), new))).otherwise(out)
    return out


def rewrite(term: Column) -> Column:
    """struct(cleaned, jurisdiction) of a term freed of prefixes, descriptors and suffixes; null if nothing changed."""
    led = reduce(lambda c, p: strip(F.regexp_replace(c, any_case(p), "")), V.LEADING_PHRASES, term)
    led = first_change(led, [(V.UNFILTERED_PREFIX, "")])

    def ahead(c: Column) -> Column:
        rules = [(rf"^{j.lower()}\s+of\s+", j) for j in V.JURISDICTION_PREFIXES]
        label = F.lit(None).cast("string")
        for pattern, j in reversed(rules):
            label = F.when(c.rlike(any_case(pattern)), j).otherwise(label)
        return F.struct(first_change(c, [(p, "") for p, _ in rules]).alias("c"), label.alias("j"))

    def behind(x: Column) -> Column:
        return F.struct(reduce(lambda c, p: strip(F.regexp_replace(c, any_case(p), "")), V.TRAILING_DESCRIPTORS, x["c"]).alias("c"), x["j"].alias("j"))

    def suffix(x: Column) -> Column:
        cut = first_change(x["c"], [(p, "") for p, _ in V.JURISDICTION_SUFFIXES])
        return F.struct(F.when(x["j"].isNull(), cut).otherwise(x["c"]).alias("c"), F.coalesce(x["j"], jurisdiction_hint(x["c"])).alias("j"))

    def expanded(x: Column) -> Column:
        c = first_change(x["c"], [(rf"^{short}\.\s*", f"{long} ") for long, short in V.PREFIX_SWAPS])
        return F.struct(F.regexp_replace(c, r"(?<!\s)\(([^)]*)\)", "$1").alias("cleaned"), x["j"].alias("jurisdiction"))

    done = let(let(let(let(led, ahead), behind), suffix), expanded)
    return let(done, lambda x: F.when((x["cleaned"] != "") & (F.lower(x["cleaned"]) != F.lower(term)), x))


def capital(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, F.lit(2), F.length(c)))


def name_variants(term: Column) -> Column:
    """Other spellings: long and short prefixes for each other, prefixes written apart or together."""
    low, out = F.lower(term), []
    for long, short in V.PREFIX_SWAPS:
        after = lambda n: F.substring(term, F.lit(n), F.length(term))
        bare = F.regexp_replace(F.regexp_replace(after(len(short) + 2), r"^\.", ""), r"(?U)^\s+", "")
        dotted = F.regexp_replace(after(len(short) + 3), r"(?U)^\s+", "")
        out.append(
            F.when(low.startswith(long.lower() + " "), F.concat(F.lit(short + " "), after(len(long) + 2)))
            .when(low.startswith(short.lower() + ". "), F.concat(F.lit(long + " "), F.regexp_replace(dotted, r"^\.", "")))
            .when(low.startswith(short.lower() + " "), F.concat(F.lit(long + " "), bare))
        )
    prefixes = "|".join(V.SPACING_PREFIXES)
    camel, flat, apart = rf"(?U)^({prefixes})([A-Z]\w+)$", rf"(?iU)^({prefixes})(\w{{3,}})$", rf"(?iU)^({prefixes})\s+(\w+)$"
    part = lambda p, i: F.regexp_extract(term, p, i)
    out.append(F.when(term.rlike(camel), F.concat_ws(" ", part(camel, 1), part(camel, 2))).when(term.rlike(flat), F.concat_ws(" ", part(flat, 1), capital(part(flat, 2)))))
    out.append(F.when(term.rlike(apart), F.concat(part(apart, 1), capital(part(apart, 2)))))
    return F.filter(F.array(*out), lambda x: x.isNotNull())


def bare(word: Column) -> Column:
    return F.regexp_replace(F.lower(word), r"[.,;:]+$", "")


def after_prepositions(term: Column) -> Column:
    """What follows a preposition of place anywhere in the term: the shortest first, each once ignoring case."""

    def found(w: Column) -> Column:
        rest = lambda k: F.array_join(F.slice(w, k, F.size(w)), " ")

        def at(x: Column, i: Column) -> Column:
            following, before = bare(F.get(w, i + 1)), bare(F.get(w, i - 1))
            text = (
                F.when(bare(x).isin(V.SPATIAL_PREPOSITIONS), rest(i + 2))
                .when(bare(x).isin(V.DIRECTIONS), F.when(following == "of", rest(i + 3)))
                .when((bare(x) == "of") & (i > 0), F.when(~before.isin(V.DIRECTIONS), rest(i + 2)))
            )
            return F.struct(F.length(text).alias("n"), i.alias("i"), text.alias("text"))

        ranked = F.array_sort(F.filter(F.transform(w, at), lambda x: x["n"] > 0))
        return F.transform(ranked, lambda x: x["text"])

    def once(c: Column) -> Column:
        return F.filter(c, lambda x, i: (i == 0) | ~F.array_contains(F.transform(F.slice(c, F.lit(1), i), F.lower), F.lower(x)))

    return let(let(words(term), found), once)


def without_cardinal(term: Column) -> Column:
    """Without its leading direction; null if there is none."""
    cut = strip(F.regexp_replace(term, any_case(V.CARDINAL_PREFIX), ""))
    return F.when((cut != "") & (F.lower(cut) != F.lower(term)), cut)


def expansions(term: Column, countries: bool = False) -> Column:
    """What an abbreviation stands for: none, one or several names."""
    table = {k: [v] for k, v in V.COUNTRIES.items()} if countries else {}
    table = V.ABBREVIATIONS | table
    pairs = [x for k, v in table.items() for x in (F.lit(k), F.array(*map(F.lit, v)))]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.regexp_replace(F.lower(term), r"\.+$", "")), F.array().cast("array<string>"))


def is_description(span: Column) -> Column:
    """True of one word for a kind of place, with or without an article: no name."""

    def test(w: Column) -> Column:
        body = F.when(F.get(w, F.lit(0)).isin("the", "a", "an"), F.slice(w, 2, 1000)).otherwise(w)
        return let(body, lambda b: (F.size(b) == 1) & F.coalesce(F.get(b, F.lit(0)).isin(V.APPELLATIVES), F.lit(False)))

    trimmed = F.filter(F.transform(words(F.lower(span)), lambda x: F.regexp_replace(x, r"^[.,;:]+|[.,;:]+$", "")), lambda x: x != "")
    return F.coalesce(let(trimmed, test), F.lit(False))


def case_is_informative(c: Column) -> Column:
    """Whether letters of both cases occur."""
    letters = F.regexp_replace(c, r"[^\p{L}]", "")
    return (letters != "") & ~letters.rlike(r"^\p{Lu}+$") & ~letters.rlike(r"^\p{Ll}+$")


def within(short: Column, long: Column, proper: bool = False) -> Column:
    """Whether one token list is a contiguous part of another."""
    room = F.size(long) > F.size(short) if proper else F.size(long) >= F.size(short)
    at = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(long) - F.size(short) + 1))
    return (F.size(short) > 0) & room & F.exists(at, lambda i: F.slice(long, i, F.size(short)) == short)


def has_corruption(c: Column) -> Column:
    return F.coalesce(c.rlike(V.CORRUPTION), F.lit(False))


def shape_tags(place: Column) -> Column:
    """How a string repeats itself: adjacent, doubled, embedded, joined, restated; sorted."""

    def tags(s: Column) -> Column:
        inside = lambda e, seg: F.regexp_like(e, F.concat(F.lit(r"(?U)\b\Q"), seg, F.lit(r"\E\b")))

        def about(seg: Column, i: Column) -> Column:
            earlier = F.slice(s, F.lit(1), i)
            each = F.transform(earlier, lambda e, j: F.when(e == seg, F.when(j == i - 1, "adjacent").otherwise("restated")).when(inside(e, seg), "embedded"))
            return F.when((i > 0) & (F.length(seg) >= 3), each).otherwise(F.array().cast("array<string>"))

        found = F.flatten(F.transform(s, about))
        doubled = F.when((F.size(s) == 2) & (F.get(s, F.lit(0)) == F.get(s, F.lit(1))), "doubled")
        joined = F.when(place.rlike("[;|]"), "joined")
        return F.array_sort(F.array_distinct(F.filter(F.concat(found, F.array(doubled, joined)), lambda x: x.isNotNull())))

    return let(non_empty(F.split(F.lower(F.coalesce(place, F.lit(""))), "[,;|]")), tags)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance; infinite if a coordinate is missing."""
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.coalesce(2 * V.EARTH_KM * F.asin(F.sqrt(h)), F.lit(float("inf")))


def without_marks(c: Column) -> Column:
    """Letters without their accents; letters that have none to lose stay."""
    bare = F.translate(c, _FOLD[0][: len(_FOLD[1])], _FOLD[1])
    for a, b in _FOLD[2]:
        bare = F.replace(bare, F.lit(a), F.lit(b))
    return F.regexp_replace(bare, r"\p{Mn}", "")


def normalized_term(c: Column) -> Column:
    """For comparing names: lower case, no accents, parentheses or apostrophes; other signs are spaces."""
    plain = F.regexp_replace(F.lower(without_marks(F.regexp_replace(c, r"\([^)]*\)", " "))), "['’]", "")
    return F.trim(F.regexp_replace(plain, r"[^\p{L}\p{N}]+", " "))


def shape_of(place: Column) -> Column:
    """Coarse kind of a place string, the first that fits."""
    s = normalized_term(place)
    return (
        F.when(s.rlike(r"\b(district|precinct|ward|beat|division|sec|magisterial|election|civil|ed)\b"), "enumeration district / precinct")
        .when(s.rlike(r"\b(township|twp|town|city|village|borough|parish)\b"), "jurisdiction suffix")
        .when(s.contains("part of") | s.contains("prt"), 'UK "(part of)"')
        .when(s.rlike(r"\b(church|cemetery|hospital|home|farm|school|street|creek|lake|hotel)\b"), "names a feature")
        .when(s.rlike(r"\bnull\b"), "contains NULL")
        .when((F.upper(place) == place) & (F.lower(place) != place), "all caps, no other marker")
        .otherwise("plain place string")
    )


def wilson(correct: Column, n: Column) -> Column:
    """struct(low, high): 95 % interval of a share."""
    z = 1.96
    p = correct / n
    d = 1 + z * z / n
    centre, half = (p + z * z / (2 * n)) / d, z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / d
    low = F.when(n > 0, F.greatest(F.lit(0.0), centre - half)).otherwise(0.0)
    high = F.when(n > 0, F.least(F.lit(1.0), centre + half)).otherwise(0.0)
    return F.struct(low.alias("low"), high.alias("high"))


def is_uuid(c: Column) -> Column:
    return F.coalesce(c.rlike("^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"), F.lit(False))


def looks_like_uuid(c: Column) -> Column:
    """The cheap test at load: length and two dashes."""
    return (F.length(c) == 36) & (F.substring(c, 9, 1) == "-") & (F.substring(c, 14, 1) == "-")


def literal_map(table: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
