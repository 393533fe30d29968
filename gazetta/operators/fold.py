"""The right-to-left fold of one string's terms, the ranking of what survives, and the decision: row by row, in Arrow batches.

Everything relational is done before: a string's terms come from right to left, each with its candidates, ordered by uuid,
and each candidate with its ancestors. A candidate is a class of records that differ in id, population, place and frequency
only (operators/matching.py), with its least id, its number and its first few; so the walk does not grow with the records
of a name. Only where neighbours are measured, all records' ids and places are asked for (Again). What is left is a walk with state, which as one column expression takes the
optimizer minutes; so the candidates go through Python here, once, in batches sorted by string.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import accumulate, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..functions import vocab as V

OUTCOME = "type string, depth int, ids array<string>, tied array<string>, skipped array<string>, notes array<string>, steps array<struct<term:string,uuids:array<string>,origins:array<string>>>"
#: All that a tie holds: its classes of records, by rank apart from population and id.
TIE = "array<struct<g:int,uuid:string>>"
#: The type of an outcome that only the single records of the classes can tell.
AGAIN = "again"
ANCHOR = "array<struct<term:string,cands:array<struct<uuid:string,origin:string>>>>"
HINTS = [(re.compile(p, re.I), label) for p, label in V.JURISDICTION_SUFFIXES]
APPELLATIVES, PREFERRED, FILTERED = set(V.APPELLATIVES), set(V.PREFERRED_JURISDICTIONS), set(V.FILTERED_JURISDICTIONS)


def haversine(a: dict, b: dict, lat: str, lon: str) -> float:
    """Kilometres from a's (lat, lon) fields to b's own place; infinite if one is missing."""
    if None in (a[lat], a[lon], b["lat"], b["lon"]):
        return math.inf
    p, q = math.radians(a[lat]), math.radians(b["lat"])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b["lon"] - a[lon]) / 2) ** 2
    return 2 * V.EARTH_KM * math.asin(min(1.0, math.sqrt(h)))


def members(c: dict) -> tuple[list[str], list, list]:
    """Ids, latitudes and longitudes of the records of a class."""
    if size(c) == 1:
        return [c["uuid"]], [c["lat"]], [c["lon"]]
    if not c.get("ids", None):
        raise Again
    return c["ids"], c["lats"], c["lons"]


class Nearest:
    """The records of some classes, to find the one nearest to a place."""

    def __init__(self, classes: list[dict]):
        self.rows = [(uuid, c["name"], lat, lon) for c in classes for uuid, lat, lon in zip(*members(c))]
        self.lat, self.lon = (np.radians(np.array([r[i] for r in self.rows], np.float64)) for i in (2, 3))
        self.seen: dict[tuple, tuple] = {}

    def to(self, c: dict) -> tuple[float, str, str]:
        """(kilometres, uuid, name) of the record nearest to the parent of c; the least uuid of equals."""
        key = (c["plat"], c["plon"])
        if key not in self.seen:
            rows = range(len(self.rows))
            if None not in key:
                p = math.radians(key[0])
                h = np.sin((self.lat - p) / 2) ** 2 + math.cos(p) * np.cos(self.lat) * np.sin((self.lon - math.radians(key[1])) / 2) ** 2
                km = 2 * V.EARTH_KM * np.arcsin(np.minimum(1.0, np.sqrt(h)))
                if not np.isnan(km).all():  # a millimetre more than rounding can make: haversine() decides
                    rows = np.flatnonzero(km <= np.nanmin(km) + 1e-6).tolist()
            self.seen[key] = min((haversine(c, {"lat": self.rows[i][2], "lon": self.rows[i][3]}, "plat", "plon"), *self.rows[i][:2]) for i in rows)
        return self.seen[key]


def describes(span: str) -> bool:
    words = [w for w in (x.strip(".,;:") for x in span.lower().split()) if w]
    return len(words[words[:1] != [] and words[0] in ("the", "a", "an") :]) == 1 and words[-1] in APPELLATIVES


def hint(term: str) -> str | None:
    return next((label for p, label in HINTS if p.search(term)), None)


def contains(long: list[str], short: list[str]) -> bool:
    """Whether `short` is a contiguous, proper part of `long`."""
    n = len(short)
    return 0 < n < len(long) and any(long[i : i + n] == short for i in range(len(long) - n + 1))


def under(cands: list[dict], targets: set[str]) -> list[dict]:
    return [c for c in cands if not targets.isdisjoint(c["anc"][: V.CHAIN_HOPS])]


class Lists:
    """A column of lists: offsets into one list of values. Null counts as empty."""

    def __init__(self, col: pa.Array):
        self.ends = [0, *accumulate(n or 0 for n in pc.list_value_length(col).to_pylist())]
        self.values = pc.list_flatten(col).to_pylist()

    def __getitem__(self, i: int) -> list:
        return self.values[self.ends[i] : self.ends[i + 1]]


class Candidate:
    """A row of columns, read as a dict of its fields: most candidates are looked at in one or two fields only."""

    __slots__ = ("cols", "i")

    def __init__(self, cols: dict, i: int):
        self.cols, self.i = cols, i

    def __getitem__(self, field: str):
        return self.cols[field][self.i]

    def get(self, field: str, default):
        return self[field] if field in self.cols.names else default


class Again(Exception):
    """The outcome depends on single records of a class, which are not at hand."""


def column(col: pa.Array) -> list | Lists:
    return Lists(col) if pa.types.is_list(col.type) or pa.types.is_large_list(col.type) else col.to_pylist()


class Columns(dict):
    """The fields of an array of structs, each read once it is asked for."""

    def __init__(self, c: pa.StructArray):
        super().__init__()
        self.c, self.names = c, {f.name for f in c.type}

    def __missing__(self, field: str) -> list | Lists:
        self[field] = out = column(pc.struct_field(self.c, field))
        return out


def whole(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Batches sorted by key, dealt anew so that no key's rows are cut."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(key)
        first = int(pc.index(k, k[-1]).as_py())
        if held and held[-1].column(key)[-1] == k[-1]:
            held.append(b)
            continue
        yield pa.Table.from_batches([*held, b.slice(0, first)])
        held = [b.slice(first)]
    if held:
        yield pa.Table.from_batches(held)


def strings_of(t: pa.Table) -> Iterator[tuple[int, list[dict]]]:
    """For each string of a table of whole ones, its first row and its terms with their candidates."""
    ids, places = t.column("row_id").to_pylist(), t.column("i").to_pylist()
    c = t.column("c").combine_chunks()
    cols = Columns(c)
    uuid = cols["uuid"]
    term, toks, n, first = (column(t.column(f).combine_chunks()) for f in ("term", "toks", "n", "first"))
    at = 0
    while at < len(ids):
        start, r = at, []
        while at < len(ids) and ids[at] == ids[start]:
            i = at
            while at < len(ids) and ids[at] == ids[start] and places[at] == places[i]:
                at += 1
            if places[i] is not None:
                r.append({"term": term[i], "toks": toks[i], "n": n[i], "first": first[i], "cands": [Candidate(cols, j) for j in range(i, at) if uuid[j] is not None]})
        yield start, r


def count(term: dict) -> int:
    """All candidates of a term, of which `cands` holds those that can connect."""
    return term.get("n", len(term["cands"]))


def first_level(cands: list[dict]) -> int | None:
    return next((c["level"] for c in cands if c["level"] is not None), None)


def pruned(cands: list[dict]) -> list[dict]:
    return [c for c in cands if c["jur"] not in FILTERED] if any(c["jur"] in PREFERRED for c in cands) else cands


def size(c: dict) -> int:
    return c.get("n", 1)


def ranked(cands: list[dict], term: dict, level: int | None, fragments: bool, container: bool = False, helper: tuple[str, int] | None = None) -> list[tuple]:
    """(weak, miss, gap, -population, uuid, class) of the first record of each class, best first. Exact and corrected candidates are pruned apart."""
    fuzzy = {c["uuid"] for c in term["cands"] if c["origin"] == "spelling"}
    if hint(term["term"]) is None and not container:
        cands = pruned([c for c in cands if c["uuid"] not in fuzzy]) + pruned([c for c in cands if c["uuid"] in fuzzy])
    out = []
    for c in cands:
        weak = c["uuid"] in fuzzy or c["hist"] or fragments and contains(c["toks"] or [], term["toks"])
        miss = max(1, 10 - helper[1]) if helper and helper[0] not in c["anc"][: V.SCOPE_HOPS] else 0
        top = first_members(c)[0]
        out.append((int(weak), miss, 0 if level is None else abs(level - (c["level"] or 0)), *top, c))
    return sorted(out, key=lambda x: x[:5])


def first_members(c: dict) -> list[tuple[int, str]]:
    """(-population, uuid) of the first records of a class, as many as an answer lists."""
    top = c.get("top", None)
    return [(-m["pop"], m["uuid"]) for m in top] if top else [(-c["pop"], c["uuid"])]


def listed(scores: list[tuple]) -> list[str]:
    """The first records of ranked classes, as many as an answer lists."""
    return [m[4] for m in sorted((*x[:3], *m) for x in scores for m in first_members(x[5]))[: V.MAX_CANDIDATES]]


def equals(scores: list[tuple]) -> list[tuple]:
    """The classes that only the population sets apart from the first; none if it stands alone."""
    same = [x for x in scores if x[:3] == scores[0][:3]]
    return same if sum(size(x[5]) for x in same) > 1 else []


def tied(scores: list[tuple]) -> list[str]:
    """The first of those that only the population sets apart from the first; none if it stands alone."""
    return listed(equals(scores))


def most_frequent(cands: list[dict], ids: list[str]) -> dict | None:
    """The class of the record that is far more frequent than all others of the classes ids."""
    own = [c for c in cands if c["uuid"] in ids]
    seen = sorted((-c["freq"], i) for i, c in enumerate(own))
    second = max([-f for f, _ in seen[1:]] + [c.get("freq2", 0) or 0 for c in own], default=0)
    if sum(map(size, own)) > 1 and -seen[0][0] >= V.FREQUENCY_LEAST and -seen[0][0] >= V.FREQUENCY_RATIO * second:
        return own[seen[0][1]]
    return None


def who(c: dict) -> str:
    """The most frequent record of a class."""
    return c.get("who", None) or c["uuid"]


def frequent(cands: list[dict], ids: list[str]) -> str | None:
    c = most_frequent(cands, ids)
    return None if c is None else who(c)


def vague(term: dict, uuid: str) -> bool:
    """Whether what reached the record is a word for a kind of place."""
    span = next((c["span"] for c in term["cands"] if c["uuid"] == uuid), None)
    return describes(span or term["term"])


def step(term: dict, uuids: set[str] | None = None) -> dict:
    cands = [c for c in term["cands"] if uuids is None or c["uuid"] in uuids]
    return {"term": term["term"], "uuids": [c["uuid"] for c in cands], "origins": [c["origin"] for c in cands]}


def outcome(kind: str, depth: int, ids=(), tied=(), skipped=(), notes=(), steps=(), rep=None, tie=()) -> dict:
    """rep: the class of the best record. tied: the first few of a tie, as an answer lists them; tie: the ranked classes of all."""
    groups = {g: i for i, g in enumerate(dict.fromkeys(x[:3] for x in tie))}
    return {"type": kind, "depth": depth, "ids": list(ids), "tied": list(tied), "skipped": list(skipped), "notes": list(notes), "steps": list(steps), "rep": rep, "tie": [{"g": groups[x[:3]], "uuid": x[5]["uuid"]} for x in tie]}


def one_term(t: dict, helper: tuple[str, int] | None) -> dict:
    scores, steps = ranked(t["cands"], t, None, False, helper=helper), [step(t)]
    first, alone = scores[0][5], not equals(scores)
    winner = first if alone else most_frequent(t["cands"], {x[5]["uuid"] for x in scores})
    if winner is None:
        return outcome("single_amb", 1, tied=listed(scores), steps=steps, rep=first["uuid"], tie=scores)
    if vague(t, winner["uuid"]):
        return outcome("low_evidence", 1, tied=listed(scores), steps=steps, rep=first["uuid"])
    return outcome("single_term" if alone else "freq_resolved", 1, ids=[scores[0][4] if alone else who(winner)], steps=steps, rep=winner["uuid"])


class Walk:
    """State of the fold: what is confirmed, by which term, and what was skipped."""

    def __init__(self, r: list[dict]):
        self.r, self.confirmed, self.depth, self.level = r, r[0]["cands"], 1, None
        self.skipped: list[int] = []
        self.open: list[int] = []
        self.steps, self.notes, self.near = [step(r[0])], [], False
        self.start = r[0]["first"] if "first" in r[0] else first_level(r[0]["cands"])
        for i in range(1, len(r)):
            self.take(i)

    def take(self, i: int) -> None:
        t = self.r[i]
        repeats = i < len(self.r) - 1 and t["term"].lower() == self.r[i - 1]["term"].lower()
        good = [] if repeats else under(t["cands"], {c["uuid"] for c in self.confirmed})
        if good:
            self.level, self.confirmed, self.depth = self.now(), good, self.depth + 1
            self.steps.append(step(t, {c["uuid"] for c in good}))
            return
        self.skipped.append(i)
        if count(t) and not repeats:
            self.open.append(i)

    def now(self) -> int | None:
        """The level of what is confirmed so far."""
        return self.start if self.depth == 1 else first_level(self.confirmed)

    def recover(self) -> None:
        """A skipped term under the confirmed records' parents and near them: a neighbouring county was written."""
        parents = {c["parent"] for c in self.confirmed if c["parent"]}
        if not self.open or not parents or self.depth < 2 and count(self.r[0]) > 1:
            return
        found, near = [], None
        for i in self.open:
            notes = []
            for c in under(self.r[i]["cands"], parents):
                if c["pname"] is None:
                    continue
                near = near or Nearest(self.confirmed)
                km, _, name = near.to(c)
                if km <= V.PROXIMITY_KM:
                    found.append((99 if c["level"] is None else c["level"], i, c))
                    notes += zip(members(c)[0], repeat(f"{name} County (proximity: {km:.0f}km, actual: {c['pname']} County)"))
            self.notes += [x for _, x in sorted(notes)]
        if not found:
            return
        lowest, hit = min(x[0] for x in found), {i for _, i, _ in found}
        chosen = {c["uuid"]: c for level, _, c in reversed(found) if level == lowest}
        self.level, self.near, self.depth = self.now(), True, self.depth + 1
        self.confirmed = [chosen[u] for u in sorted(chosen)]
        self.skipped = [i for i in self.skipped if i not in hit]
        self.steps += [step(self.r[i], {c["uuid"] for level, j, c in found if j == i and level == lowest}) for i in sorted(hit) if any(j == i and level == lowest for level, j, _ in found)]

    def result(self) -> tuple[dict, bool]:
        """The outcome, and whether a skipped term had candidates of its own."""
        self.recover()
        words = [self.r[i]["term"] for i in self.skipped]
        if self.depth == 1:
            scores = ranked(self.confirmed, self.r[0], None, True)
            return outcome("parent_only", 1, skipped=words, steps=self.steps) | {"scores": scores if equals(scores) else scores[:1]}, bool(self.open)
        last = len(self.r) - 1
        left = next((i for i in range(last, 0, -1) if self.r[i]["term"] not in words), last)
        scores = ranked(self.confirmed, self.r[left], self.level, True, left < last and (self.level or 0) >= V.CONTAINER_LEVEL)
        more = {"skipped": words, "notes": self.notes, "steps": self.steps}
        rep = next((x[5]["uuid"] for x in scores), None)
        if ties := equals(scores):
            return outcome("chain_amb", self.depth, tied=listed(ties), rep=rep, tie=ties, **more), False
        return outcome("chain_verified_proximity" if self.near else "chain_verified", self.depth, ids=[x[4] for x in scores[:1]], rep=rep, **more), False


def walked(r: list[dict], helper: tuple[str, int] | None) -> tuple[dict, bool]:
    if not r:
        return outcome("no_terms", 0), False
    if not count(r[0]):
        return outcome("no_auth_match", 0), False
    return (one_term(r[0], helper), False) if len(r) == 1 else Walk(r).result()


def judged(m: dict, t: dict, dropped: bool) -> dict:
    """A lone anchor: resolved, suspect if a dropped term had candidates of its own, vague, or a tie."""
    scores = m["scores"]
    first, only = scores[0][5], not equals(scores)
    winner = first if only else most_frequent(t["cands"], {x[5]["uuid"] for x in scores})
    kept = {"skipped": m["skipped"], "steps": m["steps"]}
    if winner is None:
        return outcome("parent_amb", m["depth"], tied=listed(scores), rep=first["uuid"], tie=scores, **kept)
    found = {"ids": [scores[0][4] if only else who(winner)], "rep": winner["uuid"]}
    if dropped:
        return outcome("parent_rejected", m["depth"], **found, **kept)
    if vague(t, winner["uuid"]):
        return outcome("low_evidence", m["depth"], tied=listed(scores), rep=first["uuid"], **kept)
    return outcome("parent_resolved" if only else "freq_resolved", m["depth"], **found, **kept)


def decide(r: list[dict], fs: str | None, junk: bool, n_terms: int, helper: tuple[str, int] | None = None) -> dict:
    """The outcome of one string: the whole string, the fold, the fold of the reverse, the lone anchor, in this order."""
    if fs is not None:
        return outcome("mnt_full_string", n_terms, ids=[fs])
    m, dropped = walked(r, helper)
    if m["type"] == "no_auth_match" and junk:
        return outcome("illegible", 0)
    if m["type"] == "parent_only":
        if m["skipped"]:
            again, _ = walked(r[::-1], helper)
            if again["type"].startswith("chain_verified"):
                return again
        if m["scores"]:
            return judged(m, r[0], dropped)
    return m


def kept(r: list[dict], m: dict) -> list[dict]:
    """The anchor with the best record, as defects need it. The steps of m keep the best record's chain, as provenance needs it.

    So an outcome's size does not depend on how many records share a name.
    """
    best, rep = next(iter(m["ids"] or m["tied"]), None), m["rep"]
    own = next((c for t in r for c in t["cands"] if c["uuid"] == rep), None) if m["steps"] and rep is not None else None
    chain = {rep, *(own["anc"][: V.SCOPE_HOPS - 1] if own else ())}
    for s in m["steps"]:
        pairs = [(best if u == rep else u, o) for u, o in zip(s["uuids"], s["origins"]) if u in chain]
        s["uuids"], s["origins"] = [u for u, _ in pairs], [o for _, o in pairs]
    return [{"term": t["term"], "cands": [{"uuid": best, "origin": c["origin"]} for c in t["cands"] if c["uuid"] == rep]} for t in r[:1]]


def decided(strings: DataFrame, cands: DataFrame, stop: DataFrame | None = None, helper: tuple[str, int] | None = None) -> DataFrame:
    """strings (row_id, place, terms, fs, others) with the outcome m, r, the anchor with the best record, and the classes of a tie. cands: as of matching.with_candidates()."""
    facts = strings.select("row_id", "fs", F.size("terms").alias("n_terms"))
    if stop is None:
        facts = facts.withColumn("junk", F.lit(False))
    else:
        known = stop.select(F.col("key").alias("k"), F.lit(1).alias("s")).distinct()
        words = strings.select("row_id", F.explode("terms").alias("t")).join(known, F.lower("t") == F.col("k"), "left")
        facts = facts.join(words.groupBy("row_id").agg((F.min(F.coalesce("s", F.lit(0))) == 1).alias("junk")), "row_id", "left").withColumn("junk", F.coalesce("junk", F.lit(False)))
    rows = facts.join(cands, "row_id", "left").repartition("row_id").sortWithinPartitions("row_id", "i", "c.uuid")
    schema = StructType([rows.schema["row_id"], *StructType.fromDDL(f"r {ANCHOR}").fields, StructField("m", StructType.fromDDL(OUTCOME)), *StructType.fromDDL(f"tie {TIE}").fields])
    kind = pa.struct([("type", pa.string()), ("depth", pa.int32()), *[(c, pa.list_(pa.string())) for c in ("ids", "tied", "skipped", "notes")], ("steps", pa.list_(pa.struct([("term", pa.string()), ("uuids", pa.list_(pa.string())), ("origins", pa.list_(pa.string()))])))])
    anchor = pa.list_(pa.struct([("term", pa.string()), ("cands", pa.list_(pa.struct([("uuid", pa.string()), ("origin", pa.string())])))]))

    sets = pa.list_(pa.struct([("g", pa.int32()), ("uuid", pa.string())]))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole(batches, "row_id"):
            fs, junk, n = (t.column(c).to_pylist() for c in ("fs", "junk", "n_terms"))
            at, top, out = [], [], []
            for s, r in strings_of(t):
                try:
                    m = decide(r, fs[s], junk[s], n[s], helper)
                except Again:
                    m = outcome(AGAIN, 0)
                at.append(s)
                top.append(kept(r, m))
                out.append(m)
            ids = t.column("row_id").combine_chunks().take(pa.array(at, pa.int64()))
            ties = [m["tie"] for m in out]
            yield pa.RecordBatch.from_arrays([ids, pa.array(top, anchor), pa.array([{f.name: m[f.name] for f in kind} for m in out], kind), pa.array(ties, sets)], names=schema.names)

    return strings.join(rows.mapInArrow(each, schema), "row_id")
