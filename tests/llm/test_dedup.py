"""Substring, line and near-duplicate operators against brute force, and their edge cases."""

import difflib
import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from gazetta.llm import components, lines, simhash, substring

DOCS = "doc_id long, text string"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def rng():
    return random.Random(3)


def brute_fingerprint(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    sh = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, radius=3):
    up = list(range(len(fps)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                up[b] = a
    return [find(i) for i in range(len(fps))]


def test_fingerprint_against_definition(rng):
    texts = ["", " \t\n", "One", "one TWO", "a b a b a b a b", "é È x", words(rng, 50), words(rng, 6000)]
    assert [simhash.fingerprint(t) for t in texts] == [brute_fingerprint(t) for t in texts]
    assert simhash.fingerprint(None) == 0


def test_near_duplicates_against_brute_force(spark, rng):
    base = [words(rng, 60) for _ in range(25)]
    texts = base + [t + " tail" for t in base[:12]] + [base[0]] * 30 + ["", None, "  ", "x"]
    texts += [base[3].replace(" ", "  ").upper(), words(rng, 20000)]
    ids = list(range(100, 100 + len(texts)))
    rng.shuffle(ids)
    rows = [*zip(ids, texts), (ids[0], texts[0])]
    got = simhash.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    fps = [brute_fingerprint(t) for _, t in rows]
    comp = brute_components(fps)
    least = {}
    for c, (i, _) in zip(comp, rows):
        least[c] = min(least.get(c, i), i)
    want = sorted((i, f"{f:016x}", least[c]) for (i, _), f, c in zip(rows, fps, comp))
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == want


def test_links_of_dense_and_chained_fingerprints(spark, rng):
    """A ball of thousands in one bucket, split in pieces, and a chain whose ends are far apart."""
    centre = rng.getrandbits(64)
    ball = {centre ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)}
    chain = [rng.getrandbits(64)]
    for step in range(20):
        chain.append(chain[-1] ^ (0b111 << 3 * step))
    lone = [rng.getrandbits(64) for _ in range(50)]
    fps = sorted(ball | set(chain) | set(lone))
    rows = [(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(fps)]
    nodes = spark.createDataFrame(rows, "node long, fp long")
    found = {r.node: r.component for r in components.connected_components(components.hamming_links(nodes, 3, len(fps))).collect()}
    want = brute_components(fps)
    assert [found.get(i, i) for i in range(len(fps))] == want


@pytest.mark.parametrize("radius,n", [(3, 10), (3, 10**8), (3, 10**11), (1, 1000)])
def test_blocks_leave_some_choice_equal(rng, radius, n):
    keys = components.block_keys(radius, components.block_count(n, radius))
    for _ in range(200):
        flips = sum(1 << b for b in rng.sample(range(64), radius))
        assert any(flips & mask == 0 for _, mask in keys)


def test_keep_one(spark, rng):
    a, b = words(rng, 40), words(rng, 40)
    df = spark.createDataFrame([(3, a, "x"), (1, a, "y"), (2, b, "z"), (2, b, "z"), (None, a, "n"), (7, None, "e"), (8, "", "e")], DOCS + ", fp string")
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0, r.fp) for r in kept.collect()) == [(0, "n"), (1, "y"), (2, "z"), (7, "e")]


def test_empty_tables(spark):
    df = spark.createDataFrame([], DOCS)
    assert simhash.near_duplicates(df).count() == 0
    assert substring.dedup_substrings(df).count() == 0
    assert lines.dedup_lines(df).count() == 0


def brute_spans(texts, run=substring.RUN):
    """Repeated byte spans by document, from the chunks alone."""
    parts, first = {}, {}
    for i, t in sorted(texts.items()):
        raw = t.encode()
        (ends,) = substring.cuts(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        at = 0
        parts[i] = []
        for e in ends:
            again = raw[at:e] in first
            first.setdefault(raw[at:e], i)
            parts[i].append((at, e, again))
            at = e
    out = {}
    for i, row in parts.items():
        spans = []
        for s, e, again in row:
            if again and spans and spans[-1][1] == s:
                spans[-1][1] = e
            elif again:
                spans.append([s, e])
        spans = [tuple(x) for x in spans if x[1] - x[0] >= run]
        if spans:
            out[i] = spans
    return out


def test_substrings_against_brute_force(spark, rng):
    passage = words(rng, 70)
    texts = {i: words(rng, 120) for i in range(12)}
    texts[3] += " " + passage + " " + words(rng, 30)
    texts[5] = words(rng, 17) + " é " + passage + " " + texts[5]
    texts[7] = texts[6]
    texts[8] = passage + " " + passage
    texts[9] = "ü" * 3000
    texts[10] = "ü" * 3000
    df = spark.createDataFrame([*texts.items(), (50, None), (51, ""), (None, passage)], DOCS)
    out = {r.doc_id: r for r in substring.dedup_substrings(df).collect()}
    assert len(out) == len(texts) + 3
    want = brute_spans(texts)
    assert {i: [(s.at, s.end) for s in r.removed_spans] for i, r in out.items() if r.removed_spans} == want
    for i, t in texts.items():
        raw, left, at = t.encode(), b"", 0
        for s, e in want.get(i, []):
            left += raw[at:s]
            at = e
        assert out[i].text == (left + raw[at:]).decode()
    assert out[50].text is None and out[51].text == "" and out[None].text == passage
    assert {5, 7, 8} <= set(want) and 3 not in want and 0 not in want
    assert out[7].removed_spans[0].first == [6] and out[7].text == ""
    assert passage not in out[5].text and passage in out[3].text


def test_substrings_of_repeated_rows(spark):
    """A row that repeats id and text loses the same runs as a single one, each byte counted once."""
    own = random.Random(11)
    passage = words(own, 70)
    texts = {1: words(own, 40) + " " + passage, 2: words(own, 30) + " " + passage + " " + words(own, 30)}
    want = brute_spans(texts)[2]
    assert len(want) == 1
    (raw,) = [texts[2].encode()]
    assert sum(want[0][0] < e < want[0][1] for e in substring.cuts(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0]) >= 3
    df = spark.createDataFrame([(1, texts[1]), (2, texts[2]), (2, texts[2])], DOCS)
    out = [r for r in substring.dedup_substrings(df).collect() if r.doc_id == 2]
    assert [[(s.at, s.end) for s in r.removed_spans or []] for r in out] == [want, want]


def test_chunks_resist_insertions(rng):
    text = words(rng, 400)
    ends = lambda t: substring.cuts(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0]

    def pieces(t):
        at, out = 0, []
        for e in ends(t):
            out.append(t.encode()[at:e])
            at = e
        assert b"".join(out) == t.encode()
        return out

    a, b = pieces(text), pieces("some new words " + text)
    assert len(set(a) & set(b)) >= len(set(a)) - 4
    assert max(map(len, pieces("x" * 5000))) <= substring.MAX


def brute_lines(texts, min_words=lines.MIN_WORDS):
    """Normalised lines by a slow path: (doc, line) to text."""
    out = {}
    for i, t in texts.items():
        for n, line in enumerate((t or "").split("\n")):
            low = "".join(c.lower() if c.isascii() or "À" <= c <= "Þ" and c != "×" else c for c in line)
            norm = " ".join("".join(c if not c.isascii() or c.isalpha() else " " for c in low).split())
            if len(norm.split(" ")) >= min_words and norm:
                out[i, n] = norm
    return out


def word_fingerprint(norm):
    data = np.frombuffer(norm.encode(), np.uint8)
    _, fp = lines.line_hashes(data, np.array([0]), np.array([len(data)]))
    return int(fp[0])


def test_normalised_lines(spark):
    texts = {1: "The  Cat, sat!\n\nÉtude No. 5 Für Elise\nthe cat sat", 2: "", 3: "\n", 4: "last line of it"}
    raw = [t.encode() for t in texts.values()]
    data, lo, hi, rows = lines.normalised(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    got = [bytes(data[a:b]).decode() for a, b in zip(lo, hi)]
    assert got == ["the cat sat", "", "étude no für elise", "the cat sat", "", "", "", "last line of it"]
    assert rows.tolist() == [0, 0, 0, 0, 1, 2, 2, 3]


def test_edit_distance(rng):
    for _ in range(300):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(0, 30)))
        b = "".join(rng.choice("abc") for _ in range(rng.randint(0, 30)))
        d = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            prev, d[0] = d[0], i
            for j, y in enumerate(b, 1):
                prev, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, prev + (x != y))
        assert lines.edit_distance(a, b, 99) == d[-1] or not (a and b) and lines.edit_distance(a, b, 99) == d[-1]
        for most in (0, 2, 5):
            assert (lines.edit_distance(a, b, most) <= most) == (d[-1] <= most)


def test_similar_pairs_at_once(rng):
    """Many pairs compared together say what one pair says: all lengths around the words' ends, letters beyond ASCII, few and many edits."""
    text = ["", "a", "é" * 64]
    for size in (3, 20, 63, 64, 65, 127, 128, 129, 200, 400, 700):
        base = [rng.choice("abcdé字 ") for _ in range(size)]
        for share in (0, 0.02, 0.15, 0.2, 0.21, 0.4):
            other = list(base)
            for _ in range(int(share * size)):
                at = rng.randrange(len(other))
                other[at : at + 1] = rng.choice(([], ["x"], [other[at], "y"]))
            text.append("".join(other))
    a, b = (np.array(x) for x in zip(*[(i, j) for i in range(len(text)) for j in range(len(text))]))
    letters = lines.Letters(text)
    for least in (0.8, 0.5):
        want = [lines.similar(text[i], text[j], least) for i, j in zip(a, b)]
        assert letters.similar(a, b, least).tolist() == want and 0.03 < np.mean(want) < 0.9
    assert all(set(letters.fitting(i, np.arange(len(text)), 0.8).tolist()) >= {j for j in range(len(text)) if lines.similar(text[i], text[j])} for i in range(len(text)))


def test_line_dedup_against_brute_force(spark, rng):
    long = words(rng, 60)
    texts = {i: "\n".join(words(rng, 9) for _ in range(5)) for i in range(8)}
    shared = "This line, is SHARED by 3 documents"
    texts[1] += "\n" + shared
    texts[4] += "\n" + shared.upper() + "\nab cd\n" + long
    texts[5] += "\nab cd\n" + long.replace(long.split()[5], long.split()[5] + "q", 1) + "\n" + shared
    texts[6] += "\n" + long + " x"
    texts[7] = texts[2]
    df = spark.createDataFrame([*texts.items(), (20, None), (21, ""), (None, shared)], DOCS)
    out = {r.doc_id: r for r in lines.dedup_lines(df).collect()}
    norm = brute_lines(texts)
    places = sorted(norm)
    fps = [word_fingerprint(norm[p]) for p in places]
    up = list(range(len(places)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(places)):
        for j in range(i):
            a, b = norm[places[i]], norm[places[j]]
            if a == b or (fps[i] ^ fps[j]).bit_count() <= 3 and lines.similar(a, b):
                x, y = sorted((find(i), find(j)))
                up[y] = x
    want = {}
    for i, p in enumerate(places):
        if find(i) != i:
            want.setdefault(p[0], []).append((p[1], *places[find(i)]))
    got = {i: [tuple(x) for x in r.removed_lines] for i, r in out.items() if r.removed_lines}
    assert got == want
    assert shared in out[1].text and shared not in out[5].text and "ab cd" in out[5].text
    assert out[7].text == "" and out[20].text is None and out[None].text == shared
    assert len(out) == len(texts) + 3


def test_near_lines_are_found(spark):
    """Real lines of all lengths, each with a copy in which a letter or a word differs: nearly all copies go."""
    own = random.Random(5)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text <> ''").orderBy("doc_id").limit(400).collect()
    norm = sorted(set(brute_lines({r.doc_id: r.text for r in docs}).values()))
    norm = [x for x in norm if 25 <= len(x) <= 900]
    own.shuffle(norm)
    rows = []
    for i, x in enumerate(norm[:600]):
        w = x.split()
        if i % 2:
            at = own.randrange(len(x))
            y = x[:at] + "q" + x[at + 1 :]
        else:
            w[own.randrange(len(w))] = "zorblat"
            y = " ".join(w)
        if len(y.split()) >= lines.MIN_WORDS and x != y and lines.similar(x, y):
            rows += [(i, x), (10000 + i, y)]
    df = spark.createDataFrame(rows, DOCS)
    gone = {r.doc_id for r in lines.dedup_lines(df, radius=None).where("removed_lines IS NOT NULL").collect()}
    found = sum(i in gone for i, _ in rows if i >= 10000)
    print("near lines found", found, "of", len(rows) // 2)
    assert found >= 0.95 * len(rows) / 2


def test_similarity_is_that_of_lengths():
    assert lines.similar("abcdefghij", "abcdefghXX") and not lines.similar("abcdefghij", "abcdefgXXX")
    assert lines.similar("", "")
    assert difflib.SequenceMatcher(None, "a", "b").ratio() == 0 and not lines.similar("a", "b")
    assert hashlib.sha256(b"").hexdigest()


def test_keep_one_decides_by_row(spark):
    long = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(5, long, 1), (5, "quite other words that stand here for nothing at all but themselves", 2), (7, long, 3), (5, long, 4), (None, long, 5)]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, `a.b` int")).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted([(0, long), (5, long), (5, rows[1][1])])


def test_lines_of_one_changed_word_link(spark, rng):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("lang = 'en'").orderBy("doc_id").limit(60).collect()
    words = sorted({w for d in docs for w in d.text.split()})
    texts, n = [], 0
    for size in (8, 12, 20, 40, 80):
        for _ in range(30):
            line = [rng.choice(words) for _ in range(size)]
            other = list(line)
            other[rng.randrange(size)] = rng.choice(words)
            texts += [(2 * n, " ".join(line)), (2 * n + 1, " ".join(other))]
            n += 1
    near = {i // 2 for i, t in texts[::2] if lines.similar(t, texts[i + 1][1])}
    gone = {r.doc_id // 2 for r in lines.dedup_lines(spark.createDataFrame(texts, "doc_id long, text string"), radius=None).where("removed_lines IS NOT NULL").collect()}
    assert len(gone & near) >= 0.95 * len(near) and len(near) > 100


def test_names_that_clash_in_dedup(spark):
    text = "the same long line of words is here twice over\nand another line of other words"
    rows = [(1, text, 7, "x"), (1, text, 7, "x"), (2, text, 8, "y"), (3, None, 9, "z")]
    for names in ("doc_id long, text string, _id int, _body string", "doc_id long, text string, `a.b` int, Text string"):
        df = spark.createDataFrame(rows, names)
        for out, n in ((substring.dedup_substrings(df), 4), (lines.dedup_lines(df, radius=None), 4), (simhash.keep_one(df), 2)):
            assert out.columns[:4] == df.columns and out.count() == n


def test_large_groups_of_lines_by_brute_force(spark):
    """A group compared in pieces connects what comparing all its pairs would: copies of the head, a second family, loners."""
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6))
    first, second = [word() for _ in range(14)], [word() for _ in range(14)]
    text = []
    for i in range(760):
        base = list(first if i < 600 else second if i < 730 else [word() for _ in range(14)])
        base[int(rng.integers(14))] = word()
        text.append(" ".join(base))
    nodes = [7 * i - 2000 for i in range(len(text))]
    marks = lines.marks_of(text, None)
    up = list(range(len(text)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(text)):
        for j in lines.near(marks, i, np.arange(i + 1, len(text)), None).tolist():
            p, q = root(i), root(j)
            if p != q and lines.similar(text[i], text[j]):
                up[max(p, q)] = min(p, q)
    want = {nodes[i]: nodes[root(i)] for i in range(len(text))}
    for head in (nodes[0], nodes[650], nodes[740]):
        groups = spark.createDataFrame([(head, n) for n in nodes], "head long, node long")
        known = spark.createDataFrame(list(zip(nodes, text)), "node long, line string")
        links = lines.verified_links(groups, known, None, lines.SIMILARITY).collect()
        assert len(links) < 8 * len(text)
        got = {n: n for n in nodes}

        def top(x, got=got):
            while got[x] != x:
                x = got[x]
            return x

        for r in links:
            p, q = top(r.a), top(r.b)
            got[max(p, q)] = min(p, q)
        assert {n: top(n) for n in nodes} == want


def test_large_buckets_of_candidates(spark):
    """A bucket above the size compared at once connects the same rows."""
    rng = np.random.default_rng(6)
    base = [f"{x} words of a line that many documents repeat with few changes" for x in ("seven", "eleven", "twelve")]
    text = sorted(base[i % 3] + f" {chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(3 * lines.TOGETHER)) + ["".join(rng.choice(list("abcdef "), 60)) for _ in range(9)]
    marks = lines.marks_of(text, None).view(np.int64)
    t = pa.table({"bucket": [1] * len(text), "part": [-1] * len(text), "size": pa.array([len(x) for x in text], pa.int32()), **{c: np.ascontiguousarray(marks[:, i]) for i, c in enumerate(lines.SKETCH)}})
    a, b = lines.candidates(t, lines.SIMILARITY)
    m = marks.view(np.uint64)
    size = np.array([len(x) for x in text])
    pairs = [(i, j) for i in range(len(text)) for j in range(i) if lines.alike(m[i], m[j]) >= lines.SHARED and min(size[i], size[j]) >= 0.75 * max(size[i], size[j])]

    def parts(pairs):
        up = list(range(len(text)))
        for x, y in pairs:
            while up[x] != x:
                x = up[x]
            while up[y] != y:
                y = up[y]
            up[max(x, y)] = min(x, y)
        out = []
        for x in range(len(text)):
            while up[x] != x:
                x = up[x]
            out.append(x)
        return out

    assert len(a) < len(text) and parts(zip(a.tolist(), b.tolist())) == parts(pairs)


def test_hubs_are_in_all_parts_of_large_buckets(spark):
    """Each pair of a large bucket meets in some part, the least node is in all parts, and each row has one first part."""
    n = 3 * components.PIECE
    nodes = spark.range(n).select((F.col("id") - 7).alias("node"), F.lit(5).alias("key"), F.lit(2).alias("size"))
    t = components.by_keys(nodes, [F.col("key")], n, "size", hubs=True).toPandas()
    parts = [set(g["node"]) for _, g in t.groupby("part")]
    assert len(parts) > 2 and all(-7 in p for p in parts) and set.union(*parts) == set(range(-7, n - 7))
    firsts = t[t["role"] == components.FIRST]
    assert sorted(firsts["node"]) == list(range(-7, n - 7))
    met = {(a, b) for p in parts for a in list(range(-7, 20)) if a in p for b in p}
    assert len(met) == 27 * n
    few = spark.range(10).select(F.col("id").alias("node"), (F.col("id") % 2).alias("key"), F.lit(2).alias("size"))
    assert set(components.by_keys(few, [F.col("key")], 10, "size", hubs=True).toPandas()["part"]) == {-1}


def test_lines_of_many_near_copies(spark):
    """One family of lines that differ in a word, more than a bucket holds at once: only the first stays."""
    rng = random.Random(8)
    base = [words(rng, 1) for _ in range(24)]
    docs = []
    for i in range(3 * components.PIECE):
        own = list(base)
        own[i % 24] = f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}"
        docs.append((i, " ".join(own)))
    docs.append((len(docs), words(rng, 24)))
    out = {r.doc_id: r.text for r in lines.dedup_lines(spark.createDataFrame(docs, DOCS), radius=None).collect()}
    assert {i for i, x in out.items() if x} == {0, len(docs) - 1}


def test_distance_of_pairs_apart(monkeypatch):
    """Bounds and early ends change no decision; lines that share a passage and nothing else cost few steps."""
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcdefghij"), rng.integers(1, 9))) for _ in range(300)]
    say = lambda n: " ".join(rng.choice(words, n))
    shared = say(25)
    pairs = [(f"{say(30)} {shared}", f"{say(30)} {shared}") for _ in range(15)] + [(f"{shared} {say(30)}", f"{shared} {say(30)}") for _ in range(15)]
    for n in (3, 12, 60, 150):
        for edits in range(0, n // 2 + 2, max(1, n // 12)):
            v = say(n).split()
            w = list(v)
            for i in rng.integers(0, n, edits):
                w[i] = str(rng.choice(words))
            pairs += [(" ".join(v), " ".join(w)), (" ".join(v), " ".join(w[edits // 3 :]))]

    def distance(a, b):
        d = list(range(len(b) + 1))
        for i, x in enumerate(a):
            last, d[0] = d[0], i + 1
            for j, y in enumerate(b):
                last, d[j + 1] = d[j + 1], min(d[j] + 1, d[j + 1] + 1, last + (x != y))
        return d[-1]

    want = [distance(a, b) <= int(0.2 * max(len(a), len(b)) + 1e-9) for a, b in pairs]
    assert [lines.similar(a, b) for a, b in pairs] == want and 0.2 < np.mean(want) < 0.8
    assert lines.similar_pairs(pairs, 0.8).tolist() == want
    monkeypatch.setattr(lines, "FEW_PAIRS", 1)
    assert lines.similar_pairs(pairs, 0.8).tolist() == want
    looks, look = [], lines.hopeless
    monkeypatch.setattr(lines, "hopeless", lambda *x: looks.append(x[2] / (x[2] + x[4])) or look(*x))
    for a, b in pairs[:30]:
        looks.clear()
        assert not lines.similar(a, b) and max(looks) < 0.9


def test_packed_buckets_hold_every_row_once(spark):
    """Buckets of small slots come back whole from their bytes, large ones are named with their rows; against a plain count."""
    from collections import Counter

    rng = np.random.default_rng(5)
    rows = [(i, 100 + i % 7, *(int(x) for x in rng.integers(-(1 << 62), 1 << 62, 3)), *(int(x) for x in rng.integers(0, 40, 4) << 32 | rng.integers(0, 300, 4))) for i in range(3000)]
    names = ["node", "size", *lines.SKETCH, *lines.KEYS]
    classes = spark.createDataFrame(rows, "node long, size int, " + ", ".join(f"{c} long" for c in names[2:])).repartition(5)
    want = {}
    for r in rows:
        for i, k in enumerate(r[5:]):
            for band, x in ((2 * i, k >> 32), (2 * i + 1, k & 0xFFFFFFFF)):
                want.setdefault((band << 32) + x, set()).add(r[0])
    members, large = lines.large_buckets(classes, len(rows), 60)
    assert dict(large) == {b: len(x) for b, x in want.items() if len(x) > 60}
    held = members.where(F.col("bucket").isin([b for b, _ in large])).toPandas()
    assert {b: set(x) for b, x in held.groupby("bucket").node} == {b: x for b, x in want.items() if len(x) > 60}
    got = Counter()
    by_node = {r[0]: r for r in rows}
    for r in lines.packed_buckets(classes, len(rows), [b for b, _ in large]).toArrow().group_by("slot").aggregate([(c, "list") for c in ("key", "node", "size", "s0", "s1")]).to_pylist():
        t = lines.unpacked_buckets(pa.table({"slot": [r["slot"]] * len(r["key_list"]), **{c: r[f"{c}_list"] for c in ("key", "node", "size", "s0", "s1")}})).to_pandas()
        for _, x in t.groupby("bucket"):
            got[frozenset(x.node)] += 1
        assert all((s, a, b) == by_node[n][1:4] for n, s, a, b in zip(t.node, t["size"], t.s0, t.s1))
    assert got == Counter(frozenset(x) for x in want.values() if 1 < len(x) <= 60)


def test_letter_counts_never_refuse_a_close_pair():
    """The bound by numbers of letters keeps every pair within the distance and drops some that is not."""
    rng = np.random.default_rng(6)
    text = ["".join(rng.choice(list("abcdeé漢"), rng.integers(0, 30))) for _ in range(60)]
    a, b = (x.ravel() for x in np.meshgrid(np.arange(60), np.arange(60)))
    most = np.full(len(a), 6)
    kept = lines.Letters(text).possible(a, b, most)
    near = [i for i, (x, y) in enumerate(zip(a, b)) if lines.edit_distance(text[x], text[y], 6) <= 6]
    assert set(near) <= set(kept.tolist()) and len(kept) < len(a)
