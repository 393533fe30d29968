"""Byte-level BPE as Spark expressions: ranked merges folded over the bytes of distinct words, and decoding."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Packed, cut, drop_cut, table, with_fields

#: Most distinct words whose ids are kept in the plan as a literal, and most bytes that it takes, the frequent first; its bytes
#: for a word beside the letters.
KNOWN_WORDS, KNOWN_BYTES, ENTRY = 1 << 20, 64 << 20, 76
#: Bytes of a match from which it is not folded as a sequence.
LONG = 512

def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def hash_map(rows: DataFrame, key: str, value: str, buckets: int) -> DataFrame:
    """One row, one column: an array of maps from key to value, each key in the map that its hash names; buckets is a power of two.

    A map literal is searched key by key; this one takes a few comparisons. As a scalar subquery it is part of the plan.
    """
    spread = rows.groupBy(F.xxhash64(key).bitwiseAND(F.lit(buckets - 1)).alias("b")).agg(F.collect_list(F.struct(key, value)).alias("kv"))
    full = rows.sparkSession.range(buckets).select(F.col("id").alias("b")).join(spread, "b", "left")
    full = full.select("b", F.coalesce("kv", F.array().cast(spread.schema["kv"].dataType)).alias("kv"))
    order = F.array_sort(F.collect_list(F.struct("b", "kv")))
    return full.agg(F.transform(order, lambda x: F.map_from_entries(x["kv"])).alias("m"))


def look_up(maps: Column, key: Column, buckets: int) -> Column:
    return F.element_at(F.get(maps, F.xxhash64(key).bitwiseAND(F.lit(buckets - 1)).cast("int")), key)


def power_of_two(n: int) -> int:
    return 1 << max(0, n - 1).bit_length()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, which is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word by a heap of its pairs: n log n steps for n bytes, as an array fold would take n squared."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    end, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))

    def pair(i: int) -> None:
        if 0 <= i and (j := after[i]) < n and (r := ranks.get(word[i : end[j]])) is not None:
            heapq.heappush(heap, (r, i, end[j]))

    heap: list[tuple[int, int, int]] = []
    for i in range(n - 1):
        pair(i)
    gone = [False] * n
    while heap:
        _, i, stop = heapq.heappop(heap)
        if gone[i] or (j := after[i]) >= n or end[j] != stop:
            continue
        end[i], after[i], gone[j] = stop, after[j], True
        if after[i] < n:
            before[after[i]] = i
        pair(before[i])
        pair(i)
    return [ranks[word[i : end[i]]] for i in range(n) if not gone[i]]


def sign(rank: int, size: int) -> str:
    """One character that stands for an id; their order is that of the ids. Small vocabularies stay below the surrogates."""
    return chr(rank + (0x800 if size <= 0xD000 else 0x10000))


class ByteBPE:
    """Encoder and decoder of one rank file; the file is read on the driver.

    A word is folded as two sequences: the ids of its pieces, at first its bytes, and what each pair of neighbours merges to.
    Each step puts the merged piece in place of the pair of lowest rank, the leftmost of equal ones, and looks up the two new
    pairs. The sequences are strings of one sign an id: as arrays, of which every step copies all boxed elements, a word takes
    half as long again. Frequent distinct words are folded once, in a table of their own, and kept as a literal map to their
    ids, bounded in words and bytes; the others, a few percent of a large corpus's words, are folded where they stand.
    Null and empty texts have no ids and decode to empty bytes; ids outside the vocabulary add nothing when decoded. Repeated
    rows are coded alike; an empty table gives an empty one; other columns stay, whatever their names.
    Texts take time in proportion to their length: those with a match of LONG bytes or more are merged by a heap in Python.
    """

    def __init__(self, spark: SparkSession, path: str, pattern: str = public_tokenizers.PATTERN, known_words: int = KNOWN_WORDS, known_bytes: int = KNOWN_BYTES):
        self.spark, self.known_words, self.known_bytes = spark, known_words, known_bytes
        #: In Java, \s is Unicode white space only under (?U).
        self.pattern = "(?U)" + pattern
        self.table = ranks = read_ranks(path)
        if sorted(ranks.values()) != list(range(len(ranks))) or any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("ranks must be 0 to n - 1 and hold every byte")
        n = len(ranks)
        self.base = ord(sign(0, n))
        #: Stands for a pair that does not merge; above all others.
        self.never = sign(n, n)
        self.byte_signs = "".join(sign(ranks[bytes([b])], n) for b in range(256))
        self.all_bytes = "".join(map(chr, range(256)))
        # Whole words and pairs of pieces are told apart by their characters, so that one map holds both.
        rows = [("w" + k.decode("latin-1"), sign(v, n)) for k, v in ranks.items()]
        for k, v in ranks.items():
            rows += [(sign(ranks[k[:i]], n) + sign(ranks[k[i:]], n), sign(v, n)) for i in range(1, len(k)) if k[:i] in ranks and k[i:] in ranks]
        self.buckets = power_of_two(len(rows) // 3)
        self.merges = cut(spark.createDataFrame(pa.table({"key": [k for k, _ in rows], "merged": [v for _, v in rows]})))
        del rows
        self.pieces = spark.createDataFrame(pa.table({"rank": pa.array(ranks.values(), pa.int32()), "piece": pa.array(ranks, pa.binary())}))

    def words(self, text: Column) -> Column:
        """What the pattern matches, in order."""
        return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(self.pattern), F.lit(0))

    def ranks(self) -> Column:
        """The literal rank map."""
        return hash_map(self.merges, "key", "merged", self.buckets).scalar()

    def merged(self, maps: Column, word: Column) -> Column:
        """Ids of one word."""
        find = lambda key: look_up(maps, key, self.buckets)
        pair = lambda s, j: F.coalesce(find(F.substring(s, j, F.lit(2))), F.lit(self.never))

        def start(s: Column) -> Column:
            pairs = F.array_join(F.transform(F.sequence(F.lit(1), F.length(s) - 1), lambda j: pair(s, j)), "")
            return F.struct(s.alias("s"), pairs.alias("f"))

        def step(x: Column, _: Column) -> Column:
            s, f = x["s"], x["f"]

            def merge(q: Column) -> Column:
                p = F.instr(f, q)
                put = lambda t: F.struct(t.alias("s"), F.overlay(f, F.concat(pair(t, p - 1), pair(t, p)), p - 1, F.lit(3)).alias("f"))
                return F.when(q < self.never, let(F.overlay(s, q, p, F.lit(2)), put)).otherwise(x)

            return let(F.array_min(F.split(f, "")), merge)

        def fold(w: Column) -> Column:
            # The word stands between two signs that merge with nothing, so that every pair has neighbours.
            signs = F.concat(F.lit(self.never), F.translate(w, self.all_bytes, self.byte_signs), F.lit(self.never))
            whole = F.aggregate(F.sequence(F.lit(2), F.greatest(F.lit(2), F.length(w))), let(signs, start), step, lambda x: x["s"])
            return F.replace(whole, F.lit(self.never), F.lit(""))

        signs = let(F.decode(word.cast("binary"), "ISO-8859-1"), lambda w: F.coalesce(find(F.concat(F.lit("w"), w)), fold(w)))
        return let(signs, lambda s: F.transform(F.split(s, ""), lambda c: F.ascii(c) - self.base))

    def vocabulary(self, texts: DataFrame) -> tuple[DataFrame, bool]:
        """(word, ids) of the most frequent distinct words of texts (text), at most known_words of them and known_bytes, and whether any word has LONG bytes."""
        counts = cut(texts.select(F.explode(self.words(F.col("text"))).alias("word")).groupBy("word").count())
        size = F.floor(F.log2("count") * 8).cast("int")
        by_size = counts.groupBy(size.alias("size")).agg(F.count("*").alias("words"), F.sum(F.octet_length("word") + ENTRY).alias("bytes"), F.max(F.octet_length("word")).alias("longest")).collect()  # a few hundred sizes at most
        least, words, bytes_ = 1 << 30, self.known_words, self.known_bytes
        for r in sorted(by_size, key=lambda r: -r["size"]):
            words, bytes_ = words - r["words"], bytes_ - r["bytes"]
            if min(words, bytes_) < 0:
                break
            least = r["size"]
        held = counts.where((size >= least) & (F.octet_length("word") < LONG)).select("word", self.ranks().alias("ranks"))
        known = cut(held.select("word", let(F.col("ranks"), lambda m: self.merged(m, F.col("word"))).alias("ids")))
        drop_cut(counts)
        return known, max((r["longest"] for r in by_size), default=0) >= LONG

    def encode(self, df: DataFrame, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
        """df with the ids of each text, array<int>."""
        packed = Packed(df, text=text_col)
        given = packed.df
        known, some_long = self.vocabulary(given.select("text"))
        buckets = power_of_two(known.count() // 4)
        maps = hash_map(known, "word", "ids", buckets).scalar()
        one = lambda m, k, w: F.coalesce(look_up(k, w, buckets), self.merged(m, w))
        ids = let(F.struct("ranks", "known"), lambda x: F.flatten(F.transform(self.words(F.col("text")), lambda w: one(x["ranks"], x["known"], w))))
        # The optimizer puts the subqueries' results into the one expression that uses them: they are no columns at run time.
        fold = lambda rows: rows.withColumns({"ranks": self.ranks(), "known": maps}).withColumn("ids", ids).drop("ranks", "known")
        if some_long:
            # A quick look at runs of signs spares most texts the exact one; a match holds white space at its ends or is nothing else.
            run = F.col("text").rlike(rf"(?<!\S)\S{{{LONG // 4 - 2}}}|(?<!\s)\s{{{LONG // 4 - 2}}}")
            long = F.coalesce(run & F.exists(self.words(F.col("text")), lambda w: F.octet_length(w) >= LONG), F.lit(False))
            out = fold(given.where(~long)).unionByName(self._encode_long(given.where(long)))
        else:
            out = fold(given)
        return packed.back(out, **{ids_col: F.col("ids")})

    def _encode_long(self, given: DataFrame) -> DataFrame:
        schema, ranks = with_fields(given, "ids array<int>"), self.table

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for r in range(b.num_rows):
                    seen: dict[str, list[int]] = {}
                    ids: list[int] = []
                    for w in b.column("words")[r].as_py():
                        if w not in seen:
                            seen[w] = merge_long(w.encode(), ranks)
                        ids += seen[w]
                    yield pa.record_batch([*[b.column(c).slice(r, 1) for c in schema.names[:-1]], pa.array([ids], pa.list_(pa.int32()))], names=schema.names)

        return given.withColumn("words", self.words(F.col("text"))).mapInArrow(each, schema)

    def decode(self, df: DataFrame, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
        """df with the bytes of each id list: its pieces, concatenated."""
        packed = Packed(df, ids=ids_col)
        # Bytes as they are, under the type of strings, as that is what array_join takes: they are neither decoded nor checked.
        pieces = self.pieces.agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "piece"))), lambda x: x["piece"].cast("string")).alias("p")).scalar()
        join = lambda x: F.array_join(F.transform(x["ids"], lambda i: F.get(x["pieces"], i)), "").cast("binary")
        both = let(F.struct(F.col("ids"), F.col("pieces")), lambda x: F.struct(x["ids"].alias("ids"), join(x).alias("bytes")))
        # Ids and pieces are each used once, so that the optimizer makes one step of this and the encoding, and no column of the pieces.
        out = packed.df.withColumn("pieces", pieces).withColumn("both", both).drop("pieces", "ids").withColumn("ids", F.col("both.ids"))
        return packed.back(out, **{bytes_col: F.col("both.bytes")})


def coded(docs: DataFrame, path: str, known_bytes: int = KNOWN_BYTES) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of documents, through their ids and bytes."""
    bpe = ByteBPE(docs.sparkSession, path, known_bytes=known_bytes)
    out = bpe.decode(bpe.encode(docs.select("doc_id", "text")).drop("text"))
    ids = F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coded(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
