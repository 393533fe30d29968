"""Readers and writers of the tab-separated exchange files, and the indexes made of them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X

#: Columns of an authority export and their names here.
EXPORT = {"ID": "uuid", "ParentID": "parent", "Term": "name", "Level": "level", "LevelName": "jurisdiction", "Population": "population", "FullChainName": "type_ahead", "Historical": "historical", "Latitude": "lat", "Longitude": "lon"}
#: Names under which files carry a column, in order of preference.
ALIASES = {
    "guid": ["guid", "place_guid"], "authority_id": ["authority_id", "place_id", "correct_authority_id", "correct_place_id"],
    "raw": ["_raw", "InputString"], "value": ["_value", "MatchAuthName"], "uuid": ["_ID", "MatchAuthID"],
}


def find_column(columns: Iterable[str], wanted: str, override: str | None = None, required: bool = True) -> str | None:
    """The column meant by a name: the override, else the first alias, whatever its case."""
    columns = list(columns)
    if override:
        if override not in columns:
            raise ValueError(f"no column {override!r}; there are {columns}")
        return override
    low = {c.lower(): c for c in reversed(columns)}
    for name in ALIASES.get(wanted, [wanted]):
        if name.lower() in low:
            return low[name.lower()]
    if required:
        raise ValueError(f"no column for {wanted!r}; there are {columns}")
    return None


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """A TSV file with a header, quotes and all columns strings; empty fields are empty strings."""
    df = spark.read.csv(path, sep="\t", header=True, quote='"', escape='"', multiLine=True, encoding="UTF-8")
    df = df.toDF(*[c.strip().lstrip("﻿") for c in df.columns])
    return df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns])


def read_commented_tsv(spark: SparkSession, path: str, everywhere: bool = False) -> DataFrame:
    """A TSV file under lines of comments: a leading block of # lines, or, `everywhere`, all # lines."""
    lines = spark.read.text(path)
    head = lines.take(1000)  # the block of comments is short; the table's own order is that of the file
    skip = next((i for i, r in enumerate(head) if not r[0].startswith("#")), len(head))
    if skip >= len(head):
        raise ValueError("no header")
    header = head[skip][0].lstrip("﻿").split("\t")
    names = [h.strip() for h in header]
    if everywhere:
        body = lines.where(~F.col("value").startswith("#"))
    else:
        comments = [r[0] for r in head[:skip]]
        body = lines.where(~F.col("value").isin(comments)) if comments else lines
    body = body.where(F.col("value") != head[skip][0])
    ddl = ", ".join(f"`{n}` STRING" for n in names)
    row = F.from_csv("value", F.lit(ddl), {"sep": "\t", "quote": '"', "escape": '"'})
    return body.select(row.alias("r")).select(*[F.coalesce(F.col("r").getField(n), F.lit("")).alias(n) for n in names])


def entries(df: DataFrame) -> DataFrame:
    """(row_id, place, guid, frequency): the matcher's input; only place is required."""
    if "place" not in df.columns:
        raise ValueError("the input needs a column place")
    cols = [X.field(F.col(c)).alias(c) if c in df.columns else F.lit("").alias(c) for c in ("place", "guid", "frequency")]
    row_id = F.col("row_id").cast("long") if "row_id" in df.columns else F.monotonically_increasing_id()
    return df.select(row_id.alias("row_id"), *cols)


def authority_from_export(df: DataFrame) -> DataFrame:
    """An export's columns by their names here; rows without id go."""
    cols = {new: X.field(F.col(old)) for old, new in EXPORT.items()}
    cols["level"] = F.expr("try_cast(Level AS INT)")
    cols["population"] = F.coalesce(F.expr("try_cast(try_cast(Population AS DOUBLE) AS BIGINT)"), F.lit(0).cast("long"))
    cols["lat"], cols["lon"] = F.expr("try_cast(Latitude AS DOUBLE)"), F.expr("try_cast(Longitude AS DOUBLE)")
    return df.select(*[c.alias(n) for n, c in cols.items()]).where("uuid <> ''")


def name_index(authority: DataFrame) -> DataFrame:
    """(key, uuid, jurisdiction): each name under both of its keys."""
    return authority.where("name <> ''").select(F.explode(X.lookup_keys(F.col("name"))).alias("key"), "uuid", F.coalesce("jurisdiction", F.lit("")).alias("jurisdiction")).distinct()


def alias_index(mapping: DataFrame, check_ids: bool = False) -> DataFrame:
    """(key, uuid, src) of a table (raw, value, uuid): raw strings and canonical values under both keys; ids that cannot be one are left out."""
    rows = mapping.where(X.looks_like_uuid(F.col("uuid"))) if check_ids else mapping.where("uuid <> ''")
    raw = rows.where("raw <> ''").select(F.explode(X.lookup_keys(F.col("raw"))).alias("key"), "uuid", F.lit("raw").alias("src"))
    value = rows.where("value <> ''").select(F.explode(X.lookup_keys(F.col("value"))).alias("key"), "uuid", F.lit("value").alias("src"))
    return raw.unionByName(value).distinct()


def whole_string_index(mapping: DataFrame) -> DataFrame:
    """(key, uuid): raw strings of several terms that mean one place only."""
    rows = mapping.where((F.col("uuid") != "") & F.col("raw").rlike("[,;]"))
    counted = rows.groupBy(X.canonical(F.col("raw")).alias("key")).agg(F.count_distinct("uuid").alias("n"), F.min("uuid").alias("uuid"))
    return counted.where("n = 1").select("key", "uuid")


def with_dictionary(index: DataFrame, dictionary: DataFrame) -> DataFrame:
    """An alias index and a term dictionary (term, uuid): a union; neither replaces the other."""
    more = dictionary.where("term <> '' AND uuid <> ''").select(F.explode(X.lookup_keys(F.col("term"))).alias("key"), F.upper("uuid").alias("uuid"), F.lit("raw").alias("src"))
    return index.unionByName(more).distinct()


def first_by(df: DataFrame, keys: list[str], order: list, last: bool = False) -> DataFrame:
    """The first row of each key, or the last, in a stated order."""
    by = [F.desc(c) if last and isinstance(c, str) else c for c in order]
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*by))).where("_n = 1").drop("_n")


def write_tsv(df: DataFrame, path: str) -> None:
    """A folder of one TSV file with a header, for people; Parquet is for programs."""
    flat = df.select(*[F.array_join(F.col(c).cast("array<string>"), "|").alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes])
    flat.coalesce(1).write.mode("overwrite").csv(path, sep="\t", header=True, quote='"', escape='"', emptyValue="")


def export_once(df: DataFrame, path: str) -> None:
    """Writes a snapshot unless there is one."""
    df.write.mode("ignore").parquet(path)


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old with new's rows put in place of those of equal keys, sorted by the keys: counts are overwritten, not added."""
    values = [c for c in old.columns if c not in keys]
    a, b = old.alias("a"), new.withColumn("_new", F.lit(True)).alias("b")
    joined = a.join(b, keys, "full_outer")
    picked = [F.when(F.col("_new"), F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c) for c in values]
    return joined.select(*keys, *picked).orderBy(*keys)
