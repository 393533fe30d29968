"""An authority, dirty place strings and a frequency prior, derived from the star schema of the test data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AUTHORITY = "uuid string, parent string, name string, level int, jurisdiction string, population long, lat double, lon double, historical string"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spot(key: str) -> list[Column]:
    k = F.col(key).cast("long")
    return [((k * 37 % 1800) / 10.0 - 90).alias("lat"), ((k * 91 % 3600) / 10.0 - 180).alias("lon")]


def authority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """region, nation, supplier and customer as four levels of places."""

    def level(df: DataFrame, key: str, prefix: str, parent: Column, name: Column, number: int, jurisdiction: Column, population: Column) -> DataFrame:
        return df.select(F.concat(F.lit(prefix), key).alias("uuid"), parent.alias("parent"), name.alias("name"), F.lit(number).alias("level"), jurisdiction.alias("jurisdiction"), population.cast("long").alias("population"), *_spot(key), F.lit("").alias("historical"))

    suppliers = table(spark, sf_dir, "supplier")
    first = suppliers.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("s"))
    cities = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("c_custkey")).join(first, F.col("s_nationkey") == F.col("c_nationkey"), "left")
    zero = F.lit(0)
    parts = [
        level(table(spark, sf_dir, "region"), "r_regionkey", "R", F.lit(None).cast("string"), F.col("r_name"), 8, F.lit("Country"), zero),
        level(table(spark, sf_dir, "nation"), "n_nationkey", "N", F.concat(F.lit("R"), "n_regionkey"), F.col("n_name"), 6, F.lit("State"), zero),
        level(suppliers, "s_suppkey", "S", F.concat(F.lit("N"), "s_nationkey"), F.col("s_name"), 5, F.lit("County"), zero),
        level(cities, "c_custkey", "C", F.coalesce(F.concat(F.lit("S"), "s"), F.concat(F.lit("N"), "c_nationkey")), F.col("p_name"), 4, F.when(F.col("c_custkey") % 3 != 0, "City").otherwise("Township"), F.greatest(zero, F.floor("c_acctbal"))),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


#: The same in SQL of the checking engine.
AUTHORITY_SQL = """
authority AS (
  SELECT 'R' || r_regionkey AS uuid, NULL::VARCHAR AS parent, r_name AS name, 8 AS level, 'Country' AS jurisdiction, 0::BIGINT AS population, (r_regionkey::BIGINT * 37 % 1800) / 10.0 - 90 AS lat, (r_regionkey::BIGINT * 91 % 3600) / 10.0 - 180 AS lon FROM region
  UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey, n_name, 6, 'State', 0, (n_nationkey::BIGINT * 37 % 1800) / 10.0 - 90, (n_nationkey::BIGINT * 91 % 3600) / 10.0 - 180 FROM nation
  UNION ALL SELECT 'S' || s_suppkey, 'N' || s_nationkey, s_name, 5, 'County', 0, (s_suppkey * 37 % 1800) / 10.0 - 90, (s_suppkey * 91 % 3600) / 10.0 - 180 FROM supplier
  UNION ALL SELECT 'C' || c_custkey, coalesce('S' || s, 'N' || c_nationkey), p_name, 4, CASE WHEN c_custkey % 3 <> 0 THEN 'City' ELSE 'Township' END, greatest(0, floor(c_acctbal))::BIGINT, (c_custkey * 37 % 1800) / 10.0 - 90, (c_custkey * 91 % 3600) / 10.0 - 180
    FROM customer JOIN part ON p_partkey = c_custkey LEFT JOIN (SELECT s_nationkey, min(s_suppkey) AS s FROM supplier GROUP BY 1) f ON s_nationkey = c_nationkey
)"""


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One string a customer in ten styles: row_id, place, guid, frequency, label."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    home = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    other = nation.select((F.col("n_nationkey") - 1).alias("o_key"), F.col("n_name").alias("o_name"))
    df = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("c_custkey"))
    df = df.join(F.broadcast(home), F.col("n_nationkey") == F.col("c_nationkey"))  # 25 rows
    df = df.join(F.broadcast(other), F.col("o_key") == F.when(F.col("c_nationkey") == 24, -1).otherwise(F.col("c_nationkey")), "left")
    k, p, n, r = F.col("c_custkey"), F.col("p_name"), F.col("n_name"), F.col("r_name")
    rest = lambda i: F.substring(p, F.lit(i), F.length(p))
    swapped = F.concat(F.substring(p, 1, 1), F.substring(p, 3, 1), F.substring(p, 2, 1), rest(4))
    even = (k / 10).cast("long") % 2 == 0
    styles = [
        F.concat_ws(", ", p, n, r), F.concat_ws(", ", p, r), F.concat_ws(", ", p, F.col("o_name"), r),
        F.concat_ws(", ", swapped, n), F.concat_ws(", ", F.concat(F.substring(p, 1, 1), rest(3)), n), F.concat_ws(" ", p, n, r),
        F.concat(F.when(even, "near ").otherwise("City of "), p, F.lit(", "), n), F.when(even, "qqq, zzz").otherwise(F.lower(r)),
        F.concat(F.lit("home of x in "), p), F.when(even, F.concat_ws(", ", r, n)).otherwise(F.concat(p, F.lit("; "), p, F.lit(", "), n)),
    ]
    text = F.lit(None).cast("string")
    for i, s in reversed(list(enumerate(styles))):
        text = F.when(k % 10 == i, s).otherwise(text)
    label = F.when(k % 10 <= 6, F.concat(F.lit("C"), k)).when((k % 10 == 7) & even, "ABSTAIN").otherwise("NONE")
    return df.select(k.alias("row_id"), text.alias("place"), F.concat(F.lit("g"), k).alias("guid"), (1 + k % 97).cast("string").alias("frequency"), label.alias("label"))


PLACES_SQL = """
places AS (
  SELECT c_custkey AS row_id, CASE c_custkey % 10
      WHEN 0 THEN p_name || ', ' || n.n_name || ', ' || r_name WHEN 1 THEN p_name || ', ' || r_name
      WHEN 2 THEN p_name || ', ' || o.n_name || ', ' || r_name
      WHEN 3 THEN substr(p_name, 1, 1) || substr(p_name, 3, 1) || substr(p_name, 2, 1) || substr(p_name, 4) || ', ' || n.n_name
      WHEN 4 THEN substr(p_name, 1, 1) || substr(p_name, 3) || ', ' || n.n_name WHEN 5 THEN p_name || ' ' || n.n_name || ' ' || r_name
      WHEN 6 THEN CASE WHEN (c_custkey // 10) % 2 = 0 THEN 'near ' ELSE 'City of ' END || p_name || ', ' || n.n_name
      WHEN 7 THEN CASE WHEN (c_custkey // 10) % 2 = 0 THEN 'qqq, zzz' ELSE lower(r_name) END
      WHEN 8 THEN 'home of x in ' || p_name
      ELSE CASE WHEN (c_custkey // 10) % 2 = 0 THEN r_name || ', ' || n.n_name ELSE p_name || '; ' || p_name || ', ' || n.n_name END END AS place,
    'g' || c_custkey AS guid, (1 + c_custkey % 97)::VARCHAR AS frequency,
    CASE WHEN c_custkey % 10 <= 6 THEN 'C' || c_custkey WHEN c_custkey % 10 = 7 AND (c_custkey // 10) % 2 = 0 THEN 'ABSTAIN' ELSE 'NONE' END AS label
  FROM customer JOIN part ON p_partkey = c_custkey JOIN nation n ON n.n_nationkey = c_nationkey JOIN region ON r_regionkey = n.n_regionkey
  LEFT JOIN nation o ON o.n_nationkey = (c_nationkey + 1) % 25
)"""


def term_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, uuid, freq): orders of each customer under its place name."""
    counts = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("freq"))
    rows = table(spark, sf_dir, "part").join(counts, F.col("p_partkey") == F.col("o_custkey"))
    return rows.select(F.lower("p_name").alias("key"), F.concat(F.lit("C"), "o_custkey").alias("uuid"), "freq")


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(raw, value, uuid): a brand names the first of its parts that is a customer."""
    rows = table(spark, sf_dir, "part").join(table(spark, sf_dir, "customer"), F.col("p_partkey") == F.col("c_custkey"), "left_semi")
    first = rows.groupBy("p_brand").agg(F.min("p_partkey").alias("k"))
    return first.select(F.col("p_brand").alias("raw"), F.lit("").alias("value"), F.concat(F.lit("C"), "k").alias("uuid"))
