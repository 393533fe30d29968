"""How well answers agree with labels: rates, depth, confusion, weighted accuracy, tables for review. All are plain aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import vocab as V

ABSTAIN, NONE = "ABSTAIN", "NONE"


def ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def share_of(cond: Column, weight: Column | None = None) -> Column:
    return F.coalesce(F.sum(F.when(cond, weight if weight is not None else F.lit(1)).otherwise(0)), F.lit(0)).cast("long")


def bucket(answer: Column, label: Column) -> Column:
    """correct, wrong or abstain; where abstaining is right, any answer is wrong."""
    given = F.coalesce(F.trim(answer), F.lit(""))
    return F.when(label == ABSTAIN, F.when(given == "", "correct").otherwise("wrong")).when(given == "", "abstain").when(given == label, "correct").otherwise("wrong")


def row_class(authority_id: Column, match_type: Column, is_id: Column) -> Column:
    """matched, amb, ill or unmatched; ids that are neither are other."""
    low = F.lower(F.trim(F.coalesce(authority_id, F.lit(""))))
    amb = (low == "amb") | F.coalesce(match_type.isin("single_amb", "chain_amb", "parent_amb"), F.lit(False))
    return F.when(is_id, "matched").when(amb, "amb").when(low == "ill", "ill").when(low == "", "unmatched").otherwise("other")


def match_rate(df: DataFrame, is_id: Column | None = None) -> DataFrame:
    """One row: rows and frequencies by class, and their rates."""
    c = row_class(F.col("authority_id"), F.col("match_type"), is_id if is_id is not None else X.is_uuid(F.col("authority_id")))
    df = df.withColumn("_c", c)
    aggs = [F.count("*").alias("total_rows"), F.coalesce(F.sum("frequency"), F.lit(0)).cast("long").alias("total_frequency")]
    for k in ("matched", "amb", "ill", "unmatched"):
        aggs += [share_of(F.col("_c") == k).alias(f"{k}_rows"), share_of(F.col("_c") == k, F.col("frequency")).alias(f"{k}_frequency")]
    one = df.agg(*aggs)
    for k in ("matched", "amb"):
        one = one.withColumn(f"{k}_row_rate", ratio(F.col(f"{k}_rows"), F.col("total_rows"))).withColumn(f"{k}_freq_rate", ratio(F.col(f"{k}_frequency"), F.col("total_frequency")))
    return one.withColumn("candidate_rows", F.col("matched_rows") + F.col("amb_rows"))


def amb_by_type(df: DataFrame) -> DataFrame:
    kinds = df.where(F.col("match_type").isin("single_amb", "chain_amb", "parent_amb") & (F.coalesce("authority_id", F.lit("")) == ""))
    return kinds.groupBy("match_type").agg(F.count("*").alias("rows"))


def depth(df: DataFrame) -> DataFrame:
    """(level, label, count, pct, specificity) of matched rows that have a level."""
    rows = df.where(F.col("level").isNotNull()).groupBy("level").agg(F.count("*").alias("count"))
    total = F.sum("count").over(Window.partitionBy(F.lit(1)))  # a dozen rows
    fine = F.sum(F.when(F.col("level").between(2, 5), F.col("count")).otherwise(0)).over(Window.partitionBy(F.lit(1)))
    label = F.coalesce(F.element_at(X.literal_map(V.LEVEL_LABELS), F.col("level")), F.col("level").cast("string"))
    return rows.select("level", label.alias("label"), "count", (F.col("count") / total).alias("pct"), (fine / total).alias("specificity"))


def contained(original: Column, chain: Column) -> Column:
    """All words of the string occur in the answer's chain."""
    return (F.size(X.tokens(original)) > 0) & (F.size(F.array_except(X.tokens(original), X.tokens(chain))) == 0)


def disjoint(original: Column, chain: Column) -> Column:
    return (F.size(X.tokens(original)) > 0) & ~F.arrays_overlap(X.tokens(original), X.tokens(chain))


def partial(original: Column, level: Column, skipped: Column) -> Column:
    """explicit if terms were skipped, inferred if the level is broad for so many parts, else null."""
    parts = F.size(X.non_empty(F.split(original, ",")))
    return F.when(skipped > 0, "explicit").when((parts >= 2) & (level >= 6), "inferred").when((parts >= 3) & (level >= 5), "inferred")


def weighted(df: DataFrame, cond: Column) -> DataFrame:
    """One row: count, rate, frequency and its rate of the rows under a condition."""
    one = df.agg(share_of(cond).alias("count"), F.count("*").alias("rows"), share_of(cond, F.col("frequency")).alias("frequency"), F.coalesce(F.sum("frequency"), F.lit(0)).cast("long").alias("all_frequency"))
    return one.select("count", ratio(F.col("count"), F.col("rows")).alias("rate"), "frequency", ratio(F.col("frequency"), F.col("all_frequency")).alias("freq_rate"))


def confusion(df: DataFrame, is_id=X.is_uuid) -> DataFrame:
    """df (authority_id, truth, frequency) to one row: counts of correct, wrong, false positives and misses, and their measures, plain and weighted.

    An answer that equals the truth, or declines where the truth is none, is correct; so precision counts right refusals.
    """
    given, true = is_id(F.col("authority_id")), is_id(F.col("truth"))
    kind = F.when(F.trim("authority_id") == F.col("truth"), "correct").when(given & true, "wrong").when(given, "false_pos").when(true, "miss").otherwise("correct")
    df = df.withColumn("_k", kind)
    one = df.agg(*[share_of(F.col("_k") == k).alias(k) for k in ("correct", "wrong", "false_pos", "miss")], *[share_of(F.col("_k") == k, F.col("frequency")).alias(f"{k}_freq") for k in ("correct", "wrong", "false_pos", "miss")])
    for end in ("", "_freq"):
        c, w, f, m = (F.col(k + end) for k in ("correct", "wrong", "false_pos", "miss"))
        one = one.withColumn("precision" + end, ratio(c, c + w + f)).withColumn("recall" + end, ratio(c, c + w + m)).withColumn("accuracy" + end, ratio(c, c + w + f + m))
        p, r = F.col("precision" + end), F.col("recall" + end)
        one = one.withColumn("f1" + end, F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0))
    return one


def with_bucket(labels: DataFrame, answers: DataFrame) -> DataFrame:
    """labels (guid, label, ...) with verdict and answer; rows without an answer are missing."""
    a = answers.select("guid", F.col("authority_id").alias("answer"), F.lit(True).alias("_there"))
    joined = labels.join(a, "guid", "left")
    return joined.withColumn("verdict", F.when(F.col("_there").isNull(), "missing").otherwise(bucket(F.col("answer"), F.col("label")))).drop("_there")


def by_band(scored: DataFrame) -> DataFrame:
    """(band, correct, wrong, abstain, scored, accuracy); labels NONE and missing rows are left out."""
    rows = scored.where((F.col("label") != NONE) & (F.col("verdict") != "missing"))
    out = rows.groupBy("band").agg(*[share_of(F.col("verdict") == k).alias(k) for k in ("correct", "wrong", "abstain")], F.count("*").alias("scored"))
    return out.withColumn("accuracy", F.col("correct") / F.col("scored"))


def record_accuracy(scored: DataFrame, bands: DataFrame) -> DataFrame:
    """Accuracy by bands (band, strings, records), weighted with the records of the bands that have rows."""
    joined = by_band(scored).join(F.broadcast(bands), "band")  # a handful of bands
    return joined.agg((F.sum(F.col("records") * F.col("accuracy")) / F.sum("records")).alias("record_accuracy"))


def paired(scored: DataFrame, bands: DataFrame) -> DataFrame:
    """(run, term_accuracy, record_accuracy, coverage, precision) of several runs; bands without rows count as zero."""
    rows = scored.where((F.col("label") != NONE) & (F.col("verdict") != "missing"))
    commit = F.coalesce(F.trim("answer"), F.lit("")) != ""
    per = rows.groupBy("run", "band").agg(F.count("*").alias("n"), share_of(F.col("verdict") == "correct").alias("ok"), share_of(commit).alias("commit"), share_of(commit & (F.col("verdict") == "correct")).alias("commit_ok"))
    strings, records = (bands.agg(F.sum(c)).first()[0] for c in ("strings", "records"))
    j = per.join(F.broadcast(bands), "band")
    rate = lambda a, b: ratio(F.col(a), F.col(b))
    return j.groupBy("run").agg((F.sum(F.col("strings") * rate("ok", "n")) / strings).alias("term_accuracy"), (F.sum(F.col("records") * rate("ok", "n")) / records).alias("record_accuracy"), (F.sum(F.col("records") * rate("commit", "n")) / records).alias("coverage"), (F.sum(F.col("records") * rate("commit_ok", "commit")) / records).alias("precision"))


def by_status(scored: DataFrame) -> DataFrame:
    """(status, strings, records, correct, records_correct, committed, committed_correct); missing rows stay in the denominator."""
    ok, commit = F.col("verdict") == "correct", F.coalesce(F.trim("answer"), F.lit("")) != ""
    f = F.col("frequency")
    return scored.groupBy("status").agg(F.count("*").alias("strings"), F.sum(f).cast("long").alias("records"), share_of(ok).alias("correct"), share_of(ok, f).alias("records_correct"), share_of(commit).alias("committed"), share_of(commit & ok).alias("committed_correct"))


def head_score(sheet: DataFrame, pps: bool = False) -> DataFrame:
    """Of a sheet (verdict, frequency): y and a are right, n wrong, others wait. pps: each row is one draw and weighs one."""
    v, w = F.lower(F.trim("verdict")), F.lit(1) if pps else F.col("frequency")
    done = v.isin("y", "a", "n")
    one = sheet.agg(share_of(done).alias("scored"), share_of(~done).alias("skipped"), share_of(v.isin("y", "a"), w).alias("correct"), share_of(v == "n", w).alias("wrong"), share_of(done, w).alias("weight"))
    ci = X.wilson(F.col("correct"), F.col("weight"))
    return one.withColumn("accuracy", ratio(F.col("correct"), F.col("weight"))).withColumn("low", ci["low"]).withColumn("high", ci["high"])


def running_share(df: DataFrame, order: str = "ordinal") -> DataFrame:
    """df (frequency, ordinal) with rank, pct and cumulative pct.

    Sums by frequency come first and their running total is over distinct frequencies; within one, position times frequency.
    """
    sums = df.groupBy("frequency").agg(F.count("*").alias("_n"))
    w = Window.partitionBy(F.lit(1)).orderBy(F.desc("frequency"))  # distinct frequencies only
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_rows", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumn("_mass", F.coalesce(F.sum(F.col("_n") * F.col("frequency")).over(before), F.lit(0)))
    total = df.agg(F.sum("frequency").alias("_total"))
    inside = F.row_number().over(Window.partitionBy("frequency").orderBy(order))
    out = df.withColumn("_i", inside).join(sums, "frequency").crossJoin(F.broadcast(total))  # one row
    return out.select(*df.columns, (F.col("_rows") + F.col("_i")).cast("long").alias("rank"), (F.col("frequency") / F.col("_total")).alias("pct"), ((F.col("_mass") + F.col("_i") * F.col("frequency")) / F.col("_total")).alias("cum_pct"))


def top_per_class(df: DataFrame, cls: str, order: list, k: int = 6) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(cls).orderBy(*order))).where(F.col("rank") <= k)


def shares_by(df: DataFrame, key: Column, least: int = 25) -> DataFrame:
    """(key, n, correct, wrong, abstain shares) of groups that are large enough."""
    rate = lambda k: F.avg(F.when(F.col("verdict") == k, 1.0).otherwise(0.0))
    out = df.groupBy(key.alias("key")).agg(F.count("*").alias("n"), rate("correct").alias("correct"), rate("wrong").alias("wrong"))
    return out.where(F.col("n") >= least).withColumn("abstain", 1 - F.col("correct") - F.col("wrong"))


def reachability(rows: DataFrame, authority: DataFrame, ancestors: DataFrame) -> DataFrame:
    """rows (row_id, place, truth) with class: absent if nothing names the record, reachable if an ancestor of it is named too, else unsupported."""
    names = authority.where("name <> ''").select(F.col("uuid").alias("hit"), X.normalized_term(F.col("name")).alias("n"))
    # From the record's own names and its ancestors' to the terms, as a term may name very many records.
    own = names.groupBy(F.col("hit").alias("truth")).agg(F.collect_set("n").alias("_own"))
    up = ancestors.select(F.col("uuid").alias("truth"), F.col("anc").alias("hit")).join(names, "hit").groupBy("truth").agg(F.collect_set("n").alias("_up"))
    truth = authority.select(F.col("uuid").alias("truth"), X.words(X.normalized_term(F.col("name"))).alias("toks"))
    named = F.exists(X.non_empty(F.split("place", "[,;]")), lambda t: X.within(F.col("toks"), X.words(X.normalized_term(t))))
    df = rows.join(truth, "truth", "left").join(own, "truth", "left").join(up, "truth", "left")
    df = df.withColumn("_terms", F.transform(X.non_empty(F.split("place", "[,;]")), lambda t: X.normalized_term(t)))
    says = lambda c: F.coalesce(F.arrays_overlap("_terms", c), F.lit(False))
    cls = F.when(F.col("toks").isNull() | ~(F.coalesce(named, F.lit(False)) | says("_own")), "absent").when(says("_up"), "reachable").otherwise("unsupported")
    return df.select(*rows.columns, cls.alias("reach"))


# Words around a name that explain a miss, in order.
NOISE_WORDS = [("direction", r"\b(north|south|east|west|near)\b"), ("jurisdiction word", r"\b(county|township|twp|city|town|parish|borough|district)\b"), ("number", r"\d")]


def failure_class(rows: DataFrame, authority: DataFrame, ancestors: DataFrame) -> DataFrame:
    """rows (row_id, truth, answer, verdict, match_type, skipped array) with failure: why a reachable row missed."""
    rec = authority.select("uuid", X.normalized_term(F.col("name")).alias("n"), "level")
    df = rows.join(rec.toDF("truth", "tn", "tl"), "truth", "left").join(rec.toDF("answer", "an", "al"), "answer", "left")
    up = ancestors.select(F.col("uuid").alias("truth"), F.col("anc").alias("answer"), F.lit(True).alias("is_up"))
    df = df.join(up, ["truth", "answer"], "left")
    hit = F.get(F.filter("skipped", lambda t: ~t.contains("proximity:") & X.within(X.words(F.col("tn")), X.words(X.normalized_term(t)))), F.lit(0))
    df = df.withColumn("_hit", hit).withColumn("_rest", F.array_join(F.array_except(X.words(X.normalized_term(F.col("_hit"))), X.words(F.col("tn"))), " "))
    noise = F.lit("other tokens")
    for label, pattern in reversed(NOISE_WORDS):
        noise = F.when(F.col("_rest").rlike(pattern), label).otherwise(noise)
    cls = (
        F.when(F.col("_hit").isNotNull() & (F.col("_rest") == ""), "leaf discarded, term was exactly the answer")
        .when(F.col("_hit").isNotNull(), F.concat(F.lit("leaf discarded, wrapped in noise: "), noise))
        .when(F.col("verdict") == "abstain", F.concat(F.lit("abstained ("), F.col("match_type"), F.lit(")")))
        .when(F.col("is_up"), "committed to an ancestor of the leaf")
        .when(F.col("an") == F.col("tn"), F.concat(F.lit("same name, wrong record (got L"), F.col("al").cast("string"), F.lit(", truth L"), F.col("tl").cast("string"), F.lit(")")))
        .otherwise("committed to an unrelated place")
    )
    return df.select(*rows.columns, cls.alias("failure"))


def summary(results: DataFrame) -> DataFrame:
    """(match_type, rows, skips, suspect encodings) in order of the types."""
    return results.groupBy("match_type").agg(F.count("*").alias("rows"), F.sum("skipped_count").cast("long").alias("skips"), share_of(F.col("source_encoding_suspect")).alias("suspect"), share_of(F.col("below_supported")).alias("below")).orderBy("match_type")


def shape_histogram(results: DataFrame) -> DataFrame:
    return results.select(F.explode("source_shape").alias("tag")).groupBy("tag").agg(F.count("*").alias("rows"))


def flagged(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """A row for each rule that a row breaks, the most frequent first."""
    reasons = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in rules.items()]))
    return df.withColumn("flag", F.explode(reasons)).orderBy(F.desc("frequency"), "flag", "guid")


def merged_verdicts(sheet: DataFrame, verdicts: DataFrame, force: bool = False) -> DataFrame:
    """sheet (rank, verdict, ...) with new verdicts (rank, new); one that is filled in and differs is a conflict and stays, unless forced."""
    j = sheet.join(verdicts, "rank", "left")
    old = F.coalesce(F.trim("verdict"), F.lit(""))
    clash = F.col("new").isNotNull() & (old != "") & (old != F.col("new"))
    use = F.col("new").isNotNull() & (F.lit(force) | ~clash)
    return j.withColumn("conflict", clash).withColumn("verdict", F.when(use, F.col("new")).otherwise(F.col("verdict"))).drop("new")


def compared(old: DataFrame, new: DataFrame, key: str, col: str) -> DataFrame:
    """(key, old, new, state): same, differs, blank or unresolved."""
    j = old.select(key, F.col(col).alias("old")).join(new.select(key, F.col(col).alias("new"), F.lit(True).alias("_there")), key, "left")
    state = F.when(F.col("_there").isNull(), "unresolved").when(F.coalesce(F.trim("new"), F.lit("")) == "", "blank").when(F.col("new") == F.col("old"), "same").otherwise("differs")
    return j.select(key, "old", "new", state.alias("state"))
