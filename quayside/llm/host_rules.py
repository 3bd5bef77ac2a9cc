r"""Operator 4: quality rules with host-level verdicts.  DataFrame functions only.

Each document is tried by the rules below.  Failures are counted by host (the
``source`` column), a beta prior is fitted to all hosts' rates by moments, and
each host's rate is shrunk towards it.  A host is bad if the rate that it
exceeds with fair certainty (posterior mean less two standard deviations) is
above ``HOST_LIMIT``.  Host verdicts are joined back to the documents: on a bad
host a document must pass the soft rules too, elsewhere the base rules decide.
So a document that passes every rule is always kept.

Null and empty texts have no words, so they fail the base rules.  Rows with a
null host form one host.  Repeated rows and ties are judged one by one.  Very long texts
are judged whole, in the memory of their row.  An empty table gives no rows.  Extra columns
go along in ``keep_good``, whatever their names, and are left out of the figures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

#: fixed values of the contract
MIN_WORDS, MAX_REPEAT = 50, 50
#: soft rules: symbols per word, share of repeated lines, mean length of a word
MAX_SYMBOLS, MAX_DUP_LINES, MEAN_WORD = 0.1, 0.3, (2.0, 12.0)
HOST_LIMIT, LEAST_STRENGTH, MOST_STRENGTH = 0.5, 1.0, 1000.0
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def repeat_words(words: Column) -> Column:
    """Words in three-word windows that occur twice or more.

    The windows are sorted with their places; equal neighbours are repeats;
    the places they cover are counted in order.
    """
    windows = F.sort_array(F.transform(F.sequence(F.lit(1), F.size(words) - 2), lambda i: F.struct(
        F.concat_ws(" ", F.get(words, i - 1), F.get(words, i), F.get(words, i + 1)).alias("w"), i.alias("i"))))

    def places(s: Column) -> Column:
        same = F.zip_with(s, F.slice(s, 2, F.size(s)), lambda a, b: a["w"].eqNullSafe(b["w"]))  # last: no next
        before = F.concat(F.array(F.lit(False)), F.slice(same, 1, F.size(same) - 1))
        return F.sort_array(F.transform(
            F.filter(F.arrays_zip(s.alias("s"), same.alias("n"), before.alias("p")), lambda x: x["n"] | x["p"]),
            lambda x: x["s"]["i"]))

    def cover(acc: Column, i: Column) -> Column:
        return F.struct((i + 2).alias("last"), (acc["n"] + i + 2 - F.greatest(acc["last"], i - 1)).alias("n"))

    start = F.struct(F.lit(0).alias("last"), F.lit(0).alias("n"))
    # one-element transforms bind an array once
    counted = F.transform(F.array(windows), lambda s: F.aggregate(places(s), start, cover)["n"])[0]
    return F.when(F.size(words) >= 4, counted).otherwise(0)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` as ``row`` with the metrics and rule results of each document."""
    t = F.col("_text")
    df = docs.select(F.struct("*").alias("row"), C.whole_text(text).alias("_text"))
    df = df.select("row", "_text", C.words_of(t).alias("_words"),
                   F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"))
    df = df.select(
        "row", F.size("_words").cast("long").alias("n_words"),
        F.length(F.regexp_replace(t, C.SPACE, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("_words")).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"))
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    mean = F.col("word_chars") / F.greatest("n_words", F.lit(1))
    soft = ((F.col("n_symbols") > MAX_SYMBOLS * F.col("n_words"))
            | (F.col("n_dup_lines") > MAX_DUP_LINES * F.col("n_lines")) | ~mean.between(*MEAN_WORD))
    return df.select("*", base.alias("base_failed"), soft.alias("soft_failed"))


def host_verdicts(judged: DataFrame) -> DataFrame:
    """(host, host_rate, host_bad) from rows (host, base_failed, soft_failed).

    The prior's mean is the pooled rate and its strength comes from the spread
    of the hosts' rates, within the two bounds.  Its three sums are one row.
    """
    hosts = judged.groupBy("host").agg(
        F.count("*").alias("n"), F.sum((F.col("base_failed") | F.col("soft_failed")).cast("long")).alias("k"))
    hosts = C.materialise(hosts, "hosts")
    x = hosts.agg(F.sum("k").alias("k"), F.sum("n").alias("n"), F.count("*").alias("h"),
                  F.sum(F.col("k") * F.col("k") / F.col("n")).alias("kk")).first()
    total, failed = x["n"] or 0, x["k"] or 0
    mean = (failed + 0.5) / (total + 1)
    # moments of a beta-binomial: sum n (p - mean)^2 against its mean under strength s
    spread = max(0.0, (x["kk"] or 0.0) - 2 * mean * failed + mean * mean * total)
    per = mean * (1 - mean)
    between = (spread - x["h"] * per) / max(total - x["h"], 1)
    strength = MOST_STRENGTH if between <= 0 else min(MOST_STRENGTH, max(LEAST_STRENGTH, per / between - 1))
    a = F.col("k") + mean * strength
    n = F.col("n") + strength
    rate = a / n
    low = rate - 2 * F.sqrt(rate * (1 - rate) / (n + 1))
    return C.materialise(hosts.select(
        "host", F.round(rate, 6).alias("host_rate"), (low > HOST_LIMIT).alias("host_bad")), "verdicts")


def judge(docs: DataFrame, host: str = "source", text: str = "text", carry: bool = True) -> DataFrame:
    """Every row of ``docs`` (as ``row``; only its doc_id unless ``carry``) with metrics, host verdict and ``kept``."""
    rows = measured(docs, text)
    rows = rows.select(F.col("row") if carry else F.struct("row.doc_id").alias("row"), F.col("row").getField(host).alias("host"),
                       *METRICS, "base_failed", "soft_failed")
    rows = C.materialise(rows, "judged")  # the metrics are used twice
    verdicts = host_verdicts(rows).withColumnRenamed("host", "_host")
    joined = rows.join(verdicts, rows["host"].eqNullSafe(verdicts["_host"]), "left").drop("_host")
    return joined.withColumn("kept", ~F.col("base_failed") & ~(F.col("host_bad") & F.col("soft_failed")))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with their own columns."""
    return judge(docs).filter("kept").select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract rows: metrics, base verdict and final verdict of every document."""
    judged = judge(C.table(spark, sf_dir, "documents").select("doc_id", "text", "source"), carry=False)
    return judged.select(F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept", "soft_failed", "host", "host_rate", "host_bad")
