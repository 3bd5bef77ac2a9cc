r"""Operator 1: secret scans over an incremental blob ledger.  DataFrame functions only.

Every version of a file is addressed by the SHA-256 of its content.  A ledger
(Parquet, in shared storage) has one row for each (blob, rule, rule version)
that was scanned, with its findings.  A scan drops every path to its blob's address,
keeps the addresses with pairs that the ledger lacks, fetches and scans one copy of each by
the missing rules only, appends the new pairs in one write, and joins the
ledger's findings back to all paths.  When nothing is new, no text is moved.  A rule's version is a digest of its
pattern, so a changed rule is scanned again and the others are not.

Null texts count as empty; an empty text is a blob like any other; rows that
repeat share one blob and each gets its findings; other columns pass through
untouched, whatever their names.  Spans that start together are ordered by their rules as
listed.  Very long texts are scanned whole, in the memory of their row.  An empty table
leaves the ledger as it is and gives no rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

#: fixed values: the base patterns (a run too short for its kind is no match, so the least length is in the
#: pattern where that gives the same matches) and two more formats; every hit is a whole match
BASE = ("assign", "access", "hex")
RULES = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
    "github": r"gh[pousr]_[A-Za-z0-9]{36,}",
    "pem": r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----",
}
MIN_VALUE = 6
FEW = 10_000  # addresses with the names of their rules (some 300 bytes each) that are sent to the texts
LEDGER = "blob binary, rule string, version string, spans array<struct<start:int,end:int>>"


def version_of(pattern: str) -> str:
    return hashlib.sha256(pattern.encode()).hexdigest()[:12]


def blob_of(text="text"):
    return F.unhex(F.sha2(C.whole_text(text), 256))


def open_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at ``path``; empty if nothing was written there yet."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    if there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there):
        return spark.read.schema(LEDGER).parquet(path)
    return spark.createDataFrame([], LEDGER)


def pending(blobs: DataFrame, ledger: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Of ``blobs`` (blob, ...), the addresses that lack a rule's version, with the rules they lack; no text is read on."""
    wanted = F.array(*[F.lit(f"{k}:{version_of(p)}") for k, p in rules.items()])
    done = (ledger.withColumn("pair", F.concat_ws(":", "rule", "version"))
            .filter(F.array_contains(wanted, F.col("pair")))
            .groupBy("blob").agg(F.collect_set("pair").alias("done")))  # at most one entry a rule
    return (blobs.select("blob").distinct().join(done, "blob", "left")
            .withColumn("todo", F.array_except(wanted, F.coalesce("done", F.expr("cast(array() as array<string>)"))))
            .filter(F.size("todo") > 0).select("blob", "todo"))


def texts_of(blobs: DataFrame, todo: DataFrame) -> DataFrame:
    """(blob, text, todo): one copy of each blob in ``todo``.

    Few of them are sent to the texts, which stay where they are; many meet the texts where copies have been
    put together, before the shuffle as far as they share a task.
    """
    if todo.limit(FEW + 1).count() <= FEW:
        return blobs.join(F.broadcast(todo), "blob").groupBy("blob").agg(F.first("text").alias("text"), F.first("todo").alias("todo"))
    return blobs.groupBy("blob").agg(F.first("text").alias("text")).join(todo, "blob")


def scan_blobs(todo: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Ledger rows for the (blob, rule) pairs in ``todo`` (blob, text, todo); a text's other rules are not run."""
    found = C.with_spans(todo, "text", rules, asked={
        k: F.array_contains("todo", f"{k}:{version_of(p)}") for k, p in rules.items()})
    rows = []
    for kind, pattern in rules.items():
        spans = F.col(f"span_{kind}")
        if kind == "assign":
            spans = F.filter(spans, lambda s: F.length(F.regexp_extract(s["hit"], RULES["assign"], 2)) >= MIN_VALUE)
        rows.append(F.struct(
            F.lit(kind).alias("rule"), F.lit(version_of(pattern)).alias("version"),
            F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("spans")))
    return (found.select("blob", "todo", F.explode(F.array(*rows)).alias("r"))
            .filter(F.array_contains("todo", F.concat_ws(":", "r.rule", "r.version")))
            .select("blob", "r.rule", "r.version", "r.spans"))


def update_ledger(docs: DataFrame, ledger_path: str, rules: dict[str, str] = RULES, text: str = "text") -> DataFrame:
    """Scan what the ledger lacks, append it, and return the whole ledger."""
    spark = docs.sparkSession
    blobs = docs.select(blob_of(text).alias("blob"), C.whole_text(text).alias("text"))
    todo = C.materialise(pending(blobs, open_ledger(spark, ledger_path), rules), "pending")
    if todo.limit(1).count():
        scan_blobs(texts_of(blobs, todo), rules).write.mode("append").parquet(ledger_path)
    return open_ledger(spark, ledger_path)


def findings(ledger: DataFrame, rules: dict[str, str] = RULES) -> DataFrame:
    """(blob, hits): all spans of the rules' present versions, by start, then rule as listed; blobs without are absent.

    A pair that the ledger holds more than once, as after two scans at the same time, counts once.
    """
    now = F.array(*[F.lit(f"{k}:{version_of(p)}") for k, p in rules.items()])
    order = F.create_map(*[x for i, k in enumerate(rules) for x in (F.lit(k), F.lit(i))])
    hits = F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), order[F.col("rule")].alias("ord"), s["end"].alias("end"), F.col("rule").alias("kind")))
    return (ledger.filter(F.array_contains(now, F.concat_ws(":", "rule", "version")) & (F.size("spans") > 0))
            .select("blob", hits.alias("hits"))
            .groupBy("blob").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("hits")))).alias("hits")))


def scan(docs: DataFrame, ledger_path: str, rules: dict[str, str] = RULES, text: str = "text") -> DataFrame:
    """``docs`` with its blob address and ``hits`` (start, ord, end, kind) joined back from the ledger."""
    found = findings(update_ledger(docs, ledger_path, rules, text), rules)
    return join_back(docs, found, text)


def join_back(docs: DataFrame, found: DataFrame, text: str = "text") -> DataFrame:
    """Findings on every path; a plain equi-join, whose hot blobs adaptive execution splits."""
    paths = docs.select(F.struct("*").alias("row"), blob_of(text).alias("blob"))
    none = F.expr("cast(array() as array<struct<start:int,ord:int,end:int,kind:string>>)")
    return paths.join(found, "blob", "left").select("row", "blob", F.coalesce("hits", none).alias("hits"))


def redacted(t: Column, hits: Column) -> Column:
    """``t`` with ``[SECRET]`` for each run of overlapping ``hits`` (start, end), which are in order of start.

    Hits go in about sqrt(m) blocks; each block works on its own piece of the
    text, as finding a place in a text costs as much as the text before it.
    """
    size = F.greatest(F.lit(8), F.ceil(F.sqrt(F.size(hits)))).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(hits) - 1) / size).cast("int")),
                         lambda b: F.slice(hits, b * size + 1, size))

    def reach(ends: Column, block: Column) -> Column:  # where each block's piece ends; the first entry is 0
        return F.concat(ends, F.array(F.greatest(F.element_at(ends, -1), F.array_max(F.transform(block, lambda s: s["end"])))))

    def put(piece: Column, begin: Column, acc: Column, s: Column) -> Column:  # acc.at: code points written or covered
        gap = F.substr(piece, acc["at"] - begin + 1, s["start"] - acc["at"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(
            s["start"] >= acc["at"], F.concat(acc["out"], gap, F.lit("[SECRET]"))).otherwise(acc["out"]).alias("out"))

    def written(block: Column, begin: Column, stop: Column) -> Column:
        return C.once(F.substr(t, begin + 1, stop - begin), lambda piece: F.aggregate(
            block, F.struct(begin.alias("at"), F.lit("").alias("out")), lambda acc, s: put(piece, begin, acc, s))["out"])

    def joined(bs: Column, ends: Column) -> Column:
        pieces = F.zip_with(bs, F.arrays_zip(F.slice(ends, 1, F.size(bs)).alias("a"), F.slice(ends, 2, F.size(bs)).alias("z")),
                            lambda block, e: written(block, e["a"], e["z"]))
        return F.concat(F.array_join(pieces, ""), F.substr(t, F.element_at(ends, -1) + 1))

    return C.once(blocks, lambda bs: C.once(F.aggregate(bs, F.array(F.lit(0)), reach), lambda ends: joined(bs, ends)))


def redact(docs: DataFrame, ledger_path: str, rules: dict[str, str] = RULES) -> DataFrame:
    """``docs`` with every found span replaced by ``[SECRET]`` (overlapping spans by one); n_chars follows the text."""
    found = scan(docs, ledger_path, rules)
    t = F.col("row.text")
    text = F.when(F.size("hits") > 0, redacted(t, F.col("hits"))).otherwise(t)
    fresh = found.select("row", text.alias("fresh"))
    cols = []
    for c in docs.columns:
        col = F.col("row").getField(c)
        if c == "text":
            col = F.col("fresh")
        elif c == "n_chars":
            col = F.when(F.col("fresh").eqNullSafe(t), col).otherwise(F.length("fresh").cast("long"))
        cols.append(col.alias(c))
    return fresh.select(*cols)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract rows: counts, digest of the base spans, and all spans, for every document.

    Starts from an empty ledger in the shared checkpoint folder, so that the
    result depends on the documents alone.
    """
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    found = findings(update_ledger(docs, C.scratch(spark, "ledger")))
    base = F.filter("hits", lambda s: s["kind"].isin(*BASE))
    count = lambda k: F.size(F.filter("hits", lambda s: s["kind"] == k)).cast("long")
    digest = found.select(
        "blob", *[count(k).alias(f"n_{k}") for k in BASE], F.sha2(C.span_text(base), 256).alias("base_sha256"),
        C.span_text(F.col("hits")).alias("spans"), count("github").alias("n_github"), count("pem").alias("n_pem"))
    paths = docs.select("doc_id", blob_of().alias("blob")).join(digest, "blob", "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return paths.select(
        "doc_id", *[zero(f"n_{k}") for k in BASE],
        F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"), zero("n_github"), zero("n_pem"),
        F.lower(F.hex("blob")).alias("blob"))
