"""Secret scans through an incremental blob ledger, DataFrame functions only.

Every version of every path is content-addressed (SHA-256 of its text).  The
ledger keeps which (blob, rule, rule version) pairs were scanned and what they
gave.  ``BlobLedger.update`` scans only pairs that are not in the ledger, each
blob once however many paths carry it; ``paths_with_findings`` joins findings
back to all paths.  Findings are appended before the pairs, and read distinct,
so an update that died half way is repeated without harm.

Defined results
---------------
* null text: empty, no finding; null path ids are ordinary versions;
* repeated rows: one blob, and one result row per input row;
* spans: code points, end exclusive, leftmost non-overlapping per rule;
* empty table: empty result; columns other than id and text are ignored by
  the scan and passed through unchanged by ``redact``.

Skew: the text travels once, keyed by (blob, carrier id), which is unique per
blob; the join back has one row per path and plain tables on both sides, so a
blob that a third of all paths carry is split by the skew join.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from listenlens.llm.common import scratch_path, text_or_empty, written


@dataclass(frozen=True)
class Rule:
    """``pattern`` must not match the empty string.  ``maybe``: a cheap necessary
    condition on the text; ``holds``: whether a match counts."""
    kind: str
    version: int
    pattern: str
    maybe: Callable[[Column], Column] | None = None
    holds: Callable[[Column], Column] | None = None


ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE_RULES = (
    Rule("assign", 1, ASSIGN, holds=lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 12),
    Rule("access", 1, r"AKIA[A-Z0-9]+", maybe=lambda t: t.contains("AKIA"), holds=lambda m: F.length(m) >= 18),
    Rule("hex", 1, r"[0-9a-f]{16,}"),  # greedy runs: the same spans as [0-9a-f]+ of 16 or more
)
#: Further spans: private key headers, signed web tokens, prefixed service tokens.
MORE_RULES = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----", maybe=lambda t: t.contains("PRIVATE KEY-----")),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", maybe=lambda t: t.contains(".eyJ")),
    Rule("service", 1, r"(?:ghp|gho|ghs|glpat|xoxb|xoxp)[_-][A-Za-z0-9-]{20,}",
         maybe=lambda t: t.rlike(r"gh[pos]_|glpat-|xox[bp]-")),
)
RULES = BASE_RULES + MORE_RULES

SCANNED = T.StructType([T.StructField("blob", T.StringType()), T.StructField("kind", T.StringType()),
                        T.StructField("version", T.IntegerType())])
FINDINGS = T.StructType([*SCANNED.fields, T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


def versions(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(path, blob, content)`` for every row."""
    return docs.select(F.col(id_column).alias("path"), text_or_empty(text).alias("content")).withColumn(
        "blob", F.sha2(F.col("content"), 256))


class BlobLedger:
    """Scanned pairs and findings as two Parquet tables under ``path``."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or scratch_path(spark, "ledger")
        for name, schema in (("scanned", SCANNED), ("findings", FINDINGS)):  # empty tables for a new ledger
            spark.createDataFrame([], schema).coalesce(1).write.mode("append").parquet(f"{self.path}/{name}")

    def scanned(self) -> DataFrame:
        return self.spark.read.schema(SCANNED).parquet(f"{self.path}/scanned").distinct()

    def findings(self, rules=RULES) -> DataFrame:
        """Distinct findings of the given rules at their versions."""
        return self.spark.read.schema(FINDINGS).parquet(f"{self.path}/findings").where(
            F.concat_ws(":", "kind", "version").isin([f"{r.kind}:{r.version}" for r in rules])).distinct()

    def update(self, contents: DataFrame, rules=RULES) -> None:
        """Scan the unseen (blob, rule version) pairs of ``versions`` rows."""
        carriers = contents.groupBy("blob").agg(F.min("path").alias("carrier"))
        pairs = carriers.select("blob", "carrier", F.explode(F.array(*(
            F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules))).alias("r"))
        unseen = pairs.select("blob", "carrier", "r.kind", "r.version").join(
            self.scanned(), ["blob", "kind", "version"], "left_anti")
        todo = written(unseen.groupBy("blob", "carrier").agg(
            F.collect_set(F.struct("kind", "version")).alias("rules")), "ledger-todo")  # at most len(rules)
        texts = contents.join(todo.withColumnRenamed("blob", "_b"), (F.col("blob") == F.col("_b"))
                              & F.col("path").eqNullSafe(F.col("carrier"))).select("blob", "rules", "content")
        spans(texts, rules).hint("rebalance").write.mode("append").parquet(f"{self.path}/findings")
        todo.select("blob", F.inline("rules")).select(*SCANNED.names).write.mode("append").parquet(
            f"{self.path}/scanned")


def spans(texts: DataFrame, rules=RULES) -> DataFrame:
    """Findings of ``(blob, rules, content)`` rows.

    ``split`` gives what lies between the matches and ``regexp_extract_all`` the
    matches, so running sums of their lengths are the code point positions.
    """
    text = F.col("content")
    per_rule = []
    for r in rules:
        wanted = F.array_contains(F.col("rules"), F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")))
        wanted = wanted & r.maybe(text) if r.maybe else wanted
        wanted = wanted & text.rlike(r.pattern)
        per_rule.append(F.when(wanted, F.struct(
            F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"),
            F.transform(F.split(text, r.pattern, -1), F.length).alias("gaps"),
            F.regexp_extract_all(text, F.lit(r.pattern), F.lit(0)).alias("hits"))))
    found = texts.select("blob", F.explode(F.array_compact(F.array(*per_rule))).alias("f"))
    rows = found.select("blob", "f.kind", "f.version", F.posexplode(F.arrays_zip("f.gaps", "f.hits")).alias("i", "x")).select(
        "blob", "kind", "version", "i", F.col("x.gaps").alias("gap"), F.col("x.hits").alias("hit")).where(
        F.col("hit").isNotNull()).distinct()  # rows that repeat id and text carry a blob twice
    through = W.partitionBy("blob", "kind", "version").orderBy("i").rowsBetween(W.unboundedPreceding, 0)
    end = F.sum((F.col("gap") + F.length("hit")).cast("long")).over(through)
    holds = F.lit(True)
    for r in rules:
        if r.holds:
            holds = F.when(F.col("kind") == r.kind, r.holds(F.col("hit"))).otherwise(holds)
    return rows.withColumn("end", end).where(holds).select(
        "blob", "kind", "version", (F.col("end") - F.length("hit")).alias("start"), "end").distinct()


def _joined(spans_: Column) -> Column:
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def paths_with_findings(contents: DataFrame, ledger: BlobLedger, rules=RULES) -> DataFrame:
    """``(path, n_<base kind>..., base_sha256, spans)`` for every version row."""
    order = F.create_map(*(F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)))
    found = ledger.findings(rules).withColumn("o", order[F.col("kind")])
    base = [r.kind for r in BASE_RULES]
    per_blob = found.groupBy("blob").agg(
        F.array_sort(F.collect_list(F.struct("start", "o", "end", "kind"))).alias("s"),
        *(F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in base))
    is_base = F.filter("s", lambda x: x["o"] < len(base))
    per_blob = written(per_blob.select(
        "blob", *(f"n_{k}" for k in base), _joined(is_base).alias("base"), _joined(F.col("s")).alias("spans")), "ledger-blobs")
    return contents.select("path", "blob").join(per_blob, "blob", "left").select(
        "path", *(F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in base),
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))


def scan(docs: DataFrame, ledger: BlobLedger | None = None, rules=RULES,
         id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Bring the ledger up to date with ``docs``, then the findings of every row."""
    ledger = ledger or BlobLedger(docs.sparkSession)
    contents = versions(docs, id_column, text)
    ledger.update(contents, rules)
    return paths_with_findings(contents, ledger, rules)


def redact(docs: DataFrame, ledger: BlobLedger | None = None, rules=RULES, mark: str = "[SECRET]",
           id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every span (overlapping ones as one) replaced by ``mark``;
    a column ``n_chars``, if there is one, holds the new length of changed texts."""
    ledger = ledger or BlobLedger(docs.sparkSession)
    ledger.update(versions(docs, id_column, text), rules)
    before = W.partitionBy("blob").orderBy("start", "end").rowsBetween(W.unboundedPreceding, -1)
    island = W.partitionBy("blob").orderBy("start", "end").rowsBetween(W.unboundedPreceding, 0)
    cuts = (ledger.findings(rules).select("blob", "start", "end").distinct()
            .withColumn("new", (F.col("start") > F.coalesce(F.max("end").over(before), F.lit(-1))).cast("int"))
            .withColumn("island", F.sum("new").over(island))
            .groupBy("blob", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
            .groupBy("blob").agg(F.array_sort(F.collect_list(F.struct(
                F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end")))).alias("cuts")))
    short = lambda blob: F.unhex(F.substring(blob, 1, 32))  # noqa: E731  128 bits keep the table small
    cuts = written(cuts.select(short(F.col("blob")).alias("blob"), "cuts"), "ledger-cuts")
    names = [f"c{i}" for i in range(len(docs.columns))]
    body = names[docs.columns.index(text)]
    rows = docs.toDF(*names).withColumn(
        "blob", short(F.sha2(text_or_empty(body), 256))).join(cuts, "blob", "left")
    # what stays: before the first cut, between cuts, after the last
    ends = F.concat(F.array(F.lit(0)), F.transform("cuts", lambda c: c["end"]))
    starts = F.concat(F.transform("cuts", lambda c: c["start"]), F.array(F.length(body)))
    kept = F.transform(F.arrays_zip(ends.alias("a"), starts.alias("b")), lambda p: F.substring(
        F.col(body), p["a"] + 1, p["b"] - p["a"]))
    clean = F.when(F.col("cuts").isNotNull(), F.array_join(kept, mark)).otherwise(F.col(body))
    rows = rows.withColumn(body, clean)
    if "n_chars" in docs.columns:
        n = names[docs.columns.index("n_chars")]
        rows = rows.withColumn(n, F.when(F.col("cuts").isNotNull(), F.length(body).cast(docs.schema["n_chars"].dataType))
                               .otherwise(F.col(n)))
    return rows.select(*names).toDF(*docs.columns)
