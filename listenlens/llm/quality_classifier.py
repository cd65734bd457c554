"""Quality scores by a sparse rule ensemble.

A random forest over text statistics is grown on a bounded sample of labelled
documents; every path from a root to a node becomes a conjunctive rule (upper
and lower bounds of statistics).  A lasso logistic regression weighs the rules,
and those with a weight compile into one Spark column: the sigmoid of the sum of
the weights of the rules that hold.  Scoring covers whole texts of all rows.

Defined results
---------------
* null or empty text: its statistics are 0 and it is scored as any other;
* null labels and labels without document are not used; equal ids: each
  document row with a label is a training row;
* fewer than two classes in the sample: a constant score, the share of label 1
  (0.5 without labels);
* null ids: scored, held out (no remainder, never trained on);
* repeated rows: one result row per row; empty table: empty result; other
  columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listenlens.llm.common import map_batches, py_texts, written
from listenlens.llm.quality_rules import TextStats

#: Share of held-out rows: remainder 0 of crc32(id as text) modulo FOLDS.
FOLDS = 5


def _statistics(s: TextStats) -> dict[str, float]:
    n, chars, lines = max(1, s.n_words), max(1, len(s.text)), max(1, len(s.lines))
    count = s.byte_counts
    share = lambda x, of: float(x) / of
    return {
        "n_words": float(s.n_words), "mean_word": share(s.word_chars, n), "symbols": share(s.n_symbols, n),
        "repeated_lines": share(s.n_dup_lines, lines), "repeated_words": share(s.n_repeat_words, n),
        "distinct_words": share(len(set(s.words)), n), "upper": share(s.n_upper, chars), "lower": share(s.n_lower, chars),
        "digits": share(count[48:58].sum(), chars), "stops": share(count[46] + count[63], n),
        "bangs": share(count[33], n), "commas": share(count[44], n), "words_per_line": share(s.n_words, lines),
        "bytes_per_char": share(len(s.raw), chars),
    }


STATISTICS = tuple(_statistics(TextStats("")))


def statistics(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, <statistics>)`` of every row."""
    source = docs.select(F.col(id_column).alias("id"), F.col(text).alias("_text"))
    schema = T.StructType([source.schema["id"]] + [T.StructField(n, T.DoubleType()) for n in STATISTICS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [tuple(_statistics(TextStats(t)).values()) for t in py_texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0)] + [pa.array(c, pa.float64()) for c in zip(*rows)],
                                             names=schema.names)

    return map_batches(source, run, schema)


@dataclass(frozen=True)
class Rule:
    """Bounds ``low < statistic <= high`` that all hold."""
    bounds: tuple[tuple[str, float, float], ...]

    def column(self) -> Column:
        holds = F.lit(True)
        for name, low, high in self.bounds:
            if low > -math.inf:
                holds = holds & (F.col(name) > low)
            if high < math.inf:
                holds = holds & (F.col(name) <= high)
        return holds


def path_rules(tree: str, names) -> list[Rule]:
    """The conjunction of every path of a tree, from Spark's text form of it."""
    rules, path = [], []
    for line in tree.splitlines():
        found = re.match(r"(\s*)(If|Else) \(feature (\d+) (<=|>) ([-+\d.eE]+)\)", line)
        if not found:
            continue
        depth = len(found[1])
        path = [p for p in path if p[0] < depth] + [(depth, names[int(found[3])], found[4], float(found[5]))]
        bounds: dict[str, tuple[float, float]] = {}
        for _, name, side, value in path:
            low, high = bounds.get(name, (-math.inf, math.inf))
            bounds[name] = (max(low, value), high) if side == ">" else (low, min(high, value))
        rules.append(Rule(tuple(sorted((n, *b) for n, b in bounds.items()))))
    return rules


@dataclass(frozen=True)
class RuleEnsemble:
    intercept: float
    weighted: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        """Probability of label 1 as a column over the statistics."""
        z = F.lit(self.intercept)
        for rule, weight in self.weighted:
            z = z + F.when(rule.column(), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-z))


def remainder(id_column: str) -> Column:
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % FOLDS


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "quality",
        max_rows: int = 20_000, trees: int = 12, depth: int = 4, penalty: float = 0.001, seed: int = 11) -> RuleEnsemble:
    """Train on at most ``max_rows`` labelled rows outside the held-out fold, taken
    by a hash of their id."""
    chosen = labels.where(F.col(label).isNotNull() & F.col(id_column).isNotNull() & (remainder(id_column) != 0)).select(
        F.col(id_column).alias("id"), F.col(label).cast("double").alias("label")).orderBy(F.xxhash64("id"), "id").limit(max_rows)
    sample = written(chosen, "quality-labels")
    found = docs.join(sample.select(F.col("id").alias("_id")).distinct(), F.col(id_column) == F.col("_id"), "left_semi")
    train = written(statistics(found, id_column, text).join(sample, "id"), "quality-train", few=False)
    classes = {r["label"]: r["n"] for r in train.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(classes) < 2:
        share = next(iter(classes), 0.5)
        return RuleEnsemble(math.log((share + 1e-3) / (1 - share + 1e-3)), ())
    assembled = train.select("label", array_to_vector(F.array(*STATISTICS)).alias("features"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, minInstancesPerNode=10, subsamplingRate=0.7,
                                    seed=seed).fit(assembled)
    rules = list(dict.fromkeys(r for t in forest.trees for r in path_rules(t.toDebugString, STATISTICS)))
    if not rules:
        return RuleEnsemble(math.log(classes[1.0] / classes[0.0]), ())
    holds = written(train.select("label", F.array(*(r.column().cast("double") for r in rules)).alias("x")), "quality-rules")
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=50, standardization=True).fit(
        holds.select("label", array_to_vector("x").alias("features")))
    return RuleEnsemble(float(lasso.intercept), tuple(
        (r, float(w)) for r, w in zip(rules, lasso.coefficients.toArray()) if abs(w) > 1e-9))


def judge(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", threshold: float = 0.3,
          **training) -> DataFrame:
    """``(id, held_out, score, predicted)`` of every row."""
    model = fit(docs, labels, id_column, text, **training)
    scored = statistics(docs, id_column, text).withColumn("score", model.score())
    return scored.select(F.col("id").alias(id_column), F.coalesce(remainder("id") == 0, F.lit(True)).alias("held_out"),
                         "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
