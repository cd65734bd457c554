"""Toxicity scores: a linear classifier over character n-grams that are scaled by
naive Bayes log-count ratios.

A text's features are its distinct character n-grams (3 to 5 code points of the
lower-cased text, white space as one blank), present or not.  On a bounded sample
of labelled rows every n-gram gets the ratio r = log((p / Σp) / (q / Σq)) of its
smoothed document counts under label 1 (p) and label 0 (q).  The n-grams whose
ratio stands out of its noise form the model;
a logistic regression with an L2 penalty is fitted on the values r of the n-grams
present.  Scoring looks all n-grams of the whole text up by their 64-bit hashes.

Defined results
---------------
* null or empty text: no n-gram, so the score is the sigmoid of the intercept;
* null labels and labels without a document are not used; equal ids: each document
  row with a label is a training row; equal texts with equal labels train once;
* fewer than two classes in the sample: a constant score, the share of label 1
  (0.5 without labels);
* null ids: scored, held out (no remainder, never trained on);
* repeated rows: one result row per row; empty table: empty result; other
  columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listenlens.llm.common import map_batches, py_texts, written

#: Share of held-out rows: remainder 0 of crc32(id as text) modulo FOLDS.
FOLDS = 5
#: Lengths of the n-grams.
SIZES = (3, 4, 5)
#: A hash's leading bits name its slot; a model has one n-gram per slot at most.
SLOT_BITS = 22
#: Code points hashed at once, and hashes that a counting task adds up at once.
SLICE, BLOCK = 1 << 18, 1 << 20

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def gram_hashes(text: str) -> Iterator[np.ndarray]:
    """64-bit hashes of the n-grams of a text, slice by slice; slices overlap so that
    no n-gram is lost."""
    text = f" {' '.join(text.lower().split())} "
    for at in range(0, max(1, len(text) - SIZES[-1] + 1), SLICE):
        part = text[at:at + SLICE + SIZES[-1] - 1].encode("utf-32-le", "surrogatepass")
        points = (np.frombuffer(part, np.uint32).astype(np.uint64) + np.uint64(1)) * _MIX
        points ^= points >> np.uint64(32)
        rolled = points
        for n in range(2, min(SIZES[-1], len(points)) + 1):
            rolled = rolled[:-1] * _STEP + points[n - 1:]
            if n in SIZES:
                yield (rolled ^ (rolled >> np.uint64(29))) * _MIX


@dataclass(frozen=True)
class Model:
    """``hashes``, sorted, with one weight each (ratio times coefficient)."""
    intercept: float
    hashes: np.ndarray
    weights: np.ndarray


class Lookup:
    """Finds a model's n-grams among hashes: a table of slots, then the whole hash."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.slots = np.full(1 << SLOT_BITS, -1, np.int32)
        self.slots[hashes >> np.uint64(64 - SLOT_BITS)] = np.arange(len(hashes), dtype=np.int32)

    def present(self, text: str) -> np.ndarray:
        """Distinct places, ascending, of the model's n-grams that the text has."""
        found = [np.zeros(0, np.int32)]
        for h in gram_hashes(text):
            at = self.slots[h >> np.uint64(64 - SLOT_BITS)]
            hit = at >= 0
            at, h = at[hit], h[hit]
            found.append(at[self.hashes[at] == h])
        return np.unique(np.concatenate(found))


def remainder(id_column: str) -> Column:
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % FOLDS


def sample(docs: DataFrame, labels: DataFrame, id_column: str, text: str, label: str, max_rows: int) -> tuple[DataFrame, dict]:
    """``(label, weight, text)``: at most ``max_rows`` / 2 labelled rows of each class outside
    the held-out fold, by a hash of their id, weighted to the classes' shares; and the shares."""
    usable = labels.where(F.col(label).isin(0, 1) & F.col(id_column).isNotNull() & (remainder(id_column) != 0)).select(
        F.col(id_column).alias("_id"), F.col(label).cast("int").alias("_label"))
    sizes = {r["_label"]: r["n"] for r in usable.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    parts = [usable.where(F.col("_label") == c).orderBy(F.xxhash64("_id"), "_id").limit(max_rows // 2)
             .withColumn("_weight", F.lit(float(max(1.0, n / (max_rows // 2))))) for c, n in sizes.items()]
    if not parts:
        return usable.select(F.col("_label").alias("label"), F.lit(1.0).alias("weight"), F.lit("").alias("text")), {}
    chosen = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    chosen = written(chosen, "toxicity-labels")
    rows = docs.select(F.col(id_column).alias("_id"), F.col(text).cast("string").alias("_text")).join(
        F.broadcast(chosen), "_id")  # at most max_rows ids
    rows = rows.select(F.col("_label").alias("label"), F.col("_weight").alias("weight"), F.col("_text").alias("text"))
    # copies count once: thousands of one text would make all of its n-grams stand out
    rows = rows.groupBy("text", "label").agg(F.max("weight").alias("weight")).select("label", "weight", "text")
    return written(rows, "toxicity-texts", few=False), sizes


def gram_counts(rows: DataFrame) -> DataFrame:
    """``(h, p, q)``: weighted numbers of label 1 and label 0 texts with each n-gram,
    summed in the tasks before the shuffle."""
    schema = T.StructType([T.StructField("h", T.LongType()), T.StructField("p", T.DoubleType()), T.StructField("q", T.DoubleType())])

    def summed(found: list) -> pa.RecordBatch:
        h, at = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
        side, weight = (np.repeat([f[k] for f in found], [len(f[0]) for f in found]) for k in (1, 2))
        return pa.RecordBatch.from_arrays([
            pa.array(h.view(np.int64)), pa.array(np.bincount(at, weight * (side == 1), len(h))),
            pa.array(np.bincount(at, weight * (side == 0), len(h)))], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, size = [], 0
            for label, weight, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), py_texts(batch.column(2))):
                h = np.unique(np.concatenate([np.zeros(0, np.uint64), *gram_hashes(text)]))
                found.append((h, label, weight))
                size += len(h)
                if size >= BLOCK:
                    yield summed(found)
                    found, size = [], 0
            if found:
                yield summed(found)

    return map_batches(rows, run, schema).groupBy("h").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))


def ratios(counts: DataFrame, least: float, stands_out: float, max_grams: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, sorted, and log-count ratios of the n-grams that ``least`` texts have and whose
    ratio is ``stands_out`` times its standard error; at most ``max_grams``, those that
    stand out most."""
    p, q, often = F.col("p") + 1.0, F.col("q") + 1.0, F.col("p") + F.col("q") >= least
    sums = counts.agg(F.sum(p).alias("p"), F.sum(q).alias("q")).first()
    r = F.log(p / sums["p"]) - F.log(q / sums["q"])
    slot = F.shiftrightunsigned("h", 64 - SLOT_BITS)
    scored = counts.where(often).select("h", r.alias("r"), F.abs(r / F.sqrt(1 / p + 1 / q)).alias("z"))
    best = scored.where(F.col("z") >= stands_out).groupBy(slot.alias("slot")).agg(F.max(F.struct("z", "h", "r")).alias("b")).select("b.*")
    rows = best.orderBy(F.desc("z"), "h").limit(max_grams).select("h", "r").collect()
    h = np.array([r["h"] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(h)
    return h[order], np.array([r["r"] for r in rows], float)[order]


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "toxic",
        max_rows: int = 16_000, least: float = 5, stands_out: float = 4.0, max_grams: int = 16_384,
        penalty: float = 0.03) -> Model:
    """Train on at most ``max_rows`` labelled rows; the model has at most ``max_grams`` n-grams."""
    rows, sizes = sample(docs, labels, id_column, text, label, max_rows)
    none = np.zeros(0, np.uint64), np.zeros(0)
    share = sizes.get(1, 0) / sum(sizes.values()) if sizes else 0.5
    if 0 < share < 1:
        classes = {r["label"] for r in rows.select("label").distinct().collect()}
        share = share if len(classes) == 2 else next(iter(classes), share)
    if not 0 < share < 1 or not sizes:
        return Model(math.log((share + 1e-3) / (1 - share + 1e-3)), *none)
    hashes, r = ratios(written(gram_counts(rows), "toxicity-counts"), least, stands_out, max_grams)
    if not len(hashes):
        return Model(math.log(share / (1 - share)), *none)
    width = len(hashes)
    schema = T.StructType([T.StructField("label", T.DoubleType()), T.StructField("weight", T.DoubleType()),
                           T.StructField("i", T.ArrayType(T.IntegerType())), T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = Lookup(hashes)
        for batch in batches:
            found = [look.present(t) for t in py_texts(batch.column(2))]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).cast(pa.float64()), batch.column(1), pa.array([f.astype(np.int32) for f in found], pa.list_(pa.int32())),
                pa.array([r[f] for f in found], pa.list_(pa.float64()))], names=schema.names)

    vector = F.udf(lambda i, x: SparseVector(width, i, x), VectorUDT())  # of the bounded sample only
    train = written(map_batches(rows, run, schema), "toxicity-train", few=False)
    linear = LogisticRegression(regParam=penalty, elasticNetParam=0.0, maxIter=60, standardization=False, weightCol="weight").fit(
        train.select("label", "weight", vector("i", "x").alias("features")))
    return Model(float(linear.intercept), hashes, linear.coefficients.toArray() * r)


def judge(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", threshold: float = 0.5,
          **training) -> DataFrame:
    """``(id, held_out, score, predicted)`` of every row."""
    model = fit(docs, labels, id_column, text, **training)
    source = docs.select(F.col(id_column).alias("id"), F.col(text).cast("string").alias("_text"))
    schema = T.StructType([source.schema["id"], T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look = Lookup(model.hashes)
        for batch in batches:
            z = np.array([model.intercept + model.weights[look.present(t)].sum() for t in py_texts(batch.column(1))])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -700, 700))), pa.float64())],
                                             names=schema.names)

    scored = map_batches(source, run, schema)
    return scored.select(F.col("id").alias(id_column), F.coalesce(remainder("id") == 0, F.lit(True)).alias("held_out"),
                         "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
