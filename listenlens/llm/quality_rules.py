"""Quality rules as a short-circuit cascade.

Every rule is a predicate over lazily computed statistics of one text; a
document is kept when no rule rejects it.  Each rule's cost and rejections are
measured on a bounded sample, the rules are ordered greedily by rejections per
second among the documents that earlier rules let pass, and evaluation of a
document stops at its first rejection.  The order changes the work only: the
verdict is "no rule rejects" in any order.

Defined results
---------------
* null or empty text: zero words, rejected by ``few_words``;
* words are maximal runs without space and U+0009-U+000D, so texts of other
  Unicode spaces are one word;
* repeated rows and equal ids: one result row per input row;
* empty table: empty result; the cascade keeps the given order of rules;
* other columns: ``filter_documents`` passes all columns through unchanged,
  ``report`` returns the id and the statistics only;
* ties in the order: the rule listed first goes first.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listenlens.llm.common import map_batches, py_texts

SYMBOLS = b"#*$%&|<>"
SPACES = b"\t\n\v\f\r "
WINDOW = 8


class TextStats:
    """Statistics of one text, each computed when first asked for."""

    def __init__(self, text: str):
        self.text = text
        self.raw = text.encode("utf-8", "surrogatepass")

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()  # splits at exactly space and \\t\\n\\v\\f\\r

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def byte_counts(self) -> np.ndarray:
        return np.bincount(np.frombuffer(self.raw, np.uint8), minlength=256)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - int(sum(self.byte_counts[c] for c in SPACES))

    @cached_property
    def n_symbols(self) -> int:
        return int(sum(self.byte_counts[c] for c in SYMBOLS))

    @cached_property
    def lines(self) -> list[bytes]:
        """Lines with a word."""
        return [x for x in self.raw.split(b"\n") if x.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_upper(self) -> int:
        return int(self.byte_counts[65:91].sum())

    @cached_property
    def n_lower(self) -> int:
        return int(self.byte_counts[97:123].sum())

    @cached_property
    def n_stutters(self) -> int:
        """Words equal to the word before."""
        return sum(map(eq, self.words, self.words[1:]))

    @cached_property
    def n_repeat_words(self) -> int:
        return repeated_window_words(self.words, WINDOW)


def repeated_window_words(words: list[bytes], size: int) -> int:
    """Words inside windows of ``size`` (a power of two) words that occur twice
    or more.  Exact: windows get ranks by doubling (pairs of half-size ranks)."""
    n = len(words)
    if n <= size:
        return 0
    ids: dict[bytes, int] = {}
    rank = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    if len(ids) > n - size:  # too few repeated words for two equal windows
        return 0
    half = 1
    while half < size:
        pair = rank[:-half] * n + rank[half:]
        _, rank = np.unique(pair, return_inverse=True)
        half *= 2
    again = np.bincount(rank)[rank] > 1
    edge = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(again)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + size, -1)
    return int((np.cumsum(edge)[:n] > 0).sum())


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[TextStats], bool]


def few_words(s: TextStats) -> bool:
    return s.n_words < 20


def repeated_windows(s: TextStats) -> bool:
    return 100 * s.n_repeat_words > 30 * s.n_words


def many_symbols(s: TextStats) -> bool:
    return 10 * s.n_symbols > s.n_words


def repeated_lines(s: TextStats) -> bool:
    return 2 * s.n_dup_lines > len(s.lines)


def stuttering(s: TextStats) -> bool:
    return 100 * s.n_stutters > 30 * s.n_words


def odd_word_length(s: TextStats) -> bool:
    return not 2 * s.n_words <= s.word_chars <= 12 * s.n_words


def shouting(s: TextStats) -> bool:
    return 10 * s.n_upper > 4 * (s.n_upper + s.n_lower) and s.n_upper + s.n_lower >= 20


BASE_RULES = (Rule("few_words", few_words), Rule("repeated_windows", repeated_windows))
RULES = BASE_RULES + (Rule("many_symbols", many_symbols), Rule("repeated_lines", repeated_lines),
                      Rule("odd_word_length", odd_word_length), Rule("shouting", shouting), Rule("stuttering", stuttering))


def rejected_by(stats: TextStats, rules) -> str | None:
    """Name of the first rejecting rule; later rules are not evaluated."""
    return next((r.name for r in rules if r.rejects(stats)), None)


def measure(docs: DataFrame, rules=RULES, text: str = "text", sample_rows: int = 2000,
            sample_fraction: float = 0.05, seed: int = 7) -> list[dict]:
    """Measured on the executors over at most ``sample_rows`` sampled rows: one
    entry per combination of rejecting rules (a bit mask) with its count and the
    seconds each rule took.  At most 2^rules small rows reach the driver."""
    rules = tuple(rules)
    schema = T.StructType([T.StructField("mask", T.LongType())]
                          + [T.StructField(f"s{i}", T.DoubleType()) for i in range(len(rules))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks, took = [], [[] for _ in rules]
            for t in py_texts(batch.column(0)):
                mask = 0
                for i, r in enumerate(rules):
                    began = time.perf_counter()
                    mask |= int(r.rejects(TextStats(t))) << i  # fresh: the rule alone
                    took[i].append(time.perf_counter() - began)
                masks.append(mask)
            yield pa.RecordBatch.from_arrays([pa.array(masks, pa.int64())] + [pa.array(x, pa.float64()) for x in took],
                                             names=schema.names)

    sample = docs.select(text).sample(False, sample_fraction, seed).limit(sample_rows)
    return [r.asDict() for r in map_batches(sample, run, schema).groupBy("mask").agg(
        F.count("*").alias("n"), *(F.sum(f"s{i}").alias(f"s{i}") for i in range(len(rules)))).collect()]


def cascade_order(rules, measured: list[dict]) -> tuple[Rule, ...]:
    """Greedy order by rejections per second among the rows still unrejected."""
    rules, order, left = tuple(rules), [], measured
    cost = [sum(m[f"s{i}"] for m in measured) + 1e-9 for i in range(len(rules))]
    open_ = list(range(len(rules)))
    while open_:
        best = max(open_, key=lambda i: (sum(m["n"] for m in left if m["mask"] >> i & 1) / cost[i], -i))
        order.append(rules[best])
        open_.remove(best)
        left = [m for m in left if not m["mask"] >> best & 1]
    return tuple(order)


def filter_documents(docs: DataFrame, rules=RULES, text: str = "text", **sampling) -> DataFrame:
    """The documents that no rule rejects, all columns unchanged."""
    order = cascade_order(rules, measure(docs, rules, text, **sampling))
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [rejected_by(TextStats(t), order) is None for t in py_texts(batch.column(at))]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return map_batches(docs, run, docs.schema)


REPORT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def report(docs: DataFrame, rules=RULES, id_column: str = "doc_id", text: str = "text", **sampling) -> DataFrame:
    """Per document: the statistics, whether a base rule fails, the cascade's verdict."""
    order = cascade_order(rules, measure(docs, rules, text, **sampling))
    source = docs.select(F.col(id_column).alias(id_column), F.col(text).alias("_text"))
    schema = T.StructType([source.schema[id_column]] + [T.StructField(n, T.LongType()) for n in REPORT]
                          + [T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t in py_texts(batch.column(1)):
                s = TextStats(t)
                kept, failed = rejected_by(s, order) is None, few_words(s) or repeated_windows(s)
                rows.append((*(getattr(s, n) for n in REPORT), failed, kept and not failed))
            columns = list(zip(*rows)) or [()] * (len(schema) - 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array(c, pa.int64() if i < len(REPORT) else pa.bool_()) for i, c in enumerate(columns)],
                names=schema.names)

    return map_batches(source, run, schema)
