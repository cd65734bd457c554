"""Periodic runs of words by online dyadic square catching.

The words of a text are appended one by one.  For every level k the completed
blocks of B = 2^k words (at multiples of B) act as catchers: the left half of any
square whose half is p words long, 2B - 1 <= p < 4B - 1, holds such a block, and its
copy stands p words later.  So a block waits for its copy over 2B places; at any
time two blocks a level are waiting.  Names of the last B words (equal names: equal
words) are kept level by level, and where the name at the end of the text is a
waiting block's, the distance p becomes a suffix comparison: extended backwards
once, then advanced by each appended word until a word differs from the one p
before it.  A comparison that has matched p words is a square; all squares that it
passes merge into one run, which is reported when the comparison ends.  Inside a
comparison of period d no multiple of d is started.

Only runs of at least ``least_words`` words and ``least_periods`` periods are wanted;
each of their words occurs ``least_periods`` times in them, each two neighbours once
less, so stretches are cut beforehand at words and between neighbours that are rarer
in the stretch (no run holds them).

Defined results
---------------
* null or empty text, or one without words: no run, digests of empty strings;
* null ids: the words are left as they are (``tiled`` has no number to draw from);
* repeated rows: one result row per row; empty table: empty result; other columns
  are ignored; of equally long runs the first, then that of the smaller period.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listenlens.llm.common import map_batches, py_texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Run(NamedTuple):
    start: int
    length: int
    period: int


class SquareCatcher:
    """Appends words and reports the runs of at least two periods as they end."""

    def __init__(self, longest_period: int):
        self.words: list = []
        # level k: names of the 2^k words that end at each place (None: too few words),
        # and the names known by the names of their halves
        self.levels = [([None] * ((1 << k) - 1), {}, 1 << k) for k in range(max(1, (longest_period + 1).bit_length() - 1))]
        self.matched: dict[int, int] = {}  # period -> first matching place of its comparison

    def append(self, word) -> list[Run]:
        words, matched, t = self.words, self.matched, len(self.words)
        words.append(word)
        runs = []
        for p in [p for p in matched if words[t - p] != word]:
            runs += self._close(p, t)
        name, below = word, None
        for names, known, block in self.levels:
            start = t + 1 - block
            if block > 1:
                if start < 0:
                    break
                pair = below[t - (block >> 1)], name
                name = known.get(pair)
                if name is None:  # new words: no block has this name
                    known[pair] = name = len(known)
                    names.append(name)
                    below = names
                    continue
            names.append(name)
            below = names
            # the waiting blocks: s + p = start of the copy, 2 * block - 1 <= p <= 4 * block - 2
            s = (start + 1 - 2 * block) // block * block
            if s >= 0:
                if names[s + block - 1] == name and start - s not in matched:
                    self._start(start - s, s)
                s -= block
                if s >= 0 and names[s + block - 1] == name and start - s not in matched and start - s <= 4 * block - 2:
                    self._start(start - s, s)
        return runs

    def _start(self, p: int, s: int) -> None:
        """Compare suffixes at distance ``p``: the block at ``s`` has its copy at ``s + p``."""
        for d, first in self.matched.items():
            if p % d == 0 and first - d <= s:
                return
        words, first = self.words, s + p
        while first > p and words[first - 1] == words[first - 1 - p]:
            first -= 1
        self.matched[p] = first

    def _close(self, p: int, t: int) -> list[Run]:
        first = self.matched.pop(p)
        return [Run(first - p, t - first + p, p)] if t - first >= p else []

    def finish(self) -> list[Run]:
        """The runs that the end of the text ends."""
        return [r for p in list(self.matched) for r in self._close(p, len(self.words))]


def stretches(words: Sequence, least: int, size: int) -> list[tuple[int, int]]:
    """The maximal stretches of at least ``size`` words in which every word occurs
    ``least`` times and every two neighbours stand together once less often: those that
    cuts leave, again and again."""
    found, open_ = [], [(0, len(words))]
    while open_:
        a, b = open_.pop()
        part = words[a:b]
        counts = Counter(part)
        if min(counts.values(), default=0) < least:
            often = {w for w, n in counts.items() if n >= least}
            cut = re.finditer(b"\x01{%d,}" % size, bytes([w in often for w in part]))
            open_ += [(a + m.start(), a + m.end()) for m in cut]
            continue
        counts = Counter(zip(part, part[1:]))
        if b - a >= size and min(counts.values(), default=least) >= least - 1:
            found.append((a, b))
            continue
        often = {w for w, n in counts.items() if n >= least - 1}
        cut = re.finditer(b"\x01{%d,}" % max(1, size - 1), bytes([w in often for w in zip(part, part[1:])]))
        open_ += [(a + m.start(), a + m.end() + 1) for m in cut]
    return sorted(found)


def find_runs(words: Sequence, least_words: int = 6, least_periods: int = 4) -> list[Run]:
    """All maximal runs of ``least_periods`` (2 or more) smallest periods and ``least_words``
    words, by start, then period."""
    found = []
    for a, b in stretches(words, least_periods, least_words):
        catcher = SquareCatcher((b - a) // least_periods)
        for word in words[a:b]:
            found += [(a, r) for r in catcher.append(word)]
        found += [(a, r) for r in catcher.finish()]
    runs = (Run(a + r.start, r.length, r.period) for a, r in found)
    return sorted(r for r in runs if r.length >= max(least_words, least_periods * r.period))


def tiled(words: list[str], doc_id) -> list[str]:
    """Every tenth document by crc32 of its id has its tail replaced by repeats: word i >= a
    becomes word a + (i - a) % p.  a and p are drawn from the same number."""
    n = len(words)
    if doc_id is None or not n:
        return words
    g, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if rest:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def collapsed(words: list[str], runs: Sequence[Run]) -> list[str]:
    """The words without those that a run holds after its first period."""
    kept, at = [], 0
    for a, b in sorted((r.start + r.period, r.start + r.length) for r in runs):
        if a > at:
            kept += words[at:a]
        at = max(at, b)
    return kept + words[at:]


def _hex(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


NUMBERS = ("n_runs", "start", "length", "period", "exponent_milli")
TEXTS = ("runs_sha256", "collapsed_sha256", "collapsed")


def detect(docs: DataFrame, id_column: str = "doc_id", text: str = "text", least_words: int = 6, least_periods: int = 4,
           tile=None, with_text: bool = False) -> DataFrame:
    """Per row: id, number of runs, the longest run, digests of all runs and of the
    collapsed text; with ``with_text`` the collapsed text too.  ``tile(words, id)`` may
    change the words first."""
    source = docs.select(F.col(id_column).alias("_id"), F.col(text).cast("string").alias("_text"))
    fields = [T.StructField(c, T.LongType()) for c in NUMBERS] + [
        T.StructField(c, T.StringType()) for c in (TEXTS if with_text else TEXTS[:2])]
    schema = T.StructType([source.schema["_id"], *fields])

    def row(doc_id, whole: str) -> tuple:
        words = WORD.findall(whole)
        words = tile(words, doc_id) if tile else words
        runs = find_runs(words, least_words, least_periods)
        best = min(runs, key=lambda r: (-r.length, r.start, r.period), default=None)
        longest = (*best, 1000 * best.length // best.period) if best else (None,) * 4
        kept = " ".join(collapsed(words, runs) if runs else words)
        listed = "".join(f"{r.start},{r.length},{r.period}\n" for r in runs)
        return len(runs), *longest, _hex(listed), _hex(kept), *([kept] if with_text else ())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [row(i, t) for i, t in zip(batch.column(0).to_pylist(), py_texts(batch.column(1)))]
            yield pa.RecordBatch.from_arrays([batch.column(0)] + [
                pa.array([r[k] for r in rows], pa.int64() if k < len(NUMBERS) else pa.string()) for k in range(len(fields))],
                names=schema.names)

    return map_batches(source, run, schema).withColumnRenamed("_id", id_column)
