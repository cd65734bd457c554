"""URL filters: rule lists, and a classifier on segmented hosts for the rest.

Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; path: then up to ``?``, ``#`` or the end.  A rule (host, path) fits
its host and all subdomains when the url's path starts with the rule's path; the
longest fitting rule decides.  Other urls go to the classifier:

* a unigram model (counts of all words of 2 to 24 letters in the visible text of
  all pages, plus the seed words) splits concatenated names into words by the
  Viterbi algorithm;
* multinomial naive Bayes over the segmented host words and the path words.  Its
  classes come from distant supervision: a url whose segmented host holds a seed
  word of the unwanted topics counts as blocked.  Counts cover all urls.

The word counts are a Spark table without a limit.  The substrings of the distinct
host labels meet it by equality, and each label is split with the counts of its own
substrings; no task holds the dictionary.  Bayes has ``buckets`` hashed features.

Defined results
---------------
* null url or no ``://``: host and path empty, no rule, allowed;
* a url without words has no evidence and gets the verdict of the prior;
* visible text: titles and bodies without tags, comments, scripts and styles, which
  end at the text's end if nothing closes them; tags and character references end words;
* repeated rows and equal or null ids: one result row per row;
* rules of equal length that both fit: the first listed;
* empty table: empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listenlens.llm.common import map_batches, py_texts, text_or_empty, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/"))
# Words that mark hosts of unwanted topics.
SEEDS = """adult bet bets betting casino cheap dating escort farm gambling jackpot loan loans lottery
naked nude pharmacy pill pills poker porn replica sex slots spam torrent viagra warez win xxx""".split()
#: Count that a seed word has at least in the unigram model.
SEED_COUNT = 1000
WORD = re.compile(r"[a-z]+")
#: Letters of a known word, at least and at most.
SHORTEST, LONGEST = 2, 24
HIDDEN = (r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b.*?(?:</\1[^>]*>?|\z)|</?[a-z!?][^<>]*>?"
          r"|&(?:[a-z][a-z0-9]{0,31}|#[0-9]{1,8}|#x[0-9a-f]{1,8});")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null."""
    best = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2]))[::-1]:  # the longest is asked first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        best = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(best)
    return best


class Segmenter:
    """Unigram Viterbi: the most probable split of a name into words."""

    def __init__(self, counts: dict[str, int], longest: int = LONGEST, total: int | None = None):
        """``total``: of all counts, where ``counts`` holds some of them."""
        total = total or sum(counts.values()) or 1
        self.cost = {w: math.log(total / n) for w, n in counts.items()}
        self.total, self.longest = total, longest

    def _word_cost(self, word: str) -> float:
        known = self.cost.get(word)
        # an unknown word is charged more for each letter
        return known if known is not None else math.log(self.total) + 2.5 * len(word)

    def split(self, name: str) -> tuple[str, ...]:
        best: list[tuple[float, int]] = [(0.0, 0)]
        for end in range(1, len(name) + 1):
            best.append(min((best[a][0] + self._word_cost(name[a:end]), a)
                            for a in range(max(0, end - self.longest), end)))
        words, end = [], len(name)
        while end:
            words.append(name[best[end][1]:end])
            end = best[end][1]
        return tuple(reversed(words))


def features(words: list[str], path: str) -> list[str]:
    """Tagged words of a segmented host and a path."""
    return [f"h:{w}" for w in words] + [f"p:{w}" for w in WORD.findall(path.lower())]


_SEED_SET = frozenset(SEEDS)


def letters(text: Column) -> Column:
    """Runs of a-z, in their order."""
    return F.array_remove(F.split(text, r"[^a-z]+"), "")


def address_of(text: Column) -> Column:
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))  # 128 bits


def dictionary(pages: DataFrame, html: str) -> DataFrame:
    """``(w, n)``: how often each word is in the visible text of all pages, and the seeds."""
    visible = F.regexp_replace(text_or_empty(html), HIDDEN, " ")
    words = pages.select(F.explode(letters(F.lower(visible))).alias("w")).where(
        F.length("w").between(SHORTEST, LONGEST)).withColumn("c", F.lit(1))
    seeds = pages.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, SEEDS))).alias("w"), F.lit(0).alias("c"))
    n = F.sum("c")
    return words.unionByName(seeds).groupBy("w").agg(
        F.when(F.col("w").isin(SEEDS), F.greatest(n, F.lit(SEED_COUNT))).otherwise(n).alias("n"))


def segments(labels: DataFrame, words: DataFrame, total: int) -> DataFrame:
    """``(label, words)`` of distinct labels."""
    keyed = labels.withColumn("k", address_of(F.col("label")))
    size = F.length("label")
    starts = keyed.where(size >= SHORTEST).select("k", "label", F.explode(F.sequence(F.lit(1), size - SHORTEST + 1)).alias("i")).select(
        "k", F.col("label").substr(F.col("i"), F.lit(LONGEST)).alias("tail"))
    parts = starts.select("k", "tail", F.explode(F.sequence(F.lit(SHORTEST), F.length("tail"))).alias("m")).select(
        "k", F.col("tail").substr(F.lit(1), F.col("m")).alias("w"))
    known = parts.join(words, "w").groupBy("k").agg(F.collect_set(F.struct("w", "n")).alias("known"))
    schema = T.StructType([T.StructField("label", T.StringType()), T.StructField("words", T.ArrayType(T.StringType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = [Segmenter({x["w"]: x["n"] for x in counts.as_py() or ()}, total=total).split(label)
                     for label, counts in zip(py_texts(batch.column(0)), batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(split, pa.list_(pa.string()))], names=schema.names)

    return map_batches(keyed.join(known, "k", "left").select("label", "known"), run, schema)


def segmented(urls: DataFrame, words: DataFrame) -> DataFrame:
    """``urls`` with the ``words`` of their hosts, written."""
    total = words.agg(F.sum("n")).first()[0]
    hosts = urls.select("host").distinct().select(address_of(F.col("host")).alias("h"), F.posexplode(letters(F.col("host"))).alias("i", "label"))
    hosts = written(hosts, "url-labels")
    split = segments(hosts.select("label").distinct(), words, total)
    of_host = hosts.join(split, "label").groupBy("h").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("i", "words"))), lambda x: x["words"])).alias("words"))
    return written(urls.withColumn("h", address_of(F.col("host"))).join(of_host, "h", "left").select(
        *urls.columns, F.coalesce("words", F.array().cast("array<string>")).alias("words")), "url-words")


def train(urls: DataFrame, buckets: int, smoothing: float = 0.01) -> tuple[np.ndarray, float]:
    """Log odds of each hashed feature (additive smoothing), and of the classes."""
    schema = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("label", T.IntegerType()),
                           T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, buckets + 1), np.int64)  # the last: urls
        for batch in batches:
            for words, path in zip(batch.column(0).to_pylist(), py_texts(batch.column(1))):
                bad = not _SEED_SET.isdisjoint(words)
                for w in features(words, path):
                    seen[int(bad), crc32(w.encode()) % buckets] += 1
                seen[int(bad), buckets] += 1
        label, bucket = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(label, pa.int32()),
                                          pa.array(seen[label, bucket])], names=schema.names)

    table = np.zeros((2, buckets + 1))
    for r in map_batches(urls.select("words", "path"), run, schema).groupBy("bucket", "label").agg(F.sum("n").alias("n")).collect():
        table[r["label"], r["bucket"]] = r["n"]  # at most 2 * (buckets + 1) rows
    smooth = table[:, :-1] + smoothing
    odds = np.log(smooth[1] / smooth[1].sum()) - np.log(smooth[0] / smooth[0].sum())
    return odds, float(np.log(table[1, -1] + 1) - np.log(table[0, -1] + 1))


def judge(pages: DataFrame, rules=RULES, id_column: str = "page_id", url: str = "url", html: str = "html",
          buckets: int = 1 << 16) -> DataFrame:
    """``(id, host, path, rule, verdict, score)`` of every row; score: the
    classifier's log odds for blocking, whatever the rules say."""
    link = F.col(url).cast("string")
    urls = pages.select(F.col(id_column).alias("id"), host_of(link).alias("host"), path_of(link).alias("path"))
    urls = segmented(urls, written(dictionary(pages, html), "url-dictionary"))
    odds, prior = train(urls, buckets)
    schema = T.StructType([urls.schema["id"], T.StructField("host", T.StringType()), T.StructField("path", T.StringType()),
                           T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [prior + sum(odds[crc32(w.encode()) % buckets] for w in features(words, path))
                      for path, words in zip(py_texts(batch.column(2)), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(scores, pa.float64())], names=schema.names)

    scored = map_batches(urls, run, schema).withColumn("r", longest_rule(F.col("host"), F.col("path"), rules))
    by_score = F.when((F.col("score") > 0) & (F.col("host") != ""), "block").otherwise("allow")
    return scored.select(F.col("id").alias(id_column), "host", "path", F.col("r.rule").alias("rule"),
                         F.coalesce("r.verdict", by_score).alias("verdict"), "score")
