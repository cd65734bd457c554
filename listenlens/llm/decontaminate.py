"""Benchmark decontamination by size-partitioned MinHash containment search.

Texts are lower-cased and cut into words of letters and digits; an item's
shingles are its distinct runs of ``shingle`` words (of all its words, if it has
fewer).  A document contains an item when at least ``threshold`` of the item's
shingles occur in it.

Search
    Items with the same shingles are one text, named by a 128-bit hash of them, so
    repeated or null item ids decide nothing.  Texts are partitioned by their
    number of shingles (powers of two).  Each text is represented by its k smallest shingle hashes (a bottom-k MinHash
    sketch), k = u - ceil(threshold * u) + 1 for the partition's largest size u.  A
    document that holds enough of the text's shingles misses fewer than k, so it
    holds one of the sketch at least: no pair is lost, at any document length.
    The shingle hashes of whole documents meet the sketches by equality.

Verification
    Candidate pairs are compared by the shingles themselves (strings); the texts
    found are mapped back to the items that have them.

DataFrame functions only.  The sketch table is joined by Spark's own choice: it
is broadcast only when its measured size is below the session's threshold.

Defined results
---------------
* null or empty texts: no shingle, in no pair (items and documents);
* repeated rows and equal ids: one result row per (id, item) pair, with the
  largest containment of the rows that share the ids (equal ones: the most shingles);
* null ids (of documents and items) are kept as such; empty tables give no pairs;
* other columns are ignored by ``contained`` and passed through by ``remove``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from listenlens.llm.common import text_or_empty, written

SHINGLE, THRESHOLD = 5, 0.8
NOT_WORD = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), NOT_WORD), "")


def shingle_hashes(hashes: Column, size: int) -> Column:
    """Hash of each run of ``size`` words, from the words' own hashes."""
    return F.when(F.size(hashes) >= size, F.transform(
        F.sequence(F.lit(0), F.size(hashes) - size),
        lambda i: F.xxhash64(F.lit(size), *(F.get(hashes, i + j) for j in range(size))))).otherwise(
            F.array().cast("array<bigint>"))


def shingle_texts(words_: Column, size: Column) -> Column:
    """Distinct runs of ``size`` words, space-joined."""
    return F.when((size > 0) & (F.size(words_) >= size), F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.size(words_) - size + 1), lambda i: F.array_join(F.slice(words_, i, size), " ")))).otherwise(
            F.array().cast("array<string>"))


def item_shingles(items: DataFrame, item_column: str, text: str, shingle: int) -> DataFrame:
    """``(item, key, size, shingles)`` of items with a word; size: words per
    shingle, key: a 128-bit hash of the shingles (words hold no line feed)."""
    w = items.select(F.col(item_column).alias("item"), words(text_or_empty(text)).alias("w")).where(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(shingle))
    cut = w.select("item", size.alias("size"), shingle_texts(F.col("w"), size).alias("shingles"))
    key = F.unhex(F.substring(F.sha2(F.array_join("shingles", "\n"), 256), 1, 32))
    return cut.select("item", key.alias("key"), "size", "shingles")


def address(text: Column) -> Column:
    """128 bits that stand for a text."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def sketches(texts: DataFrame, threshold: float, sizes: list[int]) -> DataFrame:
    """``(h, key)``: the bottom-k hashes of each distinct text, k by size partition."""
    bound = F.pow(F.lit(2), F.ceil(F.log2(F.size("shingles").cast("double"))))  # largest size of the partition
    # a little below the product, so that rounding never makes k too small
    k = bound - F.ceil(bound * F.lit(threshold) - F.lit(1e-9)) + 1
    word_hashes = F.transform(F.split("s", " "), lambda x: F.xxhash64(x))
    h = F.coalesce(*(F.when(F.col("size") == n, F.element_at(shingle_hashes(F.col("wh"), n), 1)) for n in sizes))
    rows = texts.select("key", "size", k.alias("k"), F.explode("shingles").alias("s")).select(
        "key", "size", "k", word_hashes.alias("wh")).select("key", "k", h.alias("h"))
    rank = F.row_number().over(W.partitionBy("key").orderBy("h"))
    return rows.withColumn("r", rank).where(F.col("r") <= F.col("k")).select("h", "key").distinct()


def _needed(n_shingles: Column, threshold: float) -> Column:
    return F.ceil(n_shingles * F.lit(threshold) - F.lit(1e-9))


def candidates(source: DataFrame, items: DataFrame, item_column: str, item_text: str, shingle: int,
               threshold: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(id, key)`` pairs of ``(id, text)`` rows that share a sketch hash, the items'
    distinct texts ``(key, size, shingles)``, both written, and who has them,
    ``(key, item)``."""
    of_item = written(item_shingles(items, item_column, item_text, shingle), "leak-items")
    texts = written(of_item.select("key", "size", "shingles").dropDuplicates(["key"]), "leak-texts")
    sizes = sorted(r["size"] for r in texts.select("size").distinct().collect()) or [shingle]  # ``shingle`` values at most
    sketch = written(sketches(texts, threshold, sizes), "leak-sketch")
    hashed = source.select("id", F.transform(words(F.col("text")), lambda x: F.xxhash64(x)).alias("wh"))
    found = hashed.select("id", F.explode(F.concat(*(shingle_hashes(F.col("wh"), n) for n in sizes))).alias("h"))
    pairs = written(found.join(sketch, "h").select("id", "key").distinct(), "leak-candidates")
    return pairs, texts, of_item.select("key", "item").distinct()


def contained(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text: str = "text",
              item_column: str = "item_id", item_text: str = "text", shingle: int = SHINGLE,
              threshold: float = THRESHOLD) -> DataFrame:
    """``(id, item, n_shared, n_shingles, containment)`` of contained items."""
    source = docs.select(F.col(id_column).alias("id"), text_or_empty(text).alias("text")).withColumn("address", address(F.col("text")))
    # texts are found by their address: null or repeated ids meet no other texts
    pairs, texts, owners = candidates(source.select(F.col("address").alias("id"), "text"), items, item_column, item_text,
                                      shingle, threshold)
    text_of = pairs.withColumnRenamed("id", "address").join(source, "address").select("id", "key", words(F.col("text")).alias("w"))
    shared = F.size(F.array_intersect("shingles", shingle_texts(F.col("w"), F.col("size"))))
    verified = text_of.join(texts, "key").select(
        "id", "key", shared.cast("long").alias("n_shared"), F.size("shingles").cast("long").alias("n_shingles"))
    hits = verified.where(F.col("n_shared") >= _needed(F.col("n_shingles"), threshold)).groupBy("id", "key").agg(
        F.max("n_shared").alias("n_shared"), F.max("n_shingles").alias("n_shingles"))  # a key has one n_shingles
    best = F.max(F.struct((F.col("n_shared") / F.col("n_shingles")).alias("containment"), "n_shared", "n_shingles"))
    return hits.join(owners, "key").groupBy("id", "item").agg(best.alias("b")).select(
        "id", "item", "b.n_shared", "b.n_shingles", "b.containment")


def remove(docs: DataFrame, items: DataFrame, text: str = "text", item_column: str = "item_id", item_text: str = "text",
           shingle: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without those that contain an item, all columns unchanged.  Rows
    are judged by their text, so repeated or null ids decide nothing.  The texts
    meet their candidate items' shingles in one join, where they are verified."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    body = text_or_empty(names[docs.columns.index(text)])
    keyed = docs.toDF(*names).withColumn("_text", body).withColumn("_address", address(body))
    pairs, texts, _ = candidates(keyed.select(F.col("_address").alias("id"), F.col("_text").alias("text")), items,
                                item_column, item_text, shingle, threshold)
    asked = pairs.join(texts, "key").groupBy("id").agg(F.collect_list(F.struct("size", "shingles")).alias("_asked"))
    # the one-element array binds a text's words once, for all of its shingles
    leaks = F.exists(F.array(words(F.col("_text"))), lambda w: F.exists("_asked", lambda a: F.size(F.array_intersect(
        a["shingles"], shingle_texts(w, a["size"]))) >= _needed(F.size(a["shingles"]), threshold)))
    kept = keyed.join(asked, F.col("_address") == F.col("id"), "left").where(F.col("_asked").isNull() | ~leaks)
    return kept.select(*names).toDF(*docs.columns)
