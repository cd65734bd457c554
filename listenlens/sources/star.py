"""Adapter from the driver's star-schema test tables to the music tables.

| music table   | built from                                                       |
|---------------|------------------------------------------------------------------|
| triplets      | orders ⋈ lineitem: user = o_custkey, song = l_partkey,          |
|               | play_count = CAST(sum(l_quantity) AS BIGINT)                     |
| tracks        | part: track_id = song_id = p_partkey, artist = p_brand,          |
|               | title = p_name                                                   |
| genres        | part: track_id = p_partkey, genre = p_type                       |
| postings      | documents: track_id = doc_id, tokens of lower(text) split on     |
|               | [^a-z]+, empty dropped, counted                                  |
| vocabulary    | distinct tokens, 1-based index in token order                    |
| word vectors  | embeddings: vector of the (vec_id+1)-th most frequent token      |
| labels        | labels.quality as the class of a document                        |

Ids are strings, as in the music files.  Every table is derived by Spark from
the whole input tables, so the work grows with them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from listenlens.functions.indexing import dense_index
from listenlens.operators.skew import split_join
from listenlens.session import map_batches, materialize

# Fixed values of the adapter (they must equal the oracle's):
# theme lexicon over function words of the test prose, and the stop words.
ADAPTER_THEMES = {
    "love": ["this", "from", "with", "was"],
    "war": ["are", "by", "be", "as"],
    "happiness": ["at", "on", "for", "it"],
}
ADAPTER_STOP_WORDS = ["the", "of", "and", "to", "a", "in", "is", "that"]

TOKEN_SPLIT = "[^a-z]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def triplets(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return (items.join(orders, items.l_orderkey == orders.o_orderkey)
            .groupBy("o_custkey", "l_partkey")
            .agg(F.sum("l_quantity").cast("bigint").alias("play_count"))
            .select(F.col("o_custkey").cast("string").alias("user_id"),
                    F.col("l_partkey").cast("string").alias("song_id"),
                    "play_count"))


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey").cast("string")
    return part.select(key.alias("track_id"), key.alias("song_id"),
                       F.col("p_brand").alias("artist"), F.col("p_name").alias("title"))


def releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracks where songs of parts over size 25 have a second one, ``R`` and the key."""
    part = table(spark, sf_dir, "part").where("p_size > 25")
    key = F.col("p_partkey").cast("string")
    return tracks(spark, sf_dir).unionByName(part.select(
        F.concat(F.lit("R"), key).alias("track_id"), key.alias("song_id"), F.col("p_brand").alias("artist"),
        F.concat("p_name", F.lit(" (again)")).alias("title")))


def styles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genres of ``releases``: the part's type, for every third size the brand as well."""
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey").cast("string")
    named = F.when(F.col("p_size") % 3 == 0, F.array("p_type", "p_brand")).otherwise(F.array("p_type"))
    ids = F.when(F.col("p_size") > 25, F.array(key, F.concat(F.lit("R"), key))).otherwise(F.array(key))
    return part.select(F.explode(ids).alias("track_id"), named.alias("genre")).select("track_id", F.explode("genre").alias("genre"))


def track_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracks rendered as ``<SEP>`` lines (input of the line parser)."""
    t = tracks(spark, sf_dir)
    return t.select(F.concat_ws("<SEP>", "track_id", "song_id", "artist", "title").alias("value"))


def triplet_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plays rendered as TSV lines (input of the triplet parser)."""
    return triplets(spark, sf_dir).select(
        F.concat_ws("\t", "user_id", "song_id", F.col("play_count").cast("string")).alias("value"))


def genre_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genre-file lines built from ``part``: per part one ``track<TAB>genre``
    line, one ``#`` comment line and one malformed three-field line
    (``track<TAB>genre<TAB>brand``) that the reader drops."""
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey").cast("string")
    good = part.select(F.concat_ws("\t", key, "p_type").alias("value"))
    comment = part.select(F.concat(F.lit("# part "), key).alias("value"))
    bad = part.select(F.concat_ws("\t", key, "p_type", "p_brand").alias("value"))
    return good.unionByName(comment).unionByName(bad)


def genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select(F.col("p_partkey").cast("string").alias("track_id"),
                       F.col("p_type").alias("genre"))


def tokens(spark: SparkSession, sf_dir: str, string_ids: bool = True) -> DataFrame:
    """One row per token occurrence: ``(track_id, word)``.  With
    ``string_ids=False`` the id stays the numeric ``doc_id`` (cheaper keys for
    aggregations; cast afterwards)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    tid = F.col("doc_id").cast("string") if string_ids else F.col("doc_id")
    return (docs.select(tid.alias("track_id"),
                        F.explode(F.split(F.lower("text"), TOKEN_SPLIT)).alias("word"))
            .where(F.col("word") != ""))


def token_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens as postings with ``count = 1`` and numeric ``track_id``."""
    return tokens(spark, sf_dir, string_ids=False).withColumn("count", F.lit(1))


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bag of words: ``(track_id, word, count)``; map-side combined word count
    on the numeric id, cast to string after the aggregation."""
    return (tokens(spark, sf_dir, string_ids=False).groupBy("track_id", "word")
            .agg(F.count(F.lit(1)).alias("count"))
            .select(F.col("track_id").cast("string").alias("track_id"), "word", "count"))


def vocabulary(spark: SparkSession, sf_dir: str, stop_words=ADAPTER_STOP_WORDS, rows: DataFrame | None = None) -> DataFrame:
    """``(word_index, word, is_stop)``, index 1-based in word order; ``rows``: written
    postings of all documents, where a caller has them."""
    words = (rows if rows is not None else tokens(spark, sf_dir, string_ids=False)).select("word").distinct()
    indexed = dense_index(words, ["word"], name="word_index", base=1)
    return indexed.select(F.col("word_index").cast("int").alias("word_index"), "word",
                          F.col("word").isin(list(stop_words)).alias("is_stop"))


def indexed_postings(spark: SparkSession, sf_dir: str, vocab: DataFrame | None = None,
                     split: bool = False, rows: DataFrame | None = None) -> DataFrame:
    """Postings in the lyrics-file form ``(track_id, word_index, count)``; ``split``:
    with the words of very many documents dealt over several tasks; ``rows``: written
    postings to index instead of all documents'."""
    vocab = (vocab if vocab is not None else vocabulary(spark, sf_dir)).select("word", "word_index")
    if split:
        rows = rows if rows is not None else materialize(postings(spark, sf_dir))  # read by the pass that names the words and by the join
        return split_join(rows, vocab, "word").select("track_id", "word_index", "count")
    return (rows if rows is not None else postings(spark, sf_dir)).join(vocab, "word").select("track_id", "word_index", "count")


#: Words of the vocabulary header: the most frequent ones, as in the lyrics file.
HEADER_WORDS = 5_000


def header_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(pos, word)``: the ``HEADER_WORDS`` most frequent words, 0-based, by count
    desc, then word."""
    freq = tokens(spark, sf_dir, string_ids=False).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    order = [F.desc("n"), F.asc("word")]
    return freq.orderBy(*order).limit(HEADER_WORDS).select(  # a small table: numbered in one task
        (F.row_number().over(Window.orderBy(*order)) - 1).alias("pos"), "word")


def vocabulary_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lyrics file's head: a comment line and the ``%`` line of its words."""
    line = header_words(spark, sf_dir).agg(F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("w")).select(
        F.concat(F.lit("%"), F.array_join(F.transform("w", lambda x: x["word"]), ",")).alias("value"))
    return line.unionByName(line.select(F.lit("# vocabulary above").alias("value")))


def lyrics_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lyrics file's body: ``track,other id,index:count,...`` lines with 1-based
    indices into the whole vocabulary, and a comment line for each document."""
    bags = indexed_postings(spark, sf_dir).groupBy("track_id").agg(
        F.array_sort(F.collect_list(F.struct(F.col("word_index").alias("i"), "count"))).alias("b"))
    pairs = F.transform("b", lambda x: F.concat_ws(":", x["i"].cast("string"), x["count"].cast("string")))
    body = bags.select(F.concat_ws(",", "track_id", F.lit("0"), F.array_join(pairs, ",")).alias("value"))
    return body.unionByName(bags.select(F.concat(F.lit("# "), F.col("track_id")).alias("value")))


def _cut(texts: pa.Array, stop_words: pa.Array) -> pa.Array:
    """The runs of a-z of every text but the stop words, found in the texts' bytes."""
    texts = pa.concat_arrays([texts.cast(pa.string())])
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    ends -= ends[0]
    letter = data - np.uint8(97) < 26  # other bytes wrap to larger ones
    before, after = np.zeros((2, len(letter) + 1), bool)  # a letter of the same text
    before[1:], after[:-2] = letter, letter[1:]
    before[ends[:-1]] = False
    after[ends[1:][ends[1:] > 0] - 1] = False
    begin = np.flatnonzero(letter & ~before[:-1])
    lens = np.flatnonzero(letter & ~after[:-1]) + 1 - begin
    places = np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(lens), pa.py_buffer(places), pa.py_buffer(data[letter]))
    keep = pc.invert(pc.is_in(words, value_set=stop_words))
    kept = np.concatenate([[0], np.cumsum(keep.to_numpy(zero_copy_only=False))])
    return pa.ListArray.from_arrays(pa.array(kept[np.searchsorted(begin, ends)].astype(np.int32)), words.filter(keep))


def word_lists(spark: SparkSession, sf_dir: str, stop_words=ADAPTER_STOP_WORDS, ids: DataFrame | None = None) -> DataFrame:
    """``(track_id, words)``: each document's tokens without stop words; ``ids``: of the documents
    with these ``track_id`` only, the others' texts are not cut."""
    stops = pa.array(list(stop_words), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["track_id"], _cut(batch["text"], stops)], names=["track_id", "words"])

    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("track_id"), "text")
    if ids is not None:
        texts = texts.join(ids.select("track_id"), "track_id", "left_semi")
    return map_batches(texts.select("track_id", F.lower("text").alias("text")), run, "track_id string, words array<string>")


def word_frequency_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(word, freq_rank)``: 0-based rank by total count desc, word asc."""
    freq = tokens(spark, sf_dir, string_ids=False).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return dense_index(freq, [F.desc("n"), F.asc("word")], name="freq_rank").select("word", "freq_rank")


def word_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(word, vector)``: embedding ``vec_id`` belongs to the word of frequency rank ``vec_id``."""
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    ranks = word_frequency_rank(spark, sf_dir)
    return (emb.join(ranks, emb.vec_id == ranks.freq_rank)
            .select("word", F.col("embedding").alias("vector")))


def theme_lexicon(spark: SparkSession, themes: dict | None = None) -> DataFrame:
    from listenlens.operators.themes import lexicon_df
    return lexicon_df(spark, themes or ADAPTER_THEMES)


def document_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(track_id, label)`` from ``labels.quality``."""
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("track_id"), F.col("quality").cast("string").alias("label"))
