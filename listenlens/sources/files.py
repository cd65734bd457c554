"""Readers for the raw music files.

All readers declare their schema; nothing is inferred.  Text formats are read
with ``spark.read.text`` and split with built-in expressions so that a line is
parsed inside whole-stage codegen, and a file is split across tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRIPLET_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("song_id", T.StringType()),
    T.StructField("play_count", T.IntegerType()),
])

THEME_SET_SCHEMA = T.StructType([
    T.StructField("track_id", T.StringType()),
    T.StructField("theme", T.StringType()),
    T.StructField("theme_ratio", T.DoubleType()),
])

TRACK_FIELDS = ("track_id", "song_id", "artist", "title")
TRACK_SEPARATOR = "<SEP>"


def read_triplets(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated ``user_id, song_id, play_count`` without header."""
    return spark.read.schema(TRIPLET_SCHEMA).option("sep", "\t").option("header", "false").csv(path)


def parse_triplet_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """S1 on a column of text lines (same schema and separator as the reader)."""
    parsed = F.from_csv(F.col(column), TRIPLET_SCHEMA.simpleString(), {"sep": "\t"})
    return lines.select(parsed.alias("_t")).select("_t.*")


def parse_track_lines(lines: DataFrame, column: str = "value",
                      fields=TRACK_FIELDS) -> DataFrame:
    """Split ``track<SEP>song<SEP>artist<SEP>title`` lines.

    A missing part becomes NULL (``get`` is NULL-safe out of range), extra
    parts are ignored.  ``fields`` may be a prefix of the four names, which
    prunes the rest.
    """
    parts = F.split(F.col(column), TRACK_SEPARATOR)
    return lines.select(*[F.get(parts, i).alias(name) for i, name in enumerate(fields)])


def read_tracks(spark: SparkSession, path: str, fields=TRACK_FIELDS) -> DataFrame:
    return parse_track_lines(spark.read.text(path), fields=fields)


def parse_genre_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """``track_id<TAB>genre``; ``#`` comment lines and rows that do not have
    exactly two fields are dropped (filtered before projection, so column
    pruning cannot change the row count)."""
    parts = F.split(F.col(column), "\t")
    return (lines.where(~F.col(column).startswith("#") & (F.trim(F.col(column)) != ""))
            .where(F.size(parts) == 2)
            .select(F.get(parts, 0).alias("track_id"), F.get(parts, 1).alias("genre")))


def read_genres(spark: SparkSession, path: str) -> DataFrame:
    return parse_genre_lines(spark.read.text(path))


def _is_data_line(c):
    return ~(c.startswith("%") | c.startswith("#")) & (c != "")


def parse_lyrics_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """``track_id,other_id,idx:count,...`` → long ``(track_id, word_index, count)``.

    ``%`` and ``#`` lines are not data; ``idx`` is 1-based into the vocabulary.
    A track without postings yields no row.
    """
    line = F.trim(F.col(column))
    # the fields are cut before the explode: beside it they would be cut again for every posting
    fields = (lines.select(line.alias("line")).where(_is_data_line(F.col("line")))
              .select(F.get(F.split("line", ","), 0).alias("track_id"),
                      F.expr("slice(split(line, ','), 3, greatest(size(split(line, ',')) - 2, 0))").alias("ps")))
    postings = fields.select("track_id", F.explode("ps").alias("p"))
    # try_cast: a malformed ``idx:count`` becomes NULL instead of failing the job
    # under ANSI mode; ``bad_postings`` counts them
    return postings.select(
        "track_id",
        F.split_part("p", F.lit(":"), F.lit(1)).try_cast("int").alias("word_index"),
        F.split_part("p", F.lit(":"), F.lit(2)).try_cast("int").alias("count"),
    )


def bad_postings(postings: DataFrame) -> DataFrame:
    """Rows of ``parse_lyrics_lines`` whose ``idx:count`` did not parse."""
    return postings.where(F.col("word_index").isNull() | F.col("count").isNull())


def read_lyrics(spark: SparkSession, path: str) -> DataFrame:
    return parse_lyrics_lines(spark.read.text(path))


def parse_vocabulary_line(lines: DataFrame, stop_words, column: str = "value") -> DataFrame:
    """The ``%`` header line is the comma list of words; index is 1-based
    and the first token is always ``i``.  ``is_stop`` marks stop words."""
    header = lines.where(F.col(column).startswith("%")).select(
        F.split(F.trim(F.col(column)).substr(F.lit(2), F.length(column)), ",").alias("words"))
    exploded = header.select(F.posexplode("words").alias("pos", "word"))
    word = F.when(F.col("pos") == 0, F.lit("i")).otherwise(F.col("word"))
    stop = [str(w) for w in stop_words]
    return exploded.select(
        (F.col("pos") + 1).cast("int").alias("word_index"),
        word.alias("word"),
        word.isin(stop).alias("is_stop"),
    )


def read_vocabulary(spark: SparkSession, path: str, stop_words) -> DataFrame:
    return parse_vocabulary_line(spark.read.text(path), stop_words)


def read_theme_sets(spark: SparkSession, path: str) -> DataFrame:
    """Headerless ``track_id,theme,theme_ratio``."""
    return spark.read.schema(THEME_SET_SCHEMA).option("header", "false").csv(path)


def read_word_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Parquet ``(word string, vector array<float>)``."""
    return spark.read.parquet(path).select("word", "vector")


def train_word_vectors(sentences: DataFrame, column: str = "words", size: int = 64,
                       seed: int = 42, min_count: int = 1) -> DataFrame:
    """Train word vectors with Spark ML's Word2Vec; ``(word, vector)``."""
    from pyspark.ml.feature import Word2Vec
    from pyspark.ml.functions import vector_to_array
    model = Word2Vec(vectorSize=size, seed=seed, minCount=min_count,
                     inputCol=column, outputCol="_w2v").fit(sentences)
    return model.getVectors().select(
        "word", vector_to_array("vector", "float32").alias("vector"))
