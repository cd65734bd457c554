"""Reading raw files with counted rejects.

``read_lines`` keeps a line's file and says whether its format accepts it; ``counts`` sums
that per file; ``read_good`` parses the accepted lines and observes the numbers of good,
bad and skipped lines in the same pass, without a second scan.

Defined results: empty lines, and in genre and lyrics files comment (``#``) and header
(``%``) lines, are skipped, neither good nor bad; a play line is bad unless it has three
fields with ids that are not empty and a whole number of plays; a track line unless it has
four fields; a genre line unless it has two; a lyrics line unless it has two ids and all of
its postings are ``index:count`` with numbers.  An empty folder gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from listenlens.sources import files


def _comment() -> Column:
    return F.col("value").startswith("#") | F.col("value").startswith("%")


def _good(kind: str) -> Column:
    if kind == "triplets":
        return F.col("value").rlike(r"^[^\t]+\t[^\t]+\t[+-]?[0-9]+$") & F.split_part(F.col("value"), F.lit("\t"), F.lit(3)).try_cast("int").isNotNull()
    if kind == "tracks":
        return F.size(F.split(F.col("value"), files.TRACK_SEPARATOR)) == 4
    if kind == "genres":
        return F.col("value").rlike(r"^[^\t]+\t[^\t]+$")
    if kind == "lyrics":
        return F.col("value").rlike(r"^[^,]+,[^,]+(,[0-9]{1,9}:[0-9]{1,9})+$")
    raise ValueError(f"unknown format {kind!r}")


PARSERS = {"triplets": files.parse_triplet_lines, "tracks": files.parse_track_lines,
           "genres": files.parse_genre_lines, "lyrics": files.parse_lyrics_lines}


def read_lines(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """``(file, value, state)``; state: good, bad or skipped."""
    skipped = F.trim(F.col("value")) == ""
    if kind in ("genres", "lyrics"):
        skipped = skipped | _comment()
    lines = spark.read.text(path, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("file"), "value")
    return lines.withColumn("state", F.when(skipped, "skipped").when(_good(kind), "good").otherwise("bad"))


def counts(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """``(file, good, bad, skipped)`` of every file with lines."""
    return read_lines(spark, path, kind).groupBy("file").agg(
        *(F.count_if(F.col("state") == s).alias(s) for s in ("good", "bad", "skipped")))


def read_good(spark: SparkSession, path: str, kind: str) -> tuple[DataFrame, Observation]:
    """The parsed good lines, and an observation of good, bad and skipped lines that an
    action over the whole table fills."""
    seen = Observation(f"{kind}-lines")
    lines = read_lines(spark, path, kind).observe(
        seen, *(F.count_if(F.col("state") == s).alias(s) for s in ("good", "bad", "skipped")))
    return PARSERS[kind](lines.where(F.col("state") == "good").select("value")), seen
