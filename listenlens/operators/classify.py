"""Theme classifier over bag-of-words features
(U1, A11, A16, D2, D8, J11, T9, M1, K2, P6).

Data steps are DataFrame operations; the model is Spark ML:
``LogisticRegression`` with balanced class weights by default (the workload
used a weighted MLP), or ``MultilayerPerceptronClassifier`` with the
workload's hidden layers (Spark's MLP has no weight column).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listenlens.functions.columns import md5_order
from listenlens.functions.ranking import rank_within
from listenlens.operators import charts
from listenlens.operators.skew import split_join
from listenlens.session import materialize

LABEL = "theme"


def training_set(theme_sets: list[DataFrame] | DataFrame, one_label: bool = False) -> DataFrame:
    """Union of per-theme member sets, exact duplicates removed.

    A track may carry several themes (kept, as in the workload);
    ``one_label=True`` keeps only its highest-ratio theme (ties: theme name).
    """
    sets = theme_sets if isinstance(theme_sets, list) else [theme_sets]
    df = reduce(lambda a, b: a.unionByName(b), [s.select("track_id", LABEL, "theme_ratio") for s in sets])
    df = df.dropDuplicates()
    if one_label:
        w = Window.partitionBy("track_id").orderBy(F.desc("theme_ratio"), F.asc(LABEL))
        df = df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).drop("_r")
    return df


def stratified_split(df: DataFrame, label: str = LABEL, test_size: float = 0.2,
                     seed: int = 42) -> DataFrame:
    """Per class, the ``floor(test_size * n_c + 0.5)`` rows first in a
    seeded md5 order go to ``test``.  Ranks come from ``rank_within`` (no
    per-class window, so a dominant class is not one task)."""
    n = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    keyed = df.withColumn("_h", md5_order("track_id", label, seed=seed))
    ranked = rank_within(keyed, label, ["_h", "track_id"], name="_rk").join(n, label)
    n_test = F.floor(F.col("_nc").cast("double") * F.lit(float(test_size)) + F.lit(0.5))
    return (ranked.withColumn("split", F.when(F.col("_rk") <= n_test, "test").otherwise("train"))
            .drop("_h", "_rk", "_nc"))


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Balanced weights ``n / (n_classes * n_c)``: ``(label, n_c, weight)``."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    everything = Window.partitionBy()  # over the per-class table: one row per class
    return counts.select(
        label, "n_c",
        (F.sum("n_c").over(everything) / (F.count(F.lit(1)).over(everything) * F.col("n_c"))).alias("weight"))


def bow_features(postings: DataFrame, vocabulary: DataFrame, tracks: DataFrame | None = None,
                 split: bool = False) -> DataFrame:
    """D8/J11 (long form): ``(track_id, word_index, count)`` without stop words,
    only for ``tracks`` when given (inner join: unknown ids drop out with their
    labels, so features and labels stay aligned).  ``split``: words of very many
    tracks are dealt over several tasks, at the price of a pass that names them."""
    keep = vocabulary.where(~F.col("is_stop")).select("word_index")
    out = split_join(postings, keep, "word_index") if split else postings.join(keep, "word_index")
    if tracks is not None:
        out = out.join(tracks.select("track_id").distinct(), "track_id", "left_semi")
    return out.select("track_id", "word_index", "count")


def hashed_vectors(documents: DataFrame, words: str = "words", size: int = 1 << 18) -> DataFrame:
    """D8 for the model: ``(track_id, features)`` from each track's word list.

    Spark ML's ``HashingTF`` counts the words into ``size`` buckets inside the JVM:
    no vocabulary, no join on a word, no Python.  Lists of one track are counted
    together when the caller has put them into one row."""
    from pyspark.ml.feature import HashingTF
    return HashingTF(numFeatures=size, inputCol=words, outputCol="features").transform(
        documents.where(F.col(words).isNotNull())).select("track_id", "features")


def chi_square(postings: DataFrame, classes: DataFrame, key: str = "word", label: str = LABEL) -> DataFrame:
    """``(key, chi2)``: how far a feature's counts per class are from the classes' shares.

    ``postings``: ``(track_id, key, count)``; ``classes``: ``(track_id, label)``.  With the
    share p of a class and a feature's count n in all of them, Σ (o - pn)² / pn is
    Σ o² / pn - n: one aggregation of the long rows per (feature, class), combined on
    the map side, and no row for a class without the feature."""
    sizes = classes.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    share = sizes.select(label, (F.col("_nc") / F.sum("_nc").over(Window.partitionBy())).alias("_p"))  # one row per class
    seen = postings.join(classes, "track_id").groupBy(key, label).agg(F.sum("count").alias("_o"))
    every = F.sum("_o").cast("double")
    return seen.join(share, label).groupBy(key).agg(
        (F.sum(F.col("_o") * F.col("_o") / F.col("_p")) / every - every).alias("chi2"))


def select_features(scores: DataFrame, k: int, key: str = "word") -> DataFrame:
    """The ``k`` features of largest ``chi2`` (to six decimals; ties by key)."""
    return scores.withColumn("chi2", F.round("chi2", 6)).orderBy(F.desc("chi2"), F.asc(key)).limit(k)


def selected_vectors(documents: DataFrame, vocabulary: list[str], words: str = "words") -> DataFrame:
    """D8 for the two-layer model: ``(track_id, features)``, the counts of the selected words
    (a list of bounded length, in its order), made inside the JVM."""
    from pyspark.ml.feature import CountVectorizerModel
    model = CountVectorizerModel.from_vocabulary(vocabulary, inputCol=words, outputCol="features")
    return model.transform(documents.where(F.col(words).isNotNull())).select("track_id", "features")


def fit(train: DataFrame, vectors: DataFrame, model: str = "logistic", max_iter: int = 100,
        seed: int = 42):
    """M1: fit on ``train`` (track_id, theme) ⋈ feature vectors.

    Returns a fitted ``PipelineModel`` (label indexer + classifier + label
    converter), saveable with ``.write().overwrite().save(path)`` (K2).
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
    from pyspark.ml.feature import IndexToString, StringIndexer

    weights = class_weights(train).select(LABEL, F.col("weight").alias("_w"))
    # read by the label indexer and by every iteration of the fit
    data = materialize(train.join(vectors, "track_id").join(weights, LABEL))
    indexer = StringIndexer(inputCol=LABEL, outputCol="_y", stringOrderType="alphabetAsc").fit(data)
    if model == "logistic":
        clf = LogisticRegression(featuresCol="features", labelCol="_y", weightCol="_w",
                                 maxIter=max_iter, predictionCol="_p")
    elif model == "mlp":
        size = len(data.select("features").first()[0])
        clf = MultilayerPerceptronClassifier(
            featuresCol="features", labelCol="_y", predictionCol="_p", maxIter=max_iter,
            layers=[size, 256, 128, len(indexer.labels)], blockSize=16, seed=seed)
    else:
        raise ValueError(f"unknown model {model!r}")
    back = IndexToString(inputCol="_p", outputCol="prediction", labels=indexer.labels)
    return Pipeline(stages=[indexer, clf, back]).fit(data)


def predict(model, tracks: DataFrame, vectors: DataFrame) -> DataFrame:
    """``(track_id, theme, prediction)`` for ``tracks`` with features."""
    scored = model.transform(tracks.join(vectors, "track_id"))
    return scored.select("track_id", LABEL, "prediction")


def classified_chart(plays: DataFrame, tracks: DataFrame, predictions: DataFrame, theme: str | None = None,
                     n: int = 50) -> DataFrame:
    """Chart of the tracks predicted as each theme (or one ``theme``):
    ``(theme, rank, artist, title, play_count)``."""
    pred = predictions.select("track_id", F.col("prediction").alias("theme"))
    if theme is not None:
        pred = pred.where(F.col("theme") == theme)
    pred = materialize(pred)  # read for the restriction and for the join
    totals = charts.track_totals(plays, tracks, track_ids=pred).join(pred, "track_id")
    w = Window.partitionBy("theme").orderBy(F.desc("play_count"), F.asc("track_id"))
    return (totals.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
            .withColumn("rank", F.col("rank").cast("long"))
            .select("theme", "rank", "artist", "title", "play_count"))


def save_model(model, path: str) -> None:
    """K2: persist the fitted pipeline (indexer, classifier, label converter)."""
    model.write().overwrite().save(path)


def load_model(path: str):
    """K2: load a pipeline saved by ``save_model``."""
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


def save_split(df: DataFrame, path: str) -> None:
    """K2: persist the labelled split (track ids, themes, split) as Parquet."""
    df.write.mode("overwrite").parquet(path)


def load_split(spark, path: str) -> DataFrame:
    """K2: the split saved by ``save_split``."""
    return spark.read.parquet(path)
