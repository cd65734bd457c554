"""Named vector queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from listenlens.operators import cooccurrence, themes, vectors
from listenlens.plans.registry import register
from listenlens.plans.sql import with_ctes
from listenlens.plans.themes import BASE, _love, _scores, theme_sql
from listenlens.session import materialize, shared_path
from listenlens.sources import read_word_vectors, star

UNIT = "list_transform({v}::DOUBLE[], lambda x: x / sqrt(list_dot_product({v}::DOUBLE[], {v}::DOUBLE[])))"

NEAR = {
    "nv": f"SELECT word, {UNIT.format(v='vector')} AS u FROM word_vectors",
    "near": """
        SELECT * FROM (
            SELECT word, neighbor, similarity,
                   row_number() OVER (PARTITION BY word ORDER BY similarity DESC, neighbor) AS rank
            FROM (SELECT a.word, b.word AS neighbor, round(list_dot_product(a.u, b.u), 6) AS similarity
                  FROM nv a JOIN nv b ON a.word <> b.word))
        WHERE rank <= 10""",
}


@register("l2_normalize", ids="A15", sql=f"""
    SELECT vec_id, dim, round(x / sqrt(list_dot_product(e, e)), 6) AS value FROM (
        SELECT vec_id, embedding::DOUBLE[] AS e, unnest(embedding::DOUBLE[]) AS x,
               unnest(generate_series(0, len(embedding) - 1)) AS dim
        FROM embeddings)""")
def l2_normalize(spark, d):
    emb = star.table(spark, d, "embeddings").select("vec_id", "embedding")
    unit = vectors.l2_normalize(emb, "embedding")
    return (unit.select("vec_id", F.posexplode("embedding").alias("dim", "value"))
            .withColumn("dim", F.col("dim").cast("long"))
            .withColumn("value", F.round("value", 6)))


@register("cosine_top_k", ids="V1 T7 A14 X11 X12", sql=f"""
    WITH cent AS (
        SELECT label, list(m ORDER BY pos) AS v FROM (
            SELECT label, pos, avg(x) AS m FROM (
                SELECT label, unnest(embedding::DOUBLE[]) AS x,
                       unnest(generate_series(1, len(embedding))) AS pos FROM embeddings)
            GROUP BY label, pos)
        GROUP BY label),
    q AS (SELECT label, {UNIT.format(v='v')} AS u FROM cent),
    it AS (SELECT vec_id, {UNIT.format(v='embedding')} AS u FROM embeddings)
    SELECT * FROM (
        SELECT label, vec_id, score,
               row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS rank
        FROM (SELECT q.label, it.vec_id, round(list_dot_product(q.u, it.u), 6) AS score
              FROM q, it))
    WHERE rank <= 10""")
def cosine_top_k(spark, d):
    emb = star.table(spark, d, "embeddings").select("vec_id", "label", "embedding")
    centroids = vectors.mean_vector(emb, "label", "embedding", out="vector")
    return vectors.cosine_top_k(centroids, emb, 10, query_id="label", item_id="vec_id",
                                query_vec="vector", item_vec="embedding")


@register("similar_words", ids="V2", sql=with_ctes(
    ["word_vectors", "lexicon"], "SELECT * FROM near WHERE word IN (SELECT word FROM lexicon)", NEAR))
def similar_words(spark, d):
    # the query words are the lexicon's, as in the expansion
    return vectors.similar_words(star.word_vectors(spark, d), star.theme_lexicon(spark), 10)


@register("word_vectors_roundtrip", ids="S11", sql=with_ctes(["word_vectors"], """
    SELECT word, round(list_sum(vector::DOUBLE[]), 4) AS total, len(vector) AS size FROM word_vectors"""))
def word_vectors_roundtrip(spark, d):
    path = shared_path(spark, "word-vectors")
    star.word_vectors(spark, d).write.parquet(path)
    total = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return read_word_vectors(spark, path).select("word", F.round(total, 4).alias("total"), F.size("vector").cast("long").alias("size"))


XLEX = {"xlex": """
    SELECT theme, word FROM lexicon
    UNION SELECT l.theme, n.neighbor AS word FROM lexicon l JOIN near n ON l.word = n.word"""}


@register("theme_chart_expanded", ids="P5 K1", sql=with_ctes(
    BASE + ["word_vectors"], "SELECT * FROM tchart", {**NEAR, **XLEX, **theme_sql("xlex")}))
def theme_chart_expanded(spark, d):
    lex = themes.expand_lexicon(star.theme_lexicon(spark), star.word_vectors(spark, d),
                                top_n=10, query="seeds")
    members = themes.theme_members(_scores(spark, d, lex), 0.063, 4)
    return themes.theme_chart(star.triplets(spark, d), star.tracks(spark, d), members, 50)


@register("theme_collection_expanded", ids="P7 P5", sql=with_ctes(
    BASE + ["word_vectors"], "SELECT artist, title, play_count FROM tchart WHERE theme = 'love'",
    {**NEAR, **XLEX, **theme_sql("xlex")}))
def theme_collection_expanded(spark, d):
    return _love(spark, d, "word2vec", lexicon=star.theme_lexicon(spark), vectors=star.word_vectors(spark, d),
                 top_n=10, expand_query="seeds")


# a lexicon whose theme names are words of the vocabulary, so that the
# expansion by the theme word itself (the workload's rule) finds neighbours
NAMED = {"this": ["from", "with"], "are": ["by", "be"], "at": ["on", "for"]}
NAMED_SQL = {
    "named": "SELECT * FROM (VALUES " + ", ".join(f"('{t}', '{w}')" for t, ws in NAMED.items() for w in ws) + ") AS t(theme, word)",
    "xnamed": """
        SELECT theme, word FROM named
        UNION SELECT l.theme, n.neighbor AS word FROM named l JOIN near n ON l.theme = n.word""",
}


@register("theme_word_expansion", ids="P5 V2", sql=with_ctes(["word_vectors"], "SELECT * FROM xnamed", {**NEAR, **NAMED_SQL}))
def theme_word_expansion(spark, d):
    return themes.expand_lexicon(star.theme_lexicon(spark, NAMED), star.word_vectors(spark, d), 10, "theme")


WINDOW, MIN_COUNT = 4, 20


def _pairs(spark, d, packed=False):
    return cooccurrence.pair_counts(star.word_lists(spark, d), window=WINDOW, min_count=MIN_COUNT, packed=packed)


PAIRS = {
    "placed": f"""
    SELECT doc_id, word, row_number() OVER (PARTITION BY doc_id ORDER BY o) AS p FROM (
        SELECT doc_id, unnest(l) AS word, generate_subscripts(l, 1) AS o
        FROM (SELECT doc_id, string_split_regex(lower(text), '[^a-z]+') AS l FROM documents))
    WHERE word <> '' AND word NOT IN ({", ".join(f"'{w}'" for w in star.ADAPTER_STOP_WORDS)})""",
    "kept": f"SELECT word FROM placed GROUP BY word HAVING count(*) >= {MIN_COUNT}",
    "beside": f"""
    SELECT a.word AS word, b.word AS other FROM placed a
    JOIN (SELECT doc_id, word, p, unnest(range(1, {WINDOW + 1})) AS o FROM placed) b
      ON a.doc_id = b.doc_id AND a.p = b.p - b.o
    WHERE a.word <> b.word AND a.word IN (SELECT word FROM kept) AND b.word IN (SELECT word FROM kept)""",
    "pairs": """
    SELECT word, other, count(*) AS n FROM (
        SELECT word, other FROM beside UNION ALL SELECT other, word FROM beside) GROUP BY word, other""",
    "of_word": "SELECT word, sum(n) AS nw FROM pairs GROUP BY word",
    "weighted": """
    SELECT p.word, p.other, p.n,
           ln(p.n * (SELECT CAST(sum(n) AS DOUBLE) FROM pairs) / (CAST(a.nw AS DOUBLE) * b.nw)) AS weight
    FROM pairs p JOIN of_word a ON p.word = a.word JOIN of_word b ON p.other = b.word""",
}


@register("word_pairs", ids="S11", sql=with_ctes([], "SELECT word, other, n FROM pairs", PAIRS))
def word_pairs(spark, d):
    return _pairs(spark, d)


@register("word_information", ids="S11", sql=with_ctes(
    [], "SELECT word, other, n, round(weight, 6) AS weight FROM weighted WHERE weight > 0", PAIRS))
def word_information(spark, d):
    return cooccurrence.information(_pairs(spark, d, packed=True)).withColumn("weight", F.round("weight", 6))


@register("trained_similar_words", ids="S11 V2")
def trained_similar_words(spark, d):
    # vectors trained here, neighbours of the lexicon's words
    table = materialize(cooccurrence.word_vectors(cooccurrence.information(_pairs(spark, d, packed=True), packed=True), 16))
    return vectors.similar_words(table, star.theme_lexicon(spark), 10)
