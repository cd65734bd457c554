"""DuckDB oracle building blocks: the star-schema adapter as CTEs.

These mirror ``listenlens.sources.star`` and are written independently in SQL
so that the oracle does not share code with the Spark side.
"""

from __future__ import annotations

from listenlens.sources.star import HEADER_WORDS
from listenlens.sources.stop_words import ENGLISH_STOP_WORDS

CTE = {
    "triplets": """
        SELECT CAST(o.o_custkey AS VARCHAR) AS user_id,
               CAST(l.l_partkey AS VARCHAR) AS song_id,
               CAST(sum(l.l_quantity) AS BIGINT) AS play_count
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        GROUP BY o.o_custkey, l.l_partkey""",
    "tracks": """
        SELECT CAST(p_partkey AS VARCHAR) AS track_id, CAST(p_partkey AS VARCHAR) AS song_id,
               p_brand AS artist, p_name AS title
        FROM part""",
    "genres": """
        SELECT CAST(p_partkey AS VARCHAR) AS track_id, p_type AS genre FROM part""",
    "track_totals": """
        SELECT t.track_id, t.title, t.artist, CAST(sum(p.play_count) AS BIGINT) AS play_count
        FROM triplets p JOIN tracks t ON p.song_id = t.song_id
        GROUP BY t.track_id, t.title, t.artist""",
    "tokens": """
        SELECT CAST(doc_id AS VARCHAR) AS track_id, w AS word
        FROM (SELECT doc_id, unnest(string_split_regex(lower(text), '[^a-z]+')) AS w FROM documents)
        WHERE w <> ''""",
    "postings": """
        SELECT track_id, word, count(*) AS count FROM tokens GROUP BY track_id, word""",
    "vocab": """
        SELECT CAST(row_number() OVER (ORDER BY word) AS INTEGER) AS word_index, word,
               word IN ('the', 'of', 'and', 'to', 'a', 'in', 'is', 'that') AS is_stop
        FROM (SELECT DISTINCT word FROM postings)""",
    "header": f"""
        SELECT word, CAST(row_number() OVER (ORDER BY n DESC, word) AS INTEGER) AS word_index
        FROM (SELECT word, sum(count) AS n FROM postings GROUP BY word) ORDER BY n DESC, word LIMIT {HEADER_WORDS}""",
    "lexicon": """
        SELECT * FROM (VALUES
            ('love', 'this'), ('love', 'from'), ('love', 'with'), ('love', 'was'),
            ('war', 'are'), ('war', 'by'), ('war', 'be'), ('war', 'as'),
            ('happiness', 'at'), ('happiness', 'on'), ('happiness', 'for'), ('happiness', 'it')
        ) AS t(theme, word)""",
    "word_vectors": """
        SELECT r.word, e.embedding AS vector
        FROM embeddings e JOIN (
            SELECT word, row_number() OVER (ORDER BY n DESC, word) - 1 AS freq_rank
            FROM (SELECT word, sum(count) AS n FROM postings GROUP BY word)) r
          ON e.vec_id = r.freq_rank""",
    "popular": """
        SELECT song_id, count(user_id) AS shared_users_count FROM triplets
        GROUP BY song_id ORDER BY shared_users_count DESC, song_id LIMIT 80""",
    "active": """
        SELECT user_id, count(song_id) AS shared_song_count FROM triplets
        WHERE song_id IN (SELECT song_id FROM popular)
        GROUP BY user_id ORDER BY shared_song_count DESC, user_id LIMIT 50""",
    "core": """
        SELECT t.user_id, t.song_id, t.play_count FROM triplets t
        WHERE t.user_id IN (SELECT user_id FROM active) AND t.song_id IN (SELECT song_id FROM popular)""",
    "core_split": """
        SELECT c.*, CASE WHEN c.n_items >= 5
                          AND c.rn <= greatest(1, floor(c.n_items * 0.2::DOUBLE)) THEN 'test'
                         ELSE 'train' END AS split
        FROM (SELECT user_id, song_id, play_count,
                     count(*) OVER (PARTITION BY user_id) AS n_items,
                     row_number() OVER (PARTITION BY user_id
                                        ORDER BY md5(user_id || ':' || song_id || ':42'), song_id) AS rn
              FROM core WHERE play_count > 0) c""",
    "train": "SELECT user_id, song_id, play_count FROM core_split WHERE split = 'train'",
    "test": "SELECT user_id, song_id, play_count FROM core_split WHERE split = 'test'",
}

DEPENDS = {
    "track_totals": ["triplets", "tracks"],
    "postings": ["tokens"],
    "vocab": ["postings"],
    "word_vectors": ["postings"],
    "header": ["postings"],
    "popular": ["triplets"],
    "active": ["triplets", "popular"],
    "core": ["triplets", "popular", "active"],
    "core_split": ["core"],
    "train": ["core_split"],
    "test": ["core_split"],
}


def _closure(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        for d in DEPENDS.get(n, []):
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_ctes(names, body: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` the named adapter CTEs (and their dependencies), then ``body``."""
    parts = [f"{n} AS ({CTE[n]})" for n in _closure(names)]
    parts += [f"{k} AS ({v})" for k, v in (extra or {}).items()]
    return "WITH " + ",\n".join(parts) + "\n" + body


def english_stop_words_sql() -> str:
    """SQL ``IN`` list of the English stop words."""
    return ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH_STOP_WORDS)
