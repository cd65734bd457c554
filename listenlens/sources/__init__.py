from listenlens.sources import star
from listenlens.sources.files import (
    parse_genre_lines, parse_lyrics_lines, parse_track_lines, parse_triplet_lines,
    parse_vocabulary_line, read_genres, read_lyrics, read_theme_sets, read_tracks,
    read_triplets, read_vocabulary, read_word_vectors, train_word_vectors,
)
from listenlens.sources.stop_words import english_stop_words

__all__ = [
    "english_stop_words", "parse_genre_lines", "parse_triplet_lines", "parse_lyrics_lines", "parse_track_lines",
    "parse_vocabulary_line", "read_genres", "read_lyrics", "read_theme_sets", "read_tracks",
    "read_triplets", "read_vocabulary", "read_word_vectors", "star", "train_word_vectors",
]
