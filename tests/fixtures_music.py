"""Micro-fixture files (FIXTURES.md §3.1) and helpers."""

import os

TRIPLETS = "u1\ts1\t5\nu1\ts2\t3\nu1\ts3\t1\nu2\ts1\t4\nu2\ts2\t2\nu3\ts3\t10\nu3\ts1\t12\n"
TRACKS = ("T1<SEP>s1<SEP>Ann<SEP>One\nT2<SEP>s2<SEP>Bob<SEP>Two\nT3<SEP>s3<SEP>Ann<SEP>Three\n"
          "T4<SEP>s1<SEP>Ann<SEP>One (live)\nT5<SEP>s9<SEP>Cid\n")
GENRES = "# this line is a comment\nT1\tRock\nT2\tPop\nT3\tRock\nT4\tRock\tPop\n"
LYRICS = "%i,the,love,heart,war\nA,1,1:10,3:4,5:1\nB,2,3:3,5:9\nC,3,2:96,3:4\nD,4\n"


def write_all(path):
    out = {}
    for name, text in [("triplets.txt", TRIPLETS), ("tracks.txt", TRACKS), ("genres.cls", GENRES),
                       ("lyrics.txt", LYRICS)]:
        p = os.path.join(path, name)
        with open(p, "w") as f:
            f.write(text)
        out[name.split(".")[0]] = p
    return out


def load(spark, path):
    from listenlens.sources import read_genres, read_lyrics, read_tracks, read_triplets, read_vocabulary
    files = write_all(path)
    return {
        "plays": read_triplets(spark, files["triplets"]),
        "tracks": read_tracks(spark, files["tracks"]),
        "genres": read_genres(spark, files["genres"]),
        "lyrics": read_lyrics(spark, files["lyrics"]),
        "vocab": read_vocabulary(spark, files["lyrics"], ["i", "the"]),
    }
