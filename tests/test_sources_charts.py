from fixtures_music import load

from listenlens.operators import charts


def test_tracks_missing_title_is_null(spark, tmpdir_path):
    d = load(spark, tmpdir_path)
    rows = {r.track_id: r for r in d["tracks"].collect()}
    assert rows["T5"].title is None and rows["T5"].artist == "Cid"
    assert rows["T4"].title == "One (live)"


def test_genres_drop_comments_and_malformed(spark, tmpdir_path):
    d = load(spark, tmpdir_path)
    g = d["genres"]
    assert g.count() == 3
    assert sorted(r.track_id for r in g.select("track_id").collect()) == ["T1", "T2", "T3"]


def test_lyrics_and_vocabulary(spark, tmpdir_path):
    d = load(spark, tmpdir_path)
    vocab = {r.word_index: (r.word, r.is_stop) for r in d["vocab"].collect()}
    assert vocab == {1: ("i", True), 2: ("the", True), 3: ("love", False), 4: ("heart", False),
                     5: ("war", False)}
    lyr = sorted(tuple(r) for r in d["lyrics"].collect())
    assert lyr == [("A", 1, 10), ("A", 3, 4), ("A", 5, 1), ("B", 3, 3), ("B", 5, 9),
                   ("C", 2, 96), ("C", 3, 4)]


def test_top_tracks_fan_out(spark, tmpdir_path):
    d = load(spark, tmpdir_path)
    top = [(r.title, r.play_count) for r in charts.top_tracks(d["plays"], d["tracks"]).collect()]
    assert sorted(top, key=lambda x: (-x[1], x[0])) == [("One", 21), ("One (live)", 21), ("Three", 11), ("Two", 5)]
    totals = {r.track_id: r.play_count for r in charts.track_totals(d["plays"], d["tracks"]).collect()}
    assert totals == {"T1": 21, "T4": 21, "T3": 11, "T2": 5}


def test_top_by_genre(spark, tmpdir_path):
    d = load(spark, tmpdir_path)
    rock = charts.top_by_genre(d["plays"], d["tracks"], d["genres"], "Rock").collect()
    assert [(r.title, r.play_count) for r in rock] == [("One", 21), ("Three", 11)]
    pop = charts.top_by_genre(d["plays"], d["tracks"], d["genres"], "Pop").collect()
    assert [(r.title, r.play_count) for r in pop] == [("Two", 5)]
    each = charts.top_by_each_genre(d["plays"], d["tracks"], d["genres"]).collect()
    assert sorted((r.genre, r.rank, r.title) for r in each) == [
        ("Pop", 1, "Two"), ("Rock", 1, "One"), ("Rock", 2, "Three")]


def test_song_filter_empty_list_means_all(spark, tmpdir_path):
    d = load(spark, tmpdir_path)
    assert charts.plays_with_tracks(d["plays"], d["tracks"], song_ids=[]).count() == 10  # s1 has two tracks: 3x2 + 2 + 2
    assert charts.plays_with_tracks(d["plays"], d["tracks"], song_ids=["s2"]).count() == 2
