from cases import by_key
from listenlens.llm import url_filter

URLS = [
    "http://a.net/x", "https://EXAMPLE.net/en/1?q=/de/", "http://www.example.net/en", "http://example.com/de/", "ftp://m.example.com/de/7#x",
    "http://badexample.com/de/1", "http://x.org/fr/1", "http://org/fr/", "http://org", "http://net", "http://net/", "http://net?/", "no scheme/net/",
    None, "", "http://", "http:///path", "http://a://b.net/c", "http://h#f/p", "http://CASINO-É.example.com/A b", "http://x.example.net/EN/",
    "http://freecasinowin.example.com/poker/1", "http://quietgarden.example.com/tea/1",
]


def brute(url):
    after = (url or "").partition("://")[2]
    cut = next((k for k, c in enumerate(after) if c in "/?#"), len(after))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in after[:cut])
    path = after[cut:]
    path = path[:next((k for k, c in enumerate(path) if c in "?#"), len(path))]
    fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, None))
    return host, path, best[1], best[2]


def pages(spark, urls, title="the quiet garden of tea and free words"):
    rows = [(i, u, f"<html><TITLE lang='en'>{title}</TITLE>", "clash", "clash", "clash") for i, u in enumerate(urls)]
    rows += [(None, u, None, "c", "c", "c") for u in urls[:3]] + [rows[0]]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string, id string, host string, score string")


def test_hosts_paths_and_rules(spark):
    more = [f"http://{w}-site.example.com/{w}/{k}" for w in ("casino", "poker", "garden", "tea") for k in range(30)]
    rows, df = pages(spark, URLS + more)
    got = url_filter.judge(df).collect()
    want = [(i, *brute(u)) for i, u, *_ in rows]
    assert by_key(tuple(r)[:4] for r in got) == by_key(w[:4] for w in want)
    verdicts = {(r["page_id"], r["rule"]): r["verdict"] for r in got}
    assert all(verdicts[w[0], w[3]] == w[4] for w in want if w[3])
    by_url = {i: r["verdict"] for i, u, *_ in rows for r in got if r["page_id"] == i}
    assert by_url[URLS.index(None)] == "allow"
    assert by_url[URLS.index("http://freecasinowin.example.com/poker/1")] == "block"
    spam = {i for i, u, *_ in rows if u and ("casino-site" in u or "poker-site" in u)}
    assert all(by_url[i] == "block" for i in spam) and len(spam) == 60
    assert by_url[URLS.index("http://quietgarden.example.com/tea/1")] == "allow"
    assert set(r["verdict"] for r in got) == {"allow", "block"}


def test_segmentation_is_the_most_probable_split():
    import itertools
    import math
    counts = {"free": 40, "casino": 30, "win": 50, "a": 90, "as": 60, "in": 70, "no": 40, "cas": 1}
    s = url_filter.Segmenter(counts)
    assert s.split("freecasinowin") == ("free", "casino", "win")
    for name in ("casino", "freewin", "asinno", "zzfree", "winwin"):
        splits = []
        for cuts in itertools.product((0, 1), repeat=len(name) - 1):
            at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(name)]
            words = [name[a:b] for a, b in zip(at, at[1:])]
            splits.append((sum(s._word_cost(w) for w in words), words))
        best = min(splits)[0]
        assert math.isclose(sum(map(s._word_cost, s.split(name))), best)


def test_empty_table(spark):
    assert url_filter.judge(pages(spark, URLS)[1].limit(0)).count() == 0


def test_words_of_bodies_and_without_a_limit(spark):
    """Host words that only bodies hold, behind 60,000 words that are as frequent."""
    def name(k):
        out = "q"
        for _ in range(4):
            k, r = divmod(k, 26)
            out += chr(97 + r)
        return out
    many = " ".join(name(k) for k in range(60_000))
    html = ["<p>mellow <b>zither</b></p>", f"<!-- hidden --><script>var zi = 'ther';</script><div>{many}</div>",
            "<title>Zither&nbsp;MELLOW</title><style>p{}", "<script>unclosed melodrama", None]
    df = spark.createDataFrame([(k, "http://mellowzither.example.com/", h) for k, h in enumerate(html)], "page_id long, url string, html string")
    counts = url_filter.dictionary(df, "html")
    found = {r["w"]: r["n"] for r in counts.collect()}
    assert len(found) == 60_000 + 2 + len(url_filter.SEEDS)  # tags, comments, scripts and styles add none
    assert found["mellow"] == found["zither"] == 2 and found[name(0)] == 1 and found["casino"] == url_filter.SEED_COUNT
    urls = spark.createDataFrame([(0, "mellowzither.qaaaaqbaaa.x", "/"), (1, "mellowzither.qaaaaqbaaa.x", "/a"), (2, "", "")],
                                 "id int, host string, path string")
    got = {r["id"]: r["words"] for r in url_filter.segmented(urls, counts).collect()}
    assert got == {0: (w := ["mellow", "zither", "qaaaa", "qbaaa", "x"]), 1: w, 2: []}
    assert url_filter.judge(df).count() == len(html)
