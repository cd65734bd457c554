import math
import re

from cases import AWKWARD, by_key, prose, table
from listenlens.llm import decontaminate

ITEMS = [(1, prose(50, 30)), (2, prose(51, 12)), (3, "alpha beta gamma"), (4, None), (5, ""), (6, "..."),
         (7, "solo"), (1000, prose(50, 30)), (8, "a b c d e f a b c d e f"), (9, prose(52, 5))]


def words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def grams(w, n):
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def brute(docs, items, threshold=0.8):
    best = {}
    for d, t in docs:
        w = words(t)
        for i, x in items:
            v = words(x)
            if not v:
                continue
            n = min(5, len(v))
            own = grams(v, n)
            shared = len(own & grams(w, n))
            if shared >= math.ceil(len(own) * threshold - 1e-9) and shared:
                best[d, i] = max(best.get((d, i), (0, 0)), (shared, len(own)))
    return [(*k, *v) for k, v in best.items()]


def documents():
    w = prose(50, 30).split()
    mid = lambda k: " ".join(w[:k] + ["xx"] + w[k:])
    return AWKWARD + [
        (100, prose(60, 3000) + " " + prose(50, 30) + prose(61, 3000)), (101, "!! ".join("".join(c.upper() if c.isascii() else c for c in x) for x in w)),
        (102, mid(15)), (103, mid(1)), (104, " ".join(w[:27])), (105, " ".join(w[:24])), (106, " ".join(w[2:])),
        (107, "x alpha BETA, gamma y"), (108, "solo"), (108, prose(51, 12)), (None, prose(51, 12)), (109, prose(52, 5)),
        (110, "f a b c d e f a b"), (111, "soloist"), (112, prose(50, 30)), (112, prose(50, 30))]


def test_matches_brute_force(spark):
    docs = documents()
    items = spark.createDataFrame([(i, t, "clash") for i, t in ITEMS], "item_id long, text string, id string")
    got = decontaminate.contained(table(spark, docs), items)
    rows = [(r["id"], r["item"], r["n_shared"], r["n_shingles"]) for r in got.collect()]
    want = brute(docs, ITEMS)
    assert by_key(rows) == by_key(want)
    assert len(want) > 15 and {d for d, *_ in want} >= {100, 101, 107, 108, None}


def test_every_size_near_the_threshold(spark):
    """A document that misses as many shingles as it may, for each item size."""
    items, docs = [], []
    for n in range(1, 60):
        w = [f"w{n}x{k}" for k in range(n + 4)]
        items.append((n, " ".join(w)))
        miss = n - math.ceil(0.8 * n - 1e-9)
        docs += [(2 * n, " ".join(w[miss:])), (2 * n + 1, " ".join(w[miss + 1:]))]
    got = decontaminate.contained(table(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    assert by_key((r["id"], r["item"], r["n_shared"], r["n_shingles"]) for r in got.collect()) == by_key(brute(docs, items))
    assert {d for d, _ in docs if d % 2 == 0} <= {r["id"] for r in got.collect()}


def test_remove_and_empty_tables(spark):
    docs = documents()
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = decontaminate.remove(table(spark, docs), items)
    assert kept.columns == table(spark, []).columns
    leak = [(d, t) for d, t in docs if not brute([(0, t)], ITEMS)]
    assert by_key(kept.select("doc_id", "text").collect()) == by_key(leak)
    assert decontaminate.contained(table(spark, []), items).count() == 0
    assert decontaminate.contained(table(spark, docs), items.limit(0)).count() == 0
    assert decontaminate.remove(table(spark, docs), items.limit(0)).count() == len(docs)


def test_repeated_and_null_item_ids(spark):
    """Different texts under one item id, or without one, are searched one by one."""
    texts = [prose(300 + k, 24) for k in range(60)]
    items = [(1 if k < 30 else None if k < 50 else k, t) for k, t in enumerate(texts)]
    items += [(1, texts[0]), (2, texts[0]), (None, texts[0]), (None, None)]
    docs = [(k, prose(400, 50) + t + prose(401, 50)) for k, t in enumerate(texts)]
    docs += [(100, " ".join(texts[0].split()[:-4])), (101, texts[1] + texts[2]), (None, texts[31]), (102, prose(402, 300))]
    # the largest containment of the texts of an id, of equal ones the most shingles
    want = {}
    for d, t in docs:
        for i, x in items:
            for *_, shared, own in brute([(d, t)], [(i, x)]):
                want[d, i] = max(want.get((d, i), (0, 0, 0)), (shared / own, shared, own))
    table_of = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contained(table(spark, docs), table_of).collect()
    assert by_key((r["id"], r["item"], r["containment"], r["n_shared"], r["n_shingles"]) for r in got) == by_key(
        (*k, *v) for k, v in want.items())
    assert {(k, 1) for k in range(30)} | {(k, None) for k in range(30, 50)} <= {(r["id"], r["item"]) for r in got}
    assert [r["doc_id"] for r in decontaminate.remove(table(spark, docs), table_of).collect()] == [102]


def test_null_and_repeated_document_ids(spark):
    """Most rows have no id, or one id: texts are found by their address, not by the id."""
    rows = [(None if i % 2 else 9, f"{prose(600 + i, 30)} {ITEMS[0][1] if i % 10 < 2 else ''}") for i in range(120)]
    items = spark.createDataFrame([ITEMS[0], ITEMS[1]], "item_id long, text string")
    got = decontaminate.contained(table(spark, rows), items)
    assert by_key((r["id"], r["item"], r["containment"]) for r in got.collect()) == by_key([(9, 1, 1.0), (None, 1, 1.0)])
    kept = decontaminate.remove(table(spark, rows), items)
    assert kept.count() == sum(ITEMS[0][1] not in t for _, t in rows) == 96
