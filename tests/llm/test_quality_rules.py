import random
import re

import pytest

from cases import AWKWARD, by_key, prose, table
from listenlens.llm import quality_rules
from listenlens.llm.quality_rules import RULES, Rule, TextStats, cascade_order, rejected_by

SPACE = r"[\x20\x09-\x0D]"
ROWS = AWKWARD + [
    (30, "THIS IS SHOUTED TEXT " * 12 + prose(9, 5)), (31, "### " * 40), (32, "| a " * 30),
    (33, "\n".join(["same line here"] * 9 + ["another"])), (34, "a b c d e f g h " * 2 + prose(8, 60)),
    (39, " ".join(w for x in prose(10, 30).split() for w in (x, x))), (35, "a b a b a b a b a"), (36, "x " * 8), (37, "x " * 9), (38, "word" * 20 + " " + "w" * 400)]


def brute(text):
    t = text or ""
    w = [x for x in re.split(f"{SPACE}+", t) if x]
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    inside = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(8)} if len(w) < 3500 else None
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)),
            len(inside) if inside is not None else None)


def test_statistics_match_brute_force(spark):
    got = quality_rules.report(table(spark, ROWS), sample_fraction=1.0).collect()
    assert len(got) == len(ROWS)
    left = {}
    for r in got:
        left.setdefault(r["doc_id"], []).append(tuple(r)[1:6])
    for i, t in ROWS:
        want = brute(t)
        match = next(x for x in left[i] if x[:4] == want[:4] and want[4] in (None, x[4]))
        left[i].remove(match)
    for r in got:
        failed = r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])


@pytest.mark.parametrize("seed", range(30))
def test_repeated_windows_exact(seed):
    rng = random.Random(seed)
    w = [rng.choice("ab" if seed % 2 else "abcdefgh").encode() for _ in range(rng.randint(0, 60))]
    if seed % 3 == 0:
        w = w + [b"z"] + w
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    inside = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(8)}
    assert quality_rules.repeated_window_words(w, 8) == len(inside)


def test_cascade_order_and_short_circuit():
    asked = []

    def rule(name, rejects):
        return Rule(name, lambda s: asked.append(name) or rejects)
    rules = (rule("dear", True), rule("cheap", True), rule("never", False))
    # dear rejects 10 rows in 10 s, cheap 9 of them in 1 s, never none
    measured = [{"mask": 0b11, "n": 9, "s0": 9.0, "s1": 0.9, "s2": 0.1}, {"mask": 0b01, "n": 1, "s0": 1.0, "s1": 0.1, "s2": 0.1}]
    order = cascade_order(rules, measured)
    assert [r.name for r in order] == ["cheap", "dear", "never"]
    assert rejected_by(TextStats("x"), order) == "cheap" and asked == ["cheap"]
    assert [r.name for r in cascade_order(rules, [])] == ["dear", "cheap", "never"]


def test_filter_keeps_columns_and_ignores_order(spark):
    docs = table(spark, ROWS)
    kept = quality_rules.filter_documents(docs, sample_fraction=1.0)
    assert kept.schema.names == docs.schema.names
    want = [(i, t) for i, t in ROWS if rejected_by(TextStats(t or ""), RULES) is None]
    assert by_key(kept.select("doc_id", "text").collect()) == by_key(want) and want
    assert by_key(quality_rules.filter_documents(docs, RULES[::-1]).select("doc_id", "text").collect()) == by_key(want)
    assert quality_rules.filter_documents(table(spark, [])).count() == 0
    assert quality_rules.report(table(spark, [])).count() == 0
