import test_decontaminate
import test_packing
import test_secret_scan
import test_simhash
from cases import AWKWARD, by_key, prose

import corpus_pipeline
from listenlens.llm.quality_rules import RULES, TextStats, rejected_by

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
ITEMS = test_decontaminate.ITEMS


def redacted(text):
    cuts, out, at = [], "", 0
    for a, b in sorted(tuple(map(int, s.split(":")[1:])) for s in test_secret_scan.brute(text)[-1].split(",") if s):
        if cuts and a <= cuts[-1][1]:
            cuts[-1][1] = max(cuts[-1][1], b)
        else:
            cuts.append([a, b])
    for a, b in cuts:
        out, at = out + text[at:a] + "[SECRET]", b
    return out + text[at:]


def brute_stages(rows):
    kept = [r for r in rows if rejected_by(TextStats(r[1] or ""), RULES) is None]
    yield kept
    kept = test_simhash.kept_by_brute_force(kept)
    yield kept
    kept = [(i, t) for i, t in kept if not test_decontaminate.brute([(0, t)], ITEMS)]
    yield kept
    kept = [(i, redacted(t)) for i, t in kept]
    yield kept
    yield test_packing.brute_pieces(kept, 2048)


def test_stages_and_run_match_brute_force(spark, tmp_path):
    secret = f'token = "{"0123456789abcdef" * 2}"'
    rows = [r for r in AWKWARD if r[0] not in (8, 9, 10)] + test_simhash.near_copies() + [
        (i, f"{prose(i, 40)} {secret if i % 5 == 0 else ''} {prose(i + 50, 40)} {ITEMS[i % 2][1] if i % 7 == 0 else ''}")
        for i in range(400, 440)] + [(500, prose(500, 1500)), (501, "### " * 50)]
    sf = str(tmp_path)
    spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], COLUMNS).repartition(3).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    wanted = list(brute_stages(rows))
    sizes = [len(rows), *map(len, wanted[:-1])]
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] == sizes[4] and wanted[3] != wanted[2]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for k, ((name, stage), want) in enumerate(zip(corpus_pipeline.STAGES, wanted)):
        out = stage(spark, docs, sf)
        if k < 4:
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
            got = out.collect()
            assert by_key((r["doc_id"], r["text"]) for r in got) == by_key(want), name
            assert all(r["n_chars"] == len(r["text"]) for r in got)
            out.write.parquet(f"{sf}/{name}")
            docs = spark.read.parquet(f"{sf}/{name}")
        else:
            assert by_key(tuple(r)[:5] for r in out.collect()) == by_key(want)
    assert by_key(tuple(r)[:5] for r in corpus_pipeline.run(spark, sf).collect()) == by_key(wanted[-1])


def test_empty_documents(spark, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame([], COLUMNS).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0


def test_stages_are_listed_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "simhash_near_dedup", "benchmark_decontamination", "secret_scans", "best_fit_packing"]
