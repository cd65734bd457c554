"""Growing encoders, and readers that count what they reject."""

import os
import tempfile

from conftest import write
from listenlens.operators import encoders
from listenlens.sources import checked


def folder():
    return os.path.join(tempfile.mkdtemp(prefix="listenlens-test-"), "codes")


def values(spark, *rows):
    return spark.createDataFrame([(r, "clash", "clash") for r in rows], "id string, value string, code string")


def codes(spark, path):
    return {r["value"]: (r["code"], r["generation"]) for r in encoders.load(spark, path).collect()}


def test_old_codes_stay(spark):
    path = folder()
    assert codes(spark, path) == {}
    assert encoders.append(values(spark, "m", "b", "m", None), "id", path) == 2
    assert encoders.append(values(spark, "z", "a", "b"), "id", path) == 2
    want = {"b": (0, 0), "m": (1, 0), "a": (2, 1), "z": (3, 1)}
    assert codes(spark, path) == want
    assert encoders.append(values(spark, "a", None), "id", path) == 0 and codes(spark, path) == want
    got = encoders.encode(values(spark, "z", "new", None), "id", path).collect()
    assert {r["id"]: r["id_code"] for r in got} == {"z": 3, "new": None, None: None} and got[0]["value"] == "clash"


def test_an_append_that_broke_off_does_not_count(spark):
    path = folder()
    encoders.append(values(spark, "m"), "id", path)
    broken = spark.createDataFrame([("x", 1, 2)], "value string, code long, rows long")  # one of two rows
    broken.write.parquet(f"{path}/generation=1")
    assert codes(spark, path) == {"m": (0, 0)}
    assert encoders.append(values(spark, "y", "x", "m"), "id", path) == 2
    assert codes(spark, path) == {"m": (0, 0), "x": (1, 1), "y": (2, 1)}


CASES = {
    "triplets": ("u\ts\t3\nu\ts\nu\ts\tmany\nu\ts\t1\tx\n\n\ts\t2\nu\ts\t99999999999\nv\ts\t4\n", (2, 5, 1), [("u", "s", 3), ("v", "s", 4)]),
    "tracks": ("t<SEP>s<SEP>a<SEP>b\nt<SEP>s<SEP>a\n \nt<SEP>s<SEP>a<SEP>b<SEP>c\n", (1, 2, 1), [("t", "s", "a", "b")]),
    "genres": ("# a comment\nt\tRock\nt\tRock\tPop\n%\nu\n", (1, 2, 2), [("t", "Rock")]),
    "lyrics": ("%a,b\n#x\nt,1,1:2,2:3\nt,1,1:x\nt,1\n\nv,2,7:1\n", (2, 2, 3), None),
}


def test_good_and_bad_lines_by_file(spark):
    for kind, (text, want, rows) in CASES.items():
        at = tempfile.mkdtemp(prefix="listenlens-test-")
        write(at, "one.txt", text)
        write(at, "two.txt", text + text)
        got = {os.path.basename(r["file"]): (r["good"], r["bad"], r["skipped"]) for r in checked.counts(spark, at, kind).collect()}
        assert got == {"one.txt": want, "two.txt": tuple(2 * n for n in want)}, kind
        parsed, seen = checked.read_good(spark, at, kind)
        found = parsed.collect()
        assert seen.get == {s: 3 * n for s, n in zip(("good", "bad", "skipped"), want)}, kind
        if rows is not None:
            assert sorted(map(tuple, found)) == sorted(rows * 3), kind


def test_files_without_lines(spark):
    at = tempfile.mkdtemp(prefix="listenlens-test-")
    write(at, "none.txt", "")
    assert checked.counts(spark, at, "triplets").count() == 0 and checked.read_good(spark, at, "triplets")[0].count() == 0
