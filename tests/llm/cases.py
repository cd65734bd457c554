"""Small tables with the awkward cases that every operator must handle."""

import random

from pyspark.sql import types as T

#: Extra columns whose names the operators use inside.
CLASHING = ("id", "fp", "blob", "path", "content", "h", "ra", "item", "task", "length", "cuts", "carrier", "words", "_text")
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())] + [T.StructField(c, T.StringType()) for c in CLASHING])


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = ["".join(rng.choice(("an", "the", "ér", "ing", "on", "st", "ß", "ble")) for _ in range(rng.randint(1, 3)))
             for _ in range(n)]
    return "".join(w + (".\n" if i % 17 == 16 else " ") for i, w in enumerate(words))


AWKWARD = [
    (1, prose(1, 60)), (2, prose(1, 60)),  # copies
    (3, prose(1, 58) + "x y"),  # a near copy
    (4, None), (5, ""), (6, " \n\t "), (None, prose(2, 40)), (None, None),
    (7, prose(3, 30)), (7, prose(3, 30)),  # a repeated row
    (7, prose(4, 30)),  # the id again, another text
    (8, prose(5, 9000)), (9, "word " * 3000), (10, "x" * 60_000),  # very long ones
    (11, "one"), (12, "one two"), (13, "one two three"), (14, "ONE\x0bTWO\x0cthree four  five 🎉"),
    (15, prose(6, 25) + " <|endoftext|> " + prose(7, 25)),
]


def table(spark, rows, schema=DOCS):
    extra = tuple("clash" for _ in CLASHING)
    return spark.createDataFrame([(i, t, "en", "src", None if t is None else len(t)) + extra for i, t in rows], schema)


def by_key(rows) -> list:
    return sorted((tuple(r) for r in rows), key=repr)
