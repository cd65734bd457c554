"""Best-fit packing of token sequences with Martello-Toth reduction.

Only the number of pieces of each length (at most ``capacity`` counters) decides
a packing, so the instance that the driver sees is this histogram, whatever the
size of the corpus:

1. reduction: for the longest piece left, a small set with it that dominates
   every other set with it is fixed (alone; with the longest that fits, when it
   fills the sequence, when no two others fit, or when no two others hold more;
   with the best pair, when each other pair is matched by it), as often as the
   counts allow, until nothing more is dominated;
2. best fit, longest first, of what remains, sequences of equal content as one
   entry with a count.

Both give patterns (lengths with copies, times a count).  The n-th piece of a
length then has its sequence and offset by arithmetic: pieces carry their number
within task and length, tasks' counts give the base, and no group of equal
lengths ever meets in one task.

Defined results
---------------
* null text: empty; an empty text is one piece, the end token;
* null ids, equal ids and repeated rows: each row is a document of its own;
* empty table: empty result; other columns are ignored;
* equal lengths: interchangeable, numbered as the tasks wrote them.
"""

from __future__ import annotations

import base64
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from listenlens.llm.common import map_batches, py_texts, written

CAPACITY = 2048
END = 0
SPECIAL = "<|endoftext|>"


@lru_cache(maxsize=4)
def _encoder(vocabulary: str | None, ranks: str | None):
    """Text to ids of the vocabulary file (``tokenizers`` JSON).  The rank file
    holds the same vocabulary; its encoder gives the same ids several times
    faster and is used for all texts without the special token's string."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    @lru_cache(maxsize=1)
    def whole() -> Tokenizer:  # loaded by the first text that needs it
        return Tokenizer.from_file(vocabulary or public_tokenizers.path("byte_bpe_50k.json"))

    with open(ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        fast = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks={
            base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f)})

    def encode(text: str) -> np.ndarray:
        ids = whole().encode(text, add_special_tokens=False).ids if SPECIAL in text else fast.encode_ordinary(text)
        return np.array([*ids, END], dtype="<u4")

    return encode


def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: only the first may be shorter."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first)] + [(a, capacity) for a in range(first, n, capacity)]


def pieces(docs: DataFrame, id_column: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
           vocabulary: str | None = None, ranks: str | None = None, keep_ids: bool = False) -> DataFrame:
    """Tokenised pieces; ``task`` and ``nth`` number the pieces of a length."""
    source = docs.select(F.col(id_column).alias("id"), F.col(text).alias("_text"))
    schema = T.StructType([source.schema["id"], T.StructField("piece", T.IntegerType()),
                           *(T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32")),
                           T.StructField("task", T.IntegerType()), T.StructField("nth", T.LongType())]
                          + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * keep_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, seen = _encoder(vocabulary, ranks), TaskContext.get().partitionId(), Counter()
        for batch in batches:
            of, rows = [], []
            for i, t in enumerate(py_texts(batch.column(1))):
                ids = encode(t)
                for p, (a, n) in enumerate(piece_bounds(len(ids), capacity)):
                    part = ids[a:a + n]
                    of.append(i)
                    rows.append((p, a, n, crc32(part.tobytes()), task, seen[n]) + ((part.tolist(),) if keep_ids else ()))
                    seen[n] += 1
            columns = list(zip(*rows)) or [()] * (len(schema) - 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(of, pa.int64()))]
                + [pa.array(c, _ARROW[f.dataType.simpleString()]) for c, f in zip(columns, schema.fields[1:])],
                names=schema.names)

    return map_batches(source, run, schema)


_ARROW = {"int": pa.int32(), "bigint": pa.int64(), "array<int>": pa.list_(pa.int32())}

Pattern = tuple[int, list[tuple[int, int]]]  # (sequences, [(length, copies), ...])


def reduce_instance(counts: dict[int, int], capacity: int) -> tuple[list[Pattern], dict[int, int]]:
    """Martello-Toth dominance on a histogram: fixed patterns and what is left."""
    left = {w: n for w, n in counts.items() if n > 0}
    fixed: list[Pattern] = []

    def fix(items: list[int]) -> None:
        need = Counter(items)
        times = min(left[w] // n for w, n in need.items())
        fixed.append((times, sorted(need.items(), reverse=True)))
        for w, n in need.items():
            left[w] -= times * n
            if not left[w]:
                del left[w]

    changed = True
    while changed:
        changed = False
        for w in sorted(left, reverse=True):
            while left.get(w):
                dominating = _dominating(left, w, capacity - w)
                if dominating is None:
                    break
                fix([w, *dominating])
                changed = True
    return fixed, left


def _dominating(left: dict[int, int], w: int, room: int) -> list[int] | None:
    """What joins a piece of length ``w`` in a set that dominates all its sets."""
    others = {x: n - (x == w) for x, n in left.items() if n - (x == w) > 0}
    fitting = sorted(x for x in others if x <= room)
    if not fitting:
        return []
    longest = fitting[-1]
    small = [x for x in fitting for _ in range(min(3, others[x]))][:3]
    if longest == room or len(small) < 2 or small[0] + small[1] > room:
        return [longest]
    if len(small) > 2 and sum(small) <= room:
        return None  # three others fit: no rule applies
    a, b = max(((x, y) for x in fitting if (y := _largest(others, fitting, x, room - x))), key=sum)
    if longest >= a + b:
        return [longest]
    above = [x for x in sorted(others) if x > b for _ in range(min(2, others[x]))][:2]
    if a == longest and (len(above) < 2 or sum(above) > room):
        return [a, b]
    return None


def _largest(others: dict[int, int], fitting: list[int], x: int, room: int) -> int | None:
    """The longest partner of ``x`` (not longer than it) that fits ``room``."""
    at = bisect_left(fitting, min(room, x) + 1) - 1
    if at >= 0 and fitting[at] == x and others[x] < 2:
        at -= 1
    return fitting[at] if at >= 0 else None


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best fit, longest first; sequences of equal content are one entry."""
    open_: dict[int, list[Pattern]] = {}  # by room left
    rooms: list[int] = []

    def put(room: int, sequences: int, content: list[tuple[int, int]]) -> None:
        if sequences:
            if room not in open_:
                insort(rooms, room)
            open_.setdefault(room, []).append((sequences, content))

    for w in sorted(counts, reverse=True):
        n = counts[w]
        while n:
            at = bisect_left(rooms, w)
            if at == len(rooms):  # none has room: new ones
                put(capacity, -(-n // (capacity // w)), [])
                continue
            room = rooms[at]  # the tightest; they stay the tightest until full
            sequences, content = open_[room].pop()
            if not open_[room]:
                del open_[room], rooms[at]
            each = room // w
            full = min(sequences, n // each)
            n -= full * each
            part = min(n, each) if full < sequences else 0
            n -= part
            put(room - each * w, full, content + [(w, each)])
            put(room - part * w, int(part > 0), content + [(w, part)])
            put(room, sequences - full - (part > 0), content)
    return [p for room in rooms for p in open_[room]]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    fixed, left = reduce_instance(counts, capacity)
    return fixed + best_fit(left, capacity)


def _slots(patterns: list[Pattern]) -> np.ndarray:
    """Rows (length, first number, first sequence, copies, offset), sorted."""
    used, sequence, rows = Counter(), 0, []
    for times, content in patterns:
        offset = 0
        for w, copies in content:
            rows.append((w, used[w], sequence, copies, offset))
            used[w] += copies * times
            offset += copies * w
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(docs: DataFrame, id_column: str = "doc_id", text: str = "text", capacity: int = CAPACITY, **how) -> DataFrame:
    """Every piece with its sequence and offset, as few sequences as we can."""
    cut = written(pieces(docs, id_column, text, capacity, **how), "pack-pieces", few=False)
    by_task = written(cut.groupBy("task", "length").agg(F.count("*").alias("n")), "pack-counts")
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = _slots(plan(counts, capacity))  # bounded by the capacity, not by the corpus
    before = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    base = by_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    base = written(base, "pack-base")
    numbered = cut.join(base, ["task", "length"]).withColumn("nth", F.col("nth") + F.col("base")).drop("base", "task")
    schema = T.StructType([f for f in numbered.schema if f.name != "nth"]
                          + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    # (length, number) as one increasing key
    shift = np.int64(1) << np.int64(48)
    keys = slots[:, 0] * shift + slots[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, nth = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("length", "nth"))
            _, first, sequence, copies, offset = slots[np.searchsorted(keys, length * shift + nth, side="right") - 1].T
            k = nth - first
            columns = {n: batch.column(n) for n in schema.names[:-2]}
            columns |= {"sequence_id": pa.array(sequence + k // copies), "offset": pa.array(offset + k % copies * length)}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return map_batches(numbered, place, schema).withColumnRenamed("id", id_column).select(
        id_column, "piece", "start", *(n for n in schema.names if n not in ("id", "piece", "start")))
