"""Word vectors made in Spark (S11): windowed co-occurrence counts, positive pointwise
mutual information, and the singular vectors of the weights.

Texts are read once: a task turns many of them into numbers of its own words, written
packed.  Their pairs are counted by these numbers and dealt, packed as well, to squares of
the vocabulary (residues of the words' hashes, a pair once), where the counts of all texts
meet; a frequent word is spread over a row of squares.  Weights and products with vectors
are made inside the squares, so no row per pair is shuffled.  Nothing of the vocabulary
passes the driver but a bitmap of bounded size.  Words that the bitmap shows to be too rare
make no pairs; the rest are checked exactly.

Defined results: null texts and empty lists add nothing; a word beside itself is no pair;
words with fewer than ``min_count`` occurrences keep their places in the window but have
no pairs; an empty table gives empty results.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listenlens.operators import factors
from listenlens.session import map_batches, materialize, release, shared_path

#: Words whose pairs a task counts at a time (more only for one batch that has more).
WORDS_AT_ONCE = 2_000_000
#: Bits of the bitmap of kept words, and of one row of it (Spark's).
BITS, ROW_BITS = 1 << 22, 8 * 4096
#: Pairs of a square before equal ones are added up; pairs and a residue's words in a
#: task of a product; residues at least (a power of two).
PAIRS_PER_SQUARE, PAIRS_PER_PRODUCT, WORDS_PER_SIDE, LEAST_SIDES = 8_000_000, 16_000_000, 64_000, 4
#: Rows of a batch that a task gives out.
ROWS_OUT = 500_000

_WORDS, _PAIRS = 0, 1
_PARTS = ["lens", "data", "sums", "lens2", "data2", "keys", "n"]
_DEALT = "t int, side int, " + ", ".join(f"{c} binary" for c in _PARTS)


def _written(df: DataFrame) -> DataFrame:
    """``df`` as a compressed table in the shared folder: pairs are many and repeat their words."""
    return _stored(df, "word-pairs")


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _bitmap(kept: DataFrame) -> np.ndarray:
    """Flags of the kept words' hashes: at most ``BITS`` of them, whatever the vocabulary."""
    at = F.pmod(F.crc32(F.col("a").cast("binary")), F.lit(BITS)) + 1  # Spark numbers bits and rows from 1
    rows = (kept.select(at.alias("h")).groupBy(F.bitmap_bucket_number("h").alias("row"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias("bits")).collect())
    flags = np.zeros(BITS, bool)
    for r in rows:
        flags[(r["row"] - 1) * ROW_BITS:r["row"] * ROW_BITS] = np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little")
    return flags


def _packed(values: np.ndarray) -> bytes:
    """Numbers by planes of their bytes, compressed."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return len(values).to_bytes(8, "little") + (pa.compress(planes, codec="zstd", asbytes=True) if len(values) else b"")


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    n, size = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    if not n:
        return np.empty(0, kind)
    planes = np.frombuffer(pa.decompress(data[8:], decompressed_size=n * size, codec="zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).view(kind).reshape(n)


def _packed_words(words: pa.Array) -> tuple[bytes, bytes]:
    """The words' lengths and bytes."""
    words = pa.concat_arrays([words])
    lens = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int32)
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8)[ends[0]:ends[-1]] if len(words) and ends[-1] > ends[0] else np.empty(0, np.uint8)
    return _packed(lens), _packed(data)


def _unpacked_words(lens: bytes, data: bytes) -> pa.Array:
    sizes = _unpacked(lens, np.int32)
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(ends), pa.py_buffer(_unpacked(data, np.uint8)))


def _hashes(words: pa.Array) -> np.ndarray:
    return np.fromiter((zlib.crc32(w.encode()) for w in words.to_pylist()), np.int64, len(words))


def _square(p, q):
    """The number of the square of residues ``p <= q``."""
    return q * (q + 1) // 2 + p


def _chunk(texts: list[pa.Array]) -> pa.RecordBatch:
    """Texts as one row: their words and how often each comes, the numbers of all words, the texts' lengths."""
    lists = pa.chunked_array(texts).combine_chunks()
    coded = lists.flatten().dictionary_encode()
    code = pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False).astype(np.int32)
    times = np.bincount(code[code >= 0], minlength=len(coded.dictionary))
    order = np.argsort(-times, kind="stable")  # frequent words get small numbers, that pack well
    place = np.empty(len(order) + 1, np.int32)
    place[order], place[-1] = np.arange(len(order)), -1
    lens = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int32)
    return pa.RecordBatch.from_pydict({
        "words": pa.array([coded.dictionary.take(pa.array(order)).to_pylist()], pa.list_(pa.string())),
        "times": pa.array([times[order]], pa.list_(pa.int64())), "codes": [_packed(place[code])], "lens": [_packed(lens)]})


def _chunks(words_at_once: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch.column(0))
            size += len(batch.column(0).flatten())
            if size >= words_at_once:
                yield _chunk(held)
                held, size = [], 0
        if size:
            yield _chunk(held)

    return run


def _count_pairs(texts: list[pa.Array], window: int, flags: np.ndarray | None, sides: int = 1) -> Iterator[pa.RecordBatch]:
    """``(a, b, n)``: the pairs of the texts, once each, ``a`` before ``b`` by residue of the hash and then by word;
    the columns share a dictionary in that order."""
    lists = pa.chunked_array(texts).combine_chunks()
    text = np.repeat(np.arange(len(lists), dtype=np.int32), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
    coded = lists.flatten().dictionary_encode()
    hashes = _hashes(coded.dictionary)
    order = pc.sort_indices(coded.dictionary).to_numpy().astype(np.int64)
    order = order[np.argsort(hashes[order] % sides, kind="stable")]
    if flags is not None:
        order = order[flags[hashes[order] % BITS]]
    number = np.full(len(hashes) + 1, -1, np.int64)  # null words, and words too rare, have none
    number[order] = np.arange(len(order))
    code = number[pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False)]
    width, keys = max(1, len(order)), []
    for apart in range(1, window + 1):
        a, b = code[:-apart], code[apart:]
        on = (text[:-apart] == text[apart:]) & (a >= 0) & (b >= 0) & (a != b)
        a, b = a[on], b[on]
        keys.append(np.minimum(a, b) * width + np.maximum(a, b))
    pairs = np.concatenate(keys)
    del text, code, keys
    pairs, n = _added(pairs)
    words = coded.dictionary.take(pa.array(order))
    a, b = (pa.DictionaryArray.from_arrays(pa.array(x.astype(np.int32)), words) for x in np.divmod(pairs, width))
    yield pa.RecordBatch.from_arrays([a, b, pa.array(n, pa.int64())], names=["a", "b", "n"])


def _added(keys: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and how often each comes (or the sums of ``n``)."""
    if n is None:
        keys.sort()
    else:
        order = np.argsort(keys, kind="stable")  # merges runs that are in order
        keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
    if n is None:
        return keys[first], np.diff(np.append(first, len(keys)))
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def _messages(batch: pa.RecordBatch, sides: int) -> Iterator[pa.RecordBatch]:
    """The pairs of ``_count_pairs`` as one row for each square, with its words."""
    words = batch.column("a").dictionary
    a, b = (batch.column(c).indices.to_numpy().astype(np.int64) for c in "ab")
    side, n = _hashes(words) % sides, batch.column("n").to_numpy()
    bounds = np.searchsorted(side, np.arange(sides + 1))
    square = _square(side[a], side[b]).astype(np.int32)
    if sides <= 255:  # squares of 16 bits: numpy sorts these by radix
        square = square.astype(np.uint16)
    order = np.argsort(square, kind="stable")
    cuts = np.searchsorted(square[order], np.arange(sides * (sides + 1) // 2 + 1))
    sent = [_packed_words(words[bounds[r]:bounds[r + 1]]) for r in range(sides)]
    rows = {c: [] for c in ("t", "side", *_PARTS)}
    for q in range(sides):
        for p in range(q + 1):
            t = _square(p, q)
            at = order[cuts[t]:cuts[t + 1]]
            if len(at):
                keys = (a[at] - bounds[p]) * (bounds[q + 1] - bounds[q]) + b[at] - bounds[q]
                for c, x in zip(rows, (t, _PAIRS, *sent[p], None, *sent[q], _packed(np.diff(keys, prepend=0)), _packed(n[at].astype(np.int64)))):
                    rows[c].append(x)
    yield _dealt_batch(rows)


def _dealt_batch(rows: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rows[c], pa.int32() if c in ("t", "side") else pa.binary()) for c in rows], names=list(rows))


def _pair_messages(window: int, flags: np.ndarray | None, sides: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                code, lens = (_unpacked(batch[c][row].as_py(), np.int32) for c in ("codes", "lens"))
                coded = pa.DictionaryArray.from_arrays(pa.array(code, mask=code < 0), batch["words"][row].values)
                ends = np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)
                for found in _count_pairs([pa.ListArray.from_arrays(pa.array(ends), coded)], window, flags, sides):
                    yield from _messages(found, sides)

    return run


def _row_messages(sides: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows ``(word, other, n)``, a pair once, as messages."""
    def one(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks()
        both = pa.concat_arrays([rows[c].combine_chunks() for c in ("word", "other")]).dictionary_encode()
        hashes = _hashes(both.dictionary)
        order = pc.sort_indices(both.dictionary).to_numpy().astype(np.int64)
        order = order[np.argsort(hashes[order] % sides, kind="stable")]
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        a, b = np.split(number[both.indices.to_numpy()], 2)
        pairs, n = _added(np.minimum(a, b) * len(order) + np.maximum(a, b), rows["n"].to_numpy())
        words = both.dictionary.take(pa.array(order))
        a, b = (pa.DictionaryArray.from_arrays(pa.array(x.astype(np.int32)), words) for x in np.divmod(pairs, len(order)))
        yield from _messages(pa.RecordBatch.from_arrays([a, b, pa.array(n, pa.int64())], names=["a", "b", "n"]), sides)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size >= WORDS_AT_ONCE:
                yield from one(held)
                held, size = [], 0
        if held:
            yield from one(held)

    return run


@dataclass(frozen=True)
class Squares:
    """Counted pairs in squares.  ``words``: ``(r, lens, data)``, the words of every residue in order, with
    ``sums`` of their pairs' counts once ``information`` has added them up; ``pairs``: ``(t, p, q, keys, n, of_p,
    of_q, size)``, a row for a square; ``total``: of the sums, ``kept``: words and pairs."""

    words: DataFrame
    pairs: DataFrame
    sides: int
    total: int | None = None
    kept: tuple[int, int] = (0, 0)


def _residues(kept: DataFrame, sides: int) -> DataFrame:
    """``(r, lens, data)``: the words ``a`` of every residue of their hashes, in word order."""
    lists = (kept.groupBy(F.pmod(F.crc32(F.col("a").cast("binary")), F.lit(sides)).cast("int").alias("r"))
             .agg(F.array_sort(F.collect_list("a")).alias("words")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [_packed_words(x.values) for x in batch["words"]]
            yield pa.RecordBatch.from_arrays([batch["r"], pa.array([x[0] for x in packed], pa.binary()), pa.array([x[1] for x in packed], pa.binary())],
                                             names=["r", "lens", "data"])

    return _stored(map_batches(lists, run, "r int, lens binary, data binary"), "words")


def _tasks(sides: int) -> int:
    return sides * (sides + 1) // 2


def _square_of(p: Column, q: Column) -> Column:
    low, high = F.least(p, q), F.greatest(p, q)
    return (F.shiftright(high * (high + 1), 1) + low).cast("int")


def _beside(pairs: DataFrame, words: DataFrame, sides: int) -> DataFrame:
    """The pairs of every square in a task of their own, with the words of its residues."""
    copies = words.withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(sides - 1)))).withColumn(
        "t", _square_of(F.col("r"), F.col("o"))).withColumn("side", F.lit(_WORDS))
    sent = pairs if "side" in pairs.columns else pairs.withColumn("side", F.lit(_PAIRS))
    both = [df.select("t", "side", *(F.col(c) if c in df.columns else F.lit(None).cast(kind).alias(c)
                                     for c, kind in (("r", "int"), *((c, "binary") for c in _PARTS)))) for df in (copies, sent)]
    return both[0].unionByName(both[1]).repartitionById(_tasks(sides), F.col("t"))


def _each_square(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict, list[dict]]]:
    """``(t, rows of words by residue, rows of pairs)`` of the squares of a partition."""
    words, pairs = {}, {}
    for batch in batches:
        for row in batch.to_pylist():
            if row["side"] == _WORDS:
                words.setdefault(row["t"], {})[row["r"]] = row
            else:
                pairs.setdefault(row["t"], []).append(row)
    for t in sorted(pairs):
        yield t, words.get(t, {}), pairs.pop(t)


def _corner(t: int) -> tuple[int, int]:
    q = int(((8 * t + 1) ** 0.5 - 1) // 2)
    return t - q * (q + 1) // 2, q


def _merged(t: int, words: dict, rows: list[dict]) -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray] | None:
    """The words of the square's residues, its distinct keys and their counts; words that are not kept go."""
    p, q = _corner(t)
    if p not in words or q not in words:
        return None
    one, two = (_unpacked_words(words[r]["lens"], words[r]["data"]) for r in (p, q))
    sent = [[_unpacked_words(r[f"lens{s}"], r[f"data{s}"]) for r in rows] for s in ("", "2")]
    found = [pc.fill_null(pc.index_in(pa.concat_arrays(s), value_set=w), -1).to_numpy() for s, w in zip(sent, (one, two))]
    starts = [np.concatenate([[0], np.cumsum([len(x) for x in s])]) for s in sent]
    keys, counts = [], []
    for j, row in enumerate(rows):
        a, b = np.divmod(np.cumsum(_unpacked(row["keys"], np.int64)), len(sent[1][j]))
        a, b = found[0][starts[0][j] + a].astype(np.int64), found[1][starts[1][j] + b]
        on = (a >= 0) & (b >= 0)
        keys.append(a[on] * len(two) + b[on])
        counts.append(_unpacked(row["n"], np.int64)[on])
        row.clear()
    return one, two, *_added(np.concatenate(keys), np.concatenate(counts))


def _both_ways(one: pa.Array, two: pa.Array, keys: np.ndarray, *columns: np.ndarray) -> Iterator[list[pa.Array]]:
    for lo in range(0, len(keys), ROWS_OUT):
        a, b = np.divmod(keys[lo:lo + ROWS_OUT], len(two))
        a, b = one.take(pa.array(a)), two.take(pa.array(b))
        rest = [pa.array(c[lo:lo + ROWS_OUT]) for c in columns]
        yield [a, b, *rest]
        yield [b, a, *rest]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t, words, rows in _each_square(batches):
        if found := _merged(t, words, rows):
            for columns in _both_ways(*found):
                yield pa.RecordBatch.from_arrays(columns, names=["word", "other", "n"])


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Squares whose counts are added up, with the sums of the words of both residues."""
    for t, words, rows in _each_square(batches):
        if found := _merged(t, words, rows):
            one, two, keys, n = found
            by = [_packed(np.bincount(x, n, len(w)).astype(np.int64)) for x, w in zip(np.divmod(keys, max(1, len(two))), (one, two))]
            ends = [pa.array([r], pa.int32()) for r in _corner(t)]
            yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), *ends, *(pa.array([x], pa.binary()) for x in (_packed(np.diff(keys, prepend=0)), _packed(n), *by)), pa.array([len(keys)], pa.int64())],
                                             names=["t", "p", "q", "keys", "n", "of_p", "of_q", "size"])


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for r, part in zip(batch["r"].to_pylist(), batch["part"].to_pylist()):
            sums[r] = sums.get(r, 0) + _unpacked(part, np.int64)
    for r, x in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([_packed(x)], pa.binary()), *(pa.array([y], pa.int64()) for y in (int(x.sum()), len(x)))],
                                         names=["r", "sums", "total", "size"])


def _squares(messages: DataFrame, words: DataFrame, sides: int) -> Squares:
    pairs = _stored(map_batches(_beside(messages, words, sides), _sums,
                                "t int, p int, q int, keys binary, n binary, of_p binary, of_q binary, size long"), "squares")
    return Squares(words, pairs, sides)


def _weighed(counts: Squares) -> Squares:
    """``counts`` with the words' sums, from which a task makes the weights of its square."""
    parts = counts.pairs.select(F.col("p").alias("r"), F.col("of_p").alias("part")).unionByName(
        counts.pairs.select(F.col("q").alias("r"), F.col("of_q").alias("part"))).repartitionById(counts.sides, F.col("r"))
    known = _stored(counts.words.join(map_batches(parts, _totals, "r int, sums binary, total long, size long"), "r"), "words")
    total, words = known.agg(F.sum("total"), F.sum("size")).first()
    pairs = counts.pairs.agg(F.sum("size")).first()[0]
    return Squares(known.drop("total", "size"), counts.pairs.select("t", "keys", "n"), counts.sides, total or 0, (words or 0, pairs or 0))


def _messages_of(sentences: DataFrame, column: str, window: int, min_count: int) -> tuple[DataFrame, DataFrame, int]:
    """Messages of the pairs, the words kept by residue, and the residues."""
    chunks = materialize(map_batches(sentences.select(F.col(column).cast("array<string>").alias("w")), _chunks(WORDS_AT_ONCE),
                                     "words array<string>, times array<long>, codes binary, lens binary"))
    counted = (chunks.select(F.explode(F.arrays_zip("words", "times")).alias("x")).groupBy(F.col("x.words").alias("a"))
               .agg(F.sum("x.times").alias("c")).where((F.col("c") >= min_count) & F.col("a").isNotNull()))
    kept = _stored(counted, "kept")
    occurrences, words = kept.agg(F.sum("c"), F.count("a")).first()
    sides = _sides((occurrences or 0) * window, words)
    made = map_batches(chunks.select("words", "codes", "lens"), _pair_messages(window, _bitmap(kept) if min_count > 1 else None, sides), _DEALT)
    return made, _residues(kept, sides), sides


def _sides(pairs: int, words: int = 0) -> int:
    """Residues: a power of two, so that squares of few pairs can be joined to larger ones."""
    return max(LEAST_SIDES, 1 << int(np.ceil(np.log2(max(1.0, (2 * pairs / PAIRS_PER_SQUARE) ** 0.5, words / WORDS_PER_SIDE)))))


def pair_counts(sentences: DataFrame, column: str = "words", window: int = 5, min_count: int = 1,
                packed: bool = False) -> DataFrame | Squares:
    """``(word, other, n)``, both directions: how often two words are at most ``window`` apart.
    ``packed``: written as squares, for ``information``."""
    messages, words, sides = _messages_of(sentences, column, window, min_count)
    if packed:
        return _squares(messages, words, sides)
    return map_batches(_beside(messages, words, sides), _rows, "word string, other string, n long")


def _weights(keys: np.ndarray, n: np.ndarray, width: int, sums: list[np.ndarray], total: int) -> tuple[np.ndarray, ...]:
    """Places in both residues, counts and weights of the pairs of positive weight."""
    a, b = np.divmod(keys, max(1, width))
    ratio = n * float(total) / (sums[0][a].astype(np.float64) * sums[1][b])
    on = ratio > 1
    return a[on], b[on], n[on], np.log(ratio[on])


def _weighed_rows(total: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, words, rows in _each_square(batches):
            ends = [words[r] for r in _corner(t)]
            one, two = (_unpacked_words(x["lens"], x["data"]) for x in ends)
            sums = [_unpacked(x["sums"], np.int64) for x in ends]
            for row in rows:
                a, b, n, weight = _weights(np.cumsum(_unpacked(row["keys"], np.int64)), _unpacked(row["n"], np.int64), len(two), sums, total)
                for columns in _both_ways(one, two, a * max(1, len(two)) + b, n, weight):
                    yield pa.RecordBatch.from_arrays(columns, names=["word", "other", "n", "weight"])

    return run


def information(counts: DataFrame | Squares, packed: bool = False) -> DataFrame | Squares:
    """``(word, other, n, weight)`` with ``weight = ln(n * total / (n(word) * n(other)))``
    where that is positive.  ``counts``: both directions of every pair, as ``pair_counts``
    gives them, or packed.  ``packed``: as squares, for ``word_vectors``."""
    if isinstance(counts, DataFrame):
        # a pair's directions have the same count and weight: one is written and packed
        half = _written(counts.where(F.col("word") < F.col("other")).select("word", "other", F.col("n").cast("long").alias("n")))
        sides = _sides(half.count())
        words = half.select(F.explode(F.array("word", "other")).alias("a")).distinct()
        counts = _squares(map_batches(half, _row_messages(sides), _DEALT), _residues(words, sides), sides)
    known = _weighed(counts)
    if packed:
        return known
    return map_batches(_beside(known.pairs, known.words, known.sides), _weighed_rows(known.total),
                       "word string, other string, n long, weight double")


def _product(squares: Squares, sides: int, vectors: DataFrame, width: int) -> DataFrame:
    """``(id, v)``: the weights times the vectors ``(id, v)``, for the words that have a weight.  Squares join
    to ``sides`` x ``sides`` of them, triangle only: a task makes both directions of its pairs."""
    fine, total = squares.sides, squares.total
    kinds = {"kind": "int", "r": "int", "id": "long", "v": "array<double>", "keys": "binary", "n": "binary"}

    def full(df: DataFrame, kind: int) -> DataFrame:
        df = df.withColumn("kind", F.lit(kind))
        return df.select("t", *(F.col(c) if c in df.columns else F.lit(None).cast(k).alias(c) for c, k in kinds.items()))

    def copied(df: DataFrame, side: Column) -> DataFrame:
        return df.withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(sides - 1)))).withColumn("t", _square_of(side.cast("int"), F.col("o")))

    corners = squares.pairs.withColumn("q", F.floor((F.sqrt(8 * F.col("t") + 1.0) - 1) / 2).cast("int")).withColumn(
        "p", F.col("t") - F.shiftright(F.col("q") * (F.col("q") + 1), 1))
    blocks = corners.withColumn("r", F.col("t")).withColumn("t", _square_of(F.col("p") % sides, F.col("q") % sides))
    sums = copied(squares.words.select("r", F.col("sums").alias("n")), F.col("r") % sides)
    dealt = full(sums, 0).unionByName(full(blocks, 1)).unionByName(full(copied(vectors, F.col("id") % sides), 2))

    def multiplied(t: int, sums: dict, blocks: list, vectors: list) -> Iterator[pa.RecordBatch]:
        ends = _corner(t)
        ids = np.concatenate([x[0] for x in vectors]) if vectors else np.empty(0, np.int64)
        values = np.concatenate([x[1] for x in vectors]) if vectors else np.empty((0, width))
        vectors.clear()
        height = int(ids.max(initial=0)) // sides + 1
        small = np.uint16 if height <= 1 << 16 else np.int32  # 16 bits are sorted by radix
        own = []
        for r in dict.fromkeys(ends):
            dense = np.zeros((height, width))
            dense[ids[ids % sides == r] // sides] = values[ids % sides == r]
            own.append(dense)
        del ids, values
        rows, columns, weights = [], [], []
        for square, keys, n in blocks:
            p, q = _corner(square)
            a, b, _, x = _weights(np.cumsum(_unpacked(keys, np.int64)), _unpacked(n, np.int64), len(sums[q]), [sums[p], sums[q]], total)
            a, b = ((at * fine + r) // sides for at, r in ((a, p), (b, q)))
            if p % sides != ends[0]:
                a, b = b, a
            on = (a < height) & (b < height)  # no vector, no product
            rows.append(a[on].astype(small))
            columns.append(b[on].astype(small))
            weights.append(x[on])
        blocks.clear()
        rows = np.concatenate(rows)  # one after the other, so that each is there twice for a moment only
        columns = np.concatenate(columns)
        weights = np.concatenate(weights)
        out, seen = [np.zeros((height, width)) for _ in own], [np.zeros(height, bool) for _ in own]
        for side, (at, to) in enumerate(((rows, columns), (columns, rows))):
            order = np.argsort(at, kind="stable")
            at, to, x = at[order], to[order], weights[order]
            del order
            first = np.flatnonzero(np.concatenate([np.ones(min(1, len(at)), bool), at[1:] != at[:-1]]))
            sums_to, source = out[side % len(out)], own[(1 - side) % len(own)]
            for i, lo, hi in zip(at[first].tolist(), first.tolist(), [*first[1:].tolist(), len(at)]):
                sums_to[i] += x[lo:hi] @ source.take(to[lo:hi], axis=0)
            seen[side % len(seen)][at[first]] = True
        for r, dense, has in zip(dict.fromkeys(ends), out, seen):
            places = np.flatnonzero(has)
            for lo in range(0, len(places), 4096):
                part = places[lo:lo + 4096]
                yield pa.RecordBatch.from_arrays([pa.array(part * sides + r), _lists(dense[part])], names=["id", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[dict, list, list]] = {}
        for batch in batches:
            ts, kinds = (batch[c].to_numpy() for c in ("t", "kind"))
            for t in np.unique(ts).tolist():
                sums, blocks, vectors = held.setdefault(t, ({}, [], []))
                for at in np.flatnonzero((ts == t) & (kinds == 0)).tolist():
                    sums[batch["r"][at].as_py()] = _unpacked(batch["n"][at].as_py(), np.int64)
                for at in np.flatnonzero((ts == t) & (kinds == 1)).tolist():
                    blocks.append(tuple(batch[c][at].as_py() for c in ("r", "keys", "n")))
                if len(at := np.flatnonzero((ts == t) & (kinds == 2))):
                    some = batch.take(pa.array(at))
                    vectors.append((some["id"].to_numpy(), some["v"].flatten().to_numpy().reshape(-1, width)))
        for t in sorted(held):
            if held[t][1]:
                yield from multiplied(t, *held.pop(t))

    parts = map_batches(dealt.repartitionById(_tasks(sides), F.col("t")), run, "id long, v array<double>")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(b["id"].to_numpy(), b["v"].flatten().to_numpy().reshape(-1, width)) for b in batches if b.num_rows]
        if held:
            ids, values = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(ids, kind="stable")
            ids = ids[order]
            first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            ids, values = ids[first], np.add.reduceat(values[order], first, axis=0)
            for lo in range(0, len(ids), 4096):
                yield pa.RecordBatch.from_arrays([pa.array(ids[lo:lo + 4096]), _lists(values[lo:lo + 4096])], names=["id", "v"])

    return map_batches(parts.repartition(F.col("id")), add, "id long, v array<double>")


def _lists(values: np.ndarray) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(np.ascontiguousarray(values).reshape(-1)))


def _left_vectors(squares: Squares, size: int, tolerance: float) -> tuple[DataFrame, list[float]]:
    """``(word, v)``, the left singular vectors times their values, and the values."""
    fine, sides = squares.sides, LEAST_SIDES
    while sides < fine and (squares.kept[0] > sides * WORDS_PER_SIDE or 2 * squares.kept[1] > sides ** 2 * PAIRS_PER_PRODUCT):
        sides *= 2

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words = _unpacked_words(row["lens"], row["data"])
                for lo in range(0, len(words), ROWS_OUT):
                    part = words[lo:lo + ROWS_OUT]
                    yield pa.RecordBatch.from_arrays([pa.array((np.arange(len(part)) + lo) * fine + row["r"]), part], names=["id", "word"])

    def times(key: str, out: str) -> Callable[[DataFrame, int], DataFrame]:
        def product(vectors: DataFrame, width: int) -> DataFrame:
            release(vectors.sparkSession)  # what earlier products shuffled
            return materialize(_product(squares, sides, vectors.select(F.col(key).alias("id"), "v"), width)).withColumnRenamed("id", out)

        return product

    words = map_batches(squares.words.select("r", "lens", "data"), unfold, "id long, word string")
    seen = _product(squares, sides, words.select("id", F.array(F.lit(1.0)).alias("v")), 1).select("id")
    words = materialize(words.join(seen, "id"))
    start = words.select(F.col("id").alias(factors.S), "word")
    left, _, values = factors.singular_vectors(start, "word", times(factors.S, factors.U), times(factors.U, factors.S), size, tolerance=tolerance)
    return left.join(words.withColumnRenamed("id", factors.U), factors.U).select("word", "v"), values


def word_vectors(weights: DataFrame | Squares, size: int = 32, tolerance: float = 1e-3) -> DataFrame:
    """``(word, vector array<double>)``: left singular vectors times the roots of the
    singular values; ``tolerance`` as in ``factors.svd_vectors``.  ``weights``: as
    ``information`` gives them, packed or not."""
    if isinstance(weights, DataFrame):
        entries = weights.select(F.col("word").alias(factors.U), F.col("other").alias(factors.S), F.col("weight").alias(factors.P))
        left, _, values = factors.svd_vectors(entries, size, tolerance=tolerance)
        left = left.withColumnRenamed(factors.U, "word")
    else:
        left, values = _left_vectors(weights, size, tolerance)
    if not values:
        return left.select("word", F.col("v").alias("vector"))
    roots = F.array(*(F.lit(float(v) ** 0.5) for v in values))
    return left.select("word", F.zip_with("v", roots, lambda x, r: x / r).alias("vector"))
