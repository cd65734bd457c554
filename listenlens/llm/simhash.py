"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints
    Words are maximal runs without space and U+0009-U+000D of the text with
    A-Z lower-cased; shingles of ``shingle`` words, repeats included, are hashed
    with XXH64 (seed 42); a fingerprint bit is 1 when over half the hashes have
    it.  Fewer words: the whole sequence is one shingle; no word: fingerprint 0.

Links
    Two fingerprints link when at most ``radius`` bits differ.  Only distinct
    fingerprints are compared (copies are one row).  The 64 bits are cut into
    ``radius + 6`` blocks of which two linked fingerprints share 6 at least, so
    each fingerprint is dealt once for every choice of 6 blocks (28 keys for
    radius 2) and no link is missed.  The at most 16 free bits of a key bound a
    bucket to 65,536 rows however large or skewed the corpus is.

Comparison
    A partition's rows are sorted by key and its free bits stored as vertical
    bit planes (one bit per row, 64 rows a word).  All rows are compared with
    the row ``s`` places on at once: each plane's difference is added to
    carry-save counters, and a word is abandoned once all of its rows exceed
    the radius.  Links of a bucket leave the task as a forest (at most one edge
    per row), never as all pairs.

Defined results
---------------
* null text: no words, fingerprint 0, linked like any other;
* null id: the row keeps its fingerprint; a component's id is its smallest
  non-null id, null when it has none;
* repeated rows: one result row per input row;
* empty table: empty result; other columns are ignored by ``near_duplicates``
  and passed through unchanged by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listenlens.llm.common import map_batches, py_texts, written
from listenlens.llm.components import connected_components

SEED = 42
SHARED_BLOCKS = 6
_WEIGHTS = np.left_shift(np.uint64(1), np.arange(64, dtype=np.uint64))


def fingerprint(text: str, shingle: int = 3) -> int:
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    firsts, lasts = (ends - lengths)[:len(words) - shingle + 1], ends[shingle - 1:]
    hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED)
                          for a, b in zip(firsts.tolist(), lasts.tolist())), np.uint64, len(firsts))
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)]
        bits = np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(_WEIGHTS[2 * counts > len(hashes)].sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """``(id, fp)``; fp holds the 64 bits as a signed long."""
    source = docs.select(F.col(id_column).alias("id"), F.col(text).alias("_text"))
    schema = T.StructType([source.schema["id"], T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.fromiter((fingerprint(t, shingle) for t in py_texts(batch.column(1))), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], names=schema.names)

    return map_batches(source, run, schema)


def block_masks(radius: int) -> list[int]:
    """For each choice of the blocks that may differ: a mask of their bits."""
    cuts = np.linspace(0, 64, radius + SHARED_BLOCKS + 1).astype(int).tolist()
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    return [sum(free) for free in combinations(blocks, radius)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _over(planes: np.ndarray, idx: np.ndarray, shift: int, radius: int) -> np.ndarray:
    """For the words ``idx``: a bit for each row that differs from the row
    ``shift`` places on in more than ``radius`` planes."""
    word, bit = divmod(shift, 64)
    levels = radius.bit_length() + 1
    counters = [np.zeros(len(idx), np.uint64) for _ in range(levels)]
    over = np.zeros(len(idx), np.uint64)
    live = np.arange(len(idx))
    low, high = np.uint64(bit), np.uint64(64 - bit)
    for k, plane in enumerate(planes):
        at = idx[live]
        other = plane[at + word] if not bit else (plane[at + word] >> low) | (plane[at + word + 1] << high)
        carry = plane[at] ^ other
        for c in counters:  # carry-save: add one bit to every row's counter
            c[live], carry = c[live] ^ carry, c[live] & carry
        gone = over[live] | carry
        # count > radius, compared from the highest counter bit
        equal, more = np.full(len(live), ~np.uint64(0)), np.zeros(len(live), np.uint64)
        for j in range(levels - 1, -1, -1):
            c = counters[j][live]
            if radius >> j & 1:
                equal &= c
            else:
                more |= equal & c
                equal &= ~c
        gone |= more
        over[live] = gone
        if k % 4 == 3:  # abandon words whose rows all exceed the radius
            live = live[gone != ~np.uint64(0)]
            if not len(live):
                break
    return over


def bucket_links(keys: np.ndarray, values: np.ndarray, n_bits: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted by bucket ``keys`` with the ``n_bits`` free bits in ``values``:
    a forest (child row, parent row) that connects what links within a bucket."""
    n = len(keys)
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if n else np.zeros(0, np.int64)
    size = np.diff(np.r_[first, n])
    left = np.repeat(first + size, size) - np.arange(n) - 1  # rows of the bucket that follow
    words = -(-n // 64)
    n_pad = (words + 1 + (int(size.max()) if n else 0) // 64 + 1) * 64
    planes = np.zeros((n_bits, n_pad // 64), np.uint64)
    for b in range(n_bits):
        bits = np.zeros(n_pad, np.uint8)
        bits[:n] = (values >> np.uint64(b)) & np.uint64(1)
        planes[b] = np.packbits(bits, bitorder="little").view(np.uint64)
    root = np.arange(n)
    follow = np.zeros(words * 64, np.int64)
    follow[:n] = left
    most = follow.reshape(words, 64).max(axis=1) if words else follow
    shift = 1
    while True:
        idx = np.flatnonzero(most >= shift)
        if not len(idx):
            break
        near = ~_over(planes, idx, shift, radius)
        hit = np.flatnonzero(near)
        if len(hit):
            bits = np.unpackbits(near[hit].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            w, lane = np.nonzero(bits)
            a = idx[hit[w]] * 64 + lane
            a = a[follow[a] >= shift]
            b = a + shift
            apart = root[a] != root[b]
            while apart.any():  # hook the larger root below the smaller, then flatten
                lo, hi = np.minimum(root[a], root[b])[apart], np.maximum(root[a], root[b])[apart]
                np.minimum.at(root, hi, lo)
                while True:
                    flat = root[root]
                    if (flat == root).all():
                        break
                    root = flat
                apart = root[a] != root[b]
        shift += 1
    child = np.flatnonzero(root != np.arange(n))
    return child, root[child]


def _free_bits(fp: np.ndarray, mask: int) -> np.ndarray:
    out = np.zeros(len(fp), np.uint64)
    for j, b in enumerate(i for i in range(64) if mask >> i & 1):
        out |= (fp >> np.uint64(b) & np.uint64(1)) << np.uint64(j)
    return out


def links(distinct: DataFrame, radius: int = 2) -> DataFrame:
    """Edges ``(a, b)`` between distinct fingerprints ``fp`` whose components are
    those of all pairs within ``radius`` bits."""
    masks = block_masks(radius)
    keyed = distinct.select("fp", F.explode(F.array(*(
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(~m & (1 << 64) - 1))).alias("key"))
        for t, m in enumerate(masks)))).alias("k")).select("fp", "k.t", "k.key")
    dealt = keyed.repartition(F.col("t"), F.col("key")).sortWithinPartitions("t", "key", "fp")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        """Rows (t, key, fp) in pieces that end at a bucket's end."""
        rest = np.zeros((3, 0), np.int64)
        for batch in batches:
            now = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (1, 2, 0)])
            rest = np.concatenate([rest, now], axis=1)
            new = np.flatnonzero((rest[0, 1:] != rest[0, :-1]) | (rest[1, 1:] != rest[1, :-1]))
            if len(new) and rest.shape[1] >= 1 << 17:
                yield rest[:, :new[-1] + 1]
                rest = rest[:, new[-1] + 1:]
        yield rest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, key, fp in chunks(batches):
            for choice in np.unique(t):
                own = np.flatnonzero(t == choice)
                k = key[own]
                shared = np.zeros(len(own), bool)  # rows alone in their bucket have nobody to meet
                same = k[1:] == k[:-1]
                shared[1:] |= same
                shared[:-1] |= same
                own = own[shared]
                if not len(own):
                    continue
                mask = masks[int(choice)]
                values = fp[own].view(np.uint64)
                child, parent = bucket_links(key[own], _free_bits(values, mask), mask.bit_count(), radius)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(fp[own][child]), pa.array(fp[own][parent])], names=schema.names)

    return map_batches(dealt, run, schema)


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
                    shingle: int = 3, radius: int = 2) -> DataFrame:
    """``(id, fp, component)`` for every row; component: the smallest id reachable."""
    prints = written(fingerprints(docs, id_column, text, shingle), "simhash", few=False)
    by_print = written(prints.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
    edges = written(links(by_print.select("fp"), radius).distinct(), "simhash-links")
    roots = written(connected_components(edges), "simhash-roots")
    member = by_print.join(roots, by_print.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    member = written(member, "simhash-member")
    class_id = written(member.groupBy("root").agg(F.min("least").alias("component")), "simhash-class")
    of_print = written(member.join(class_id, "root").select("fp", "component"), "simhash-of")
    return prints.join(of_print, "fp").select("id", "fp", "component")


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text",
             shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row of each group of near-duplicates, all columns unchanged: that of the
    smallest id (rows without id come last; of equal ids the text with the smaller
    128-bit hash).  Rows are named by id and text, so a text that shares its id with
    a near copy of another document stays; of rows equal in both one stays."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    own, body = names[docs.columns.index(id_column)], names[docs.columns.index(text)]
    address = F.unhex(F.substring(F.sha2(F.coalesce(F.col(body).cast("string"), F.lit("")), 256), 1, 32))
    keyed = docs.toDF(*names).withColumn("_address", address)
    name = F.struct(F.col(own).isNull().alias("none"), F.col(own).alias("id"), F.col("_address").alias("address"))
    groups = near_duplicates(keyed.withColumn("_name", name), "_name", body, shingle, radius)
    first = written(groups.where(F.col("id").eqNullSafe(F.col("component"))).select(
        F.col("id.id").alias("_first"), F.col("id.address").alias("_at")).distinct(), "simhash-first")
    kept = keyed.join(first, (F.col("_address") == F.col("_at")) & F.col(own).eqNullSafe(F.col("_first")), "left_semi")
    return kept.dropDuplicates(["_address"]).select(*names).toDF(*docs.columns)
