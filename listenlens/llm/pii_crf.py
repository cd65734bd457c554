"""Personal data by patterns and a skip-chain conditional random field.

Patterns give the base spans (email, ip, card, phone).  The field then labels
the tokens with digits or ``@`` that no base span covers: neighbouring tokens
share chain potentials, and all tokens of a document with the same or similar
content (the same last four digits, the same local part of an address, or equal text
without outer punctuation) are linked by skip edges from each occurrence to the next,
however distant.  Loopy sum-product
message passing, whose rounds sweep over whole runs of neighbours and over all
occurrences from the first to the last and back, makes an entity's mentions agree: the tokens of a number that was
recognised once are found again where its form is broken or abridged.  Base
spans are evidence and always stay; a run of adjacent tokens that get the same
label becomes a further span.

The weights are trained here on a bounded sample whose labels are the base
spans.  It is drawn by a hash of id and text over the whole table, holds texts of
each kind of base span that the table has, and takes about as many tokens from each
text; where the rows lie decides nothing.  A sampled text gets broken repeats of some of
its own mentions, which carry their label, and as many broken forms of entities that it
does not mention, which carry none: what a token looks like cannot tell them apart, the
skip edges have to.  The weights are multinomial logistic node weights, and smoothed association of the labels
at the ends of chain and skip edges.

Defined results
---------------
* null text: empty, no span;
* equal or null ids and repeated rows: one result row per row;
* positions: code points, end exclusive; very long texts are read whole, all
  scans are linear in the text;
* a table without base spans: no further spans;
* empty table: empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listenlens.llm.common import map_batches, py_texts, written

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
Span = tuple[str, int, int]

DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
GROUPED = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PLUS = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")
TOKEN = re.compile(r"[^\x20\x09-\x0D]++")
CLUE = re.compile(r"[0-9@]")


def emails(text: str) -> list[Span]:
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        a = at
        while a > last and text[a - 1] in LOCAL:
            a -= 1
        domain = DOMAIN.match(text, at + 1) if a < at else None
        if domain:
            found.append(("email", a, last := domain.end()))
        else:
            last = at + 1  # no match holds this "@", and none crosses it
        at = text.find("@", max(at + 1, last))
    return found


def addresses(text: str) -> list[Span]:
    found = []
    for run in DOTTED.finditer(text):  # a run's parts are taken four at a time
        parts, a = run[0].split("."), run.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = a + len(".".join(four))
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                found.append(("ip", a, end))
            a = end + 1
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def cards(text: str) -> list[Span]:
    found = []
    for run in GROUPED.finditer(text):
        if run.end() - run.start() >= 14:
            digits = NOT_DIGIT.sub("", run[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", run.start(), run.end()))
    return found


def phones(text: str) -> list[Span]:
    return [("phone", m.start(), m.end()) for m in PLUS.finditer(text) if 10 <= len(NOT_DIGIT.sub("", m[0])) <= 15]


def base_spans(text: str) -> list[Span]:
    """All base spans by start, then kind as listed."""
    if not CLUE.search(text):
        return []
    found = (emails(text) if "@" in text else []) + addresses(text) + cards(text) + (phones(text) if "+" in text else [])
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


@dataclass
class Graph:
    """Tokens with a clue, their features, evidence and edges."""
    starts: np.ndarray
    ends: np.ndarray
    digits: list[str]
    x: np.ndarray
    label: np.ndarray  # from the base spans; 0: none
    seen: np.ndarray  # covered by a base span
    chain: np.ndarray  # edges (m, 2)
    skip: np.ndarray


N_FEATURES = 21


def _features(token: str, digits: str, before: bool, after: bool) -> list[float]:
    n = len(digits)
    row = [1.0, "@" in token, token.count(".") == 3, token[0] == "+", "(" in token or ")" in token, "-" in token,
           any(c.isalpha() for c in token), token.rpartition("@")[2].count(".") > 0, n >= 12 and luhn(digits), before, after]
    bins = [0.0] * 10
    bins[min(n, 4) if n < 5 else 5 if n < 7 else 6 if n < 10 else 7 if n < 14 else 8 if n < 20 else 9] = 1.0
    return [float(v) for v in row] + bins


def _entity(word: str, digits: str) -> str:
    """What similar tokens have in common: the last digits of a number, else the local
    part of an address, else the text."""
    word = word.strip(".,;:!?\"'()[]{}<>#*$%&|").lower()
    if "@" in word:
        return word.partition("@")[0] + "@"
    return digits[-4:] if len(digits) >= 3 else word


def build_graph(text: str, base: list[Span]) -> Graph | None:
    tokens = [(i, m.start(), m.end()) for i, m in enumerate(TOKEN.finditer(text)) if CLUE.search(text, m.start(), m.end())]
    if not tokens:
        return None
    n = len(tokens)
    words = [text[a:b] for _, a, b in tokens]
    digits = [NOT_DIGIT.sub("", w) for w in words]
    place = np.array([t[0] for t in tokens])
    starts, ends = np.array([t[1] for t in tokens]), np.array([t[2] for t in tokens])
    near = np.diff(place) == 1
    x = np.array([_features(w, d, i > 0 and bool(near[i - 1]), i < n - 1 and bool(near[i]))
                  for i, (w, d) in enumerate(zip(words, digits))])
    label, seen = np.zeros(n, np.int64), np.zeros(n, bool)
    for kind, a, b in base:
        over = slice(int(np.searchsorted(ends, a, side="right")), int(np.searchsorted(starts, b)))
        label[over], seen[over] = LABELS.index(kind), True
    last: dict[str, int] = {}
    skip = []
    for i, (w, d) in enumerate(zip(words, digits)):
        key = _entity(w, d)
        if key in last:
            skip.append((last[key], i))
        last[key] = i
    chain = np.flatnonzero(near)
    return Graph(starts, ends, digits, x, label, seen, np.stack([chain, chain + 1], axis=1),
                 np.array(skip, np.int64).reshape(-1, 2))


@dataclass(frozen=True)
class Field:
    """Node weights (labels x features) and edge potentials (labels x labels)."""
    node: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def marginals(self, g: Graph, rounds: int | None = None, damping: float = 0.3) -> np.ndarray:
        """Loopy sum-product; base spans clamp their tokens.

        A round sums exactly over every run of neighbours and then over every
        sequence of occurrences, at any length: evidence passes all of an entity's
        mentions in one.  Rounds go on until the messages change by less than 1e-4,
        ``rounds`` at most (by default ``ROUNDS`` and one for each sequence)."""
        unary = g.x @ self.node.T
        unary[g.seen] = -30.0
        unary[g.seen, g.label[g.seen]] = 0.0
        own = np.exp(np.maximum(unary - unary.max(axis=1, keepdims=True), -300.0))
        chain, skip = _Paths(g.chain, len(own)), _Paths(g.skip, len(own))
        if rounds is None:
            rounds = ROUNDS + skip.number
        of_chain, of_skip = np.exp(self.chain), np.exp(self.skip)
        messages = np.ones((2, *own.shape))  # along the skip edges, forward and backward
        for _ in range(rounds):
            near = chain.sweep(own * messages[0] * messages[1], of_chain)
            if not len(g.skip):
                break
            new = skip.sweep(own * near[0] * near[1], of_skip)
            change = np.abs(np.log(new) - np.log(messages)).max()
            messages = messages ** damping * new ** (1 - damping)
            if change < 1e-4:
                break
        near = chain.sweep(own * messages[0] * messages[1], of_chain)
        belief = own * messages[0] * messages[1] * near[0] * near[1]
        return belief / belief.sum(axis=1, keepdims=True)


#: Rounds of message passing that any text has at most, besides one for each sequence of occurrences.
ROUNDS = 60


class _Paths:
    """Edges that form disjoint paths (each node has one next and one previous at
    most), laid out by the nodes' places in them, long paths first."""

    def __init__(self, edges: np.ndarray, n: int):
        before = np.full(n, -1)
        before[edges[:, 1]] = edges[:, 0]
        path, place = np.arange(n), np.zeros(n, np.int64)
        for node in np.sort(edges[:, 1]).tolist():  # a node's previous one has a smaller number
            path[node], place[node] = path[before[node]], place[before[node]] + 1
        length = np.bincount(path, minlength=n)
        self.order = np.lexsort((path, -length[path], place))
        self.number = int((length > 1).sum())
        self.starts = np.r_[0, np.cumsum(np.bincount(place, minlength=1))].tolist()

    def sweep(self, weight: np.ndarray, potential: np.ndarray) -> np.ndarray:
        """Messages from the previous and from the next node, each summing to one
        (ones where there is none)."""
        w, starts = weight[self.order], self.starts
        forward, backward = np.ones_like(w), np.ones_like(w)
        for d in range(1, len(starts) - 1):
            a, b, c = starts[d - 1], starts[d], starts[d + 1]
            m = (w[a:a + c - b] * forward[a:a + c - b]) @ potential
            forward[b:c] = m / m.sum(axis=1, keepdims=True)
        for d in range(len(starts) - 2, 0, -1):
            a, b, c = starts[d - 1], starts[d], starts[d + 1]
            m = (w[b:c] * backward[b:c]) @ potential.T
            backward[a:a + c - b] = m / m.sum(axis=1, keepdims=True)
        out = np.empty((2, *w.shape))
        out[0, self.order], out[1, self.order] = forward, backward
        return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


#: Digits that a further span has at least and at most, and its least probability.
LEAST_DIGITS = {"email": 0, "ip": 4, "card": 14, "phone": 7}
MOST_DIGITS = {"email": 64, "ip": 12, "card": 19, "phone": 15}
LEAST_PROBABILITY = 0.7


def further_spans(text: str, base: list[Span], field: Field) -> list[Span]:
    """Runs of adjacent unseen tokens with the same label, as long as their digits
    can be one entity's."""
    g = build_graph(text, base)
    if g is None or g.seen.all():
        return []
    p = field.marginals(g)
    label = np.where(g.seen | (p.max(axis=1) < LEAST_PROBABILITY), 0, p.argmax(axis=1))
    near = set(g.chain[:, 0].tolist())
    found, i = [], 0
    while i < len(label):
        j, n = i, len(g.digits[i])
        while label[i] and j in near and label[j + 1] == label[i] and (
                n + len(g.digits[j + 1]) <= MOST_DIGITS[LABELS[label[i]]]):
            j += 1
            n += len(g.digits[j])
        if label[i]:
            kind, a, b = LABELS[label[i]], int(g.starts[i]), int(g.ends[j])
            body = text[a:b]
            a += len(body) - len(body.lstrip(".,;:!?\"'[]{}<>#*$%&|)"))
            b -= len(body) - len(body.rstrip(".,;:!?\"'[]{}<>#*$%&|("))
            if a < b and n >= LEAST_DIGITS[kind] and (kind != "email" or "@" in text[a:b]):
                found.append((kind, a, b))
        i = j + 1
    return found


#: Sampled texts of each kind, if the table has so many.
PER_KIND = 64


def sample(docs: DataFrame, id_column: str, text: str, max_documents: int, seed: int) -> DataFrame | None:
    """``(u, text)`` of at most ``max_documents`` distinct rows with a clue, those with
    the smallest hashes ``u`` of each kind and of all; None without a base span in
    the whole table."""
    u = F.xxhash64(F.lit(seed), F.col(id_column), F.col(text))
    rows = docs.select(u.alias("u"), F.col(text).alias("text")).where(F.col("text").rlike("[0-9@]"))
    schema = T.StructType([T.StructField("u", T.LongType()), T.StructField("kinds", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = [sum(1 << KINDS.index(k) for k in {k for k, _, _ in base_spans(t)}) for t in py_texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kinds, pa.int32())], names=schema.names)

    scanned = written(map_batches(rows, run, schema).distinct(), "pii-kinds")
    count = {r["kinds"]: r["count"] for r in scanned.groupBy("kinds").count().collect()}  # 16 rows at most
    if not any(count):
        return None
    bits, least = [1 << k for k in range(len(KINDS))], max(1, min(PER_KIND, max_documents // (2 * len(KINDS))))

    def among(wanted: int, n: int):  # about 4 * wanted rows of n, or all
        share = 4 * wanted / max(n, 1)
        return F.lit(True) if share >= 1 else F.col("u") < F.lit(int(share * 2**64) - 2**63)

    near = among(max_documents, sum(count.values()))
    for bit in bits:
        of_kind = sum(n for kinds, n in count.items() if kinds & bit)
        near = near | ((F.col("kinds").bitwiseAND(bit) > 0) & among(least, of_kind))
    found = sorted((r["u"], r["kinds"]) for r in scanned.where(near).collect())  # bounded by the shares
    taken = {v for bit in bits for v in [v for v, kinds in found if kinds & bit][:least]}
    rest = [v for v, _ in found if v not in taken][:max(0, max_documents - len(taken))]
    chosen = F.col("u").isin(sorted(taken))
    if rest:
        chosen = chosen | (F.col("u") <= rest[-1])  # all up to there are taken
    return written(rows.where(chosen).dropDuplicates(["u"]), "pii-sample")


def quota(sizes: list[int], total: int) -> int:
    """The largest number of tokens a text can give so that all give ``total`` at most."""
    left = total
    for k, n in enumerate(sizes := sorted(sizes)):
        if n * (len(sizes) - k) > left:
            return max(1, left // (len(sizes) - k))
        left -= n
    return max(sizes, default=1)


#: Mentions of a sampled text that are repeated in a broken form, at most.
PLANTS = 4
COUNTRY = re.compile(r"\+[0-9]+[\x20.-]*")


def broken(kind: str, mention: str, draw: int) -> str:
    """A mention as a text may repeat it where the pattern fails: abridged or with
    other separators.  ``draw`` chooses the form."""
    digits = NOT_DIGIT.sub("", mention)
    if kind == "email":
        local, _, domain = mention.partition("@")
        return f"{local}@{domain.partition('.')[0]}"
    if kind == "ip":
        return mention.replace(".", ",-/"[draw % 3])
    if kind == "card":
        return [f"{digits[:4]}/{digits[4:8]}/{digits[8:12]}/{digits[12:]}", f"{digits[:-4]}.{digits[-4:]}", f"#{digits}x"][draw % 3]
    local = COUNTRY.sub("", mention) or digits
    return [local, f"{digits[-10:-7]}.{digits[-7:-4]}.{digits[-4:]}", f"{digits[-7:-4]}-{digits[-4:]}"][draw % 3]


def stranger(mention: str, draw: np.random.Generator) -> str:
    """Another entity of the same form."""
    swap = {**{c: str(draw.integers(10)) for c in "0123456789"},
            **{c: chr(97 + draw.integers(26)) for c in "abcdefghijklmnopqrstuvwxyz"}}
    return "".join(str(draw.integers(10)) if c.isdigit() else swap.get(c, c) for c in mention)


def planted(text: str, base: list[Span], seed: int) -> tuple[str, list[Span], int]:
    """The text with broken repeats of at most ``PLANTS`` of its mentions and as many of
    strangers behind it, the spans of the mentions and their repeats, and the text's
    length before.  Repeats that are base spans themselves are left out."""
    draw = np.random.default_rng(seed & 0xFFFFFFFF)
    spans, parts, at = list(base), [text], len(text)
    for j in draw.permutation(len(base))[:PLANTS]:
        kind, a, b = base[j]
        if b - a > 256:  # a token of that length is no repeat
            continue
        form = int(draw.integers(3))
        for mention, label in ((text[a:b], kind), (stranger(text[a:b], draw), None)):
            repeat = broken(kind, mention, form)
            if base_spans(repeat):
                continue
            parts.append(f" again {repeat} and")
            if label:
                spans.append((label, at + 7, at + 7 + len(repeat)))
            at += len(parts[-1])
    return "".join(parts), spans, len(text)


def _picked(label: np.ndarray, most: int, must: np.ndarray = np.empty(0, np.int64)) -> list[int]:
    """Places in ``must`` and of the first token of each label, then evenly spaced ones."""
    if len(label) <= most:
        return list(range(len(label)))
    first = must.tolist() + np.unique(label, return_index=True)[1].tolist()
    first = list(dict.fromkeys(first))
    even = np.linspace(0, len(label) - 1, most).astype(int).tolist()
    return sorted(list(dict.fromkeys(first + even))[:max(most, len(first))])


def train(docs: DataFrame, text: str, max_documents: int = 4000, max_tokens: int = 40_000, seed: int = 5,
          id_column: str = "doc_id") -> Field | None:
    """Weights from at most ``max_documents`` sampled texts with a clue and about
    ``max_tokens`` of their tokens, besides those of the planted repeats; None without a base span in the table."""
    texts = sample(docs, id_column, text, max_documents, seed)
    if texts is None:
        return None
    size = T.StructType([T.StructField("n", T.LongType())])

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [sum(1 for m in TOKEN.finditer(t) if CLUE.search(t, m.start(), m.end())) for t in py_texts(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64())], names=size.names)

    most = quota([r["n"] for r in map_batches(texts.select("text"), tokens, size).collect()], max_tokens)
    schema = T.StructType([T.StructField("u", T.LongType()), T.StructField("i", T.IntegerType()),
                           T.StructField("x", T.ArrayType(T.DoubleType())), T.StructField("label", T.IntegerType()),
                           T.StructField("chain", T.IntegerType()), T.StructField("skip", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for u, t in zip(batch.column(0).to_pylist(), py_texts(batch.column(1))):
                t, spans, own = planted(t, base_spans(t), u)
                if g := build_graph(t, spans):
                    after = np.flatnonzero(g.starts >= own)
                    must = np.union1d(after, g.skip[np.isin(g.skip[:, 1], after), 0])
                    ends = [dict(e.tolist()) for e in (g.chain, g.skip)]  # a token's next in chain and skip
                    rows += [(u, i, g.x[i].tolist(), int(g.label[i]), *(int(g.label[e[i]]) if i in e else None for e in ends))
                             for i in _picked(g.label, most, must)]
            columns = zip(*rows) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, f) for c, f in zip(columns, (
                pa.int64(), pa.int32(), pa.list_(pa.float64()), pa.int32(), pa.int32(), pa.int32()))], names=schema.names)

    rows = sorted(map_batches(texts, run, schema).collect(), key=lambda r: (r["u"], r["i"]))
    y = np.array([r["label"] for r in rows], np.int64)
    x = np.array([r["x"] for r in rows])
    target = np.eye(len(LABELS))[y]
    node = np.zeros((len(LABELS), N_FEATURES))
    for _ in range(400):  # gradient ascent with weight decay
        z = x @ node.T
        q = np.exp(z - _log_sum(z, axis=1)[:, None])
        node += 1.0 * ((target - q).T @ x / len(x) - 1e-4 * node)
    return Field(node, *(_association(y, [r[k] for r in rows]) for k in ("chain", "skip")))


def _association(first: np.ndarray, second: list) -> np.ndarray:
    """Log ratio of the joint frequency of two labels to their independence."""
    joint = np.full((len(LABELS), len(LABELS)), 0.5) + 2 * np.eye(len(LABELS))
    for a, b in zip(first, second):
        if b is not None:
            joint[a, b] += 1
    joint /= joint.sum()
    return np.clip(np.log(joint) - np.log(joint.sum(axis=1))[:, None] - np.log(joint.sum(axis=0))[None], -4, 4)


def find(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **training) -> DataFrame:
    """``(id, n_<kind>..., base_sha256, spans)`` of every row."""
    field = train(docs, text, id_column=id_column, **training)
    source = docs.select(F.col(id_column).alias(id_column), F.col(text).alias("_text"))
    counts = [f"n_{k}" for k in KINDS]
    schema = T.StructType([source.schema[id_column]] + [T.StructField(n, T.LongType()) for n in counts]
                          + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t in py_texts(batch.column(1)):
                base = base_spans(t)
                more = further_spans(t, base, field) if field is not None else []
                spans = sorted(base + more, key=lambda s: (s[1], KINDS.index(s[0])))
                kinds = [k for k, _, _ in base]
                rows.append((*(kinds.count(k) for k in KINDS), sha256(joined(base).encode()).hexdigest(), joined(spans)))
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:4]),
                 *(pa.array(c, pa.string()) for c in columns[4:])], names=schema.names)

    return map_batches(source, run, schema)
