"""Language-model scores by context-tree weighting.

A text is the bytes of its words, A-Z lower-cased, each followed by one space,
and one end byte.  Every byte is eight binary decisions.  Each decision has a
tree over the preceding bytes, DEPTH deep; every node keeps a
Krichevsky-Trofimov estimate, and a node's weighted probability is half its own
estimate and half the product of its children.  Scores mix the estimates of all
depths along a path with the weights that training gave them; a node without
training bits is no part of a path.

The trees follow from the counts of byte sequences, which grow with the corpus
and are never sent to the driver or to every executor.  Documents are handled in
chunks.  A chunk offers its distinct sequences and words with their training
counts; shards add these up; the sums, grouped by the last two bytes of context,
give the trees; and the shards answer every chunk what it offered.  Contexts of
two bytes with more than `hot` sequences are split by the third byte: their trees
are grown from depth 3, and what these hand to depth 2 is added up first, at most
255 nodes for each of at most 65,536 contexts.  Only the nodes of depth 0 and 1,
at most 65,535 of each kind, pass through the driver.

Chunks and shards grow in number with the input (CHUNK_BYTES and SHARD_BYTES of
text each).  A chunk has a row for each shard that one of its sequences belongs
to, never more than it has distinct sequences and words.

The unigram base: sum over words and one end of log10((c + 0.5) / (N + 0.5 (V + 1))).

Null and empty texts are the end alone.  Repeated rows count and are scored one
by one.  Rows without doc_id have the text "" as key of their fold.  An empty
table gives an empty result.  Extra columns are ignored."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as V
from .common import chunk_count, input_bytes, materialize, with_chunk

U = np.uint64
DEPTH = 5
#: Larger chunks repeat fewer sequences.
CHUNK_BYTES = 8 << 20
#: Bytes of text whose distinct sequences and words one shard adds up.
SHARD_BYTES = 48 << 20
#: Sequences of one context of two bytes that one task takes whole, and of all contexts that a task is dealt on average.
HOT, DEALT = 400_000, 400_000
END, GAP = 10, 32
SEQUENCE, WORD, DOCS = 0, 1, 2
OFFERS = "chunk int, shard int, kind int, keys binary, counts binary"
ANSWERS = "chunk int, kind int, keys binary, values binary"
WORDS = ANSWERS + ", vocabulary long, tokens long, docs long"
UNITS = "pair long, sub int, shard int, keys binary, counts binary"
ROOTS = "pair long, node long, n0 double, n1 double, children double"
ABOVE = "node long, n0 double, n1 double, own double, weighted double"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, n_bytes long, base_score double, score double"


def spelled(data: np.ndarray, off: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(sequence before and at every byte, its document; word hashes, their document).

    A sequence has the last context byte on top and the byte itself at the bottom."""
    starts, ends, doc = V.words(data, off)
    n = len(off) - 1
    count = np.bincount(doc, minlength=n)
    size = depth + 1 + np.bincount(doc, weights=ends - starts + 1, minlength=n).astype(np.int64)
    base = np.cumsum(size) - size
    ahead = np.cumsum(ends - starts + 1) - (ends - starts + 1)
    first = np.cumsum(count) - count
    place = base[doc] + depth + ahead - (ahead[first[doc]] if len(doc) else 0)
    out = np.full(int(size.sum()), END, np.uint8)
    src = np.flatnonzero(~V.SPACE[data])
    opened = np.zeros(len(data) + 1, np.int64)
    opened[starts] = 1
    word = np.cumsum(opened)[src] - 1
    low = data.copy()
    low[(data >= 65) & (data <= 90)] += 32
    out[place[word] + src - starts[word]] = low[src]
    out[place + ends - starts] = GAP
    keep = np.ones(len(out), bool)
    keep[(base[:, None] + np.arange(depth)).ravel()] = False
    at = np.flatnonzero(keep)
    key = np.zeros(len(at), U)
    for k in range(1, depth + 1):
        key = (key << U(8)) | out[at - k].astype(U)
    key = (key << U(8)) | out[at].astype(U)
    return key, np.repeat(np.arange(n), size - depth), V.hashes(data, starts, ends, V.LOWER), doc


def pack(values: np.ndarray) -> bytes:
    """Whole numbers as compressed planes of bytes (sorted keys: of their differences, which pack() is given)."""
    planes = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def pack_keys(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=U(0)))


def unpack_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(unpack(raw), dtype=U)


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and how often each is there."""
    keys = np.sort(keys)
    at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[at], np.diff(np.r_[at, len(keys)])


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sum of their counts."""
    if not keys:
        return np.zeros(0, U), np.zeros(0, np.int64)
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return key[at], np.add.reduceat(count, at) if len(at) else np.zeros(0, np.int64)


def _offer(shards: int, depth: int):
    def offer(table: pa.Table) -> pa.Table:
        train = ~table.column("held_out").to_numpy()
        found: dict[int, tuple[list, list]] = {SEQUENCE: ([], []), WORD: ([], [])}
        data, off = V.flat(table.column("text"))
        for first, _, part, offsets in V.slices(data, off):
            key, key_doc, word, word_doc = spelled(part, offsets, depth)
            for kind, what, doc in ((SEQUENCE, key, key_doc), (WORD, word, word_doc)):
                learn = train[first + doc]
                distinct, n = _counted(what[learn])
                other, _ = _counted(what[~learn])
                found[kind][0].extend([distinct, other])
                found[kind][1].extend([n, np.zeros(len(other), np.int64)])
        chunk, rows = table.column("chunk")[0].as_py(), []
        for kind, (keys, counts) in found.items():
            key, count = _merge(keys, counts)
            shard = (V.mix(key) % U(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[order], np.arange(shards + 1))
            rows += [(chunk, s, kind, pack_keys(key[i]), pack(count[i])) for s in range(shards) if len(i := order[cuts[s] : cuts[s + 1]])]
        rows.append((chunk, 0, DOCS, pack_keys(np.zeros(0, U)), pack(np.array([train.sum()]))))
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
        return pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(zip(("chunk", "shard", "kind", "keys", "counts"), kinds, strict=True))})

    return offer


def _unpack(table: pa.Table, kind: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    rows = zip(table.column("chunk").to_pylist(), table.column("kind").to_pylist(), table.column("keys").to_pylist(), table.column("counts").to_pylist(), strict=True)
    return [(c, unpack_keys(k), unpack(n).astype(np.int64)) for c, found, k, n in rows if found == kind]


def _answer_words(table: pa.Table) -> pa.Table:
    """One shard: total counts to every chunk that has the word, and the shard's words and tokens as chunk -1."""
    offers = _unpack(table, WORD)
    key, count = _merge([k for _, k, _ in offers], [n for _, _, n in offers])
    rows = [(c, WORD, pack_keys(k), pack(count[np.searchsorted(key, k)])) for c, k, _ in offers]
    docs = sum(int(n.sum()) for _, _, n in _unpack(table, DOCS))
    out = _answers([*rows, (-1, DOCS, b"", b"")])
    for name, value in (("vocabulary", (count > 0).sum()), ("tokens", count.sum()), ("docs", docs)):
        out = out.append_column(name, pa.array([None] * len(rows) + [int(value)], pa.int64()))
    return out


def _answers(rows: list[tuple]) -> pa.Table:
    kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
    return pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(zip(("chunk", "kind", "keys", "values"), kinds, strict=True))})


def _sums(table: pa.Table) -> pa.Table:
    """One shard: its distinct sequences, one row for each two last bytes of context."""
    offers = _unpack(table, SEQUENCE)
    key, count = _merge([k for _, k, _ in offers], [n for _, _, n in offers])
    depth_bits = table.column("bits")[0].as_py()
    pair = (key >> U(depth_bits)).astype(np.int64)
    at = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]]) if len(pair) else np.zeros(0, np.int64)
    ends = np.r_[at[1:], len(pair)].astype(np.int64)
    return _units(pair[at], np.zeros(len(at), np.int64), [table.column("shard")[0].as_py()] * len(at), key, count, at, ends)


def _units(pair: np.ndarray, sub: np.ndarray, shard: list[int], key: np.ndarray, count: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Table:
    runs = list(zip(starts.tolist(), ends.tolist(), strict=True))
    return pa.table({
        "pair": pa.array(pair, pa.int64()), "sub": pa.array(sub, pa.int32()), "shard": pa.array(shard, pa.int32()),
        "keys": pa.array([key[a:b].tobytes() for a, b in runs], pa.binary()), "counts": pa.array([count[a:b].tobytes() for a, b in runs], pa.binary()),
    })


def _split(depth: int):
    """Sequences of a context of two bytes by the third one."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair, shard, keys, counts in zip(*(batch.column(c).to_pylist() for c in ("pair", "shard", "keys", "counts")), strict=True):
                key, count = np.frombuffer(keys, U), np.frombuffer(counts, np.int64)
                third = ((key >> U(8 * (depth - 2))) & U(255)).astype(np.int64)  # sorted, as the keys are
                at = np.flatnonzero(np.r_[True, third[1:] != third[:-1]])
                out = _units(np.full(len(at), pair), third[at], [shard] * len(at), key, count, at, np.r_[at[1:], len(key)])
                yield from out.to_batches()

    return split


_HALF_LOG_PI = 0.5 * math.log(math.pi)
_SMALL = np.array([math.lgamma(i / 2 + 0.5) for i in range(0, 4096)])


def _lgamma_half(n: np.ndarray) -> np.ndarray:
    """log Gamma(n + 1/2) of whole n."""
    x = n + 0.5
    with np.errstate(divide="ignore", invalid="ignore"):
        big = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3)
    return np.where(n < 2000, _SMALL[np.minimum(2 * n, 4094).astype(np.int64)], big)


def _lgamma_next(n: np.ndarray) -> np.ndarray:
    """log Gamma(n + 1) of whole n."""
    x = n + 1.0
    big = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3)
    return np.where(n < 2000, _SMALL[np.minimum(2 * n + 1, 4095).astype(np.int64)], big)


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    return _lgamma_half(n0) + _lgamma_half(n1) - 2 * _HALF_LOG_PI - _lgamma_next(n0 + n1)


class Level:
    """The nodes of one depth: (context, decision) with bit counts and weights."""

    def __init__(self, key: np.ndarray, count: np.ndarray, depth: int, d: int):
        context, byte = key >> U(8 * (depth - d + 1)), key & U(255)
        bits = np.arange(8)
        decision = (U(1) << bits.astype(U)) | (byte[:, None] >> (U(8) - bits.astype(U)))
        node = (context[:, None] << U(8)) | decision
        self.node, back = np.unique(node.ravel(), return_inverse=True)
        self.of = back.reshape(node.shape)
        self.bit = ((byte[:, None] >> (U(7) - bits.astype(U))) & U(1)).astype(bool)
        n = np.repeat(count[:, None], 8, axis=1)
        self.n1 = np.bincount(back, weights=(n * self.bit).ravel(), minlength=len(self.node))
        self.n0 = np.bincount(back, weights=(n * ~self.bit).ravel(), minlength=len(self.node))
        self.kt = log_kt(self.n0, self.n1)

    def weigh(self, deeper: "Level | None") -> None:
        if deeper is None:
            self.weighted, self.own = self.kt, np.ones(len(self.node))
            return
        parent = np.searchsorted(self.node, ((deeper.node >> U(16)) << U(8)) | (deeper.node & U(255)))
        children = np.bincount(parent, weights=deeper.weighted, minlength=len(self.node))
        self.weighted = np.logaddexp(self.kt, children) - math.log(2)
        self.own = np.exp(self.kt - math.log(2) - self.weighted)

    def estimate(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(probability of each decision's bit, weight of the node's own estimate, whether it was trained) by key and bit."""
        n0, n1 = self.n0[self.of], self.n1[self.of]
        return (np.where(self.bit, n1, n0) + 0.5) / (n0 + n1 + 1), self.own[self.of], n0 + n1 > 0


def grow(key: np.ndarray, count: np.ndarray, depth: int, first: int = 2) -> list[Level]:
    """Levels `first` to depth over sorted distinct sequences."""
    levels = [Level(key, count, depth, d) for d in range(first, depth + 1)]
    for i in range(len(levels) - 1, -1, -1):
        levels[i].weigh(levels[i + 1] if i + 1 < len(levels) else None)
    return levels


def _gather(table: pa.Table) -> Iterator[tuple[bool, np.ndarray, np.ndarray, np.ndarray]]:
    """(whether their contexts are split, sequences, counts, shards): whole contexts together, and those that are split."""
    hot = table.column("hot").to_numpy(zero_copy_only=False)
    for split in (False, True):
        part = table.filter(pa.array(hot == split))
        if part.num_rows:
            keys = [np.frombuffer(k, U) for k in part.column("keys").to_pylist()]
            key, count = np.concatenate(keys), np.concatenate([np.frombuffer(n, np.int64) for n in part.column("counts").to_pylist()])
            shard = np.repeat(part.column("shard").to_numpy(), [len(k) for k in keys])
            order = np.argsort(key, kind="stable")
            yield split, key[order], count[order], shard[order]


def _roots(depth: int):
    def roots(table: pa.Table) -> pa.Table:
        """Counts and weighted probability of some contexts, added up by their last byte (pair -1) or, of split ones, their last two."""
        out = {c: [] for c in ("pair", "node", "n0", "n1", "children")}
        for split, key, count, _ in _gather(table):
            top = grow(key, count, depth, 3 if split else 2)[0]
            context, decision = (top.node >> U(16)).astype(np.int64), (top.node & U(255)).astype(np.int64)
            group, back = np.unique(context * 256 + decision, return_inverse=True)
            out["pair"].append(group >> 8 if split else np.full(len(group), -1))
            out["node"].append(group)
            for name, x in (("n0", top.n0), ("n1", top.n1), ("children", top.weighted)):
                out[name].append(np.bincount(back, weights=x, minlength=len(group)))
        return pa.table({name: pa.array(np.concatenate(x)) for name, x in out.items()})

    return roots


def _second(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Nodes of depth 2 of split contexts, from what their parts hand up."""
    for rows in batches:
        kt = log_kt(rows["n0"].to_numpy(), rows["n1"].to_numpy())
        weighted = np.logaddexp(kt, rows["children"].to_numpy()) - math.log(2)
        yield pd.DataFrame({"node": rows["node"], "n0": rows["n0"], "n1": rows["n1"], "own": np.exp(kt - math.log(2) - weighted), "weighted": weighted})


def top_levels(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(estimate of a one, weight of the own estimate) at depth 1 by [last byte, decision] and at depth 0 by [decision]."""
    n0, n1, children = (np.zeros((256, 256)) for _ in range(3))
    at = (rows["node"].to_numpy() // 256, rows["node"].to_numpy() % 256)
    n0[at], n1[at], children[at] = rows["n0"], rows["n1"], rows["children"]
    kt = log_kt(n0, n1)
    weighted = np.logaddexp(kt, children) - math.log(2)
    z0, z1, below = n0.sum(axis=0), n1.sum(axis=0), weighted.sum(axis=0)
    kt0 = log_kt(z0, z1)
    own0 = np.exp(kt0 - np.logaddexp(kt0, below))
    one = np.where(n0 + n1 > 0, (n1 + 0.5) / (n0 + n1 + 1), np.nan)
    return one, np.exp(kt - np.logaddexp(kt, children)), (z1 + 0.5) / (z0 + z1 + 1), own0


def code_length(key: np.ndarray, count: np.ndarray, depth: int, top: tuple, above: pd.DataFrame | None = None) -> np.ndarray:
    """log10 probability of the byte of every sequence after its context.

    above: the nodes of depth 2, sorted, where these sequences are a part of a split context's."""
    levels = grow(key, count, depth, 2 if above is None else 3)
    p = np.full((len(key), 8), np.nan)
    for level in reversed(levels):
        estimate, own, trained = level.estimate()
        mixed = np.where(np.isnan(p), estimate, own * estimate + (1 - own) * p)
        p = np.where(trained, mixed, p)
    bit, decision = levels[0].bit, (levels[0].node & U(255)).astype(np.int64)[levels[0].of]
    if above is not None:
        at = np.searchsorted(above["node"].to_numpy(), (key >> U(8 * (depth - 1))).astype(np.int64)[:, None] * 256 + decision)
        n0, n1, own = (above[c].to_numpy()[at] for c in ("n0", "n1", "own"))
        estimate = (np.where(bit, n1, n0) + 0.5) / (n0 + n1 + 1)
        p = np.where(n0 + n1 > 0, np.where(np.isnan(p), estimate, own * estimate + (1 - own) * p), p)
    one1, own1, one0, own0 = top
    last = (key >> U(8 * depth)).astype(np.int64)[:, None]
    for one, own in ((one1[last, decision], own1[last, decision]), (one0[decision], own0[decision])):
        estimate = np.where(bit, one, 1 - one)
        p = np.where(np.isnan(estimate), p, np.where(np.isnan(p), estimate, own * estimate + (1 - own) * p))
    return np.log10(p).sum(axis=1)


def _price(depth: int, top: tuple):
    def price(table: pa.Table, second: pa.Table) -> pa.Table:
        above = second.to_pandas().drop_duplicates("node").sort_values("node")
        rows = []
        for split, key, count, shard in _gather(table):
            cost = code_length(key, count, depth, top, above if split else None)
            rows += [(int(s), key[shard == s].tobytes(), cost[shard == s].tobytes()) for s in np.unique(shard)]
        return pa.table({"shard": pa.array([r[0] for r in rows], pa.int32()), "priced": pa.array([r[1] for r in rows], pa.binary()), "cost": pa.array([r[2] for r in rows], pa.binary())})

    return price


def _answer_sequences(offers: pa.Table, prices: pa.Table) -> pa.Table:
    """One shard: the price of every sequence to each chunk that has it."""
    key = np.concatenate([np.frombuffer(k, U) for k in prices.column("priced").to_pylist()] or [np.zeros(0, U)])
    cost = np.concatenate([np.frombuffer(c) for c in prices.column("cost").to_pylist()] or [np.zeros(0)])
    order = np.argsort(key, kind="stable")
    key, cost = key[order], cost[order]
    return _answers([(c, SEQUENCE, pack_keys(k), cost[np.searchsorted(key, k)].astype(np.float32).tobytes()) for c, k, _ in _unpack(offers, SEQUENCE)])


def _summed(key: np.ndarray, doc: np.ndarray, size: int, keys: np.ndarray, cost: np.ndarray, depth: int) -> np.ndarray:
    """Sum by document of the cost of its sequences; doc is sorted.

    Sequence and document are sorted as one number, so that the book of costs is
    read from end to end: far faster than a search for each byte of the text."""
    room = 64 - 8 * (depth + 1)
    if room < 8:
        return np.bincount(doc, weights=cost[np.searchsorted(keys, key)], minlength=size)
    out = np.zeros(size)
    for a in range(0, size, 1 << room):
        b = min(size, a + (1 << room))
        here = slice(*np.searchsorted(doc, [a, b]))
        both = (key[here] << U(room)) | (doc[here] - a).astype(U)
        both.sort()
        found = both >> U(room)
        at = np.flatnonzero(np.r_[True, found[1:] != found[:-1]]) if len(found) else np.zeros(0, np.int64)
        price = np.repeat(cost[np.searchsorted(keys, found[at])], np.diff(np.r_[at, len(found)]))
        out[a:b] = np.bincount((both & U((1 << room) - 1)).astype(np.int64), weights=price, minlength=b - a)
    return out


def _score(depth: int, vocabulary: int, tokens: int, train_docs: int):
    total = tokens + 0.5 * (vocabulary + 1)

    def book(answers: pa.Table, kind: int, dtype: type) -> tuple[np.ndarray, np.ndarray]:
        rows = [(k, v) for k, v, f in zip(answers.column("keys").to_pylist(), answers.column("values").to_pylist(), answers.column("kind").to_pylist(), strict=True) if f == kind]
        key = np.concatenate([unpack_keys(k) for k, _ in rows] or [np.zeros(0, U)])
        value = np.concatenate([unpack(v) if dtype is np.uint64 else np.frombuffer(v, dtype) for _, v in rows] or [np.zeros(0, dtype)])
        order = np.argsort(key, kind="stable")
        return key[order], value[order].astype(np.float64)

    def score(docs: pa.Table, answers: pa.Table) -> pa.Table:
        keys, cost = book(answers, SEQUENCE, np.float32)
        words, counts = book(answers, WORD, np.uint64)
        word_cost, n = np.log10((counts + 0.5) / total), docs.num_rows
        out = {c: np.zeros(n) for c in ("tokens", "known", "bytes", "base", "score")}
        data, off = V.flat(docs.column("text"))
        for first, end, part, offsets in V.slices(data, off):
            key, key_doc, word, word_doc = spelled(part, offsets, depth)
            m, to = end - first, slice(first, end)
            at = np.searchsorted(words, word)
            out["tokens"][to] = np.bincount(word_doc, minlength=m) + 1
            out["known"][to] = np.bincount(word_doc, weights=counts[at] > 0, minlength=m) + (train_docs > 0)
            out["base"][to] = np.bincount(word_doc, weights=word_cost[at], minlength=m) + math.log10((train_docs + 0.5) / total)
            out["bytes"][to] = np.bincount(key_doc, minlength=m)
            out["score"][to] = _summed(key, key_doc, m, keys, cost, depth)
        whole = lambda x: pa.array(x.astype(np.int64))
        return pa.table({
            "doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"), "n_tokens": whole(out["tokens"]), "n_known": whole(out["known"]),
            "train_tokens": pa.array(np.full(n, tokens, np.int64)), "n_bytes": whole(out["bytes"]), "base_score": pa.array(out["base"]), "score": pa.array(out["score"]),
        })

    return score


def score_documents(docs: DataFrame, folds: int = 5, held_fold: int = 1, depth: int = DEPTH, hot: int = HOT) -> DataFrame:
    """log10 probability of every text; learnt from those whose crc32(doc_id) mod folds isn't held_fold.

    docs: doc_id, text.  depth: 3 or more.  Returns doc_id, held_out, n_tokens, n_known,
    train_tokens, n_bytes (spelled), base_score and score; -score * log2(10) /
    n_bytes is the code length per byte."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n, shards = chunk_count(docs, CHUNK_BYTES), max(parts, -(-input_bytes(docs) // SHARD_BYTES), 1)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = with_chunk(rows.withColumn("held_out", F.crc32(key.cast("binary")) % folds == held_fold), n)
    offers = materialize(rows.groupBy("chunk").applyInArrow(_offer(shards, depth), OFFERS), "offers")
    words = materialize(offers.where(f"kind <> {SEQUENCE}").groupBy("shard").applyInArrow(_answer_words, WORDS), "words")
    sums = words.where("chunk = -1").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("vocabulary", "tokens", "docs")]).first()
    vocabulary, tokens, train_docs = (int(sums[c]) for c in ("vocabulary", "tokens", "docs"))
    if train_docs:  # the end is a token too
        vocabulary, tokens = vocabulary + 1, tokens + train_docs

    sequences = offers.where(f"kind = {SEQUENCE}")
    summed = sequences.withColumn("bits", F.lit(8 * (depth - 1))).groupBy("shard").applyInArrow(_sums, UNITS)
    pairs = materialize(summed, "sums")
    sizes = pairs.groupBy("pair").agg(F.sum(F.length("keys") / 8).alias("n"))  # at most 65,536 rows of two numbers
    large = F.broadcast(sizes.where(F.col("n") > hot).select("pair"))
    total = int(sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    whole = pairs.join(large, "pair", "left_anti").withColumn("hot", F.lit(False))
    split = pairs.join(large, "pair", "left_semi").mapInArrow(_split(depth), UNITS).withColumn("hot", F.lit(True))
    deals = max(parts, -(-total // DEALT))
    units = materialize(whole.unionByName(split).withColumn("deal", F.pmod(F.xxhash64("pair", "sub"), F.lit(deals))), "units")

    roots = materialize(units.groupBy("deal").applyInArrow(_roots(depth), ROOTS), "roots")
    add = [F.sum(c).alias(c) for c in ("n0", "n1", "children")]
    second = materialize(roots.where("pair >= 0").groupBy("node").agg(*add).mapInPandas(_second, ABOVE), "second")
    handed = second.select(F.expr("((node div 256) div 256) * 256 + node % 256").alias("node"), "n0", "n1", F.col("weighted").alias("children"))
    found = roots.where("pair < 0").select("node", "n0", "n1", "children").unionByName(handed).groupBy("node").agg(*add).orderBy("node")
    top = top_levels(found.toPandas())  # at most 256 * 255 rows
    asked = units.where("hot").select("pair", (F.col("deal") + 0).alias("to_deal")).distinct().join(second.withColumn("pair", F.expr("node div 256")), "pair").drop("pair")
    prices = units.groupBy("deal").cogroup(asked.groupBy("to_deal")).applyInArrow(_price(depth, top), "shard int, priced binary, cost binary")
    answers = sequences.groupBy("shard").cogroup(prices.groupBy("shard")).applyInArrow(_answer_sequences, ANSWERS)
    known = words.where("chunk >= 0").select("chunk", "kind", "keys", "values")
    return rows.groupBy("chunk").cogroup(answers.unionByName(known).groupBy("chunk")).applyInArrow(_score(depth, vocabulary, tokens, train_docs), SCORES)
