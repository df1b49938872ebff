"""Near-duplicate documents by word shingles.

Method: chosen-path set similarity join.  Every distinct shingle set is embedded
as COORDS minwise tokens.  Each of TREES independent trees sends it down a path:
a node picks one of the minwise tokens (and in a share of 1 / s - 1 of the nodes
two, at random from the node's own seed, so that a pair of similarity s is
expected to share one child) and the sets with the same token share the child.
Nodes of up to `limit` sets and NODE_BYTES of shingles are compared exhaustively
by their sketches, and the candidates are confirmed on full sets.

Recall: a pair at similarity s reaches a small first-level node of one tree with
chance s, so of TREES trees all miss a pair at 0.85 with a chance of 7e-14, at
0.80 of 7e-12.  A pair whose first-level nodes are all large is lost with the
chance that it shares no node further down (`pair_recall`): at 0.85 by level 4
6e-7, level 8 1.3e-4, level 10 5e-4; at 0.80 1e-5, 9e-4 and 3e-3.  Candidates by
sketches are admitted DEVIATIONS below the threshold (lost: 3e-6).

Groups of copies are never expanded.  Sets that are equal are one.  Of a node,
first a forest is tested: every set against a central one (the set that agrees
best with the majority of the node).  Pairs that are connected already are not
looked at again; only pairs between different components are compared further,
each in the first node where it meets.  Nodes that stay large at full depth are
compared block by block, without a cap: each of their members is repeated once
per block, the one step that grows with the square of a node's size.

Shingles: five words [^\\x20\\x09-\\x0D]+ after A-Z are lower-cased; fewer words
are one shingle; a set is the 64-bit hashes of its shingles.  Sets are told apart
by 128 bits of them, and numbered for everything after.  Null and empty texts have no set,
and so have texts without words: they are linked with nothing.  Repeated rows
are one set and stay repeated.  Rows of one doc_id with different texts are
judged each by its own text.  Rows without doc_id are linked with nothing and
kept.  An empty table gives an empty result.  Extra columns are carried along if named in `keep`; those named like
the operator's own give way."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as V
from .common import materialize

U = np.uint64
COORDS = 192
TREES = 16
LIMIT = 4096
DEPTH = 10
#: Shingles (8 bytes each) of all members of a small node: what one worker holds at once.
NODE_BYTES = 32 << 20
#: Bytes of members, or of their shingles, that one task handles together.
TASK_BYTES = 48 << 20
#: A sketch agrees by s +- sqrt(s (1 - s) / COORDS); candidates may lie this many deviations below the threshold.
DEVIATIONS = 4.5
CENTRES = 3

_rng = np.random.default_rng(77)
_XOR = _rng.integers(0, 2**64, COORDS, dtype=np.uint64)
_ODD = _rng.integers(0, 2**63, COORDS, dtype=np.uint64) * U(2) + U(1)
SIGNED = "doc_id long, n_shingles long, key binary, sketch binary, tokens array<long>"
EDGES = "a long, b long"
#: Members of nodes that one task handles together, and of one node that share their centres.
TOGETHER = 20_000


def shingle_sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text of a column."""
    data, off = V.flat(column)
    for first, end, part, offsets in V.slices(data, off):
        starts, ends, doc = V.words(part, offsets)
        word = V.hashes(part, starts, ends, V.LOWER)
        at = np.searchsorted(doc, np.arange(end - first + 1))
        spread = max(len(word) - words + 1, 0)
        whole = np.zeros(spread, U)
        for k in range(words):
            whole = V.mix(whole * U(0x9E3779B97F4A7C15) + word[k : k + spread])
        for i in range(end - first):
            a, b = at[i], at[i + 1]
            if b - a >= words:
                yield np.unique(whole[a : b - words + 1])
            elif b > a:
                one = np.array([b - a], U)
                for w in word[a:b]:
                    one = V.mix(one * U(0x9E3779B97F4A7C15) + w)
                yield one
            else:
                yield np.zeros(0, U)


def minwise(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of the set under each of COORDS hash functions."""
    out = np.full(COORDS, np.iinfo(np.uint64).max, U)
    for a in range(0, len(shingles), 4096):
        out = np.minimum(out, ((shingles[a : a + 4096, None] ^ _XOR) * _ODD).min(axis=0))
    return V.mix(out)


def set_key(shingles: np.ndarray) -> bytes | None:
    return hashlib.md5(shingles.tobytes()).digest() if len(shingles) else None


def pair_recall(s: float, level: int, trees: int = TREES) -> float:
    """Chance that a pair at similarity s shares a node of this level of any tree."""
    double, shared = min(1.0, 1 / s - 1), 1.0
    for _ in range(level - 1):
        missed = 1 - s * shared
        shared = 1 - (1 - double) * missed - double * missed**2
    return 1 - (1 - s * shared) ** trees  # a first-level node is one token


def _sign(words: int, marked: bool):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seed = V.mix(np.arange(TREES, dtype=U) + U(1))
        for batch in batches:
            n, names, sketches, tokens = [], [], [], []
            for s in shingle_sets(batch.column("text"), words):
                n.append(len(s))
                values = minwise(s) if len(s) else None
                names.append(set_key(s))
                sketches.append((values >> U(32)).astype(np.uint8).tobytes() if len(s) else None)
                tokens.append(V.mix(values[:TREES] ^ seed).view(np.int64) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(names, pa.binary()), pa.array(sketches, pa.binary()), pa.array(tokens, pa.list_(pa.int64())), *(batch.column(c) for c in ["mark"] * marked)],
                names=["doc_id", "n_shingles", "key", "sketch", "tokens", *["mark"] * marked],
            )

    return sign


def _sets(words: int, packed: bool):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(shingle_sets(batch.column("text"), words))
            names = pa.array([set_key(s) for s in found], pa.binary())
            shingles = pa.array([s.tobytes() for s in found], pa.binary()) if packed else pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), names, shingles], names=["doc_id", "key", "shingles"])

    return sets


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, COORDS)


def _agree(row: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Share of equal coordinates of a sketch with each of others."""
    return np.count_nonzero(others == row, axis=1) / COORDS


def _centre(sketch: np.ndarray) -> int:
    """The row that agrees best with the others (of many: with the most frequent value of each coordinate)."""
    if len(sketch) <= 48:
        return int(np.argmax((sketch[:, None] == sketch).sum(axis=(1, 2))))
    score = np.zeros(len(sketch), np.int64)
    for c in range(COORDS):
        score += sketch[:, c] == np.argmax(np.bincount(sketch[:, c], minlength=256))
    return int(np.argmax(score))


def _star(ids: np.ndarray, sketch: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Candidates of one node: a few central sets with all others."""
    left, pairs = np.arange(len(ids)), []
    for _ in range(CENTRES):
        if len(left) < 2:
            break
        centre = _centre(sketch[left]) if len(left) > 2 else 0
        near = _agree(sketch[left[centre]], sketch[left]) >= least
        near[centre] = False
        pairs += [(int(min(ids[left[centre]], i)), int(max(ids[left[centre]], i))) for i in ids[left[near]]]
        near[centre] = True
        left = left[~near]
    return pairs


@dataclass
class Node:
    """Members of one node (or pair of blocks), as arrays in one order."""

    ids: np.ndarray
    sketch: np.ndarray
    label: np.ndarray | None = None
    side: np.ndarray | None = None
    level: np.ndarray | None = None
    small: np.ndarray | None = None
    tokens: np.ndarray | None = None
    sets: list | None = None  # sorted shingles of each

    def pairs(self, least: float) -> Iterator[tuple[int, np.ndarray]]:
        """(member, others) that may be linked, are of different components, and don't
        meet in a small first-level node of an earlier tree (for deeper nodes: of any
        tree), to which such a pair is left."""
        others = np.flatnonzero(self.side != 0)
        bits = ((self.small.astype(np.int64) & ((np.int64(1) << self.level) - 1))[:, None] >> np.arange(TREES)) & 1
        for i in np.flatnonzero(self.side != 1):
            of = others[(self.label[others] != self.label[i]) & ((self.side[others] != 2) | (others > i))]
            of = of[_agree(self.sketch[i], self.sketch[of]) >= least]
            if len(of):
                met = ((self.tokens[of] == self.tokens[i]) & (bits[i] > 0)).any(axis=1)
                if not met.all():
                    yield i, of[~met]


def _involved(node: Node, least: float) -> list[tuple]:
    """Members with any candidate."""
    hit = np.zeros(len(node.ids), bool)
    for i, of in node.pairs(least):
        hit[i] = True
        hit[of] = True
    return [(int(x),) for x in np.unique(node.ids[hit])]


def _linked(node: Node, least: float, num: int, den: int) -> list[tuple]:
    """Links confirmed on full sets: at most enough to connect the components that are linked here."""
    root = {int(x): int(x) for x in np.unique(node.label)}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    out = []
    for i, of in node.pairs(least):
        a = node.sets[i]
        for j in of:
            x, y = find(int(node.label[i])), find(int(node.label[j]))
            if x == y:
                continue
            b = node.sets[j]
            if num * max(len(a), len(b)) > den * min(len(a), len(b)):
                continue
            common = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
            if den * common >= num * (len(a) + len(b) - common):
                root[max(x, y)] = min(x, y)
                out.append((int(min(node.ids[i], node.ids[j])), int(max(node.ids[i], node.ids[j]))))
    return out


def _views(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The sorted shingles of every row, without copies."""
    out = []
    for chunk in column.chunks:
        _, offsets, data = chunk.cast(pa.large_binary()).buffers()
        if not len(chunk):
            continue
        at = np.frombuffer(offsets, np.int64)[chunk.offset : chunk.offset + len(chunk) + 1] // 8
        whole = np.frombuffer(data, np.uint8)[: at[-1] * 8].view(U) if data is not None else np.zeros(0, U)
        out += [whole[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
    return out


def _each_node(members: DataFrame, handle_node, result: str, where: bool = False) -> DataFrame:
    """Rows that handle_node makes of every (node, part), with these if `where`: many nodes share a task, none is split."""
    spark = members.sparkSession
    labelled, full = "label" in members.columns, "shingles" in members.columns
    held = members.agg(F.sum(F.length("sketch") + 64 + (F.length("shingles") if full else 0))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-held // (TASK_BYTES if full else TOGETHER * (COORDS + 64))))

    def handle(table: pa.Table) -> pa.Table:
        node, part, ids = (table.column(c).to_numpy() for c in ("node", "part", "set_id"))
        order = np.lexsort((ids, part, node))
        node, part, ids, sketch = node[order], part[order], ids[order], _matrix(table.column("sketch"))[order]
        more = [table.column(c).to_numpy()[order] for c in ("label", "side", "level", "small")] if labelled else []
        if labelled:
            more.append(np.frombuffer(b"".join(table.column("tokens").to_pylist()), "<u4").reshape(-1, TREES)[order])
        raw = _views(table.column("shingles")) if full else []
        sets = [raw[k] for k in order] if full else []
        cut = np.flatnonzero(np.r_[True, (node[1:] != node[:-1]) | (part[1:] != part[:-1]), True])
        out: set[tuple] = set()
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            found = handle_node(Node(ids[a:b], sketch[a:b], *[m[a:b] for m in more], **({"sets": sets[a:b]} if full else {})))
            out.update((int(node[a]), int(part[a]), *row) for row in found) if where else out.update(found)
        names = ["node", "part"] * where + [f.split()[0] for f in result.split(", ")]
        rows = list(out)
        return pa.table({name: pa.array([r[k] for r in rows], pa.int64()) for k, name in enumerate(names)})

    dealt = members.withColumn("deal", F.pmod(F.xxhash64("node", "part"), F.lit(n)))
    return dealt.groupBy("deal").applyInArrow(handle, "node long, part long, " * where + result)


def _wanted_sets(wanted: DataFrame, docs: DataFrame, firsts: DataFrame, words: int, packed: bool) -> DataFrame:
    """set_id, shingles (an array, or its sorted bytes) of the wanted sets, taken anew from the texts."""
    wanted = wanted.select("set_id").distinct().join(firsts.select("set_id", "key", "doc_id"), "set_id")
    texts = docs.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    sets = texts.mapInArrow(_sets(words, packed), f"doc_id long, key binary, shingles {'binary' if packed else 'array<long>'}").join(wanted, ["key", "doc_id"]).dropDuplicates(["set_id"])
    return materialize(sets.select("set_id", "shingles"), "shingles")


def _confirm(pairs: DataFrame, docs: DataFrame, firsts: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """The pairs with similarity num / den or more on full sets."""
    sets = _wanted_sets(pairs.select(F.explode(F.array("a", "b")).alias("set_id")), docs, firsts, words, packed=False)
    a, b = sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("x")), sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(a, "a").join(b, "b").withColumn("common", F.size(F.array_intersect("x", "y")))
    alike = den * F.col("common") >= num * (F.size("x") + F.size("y") - F.col("common"))
    return materialize(both.where((F.col("common") > 0) & alike).select("a", "b"), "links")


def components(links: DataFrame) -> DataFrame:
    """(set_id, label) of everything that has a link: the smallest reachable set_id.

    Alternates between hooking every vertex's larger neighbours and its smaller
    ones to the smallest it knows, which takes a logarithmic number of rounds;
    each round is written, and only counts reach the driver."""
    edges = links.select("a", "b").where("a <> b").distinct()
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        small = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        down = small.groupBy("a").agg(F.min("b").alias("m"))
        edges = small.join(down, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        edges = materialize(edges, "hooks")
        state = edges.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.hash("a", "b").cast("long")), F.lit(0)).alias("h"), F.countDistinct("a").alias("d")).first()
        if state == before or state["n"] == 0:
            break
        before = state
    out = edges.select(F.col("a").alias("set_id"), F.col("b").alias("label"))
    return out.union(edges.select(F.col("b").alias("set_id"), F.col("b").alias("label"))).groupBy("set_id").agg(F.min("label").alias("label"))


def _children(level: int, double: float):
    """Where a set goes from a large node: the node's seed picks one token, in a share `double` of the nodes a second one."""

    def children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            node, sketch = batch.column("node").to_numpy().view(U), _matrix(batch.column("sketch"))
            seed = V.mix(node + U(level * 0xA0761D6478BD642F % 2**64))
            other = V.mix(seed)
            pick = (seed % U(COORDS)).astype(np.int64)
            twice = np.flatnonzero((seed >> U(32)).astype(np.float64) < double * 2**32)
            rows = np.concatenate([np.arange(len(node)), twice])
            coord = np.concatenate([pick, (pick[twice] + 1 + (other[twice] % U(COORDS - 1)).astype(np.int64)) % COORDS])
            child = V.mix(node[rows] ^ V.mix(sketch[rows, coord].astype(U) + (coord.astype(U) << U(32)) + U(level)))
            take = pa.array(rows)
            yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), *[batch.column(c).take(take) for c in ("set_id", "sketch", "label", "n")]], names=["node", "set_id", "sketch", "label", "n"])

    return children


def _crowded(members: DataFrame, limit: int) -> DataFrame:
    """The members of nodes with at least two sets, with the node's size and load: 1 or less for nodes that are compared at once."""
    sizes = members.groupBy("node").agg(F.count("*").alias("size"), F.greatest(F.count("*") / limit, F.sum("n") * 8 / NODE_BYTES).alias("load")).where("size > 1")
    return members.join(sizes, "node")


def _mixed(members: DataFrame) -> DataFrame:
    """The members of nodes that hold different components."""
    nodes = members.groupBy("node").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("node")
    return members.join(nodes, "node", "left_semi")


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    return members.drop("label").join(labels, "set_id", "left").withColumn("label", F.coalesce("label", "set_id"))


def _link(docs: DataFrame, words: int, num: int, den: int, limit: int, depth: int, marked: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(doc_id, n_shingles, key and, if `marked`, the text's hash (mark) of all rows; key, set_id, smallest doc_id of the sets; set_id, label of linked sets)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = rows.withColumn("mark", F.xxhash64("text")) if marked else rows
    signed = materialize(texts.mapInArrow(_sign(words, marked), SIGNED + ", mark long" * marked), "signed")
    named = signed.where("key is not null and doc_id is not null")
    firsts = named.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"), F.first("tokens").alias("tokens"))
    firsts = materialize(firsts.withColumn("set_id", F.monotonically_increasing_id()), "firsts")  # numbers that are written once
    s = num / den
    least = s - DEVIATIONS * (s * (1 - s) / COORDS) ** 0.5

    # First level: one minwise token for each tree.  Every node's centres are tried on its members.
    first = firsts.select("set_id", "n", F.posexplode("tokens").alias("tree", "token")).select("set_id", "n", "tree", F.xxhash64("tree", "token").alias("node"))
    crowd = materialize(_crowded(first, limit).join(firsts.select("set_id", "sketch"), "set_id").select("node", "set_id", "sketch", "tree", "n", "size", "load"), "nodes")
    part = F.pmod(F.xxhash64("set_id"), F.ceil(F.col("size") / TOGETHER))
    tried = materialize(_each_node(crowd.withColumn("part", part), lambda x: _star(x.ids, x.sketch, least), EDGES).where("a <> b").distinct(), "tried")
    links = _confirm(tried, rows, firsts, words, num, den)
    labels = materialize(components(links), "labels")

    # Further levels: large nodes branch on, as long as they hold sets that aren't connected yet.
    nodes = _mixed(_labelled(crowd, labels))
    small = nodes.where("load <= 1").select("node", "set_id", "sketch", "label", F.col("tree").alias("level"))
    large = materialize(nodes.where("load > 1").select("node", "set_id", "sketch", "label", "n", "load"), "large")
    for level in range(2, depth + 1):
        if large.isEmpty():
            break
        moved = large.select("node", "set_id", "sketch", "label", "n").mapInArrow(_children(level, min(1.0, 1 / s - 1)), "node long, set_id long, sketch binary, label long, n long")
        nodes = materialize(_crowded(_mixed(moved), limit).select("node", "set_id", "sketch", "label", "n", "load"), "nodes")
        small = small.unionByName(nodes.where("load <= 1").select("node", "set_id", "sketch", "label", F.lit(TREES).alias("level")))
        large = nodes.where("load > 1")
    parts = small.withColumns({"side": F.lit(2), "part": F.lit(0).cast("long")}).unionByName(_blocks(large))

    # All pairs of small nodes between components that aren't connected yet, each in the first node where it meets.
    met = crowd.where("load <= 1").groupBy("set_id").agg(F.expr("bit_or(shiftleft(1, tree))").alias("small"))
    packed = firsts.select("set_id", F.unhex(F.array_join(F.transform("tokens", lambda t: F.substring(F.lpad(F.hex(t), 16, "0"), 9, 8)), "")).alias("tokens"))
    open_ = parts.join(packed.join(met, "set_id", "left").withColumn("small", F.coalesce("small", F.lit(0))), "set_id")
    involved = materialize(_each_node(open_, lambda x: _involved(x, least), "set_id long", where=True), "involved")
    sets = _wanted_sets(involved, rows, firsts, words, packed=True)
    full = open_.join(involved, ["node", "part", "set_id"], "left_semi").join(sets, "set_id")
    links = links.unionByName(materialize(_each_node(full, lambda x: _linked(x, least, num, den), EDGES), "links"))
    return signed.drop("sketch", "tokens"), firsts.select("key", "set_id", "doc_id"), materialize(components(links), "labels")


def near_links(docs: DataFrame, words: int, num: int, den: int, limit: int = LIMIT, depth: int = DEPTH) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, set_id of all rows; set_id, label of linked sets)."""
    signed, firsts, labels = _link(docs, words, num, den, limit, depth, False)
    return signed.join(firsts.select("key", "set_id"), "key", "left").drop("key"), labels


def _blocks(large: DataFrame) -> DataFrame:
    """A node too large at full depth as pairs of blocks: every two members meet in one of them."""
    rows = large.withColumn("blocks", F.ceil("load").cast("int"))
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    side = F.when(F.col("mine") == F.col("other"), 2).when(F.col("mine") < F.col("other"), 0).otherwise(1)
    part = F.least("mine", "other").cast("long") * (1 << 31) + F.greatest("mine", "other") + 1
    return rows.select("node", "set_id", "sketch", "label", F.lit(TREES).alias("level"), side.alias("side"), part.alias("part"))


def near_duplicates(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100, keep: list[str] | None = None) -> DataFrame:
    """Component of every document under links of similarity num / den or more.

    docs: doc_id, text.  Returns doc_id, n_shingles, component_id (smallest
    doc_id reachable), kept (doc_id = component_id); with `keep` doc_id, these
    columns, component_id and kept."""
    signed, firsts, labels = _link(docs, words, num, den, LIMIT, DEPTH, keep is not None)
    # components of sets, of which there are fewer than documents; rows without a set stand apart from the join
    sets = firsts.join(labels, "set_id", "left").withColumn("label", F.coalesce("label", "set_id"))
    smallest = sets.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    sets = materialize(sets.join(smallest, "label").select("key", "component_id"), "components")
    linked = F.col("key").isNotNull() & F.col("doc_id").isNotNull()
    found = signed.where(linked).join(sets, "key").withColumn("kept", F.col("doc_id") == F.col("component_id"))
    if keep is None:
        alone = signed.where(~linked).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
        return found.select("doc_id", "n_shingles", "component_id", "kept").unionByName(alone)
    extra = [c for c in keep if c not in ("doc_id", "component_id", "kept")]
    moved = found.where("doc_id <> component_id").groupBy(F.col("doc_id").alias("_doc"), F.col("mark").alias("_mark")).agg(F.min("component_id").alias("_component"))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *extra, F.xxhash64(F.col("text").cast("string")).alias("_text"))
    joined = own.join(moved, (F.col("doc_id") == F.col("_doc")) & (F.col("_text") == F.col("_mark")), "left")  # rows of one doc_id may have different texts
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")
    return joined.withColumn("component_id", F.coalesce("_component", "doc_id")).select("doc_id", *extra, "component_id", kept)
