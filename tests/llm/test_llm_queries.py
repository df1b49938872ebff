"""The opN queries against their SQL, or against brute force where SQL can't express them."""

import functools
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from compare import DATA, assert_same

from dispensa.llm import media_ts
from dispensa.llm.queries import ORACLES, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    assert_same(QUERIES[name](spark, DATA).toPandas(), ORACLES[name])


def test_toxicity_held_out(spark):
    data = DATA.replace("sf0.001", "sf0.01")
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    found = QUERIES["op3_toxicity"](spark, data).collect()
    assert len(found) == 1000
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found)
    held = [(labels[r["doc_id"]], r["predicted"]) for r in found if r["held_out"] and r["doc_id"] in labels]
    assert sum(a == b for a, b in held) / len(held) > 0.93
    assert sum(b for a, b in held if a == 0) <= 0.03 * len(held)


def kt(n0, n1):
    return math.lgamma(n0 + 0.5) + math.lgamma(n1 + 0.5) - math.log(math.pi) - math.lgamma(n0 + n1 + 1)


class Tree:
    """Context-tree weighting of one binary decision, by recursion over dictionaries."""

    def __init__(self, depth):
        self.depth, self.n, self.memo = depth, defaultdict(lambda: [0, 0]), {}
        self.children = defaultdict(set)

    def learn(self, context, bit):
        for d in range(self.depth + 1):
            self.n[context[:d]][bit] += 1
            if d:
                self.children[context[: d - 1]].add(context[:d])

    def weighted(self, s):
        if s not in self.memo:
            own = kt(*self.n[s])
            if len(s) == self.depth:
                self.memo[s] = own
            else:
                rest = sum(self.weighted(c) for c in self.children[s])
                self.memo[s] = math.log(0.5) + max(own, rest) + math.log1p(math.exp(-abs(own - rest)))
        return self.memo[s]

    def probability(self, context, bit):
        p = None
        for d in range(self.depth, -1, -1):
            s = context[:d]
            if s not in self.n and d:
                continue
            n0, n1 = self.n[s]
            own = ((n1 if bit else n0) + 0.5) / (n0 + n1 + 1)
            if p is None:
                p = own
            else:
                w = math.exp(kt(n0, n1) + math.log(0.5) - self.weighted(s))
                p = w * own + (1 - w) * p
        return p


@pytest.mark.parametrize("hot", [400_000, 12, 0])
def test_context_trees_by_recursion(spark, hot):
    """With whole contexts of two bytes, with some of them split by the third, and with all of them split."""
    from dispensa.llm.lm_scoring import score_documents

    texts = {1: "the cat sat on the mat", 2: "The dog  sat on\nthe log é", 3: "", 4: None, 5: "a cat and a dog", 6: "the the the zebra"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    depth = 3
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    trees = defaultdict(lambda: Tree(depth))

    def bits(text):
        raw = "".join(w + " " for w in WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))).encode() + b"\n"
        padded = b"\n" * depth + raw
        for i in range(depth, len(padded)):
            context = tuple(padded[i - k] for k in range(1, depth + 1))
            for k in range(8):
                yield (1 << k) | (padded[i] >> (8 - k)), context, padded[i] >> (7 - k) & 1

    for i, t in texts.items():
        if not held[i]:
            for node, context, bit in bits(t):
                trees[node].learn(context, bit)
    counts = Counter(w for i, t in texts.items() if not held[i] for w in [*WORD.findall((t or "").lower()), None])
    n, v = sum(counts.values()), len(counts)
    for r in score_documents(docs, depth=depth, hot=hot).collect():
        t = texts[r["doc_id"]]
        expected = sum(math.log10(trees[node].probability(context, bit)) for node, context, bit in bits(t))
        assert r["score"] == pytest.approx(expected, rel=1e-5)
        words = [*WORD.findall((t or "").lower()), None]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["doc_id"]], len(words), sum(counts[w] > 0 for w in words), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words))


def test_scores_of_all_documents(spark, documents):
    found = QUERIES["op5_lm_scoring"](spark, DATA).collect()
    assert len(found) == len(documents)
    train = [t for i, t in documents.items() if zlib.crc32(str(i).encode()) % 5 != 1]
    counts = Counter(w for t in train for w in WORD.findall(t.translate({c: c + 32 for c in range(65, 91)})))
    n, v = sum(counts.values()) + len(train), len(counts) + 1
    for r in found[::7]:
        words = WORD.findall(documents[r["doc_id"]].translate({c: c + 32 for c in range(65, 91)}))
        assert r["train_tokens"] == n
        assert r["n_known"] == sum(counts[w] > 0 for w in words) + 1
        ends = math.log10((len(train) + 0.5) / (n + 0.5 * (v + 1)))
        assert r["base_score"] == pytest.approx(ends + sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words))


def test_packing(spark, documents):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = QUERIES["op8_best_fit_packing"](spark, DATA).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(documents)
    total = 0
    for doc, text in documents.items():
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        total += len(ids)
        rows = sorted(by_doc[doc], key=lambda r: r["piece"])
        assert [r["piece"] for r in rows] == list(range(len(rows)))
        assert sum(r["length"] for r in rows) == len(ids)
        assert len(rows) == math.ceil(len(ids) / 2048) and all(r["length"] == 2048 for r in rows[1:])
        for r in rows:
            part = ids[r["start"] : r["start"] + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    assert len(by_sequence) <= math.ceil(total / 2048) + 2


def demultiplexed(media):
    """(payload, timestamps) by the book of the standard, apart from the writer: bits are read from one long number."""
    bits = "".join(f"{b:08b}" for b in media)
    num = lambda a, n: int(bits[a : a + n], 2)
    crc = lambda a, b: functools.reduce(lambda c, x: ((c << 1) & 0xFFFFFFFF) ^ (0x04C11DB7 if (c >> 31) ^ int(x) else 0), bits[a:b], 0xFFFFFFFF)
    tables, elementary, parts, stamps, counters = {0}, set(), [], [], {}
    for at in range(0, len(bits), 188 * 8):
        assert num(at, 8) == 0x47 and num(at + 8, 1) == 0 and num(at + 24, 2) == 0
        start, pid, adaptation, payload, counter = num(at + 9, 1), num(at + 11, 13), num(at + 26, 1), num(at + 27, 1), num(at + 28, 4)
        assert counters.get(pid, counter) == counter
        counters[pid] = (counter + payload) % 16
        body, end = at + 32, at + 188 * 8
        if adaptation:
            body += 8 + 8 * num(body, 8)
        assert body <= end
        if pid in tables:
            assert start
            body += 8 + 8 * num(body, 8)
            size = num(body + 12, 12)
            after = body + 24 + 8 * size
            assert crc(body, after) == 0 and set(bits[after:end]) <= {"1"}
            assert num(body, 8) == (0 if pid == 0 else 2)
            if pid == 0:
                tables |= {num(k + 19, 13) for k in range(body + 64, after - 32, 32) if num(k, 16)}
            else:
                k = body + 96 + 8 * num(body + 84, 12)
                while k < after - 32:
                    elementary.add(num(k + 11, 13))
                    k += 40 + 8 * num(k + 28, 12)
        elif pid in elementary:
            if start:
                assert num(body, 24) == 1 and num(body + 48, 2) == 2
                left = num(body + 32, 16)
                head = num(body + 64, 8)
                if num(body + 56, 2) & 2:
                    t = body + 72
                    assert num(t, 4) == 2 and bits[t + 7] == bits[t + 23] == bits[t + 39] == "1"
                    stamps.append(num(t + 4, 3) << 30 | num(t + 8, 15) << 15 | num(t + 24, 15))
                body, left = body + 72 + 8 * head, left - 3 - head
            take = (end - body) // 8
            parts.append(bits[body:end])
            left -= take
            assert left >= 0
    assert left == 0
    whole = "".join(parts)
    return int(whole, 2).to_bytes(len(whole) // 8), stamps


def test_streams_by_another_parser():
    for n in (64, 128, 192, 1024, 16_384, 16_448, 49_152):
        payload = bytes((i * 7 + n) % 256 for i in range(n))
        assert demultiplexed(media_ts.write_stream(payload)) == (payload, [k * 3600 for k in range(-(-n // 16_384))])


def test_media(spark, documents):
    found = QUERIES["op9_media_ts"](spark, DATA).collect()
    assert len(found) == len(documents)
    for r in found:
        raw = documents[r["doc_id"]].encode()
        n, payload = len(raw), raw + bytes(-len(raw) % 64 or 64 * (not raw))
        media = media_ts.write_stream(payload)
        if len(payload) < 4000:
            assert demultiplexed(media)[0] == payload
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"]) == (n, len(payload), hashlib.sha256(payload).hexdigest())
        assert (r["tail_crc32"], r["media_bytes"], r["media_sha256"]) == (zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest())


def smallest_of_groups(texts):
    """The smallest doc_id of each group of texts that similarities of 0.8 or more connect, pair by pair."""
    sets = {}
    for i, t in texts.items():
        words = WORD.findall(t.translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    label = {i: i for i in texts}
    for i in sets:
        for j in sets:
            k = len(sets[i] & sets[j])
            if j < i and k and 100 * k >= 80 * (len(sets[i]) + len(sets[j]) - k):
                a, b = label[i], label[j]
                label = {x: min(a, b) if y in (a, b) else y for x, y in label.items()}
    return set(label.values())


SPACES = " \t\n\x0b\x0c\r"


def key_of(line):
    return line.strip(SPACES).translate({c: c + 32 for c in range(65, 91)})


def without_shared_lines(rows):
    """{doc_id: (text, lines dropped)} by a table of lines."""
    owner, holders = {}, defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None and len(key_of(line)) >= 10:
                holders[key_of(line)].add(i)
                owner[key_of(line)] = min(i, owner.get(key_of(line), i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if i is None or len(holders.get(key_of(x), ())) < 2 or owner[key_of(x)] == i]
        out.append((i, "\n".join(left), len(lines) - len(left)))
    return out


def test_mixing_by_brute_force(spark):
    """Targets by exhaustive filling, and each source's documents in seeded order until half a document is left over."""
    from dispensa.llm import source_mix

    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * rng.randint(0, 60)), rng.choice(["a", "b", "c", "d", None])) for i in range(400)]
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(text.split())
    order = sorted(sizes, key=lambda x: (x is None, x or ""))
    weight = {x: (1, 2, 3)[k % 3] for k, x in enumerate(order)}
    target, free = {}, set(order)
    while True:
        left = sum(sizes.values()) - sum(target.values())
        share = {x: left * weight[x] / sum(weight[y] for y in free) for x in free}
        over = [x for x in free if share[x] > 3 * sizes[x]]
        if not over:
            break
        target.update({x: 3 * sizes[x] for x in over})
        free -= set(over)
    target.update(share)
    taken = {}
    for x in order:
        whole = int(target[x] // sizes[x])
        need, so_far = target[x] - whole * sizes[x], 0
        for i, text, _ in sorted((r for r in rows if r[2] == x), key=lambda r: (hashlib.md5(f"mix:{r[0]}".encode()).hexdigest(), r[0])):
            n = len(text.split())
            taken[i] = (whole + (need > 0 and so_far + n / 2 <= need)) * n
            so_far += n
    found = source_mix.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {r["doc_id"]: r["taken"] for r in found} == taken


def test_pipeline(spark):
    import corpus_pipeline
    from dispensa.llm import textvec as V
    from dispensa.llm import toxicity

    import pyarrow as pa

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{DATA}/labels.parquet"))
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        before = [tuple(r) for r in kept.select(corpus_pipeline.COLUMNS).collect()]
        kept = stage(spark, kept, DATA).cache()
        after = sorted(tuple(r) for r in kept.collect())
        assert kept.columns == corpus_pipeline.COLUMNS
        if name == "toxicity":
            alone = [model.scores(model.margins(*V.flat(pa.array([r[1]]))))[0] for r in before]
            assert after == sorted(r for r, score in zip(before, alone, strict=True) if score < 0.5) and 0 < len(after) < len(before)
        if name == "line_dedup":
            left = [(r, t) for r, (_, t, n) in zip(before, without_shared_lines([r[:2] for r in before]), strict=True) if not n or t.strip(SPACES)]
            assert after == sorted((r[0], t, r[2], r[3], len(t)) for r, t in left)
            assert len(after) < len(before)
        if name == "minhash_dedup":
            stay = smallest_of_groups({r[0]: r[1] for r in before})
            assert after == sorted(r for r in before if r[0] in stay)
        if name == "source_mix":
            from dispensa.llm import source_mix

            copies = {r["doc_id"]: r["copies"] for r in source_mix.mix_sources(spark.createDataFrame(before, docs.select(corpus_pipeline.COLUMNS).schema)).collect()}
            assert after == sorted(r for r in before for _ in range(copies[r[0]])) and max(copies.values()) <= 3
    pieces = corpus_pipeline.pack(spark, kept, DATA).collect()
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = [len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in after]
    assert Counter(r["doc_id"] for r in pieces if r["piece"] == 0) == Counter(r[0] for r in after) and sum(r["length"] for r in pieces) == sum(ids)
    fill = Counter()
    for r in pieces:
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= 2048 and len(fill) <= math.ceil(sum(ids) / 2048) + 2


ODD = [(1, "moronic words here and a few more of them\nline that is shared", "en", "a", 9), (1, "moronic words here and a few more of them\nline that is shared", "en", "a", 9), (2, None, None, None, None),
       (3, "", "en", "b", 0), (None, "no id\nline that is shared", "en", "b", 3), (4, "line that is shared\n", "en", "b", 20), (5, "a few words " * 9000, None, "c", 1), (6, "LINE THAT IS SHARED  \nand more", "é", "é", 2)]


def test_stages_on_odd_rows(spark):
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    odd = spark.createDataFrame(ODD, schema).selectExpr("*", "'x' AS chunk", "'x' AS kept", "'x' AS predicted", "'x' AS copies", "'x' AS n_lines", "'x' AS copy", "'x' AS size")
    ids = lambda rows: sorted((r["doc_id"] is not None, r["doc_id"]) for r in rows)
    everyone = sorted((r[0] is not None, r[0]) for r in ODD)
    rows = corpus_pipeline.drop_toxic(spark, odd, DATA).collect()
    assert set(ids(rows)) <= set(everyone) and {(True, 2), (True, 3)} <= set(ids(rows)) and all(tuple(r) in ODD for r in rows)
    rows = corpus_pipeline.drop_lines(spark, odd, DATA).collect()
    assert ids(rows) == [x for x in everyone if x != (True, 4)]  # nothing is left of 4
    assert {r["doc_id"]: r["text"] for r in rows}[6] == "and more" and {r["doc_id"]: (r["text"], r["n_chars"]) for r in rows}[2] == ("", 0)
    rows = corpus_pipeline.drop_near_duplicates(spark, odd, DATA).collect()
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, ODD))
    rows = corpus_pipeline.mix(spark, odd, DATA)
    assert rows.columns == corpus_pipeline.COLUMNS and max(Counter(r["doc_id"] for r in rows.collect()).values()) <= 6
    rows = corpus_pipeline.pack(spark, odd, DATA).collect()
    assert sorted({(r["doc_id"] is not None, r["doc_id"]) for r in rows if r["piece"] == 0}) == sorted(set(everyone))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.limit(0), DATA).collect() == []
