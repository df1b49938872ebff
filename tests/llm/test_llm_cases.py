"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import base64
import hashlib
import os

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dispensa.llm import chat_format, line_dedup, lm_scoring, media_ts, minhash_dedup, packing, quality_rules, source_mix, tokens, toxicity, warc

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
LONG = "lorem ipsum dolor " * 30_000
ROWS = [(1, "one two three four five six\nline that is shared\n", "a", 9), (1, "one two three four five six\nline that is shared\n", "a", 9), (2, None, None, None), (3, "", "b", 0),
        (None, "no id\nline that is shared", "b", 3), (4, " \t\n ", "b", 1), (5, LONG, None, 1), (6, "Línea única: ñandú — 日本\nLINE THAT IS SHARED  ", "é", 2)]
SCHEMA = "doc_id long, text string, source string, size long"
CLASHES = ["chunk", "kept", "score", "n_words", "part", "bin", "label", "node", "target", "copies", "media", "digest", "held_out"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    for c in CLASHES:
        rows = rows.withColumn(c, F.lit("x"))
    return rows


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (3, 0), (3, None), (None, 1)], "doc_id long, toxic int")


def operators(labels):
    return {
        "quality": lambda d: quality_rules.judge_quality(d),
        "near": lambda d: minhash_dedup.near_duplicates(d),
        "near keep": lambda d: minhash_dedup.near_duplicates(d, keep=["text", "source", "label"]),
        "toxic": lambda d: toxicity.score_documents(d, labels, keep=["source"]),
        "lines": lambda d: line_dedup.drop_shared_lines(d, keep=["source", "chunk"]),
        "model": lambda d: lm_scoring.score_documents(d),
        "mix": lambda d: source_mix.mix_sources(d, keep=["text"]),
        "media": lambda d: media_ts.media_features(media_ts.store_media(d)),
    }


COPY = "one two three four five six\nline that is shared\n"


def values(found, *columns):
    """Rows as tuples of these columns, sorted (nulls first), after evaluating all columns."""
    rows = [tuple(r[c] for c in columns) for r in found.collect()]
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def test_odd_quality(docs):
    found = values(quality_rules.judge_quality(docs), "doc_id", "n_words", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    assert found == [(None, 6, 0, 0, True, False), (1, 10, 0, 0, True, False), (1, 10, 0, 0, True, False), (2, 0, 0, 0, True, False), (3, 0, 0, 0, True, False),
                     (4, 0, 0, 0, True, False), (5, 90_000, 0, 90_000, True, False), (6, 9, 0, 0, True, False)]


def test_repeated_windows(spark):
    """Words in windows found twice, on both sides of the number of windows that are looked up one by one."""
    import random

    rng, texts = random.Random(8), []
    for distinct in (0, 1, 2, 30, 62, 63, 64, 65, 66, 67, 70, 200):
        once = [f"u{i}" for i in range(80)]
        again = [f"r{i}" for i in range(distinct + 2)] if distinct else []
        texts.append(" ".join([*again, *once, *again]))
    texts += [" ".join(rng.choice("abcdef") for _ in range(n)) for n in (3, 4, 50, 400, 3000)] + ["a " * 500, "a b " * 500]
    expected = []
    for t in texts:
        words = t.split()
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        twice = {w for w in windows if windows.count(w) > 1}
        expected.append(len({i + k for i, w in enumerate(windows) if w in twice for k in range(3)}))
    found = quality_rules.judge_quality(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r["n_repeat_words"] for r in found] == expected and quality_rules.FEW == 64


def test_odd_near(docs):
    sets = {1: 6, 2: 0, 3: 0, 4: 0, 5: 3, 6: 5}
    found = values(minhash_dedup.near_duplicates(docs), "doc_id", "n_shingles", "component_id", "kept")
    assert found == [(None, 2, None, True), *[(i, n, i, True) for i, n in sorted([*sets.items(), (1, 6)])]]
    kept = minhash_dedup.near_duplicates(docs, keep=["text", "source", "label"])
    assert values(kept, "doc_id", "component_id", "kept", "label") == [(None, None, True, "x"), *[(i, i, True, "x") for i in sorted([*sets, 1])]]
    assert {(r["doc_id"], r["text"], r["source"]) for r in kept.collect()} == {r[:3] for r in ROWS}


def test_odd_toxic(spark, docs, labels):
    bare = toxicity.score_documents(docs, labels, keep=["source", "kept"])
    assert values(bare, "doc_id", "score", "predicted", "kept") == [(i, 0.0, 0, "x") for i in (None, 1, 1, 2, 3, 4, 5, 6)]  # no landmark to learn
    words = spark.createDataFrame([(i, f"number {i} is a moronic thing" if i % 2 else f"number {i} is a green thing") for i in range(10, 60)], "doc_id long, text string")
    marks = words.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    model = toxicity.train(words.unionByName(docs.select("doc_id", "text")), marks)
    found = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs.unionByName(words, allowMissingColumns=True), marks.unionByName(labels.where("false")), keep=["source"]).collect()}
    assert model.landmarks and found[2] == found[3] == found[4] == found[5] < 0.5 < found[11]


def test_odd_lines(docs):
    found = values(line_dedup.drop_shared_lines(docs, keep=["source", "chunk"]), "doc_id", "text", "n_lines", "n_dropped", "source")
    assert found == [(None, "no id\nline that is shared", 2, 0, "b"), (1, COPY, 3, 0, "a"), (1, COPY, 3, 0, "a"), (2, "", 1, 0, None), (3, "", 1, 0, "b"), (4, " \t\n ", 2, 0, "b"),
                     (5, LONG, 1, 0, None), (6, "Línea única: ñandú — 日本", 2, 1, "é")]


def test_odd_model(docs):
    found = values(lm_scoring.score_documents(docs), "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "n_bytes", "base_score", "score")
    assert [r[:3] for r in found] == [(i, h, n) for (i, n), h in zip([(None, 7), (1, 11), (1, 11), (2, 1), (3, 1), (4, 1), (5, 90_001), (6, 10)], [r[1] for r in found], strict=True)]
    assert all(r[6] < 0 and r[7] < 0 and r[3] <= r[2] for r in found) and len({r[4] for r in found}) == 1
    assert [r[5] for r in found if r[0] in (2, 3, 4)] == [1, 1, 1]


def test_odd_mix(docs):
    found = values(source_mix.mix_sources(docs, keep=["text", "source"]), "doc_id", "source", "size", "source_size", "taken", "copies")
    sizes = {None: 6, 1: 10, 2: 0, 3: 0, 4: 0, 5: 90_000, 6: 9}
    assert [(r[0], r[2]) for r in found] == [(i, sizes[i]) for i in (None, 1, 1, 2, 3, 4, 5, 6)]
    assert {r[1]: r[3] for r in found} == {"a": 20, "b": 6, "é": 9, None: 90_000}
    assert all(r[4] == r[2] * r[5] and 0 <= r[5] <= 3 for r in found)


def test_odd_media(docs):
    found = values(media_ts.media_features(media_ts.store_media(docs)), "doc_id", "n_bytes", "payload_bytes", "payload_sha256")
    texts = [None, *sorted(i for i, *_ in ROWS if i is not None)]
    by_id = {r[0]: r[1] or "" for r in ROWS}
    for row, i in zip(found, texts, strict=True):
        raw = by_id[i].encode()
        payload = raw + bytes(-len(raw) % 64 if raw else 64)
        assert row == (i, len(raw), len(payload), hashlib.sha256(payload).hexdigest())


@pytest.mark.parametrize("name", sorted(operators(None)))
def test_empty_table(docs, labels, name):
    assert operators(labels)[name](docs.limit(0)).collect() == []


def test_long_turns(spark):
    text = "wörd </s> " * 50_000
    turns = spark.createDataFrame([(1, 0, "user", text), (1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    found = chat_format.read_conversations(chat_format.format_conversations(turns, TOKENIZER), TOKENIZER).first()
    assert (found["loss_chars"], found["loss_sha256"]) == (len(text), hashlib.sha256(text.encode()).hexdigest())


def test_warc_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(spark, warc.write_archives(pages)).collect() == []


def test_packing_odd_rows(docs):
    pieces = packing.pack_documents(docs, TOKENIZER, partitions=20).collect()
    assert sorted({r["doc_id"] for r in pieces if r["doc_id"] is not None}) == [1, 2, 3, 4, 5, 6]
    assert [r["length"] for r in pieces if r["doc_id"] in (2, 3)] == [1, 1]
    assert packing.pack_documents(docs.limit(0), TOKENIZER).collect() == []


def test_lines(spark, docs):
    found = {r["doc_id"]: r for r in line_dedup.drop_shared_lines(docs).collect()}
    assert found[6]["text"] == "Línea única: ñandú — 日本" and found[6]["n_dropped"] == 1
    assert found[1]["n_dropped"] == 0 and found[None]["n_dropped"] == 0 and found[2]["n_lines"] == 1
    assert found[6]["kept_sha256"] == hashlib.sha256(found[6]["text"].encode()).hexdigest()


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**63, 50_000, dtype=np.uint64))
    found = line_dedup.MinimalPerfectHash(keys)
    assert sorted(found.index(keys).tolist()) == list(range(len(keys)))


def test_line_arrays():
    """Published arrays: shared lines only, lines with one key apart, any other line rejected by its fingerprint."""
    rng = np.random.default_rng(2)
    keys, prints = rng.integers(0, 2**63, 5000, dtype=np.uint64), rng.integers(0, 2**63, 5000, dtype=np.uint64)
    keys[11] = keys[12] = keys[10]  # three lines, one key
    low = np.arange(5000)
    high = np.where(low % 3 == 0, low, low + 1)  # every third line is in one document
    arrays = line_dedup.LineArrays.unpacked(*line_dedup.LineArrays.build(keys, prints, low, high).packed())
    shared, owner = arrays.probe(keys, prints)
    assert (shared == (low < high)).all() and (owner[shared] == low[shared]).all() and len(arrays.prints) < 3400
    assert not arrays.probe(keys, prints + np.uint64(1))[0].any()
    assert not arrays.probe(*rng.integers(0, 2**63, (2, 5000), dtype=np.uint64))[0].any()
    empty = line_dedup.LineArrays.unpacked(*line_dedup.LineArrays.build(*[np.zeros(0, np.uint64)] * 2, *[np.zeros(0, np.int64)] * 2).packed())
    assert not empty.probe(keys, prints)[0].any()


def test_near_duplicates(spark):
    base = [f"w{i}" for i in range(200)]
    near = base[:100] + ["x"] + base[101:]
    far = [f"v{i}" for i in range(200)]
    shared = base[:60] + [f"u{i}" for i in range(140)]
    rows = [(7, base), (3, near), (9, base), (4, far), (5, shared), (6, ["A", "b"]), (8, ["a", "B"])]
    found = {r["doc_id"]: r["component_id"] for r in minhash_dedup.near_duplicates(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string"), num=85).collect()}
    assert found == {7: 3, 3: 3, 9: 3, 4: 4, 5: 5, 6: 6, 8: 6}


@pytest.mark.parametrize("limit", [3, 4096])
def test_near_duplicates_by_brute_force(spark, limit):
    """Chains and loose groups, also through deeper nodes and blocks."""
    rng = np.random.default_rng(5)
    texts = []
    for family in range(6):
        base = [f"f{family}w{i}" for i in range(120)]
        for _ in range(25):
            words = list(base)
            for at in rng.integers(0, 120, rng.integers(0, 7)):
                words[at] = f"r{rng.integers(1 << 30)}"
            texts.append(" ".join(words))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(116)} for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if 100 * k >= 85 * (len(sets[i]) + len(sets[j]) - k):
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    signed, found = minhash_dedup.near_links(docs, 5, 85, 100, limit=limit, depth=2)
    names = {r["set_id"]: r["label"] for r in found.collect()}
    mine = {r["doc_id"]: names.get(r["set_id"], r["set_id"]) for r in signed.collect()}
    first: dict = {}
    for i in range(len(texts)):
        first.setdefault(mine[i], i)
    assert [first[mine[i]] for i in range(len(texts))] == label


@pytest.mark.parametrize("depth", [4, 8])
def test_recall_through_deep_nodes(spark, depth):
    """Pairs just above 0.80 among sets that all share half of their shingles.  No node counts as small, so all but the
    few that a node's centres find are found by branching to this depth."""
    pairs = 60
    text = lambda k, side: " ".join([*[f"s{i}" for i in range(300)], *[f"p{k}w{i}" for i in range(120)], *[f"{side}{k}x{i}" for i in range(48)]])
    docs = [(2 * k + (side == "b"), text(k, side)) for k in range(pairs) for side in "ab"]
    signed, found = minhash_dedup.near_links(spark.createDataFrame(docs, "doc_id long, text string"), 5, 80, 100, limit=1, depth=depth)
    names = {r["set_id"]: r["label"] for r in found.collect()}
    mine = {r["doc_id"]: names.get(r["set_id"], r["set_id"]) for r in signed.collect()}
    assert [k for k in range(pairs) if mine[2 * k] != mine[2 * k + 1]] == []
    assert len(set(mine.values())) == pairs


def test_pair_recall():
    """The formula against walks down random trees."""
    rng = np.random.default_rng(4)
    for s, level in ((0.8, 1), (0.8, 4), (0.85, 6)):
        met = 0
        for _ in range(4000):
            nodes = int(rng.random() < s)
            for _ in range(level - 1):
                picks = nodes + int((rng.random(nodes) < 1 / s - 1).sum())
                nodes = int((rng.random(picks) < s).sum())
            met += nodes > 0
        assert met / 4000 == pytest.approx(minhash_dedup.pair_recall(s, level, 1), abs=0.03)


def test_mix():
    assert source_mix.water_fill([100, 100, 1], [1, 2, 3], 3) == pytest.approx([66.0, 132.0, 3.0])
    assert source_mix.water_fill([], [], 3) == []
    assert source_mix.water_fill([0, 10], [1, 1], 3) == [0.0, 10.0]


def test_mix_comes_near(spark):
    rows = [(i, "w " * (i % 50 + 1), f"s{i % 3}") for i in range(3000)]
    found = source_mix.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"), keep=["source"])
    for r in found.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g")).collect():
        assert abs(r["t"] - r["g"]) <= 25


def test_pack_tree():
    sizes = np.array([1500] * 40 + [500] * 40)
    bins, offset, fill = packing.best_fit(sizes, 2048)
    assert len(fill) == 40 and max(fill) == 2000
    assert packing.cut(5000, 2048) == [(0, 904), (904, 2048), (2952, 2048)]
    assert packing.cut(2048, 2048) == [(0, 2048)] and packing.cut(4096, 2048) == [(0, 2048), (2048, 2048)]
    up = packing.handed_up(np.array([100, 1100, 1200, 1300, 2047]), 2048, 16, 2)
    assert up.tolist() == [True, True, True, False, False]


def test_tokens():
    from tokenizers import Tokenizer

    found, loaded = tokens.encoder(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    odd = ["", "  a  b \n\n c", "it's  we'll \t x", "日本語 テキスト　x", "<|endoftext|> hi", "hi <|endoftext|> you", "x<|endoftext|>", "<|endoftext |>", "a\r\n\r\nb  ", " ", "a  \n\nb", None, "x" * 5000, "\x1ca b\x1f c", "word. word, word", "1.000,5 %"]
    for text, ids in zip(odd, found.documents(pa.array(odd)), strict=True):
        assert ids.tolist() == loaded.encode(text or "", add_special_tokens=False).ids


def test_chat(spark):
    control = "</s>[INST] ok [/INST] <|end|> \\<|text|> <\\|turn|>"
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", control), (1, 1, "assistant", None), (2, 0, None, ""), (None, 3, "system", "x\ny")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("ids", F.lit("x"))
    read = {r["conv_id"]: r for r in chat_format.read_conversations(chat_format.format_conversations(turns, TOKENIZER), TOKENIZER).collect()}
    assert read[1]["loss_chars"] == len(control) and read[1]["loss_sha256"] == hashlib.sha256(control.encode()).hexdigest()
    assert read[1]["turns_sha256"] == hashlib.sha256(f"user\nhi\nassistant\n\nassistant\n{control}\n".encode()).hexdigest()
    assert read[2]["n_turns"] == 1 and read[None]["n_turns"] == 1
    assert chat_format.read_conversations(chat_format.format_conversations(turns.limit(0), TOKENIZER), TOKENIZER).count() == 0


def test_transport_streams():
    for n in [*range(64, 1024, 64), 16384, 16448, 100_032]:
        payload = os.urandom(n)
        stream = media_ts.write_stream(payload)
        found = media_ts.read_stream(stream)
        assert found.payload == payload and len(stream) % 188 == 0 and found.programs == {0x100: 6}
        assert [t for t, _ in found.points] == [k * 3600 for k in range(-(-n // 16384))]
    with pytest.raises(ValueError, match="missing"):
        media_ts.read_stream(stream[: 188 * 5] + stream[188 * 6 :])
    with pytest.raises(ValueError, match="checksum"):
        media_ts.read_stream(stream[:10] + b"\xff" + stream[11:])


def test_warc(spark):
    big = "é" * 30_000
    rows = [(1, "u\n1", big), (2, None, big), (3, "v", None), (4, "v", ""), (5, "w", "x"), (5, "w", "x"), (None, "n", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("x"))
    found = warc.read_archives(spark, warc.write_archives(pages)).collect()
    got = sorted((r["page_id"] if r["page_id"] is not None else -1, r["payload_bytes"], r["record_type"], r["refers_to"]) for r in found)
    assert got == [(-1, 1, "revisit", 5), (1, 60_000, "revisit", 2), (2, 60_000, "response", None), (3, 0, "revisit", 4), (4, 0, "response", None), (5, 1, "response", None), (5, 1, "response", None)]
    assert {r["payload_digest"] for r in found if r["page_id"] == 1} == {base64.b32encode(hashlib.sha1(big.encode()).digest()).decode()}
    assert warc.read_archives(spark, warc.write_archives(pages, min_bytes=2)).where("record_type = 'revisit'").count() == 1
    parts = [(2, 6, b"def"), (1, None, b"abc")]
    assert warc.whole(parts) == b"abcdef"
    with pytest.raises(ValueError, match="segments"):
        warc.whole([(1, None, b"abc"), (3, 6, b"def")])


def test_toxicity_spelling():
    insults = ["moronic", "worthless", "pathetic"]
    rng = np.random.default_rng(0)
    words = ["house", "river", "table", "green", "walk", "paper", "stone", "light", "every", "music"]
    clean = [" ".join(rng.choice(words, 30)) + "." for _ in range(120)]
    toxic = [" ".join(rng.choice(words, 20)) + f" {rng.choice(insults)} " + " ".join(rng.choice(words, 10)) for _ in range(60)]
    model = toxicity.fit(pa.array(clean + toxic), np.array([False] * 120 + [True] * 60))
    from dispensa.llm import textvec as V

    def scores(texts):
        return model.scores(model.margins(*V.flat(pa.array(texts))))

    assert (scores(["a pathetic house", "p a t h e t i c river", "so w.o.r.t.h.l.e.s.s", "MORONIC table"]) > 0.5).all()
    assert (scores(["green house", "", "a path to the river", "the theme of music"]) < 0.5).all()
