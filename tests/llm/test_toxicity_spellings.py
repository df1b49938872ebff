"""Insults with an inserted letter or in fragments, and clean text that comes near."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from dispensa.llm import textvec as V
from dispensa.llm import toxicity

INSULTS = ["moronic", "worthless", "pathetic", "loser"]


@pytest.fixture(scope="module")
def scores():
    rng = np.random.default_rng(0)
    words = ["house", "river", "table", "green", "walk", "paper", "stone", "light", "every", "music", "ororon", "path", "worthy", "closed", "morose", "pathology"]
    clean = [" ".join(rng.choice(words, 30)) + "." for _ in range(120)]
    toxic = [" ".join(rng.choice(words, 20)) + f" {rng.choice(INSULTS)} " + " ".join(rng.choice(words, 10)) for _ in range(80)]
    model = toxicity.fit(pa.array(clean + toxic), np.array([False] * 120 + [True] * 80))
    return lambda texts: model.scores(model.margins(*V.flat(pa.array(texts))))


@pytest.mark.parametrize("word", INSULTS)
def test_inserted_letters(scores, word):
    assert (scores([f"a {word[:i]}{x}{word[i:]} river" for i in range(1, len(word)) for x in "aqx"]) > 0.5).all()


@pytest.mark.parametrize("word", INSULTS)
def test_fragments(scores, word):
    assert (scores([f"a {word[:i]} {word[i:]} river" for i in range(1, len(word))]) > 0.5).all()
    assert (scores([f"a {word[:2]} {word[2]} {word[3:]} river", f"{word[:1]} {word[1:3]} - {word[3:]}"]) > 0.5).all()


def test_clean_text_near_insults(scores):
    assert (scores(["the path to worthy", "ororon ororonor", "the closed house", "path house"]) < 0.5).all()


def test_repeated_pieces_are_no_match():
    rows = np.array([list(b"ororon"), list(b"moron\0")], np.uint8)
    value = toxicity.kernel(rows, np.array([6, 5]), b"moron")
    assert value[0] < 0.7 * value[1]


def plain_kernel(unit, landmark):
    """By recursion over places: of each place of the landmark the best occurrence in the unit, DECAY per character spanned in both."""
    decay = toxicity.DECAY

    def reached(order, place, end):
        """Best subsequence of this order that ends at a place of the landmark, seen from unit[end]."""
        return max([decay ** (end - e) * grown(order, place, e) for e in range(end + 1) if unit[e] == landmark[place]], default=0.0)

    def grown(order, place, e):
        if order == 1:
            return decay**2
        return decay**2 * sum(decay ** (place - 1 - p) * reached(order - 1, p, e - 1) for p in range(place))

    return sum(max([grown(toxicity.ORDER, r, e) for e in range(len(unit)) if unit[e] == landmark[r]], default=0.0) for r in range(len(landmark)))


def test_kernel_by_recursion():
    rng = np.random.default_rng(3)
    for _ in range(60):
        landmark = "".join(rng.choice(list("abcd"), rng.integers(3, 6))).encode()
        units = ["".join(rng.choice(list("abcde"), rng.integers(1, 8))).encode() for _ in range(5)]
        rows = np.zeros((5, 8), np.uint8)
        for i, u in enumerate(units):
            rows[i, : len(u)] = np.frombuffer(u, np.uint8)
        found = toxicity.kernel(rows, np.array([len(u) for u in units]), landmark)
        assert found == pytest.approx([plain_kernel(u, landmark) for u in units])


def test_every_learnt_insult_in_every_spelling():
    """Insults of the labelled documents that are landmarks: whatever scores as toxic plain does so doubled, in gaps and, mostly, with a letter inserted."""
    import duckdb

    data = "/root/testdata/sf0.1"
    rows = duckdb.connect().execute(f"SELECT doc_id, text, toxic FROM '{data}/documents.parquet' JOIN '{data}/labels.parquet' USING (doc_id) ORDER BY doc_id").fetchall()
    train = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    model = toxicity.fit(pa.array([r[1] or "" for r in train]), np.array([r[2] > 0 for r in train]))

    def share(texts):
        return float((model.scores(model.margins(*V.flat(pa.array(texts)))) >= 0.5).mean())

    def said(forms):
        return [f"you are a {x} man" for x in forms]

    words = [w for w in ("trash", "pathetic", "worthless", "idiot", "disgusting", "loser", "scum", "clown", "moron", "stupid") if w.encode() in model.landmarks]
    assert len(words) == 10 and share(said(words)) == 1.0
    inserted = [share(said([w[:k] + c + w[k:] for k in range(1, len(w)) for c in "abcdefghijklmnopqrstuvwxyz"])) for w in words]
    doubled = [share(said([w[:k] + w[k] + w[k:] for k in range(len(w))])) for w in words]
    gapped = [share(said([w[:k] + " " + w[k:] for k in range(1, len(w))] + [" ".join(w), "-".join(w), ".".join(w)])) for w in words]
    assert min(gapped) == 1.0 and np.mean(doubled) > 0.9 and np.mean(inserted) > 0.8, (inserted, doubled, gapped)
