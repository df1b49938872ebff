"""Toxicity scores from a subsequence string kernel.

Method: a support vector machine on a Nyström-style map of the gap-weighted
subsequence kernel.  Landmarks are short strings (words and word beginnings)
chosen from the labelled documents so that together they cover the toxic ones.
A unit of text (a word) is mapped to its kernel values with the landmarks,
whitened by the landmarks' own kernel matrix; a sentence is the element-wise
maximum of its units' kernel values.  The machine is trained on sentences: of a
document labelled 0 all are negative, of one labelled 1 the sentence with the
highest margin is its witness, chosen anew in every round.  A document's score
is a fitted logistic curve of its best sentence's margin and the next two's mean,
so that an insult is enough, and many doubtful words count more than one.

The kernel counts common subsequences of ORDER characters, each weighted by
DECAY per character it spans, so inserted characters and gaps lower a value
without removing it.  Of each place of a landmark only the best occurrence in the
unit counts, so that repeated pieces ("ororon") don't add up to a whole match.  Units are made so that spelling tricks stay inside one:
A-Z are lower-cased, characters other than letters and digits are dropped from
words, and runs of three or more one-letter words are joined.  Neighbouring words
that together are about as long as a landmark and begin like one are a further
unit, so that a landmark in fragments ("mor onic") is seen whole.  Longer units
than WINDOW bytes are seen through overlapping windows, so no text is cut.  The
machine and the curve are also fitted on passages of toxic documents in which a
landmark has an inserted letter or a gap; they count as much as their documents.

Fitting takes at most `max_train` labelled documents, those first by md5 of
their doc_id within each label, as long as they have at most `max_bytes` together
and a 64th of that each (documented bounds; scoring reads all texts whole).  Of
one doc_id with several texts, the first by hash is learnt from.  lang, source, doc_id and labels are never inputs of a score.

Null and empty texts have no sentence and get the score of a text without any
unit near a landmark.  Repeated rows are scored one by one.  Labels of one
doc_id that disagree count as toxic.  Without a label of both kinds, every score
is 0.  An empty table gives an empty result.  Extra columns are carried along if
named in `keep`; those named like the operator's own give way."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textvec as V
from .common import materialize

U = np.uint64
ORDER = 3
DECAY = 0.75
LANDMARKS = 96
#: What a toxic document counts for a further landmark with each it has already, and the count (of the least that any landmark needs) at which none is added.
COVERED, ENOUGH = 0.6, 0.3
#: Units near no landmark that a task remembers, so as not to compare them again.
FAR = 1_000_000
#: A landmark's documents that aren't toxic, at most, as a share of its toxic ones at equal numbers of both.
FALSE = 0.06
#: The same of a landmark that makes any passage toxic.
PURE = 0.004
WINDOW, STEP = 32, 16
#: Kernel values (of a landmark with itself: 1) below this count as 0.
LEAST = 0.4
#: A power of a kernel is a kernel; this one sets whole matches further apart from partial ones.
POWER = 2
#: Joined words may be this many bytes longer than the longest landmark.
ROOM = 2
#: Passages with a changed landmark that one toxic document gives to training, and characters around it.
PASSAGES, AROUND = 6, 60
LETTER = np.zeros(256, bool)
LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
STOP = np.zeros(256, bool)
STOP[[10, 33, 46, 63]] = True  # a sentence ends at \n ! . ?
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


@dataclass
class Units:
    """Distinct units of a slice and where they stand."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    back: np.ndarray  # of every unit, its distinct one
    sentence: np.ndarray  # of every unit, numbered through the slice
    doc: np.ndarray  # of every sentence
    mark: np.ndarray  # hash of every distinct unit, sorted


def units(data: np.ndarray, off: np.ndarray, begins: np.ndarray | None = None, reach: int = 0) -> Units:
    """Words without other characters than letters and digits; runs of one-letter words are one unit.

    Neighbouring words of up to `reach` bytes together are a further unit if the
    first two bytes, or the first and the third, are marked in `begins`."""
    low = FOLD[data]
    letter = LETTER[low]
    starts, ends, doc = V.words(low, off)
    letters = np.r_[0, np.cumsum(letter)]
    solid = letters[ends] > letters[starts]  # else only marks, as "***"
    kept_points = np.r_[0, np.cumsum(letter & ((low & 0xC0) != 0x80))]
    single = solid & (kept_points[ends] - kept_points[starts] == 1)
    stops = np.r_[0, np.cumsum(STOP[data])]
    n = len(starts)
    joined = np.zeros(n, bool)  # to the word before
    if n > 2:
        pair = single[1:] & single[:-1] & (doc[1:] == doc[:-1])
        run_start, run_end = V.runs(pair, np.array([0, len(pair)]))
        for a, b in zip(run_start, run_end, strict=True):
            if b - a >= 2:
                joined[a + 1 : b + 1] = True
    # letters only, in order; a unit starts at every word that isn't joined
    src = np.flatnonzero(letter)
    compact = low[src]
    first, last = letters[starts], letters[ends]
    lead = np.flatnonzero(~joined & solid) if n else np.zeros(0, np.int64)
    heads = np.flatnonzero(~joined) if n else np.zeros(0, np.int64)
    tail = np.r_[heads[1:], n] - 1 if n else heads
    begin, end = first[heads], last[tail]
    keep = np.isin(heads, lead, assume_unique=True)
    begin, end, at, unit_doc = begin[keep], end[keep], starts[heads[keep]], doc[heads[keep]]
    # long units through windows
    size = end - begin
    long = np.flatnonzero(size > WINDOW)
    if len(long):
        more = [np.arange(begin[i], max(end[i] - STEP, begin[i] + 1), STEP) for i in long]
        reps = [len(m) for m in more]
        short = np.flatnonzero(size <= WINDOW)
        w = np.concatenate(more)
        begin, end = np.r_[begin[short], w], np.r_[end[short], np.minimum(w + WINDOW, np.repeat(end[long], reps))]
        at, unit_doc = np.r_[at[short], np.repeat(at[long], reps)], np.r_[unit_doc[short], np.repeat(unit_doc[long], reps)]
    if begins is not None and len(compact) > 2:
        more = _joined(compact, first[solid], last[solid], doc[solid], begins, reach)
        begin, end = np.r_[begin, more[0]], np.r_[end, more[1]]
        at, unit_doc = np.r_[at, starts[solid][more[2]]], np.r_[unit_doc, doc[solid][more[2]]]
    sentence_key = unit_doc.astype(np.int64) * (len(data) + 1) + stops[at]
    keys, sentence = np.unique(sentence_key, return_inverse=True)
    marks = V.hashes(compact, begin, end)
    distinct, pick, back = np.unique(marks, return_index=True, return_inverse=True)
    return Units(compact, begin[pick], end[pick], back, sentence, (keys // (len(data) + 1)).astype(np.int64), distinct)


def _joined(compact: np.ndarray, first: np.ndarray, last: np.ndarray, doc: np.ndarray, begins: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, end, first word) of two or more neighbouring words of a document, up to `reach` bytes together."""
    follow = compact[np.minimum(first[:, None] + np.arange(3), len(compact) - 1)]
    head = np.flatnonzero((last - first < reach) & (begins[follow[:, 0], follow[:, 1]] | begins[follow[:, 0], follow[:, 2]]))
    found = [np.zeros((3, 0), np.int64)]
    for k in range(1, reach):
        head = head[head + k < len(first)]
        head = head[(doc[head + k] == doc[head]) & (last[head + k] - first[head] <= reach)]
        if not len(head):
            break
        found.append(np.stack([first[head], last[head + k], head]))
    return tuple(np.concatenate(found, axis=1))


def kernel(texts: np.ndarray, lengths: np.ndarray, landmark: bytes) -> np.ndarray:
    """Gap-weighted subsequence kernel of order ORDER between rows of bytes (0 beyond their length) and a landmark,
    of every place of the landmark the best occurrence."""
    t = np.frombuffer(landmark, np.uint8)
    n, m = len(texts), len(t)
    fade = np.tril(DECAY ** (np.arange(m)[:, None] - np.arange(m)[None, :]).clip(0)).T  # [from, to], to >= from
    partial = [np.zeros((n, m + 1)) for _ in range(ORDER)]  # of order i, over prefixes of the landmark
    partial[0][:] = 1.0
    best = [np.zeros((n, m)) for _ in range(ORDER + 1)]  # of order i, by the landmark's place where it ends
    for pos in range(int(lengths.max(initial=0))):
        same = (texts[:, pos][:, None] == t) & (lengths > pos)[:, None]
        grown = [same * partial[i][:, :-1] * DECAY**2 for i in range(ORDER)]
        np.maximum(best[ORDER], grown[ORDER - 1], out=best[ORDER])
        for i in range(1, ORDER):
            best[i] = np.maximum(best[i] * DECAY, grown[i - 1])
            partial[i][:, 1:] = best[i] @ fade
    return best[ORDER].sum(axis=1)


def _rows(found: Units, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = found.ends[which] - found.starts[which]
    width = int(size.max(initial=1))
    at = found.starts[which][:, None] + np.arange(width)
    inside = np.arange(width) < size[:, None]
    return np.where(inside, found.data[np.minimum(at, len(found.data) - 1)], 0).astype(np.uint8), size


@dataclass
class Model:
    landmarks: list[bytes] = field(default_factory=list)
    scale: np.ndarray = field(default_factory=lambda: np.zeros(0))
    white: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = 0.0
    slope: np.ndarray = field(default_factory=lambda: np.zeros(2))
    shift: float = 0.0
    begins: np.ndarray | None = None  # the first two bytes of landmarks
    reach: int = 0
    far: np.ndarray = field(default_factory=lambda: np.zeros(0, U))  # units that were found near no landmark, sorted

    def set_landmarks(self, landmarks: list[bytes]) -> None:
        """Kernel matrix of the landmarks, its diagonal (the scale) and its inverse root (the Nyström map)."""
        self.landmarks, self.far = landmarks, np.zeros(0, U)
        width = max(map(len, landmarks))
        rows = np.zeros((len(landmarks), width), np.uint8)
        for i, t in enumerate(landmarks):
            rows[i, : len(t)] = np.frombuffer(t, np.uint8)
        sizes = np.array([len(t) for t in landmarks])
        gram = np.stack([kernel(rows, sizes, t) for t in landmarks], axis=1)
        self.begins, self.reach = np.zeros((256, 256), bool), width + ROOM
        self.begins[rows[:, 0], rows[:, 1]] = True
        self.scale = np.diag(gram).copy()
        gram = (gram / np.sqrt(self.scale[:, None] * self.scale[None, :])) ** POWER
        values, vectors = np.linalg.eigh((gram + gram.T) / 2)
        self.white = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 0.05))) @ vectors.T

    def near(self, found: Units) -> tuple[np.ndarray, np.ndarray]:
        """(distinct units with a value of LEAST or more, their values by landmark, 1 for the landmark itself)."""
        n = len(found.starts)
        if not n or not self.landmarks:
            return np.zeros(0, np.int64), np.zeros((0, len(self.landmarks)))
        bit = U(1) << (np.arange(256, dtype=U) % U(61))
        masks = np.zeros(n, U)
        size = found.ends - found.starts
        for pos in range(int(size.max(initial=0))):
            live = np.flatnonzero(size > pos)
            masks[live] |= bit[found.data[found.starts[live] + pos]]
        open_ = np.ones(n, bool)
        if len(self.far):
            open_ = self.far[np.minimum(np.searchsorted(self.far, found.mark), len(self.far) - 1)] != found.mark
        cells = []
        for j, t in enumerate(self.landmarks):
            letters = np.bitwise_or.reduce(bit[np.frombuffer(t, np.uint8)])
            need = max(ORDER, int(letters).bit_count() - 1)  # a unit may lack one of the letters
            which = np.flatnonzero(open_ & (np.bitwise_count(masks & letters) >= need) & (size >= ORDER)) if int(letters).bit_count() >= ORDER else np.zeros(0, np.int64)
            for a in range(0, len(which), 50_000):
                part = which[a : a + 50_000]
                rows, sizes = _rows(found, part)
                k = kernel(rows, sizes, t) / self.scale[j]
                hit = k >= LEAST
                cells.append((part[hit], np.full(int(hit.sum()), j), np.minimum(k[hit], 1.0) ** POWER))
        if not cells:
            return np.zeros(0, np.int64), np.zeros((0, len(self.landmarks)))
        for part, _, _ in cells:
            open_[part] = False
        far = found.mark[open_]
        self.far = np.sort(np.concatenate([self.far, far]), kind="stable") if len(self.far) + len(far) <= FAR else far
        unit, column, value = (np.concatenate(x) for x in zip(*cells, strict=True))
        distinct, row = np.unique(unit, return_inverse=True)
        out = np.zeros((len(distinct), len(self.landmarks)))
        out[row, column] = value
        return distinct, out

    def sentences(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document, Nyström features) of the sentences of a slice that have a unit near a landmark."""
        found = units(data, off, self.begins, self.reach)
        near, values = self.near(found)
        if not len(near):
            return np.zeros(0, np.int64), np.zeros((0, len(self.landmarks)))
        place = np.full(len(found.starts), -1)
        place[near] = np.arange(len(near))
        where = np.flatnonzero(place[found.back] >= 0)
        where = where[np.argsort(found.sentence[where], kind="stable")]
        sentence = found.sentence[where]
        at = np.flatnonzero(np.r_[True, sentence[1:] != sentence[:-1]])
        pooled = np.maximum.reduceat(values[place[found.back[where]]], at, axis=0)
        return found.doc[sentence[at]], pooled @ self.white

    def margins(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """(the best sentence's margin, the mean of the next two) of every document of a slice; the bias for sentences that aren't there or near no landmark."""
        doc, features = self.sentences(data, off)
        return _tops(doc, features @ self.weights + self.bias if len(doc) else np.zeros(0), len(off) - 1, self.bias)

    def scores(self, margins: np.ndarray) -> np.ndarray:
        if not self.landmarks:
            return np.zeros(len(margins))
        return 1 / (1 + np.exp(-np.clip(margins @ self.slope + self.shift, -700, 700)))


def _tops(doc: np.ndarray, margin: np.ndarray, size: int, bias: float) -> np.ndarray:
    """Of every document the largest margin and the mean of the next two, with `bias` for missing and smaller ones."""
    out = np.full((size, 3), bias)
    order = np.lexsort((-margin, doc))
    doc, margin = doc[order], np.maximum(margin[order], bias)
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, np.int64)
    rank = np.arange(len(doc)) - np.repeat(first, np.diff(np.r_[first, len(doc)]))
    top = rank < 3
    out[doc[top], rank[top]] = margin[top]
    return np.stack([out[:, 0], out[:, 1:].mean(axis=1)], axis=1)


def _strings(data: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, set[bytes]]]:
    """(document, its words of up to 12 bytes and their beginnings of 4 to 8) of a column."""
    for first, end, part, offsets in V.slices(data, off):
        found = units(part, offsets)
        raw = found.data.tobytes()
        parts = []
        for a, b in zip(found.starts.tolist(), found.ends.tolist(), strict=True):
            parts.append([raw[a : a + k] for k in range(4, min(b - a, 9))] + ([raw[a:b]] if 4 <= b - a <= 12 else []))
        docs = found.doc[found.sentence]
        order = np.argsort(docs, kind="stable")
        cut = np.searchsorted(docs[order], np.arange(end - first + 1))
        back = found.back[order]
        for i in range(end - first):
            yield first + i, {x for u in set(back[cut[i] : cut[i + 1]].tolist()) for x in parts[u]}


def _candidates(texts: pa.Array, toxic: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """(landmarks, those that are toxic by themselves): strings in toxic documents and nearly no others, chosen greedily by how many documents they newly cover."""
    bad, good = V.flat(texts.filter(pa.array(toxic))), V.flat(texts.filter(pa.array(~toxic)))
    hits = Counter(x for _, found in _strings(*bad) for x in found)
    least = min(8, max(2, int(0.1 * toxic.sum())))
    hits = {x: n for x, n in hits.items() if n >= least and len(set(x)) >= ORDER}
    false = Counter(x for _, found in _strings(*good) for x in found if x in hits)
    share = FALSE * max(1, (~toxic).sum()) / max(1, toxic.sum())
    holders: dict[bytes, list[int]] = {x: [] for x, n in hits.items() if false[x] <= share * n}
    for d, found in _strings(*bad):
        for x in found:
            if x in holders:
                holders[x].append(d)
    chosen: list[bytes] = []
    value = np.ones(int(toxic.sum()))  # a document counts less the more landmarks cover it
    while holders and len(chosen) < LANDMARKS:
        gain = {x: float(value[docs].sum()) for x, docs in holders.items()}
        best = max(gain, key=lambda x: (round(gain[x], 6), len(x), x))  # of equal ones the longer string says more
        if gain[best] < least * ENOUGH:
            break
        chosen.append(best)
        value[holders.pop(best)] *= COVERED
        holders = {x: docs for x, docs in holders.items() if gain[x] >= least * ENOUGH}
    return chosen, [x for x in chosen if false[x] * FALSE <= share * hits[x] * PURE]


def _hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-4) -> tuple[np.ndarray, float]:
    """Linear support vector machine (squared hinge loss) by Newton steps over the set of margin violations."""
    x1 = np.c_[x, np.ones(len(x))]
    w, ridge = np.zeros(x1.shape[1]), np.r_[np.full(x.shape[1], penalty), 1e-9]
    weight = weight / weight.sum()
    inside = None
    for _ in range(60):
        now = y * (x1 @ w) < 1
        if inside is not None and (now == inside).all():
            break
        inside = now
        xa = x1[now] * weight[now, None]
        goal = np.linalg.solve(2 * xa.T @ x1[now] + np.diag(ridge), 2 * xa.T @ y[now])

        def loss(v: np.ndarray) -> float:
            return float((weight * np.maximum(0, 1 - y * (x1 @ v)) ** 2).sum() + 0.5 * (ridge * v * v).sum())

        step = 1.0
        while step > 1e-3 and loss(w + step * (goal - w)) > loss(w):
            step /= 2
        w = w + step * (goal - w)
    return w[:-1], float(w[-1])


def _spellings(texts: pa.Array, landmarks: list[bytes]) -> tuple[list[str], np.ndarray]:
    """(passages around landmarks, one of them with an inserted letter, with a gap or as it is; the text of each)."""
    whole = []
    for t in landmarks:
        try:
            whole.append(t.decode())
        except UnicodeDecodeError:  # a beginning that ends inside a character
            continue
    whole = [t for t in whole if len(t) > 1]
    if not whole:
        return [], np.zeros(0, np.int64)
    pattern = re.compile(r"(?<![^\W_])(?:" + "|".join(re.escape(t) for t in sorted(whole, key=len, reverse=True)) + ")", re.IGNORECASE)
    rng, passages, of = np.random.default_rng(20240611), [], []
    for i, text in enumerate(texts.to_pylist()):
        hits = list(pattern.finditer(text or ""))
        for k in range(PASSAGES if hits else 0):
            hit = hits[int(rng.integers(len(hits)))]
            at = hit.start() + int(rng.integers(1, hit.end() - hit.start()))
            new = " " if k % 4 == 2 else "" if k % 4 == 3 else chr(97 + int(rng.integers(26)))
            passages.append(text[max(0, hit.start() - AROUND) : at] + new + text[at : hit.end() + AROUND])
            of.append(i)
    return passages, np.array(of, np.int64)


def _machine(model: Model, texts: pa.Array, toxic: np.ndarray, weight: np.ndarray, rounds: int) -> None:
    """Weights, bias, slope and shift from texts that count by their weight."""
    docs, features = [], []
    for first, _, part, offsets in V.slices(*V.flat(texts)):
        doc, x = model.sentences(part, offsets)
        docs.append(first + doc)
        features.append(x)
    doc, x = np.concatenate(docs), np.concatenate(features)
    bare = np.setdiff1d(np.arange(len(toxic)), doc)  # documents without any unit near a landmark
    doc, x = np.r_[doc, bare], np.r_[x, np.zeros((len(bare), x.shape[1]))]
    margin = x.sum(axis=1)
    for _ in range(rounds):
        order = np.lexsort((-margin, doc))
        witness = order[np.r_[True, doc[order][1:] != doc[order][:-1]]]
        use = np.r_[witness, np.setdiff1d(np.flatnonzero(~toxic[doc]), witness)]
        y = np.where(toxic[doc[use]], 1.0, -1.0)
        share = weight[doc[use]]
        share = share * np.where(y > 0, 0.5 / max(share[y > 0].sum(), 1e-9), 0.5 / max(share[y < 0].sum(), 1e-9))
        model.weights, model.bias = _hinge(x[use], y, share)
        margin = x @ model.weights + model.bias
    model.slope, model.shift = _logistic(_tops(doc, margin, len(toxic), model.bias), toxic, weight)


def fit(texts: pa.Array, toxic: np.ndarray, rounds: int = 4) -> Model:
    model = Model()
    texts = pa.concat_arrays(texts.chunks) if isinstance(texts, pa.ChunkedArray) else texts
    landmarks, pure = _candidates(texts, toxic) if 0 < toxic.sum() < len(toxic) else ([], [])
    if not landmarks:
        return model
    model.set_landmarks(landmarks)
    _machine(model, texts, toxic, np.ones(len(toxic)), rounds)
    # again with passages around the landmarks that are toxic by themselves, changed and unchanged
    passages, of = _spellings(texts.filter(pa.array(toxic)), pure)
    if passages:
        copies = np.bincount(of, minlength=int(toxic.sum()))
        weight = np.r_[np.ones(len(toxic)), 1 / copies[of]]
        both = pa.concat_arrays([texts.cast(pa.large_string()), pa.array(passages, pa.large_string())])
        _machine(model, both, np.r_[toxic, np.ones(len(of), bool)], weight, rounds)
    return model


def _logistic(margins: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Slopes (none falls) and shift of the curve from margins to probability, with smoothed targets."""
    n1, n0 = float(weight[toxic].sum()), float(weight[~toxic].sum())
    target = np.where(toxic, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    use = np.ones(margins.shape[1], bool)
    while True:
        x = np.c_[margins * use, np.ones(len(margins))]
        w = np.r_[use * 1.0, 0.0]
        ridge = np.diag(np.r_[np.full(margins.shape[1], 1e-3), 1e-6])
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
            step = np.linalg.solve((x * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + ridge, x.T @ (weight * (p - target)) + ridge @ w)
            step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
            w = w - step
            if np.abs(step).max() < 1e-9:
                break
        falls = use & (w[:-1] < 0)
        if not falls.any():
            return np.where(use, w[:-1], 0.0), float(w[-1])
        use &= ~falls


def train(docs: DataFrame, labels: DataFrame, folds: int = 5, held_fold: int = 0, max_train: int = 6_000, max_bytes: int = 64 << 20) -> Model:
    """Model from labelled documents outside the held-out fold, at most a quarter of max_train and of max_bytes toxic and three quarters others."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    known = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.where(F.crc32(key.cast("binary")) % folds != held_fold).withColumn("toxic", F.when(F.col("toxic") > 0, 1).otherwise(0))
    picked = None
    for label in (0, 1):  # the first by md5, found by partial top-k
        side = known.where(F.col("toxic") == label).orderBy(F.md5(key), "doc_id").limit(max_train // 4 if label else max_train - max_train // 4)
        picked = side if picked is None else picked.unionByName(side)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"))
    # at most max_train rows of two numbers are broadcast
    labelled = materialize(texts.where(F.col("size") <= max_bytes // 64).join(F.broadcast(picked), "doc_id"), "labelled")
    one = labelled.groupBy("doc_id").agg(F.min_by(F.struct("text", "size", "toxic"), F.xxhash64("text")).alias("d")).select("doc_id", "d.*")
    so_far = F.sum("size").over(Window.partitionBy("toxic").orderBy(F.md5(key), "doc_id"))  # over at most max_train rows
    within = one.select("doc_id", "toxic", so_far.alias("sum"))
    within = within.where(F.col("sum") <= F.when(F.col("toxic") == 1, max_bytes // 4).otherwise(max_bytes - max_bytes // 4)).select("doc_id")
    sample = one.join(within, "doc_id").select("doc_id", "text", "toxic")

    def fit_group(table: pa.Table) -> pa.Table:
        import pickle

        order = np.argsort(table.column("doc_id").to_numpy(), kind="stable")
        table = table.take(pa.array(order))
        model = fit(table.column("text"), table.column("toxic").to_numpy() == 1)
        model.far = np.zeros(0, U)
        return pa.table({"model": pa.array([pickle.dumps(model)], pa.binary())})

    import pickle

    found = sample.withColumn("one", F.lit(0)).groupBy("one").applyInArrow(fit_group, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else Model()


def _score(model: Model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = V.flat(batch.column("text"))
            out = np.zeros(batch.num_rows)
            for first, end, part, offsets in V.slices(data, off):
                out[first:end] = model.scores(model.margins(part, offsets))
            columns = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out), pa.array((out >= 0.5).astype(np.int32))], names=[*batch.schema.names, "score", "predicted"])

    return score


def score_documents(docs: DataFrame, labels: DataFrame, folds: int = 5, held_fold: int = 0, max_train: int = 6_000, max_bytes: int = 64 << 20, keep: list[str] | None = None) -> DataFrame:
    """docs: doc_id, text; labels: doc_id, toxic.  Returns doc_id, the columns in
    `keep`, text, held_out (crc32(doc_id) mod folds is held_fold), score and predicted."""
    model = train(docs, labels, folds, held_fold, max_train, max_bytes)
    extra = [c for c in keep or [] if c not in ("doc_id", "text", "held_out", "score", "predicted")]
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *extra, F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("held_out", F.crc32(key.cast("binary")) % folds == held_fold)
    schema = ", ".join([f"`{name}` {kind}" for name, kind in rows.dtypes] + ["score double, predicted int"])
    return rows.mapInArrow(_score(model), schema)
