"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams (3 to 5, with word bounds) and itself, hashed;
its vector is their mean. A window of ``WINDOW`` words is the mean of its word vectors, and
a linear softmax over that mean gives clean/toxic. Embeddings and softmax are trained
together, so a misspelling that was never seen gets the vectors of the n-grams it shares.

Labels are given per document, toxic words are few: training repeats (1) fit windows to
labels and (2) keep as toxic windows of a toxic document only those that score above what
clean documents reach (its best one at least). The document's score is that of its most
toxic window, turned into a probability by a one-dimensional logistic fit on documents
that the embeddings were not trained on, weighted to the labels' true shares.

Bounds: the fit uses at most ``SAMPLE`` documents of each label, of any length. Of a text
longer than ``SAMPLE_CHARS`` the embeddings see as many characters, in stretches picked by a
hash from the whole text; the calibration takes the most toxic window of whole texts, found
by Spark. Scoring reads whole texts. After training a subword contributes one number (its
embedding times the softmax weights), so the model sent to tasks is one array of ``BUCKETS``
floats.

Defined cases: a null, empty or letterless text is scored as a window without words;
unlabelled or null labels, and ids whose labels disagree, are not learned from; of an id with
several texts the one with the least hash is; with one class or none to learn from every
score is that class's share (0 if none); repeated rows are scored each, and equal texts get
equal scores; an empty table gives an empty result; extra columns travel along unread.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm.common import arrow_columns, staged, stretches

SAMPLE, SAMPLE_CHARS, STRETCH = 1500, 20_000, 2_000
HELD = 0.3  # share of the sample that the embeddings do not learn from, for the calibration
BUCKETS, DIM, WINDOW, NGRAMS = 1 << 17, 8, 5, (3, 4, 5)
ROUND_WINDOWS = 200_000  # a small sample is gone through until a round has seen so many windows (30 times at most)
SCORE = T.StructType([T.StructField("score", T.DoubleType())])
LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


def subwords(word: str) -> list[int]:
    raw = f"<{word}>".encode("utf-8", "surrogatepass")  # n-grams of bytes: one pass, any script
    crc, mask = zlib.crc32, BUCKETS - 1
    return [crc(raw) & mask] + [crc(raw[i:i + n]) & mask for n in NGRAMS for i in range(len(raw) - n + 1)]


def window_starts(n_words: int, window: int = WINDOW) -> list[int]:
    """Starts of about equally long windows of at most ``window`` words."""
    parts = max(1, -(-n_words // window))
    return [i * n_words // parts for i in range(parts)]


class SubwordSoftmax:
    """Two classes; only the difference of their softmax rows matters, so one weight row."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.vectors = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
        self.weight, self.bias = rng.normal(0, 0.1, DIM), 0.0
        self.speed_v, self.speed_w = np.full((BUCKETS, DIM), 1e-9, np.float32), np.full(DIM + 1, 1e-6)

    def epoch(self, bags: Bags, windows: np.ndarray, labels: np.ndarray, rng, batch: int = 512, rate: float = 0.05):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), batch):
            pick = order[at:at + batch]
            words, owner, share = bags.words_in(windows[pick])
            names, back = np.unique(words, return_inverse=True)
            flat, starts, sizes = bags.subwords_in(names)
            vec = np.add.reduceat(self.vectors[flat], starts, axis=0) / sizes[:, None]
            mean = np.zeros((len(pick), DIM))
            for d in range(DIM):
                mean[:, d] = np.bincount(owner, vec[back, d] * share, len(pick))
            p = 1 / (1 + np.exp(-np.clip(mean @ self.weight + self.bias, -30, 30)))
            gap = (p - labels[pick]) / len(pick)
            g_word = np.bincount(back, gap[owner] * share, len(names)) / sizes  # times weight: per word vector
            per_row = np.bincount(flat, np.repeat(g_word, sizes), BUCKETS)
            rows = np.flatnonzero(per_row)
            grad = per_row[rows, None] * self.weight
            g_w = np.concatenate([gap @ mean, [gap.sum()]])
            self.speed_v[rows] += grad**2
            self.vectors[rows] -= (rate * grad / np.sqrt(self.speed_v[rows])).astype(np.float32)
            self.speed_w += g_w**2
            step = rate * g_w / np.sqrt(self.speed_w)
            self.weight -= step[:DIM]
            self.bias -= step[DIM]

    def per_subword(self) -> np.ndarray:
        return (self.vectors @ self.weight).astype(np.float32)


class Bags:
    """Words of sample documents as ids, windows as (first, last) ranges of one long id array."""

    def __init__(self, docs: list[list[str]]):
        index: dict[str, int] = {}
        self.ids = np.array([index.setdefault(w, len(index)) for ws in docs for w in ws], np.int64)
        lists = [subwords(w) for w in index]
        self.sizes = np.array([len(x) for x in lists])
        self.flat = np.array([g for x in lists for g in x], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        ranges, owner, at = [], [], 0
        for d, ws in enumerate(docs):
            cut = [*window_starts(len(ws)), len(ws)]
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                if b > a:
                    ranges.append((at + a, at + b))
                    owner.append(d)
            at += len(ws)
        self.windows, self.owner = np.array(ranges).reshape(-1, 2), np.array(owner, int)

    def words_in(self, windows: np.ndarray):
        sizes = windows[:, 1] - windows[:, 0]
        owner = np.repeat(np.arange(len(windows)), sizes)
        inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return self.ids[np.repeat(windows[:, 0], sizes) + inside], owner, 1 / sizes[owner]

    def subwords_in(self, names: np.ndarray):
        sizes = self.sizes[names]
        starts = np.cumsum(sizes) - sizes
        inside = np.arange(sizes.sum()) - np.repeat(starts, sizes)
        return self.flat[np.repeat(self.starts[names], sizes) + inside], starts, sizes

    def scores(self, model: SubwordSoftmax) -> np.ndarray:
        word = np.add.reduceat(model.per_subword()[self.flat], self.starts) / self.sizes
        total = np.concatenate([[0], np.cumsum(word[self.ids], dtype=np.float64)])
        a, b = self.windows.T
        return (total[b] - total[a]) / (b - a) + model.bias


def train(docs: list[list[str]], toxic: np.ndarray, rng) -> dict:
    """The embeddings' scorer, not calibrated, learned from documents (their words) with labels 0/1, both present."""
    bags, model = Bags(docs), SubwordSoftmax()
    label = toxic[bags.owner]
    windows = np.arange(len(bags.windows))
    for round_ in range(4):
        if round_:
            z = bags.scores(model)
            bar = np.quantile(z[label == 0], 0.998)
            best = np.full(len(docs), -np.inf)
            np.maximum.at(best, bags.owner, z)
            windows = np.flatnonzero((label == 0) | (z >= np.minimum(bar, best[bags.owner])))
        for _ in range(min(30, max(2, -(-ROUND_WINDOWS // len(windows))))):
            model.epoch(bags, bags.windows[windows], label[windows], rng)
    return {"subword": model.per_subword(), "bias": float(model.bias)}


def split(toxic: np.ndarray, held: np.ndarray) -> np.ndarray:
    """``held``, or nothing where either part would lack a class: then the calibration takes what was trained on."""
    few = min(np.bincount(toxic[held], minlength=2)) == 0 or min(np.bincount(toxic[~held], minlength=2)) == 0
    return np.zeros_like(held) if few else held


def fit(texts: list[str], toxic: np.ndarray, share: float, seed: int = 5) -> dict:
    """The scorer learned from texts with labels 0/1; ``share`` is the true share of toxic ones."""
    docs = [words_of(t) for t in texts]
    keep = [i for i, ws in enumerate(docs) if ws]
    docs, texts, toxic = [docs[i] for i in keep], [texts[i] for i in keep], np.asarray(toxic, int)[keep]
    if not len(toxic) or toxic.min() == toxic.max():
        return {"flat": float(share)}
    rng = np.random.default_rng(seed)
    held = split(toxic, rng.random(len(docs)) < HELD)
    model = train([d for d, h in zip(docs, held, strict=True) if not h], toxic[~held], rng)
    rows = np.flatnonzero(held if held.any() else ~held)
    best = scorer(model, calibrated=False)([texts[i] for i in rows])["score"]
    a, c = calibrate(best, toxic[rows], share)
    return {**model, "a": a, "c": c}


def calibrate(z: np.ndarray, y: np.ndarray, share: float, steps: int = 200) -> tuple[float, float]:
    """Logistic fit of labels on scores by Newton steps, classes weighted to their true shares."""
    middle, spread = z.mean(), z.std() + 1e-9
    x = np.stack([(z - middle) / spread, np.ones_like(z)], 1)
    have = y.mean()
    w = np.where(y == 1, share / have, (1 - share) / (1 - have))
    theta = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        grad = x.T @ (w * (p - y)) / len(y) + 1e-4 * theta
        hess = (x * (w * p * (1 - p))[:, None]).T @ x / len(y) + 1e-4 * np.eye(2)
        theta -= np.clip(np.linalg.solve(hess, grad), -1, 1)
    return float(theta[0] / spread), float(theta[1] - theta[0] * middle / spread)


def scorer(model: dict, keep_words: int = 150_000, calibrated: bool = True):
    """texts -> score: the calibrated probability of the most toxic window, or its plain score."""
    known: dict[str, int] = {}
    table = [np.zeros(0, np.float32)]

    def score(texts: list) -> dict:
        if "flat" in model:
            return {"score": np.full(len(texts), model["flat"])}
        if len(known) > keep_words:
            known.clear()
            table[0] = table[0][:0]
        new: list[str] = []
        ids, cuts, heads, at = [], [], [], 0
        for t in texts:
            ws = words_of(t)
            for w in ws:
                i = known.get(w)
                if i is None:
                    i = known[w] = len(known)
                    new.append(w)
                ids.append(i)
            heads.append(len(cuts))
            if ws:
                cuts += [at + s for s in window_starts(len(ws))]
                at += len(ws)
        if new:
            lists = [subwords(w) for w in new]
            sizes = np.array([len(x) for x in lists])
            flat = np.fromiter((g for x in lists for g in x), np.int64, int(sizes.sum()))
            table[0] = np.concatenate([table[0], np.add.reduceat(model["subword"][flat], np.cumsum(sizes) - sizes) / sizes])
        best = np.zeros(len(texts))
        if ids:
            word = table[0][np.array(ids)].astype(np.float64)
            cuts_ = np.array(cuts)
            mean = np.add.reduceat(word, cuts_) / np.diff(np.append(cuts_, at))
            ends = np.append(heads[1:], len(cuts))
            full = np.flatnonzero(ends > np.array(heads))
            best[full] = np.maximum.reduceat(mean, np.array(heads)[full])
        if not calibrated:
            return {"score": best + model["bias"]}
        x = model["a"] * (best + model["bias"]) + model["c"]
        return {"score": 1 / (1 + np.exp(-np.clip(x, -500, 500)))}

    return score


def sample(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE) -> tuple[DataFrame, float]:
    """(h, toxic, text) of at most ``per_label`` labelled documents of each label, those with the least hash
    of the id, and the share of toxic labels. Written; the picked ids are few by construction, so they
    are broadcast."""
    known = (labels.filter("toxic in (0, 1) and doc_id is not null").groupBy("doc_id")
             .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("also")).filter("toxic = also")
             .select("doc_id", "toxic", F.xxhash64("doc_id").alias("h")))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    found = docs.filter("text is not null").select("doc_id", "text")
    here = known.join(found.select("doc_id"), "doc_id", "left_semi")     # labels without a document take no place
    each = [here.filter(F.col("toxic") == k).orderBy("h", "doc_id").limit(per_label) for k in (0, 1)]
    picked = staged(each[0].unionByName(each[1]).withColumnRenamed("doc_id", "l_id"), "toxicity-picked")
    one = (found.join(F.broadcast(picked), F.col("doc_id") == F.col("l_id")).groupBy("h", "toxic")
           .agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")))
    return staged(one, "toxicity-sample"), counts.get(1, 0) / max(1, sum(counts.values()))


def learn(docs: DataFrame, labels: DataFrame) -> dict:
    """The calibrated scorer of ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic) cover."""
    picked, share = sample(docs, labels)
    rows = sorted(picked.select("h", "toxic", stretches(F.col("text"), F.col("h"), SAMPLE_CHARS, STRETCH).alias("part")).collect())  # 2 SAMPLE rows
    words = [(h, k, ws) for h, k, part in rows if (ws := words_of(part))]
    toxic = np.array([k for _, k, _ in words], int)
    if not len(toxic) or toxic.min() == toxic.max():
        return {"flat": float(share)}
    held = split(toxic, np.array([h % 100 < 100 * HELD for h, _, _ in words]))
    model = train([ws for (_, _, ws), out in zip(words, held, strict=True) if not out], toxic[~held], np.random.default_rng(5))
    wanted = {h for (h, _, _), out in zip(words, held, strict=True) if out or not held.any()}
    shared = docs.sparkSession.sparkContext.broadcast(model)
    whole = arrow_columns(picked, "text", SCORE, lambda: scorer(shared.value, calibrated=False))
    best = sorted(r for r in whole.select("row.h", "row.toxic", "score").collect() if r["h"] in wanted)
    a, c = calibrate(np.array([r["score"] for r in best]), np.array([r["toxic"] for r in best]), share)
    return {**model, "a": a, "c": c}


def judge(docs: DataFrame, labelled: DataFrame, labels: DataFrame) -> DataFrame:
    """``row`` and ``score`` of every document; learned from ``labelled`` (doc_id, text) and ``labels``."""
    model = learn(labelled, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS floats
    return arrow_columns(docs, "text", SCORE, lambda: scorer(shared.value))
