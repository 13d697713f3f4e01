"""Language identification: a linear-chain conditional random field over words.

Every word gets a label; labels interact through learned transitions, so a word that fits
several languages takes that of its neighbours, and code-switched text gets one label per
stretch. Features of a word: prefixes (1-3 letters), suffixes (1-4), inner n-grams (2, 3),
all hashed, and its entry in a lexicon of each language's frequent words. Marginals come
from forward-backward over the whole text.

Training (driver, numpy, Adagrad on the exact likelihood gradient): a sample bounded by
``SAMPLE_DOCS`` distinct labelled texts per language (fewer if there are many languages, but
``LEAST_DOCS`` at least; no language is left out) and ``SAMPLE_WORDS`` words of each, from stretches
that a hash picks in the whole text; the labels of documents are the words' labels. Sequences are stitched from pieces of several
documents, so transitions between languages are seen. The model is some MB, whatever the corpus.

A document's label is the one with the largest mean marginal over its words, its score
that mean. Words are runs of letters (Unicode categories L), lower-cased.

Defined cases: a null text or one without a letter gets ``und`` and score 0; if no labelled
row exists every text gets ``und``; of labels with equal mass the first in order counts;
repeated rows are labelled each; texts of any length are read whole; an empty table gives an
empty result; extra columns travel along and are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm.common import arrow_columns, staged, stretches, time_major, word_groups

UNDETERMINED = "und"
SAMPLE_DOCS, SAMPLE_WORDS, SAMPLE_ALL, LEAST_DOCS = 250, 240, 8000, 20
STRETCH = 480  # characters of a stretch of a long training text
BUCKETS, LEXICON = 1 << 17, 1000
STEP_WORDS = 1_500_000  # words in one forward-backward pass
LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    words = LETTERS.findall(text.lower()) if text else []
    if all(map(str.isalpha, words)):
        return words
    # \w also takes numerals such as a half or a Roman three, which are no letters
    return [w for x in words for w in "".join(c if c.isalpha() else " " for c in x).split()]


def grams(word: str) -> list[int]:
    n = len(word)
    parts = [f"^{word[:k]}" for k in (1, 2, 3) if k <= n] + [f"{word[-k:]}$" for k in (1, 2, 3, 4) if k <= n]
    parts += [word[i:i + k] for k in (2, 3) for i in range(n - k + 1)]
    return [zlib.crc32(p.encode("utf-8", "surrogatepass")) % BUCKETS for p in parts]


class Crf:
    def __init__(self, labels: list[str], lexicon: dict[str, int]):
        self.labels, self.lexicon = labels, lexicon
        self.weights = np.zeros((BUCKETS + len(lexicon), len(labels)), np.float32)
        self.moves = np.zeros((len(labels), len(labels)))

    def features(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat feature ids of the words and where each word begins."""
        lists = [grams(w) + ([BUCKETS + self.lexicon[w]] if w in self.lexicon else []) for w in words]
        return (np.fromiter((f for x in lists for f in x), np.int64),
                np.cumsum([0, *map(len, lists)])[:-1].astype(np.int64))

    def emissions(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros((0, len(self.labels)), np.float32)
        flat, starts = self.features(words)
        return np.add.reduceat(self.weights[flat], starts, axis=0)

    def fit(self, sequences: list[tuple[list[str], np.ndarray]], epochs: int = 4, batch: int = 128, rate: float = 0.3):
        """``sequences``: equally long word lists with label ids."""
        k, speed = len(self.labels), np.full(self.weights.shape, 1e-2)
        move_speed, rng = np.full((k, k), 1e-2), np.random.default_rng(7)
        for _ in range(epochs):
            order = rng.permutation(len(sequences))
            for at in range(0, len(order), batch):
                part = [sequences[i] for i in order[at:at + batch]]
                names = sorted({w for ws, _ in part for w in ws})
                index = {w: i for i, w in enumerate(names)}
                ids = np.array([[index[w] for w in ws] for ws, _ in part])
                gold = np.array([y for _, y in part])
                flat, starts = self.features(names)
                u = np.add.reduceat(self.weights[flat], starts, axis=0).astype(np.float64)[ids]
                node, edge = self.posterior(u)
                want = np.eye(k)[gold]
                gap = (want - node).reshape(-1, k)
                per_word = np.stack([np.bincount(ids.ravel(), gap[:, j], len(names)) for j in range(k)], 1)
                sizes = np.diff([*starts, len(flat)])
                grad = np.stack([np.bincount(flat, np.repeat(per_word[:, j], sizes), len(self.weights))
                                 for j in range(k)], 1) / len(part)
                moved = np.zeros((k, k))
                np.add.at(moved, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1)
                move = (moved - edge) / len(part)
                speed += grad**2
                move_speed += move**2
                self.weights += (rate * grad / np.sqrt(speed)).astype(np.float32)
                self.moves += rate * move / np.sqrt(move_speed)

    def posterior(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Label marginals (s, t, k) and expected transition counts (k, k) of equally long sequences."""
        e, m = np.exp(u - u.max(axis=2, keepdims=True)), np.exp(self.moves)
        s, steps, k = e.shape
        fore, back, scale = np.empty_like(e), np.ones_like(e), np.empty((s, steps, 1))
        for t in range(steps):
            fore[:, t] = e[:, t] * (fore[:, t - 1] @ m if t else 1 / k)
            scale[:, t] = fore[:, t].sum(axis=1, keepdims=True)
            fore[:, t] /= scale[:, t]
        for t in range(steps - 2, -1, -1):
            back[:, t] = (e[:, t + 1] * back[:, t + 1]) @ m.T / scale[:, t + 1]
        node = fore * back
        edge = np.einsum("sti,stj->ij", fore[:, :-1], e[:, 1:] * back[:, 1:] / scale[:, 1:]) * m
        return node / node.sum(axis=2, keepdims=True), edge

    def mean_marginals(self, ids: list[np.ndarray], emission: np.ndarray, path: bool = False):
        """Mean label marginals of sequences of word ids (all longer than 0); with ``path``
        also each word's most likely label. Vectorised over sequences, step by step."""
        m = np.exp(self.moves).astype(np.float32)
        local = np.exp(emission - emission.max(axis=1, keepdims=True)).astype(np.float32)
        lengths = np.array([len(x) for x in ids])
        out, labels = np.zeros((len(ids), len(self.labels))), [None] * len(ids)
        for group in word_groups(lengths, STEP_WORDS):
            order, active, offset = time_major(lengths[group])
            packed = np.empty(offset[-1], np.int64)
            for d, i in enumerate(order):
                n = lengths[group[i]]
                packed[offset[:n] + d] = ids[group[i]]
            e = local[packed]
            fore, a = np.empty_like(e), None
            for t, n in enumerate(active.tolist()):
                a = e[offset[t]:offset[t + 1]] * (1 if a is None else a[:n] @ m)
                a /= a.sum(axis=1, keepdims=True)
                fore[offset[t]:offset[t + 1]] = a
            b, total = np.ones((len(group), len(self.labels)), np.float32), np.zeros((len(group), len(self.labels)))
            for t in range(len(active) - 1, -1, -1):
                n, cut = int(active[t]), slice(offset[t], offset[t + 1])
                node = fore[cut] * b[:n]
                node /= node.sum(axis=1, keepdims=True)
                total[:n] += node
                if path:
                    fore[cut] = node
                back = (e[cut] * b[:n]) @ m.T
                b[:n] = back / back.sum(axis=1, keepdims=True)
            out[group[order]] = total / lengths[group[order], None]
            if path:
                for d, i in enumerate(order):
                    n = lengths[group[i]]
                    labels[group[i]] = fore[offset[:n] + d].argmax(axis=1)
        return (out, labels) if path else out


def sample(docs: DataFrame, per_label: int = SAMPLE_DOCS, most_words: int = SAMPLE_WORDS) -> dict[str, list[list[str]]]:
    """Words of ``per_label`` distinct texts of each label, those with the least hash, ``most_words`` of each.
    What reaches the driver is bounded by labels * per_label short texts; copies of a text count once."""
    known = docs.filter("lang is not null and text is not null").select("lang", "text", F.xxhash64("text").alias("h"))
    labels = known.select("lang").distinct().count()
    if not labels:
        return {}
    per_label = min(per_label, max(LEAST_DOCS, SAMPLE_ALL // labels))
    least = Window.partitionBy("lang").orderBy("h")
    picked = (known.select("lang", "h").distinct().withColumn("k", F.row_number().over(least))
              .filter(F.col("k") <= per_label).select(F.col("lang").alias("_lang"), F.col("h").alias("_h")))
    picked = staged(picked, "language-sample")  # labels * per_label rows
    # a word has 16 characters at most on average: enough for the sample's bound
    part = stretches(F.col("text"), F.col("h"), most_words * 16, STRETCH)
    rows = (known.join(picked, (F.col("lang") == F.col("_lang")) & (F.col("h") == F.col("_h")))
            .groupBy("lang", "h").agg(F.min(part).alias("t")).collect())
    out: dict[str, list[list[str]]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["h"])):
        if w := words_of(r["t"])[:most_words]:
            out.setdefault(r["lang"], []).append(w)
    return out


def train(samples: dict[str, list[list[str]]], length: int = 48, seed: int = 3) -> Crf | None:
    if not samples:
        return None
    labels = sorted(samples)
    lexicon: dict[str, int] = {}
    for k in labels:
        for w, n in Counter(w for ws in samples[k] for w in ws).most_common(LEXICON):
            if n > 1:
                lexicon.setdefault(w, len(lexicon))
    model, rng = Crf(labels, lexicon), np.random.default_rng(seed)
    pieces = []
    for y, k in enumerate(labels):
        for ws in samples[k]:
            at = 0
            while at < len(ws):
                n = int(rng.integers(4, 40))
                pieces.append((ws[at:at + n], y))
                at += n
    # half of the pieces stay in runs of one language, half are shuffled
    tail = rng.permutation(len(pieces))[: len(pieces) // 2]
    chosen = set(tail.tolist())
    line = [p for i, p in enumerate(pieces) if i not in chosen] + [pieces[i] for i in tail]
    words = [w for ws, _ in line for w in ws]
    gold = np.array([y for ws, y in line for _ in ws])
    length = min(length, len(words))
    cut = range(0, len(words) - length + 1, length)
    model.fit([(words[i:i + length], gold[i:i + length]) for i in cut])
    return model


def predictor(model: Crf | None, keep_words: int = 150_000):
    """texts -> lang_pred and score; emissions of words seen in earlier batches are kept up to a bound."""
    known: dict[str, int] = {}
    table = [np.zeros((0, len(model.labels) if model else 1), np.float32)]

    def predict(texts: list) -> dict:
        lang, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        if len(known) > keep_words:
            known.clear()
            table[0] = table[0][:0]
        new, ids, full = [], [], []
        for i, text in enumerate(texts if model else ()):
            row = []
            for w in words_of(text):
                at = known.get(w)
                if at is None:
                    at = known[w] = len(known)
                    new.append(w)
                row.append(at)
            if row:
                ids.append(np.array(row, np.int32))
                full.append(i)
        if not full:
            return {"lang_pred": lang, "score": score}
        table[0] = np.concatenate([table[0], model.emissions(new)])
        mean = model.mean_marginals(ids, table[0])
        best = mean.argmax(axis=1)
        score[full] = np.clip(mean.max(axis=1), 0.0, 1.0)
        for i, b in zip(full, best.tolist(), strict=True):
            lang[i] = model.labels[b]
        return {"lang_pred": lang, "score": score}

    return predict


def identified(docs: DataFrame, model: Crf | None) -> DataFrame:
    """``row``, ``lang_pred``, ``score`` for every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some MB: BUCKETS * labels floats and the lexicon
    new = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return arrow_columns(docs, "text", new, lambda: predictor(shared.value))


def identify(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """``row``, ``lang_pred``, ``score`` for every document; ``labelled`` has text and lang."""
    return identified(docs, train(sample(labelled)))


def determined(docs: DataFrame) -> DataFrame:
    """The documents (text, lang, …) in which some language is found, learned from their own labels: code-switched
    texts stay however evenly their languages share them. Without any label, all texts with a letter stay."""
    model = train(sample(docs))
    if model is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    return identified(docs, model).filter(F.col("lang_pred") != UNDETERMINED).select("row.*")


def label_words(texts: list[str], model: Crf) -> list[list[tuple[str, str]]]:
    """(word, label) of every word: the segmentation of code-switched text."""
    split = [words_of(t) for t in texts]
    names = sorted({w for ws in split for w in ws})
    index = {w: i for i, w in enumerate(names)}
    full = [ws for ws in split if ws]
    got = iter(model.mean_marginals([np.array([index[w] for w in ws]) for ws in full], model.emissions(names), path=True)[1]
               if full else [])
    return [[(w, model.labels[b]) for w, b in zip(ws, next(got), strict=True)] if ws else [] for ws in split]
