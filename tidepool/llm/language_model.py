"""LM scoring: a gated recurrent language model with a class-factored output softmax.

Tokens are words (split at ASCII white space, A-Z lowered) and one end token per document.

P(token | history) = P(class | state) * P(token | class, state). The most frequent
``HEAD`` words sit in classes of ``PER_CLASS`` with a learned softmax inside. One more class is
for all other words: its members are ``TAIL`` groups of words by their last two bytes, and inside
a group a word has its share of the corpus counts (with half a count added, one unseen word
included). The state is a
GRU's; it starts at zero and is carried across windows, so a text's log-likelihood is that
of the complete document.

What comes from the corpus: counts of every token of all training documents (one shuffle of
pre-aggregated counts), the tail classes' masses, and the count of each rare token looked up
by a join on the token. The recurrent weights are fitted on all training documents too, of any
length: each partition (of about ``TASK_TOKENS``) runs truncated backpropagation over windows of
``BPTT`` steps from shared weights, in numpy, and the partitions' weights are averaged by a tree of
tasks. Each of ``ROUNDS`` rounds takes another share of the documents, by a hash of the text, so
every corpus is passed once. A task's share of tokens decides how many streams it reads side by
side, up to ``STREAMS``. The start already equals the smoothed unigram model.

Sizes: the driver and the tasks hold the ``KNOWN`` most frequent words (a bound on rows,
ensured by a count histogram), never the vocabulary. A task holds the words and ids of
``HELD_BYTES`` of text at a time (a longer text alone); equal texts among them are scored once.
Texts are split, and words looked up and counted, as Arrow arrays.

Defined cases: a null or empty text is just its end token; without training documents every
token has probability 1 in the base score (V and N are 0) and the model keeps its start;
repeated rows are scored each; an empty table gives an empty result; other columns unread.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from copy import copy

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import slices, staged, time_major, word_groups

HEAD, PER_CLASS, TAIL, KNOWN = 2048, 64, 64, 1 << 17  # TAIL is PER_CLASS at most
STATE, BPTT, STREAMS, LEAST_STREAMS, UPDATES = 24, 16, 256, 8, 128
ROUNDS, TASK_TOKENS, LONGEST, FAN = 2, 2_000_000, 16, 8
RATE = 3e-3  # of updates over 64 streams, in proportion for more
END = b""
HALVED = np.array([0.5, 0.5, 1])[:, None, None]  # update, reset, candidate
GROUP_TOKENS, CHUNK_TOKENS = 1_500_000, 8192
UPDATED = 1 << 16  # weights updated at once
HELD_BYTES, HELD_COUNTS = 16 << 20, 400_000


def tokens(text: str | None) -> list[bytes]:
    """Words, without the end token."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``tokens`` of all texts, one after the other, and the number of each text's."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, bounds = lists.flatten().cast(pa.binary()), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    real = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0  # white space at an end leaves an empty word
    return words.filter(pa.array(real)), np.diff(np.concatenate([[0], np.cumsum(real)])[bounds])


def tail_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % TAIL


class Index(dict):
    """Word -> its place in a list; any other word falls behind the list's end, by its tail class."""

    def __init__(self, words: Iterable[bytes]):
        super().__init__((w, i) for i, w in enumerate(words))

    def __missing__(self, word: bytes) -> int:
        return len(self) + tail_class(word)

    def places(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))

    def places_of(self, words: pa.Array) -> np.ndarray:
        """``places`` of an Arrow array; of the words outside the list, each different end is looked at once."""
        found = pc.index_in(words, value_set=pa.array(list(self), pa.binary()))
        at = pc.fill_null(found, -1).to_numpy().copy()
        other = np.flatnonzero(at < 0)
        ends = pc.binary_slice(words.filter(pc.is_null(found)), -2).dictionary_encode()
        groups = np.array([tail_class(w) for w in ends.dictionary.to_pylist()], np.int32)
        at[other] = len(self) + groups[ends.indices.to_numpy()]
        return at


def count_tokens(train: DataFrame) -> DataFrame:
    """(token binary, c): occurrences over all training documents, the end token included. A task sends
    what it has counted whenever it holds ``HELD_COUNTS`` tokens, and at its end."""
    def sent(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = pa.Table.from_batches(held).group_by("token", use_threads=False).aggregate([("c", "sum")])
        yield from counts.rename_columns(["token", "c"]).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for part in slices(batch.column(0), 0):
                values, n = split(part.field(0))[0].value_counts().flatten()
                held += [pa.RecordBatch.from_arrays([v, c], ["token", "c"]) for v, c in (
                    (values, n), (pa.array([END], pa.binary()), pa.array([len(part)], pa.int64())))]
                if sum(map(len, held)) >= HELD_COUNTS:
                    yield from sent(held)
                    held.clear()
        if held:
            yield from sent(held)

    return (train.select(F.struct("text").alias("row")).mapInArrow(run, "token binary, c long")
            .groupBy("token").agg(F.sum("c").alias("c")))


def most_frequent(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """At most ``most`` of the most frequent tokens: all those at or above a count that a histogram
    of counts (logarithmic bins, some hundreds of rows) shows to be selective enough."""
    step = F.floor(F.log2("c") * 16)
    bins = sorted(((r["b"], r["n"], r["least"]) for r in counts.groupBy(step.alias("b")).agg(
        F.count(F.lit(1)).alias("n"), F.min("c").alias("least")).collect()), reverse=True)
    bar, total = None, 0
    for _, n, least in bins:
        total += n
        if total > most:
            break
        bar = least
    if bar is None:
        return []
    rows = counts.filter(F.col("c") >= bar).collect()
    return sorted(((bytes(r["token"]), r["c"]) for r in rows), key=lambda r: (-r[1], r[0]))


class Gru:
    """Recurrent weights and the class-factored output."""

    def __init__(self, head: list[tuple[bytes, int]], tail_mass: np.ndarray, seed: int = 17):
        rng, k = np.random.default_rng(seed), STATE
        self.n_head = len(head)
        self.ids = Index(w for w, _ in head)
        self.n_classes = -(-self.n_head // PER_CLASS) + 1  # the last one is the tail's
        inputs, classes = self.n_head + TAIL, self.n_classes
        small = lambda *s: rng.normal(0, 0.1, s).astype(np.float32)
        mass = np.zeros((self.n_classes, PER_CLASS)) + 1e-30
        mass.ravel()[: self.n_head] = [c + 0.5 for _, c in head]
        mass[-1, :TAIL] = tail_mass
        whole = mass.sum(axis=1)
        self.log_tail = np.log(tail_mass)
        self.p = {
            "x": small(inputs, 3 * k), "h": small(k, 3 * k) / np.float32(k**0.5),
            "c": small(k, classes) * np.float32(0.1), "cb": np.log(whole / whole.sum()).astype(np.float32),
            "w": small(self.n_classes, k, PER_CLASS) * np.float32(0.1),
            "wb": np.log(mass / mass.sum(axis=1, keepdims=True)).astype(np.float32)}

    def copy(self) -> Gru:
        """With weights of its own, to be trained; a broadcast value may be shared by tasks."""
        out = copy(self)
        out.p = {n: v.copy() for n, v in self.p.items()}
        return out

    def encode(self, words: list[bytes]) -> np.ndarray:
        """Ids: head words 0.., others n_head + tail class."""
        return self.ids.places(words)

    def encode_all(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text's words."""
        words, sizes = split(texts)
        return np.split(self.ids.places_of(words), np.cumsum(sizes)[:-1])

    def gates(self) -> tuple[np.ndarray, np.ndarray]:
        """Input and recurrent weights with the gates (update, reset, candidate) as first axis, so that
        every array of a step lies in one piece; halved for update and reset, as ``advance`` takes them."""
        return tuple(np.ascontiguousarray(self.p[n].reshape(-1, 3, STATE).transpose(1, 0, 2) * HALVED.astype(
            self.p[n].dtype)) for n in ("x", "h"))

    @staticmethod
    def advance(x: np.ndarray, h: np.ndarray, recurrent: np.ndarray, a: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The next state from inputs ``x`` (3, rows, k), a sigmoid of v being 0.5 + 0.5 tanh(v / 2). Leaves update, reset and the recurrent part in ``a``
        (as ``x``), the candidate in ``n``."""
        np.matmul(h, recurrent, out=a)
        zr = a[:2]
        zr += x[:2]
        np.tanh(zr, out=zr)
        zr *= 0.5
        zr += 0.5
        np.multiply(a[1], a[2], out=n)
        n += x[2]
        np.tanh(n, out=n)
        out = h - n
        out *= a[0]
        out += n
        return out

    def step(self, x: np.ndarray, h: np.ndarray):
        """One step from summed inputs ``x`` (rows, 3k): (new state, update, reset, candidate, recurrent part)."""
        a, n = np.empty((3, *h.shape), h.dtype), np.empty_like(h)
        new = self.advance(x.reshape(len(x), 3, STATE).transpose(1, 0, 2) * HALVED.astype(x.dtype), h, self.gates()[1].astype(h.dtype), a, n)
        return new, a[0], a[1], n, a[2]

    def slots(self, target: np.ndarray) -> np.ndarray:
        """Place in the classes, one after the other."""
        return np.where(target < self.n_head, target, target - self.n_head + (self.n_classes - 1) * PER_CLASS)

    @staticmethod
    def softmax(logit: np.ndarray, own: np.ndarray, bounded: bool, learn: bool):
        """Log-probability of each row's ``own`` column; with ``learn`` also the gradient of minus it by the
        logits. Works in place. Rows that are ``bounded`` need no maximum taken off."""
        rows = np.arange(len(own))
        if not bounded:
            logit -= logit.max(axis=1, keepdims=True)
        mine = logit[rows, own]
        e = np.exp(logit, out=logit)
        total = e @ np.ones(e.shape[1], e.dtype)
        if learn:
            e *= (1 / total)[:, None]
            e[rows, own] -= 1
        return mine - np.log(total), e

    def output(self, h: np.ndarray, target: np.ndarray, learn: bool = False):
        """Log-probability of each target given states; with ``learn`` also gradients of minus their sum."""
        p, slot = self.p, self.slots(target)
        order = np.argsort((slot // PER_CLASS).astype(np.int16), kind="stable")
        target, slot = target[order], slot[order]  # rows of a class lie together, the tail's last
        states = np.ones((len(h), STATE + 1), h.dtype)  # the last column meets the biases
        states[:, :-1] = h.take(order, axis=0)
        cls, inside = np.divmod(slot, PER_CLASS)
        reach = np.abs(h).max(initial=0)
        near = lambda w, b, axis: (reach * np.abs(w).sum(axis=axis) + np.abs(b)).max(axis=-1) < 80
        got, d = self.softmax(states @ np.concatenate([p["c"], p["cb"][None]]), cls, bool(near(p["c"], p["cb"], 0)), learn)
        words, logit = np.concatenate([p["w"], p["wb"][:, None]], axis=1), np.empty((len(h), PER_CLASS), h.dtype)
        cut, bounded = np.searchsorted(cls, np.arange(self.n_classes + 1)).tolist(), near(p["w"], p["wb"], 1)
        spans = [(c, slice(cut[c], cut[c + 1])) for c in range(self.n_classes) if cut[c] < cut[c + 1]]
        for c, at in spans:
            np.matmul(states[at], words[c], out=logit[at])
            if not bounded[c]:
                logit[at] -= logit[at].max(axis=1, keepdims=True)
        own, e = self.softmax(logit, inside, True, learn)
        out = got.astype(np.float64) + own
        out[cut[-2]:] -= self.log_tail[target[cut[-2]:] - self.n_head]
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        if not learn:
            return out[back]
        turned, grad, dh = np.ascontiguousarray(p["w"].transpose(0, 2, 1)), np.zeros_like(words), np.empty_like(h)
        for c, at in spans:
            np.matmul(states[at].T, e[at], out=grad[c])
            np.matmul(e[at], turned[c], out=dh[at])
        dh += d @ p["c"].T
        both = states.T @ d
        grad = {"c": both[:-1], "cb": both[-1], "w": grad[:, :-1], "wb": grad[:, -1]}
        return out[back], grad, dh.take(back, axis=0)

    def fit(self, docs: Iterable[np.ndarray], width: int = STREAMS) -> int:
        """Truncated backpropagation over every token: ``width`` parallel streams take the documents as
        they come, in windows of ``BPTT`` steps (more when few streams are left), with the state carried
        from window to window and set to zero where a document starts. Returns the number of tokens."""
        end, source, seen, t, rate = self.ids[END], iter(docs), 0, 0, RATE * max(1.0, width / 64)
        flat = np.concatenate([self.p[n].ravel() for n in sorted(self.p)])
        self.p = shaped(flat, self.p)
        g, free, first, second = (np.zeros_like(flat) for _ in range(4))
        cuts = [slice(i, i + UPDATED) for i in range(0, len(flat), UPDATED)]
        lanes = [np.empty(0, np.int32) for _ in range(width)]
        h, last = np.zeros((width, STATE), np.float32), np.full(width, end, np.int32)
        while True:
            steps = BPTT * max(1, min(LONGEST, width // max(1, len(lanes))))
            for i, lane in enumerate(lanes):
                parts, n = [lane], len(lane)
                while n < steps and (doc := next(source, None)) is not None:
                    parts += [doc, np.array([end], np.int32)]
                    n += len(doc) + 1
                if len(parts) > 1:
                    lanes[i] = np.concatenate(parts)
            alive = [i for i, lane in enumerate(lanes) if len(lane)]
            if not alive:
                return seen
            lanes, h, last = [lanes[i] for i in alive], h[alive], last[alive]
            steps = min(steps, max(len(lane) for lane in lanes))
            y, real = np.full((len(lanes), steps), end, np.int32), np.ones((len(lanes), steps), bool)
            for i, lane in enumerate(lanes):
                n = min(steps, len(lane))
                y[i, :n], lanes[i] = lane[:n], lane[n:]
                if n < steps:
                    real[i, n:] = False
            x = np.concatenate([last[:, None], y[:, :-1]], axis=1)
            last = y[:, -1]
            h, grad = self.window(x, y, h, end, None if real.all() else real)
            seen += int(real.sum())
            t += 1
            np.concatenate([grad[n].ravel() for n in sorted(grad)], out=g)
            clip, grow, down = (np.float32(v) for v in (
                min(1.0, 1.0 / (float(g @ g)**0.5 + 1e-9)), 1 / (1 - 0.99**t), rate / (1 - 0.9**t)))
            for part in cuts:  # what a block touches stays in a core's cache
                w, d, f, m, v = (values[part] for values in (flat, g, free, first, second))
                d *= clip
                m += np.multiply(np.subtract(d, m, out=f), np.float32(0.1), out=f)
                d *= d
                v += np.multiply(np.subtract(d, v, out=f), np.float32(0.01), out=f)
                np.sqrt(np.multiply(v, grow, out=f), out=f)
                f += np.float32(1e-6)
                np.divide(m, f, out=f)
                f *= down
                w -= f  # the weights are views of it

    def window(self, x: np.ndarray, y: np.ndarray, h: np.ndarray, end: int, real: np.ndarray | None = None):
        """State after the window and the mean gradient over it, or over its ``real`` targets."""
        k, (width, steps) = STATE, x.shape
        source, carry = x.T.ravel(), (x.T != end).astype(h.dtype)[:, :, None]  # a document starts after an end
        weights_in, recurrent = self.gates()
        inputs = weights_in.take(source, axis=1).reshape(3, steps, width, k)
        a, (start, n, states) = np.empty_like(inputs), np.empty((3, steps, width, k), h.dtype)
        for t in range(steps):
            np.multiply(h, carry[t], out=start[t])
            states[t] = h = self.advance(inputs[:, t], start[t], recurrent, a[:, t], n[t])
        states, (z, r, inner) = states.reshape(-1, k), a
        keep = slice(None) if real is None else np.flatnonzero(real.T.ravel())
        _, grad, kept = self.output(states[keep], y.T.ravel()[keep], learn=True)
        dh = np.zeros_like(states)
        dh[keep] = kept
        dh = dh.reshape(steps, width, k)
        # the derivatives that do not depend on later steps, for all steps at once
        through = np.stack([(start - n) * z * (1 - z), inner * r * (1 - r), (1 - z) * (1 - n * n)])
        dx, dn, back = np.empty_like(a), np.empty_like(n), np.zeros_like(h)
        turned = np.ascontiguousarray(recurrent.transpose(0, 2, 1)) / HALVED.astype(h.dtype)
        for t in range(steps - 1, -1, -1):
            d = back
            d += dh[t]
            np.multiply(d, through[0, t], out=dx[0, t])
            np.multiply(d, through[2, t], out=dx[2, t])
            np.multiply(dx[2, t], through[1, t], out=dx[1, t])
            np.multiply(dx[2, t], r[t], out=dn[t])
            back = dx[0, t] @ turned[0]
            back += dx[1, t] @ turned[1]
            back += dn[t] @ turned[2]
            d *= z[t]
            back += d
            back *= carry[t]
        before = start.reshape(-1, k).T
        grad["h"] = np.concatenate([before @ g.reshape(-1, k) for g in (dx[0], dx[1], dn)], axis=1)
        grad["x"] = np.zeros_like(self.p["x"])
        order = np.argsort(source.astype(np.int16) if len(grad["x"]) < 1 << 15 else source, kind="stable")
        some, cut = np.unique(source[order], return_index=True)
        for i in range(3):
            grad["x"][some, i * k:(i + 1) * k] = np.add.reduceat(dx[i].reshape(-1, k).take(order, axis=0), cut)
        total = y.size if real is None else int(real.sum())
        return h, {name: g / g.dtype.type(total) for name, g in grad.items()}

    def log_likelihood(self, docs: list[np.ndarray]) -> np.ndarray:
        """Natural log-probability of each document's ids and its end, the state carried all the way
        (tail tokens less their corpus share within the class). Steps run over all documents at once."""
        end, out, (weights_in, recurrent) = self.ids[END], np.zeros(len(docs)), self.gates()
        lengths = np.array([len(d) + 1 for d in docs])
        for group in word_groups(lengths, GROUP_TOKENS):
            order, active, offset = time_major(lengths[group])
            target = np.empty(offset[-1], np.int32)
            owner = np.empty(offset[-1], np.int32)
            for d, i in enumerate(order):
                n = lengths[group[i]]
                target[offset[:n] + d] = np.append(docs[group[i]], end)
                owner[offset[:n] + d] = group[i]
            h, source, held, since = np.zeros((len(group), STATE), np.float32), np.full(len(group), end), [], 0
            for t, n in enumerate(active.tolist()):
                h = self.advance(weights_in.take(source[:n], axis=1), h[:n], recurrent,
                                 np.empty((3, n, STATE), h.dtype), np.empty((n, STATE), h.dtype))
                held.append(h)
                source = target[offset[t]:offset[t + 1]]
                if offset[t + 1] - since >= CHUNK_TOKENS or t == len(active) - 1:
                    cut = slice(since, offset[t + 1])
                    out += np.bincount(owner[cut], self.output(np.concatenate(held), target[cut]), len(docs))
                    held, since = [], offset[t + 1]
        return out


def weights(p: dict[str, np.ndarray]) -> bytes:
    return b"".join(p[n].astype(np.float32).tobytes() for n in sorted(p))


def shaped(data: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Views of flat weights."""
    cut = np.cumsum([like[n].size for n in sorted(like)])[:-1]
    return {n: v.reshape(like[n].shape) for n, v in zip(sorted(like), np.split(data, cut), strict=True)}


def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's weights as one row, each counting by its tokens."""
    part, total, mean = 0, 0, None
    for batch in batches:
        for i, n, w in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
            w = np.frombuffer(w, np.float32).astype(np.float64)
            part, total = i, total + n
            mean = w if mean is None else mean + (w - mean) * (n / total)
    if mean is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([total], pa.int64()),
             pa.array([mean.astype(np.float32).tobytes()], pa.binary())], ["part", "n", "w"])


TRAINED = "part int, n long, w binary"


def fit_round(docs: DataFrame, model: Gru, turn: int, width: int) -> np.ndarray | None:
    """Each partition trains from the model's weights on its documents of this round; the mean of
    all results, weighted by tokens, by a tree of ``FAN`` rows a task. None without documents."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    mine = docs.filter(F.pmod(F.xxhash64("text"), F.lit(ROUNDS)) == turn).select(F.struct("text").alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value.copy()
        total = m.fit((ids for batch in batches for part in slices(batch.column(0), 0)
                       for ids in m.encode_all(part.field(0))), width)
        if total:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([total], pa.int64()),
                                              pa.array([weights(m.p)], pa.binary())], ["part", "n", "w"])

    rows, parts = mine.mapInArrow(run, TRAINED), max(2, docs.rdd.getNumPartitions())
    while parts > 1:
        parts = -(-parts // FAN)
        rows = (rows.withColumn("part", (F.col("part") % parts).cast("int")).repartition(parts, "part")
                .mapInArrow(average, TRAINED))
    got = rows.collect()  # one row at most
    shared.unpersist()
    return np.frombuffer(got[0]["w"], np.float32) if got else None


def fit(docs: DataFrame, model: Gru, n_tokens: int) -> None:
    """Train the model on all documents, in tasks, once, in ``ROUNDS`` rounds of a share each."""
    tasks = max(1, n_tokens // TASK_TOKENS)
    width = min(STREAMS, max(LEAST_STREAMS, n_tokens // (tasks * ROUNDS * BPTT * UPDATES)))
    docs = docs.select("text").coalesce(tasks)
    for turn in range(ROUNDS):
        got = fit_round(docs, model, turn, width)
        if got is not None:
            model.p = shaped(got, model.p)


def train(docs: DataFrame) -> tuple[DataFrame, dict]:
    """(counts of all training tokens, written; the model and what scoring needs of the corpus)."""
    counts = staged(count_tokens(docs.select("text")), "lm-counts")
    whole = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    known = most_frequent(counts, KNOWN)
    size = dict(known) | {END: r["c"] for r in counts.filter(F.length("token") == 0).collect()}  # one row at most
    head = sorted({w for w, _ in known[:HEAD]} | {END}, key=lambda w: (-size.get(w, 0), w))
    by_class = counts.groupBy((F.crc32(F.substring("token", -2, 2)) % TAIL).alias("k")).agg(
        F.sum(F.col("c") + F.lit(0.5)).alias("mass")).collect()
    mass = np.full(TAIL, 0.5)
    for r in by_class:
        mass[r["k"]] += r["mass"]
    for w in head:
        if w in size:
            mass[tail_class(w)] -= size[w] + 0.5
    model = Gru([(w, size.get(w, 0)) for w in head], np.maximum(mass, 0.5))
    fit(docs, model, int(whole[0]))
    return counts, {"model": model, "known": size, "n": int(whole[0]), "v": int(whole[1])}


def place_tables(model: Gru, known: dict[bytes, int]) -> tuple[Index, np.ndarray, np.ndarray, np.ndarray]:
    """An index of the known words, and by place: the model's id, log10(c + 0.5) and whether the word
    is known but outside the head. Places behind the known words are the tail classes, with log 0."""
    index = Index(known)
    tail = model.n_head + np.arange(TAIL)
    ids = np.concatenate([model.encode(list(known)), tail]).astype(np.int32)
    logs = np.concatenate([np.log10(np.array(list(known.values()), np.float64) + 0.5), np.zeros(TAIL)])
    return index, ids, logs, ids >= model.n_head


def score(docs: DataFrame, counts: DataFrame, learned: dict) -> DataFrame:
    """Per document: doc_id, n_tokens, n_known, base_score, score (both log10)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(learned)  # at most KNOWN words and the weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, known = shared.value["model"], shared.value["known"]
        index, ids_of, log_of, outside = place_tables(m, known)
        end = float(log_of[index[END]]) if END in index else float(np.log10(0.5))
        number = TaskContext.get().partitionId() << 33

        def looked_up(texts: pa.Array):
            """Of each text: the model's ids, tokens, known tokens, log10 of its counts and of its words'
            shares inside their tail class, and its unknown words; all arrays by word end here."""
            words, sizes = split(texts)
            n, owner, at = len(sizes), np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), index.places_of(words)
            logs, unknown = log_of[at], at >= len(index)
            base, rest = np.bincount(owner, logs, n) + end, np.bincount(owner, np.where(outside[at], logs, 0), n)
            n_known = sizes - np.bincount(owner[unknown], minlength=n) + (END in index)
            coded = words.filter(pa.array(unknown)).dictionary_encode()
            different = max(1, len(coded.dictionary))
            each, times = np.unique(owner[unknown].astype(np.int64) * different + coded.indices.to_numpy(), return_counts=True)
            rare = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(each, np.arange(n + 1) * different), pa.int32()), pa.StructArray.from_arrays(
                    [coded.dictionary.take(pa.array(each % different)), pa.array(times, pa.int64())], ["token", "n"]))
            return np.split(ids_of[at], np.cumsum(sizes)[:-1]), sizes + 1, n_known, base, rest, rare

        for batch in batches:
            for part in slices(batch.column(0), 1, HELD_BYTES):
                texts = pc.fill_null(part.field(1), "").dictionary_encode()
                which = texts.indices.to_numpy()
                ids, n_tokens, n_known, base, rest, rare = looked_up(texts.dictionary)
                gru = m.log_likelihood(ids) / np.log(10) + rest
                rid = np.arange(number, number + len(which))
                number += len(which)
                yield pa.RecordBatch.from_arrays(
                    [part.field(0), pa.array(rid), *(pa.array(np.array(c, t)[which]) for c, t in (
                        (n_tokens, np.int64), (n_known, np.int64), (base, np.float64), (gru, np.float64))),
                     rare.take(pa.array(which))],
                    ["doc_id", "rid", "n_tokens", "n_known", "base", "gru", "rare"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = staged(docs.select(F.struct("doc_id", "text").alias("row")).mapInArrow(
        run, f"doc_id {kind}, rid long, n_tokens long, n_known long, base double, gru double, "
             "rare array<struct<token:binary,n:long>>"), "lm-rows")
    found = (rows.select("rid", F.explode("rare").alias("r")).select("rid", "r.token", "r.n")
             .join(counts.withColumnRenamed("token", "token2"), F.col("token") == F.col("token2"), "left"))
    tail = found.groupBy("rid").agg(
        F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("tail_known"),
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.5))).alias("tail_log")).withColumnRenamed("rid", "rid2")
    n, v = learned["n"], learned["v"]
    lower = F.log10(F.lit(n + 0.5 * (v + 1)))
    zero = F.lit(0.0)
    return rows.join(tail, F.col("rid") == F.col("rid2"), "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("tail_log", zero) - F.col("n_tokens") * lower).alias("base_score"),
        (F.col("gru") + F.coalesce("tail_log", zero)).alias("score"))
