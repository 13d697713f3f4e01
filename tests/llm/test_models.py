"""The numpy models against enumeration, numeric gradients and small constructed data."""

import itertools
import random

import numpy as np
import pytest

from tidepool.llm import induced, language, language_model, mixing, nearest, simhash, toxicity


def test_random_field_equals_enumeration():
    model = language.Crf(["a", "b", "c"], {})
    rng = np.random.default_rng(0)
    model.moves = rng.normal(size=(3, 3))
    u = rng.normal(size=(1, 5, 3))
    paths = list(itertools.product(range(3), repeat=5))
    weight = np.array([np.exp(sum(u[0, t, y] for t, y in enumerate(p)) + sum(model.moves[a, b] for a, b in itertools.pairwise(p)))
                       for p in paths])
    want = np.array([[sum(w for w, p in zip(weight, paths, strict=True) if p[t] == y) for y in range(3)] for t in range(5)]) / weight.sum()
    node, edge = model.posterior(u)
    np.testing.assert_allclose(node[0], want, atol=1e-9)
    assert abs(edge.sum() - 4) < 1e-9
    ids = [np.arange(5), np.arange(2), np.arange(4)]  # ragged sequences in one pass
    got, labels = model.mean_marginals(ids, u[0], path=True)
    np.testing.assert_allclose(got[0], want.mean(axis=0), atol=1e-5)
    np.testing.assert_array_equal(labels[0], want.argmax(axis=1))
    for i in (1, 2):
        np.testing.assert_allclose(got[i], model.posterior(u[:, : len(ids[i])])[0][0].mean(axis=0), atol=1e-5)


def test_code_switched_words_get_their_own_labels():
    en = "the house and the garden with the river".split()
    de = "das haus und der garten mit dem fluss".split()
    rng = random.Random(1)
    samples = {"en": [[rng.choice(en) for _ in range(60)] for _ in range(40)],
               "de": [[rng.choice(de) for _ in range(60)] for _ in range(40)]}
    model = language.train(samples)
    text = "the garden and the river 12 das haus und der garten"
    tags = language.label_words([text, "", None], model)
    assert [y for _, y in tags[0]] == ["en"] * 5 + ["de"] * 5 and tags[1:] == [[], []]
    got = language.predictor(model)(["der fluss und das haus", None, "123 --", "the house"])
    assert got["lang_pred"] == ["de", "und", "und", "en"] and got["score"][1] == 0
    assert language.predictor(None)(["the house"])["lang_pred"] == ["und"]


def test_unseen_misspelling_scores_as_toxic():
    rng = random.Random(2)
    plain = [f"{a}{b}" for a in ("bar", "len", "mor", "tas", "vik") for b in ("an", "el", "ot", "un", "ia")]
    line = lambda extra: " ".join(rng.choice(plain) for _ in range(40)) + extra
    texts = [line("") for _ in range(150)] + [line(f" {w}") for w in ("scoundrel", "scoundrell", "skoundrel") * 50]
    model = toxicity.fit(texts, np.array([0] * 150 + [1] * 150), 0.5)
    score = toxicity.scorer(model)([line(""), line(" scoundrels"), line(" scooundrel"), "", None])["score"]
    assert score[0] < 0.5 < min(score[1:3]) and score[3] == score[4] < 0.5
    assert toxicity.fit(["a b"], np.array([1]), 0.25) == {"flat": 0.25}
    assert toxicity.fit([], np.zeros(0, int), 0.0) == {"flat": 0.0}


@pytest.fixture(scope="module")
def small_lm():
    counts = {b"a": 9, b"b": 5, b"c": 3, language_model.END: 4, b"rare": 1, b"tail": 2}
    head = [b"a", b"b", language_model.END, b"c"]
    mass = np.full(language_model.TAIL, 0.5)
    for w in (b"rare", b"tail"):
        mass[language_model.tail_class(w)] += counts[w] + 0.5
    return language_model.Gru([(w, counts[w]) for w in head], mass), counts, mass


def test_language_model_is_a_distribution(small_lm):
    model, counts, mass = small_lm
    h = np.random.default_rng(0).normal(size=(1, language_model.STATE)).astype(np.float32)
    head = sum(np.exp(model.output(h, np.array([i])))[0] for i in range(model.n_head))
    # a tail class: its seen words and one unseen
    tail = sum(np.exp(model.output(h, np.array([model.n_head + k])))[0] * mass[k] for k in range(language_model.TAIL))
    assert abs(head + tail - 1) < 1e-5


def test_language_model_gradient(small_lm):
    model = small_lm[0]
    x, y = np.array([[0, 1, 2, 0, 4]]), np.array([[1, 2, 0, 4, 3]])
    h = np.random.default_rng(1).normal(size=(1, language_model.STATE)).astype(np.float64)
    model.p = {n: v.astype(np.float64) for n, v in model.p.items()}

    def loss():
        total, state = 0.0, h
        for t in range(5):
            state = state * (x[:, t] != 2)[:, None]
            state = model.step(model.p["x"][x[:, t]], state)[0]
            total -= model.output(state, y[:, t]).sum()
        return total / 5

    grad = model.window(x, y, h, end=2)[1]
    rng = np.random.default_rng(3)
    for name, value in model.p.items():
        for _ in range(4):
            i = tuple(int(rng.integers(n)) for n in value.shape)
            if name == "x":
                i = (int(x[0, rng.integers(5)]), i[1])
            keep = value[i]
            value[i] = keep + 1e-5
            up = loss()
            value[i] = keep - 1e-5
            down = loss()
            value[i] = keep
            assert abs((up - down) / 2e-5 - grad[name][i]) < 1e-4, name
    model.p = {n: v.astype(np.float32) for n, v in model.p.items()}


def test_fit_reads_every_token(small_lm):
    model = small_lm[0].copy()
    docs = [np.full(n, n % 5) for n in (5000, 3, 0, 700, 41)]
    assert model.fit(iter(docs), 3) == 5744 + 5
    assert any((model.p[n] != v).any() for n, v in small_lm[0].p.items()) and model.fit([], 3) == 0


def test_state_is_carried_over_the_whole_document(small_lm):
    model = small_lm[0]
    docs = [np.array([0, 1, 4, 2, 0, 0]), np.array([], int), np.array([3, 3])]
    got = model.log_likelihood(docs)
    for d, want in zip(docs, got, strict=True):
        h, source, total = np.zeros((1, language_model.STATE), np.float32), model.ids[language_model.END], 0.0
        for target in [*d.tolist(), model.ids[language_model.END]]:
            h = model.step(model.p["x"][[source]], h)[0]
            total += model.output(h, np.array([target]))[0]
            source = target
        assert abs(total - want) < 1e-4


def test_words_split_and_looked_up_together_as_one_by_one():
    import pyarrow as pa

    texts = ["One  two\ttwo\n", None, "", " \x0b\x0c\r ", "\u00c9t\u00c9 A\u00a0b \u2003 x", "zz three\x1fthree ONE", "q"]
    want = [language_model.tokens(t) for t in texts]
    index = language_model.Index([b"", b"two", b"x", b"one"])
    for rows, kept in ((pa.array(texts), want), (pa.array(texts).slice(2, 4), want[2:6]), (pa.array([], pa.string()), [])):
        words, sizes = language_model.split(rows)
        assert words.to_pylist() == [w for ws in kept for w in ws] and sizes.tolist() == [len(ws) for ws in kept]
        assert index.places_of(words).tolist() == [index[w] for ws in kept for w in ws]


def test_ranks_after_a_split_do_not_depend_on_the_sort():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 300):
        first = rng.integers(0, 2**60, max(1, n // 3))[rng.integers(0, max(1, n // 3), n)]
        group = induced.refine(np.zeros(n, np.int64), first)
        assert group.tolist() == [int((first < x).sum()) for x in first]
        key = rng.integers(0, 2**60, 4)[rng.integers(0, 4, n)]
        pairs = list(zip(first.tolist(), key.tolist(), strict=True))
        assert induced.refine(group, key).tolist() == [sum(q < p for q in pairs) for p in pairs]


def test_induced_sorting_equals_plain_sorting():
    rng = random.Random(4)
    for _ in range(150):
        n, letters = rng.randint(1, 90), rng.choice((1, 2, 5))
        t = [rng.randint(2, 1 + letters) for _ in range(n)]
        for _ in range(rng.randint(0, 4)):
            t[rng.randrange(n)] = induced.SEPARATOR
        t.append(0)
        parts = list(induced.Induced(np.array(t, np.uint16)).buckets())[::-1]
        want = sorted(range(n + 1), key=lambda i: t[i:])  # noqa: B023
        common = [0] + [next((k for k in range(n + 1) if t[a + k:a + k + 1] != t[b + k:b + k + 1]), 0)
                        for a, b in itertools.pairwise(want)]
        pos = np.concatenate([p for p, _ in parts]).tolist()
        lcp = np.concatenate([c for _, c in parts]).tolist()
        if pos[0] != n:  # the end's suffix need not be listed
            want, common = want[1:], [0, *common[2:]]
        assert pos == want and lcp == common


def test_spilled_shard_gives_the_same_ranges():
    rng = random.Random(5)
    pieces = [bytes(rng.choice(b"abc") for _ in range(rng.randint(300, 900))) for _ in range(30)]
    pieces += [pieces[0][100:] + b"tail", b" " * 500, b"x" + b" " * 450 + b"y"]
    windows = [len(p) - 199 for p in pieces]
    weights = [1] * len(pieces)
    got = induced.repeated(pieces, windows, weights, 200)
    assert got == induced.repeated(pieces, windows, weights, 200, induced.Store(4096))
    seen = {}
    for p in pieces:
        for i in range(len(p) - 199):
            seen[p[i:i + 200]] = seen.get(p[i:i + 200], 0) + 1
    for p, ranges in zip(pieces, got, strict=True):
        assert {i for a, b in ranges for i in range(a, b)} == {i for i in range(len(p) - 199) if seen[p[i:i + 200]] > 1}


def test_probe_sets_rise_in_cost_and_never_pair_opposites():
    sets = nearest.probe_sets(4, 40)
    assert not sets[0].any() and len({tuple(s) for s in sets}) == len(sets)
    assert not any(s[j] and s[7 - j] for s in sets for j in range(8))


def test_permutation_and_targets():
    for n in (1, 2, 3, 17, 1000, 4097):
        got = mixing.permute(np.arange(n), np.full(n, n), np.full(n, 5))
        assert sorted(got.tolist()) == list(range(n))
    assert mixing.targets([100, 100, 100]) == [200, 2 / 3 * 250, 1 / 3 * 250]
    assert mixing.targets([]) == [] and mixing.targets([0, 0]) == [0, 0]
    assert mixing.targets([10]) == [15]
    t = mixing.targets([5, 1000, 1000, 1000])
    assert t[0] == 10 and abs(sum(t) - 1.5 * 3005) < 1e-6


def test_links_of_large_and_small_lists_agree(monkeypatch):
    rng = np.random.default_rng(6)
    base = rng.integers(0, 2**63, dtype=np.uint64)
    fps = np.unique(base ^ rng.integers(0, 2**16, 300).astype(np.uint64) << np.uint64(8))

    def groups():
        left, right = simhash.spanning_links(fps)
        root = list(range(len(fps)))
        for a, b in zip(left, right, strict=True):
            x, y = root[a], root[b]
            root = [x if r == y else r for r in root]
        return {tuple(i for i, r in enumerate(root) if r == k) for k in set(root)}, len(left)

    small, edges = groups()
    assert edges < len(fps)
    monkeypatch.setattr(simhash, "ALL_PAIRS", 1)
    assert groups()[0] == small


def test_numerals_are_no_letters():
    assert language.words_of("½ ² Ⅷ ① 12 _ -") == []
    assert language.words_of("x² año Ⅷth 3rd_Ωmega İ") == ["x", "año", "th", "rd", "ωmega", "i"]
    assert language.predictor(None)(["①"])["lang_pred"] == ["und"]
