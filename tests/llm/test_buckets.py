"""Quality rules and importance resampling against plain Python and their SQL."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import LONG, ROWS
from tests.plans import plan_text
from tidepool.llm import importance, quality
from tidepool.llm.buckets import PAIR
from tidepool.llm.queries import ORACLE, QUERIES
from tools.compare import digest, duck

SF = "/root/testdata/sf0.001"
LABELS = "doc_id long, quality int"


@pytest.mark.parametrize("name", ["op11_quality", "op12_importance"])
def test_query_equals_sql(spark, name):
    frame = QUERIES[name](spark, SF)
    cursor = duck(SF).execute(ORACLE[name])
    assert digest(frame.columns, [tuple(r) for r in frame.collect()]) == digest([c[0] for c in cursor.description], cursor.fetchall())


# quality rules

def plain_measures(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    hit = {i + k for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(w) < 10 or 100 * len(hit) > 20 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit), failed)


def buckets_of(text):
    one = [zlib.crc32(x.encode()) % quality.BUCKETS for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return one + [(a * PAIR + b) % quality.BUCKETS for a, b in zip(one, one[1:])]


def plain_kept(docs, labels):
    """{(id, text): (score, kept)} by whole-corpus loops."""
    said = {}
    for i, q in labels:
        if i is not None and q is not None:
            said.setdefault(i, set()).add(q)
    h = {i: int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16) for i, q in said.items() if q == {1}}
    s, t = Counter(), Counter()
    for i, text in docs:
        s.update(buckets_of(text))
        if i in h and h[i] % 2 == 0:
            t.update(buckets_of(text))
    n, S, T = quality.BUCKETS, sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (S + n) / ((s[b] + 1) * (T + n)))) for b in s}
    score = [sum(gain[b] for b in bs) // len(bs) if (bs := buckets_of(text)) else 0 for _, text in docs]
    failed = [plain_measures(text)[-1] for _, text in docs]
    rest = sorted(x for (i, _), x, f in zip(docs, score, failed) if i in h and h[i] % 2 and not f)
    bar = next((x for k, x in enumerate(rest) if sum(y <= x for y in rest) > quality.LOST * len(rest)), None)
    return [(i, x, not f and (bar is None or x >= bar)) for (i, _), x, f in zip(docs, score, failed)]


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_measures_equal_plain(spark, odd_docs, sample_docs):
    texts = [(r[1],) for r in ROWS] + sample_docs[1][:0]
    texts += [("a b c d e " * k,) for k in range(1, 8)] + [("x\ny\nx\n\n \n \nx y",), ("one two three four five six one two three four five",),
              ("a b c d e f a b c d e\tg a b c d e",), ("w " * 4,), ("w " * 5,), ("w " * 6,), (" wide space " * 4,), ("\x1c \x85 x",)]
    frame = spark.createDataFrame(texts, "text string").withColumn("doc_id", F.monotonically_increasing_id())
    for r in quality.measures(frame).collect():
        assert tuple(r[m] for m in MEASURES) == plain_measures(r["row"]["text"]), r["row"]["text"]


def test_verdicts_equal_plain(spark, sample_docs):
    labels = [tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality").collect()]
    got = sorted((r["doc_id"], r["score"], r["kept"]) for r in QUERIES["op11_quality"](spark, SF).collect())
    assert got == sorted(plain_kept(sample_docs[1], labels))
    by_label = {q: [k for i, _, k in got if (i, q) in set(labels)] for q in (0, 1)}
    assert sum(by_label[1]) / len(by_label[1]) > 0.9 and sum(by_label[0]) / len(by_label[0]) < 0.2


def test_quality_odd_inputs(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 1), (6, 1), (7, 0), (14, 1), (14, 0), (12, None), (None, 1), (99, 1)], LABELS)
    rows = quality.judge(odd_docs, labels).collect()
    assert len(rows) == len(ROWS) and {r["row"]["words"] for r in rows} == {"clash"}
    for r in rows:
        assert not (r["kept"] and r["base_failed"])
    assert {r["n_words"] for r in rows if r["row"]["doc_id"] == 6} == {len(LONG.split())}
    trusted = {r["id"] for r in quality.trusted_ids(labels).collect()}
    assert trusted == {1, 6, 99}                # conflicting, null and unlabelled ids are not trusted
    kept = quality.keep(odd_docs, labels)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["row"]["doc_id"] for r in rows if r["kept"])
    none = labels.limit(0)
    assert quality.judge(no_docs, labels).count() == 0 and quality.keep(no_docs, none).count() == 0
    for r in quality.judge(odd_docs, none).collect():
        assert r["threshold"] is None and r["kept"] == (not r["base_failed"])


def test_trusted_ids_are_bounded(spark):
    labels = spark.range(300).selectExpr("id AS doc_id", "1 AS quality")
    some = quality.trusted_ids(labels, most=20).collect()
    assert len(some) == 40 and {r["teaches"] for r in some} == {True, False}
    assert {r["id"] for r in some} == {r["id"] for r in quality.trusted_ids(labels.repartition(7), most=20).collect()}


def test_every_trusted_document_is_read(spark):
    n = 2 * quality.TRUSTED + 500
    labels = spark.range(n).selectExpr("id AS doc_id", "1 AS quality")
    trusted = quality.trusted_ids(labels)
    assert (trusted.count(), trusted.select("id").distinct().count()) == (n, n)
    found = spark.range(n).selectExpr("named_struct('doc_id', id) AS row", "array(0, 65520) AS b", "false AS base_failed", "id AS score")
    told = quality.marked(found, trusted)
    assert told.filter("teaches IS NULL OR b != array(0, 65520)").count() == 0
    held = [r["score"] for r in told.filter("NOT teaches").select("score").orderBy("score").collect()]
    at = next(i for i in range(n) if i + 1 > quality.LOST * len(held))
    assert quality.threshold(told) == held[at]


def test_repeats_take_no_quadratic_time(spark):
    text = " ".join(f"w{i % 20_000}" for i in range(200_000))
    row = quality.measures(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row["n_words"], row["n_repeat_words"]) == (200_000, 200_000)


def test_quality_runs_no_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = plan_text(quality.scored(quality.measures(docs), [0] * quality.BUCKETS))
    assert not re.search("MapInArrow|MapInPandas|ArrowEval|BatchEval|FlatMapGroups|PythonUDF", plan)
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


# importance resampling

def test_ranks_by_regular_sampling(spark, monkeypatch):
    """Many runs and segments, equal scores and repeated ids: exact ranks, bounded segments."""
    monkeypatch.setattr(importance, "SEGMENT_ROWS", 100)
    rng = np.random.default_rng(4)
    rows = [(int(i) if i % 17 else None, int(s)) for i, s in enumerate(rng.integers(0, 40, 1500))]
    rows += [(7, 20)] * 1000 + [(8, 39)] * 500
    frame = spark.createDataFrame(rows, "doc_id long, score long").repartition(11).selectExpr("struct(doc_id) AS row", "score")
    seen = []
    real = importance.cut
    monkeypatch.setattr(importance, "cut", lambda runs, splitters: seen.append(real(runs, splitters)) or seen[-1])
    got = importance.ranked(frame, 700, len(rows)).select("row.doc_id", "score", "rank").collect()
    want = sorted(rows, key=lambda r: (-r[1], r[0] is None, r[0] or 0))[:700]
    drawn = sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])
    assert [(r["doc_id"], r["score"]) for r in drawn] == want and [r["rank"] for r in drawn] == list(range(1, 701))
    assert sorted(((r["doc_id"], r["score"]) for r in got), key=repr) == sorted(rows, key=repr)
    sizes = [r["count"] for r in seen[0].groupBy("_segment").count().collect()]
    share = len(rows) / 30
    assert len(sizes) > 15 and max(sizes) <= 2 * share + 30


def test_importance_odd_inputs(spark, odd_docs, no_docs):
    target = spark.createDataFrame([(1, "alpha beta alpha"), (2, None), (3, "")], "item_id long, text string")
    rows = importance.resample(odd_docs, target, percent=50, least_words=1).collect()
    assert len(rows) == len(ROWS) and {r["row"]["score"] for r in rows} == {"clash"}
    eligible = [r for r in rows if r["n_words"] >= 1]
    assert sorted(r["rank"] for r in rows if r["rank"]) == list(range(1, len(eligible) // 2 + 1))
    for r in rows:
        n = len(re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r["row"]["text"] or "")))
        assert r["n_words"] == r["n_features"] == n and (n or r["weight"] == 0)
    drawn = importance.sample(odd_docs, target, percent=50, least_words=1)
    assert drawn.columns == odd_docs.columns and drawn.count() == len(eligible) // 2
    assert importance.resample(no_docs, target).count() == 0
    assert importance.resample(odd_docs, target.limit(0)).count() == len(ROWS)
    again = importance.resample(odd_docs.repartition(1), target, percent=50, least_words=1).collect()
    key = lambda rs: sorted(((r["row"]["doc_id"], r["score"], r["rank"]) for r in rs), key=repr)
    assert key(again) == key(rows)


def test_runs_of_words_are_features(spark):
    docs = spark.createDataFrame([(1, "A b a b c"), (2, "c")], "doc_id long, text string")
    got = {r["row"]["doc_id"]: r["n_features"] for r in importance.resample(docs, docs, orders=3).collect()}
    assert got == {1: 5 + 4 + 3, 2: 1}
    counts = importance.bucket_counts(docs, 1 << 20, 2)
    names = Counter(["a", "b", "a", "b", "c", "c", "a b", "b a", "a b", "b c"])
    assert {zlib.crc32(g.encode()) % (1 << 20): n for g, n in names.items()} == {int(i): int(counts[i]) for i in np.flatnonzero(counts)}


def test_draw_follows_the_weights(spark):
    """Documents of the target's words are drawn more often than others."""
    docs = spark.range(400).selectExpr("id AS doc_id", "repeat(if(id % 2 = 0, 'target words ', 'other things '), 15) AS text")
    target = spark.createDataFrame([(1, "target words " * 50)], "item_id long, text string")
    drawn = importance.sample(docs, target, percent=20)
    share = drawn.filter("doc_id % 2 = 0").count() / drawn.count()
    assert drawn.count() == 80 and share > 0.6
