"""Conversation repair against plain dynamic programming, row by row."""

import hashlib
import itertools
import random
import re
import zlib
from functools import cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepool.llm import conversations as C
from tidepool.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(conv, turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


def plain_repair(rows):
    """(statistics, audit, text) of one conversation's rows in order."""
    seen, kinds, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    for _, _, role, text in rows:
        word = re.findall(r"[^\x20\x09-\x0D]", text)
        kind = ("blank" if not word else "duplicate" if (role, text) in seen else "truncated" if word[-1] not in ".!?" else "")
        seen.add((role, text))
        kinds.append(kind)
        if kind:
            counts[kind] += 1
    initial = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initial, initial[1:]))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    nexts = {"": "su", "s": "u", "u": "a", "a": "u"}

    @cache
    def best(i, state):         # (cost, audit, repaired lines) of rows i.. after ``state``
        options = []
        if i == len(rows):
            if state in ("", "a"):
                options.append((0, "", ()))
        else:
            role, text, kind = rows[i][2], rows[i][3], kinds[i]
            c, a, t = best(i + 1, state)
            options.append((c + 3, "D" + a, t))
            if kind not in ("blank", "duplicate"):
                more = kind == "truncated"
                if initial[i] and initial[i] in nexts[state]:
                    c, a, t = best(i + 1, initial[i])
                    options.append((c + more, "K" + a, (f"{role}:{text}", *t)))
                for to in ("user", "assistant"):
                    if to[0] in nexts[state]:
                        c, a, t = best(i + 1, to[0])
                        options.append((c + 2 + more, "R" + a, (f"{to}:{text}", *t)))
        return min(options + inserted(i, state, options), default=(10**9, "~", ()))

    def inserted(i, state, _):
        out, lines, now = [], (), state
        for k in range(1, 4):
            to = "assistant" if now == "u" else "user"
            lines, now = (*lines, f"{to}:"), to[0]
            if k > 2 and i < len(rows):
                break
            c, a, t = without_insert(i, now)
            out.append((c + 2 * k, "I" * k + a, (*lines, *t)))
        return out

    @cache
    def without_insert(i, state):
        if i == len(rows):
            return (0, "", ()) if state in ("", "a") else (10**9, "~", ())
        role, text, kind = rows[i][2], rows[i][3], kinds[i]
        c, a, t = best(i + 1, state)
        options = [(c + 3, "D" + a, t)]
        if kind not in ("blank", "duplicate"):
            more = kind == "truncated"
            if initial[i] and initial[i] in nexts[state]:
                c, a, t = best(i + 1, initial[i])
                options.append((c + more, "K" + a, (f"{role}:{text}", *t)))
            for to in ("user", "assistant"):
                if to[0] in nexts[state]:
                    c, a, t = best(i + 1, to[0])
                    options.append((c + 2 + more, "R" + a, (f"{to}:{text}", *t)))
        return min(options)

    cost, audit, lines = best(0, "")
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def plain_report(rows, ids=None):
    out = {}
    for conv in {r[0] for r in rows} | set(ids or ()):
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (
            r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))
        out[conv] = plain_repair(mine)
    return out


def as_dict(frame):
    rows = frame.collect()
    assert len({r["conv_id"] for r in rows}) == len(rows)
    return {r["conv_id"]: tuple(r[n] for n in NAMES) for r in rows}


def random_rows(seed, conversations=60, longest=9):
    rng = random.Random(seed)
    texts = ["", " \n", "Hi.", "What?", "no end", "Hi.", "more\tthan one. ", "…", "ok!\x0b", "end .x"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "ua", "Sys"]
    return [(c if c else None, rng.choice([t, t, t, 2 * t, None, 0]), rng.choice(roles), rng.choice(texts))
            for c in range(conversations) for t in range(rng.randrange(longest))]


def test_query_equals_plain(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op13_conversations"](spark, SF)
    assert got.columns == ["conv_id", *NAMES]
    want = plain_report(plain_damage(rows), {r[0] for r in rows})
    assert as_dict(got) == want and {len(w[6]) > 2 for w in want.values()} == {True, False}


@pytest.mark.parametrize("chunk", [4096, 2])
def test_random_conversations(spark, monkeypatch, chunk):
    """Nulls in ids and turns, ties, repeated rows, odd roles; also when every conversation has many chunks."""
    monkeypatch.setattr(C, "CHUNK", chunk)
    rows = random_rows(chunk)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert as_dict(C.report(frame)) == plain_report(rows)


def test_damage_equals_plain(spark):
    rows = random_rows(7, 200) + [(3, None, None, None), (None, None, "user", None), (None, 4, None, "Hi.")]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = sorted((tuple(r) for r in C.damage(frame).collect()), key=repr)
    assert got == sorted(plain_damage(rows), key=repr)


def test_repaired_rows_are_legal(spark):
    rows = random_rows(5)
    lines = C.repair(spark.createDataFrame(rows, SCHEMA)).orderBy("conv_id", "at", "i").collect()
    for conv, mine in itertools.groupby(lines, key=lambda r: r["conv_id"]):
        mine = list(mine)
        assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][0] for r in mine))
        text = "\n".join(f"{r['role']}:{r['text']}" for r in mine)
        assert hashlib.sha256(text.encode()).hexdigest() == plain_report([r for r in rows if r[0] == conv])[conv][7]


def test_empty_table_and_conversations_without_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert C.report(none).count() == 0 and C.repair(none).count() == 0
    ids = spark.createDataFrame([(5,), (None,), (5,)], "conv_id long")
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert as_dict(C.report(none, ids)) == {5: nothing, None: nothing}


def test_long_text_many_copies_and_extra_columns(spark):
    long = "word " * 400_000 + "end."
    rows = [(1, 0, "user", long), (1, 1, "assistant", long), (2, 0, "user", "Hi."), (2, 1, "assistant", "Hi.")] + [(2, 1, "assistant", "Hi.")] * 500
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("at", "chunk", "rows", "head", "digest", "n")})
    assert as_dict(C.report(frame)) == plain_report(rows)


def test_one_conversation_with_a_third_of_the_rows(spark):
    """Chunks are bounded whatever the conversation's length."""
    roles = ["user", "assistant", "assistant", "user", "system"]
    rows = [(1, t, roles[t * t % 5], f"text {t}" + (".", "", "?")[t % 3]) for t in range(900)]
    rows += [(2 + i // 4, i % 4, ("user", "assistant")[i % 2], f"text {i}.") for i in range(400)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(6)
    before, C.CHUNK = C.CHUNK, 64
    try:
        sizes = [r["n"] for r in C.chunks(C.entries(C.plain(frame))).select(F.size("rows").alias("n")).collect()]
        got = as_dict(C.report(frame))
    finally:
        C.CHUNK = before
    assert max(sizes) <= 64 and sum(sizes) == len(rows)
    assert got == plain_report(rows)


def test_run_powers_equal_single_steps():
    for symbol in range(9):
        step = C.power(symbol, 0)
        slow = C.ACCEPT
        for n in range(40):
            assert np.array_equal(C.before_run(symbol, n, C.ACCEPT), slow)
            slow = C.times(step, slow)


def test_chunk_matrices_compose():
    rng = np.random.default_rng(3)
    head, role, copies = rng.integers(0, 3, 50), rng.integers(0, 4, 50), rng.integers(1, 4, 50)
    whole = C.matrix_of(C.runs_of(head, role, copies))
    parts = [C.matrix_of(C.runs_of(head[a:a + 7], role[a:a + 7], copies[a:a + 7])) for a in range(0, 50, 7)]
    out = parts[0]
    for p in parts[1:]:
        out = C.times(out, p)
    assert np.array_equal(out, whole)
