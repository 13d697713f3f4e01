"""The queries of the llm operators over the given tables, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import (
    conversations,
    decontaminate,
    importance,
    language,
    language_model,
    mixing,
    nearest,
    quality,
    secrets,
    simhash,
    suffix_dedup,
    toxicity,
    url_filter,
)
from tidepool.llm.buckets import PAIR
from tidepool.llm.common import documents, id_fold


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    held_out = id_fold("doc_id", 4) == 2
    found = language.identify(docs.select("doc_id", "text"), docs.filter(~held_out))
    return found.select("row.doc_id", "lang_pred", "score").select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    held_out = id_fold("doc_id", 5) == 0
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out)     # nothing of held-out labels is counted
    found = toxicity.judge(docs, docs.filter(~held_out), labels)
    return found.select("row.doc_id", "score").select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return nearest.search(vectors, vectors.filter("vec_id % 50 = 0"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(documents(spark, sf_dir).select("doc_id", "text"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(documents(spark, sf_dir).select("doc_id", "text"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(documents(spark, sf_dir))


def op10_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    held_out = id_fold("doc_id", 5) == 1
    counts, learned = language_model.train(docs.filter(~held_out))
    return language_model.score(docs, counts, learned).withColumn("held_out", held_out)


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judge(documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return found.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                        "kept", "score", "threshold")


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = importance.resample(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), carry=["doc_id"])
    return found.select("row.doc_id", "n_features", "weight", "score", "rank")


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return conversations.report(conversations.damage(rows), rows)


QUERIES = {f.__name__: f for f in (
    op1_language, op2_toxicity, op3_url_filter, op4_mixing, op5_decontaminate, op6_nearest,
    op7_suffix_dedup, op8_secrets, op9_simhash, op10_language_model, op11_quality, op12_importance,
    op13_conversations)}


def op3_sql() -> str:
    """The model's weights are a function of the labelled table alone, so they enter as a list."""
    weights = url_filter.trained()
    host = r"regexp_extract(url, '^(?s:.*?)://([^/?#]*)([^?#]*)', 1)"
    gram = {n: "0" for n in url_filter.NGRAMS}
    for n in gram:
        for k in range(n):
            gram[n] = f"(({gram[n]} * 131 + unicode(s[i + {k}])) % {url_filter.BUCKETS})"
    sums = " + ".join(f"coalesce(list_sum(list_transform(range(1, greatest(length(s) - {n - 2}, 1)), lambda i: w[{gram[n]} + 1])), 0)"
                      for n in gram)
    count = " + ".join(f"greatest(length(s) - {n - 1}, 0)" for n in gram)
    action = lambda what, none: "CASE " + " ".join(
        f"WHEN (host = '{d}' OR ends_with(host, '.{d}')) AND starts_with(path, '{p}') THEN '{what(a, d, p)}'"
        for a, d, p in sorted(url_filter.RULES, key=lambda r: -len(r[1] + r[2]))) + f" ELSE {none} END"
    return f"""
WITH parts AS (SELECT page_id,
    translate(coalesce({host}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce({host.replace(", 1)", ", 2)")}, '') AS path FROM pages),
scored AS (SELECT *, round({weights[-1]} + CASE WHEN {count} > 0 THEN ({sums}) / sqrt({count}) ELSE 0 END, 6) AS score
    FROM (SELECT *, '^' || host || ' ' || path || '$' AS s, {weights} AS w FROM parts))
SELECT page_id, host, path, {action(lambda a, d, p: d + p, 'NULL')} AS rule,
    {action(lambda a, d, p: a, "CASE WHEN score > 0 THEN 'block' ELSE 'allow' END")} AS verdict, score FROM scored"""


OP5 = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[0-9a-z\x{80}-\x{10FFFF}]+'), []) AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark WHERE text IS NOT NULL),
phrase AS (SELECT DISTINCT item_id, len(terms) AS n, array_to_string(terms, ' ') AS t FROM (
    SELECT item_id, w[i:least(i + 9, len(w))] AS terms FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(i) WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM phrase),
starts AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS t
    FROM d, lengths, unnest(range(1, len(w) - n + 2)) AS u(i)),
hit AS (SELECT s.doc_id, s.i, s.n, p.item_id FROM starts s JOIN phrase p ON s.t = p.t AND s.n = p.n),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hit, unnest(range(0, n)) AS u(k) GROUP BY doc_id),
held AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN held USING (doc_id)"""

CRC = """
bits AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
coded AS (SELECT word, xor(list_reduce(list_concat([4294967295], list_transform(range(0, octet_length(encode(word))),
        lambda k: CAST('0x' || substr(hex(encode(word)), CAST(2 * k + 1 AS INTEGER), 2) AS BIGINT))),
    lambda c, b: xor(c >> 8, tab[1 + (xor(c, b) & 255)])), 4294967295) AS crc
    FROM (SELECT DISTINCT word FROM vocabulary), bits)"""

OP12 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+'), []) AS w FROM documents),
b AS (SELECT coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[0-9a-z\x{{80}}-\x{{10FFFF}}]+'), []) AS w FROM benchmark),
dw AS (SELECT r, unnest(w) AS word FROM d), bw AS (SELECT unnest(w) AS word FROM b),
vocabulary AS (SELECT word FROM dw UNION SELECT word FROM bw),{CRC},
db AS (SELECT r, crc % 10000 AS bucket FROM dw JOIN coded USING (word)),
s AS (SELECT bucket, count(*) AS s FROM db GROUP BY bucket),
t AS (SELECT crc % 10000 AS bucket, count(*) AS t FROM bw JOIN coded USING (word) GROUP BY bucket),
sizes AS (SELECT CAST((SELECT sum(s) FROM s) AS DOUBLE) AS n_corpus, CAST(coalesce((SELECT sum(t) FROM t), 0) AS DOUBLE) AS n_target),
gain AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t.t, 0) + 1) * (n_corpus + 10000) / ((s.s + 1) * (n_target + 10000)))) AS BIGINT) AS gain
    FROM s LEFT JOIN t USING (bucket), sizes),
weights AS (SELECT r, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight FROM db JOIN gain USING (bucket) GROUP BY r),
scored AS (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
        (CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5) / 4294967296))) AS BIGINT) AS score
    FROM d LEFT JOIN weights USING (r)),
placed AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank FROM scored LEFT JOIN placed USING (r)"""

def op11_sql() -> str:
    n, pair = quality.BUCKETS, PAIR
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
dw AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d), vocabulary AS (SELECT DISTINCT word FROM dw),{CRC},
one AS (SELECT r, i, crc % {n} AS b FROM dw JOIN coded USING (word)),
feature AS (SELECT r, b FROM one UNION ALL SELECT x.r, (x.b * {pair} + y.b) % {n} FROM one x JOIN one y ON x.r = y.r AND y.i = x.i + 1),
windows AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS g FROM d, unnest(range(1, len(w) - 3)) AS u(i)),
twice AS (SELECT r, i FROM windows JOIN (SELECT r, g FROM windows GROUP BY r, g HAVING count(*) > 1) USING (r, g)),
repeated AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, unnest(range(0, 5)) AS u(k) GROUP BY r),
base AS (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
       - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS BIGINT) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words, len(w) < {quality.LEAST_WORDS} OR 100 * coalesce(n, 0) > {quality.MOST_REPEATED_PERCENT} * len(w) AS base_failed
    FROM d LEFT JOIN repeated USING (r)),
agreed AS (SELECT doc_id, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) AS h FROM labels
    WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1 AND max(quality) = 1),
trusted AS (SELECT doc_id, h % 2 = 0 AS teaches FROM agreed ORDER BY h, doc_id LIMIT {2 * quality.TRUSTED}),
counts AS (SELECT b, count(*) AS s, count_if(r IN (SELECT r FROM d JOIN trusted USING (doc_id) WHERE teaches)) AS t FROM feature GROUP BY b),
gain AS (SELECT b, CAST(floor(1000 * ln((t + 1) * (sum(s) OVER () + CAST({n} AS DOUBLE)) / ((s + 1) * (sum(t) OVER () + CAST({n} AS DOUBLE))))) AS BIGINT) AS gain FROM counts),
weights AS (SELECT r, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS score FROM feature JOIN gain USING (b) GROUP BY r),
scored AS (SELECT base.*, coalesce(score, 0) AS score FROM base LEFT JOIN weights USING (r)),
rest AS (SELECT score, count(*) AS k FROM scored JOIN trusted USING (doc_id) WHERE NOT teaches AND NOT base_failed GROUP BY score),
bar AS (SELECT min(score) AS threshold FROM (SELECT score, sum(k) OVER (ORDER BY score) > {quality.LOST} * sum(k) OVER () AS reached FROM rest) WHERE reached)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, threshold,
    NOT base_failed AND coalesce(score >= threshold, TRUE) AS kept FROM scored, bar"""


ORACLE = {"op11_quality": op11_sql(), "op12_importance": OP12, "op3_url_filter": op3_sql(), "op5_decontaminate": OP5}
