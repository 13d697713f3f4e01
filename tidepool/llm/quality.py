"""Quality rules: hashed n-gram log-likelihood ratio between a trusted target and the raw corpus.

Words, in their own case, and pairs of words are hashed into ``BUCKETS``; two multinomials over the
buckets are counted, one over trusted documents, one over all documents. A document's score is the
mean log ratio of its n-grams (so its length does not matter), a whole number of thousandths of a
nat. A document is kept if its score reaches a threshold: the score that all but a share ``LOST`` of
the trusted documents reach which the target did not learn from. Before that come the plain rules:
too few words, or too many words in windows of five that the text repeats.

All of it is DataFrame functions. Texts are read once; their words' buckets (two bytes a word) and
counts are written with their label, and read for the corpus counts and for the scores. What is shuffled
is one row a bucket and task, a row of labels each, and the buckets once, two bytes a word, to meet the
trusted ids. The ratios are looked up in one constant array.

The target is fitted on every trusted document of one half (a hash of the id picks it), the threshold on
every one of the other; the corpus counts and the scores take every document whole.

Defined cases: a null or empty text has no words, counts 0, fails the plain rules; an id is trusted if
its labels all say so (conflicting or null labels do not count, repeated labels count once); equal
rows are judged each; without trusted documents only the plain rules judge; ties at the threshold are
kept; texts of any length are read whole, in time that grows with n log n of their words; an empty
table gives an empty result; extra columns, whatever their names, travel along in ``row``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.buckets import bucket, floored_mean, gains, let, runs, tallies, with_later
from tidepool.llm.common import staged

# White space between words, symbol characters, and the plain rules' limits.
SPACE = r"[\x20\x09-\x0D]+"
NO_SYMBOLS = r"[^#*$%&|<>]++"
LEAST_WORDS, MOST_REPEATED_PERCENT, REPEAT_WINDOW = 10, 20, 5

BUCKETS, ORDERS = 65_521, 2     # a prime: the pairs' buckets spread
LOST = 0.002
TRUSTED = 50_000    # trusted documents of each half that the SQL reads; the operator reads all of them


def words(text: Column) -> Column:
    """Whole runs between white space; none for null."""
    return F.coalesce(F.array_remove(F.split(text, SPACE), ""), F.array().cast("array<string>"))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that are equal to an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return F.when(F.instr(text, "\n") > 0, let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))).otherwise(0)


def windows_of_five(w: Column) -> Column:
    """A 64-bit hash of every five consecutive words: of words, pairs, fours, then fives."""
    def pairs(h: Column) -> Column:
        return let(with_later(h, h, 1, F.xxhash64), lambda p: fours(h, p))

    def fours(h: Column, p: Column) -> Column:
        return let(with_later(p, p, 2, F.xxhash64), lambda q: with_later(q, h, 4, F.xxhash64))

    return F.when(F.size(w) >= REPEAT_WINDOW, let(F.transform(w, lambda x: F.xxhash64(x)), pairs)).otherwise(
        F.array().cast("array<bigint>"))


def repeated_words(w: Column) -> Column:
    """Words in windows of five words that are found twice or more.

    Windows are compared by their hash. Texts without an equal pair, most of them, end there; otherwise
    (hash, start) pairs are sorted, starts next to an equal hash are taken in order, and each adds the
    words that the one before does not cover."""
    def starts_of(sorted_: Column) -> Column:
        def twice(s: Column, i: Column) -> Column:
            same = lambda at: F.coalesce(F.get(sorted_, at)["h"] == s["h"], F.lit(False))
            return F.when(same(i - 1) | same(i + 1), s["i"])
        return F.sort_array(F.array_compact(F.transform(sorted_, twice)))

    def covered(starts: Column) -> Column:
        zero = F.struct(F.lit(0).alias("n"), F.lit(-REPEAT_WINDOW).alias("last"))
        return F.aggregate(starts, zero, lambda a, p: F.struct(
            (a["n"] + F.least(F.lit(REPEAT_WINDOW), p - a["last"])).alias("n"), p.alias("last")), lambda a: a["n"])

    def of(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return (F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0))
                .otherwise(covered(let(pairs, starts_of))))

    return let(windows_of_five(w), of)


def measures(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """``row`` (the columns ``carry``, all by default), the words' buckets ``b``, and the counts and
    verdict of the plain rules."""
    carry = docs.columns if carry is None else carry
    t = F.coalesce("text", F.lit(""))

    def counts(w: Column) -> Column:
        return F.struct(F.transform(w, lambda x: bucket(x, BUCKETS)).alias("b"), F.size(w).cast("long").alias("n_words"),
                        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                        repeated_words(w).cast("long").alias("n_repeat_words"))

    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), let(words(t), counts).alias("c"),
                      F.length(F.regexp_replace(t, NO_SYMBOLS, "")).cast("long").alias("n_symbols"),
                      duplicate_lines(t).cast("long").alias("n_dup_lines"))
    out = out.select("row", "c.b", "c.n_words", "c.word_chars", "n_symbols", "n_dup_lines", "c.n_repeat_words")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def trusted_ids(labels: DataFrame, most: int | None = None) -> DataFrame:
    """(id, teaches) of every trusted document; half of them teach. ``most``: of the first ``2 * most``
    of them in hash order."""
    agreed = (labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
              .agg(F.min("quality").alias("q"), F.max("quality").alias("r")).filter("q = 1 AND r = 1"))
    h = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 8), 16, 10).cast("long")
    ids = agreed.select(F.col("doc_id").alias("id"), h.alias("h"))
    if most is not None:
        ids = ids.orderBy("h", "id").limit(2 * most)
    return staged(ids.select("id", (F.col("h") % 2 == 0).alias("teaches")), "quality-trusted")


def marked(found: DataFrame, trusted: DataFrame) -> DataFrame:
    """Measured documents with ``teaches``: true or false if they are trusted, else null. Trusted ids grow
    with the table, so the documents' buckets are dealt by id, at two bytes a word; only ids are held."""
    half = BUCKETS // 2 + 1
    dealt = found.withColumn("b", F.transform("b", lambda x: (x - half).cast("smallint")))
    return (dealt.join(trusted.hint("shuffle_hash"), F.col("row.doc_id") == F.col("id"), "left").drop("id")
            .withColumn("b", F.transform("b", lambda x: x.cast("int") + half)))


def learn(found: DataFrame) -> list[int]:
    """The gain of each bucket: trusted documents that teach against all documents measured."""
    teaches = F.when(F.col("teaches"), 1).otherwise(0)
    counts = tallies(found, runs(F.col("b"), ORDERS, BUCKETS), s=F.lit(1), t=teaches)
    return gains(found.sparkSession, counts, BUCKETS)


def scored(found: DataFrame, gain: list[int]) -> DataFrame:
    """Measured documents with their ``score``."""
    return found.withColumn("score", floored_mean(runs(F.col("b"), ORDERS, BUCKETS), gain)).drop("b")


def threshold(found: DataFrame, lost: float = LOST) -> int | None:
    """The score that all but a share ``lost`` of the trusted documents reach which did not teach and
    pass the plain rules; None without any. Scores are few whole numbers, so are the rows sorted."""
    counts = found.filter("NOT teaches AND NOT base_failed").groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    all_ = counts.agg(F.sort_array(F.collect_list(F.struct("score", "n"))).alias("c"), F.sum("n").alias("total"))

    def step(a: Column, c: Column) -> Column:
        reached = a["n"] + c["n"] > lost * F.col("total")
        return F.struct((a["n"] + c["n"]).alias("n"), F.coalesce(a["at"], F.when(reached, c["score"])).alias("at"))

    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("at"))
    return all_.select(F.aggregate("c", zero, step, lambda a: a["at"]).alias("at")).first()["at"]


def verdict(bar: int | None) -> Column:
    reached = F.lit(True) if bar is None else F.col("score") >= F.lit(bar)
    return ~F.col("base_failed") & reached


def fit(docs: DataFrame, labels: DataFrame, carry: list[str]) -> tuple[DataFrame, list[int], int | None]:
    """(documents scored, gains, threshold)."""
    trusted = trusted_ids(labels)
    measured = staged(marked(measures(docs, carry), trusted), "quality-measures")
    gain = learn(measured)
    found = staged(scored(measured, gain), "quality-scores")
    return found.drop("teaches"), gain, threshold(found)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``row`` (the columns of ``docs`` but its text), the counts, ``score``, ``threshold`` and ``kept`` of
    every document of ``docs`` (doc_id, text, …); ``labels`` (doc_id, quality) says which are trusted."""
    found, _, bar = fit(docs, labels, [c for c in docs.columns if c != "text"])
    return found.withColumn("threshold", F.lit(bar).cast("long")).withColumn("kept", verdict(bar))


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, with the columns of ``docs``; texts are measured again, not copied."""
    _, gain, bar = fit(docs, labels, ["doc_id"])
    return scored(measures(docs), gain).filter(verdict(bar)).select("row.*")
