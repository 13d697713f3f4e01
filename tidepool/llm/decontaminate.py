"""Benchmark decontamination with a positional inverted index.

The test side is cut into phrases (windows of ``window`` consecutive words). The
index holds postings (term, document, position, the words around it) of training
tokens, for the terms that lead a phrase: of each phrase, the term that is rarest
in the training data. A phrase's list is read at its rarest term, shifted by that
term's offset to the phrase's start, and intersected with the other terms in order
of rarity at their own offsets; what survives all of them is an exact match.
``proximity_matches`` asks only that the rarest terms occur within a distance.

Everything is DataFrame functions. Test-side tables are broadcast only after a
check of their size (``MAX_BROADCAST_ROWS``); beyond it the same joins shuffle.

Defined cases: null texts have no words; a phrase-less item never matches; equal
rows (same id and text) get the same result each; texts of any length are read whole;
items that share a phrase all count; empty tables give empty results
(or zero counts); further columns of the inputs are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import lower_ascii, staged

# Fixed value: what lies between words. Upper-case letters count as word characters here because
# words are cut before they are lowered (lowering whole texts costs more than cutting them).
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 10
MAX_BROADCAST_ROWS = 200_000


def words(text: Column) -> Column:
    """Words in their own case."""
    return F.coalesce(F.array_remove(F.split(text, GAP), ""), F.array().cast("array<string>"))


def folded(word: Column) -> Column:
    """The key of a term in joins. It folds more than the contract's A-Z (other scripts too), so
    equal words have equal keys; matches are decided by ``lower_ascii`` on the words themselves."""
    return F.lower(word)


def bounded(df: DataFrame) -> DataFrame:
    """Broadcast ``df`` (a written table) if its counted rows stay under the bound."""
    return F.broadcast(df) if df.count() <= MAX_BROADCAST_ROWS else df


def keyed(docs: DataFrame) -> DataFrame:
    """doc (id and text as one key), doc_id, words. The key makes equal rows one document."""
    return docs.select(F.xxhash64("doc_id", "text").alias("doc"), "doc_id", words(F.col("text")).alias("words"))


def phrases(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct phrases: (pid, terms, items that hold it). Written: it is read several times."""
    w = items.select("item_id", words(lower_ascii(F.col("text"))).alias("w")).filter("size(w) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - window + 1))
    cut = w.select("item_id", F.explode(F.transform(starts, lambda s: F.slice("w", s, window))).alias("terms"))
    return staged(cut.groupBy("terms").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
                  .select(F.xxhash64("terms").alias("pid"), "terms", "items"), "phrases")


def term_counts(train: DataFrame, phrase: DataFrame) -> DataFrame:
    """Occurrences in the training data of every (folded) term of a phrase (0 if none)."""
    vocabulary = staged(phrase.select(F.explode("terms").alias("term")).select(
        folded(F.col("term")).alias("term")).distinct(), "phrase-terms")
    found = (train.select(F.explode("words").alias("word")).select(folded(F.col("word")).alias("term")).join(bounded(vocabulary), "term")
             .groupBy("term").agg(F.count(F.lit(1)).alias("n")))
    return vocabulary.join(found, "term", "left").select("term", F.coalesce("n", F.lit(0)).alias("n"))


def leads(phrase: DataFrame, counts: DataFrame, ranked: int = 3) -> DataFrame:
    """(pid, terms, lead, off, others): the rarest term with its offset, and the offsets of
    all terms by rarity."""
    each = (phrase.select("pid", F.posexplode("terms").alias("off", "word"))
            .select("pid", "off", folded(F.col("word")).alias("term")).join(counts, "term"))
    order = (each.groupBy("pid").agg(F.min("n").alias("least"), F.array_sort(
        F.collect_list(F.struct("n", "off", "term"))).alias("by_rarity")))
    return staged(phrase.join(order.filter("least > 0"), "pid").select(
        "pid", "terms", F.col("by_rarity")[0]["term"].alias("lead"), F.col("by_rarity")[0]["off"].alias("off"),
        F.transform("by_rarity", lambda b: b["off"]).alias("rare_offs")), "phrase-leads")


def postings(train: DataFrame, lead: DataFrame, window: int = WINDOW) -> DataFrame:
    """The index over the leading terms: (term, doc, pos, before, near).

    ``near`` holds the words from ``window - 1`` before the position to ``window - 1``
    after it in their own case, ``before`` how many of them lie before: all that an intersection of
    offset-adjusted lists reads of the other terms' postings in this document.
    """
    terms = bounded(staged(lead.select(F.col("lead").alias("term")).distinct(), "lead-terms"))
    hit = (train.select("doc", "words", F.posexplode("words").alias("pos", "word"))
           .withColumn("term", folded(F.col("word"))).join(terms, "term"))
    before = F.least(F.col("pos"), F.lit(window - 1))
    return hit.select("term", "doc", "pos", before.alias("before"),
                      F.slice("words", F.col("pos") - before + 1, before + window).alias("near"))


def phrase_matches(index: DataFrame, lead: DataFrame) -> DataFrame:
    """(doc, pid, start, n): exact occurrences of phrases."""
    at = F.col("before") - F.col("off")  # the phrase's start in near
    inside = (at >= 0) & (at + F.size("terms") <= F.size("near"))
    # rarest first: the second and third rarest terms sort out most before the whole is compared
    rare = F.forall(F.slice("rare_offs", 2, 2), lambda o: lower_ascii(F.get("near", at + o)) == F.get("terms", o))
    whole = F.transform(F.slice("near", at + 1, F.size("terms")), lower_ascii) == F.col("terms")
    return (index.join(bounded(lead), F.col("term") == F.col("lead"))
            .filter(F.when(inside, rare & whole).otherwise(F.lit(False)))
            .select("doc", "pid", (F.col("pos") - F.col("off")).alias("start"), F.size("terms").alias("n")))


def proximity_matches(index: DataFrame, lead: DataFrame, terms: int = 3) -> DataFrame:
    """(doc, pid, pos): the ``terms`` rarest terms of a phrase within the index's reach of each other."""
    wanted = F.transform(F.slice("rare_offs", 1, terms), lambda o: F.get("terms", o))
    near = F.transform("near", lower_ascii)
    return (index.join(bounded(lead), F.col("term") == F.col("lead"))
            .filter(F.size(F.array_except(wanted, near)) == 0).select("doc", "pid", "pos").distinct())


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc, n_hit, item list) for documents that hold a phrase: covered words, items sorted."""
    train, phrase = keyed(docs), phrases(items, window)
    lead = leads(phrase, term_counts(train, phrase))
    found = staged(phrase_matches(postings(train, lead, window), lead).distinct(), "phrase-matches")
    # covered words: merge the sorted (start, end) of a document; a start counts once however many
    # phrases share it, so a document's list is bounded by its own words
    spans = found.groupBy("doc", "start").agg(F.max("n").alias("n"))
    step = lambda acc, s: F.struct(
        (acc["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(acc["at"], s["start"]))).alias("n"),
        F.greatest(acc["at"], s["end"]).alias("at"))
    covered = (spans.groupBy("doc").agg(F.array_sort(F.collect_list(
        F.struct("start", (F.col("start") + F.col("n")).alias("end")))).alias("s"))
        .select("doc", F.aggregate("s", F.struct(F.lit(0).alias("n"), F.lit(0).alias("at")), step,
                                   lambda a: a["n"]).cast("long").alias("n_hit")))
    held = (found.select("doc", "pid").distinct().join(bounded(phrase), "pid")
            .select("doc", F.explode("items").alias("item")).distinct()
            .groupBy("doc").agg(F.array_sort(F.collect_list("item")).alias("found_items")))
    return covered.join(held, "doc", "left")


def report(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    hits = staged(contamination(docs, items, window), "contaminated").select(
        F.col("doc").alias("hit_doc"), "n_hit", "found_items")
    # only ids and counts go through the join, not the texts
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("doc"),
                       F.size(words(F.col("text"))).cast("long").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    names = F.coalesce("found_items", F.array().cast("array<string>"))
    return rows.join(hits, F.col("doc") == F.col("hit_doc"), "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any phrase of the benchmark."""
    hits = staged(contamination(docs, items, window).select(F.col("doc").alias("_hit_doc")), "contaminated")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.xxhash64("doc_id", "text").alias("_doc"))
    return rows.join(bounded(hits), F.col("_doc") == F.col("_hit_doc"), "left_anti").select("row.*")
