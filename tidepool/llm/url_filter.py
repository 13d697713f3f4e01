"""URL filters: domain rules, and logistic regression on hashed character n-grams.

A rule (host, path) fits its host and all subdomains if the url's path starts with
the rule's path; the longest rule wins. Where no rule fits, a logistic regression
over n-grams of ``host + path`` judges, trained from a small labelled url table.

Features: n-grams of 3 and 4 characters of ``^host path$`` at an index that is a
polynomial of their code points modulo ``BUCKETS``. The weights are one literal array;
scoring is one expression per row, without a join or shuffle.

Defined cases: a null url, or one without ``://``, has empty host and path and is
judged by the model on the empty string; repeated rows are judged each; urls of any
length are read whole; two rules of one length that both fit have the same text; an empty
table gives an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import json
import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import ASCII_UPPER, lower_ascii

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]  # fixed values of the contract
BUCKETS, NGRAMS = 4096, (3, 4)

# A small labelled url table, our own: 1 is unwanted.
UNWANTED = """lucky-slots hot-singles payday-loan pills-online win-prize poker-bonus track-click xxx-video
casino-royal-play bets-now replica-watch miracle-diet crypto-double adserver click-farm gambling-palace
roulette-king sports-betting bonus-spins jackpot-city viagra-store cheap-meds pharmacy-discount weight-loss-trick
adult-chat sexy-cams escort-club nude-models dating-hookup ads-network banner-ads popup-ads tracker-pixel
spam-mailer bulk-mail link-farm seo-backlinks free-iphone get-rich-quick work-from-home-cash fake-rolex
bet-online win-big cheap-tickets-scam free-spins online-casino""".split()
ORDINARY = """library weather thenews cityguide recipes gardening museum travelnotes opendata schoolboard mathforum
histories mountain riverside theatre station bookshelf university newsletter hospital chemistry orchestra
architecture photography carpentry bicycles football railways parliament archive dictionary encyclopedia
kindergarten marathon bakery village harbour forest farmers-market science-journal local-council
open-source music-school the-gardener northern-lights weathermap handwriting another-day interesting
international translation""".split()


def labelled_urls() -> list[tuple[str, int]]:
    """Each name under three hosts and paths, so neither the host's ending nor the path tells the label."""
    out = []
    for label, names in ((1, UNWANTED), (0, ORDINARY)):
        for i, name in enumerate(names):
            for j, (sub, end, path) in enumerate((("", "example.com", "/en/"), ("www.", "example.org", "/de/"),
                                                  ("blog.", "example.com", "/es/"))):
                out.append((f"https://{sub}{name}.{end}{path}{(i * 7919 + j * 104729) % 50000}", label))
    return out


def host_path(url: Column) -> tuple[Column, Column]:
    parts = r"^[\s\S]*?://([^/?#]*)([^?#]*)"
    return (lower_ascii(F.coalesce(F.regexp_extract(url, parts, 1), F.lit(""))),
            F.coalesce(F.regexp_extract(url, parts, 2), F.lit("")))


def plain_host_path(url: str) -> tuple[str, str]:
    """``host_path`` of one url of the labelled table."""
    found = re.match(r"[\s\S]*?://([^/?#]*)([^?#]*)", url)
    return (found[1].translate(str.maketrans(ASCII_UPPER, ASCII_UPPER.lower())), found[2]) if found else ("", "")


def index_of(gram: str) -> int:
    h = 0
    for ch in gram:
        h = (h * 131 + ord(ch)) % BUCKETS
    return h


def features(host: str, path: str) -> list[int]:
    s = f"^{host} {path}$"
    return [index_of(s[i:i + n]) for n in NGRAMS for i in range(len(s) - n + 1)]


def train(rows: list[tuple[str, str, int]], epochs: int = 60, rate: float = 0.5, decay: float = 1e-4) -> list[float]:
    """Stochastic gradient descent over (host, path, label); the last number is the bias.
    The table is small (under 200 rows here), so this is driver arithmetic."""
    w = [0.0] * (BUCKETS + 1)
    data = [(features(h, p), y) for h, p, y in rows]
    for epoch in range(epochs):
        for k in range(len(data)):
            grams, y = data[(k * 37 + epoch) % len(data)]
            z = w[BUCKETS] + sum(w[g] for g in grams) / len(grams) ** 0.5
            step = rate / (1 + 0.1 * epoch) * (y - 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
            w[BUCKETS] += 0.1 * step
            for g in grams:
                w[g] += step / len(grams) ** 0.5 - rate * decay * w[g]
    return [round(x, 6) for x in w]


def trained(urls: list[tuple[str, int]] | None = None) -> list[float]:
    return train([(*plain_host_path(u), y) for u, y in urls or labelled_urls()])


def gram_weight(n: int, table: Column):
    """i -> weight of the n-gram that starts at index i of ``_codes``."""
    def look(i):
        h = F.lit(0)
        for k in range(n):
            h = (h * 131 + F.get("_codes", i + k)) % BUCKETS
        return F.get(table, h)
    return look


def model_score(host: Column, path: Column, weights: list[float]) -> tuple[Column, Column]:
    """(code points, to be named ``_codes``; log odds that the url is unwanted)."""
    table = F.from_json(F.lit(json.dumps(weights)), "array<double>")
    whole = F.concat(F.lit("^"), host, F.lit(" "), path, F.lit("$"))
    codes = F.transform(F.split(whole, ""), F.ascii)
    sums, count = F.lit(0.0), F.lit(0)
    for n in NGRAMS:
        last = F.size("_codes") - n + 1

        # a text of under n characters has no n-gram
        at = F.when(last > 0, F.sequence(F.lit(0), last - 1)).otherwise(F.array().cast("array<int>"))
        sums = sums + F.aggregate(F.transform(at, gram_weight(n, table)), F.lit(0.0), lambda a, x: a + x)
        count = count + F.greatest(last, F.lit(0))
    return codes, F.lit(weights[BUCKETS]) + F.when(count > 0, sums / F.sqrt(count)).otherwise(F.lit(0.0))


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as (text, action); ties in length cannot both fit but for equal text."""
    out = F.lit(None).cast("struct<text:string,action:string>")
    for action, domain, start in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(domain + start).alias("text"), F.lit(action).alias("action"))).otherwise(out)
    return out


def judge(pages: DataFrame, weights: list[float] | None = None, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, score (log odds of the model, six decimals)."""
    weights = weights or trained()
    host, path = host_path(F.col("url"))
    codes, score = model_score(F.col("host"), F.col("path"), weights)
    rule = rule_for(F.col("host"), F.col("path"), rules)
    return (pages.select("page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
            .withColumn("_codes", codes).withColumn("score", F.round(score, 6)).withColumn("fit", rule)
            .select("page_id", "host", "path", F.col("fit.text").alias("rule"),
                    F.coalesce("fit.action", F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"),
                    "score"))
