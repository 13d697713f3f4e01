"""Secret scans: character Markov models compared by log-likelihood ratio.

Two first-order Markov chains over a 65-symbol alphabet (letters, digits, one
symbol for ``+ / _ - =``, start) are trained from labelled samples: random strings
and ordinary identifiers. A candidate (a run of ``[A-Za-z0-9+/_=-]``, 20 characters
or more) is a secret if its mean log-likelihood ratio reaches ``MIN_RATIO``.
Named patterns (assignments, access keys, hex) are found beside it.

All of it is DataFrame functions: the matches of a pattern and the gaps between
them come from ``regexp_extract_all`` and ``split``; running sums of their lengths give
positions in code points; the ratio of a pair of characters is looked up in a
literal array of 65 * 65 numbers.

Defined cases: a null or empty text has no spans, counts 0, and empty span lists;
spans of one start come in the order of the kinds; repeated rows are scanned each; texts are
read whole, in time linear in the text and its matches; an empty table gives an empty result;
extra columns, whatever their names, travel along in ``row``.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.buckets import let

# The patterns of the contract.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}+"  # greedy maximal runs: the same as AKIA[A-Z0-9]+ of 16 characters or more
HEX = r"[0-9a-f]{32,}+"         # likewise [0-9a-f]+ of 32 or more
RUN = r"[A-Za-z0-9+/_=-]{20,}+"
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
MIN_RATIO = 0.5
BLOCK = 64   # elements in a block of a running sum

IDENTIFIERS = """getUserName set_default_value parse_http_header connectionTimeout max_retry_count
InternalServerError background-color margin-left-right application/json content-type-options
user_session_manager LinkedHashMapIterator readFileSync create_or_replace_table is_valid_password
AbstractFactoryBean total_order_amount customer_shipping_address updateLastModified
test_connection_pool default_token_length secret_key_name string_to_integer configuration-file-path
openStreetMapLayer render_template_string calculate_moving_average DatabaseMigrationScript
notification_service_url onMouseMoveListener en-us-keyboard-layout http_request_duration_seconds
international understanding responsibilities characteristics documentation/getting-started
the_quick_brown_fox_jumps over-the-lazy-dog straightforwardness Datenschutzbeauftragter
developpement-durable responsabilidad informaciones Geschwindigkeitsbegrenzung
section_2_table_10 version-1-0-2 page12of34 ISO-8601-date UTF-8-encoding HTTP2Server MAX_BUFFER_SIZE
DO-NOT-EDIT-THIS-FILE README_FIRST_PLEASE YYYY-MM-DD-HH-MM-SS AAAAAAAAAAAAAAAAAAAAAAAA
==================== -------------------- ____________________ ++++++++++++++++++++""".split()
#: Parts that ordinary identifiers are joined from.
PARTS = """account action address agent amount array asset balance batch block bucket buffer cache callback
catalog channel client cluster column command config context control counter cursor customer data date decode default
delete detail device document domain driver element encode entry error event export factory field filter format
frame function gateway global group handler header height history image import index input instance item iterator
join label layout length level library limit link list loader local lookup manager mapping matrix member memory
message method metric model module monitor name network node number object offset option order output owner package
parameter parent parser partition password path pattern payment percent policy pool position prefix price process
product profile project property provider query queue random range record region register remote report request
resource response result retry return role router rule runner sample schedule schema scope search second section
sequence server service session setting shape shipping signal size source stage state status storage stream string
style suffix summary support switch symbol system table target task template text thread time token topic total
trace transfer trigger type update user utility value vector version view volume weight widget width window worker
writer""".split()


def _draws(seed: int = 12345):
    """Numbers of a linear congruential rule: the samples are the same everywhere."""
    while True:
        seed = (seed * 6364136223846793005 + 1442695040888963407) % 2**64
        yield seed >> 33


def labelled_samples(spark: SparkSession, n: int = 2000) -> DataFrame:
    """(text, random): ordinary identifiers, listed ones and ``n`` joined from ``PARTS`` in the usual styles
    (also in capitals), and ``n`` strings drawn over base64-like, hex and upper-case alphabets."""
    draw = _draws()
    pick = lambda of: of[next(draw) % len(of)]
    rows = [(w, 0) for w in (*IDENTIFIERS, *(w.upper() for w in IDENTIFIERS))]
    styles = ("_".join, "-".join, "/".join, lambda p: "_".join(p).upper(), lambda p: "".join(x.capitalize() for x in p),
              lambda p: p[0] + "".join(x.capitalize() for x in p[1:]), "".join)
    for i in range(n):
        parts = [pick(PARTS) for _ in range(3 + next(draw) % 3)]
        rows.append((styles[i % len(styles)](parts + ([str(next(draw) % 100)] if i % 5 == 0 else [])), 0))
    kinds = (SYMBOLS[:62], SYMBOLS[52:62] + "abcdef", SYMBOLS[:64], SYMBOLS[:26] + SYMBOLS[52:62])
    for i in range(n):
        rows.append(("".join(pick(kinds[i % len(kinds)]) for _ in range(20 + next(draw) % 28)), 1))
    return spark.createDataFrame(rows, "text string, random int")


def train(samples: DataFrame) -> list[float]:
    """Log ratios of the transition a -> b at [65 * a + b], symbol 64 the start; needs
    one aggregation over the samples (two labels * 65 * 65 counts at most)."""
    pairs = (samples.filter("text is not null")
             .select("random", F.concat(F.lit(" "), "text").alias("t"))
             .filter("length(t) > 1")
             .select("random", F.explode(F.expr(
                 "transform(sequence(1, length(t) - 1), i -> substring(t, i, 2))")).alias("p"))
             .groupBy("random", "p").count())
    counts = {k: [[0] * 65 for _ in range(65)] for k in (0, 1)}
    for r in pairs.collect():
        counts[r["random"]][symbol(r["p"][0])][symbol(r["p"][1])] += r["count"]
    return log_ratios(counts)


def log_ratios(counts: dict[int, list[list[int]]], alpha: float = 0.5, back: float = 4.0) -> list[float]:
    """Transition log ratios of both chains; an unseen transition falls back on how frequent
    the second symbol is (``back`` counts of it), that on ``alpha`` counts of every symbol."""
    log = {}
    for k, table in counts.items():
        single = [sum(row[b] for row in table) + alpha for b in range(65)]
        total = sum(single)
        log[k] = [math.log((row[b] + back * single[b] / total) / (sum(row) + back)) for row in table for b in range(65)]
    return [r - o for r, o in zip(log[1], log[0], strict=True)]


def symbol(ch: str) -> int:
    if ch == " ":
        return 64
    at = SYMBOLS.find(ch)
    return min(at, 62) if at >= 0 else 63


def ratio(text: Column, table: list[float]) -> Column:
    """Mean log-likelihood ratio per character."""
    lookup = F.from_json(F.lit(json.dumps(table)), "array<double>")
    code = lambda at: F.when(at > 0, F.least(at - 1, F.lit(62))).otherwise(63)
    codes = F.transform(F.split(text, ""), lambda c: code(F.instr(F.lit(SYMBOLS), c)))
    step = lambda acc, b: F.struct(
        (acc["s"] + F.element_at(lookup, acc["a"] * 65 + b + 1)).alias("s"), b.alias("a"))
    start = F.struct(F.lit(0.0).alias("s"), F.lit(64).alias("a"))
    return F.aggregate(codes, start, step, lambda acc: acc["s"] / F.length(text))


def running(values: Column, join) -> Column:
    """What ``join`` (a sum, a maximum) makes of 0 and the elements before each one, in blocks of ``BLOCK``:
    arrays grow only inside a block, so the work is in proportion to the array."""
    start = F.expr("struct(0 AS all, cast(array() AS array<int>) AS before)")
    add = lambda acc, x: F.struct(join(acc["all"], x).alias("all"), F.concat(acc["before"], F.array(acc["all"])).alias("before"))

    def of(v: Column) -> Column:
        last = F.floor((F.size(v) - 1) / BLOCK).cast("int")

        def block(k: Column) -> Column:
            inside = F.sequence(k * BLOCK, F.least(F.size(v), (k + 1) * BLOCK) - 1)
            return F.aggregate(inside, start, lambda acc, i: add(acc, F.get(v, i)))

        return let(F.transform(F.sequence(F.lit(0), last), lambda k: block(k)), together)

    def together(blocks: Column) -> Column:
        before = F.aggregate(blocks, start, lambda acc, b: add(acc, b["all"]), lambda acc: acc["before"])
        return F.flatten(F.zip_with(blocks, before, lambda b, o: F.transform(b["before"], lambda x: join(o, x))))

    return F.when(F.size(values) > 0, let(values, of)).otherwise(F.array().cast("array<int>"))


def spans(text: Column, kind: str, order: int, pattern: str, group: int, keep) -> Column:
    """Array of (start, kind order, end, kind, value) of the pattern's leftmost non-overlapping
    matches that ``keep`` (of the group's text) accepts; code points, end exclusive."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    empty = F.expr("cast(array() as array<struct<start:int,ord:int,end:int,kind:string,value:string>>)")

    def of(m: Column) -> Column:      # one entry a match: gap before it, its length, its value
        before = running(F.transform(m, lambda x: x["gap"] + x["len"]), lambda a, b: a + b)
        return F.zip_with(m, before, lambda x, at: F.struct(
            (at + x["gap"]).alias("start"), F.lit(order).alias("ord"), (at + x["gap"] + x["len"]).alias("end"),
            F.lit(kind).alias("kind"), x["value"].alias("value")))

    both = F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"),
                        F.transform(found, lambda m: F.length(m)).alias("len"), value.alias("value"))
    return F.when(text.rlike(pattern), F.filter(let(both, of), lambda m: keep(m["value"]))).otherwise(empty)


def scan(docs: DataFrame, table: list[float] | None = None, min_ratio: float = MIN_RATIO) -> DataFrame:
    """``row`` (the input row) and ``found``: all spans, sorted by start, then kind."""
    table = table or train(labelled_samples(docs.sparkSession))
    frame = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.coalesce("text", F.lit("")).alias("t"))
    t = F.col("t")
    length = lambda n: lambda v: F.length(v) >= n
    kinds = [spans(t, "assign", 0, ASSIGN, 1, length(8)), spans(t, "access", 1, ACCESS, 0, length(16)),
             spans(t, "hex", 2, HEX, 0, length(32)),
             spans(t, "markov", 3, RUN, 0, lambda v: ratio(v, table) >= min_ratio)]
    return frame.select("row", F.sort_array(F.concat(*kinds)).alias("found"))


def span_text(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda m: F.concat_ws(
        ":", m["kind"], m["start"].cast("string"), m["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """Counts by kind, the digest of the base spans and the list of all spans."""
    found = F.col("found")
    of = lambda kind: F.size(F.filter(found, lambda m: m["kind"] == kind)).cast("long")
    return scan(docs).select(
        F.col("row.doc_id").alias("doc_id"), of("assign").alias("n_assign"), of("access").alias("n_access"),
        of("hex").alias("n_hex"),
        F.sha2(span_text(F.filter(found, lambda m: m["kind"] != "markov")).cast("binary"), 256).alias("base_sha256"),
        span_text(found).alias("spans"))


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """The documents with every span replaced by ``mark`` (overlapping spans become one mark).

    A mask as long as the text says of each code point whether it stays (0), goes (1) or becomes the
    mark (2); both are joined point by point, in time linear in the text and its spans."""
    text, zero = F.col("row.text"), F.lit(0)

    def masked(found: Column) -> Column:
        reached = running(F.transform(found, lambda m: m["end"]), lambda a, b: F.greatest(a, b))
        piece = lambda m, at: F.when(m["start"] >= at, F.concat(
            F.repeat(F.lit("0"), m["start"] - at), F.lit("2"), F.repeat(F.lit("1"), m["end"] - m["start"] - 1))).otherwise(
            F.repeat(F.lit("1"), F.greatest(zero, m["end"] - at)))
        last = F.array_max(F.transform(found, lambda m: m["end"]))
        return F.concat(F.array_join(F.zip_with(found, reached, piece), ""), F.repeat(F.lit("0"), F.length(text) - last))

    point = lambda c, m: F.when(m == "0", c).when(m == "2", F.lit(mark)).otherwise(F.lit(""))
    done = F.array_join(F.zip_with(F.split(text, ""), F.split(let(F.col("found"), masked), ""), point), "")
    marked = scan(docs).withColumn("clean", F.when(F.size("found") > 0, done).otherwise(text))
    cols = [F.col("clean").alias(c) if c == "text" else
            F.when(F.size("found") > 0, F.length("clean").cast("long")).otherwise(F.col("row.n_chars")).alias(c)
            if c == "n_chars" else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return marked.select(*cols)
