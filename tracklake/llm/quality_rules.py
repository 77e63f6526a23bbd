"""Document rules, and verdicts on hosts from the documents that fail them.

Every document is measured on its whole text. Failures are counted per host, the failure rate of a
host is shrunk towards the rate of all hosts by a beta prior fitted to the hosts themselves, and a
host whose shrunk rate is above `max_rate` takes all its documents with it.

Everything is DataFrame code. Within a document, repeated windows are found by sorting the array
of window hashes (64 bits, compared within one document only); nothing is exploded, so the only
shuffle is the one of partial counts per host.

Defined results: a null text has no words, no symbols and no lines, and fails for having too few
words. A null host is a host of its own. Repeated rows count as often as they occur. An empty
table gives an empty result.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklake.session import stage

SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
# Bounds on the spread between hosts (intra-class correlation); the prior then weighs 1 to 999 documents.
LEAST_SPREAD, MOST_SPREAD = 0.001, 0.5


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def repeated_words(starts: Column) -> Column:
    """Words covered by windows at the given ascending starts."""
    gaps = F.transform(
        starts, lambda s, k: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - s, F.lit(WINDOW)))
    )
    return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    whole = F.coalesce(docs[text], F.lit(""))
    kept = [docs[c] for c in docs.columns if c != text]
    words = F.filter(F.split(whole, SPACE), lambda w: w != "")
    lines = F.filter(F.split(whole, "\n"), lambda l: without(l, SPACES) != "")
    first = docs.select(
        *kept,
        words.alias("_words"),
        lines.alias("_lines"),
        F.length(without(whole, SPACES)).cast("long").alias("word_chars"),
        (F.length(whole) - F.length(without(whole, SYMBOLS))).cast("long").alias("n_symbols"),
    )
    w = F.col("_words")
    window = F.transform(
        F.slice(w, 1, F.greatest(F.size(w) - (WINDOW - 1), F.lit(0))),
        lambda x, i: F.struct(
            F.xxhash64(x, *(F.get(w, i + k) for k in range(1, WINDOW))).alias("h"), i.alias("i")
        ),
    )
    names = [c for c in docs.columns if c != text] + ["word_chars", "n_symbols"]
    second = first.select(
        *names,
        F.size(w).cast("long").alias("n_words"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.sort_array(window).alias("_windows"),
    )
    x = F.col("_windows")
    again = F.filter(
        x,
        lambda y, k: F.coalesce(F.get(x, k + 1)["h"] == y["h"], F.lit(False))
        | F.coalesce(F.get(x, k - 1)["h"] == y["h"], F.lit(False)),
    )
    third = second.select(
        *names, "n_words", "n_dup_lines", F.sort_array(F.transform(again, lambda y: y["i"])).alias("_starts")
    )
    fourth = third.select(
        *names,
        "n_words",
        "n_dup_lines",
        repeated_words(F.col("_starts")).cast("long").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return fourth.withColumn("base_failed", failed)


def host_rates(measured: DataFrame, host: str = "host") -> DataFrame:
    """Documents and failures per host, and the rate shrunk by the prior: one row per host.

    The prior comes from the moments of the hosts' rates. With m the rate of all documents and
    S the squared distances of the hosts' rates from it, weighed by documents, the correlation
    within hosts is (S - m(1-m)(hosts-1)) / (m(1-m)(N - sum n^2/N - (hosts-1))), kept within
    bounds; the prior weighs 1/correlation - 1 documents at rate m.
    """
    hosts = stage(
        measured.groupBy(F.col(host)).agg(
            F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed")
        ),
        "hosts",
    )
    total = hosts.agg(F.sum("n_docs").alias("n"), F.sum("n_failed").alias("f")).first()
    n, mean = total["n"] or 0, (total["f"] or 0) / max(total["n"] or 0, 1)
    rate = F.col("n_failed") / F.col("n_docs")
    spread = hosts.agg(
        F.count(F.lit(1)).alias("hosts"),
        F.sum(F.col("n_docs") * (rate - F.lit(mean)) ** 2).alias("s"),
        F.sum(F.col("n_docs").cast("double") ** 2).alias("n2"),
    ).first()
    within, free = mean * (1 - mean), spread["hosts"] - 1
    room = within * (n - (spread["n2"] or 0.0) / max(n, 1) - free)
    between = ((spread["s"] or 0.0) - within * free) / room if room > 0 else LEAST_SPREAD
    weight = 1 / min(max(between, LEAST_SPREAD), MOST_SPREAD) - 1
    shrunk = (F.col("n_failed") + F.lit(weight * mean)) / (F.col("n_docs") + F.lit(weight))
    return hosts.withColumn("host_rate", shrunk)


def judge(docs: DataFrame, doc_id="doc_id", text="text", host="source", max_rate: float = 0.5) -> DataFrame:
    """Measures, host_rate, base_failed and kept for every row of docs."""
    own = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"), docs[host].alias("host"))
    measured = stage(measure(own), "measured")
    hosts = host_rates(measured).select(F.col("host").alias("of_host"), "host_rate")
    joined = measured.join(hosts, measured["host"].eqNullSafe(hosts["of_host"]), "left").drop("of_host")
    return joined.withColumn("kept", ~F.col("base_failed") & (F.col("host_rate") <= max_rate))
