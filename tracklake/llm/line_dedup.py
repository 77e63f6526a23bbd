"""Cross-site boilerplate: lines that stand on many distinct sites are removed from documents.

The spread of each line is a HyperLogLog sketch of its sites per line hash, merged by aggregation:
each task sends one sketch per line it has seen, however often the line occurs. Lines whose estimate
is near the threshold get exact distinct counts; only for them are (line, site) pairs shuffled, and
these are made distinct within tasks first.

A line is a whole line between line breaks, equal to the byte, with at least `min_chars` characters
that are not spaces at its ends. It is boilerplate if it stands on `min_sites` distinct sites or
more. A document loses all its boilerplate lines, unless they hold over half of its characters: such
a document is a copy, not a page around boilerplate, and stays whole for the steps that look for copies.

Everything is DataFrame code. Lines are compared by 64-bit hashes; a false match would need a line
whose hash equals that of a boilerplate line.

Defined results: a null text stays null and has no lines. A null site counts for no line. Repeated
rows and copies add nothing to the spread within one site. An empty table gives an empty result.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklake.session import stage

LOG_SIZE = 12
# Estimates of sketches of this size are within 5 % (three standard errors); near is twice that.
NEAR = 0.1


def line_hashes(text: Column, min_chars: int) -> Column:
    """Distinct hashes of the lines that are long enough."""
    lines = F.filter(F.split(text, "\n"), lambda l: F.length(F.trim(l)) >= min_chars)
    return F.array_distinct(F.transform(lines, lambda l: F.xxhash64(l)))


def spread(docs: DataFrame, min_sites: int, min_chars: int) -> DataFrame:
    """Lines that may be on min_sites sites, with the estimate: (line, estimate)."""
    lines = docs.select("site", F.explode(line_hashes(F.col("text"), min_chars)).alias("line"))
    sketches = lines.groupBy("line").agg(F.hll_sketch_agg("site", F.lit(LOG_SIZE)).alias("sketch"))
    estimated = sketches.select("line", F.hll_sketch_estimate("sketch").alias("estimate"))
    return estimated.where(F.col("estimate") >= min_sites * (1 - NEAR) - 1)


def boilerplate(docs: DataFrame, min_sites: int, min_chars: int) -> tuple[DataFrame, DataFrame]:
    """Boilerplate lines, and for each text (by hash) the candidate lines it holds."""
    candidates = stage(spread(docs, min_sites, min_chars), "line-spread")
    held = docs.select(
        "site", F.xxhash64("text").alias("text_hash"), F.explode(line_hashes(F.col("text"), min_chars)).alias("line")
    )
    hits = stage(
        held.join(candidates, "line").groupBy("line", "estimate", "site", "text_hash").agg(F.lit(1).alias("one")),
        "line-hits",
    )
    near = F.col("estimate") < min_sites * (1 + NEAR) + 1
    pairs = hits.where(near).groupBy("line", "site").agg(F.lit(1).alias("one"))
    exact = pairs.groupBy("line").agg(F.count("site").alias("sites")).where(F.col("sites") >= min_sites)
    sure = hits.where(~near).select("line").distinct()
    return stage(sure.union(exact.select("line")), "boilerplate"), hits


def remove(docs: DataFrame, text="text", site="source", min_sites: int = 10, min_chars: int = 20,
           counts: bool = True) -> DataFrame:
    """docs with its text column reduced and, with counts, n_lines and n_removed (long).

    Columns of docs that have these two names are then replaced.
    """
    own = docs.select(F.struct("*").alias("row"), docs[text].alias("text"), docs[site].cast("string").alias("site"))
    lines, hits = boilerplate(own, min_sites, min_chars)
    bad = (
        hits.select("text_hash", "line").distinct().join(lines, "line").groupBy("text_hash")
        .agg(F.collect_set("line").alias("bad"))
    )
    bad = stage(bad, "lines-of-texts")
    hashed = own.select("row", "text", F.xxhash64("text").alias("hash"))
    # Always by a shuffle: the lists grow with the documents, and so would a broadcast of them.
    joined = hashed.join(bad.hint("merge"), F.col("hash") == F.col("text_hash"), "left")
    split = F.split("text", "\n")
    is_bad = lambda l: (F.length(F.trim(l)) >= min_chars) & F.array_contains("bad", F.xxhash64(l))
    tried = joined.select(
        "row", "text", split.alias("lines"),
        F.when(F.col("bad").isNotNull(), F.filter(split, lambda l: ~is_bad(l))).alias("rest"),
    )
    shorter = F.concat_ws("\n", "rest")
    chars = lambda array: F.aggregate(array, F.lit(0), lambda n, l: n + F.length(F.trim(l)))
    applies = F.coalesce(F.col("rest").isNotNull() & (2 * chars("rest") >= chars("lines")), F.lit(False))
    added = ("n_lines", "n_removed") if counts else ()
    made = {
        text: F.when(F.col("applies"), shorter).otherwise(F.col("text")),
        "n_lines": F.coalesce(F.size("lines"), F.lit(0)).cast("long"),
        "n_removed": F.when(F.col("applies"), F.size("lines") - F.size("rest")).otherwise(0).cast("long"),
    }
    names = [*(c for c in docs.columns if c not in added), *added]
    own = {text, *added}
    done = tried.withColumn("applies", applies)
    return done.select(*(made[c].alias(c) if c in own else F.col("row")[c].alias(c) for c in names))
