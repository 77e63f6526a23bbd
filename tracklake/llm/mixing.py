"""Mixing sources to target weights by Poisson replication.

Each source has a mean repetition rate, its share of the target over its share of the rows. The
copies of a document follow a Poisson distribution with that mean, inverted at a uniform number
made from a hash of seed, part and id: the same document always gets the same count. Copies are
spread over the cluster and sorted by a second hash, so the written order is a global shuffle.

A Poisson number with a large mean is a sum of parts with means of at most `LARGEST_MEAN`, each
inverted from its own hash, so that the distribution's table stays short and exp() does not
underflow.

Defined results: a null source is a source of its own. A null id hashes as an empty text. Rows
that repeat an id get equal counts. Sources with weight 0 get no copies; sources missing from the
weights keep the weight given by `weights=None`, which is the square root of their rows. An empty
table gives an empty result.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklake.session import stage

LARGEST_MEAN = 64.0
# Beyond this count the tail of a mean of 64 is below 2**-52, the step of the uniform numbers.
TABLE = 160
HASH_DIGITS = 13


def bits(*parts: Column) -> Column:
    """52 bits of the MD5 of the parts joined by ':', as a long."""
    text = F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_DIGITS), 16, 10).cast("long")


def uniform(*parts: Column) -> Column:
    """In [0, 1), from the bits of the parts."""
    return bits(*parts) / F.lit(float(16**HASH_DIGITS))


def rates(docs: DataFrame, source: str, weights: dict | None, copies_per_row: float) -> DataFrame:
    """Per source: rows, mean repetition rate, parts, and the distribution of one part."""
    counted = docs.groupBy(F.col(source).alias("of_source")).agg(F.count(F.lit(1)).alias("n"))
    given = F.lit(None).cast("double")
    for name, weight in (weights or {}).items():
        given = F.when(F.col("of_source").eqNullSafe(F.lit(name)), F.lit(float(weight))).otherwise(given)
    weighed = stage(counted.withColumn("weight", F.coalesce(given, F.sqrt(F.col("n").cast("double")))), "sources")
    total = weighed.agg(F.sum("n").alias("n"), F.sum("weight").alias("weight")).first()
    rows, weight = float(total["n"] or 0), total["weight"] or 1.0
    mean = F.col("weight") / F.lit(weight) * F.lit(rows * copies_per_row) / F.col("n")
    return (
        weighed.withColumn("rate", mean)
        .withColumn("parts", F.greatest(F.ceil(F.col("rate") / LARGEST_MEAN), F.lit(1)).cast("int"))
        .withColumn("part_mean", F.col("rate") / F.col("parts"))
        .withColumn("steps", distribution(F.col("part_mean")))
    )


def distribution(mean: Column) -> Column:
    """P(count <= k) for k = 0, 1, …, as an array, each from the one before."""
    first = F.exp(-mean)
    start = F.struct(first.alias("p"), F.array(first).alias("all"))

    def step(state: Column, k: Column) -> Column:
        p = state["p"] * mean / k
        return F.struct(p.alias("p"), F.concat(state["all"], F.array(F.element_at(state["all"], -1) + p)).alias("all"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TABLE)), start, step, lambda state: state["all"])


def copies(docs: DataFrame, doc_id="doc_id", source="source", weights: dict | None = None,
           copies_per_row: float = 1.0, seed: int = 7) -> DataFrame:
    """One struct `row` per row of docs, its id, and n_copies, the Poisson count."""
    own = docs.select(F.struct("*").alias("row"), docs[doc_id].alias("id"), docs[source].alias("source"))
    table = stage(rates(docs.select(docs[source]), source, weights, copies_per_row), "rates")
    steps = table.select("of_source", "parts", "steps")
    joined = own.join(steps, own["source"].eqNullSafe(steps["of_source"]), "left")
    drawn = F.transform(F.sequence(F.lit(1), "parts"), lambda part: uniform(F.lit(seed), part, F.col("id")))
    counts = F.transform(drawn, lambda u: F.size(F.filter("steps", lambda c: c <= u)))
    return joined.select("row", "id", F.aggregate(counts, F.lit(0), lambda a, b: a + b).alias("n_copies"))


def mix(docs: DataFrame, doc_id="doc_id", source="source", weights: dict | None = None,
        copies_per_row: float = 1.0, seed: int = 7, counts: bool = True) -> DataFrame:
    """Every row as often as its count says, in shuffled order.

    With counts also n_copies, copy (from 1) and shuffle_key; columns of docs with these names are
    then replaced.

    Rows are spread by the key and sorted by it within partitions. The rows of a hot source and
    the copies of one document have keys of their own, so no partition is larger than the others.
    """
    counted = copies(docs, doc_id, source, weights, copies_per_row, seed).where("n_copies > 0")
    copied = counted.select("*", F.explode(F.sequence(F.lit(1), F.col("n_copies"))).alias("copy"))
    key = bits(F.lit(f"{seed}/order"), F.col("id"), F.col("copy"))
    shuffled = copied.withColumn("shuffle_key", key).repartition(F.col("shuffle_key"))
    added = ("n_copies", "copy", "shuffle_key") if counts else ()
    columns = [F.col("row")[c].alias(c) for c in docs.columns if c not in added]
    return shuffled.sortWithinPartitions("shuffle_key").select(*columns, *added)
