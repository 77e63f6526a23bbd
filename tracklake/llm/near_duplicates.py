"""Near-duplicate classes by improved consistent weighted sampling over TF-IDF shingles.

A document is the weighted set of its five-word shingles, weight (1 + DAMP ln tf)(1 + d ln(N/df)). Both parts
are damped: with plain weights the shingles of a large group of near copies would count for little beside
each copy's own changes, and a repeated line would outweigh a text. Samples are drawn with the weights
that decide similarity, d = DAMP, so how often a pair becomes candidates depends on its similarity alone, however large
its group is. Document frequencies are counted over all documents, in 2**20 buckets of shingle hashes, a table of fixed size.

Improved consistent weighted sampling gives ROWS x BANDS samples per document; two documents agree in
a sample with the probability of their weighted Jaccard similarity. Equal bands make candidates. At a
similarity of 0.8, all bands of a pair differ once in a million pairs, above that less often.

Documents with the same sequence of words are one class from the start, and one of them stands for it.
Within a bucket of candidates pairs are not listed. All members are compared with a pivot. It is the least
member of a small bucket; in one of LARGE members and more, it is the one that agrees most with the most common samples, the text that near copies were made from, if it is
there. What is then left of a small bucket is
compared in pairs; of a large one, in blocks, two to a task, which hand on no more than a pair per document: pairs that agree in
LEAST_AGREED samples and are not in one component yet are compared by their sets. One
minus the similarity is a metric, so a member y that is not linked to a pivot p can only be linked to a
member x that is if d(y,p) <= d(x,p) + 0.2; such pairs are compared where x and y are in different classes.
So the classes are the components of all links between candidates, without a list of all pairs.

Defined results: texts without words, null or empty, are copies of each other. A text of fewer than five
words is one shingle. Rows with a null id get the class of equal texts, and null if all ids of these are null;
they are not compared otherwise. Rows that repeat an id get classes by their own texts, each of which is compared; two
classes with the same least id have the same name. An empty table gives an empty result.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklake.llm.batches import Rolling, mix64, slices, word_bounds
from tracklake.llm.graph import components
from tracklake.session import stage

WORDS = 5
ROWS, BANDS = 3, 20
SIMILARITY = 0.8
DAMP = 0.05
BUCKET_BITS, BLOCK_BITS = 20, 14
RANDOM_BITS = 14
ODD = np.uint64(0x9E3779B97F4A7C15)
LARGE = 16
# Parts of a large bucket that are searched for a pivot on their own.
PARTS = 16
BLOCK = 512
# Bytes of sets in a block, and of text that is hashed at once.
BLOCK_BYTES = 4 << 20
SLICE = 1 << 20
# Of 60 samples; a pair with similarity 0.8 agrees in 48, and in fewer than 16 practically never.
LEAST_AGREED = 16


def shingles(rolling: Rolling, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes of all texts, where each text's begin, and the hashes of the words."""
    starts, ends = word_bounds(data, offsets)
    words = rolling.of(rolling.prefix(data), starts, ends)
    at = np.searchsorted(starts, offsets)
    n = np.diff(at)
    count = np.where(n >= WORDS, n - WORDS + 1, (n > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(count)])
    first = np.arange(bounds[-1]) + np.repeat(at[:-1] - bounds[:-1], count)
    left = np.repeat(np.minimum(n, WORDS), count)
    h = np.zeros(len(first), np.uint64)
    for k in range(WORDS):
        there = left > k
        h[there] = mix64(h[there] * ODD + words[first[there] + k] + np.uint64(k + 1))
    return h, bounds, (words, at)


def count_buckets(batches):
    """(block, counts) of a task: documents with a shingle in each bucket."""
    rolling, total = Rolling(23), np.zeros(1 << BUCKET_BITS, np.int32)
    seen = False
    for _, data, offsets in slices(batches, 0, SLICE):
        h, bounds, _ = shingles(rolling, data, offsets)
        bucket = (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        own = np.unique(np.repeat(np.arange(len(offsets) - 1), np.diff(bounds)) << BUCKET_BITS | bucket)
        total += np.bincount(own & ((1 << BUCKET_BITS) - 1), minlength=len(total)).astype(np.int32)
        seen = True
    if seen:
        blocks = total.reshape(-1, 1 << BLOCK_BITS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(blocks), dtype=np.int32)), pa.array([b.tobytes() for b in blocks], pa.binary())], names=["block", "counts"]
        )


def sum_blocks(batches):
    """Sums of the counts of each block; a task holds one array per block it gets."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
            own = sums.setdefault(block, np.zeros(1 << BLOCK_BITS, np.int64))
            own += np.frombuffer(counts.as_buffer(), np.int32)
    if sums:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["block", "counts"]
        )


def document_frequencies(docs: DataFrame) -> np.ndarray:
    """N/df of each bucket."""
    n = docs.count()
    counted = docs.select("text").mapInArrow(count_buckets, "block int, counts binary")
    # A fixed number of rows of fixed size.
    rows = counted.repartition("block").mapInArrow(sum_blocks, "block int, counts binary").collect()
    df = np.zeros(1 << BUCKET_BITS)
    for r in rows:
        df[r["block"] << BLOCK_BITS : (r["block"] + 1) << BLOCK_BITS] = np.frombuffer(r["counts"], np.int64)
    return max(n, 1) / np.clip(df, 1, max(n, 1))


class Sampler:
    """Weighted sets of documents and their samples."""

    def __init__(self, rarity: np.ndarray):
        # One kind of weights: with others, the loss of candidates would not follow from the similarity.
        self.sampled = self.compared = (1 + DAMP * np.log(rarity)).astype(np.float32)
        rng = np.random.default_rng(29)
        shape = (ROWS * BANDS, 1 << RANDOM_BITS)
        self.r = rng.gamma(2, 1, shape).astype(np.float32)
        self.log_c = np.log(rng.gamma(2, 1, shape)).astype(np.float32)
        self.beta = rng.random(shape, np.float32)
        self.odd = rng.integers(1, 1 << 62, ROWS * BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.rolling = Rolling(23)

    def weighted(self, h: np.ndarray, bounds: np.ndarray, factor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct shingles in order, their weights by the factor, and where each document's begin."""
        sets = [np.unique(h[a:b], return_counts=True) for a, b in zip(bounds[:-1], bounds[1:])]
        keys = np.concatenate([s[0] for s in sets]) if sets else h[:0]
        tf = np.concatenate([s[1] for s in sets]) if sets else np.zeros(0)
        at = np.concatenate([[0], np.cumsum([len(s[0]) for s in sets])]).astype(np.int64)
        weight = (1 + DAMP * np.log(tf)).astype(np.float32) * factor[(keys >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)]
        return keys, weight, at

    def samples(self, keys: np.ndarray, weight: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of bands, documents x BANDS, and of samples; documents without shingles get zeros."""
        n = len(at) - 1
        out, each = np.zeros((n, BANDS), np.uint64), np.zeros((n, ROWS * BANDS), np.uint32)
        full = np.flatnonzero(np.diff(at) > 0)
        if not len(full):
            return out, each
        starts, log_w = at[full], np.log(weight)
        width = np.diff(at)[full]
        for band in range(BANDS):
            key = np.full(len(full), np.uint64(band + 1))
            for k in range(band * ROWS, (band + 1) * ROWS):
                place = ((keys * self.odd[k]) >> np.uint64(64 - RANDOM_BITS)).astype(np.int64)
                r, beta = self.r[k][place], self.beta[k][place]
                t = np.floor(log_w / r + beta)
                log_a = self.log_c[k][place] - r * (t - beta) - r
                least = np.minimum.reduceat(log_a, starts)
                hits = np.flatnonzero(log_a == np.repeat(least, width))
                owner = np.searchsorted(starts, hits, "right") - 1
                pick = hits[np.concatenate([[True], owner[1:] != owner[:-1]])]
                sample = mix64(keys[pick] + t[pick].astype(np.int64).astype(np.uint64) * ODD)
                each[full, k] = sample.astype(np.uint32)
                key = mix64(key * ODD + sample)
            out[full, band] = key
        return out, each


def fingerprints(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each document's sequence of words."""
    place = np.arange(len(words)) - np.repeat(at[:-1], np.diff(at))
    out = []
    for seed in (1, 2):
        each = mix64(words * np.uint64(2 * seed + 1) + mix64(place.astype(np.uint64) + np.uint64(seed << 40)))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(each, dtype=np.uint64)])
        out.append(mix64(sums[at[1:]] - sums[at[:-1]] + np.diff(at).astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def signatures(docs: DataFrame, sampler) -> DataFrame:
    """(doc_id, h, f1, f2, bands, samples) of (doc_id, text, h): fingerprint of the words, bands, and samples."""

    def run(batches):
        own = sampler.value
        for rows, data, offsets in slices(batches, 1, SLICE):
            h, bounds, (words, at) = shingles(own.rolling, data, offsets)
            bands, each = own.samples(*own.weighted(h, bounds, own.sampled))
            bands = bands.view(np.int64)
            each = pa.ListArray.from_arrays(np.arange(0, each.size + 1, ROWS * BANDS, dtype=np.int32), pa.array(each.view(np.int32).ravel()))
            f1, f2 = fingerprints(words, at)
            lists = pa.ListArray.from_arrays(np.arange(0, bands.size + 1, BANDS, dtype=np.int32), pa.array(bands.ravel()))
            made = [rows.column(0), rows.column(2), pa.array(f1), pa.array(f2), lists, each]
            yield pa.RecordBatch.from_arrays(made, names=["doc_id", "h", "f1", "f2", "bands", "samples"])

    return docs.mapInArrow(run, "doc_id long, h long, f1 long, f2 long, bands array<long>, samples array<int>")


def vectors(docs: DataFrame, sampler) -> DataFrame:
    """(doc, keys, weights, size): arrays in binary, and their bytes."""

    def run(batches):
        own = sampler.value
        for rows, data, offsets in slices(batches, 1, SLICE):
            h, bounds, _ = shingles(own.rolling, data, offsets)
            keys, weight, at = own.weighted(h, bounds, own.compared)
            cut = lambda x: pa.array([x[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())
            size = pa.array(12 * np.diff(at))
            yield pa.RecordBatch.from_arrays([rows.column(0), cut(keys), cut(weight), size], names=["doc", "keys", "weights", "size"])

    return docs.mapInArrow(run, "doc long, keys binary, weights binary, size long")


def similarity(a_keys, a_weights, b_keys, b_weights) -> float:
    """Weighted Jaccard similarity of two sets in the order of their keys."""
    _, i, j = np.intersect1d(a_keys, b_keys, assume_unique=True, return_indices=True)
    both = np.minimum(a_weights[i], b_weights[j]).sum(dtype=float)
    either = a_weights.sum(dtype=float) + b_weights.sum(dtype=float) - both
    return both / either if either > 0 else 1.0


def compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, sim) of distinct pairs (a, b).

    The sets of b, of which a hot a has many, are joined first; the join on a is then one whose
    skew adaptive execution can split.
    """
    left, right = (sets.select(F.col("doc").alias(f"{x}_doc"), F.col("keys").alias(f"{x}_keys"), F.col("weights").alias(f"{x}_weights")) for x in "ab")
    joined = pairs.join(right.hint("merge"), F.col("b") == F.col("b_doc")).join(left.hint("merge"), F.col("a") == F.col("a_doc"))

    def run(batches):
        view = lambda c, kind: [np.frombuffer(x.as_buffer(), kind) for x in c]
        for batch in batches:
            ak, aw, bk, bw = (view(batch.column(i), kind) for i, kind in ((2, np.uint64), (3, np.float32), (4, np.uint64), (5, np.float32)))
            sims = [similarity(*x) for x in zip(ak, aw, bk, bw)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sims, pa.float64())], names=["a", "b", "sim"])

    return joined.select("a", "b", "a_keys", "a_weights", "b_keys", "b_weights").mapInArrow(run, "a long, b long, sim double")


def pivots_of(todo: DataFrame, samples: DataFrame) -> DataFrame:
    """(key, pivot) of each bucket with two members or more.

    The most common samples of a large bucket come from sketches of fixed size per bucket.
    """
    sizes = todo.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("least")).where("n > 1")
    sizes = stage(sizes, "bucket-sizes")
    large = todo.join(sizes.where(F.col("n") >= LARGE).select("key"), "key")
    sampled = stage(large.join(samples, "doc"), "large-buckets")
    looked_at = range(0, ROWS * BANDS, ROWS)  # one sample of each band
    # A sketch names no sample where none stands out, as in a bucket whose members share one passage only.
    common = [F.expr(f"get(approx_top_k(samples[{k}], 1, 64), 0).item") for k in looked_at]
    modes = sampled.groupBy("key").agg(*(c.alias(f"m{k}") for k, c in enumerate(common)))
    modes = modes.select("key", F.array(*(f"m{k}" for k in range(len(common)))).alias("modes"))
    own = F.array(*(F.get("samples", F.lit(k)) for k in looked_at))
    agreed = F.size(F.filter(F.zip_with(own, "modes", lambda x, y: x == y), lambda x: x))
    # A large bucket is dealt over parts; the best of each part meet again.
    part = F.pmod(F.xxhash64("doc"), F.lit(PARTS)).cast("int")
    spread = modes.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    score = F.struct(agreed.alias("agreed"), (-F.col("doc")).alias("least"))
    of_part = sampled.withColumn("part", part).join(spread, ["key", "part"]).groupBy("key", "part").agg(F.max(score).alias("best"))
    best = of_part.groupBy("key").agg((-F.max("best")["least"]).alias("central"))
    return sizes.join(best, "key", "left").select("key", F.coalesce("central", "least").alias("pivot"))


def blocks_of(members: DataFrame, samples: DataFrame, sets: DataFrame) -> DataFrame:
    """(key, block, docs) of members (key, doc), with samples and sets: about BLOCK documents each, fewer of long ones."""
    bulk = members.join(sets.select("doc", "size"), "doc").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
    sizes = bulk.select("key", F.ceil(F.greatest(F.col("n") / BLOCK, F.col("bytes") / BLOCK_BYTES)).alias("blocks"))
    placed = members.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")))
    full = placed.join(samples, "doc").join(sets, "doc")
    docs = F.collect_list(F.struct("doc", "samples", "keys", "weights")).alias("docs")
    return full.groupBy("key", "block").agg(docs)


def tied(x, y, least: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (a, b) that make the same components as all links between two blocks: a is the least of b's component.

    A block is (docs, samples, keys, weights). Pairs that enough samples agree in are compared by their sets, a row of
    them at once; those that are in one component already are not.
    """
    (x_docs, x_samples, x_keys, x_weights), (y_docs, y_samples, y_keys, y_weights) = x, y
    agreed = np.zeros((len(x_docs), len(y_docs)), np.uint8)
    for k in range(ROWS * BANDS):
        agreed += x_samples[:, k, None] == y_samples[None, :, k]
    close = agreed >= LEAST_AGREED
    if same:
        close = np.triu(close, 1)
    docs, at = np.unique(np.concatenate([x_docs, y_docs]), return_inverse=True)
    x_at, y_at = at[: len(x_docs)], at[len(x_docs) :]
    label = np.arange(len(docs))
    rows, columns = np.flatnonzero(close.any(1)), np.flatnonzero(close.any(0))
    if len(rows):
        keys = [*(x_keys[p] for p in rows), *(y_keys[q] for q in columns)]
        every, number = np.unique(np.concatenate(keys), return_inverse=True)
        numbers = np.split(number, np.cumsum([len(k) for k in keys])[:-1])
        x_numbers, y_numbers = dict(zip(rows, numbers)), dict(zip(columns, numbers[len(rows) :]))
        y_size = np.array([w.sum(dtype=float) for w in y_weights])
        own = np.zeros(len(every), np.float32)
        for p in rows:
            q = np.flatnonzero(close[p] & (label[y_at] != label[x_at[p]]))
            if not len(q):
                continue
            own[x_numbers[p]] = x_weights[p]
            least_of = np.minimum(own[np.concatenate([y_numbers[j] for j in q])], np.concatenate([y_weights[j] for j in q]))
            own[x_numbers[p]] = 0
            sums = np.concatenate([[0.0], np.cumsum(least_of, dtype=float)])
            both = np.diff(sums[np.concatenate([[0], np.cumsum([len(y_weights[j]) for j in q])])])
            either = x_weights[p].sum(dtype=float) + y_size[q] - both
            linked = q[np.where(either > 0, both / np.where(either > 0, either, 1), 1.0) >= least]
            label[np.isin(label, label[y_at[linked]])] = label[x_at[p]]
    root = np.full(len(docs), len(docs))
    np.minimum.at(root, label, np.arange(len(docs)))
    root = root[label]
    others = np.flatnonzero(root != np.arange(len(docs)))
    return docs[root[others]], docs[others]


def linked_blocks(left: DataFrame, right: DataFrame, samples: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) that make the same components as all links between the members (key, doc) of left and of right that have the same key.

    A task holds two blocks, and compares the sets of those that agree in enough samples. Where left is right, two blocks meet once.
    """
    whole = right is left
    a = stage(blocks_of(left, samples, sets), "blocks")
    b = a if whole else stage(blocks_of(right, samples, sets), "blocks")
    sides = a.select("key", F.col("block").alias("i"), F.col("docs").alias("a")), b.select("key", F.col("block").alias("j"), F.col("docs").alias("b"))
    pairs = sides[0].join(sides[1], "key")
    pairs = pairs.where("i <= j") if whole else pairs
    pairs = pairs.select("a", "b", (F.col("i") == F.col("j") if whole else F.lit(False)).alias("same"))

    def run(batches):
        def read(cell):
            docs = cell.values
            view = lambda k, kind: [np.frombuffer(x.as_buffer(), kind) for x in docs.field(k)]
            each = docs.field(1).flatten().to_numpy().reshape(-1, ROWS * BANDS)
            return docs.field(0).to_numpy(), each, view(2, np.uint64), view(3, np.float32)

        for batch in batches:
            for i in range(batch.num_rows):
                found = tied(read(batch.column(0)[i]), read(batch.column(1)[i]), least, batch.column(2)[i].as_py())
                yield pa.RecordBatch.from_arrays([pa.array(f, pa.int64()) for f in found], names=["a", "b"])

    return pairs.mapInArrow(run, "a long, b long").distinct()


def links(members: DataFrame, samples: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) whose links make the same components as all links within buckets (key, doc)."""
    pivots = pivots_of(members, samples)
    tried = stage(members.join(pivots, "key").where("doc <> pivot").select("key", F.col("pivot").alias("a"), F.col("doc").alias("b")), "tried")
    seen = stage(compare(tried.select("a", "b").distinct(), sets), "compared")
    found = seen.where(F.col("sim") >= least).select("a", "b")
    todo = tried.join(seen, ["a", "b"]).where(F.col("sim") < least).select("key", F.col("b").alias("doc"))
    sizes = todo.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sized = stage(todo.join(sizes, "key"), "left-over")
    few = sized.where(F.col("n") < LARGE).select("key", "doc")
    pairs = few.withColumnRenamed("doc", "a").join(few.withColumnRenamed("doc", "b"), "key").where("a < b").select("a", "b").distinct()
    found = found.union(stage(compare(pairs, sets), "compared").where(F.col("sim") >= least).select("a", "b"))
    many = sized.where(F.col("n") >= LARGE).select("key", "doc")
    found = found.union(stage(linked_blocks(many, many, samples, sets, least), "linked"))
    distance = 1 - least
    near = seen.where(F.col("sim") >= least).select(F.col("a").alias("p"), F.col("b").alias("x"), F.col("sim").alias("x_sim"))
    borderline = seen.where((F.col("sim") < least) & (F.col("sim") >= 1 - 2 * distance - 1e-9))
    of = stage(components(found), "components")
    node = lambda c: of.select(F.col("node").alias(f"n_{c}"), F.col("component").alias(f"c_{c}"))
    placed = borderline.join(node("a"), F.col("a") == F.col("n_a"), "left").join(node("b"), F.col("b") == F.col("n_b"), "left")
    apart = stage(placed.where(F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).select("a", "b", "sim"), "apart")
    # Whoever is in another class than a pivot near it is compared with the pivot's own that are near enough.
    farthest = apart.groupBy("a").agg((F.max("sim") + distance + 1e-9).alias("most"))
    own = near.join(farthest, F.col("p") == F.col("a")).where("x_sim <= most").select(F.col("a").alias("key"), F.col("x").alias("doc"))
    others = apart.select(F.col("a").alias("key"), F.col("b").alias("doc"))
    found = found.union(stage(linked_blocks(others, own, samples, sets, least), "linked"))
    return found


def classed(docs: DataFrame, doc_id="doc_id", text="text", least: float = SIMILARITY) -> DataFrame:
    """(doc_id, h, class_id) of every row of docs, h being the hash of its text; the class is named by its least id."""
    own = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"), F.xxhash64(docs[text]).alias("h"))
    sampler = docs.sparkSession.sparkContext.broadcast(Sampler(document_frequencies(own)))
    signed = stage(signatures(own, sampler), "signatures")
    # One row per sequence of words. It has a number of its own, which a repeated id cannot confuse, and the row that stands for it.
    row = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "h"))
    equal = signed.groupBy("f1", "f2").agg(F.min(row).alias("row"), F.first("bands").alias("bands"), F.first("samples").alias("samples"))
    copies = stage(equal.select("f1", "f2", "row.*", "bands", "samples", F.monotonically_increasing_id().alias("doc")), "copies")
    named = copies.where("doc_id is not null")
    samples = named.select("doc", "samples")
    banded = named.select("doc", F.posexplode("bands").alias("band", "value"))
    keyed = stage(banded.select(F.xxhash64("band", "value").alias("key"), "doc").distinct(), "bands")
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = stage(keyed.join(shared.select("key"), "key"), "members")
    wanted = members.select("doc").distinct().join(named.select("doc", "doc_id", "h"), "doc")
    # Rows that repeat an id are told apart by the hash of their text.
    texts = own.join(wanted.hint("merge"), ["doc_id", "h"]).select("doc", "text")
    sets = stage(vectors(texts, sampler), "sets")
    linked = links(members, samples, sets.dropDuplicates(["doc"]), least)
    of = stage(components(linked), "classes")
    ids = of.join(named.select("doc", "doc_id"), F.col("node") == F.col("doc"))
    names = stage(ids.groupBy("component").agg(F.min("doc_id").alias("class_id")), "names")
    placed = of.join(names, "component").select(F.col("node").alias("doc"), "class_id")
    told = copies.select("f1", "f2", "doc", "doc_id").join(placed, "doc", "left").select("f1", "f2", F.coalesce("class_id", "doc_id").alias("class_id"))
    return signed.select("doc_id", "h", "f1", "f2").join(told, ["f1", "f2"]).select("doc_id", "h", "class_id")


def classes(docs: DataFrame, doc_id="doc_id", text="text", least: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id) of every row of docs."""
    return classed(docs, doc_id, text, least).select("doc_id", "class_id")


def keep_one(docs: DataFrame, doc_id="doc_id", text="text", least: float = SIMILARITY) -> DataFrame:
    """docs without all but the document with the least id of each class; null ids stay.

    Of rows that repeat that id, those in the class stay.
    """
    kept = classed(docs, doc_id, text, least).where("doc_id = class_id").select("class_id", "h").distinct()
    stays = docs.join(kept, (docs[doc_id] == kept["class_id"]) & (F.xxhash64(docs[text]) == kept["h"]), "left_semi")
    return stays.union(docs.where(docs[doc_id].isNull()))
