"""Removes every byte covered by a string of `least` bytes that also starts anywhere else.

A suffix order by difference covers, over phrases instead of bytes. Phrases begin at anchors: the least
of any WINDOW neighbouring GRAM-byte hashes. Anchors depend on the text around them alone, so two
equal strings of `least` bytes have the same anchor in their first window, at the same place.

1. Whatever its first window shows, a string with anchor A holds the least - WINDOW + 1 bytes from A on,
   its context. Contexts are counted; only anchors whose context stands twice can matter.
2. The starts of an anchor, with the bytes their strings cover, form one stretch. Equal stretches repeat
   from end to end, so of any number of copies one stays to be looked at, and only if other stretches
   have the same context.
3. The phrases from these anchors on are put in suffix order (see suffix_order), and adjacent suffixes
   are compared: neighbours share the most phrases. That gives the last start that may repeat.
4. The strings at these starts are spelled out, and compared by 128-bit hashes: first, for every STEP
   starts, the string that all of theirs contain, then those whose shared string stands twice.

So rows are spelled out around the ends of repeats only. Texts are kept in a table bucketed by row,
which the five passes join without moving it.

Defined results: texts count as UTF-8 bytes, a null text is empty; texts shorter than `least` lose
nothing, and no match crosses documents. Rows are told apart even if ids repeat or are null: a document
that stands twice loses all its bytes. An empty table gives an empty result.
"""

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklake.llm.batches import Rolling, slices
from tracklake.llm.suffix_order import ranks, running
from tracklake.session import scope, scratch_path, stage

LEAST = 400
WINDOW, GRAM = 160, 16
STEP = 20
# A task holds some twenty numbers for each byte of a slice, which should stay in the processor's cache.
SLICE = 128 << 10


def leftmost_least(grams: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Place of the least hash, and of equal ones the first, in the window of each start.

    A window is the end of one block and the beginning of the next. Places are kept beside the hashes
    and not in their bits, so that they hold for texts of any length.
    """
    blocks = -(-len(grams) // WINDOW)
    padded = np.full(blocks * WINDOW, ~np.uint64(0))
    padded[: len(grams)] = grams
    shaped = padded.reshape(blocks, WINDOW)
    place = np.arange(blocks * WINDOW).reshape(blocks, WINDOW)
    least = np.minimum.accumulate(shaped, axis=1)
    new = np.ones(shaped.shape, bool)
    new[:, 1:] = shaped[:, 1:] < least[:, :-1]
    left = np.maximum.accumulate(np.where(new, place, 0), axis=1).ravel()
    # From the right an equal hash is a new least: it stands further left.
    least = np.minimum.accumulate(shaped[:, ::-1], axis=1)[:, ::-1]
    right = np.minimum.accumulate(np.where(shaped == least, place, blocks * WINDOW)[:, ::-1], axis=1)[:, ::-1].ravel()
    a, b = right[starts], left[starts + WINDOW - 1]
    return np.where(padded[b] < padded[a], b, a)


class Anchors:
    """Anchors of the texts of a slice, and which starts belong to each."""

    def __init__(self, hashes: "Hashes", data: np.ndarray, offsets: np.ndarray, least: int):
        self.data, self.offsets, self.least = data, offsets, least
        self.prefix = hashes.first.prefix(data)
        size = np.diff(offsets)
        windows = np.where(size >= least, size - (WINDOW + GRAM - 2), 0)
        starts = np.arange(windows.sum()) + np.repeat(offsets[:-1] - (np.cumsum(windows) - windows), windows)
        if not len(starts):
            self.at, self.doc, self.of_start, self.starts = (np.zeros(0, np.int64),) * 4
            return
        chosen = leftmost_least(hashes.first.grams(self.prefix, GRAM), starts)
        # The first least of a window never moves back, so equal ones stand together, by document.
        new = np.ones(len(chosen), bool)
        new[1:] = chosen[1:] != chosen[:-1]
        self.at = chosen[new]
        self.doc = np.searchsorted(offsets, self.at, "right") - 1
        # Starts of strings that end within their document, and the anchor of each.
        inside = starts + least <= np.repeat(offsets[1:], windows)
        self.starts, self.of_start = starts[inside], (np.cumsum(new) - 1)[inside]


class Hashes:
    def __init__(self):
        self.first, self.second = Rolling(41), Rolling(43)


def reach(least: int) -> tuple[int, int]:
    """Bytes after an anchor up to which a core reaches: for its first start, and for its last one."""
    last = least - (WINDOW + GRAM - 1)
    return last - (WINDOW - 1), last


def positive(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(1)).astype(np.int64)


def ends_of_cores(a: Anchors) -> tuple[np.ndarray, np.ndarray]:
    """For each anchor: the anchors that end its shortest and its longest core."""
    short, long = reach(a.least)
    limit = np.searchsorted(a.doc, a.doc, "right") - 1  # last anchor of the document
    low = np.minimum(np.searchsorted(a.at, a.at + short, "right") - 1, limit)
    high = np.minimum(np.searchsorted(a.at, a.at + long, "right") - 1, limit)
    return low, high


def context(hashes: Hashes, a: Anchors, which: np.ndarray) -> np.ndarray:
    """Hashes of the bytes that any string with such an anchor holds from the anchor on."""
    return positive(hashes.first.of(a.prefix, a.at[which], a.at[which] + a.least - WINDOW + 1))


def context_rows(texts: DataFrame, least: int) -> DataFrame:
    """(context, rid, i) of every anchor with starts; i counts the anchors of a row."""

    def run(batches):
        hashes = Hashes()
        for rows, data, offsets in slices(batches, 1, SLICE):
            a = Anchors(hashes, data, offsets, least)
            if len(a.at):
                has = np.flatnonzero(np.bincount(a.of_start, minlength=len(a.at)))
                i = has - np.searchsorted(a.doc, a.doc[has], "left")
                rid = rows.column(0).to_numpy()[a.doc[has]]
                columns = [pa.array(context(hashes, a, has)), pa.array(rid), pa.array(i.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["context", "rid", "i"])

    return texts.mapInArrow(run, "context long, rid long, i int")


def chosen_of(column, a: Anchors, begin: np.ndarray) -> np.ndarray:
    """Numbers within the slice of the anchors that a list column names by their place in the row."""
    lists = column.values.to_numpy()[column.offsets[0].as_py() : column.offsets[-1].as_py()]
    return np.sort(lists + np.repeat(begin[:-1], np.diff(column.offsets.to_numpy())))


def stretch_rows(texts: DataFrame, chosen: DataFrame, least: int) -> DataFrame:
    """(rid, i, low, high, context, u1, u2) of chosen anchors: first and last start, and the stretch's hash."""
    schema = "rid long, i int, low int, high int, context long, u1 long, u2 long"

    def run(batches):
        hashes = Hashes()
        for rows, data, offsets in slices(batches, 1, SLICE):
            a = Anchors(hashes, data, offsets, least)
            begin = np.searchsorted(a.doc, np.arange(len(offsets)), "left")
            picked = chosen_of(rows.column(2), a, begin)
            second = hashes.second.prefix(data)
            low = a.starts[np.searchsorted(a.of_start, picked, "left")]
            high = a.starts[np.searchsorted(a.of_start, picked, "right") - 1]
            u1 = hashes.first.of(a.prefix, low, high + least) + (a.at[picked] - low).astype(np.uint64)
            u2 = hashes.second.of(second, low, high + least)
            doc = a.doc[picked]
            here = offsets[doc]
            i32 = lambda x: pa.array(x.astype(np.int32))
            columns = [
                pa.array(rows.column(0).to_numpy()[doc]), i32(picked - begin[doc]), i32(low - here), i32(high - here),
                pa.array(context(hashes, a, picked)), pa.array(u1.view(np.int64)), pa.array(u2.view(np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in schema.split(", ")])

    return texts.join(chosen, "rid").select("rid", "text", "wanted").mapInArrow(run, schema)


ROW = "rid long, i int, run int, at int, sym long, len long, candidate boolean, cores array<long>, nexts array<int>"


def phrase_rows(texts: DataFrame, chosen: DataFrame, least: int) -> DataFrame:
    """A row for each chosen anchor, and for those that its cores reach.

    A core is a sequence of whole phrases from the anchor on that a string may hold. cores: their
    hashes, the shortest first; nexts: the anchors at which the second and later ones end; at: the anchor.
    """

    def run(batches):
        hashes = Hashes()
        for rows, data, offsets in slices(batches, 1, SLICE):
            a = Anchors(hashes, data, offsets, least)
            low, high = ends_of_cores(a)
            begin = np.searchsorted(a.doc, np.arange(len(offsets)), "left")
            picked = chosen_of(rows.column(2), a, begin)
            is_candidate = np.zeros(len(a.at), bool)
            is_candidate[picked] = True
            # Anchors between a candidate and the end of its longest core.
            cover = np.zeros(len(a.at) + 1, np.int64)
            np.add.at(cover, picked, 1)
            np.add.at(cover, high[picked] + 1, -1)
            used = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
            new_run = np.ones(len(used), bool)
            new_run[1:] = (used[1:] != used[:-1] + 1) | (a.doc[used[1:]] != a.doc[used[:-1]])
            doc = a.doc[used]
            run = used[np.maximum.accumulate(np.where(new_run, np.arange(len(used)), 0))] - begin[doc]
            after = np.minimum(used + 1, len(a.at) - 1)
            last = (used + 1 >= len(a.at)) | (a.doc[after] != doc)
            end = np.where(last, offsets[doc + 1], a.at[after])
            sym = positive(hashes.first.of(a.prefix, a.at[used], end))
            candidate = is_candidate[used]
            n_cores = np.where(candidate, high[used] - low[used] + 1, 0)
            at_core = np.concatenate([[0], np.cumsum(n_cores)])
            step = np.arange(at_core[-1]) - np.repeat(at_core[:-1], n_cores)
            core_end = np.repeat(low[used], n_cores) + step
            cores = positive(hashes.first.of(a.prefix, np.repeat(a.at[used], n_cores), a.at[core_end]))
            base = np.repeat(offsets[doc], n_cores)
            at_next = np.concatenate([[0], np.cumsum(np.maximum(n_cores - 1, 0))])
            i32 = lambda x: pa.array(x.astype(np.int32))
            columns = [
                pa.array(rows.column(0).to_numpy()[doc]), i32(used - begin[doc]), i32(run), i32(a.at[used] - offsets[doc]), pa.array(sym), pa.array(end - a.at[used]), pa.array(candidate),
                pa.ListArray.from_arrays(at_core.astype(np.int32), pa.array(cores)),
                pa.ListArray.from_arrays(at_next.astype(np.int32), i32((a.at[core_end] - base)[step > 0])),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in ROW.split(", ")])

    return texts.join(chosen, "rid").select("rid", "text", "wanted").mapInArrow(run, ROW)


def shared_cores(phrases: DataFrame, least: int) -> DataFrame:
    """(rid, i, shared): how many cores of each candidate, from the shortest, stand elsewhere too."""
    enough = reach(least)[1]
    places = phrases.select(
        F.xxhash64("rid", "run").alias("str"), F.lit(1).cast("long").alias("half"), (F.col("i") - F.col("run")).cast("long").alias("k"), "sym", "len", "rid", "i", "candidate", "cores"
    )
    order = ranks(places.select("str", "half", "k", "sym", "len"), enough)
    ranked = stage(places.where("candidate").join(order, ["str", "half", "k"]).select("rid", "i", "rank", "cores"), "suffixes")
    kinds = ranked.groupBy("rank").agg(F.count(F.lit(1)).alias("n"), F.max_by("cores", F.size("cores")).alias("cores"), F.min(F.size("cores")).alias("least"))
    places = running(ranked.select("rank", F.lit(1).alias("one")).distinct(), ["rank"], ["one"]).select("rank", F.col("before_one").alias("place"))
    kinds = stage(kinds.join(places, "rank"), "kinds")
    beside = kinds.select((F.col("place") + 1).alias("place"), F.col("cores").alias("other"))
    beyond = kinds.select((F.col("place") - 1).alias("place"), F.col("cores").alias("other"))
    common = lambda x, y: F.aggregate(  # noqa: E731  length of the common beginning
        F.zip_with(x, y, lambda p, q: F.coalesce((p == q).cast("int"), F.lit(0))), F.struct(F.lit(0).alias("n"), F.lit(1).alias("on")),
        lambda s, same: F.struct((s["n"] + s["on"] * same).alias("n"), (s["on"] * same).alias("on")), lambda s: s["n"],
    )
    pairs = kinds.join(beside.union(beyond), "place").groupBy("rank").agg(F.max(common(F.col("cores"), F.col("other"))).alias("with_next"))
    known = kinds.select("rank", "n").join(pairs, "rank", "left")
    joined = ranked.join(known, "rank")
    whole = F.size("cores")
    # The shortest core is part of the context, which is known to stand twice.
    shared = F.when(F.col("n") > 1, whole).otherwise(F.greatest(F.lit(1), F.least(F.coalesce("with_next", F.lit(0)), whole)))
    return joined.select("rid", "i", shared.alias("shared"))


def spelled(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(h1, h2, rid, start, low, top): hashes of strings of this length at the places of each range.

    wanted: (rid, low, top, first, last, step); places go from first to last by step.
    """
    schema = "h1 long, h2 long, rid long, start int, low int, top int"

    def run(batches):
        hashes = Hashes()
        for rows, data, offsets in slices(batches, 1, SLICE):
            first, second = hashes.first.prefix(data), hashes.second.prefix(data)
            lists = rows.column(2)
            sizes = np.diff(lists.offsets.to_numpy())
            a, b = lists.offsets[0].as_py(), lists.offsets[-1].as_py()
            low, top, start, last, step = (lists.values.field(k).to_numpy()[a:b].astype(np.int64) for k in range(5))
            doc = np.repeat(np.arange(len(sizes)), sizes)
            n = (last - start) // step + 1
            for p in range(0, len(n), 1 << 15):
                part = slice(p, p + (1 << 15))
                m = n[part]
                which = np.repeat(np.arange(len(n))[part], m)
                place = (np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)) * step[which] + start[which]
                at = place + offsets[doc[which]]
                i32 = lambda x: pa.array(x.astype(np.int32))
                columns = [
                    pa.array(hashes.first.of(first, at, at + length).view(np.int64)), pa.array(hashes.second.of(second, at, at + length).view(np.int64)),
                    pa.array(rows.column(0).to_numpy()[doc[which]]), i32(place), i32(low[which]), i32(top[which]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in schema.split(", ")])

    ranges = wanted.groupBy("rid").agg(F.collect_list(F.struct("low", "top", "first", "last", "step")).alias("ranges"))
    return texts.join(ranges, "rid").select("rid", "text", "ranges").mapInArrow(run, schema)


def standing_twice(rows: DataFrame) -> DataFrame:
    found = rows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1", "h2")
    return rows.join(found, ["h1", "h2"])


def repeated_starts(texts: DataFrame, least: int) -> DataFrame:
    """(rid, low, high): ranges of starts whose string of `least` bytes stands elsewhere too."""
    spark = texts.sparkSession
    with scope(spark) as keep:
        contexts = stage(context_rows(texts.select("rid", "text"), least), "contexts")
        twice = contexts.groupBy("context").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("context")
        chosen = contexts.join(twice, "context").groupBy("rid").agg(F.collect_list("i").alias("wanted"))
        stretches = keep(stage(stretch_rows(texts, chosen, least), "stretches"))
    with scope(spark) as keep:
        kinds = stretches.groupBy("context", "u1", "u2").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("rid", "i", "low", "high")).alias("one")
        )
        kinds = stage(kinds, "stretch-kinds")
        again = kinds.where("n > 1").select("context", "u1", "u2")
        whole = keep(stage(stretches.join(again, ["context", "u1", "u2"]).select("rid", "low", "high"), "whole-stretches"))
        mixed = kinds.groupBy("context").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("context")
        single = keep(stage(kinds.join(mixed, "context").select("one.*"), "mixed-stretches"))
    with scope(spark) as keep:
        phrases = stage(phrase_rows(texts, single.groupBy("rid").agg(F.collect_list("i").alias("wanted")), least), "phrases")
        known = phrases.where("candidate").select("rid", "i", "at", "nexts").join(shared_cores(phrases, least), ["rid", "i"])
        # The next core that is not shared ends at an anchor that the string of a start must not hold.
        stop = F.when(F.col("shared") <= F.size("nexts"), F.get("nexts", F.col("shared") - 1) - reach(least)[1] - 1)
        tops = known.select("rid", "i", "at", stop.alias("stop"))
        ranges = keep(stage(single.join(tops, ["rid", "i"]).withColumn("top", F.least("high", "stop")).where("top >= low"), "ranges"))
    with scope(spark) as keep:
        # Starts in the same STEP places before an anchor share a string; where that stands once, none of them repeats.
        block = lambda c: F.col("at") - F.floor((F.col("at") - F.col(c)) / STEP) * STEP
        by_block = ranges.select("rid", "low", "top", block("low").alias("first"), block("top").alias("last"), F.lit(STEP).alias("step"))
        rough = keep(stage(standing_twice(stage(spelled(texts, by_block, least - STEP + 1), "blocks-of-starts")), "rough-starts"))
    with scope(spark) as keep:
        fine = rough.select("rid", F.greatest("low", F.col("start") - STEP + 1).alias("low"), F.least("top", "start").alias("top"))
        by_start = fine.select("rid", "low", "top", F.col("low").alias("first"), F.col("top").alias("last"), F.lit(1).alias("step"))
        rows = stage(spelled(texts, by_start, least).select("h1", "h2", "rid", "start"), "spelled")
        single = standing_twice(rows).select("rid", F.col("start").alias("low"), F.col("start").alias("high"))
        return keep(stage(whole.union(single), "starts"))


def keep_rest(texts: DataFrame, starts: DataFrame, least: int) -> DataFrame:
    """doc_id, text (what is left, as bytes), n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    lists = starts.groupBy("rid").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))
    joined = texts.join(lists, "rid", "left").select("rid", "text", "ranges", "doc_id")
    schema = "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

    def run(batches):
        for rows, data, offsets in slices(batches, 1, SLICE):
            out = []
            for j in range(rows.num_rows):
                text = data[offsets[j] : offsets[j + 1]]
                ranges = rows.column(2)[j]
                spans, removed = 0, 0
                if ranges.is_valid and len(ranges):
                    lo, hi = (ranges.values.field(k).to_numpy().astype(np.int64) for k in (0, 1))
                    edge = np.zeros(len(text) + 1, np.int64)
                    np.add.at(edge, lo, 1)
                    np.add.at(edge, hi + least, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    removed, spans = int(gone.sum()), int((gone & ~np.concatenate([[False], gone[:-1]])).sum())
                    kept = text[~gone].tobytes()
                else:
                    kept = text.tobytes()
                out.append((kept, len(text), removed, spans, hashlib.sha256(kept).hexdigest()))
            columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([rows.column(3), *columns], names=[x.split()[0] for x in schema.split(", ")])

    return joined.mapInArrow(run, schema)


def bucketed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(rid, doc_id, text) in a table bucketed by rid, a number for each row."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = docs.select(F.monotonically_increasing_id().alias("rid"), docs[doc_id].cast("long").alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text"))
    name = f"texts_{uuid.uuid4().hex}"
    own.repartition(n, "rid").write.bucketBy(n, "rid").sortBy("rid").option("path", scratch_path(spark, "texts")).saveAsTable(name)
    table = spark.table(name)
    # The frame knows its files and buckets by now; the catalog forgets the name, and the files stay.
    spark.sql(f"drop table {name}")
    return table


def without_repeats(docs: DataFrame, doc_id="doc_id", text="text", least: int = LEAST) -> DataFrame:
    """A row per row of docs: what is left of its text, and what was removed."""
    if least < 2 * WINDOW + 2 * GRAM:
        raise ValueError("strings must hold several windows")
    texts = bucketed(docs, doc_id, text)
    with scope(docs.sparkSession) as keep:
        starts = keep(repeated_starts(texts, least))
    return keep_rest(texts, starts, least)
