"""Language identification by n-gram filters whose answer is a set of languages.

Training counts, over all training documents, the four-byte windows of each language and keeps for
a language those with a rate of at least `LEAST_RATE`, and of at least `SHARE` of the rate they
have in any language: a foreign passage in a document does not make its windows native. By the
first bound a language keeps at most 1 / LEAST_RATE windows, so the collected model is bounded
whatever the corpus. The windows go into one Bloom filter with a slice of bits per language: each slot
holds a mask of languages, and the AND of a window's slots is the set of languages that have it.

A document gets, per language, the number of its windows in that language's slice, corrected for the
slice's rate of false positives, over all its windows. The largest wins; the score is that share.

Windows are taken from the text with ASCII letters in lower case and other ASCII characters as spaces,
and only where the second byte is no space.

Defined results: a null text, or one without letters, is `und` with score 0, as is everything if no
training row has a language. Equal shares go to the language with more training windows, then to the
lesser name. A null id is folded as an empty text.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracklake.llm.batches import mix64, slices
from tracklake.llm.tables import fold
from tracklake.session import stage

LEAST_RATE = 2e-5
SHARE = 0.3
SLOTS = 1 << 20
HASHES = 3
UNDETERMINED = "und"
# Windows a task holds before it hands on what it has counted.
HELD = 1 << 20

PLAIN = np.arange(256, dtype=np.uint8)
PLAIN[:128] = 32
PLAIN[97:123] = np.arange(97, 123)
PLAIN[65:91] = np.arange(97, 123)


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Four-byte windows as numbers, and where each document's begin."""
    n = len(offsets) - 1
    padded = np.full(len(data) + 3 * n, 32, np.uint8)
    shift = np.repeat(3 * np.arange(n) + 1, np.diff(offsets))
    padded[np.arange(len(data)) + shift] = PLAIN[data]
    starts = offsets + 3 * np.arange(n + 1)
    x = padded.astype(np.uint32)
    code = x[:-3] | x[1:-2] << 8 | x[2:-1] << 16 | x[3:] << 24
    good = padded[1:-2] != 32
    # A window that would reach into the next document starts in the last two bytes of padding.
    counts = np.concatenate([[0], np.cumsum(good)])
    return code[good], counts[np.minimum(starts, len(good))]


def count_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of a task's documents."""
    names: dict[str, int] = {}
    codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def out():
        order = list(names)
        langs = pa.array([order[i] for i in codes >> 32], pa.string())
        return pa.record_batch([langs, pa.array(codes & 0xFFFFFFFF), pa.array(counts)], ["lang", "gram", "n"])

    for rows, data, offsets in slices(batches, 0):
        for lang in rows.column(1).unique().to_pylist():
            names.setdefault(lang, len(names))
        which = np.array([names[x] for x in rows.column(1).to_pylist()], np.int64)
        code, at = windows(data, offsets)
        got, n = np.unique(code.astype(np.int64) | np.repeat(which, np.diff(at)) << 32, return_counts=True)
        both, where = np.unique(np.concatenate([codes, got]), return_inverse=True)
        counts = np.bincount(where, np.concatenate([counts, n]), len(both)).astype(np.int64)
        codes = both
        if len(codes) > HELD:
            yield out()
            names, codes, counts = {}, codes[:0], counts[:0]
    if len(codes):
        yield out()


class Filters:
    """The bit-sliced filter: languages, slots, and false-positive rates."""

    def __init__(self, rows: list, totals: dict[str, int]):
        self.languages = sorted(totals, key=lambda x: (-totals[x], x))
        place = {x: i for i, x in enumerate(self.languages)}
        words = max(1, -(-len(self.languages) // 64))
        self.slots = np.zeros((words, SLOTS), np.uint64)
        grams = np.array([g for g, _ in rows], np.uint64)
        langs = np.array([place[x] for _, x in rows], np.int64)
        for where in self.places(grams) if len(rows) else ():
            np.bitwise_or.at(self.slots, (langs // 64, where), np.uint64(1) << (langs % 64).astype(np.uint64))
        fill = [np.mean(self.slots[i // 64] >> np.uint64(i % 64) & np.uint64(1)) for i in range(len(place))]
        self.false = np.array(fill) ** HASHES
        if len(place) <= 8:  # a table that fits in the processor's cache
            self.slots = self.slots.astype(np.uint8)

    @staticmethod
    def places(grams: np.ndarray) -> list[np.ndarray]:
        h = mix64(grams.astype(np.uint64) + np.uint64(1))
        bits = SLOTS.bit_length() - 1
        return [((h >> np.uint64(i * bits)) & np.uint64(SLOTS - 1)).astype(np.int64) for i in range(HASHES)]

    def shares(self, grams: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Corrected share of each document's windows in each language: documents x languages."""
        found = np.zeros((len(at) - 1, len(self.languages)))
        n = np.maximum(np.diff(at), 1)
        where = self.places(grams)
        for word, slots in enumerate(self.slots):
            mask = slots[where[0]] & slots[where[1]] & slots[where[2]]
            for i in range(word * 64, min(word * 64 + 64, len(self.languages))):
                hits = np.concatenate([[0], np.cumsum(mask >> mask.dtype.type(i % 64) & mask.dtype.type(1), dtype=np.int64)])
                share = np.diff(hits[at]) / n
                found[:, i] = np.clip((share - self.false[i]) / (1 - self.false[i]), 0, 1)
        return found


def learn(docs: DataFrame, text="text", lang="lang") -> Filters:
    """Filters from the rows of docs that have a language and a text."""
    own = docs.select(docs[text].alias("text"), docs[lang].cast("string").alias("lang"))
    counted = own.where("lang is not null and text is not null").mapInArrow(
        count_windows, "lang string, gram long, n long"
    )
    grams = stage(counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    of_gram = Window.partitionBy("gram")
    total = grams.groupBy("lang").agg(F.sum("n").alias("total"))
    # One small row per language.
    totals = {r["lang"]: r["total"] for r in total.collect()}
    if not totals:
        return Filters([], {})
    rate = F.col("n") / F.element_at(F.create_map(*(F.lit(v) for kv in totals.items() for v in kv)), F.col("lang"))
    common = grams.withColumn("rate", rate).where(F.col("rate") >= LEAST_RATE)
    kept = common.withColumn("best", F.max("rate").over(of_gram)).where(F.col("rate") >= SHARE * F.col("best"))
    return Filters([(r["gram"], r["lang"]) for r in kept.select("gram", "lang").collect()], totals)


def has_letter(data: np.ndarray) -> bool:
    return any(c.isalpha() for c in data.tobytes().decode("utf-8", "replace"))


def predict(docs: DataFrame, filters: Filters, text="text", name="lang_pred", score="score") -> DataFrame:
    """docs with the predicted language and its score; columns with these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    kept = [c for c in docs.columns if c not in (name, score)]
    schema = docs.select(kept).withColumn(name, F.lit("")).withColumn(score, F.lit(0.0)).schema
    place = kept.index(text)

    def judge(batches):
        model = shared.value
        ascii_letter = PLAIN != 32
        ascii_letter[128:] = False
        for rows, data, offsets in slices(batches, place):
            code, at = windows(data, offsets)
            if model.languages:
                shares = model.shares(code, at)
                best = shares.argmax(1)
                scores = shares[np.arange(len(best)), best]
                langs = np.array([*model.languages], object)[best]
            else:
                scores, langs = np.zeros(rows.num_rows), np.full(rows.num_rows, UNDETERMINED, object)
            letters = np.concatenate([[0], np.cumsum(ascii_letter[data])])[offsets]
            for i in np.flatnonzero(np.diff(letters) == 0):
                if not has_letter(data[offsets[i] : offsets[i + 1]]):
                    langs[i], scores[i] = UNDETERMINED, 0.0
            columns = [*rows.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*rows.schema.names, name, score])

    return docs.select(kept).mapInArrow(judge, schema)


def identify(docs: DataFrame, doc_id="doc_id", text="text", lang="lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score: learned from the rows that are not held out."""
    own = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"), docs[lang].alias("lang"))
    held = fold("doc_id") == 0
    filters = learn(own.where(~held))
    return predict(own.select("doc_id", held.alias("held_out"), "text"), filters).drop("text")
