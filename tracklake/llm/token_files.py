"""Token ids in binary files, compressed by a Re-Pair grammar.

Documents are spread by ranges of their id and sorted, so that shards follow each other in the order
of ids. A task encodes its documents and writes blocks of whole documents. In each block, pairs of
neighbouring ids are replaced by new symbols, round after round, until no pair stands twice; the block stores the rules
(pairs) and the length of each symbol's expansion, with which a reader finds any token without decoding
what stands before it. Pairs never reach over the end of a document.

Encoding looks at each distinct stretch between spaces once per worker: the tokenizer splits before a
space that is followed by a visible character in any case, so ids of stretches put together are the ids of
the whole text. Stretches are told apart by 64-bit hashes within a bounded table.

The format is a row per block, kept in Parquet files that Spark writes and commits, so that a lost task
leaves no partial block: shard, block, first (tokens of the shard before the block), doc_ids, starts (first
symbol of each document), lengths (tokens of each document), rules, expanded, symbols.

Defined results: a null text is empty and has only the end id. Rows with equal or null ids each keep
their place (null ids first; equal ids by hash of text). An empty table gives no blocks.
"""

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracklake.llm.batches import Remembered, gather, mix64, slices
from tracklake.session import stage

TABLE = 1 << 20  # distinct stretches a worker remembers
BLOCK_TOKENS = 1 << 19
LEAST = 2  # occurrences in a block that make a pair frequent
SLOT_BITS = 18
ODD = 0x9E3779B97F4A7C15
# First bytes of characters beyond ASCII that may be white space.
DOUBTFUL = np.zeros(256, bool)
DOUBTFUL[[0xC2, 0xE1, 0xE2, 0xE3]] = True
SCHEMA = (
    "shard int, block int, first long, doc_ids binary, null_ids binary, starts binary, lengths binary, "
    "rules binary, expanded binary, symbols binary"
)


class Encoder:
    """Ids of many texts, each distinct stretch encoded once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values()) + 1
        self.bytes_of = np.zeros(self.size, np.int64)
        added = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        for token, i in vocabulary.items():  # byte-level tokens have a character per byte
            self.bytes_of[i] = len(token.encode()) if token in added else len(token)
        self.memory = Remembered(self.solve, TABLE)

    def plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def solve(self, data, starts, ends):
        """Ids of stretches that all begin with a space before a visible character."""
        bounds = np.cumsum(ends - starts)
        text = gather(data, starts, ends - starts)[0].tobytes().decode()
        ids = np.array(self.plain([text])[0], np.uint32)
        reached = np.cumsum(self.bytes_of[ids])
        ends = np.searchsorted(reached, bounds) + 1
        if not np.array_equal(reached[ends - 1], bounds):
            raise ValueError("the tokenizer does not keep the bytes of a text")
        return ids, np.diff(ends, prepend=0)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents one after the other, and where each begins."""
        n = len(offsets) - 1
        filled = np.diff(offsets) > 0
        follows = np.zeros(len(data), bool)
        follows[:-1] = (data[1:] > 32) & ~DOUBTFUL[data[1:]]
        follows[offsets[1:][filled] - 1] = False
        cut = follows & (data == 32)
        first = offsets[:-1][filled]
        cut[first] = False
        marks = cut.copy()
        marks[first] = True
        starts = np.flatnonzero(marks)
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        inner = cut[starts] if len(starts) else np.zeros(0, bool)
        at, length = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        at[inner], length[inner] = self.memory.look_up(data, starts[inner], ends[inner])
        # The first stretch of a document may begin with any character, and is encoded by itself.
        heads = [data[a:b].tobytes().decode() for a, b in zip(starts[~inner], ends[~inner])]
        own = [np.array(x, np.uint32) for x in self.plain(heads)]
        sizes = np.array([len(x) for x in own], np.int64)
        at[~inner], length[~inner] = len(self.memory.pool) + np.cumsum(sizes) - sizes, sizes
        ids, done = gather(np.concatenate([self.memory.pool, *own]), at, length)
        return ids, done[np.searchsorted(starts, offsets)]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per worker process, with what it has learned."""
    return Encoder(path)


def without_overlaps(weight: np.ndarray) -> np.ndarray:
    """Which places with a weight to take, no two of them neighbours: heavier ones first, then the first."""
    taken = np.zeros(len(weight), bool)
    at = np.flatnonzero(weight > 0)
    weight = weight[at]
    while len(at):
        beside = at[1:] == at[:-1] + 1
        later = weight[1:] > weight[:-1]
        now = np.ones(len(at), bool)
        now[1:] &= ~beside | later
        now[:-1] &= ~beside | ~later
        taken[at[now]] = True
        gone = now.copy()
        gone[1:] |= now[:-1] & beside
        gone[:-1] |= now[1:] & beside
        at, weight = at[~gone], weight[~gone]
    return taken


def places_of(found: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values are in found, whose numbers are distinct, and at which place of it.

    A table by hash, small enough for a cache; of several numbers in a slot one stays, and the others go to the next table.
    """
    rows, left, slots = [], np.arange(len(found)), np.uint64(64 - SLOT_BITS)
    rest, here, odd = None, values, ODD
    while len(left) and len(here):
        table, full = np.zeros(1 << SLOT_BITS, np.int32), np.zeros(1 << SLOT_BITS, bool)
        own = (found[left] * np.uint64(odd)) >> slots
        table[own] = left
        away = table[own] != left
        full[own[away]] = True
        slot = (here * np.uint64(odd)) >> slots
        place = table[slot]
        hit = np.flatnonzero(found[place] == here)
        rows.append((hit if rest is None else rest[hit], place[hit]))
        more = np.flatnonzero(full[slot])
        rest, here, left = more if rest is None else rest[more], here[more], left[away]
        odd = odd * ODD % (1 << 64)
    return tuple(np.concatenate(x) for x in zip(*rows)) if rows else (left, left)


def alternating(at: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Which of the pairs at these places do not reach into the one before: in a run of one symbol, every other one."""
    again = np.zeros(len(at), bool)
    again[1:] = (at[1:] == at[:-1] + 1) & (pairs[1:] == pairs[:-1])
    if not again.any():
        return ~again
    place = np.arange(len(at))
    return (place - np.maximum.accumulate(np.where(again, 0, place))) % 2 == 0


def compress(ids: np.ndarray, ends: np.ndarray, base: int, rounds: int | None = None, least: int = LEAST):
    """Symbols, where each document's begin, rules (pairs), and the length of each rule's expansion.

    ends: positions after the last id of each document. Without `rounds`, no pair is left that stands `least` times within
    documents. A round replaces many pairs at once, where they are heavier than what they overlap; the heaviest is
    replaced wherever it stands. Only pairs that were frequent in the last round or hold a new symbol are counted again.
    """
    symbols = ids.astype(np.uint32)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    last = np.zeros(len(symbols), bool)
    last[ends - 1] = True
    rules, expanded, n_rules = [np.zeros((0, 2), np.uint32)], np.ones(base, np.uint32), 0
    live, done = ~last, 0
    while rounds is None or done < rounds:
        done += 1
        places = np.flatnonzero(live)
        if len(places) < 2:
            break
        pairs = symbols[places].astype(np.uint64) << np.uint64(32) | symbols[places + 1]
        free = alternating(places, pairs)
        order = np.argsort(pairs)
        pairs = pairs[order]
        first = np.ones(len(pairs), bool)
        first[1:] = pairs[1:] != pairs[:-1]
        found = pairs[first]
        which = np.empty(len(pairs), np.int32)
        which[order] = np.cumsum(first, dtype=np.int32) - 1
        del pairs, order, first
        counts = np.bincount(which[free], minlength=len(found))
        often = counts >= max(least, 2)
        if not often.any():
            break
        held = often[which]
        live[places[~held]] = False
        places, which, free = places[held], which[held], free[held]
        # Of pairs with one count, the same goes first everywhere.
        rank = counts << 32 | (mix64(found) >> np.uint64(32)).astype(np.int64)
        weight = np.zeros(len(symbols), np.int64)
        weight[places[free]] = rank[which[free]]
        taken = without_overlaps(weight)[places]
        number = which[taken]
        uses = np.bincount(number, minlength=len(found))
        best = np.flatnonzero(uses > 1)
        chosen = uses[number] > 1
        at, number = places[taken][chosen], number[chosen]
        if not len(best):  # only if hashes are equal
            best = np.array([np.argmax(counts)])
            at = places[free & (which == best[0])]
            number = np.full(len(at), best[0])
        named = np.zeros(len(found), np.uint32)
        named[best] = base + n_rules + np.arange(len(best))
        left, right = (found[best] >> np.uint64(32)).astype(np.uint32), found[best].astype(np.uint32)
        rules.append(np.stack([left, right], 1))
        expanded = np.concatenate([expanded, expanded[left] + expanded[right]])
        n_rules += len(best)
        symbols[at] = named[number]
        last[at] = last[at + 1]
        live[at] = True
        live[np.maximum(at - 1, 0)] = True
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        starts = (np.cumsum(keep) - keep)[starts]
        symbols, last, live = symbols[keep], last[keep], live[keep]
        live &= ~last
    return symbols, starts, np.concatenate(rules), expanded[base:]


def expand(symbols: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """Ids of symbols. A rule is taken apart at its own place; what is an id already is not touched again."""
    pairs = rules.astype(np.int64)
    size = np.ones(base + len(rules), np.int64)
    while True:  # as often as rules are nested
        grown = size[pairs[:, 0]] + size[pairs[:, 1]]
        if np.array_equal(grown, size[base:]):
            break
        size[base:] = grown
    left = symbols.astype(np.int64)
    at = np.cumsum(size[left]) - size[left]
    out = np.empty(int(size[left].sum()), np.uint32)
    while True:
        is_rule = left >= base
        out[at[~is_rule]] = left[~is_rule]
        if not is_rule.any():
            return out
        at, pair = at[is_rule], pairs[left[is_rule] - base]
        left, at = np.concatenate([pair[:, 0], pair[:, 1]]), np.concatenate([at, at + size[pair[:, 0]]])


def token_range(symbols, rules, expanded, base: int, first: int, last: int) -> np.ndarray:
    """Ids first to last of a run of symbols; only the symbols that hold them are expanded."""
    size = np.where(symbols < base, 1, expanded[np.maximum(symbols.astype(np.int64) - base, 0)] if len(expanded) else 1)
    ends = np.cumsum(size)
    a, b = np.searchsorted(ends, first, "right"), np.searchsorted(ends, last, "left") + 1
    skipped = ends[a] - size[a] if a < len(ends) else 0
    return expand(symbols[a:b], rules, base)[first - skipped : last - skipped]


def width(base: int, n_rules: int):
    """The kind of numbers that holds all symbols of a block."""
    return np.uint16 if base + n_rules <= 1 << 16 else np.uint32


def write(docs: DataFrame, tokenizer: str, end_id: int, doc_id="doc_id", text="text") -> DataFrame:
    """Encodes docs, writes the blocks, and returns them as read back."""
    own = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    ranged = own.repartitionByRange(*order).sortWithinPartitions(*order)

    def shards(batches):
        from pyspark import TaskContext

        coder = encoder(tokenizer)
        shard, block, first = TaskContext.get().partitionId(), 0, 0
        held, sizes, doc_ids = [], [], []

        def out():
            lengths = np.concatenate(sizes)
            symbols, starts, rules, expanded = compress(np.concatenate(held), np.cumsum(lengths), coder.size)
            ids, wide = pa.concat_arrays(doc_ids), width(coder.size, len(rules))
            columns = [
                [shard], [block], [first], [ids.fill_null(0).to_numpy().tobytes()],
                [np.asarray(ids.is_null()).astype(np.uint8).tobytes()], [starts.astype(np.uint32).tobytes()],
                [lengths.astype(np.uint32).tobytes()], [rules.astype(wide).tobytes()], [expanded.tobytes()],
                [symbols.astype(wide).tobytes()],
            ]
            types = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 7]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=[x.split()[0] for x in SCHEMA.split(", ")]
            )

        for rows, data, offsets in slices(batches, 1):
            ids, at = coder.encode(data, offsets)
            n = rows.num_rows
            with_end = np.empty(len(ids) + n, np.uint32)
            with_end[at[1:] + np.arange(n)] = end_id
            inner = np.ones(len(with_end), bool)
            inner[at[1:] + np.arange(n)] = False
            with_end[inner] = ids
            held.append(with_end)
            sizes.append(np.diff(at) + 1)
            doc_ids.append(rows.column(0))
            if sum(map(len, held)) >= BLOCK_TOKENS:
                yield out()
                block, first = block + 1, first + sum(map(len, held))
                held, sizes, doc_ids = [], [], []
        if held:
            yield out()

    return stage(ranged.mapInArrow(shards, SCHEMA), "token-files")


def documents(blocks: DataFrame, base: int) -> DataFrame:
    """shard, doc_id, place within the shard, n_tokens and ids_crc32 of every document, from the blocks."""
    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.frombuffer(row["lengths"], np.uint32).astype(np.int64)
                wide = width(base, len(row["expanded"]) // 4)
                symbols = np.frombuffer(row["symbols"], wide).astype(np.uint32)
                rules = np.frombuffer(row["rules"], wide).astype(np.uint32).reshape(-1, 2)
                ids = expand(symbols, rules, base).astype("<u4")
                ends = np.cumsum(lengths)
                whole = memoryview(ids.tobytes())
                crc = [zlib.crc32(whole[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
                nulls = np.frombuffer(row["null_ids"], np.uint8).astype(bool)
                columns = [
                    pa.array(np.full(len(lengths), row["shard"], np.int32)),
                    pa.array(np.frombuffer(row["doc_ids"], np.int64), mask=nulls),
                    pa.array(row["first"] + ends - lengths), pa.array(lengths), pa.array(crc, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["shard", "doc_id", "place", "n_tokens", "ids_crc32"])

    return blocks.mapInArrow(read, "shard int, doc_id long, place long, n_tokens long, ids_crc32 long")


def starts(docs: DataFrame) -> DataFrame:
    """The place within the shard becomes the place among all tokens."""
    docs = stage(docs, "tokens")
    totals = docs.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    # A row per shard, which are as many as the tasks that wrote them.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = totals.select(F.col("shard").alias("of"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    joined = docs.join(F.broadcast(placed), F.col("shard") == F.col("of"))
    return joined.select("doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")
