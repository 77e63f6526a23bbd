"""Encoding and decoding with a SentencePiece vocabulary: best paths by max-plus algebra.

A text becomes the sequence of pieces with the largest sum of scores, as SentencePiece's unigram
model does it: a space is put in front, spaces are shown as U+2581, a character that is no piece costs
ten more than the worst piece and is written as byte pieces. Scores are the model file's own. Sums are
exact; of equal paths, the one with the longer last piece is taken, from the end backwards.

No piece has a space after another character, so a path has a cut before every space that follows
one. Each distinct stretch between such cuts is solved once per worker, many side by side.

A document of more than `chunk` characters is split, wherever the split falls. A path may be on any of the
`reach` last characters before a split when it last ends a piece, so a chunk is a matrix of reach x
reach: the best score from each such place before it to each such place at its end. A chunk with a
certain cut inside is an outer sum of two vectors, one without is solved once for each way in. The
matrices of neighbours are multiplied, GROUP at a time, in rounds, until GROUP or fewer are left of a document. From the
last round back to the first, each group then learns where the best path enters and leaves it, and finds
the place of each split inside. No task holds more than GROUP matrices at once, and rounds grow with the logarithm of the
longest document. With these cuts known, chunks are encoded independently of each other. Where a word lies
across splits and has several best paths, its path is one of them.

Defined results: a null or empty text has no pieces. U+2581 in a text reads back as a space, as with
the library. Rows with equal or null ids keep apart. An empty table gives an empty result.
"""

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklake.llm.batches import SLICE_BYTES, Remembered, Rolling, gather, mix64, slices, text_bytes
from tracklake.session import stage

CHUNK = 16_384
TABLE = 1 << 19
BLANK = "▁"
UNKNOWN_COST = 10.0
PRIME = (1 << 31) - 1
LANES = 1 << 18  # lanes times length solved at once
GROUP = 64  # neighbours combined at once


class Vocabulary:
    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = len(model)
        names = [model.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))]
        self.scores = {names[i]: (i, model.get_score(i)) for i in plain}
        self.byte_ids = np.zeros(256, np.uint32)
        self.shown = [b""] * n
        for i in range(n):
            if model.is_byte(i):
                self.byte_ids[int(names[i][3:5], 16)] = i
                self.shown[i] = bytes([int(names[i][3:5], 16)])
        for i in plain:
            self.shown[i] = names[i].replace(BLANK, " ").encode()
        if any(BLANK in p.lstrip(BLANK) for p in self.scores):
            raise ValueError("pieces with a space after another character are not supported")
        self.reach = max(map(len, self.scores))
        self.unknown = min(s for _, s in self.scores.values()) - UNKNOWN_COST
        lengths = np.array([len(x) for x in self.shown], np.int64)
        self.bytes_at, self.bytes_len = np.cumsum(lengths) - lengths, lengths
        self.bytes_pool = np.frombuffer(b"".join(self.shown), np.uint8)
        self.rolling = Rolling(5)
        self.tables = {}
        for size in range(1, self.reach + 1):
            own = [p for p in self.scores if len(p) == size]
            if own:
                codes = np.frombuffer("".join(own).encode("utf-32-le"), np.uint32)
                ends = np.arange(1, len(own) + 1) * size
                hashes = self.hashes(self.prefix(codes), ends, size)
                order = np.argsort(hashes)
                ids, scores = (np.array([self.scores[p][k] for p in own])[order] for k in (0, 1))
                there = np.zeros(1 << 20, bool)
                there[(hashes >> np.uint64(44)).astype(np.int64)] = True
                self.tables[size] = (hashes[order], ids.astype(np.int64), scores, there)
        self.memory = Remembered(self.solve, TABLE)

    def prefix(self, codes: np.ndarray) -> np.ndarray:
        self.rolling._grow(len(codes) + 1)
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(mix64(codes.astype(np.uint64) + np.uint64(77)) * self.rolling.powers[: len(codes)], out=sums[1:])
        return sums

    def hashes(self, prefix: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
        return (prefix[ends] - prefix[ends - size]) * self.rolling.inverse[ends - size] * np.uint64(0x9E3779B97F4A7C15)

    def edges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score and id of the piece of each size (row size - 1) that ends at each character, -inf if none."""
        n = len(codes)
        score = np.full((self.reach, n), -np.inf)
        number = np.zeros((self.reach, n), np.int32)
        score[0] = self.unknown
        number[0] = -1
        prefix = self.prefix(codes)
        for size, (known, ids, scores, there) in self.tables.items():
            if size > n:
                break
            h = self.hashes(prefix, np.arange(size, n + 1), size)
            maybe = np.flatnonzero(there[(h >> np.uint64(44)).astype(np.int64)])
            place = np.minimum(np.searchsorted(known, h[maybe]), len(known) - 1)
            real = known[place] == h[maybe]
            at = maybe[real] + size - 1
            score[size - 1, at], number[size - 1, at] = scores[place[real]], ids[place[real]]
        return score, number

    def paths(self, score: np.ndarray, starts: np.ndarray, lengths: np.ndarray, first: np.ndarray):
        """Best sums and last sizes at each place of many stretches side by side.

        first: best sums at the places before and at the start, (places, stretches); the last
        row is the start itself. Pieces that end at or before the start are not considered.
        """
        before = len(first) - 1
        n = int(lengths.max(initial=0))
        best = np.full((before + n + 1, len(starts)), -np.inf)
        best[: before + 1] = first
        last = np.zeros((n + 1, len(starts)), np.int8)
        for t in range(1, n + 1):
            k = int(np.searchsorted(-lengths, -t, "right"))  # lanes are sorted, longest first
            row = best[before + t]
            for size in range(1, min(self.reach, before + t) + 1):
                tried = best[before + t - size, :k] + score[size - 1, starts[:k] + t - 1]
                better = (tried >= row[:k]) & (tried > -np.inf)
                row[:k][better] = tried[better]
                last[t, :k][better] = size
        return best, last

    def solve(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Ids of stretches of UTF-8 bytes, and their number for each."""
        text, _ = gather(data, starts, ends - starts)
        lead = (text & 0xC0) != 0x80
        chars = np.concatenate([[0], np.cumsum(lead)])
        bounds = chars[np.concatenate([[0], np.cumsum(ends - starts)])]
        codes = np.frombuffer(text.tobytes().decode().replace(" ", BLANK).encode("utf-32-le"), np.uint32)
        at, length = bounds[:-1], np.diff(bounds)
        order = np.argsort(-length, kind="stable")
        counts = np.zeros(len(at), np.int64)
        found, place, char = [], [], []
        i = 0
        while i < len(order):
            n = max(1, LANES // max(int(length[order[i]]), 1))
            lanes = order[i : i + n]
            i += n
            # Only the characters of these lanes get edges.
            own, done = gather(codes, at[lanes], length[lanes])
            score, number = self.edges_within(own, done)
            _, last = self.paths(score, done[:-1], length[lanes], np.zeros((1, len(lanes))))
            left, step = length[lanes].copy(), 0
            alive = np.flatnonzero(left > 0)
            while len(alive):
                size = last[left[alive], alive].astype(np.int64)
                end = done[alive] + left[alive] - 1
                found.append(number[size - 1, end])
                place.append(np.stack([lanes[alive], np.full(len(alive), step)]))
                char.append(own[end])
                left[alive] -= size
                counts[lanes[alive]] += 1
                step += 1
                alive = alive[left[alive] > 0]
        if not found:
            return np.zeros(0, np.uint32), counts
        found, char, (lane, step) = np.concatenate(found), np.concatenate(char), np.concatenate(place, 1)
        ids, chars = np.zeros(len(found), np.int64), np.zeros(len(found), np.uint32)
        where = np.cumsum(counts)[lane] - 1 - step
        ids[where], chars[where] = found, char
        odd = np.flatnonzero(ids < 0)
        if not len(odd):
            return ids.astype(np.uint32), counts
        spelled = [chr(c).encode() for c in chars[odd].tolist()]
        width = np.ones(len(ids), np.int64)
        width[odd] = [len(b) for b in spelled]
        out = np.repeat(ids, width)
        first = np.cumsum(width) - width
        out[np.repeat(first[odd], width[odd]) + np.concatenate([np.arange(len(b)) for b in spelled])] = self.byte_ids[
            np.frombuffer(b"".join(spelled), np.uint8)
        ]
        owner = np.repeat(np.arange(len(counts)), counts)
        return out.astype(np.uint32), np.bincount(owner, width, len(counts)).astype(np.int64)

    def edges_within(self, codes: np.ndarray, done: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As edges, without pieces that reach over the start of their stretch."""
        score, number = self.edges(codes)
        into = np.arange(len(codes)) - np.repeat(done[:-1], np.diff(done))
        for size in range(2, self.reach + 1):
            score[size - 1, into < size - 1] = -np.inf
        return score, number

    def encode(self, data: np.ndarray, offsets: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each begins.

        fresh: which texts are whole documents or begin one, and so get a space in front.
        """
        filled = np.diff(offsets) > 0
        shift = np.cumsum(fresh & filled)
        padded = np.full(len(data) + int(shift[-1]) if len(shift) else 0, 32, np.uint8)
        padded[np.arange(len(data)) + np.repeat(shift, np.diff(offsets))] = data
        bounds = offsets + np.concatenate([[0], shift])
        # U+2581 ends with the byte 0x81; a cut that is left out costs nothing but time.
        cut = padded == 32
        cut[1:] &= (padded[:-1] != 32) & (padded[:-1] != 0x81)
        cut[bounds[:-1][filled]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(padded)) if len(starts) else starts
        at, length = self.memory.look_up(padded, starts, ends)
        ids, done = gather(self.memory.pool, at, length)
        return ids, done[np.searchsorted(starts, bounds)]

    def decode(self, ids: np.ndarray, at: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts one after the other, and where each begins."""
        out, done = gather(self.bytes_pool, self.bytes_at[ids], self.bytes_len[ids])
        bounds = done[at]
        drop = np.zeros(len(out), bool)
        first = bounds[:-1][fresh & (np.diff(bounds) > 0)]
        drop[first] = out[first] == 32
        return out[~drop], bounds - np.concatenate([[0], np.cumsum(drop)])[bounds]

    def matrix(self, before: str, text: str) -> np.ndarray:
        """Best sums from i characters before the chunk to j characters before its end.

        before: the characters in front of the chunk, as many as reach - 1 or as there are.
        """
        lead, codes = len(before), np.frombuffer((before + text).replace(" ", BLANK).encode("utf-32-le"), np.uint32)
        blank = codes == ord(BLANK)
        cuts = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
        cuts = cuts[cuts >= lead]
        end = len(codes)
        head = int(cuts[0]) if len(cuts) else end
        tail = int(cuts[-1]) if len(cuts) else end
        score, _ = self.edges_within(codes[:head], np.array([0, head]))
        first = np.full((lead + 1, lead + 1), -np.inf)
        first[np.arange(lead + 1), np.arange(lead + 1)[::-1]] = 0  # lane i enters i characters before
        size = np.full(lead + 1, head - lead)
        best, _ = self.paths(score, np.full(lead + 1, lead), size, first)
        out = np.full((self.reach, self.reach), -np.inf)
        if not len(cuts):
            rows = best[::-1][: self.reach]  # row j: places j before the end
            out[: lead + 1, : len(rows)] = rows.T
            return out
        enter = best[-1]
        middle = 0.0
        if tail > head:
            inner = codes[head:tail]
            starts = cuts[:-1] - head
            length = np.diff(np.append(starts, len(inner)))
            order = np.argsort(-length, kind="stable")
            score, _ = self.edges_within(inner, np.append(starts, len(inner)))
            sums, _ = self.paths(score, starts[order], length[order], np.zeros((1, len(starts))))
            middle = float(sums[length[order], np.arange(len(order))].sum())
        score, _ = self.edges_within(codes[tail:], np.array([0, end - tail]))
        leave, _ = self.paths(score, np.zeros(1, np.int64), np.array([end - tail]), np.zeros((1, 1)))
        leave = leave[::-1, 0][: self.reach]
        out[: lead + 1, : len(leave)] = enter[:, None] + middle + leave[None, :]
        return out


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One per worker process, with what it has learned."""
    return Vocabulary(path)


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The matrix of two neighbouring chunks: a product in max-plus algebra."""
    return (a[:, :, None] + b[None, :, :]).max(1)


def crossings(matrices: list[np.ndarray], enter: int = 0, leave: int = 0) -> list[int]:
    """For each of neighbouring chunks, how far before its end the best path cuts; for the last that is `leave`.

    enter: how far before the first chunk the path begins.
    """
    reached = [np.where(np.arange(len(matrices[0])) == enter, 0.0, -np.inf)]
    for m in matrices[:-1]:
        reached.append((reached[-1][:, None] + m).max(0))
    cuts, j = [leave], leave
    for i in range(len(matrices) - 1, 0, -1):
        through = reached[i] + matrices[i][:, j]
        j = len(through) - 1 - int(np.argmax(through[::-1]))  # of equal places the earliest
        cuts.append(j)
    return cuts[::-1]


NODE = "rid long, part int, last int"


def square(data: bytes) -> np.ndarray:
    values = np.frombuffer(data)
    return values.reshape(int(len(values) ** 0.5), -1)


def grouped(level: DataFrame, group: int) -> DataFrame:
    """level with the number of the group as node, and a group's rows together.

    The number of partitions is given, so that many small documents are not put into one task.
    """
    spread = int(level.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return level.withColumn("node", F.floor(F.col("part") / group).cast("int")).repartition(spread, "rid", "node")


def raised(level: DataFrame, group: int) -> DataFrame:
    """(rid, part, last, matrix) of every `group` neighbours in level."""

    def run(frame):
        frame = frame.sort_values("part")
        whole = square(frame["matrix"].iloc[0])
        for m in frame["matrix"].iloc[1:]:
            whole = combine(whole, square(m))
        first = frame.head(1)
        return first[["rid"]].assign(part=first["part"] // group, last=first["last"] // group, matrix=[whole.tobytes()])

    return grouped(level, group).groupBy("rid", "node").applyInPandas(run, f"{NODE}, matrix binary")


def lowered(level: DataFrame, above: DataFrame | None, group: int) -> DataFrame:
    """(rid, part, enter, leave) of level from those of the groups above it.

    The nodes of a document with `group` or fewer in level have nothing above: their path begins and ends with the document.
    """
    zero = F.lit(0)
    nodes = grouped(level, group)
    placed = nodes.where(F.col("last") < group).withColumns({"enter": zero, "leave": zero})
    if above is not None:
        over = above.withColumnRenamed("part", "node")
        placed = placed.unionByName(nodes.where(F.col("last") >= group).join(over, ["rid", "node"]))

    def run(frame):
        frame = frame.sort_values("part")
        cuts = crossings([square(m) for m in frame["matrix"]], int(frame["enter"].iloc[0]), int(frame["leave"].iloc[0]))
        return frame[["rid", "part"]].assign(enter=[int(frame["enter"].iloc[0]), *cuts[:-1]], leave=cuts)

    return placed.groupBy("rid", "node").applyInPandas(run, "rid long, part int, enter int, leave int")


def placed_cuts(matrices: DataFrame, group: int = GROUP) -> DataFrame:
    """(rid, part, enter, leave) of every chunk from (rid, part, last, matrix), last being its document's last part."""
    levels = [stage(matrices, "matrices")]
    top = levels[0].agg(F.max("last")).first()[0] or 0
    while top >= group:
        levels.append(stage(raised(levels[-1].where(F.col("last") >= group), group), "matrices"))
        top //= group
    above = None
    for level in reversed(levels):
        above = stage(lowered(level, above, group), "cuts")
    return above


ROWS = "rid long, part int, last int, doc_id long, before string, text string"


def split(docs: DataFrame, reach: int, chunk: int) -> DataFrame:
    """Chunks of the long documents, each with the characters before it."""

    def cut(batches):
        for batch in batches:
            for rid, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                shown = f" {text}"
                last = (len(shown) - 1) // chunk
                for part, at in enumerate(range(0, len(shown), chunk)):
                    row = [[rid], [part], [last], [doc_id], [shown[max(0, at - reach + 1) : at]], [shown[at : at + chunk]]]
                    types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, types)], names=[x.split()[0] for x in ROWS.split(", ")])

    return docs.select(F.monotonically_increasing_id(), "doc_id", "text").mapInArrow(cut, ROWS)


def encode(docs: DataFrame, model: str, doc_id="doc_id", text="text", chunk: int = CHUNK, with_ids: bool = False, group: int = GROUP) -> DataFrame:
    """doc_id, n_pieces, digest (sum of position times id, modulo 2**31 - 1), n_bytes, same.

    same: the ids decode to the text (null for U+2581 in it means: to it with spaces there). With
    with_ids also ids, the ids as little-endian 32-bit numbers.
    """
    reach = vocabulary(model).reach
    if chunk < reach:
        raise ValueError("a piece must not reach over a whole chunk")
    own = docs.select(docs[doc_id].cast("long").alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text"))
    is_long = F.length("text") >= chunk
    parts = stage(split(own.where(is_long), reach, chunk), "chunks")

    def matrices(batches):
        words = vocabulary(model)
        for batch in batches:
            made = [words.matrix(b, t).tobytes() for b, t in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(made, pa.binary())], names=["rid", "part", "last", "matrix"])

    found = parts.select("rid", "part", "last", "before", "text").mapInArrow(matrices, f"{NODE}, matrix binary")
    # A document's matrices are an eighth of its size at most; its text is not gathered.
    placed = placed_cuts(found, group)
    exact = parts.join(placed, ["rid", "part"]).select(
        "rid", "part", "doc_id",
        F.concat(F.expr("right(before, enter)"), F.expr("left(text, length(text) - leave)")).alias("text"),
        F.lit(False).alias("fresh"),
    )
    none = F.lit(None).cast("long")
    short = own.where(~is_long).select(none.alias("rid"), F.lit(0).alias("part"), "doc_id", "text", F.lit(True).alias("fresh"))

    def solve(batches):
        words = vocabulary(model)
        for rows, data, offsets in slices(batches, 3, SLICE_BYTES // 4):
            fresh = np.asarray(rows.column(4))
            ids, at = words.encode(data, offsets, fresh)
            back, bounds = words.decode(ids, at, fresh)
            n, place = np.diff(at), np.arange(len(ids)) - np.repeat(at[:-1], np.diff(at)) + 1
            sums = np.concatenate([[0], np.cumsum(ids.astype(np.int64) % PRIME)])
            weighed = np.concatenate([[0], np.cumsum(place % PRIME * ids.astype(np.int64) % PRIME)])
            same = np.array([
                a == b or a == b.replace(BLANK.encode(), b" ")
                for a, b in (
                    (back[bounds[i] : bounds[i + 1]].tobytes(), data[offsets[i] : offsets[i + 1]].tobytes())
                    for i in range(rows.num_rows)
                )
            ], bool)
            columns = [
                *rows.columns[:3], pa.array(n), pa.array((sums[at[1:]] - sums[at[:-1]]) % PRIME),
                pa.array((weighed[at[1:]] - weighed[at[:-1]]) % PRIME), pa.array(np.diff(offsets)), pa.array(same, pa.bool_()),
            ]
            if with_ids:
                whole = ids.astype("<u4")
                columns.append(pa.array([whole[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in schema.split(", ")])

    schema = "rid long, part int, doc_id long, n_pieces long, total long, digest long, n_bytes long, same boolean"
    schema += ", ids binary" if with_ids else ""
    more = ["ids"] if with_ids else []
    whole = short.mapInArrow(solve, schema).select("doc_id", "n_pieces", "digest", "n_bytes", "same", *more)
    pieces = exact.mapInArrow(solve, schema)
    in_order = lambda *columns: F.array_sort(F.collect_list(F.struct("part", *columns)))
    joined = pieces.groupBy("rid").agg(
        F.first("doc_id").alias("doc_id"), F.sum("n_pieces").alias("n_pieces"), (F.sum("n_bytes") - 1).alias("n_bytes"),
        F.bool_and("same").alias("same"), in_order("n_pieces", "total", "digest").alias("parts"),
        *([in_order("ids").alias("id_parts")] if with_ids else []),
    )
    state = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("digest"))
    digest = F.aggregate(
        "parts", state,
        lambda s, p: F.struct((s["n"] + p["n_pieces"]).alias("n"), ((s["digest"] + p["digest"] + s["n"] % PRIME * p["total"]) % PRIME).alias("digest")),
        lambda s: s["digest"],
    )
    # Joined once as hexadecimal text: appending part by part would copy all that came before each time.
    ids = [F.unhex(F.array_join(F.transform("id_parts", lambda p: F.hex(p["ids"])), "")).alias("ids")] if with_ids else []
    return whole.unionByName(joined.select("doc_id", "n_pieces", digest.alias("digest"), "n_bytes", "same", *ids))
