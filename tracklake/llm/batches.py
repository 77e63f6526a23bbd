"""Texts of Arrow batches as arrays of bytes, and hashes of their words.

Batches are cut into slices of a few megabytes of text, so what a task holds does not depend on how
many rows Spark puts in a batch. One document is never cut here; a slice of one document is as
large as that document.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20
# Length of the tables of powers that a worker keeps; longer ones are made for a long text and go after it.
TABLE_BYTES = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at.astype(np.int64) - at[0]


def slices(batches: Iterator[pa.RecordBatch], text: int = 1, most: int = SLICE_BYTES):
    """(rows as a RecordBatch, bytes, offsets) for runs of rows with at most `most` bytes, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = text_bytes(batch.column(text))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            cut = offsets[first : last + 1]
            yield batch.slice(first, last - first), data[cut[0] : cut[-1]], cut - cut[0]
            first = last


def mix64(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of any stretch of a text in constant time: sums of random numbers per byte times powers.

    Two stretches with the same bytes have the same hash wherever they stand.
    """

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.of_byte = rng.integers(1, 1 << 63, 256, dtype=np.uint64)
        self.base = int(rng.integers(1, 1 << 61)) * 8 + 5
        self.powers = np.ones(1, np.uint64)
        self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n or len(self.powers) > max(n, 4 * TABLE_BYTES):
            n = max(n, TABLE_BYTES)
            with np.errstate(over="ignore"):
                for name, base in (("powers", self.base), ("inverse", pow(self.base, -1, 1 << 64))):
                    x = np.full(n, np.uint64(base & 0xFFFFFFFFFFFFFFFF))
                    x[0] = 1
                    setattr(self, name, np.multiply.accumulate(x))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.of_byte[data] * self.powers[: len(data)], out=sums[1:])
        return sums

    def of(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((prefix[end] - prefix[start]) * self.inverse[start] + (end - start).astype(np.uint64))

    def grams(self, prefix: np.ndarray, length: int) -> np.ndarray:
        """As `of`, for the stretches of this length from every place on."""
        n = len(prefix) - length
        return mix64((prefix[length:] - prefix[:n]) * self.inverse[:n] + np.uint64(length))


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words; a document's end ends a word."""
    letter = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.ones(len(data), bool)
    before[1:] = ~letter[:-1]
    after = np.ones(len(data), bool)
    after[:-1] = ~letter[1:]
    starts = np.flatnonzero(letter & (before | edge[:-1]))
    ends = np.flatnonzero(letter & (after | edge[1:])) + 1
    return starts, ends


class Remembered:
    """Ids of stretches of text, each distinct stretch solved once while it is remembered.

    solve(data, starts, ends) gives the ids of all these stretches one after the other, and their
    number for each. Stretches are told apart by 64-bit hashes; the table is emptied when it is full.
    """

    def __init__(self, solve, most: int):
        self.solve, self.most, self.rolling = solve, most, Rolling(11)
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.at, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def look_up(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in the pool the ids of each stretch begin, and their number."""
        if len(self.known) > self.most:
            self.clear()
        hashes = self.rolling.of(self.rolling.prefix(data), starts, ends)
        # Any of the equal stretches stands for them, so the order need not be stable as that of np.unique.
        order = np.argsort(hashes)
        ordered = hashes[order]
        new = np.ones(len(hashes), bool)
        new[1:] = ordered[1:] != ordered[:-1]
        distinct, where = ordered[new], order[new]
        back = np.empty(len(hashes), np.int64)
        back[order] = np.cumsum(new) - 1
        place = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), bool)
        inside = place < len(self.known)
        new[inside] = self.known[place[inside]] != distinct[inside]
        if new.any():
            ids, counts = self.solve(data, starts[where[new]], ends[where[new]])
            known = np.concatenate([self.known, distinct[new]])
            order = np.argsort(known, kind="stable")
            self.at = np.concatenate([self.at, len(self.pool) + np.cumsum(counts) - counts])[order]
            self.length = np.concatenate([self.length, counts])[order]
            self.known, self.pool = known[order], np.concatenate([self.pool, ids.astype(np.uint32)])
            place = np.searchsorted(self.known, distinct)
        return self.at[place][back], self.length[place][back]


def gather(pool: np.ndarray, at: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of pool one after the other, and where each begins and the last ends."""
    done = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
    return pool[np.arange(done[-1]) + np.repeat(at - done[:-1], length)], done
