"""Toxicity by a subsequence string-kernel machine with Nyström landmarks.

The kernel compares two strings by their common subsequences of four letters. An occurrence that
spans s letters weighs DECAY ** (s - 4), and spans reach up to six: insults with gaps, and with up
to two inserted letters in any four, still match. Anything that is no letter is passed over, so
"i-d i.o t" is read as "idiot". Sentences are cut at a space after every 40 letters. The landmarks are words of the training sentences and beginnings of
words, those that mark toxic documents best and others for contrast; a sentence is mapped to its kernel values with them, times
the inverse square root of the landmarks' own kernel matrix, and a linear machine with squared
hinge loss is trained on that.

Labels belong to documents. A document is toxic if one of its sentences is, so training alternates:
fit to the sentences of clean documents and the most suspicious sentence of each toxic one, then choose
these sentences anew. A document scores by its three worst sentences, turned into a probability by a
logistic curve fitted to the sampled documents, weighed to the label shares of all training rows.

As the kernel is a sum over subsequences, so is the machine: one weight per subsequence, in a table
of fixed size. Scoring adds up table entries, over all sentences of all whole texts.

The model is fitted on at most `sample` labelled documents per class, the ones with the least hash of
id, and on CLEAN_SENTENCES sentences of the clean ones; landmarks, weights and curve are bounded by parameters.

Defined results: a null or empty text scores as a sentence without letters. Labels that are null are
left out; a document with several labels takes the largest. Without rows of both classes every
score is the share of toxic rows (0 if there are none). Rows that repeat an id score by their own text, and are trained on by the text with the least hash.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklake.llm.batches import slices
from tracklake.llm.tables import fold

SAMPLE = 1000
# Sentences of clean documents that are fitted to, at most; evenly spread over the sampled documents.
CLEAN_SENTENCES = 30_000
MARKING, CONTRAST = 96, 32
# Sentences whose values the curve sees, the worst ones first.
WORST = 3
DECAY = 0.5
LETTERS = 28  # a to z, any byte of a longer character, and the break between sentences
OTHER, BREAK, SKIP = 26, 27, 255
# Offsets of the second, third and fourth letter: spans of four to six.
PATTERNS = [(a, b, c) for c in range(3, 6) for b in range(2, c) for a in range(1, b)]
REACH = 5
# Longer sentences are cut, so that a machine sees strings of like length.
PIECE = 40
RIDGE = 0.01

CODE = np.full(256, SKIP, np.uint8)
CODE[97:123] = CODE[65:91] = np.arange(26)
CODE[128:] = OTHER
STOPS = np.zeros(256, bool)
STOPS[[ord(c) for c in ".!?"]] = True


def long_sentences(text: np.ndarray, code: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Spaces at which sentences are cut: the first one after every PIECE letters."""
    count = np.cumsum(code < BREAK)
    part = (count - np.maximum.accumulate(np.where(ends, count, 0))) // PIECE
    spaces = np.flatnonzero(text == 32)
    key = np.cumsum(ends)[spaces] * len(text) + part[spaces]
    changed = np.ones(len(spaces), bool)
    changed[1:] = key[1:] != key[:-1]
    return spaces[changed & (part[spaces] > 0)]


def letters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all documents with breaks after sentences, and where each document's begin."""
    n = len(offsets) - 1
    text = np.full(len(data) + n, 10, np.uint8)
    text[np.arange(len(data)) + np.repeat(np.arange(n), np.diff(offsets))] = data
    code = CODE[text]
    ends = text == 10
    ends[:-1] |= STOPS[text[:-1]] & ((text[1:] == 32) | (text[1:] == 10))
    code[ends] = BREAK
    code[long_sentences(text, code, ends)] = BREAK
    width = np.where(code == SKIP, 0, np.where(code == BREAK, REACH, 1))
    at = np.concatenate([[0], np.cumsum(width)])[offsets + np.arange(n + 1)]
    return np.repeat(code, width), at


def occurrences(code: np.ndarray):
    """For each pattern: numbers of the subsequences starting at each letter, and their weight."""
    x = np.concatenate([code, np.full(REACH, BREAK, np.uint8)]).astype(np.int32)
    n = len(code)
    first = x[:n] * LETTERS**3
    second = {a: first + x[a : a + n] * LETTERS**2 for a in {p[0] for p in PATTERNS}}
    third = {(a, b): second[a] + x[b : b + n] * LETTERS for a, b in {p[:2] for p in PATTERNS}}
    for a, b, c in PATTERNS:
        yield third[a, b] + x[c : c + n], DECAY ** (c - 3)


def has_break() -> np.ndarray:
    """Subsequences that touch a break; no kernel counts them."""
    i = np.arange(LETTERS**4)
    return np.logical_or.reduce([i // LETTERS**k % LETTERS == BREAK for k in range(4)])


def features(word: str) -> dict[int, float]:
    """The subsequences of one string with their weights, scaled to length 1."""
    data = np.frombuffer(word.encode(), np.uint8)
    code, _ = letters(data, np.array([0, len(data)]))
    found: dict[int, float] = {}
    for numbers, weight in occurrences(code):
        for i in numbers.tolist():
            if all(i // LETTERS**k % LETTERS != BREAK for k in range(4)):
                found[i] = found.get(i, 0.0) + weight
    norm = sum(v * v for v in found.values()) ** 0.5
    return {i: v / norm for i, v in found.items()}


def sentence_starts(code: np.ndarray) -> np.ndarray:
    """Where the letters of each sentence begin; the breaks after it belong to it."""
    if not len(code):
        return np.zeros(0, np.int64)
    broken = code == BREAK
    return np.flatnonzero(np.concatenate([[True], broken[:-1] & ~broken[1:]]))


class Machine:
    """Weights per subsequence, the bias, and the curve's coefficients, its shift last."""

    def __init__(self, table, bias: float, curve: np.ndarray):
        self.table, self.bias, self.curve = table, bias, curve

    def values(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The worst sentences' values of each document."""
        code, at = letters(data, offsets)
        total = np.zeros(len(code), np.float32)
        for numbers, weight in occurrences(code):
            total += self.table[numbers] * np.float32(weight)
        starts = sentence_starts(code)
        sums = np.add.reduceat(total, starts).astype(float) if len(starts) else np.zeros(0)
        # A document ends with breaks, so a sentence never reaches into the next document.
        owner = np.searchsorted(at, starts, "right") - 1
        return worst(sums, owner, len(offsets) - 1) + self.bias

    def documents(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.table is None:
            return np.full(len(offsets) - 1, self.curve[-1])
        return chance(self.values(data, offsets), self.curve)


def worst(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """The WORST largest values of each owner, in order; where there are fewer, 0."""
    out = np.zeros((n, WORST))
    order = np.lexsort((-values, owner))
    held = owner[order]
    rank = np.arange(len(held)) - np.searchsorted(held, held)
    few = rank < WORST
    out[held[few], rank[few]] = values[order][few]
    return out


def chance(values: np.ndarray, curve: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(values @ curve[:-1] + curve[-1], -500, 500)))


def landmarks(texts: list[str], toxic: np.ndarray) -> list[str]:
    """Words and beginnings of words that mark toxic documents, by likelihood ratio, and common others."""
    seen: dict[str, list[int]] = {}
    for text, y in zip(texts, toxic):
        words = {"".join(c for c in w if c.isalpha()) for w in text.lower().split()}
        for part in {w[:n] for w in words for n in (4, 5, 6, 24) if len(w) >= 4}:
            seen.setdefault(part, [0, 0])[int(y)] += 1
    totals = max(int((~toxic).sum()), 1), max(int(toxic.sum()), 1)

    def marks(part: str) -> float:
        """Signed likelihood ratio of the part's share in toxic and in clean documents."""
        n, t = seen[part]
        ratio = 0.0
        for got, of in ((n, totals[0]), (t, totals[1])):
            share = (n + t) / sum(totals)
            for count, expected in ((got, of * share), (of - got, of * (1 - share))):
                ratio += count * np.log(count / expected) if count else 0.0
        return ratio if t / totals[1] > n / totals[0] else -ratio

    order = sorted((w for w in seen if sum(seen[w]) >= 3), key=lambda w: (-marks(w), w))
    chosen: list[str] = []
    for part in order:
        if len(chosen) == MARKING:
            break
        if not any(part.startswith(c) or c.startswith(part) for c in chosen):
            chosen.append(part)
    common = sorted(set(order) - set(chosen), key=lambda w: (-sum(seen[w]), w))
    return chosen + common[:CONTRAST]


def hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Minimises ridge and squared hinge loss by Newton steps; the last coefficient is the bias."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    ridge = RIDGE * np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(30):
        inside = y * (x @ w) < 1
        xs, ws = x[inside].astype(float), weight[inside][:, None]
        new = np.linalg.solve(ridge + xs.T @ (xs * ws), xs.T @ (ws[:, 0] * y[inside]))
        if np.allclose(new, w, atol=1e-8):
            break
        w = 0.5 * w + 0.5 * new if _ > 10 else new
    return w


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Coefficients and shift of a logistic curve, by damped Newton steps."""
    design = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(design.shape[1])
    ridge = 1e-2 * np.eye(len(w))
    for _ in range(100):
        p = chance(x, w)
        bend = design.T @ (design * (weight * p * (1 - p))[:, None]) + ridge
        w = w + np.clip(np.linalg.solve(bend, design.T @ (weight * (y - p)) - ridge @ w), -1, 1)
    return w


def fit(texts: list[str], toxic: np.ndarray, share: float) -> Machine:
    """A machine from documents and their labels; share: of toxic rows among all labelled ones."""
    if not toxic.any() or toxic.all():
        return Machine(None, 0.0, np.array([share]))
    words = [w for w in landmarks(texts, toxic) if features(w)]
    if not words:
        return Machine(None, 0.0, np.array([share]))
    maps = [features(w) for w in words]
    numbers = sorted({i for m in maps for i in m})
    place = np.full(LETTERS**4, -1, np.int32)
    place[numbers] = np.arange(len(numbers))
    phi = np.zeros((len(numbers), len(words)), np.float32)
    for j, m in enumerate(maps):
        for i, v in m.items():
            phi[place[i], j] = v
    values, vectors = np.linalg.eigh((phi.T @ phi).astype(float))
    root = vectors @ np.diag(np.where(values > 1e-6, 1 / np.sqrt(np.maximum(values, 1e-6)), 0)) @ vectors.T

    wanted = max(1, sum(len(t) for t, y in zip(texts, toxic) if not y) // PIECE // CLEAN_SENTENCES)
    x, owner = [], []
    for first, data, offsets in in_groups(texts):
        code, at = letters(data, offsets)
        starts = sentence_starts(code)
        sentence = np.searchsorted(starts, np.arange(len(code)), "right") - 1
        kernel = np.zeros((len(starts), len(words)), np.float32)
        for subsequence, weight in occurrences(code):
            where = place[subsequence]
            hit = np.flatnonzero(where >= 0)
            if len(hit):
                s = sentence[hit]
                begin = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
                kernel[s[begin]] += np.float32(weight) * np.add.reduceat(phi[where[hit]], begin)
        of = first + np.searchsorted(at, starts, "right") - 1
        keep = toxic[of] | (np.arange(len(of)) % wanted == 0)
        x.append(kernel[keep])
        owner.append(of[keep])
    x, owner = np.concatenate(x), np.concatenate(owner)
    bad = toxic[owner]
    # To begin with, the sentence nearest to the marking landmarks.
    suspicion = x[:, :MARKING].max(1)
    x = x @ root.astype(np.float32)
    clean = np.flatnonzero(~bad)
    for _ in range(4):
        order = np.lexsort((-suspicion, owner))
        firsts = order[np.concatenate([[True], owner[order][1:] != owner[order][:-1]])]
        chosen = firsts[bad[firsts]]
        rows = np.concatenate([chosen, clean])
        y = np.concatenate([np.ones(len(chosen)), -np.ones(len(clean))])
        weight = np.where(y > 0, 1.0 / max(len(chosen), 1), 1.0 / max(len(clean), 1)) * 2000
        w = hinge(x[rows], y, weight)
        suspicion = x @ w[:-1].astype(np.float32) + w[-1]
    table = np.zeros(LETTERS**4, np.float32)
    table[numbers] = phi @ (root @ w[:-1]).astype(np.float32)
    table[has_break()] = 0
    machine = Machine(table, float(w[-1]), np.zeros(WORST + 1))
    values = np.concatenate([machine.values(data, offsets) for _, data, offsets in in_groups(texts)])
    rates = np.where(toxic, share / toxic.mean(), (1 - share) / (1 - toxic.mean()))
    machine.curve = logistic(values, toxic.astype(float), rates)
    return machine


def in_groups(texts: list[str], n: int = 50):
    """(index of the first, bytes, offsets) of n texts at a time."""
    for first in range(0, len(texts), n):
        encoded = [t.encode() for t in texts[first : first + n]]
        yield first, np.frombuffer(b"".join(encoded), np.uint8), np.concatenate([[0], np.cumsum([len(e) for e in encoded])])


def learn(docs: DataFrame, labels: DataFrame, doc_id="doc_id", text="text", toxic="toxic", sample: int = SAMPLE) -> Machine:
    """A machine from the labelled rows of docs whose fold is not 0."""
    known = labels.select(labels[doc_id].alias("id"), labels[toxic].cast("int").alias("y"))
    known = known.where(F.col("y").isNotNull() & F.col("id").isNotNull() & (fold("id") != 0))
    known = known.groupBy("id").agg(F.max("y").alias("y"))
    total = known.agg(F.sum((F.col("y") > 0).cast("int")).alias("t"), F.count("y").alias("n")).first()
    share = (total["t"] or 0) / max(total["n"], 1)
    picked = [r for y in (0, 1) for r in known.where((F.col("y") > 0) == bool(y)).orderBy(F.xxhash64("id"), "id").limit(sample).collect()]
    ids = docs.sparkSession.createDataFrame([(r["id"], int(r["y"] > 0)) for r in picked], "id long, y int")
    own = docs.select(docs[doc_id].cast("long").alias("id"), F.coalesce(docs[text], F.lit("")).alias("text"))
    # At most two samples of ids, one row each: of the texts of a repeated id the one with the least hash.
    least = F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"].alias("text")
    rows = own.join(F.broadcast(ids), "id").groupBy("id", "y").agg(least).select("text", "y").collect()
    rows.sort(key=lambda r: (r["y"], r["text"]))
    return fit([r["text"] for r in rows], np.array([r["y"] > 0 for r in rows], bool), share)


def score(docs: DataFrame, machine: Machine, text="text", name="score") -> DataFrame:
    """docs with the score of every whole text; a column of that name is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    kept = [c for c in docs.columns if c != name]
    schema = docs.select(kept).withColumn(name, F.lit(0.0)).schema
    place = kept.index(text)

    def run(batches):
        for rows, data, offsets in slices(batches, place, 2 << 20):
            scores = pa.array(shared.value.documents(data, offsets), pa.float64())
            yield pa.RecordBatch.from_arrays([*rows.columns, scores], names=[*rows.schema.names, name])

    return docs.select(kept).mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, doc_id="doc_id", text="text", toxic="toxic") -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs."""
    machine = learn(docs, labels, doc_id, text, toxic)
    own = docs.select(docs[doc_id].alias("doc_id"), (fold(doc_id) == 0).alias("held_out"), docs[text].alias("text"))
    scored = score(own, machine).drop("text")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
