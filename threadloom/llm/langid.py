"""Language identification: a bidirectional gated recurrent network over bytes, trained here in numpy.

Texts are cut into windows of ``WINDOW`` bytes (A-Z lower-cased). Both directions read a window and every
byte position gets a probability per language; a document's probabilities are the means over all positions
of its whole text. Gates and candidates use the softsign x / (1 + |x|) in place of the hyperbolic tangent, and
(1 + softsign) / 2 in place of the logistic function: the same shape from three cheap vector operations. Training is backpropagation through time on a bounded sample of windows: at most
``per_lang`` documents a language and ``per_doc`` windows a document, drawn by hash. Everything else covers
all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.llm.common import LOWER_BYTES, as_bytes

WINDOW = 64
HIDDEN = 8
PER_LANG = 400
PER_DOC = 8
SPARE = 4  # documents ranked for each one that is drawn
STEPS = 250
BATCH = 192
RATE = 0.01
SEED = 42
CHUNK = 1024  # windows read together
UNKNOWN = "und"
LETTER = r"\p{L}"


@dataclass
class Direction:
    """One direction: rows per byte, recurrent weights and biases, each for the update, reset and candidate."""

    table: np.ndarray  # (3, 256, hidden)
    inner: np.ndarray  # (3, hidden, hidden)
    bias: np.ndarray  # (3, hidden)

    def parts(self) -> list[np.ndarray]:
        return [self.table, self.inner, self.bias]


@dataclass
class Model:
    labels: list[str]
    ways: list[Direction]
    out: np.ndarray
    shift: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [p for way in self.ways for p in way.parts()] + [self.out, self.shift]


def new_model(labels: list[str], hidden: int, rng: np.random.Generator) -> Model:
    def draw(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    ways = [Direction(draw(3, 256, hidden, scale=0.5), draw(3, hidden, hidden, scale=hidden**-0.5),
                      np.zeros((3, hidden), np.float32)) for _ in range(2)]
    return Model(labels, ways, draw(2 * hidden, len(labels), scale=0.3), np.zeros(len(labels), np.float32))


def softsign(x: np.ndarray) -> np.ndarray:
    """In place."""
    x /= np.abs(x) + 1
    return x


def run_way(way: Direction, steps: np.ndarray) -> tuple[np.ndarray, list]:
    """States of one direction over ``steps`` (time, row) of bytes, and what backpropagation needs."""
    state, states, trail = np.zeros((steps.shape[1], way.bias.shape[1]), np.float32), [], []
    for row in steps:
        given = [way.table[k].take(row, axis=0) + way.bias[k] for k in range(3)]
        mixed = state @ way.inner[2]
        update, reset = (0.5 + 0.5 * softsign(given[k] + state @ way.inner[k]) for k in range(2))
        candidate = softsign(given[2] + reset * mixed)
        trail.append((state, update, reset, candidate, mixed))
        state = candidate + update * (state - candidate)
        states.append(state)
    return np.stack(states), trail


def back_way(way: Direction, steps: np.ndarray, trail: list, grad: np.ndarray) -> list[np.ndarray]:
    """Gradients of table, inner and bias from ``grad`` (time, row, hidden) on the states.

    The slope of the softsign f is (1 - |f|)^2; that of a gate g = (1 + f) / 2 is half of it at f = 2 g - 1.
    """
    inner = np.zeros_like(way.inner)
    given = np.zeros((3, *grad.shape), np.float32)
    later = np.zeros_like(grad[0])
    for t in range(len(steps) - 1, -1, -1):
        state, update, reset, candidate, mixed = trail[t]
        d = grad[t] + later
        d_candidate = d * (1 - update) * (1 - np.abs(candidate)) ** 2
        d_update = d * (state - candidate) * 0.5 * (1 - np.abs(2 * update - 1)) ** 2
        d_reset = d_candidate * mixed * 0.5 * (1 - np.abs(2 * reset - 1)) ** 2
        given[0, t], given[1, t], given[2, t] = d_update, d_reset, d_candidate
        later = d * update
        for k, part in enumerate((d_update, d_reset, d_candidate * reset)):
            later += part @ way.inner[k].T
            inner[k] += state.T @ part
    flat, order = given.reshape(3, -1, grad.shape[2]), np.argsort(steps, axis=None, kind="stable")
    symbols, starts = np.unique(steps.ravel()[order], return_index=True)
    table = np.zeros_like(way.table)
    table[:, symbols] = np.add.reduceat(flat[:, order], starts, axis=1)
    return [table, inner, flat.sum(axis=1)]


def train(windows: np.ndarray, sizes: np.ndarray, targets: np.ndarray, labels: list[str], hidden: int = HIDDEN,
          steps: int = STEPS, batch: int = BATCH, rate: float = RATE, seed: int = SEED) -> Model:
    """Adam on the mean cross-entropy of all positions; same input, same model."""
    rng = np.random.default_rng(seed)
    model = new_model(labels, hidden, rng)
    first = [np.zeros_like(p) for p in model.parts()]
    second = [np.zeros_like(p) for p in model.parts()]
    by_label = [np.flatnonzero(targets == k) for k in range(len(labels))]
    for number in range(1, steps + 1):
        # The same number of windows of each language, whatever their shares.
        pick = np.concatenate([rng.choice(rows, -(-batch // len(labels))) for rows in by_label])
        forward = windows[pick].T
        backward = forward[::-1]
        mask = (np.arange(forward.shape[0])[:, None] < sizes[pick]).astype(np.float32)
        ahead, trail_a = run_way(model.ways[0], forward)
        behind, trail_b = run_way(model.ways[1], backward)
        both = np.concatenate((ahead, behind[::-1]), axis=2)
        scores = both @ model.out + model.shift
        scores -= scores.max(axis=2, keepdims=True)
        chance = np.exp(scores)
        chance /= chance.sum(axis=2, keepdims=True)
        chance[:, np.arange(len(pick)), targets[pick]] -= 1
        chance *= (mask / mask.sum())[:, :, None]
        flat = chance.reshape(-1, len(labels))
        d_both = chance @ model.out.T
        grads = back_way(model.ways[0], forward, trail_a, d_both[:, :, :hidden])
        grads += back_way(model.ways[1], backward, trail_b, d_both[::-1, :, hidden:])
        grads += [both.reshape(-1, 2 * hidden).T @ flat, flat.sum(axis=0)]
        norm = float(np.sqrt(sum((g * g).sum() for g in grads)))
        scale = min(1.0, 1.0 / (norm + 1e-8))
        pace = rate * (1 - number / (steps + 1)) * np.sqrt(1 - 0.999**number) / (1 - 0.9**number)
        for p, g, m, v in zip(model.parts(), grads, first, second, strict=True):
            g = g * scale
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= (pace * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
    return model


class Reader:
    """The trained network for reading only."""

    def __init__(self, model: Model):
        self.labels, self.ways = model.labels, model.ways
        self.hidden = model.ways[0].bias.shape[1]
        self.tables = [way.table + way.bias[:, None] for way in model.ways]
        self.out, self.shift = model.out, model.shift

    def states(self, steps: np.ndarray, number: int, into: np.ndarray) -> None:
        """States of one direction at every position, into ``into`` (time, row, hidden); contiguous work arrays."""
        table, inner = self.tables[number], self.ways[number].inner
        shape = (steps.shape[1], self.hidden)
        state, update, reset, mixed, given, size = (np.zeros(shape, np.float32) for _ in range(6))

        def squash(x: np.ndarray) -> None:
            np.abs(x, out=size)
            np.add(size, 1, out=size)
            np.divide(x, size, out=x)

        order = range(len(steps)) if number == 0 else range(len(steps) - 1, -1, -1)
        for t in order:
            for k, gate in ((0, update), (1, reset)):
                np.matmul(state, inner[k], out=gate)
                np.take(table[k], steps[t], axis=0, out=given, mode="clip")
                gate += given
                squash(gate)
                gate += 1
                gate *= 0.5
            np.matmul(state, inner[2], out=mixed)
            np.take(table[2], steps[t], axis=0, out=given, mode="clip")
            mixed *= reset
            mixed += given
            squash(mixed)
            state -= mixed
            state *= update
            state += mixed
            into[t] = state

    def window_sums(self, windows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """(windows, labels): sums of the position probabilities over the first ``sizes`` positions."""
        sums = np.zeros((len(windows), len(self.labels)), np.float64)
        for low in range(0, len(windows), CHUNK):
            steps = np.ascontiguousarray(windows[low: low + CHUNK].T)
            both = np.empty((2, *steps.shape, self.hidden), np.float32)
            scores = np.zeros((steps.size, len(self.labels)), np.float32) + self.shift
            for number in range(2):
                self.states(steps, number, both[number])
                part = self.out[number * self.hidden: (number + 1) * self.hidden]
                scores += both[number].reshape(-1, self.hidden) @ part
            np.exp(np.clip(scores, -60, 60, out=scores), out=scores)
            scores /= scores.sum(axis=1, keepdims=True)
            scores = scores.reshape(*steps.shape, -1)
            scores *= (np.arange(len(steps))[:, None] < sizes[low: low + CHUNK])[:, :, None]
            sums[low: low + CHUNK] = scores.sum(axis=0)
        return sums

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """(texts, labels): mean probabilities over all positions of each non-empty text."""
        windows, sizes, counts = cut(texts)
        sums = np.add.reduceat(self.window_sums(windows, sizes), np.cumsum(counts) - counts, axis=0)
        return sums / np.array([len(t) for t in texts])[:, None]


def cut(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all (non-empty) texts, the bytes in each, and the windows per text."""
    counts = np.array([-(-len(t) // WINDOW) for t in texts])
    padded = b"".join(t.translate(LOWER_BYTES).ljust(int(n) * WINDOW, b"\0") for t, n in zip(texts, counts, strict=True))
    sizes = np.full(int(counts.sum()), WINDOW)
    sizes[np.cumsum(counts) - 1] = [len(t) - (int(n) - 1) * WINDOW for t, n in zip(texts, counts, strict=True)]
    return np.frombuffer(padded, np.uint8).reshape(-1, WINDOW), sizes, counts


def has_letters(text: Column) -> Column:
    return F.coalesce(text.rlike(LETTER), F.lit(False))


def sample_windows(labelled: DataFrame, per_lang: int, per_doc: int, seed: int) -> DataFrame:
    """(lang, bytes): evenly spaced windows of the documents with the smallest hashes of each language.

    Only documents below a hash bound are ranked: ``SPARE`` times the wanted number by a language's estimated size,
    so that the group of a large language is no larger than that of any other.
    """
    sizes = labelled.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n")).collect()  # one row a label
    bounds = [(r["lang"], min(2**63 - 1, -(2**63) + SPARE * per_lang * 2**64 // max(1, r["n"]))) for r in sizes]
    if not bounds:
        return labelled.sparkSession.createDataFrame([], "lang string, bytes binary")
    bounds = labelled.sparkSession.createDataFrame(bounds, "lang string, _bound bigint")
    hashed = labelled.select("doc_id", "lang", F.xxhash64(F.lit(seed), "doc_id").alias("_hash"))
    near = hashed.join(F.broadcast(bounds), "lang").filter(F.col("_hash") <= F.col("_bound"))  # the model's labels
    order = Window.partitionBy("lang").orderBy("_hash", "doc_id")
    narrow = near.select("doc_id", "lang", "_hash").distinct().withColumn("_n", F.row_number().over(order))
    drawn = narrow.filter(F.col("_n") <= per_lang).select(F.col("doc_id").alias("_d"), F.col("lang").alias("_l"))
    same = labelled["doc_id"].eqNullSafe(F.col("_d")) & (labelled["lang"] == F.col("_l"))
    rows = labelled.join(F.broadcast(drawn), same, "left_semi")  # per_lang rows a language
    rows = rows.groupBy("doc_id", "lang").agg(F.min("text").alias("text")).select("lang", "text")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, parts = [], []
            for lang, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), strict=True):
                room = max(1, len(text) - WINDOW + 1)
                starts = sorted({i * room // per_doc for i in range(per_doc)})
                # Also the text's last window, which is shorter in most texts.
                for at in [*starts, len(text) // WINDOW * WINDOW]:
                    if at < len(text):
                        langs.append(lang)
                        parts.append(text[at: at + WINDOW])
            yield pa.RecordBatch.from_pydict({"lang": pa.array(langs, pa.string()), "bytes": pa.array(parts, pa.binary())})

    return rows.mapInArrow(windows, "lang string, bytes binary")


def fit(labelled: DataFrame, per_lang: int = PER_LANG, per_doc: int = PER_DOC, seed: int = SEED, **options) -> Model | None:
    """A model from (doc_id, text, lang); rows without lang or letters teach nothing. ``None`` without any."""
    rows = labelled.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & has_letters(F.col("text")))
    sample = sample_windows(rows, per_lang, per_doc, seed).orderBy("lang", "bytes").collect()  # bounded: see above
    if not sample:
        return None
    labels = sorted({r["lang"] for r in sample})
    parts = [bytes(r["bytes"]) for r in sample]
    windows, sizes, _ = cut(parts)
    targets = np.array([labels.index(r["lang"]) for r in sample])
    return train(windows, sizes, targets, labels, seed=seed, **options)


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """The columns of ``docs`` and lang_pred, score (these replace input columns of the same name).

    ``score`` is the mean probability of the predicted language over all byte positions. Null texts and texts
    without a letter, and every text if there is no model, get ``und`` with score 0. Ties go to the first label.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    rows = docs.select(*kept, F.when(has_letters(F.col("text")), F.col("text")).alias("_readable"))
    schema = T.StructType([*docs.select(*kept).schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model) if model else None
        for batch in batches:
            texts = as_bytes(batch.column(batch.num_columns - 1))
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            at = [i for i, t in enumerate(texts) if t]
            if reader and at:
                chance = reader.documents([texts[i] for i in at])
                best = chance.argmax(axis=1)
                scores[at] = np.clip(chance[np.arange(len(at)), best], 0, 1)
                for i, k in zip(at, best.tolist(), strict=True):
                    names[i] = reader.labels[k]
            columns = [*batch.columns[:-1], pa.array(names), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)
