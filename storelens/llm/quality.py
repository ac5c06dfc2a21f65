"""Quality classifier: random-indexing word vectors pooled per document, then a small calibrated network."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import held, remainder, slices, texts_of
from storelens.llm.word_shingles import word_codes
from storelens.session import materialize

# Words and their shapes share a table of so many vectors, half of it each.
SLOTS = 1 << 14
WIDTH = 32
# Index vectors have so many entries of +1 or -1.
NONZERO = 2
# The network is fitted on so many labelled rows at most, the first by a hash of their id, and on twice as many rows
# of documents with these ids.
MOST_LABELLED = 20_000
HIDDEN = 32
EPOCHS = 40
ACCEPTED = 0.3
FOLDS = 5
SLICE_BYTES = 3_000_000
KEPT_WORDS = 150_000
_SHAPE = bytes(
    ord("A") if 65 <= b <= 90 else ord("a") if 97 <= b <= 122 or b >= 128 else ord("0") if 48 <= b <= 57 else b
    for b in range(256)
)
_REPEATS = re.compile(rb"(.)\1+", re.DOTALL)
_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())


class Slots:
    """Slots of words (without case and marks around them) and of shapes (kinds of characters, repeats once)."""

    def __init__(self) -> None:
        self.kept: dict[bytes, tuple[int, int]] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self.kept) > KEPT_WORDS:
            self.kept.clear()
        known, half = self.kept, SLOTS // 2
        for word in words:
            if word not in known:
                shape = _REPEATS.sub(rb"\1", word.translate(_SHAPE))
                plain = word.lower().strip(_MARKS)
                known[word] = (
                    xxhash.xxh64_intdigest(plain) % half, half + xxhash.xxh64_intdigest(shape) % half
                )
        return np.array([known[w] for w in words], np.int64).reshape(-1, 2)


def _slots(words: list[bytes]) -> np.ndarray:
    return held("slots", Slots)(words)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the entries of every slot's index vector, the same on every machine."""
    hashes = [xxhash.xxh64_intdigest(f"{slot}-{n}") for slot in range(SLOTS) for n in range(NONZERO)]
    drawn = np.array(hashes, np.uint64).reshape(SLOTS, NONZERO)
    return (drawn % np.uint64(WIDTH)).astype(np.int64), np.where(drawn >> np.uint64(63), 1.0, -1.0)


def _add_contexts(sums: np.ndarray, slots: np.ndarray, bounds: np.ndarray, places, signs) -> None:
    """Adds to every token's slots the index vectors of the token before and of the one behind it."""
    joined = np.ones(max(len(slots) - 1, 0), bool)
    inner = bounds[(bounds > 0) & (bounds < len(slots))]
    joined[inner - 1] = False
    left, right = slots[:-1][joined], slots[1:][joined]
    for target, near in ((left, right), (right, left)):
        for own in target.T:
            for other in near.T:
                for n in range(NONZERO):
                    np.add.at(sums, own * WIDTH + places[other, n], signs[other, n])


def context_sums(docs: DataFrame) -> DataFrame:
    """(slot, vector): sums over all texts, one row a slot; each task adds up its texts before anything is shuffled."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        sums = np.zeros(SLOTS * WIDTH)
        for batch in slices(batches, "text", SLICE_BYTES):
            distinct, codes, bounds = word_codes(texts_of(batch.column("text")))
            _add_contexts(sums, _slots(distinct)[codes], bounds, places, signs)
        table = sums.reshape(SLOTS, WIDTH)
        used = np.flatnonzero(table.any(1))
        yield _rows_of(used, table[used])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            vectors = batch.column("vector").flatten().to_numpy().reshape(-1, WIDTH)
            for slot, vector in zip(batch.column("slot").to_pylist(), vectors):
                sums[slot] = sums[slot] + vector if slot in sums else vector
        order = sorted(sums)
        yield _rows_of(np.array(order, np.int64), np.array([sums[s] for s in order]).reshape(-1, WIDTH))

    schema = "slot long, vector array<double>"
    return docs.select("text").mapInArrow(add, schema).repartition("slot").mapInArrow(total, schema)


def _rows_of(slots: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
    offsets = np.arange(len(slots) + 1, dtype=np.int32) * WIDTH
    listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(vectors.ravel()))
    return pa.RecordBatch.from_arrays([pa.array(slots), listed], names=["slot", "vector"])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The table of vectors, SLOTS x WIDTH, each of length 1 or 0: two megabytes, whatever the corpus."""
    table = np.zeros((SLOTS, WIDTH), np.float32)
    for row in context_sums(docs).collect():
        table[row["slot"]] = row["vector"]
    return table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)


def pooled(texts: pa.Array, table: np.ndarray) -> np.ndarray:
    """Mean vector of the words and of the shapes of each text; zeros for a text without words."""
    distinct, codes, bounds = word_codes(texts)
    slots = _slots(distinct)
    counts = np.diff(bounds)
    out = np.zeros((len(counts), 2 * WIDTH), np.float32)
    own = np.concatenate([table[slots[:, 0]], table[slots[:, 1]]], axis=1)
    step = 1 << 16
    row = np.repeat(np.arange(len(counts)), counts)
    for at in range(0, len(codes), step):
        part, rows = own[codes[at:at + step]], row[at:at + step]
        first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        out[rows[first]] += np.add.reduceat(part, first, axis=0)
    return out / np.maximum(counts, 1)[:, None]


@dataclass
class Network:
    """Two layers over standardised features; the logit is divided by a temperature."""

    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        w, b, v, c = self.layers
        return (np.tanh((x - self.mean) / self.scale @ w + b) @ v + c)[:, 0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = 5) -> Network:
    """Trains on four of five rows and sets the temperature on the others; without rows every score is 0.5."""
    draw = np.random.default_rng(seed)
    width = x.shape[1]
    layers = [draw.normal(0, width**-0.5, (width, HIDDEN)), np.zeros(HIDDEN), np.zeros((HIDDEN, 1)), np.zeros(1)]
    net = Network(x.mean(0) if len(x) else np.zeros(width), x.std(0) + 1e-6 if len(x) else np.ones(width), layers)
    if not len(x):
        return net
    aside = np.arange(len(x)) % 5 == 4
    inputs, wanted = ((x - net.mean) / net.scale)[~aside], y[~aside].astype(float)
    first, second = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers]
    step, batch = 0, 128
    for epoch in range(epochs):
        order = draw.permutation(len(inputs))
        for at in range(0, len(order), batch):
            rows = order[at:at + batch]
            w, b, v, c = layers
            hidden = np.tanh(inputs[rows] @ w + b)
            error = (1 / (1 + np.exp(-np.clip(hidden @ v + c, -40, 40)))[:, 0] - wanted[rows])[:, None] / len(rows)
            back = error @ v.T * (1 - hidden**2)
            slopes = [inputs[rows].T @ back + 1e-4 * w, back.sum(0), hidden.T @ error + 1e-4 * v, error.sum(0)]
            step += 1
            rate = 0.004 * (1 - epoch / epochs)
            for p, g, m, s in zip(layers, slopes, first, second):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    if aside.any():
        logits, truth = net.logits(x[aside]), y[aside]
        sign = np.where(truth == 1, 1.0, -1.0)
        tried = np.geomspace(0.25, 8, 61)
        net.temperature = float(min(tried, key=lambda t: np.logaddexp(0, -sign * logits / t).mean()))
    return net


def _features(docs: DataFrame, table: Broadcast) -> DataFrame:
    """(label, features) of rows (label, text)."""
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            found = pooled(texts_of(batch.column("text")), table.value)
            offsets = np.arange(len(found) + 1, dtype=np.int32) * found.shape[1]
            listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.ravel().astype(np.float64)))
            yield pa.RecordBatch.from_arrays([batch.column("label"), listed], names=["label", "features"])

    return docs.mapInArrow(features, "label int, features array<double>")


def fit_model(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    most_labelled: int = MOST_LABELLED,
) -> tuple[Broadcast, Broadcast]:
    """Word vectors of all texts and the network fitted on a bounded sample of the labelled rows, both broadcast."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    table = spark.sparkContext.broadcast(word_vectors(texts))
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & (remainder(F.col(id_col), FOLDS) != 0))
    drawn = known.select(F.col(id_col).alias("of_"), F.col(label_col).cast("int").alias("label")).orderBy(
        F.xxhash64("of_"), "of_", "label").limit(most_labelled)
    drawn = materialize(drawn)
    sample = texts.join(F.broadcast(drawn), F.col("id") == F.col("of_")).select("label", "text")  # most_labelled rows
    rows = _features(sample, table).orderBy(F.xxhash64("features", "label")).limit(2 * most_labelled).collect()
    x = np.array([r["features"] for r in rows], np.float64).reshape(-1, 2 * WIDTH)
    return table, spark.sparkContext.broadcast(fit(x, np.array([r["label"] for r in rows], np.int64)))


def score_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    most_labelled: int = MOST_LABELLED,
) -> DataFrame:
    """One row per row of ``docs``: id, held_out, score (0 to 1, higher: label 1 is likelier) and predicted.

    held_out rows (crc32 of the id mod 5 is 0) give no labels. Word vectors are summed over all texts; only the text
    enters a score. The network learns from at most ``most_labelled`` labelled rows, the first by a hash of the id, and
    from twice as many pairs of such a row and a document with its id, the first by a hash of features and label;
    a label that is NULL or not 0 or 1 is left out, several labels of one id all count. predicted is 1 from a score of
    0.3. NULL counts as empty text, which gets a score too, as do rows with a NULL id. Repeated rows are scored alike.
    Without labels every score is 0.5. Other columns are ignored. No rows in, no rows out.
    """
    table, model = fit_model(docs, labels, id_col, text_col, label_col, most_labelled)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            scores = model.value.score(pooled(texts_of(batch.column("text")), table.value))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("held_out"), pa.array(scores),
                 pa.array((scores >= ACCEPTED).astype(np.int32))],
                names=[id_col, "held_out", "score", "predicted"],
            )

    ready = docs.select(
        F.col(id_col).alias("id"), (remainder(F.col(id_col), FOLDS) == 0).alias("held_out"), F.col(text_col).alias("text"))
    kind = ready.schema["id"].dataType.simpleString()
    return ready.mapInArrow(score, f"`{id_col}` {kind}, held_out boolean, score double, predicted int")


def drop_poor(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
) -> DataFrame:
    """The rows of ``docs`` with predicted 1, with all their columns; nothing is shuffled for it."""
    table, model = fit_model(docs, labels, id_col, text_col, label_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col, SLICE_BYTES):
            scores = model.value.score(pooled(texts_of(batch.column(text_col)), table.value))
            yield batch.filter(pa.array(scores >= ACCEPTED))

    return docs.mapInArrow(keep, docs.schema)
