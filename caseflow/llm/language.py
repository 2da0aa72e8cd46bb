"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are n-grams of one to three characters of the lower-cased text, in which every run of
non-letters is one space, hashed into a fixed number of slots; the weight is (1 + log count) times the
inverse document frequency, scaled to length one. Document frequencies come from all labelled texts.
The weights are fitted with follow-the-regularised-leader and an elastic-net penalty (whose L1 part
leaves most of them zero) on a bounded, documented sample of labelled rows, drawn by hash with an equal
expected share for each language. A part of the sample, not fitted on, sets the softmax temperature.

Results: null texts and texts without a letter are `und` with score 0; so is every text when no
language was learned. Rows with a null label teach nothing. Texts of any length are read whole, in
bounded pieces. Ties go to the language that sorts first. Repeated rows get equal results; input
columns named like the outputs are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, StringType, StructField, StructType

UNDETERMINED = "und"
SLOT_BITS, LONGEST = 15, 3
SLOTS = 1 << SLOT_BITS
#: Expected rows in the fitting sample, over all languages together; at most twice as many are fetched.
SAMPLE_ROWS = 2400
#: Every so-manieth row of the sample sets the temperature instead of the weights.
CALIBRATION = 4
#: Characters that are hashed at a time; it bounds the memory of a very long text.
AT_ONCE = 1 << 20


@cache
def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def gram_counts(text: str | None) -> np.ndarray | None:
    """Counts of all n-grams by slot; None for a text without a letter."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    letters = _letters()[points]
    if not letters.any():
        return None
    spaced = np.concatenate(([32], np.where(letters, points, 32), [32])).astype(np.uint32)
    spaced = spaced[np.concatenate(([True], (spaced[1:] != 32) | (spaced[:-1] != 32)))]
    counts = np.zeros(SLOTS, np.int64)
    for start in range(0, len(spaced), AT_ONCE):
        part = spaced[start : start + AT_ONCE + LONGEST - 1]
        gram = np.zeros(len(part), np.uint32)
        for n in range(LONGEST):
            gram = (gram[: len(part) - n] + part[n:] + np.uint32(n + 1)) * np.uint32(0x9E3779B1)
            own = gram[:AT_ONCE]
            counts += np.bincount((own ^ own >> np.uint32(15)) * np.uint32(0x85EBCA6B) >> np.uint32(32 - SLOT_BITS), minlength=SLOTS)
    return counts


def weigh(slots: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF of length one for the given slots."""
    x = (1 + np.log(counts)) * idf[slots]
    return x / (np.sqrt(x @ x) or 1)


@dataclass
class Model:
    """Languages in order, weights (slot, language), inverse document frequencies, temperature."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    idf: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or (counts := gram_counts(text)) is None:
            return UNDETERMINED, 0.0
        slots = counts.nonzero()[0]
        z = (weigh(slots, counts[slots], self.idf) @ self.weights[slots] + self.bias) / self.temperature
        p = softmax(z)
        best = int(p.argmax())
        return self.languages[best], float(min(1.0, p[best]))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def document_frequencies(docs: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """In how many texts with a letter each slot occurs, and how many such texts there are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, texts = np.zeros(SLOTS, np.int64), 0
        for batch in batches:
            for t in batch.column(0).to_pylist():
                if (counts := gram_counts(t)) is not None:
                    seen += counts > 0
                    texts += 1
        slots = seen.nonzero()[0]
        if texts:
            yield pa.RecordBatch.from_arrays([pa.array([*slots, -1], pa.int32()), pa.array([*seen[slots], texts], pa.int64())], ["slot", "n"])

    rows = docs.select(text_col).mapInArrow(count, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    total, frequency = 0, np.zeros(SLOTS)
    for slot, n in zip(rows["slot"], rows["n"], strict=True):
        if slot < 0:
            total = int(n)
        else:
            frequency[slot] = n
    return frequency, total


@F.arrow_udf(StructType([StructField("slots", ArrayType(IntegerType())), StructField("counts", ArrayType(FloatType()))]))
def sparse_counts(texts: pa.Array) -> pa.Array:
    made = [gram_counts(t) for t in texts.to_pylist()]
    slots = [[] if c is None else c.nonzero()[0].astype(np.int32) for c in made]
    values = [[] if c is None else c[s].astype(np.float32) for c, s in zip(made, slots, strict=True)]
    return pa.StructArray.from_arrays([pa.array(slots, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))], ["slots", "counts"])


def labelled_sample(docs: DataFrame, text_col: str, label_col: str, key: Column, rows: int) -> list:
    """About `rows` labelled rows as sparse counts, in the order of their hash."""
    sizes = {r.label: r.n for r in docs.groupBy(F.col(label_col).alias("label")).agg(F.count("*").alias("n")).collect()}
    share = rows / max(1, len(sizes))
    limits = F.create_map(*(F.lit(x) for label, n in sizes.items() for x in (label, min(1.0, share / n)))) if sizes else F.lit(None)
    point = F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30)) / (1 << 30)
    drawn = docs.where(point < limits[F.col(label_col)]) if sizes else docs.limit(0)
    chosen = drawn.select(F.col(label_col).alias("label"), point.alias("point"), F.col(text_col).alias("text")).limit(2 * rows)
    made = chosen.select("label", "point", sparse_counts("text").alias("x")).where(F.size("x.slots") > 0)
    return sorted(made.collect(), key=lambda r: (r.point, r.label, len(r.x.slots)))


def fit_weights(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, rate: float, l1: float, l2: float, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal with elastic net over (slots, values, class) rows; the last slot is the bias."""
    z, n = np.zeros((SLOTS + 1, classes)), np.zeros((SLOTS + 1, classes))

    def weights(zs: np.ndarray, ns: np.ndarray) -> np.ndarray:
        return -np.sign(zs) * np.maximum(np.abs(zs) - l1, 0) / ((1 + np.sqrt(ns)) / rate + l2)

    for _ in range(rounds):
        for slots, values, label in rows:
            at, x = np.append(slots, SLOTS), np.append(values, 1.0)
            zs, ns = z[at], n[at]
            w = weights(zs, ns)
            p = softmax(x @ w)
            p[label] -= 1
            g = np.outer(x, p)
            grown = ns + g * g
            z[at] = zs + g - (np.sqrt(grown) - np.sqrt(ns)) / rate * w
            n[at] = grown
    w = weights(z, n)
    return w[:SLOTS], w[SLOTS]


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of the least log loss on held-back rows, by golden sections over its logarithm.

    The targets leave 1 / (rows + 2) to the other languages, so that rows without an error do not ask
    for certainty.
    """
    spare = 1 / (len(labels) + 2)
    target = np.full(logits.shape, spare / (logits.shape[1] - 1))
    target[np.arange(len(labels)), labels] = 1 - spare

    def loss(log_t: float) -> float:
        return -(target * np.log(np.maximum(softmax(logits / np.exp(log_t)), 1e-12))).sum(axis=1).mean()

    low, high, ratio = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train(docs: DataFrame, text_col: str, label_col: str, key: Column, sample_rows: int = SAMPLE_ROWS, rate: float = 1.0, l1: float = 0.02, l2: float = 0.002, rounds: int = 4) -> Model:
    """A model from the rows of docs that have a label; key draws the fitting sample by its hash."""
    labelled = docs.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    frequency, total = document_frequencies(labelled, text_col)
    idf = np.log((1 + total) / (1 + frequency)) + 1
    sample = labelled_sample(labelled, text_col, label_col, key, sample_rows)
    languages = sorted({r.label for r in sample})
    code = {label: i for i, label in enumerate(languages)}
    rows = []
    for r in sample:
        slots = np.asarray(r.x.slots, np.int64)
        rows.append((slots, weigh(slots, np.asarray(r.x.counts, float), idf), code[r.label]))
    held_back = rows[::CALIBRATION] if len(rows) >= 2 * CALIBRATION else []
    fitted = [r for i, r in enumerate(rows) if i % CALIBRATION] if held_back else rows
    weights, bias = fit_weights(fitted, max(1, len(languages)), rate, l1, l2, rounds)
    temperature = 1.0
    if held_back and len(languages) > 1:
        logits = np.array([x @ weights[slots] + bias for slots, x, _ in held_back])
        temperature = fit_temperature(logits, np.array([label for *_, label in held_back]))
    return Model(languages, weights.astype(np.float32), bias.astype(np.float32), idf.astype(np.float32), temperature)


PREDICTION = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType())])


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents with lang_pred and score."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # languages times slots, whatever the corpus

    @F.arrow_udf(PREDICTION)
    def predicted(texts: pa.Array) -> pa.Array:
        known = shipped.value
        found = [known.predict(t) for t in texts.to_pylist()]
        return pa.StructArray.from_arrays([pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], ["lang_pred", "score"])

    columns = [F.col(c) for c in docs.columns if c not in ("lang_pred", "score")]
    return docs.select(*columns, predicted(F.col(text_col)).alias("found_lang")).select(*columns, "found_lang.lang_pred", "found_lang.score")
