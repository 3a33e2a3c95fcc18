"""Language identification by averaged embeddings of hashed subwords.

A text is the average of the embeddings of its subwords: the one to four
letters that follow each other in a word, where a space marks either end of
the word, hashed to a fixed number of buckets. A linear softmax over that
average names the language. Embeddings and softmax are trained together by
stochastic gradient descent in numpy on a bounded sample; a part of the sample
that the descent does not see gives the temperature that calibrates the scores
and the score below which a prediction is marked as rejected.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
BUCKETS, LONGEST, WIDTH = 1 << 16, 4, 16
# Rows of the sample over all languages; what a row brings is at most one number for each bucket.
SAMPLE_ROWS, MOST_LANGUAGES = 1_200, 1_000
EPOCHS, RATE, CALIBRATION_SHARE = 8, 0.3, 0.2
# A small sample is gone through more often, up to so many steps.
LEAST_STEPS = 8_000
# Share of errors among the predictions that are not rejected, on the calibration rows.
ACCEPTED_ERRORS = 0.01
# Characters of a text that are hashed at once.
BLOCK = 1 << 18

_NOT_LETTERS = re.compile(r"[\W\d_]+")
_FACTOR, _SPREAD = np.uint32(16777619), np.uint32(2654435769)


def letters(text: str) -> str:
    """The text in lower case, with spaces where no letters stand."""
    found = _NOT_LETTERS.sub(" ", text.lower())
    # Word characters that are neither letters nor decimal digits, such as superscripts.
    other = [c for c in set(found) if c != " " and not c.isalpha()]
    return found.translate(dict.fromkeys(map(ord, other), " ")) if other else found


def subwords(text: str, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(buckets in use, occurrences) of the subwords of a whole text.

    The text is taken block by block; the last characters of a block go on
    into the next, so that the blocks leave no trace in the counts.
    """
    counts = None
    carried = np.array([32], np.uint32)
    shift = np.uint32(32 - int(math.log2(buckets)))
    for start in range(0, len(text) + 1, BLOCK):
        block = letters(text[start:start + BLOCK])
        if start + BLOCK > len(text):
            block += " "
        codes = np.concatenate([carried, np.frombuffer(block.encode("utf-32-le", "surrogatepass"), np.uint32)])
        old, space = len(carried), codes == 32
        hashed, open_, found = np.full(len(codes), 2166136261, np.uint32), ~space, []
        for n in range(1, LONGEST + 1):
            # Position i stands for the n codes that begin there; a space may only be the first or the last.
            last = len(codes) - n + 1
            if last <= 0:
                break
            hashed = (hashed[:last] ^ codes[n - 1:]) * _FACTOR
            if n == 2:
                open_ = open_[:last] | open_[1:]
            elif n > 2:
                open_ = open_[:last] & ~space[n - 2:len(codes) - 1]
            fresh = max(old - n + 1, 0)
            found.append(hashed[fresh:][open_[fresh:last]])
        hits = np.bincount((np.concatenate(found) * _SPREAD) >> shift, minlength=buckets)
        counts = hits if counts is None else counts + hits
        carried = codes[-(LONGEST - 1):]
    used = np.flatnonzero(counts)
    return used, counts[used]


@dataclass
class Model:
    labels: list[str]
    embeddings: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, used: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return (counts / counts.sum()) @ self.embeddings[used] @ self.weights + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and calibrated score; a tie goes to the first language by code point."""
        used, counts = subwords(text or "", len(self.embeddings))
        if not self.labels or not len(used):
            return UNKNOWN, 0.0
        chances = _softmax(self.logits(used, counts) / self.temperature)
        best = int(np.argmax(chances))
        return self.labels[best], float(chances[best])


def _softmax(logits: np.ndarray) -> np.ndarray:
    found = np.exp(logits - logits.max(-1, keepdims=True))
    return found / found.sum(-1, keepdims=True)


def train(
    rows: list[tuple[np.ndarray, np.ndarray, int]], labels: list[str], buckets: int = BUCKETS, seed: int = 7,
    epochs: int | None = None, rate: float = RATE,
) -> Model:
    """Fit by gradient descent, one row a step; ``rows`` holds buckets, occurrences and the number of the label."""
    rng = np.random.default_rng(seed)
    model = Model(
        labels, rng.uniform(-1 / WIDTH, 1 / WIDTH, (buckets, WIDTH)), np.zeros((WIDTH, len(labels))), np.zeros(len(labels)))
    epochs = epochs or max(EPOCHS, LEAST_STEPS // max(1, len(rows)))
    steps, done = max(1, epochs * len(rows)), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            used, counts, label = rows[i]
            pace = rate * (1 - done / steps)
            done += 1
            share = counts / counts.sum()
            hidden = share @ model.embeddings[used]
            error = _softmax(hidden @ model.weights + model.bias)
            error[label] -= 1
            back = model.weights @ error
            model.weights -= pace * np.outer(hidden, error)
            model.bias -= 0.1 * pace * error
            # As the share of one subword is small, its embedding takes the step of the most frequent one in full.
            model.embeddings[used] -= pace * np.outer(share / share.max(), back)
    return model


def calibrate(model: Model, rows: list[tuple[np.ndarray, np.ndarray, int]], errors: float = ACCEPTED_ERRORS) -> Model:
    """Set temperature and threshold from rows that the fit did not see; without any, both stay as they are."""
    if not rows:
        return model
    logits = np.array([model.logits(used, counts) for used, counts, _ in rows])
    truth = np.array([label for _, _, label in rows])

    # A row that is right stands for slightly less than certainty, as in Platt's scaling.
    spread = np.full(logits.shape, 1 / (len(truth) + 2) / max(1, len(model.labels) - 1))
    spread[np.arange(len(truth)), truth] = (len(truth) + 1) / (len(truth) + 2)

    def loss(temperature: float) -> float:
        return float(-(spread * np.log(np.maximum(_softmax(logits / temperature), 1e-300))).sum())

    model.temperature = float(min(np.geomspace(0.05, 20, 200), key=loss))
    chances = _softmax(logits / model.temperature)
    best = chances.max(1)
    order = np.argsort(-best, kind="stable")
    ordered, wrong = best[order], (chances.argmax(1) != truth)[order]
    # The longest run of falling scores with few enough errors; equal scores stand or fall together.
    whole = np.append(ordered[:-1] > ordered[1:], True)
    allowed = np.flatnonzero(whole & (np.cumsum(wrong) <= errors * np.arange(1, len(wrong) + 1)))
    model.threshold = float(ordered[allowed[-1]]) if len(allowed) else float(np.nextafter(ordered[0], 2))
    return model


def held_out(key: str | Column) -> Column:
    """Whether a document is kept from training; one without an id is neither held out nor learnt from."""
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))


def sample(df: DataFrame, key: str, text: str, label: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(order, label, text) of at most ``rows`` labelled rows, alike for all labels, drawn by a hash of the key.

    Labels are counted first, so that only about as many rows as are drawn
    have to be sorted, however many a label has.
    """
    known = df.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(label).alias("label")).filter(
        "key IS NOT NULL AND label IS NOT NULL AND text IS NOT NULL").filter(~held_out("key"))
    sizes = known.groupBy("label").count().orderBy("label").limit(MOST_LANGUAGES + 1).collect()
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not sizes:
        return known.limit(0).select(F.lit(0).cast("long").alias("order"), "label", "text")
    each = max(1, rows // len(sizes))
    draw = F.xxhash64(F.lit("sample"), F.col("key").cast("string"))
    part = F.pmod(draw, F.lit(1 << 32))
    # Twice the rows wanted, and some more, so that a label hardly ever comes short.
    wanted = F.coalesce(*[
        F.when(F.col("label") == r["label"], F.lit(int(min(1.0, (2 * each + 20) / r["count"]) * (1 << 32)))) for r in sizes])
    drawn = known.withColumn("order", draw).filter(part < wanted)
    ranked = drawn.withColumn("rank", F.row_number().over(Window.partitionBy("label").orderBy("order", "text")))
    return ranked.filter(F.col("rank") <= each).select("order", "label", "text")


def fit(df: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", rows: int = SAMPLE_ROWS) -> Model:
    """A model of the labelled rows that are not held out.

    Subwords are counted in the tasks; the driver gets at most ``rows`` lists
    of at most ``BUCKETS`` numbers, fits and calibrates. Rows without a letter
    are left out. Without labelled rows the model knows no language.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [subwords(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([u for u, _ in found], pa.list_(pa.int32())),
                pa.array([c for _, c in found], pa.list_(pa.int64())),
            ], names=["order", "label", "used", "counts"])

    counted = sample(df, key, text, label, rows).mapInArrow(run, "order long, label string, used array<int>, counts array<long>")
    drawn = sorted((r for r in counted.collect() if r.used), key=lambda r: (r.label, r.order, r.used, r.counts))
    labels = sorted({r.label for r in drawn})
    number = {name: i for i, name in enumerate(labels)}
    known = [(np.array(r.used), np.array(r.counts, float), number[r.label]) for r in drawn]
    every = round(1 / CALIBRATION_SHARE)
    aside = [r for i, r in enumerate(known) if i % every == every - 1]
    return calibrate(train([r for i, r in enumerate(known) if i % every != every - 1], labels), aside)


def identify(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, lang_pred, score, rejected) for every row, from nothing but its text.

    A null text, one without a letter, and every text under a model without
    languages is ``und`` with score 0 and rejected. A prediction whose
    calibrated score is below the model's threshold is marked as rejected and
    keeps its language. Equal texts get equal results; an empty table gives an
    empty result; further columns are not carried. Texts are counted whole.
    """
    kind = df.schema[key].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            found = [known.predict(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([n for n, _ in found], pa.string()),
                pa.array([s for _, s in found], pa.float64()),
                pa.array([n == UNKNOWN or s < known.threshold for n, s in found], pa.bool_()),
            ], names=["key", "held_out", "lang_pred", "score", "rejected"])

    rows = df.select(F.col(key).alias("key"), held_out(key).alias("held_out"), F.col(text).alias("text"))
    layout = f"key {kind}, held_out boolean, lang_pred string, score double, rejected boolean"
    return rows.mapInArrow(run, layout).withColumnRenamed("key", key)
