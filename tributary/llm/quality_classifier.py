"""Naive Bayes support vectors: n-gram indicators scaled by class log-count ratios, and a linear hinge-loss
model fitted by dual coordinate descent.

Features of a text are indicators, hashed to ``BUCKETS``: runs of three bytes with the space between words as one
of them (so style and alphabet generalise to words never seen), and runs of two to four equal words, one bucket for each length (2, 3 and 4).
The log-count ratio of each feature is counted over the fitting rows, in two numbers per bucket, and scales its
indicator. A Platt curve over the fitting margins turns margins into probabilities.

Only the fitting rows are bounded: ``MAX_ROWS`` labelled rows, those with the smallest hash of their id. All rows are
scored, in batches of bit sets, by a model of ``BUCKETS`` numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.llm.blocks import small_batches
from tributary.llm.words import U, gram_hashes, split_words, steps

BUCKETS = 1 << 15
#: Bound of the sample the model is fitted on.
MAX_ROWS = 6000
#: Texts whose indicators are held at once.
_TEXTS = 256
SMOOTHING = 1.0
COST = 0.05
EPOCHS = 12
REJECT_BELOW = 0.3
_GRAM = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


@dataclass
class Model:
    weights: np.ndarray  # per bucket: log-count ratio times hinge weight
    bias: float
    slope: float
    shift: float

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def indicators(texts: pa.ChunkedArray):
    """Yields (first text, bit matrix of texts by buckets) for at most ``_TEXTS`` texts at a time."""
    words = split_words(texts)
    data = np.where(words.data < 33, np.uint8(32), words.data).astype(np.uint32)
    gram = (data[:-2] * _GRAM[0] + data[1:-1] * _GRAM[1] + data[2:] * _GRAM[2]) if len(data) > 2 else np.zeros(0, np.uint32)
    gram = ((gram ^ (gram >> np.uint32(15))) * _GRAM[1]) >> np.uint32(32 - 15)
    inside = np.ones(len(data), bool)  # grams that do not reach into the next text
    inside[words.text_end] = inside[words.text_end - 1] = False
    inside = inside[: len(gram)]
    hashes = words.hashes()
    same = [np.zeros(0, np.int64)]
    for n in (2, 3, 4):
        first = gram_hashes(hashes, 1)
        run = np.ones(max(0, len(hashes) - n + 1), bool)
        for k in range(1, n):
            run &= (first[k : k + len(run)] == first[: len(run)]) & (words.text[k : k + len(run)] == words.text[: len(run)])
        same.append(words.text[: len(run)][run] * BUCKETS + n)  # buckets 2, 3 and 4 stand for runs of equal words
    repeats = np.unique(np.concatenate(same))
    starts = np.concatenate([[0], words.text_end[:-1] + 1])
    for at in range(0, words.n_texts, _TEXTS):
        stop = min(at + _TEXTS, words.n_texts)
        bits = np.zeros((stop - at, BUCKETS), bool)
        lo, hi = starts[at], max(starts[at], words.text_end[stop - 1] - 1)  # the last gram ends with the text's line feed
        row = np.repeat(np.arange(stop - at), words.text_end[at:stop] + 1 - starts[at:stop])[: hi - lo]
        bits.reshape(-1)[(row * BUCKETS + gram[lo:hi])[inside[lo:hi]]] = True
        own = repeats[(repeats >= at * BUCKETS) & (repeats < stop * BUCKETS)] - at * BUCKETS
        bits.reshape(-1)[own] = True
        yield at, bits


def _features(batches):
    """Sorted buckets of each text, packed."""
    for batch in batches:
        for part in steps(batch, "text"):
            packed = []
            for _, bits in indicators(part["text"]):
                packed += [np.flatnonzero(x).astype("<u2").tobytes() for x in bits]
            yield pa.record_batch({"label": part["label"].combine_chunks(), "buckets": pa.array(packed, pa.binary())})


def _dual_descent(rows: list[np.ndarray], sign: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """L2-regularised hinge loss by dual coordinate descent; the bias is one more feature of value 1."""
    w, bias = np.zeros(BUCKETS), 0.0
    values = [ratio[x] for x in rows]
    norm = np.array([v @ v + 1.0 for v in values])
    alpha = np.zeros(len(rows))
    upper = COST * np.where(sign > 0, len(sign) / max(1, 2 * (sign > 0).sum()), len(sign) / max(1, 2 * (sign < 0).sum()))
    rng = np.random.default_rng(7)
    for _ in range(EPOCHS):
        largest = 0.0
        for i in rng.permutation(len(rows)):
            gradient = sign[i] * (w[rows[i]] @ values[i] + bias) - 1
            step = min(max(alpha[i] - gradient / norm[i], 0.0), upper[i]) - alpha[i]
            if step:
                alpha[i] += step
                w[rows[i]] += step * sign[i] * values[i]
                bias += step * sign[i]
                largest = max(largest, abs(step))
        if largest < 1e-4:
            break
    return w, bias


def _platt(margin: np.ndarray, positive: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through the margins, by Newton steps on smoothed targets."""
    n_pos, n_neg = positive.sum(), (~positive).sum()
    target = np.where(positive, (n_pos + 1) / (n_pos + 2), 1 / (n_neg + 2))
    x = np.stack([margin, np.ones(len(margin))], axis=1)
    theta = np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (target - p) - 1e-3 * (theta - [1, 0]))
        theta = theta + np.clip(step, -2, 2)
    return max(1e-3, float(theta[0])), float(theta[1])


def fit(labelled: DataFrame, text_col: str = "text", label_col: str = "label", id_col: str = "doc_id", max_rows: int = MAX_ROWS) -> Model:
    """Model of P(label = 1) from at most ``max_rows`` rows; rows whose label is null or not 0 or 1 are left out.

    With rows of one class only, every text gets the smoothed share of that class.
    """
    small_batches(labelled.sparkSession)
    plain = labelled.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(label_col).cast("int").alias("label"))
    sample = plain.where("label IN (0, 1)").orderBy(F.xxhash64("doc_id"), "doc_id", "text", "label").limit(max_rows)
    found = sample.select("text", "label").mapInArrow(_features, "label int, buckets binary").toArrow()  # bounded by max_rows
    positive = found["label"].to_numpy() == 1
    rows = [np.frombuffer(x, "<u2").astype(np.int64) for x in found["buckets"].to_pylist()]
    if positive.all() or not positive.any():
        share = (positive.sum() + 1) / (len(positive) + 2)
        return Model(np.zeros(BUCKETS), 0.0, 1.0, float(np.log(share / (1 - share))))
    counts = [np.bincount(np.concatenate([x for x, p in zip(rows, positive) if p == side]), minlength=BUCKETS) + SMOOTHING for side in (True, False)]
    ratio = np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum())
    sign = np.where(positive, 1.0, -1.0)
    # Margins for the curve come from rows the model did not see: each half is scored by a fit on the other.
    half = np.arange(len(rows)) % 2 == 0
    margin = np.zeros(len(rows))
    for own in (half, ~half):
        if len(set(sign[~own])) == 2:
            w, b = _dual_descent([x for x, o in zip(rows, own) if not o], sign[~own], ratio)
            margin[own] = [w[x] @ ratio[x] + b for x, o in zip(rows, own) if o]
    w, bias = _dual_descent(rows, sign, ratio)
    slope, shift = _platt(margin, positive)
    return Model(w * ratio, bias, slope, shift)


def _score(model: Model, text_col: str):
    weights = model.weights.astype(np.float32)

    def run(batches):
        for batch in batches:
            for part in steps(batch, text_col):
                margin = np.zeros(part.num_rows)
                for at, bits in indicators(part[text_col]):
                    flat = np.flatnonzero(bits)
                    margin[at : at + len(bits)] = np.bincount(flat >> 15, weights=weights[flat & (BUCKETS - 1)], minlength=len(bits))
                score = model.probability(margin + model.bias)
                yield from part.append_column("score", pa.array(score)).combine_chunks().to_batches()

    return run


def score_rows(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with score and predicted behind its columns, which replace columns of these names; see score()."""
    small_batches(docs.sparkSession)
    plain = docs.drop("score", "predicted")
    fields = T.StructType([*plain.schema.fields, T.StructField("score", T.DoubleType())])
    return plain.mapInArrow(_score(model, text_col), fields).withColumn("predicted", F.when(F.col("score") >= REJECT_BELOW, 1).otherwise(0))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) of every row; score is P(label = 1) of the whole text, predicted 1 from REJECT_BELOW on.

    Only the text is an input. A null or empty text has no indicators but the bias and gets its score. Repeated rows and null ids are
    scored like any other row; other columns are ignored; an empty table gives no rows.
    """
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return score_rows(plain, model).select("doc_id", "score", "predicted")


def held_out(id_col: str = "doc_id") -> F.Column:
    """Rows no label is learnt from; false without an id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def fit_on_labels(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Model of ``labels.quality``, from rows that are not held out."""
    known = labels.select("doc_id", F.col("quality").alias("label")).where(~held_out()).where("label IN (0, 1)")
    # The sample is chosen on the ids alone, so that few texts move.
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_rows)
    texts = docs.select("doc_id", "text")
    return fit(texts.join(F.broadcast(chosen), "doc_id"), max_rows=max_rows)  # broadcast: at most max_rows rows
