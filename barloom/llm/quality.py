"""Quality classifier: Naive Bayes support vectors.

A document is the set of its hashed n-grams. Each n-gram's indicator is scaled by the log of the
ratio of its rates in the two classes; a linear model with hinge loss is fitted to the scaled,
length-normalised vectors by dual coordinate descent. Three kinds of n-grams see a text: its
bytes, its shape (runs of a class of characters as one sign) and its words as (first sign, last
sign, length, same as the word before).

The fit uses at most ``rows_per_class`` labelled rows of each class, those with the smallest hash of
their id; the sets of n-grams come to the driver as bitmaps of ``2**BITS`` bits. Scoring is a
function of one text, so it runs wherever the texts are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bits of the hash of an n-gram.
BITS = 17
#: Labelled rows of each class that a fit uses at most.
ROWS_PER_CLASS = 1000


def _signs() -> np.ndarray:
    """The sign of each byte: blank, upper case, lower case or beyond ASCII, digit; others are their own."""
    table = np.arange(256, dtype=np.uint32)
    table[0x80:] = table[ord("a") : ord("z") + 1] = ord("a")
    table[ord("A") : ord("Z") + 1] = ord("A")
    table[ord("0") : ord("9") + 1] = ord("0")
    table[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = ord(" ")
    return table


SIGNS = _signs()


def _grams(codes: np.ndarray, sizes: tuple[int, ...], salt: int, bits: int) -> list[np.ndarray]:
    """Hashes of the runs of ``codes`` of these sizes."""
    found = []
    for size in sizes:
        if len(codes) < size:
            continue
        h = np.full(len(codes) - size + 1, salt * 0x9E3779B1 + size & 0xFFFFFFFF, np.uint32)
        for k in range(size):
            h ^= codes[k : len(codes) - size + 1 + k]
            h *= np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(15)
        found.append((h * np.uint32(0xC2B2AE35)) >> np.uint32(32 - bits))
    return found


def ngram_set(text: str | None, bits: int = BITS) -> np.ndarray:
    """The sorted hashes of the n-grams of a whole text; none for null and empty texts."""
    raw = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    if not len(raw):
        return np.empty(0, np.int64)
    signs = SIGNS[raw]
    blank = signs == ord(" ")
    turns = np.flatnonzero(np.concatenate(([True], signs[1:] != signs[:-1])))
    found = _grams(raw.astype(np.uint32), (3, 4), 1, bits) + _grams(signs[turns], (1, 2, 3, 4, 5), 2, bits)
    starts = np.flatnonzero(~blank & np.concatenate(([True], blank[:-1])))
    if len(starts):
        ends = np.flatnonzero(~blank & np.concatenate((blank[1:], [True]))) + 1
        lengths = ends - starts
        letters = np.flatnonzero(~blank)
        places = letters - np.repeat(starts, lengths)
        spread = (raw[letters].astype(np.uint32) + 1) * (places.astype(np.uint32) * np.uint32(2654435761) + np.uint32(97))
        hashed = np.add.reduceat(spread * (spread >> np.uint32(7) | np.uint32(1)), np.concatenate(([0], np.cumsum(lengths)[:-1])))
        same = np.concatenate(([False], (hashed[1:] == hashed[:-1]) & (lengths[1:] == lengths[:-1])))
        words = signs[starts] << np.uint32(16) | signs[ends - 1] << np.uint32(8) | np.minimum(lengths, 9).astype(np.uint32) << np.uint32(2)
        found += _grams(words | same, (1, 2, 3), 3, bits) + _grams(same.astype(np.uint32), (3, 6), 4, bits)
    seen = np.zeros(1 << bits, bool)
    for h in found:
        seen[h] = True
    return np.flatnonzero(seen)


@dataclass
class QualityModel:
    """``score = sigmoid(slope * margin + offset)``; a model without examples of both classes has no n-grams."""

    scaled: np.ndarray
    squares: np.ndarray
    bias: float
    slope: float
    offset: float
    bits: int = BITS

    def margin(self, found: np.ndarray) -> float:
        norm = float(np.sqrt(self.squares[found].sum()))
        return float(self.scaled[found].sum()) / norm + self.bias if norm else self.bias

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(ngram_set(text, self.bits)) + self.offset, -30, 30))))


def log_count_ratios(sets: list[np.ndarray], labels: np.ndarray, size: int, smoothing: float = 1.0) -> np.ndarray:
    """The log of each n-gram's share of the indicators of class 1 over its share of those of class 0."""
    counts = np.full((2, size), smoothing)
    for found, label in zip(sets, labels, strict=True):
        counts[int(label)][found] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def dual_coordinate_descent(
    sets: list[np.ndarray], labels: np.ndarray, scale: np.ndarray, cost: float = 1.0, epochs: int = 40, tolerance: float = 0.01
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise half the squared weights plus ``cost`` times the hinge losses
    of the unit vectors ``scale[set]``; the bias is the weight of one more constant coordinate."""
    norms = np.array([float(np.sqrt((scale[found] ** 2).sum())) for found in sets])
    signs = np.where(labels == 1, 1.0, -1.0)
    weights, bias, alpha = np.zeros(len(scale)), 0.0, np.zeros(len(sets))
    order = np.random.default_rng(7)
    for _ in range(epochs):
        worst = 0.0
        for i in order.permutation(len(sets)):
            found, square = sets[i], 2.0 if norms[i] else 1.0
            values = scale[found] / (norms[i] or 1.0)
            slope = signs[i] * (weights[found] @ values + bias) - 1
            projected = min(slope, 0) if alpha[i] == 0 else max(slope, 0) if alpha[i] == cost else slope
            if projected:
                worst = max(worst, abs(projected))
                new = min(max(alpha[i] - slope / square, 0.0), cost)
                step = (new - alpha[i]) * signs[i]
                weights[found] += step * values
                bias += step
                alpha[i] = new
        if worst < tolerance:
            break
    return weights, bias


def fit_sigmoid(margins: np.ndarray, labels: np.ndarray, importance: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through the margins, with smoothed targets, by Newton steps."""
    high, low = importance[labels == 1].sum(), importance[labels == 0].sum()
    target = np.where(labels == 1, (high + 1) / (high + 2), 1 / (low + 2))
    x = np.column_stack((margins, np.ones(len(margins))))
    theta = np.array([1.0, 0.0])

    def loss(t: np.ndarray) -> float:
        z = x @ t
        return float((importance * (np.logaddexp(0, z) - target * z)).sum()) + 1e-3 * float(t @ t)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        gradient = x.T @ (importance * (p - target)) + 2e-3 * theta
        hessian = (x * (importance * p * (1 - p))[:, None]).T @ x + 2e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        size = 1.0
        while size > 1e-6 and loss(theta - size * step) > loss(theta):
            size /= 2
        theta = theta - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return max(float(theta[0]), 1e-3), float(theta[1])


def fit_sets(sets: list[np.ndarray], labels: np.ndarray, totals: tuple[int, int], bits: int = BITS) -> QualityModel:
    """The model of labelled sets of n-grams. ``totals``: all labelled rows of class 0 and of class 1; the
    score is a probability at their mix. With one class only (or none) every text gets that class's share."""
    size = 1 << bits
    prior = (totals[1] + 1) / (sum(totals) + 2)
    if len(set(labels.tolist())) < 2:
        return QualityModel(np.zeros(size), np.zeros(size), 0.0, 1.0, float(np.log(prior / (1 - prior))), bits)
    fold = np.arange(len(sets)) % 5 == 0
    checked = min((labels[fold] == 0).sum(), (labels[fold] == 1).sum()) >= 5
    kept = ~fold if checked else np.ones(len(sets), bool)

    def fit(chosen: np.ndarray) -> QualityModel:
        own = [sets[i] for i in np.flatnonzero(chosen)]
        scale = log_count_ratios(own, labels[chosen], size)
        weights, bias = dual_coordinate_descent(own, labels[chosen], scale)
        return QualityModel(weights * scale, scale * scale, bias, 1.0, 0.0, bits)

    half, tested = fit(kept), fold if checked else kept
    margins = np.array([half.margin(sets[i]) for i in np.flatnonzero(tested)])
    share = np.array([totals[0] / max((labels[tested] == 0).sum(), 1), totals[1] / max((labels[tested] == 1).sum(), 1)])
    share *= tested.sum() / max(sum(totals), 1)
    slope, offset = fit_sigmoid(margins, labels[tested], share[labels[tested].astype(int)])
    model = fit(np.ones(len(sets), bool)) if checked else half
    model.slope, model.offset = slope, offset
    return model


def train_quality(
    documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows_per_class: int = ROWS_PER_CLASS, bits: int = BITS
) -> QualityModel:
    """Fit on the labelled documents. Labels other than 0 and 1 and null ids are left out; a document with
    both labels counts as 0. Repeated ids count once for each row of ``documents``, up to the bound.
    """
    label = F.col(f"`{label_col}`")
    known = (
        labels.select(F.col(f"`{id_col}`").alias("id"), label.cast("int").alias("label"))
        .where("label in (0, 1) and id is not null")
        .groupBy("id")
        .agg(F.min("label").alias("label"))
    )
    totals = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    order = [F.xxhash64("id"), F.col("id")]
    # A threshold on the hash leaves about four times as many ids as are wanted, however many there are.
    share = {k: 4.0 * rows_per_class / max(totals.get(k, 0), 1) * (1 << 31) for k in (0, 1)}
    near = {k: known.where((F.col("label") == k) & (F.pmod(F.xxhash64("id"), F.lit(1 << 31)) < share[k])) for k in (0, 1)}
    parts = [near[k].orderBy(*order).limit(rows_per_class) for k in (0, 1)]
    sample = parts[0].unionByName(parts[1])
    texts = documents.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))

    def bitmaps(batches):
        for frame in batches:
            maps = [_bitmap(x, bits) for x in frame["text"]]
            yield pd.DataFrame({"id": frame["id"].astype(str), "label": frame["label"], "found": maps})

    first = Window.partitionBy("label").orderBy(F.xxhash64("id"), "id", F.xxhash64("found"))
    rows = (
        texts.join(F.broadcast(sample), "id")
        .select("id", "label", "text")
        .mapInPandas(bitmaps, "id string, label int, found binary")
        .withColumn("turn", F.row_number().over(first))
        .where(F.col("turn") <= rows_per_class)
        .orderBy(F.xxhash64("id"), "id", F.xxhash64("found"))
        .collect()
    )
    sets = [np.flatnonzero(np.unpackbits(np.frombuffer(r["found"], np.uint8))).astype(np.int32) for r in rows]
    marks = np.array([r["label"] for r in rows], int)
    del rows
    return fit_sets(sets, marks, (totals.get(0, 0), totals.get(1, 0)), bits)


def _bitmap(text: str | None, bits: int) -> bytes:
    seen = np.zeros(1 << bits, np.uint8)
    seen[ngram_set(text, bits)] = 1
    return np.packbits(seen).tobytes()


def quality_score(model: QualityModel, text: Column) -> Column:
    """The probability of label 1 for each text; null counts as empty."""
    shared = SparkSession.getActiveSession().sparkContext.broadcast(vars(model))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        own = QualityModel(**shared.value)
        return pd.Series([own.score(x) for x in texts], dtype="float64")

    return score(text)
