"""Toxic passages by maximum-scoring segments of token log-odds.

Words are lower-cased (A-Z) `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`. From labelled rows each word gets the log-odds of being in a toxic rather
than in another document, with a Dirichlet prior in proportion to its frequency in both; words whose log-odds are `least_z` standard
deviations above zero score by them, all others score `-drift`. One linear pass finds every maximal scoring segment of a text.

A segment of score S among n words is expected `n * exp(-lambda * S)` times by chance, where lambda solves the equation of Karlin and
Altschul for the words of documents that are not toxic; segments with an expectation below `least_expected` are significant. The best
segment's expectation and the number of significant segments become a probability by a logistic fit on labelled rows that the log-odds
did not see.

Labels are read from at most `sample` rows, the first by a hash of their id (documented bound of the fit); words are counted over all
of their whole texts, and the model holds at most `most_words` words, the most significant ones. Every document is scored in whole.

Null and empty texts have no segment and score as such. A document with two labels counts as toxic if one says so. Without labelled rows
of both classes no word scores. Repeated rows are judged alike; result columns replace columns of the same name.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runsift.llm.frames import append_columns, slices
from runsift.llm.words import LETTER_OR_DIGIT, LOWER, U, hashes, prefix_sums, spans, text_bytes

SAMPLE, MOST_WORDS = 20_000, 20_000
LEAST_Z, DRIFT, PRIOR_SHARE = 3.0, 0.5, 0.05
LEAST_EXPECTED = 0.05
THRESHOLD = 0.7


def labelled(docs: DataFrame, labels: DataFrame, label: str, allowed: Column | None, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, text, label) of at most `sample` labelled documents, the first by a hash of their id."""
    held = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    held = held if allowed is None else held.where(allowed)
    chosen = held.groupBy("doc_id").agg(F.max(label).cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


class Model(NamedTuple):
    hashes: np.ndarray  # of words that score, sorted
    scores: np.ndarray
    decay: float  # lambda
    drift: float
    weights: np.ndarray  # of the logistic fit: constant, best segment, significant segments


def _text_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = LOWER[data]
    found = spans(data, offsets, LETTER_OR_DIGIT)
    return hashes(prefix_sums(data), found.starts, found.ends), found.first


def _word_counts(batches):
    """Number of documents of each label that hold a word, for each batch."""
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        label = np.asarray(batch.column("label").to_numpy(zero_copy_only=False)) > 0
        for low, high in slices(offsets):
            words, first = _text_words(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
            row = np.repeat(np.arange(high - low), np.diff(first))
            order = np.lexsort((row, words))
            words, row = words[order], row[order]
            once = np.ones(len(words), bool)
            once[1:] = (words[1:] != words[:-1]) | (row[1:] != row[:-1])
            words, toxic = words[once], label[low:high][row[once]]
            unique, place = np.unique(words, return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(unique.view(np.int64)), pa.array(np.bincount(place[toxic], minlength=len(unique))), pa.array(np.bincount(place[~toxic], minlength=len(unique)))],
                names=["word", "toxic", "other"],
            )


def segments(positions: np.ndarray, scores: np.ndarray, drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first word, end, score) of words of which those at `positions` score above zero."""
    held: list[list[float]] = []  # first, end, sum before, sum up to the end
    total, last = 0.0, 0
    for at, score in zip(positions.tolist(), scores.tolist(), strict=True):
        total -= drift * (at - last)
        last = at + 1
        new = [at, at + 1, total, total + score]
        total += score
        while True:
            k = len(held) - 1
            while k >= 0 and held[k][2] >= new[2]:
                k -= 1
            if k < 0 or held[k][3] >= new[3]:
                held.append(new)
                break
            new = [held[k][0], new[1], held[k][2], new[3]]
            del held[k:]
    return [(int(a), int(b), r - l) for a, b, l, r in held]


def _decay(scores: np.ndarray, chances: np.ndarray, drift: float) -> float:
    """The positive solution of sum(p * exp(lambda * s)) = 1 for the words of ordinary documents."""
    rest = max(0.0, 1 - chances.sum())
    total = lambda x: float((chances * np.exp(np.minimum(x * scores, 700))).sum() + rest * math.exp(-x * drift)) - 1
    low, high = 0.0, 64.0
    if not len(scores) or total(high) < 0:
        return high
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if total(mid) < 0 else (low, mid)
    return high


def scan(model: Model, data: np.ndarray, offsets: np.ndarray, least_expected: float = LEAST_EXPECTED) -> tuple[np.ndarray, list[list[tuple[int, int, float]]]]:
    """For each text its features, and its significant segments."""
    words, first = _text_words(data, offsets)
    n = np.diff(first)
    features = np.zeros((len(n), 3))
    features[:, 0] = 1
    found: list[list[tuple[int, int, float]]] = [[] for _ in n]
    # Without a segment: the expectation of the smallest score there is, none.
    features[:, 1] = -np.log(np.maximum(n, 1))
    if len(model.hashes) and len(words):
        place = np.minimum(np.searchsorted(model.hashes, words), len(model.hashes) - 1)
        at = np.flatnonzero(model.hashes[place] == words)
        row = np.searchsorted(first, at, side="right") - 1
        edges = np.searchsorted(row, np.arange(len(n) + 1))
        for r in np.unique(row).tolist():
            own = at[edges[r] : edges[r + 1]]
            held = segments(own - first[r], model.scores[place[own]], model.drift)
            logs = [model.decay * s - math.log(n[r]) for _, _, s in held]
            found[r] = [s for s, x in zip(held, logs, strict=True) if -x < math.log(least_expected)]
            features[r, 1] = max(logs)
            features[r, 2] = math.log1p(len(found[r]))
    return features, found


def _features(batches, model: Model):
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        parts = [scan(model, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])[0] for a, b in slices(offsets)]
        if parts:
            x = np.concatenate(parts)
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 1]), pa.array(x[:, 2]), batch.column("label").cast(pa.int32())], names=["best", "many", "label"])


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    weights = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1]), x.T @ (y - p) - ridge * weights)
        weights = weights + step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", allowed: Column | None = None, sample: int = SAMPLE, least_z: float = LEAST_Z, drift: float = DRIFT, most_words: int = MOST_WORDS) -> Model:
    """A model of the words of labelled rows. Two thirds of them give the log-odds, one third the probability."""
    rows = labelled(docs, labels, label, allowed, sample)
    third = F.pmod(F.xxhash64(F.sha2("text", 256)), F.lit(3)) == 0  # copies of a text are on one side
    counts = rows.where(~third & F.col("text").isNotNull()).select("text", "label").mapInArrow(_word_counts, "word bigint, toxic bigint, other bigint")
    words = counts.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    total = words.agg(F.sum("toxic").alias("n_toxic"), F.sum("other").alias("n_other"))
    prior = PRIOR_SHARE * (F.col("n_toxic") + F.col("n_other"))
    own = PRIOR_SHARE * (F.col("toxic") + F.col("other"))
    odds = F.log((F.col("toxic") + own) / (F.col("n_toxic") + prior - F.col("toxic") - own)) - F.log((F.col("other") + own) / (F.col("n_other") + prior - F.col("other") - own))
    spread = F.sqrt(1 / (F.col("toxic") + own) + 1 / (F.col("other") + own))
    scored = words.crossJoin(F.broadcast(total)).withColumns({"odds": odds, "z": odds / spread, "chance": (F.col("other") + own) / (F.col("n_other") + prior)})
    chosen = scored.where((F.col("z") >= least_z) & (F.col("n_toxic") > 0) & (F.col("n_other") > 0)).orderBy(F.desc("z"), "word").limit(most_words).toPandas()
    hashed = chosen["word"].to_numpy(np.int64).view(U)
    order = np.argsort(hashed)
    scores = chosen["odds"].to_numpy(float)[order]
    decay = _decay(scores, chosen["chance"].to_numpy(float)[order], drift)
    model = Model(hashed[order], scores, decay, drift, np.zeros(3))
    held_back = rows.where(third).select("text", "label").mapInArrow(lambda batches: _features(batches, model), "best double, many double, label int").toPandas()
    return model._replace(weights=_weights(held_back))


def _weights(rows: pd.DataFrame) -> np.ndarray:
    y = rows["label"].to_numpy(float)
    if not len(y) or y.min() == y.max():
        return np.array([-3.0 if not len(y) or y.max() == 0 else 3.0, 0.0, 0.0])
    return _logistic(np.stack([np.ones(len(y)), rows["best"], rows["many"]], axis=1), y)


def score(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """`docs` with `score` and `passages`, the significant segments as (first word, end, log-odds)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = "score double, passages array<struct<first: bigint, stop: bigint, log_odds: double>>"

    def work(column: pa.Array) -> list:
        model = shared.value
        data, offsets = text_bytes(column)
        chances, passages = [np.zeros(0)], []
        for low, high in slices(offsets):
            x, found = scan(model, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
            chances.append(1 / (1 + np.exp(-np.clip(x @ model.weights, -30, 30))))
            passages += [[{"first": a, "stop": b, "log_odds": s} for a, b, s in row] for row in found]
        return [np.concatenate(chances), passages]

    return append_columns(docs, fields, work, keep=keep)


def held_out() -> Column:
    """Rows whose labels no fit may see."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    model = fit(docs, labels)
    return append_columns(docs, "__score double", _score_only(docs, model)).where(F.col("__score") < threshold).select(*docs.columns)


def _score_only(docs: DataFrame, model: Model):
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(column: pa.Array) -> list:
        model = shared.value
        data, offsets = text_bytes(column)
        parts = [scan(model, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])[0] for a, b in slices(offsets)]
        x = np.concatenate(parts) if parts else np.zeros((0, 3))
        return [1 / (1 + np.exp(-np.clip(x @ model.weights, -30, 30)))]

    return work


def toxicity_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(docs, labels, allowed=~held_out())
    scored = score(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), F.size("passages").cast("long").alias("n_passages"))
