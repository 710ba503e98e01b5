"""Quality by votes of the nearest labelled documents in a latent-semantic space.

The terms of a text are pairs of neighbouring character classes, words that repeat the one before, word lengths, and hashed words; their
weights are logarithms of counts per 1,000 bytes times the inverse document frequency. The singular vectors of the labelled documents'
term matrix span the space. Each document is projected, its exact cosines with all labelled vectors are taken block by block, and the
`neighbours` nearest vote with their label, weighted by similarity.

Labels are read from at most `sample` rows, the first by a hash of their id (documented bound of the fit, and of what is broadcast).
Every document is scored over its whole text.

Null and empty texts have no direction and get the share of good labelled rows. A document with two labels counts as good if one says so.
Without labelled rows every score is 0.5. Repeated rows are judged alike; result columns replace columns of the same name.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runsift.llm.frames import append_columns, slices
from runsift.llm.toxicity import held_out, labelled
from runsift.llm.words import LOWER, NOT_SPACE, U, hashes, prefix_sums, row_sums, spans, text_bytes

SAMPLE, NEIGHBOURS, RANK = 4096, 15, 32
THRESHOLD = 0.5
_WORD_BUCKETS, _LENGTHS = 512, 24
#: What a hashed word weighs against a pair of character classes.
_WORD_WEIGHT = 0.1

# Character classes: each mark that texts are marred with stands for itself.
_CLASSES = np.zeros(256, np.int64)
_CLASSES[0x61:0x7B] = 1
_CLASSES[0x41:0x5B] = 2
_CLASSES[0x30:0x3A] = 3
_CLASSES[0x80:] = 4
for _k, _c in enumerate(b" \n\t.,|!#$%&*<>=@/_-'\"():;", start=5):
    _CLASSES[_c] = _k
_N = int(_CLASSES.max()) + 1
WIDTH = _N * _N + 1 + _LENGTHS + _WORD_BUCKETS


def terms(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Term weights, before the inverse document frequency, of each text."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    kinds = _CLASSES[data]
    pairs = np.zeros((n, _N * _N))
    if len(data) > 1:
        code = kinds[:-1] * _N + kinds[1:]
        row = np.repeat(np.arange(n), size)
        same = row[:-1] == row[1:]
        pairs = np.bincount((row[:-1] * (_N * _N) + code)[same], minlength=n * _N * _N).reshape(n, -1)
    words = spans(data, offsets, NOT_SPACE)
    hashed = hashes(prefix_sums(LOWER[data]), words.starts, words.ends)
    row = words.rows
    again = np.zeros(len(hashed), bool)
    again[1:] = (hashed[1:] == hashed[:-1]) & (row[1:] == row[:-1])
    length = np.minimum(words.ends - words.starts, _LENGTHS) - 1
    lengths = np.bincount(row * _LENGTHS + length, minlength=n * _LENGTHS).reshape(n, -1)
    buckets = np.bincount(row * _WORD_BUCKETS + (hashed >> U(55)).astype(np.int64), minlength=n * _WORD_BUCKETS).reshape(n, -1)
    counts = np.concatenate([pairs, row_sums(again, words.first)[:, None], lengths, buckets], axis=1)
    weights = np.log1p(counts * (1000 / np.maximum(size, 1))[:, None]).astype(np.float32)
    weights[:, -_WORD_BUCKETS:] *= _WORD_WEIGHT
    return weights


class Model(NamedTuple):
    rarity: np.ndarray  # inverse document frequency of each term
    axes: np.ndarray  # terms to latent dimensions
    vectors: np.ndarray  # labelled documents, of length 1
    good: np.ndarray
    share: float
    neighbours: int


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", allowed: Column | None = None, sample: int = SAMPLE, neighbours: int = NEIGHBOURS, rank: int = RANK) -> Model:
    def work(column: pa.Array) -> list:
        data, offsets = text_bytes(column)
        parts = [terms(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in slices(offsets, 1 << 19, 1024)]
        return [[row.tobytes() for part in parts for row in part]]

    rows = labelled(docs, labels, label, allowed, sample).where("length(text) > 0").dropDuplicates(["doc_id"])
    held = append_columns(rows, "terms binary", work, keep=["doc_id", "label"]).orderBy("doc_id").toPandas()
    if not len(held):
        return Model(np.ones(WIDTH, np.float32), np.zeros((WIDTH, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0), 0.5, neighbours)
    table = np.stack([np.frombuffer(x, np.float32) for x in held["terms"]])
    good = (held["label"].to_numpy() > 0).astype(np.float32)
    rarity = (np.log((1 + len(table)) / (1 + (table > 0).sum(axis=0))) + 1).astype(np.float32)
    table = table * rarity
    _, axes = np.linalg.eigh(table.T @ table)  # the right singular vectors, the largest last
    axes = np.ascontiguousarray(axes[:, ::-1][:, :rank])
    return Model(rarity, axes, _unit(table @ axes), good, float(good.mean()), min(neighbours, len(table)))


def votes(model: Model, weights: np.ndarray) -> np.ndarray:
    """Similarity-weighted share of good neighbours of each row of term weights."""
    if not len(model.vectors) or not len(weights):
        return np.full(len(weights), model.share)
    found = _unit((weights * model.rarity) @ model.axes)
    near = found @ model.vectors.T
    place = np.argpartition(-near, model.neighbours - 1, axis=1)[:, : model.neighbours]
    weight = np.maximum(np.take_along_axis(near, place, axis=1), 0) ** 4
    total = weight.sum(axis=1)
    voted = (weight * model.good[place]).sum(axis=1) / np.maximum(total, 1e-12)
    return np.where(total > 1e-9, np.clip(voted, 0, 1), model.share)


def score(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """`docs` with `score`, the chance that a document is of good quality."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(column: pa.Array) -> list:
        data, offsets = text_bytes(column)
        parts = [votes(shared.value, terms(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])) for a, b in slices(offsets, 1 << 19, 1024)]
        return [np.concatenate(parts).astype(float) if parts else np.zeros(0)]

    return append_columns(docs, "score double", work, keep=keep)


def quality_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs.select("doc_id", "text"), fit(docs, labels, allowed=~held_out()), keep=["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
