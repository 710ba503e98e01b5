"""Language identification by unigram piece models, summed over all segmentations.

The pieces are those of a fixed public vocabulary, lower-cased, and single bytes. For each language every piece has a probability; the
probability of a word is the sum over all ways to cut it into pieces of the product of their probabilities, by the forward algorithm. The
languages' probabilities of a text's words give the posterior of each language, all of them equally likely beforehand.

Piece probabilities come from one expectation step over all allowed rows: with a prior that falls with a piece's rank in the vocabulary,
the forward-backward algorithm tells how often each piece is expected in each language. Counts are summed per task before the shuffle; what
is collected and broadcast is one number for each piece and language.

Words are lower-cased (A-Z) `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` with the space before them; a longer one is cut into units of `UNIT`
bytes, none is left out. A text that is null or has no letter is `und` with score 0, and so is every text when no row has a language. Of
equally likely languages the first by name is told. Repeated rows count as often as they occur; result columns replace columns of the
same name; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runsift.llm.frames import append_columns, slices
from runsift.llm.pieces import SPACE, load
from runsift.llm.words import LETTER_OR_DIGIT, LOWER, U, byte_set, hashes, powers, prefix_sums, spans, text_bytes

UNIT = 24
UNKNOWN = "und"
#: Pieces that a language is taken to have shown before its first text, dealt out by the prior.
PRIOR_PIECES = 2000.0
_SLICE = 2 << 20
_BITS = 17
_SPREAD = (U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F))
_ASCII_LETTERS = byte_set([*range(65, 91), *range(97, 123)])


class Vocabulary(NamedTuple):
    """Two tables by hash, of which one holds each piece at its place; `prior` is a probability of each piece."""

    keys: np.ndarray
    ids: np.ndarray
    prior: np.ndarray
    longest: int


def _raw_hash(piece: bytes) -> int:
    up, _ = powers(len(piece) + 1)
    return int(((np.frombuffer(piece, np.uint8).astype(U) + U(1)) * up[: len(piece)]).sum())


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    pieces: dict[bytes, float] = {bytes([b]): 1e-6 for b in range(256)}
    for rank, name in enumerate(load(path).ids):
        raw = name.replace(SPACE, " ").encode()
        if len(raw) <= UNIT and raw == bytes(LOWER[np.frombuffer(raw, np.uint8)]) and not raw.endswith(b"  "):
            pieces[raw] = pieces.get(raw, 0.0) + 1.0 / (rank + 100)
    prior = np.array(list(pieces.values()))
    keys, ids = np.zeros((2, 1 << _BITS), U), np.full((2, 1 << _BITS), -1, np.int32)
    for number, raw in enumerate(pieces):
        # Cuckoo hashing: a piece takes its place in one table, and what was there goes to its place in the other.
        key, table = _raw_hash(raw), 0
        for _ in range(500):
            place = ((key * int(_SPREAD[table])) & ((1 << 64) - 1)) >> (64 - _BITS)
            old_key, old = int(keys[table, place]), int(ids[table, place])
            keys[table, place], ids[table, place] = key, number
            if old < 0:
                break
            key, number, table = old_key, old, 1 - table
        else:
            raise ValueError("the vocabulary does not fit into its table")
    return Vocabulary(keys, ids, prior / prior.sum(), max(map(len, pieces)))


def _find(held: Vocabulary, key: np.ndarray) -> np.ndarray:
    """Numbers of the pieces with these hashes, -1 where there is none."""
    found = np.full(len(key), -1, np.int32)
    for table in (0, 1):
        place = ((key * _SPREAD[table]) >> U(64 - _BITS)).astype(np.int64)
        found = np.where(held.keys[table][place] == key, held.ids[table][place], found)
    return found


class Units(NamedTuple):
    table: np.ndarray  # distinct units, the longest first, as a matrix of bytes
    sizes: np.ndarray
    which: np.ndarray  # for each unit of the texts, its row in `table`
    first: np.ndarray  # where the units of each text begin


def units(data: np.ndarray, offsets: np.ndarray) -> Units:
    data = LOWER[data]
    words = spans(data, offsets, LETTER_OR_DIGIT)
    starts, ends, row = words.starts, words.ends, words.rows
    parts = -(-(ends - starts) // (UNIT - 1))
    if len(parts) and parts.max() > 1:
        which = np.repeat(np.arange(len(starts)), parts)
        step = np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)
        low = starts[which] + step * (UNIT - 1)
        # A cut goes back to where a character begins.
        for _ in range(3):
            low = low - ((step > 0) & (data[np.minimum(low, len(data) - 1)] & 0xC0 == 0x80))
        high = np.where(np.append(which[1:] == which[:-1], False), np.append(low[1:], 0), ends[which])
        starts, ends, row, lead = low, high, row[which], step == 0
    else:
        lead = np.ones(len(starts), bool)
    sums = prefix_sums(data)
    hashed = hashes(sums, starts, ends) ^ np.where(lead, U(0), U(0x5851F42D4C957F2D))
    _, index, inverse = np.unique(hashed, return_index=True, return_inverse=True)
    size = (ends - starts + lead)[index]
    order = np.argsort(-size, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    index, size = index[order], size[order]
    width = int(size[0]) if len(size) else 0
    at = (starts - lead)[index][:, None] + np.arange(width)
    table = data[np.clip(at, 0, max(0, len(data) - 1))] if len(data) else np.zeros((0, 0), np.uint8)
    if width:
        table[lead[index], 0] = 32
    return Units(table, size, place[inverse], np.searchsorted(row, np.arange(len(offsets))))


def _matches(held: Vocabulary, found: Units) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(begin, end, rows, pieces) of all pieces in all distinct units, by where they end."""
    n, width = found.table.shape
    up, down = powers(width + 1)
    sums = np.zeros((width + 1, n), U)
    for k in range(width):
        sums[k + 1] = sums[k] + (found.table[:, k].astype(U) + U(1)) * up[k]
    active = np.searchsorted(-found.sizes, -np.arange(width + 1), side="right")  # rows that are so long
    for end in range(1, width + 1):
        m = active[end]
        for begin in range(end - 1, max(-1, end - held.longest - 1), -1):
            piece = _find(held, (sums[end, :m] - sums[begin, :m]) * down[begin])
            rows = np.flatnonzero(piece >= 0)
            if len(rows):
                yield begin, end, rows, piece[rows]


def _forward(matches, width: int, n: int, chance: np.ndarray) -> np.ndarray:
    """Probability of each beginning of each unit; `chance` has a row for each piece and a column for each model."""
    ahead = np.zeros((width + 1, n, chance.shape[1]))
    ahead[0] = 1
    for begin, end, rows, piece in matches:
        ahead[end, rows] += ahead[begin, rows] * chance[piece]
    return ahead


def log_likelihood(held: Vocabulary, found: Units, chance: np.ndarray) -> np.ndarray:
    """Of each distinct unit under each model."""
    n, width = found.table.shape
    ahead = _forward(_matches(held, found), width, n, chance)
    return np.log(np.maximum(ahead[found.sizes, np.arange(n)], 1e-300))


def expected_pieces(held: Vocabulary, found: Units, weights: np.ndarray) -> np.ndarray:
    """How often each piece is expected under the prior, for units that occur `weights` (units by classes) times."""
    n, width = found.table.shape
    matches = list(_matches(held, found))
    chance = held.prior[:, None]
    ahead = _forward(matches, width, n, chance)[:, :, 0]
    behind = np.zeros((width + 1, n))
    behind[found.sizes, np.arange(n)] = 1
    whole = ahead[found.sizes, np.arange(n)]
    total = np.zeros((len(held.prior), weights.shape[1]))
    for begin, end, rows, piece in reversed(matches):
        part = held.prior[piece] * behind[end, rows]
        behind[begin, rows] += part
        share = ahead[begin, rows] * part / whole[rows]
        for k in range(weights.shape[1]):
            total[:, k] += np.bincount(piece, share * weights[rows, k], len(total))
    return total


class Model(NamedTuple):
    path: str
    languages: list[str]
    chance: np.ndarray  # pieces by languages


def fit(docs: DataFrame, path: str, allowed: Column | None = None, lang: str = "lang") -> Model:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = vocabulary(path)
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            codes = batch.column("lang").dictionary_encode()
            names, code = codes.dictionary.to_pylist(), codes.indices.to_numpy(zero_copy_only=False)
            total = np.zeros((len(held.prior), len(names)))
            for low, high in slices(offsets, _SLICE):
                found = units(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
                n = len(found.sizes)
                if n:
                    unit_lang = np.repeat(code[low:high], np.diff(found.first)).astype(np.int64)
                    weights = np.bincount(found.which * len(names) + unit_lang, minlength=n * len(names)).reshape(n, -1)
                    total += expected_pieces(held, found, weights)
            piece, which = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([names[k] for k in which], pa.string()), pa.array(piece.astype(np.int32)), pa.array(total[piece, which])], names=["lang", "piece", "n"])

    rows = docs.where(F.col(lang).isNotNull() & F.col("text").isNotNull())
    rows = rows if allowed is None else rows.where(allowed)
    counted = rows.select(F.col(lang).cast("string").alias("lang"), "text").mapInArrow(count, "lang string, piece int, n double")
    summed = counted.groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
    held = vocabulary(path)
    languages = sorted(summed["lang"].unique())
    total = np.zeros((len(held.prior), len(languages)))
    # Sums of floating-point numbers differ in their last digits with the order of tasks.
    total[summed["piece"], summed["lang"].map({x: k for k, x in enumerate(languages)})] = summed["n"].round(3)
    chance = (total + PRIOR_PIECES * held.prior[:, None]) / (total.sum(axis=0) + PRIOR_PIECES)
    return Model(path, languages, chance)


def predict(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """`docs` with `lang_pred` and `score`, the posterior of that language."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(column: pa.Array) -> list:
        model = shared.value
        held = vocabulary(model.path)
        data, offsets = text_bytes(column)
        names: list[str] = []
        scores: list[float] = []
        for low, high in slices(offsets, _SLICE):
            part, own = data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
            letters = np.concatenate([[0], np.cumsum(_ASCII_LETTERS[part])])
            lettered = letters[own[1:]] > letters[own[:-1]]
            found = units(part, own)
            total = np.zeros((high - low, len(model.languages)))
            if len(found.sizes) and model.languages:
                each = log_likelihood(held, found, model.chance)[found.which]
                sums = np.concatenate([np.zeros((1, each.shape[1])), np.cumsum(each, axis=0)])
                total = sums[found.first[1:]] - sums[found.first[:-1]]
            for k in range(high - low):
                known = lettered[k] or any(c.isalpha() for c in column[low + k].as_py() or "")
                if not known or not model.languages:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                best = int(np.argmax(total[k]))
                names.append(model.languages[best])
                scores.append(float(1 / np.exp(total[k] - total[k, best]).sum()))
        return [names, scores]

    return append_columns(docs, "lang_pred string, score double", work, keep=keep)


def held_out() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0


def language_digest(docs: DataFrame, path: str) -> DataFrame:
    model = fit(docs, path, ~held_out())
    return predict(docs.select("doc_id", "text"), model, keep=["doc_id"]).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
