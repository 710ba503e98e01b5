"""Collocations: phrases of 2 to 5 words that occur far more often than their parts, per language.

Texts are lower-cased in A-Z (null: empty), cut at `[.,;:!?\\x0A-\\x0D]` into pieces and pieces into words `[^\\x20\\x09]+`.
Per lang (null: `und`), n counts all words and f(phrase) its contiguous occurrences within pieces. Candidates have 2 to 5
words and a = f >= LEAST. Cutting after k words gives l = f(first part), r = f(rest), score floor(1000*a*n/(l*r)); the
lowest score counts (ties: smallest k). A candidate is dropped where it lies inside a longer candidate with f >= a.

Counting is level by level. A phrase of L words can only reach LEAST where both of its parts of L-1 words do, so level L
counts only such phrases: no count below the threshold is lost, and phrases that cannot reach it are never shuffled.
Within a task, each batch of texts is cut by its bytes (NumPy) and its words numbered by Arrow; the phrases of the level
are rows of word ids, written as one number each and counted exactly by sorting these (NumPy), which groups them by lang
and first word, the first level of a word-id trie, with the following ids below it. Each batch spills its counts as one
sorted run; Spark merges the runs of all tasks by a partial and a final aggregation. The frequent phrases of the level below reach the tasks as sorted 64-bit
hashes (a broadcast, when there are at most MOST_BROADCAST of them; else each occurrence is checked by joins): a hash
only lets a phrase be counted, so a collision costs a count and never loses one.

Defined cases: null or empty texts add nothing; a text of one piece without separators is one piece. An empty table or
no candidate gives no rows. Equal scores and counts are ordered by phrase (UTF-8 bytes). Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runsift.llm.frames import give_back, settled, slices
from runsift.llm.words import LOWER, byte_set, hashes, prefix_sums, spans, text_bytes

LEAST = 100
LONGEST = 5
TOP = 2000
#: Frequent phrases of a level sent to every task at most; beyond, occurrences are checked by joins.
MOST_BROADCAST = 2_000_000

_CUT = re.compile(r"[.,;:!?\n\x0b\x0c\r]")
_SPACE = re.compile(r"[ \t]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Bytes that end a piece, and bytes of words.
_CUTS = byte_set(b".,;:!?\n\x0b\x0c\r")
_WORDS = ~_CUTS & ~byte_set(b" \t")


def pieces(text: str | None) -> Iterator[list[str]]:
    """Word lists of the pieces of a text."""
    for piece in _CUT.split((text or "").translate(_LOWER)):
        words = [w for w in _SPACE.split(piece) if w]
        if words:
            yield words


_SEED = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash per word, alike in every task."""
    data, offsets = text_bytes(words)
    return hashes(prefix_sums(data), offsets[:-1], offsets[1:])


def gram_hashes(hashes: np.ndarray) -> np.ndarray:
    """Hashes of phrases from a matrix of word hashes, one phrase a row; used only to pass over phrases that cannot be
    frequent, so that a collision costs a count, never a phrase."""
    return _gram_hashes([hashes[:, k] for k in range(hashes.shape[1])])


def _gram_hashes(words: list[np.ndarray]) -> np.ndarray:
    out = np.full(len(words[0]), _SEED, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for column in words:
            out = _mix(out * np.uint64(31) + column)
    return out


def phrase_hashes(langs: pa.Array, phrases: pa.Array) -> np.ndarray:
    """`gram_hashes` of phrases of equally many words, with their langs."""
    if not len(phrases):
        return np.zeros(0, np.uint64)
    words = pc.list_flatten(pc.split_pattern(phrases, " "))
    return gram_hashes(word_hashes(words).reshape(len(phrases), -1)) ^ word_hashes(langs)


class Frequent:
    """Sorted hashes of frequent phrases, with a table of their first bits that passes over most of the others."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        bits = min(25, max(16, (16 * len(hashes)).bit_length()))
        self.shift = np.uint64(64 - bits)
        self.first = np.zeros(1 << bits, bool)
        self.first[hashes >> self.shift] = True

    def holds(self, hashed: np.ndarray) -> np.ndarray:
        found = self.first[hashed >> self.shift]
        if len(self.hashes):
            near = hashed[found]
            found[found] = self.hashes[np.minimum(np.searchsorted(self.hashes, near), len(self.hashes) - 1)] == near
        return found


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All words of texts (null: empty), lower-cased, with the number of the text and of the piece that holds each.

    Separators are single bytes of ASCII, so that words of whole UTF-8 characters are cut byte by byte."""
    data, offsets = text_bytes(texts)
    found = spans(data, offsets, _WORDS)
    ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(found.ends - found.starts)])
    words = pa.LargeStringArray.from_buffers(len(found.starts), pa.py_buffer(ends), pa.py_buffer(LOWER[data[_WORDS[data]]]))
    return words, found.rows, found.rows + np.searchsorted(np.flatnonzero(_CUTS[data]), found.starts)


def _counted_rows(columns: list[np.ndarray], sizes: list[int]) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows, sorted, of columns of numbers below `sizes`, and how often each occurs."""
    code, limit = columns[0].astype(np.int64), sizes[0]
    steps: list[tuple[int, np.ndarray | None]] = []
    for column, size in zip(columns[1:], sizes[1:], strict=True):
        seen = None
        if limit * size >= 1 << 63:
            seen, code = np.unique(code, return_inverse=True)
            limit = len(seen)
        steps.append((size, seen))
        code = code * size + column
        limit *= size
    code.sort()
    begins = np.flatnonzero(np.concatenate([np.ones(1, bool), code[1:] != code[:-1]]))
    counts = np.diff(np.append(begins, len(code)))
    code = code[begins]
    out = []
    for size, seen in reversed(steps):
        code, column = np.divmod(code, size)
        out.append(column)
        if seen is not None:
            code = seen[code]
    return [code, *reversed(out)], counts


def batch_runs(langs: pa.Array, texts: pa.Array, size: int, frequent: Frequent | None) -> pa.RecordBatch:
    """(lang, phrase, c) of the phrases of `size` words in a batch, as runs sorted by their word ids under each first
    word; with `frequent` (phrases of size-1 words), only phrases whose two parts are there."""
    words, text, piece = split_words(texts)
    empty = pa.RecordBatch.from_arrays([pa.array([], pa.string()), pa.array([], pa.string()), pa.array([], pa.int64())], schema=_ARROW)
    if len(words) < size:
        return empty
    coded = pc.dictionary_encode(words)
    ids, vocab = np.asarray(coded.indices), coded.dictionary
    lang_codes = pc.dictionary_encode(pc.fill_null(pa.concat_arrays([langs.cast(pa.string())]), "und"))
    lang_of = np.asarray(lang_codes.indices)[text]
    keep = piece[: len(ids) - size + 1] == piece[size - 1 :]
    if frequent is not None and size > 1:
        word_h, lang_h = word_hashes(vocab), word_hashes(lang_codes.dictionary)
        places = len(ids) - size + 2  # of parts; those over the end of a piece are not asked for
        held = frequent.holds(_gram_hashes([word_h[ids[k : k + places]] for k in range(size - 1)]) ^ lang_h[lang_of[:places]])
        keep &= held[:-1] & held[1:]
    starts = np.flatnonzero(keep)
    if not len(starts):
        return empty
    grams = [ids[starts + k] for k in range(size)]
    if size > 2:  # few words are left: number them anew, for shorter codes
        used = np.zeros(len(vocab), bool)
        for column in grams:
            used[column] = True
        number = np.cumsum(used) - 1
        vocab, grams = vocab.filter(pa.array(used)), [number[column] for column in grams]
    # Sorted runs: by lang, then first word id (the trie's first level), then the ids that follow.
    found, counts = _counted_rows([lang_of[starts], *grams], [len(lang_codes.dictionary), *[len(vocab)] * size])
    parts = [vocab.take(pa.array(column)) for column in found[1:]]
    phrase = parts[0] if size == 1 else pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string()))
    lang = lang_codes.dictionary.take(pa.array(found[0]))
    return pa.RecordBatch.from_arrays([lang, phrase.cast(pa.string()), pa.array(counts, pa.int64())], schema=_ARROW)


def runs(batches: Iterator[pa.RecordBatch], size: int, frequent: Frequent | None) -> Iterator[pa.RecordBatch]:
    """`batch_runs` of batches of (lang, text), in slices of at most _ROWS texts and about _BYTES."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0)
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.asarray(lengths), dtype=np.int64)])
        for low, high in slices(ends, _BYTES, _ROWS):
            part = batch.slice(low, high - low)
            out = batch_runs(part.column(0), part.column(1), size, frequent)
            if out.num_rows:
                yield out


def _count_level(docs: DataFrame, size: int, frequent) -> DataFrame:
    """(lang, phrase, f) of phrases of `size` words; with `frequent`, a broadcast of sorted hashes of the frequent
    phrases of size-1 words, only phrases whose two parts of size-1 words are among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from runs(batches, size, None if frequent is None else Frequent(frequent.value))
        give_back()

    counted = docs.mapInArrow(run, "lang string, phrase string, c long")
    return counted.groupBy("lang", "phrase").agg(F.sum("c").alias("f"))


def _hashed(below: DataFrame) -> np.ndarray:
    """Sorted `phrase_hashes` of (lang, phrase)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(phrase_hashes(*batch.columns).view(np.int64))], names=["hash"])

    found = below.select("lang", "phrase").mapInArrow(run, "hash long").toArrow().column("hash")
    return np.unique(found.to_numpy().view(np.uint64))


_ARROW = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("c", pa.int64())])
#: Texts worked on at once in a task, and their bytes; a longer text stands alone.
_ROWS = 16_384
_BYTES = 8 << 20


def _parts(frame: DataFrame, words: str = "phrase") -> DataFrame:
    w = F.split(words, " ")
    return frame.withColumn("_first", F.array_join(F.slice(w, 1, F.size(w) - 1), " ")).withColumn("_last", F.array_join(F.slice(w, 2, F.size(w) - 1), " "))


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of every phrase of 1 to `longest` words with f >= `least`, and (lang, n) of all langs."""
    spark = docs.sparkSession
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    ones = settled(_count_level(docs, 1, None))
    totals = settled(ones.groupBy("lang").agg(F.sum("f").alias("n")))
    levels = [settled(ones.where(F.col("f") >= least).withColumn("words", F.lit(1)))]
    for size in range(2, longest + 1):
        below = levels[-1].select("lang", "phrase")
        count = below.count()
        if count == 0:
            break
        if count <= MOST_BROADCAST:
            shared = spark.sparkContext.broadcast(_hashed(below))
            found = _count_level(docs, size, shared)
        else:  # too many to send: count all, then keep phrases whose parts are frequent, by joins
            found = _parts(_count_level(docs, size, None))
            keys = below.select("lang", F.col("phrase").alias("_k"))
            found = found.join(keys.withColumnRenamed("_k", "_first"), ["lang", "_first"], "left_semi")
            found = found.join(keys.withColumnRenamed("_k", "_last"), ["lang", "_last"], "left_semi").drop("_first", "_last")
        levels.append(settled(found.where(F.col("f") >= least).withColumn("words", F.lit(size))))
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out, totals


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """Per lang its first `top` candidates by score desc, a desc, phrase asc: lang, rank, phrase, a, l, r, n, score, k."""
    counts, totals = frequent_phrases(docs, least, longest)
    counts = settled(counts)
    cands = counts.where("words >= 2").select("lang", "phrase", "words", F.col("f").alias("a"))
    # Inside a longer candidate with f >= a: its inner runs of 2 or more words, with that f.
    w = F.split("phrase", " ")
    inner = cands.where("words >= 3").select(
        "lang",
        "a",
        F.explode(
            F.flatten(
                F.transform(
                    F.sequence(F.lit(2), F.col("words") - 1),
                    lambda m: F.transform(F.sequence(F.lit(1), F.col("words") - m + 1), lambda i: F.array_join(F.slice(w, i, m), " ")),
                )
            )
        ).alias("phrase"),
    )
    covered = inner.groupBy("lang", "phrase").agg(F.max("a").alias("_outer"))
    cands = cands.join(covered, ["lang", "phrase"], "left").where(F.col("_outer").isNull() | (F.col("_outer") < F.col("a"))).drop("_outer")
    cuts = cands.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).withColumn("_w", w)
    cuts = cuts.withColumn("_left", F.array_join(F.slice("_w", 1, F.col("k")), " ")).withColumn(
        "_right", F.array_join(F.slice("_w", F.col("k") + 1, F.col("words") - F.col("k")), " ")
    )
    parts = counts.select("lang", "phrase", "f")
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("_left"), F.col("f").alias("l")), ["lang", "_left"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("_right"), F.col("f").alias("r")), ["lang", "_right"])
    cuts = cuts.join(totals, "lang")
    big = "decimal(38,0)"
    score = F.expr(f"(CAST(1000 AS {big}) * CAST(a AS {big}) * CAST(n AS {big})) div (CAST(l AS {big}) * CAST(r AS {big}))")
    cuts = cuts.withColumn("score", score.cast("long"))
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("_b")).select(
        "lang", "phrase", "a", "n", "_b.score", "_b.k", "_b.l", "_b.r"
    )
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase").cast("binary"))
    ranked = best.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score", F.col("k").cast("long").alias("k"))
