"""Quality rules, and robust multivariate outliers of the statistics behind them.

Words are `[^\\x20\\x09-\\x0D]+`. The rules fail texts with few words or many repeated 8-word windows. Every other text has a vector of
transformed statistics, and for each language and source the minimum-covariance-determinant estimate of that vector's centre and spread is
taken: concentration steps from three starts made of the data, each of which keeps the `share` of rows that are nearest so far; the estimate
of least determinant counts. Rows whose Mahalanobis distance is beyond a cutoff are rejected. To the group's spread a row adds what counting
alone makes its statistics vary (`VECTOR`), so that one address in a short text is no outlier where others have none.

The estimates cover all rows: each step is one aggregation of moments by group and distance bin, partly summed before the shuffle, so that
a group of any size is never gathered. A group with fewer than `least_rows` rows is judged with its language, a language with fewer with all.

Null and empty texts have no words and fail. Null languages and sources are groups of their own. Repeated rows are judged alike; an empty
table gives an empty result. Result columns replace columns of the same name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runsift.llm.frames import append_columns, settled, slices
from runsift.llm.words import NOT_SPACE, U, byte_set, hashes, mix, prefix_sums, row_sums, spans, text_bytes

WINDOW = 8
PARTS = 64
#: Squared distance that one in about a thousand rows of a normal distribution of eight statistics exceeds.
CUTOFF = 26.0
_SYMBOLS = byte_set(b"#*$%&|<>")
_MARKS = byte_set(b"!?\"'()[]{}=+/\\@^_~`;:")
_UPPER = byte_set(range(65, 91))
_DIGIT = byte_set(range(48, 58))
_NOT_NEWLINE = ~byte_set([10])
_LEAD = np.array([b & 0xC0 != 0x80 for b in range(256)])

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_marks", "n_upper", "n_digits", "n_lines", "n_same_words")
#: Each statistic, with what it is a share of and how many characters, words or lines usually come together: digits in numbers, marks in pairs,
#: capitals in names, repeats as two windows. A share `k / n` in clumps of `c` has the variance `c / 4n` by counting alone, once its root is taken.
VECTOR = (("word_length", "n_words", 4), ("symbols", "n_words", 2), ("marks", "n_words", 2), ("upper", "word_chars", 4), ("digits", "word_chars", 10), ("same_words", "n_words", 1), ("repeats", "n_words", 2 * WINDOW), ("dup_lines", "n_lines", 1))
#: Numerical size below which no spread goes.
TINY = 1e-4

def statistics(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The counts named in `COUNTS` for each text."""
    words = spans(data, offsets, NOT_SPACE)
    n, row = np.diff(words.first), words.rows

    def count(flags: np.ndarray) -> np.ndarray:
        return row_sums(flags, offsets)

    sums = prefix_sums(data)
    hashed = hashes(sums, words.starts, words.ends)
    salt = mix(np.arange(len(n), dtype=U) + U(1))

    lines = spans(data, offsets, _NOT_NEWLINE)
    line_first = np.searchsorted(words.starts, lines.starts)
    worded = np.searchsorted(words.starts, lines.ends) > line_first
    line_row = lines.rows[worded]
    line_hash = mix(hashes(sums, lines.starts[worded], lines.ends[worded]) ^ salt[line_row])
    _, firsts = np.unique(line_hash, return_index=True)
    n_lines = np.bincount(line_row, minlength=len(n))
    dup_lines = n_lines - np.bincount(line_row[firsts], minlength=len(n))

    repeat = np.zeros(len(n), np.int64)
    if len(hashed) >= WINDOW:
        last = len(hashed) - WINDOW + 1
        at = np.flatnonzero(row[:last] == row[WINDOW - 1 :])
        window = np.zeros(last, U)
        for k in range(WINDOW):
            window = window * U(0x9E3779B97F4A7C15) + hashed[k : k + last]
        window = mix(window[at] ^ salt[row[at]])
        order = np.argsort(window)
        sorted_ = window[order]
        same = sorted_[1:] == sorted_[:-1]
        twice = np.zeros(len(at), bool)
        twice[1:] |= same
        twice[:-1] |= same
        start = at[order[twice]]
        cover = np.zeros(len(hashed) + 1, np.int64)
        np.add.at(cover, start, 1)
        np.add.at(cover, start + WINDOW, -1)
        repeat = row_sums(np.cumsum(cover[:-1]) > 0, words.first)
    same_word = np.zeros(len(hashed), bool)
    same_word[1:] = (hashed[1:] == hashed[:-1]) & (row[1:] == row[:-1])
    return [
        n,
        count(NOT_SPACE[data] & _LEAD[data]),
        count(_SYMBOLS[data]),
        dup_lines,
        repeat,
        count(_MARKS[data]),
        count(_UPPER[data]),
        count(_DIGIT[data]),
        n_lines,
        row_sums(same_word, words.first),
    ]


def _vector(counts: list[np.ndarray]) -> np.ndarray:
    """Transformed statistics: logarithm of the mean word length, square roots of shares."""
    n, chars, symbols, dup_lines, repeat, marks, upper, digits, lines, same = (np.asarray(c, float) for c in counts)
    words, chars = np.maximum(n, 1), np.maximum(chars, 1)
    share = lambda a, b: np.sqrt(np.minimum(a / b, 4))
    return np.stack([np.log(chars / words), share(symbols, words), share(marks, words), share(upper, chars), share(digits, chars), share(same, words), share(repeat, words), share(dup_lines, np.maximum(lines, 1))], axis=1)


def _noise(counts: list[np.ndarray]) -> np.ndarray:
    """Variance of each statistic by counting alone."""
    held = dict(zip(COUNTS, counts, strict=True))
    return np.stack([clump / (4 * np.maximum(np.asarray(held[of], float), 1)) for _, of, clump in VECTOR], axis=1)


def add_statistics(docs: DataFrame, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """`docs` with the counts, `base_failed`, the vector `stats` and its counting `noise`."""
    fields = ", ".join(f"{c} bigint" for c in COUNTS) + ", base_failed boolean, stats array<double>, noise array<double>"

    def work(column: pa.Array) -> list:
        data, offsets = text_bytes(column)
        parts = [statistics(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in slices(offsets)]
        counts = [np.concatenate(x).astype(np.int64) for x in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64) for _ in COUNTS]
        failed = (counts[0] < 20) | (100 * counts[4] > 30 * counts[0])
        vectors = _vector(counts)
        ends = np.arange(0, vectors.size + 1, len(VECTOR), dtype=np.int32)
        return [*counts, failed, *(pa.ListArray.from_arrays(pa.array(ends), pa.array(x.ravel())) for x in (vectors, _noise(counts)))]

    return append_columns(docs, fields, work, (text,), keep)


def _chi2_quantile(p: float, d: int) -> float:
    """Wilson and Hilferty's approximation."""
    low, high = -8.0, 8.0
    for _ in range(60):
        z = (low + high) / 2
        low, high = (z, high) if 0.5 * math.erfc(-z / math.sqrt(2)) < p else (low, z)
    return d * (1 - 2 / (9 * d) + z * math.sqrt(2 / (9 * d))) ** 3


#: Distance bins for the order statistic: a sixteenth of a power of two each.
def _bin(distance):
    return F.greatest(F.lit(-160), F.least(F.lit(640), F.floor(F.log2(F.greatest(distance, F.lit(1e-12))) * 16))).cast("int")


def _near(d: int):
    """Squared distance of a row: the spread of its group, with the row's counting noise added to the variance of each statistic."""
    spread = [F.col("spread")[i] for i in range(d)]
    gap = [(F.col("stats")[i] - F.col("centre")[i]) * spread[i] / F.sqrt(spread[i] * spread[i] + F.col("noise")[i]) for i in range(d)]
    return sum(sum(F.col("root")[i * d + j] * gap[j] for j in range(i + 1)) ** 2 for i in range(d))


def _starts(levels: DataFrame) -> DataFrame:
    """Three starts for each group, without correlation: medians with the middle spread, medians with the spread of a narrower middle, and means."""
    d = len(VECTOR)
    s = [F.col("stats")[i] for i in range(d)]
    points = [0.25, 0.375, 0.5, 0.625, 0.75]
    found = levels.groupBy("group").agg(*[F.percentile_approx(x, points, 1000).alias(f"q{i}") for i, x in enumerate(s)], *[F.avg(x).alias(f"m{i}") for i, x in enumerate(s)], *[F.stddev_pop(x).alias(f"s{i}") for i, x in enumerate(s)])
    wide = lambda high, low, z: [(F.col(f"q{i}")[high] - F.col(f"q{i}")[low]) / (2 * z) for i in range(d)]
    middle = [F.col(f"q{i}")[2].cast("double") for i in range(d)]
    starts = [(middle, wide(4, 0, 0.6745)), (middle, wide(3, 1, 0.3186)), ([F.col(f"m{i}") for i in range(d)], [F.col(f"s{i}") for i in range(d)])]
    made = [F.struct(F.lit(k).alias("start"), F.array(*c).alias("centre"), F.transform(F.array(*w), lambda x: F.greatest(x.cast("double"), F.lit(TINY))).alias("spread")) for k, (c, w) in enumerate(starts)]
    root = F.flatten(F.array(*[F.array(*[F.when(F.lit(i == j), 1 / F.col("spread")[i]).otherwise(F.lit(0.0)) for j in range(d)]) for i in range(d)]))
    return found.select("group", F.inline(F.array(*made))).select("group", "start", "centre", root.alias("root"), "spread", F.lit(0.0).alias("size"))


def _estimates(rows: DataFrame, params: DataFrame, share: float) -> DataFrame:
    """Centre, spread, root of the inverse covariance and log determinant of the rows of each group nearest to each of `params`."""
    d = len(VECTOR)
    pairs = [(i, j) for i in range(d) for j in range(i + 1)]
    s = [F.col("stats")[i] for i in range(d)]
    names = ["n", *[f"a{i}" for i in range(d)], *[f"e{i}" for i in range(d)], *[f"b{i}_{j}" for i, j in pairs]]
    moments = (
        rows.join(params, "group")
        .withColumn("distance", _near(d))
        .groupBy("group", "start", _bin(F.col("distance")).alias("bin"))
        .agg(F.count("*").alias("n"), *[F.sum(x).alias(f"a{i}") for i, x in enumerate(s)], *[F.sum(F.col("noise")[i]).alias(f"e{i}") for i in range(d)], *[F.sum(s[i] * s[j]).alias(f"b{i}_{j}") for i, j in pairs])
    )
    window = Window.partitionBy("group", "start").orderBy("bin")
    nearest = moments.withColumn("before", F.sum("n").over(window) - F.col("n")).withColumn("all", F.sum("n").over(Window.partitionBy("group", "start"))).where(F.col("before") < share * F.col("all"))
    summed = nearest.groupBy("group", "start").agg(*[F.sum(c).alias(c) for c in names])
    spread_left = share_spread(share, d)

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                n = row["n"]
                centre = np.array([row[f"a{i}"] for i in range(d)]) / n
                cov = np.zeros((d, d))
                for i, j in pairs:
                    cov[i, j] = cov[j, i] = row[f"b{i}_{j}"] / n - centre[i] * centre[j]
                # The nearest rows spread less than all; the trimmed share of a normal distribution says by how much.
                cov /= spread_left
                spread = np.sqrt(np.maximum(np.diag(cov), TINY**2))
                alike = np.clip(cov / np.outer(spread, spread), -1, 1)
                np.fill_diagonal(alike, 1.0)
                alike = 0.95 * alike + 0.05 * np.eye(d)
                root = np.linalg.inv(np.linalg.cholesky(alike * np.outer(spread, spread)))
                noise = np.array([row[f"e{i}"] for i in range(d)]) / n
                size = np.linalg.slogdet(alike)[1] + np.log(spread**2 + noise).sum()
                out.append({"group": row["group"], "start": row["start"], "centre": centre.tolist(), "root": root.ravel().tolist(), "spread": spread.tolist(), "size": float(size)})
            yield pd.DataFrame(out, columns=["group", "start", "centre", "root", "spread", "size"])

    return summed.mapInPandas(solve, "group string, start int, centre array<double>, root array<double>, spread array<double>, size double")


def share_spread(share: float, d: int) -> float:
    """Variance of the `share` of a d-dimensional normal distribution nearest to its centre, against that of all of it."""
    q = _chi2_quantile(share, d)
    x = np.linspace(0, q, 20_001)[1:]
    log_density = (d / 2) * np.log(x / 2) - x / 2 - math.lgamma(d / 2 + 1)
    return float(np.exp(log_density).sum() * (x[1] - x[0]) / 2 / share)


def judge(docs: DataFrame, share: float = 0.75, steps: int = 4, cutoff: float = CUTOFF, least_rows: int = 200, keep: list[str] | None = None) -> DataFrame:
    """`docs` with its counts, `base_failed`, the Mahalanobis `distance` (squared, null where no estimate applies) and `kept`."""
    names = {c.lower() for c in (docs.columns if keep is None else keep)}
    lang, source = (F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) if c in {x.lower() for x in docs.columns} else F.lit("\u0000") for c in ("lang", "source"))
    marked = docs.withColumns({"__lang": lang, "__source": source})
    rows = settled(add_statistics(marked, [c for c in marked.columns if c.lower() in names or c.startswith("__")]))
    # Levels: language and source, language, all.
    sizes = rows.where("not base_failed").groupBy("__lang", "__source").agg(F.count("*").alias("n"))
    per_lang = sizes.groupBy("__lang").agg(F.sum("n").alias("n_lang"))
    named = sizes.join(per_lang, "__lang").select(
        "__lang",
        "__source",
        F.when(F.col("n") >= least_rows, F.to_json(F.array("__lang", "__source"))).when(F.col("n_lang") >= least_rows, F.to_json(F.array("__lang"))).otherwise(F.lit("[]")).alias("group"),
    )
    grouped = rows.where("not base_failed").select("__lang", "__source", "stats", "noise").join(named, ["__lang", "__source"])
    # Rows of small groups add to the estimate of their language, and those of small languages to that of all, beside all others of these.
    levels = grouped.select("stats", "noise", F.explode(F.array_distinct(F.array("group", F.to_json(F.array("__lang")), F.lit("[]")))).alias("group"))
    used = named.select("group").distinct()
    levels = settled(levels.join(used, "group", "left_semi"))
    params = settled(_starts(levels))
    for _ in range(steps):
        params = settled(_estimates(levels, params, share))
    # Of the estimates from several starts the one of least determinant counts.
    params = params.groupBy("group").agg(F.min_by(F.struct("centre", "root", "spread"), F.struct("size", "start")).alias("best")).select("group", "best.*")
    # A source may hold a third of all rows: its rows are dealt out over parts, each with its own copy of the group's name.
    parts = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(PARTS)).cast("int")
    copies = named.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    scored = rows.withColumn("__part", parts).join(copies, ["__lang", "__source", "__part"], "left").drop("__part")
    joined = scored.join(params, "group", "left")
    distance = F.when(~F.col("base_failed"), _near(len(VECTOR)))
    return joined.withColumn("distance", distance).withColumn("kept", ~F.col("base_failed") & (F.coalesce(F.col("distance"), F.lit(0.0)) <= cutoff)).drop("__lang", "__source", "group", "centre", "root", "spread", "stats", "noise")


def rules_digest(docs: DataFrame) -> DataFrame:
    return judge(docs.select("doc_id", "text", "lang", "source"), keep=["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )
