"""Repeated byte strings across and within texts, by common-prefix intervals of an enhanced suffix array.

All suffixes of all texts can't meet in one place, so the array is a sparse one, in parts. Of each `LENGTH` bytes of a text the anchor is
the place of the least hash of `GRAM` bytes, the leftmost of equal ones: equal strings have equal anchors at the same place within them.
Suffixes at anchors with the same `GRAM` bytes form one part. A part is sorted by what follows the anchors; one scan with a stack over the
common prefixes of neighbours gives the tree of its intervals, bottom up. Each interval keeps its suffixes in the order of what comes
before the anchor, read backwards; where intervals join, suffixes that become neighbours in that order are tested for how far they agree
to the left too. So every repeat is extended to both sides as far as it goes, and is told for all its occurrences, not just for
neighbours in the array. Contexts reach `LENGTH` bytes to each side of an anchor, longer repeats come as overlapping pieces.

Suffixes with equal contexts are one suffix with a count: if it is over one, the whole context is repeated. A part with more than `most_suffixes` suffixes is still not gathered. Its strings of `LENGTH` bytes are counted by hash instead: first blocks of
neighbouring strings by what these have in common, then single strings where a block is neither unlike nor alike as a whole. Both are
sums by key, partly made before the shuffle, and give the same bytes.

Equal texts are one text with a count; if it is over one, all of its bytes are repeated, provided that there are `LENGTH`. Null and empty
texts, and texts of fewer bytes, hold no repeats. Repeated rows are copies like any others. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runsift.llm.frames import append_columns, chunked, settled, slices
from runsift.llm.words import U, hashes, mix, prefix_sums

LENGTH, GRAM = 400, 128
MOST_SUFFIXES = 16_384
_REACH = LENGTH - GRAM  # how far a string that holds an anchor may begin before it, or end after its gram
_BLOCK = 18  # strings whose common part stands for all of them, in parts that are not gathered
_PLACE = U((1 << 24) - 1)
_CHUNK = 1 << 23


def binary_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of anchors, and hashes of their grams, of texts that stand end to end (at most 16 MB)."""
    width = _REACH + 1
    n = len(data) - GRAM + 1
    if n < width:
        return np.zeros(0, np.int64), np.zeros(0, U)
    starts = np.arange(n)
    gram = hashes(prefix_sums(data), starts, starts + GRAM)
    ranked = (gram & ~_PLACE) | starts.astype(U)
    padded = np.full(-(-n // width) * width, ~U(0), U)
    padded[:n] = ranked
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[: n - width + 1], ahead[width - 1 : n])
    # A string may not go over the end of its text.
    whole = np.ones(n - width + 1, bool)
    for end in offsets[1:-1]:
        whole[max(0, end - LENGTH + 1) : end] = False
    found = np.zeros(n, bool)
    found[(least[whole] & _PLACE).astype(np.int64)] = True
    at = np.flatnonzero(found)
    return at, gram[at]


def text_anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place in it, gram) of all anchors; a very long text goes in overlapping chunks."""
    out = []
    for low, high in slices(offsets):
        part, own = data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        if high - low > 1 or len(part) <= _CHUNK:
            at, gram = anchors(part, own)
            row = np.searchsorted(own, at, side="right") - 1
            out.append((row + low, at - own[row], gram))
            continue
        places, grams = [], []
        for begin in range(0, len(part) - LENGTH + 1, _CHUNK):
            chunk = part[begin : begin + _CHUNK + LENGTH - 1]
            at, gram = anchors(chunk, np.array([0, len(chunk)]))
            places.append(at + begin)
            grams.append(gram)
        at, first = np.unique(np.concatenate(places), return_index=True)
        out.append((np.full(len(at), low), at, np.concatenate(grams)[first]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U)
    row, at, gram = (np.concatenate(x) for x in zip(*out, strict=True))
    return row, at, gram


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    high = min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    low = 0
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def repeats(lefts: list[bytes], rights: list[bytes], length: int = LENGTH, groups: list | None = None) -> list[list[tuple[int, int]]]:
    """For each suffix of a part the repeats of `length` bytes or more around its anchor, as (bytes before it, bytes from it on).

    `lefts` are read backwards from the anchor. Into `groups`, if given, go all maximal repeats, each as (before, from, its suffixes).
    """
    n = len(rights)
    found: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    by_right = sorted(range(n), key=rights.__getitem__)
    by_left = sorted(range(n), key=lefts.__getitem__)
    rank = [0] * n
    for k, i in enumerate(by_left):
        rank[i] = k

    def agree(a: int, b: int) -> int:
        return common(lefts[by_left[a]], lefts[by_left[b]])

    def join(one: list[int], other: list[int], right: int) -> list[int]:
        """The left order of two intervals that become one; suffixes that become neighbours in it are tested.

        Neighbours from the same interval have met before, where they agreed further to the right.
        """
        if len(one) < len(other):
            one, other = other, one
        for r in other:
            one.insert(bisect_left(one, r), r)
        smaller, reached = set(other), set()
        for r in other:
            k = bisect_left(one, r)
            for near in (one[k - 1 : k] if k else []) + one[k + 1 : k + 2]:
                if near not in smaller and (left := agree(near, r)) + right >= length:
                    reached.add(left)
                    found[by_left[near]].append((left, right))
                    found[by_left[r]].append((left, right))
        if groups is not None and reached:
            steps = [agree(a, b) for a, b in zip(one, one[1:])]
            for left in reached:
                begin = 0
                for k in range(len(one)):
                    if k + 1 == len(one) or steps[k] < left:
                        # Left-diverse: not all suffixes of the run agree any further to the left.
                        if k > begin and min(steps[begin:k]) == left:
                            groups.append((left, right, [by_left[r] for r in one[begin : k + 1]]))
                        begin = k + 1
        return one

    # Open intervals, each with the common prefix that its first suffix has with the one before.
    stack: list[tuple[int, list[int]]] = []
    for k in range(n + 1):
        prefix = common(rights[by_right[k - 1]], rights[by_right[k]]) if 0 < k < n else -1
        while len(stack) > 1 and stack[-1][0] >= prefix:
            inner, members = stack.pop()
            before, around = stack.pop()
            stack.append((before, join(around, members, inner)))
        if k < n:
            stack.append((prefix, [rank[by_right[k]]]))
    return found


# Tables: texts (ta, tb, text, copies), named by two halves of a hash; places (ta, tb, at, gram, context) of anchors whose gram occurs
# twice or more, context being a hash of it; spans (ta, tb, start, stop).
_NAME = ["ta", "tb"]


def _named(text: Column) -> list[Column]:
    hashed = F.md5(text)
    return [F.conv(F.substring(hashed, k, 15), 16, 10).cast("long").alias(name) for k, name in ((1, "ta"), (17, "tb"))]


def distinct_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    raw = F.col(text).cast("binary")
    return docs.where(F.octet_length(text) >= LENGTH).select(*_named(raw), raw.alias("text")).groupBy(*_NAME).agg(F.first("text").alias("text"), F.count("*").alias("copies"))


def anchor_places(texts: DataFrame) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = binary_bytes(batch.column("text"))
            rows, places, grams, contexts = [], [], [], []
            for low, high in slices(offsets):
                part, own = data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
                row, at, gram = text_anchors(part, own)
                begin, end = np.maximum(at - _REACH, 0), np.minimum(at + LENGTH, np.diff(own)[row])
                context = hashes(prefix_sums(part), own[row] + begin, own[row] + end) ^ mix((at - begin).astype(U))
                for held, more in ((rows, row + low), (places, at), (grams, gram), (contexts, context)):
                    held.append(more)
            if rows:
                row, at, gram, context = (np.concatenate(x) for x in (rows, places, grams, contexts))
                named = [batch.column(c).take(pa.array(row)) for c in _NAME]
                yield pa.RecordBatch.from_arrays([*named, pa.array(at.astype(np.int32)), pa.array(gram.view(np.int64)), pa.array(context.view(np.int64))], names=[*_NAME, "at", "gram", "context"])

    found = texts.select(*_NAME, "text").mapInArrow(find, "ta bigint, tb bigint, at int, gram bigint, context bigint")
    shared = found.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram")
    return found.join(shared, "gram", "left_semi")


def _with_texts(texts: DataFrame, places: DataFrame, columns: list[str]) -> DataFrame:
    """Each text with its own places as one array."""
    listed = places.groupBy(*_NAME).agg(F.collect_list(F.struct(*columns)).alias("places"))
    return texts.select(*_NAME, "text").join(listed, _NAME)


def _cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held = batch.column("places")
        row = np.repeat(np.arange(len(held)), np.diff(held.offsets.to_numpy()))
        at, gram = (held.values.field(k) for k in ("at", "gram"))
        texts = [x.as_py() for x in batch.column("text")]
        near = [texts[r][max(0, p - _REACH) : p + LENGTH] for r, p in zip(row.tolist(), at.to_pylist(), strict=True)]
        named = [batch.column(c).take(pa.array(row)) for c in _NAME]
        yield pa.RecordBatch.from_arrays([*named, at, gram, pa.array(near, pa.binary())], names=[*_NAME, "at", "gram", "near"])


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[list]]:
    """Suffixes (ta, tb, at, near) with equal grams, of rows sorted by gram; single ones are left out."""
    part: list[list] = []
    gram = None
    for batch in batches:
        for g, *suffix in zip(*(batch.column(c).to_pylist() for c in ("gram", *_NAME, "at", "near")), strict=True):
            if g != gram:
                if len(part) > 1:
                    yield part
                part, gram = [], g
            part.append(suffix)
    if len(part) > 1:
        yield part


def _sides(part: list[list]) -> tuple[list[bytes], list[bytes]]:
    """What comes before each anchor, backwards, and what comes from it on."""
    before = [min(_REACH, at) for _, _, at, _ in part]
    return [s[3][:b][::-1] for s, b in zip(part, before, strict=True)], [s[3][b:] for s, b in zip(part, before, strict=True)]


def _gathered(texts: DataFrame, places: DataFrame) -> DataFrame:
    """Spans from parts that meet in one task each."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in chunked(spans_of_parts(batches), 10_000):
            columns, kinds = zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=[*_NAME, "start", "stop"])

    def spans_of_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int, int]]:
        for part in _parts(batches):
            for (ta, tb, at, _), held in zip(part, repeats(*_sides(part)), strict=True):
                reach: list[list[int]] = []
                for left, right in sorted(set(held), key=lambda x: -x[0]):
                    if reach and -left <= reach[-1][1]:  # all hold the anchor, so all overlap
                        reach[-1][1] = max(reach[-1][1], right)
                    else:
                        reach.append([-left, right])
                yield from ((ta, tb, at + a, at + b) for a, b in reach)

    contexts = _with_texts(texts, places, ["at", "gram"]).mapInArrow(_cut_contexts, "ta bigint, tb bigint, at int, gram bigint, near binary")
    return contexts.repartition("gram").sortWithinPartitions("gram").mapInArrow(scan, "ta bigint, tb bigint, start int, stop int")


def _counted(texts: DataFrame, places: DataFrame) -> DataFrame:
    """Spans from parts of any size, by counting strings of `length` bytes by hash, first in blocks."""
    length = LENGTH
    count = length - GRAM + 1  # strings that hold an anchor: number s begins s bytes after the first
    key = ["gram", "s", "hash"]

    def runs(columns: list[str], spans_of) -> DataFrame:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                data, offsets = binary_bytes(batch.column("text"))
                held = batch.column("places")
                edges = held.offsets.to_numpy()
                row = np.repeat(np.arange(len(held)), np.diff(edges))
                given = [held.values.field(c).to_numpy() for c in columns]
                origin = offsets[row] + given[0] - (length - GRAM)
                which, s, low, high = spans_of(given, origin, offsets[row], offsets[row + 1])
                sums = prefix_sums(data)
                ok = low >= 0
                hashed = np.zeros(len(low), U)
                hashed[ok] = hashes(sums, low[ok], high[ok])
                base = offsets[row][which]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c).take(pa.array(row[which])) for c in _NAME],
                        pa.array(given[0][which].astype(np.int32)),
                        pa.array(given[1][which]),
                        pa.array(s.astype(np.int32)),
                        pa.array(hashed.view(np.int64), mask=~ok),
                        pa.array((low - base).astype(np.int32)),
                        pa.array((high - base).astype(np.int32)),
                    ],
                    names=[*_NAME, "at", "gram", "s", "hash", "start", "stop"],
                )

        return work

    schema = "ta bigint, tb bigint, at int, gram bigint, s int, hash bigint, start int, stop int"

    def blocks(given, origin, begin, end):
        """Of each place and block of strings the bytes that all have in common (even numbers), and those of all together (odd ones)."""
        first = np.arange(0, count, _BLOCK)
        last = np.minimum(first + _BLOCK, count) - 1
        place = np.repeat(np.arange(len(origin)), len(first))
        k = np.tile(np.arange(len(first)), len(origin))
        o, b, e = origin[place], begin[place], end[place]
        core_low, core_high = o + last[k], o + first[k] + length
        all_low, all_high = o + first[k], o + last[k] + length
        core = (core_low >= b) & (core_high <= e)
        whole = core & (all_low >= b) & (all_high <= e)
        which = np.concatenate([place[core], place[whole]])
        s = np.concatenate([2 * k[core], 2 * k[whole] + 1])
        return which, s, np.concatenate([core_low[core], all_low[whole]]), np.concatenate([core_high[core], all_high[whole]])

    def strings(given, origin, begin, end):
        first = given[2].astype(np.int64) // 2 * _BLOCK
        place = np.repeat(np.arange(len(origin)), _BLOCK)
        s = np.repeat(first, _BLOCK) + np.tile(np.arange(_BLOCK), len(origin))
        low = origin[place] + s
        ok = (s < count) & (low >= begin[place]) & (low + length <= end[place])
        return place[ok], s[ok], low[ok], low[ok] + length

    tried = _with_texts(texts, places, ["at", "gram"]).mapInArrow(runs(["at", "gram"], blocks), schema)
    twice = tried.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(*key)
    found = settled(tried.join(twice, key, "left_semi"))
    whole = found.where("s % 2 = 1")
    open_ = found.where("s % 2 = 0").join(whole.select(*_NAME, "at", "gram", (F.col("s") - 1).alias("s")), [*_NAME, "at", "gram", "s"], "left_anti")
    # Of blocks that are alike as a whole one stands for all, as its strings may be what an open block repeats.
    one = whole.groupBy(*key).agg(F.min(F.struct(*_NAME, "at")).alias("one")).select("one.ta", "one.tb", "one.at", "gram", (F.col("s") - 1).alias("s"))
    wanted = open_.select(*_NAME, "at", "gram", "s").union(one)
    single = _with_texts(texts, wanted, ["at", "gram", "s"]).mapInArrow(runs(["at", "gram", "s"], strings), schema)
    again = single.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(*key)
    return whole.union(single.join(again, key, "left_semi")).select(*_NAME, "start", "stop", F.concat_ws(":", *key).alias("group"))


def _kinds(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All places, and one for each gram and context, with their number and how many contexts the gram has."""
    places = settled(anchor_places(texts))
    kinds = places.groupBy("gram", "context").agg(F.count("*").alias("n"), *[F.min_by(c, F.struct(*_NAME, "at")).alias(c) for c in (*_NAME, "at")])
    sizes = kinds.groupBy("gram").agg(F.count("*").alias("suffixes"))
    return places, settled(kinds.join(sizes, "gram"))


def repeated_spans(texts: DataFrame, most_suffixes: int = MOST_SUFFIXES) -> DataFrame:
    """(ta, tb, start, stop) in bytes; the union of a text's spans is what a string that starts anywhere else covers.

    A span may go beyond the end of its text.
    """
    places, kinds = _kinds(texts)
    alike = places.join(kinds.where("n > 1").select("gram", "context"), ["gram", "context"], "left_semi")
    found = alike.select(*_NAME, F.greatest(F.col("at") - _REACH, F.lit(0)).alias("start"), (F.col("at") + LENGTH).alias("stop"))
    few, many = kinds.where(f"suffixes between 2 and {most_suffixes}"), kinds.where(f"suffixes > {max(1, most_suffixes)}")
    found = found.union(_gathered(texts, few))
    return found if many.isEmpty() else found.union(_counted(texts, many).drop("group"))


def remove_repeats(texts: DataFrame, most_suffixes: int = MOST_SUFFIXES) -> DataFrame:
    """(ta, tb, n_removed, removed, kept): of each distinct text the maximal runs that are repeated, and the bytes that are left."""
    listed = repeated_spans(texts, most_suffixes).groupBy(*_NAME).agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    joined = texts.join(listed, _NAME, "left")

    def cut(text: pa.Array, spans: pa.Array, copies: pa.Array) -> list:
        removed, runs, kept = [], [], []
        for raw, held, n in zip(text.to_pylist(), spans.to_pylist(), copies.to_pylist(), strict=True):
            merged: list[list[int]] = [[0, len(raw)]] if n > 1 else []
            if n == 1:
                for a, b in sorted((x["start"], min(x["stop"], len(raw))) for x in held or ()):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
            edges = [0, *(x for m in merged for x in m), len(raw)]
            kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            removed.append(sum(b - a for a, b in merged))
            runs.append(merged)
        return [removed, runs, kept]

    return append_columns(joined, "n_removed bigint, removed array<array<bigint>>, kept binary", cut, ("text", "spans", "copies"), _NAME)


def maximal_repeats(docs: DataFrame, most_suffixes: int = MOST_SUFFIXES) -> DataFrame:
    """(group, ta, tb, start, stop): maximal repeats within reach of an anchor, one row for each occurrence; a text's copies are one text.

    Groups are found among distinct contexts and then told for all places that have these. Of parts that are not gathered each repeated
    string, or block of strings, is a group. A span may go beyond the end of its text.
    """
    texts = distinct_texts(docs)
    places, kinds = _kinds(texts)
    few, many = kinds.where(f"suffixes between 2 and {most_suffixes}"), kinds.where(f"suffixes > {max(1, most_suffixes)}")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            groups: list = []
            lefts, rights = _sides(part)
            repeats(lefts, rights, LENGTH, groups)
            named = ((hashlib.md5(lefts[m[0]][:left][::-1] + rights[m[0]][:right]).hexdigest(), *part[i][:3], left, right) for left, right, m in groups for i in m)
            for rows in chunked(named, 10_000):
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["group", *_NAME, "at", "left", "right"])

    contexts = _with_texts(texts, few, ["at", "gram"]).mapInArrow(_cut_contexts, "ta bigint, tb bigint, at int, gram bigint, near binary")
    found = contexts.repartition("gram").sortWithinPartitions("gram").mapInArrow(scan, "group string, ta bigint, tb bigint, at int, left int, right int")
    named = found.join(kinds.select(*_NAME, "at", "gram", "context"), [*_NAME, "at"]).select("group", "gram", "context", "left", "right")
    whole = kinds.where("n > 1").select(F.concat_ws(":", "gram", "context").alias("group"), "gram", "context", F.lit(_REACH).alias("left"), F.lit(LENGTH).alias("right"))
    told = named.union(whole).join(places, ["gram", "context"]).select("group", *_NAME, F.greatest(F.col("at") - F.col("left"), F.lit(0)).alias("start"), (F.col("at") + F.col("right")).alias("stop"))
    return told.union(_counted(texts, many).select("group", *_NAME, "start", "stop")).distinct()


def repeats_digest(docs: DataFrame, most_suffixes: int = MOST_SUFFIXES) -> DataFrame:
    cleaned = remove_repeats(distinct_texts(docs), most_suffixes)
    slim = cleaned.select(*_NAME, "n_removed", F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    size = F.octet_length(raw)
    rows = docs.select("doc_id", *_named(raw), size.cast("long").alias("n_bytes"), F.when(size < LENGTH, F.sha2(raw, 256)).alias("own"))
    return rows.join(slim, _NAME, "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("own", "kept_sha256").alias("kept_sha256"),
    )
