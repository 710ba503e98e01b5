"""Near-duplicate documents by b-bit MinHash.

A text is lower-cased (A-Z), cut into words `[^\\x20\\x09-\\x0D]+`, and stands for the set of its distinct shingles of `size` words; with
fewer words the whole sequence is its one shingle. Equal sets are one node from the start, so that exact copies never meet each other.

Of each set the minima of `BANDS * ROWS` hash functions are taken. Bands of `ROWS` minima give candidates; of the minima themselves only
the low `BITS` bits are kept, packed into longs, and the similarity of a pair is estimated from a bit count, corrected for low bits that
agree by chance. The estimate only drops pairs five standard deviations below the limit. Sets that have candidates also get a parity sketch
of `PARITY` bits: bits in which two sketches differ are never more than the elements in which the sets differ, so that most pairs below the
limit are dropped for certain. All others are confirmed on full sets.

Every document comes to the component of all its links, without all pairs of a bucket: members are first linked with two hubs
of their bucket. Then only members that are not in the largest component of their bucket are compared, by signature, with the members of
other components. At a similarity of 0.8 a pair shares no band with a probability of 3 in a million.

Nodes are named by the least `doc_id` of their set. Null and empty texts, and rows without a `doc_id`, are linked with nothing and stay.
Repeated rows are one document. Result columns replace columns of the same name; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runsift.llm.frames import append_columns, settled, slices
from runsift.llm.words import LOWER, NOT_SPACE, U, hashes, mix, prefix_sums, spans, text_bytes

BANDS, ROWS, BITS = 32, 5, 4
SLOTS = BANDS * ROWS
PERCENT = 80
PARITY = 2048
_TEXTS = 1024  # texts that are worked on at once
#: Standard deviations that an estimate may lie below the limit.
SLACK = 5
_random = np.random.RandomState(20_230_517)
_FACTORS = (_random.randint(0, 1 << 62, SLOTS).astype(U) << U(1)) | U(1)
_TERMS = _random.randint(0, 1 << 62, SLOTS).astype(U)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes (52 bits) of each text, end to end, and where each text's begin. At most 4,096 texts."""
    data = LOWER[data]
    words = spans(data, offsets, NOT_SPACE)
    n, row = np.diff(words.first), words.rows
    hashed = hashes(prefix_sums(data), words.starts, words.ends)
    keys = []
    for length in range(1, size + 1):  # shorter lengths only where the whole text is so short
        last = len(hashed) - length + 1
        if last <= 0:
            continue
        at = np.flatnonzero(row[:last] == row[length - 1 :]) if length == size else words.first[:-1][n == length]
        joined = np.full(len(at), length, U)
        for k in range(length):
            joined = joined * U(0x9E3779B97F4A7C15) + hashed[at + k]
        keys.append((row[at].astype(U) << U(52)) | (mix(joined) >> U(12)))
    keys = np.unique(np.concatenate(keys)) if keys else np.zeros(0, U)
    return keys & U((1 << 52) - 1), np.searchsorted(keys, np.arange(len(n) + 1, dtype=U) << U(52))


def identities(shingles: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Two halves of the identity of each set; zeros for empty sets."""
    ids = np.zeros((2, len(first) - 1), U)
    held = np.flatnonzero(np.diff(first))
    if len(held):
        ids[0, held] = np.add.reduceat(mix(shingles + U(1)), first[:-1][held])
        ids[1, held] = np.add.reduceat(mix(shingles ^ U(0x5851F42D4C957F2D)), first[:-1][held])
    return ids


def signatures(shingles: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
    """Two halves of a set's identity, the keys of its bands, and its packed low bits; zeros for empty sets."""
    rows = len(first) - 1
    held = np.flatnonzero(np.diff(first))
    starts = first[:-1][held]
    minima = np.zeros((SLOTS, rows), U)
    if len(held):
        for k in range(SLOTS):
            minima[k, held] = np.minimum.reduceat(((shingles + _TERMS[k]) * _FACTORS[k]) >> U(32), starts)
    ids = identities(shingles, first)
    bands = np.zeros((BANDS, rows), U)
    for k in range(BANDS):
        bands[k] += U(k + 1)
        for r in range(ROWS):
            bands[k] = mix(bands[k] * U(0x9E3779B97F4A7C15) + minima[k * ROWS + r])
    per_long = 64 // BITS
    packed = np.zeros((SLOTS // per_long, rows), U)
    for k in range(SLOTS):
        packed[k // per_long] |= (minima[k] & U((1 << BITS) - 1)) << U(BITS * (k % per_long))
    return ids[0], ids[1], bands.T, packed.T


def parities(shingles: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each set and bit, whether an odd number of its elements falls on the bit; packed into longs."""
    rows = len(first) - 1
    row = np.repeat(np.arange(rows), np.diff(first))
    bit = (mix(shingles ^ U(0x2545F4914F6CDD1D)) & U(PARITY - 1)).astype(np.int64)
    odd = (np.bincount(row * PARITY + bit, minlength=rows * PARITY) & 1).astype(np.uint8).reshape(rows, PARITY)
    return np.packbits(odd, axis=1).view(U)


def _lists(table: np.ndarray) -> pa.Array:
    table = np.ascontiguousarray(table).view(np.int64)
    ends = np.arange(0, table.size + 1, table.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(table.ravel()))


def _signature_columns(size: int):
    def work(column: pa.Array) -> list:
        data, offsets = text_bytes(column)
        n, parts = [np.zeros(0, np.int64)], []
        for low, high in slices(offsets, most_rows=_TEXTS):
            shingles, first = shingle_sets(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], size)
            n.append(np.diff(first))
            parts.append(signatures(shingles, first))
        if not parts:
            parts = [signatures(np.zeros(0, U), np.zeros(1, np.int64))]
        a, b, bands, packed = (np.concatenate(x) for x in zip(*parts, strict=True))
        return [a.view(np.int64), b.view(np.int64), np.concatenate(n).astype(np.int64), _lists(bands), _lists(packed)]

    return work


def _set_columns(size: int):
    def work(column: pa.Array) -> list:
        data, offsets = text_bytes(column)
        values, ends, ids, odd = [np.zeros(0, U)], [np.zeros(1, np.int64)], [np.zeros((2, 0), U)], [np.zeros((0, PARITY // 64), U)]
        for low, high in slices(offsets, most_rows=_TEXTS):
            shingles, first = shingle_sets(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], size)
            ids.append(identities(shingles, first))
            odd.append(parities(shingles, first))
            values.append(shingles)
            ends.append(ends[-1][-1] + first[1:])
        both = np.concatenate(ids, axis=1).view(np.int64)
        joined = np.concatenate(values).view(np.int64)
        return [both[0], both[1], pa.ListArray.from_arrays(pa.array(np.concatenate(ends).astype(np.int32)), pa.array(joined)), _lists(np.concatenate(odd))]

    return work


def agreeing(a: Column, b: Column) -> Column:
    """Number of slots whose low bits agree."""
    differing = F.lit(0)
    for k in range(SLOTS * BITS // 64):
        x = a[k].bitwiseXOR(b[k])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        differing = differing + F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
    return F.lit(SLOTS) - differing


def estimate(a: Column, b: Column) -> Column:
    """Similarity by agreeing low bits, corrected for those that agree by chance."""
    chance = 2.0**-BITS
    return (agreeing(a, b) / F.lit(float(SLOTS)) - chance) / (1 - chance)


def differing(a: Column, b: Column) -> Column:
    """Number of bits in which two parity sketches differ: at most the number of elements in which the sets differ."""
    total = F.bit_count(a[0].bitwiseXOR(b[0]))
    for k in range(1, PARITY // 64):
        total = total + F.bit_count(a[k].bitwiseXOR(b[k]))
    return total


def most_differing(elements: Column) -> Column:
    """How many bits of two sketches may differ when the sets differ in so many elements: all, or the mean and six standard deviations."""
    m = float(PARITY)
    two, four = F.pow(F.lit(1 - 2 / m), elements), F.pow(F.lit(1 - 4 / m), elements)
    variance = m / 4 * (1 - two * two) + m * (m - 1) / 4 * (four - two * two)
    return F.least(elements.cast("double"), m / 2 * (1 - two) + 6 * F.sqrt(F.greatest(variance, F.lit(0.0))))


def _close_enough(percent: int) -> Column:
    limit = percent / 100
    least = limit - SLACK * (limit * (1 - limit) / SLOTS) ** 0.5
    # 100 * shared >= percent * union, with shared + union = n + other_n and union - shared = elements in which they differ
    elements = (F.col("n") + F.col("other_n")) * F.lit((100 - percent) / (100 + percent))
    return (
        (100 * F.least("n", "other_n") >= percent * F.greatest("n", "other_n"))
        & (estimate(F.col("sig"), F.col("other_sig")) >= least)
        & (differing(F.col("odd"), F.col("other_odd")) <= most_differing(elements) + 1e-6)
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of `edges` (u, v): alternating large and small stars, until nothing changes."""
    stars, before = settled(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()), None
    while True:
        both = stars.union(stars.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).where("u != v").distinct()
        large = settled(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = settled(small.union(least.select("u", "m")).distinct())
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = now


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of `pairs` (u, v) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("u"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("v"), F.col("shingles").alias("right"))

    def compare(a: pa.Array, b: pa.Array) -> list:
        starts_a, starts_b = a.offsets.to_numpy(), b.offsets.to_numpy()
        x, y = a.values.to_numpy(), b.values.to_numpy()
        out = np.zeros(len(a), bool)
        for i in range(len(a)):
            p, q = x[starts_a[i] : starts_a[i + 1]], y[starts_b[i] : starts_b[i + 1]]
            both = np.concatenate([p, q])
            both.sort()
            shared = int((both[1:] == both[:-1]).sum())
            out[i] = 100 * shared >= percent * (len(p) + len(q) - shared)
        return [out]

    joined = pairs.join(left, "u").join(right, "v")
    return append_columns(joined, "linked boolean", compare, ("left", "right"), ["u", "v"]).where("linked").select("u", "v")


def near_components(docs: DataFrame, size: int = 5, percent: int = PERCENT) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, the two halves of its set's identity, n_shingles, component_id."""
    docs = docs.select("doc_id", "text")
    fields = "sid_a bigint, sid_b bigint, n_shingles bigint, bands array<bigint>, sig array<bigint>"
    signed = settled(append_columns(docs, fields, _signature_columns(size), keep=["doc_id"]))
    nodes = settled(
        signed.where("n_shingles > 0 and doc_id is not null")
        .groupBy("sid_a", "sid_b")
        .agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("sig").alias("sig"))
    )
    banded = nodes.select("node", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    buckets = settled(banded.join(shared, "key"))
    wanted = nodes.join(buckets.select("node").distinct(), "node", "left_semi").select("node", F.col("sid_a").alias("want_a"), F.col("sid_b").alias("want_b"))
    texts = docs.join(wanted, docs["doc_id"] == wanted["node"]).select("node", "want_a", "want_b", "text")
    fields = "sid_a bigint, sid_b bigint, shingles array<bigint>, odd array<bigint>"
    sets = append_columns(texts, fields, _set_columns(size), keep=["node", "want_a", "want_b"])
    sets = settled(sets.where("sid_a = want_a and sid_b = want_b").select("node", "shingles", "odd").dropDuplicates(["node"]))
    slim = settled(nodes.select("node", "n", "sig").join(sets.select("node", "odd"), "node"))

    def plausible(pairs: DataFrame) -> DataFrame:
        a = slim.select(F.col("node").alias("u"), "n", "sig", "odd")
        b = slim.select(F.col("node").alias("v"), F.col("n").alias("other_n"), F.col("sig").alias("other_sig"), F.col("odd").alias("other_odd"))
        return pairs.join(a, "u").join(b, "v").where(_close_enough(percent)).select("u", "v")

    # Hubs: the member that shares most over all its buckets, as what others are copies of does, and one picked by a hash.
    weight = buckets.groupBy("node").agg(F.sum("members").alias("weight"))
    hubs = (
        buckets.join(weight, "node")
        .groupBy("key")
        .agg(
            F.max_by("node", F.struct("weight", "node")).alias("hub"),
            F.min_by("node", F.struct(F.xxhash64("node"), "node")).alias("other_hub"),
        )
    )
    spokes = buckets.join(hubs, "key").select("node", F.explode(F.array_distinct(F.array("hub", "other_hub"))).alias("hub")).where("node != hub")
    pairs = settled(plausible(spokes.select(F.greatest("node", "hub").alias("u"), F.least("node", "hub").alias("v")).distinct()))
    links = settled(_confirmed(pairs, sets, percent))
    found = components(links)

    # What the hubs left apart: members outside the largest component of their bucket, against those of other components.
    placed = buckets.select("key", "node").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    divided = placed.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a != b").select("key")
    open_ = settled(placed.join(divided, "key", "left_semi").join(slim, "node"))
    largest = open_.groupBy("key", "component").agg(F.count("*").alias("k")).groupBy("key").agg(F.max_by("component", F.struct("k", "component")).alias("largest"))
    apart = open_.join(largest, "key").where("component != largest").drop("largest")
    other = open_.join(largest, "key").select("key", F.col("node").alias("other"), F.col("component").alias("other_component"), F.col("n").alias("other_n"), F.col("sig").alias("other_sig"), F.col("odd").alias("other_odd"), (F.col("component") != F.col("largest")).alias("both"))
    meet = apart.join(other, "key").where((F.col("component") != F.col("other_component")) & (~F.col("both") | (F.col("node") < F.col("other"))) & _close_enough(percent))
    rest = meet.select(F.greatest("node", "other").alias("u"), F.least("node", "other").alias("v")).distinct().join(pairs, ["u", "v"], "left_anti")
    more = _confirmed(settled(rest), sets, percent)
    found = components(found.select(F.col("node").alias("u"), F.col("component").alias("v")).union(more))
    named = nodes.join(found, "node", "left").select("sid_a", "sid_b", F.coalesce("component", "node").alias("component_id"))
    return (
        signed.select("doc_id", "sid_a", "sid_b", "n_shingles")
        .join(named, ["sid_a", "sid_b"], "left")
        .withColumn("component_id", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id")))
    )


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = PERCENT) -> DataFrame:
    """`docs` with one document of each component, the one with the least `doc_id`; of repeated rows one stays."""
    found = near_components(docs, size, percent).where("n_shingles > 0 and doc_id = component_id").groupBy("doc_id").agg(F.min(F.struct("sid_a", "sid_b")).alias("__kept"))
    marked = append_columns(docs, "__a bigint, __b bigint, __n bigint", _ids_only(size))
    joined = marked.join(found, "doc_id", "left").where(F.col("__n").eqNullSafe(0) | F.col("doc_id").isNull() | ((F.col("__a") == F.col("__kept.sid_a")) & (F.col("__b") == F.col("__kept.sid_b"))))
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy("__a", "__b"))
    return joined.withColumn("__rank", rank).where("__rank = 1 or __n = 0 or doc_id is null").select(*docs.columns)


def _ids_only(size: int):
    def work(column: pa.Array) -> list:
        data, offsets = text_bytes(column)
        ids, n = [np.zeros((2, 0), U)], [np.zeros(0, np.int64)]
        for low, high in slices(offsets, most_rows=_TEXTS):
            shingles, first = shingle_sets(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], size)
            ids.append(identities(shingles, first))
            n.append(np.diff(first))
        both = np.concatenate(ids, axis=1).view(np.int64)
        return [both[0], both[1], np.concatenate(n).astype(np.int64)]

    return work


def near_digest(docs: DataFrame) -> DataFrame:
    found = near_components(docs, size=2)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))
