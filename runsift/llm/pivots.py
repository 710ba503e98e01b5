"""Near-duplicate vectors by a pivot-permutation index: cosine links within a label, their counts and components.

Vectors are described by their PREFIX nearest of PIVOTS reference points, in order of nearness. The reference points are
a bounded, documented sample: per vector length, the PIVOTS distinct vectors with the smallest hash of their id. Every
vector is indexed: it is posted to the inverted list (label, length, pivot) of each pivot of its prefix. A list is cut
into blocks of at most BLOCK vectors by a hash of the id, and each pair of blocks of a list (a block with itself too) is
one task, which verifies candidates by exact cosine in double precision, blockwise by matrix products. A candidate pair
is counted only in the list of the smallest pivot its two prefixes share, so that a pair sharing several is counted
once; pairs that share no pivot are not found (the recall, measured against brute force, is in the README). Tasks emit no
pairs: per vector the number of links found, weighted by copies, and a spanning forest of the links, so that a dense
group costs comparisons, never rows. Exact copies (equal label and components) are one vector with a multiplicity
before the index; their links to each other are counted without comparison.

Defined cases: a row repeated exactly is one vector. A vector that is null, empty, zero, or holds a null or non-finite
component, and a row whose vec_id or label is null, link with nothing: n_links 0, component_id its own vec_id. Vectors
of unlike lengths never link. Two rows with one vec_id and unlike vectors are two vectors. kept is false for a null
vec_id. Columns besides vec_id, embedding and label are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runsift.llm.frames import settled
from runsift.llm.near import components

#: Reference points per vector length, drawn by the smallest hash of the id among distinct vectors.
PIVOTS = 64
#: Nearest pivots that describe a vector, in order.
PREFIX = 6
#: Vectors of one inverted list compared in one task at most, against as many of another block.
BLOCK = 2048
THRESHOLD = 0.93
#: Small tables (pivots, list sizes) are broadcast up to so many rows, else shuffled.
MOST_BROADCAST = 200_000


def usable(embedding: Column) -> Column:
    """Not null, not empty, every component present and finite, not all zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    square = F.aggregate(embedding, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return F.coalesce(embedding.isNotNull() & (F.size(embedding) > 0) & finite & (square > 0), F.lit(False))


def _bounded(small: DataFrame) -> DataFrame:
    small = settled(small)
    return F.broadcast(small) if small.count() <= MOST_BROADCAST else small


def _prefixes(distinct: DataFrame, pivots: DataFrame, prefix: int) -> DataFrame:
    """`distinct` with `perm`: ids of its `prefix` nearest pivots of its length, nearest first (ties: smaller id)."""
    spark = distinct.sparkSession
    held = {}
    for r in pivots.collect():  # PIVOTS rows per vector length
        held.setdefault(r["dim"], []).append((r["pid"], np.asarray(r["e"], dtype=np.float64)))
    table = {d: (np.array([p for p, _ in v]), np.stack([e / np.linalg.norm(e) for _, e in v])) for d, v in held.items()}
    shared = spark.sparkContext.broadcast(table)

    def work(batches):
        points = shared.value
        for b in batches:
            perms = []
            for e, dim in zip(b["e"], b["dim"], strict=True):
                ids, unit = points[dim]
                x = np.asarray(e, dtype=np.float64)
                near = unit @ (x / np.linalg.norm(x))
                order = np.lexsort((ids, -near))[:prefix]
                perms.append(ids[order].tolist())
            yield b.assign(perm=perms)

    schema = T.StructType([*distinct.schema.fields, T.StructField("perm", T.ArrayType(T.IntegerType()))])
    return distinct.mapInPandas(work, schema)


def _block_work(threshold: float):
    def work(rows: pd.DataFrame) -> pd.DataFrame:
        pivot, lo, hi = int(rows["pivot"].iat[0]), int(rows["lo"].iat[0]), int(rows["hi"].iat[0])
        a = rows[rows["b"] == lo]
        b = a if lo == hi else rows[rows["b"] == hi]
        if a.empty or b.empty:  # a block that the hash left empty
            return pd.DataFrame({"rep": pd.Series([], dtype="int64"), "add": pd.Series([], dtype="int64"), "other": pd.Series([], dtype="Int64")})
        xa, xb = np.stack(a["e"].to_numpy()).astype(np.float64), np.stack(b["e"].to_numpy()).astype(np.float64)
        na, nb = np.sqrt((xa * xa).sum(1)), np.sqrt((xb * xb).sum(1))
        cos = (xa @ xb.T) / np.outer(na, nb)
        hit = cos >= threshold
        if lo == hi:
            hit = np.triu(hit, 1)
        i, j = np.nonzero(hit)
        pa, pb = a["perm"].to_numpy(), b["perm"].to_numpy()
        own = np.array([min(set(pa[x]) & set(pb[y])) == pivot for x, y in zip(i, j, strict=True)], dtype=bool)
        i, j = i[own], j[own]
        ra, rb = a["nid"].to_numpy(), b["nid"].to_numpy()
        ma, mb = a["mult"].to_numpy(), b["mult"].to_numpy()
        counts = pd.DataFrame({"rep": np.concatenate([ra[i], rb[j]]), "add": np.concatenate([mb[j], ma[i]])})
        counts = counts.groupby("rep", as_index=False)["add"].sum()
        # A spanning forest of the links: one edge per union of two trees.
        parent: dict[int, int] = {}

        def find(x):
            while parent.get(x, x) != x:
                parent[x] = parent.get(parent[x], parent[x])
                x = parent[x]
            return x

        u, v = [], []
        for x, y in zip(ra[i].tolist(), rb[j].tolist(), strict=True):
            fx, fy = find(x), find(y)
            if fx != fy:
                parent[max(fx, fy)] = min(fx, fy)
                u.append(x)
                v.append(y)
        edges = pd.DataFrame({"rep": np.array(u, dtype=np.int64), "add": np.zeros(len(u), np.int64), "other": np.array(v, dtype=np.int64)})
        counts["other"] = pd.array([None] * len(counts), dtype="Int64")
        return pd.concat([counts.astype({"rep": "int64", "add": "int64"}), edges], ignore_index=True)

    return work


def pivot_links(
    vectors: DataFrame, threshold: float = THRESHOLD, pivots: int = PIVOTS, prefix: int = PREFIX, block: int = BLOCK
) -> DataFrame:
    """Per distinct row of `vectors` (vec_id, embedding, label): vec_id, label, n_links (other vectors linked directly,
    copies included), component_id (smallest vec_id reachable, itself included), kept (vec_id = component_id)."""
    c = F.col
    rows = vectors.select(c("vec_id").cast("long").alias("vec_id"), c("label"), c("embedding")).dropDuplicates(["vec_id", "label", "embedding"])
    rows = settled(rows.withColumn("ok", usable(c("embedding")) & c("vec_id").isNotNull() & c("label").isNotNull()))
    # Exact copies are one vector, named by its least id; partial aggregation keeps a hot group small before the shuffle.
    distinct = settled(
        rows.where("ok")
        .groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("mult"))
        .select("label", "rep", "mult", F.size("embedding").alias("dim"), c("embedding").cast("array<double>").alias("e"))
        .withColumn("nid", F.monotonically_increasing_id())  # a node of its own: two vectors may share a least id
    )
    ranked = distinct.withColumn("_r", F.row_number().over(Window.partitionBy("dim").orderBy(F.xxhash64("rep"), "rep", "nid")))
    chosen = ranked.where(c("_r") <= pivots).select("dim", (c("_r") - 1).cast("int").alias("pid"), "e")
    indexed = settled(_prefixes(distinct, chosen, prefix))
    posted = indexed.select("label", "dim", "nid", "mult", "e", "perm", F.explode("perm").alias("pivot"))
    sizes = _bounded(posted.groupBy("label", "dim", "pivot").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("nb")))
    posted = posted.join(sizes, ["label", "dim", "pivot"]).withColumn("b", F.pmod(F.xxhash64("nid"), c("nb")).cast("int"))
    paired = posted.withColumn("o", F.explode(F.sequence(F.lit(0), c("nb") - 1))).select(
        "*", F.least("b", "o").alias("lo"), F.greatest("b", "o").alias("hi")
    ).drop("o", "nb")
    found = settled(paired.groupBy("label", "dim", "pivot", "lo", "hi").applyInPandas(_block_work(threshold), "rep long, add long, other long"))
    added = found.where(c("other").isNull()).groupBy(c("rep").alias("nid")).agg(F.sum("add").alias("found"))
    parts = components(found.where(c("other").isNotNull()).select(c("rep").alias("u"), c("other").alias("v")))
    parts = parts.unionByName(parts.select(c("component").alias("node"), "component").distinct())  # roots are listed as components only
    parts = parts.join(distinct.select(c("nid").alias("node"), "rep"), "node")
    least = parts.groupBy("component").agg(F.min("rep").alias("comp"))  # partial minima: a large component is no hot key
    parts = parts.join(least, "component").select(c("node").alias("nid"), "comp")
    per_vector = distinct.select("label", "nid", "rep", "mult").join(added, "nid", "left").join(parts, "nid", "left")
    # Each row of a copy group meets its vector's figures by (label, components); a hot group is split by skew handling.
    figures = per_vector.join(distinct.select("nid", "e"), "nid")
    figures = figures.select("label", c("e").alias("_k"), "mult", "found", "comp", "rep")
    good = rows.where("ok").withColumn("_k", c("embedding").cast("array<double>")).join(figures, ["label", "_k"])
    good = good.select(
        "vec_id",
        "label",
        (c("mult") - 1 + F.coalesce("found", F.lit(0))).alias("n_links"),
        F.coalesce("comp", "rep").alias("component_id"),
    )
    bad = rows.where(~c("ok")).select("vec_id", "label", F.lit(0).cast("long").alias("n_links"), c("vec_id").alias("component_id"))
    out = good.unionByName(bad)
    return out.withColumn("kept", F.coalesce(c("vec_id") == c("component_id"), F.lit(False)))


def links_digest(vectors: DataFrame) -> DataFrame:
    return pivot_links(vectors).select("vec_id", "n_links", "component_id", "kept", "label")
