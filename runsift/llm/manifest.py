"""A Merkle manifest of a table of documents, with a proof per row and a check of each proof against tampered rows.

Every row is a leaf: H of its fields doc_id, source, lang, n_chars, text, each `-` if null, else its UTF-8 byte count, `:`,
and its value (integers in decimal). H is the lowercase hex SHA-256 of the concatenated inputs; digests enter as hex text.
Per lang, leaves ascend by doc_id (null first; equal ids by leaf); while a level holds several nodes, every 8 consecutive
ones (the last run may hold fewer, even one) become their H. The one node left is the lang's subroot; a lone leaf is its
own subroot. Subroots ordered by lang (null first, UTF-8 bytewise) give the root likewise.

The work is cogrouped subtree exchange. Leaves are numbered per lang by a range-partitioned sort. A superblock is 8**LEVELS
consecutive leaves of one lang, so that it covers whole subtrees: it reduces by itself to its top node. The tops form the
next, 8**LEVELS times smaller round, until every lang has one node; the subroots form the root's tree the same way. Each
round also gives, per node, the siblings on its way to the top of its group; joined top down, these make the outer path
of each superblock. Last, the leaves of a superblock and its outer path are cogrouped in applyInPandas, which reduces the
superblock again, joins local and outer siblings into proofs and folds every leaf, tampered or not, up to a root.

Defined cases: an empty table gives no rows. Null fields are `-`; null lang is a lang of its own, first; a null doc_id
sorts first and is never tampered. Repeated rows are separate leaves. Tampering lower-cases A-Z of the text where 3
divides the unsigned crc32 of the decimal doc_id; a row whose text holds no A-Z (or is null) folds to the root. Other
columns of the input are ignored; the output has its own names only.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runsift.llm.frames import settled

FAN = 8
#: Levels that one group reduces by itself: a group holds 8**5 = 32,768 nodes at most, whatever the size of a lang.
LEVELS = 5
#: Small tables (counts per partition and lang, langs, outer paths) are broadcast up to so many rows, else shuffled.
MOST_BROADCAST = 200_000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PATH = "array<struct<l:string,r:string>>"


def _field(c: Column) -> Column:
    s = c.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_hash(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """The leaf of a row, as a column expression that stays in the JVM."""
    return F.sha2(F.concat(*[_field(c) for c in (doc_id, source, lang, n_chars, text)]), 256)


def tampered(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 0, F.lit(False))


def _h(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def reduce_group(hashes: list[str], total: int, levels: int) -> list[list[str]]:
    """Levels of an aligned group of nodes, the first being `hashes`: at most `levels` steps, and none once a level of
    the whole tree, which holds `total` nodes at the first level, has a single node."""
    out, count = [list(hashes)], total
    while count > 1 and len(out) <= levels:
        now = out[-1]
        out.append([_h(now[i : i + FAN]) for i in range(0, len(now), FAN)])
        count = -(-count // FAN)
    return out


def path_of(tree: list[list[str]], i: int) -> list[tuple[str, str]]:
    """Siblings left and right of node `i` of the first level, level by level to the top of `tree`."""
    path = []
    for level in tree[:-1]:
        low = i - i % FAN
        path.append(("".join(level[low:i]), "".join(level[i + 1 : low + FAN])))
        i //= FAN
    return path


def fold(node: str, path) -> str:
    for left, right in path:
        node = _h([left, node, right])
    return node


def _numbered(frame: DataFrame, key: str, order: list[str]) -> DataFrame:
    """`frame` with `pos`: place of each row within its `key`, counted from 0 by `order`, by a range-partitioned sort.

    A key with a third of all rows spreads over many partitions; only counts per (partition, key) are combined.
    """
    spark = frame.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = frame.repartitionByRange(parts, *[F.col(c).asc_nulls_first() for c in order]).sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order])
    ordered = settled(ordered.withColumn("_m", F.monotonically_increasing_id()))
    ordered = ordered.withColumn("_p", F.shiftright("_m", 33)).withColumn("_i", F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)))
    counts = ordered.groupBy("_p", key).agg(F.count("*").alias("_n"), F.min("_i").alias("_first"))
    before = Window.partitionBy(key).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).drop("_n", "_first")
    counts = _bounded(counts)
    return ordered.join(counts, ["_p", key]).withColumn("pos", F.col("_offset") + F.col("_i")).drop("_m", "_p", "_i", "_offset")


def _bounded(small: DataFrame) -> DataFrame:
    """`small`, settled, with a broadcast hint where its row count is proven below MOST_BROADCAST."""
    small = settled(small)
    return F.broadcast(small) if small.count() <= MOST_BROADCAST else small


def _reduce_round(nodes: DataFrame, totals: DataFrame, levels: int) -> tuple[DataFrame, DataFrame]:
    """One round over nodes (lk, idx, h): tops (lk, idx, h) of groups of 8**levels nodes, and each node's path to its top."""
    grouped = nodes.join(totals, "lk").withColumn("g", F.shiftright("idx", 3 * levels))

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("idx")
        total, g, lk = int(rows["total"].iat[0]), int(rows["g"].iat[0]), rows["lk"].iat[0]
        tree = reduce_group(rows["h"].tolist(), total, levels)
        paths = [[{"l": a, "r": b} for a, b in path_of(tree, i)] for i in range(len(rows))]
        top = pd.DataFrame({"lk": [lk], "idx": [g], "h": [tree[-1][0]], "path": [None], "top": [True]})
        below = pd.DataFrame({"lk": lk, "idx": rows["idx"].to_numpy(), "h": rows["h"].to_numpy(), "path": paths, "top": False})
        return pd.concat([below, top], ignore_index=True)

    out = settled(grouped.groupBy("lk", "g").applyInPandas(work, f"lk long, idx long, h string, path {_PATH}, top boolean"))
    return out.where("top").select("lk", "idx", "h"), out.where("not top").select("lk", "idx", "path")


def _tree(nodes: DataFrame, levels: int) -> tuple[DataFrame, DataFrame]:
    """Rounds over nodes (lk, idx, h) until each lk holds one node: tops (lk, h), and the outer path (lk, idx, path) of each first node."""
    rounds = []
    while True:
        totals = _bounded(nodes.groupBy("lk").agg(F.count("*").alias("total")))
        if totals.agg(F.max("total")).first()[0] in (None, 1):
            break
        nodes, paths = _reduce_round(nodes, totals, levels)
        rounds.append(paths)
    tops = nodes.select("lk", "h")
    if not rounds:
        return tops, nodes.select("lk", "idx", F.array().cast(_PATH).alias("path"))
    outer = rounds[-1]
    for paths in reversed(rounds[:-1]):
        up = outer.select("lk", F.col("idx").alias("up"), F.col("path").alias("above"))
        outer = paths.withColumn("up", F.shiftright("idx", 3 * levels)).join(up, ["lk", "up"]).select(
            "lk", "idx", F.concat("path", "above").alias("path")
        )
    return tops, outer


def manifest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Per row of `docs` (doc_id, source, lang, n_chars, text): doc_id, lang, pos, leaf, subroot, root, proof_sha256,
    folded_root, verified (folded_root = root). `levels`: levels that one group reduces by itself; 8**levels leaves a group."""
    c = F.col
    rows = docs.select(
        c("doc_id").cast("long").alias("doc_id"),
        c("lang").cast("string").alias("lang"),
        leaf_hash(c("doc_id"), c("source"), c("lang"), c("n_chars"), c("text")).alias("leaf"),
        F.when(tampered(c("doc_id")), leaf_hash(c("doc_id"), c("source"), c("lang"), c("n_chars"), F.translate("text", _UPPER, _UPPER.lower()))).alias("changed"),
    )
    # Langs are numbered in order (a window over one row per lang); a null lang is a key of its own.
    rows = rows.withColumn("_lang", F.concat(F.when(c("lang").isNull(), "0").otherwise("1"), F.coalesce("lang", F.lit(""))))
    langs = rows.select("_lang").distinct().withColumn("lk", (F.row_number().over(Window.orderBy("_lang")) - 1).cast("long"))
    leaves = _numbered(rows.join(_bounded(langs), "_lang").drop("_lang"), "lk", ["lk", "doc_id", "leaf"])
    leaves = leaves.withColumn("sb", F.shiftright("pos", 3 * levels))
    totals = _bounded(leaves.groupBy("lk").agg(F.count("*").alias("total")))

    # Tops of superblocks, then the trees above them; subroots, then the root's tree over subroots.
    def top_only(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        tree = reduce_group(rows["leaf"].tolist(), int(rows["total"].iat[0]), levels)
        return pd.DataFrame({"lk": [rows["lk"].iat[0]], "idx": [rows["sb"].iat[0]], "h": [tree[-1][0]]})

    tops = settled(leaves.select("lk", "sb", "pos", "leaf").join(totals, "lk").groupBy("lk", "sb").applyInPandas(top_only, "lk long, idx long, h string"))
    subroots, upper = _tree(tops, levels)
    root_top, root_paths = _tree(subroots.select(F.lit(0).cast("long").alias("lk"), F.col("lk").alias("idx"), "h"), levels)
    root = root_top.select("h").first()  # one value, or none for an empty table
    ends = subroots.select("lk", F.col("h").alias("subroot")).join(root_paths.select(F.col("idx").alias("lk"), F.col("path").alias("crown")), "lk")
    outer = upper.join(_bounded(ends), "lk").select(
        "lk", F.col("idx").alias("sb"), F.concat("path", "crown").alias("outer"), "subroot", F.lit(root and root[0]).alias("root")
    )
    outer = settled(outer)

    def finish(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return pd.DataFrame(columns=_OUT)
        rows = rows.sort_values("pos")
        tree = reduce_group(rows["leaf"].tolist(), int(rows["total"].iat[0]), levels)
        outer_path = [(s["l"], s["r"]) for s in above["outer"].iat[0]]
        outer_text = "".join(a + b for a, b in outer_path)
        proofs, folded = [], []
        for i, (leaf, changed) in enumerate(zip(rows["leaf"], rows["changed"], strict=True)):
            path = path_of(tree, i)
            proofs.append(_h([*(a + b for a, b in path), outer_text]))
            folded.append(fold(fold(leaf if changed is None else changed, path), outer_path))
        root = above["root"].iat[0]
        return pd.DataFrame(
            {
                "doc_id": rows["doc_id"].to_numpy(),
                "lang": rows["lang"].to_numpy(),
                "pos": rows["pos"].to_numpy(),
                "leaf": rows["leaf"].to_numpy(),
                "subroot": above["subroot"].iat[0],
                "root": root,
                "proof_sha256": proofs,
                "folded_root": folded,
                "verified": [f == root for f in folded],
            }
        )

    left = leaves.join(totals, "lk").groupBy("lk", "sb")
    return left.cogroup(outer.groupBy("lk", "sb")).applyInPandas(finish, _SCHEMA)


_SCHEMA = "doc_id long, lang string, pos long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
_OUT = [f.split()[0] for f in _SCHEMA.split(", ")]


def manifest_digest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    return manifest(docs, levels).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "lang", "pos")
