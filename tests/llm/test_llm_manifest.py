"""The Merkle manifest against a plain tree built row by row, and against its SQL, at several group depths."""

import hashlib
import zlib

import duckdb
import pytest

from runsift.llm.manifest import manifest_digest
from runsift.llm.queries import SQL

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _field(v) -> str:
    if v is None:
        return "-"
    s = str(v)
    return f"{len(s.encode())}:{s}"


def _leaf(r, text) -> str:
    return _h("".join(_field(v) for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))


def _levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        now = out[-1]
        out.append([_h("".join(now[i : i + 8])) for i in range(0, len(now), 8)])
    return out


def _walk(levels, i, node):
    proof = ""
    for level in levels[:-1]:
        low = i - i % 8
        left, right = "".join(level[low:i]), "".join(level[i + 1 : low + 8])
        proof += left + right
        node = _h(left + node + right)
        i //= 8
    return proof, node


def plain(rows):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row, built one by one."""
    by_lang = {}
    for r in rows:
        text = r["text"]
        changed = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
        lowered = None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        by_lang.setdefault(r["lang"], []).append((r["doc_id"], _leaf(r, text), _leaf(r, lowered) if changed else None))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1]))
        trees[lang] = _levels([t[1] for t in by_lang[lang]])
    crown = _levels([trees[lang][-1][0] for lang in langs])
    root = crown[-1][0]
    out = []
    for k, lang in enumerate(langs):
        for i, (doc_id, leaf, changed) in enumerate(by_lang[lang]):
            low, node = _walk(trees[lang], i, changed or leaf)
            high, node = _walk(crown, k, node)
            out.append((doc_id, leaf, trees[lang][-1][0], root, _h(low + high), node, node == root))
    return sorted(out, key=lambda t: (t[0] is not None, t[0] or 0, t[1]))


def found(frame):
    rows = [tuple(r) for r in frame.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()]
    return sorted(rows, key=lambda t: (t[0] is not None, t[0] or 0, t[1]))


@pytest.mark.parametrize("levels", [1, 2, 5])
def test_whole_table_equals_plain_tree(spark, levels):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert found(manifest_digest(docs, levels)) == plain([r.asDict() for r in docs.collect()])


def test_edges(spark):
    """Nulls everywhere, a null lang, a null doc_id, repeated rows, equal ids, long and empty texts, other columns."""
    rows = [
        (1, "Hello World", "en", "web", 11),
        (1, "Hello World", "en", "web", 11),
        (1, "other Text", "en", "web", 10),
        (None, "Null Id", "en", None, None),
        (2, None, None, None, None),
        (3, "", "de", "x", 0),
        (4, "Ünïcode ÄB" * 5000, "de", "x", 50000),
        *[(i, f"Row {i}", "fr", "s", 5) for i in range(5, 90)],
    ]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("leaf", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("x"))
    want = plain([dict(zip(["doc_id", "text", "lang", "source", "n_chars"], r, strict=True)) for r in rows])
    for levels in (1, 5):
        assert found(manifest_digest(docs, levels)) == want
    assert sum(1 for r in want if not r[6]) > 0


def test_single_row_and_empty(spark):
    one = spark.createDataFrame([(7, "Abc", "en", "s", 3)], SCHEMA)
    (row,) = found(manifest_digest(one))
    assert row[1] == row[2] == row[3]  # a lone leaf is its subroot and the root
    assert manifest_digest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sql_equals_spark(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    want = sorted(tuple(r) for r in con.sql(f"SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, verified FROM ({SQL['op11_merkle_manifest']})").fetchall())
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert sorted(found(manifest_digest(docs))) == want
