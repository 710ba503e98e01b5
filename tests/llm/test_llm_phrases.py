"""Collocations against counting every phrase in plain Python, by both ways of checking parts, and against SQL."""

import collections

import random

import duckdb
import numpy as np
import pyarrow as pa

from runsift.llm import phrases
from runsift.llm.phrases import _counted_rows, collocations, phrase_hashes, pieces, split_words
from runsift.llm.queries import SQL

SMALL = "/root/testdata/sf0.001/documents.parquet"


def plain(rows, least, top=2000):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            n[lang] += len(words)
            for m in range(1, 6):
                for i in range(len(words) - m + 1):
                    f[lang, " ".join(words[i : i + m])] += 1
    cands = {(lang, p): a for (lang, p), a in f.items() if 2 <= len(p.split(" ")) <= 5 and a >= least}
    out = []
    for (lang, p), a in cands.items():
        w = p.split(" ")
        inside = any(
            lang == l2 and len(q.split(" ")) > len(w) and b >= a and f" {p} " in f" {q} " for (l2, q), b in cands.items()
        )
        if inside:
            continue
        best = min(((1000 * a * n[lang]) // (f[lang, " ".join(w[:k])] * f[lang, " ".join(w[k:])]), k) for k in range(1, len(w)))
        k = best[1]
        out.append((lang, p, a, f[lang, " ".join(w[:k])], f[lang, " ".join(w[k:])], n[lang], best[0], k))
    ranked = []
    for lang in {r[0] for r in out}:
        mine = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        ranked += [(r[0], i + 1, *r[1:]) for i, r in enumerate(mine)]
    return sorted(ranked)


def found(frame):
    return sorted(tuple(r) for r in frame.select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "k").collect())


def test_small_table_equals_plain_count(spark, monkeypatch):
    docs = spark.read.parquet(SMALL)
    want = plain([(r.lang, r.text) for r in docs.collect()], least=20)
    assert len(want) > 10
    assert found(collocations(docs, least=20)) == want
    monkeypatch.setattr(phrases, "MOST_BROADCAST", 0)  # parts checked by joins
    monkeypatch.setattr(phrases, "_ROWS", 3)  # many small runs per task
    assert found(collocations(docs, least=20)) == want


def test_edges(spark):
    """Null lang and text, empty texts, tabs, separators, upper case, ties, repeated rows, long texts, other columns."""
    rows = [
        (None, "Big Cat. big cat; BIG\tcat"),
        (None, None),
        ("en", ""),
        ("en", "a b c d e f. " * 400),
        ("en", "a b c d e f. " * 400),
        ("en", "x y! x y? x y" + " z" * 5000),
        ("und", "big cat"),
    ]
    docs = spark.createDataFrame(rows, "lang string, text string").withColumn("score", __import__("pyspark.sql.functions", fromlist=["lit"]).lit(1))
    assert found(collocations(docs, least=3)) == plain(rows, least=3)
    assert collocations(spark.createDataFrame([], "lang string, text string"), least=3).count() == 0


def test_sql_equals_spark(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}'")
    sql = SQL["op12_phrase_collocations"].replace("f >= 100", "f >= 20")
    want = sorted(tuple(r) for r in con.sql(f"SELECT lang, rank, phrase, a, l, r, n, score, k FROM ({sql})").fetchall())
    assert want and found(collocations(spark.read.parquet(SMALL), least=20)) == want


def test_words_are_cut_by_bytes():
    some = random.Random(5)
    texts = [None, "", ".", "Ab", " Ab", "ab c ", "\u00c4B\u00df.\u00c4b\t\u4e2d\u6587;x\x0by\x0cz\rq\u00a0r"]
    texts += ["".join(some.choices("aB\u00e9\u4e2d\U0001f600 \t.,\n-", k=some.randrange(30))) for _ in range(500)]
    column = pa.array(["x y", *texts])[1:]
    words, text, piece = split_words(column)
    found = collections.defaultdict(list)
    for word, i, k in zip(words.to_pylist(), text.tolist(), piece.tolist(), strict=True):
        found[i, k].append(word)
    assert [(i, w) for (i, _), w in sorted(found.items())] == [(i, w) for i, t in enumerate(texts) for w in pieces(t)]
    assert len(split_words(pa.array([None, ""], pa.string()))[0]) == 0


def test_rows_of_numbers_are_counted_whatever_their_size():
    some = np.random.default_rng(3)
    for sizes in ([2, 3, 4], [3, 1 << 30, 1 << 30, 1 << 30, 1 << 30, 1 << 30]):
        columns = [some.choice(some.integers(0, s, 2), 500) for s in sizes]
        rows, counts = _counted_rows(columns, sizes)
        want = sorted(collections.Counter(zip(*(c.tolist() for c in columns), strict=True)).items())
        assert list(zip(zip(*(c.tolist() for c in rows), strict=True), counts.tolist(), strict=True)) == want


def test_a_batch_of_many_texts_is_one_run():
    """What each slice of 512 texts told again went through the shuffle once more."""
    texts = ["some words here. some words there"] * 3000 + ["some long words here"] * 100
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), pa.array(texts)], names=["lang", "text"])
    below = pa.array(["some", "words", "here"])
    held = phrases.Frequent(np.unique(phrase_hashes(pa.array(["en"] * 3), below)))
    (run,) = phrases.runs(iter([batch]), 2, held)
    assert dict(zip(run.column(1).to_pylist(), run.column(2).to_pylist(), strict=True)) == {"some words": 6000, "words here": 3100}
