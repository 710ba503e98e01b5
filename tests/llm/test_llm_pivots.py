"""Links of vectors by the pivot-permutation index against brute force over all pairs, and against its SQL."""

import duckdb
import numpy as np
import pytest

from runsift.llm.pivots import pivot_links
from runsift.llm.queries import SQL

HOT = "/root/testdata/check_h/embeddings.parquet"
SMALL = "/root/testdata/sf0.01/embeddings.parquet"


def brute(rows):
    """(vec_id, n_links, component_id, kept) per distinct row, by all pairs within a label."""
    rows = list(dict.fromkeys((i, lab, None if e is None else tuple(e)) for i, lab, e in rows))
    ok = []
    for k, (i, lab, e) in enumerate(rows):
        x = None if e is None else np.array([np.nan if v is None else v for v in e], dtype=np.float64)
        if i is not None and lab is not None and x is not None and len(x) and np.all(np.isfinite(x)) and (x * x).sum() > 0:
            ok.append(k)
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    links = [0] * len(rows)
    by = {}
    for k in ok:
        by.setdefault((rows[k][1], len(rows[k][2])), []).append(k)
    for members in by.values():
        x = np.array([rows[k][2] for k in members], dtype=np.float64)
        n = np.sqrt((x * x).sum(1))
        cos = (x @ x.T) / np.outer(n, n)
        a, b = np.nonzero(np.triu(cos >= 0.93, 1))
        for p, q in zip(a, b, strict=True):
            u, w = members[p], members[q]
            links[u] += 1
            links[w] += 1
            parent[find(u)] = find(w)
    least = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            r = find(k)
            least[r] = min(least.get(r, i), i)
    out = []
    for k, (i, _, _) in enumerate(rows):
        comp = None if i is None else least[find(k)]
        out.append((i, links[k], comp, i is not None and comp == i))
    return sorted(out, key=lambda t: (t[0] is None, t[0] or 0, t[1]))


def found(frame):
    got = [tuple(r) for r in frame.select("vec_id", "n_links", "component_id", "kept").collect()]
    return sorted(got, key=lambda t: (t[0] is None, t[0] or 0, t[1]))


def test_dense_group_equals_brute_force(spark):
    vectors = spark.read.parquet(HOT)
    want = brute([(r.vec_id, r.label, r.embedding) for r in vectors.collect()])
    assert sum(t[1] for t in want) > 100_000  # a dense group of near copies
    assert found(pivot_links(vectors)) == want


@pytest.mark.parametrize("block", [3, 2048])
def test_edges(spark, block):
    """Copies, a repeated row, zero, null, NaN, infinite and null-component vectors, null ids and labels, other lengths."""
    base = [1.0, 0.5, 0.25, 0.0]
    rows = [
        (1, 0, base), (2, 0, base), (3, 0, base), (3, 0, base),
        (4, 0, [1.0, 0.55, 0.25, 0.01]), (5, 0, [-1.0, 0.0, 0.0, 0.0]), (6, 0, [0.0, 0.0, 0.0, 0.0]),
        (7, 0, None), (8, 0, [float("nan"), 1.0, 0.0, 0.0]), (9, 0, [float("inf"), 1.0, 0.0, 0.0]),
        (10, 0, [1.0, None, 0.0, 0.0]), (None, 0, base), (11, None, base), (12, 1, base), (13, 0, [1.0, 0.5]),
        (14, 0, [1.0, 0.5]), (15, 0, []), (4, 0, [-1.0, 0.1, 0.0, 0.0]),
        *[(100 + k, 2, [1.0, 0.01 * k, 0.0, 0.0]) for k in range(40)],
    ]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    got = found(pivot_links(frame.withColumn("n_links", frame.vec_id), block=block, pivots=3, prefix=2))
    assert got == brute(rows)


def test_sql_equals_spark(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}'")
    want = sorted((tuple(r) for r in con.sql(f"SELECT vec_id, n_links, component_id, kept FROM ({SQL['op13_embedding_near_dedup']})").fetchall()), key=str)
    assert sorted(found(pivot_links(spark.read.parquet(SMALL))), key=str) == want
