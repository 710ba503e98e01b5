"""The registered queries of this folder, and those of them that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from runsift.llm import pieces
from runsift.llm.decontaminate import contamination_digest
from runsift.llm.frames import table
from runsift.llm.language import language_digest
from runsift.llm.manifest import manifest_digest
from runsift.llm.near import near_digest
from runsift.llm.phrases import collocations
from runsift.llm.pivots import links_digest
from runsift.llm.quality import quality_digest
from runsift.llm.repeats import repeats_digest
from runsift.llm.rules import rules_digest
from runsift.llm.secrets import secrets_digest
from runsift.llm.token_counts import token_digest
from runsift.llm.toxicity import toxicity_digest


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digest(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), keep=["doc_id"])


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats_digest(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_digest(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_digest(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_digest(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules_digest(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_digest(table(spark, sf_dir, "documents"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links_digest(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_sentencepiece,
        op3_benchmark_decontamination,
        op4_suffix_array_dedup,
        op5_language_id,
        op6_minhash_near_dedup,
        op7_toxicity,
        op8_quality_classifier,
        op9_secret_scans,
        op10_quality_rules,
        op11_merkle_manifest,
        op12_phrase_collocations,
        op13_embedding_near_dedup,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP3 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
win AS (
    SELECT DISTINCT item, least(len(w), 10) AS n, unnest([array_to_string(w[k:k + 9], ' ') FOR k IN range(1, greatest(len(w) - 8, 2))]) AS x
    FROM i WHERE len(w) > 0
),
sizes AS (SELECT DISTINCT n FROM win),
cut AS (
    SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS k, unnest([array_to_string(w[j:j + n - 1], ' ') FOR j IN range(1, len(w) - n + 2)]) AS x
    FROM d, sizes WHERE len(w) >= n
),
found AS (SELECT doc_id, k, cut.n, item FROM cut JOIN win ON cut.x = win.x AND cut.n = win.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM found) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS named
    FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(named, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_OP6 = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
    SELECT doc_id, unnest(CASE WHEN len(w) = 1 THEN w ELSE list_distinct([w[k] || ' ' || w[k + 1] FOR k IN range(1, len(w))]) END) AS x
    FROM d WHERE len(w) > 0
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY u, v),
link AS (
    SELECT u, v FROM pairs JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * k >= 80 * (a.n + b.n - k)
),
sym AS (SELECT u, v FROM link UNION ALL SELECT v, u FROM link),
reach(doc_id, other) AS (SELECT u, v FROM sym UNION SELECT reach.doc_id, sym.v FROM reach JOIN sym ON reach.other = sym.u),
least_ AS (SELECT doc_id, min(other) AS m FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id, d.doc_id <= coalesce(m, d.doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least_ USING (doc_id)
"""

def _field(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR) END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_OP11 = f"""
WITH RECURSIVE tab(n, k, c) AS (
    SELECT i, 0, CAST(i AS UBIGINT) FROM range(256) t(i)
    UNION ALL SELECT n, k + 1, CASE WHEN c & 1 = 1 THEN xor(CAST(3988292384 AS UBIGINT), c >> 1) ELSE c >> 1 END FROM tab WHERE k < 8
),
crct AS (SELECT n, c FROM tab WHERE k = 8),
ids AS (SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR) AS s FROM documents WHERE doc_id IS NOT NULL),
crc(doc_id, s, i, c) AS (
    SELECT doc_id, s, 0, CAST(4294967295 AS UBIGINT) FROM ids
    UNION ALL
    SELECT crc.doc_id, crc.s, i + 1, xor(crct.c, crc.c >> 8) FROM crc
    JOIN crct ON crct.n = (xor(crc.c, CAST(ascii(substr(crc.s, i + 1, 1)) AS UBIGINT)) & 255) WHERE i < strlen(crc.s)
),
crcs AS (SELECT doc_id, xor(c, CAST(4294967295 AS UBIGINT)) AS crc FROM crc WHERE i = strlen(s)),
rows_ AS (
    SELECT doc_id, lang, {_leaf("text")} AS leaf,
        {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS lowered,
        row_number() OVER () AS rid
    FROM documents
),
lv0 AS (
    SELECT r.*, CASE WHEN crcs.crc % 3 = 0 THEN lowered ELSE leaf END AS fleaf,
        dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS lk,
        row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
    FROM rows_ r LEFT JOIN crcs USING (doc_id)
),
lt(l, lk, idx, h, cnt) AS (
    SELECT 0, lk, pos, leaf, count(*) OVER (PARTITION BY lk) FROM lv0
    UNION ALL
    SELECT l + 1, lk, idx // 8, sha256(string_agg(h, '' ORDER BY idx)), max((cnt + 7) // 8) FROM lt WHERE cnt > 1 GROUP BY l, lk, idx // 8
),
sub AS (SELECT lk, h FROM lt WHERE cnt = 1),
rt(l, idx, h, cnt) AS (
    SELECT 0, lk, h, count(*) OVER () FROM sub
    UNION ALL
    SELECT l + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx)), max((cnt + 7) // 8) FROM rt WHERE cnt > 1 GROUP BY l, idx // 8
),
top AS (SELECT h FROM rt WHERE cnt = 1),
w0(rid, lk, l, idx, f, proof) AS (
    SELECT rid, lk, 0, pos, fleaf, '' FROM lv0
    UNION ALL
    SELECT w.rid, w.lk, w.l + 1, w.idx // 8,
        sha256(string_agg(CASE WHEN s.idx = w.idx THEN w.f ELSE s.h END, '' ORDER BY s.idx)),
        w.proof || string_agg(CASE WHEN s.idx = w.idx THEN '' ELSE s.h END, '' ORDER BY s.idx)
    FROM w0 w JOIN lt s ON s.lk = w.lk AND s.l = w.l AND s.idx // 8 = w.idx // 8 AND s.cnt > 1
    GROUP BY w.rid, w.lk, w.l, w.idx, w.f, w.proof
),
end0 AS (SELECT w.* FROM w0 w JOIN lt s ON s.lk = w.lk AND s.l = w.l AND s.cnt = 1),
w1(rid, l, idx, f, proof) AS (
    SELECT rid, 0, lk, f, proof FROM end0
    UNION ALL
    SELECT w.rid, w.l + 1, w.idx // 8,
        sha256(string_agg(CASE WHEN s.idx = w.idx THEN w.f ELSE s.h END, '' ORDER BY s.idx)),
        w.proof || string_agg(CASE WHEN s.idx = w.idx THEN '' ELSE s.h END, '' ORDER BY s.idx)
    FROM w1 w JOIN rt s ON s.l = w.l AND s.idx // 8 = w.idx // 8 AND s.cnt > 1
    GROUP BY w.rid, w.l, w.idx, w.f, w.proof
),
end1 AS (SELECT w.* FROM w1 w JOIN rt s ON s.l = w.l AND s.cnt = 1)
SELECT v.doc_id, v.leaf, sub.h AS subroot, top.h AS root, sha256(e.proof) AS proof_sha256, e.f AS folded_root,
    e.f = top.h AS verified, v.lang, CAST(v.pos AS BIGINT) AS pos
FROM lv0 v JOIN sub USING (lk) JOIN end1 e USING (rid), top
"""

_OP13 = """
WITH RECURSIVE r AS (SELECT DISTINCT vec_id, label, embedding FROM embeddings),
r2 AS (
    SELECT *, row_number() OVER () AS rid,
        coalesce(vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
            AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
            AND list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))) > 0, false) AS ok
    FROM r
),
v AS (
    SELECT rid, vec_id, label, CAST(embedding AS DOUBLE[]) AS e, sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x))) AS n
    FROM r2 WHERE ok
),
link AS (
    SELECT a.rid AS u, b.rid AS w FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.rid < b.rid
    WHERE list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.93
),
sym AS (SELECT u, w FROM link UNION ALL SELECT w, u FROM link),
reach(a, b) AS (SELECT u, w FROM sym UNION SELECT reach.a, sym.w FROM reach JOIN sym ON reach.b = sym.u),
comp AS (SELECT reach.a AS rid, min(v.vec_id) AS m FROM reach JOIN v ON v.rid = reach.b GROUP BY reach.a),
cnt AS (SELECT u AS rid, count(*) AS k FROM sym GROUP BY u)
SELECT r2.vec_id, CAST(coalesce(cnt.k, 0) AS BIGINT) AS n_links, CAST(least(r2.vec_id, coalesce(comp.m, r2.vec_id)) AS BIGINT) AS component_id,
    coalesce(r2.vec_id = least(r2.vec_id, coalesce(comp.m, r2.vec_id)), false) AS kept, r2.label
FROM r2 LEFT JOIN cnt USING (rid) LEFT JOIN comp USING (rid)
"""

_OP12 = f"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, {_LOWER} AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \x09]+'), lambda x: x <> '') AS ws FROM p),
totals AS (SELECT lang, sum(len(ws)) AS n FROM w GROUP BY lang),
g AS (
    SELECT lang, m, unnest([array_to_string(ws[i:i + m - 1], ' ') FOR i IN range(1, len(ws) - m + 2)]) AS phrase
    FROM w, (SELECT unnest(range(1, 6)) AS m) WHERE len(ws) >= m
),
f AS (SELECT lang, phrase, m, count(*) AS f FROM g GROUP BY ALL),
cand AS (SELECT lang, phrase, m, f AS a FROM f WHERE m >= 2 AND f >= 100),
inner_ AS (
    SELECT c.lang, c.a, unnest([array_to_string(string_split(c.phrase, ' ')[i:i + k - 1], ' ') FOR i IN range(1, c.m - k + 2)]) AS phrase
    FROM cand c, (SELECT unnest(range(2, 5)) AS k) WHERE k < c.m
),
covered AS (SELECT lang, phrase, max(a) AS outer_ FROM inner_ GROUP BY ALL),
kept AS (SELECT c.* FROM cand c LEFT JOIN covered v USING (lang, phrase) WHERE v.outer_ IS NULL OR v.outer_ < c.a),
cuts AS (
    SELECT k.lang, k.phrase, k.a, j AS k, array_to_string(string_split(k.phrase, ' ')[1:j], ' ') AS lp,
        array_to_string(string_split(k.phrase, ' ')[j + 1:], ' ') AS rp
    FROM kept k, (SELECT unnest(range(1, 5)) AS j) WHERE j < k.m
),
scored AS (
    SELECT c.lang, c.phrase, c.a, c.k, fl.f AS l, fr.f AS r, t.n,
        CAST((CAST(1000 AS HUGEINT) * c.a * t.n) // (CAST(fl.f AS HUGEINT) * fr.f) AS BIGINT) AS score
    FROM cuts c JOIN f fl ON fl.lang = c.lang AND fl.phrase = c.lp JOIN f fr ON fr.lang = c.lang AND fr.phrase = c.rp JOIN totals t ON t.lang = c.lang
),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM best)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
    CAST(n AS BIGINT) AS n, score, CAST(k AS BIGINT) AS k
FROM ranked WHERE rank <= 2000
"""

#: The others need encoders, learned models, byte arithmetic over all positions, or several statements.
SQL: dict[str, str] = {"op3_benchmark_decontamination": _OP3, "op6_minhash_near_dedup": _OP6, "op11_merkle_manifest": _OP11, "op12_phrase_collocations": _OP12, "op13_embedding_near_dedup": _OP13}
