"""Every query over whole small tables, against step-by-step rules, the public libraries, SQL, or held-out labels."""

import duckdb
import public_tokenizers
import pytest
import sentencepiece
from llm_rules import base_quality, base_secrets, contamination, near_components, removed_bytes, sha

from runsift.llm.queries import QUERIES, SQL
from runsift.llm.token_counts import cleaning_edits, counter

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return {t: spark.read.parquet(f"{SMALL}/{t}.parquet").toPandas() for t in ("documents", "benchmark", "labels")}


@pytest.fixture(scope="module")
def run(spark):
    held = {}

    def get(name, sf=SMALL):
        if (name, sf) not in held:
            held[name, sf] = {r["doc_id"]: r for r in QUERIES[name](spark, sf).collect()}
        return held[name, sf]

    return get


def test_token_counts(tables, run):
    encoding = counter(public_tokenizers.path("byte_bpe_50k.tiktoken")).encoding
    found = run("op1_token_counts")
    for i, text in zip(tables["documents"].doc_id, tables["documents"].text):
        edits = cleaning_edits(text)
        after = text
        for a, b, s in edits:
            after = after[:a] + s + after[b:]
        row = found[i]
        assert (row.n_tokens, row.n_edits, row.n_tokens_after) == (len(encoding.encode_ordinary(text)), len(edits), len(encoding.encode_ordinary(after)))


def test_sentencepiece(tables, run):
    public = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found = run("op2_sentencepiece")
    for i, text in zip(tables["documents"].doc_id, tables["documents"].text):
        ids = public.encode(text)
        assert tuple(found[i])[1:] == (len(ids), sha(",".join(map(str, ids))), sha(public.decode(ids)))


def test_decontamination(tables, run):
    items = list(zip(tables["benchmark"].item_id, tables["benchmark"].text))
    found = run("op3_benchmark_decontamination")
    assert any(r.contaminated for r in found.values())
    for i, text in zip(tables["documents"].doc_id, tables["documents"].text):
        assert tuple(found[i])[1:] == contamination(text, items)


def test_repeats(tables, run):
    found = run("op4_suffix_array_dedup")
    for i, expected in zip(tables["documents"].doc_id, removed_bytes(tables["documents"].text), strict=True):
        assert tuple(found[i])[1:] == expected


def test_language(tables, run):
    found = run("op5_language_id")
    held = [(r.lang_pred, lang) for i, lang in zip(tables["documents"].doc_id, tables["documents"].lang) if (r := found[i]).held_out]
    assert len(held) > 20 and sum(a == b for a, b in held) >= 0.95 * len(held)


def test_near(tables, run):
    found = run("op6_minhash_near_dedup")
    expected = near_components(list(zip(tables["documents"].doc_id, tables["documents"].text)), 2)
    assert {i: (r.n_shingles, r.component_id) for i, r in found.items()} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in found.values())


@pytest.mark.parametrize(("name", "label", "least"), [("op7_toxicity", "toxic", 0.85), ("op8_quality_classifier", "quality", 0.95)])
def test_classifiers(spark, run, name, label, least):
    sf = "/root/testdata/sf0.01"
    found = run(name, sf)
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(found[i].predicted, y) for i, y in labels.items() if found[i].held_out]
    assert len(held) > 50 and sum(a == b for a, b in held) >= least * len(held)
    assert all(0 <= r.score <= 1 for r in found.values())
    assert sum(p for p, y in held if y == 0) <= 0.3 * sum(y == 0 for _, y in held)


def test_secrets(tables, run):
    found = run("op9_secret_scans")
    for i, text in zip(tables["documents"].doc_id, tables["documents"].text):
        base = base_secrets(text)
        said = [f"{k}:{a}:{b}" for k, a, b in base]
        row = found[i]
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(sum(k == x for k, _, _ in base) for x in ("assign", "access", "hex"))
        assert row.base_sha256 == sha(",".join(said)) and set(said) <= set(filter(None, row.spans.split(","))) | set()


def test_rules(tables, run):
    found = run("op10_quality_rules")
    for i, text in zip(tables["documents"].doc_id, tables["documents"].text):
        assert tuple(found[i])[1:7] == base_quality(text)
        assert not (found[i].base_failed and found[i].kept)


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(run, name):
    other = duckdb.connect()
    for t in ("documents", "benchmark"):
        other.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    expected = other.execute(SQL[name]).fetchdf().to_dict("records")
    found = [r.asDict() for r in run(name).values()]
    key = lambda r: r["doc_id"]
    assert sorted(found, key=key) == sorted(expected, key=key)
