"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names, for every operator and stage."""

import corpus_pipeline
import public_tokenizers
import pytest
from llm_rules import base_quality, contamination, near_components, removed_bytes, sha

from runsift.llm import decontaminate, language, near, pieces, quality, repeats, rules, secrets, token_counts, toxicity

PIECES, RANKS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.tiktoken")
FIELDS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, N_WORDS string, sig int, tree string, kept string"
LONG = " ".join(f"word{i % 977} Ünter{i % 31}" for i in range(60_000))
PLAIN = "one plain little text about nothing much that goes on for some twenty words so that it is long enough to stay here"


def row(i, text, lang="en", source="s"):
    return (i, text, lang, source, None if text is None else len(text), "x", "y", 1, "z", "w")


ROWS = [
    row(1, None), row(2, ""), row(3, "   \n\t"), row(4, PLAIN), row(4, PLAIN), row(5, PLAIN), row(6, PLAIN, None, None), row(None, PLAIN),
    row(7, LONG), row(8, LONG + " end"), row(9, "x" * 100_000), row(10, "idiot trash " * 30), row(11, "é́漢\U0001f600 ▁ \x00 ſecret password = 'aB3$kQ9!zz7'"),
    row(12, "###!!! 12345"), row(13, PLAIN.upper()),
]
LABELS = [(i, i % 2, int(i == 10)) for i in range(1, 14)] + [(None, 1, 1), (4, None, None), (10, 0, 1)]
ITEMS = [(1, PLAIN), (2, None), (3, ""), (3, "much that"), (None, "one plain"), (5, PLAIN)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, FIELDS).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id bigint, text string")


DIGESTS = {
    "op1": lambda d, b, l: token_counts.token_digest(d, RANKS),
    "op2": lambda d, b, l: pieces.digest(d, PIECES, keep=["doc_id"]),
    "op3": lambda d, b, l: decontaminate.contamination_digest(d, b),
    "op4": lambda d, b, l: repeats.repeats_digest(d),
    "op5": lambda d, b, l: language.language_digest(d, PIECES),
    "op6": lambda d, b, l: near.near_digest(d),
    "op7": lambda d, b, l: toxicity.toxicity_digest(d, l),
    "op8": lambda d, b, l: quality.quality_digest(d, l),
    "op9": lambda d, b, l: secrets.secrets_digest(d),
    "op10": lambda d, b, l: rules.rules_digest(d),
}


@pytest.mark.parametrize("name", DIGESTS)
def test_one_row_for_each_and_none_for_none(docs, items, labels, name):
    assert sorted(map(str, (r.doc_id for r in DIGESTS[name](docs, items, labels).collect()))) == sorted(str(r[0]) for r in ROWS)
    for b, l in ((items, labels), (items.limit(0), labels.limit(0))):
        assert DIGESTS[name](docs.limit(0), b, l).count() == 0
    # Without items or labels there is still one row for each document.
    assert DIGESTS[name](docs, items.limit(0), labels.limit(0)).count() == len(ROWS)


def by_id(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_exact_results(docs, items, labels):
    texts = {r[0]: r[1] for r in ROWS}
    hit = by_id(decontaminate.contamination_digest(docs, items))
    kept = [x for x in ITEMS if x[0] is not None]
    assert {i: tuple(r)[1:] for i, r in hit.items()} == {i: contamination(t, kept) for i, t in texts.items()}
    counted = by_id(rules.rules_digest(docs))
    assert {i: tuple(r)[1:7] for i, r in counted.items()} == {i: base_quality(t) for i, t in texts.items()}
    found = by_id(near.near_digest(docs.where("doc_id is not null")))
    assert {i: (r.n_shingles, r.component_id) for i, r in found.items()} == near_components([(i, t) for i, t in texts.items() if i], 2)
    short = [r for r in ROWS if r[0] not in (7, 8, 9)]
    gone = by_id(repeats.repeats_digest(docs.where("coalesce(doc_id, 0) not in (7, 8, 9)")))
    assert {i: tuple(r)[1:] for i, r in gone.items()} == {r[0]: e for r, e in zip(short, removed_bytes([r[1] for r in short]), strict=True)}
    assert by_id(repeats.repeats_digest(docs))[9].n_removed == 100_000
    empty = by_id(pieces.digest(docs, PIECES))[1]
    assert (empty.n_tokens, empty.ids_sha256, empty.decoded_sha256) == (0, sha(""), sha(""))
    named = by_id(language.language_digest(docs, PIECES))
    assert [named[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and named[6].lang_pred == "en"


def test_clashing_columns_are_replaced(docs, labels):
    assert by_id(token_counts.build_trees(docs, RANKS))[4].tree["counts"]
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    assert [f.dataType.simpleString() for f in scored.schema if f.name == "score"] == ["double"]
    assert "N_WORDS" not in decontaminate.find_hits(docs, docs.selectExpr("doc_id item_id", "text").where("doc_id = 4")).columns


@pytest.mark.parametrize("k", range(5))
def test_stages(spark, docs, items, labels, tmp_path, k):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    _, stage = corpus_pipeline.STAGES[k]
    found = stage(spark, docs, str(tmp_path))
    assert found.columns[: len(docs.columns)] == docs.columns or k == 4
    ids = sorted(str(r.doc_id) for r in found.select("doc_id").collect())
    assert {"1", "2", "3", "12"} <= set(ids) and stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    if k == 1:
        assert ids.count("4") == 1 and {"5", "6", "8", "13"}.isdisjoint(ids)


def test_pipeline_of_nothing(spark, docs, items, labels, tmp_path):
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    labels.limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    items.limit(0).write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
