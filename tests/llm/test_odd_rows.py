"""Nulls, empty and long texts, repeats, empty tables and columns of clashing names."""

import hashlib

import pytest
from tokenizers import Tokenizer

from millrace.llm import bpe, jaccard_join, mixing, quality, queries, suffix_dedup, token_files, toxicity

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(120_000))
TEXTS = [(1, "a text of words"), (1, "a text of words"), (2, None), (3, ""), (None, "no id"), (4, LONG), (5, LONG + " end"), (6, "　\x85 \n"), (7, "x" * 200_000)]
CLASHES = ["score", "__kept", "__gone", "__stays", "__n", "__id", "__size", "__doc", "ids_of", "node", "token", "part", "words"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame([(d, t, "en", "s") for d, t in TEXTS], "doc_id long, text string, lang string, source string")
    return df.selectExpr("*", *(f"'{c}' as {c}" for c in CLASHES)).repartition(3)


def test_digests_equal_the_library(spark, docs):
    library = Tokenizer.from_file(queries.vocabulary())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for d, t in TEXTS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((d, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    got = [tuple(r) for r in bpe.digests(docs, queries.vocabulary()).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert bpe.digests(docs.limit(0), queries.vocabulary()).count() == 0


def test_token_files_of_odd_rows(spark, docs, tmp_path):
    library = Tokenizer.from_file(queries.vocabulary())
    want, at = [], 0
    for d, t in sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0)):
        n = len(library.encode(t or "", add_special_tokens=False).ids) + 1
        want.append((d, at, n))
        at += n
    manifest = token_files.write(docs, queries.vocabulary(), str(tmp_path / "f")).persist()
    got = [(r.doc_id, r.start, r.n_tokens) for r in token_files.read_back(manifest).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


@pytest.mark.parametrize("stage", [lambda d: jaccard_join.keep_one(d, 5, 80), suffix_dedup.cut_repeats, mixing.mix, lambda d: bpe.encode_documents(d, queries.vocabulary())])
def test_stages_keep_columns_and_odd_rows(spark, docs, stage):
    out = stage(docs)
    assert out.columns[: len(docs.columns)] == docs.columns and {tuple(r) for r in out.select(*CLASHES).distinct().collect()} == {tuple(CLASHES)}
    assert stage(docs.limit(0)).count() == 0


def test_near_copies_among_long_texts_are_found(spark, docs):
    by = {r.doc_id: r.component_id for r in jaccard_join.join(docs).collect()}
    assert by[5] == 4 and by[1] == 1 and by[None] is None
    kept = sorted(str(r.doc_id) for r in jaccard_join.keep_one(docs, 5, 80).collect())
    assert kept == ["1", "1", "2", "3", "4", "6", "7", "None"]
    assert {(r.doc_id, r.n_words) for r in suffix_dedup.repeats(docs).collect()} == {(4, 120_000), (5, 120_000)}


@pytest.mark.parametrize(("run", "label"), [(quality.scored, "quality"), (toxicity.scored, "toxic")])
def test_classifiers_score_odd_rows(spark, docs, run, label):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, 0), (4, 1), (5, 0), (5, 0), (None, 1), (7, None)], f"doc_id long, {label} int")
    rows = run(docs, labels).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 for r in rows)
