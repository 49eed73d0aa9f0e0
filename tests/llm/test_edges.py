"""Every operator and stage on odd rows, on an empty table, and beside columns of clashing names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.data import documents, odd_texts
from wardline.llm import bpe, decontamination, fingerprints, hidden_markov, jaccard_join, language_id, secret_scans, sharding, token_files, url_filters
from wardline.llm.chunks import load_vocabulary, tokenizer_path
from wardline.llm.tasks import residue


@pytest.fixture(scope="module")
def vocabulary():
    return load_vocabulary(tokenizer_path())


def operators(spark, vocabulary):
    bench = spark.createDataFrame([(1, odd_texts()[6][1]), (2, None), (3, ""), (4, "too short")], "item_id long, text string")
    return {
        "secrets": lambda d: secret_scans.find_secrets(d),
        "sharding": lambda d: sharding.place(d.select("doc_id"), "doc_id", ["a", "b", "c"], 101),
        "markov": lambda d: hidden_markov.score_documents(d, residue("doc_id", 7) != 2),
        "jaccard": lambda d: jaccard_join.jaccard_components(d),
        "fingerprints": lambda d: fingerprints.fingerprint_edits(d),
        "tokens": lambda d: token_files.read_token_segments(token_files.token_segments(d, tokenizer_path())),
        "language": lambda d: d.select("doc_id", language_id.predict(d, language_id.fit(d)).alias("p")),
        "bpe": lambda d: d.select("doc_id", bpe.encode(d, vocabulary, bpe.build_lexicon(d, vocabulary)).alias("e")),
        "benchmark": lambda d: decontamination.contaminated(d, bench),
        "urls": lambda d: url_filters.judge_urls(d.select("doc_id", F.col("text").alias("url"))),
    }


NAMES = ["secrets", "sharding", "markov", "jaccard", "fingerprints", "tokens", "language", "bpe", "benchmark", "urls"]


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(spark, vocabulary, name):
    rows = odd_texts()
    got = operators(spark, vocabulary)[name](documents(spark, rows, more=True)).collect()
    if name == "benchmark":
        assert {r.doc_id for r in got} == {7, 8}
    else:  # a row for each row, repeated and null ids too
        assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, vocabulary, name):
    assert operators(spark, vocabulary)[name](documents(spark, [])).collect() == []


@pytest.mark.parametrize("at", range(5))
def test_stages(spark, tmp_path, at):
    spark.createDataFrame([(1, odd_texts()[6][1]), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    name, stage = corpus_pipeline.STAGES[at]
    for rows in (odd_texts(), []):
        docs = documents(spark, rows, more=True)
        got = stage(spark, docs, str(tmp_path))
        if at < 4:
            assert got.columns == docs.columns
        kept = sorted(str(r.doc_id) for r in got.collect())
        ids = sorted(str(r[0]) for r in rows)
        if name in ("secret_scans", "bpe"):
            assert kept == ids
        if name == "language_id" and rows:
            assert kept == sorted(str(r[0]) for r in rows if r[1] and any(map(str.isalpha, r[1])))
        if name == "jaccard_join" and rows:
            # 7 twice and 8 hold one text; of those 7 stays, once. Wordless rows all stay.
            assert kept.count("7") == 1 and kept.count("8") == 1 and kept.count("None") == 2
        if name == "decontamination" and rows:
            assert kept.count("7") == 0 and kept.count("8") == 1
