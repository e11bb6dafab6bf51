"""The stages against brute force, and the entry points."""

import corpus_pipeline
import pytest
import test_decontaminate
import test_jaccard_join
import test_quality_rules

import __spark_entry__ as entry_points
from tidemark.llm import quality_rules, secrets

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_every_query_is_registered():
    names = entry_points.queries()
    assert [n.split("_")[0] for n in names if n.startswith("op")] == [f"op{i}" for i in range(1, 11)]
    assert "pipeline" in names and "pipeline" not in entry_points.oracle_sql()


def test_stages(spark, folder, documents):
    benchmark = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    rows = {r.doc_id: r for r in documents.collect()}
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, folder)
        assert after.columns == COLUMNS, name
        kept = {r.doc_id: r for r in after.collect()}
        pairs = [(k, r.text) for k, r in rows.items()]
        if name == "quality_rules":
            # Eighty labels can't prove any cutoff at this risk, so the base alone decides.
            counts = {k: test_quality_rules.brute(t) for k, t in pairs}
            assert set(kept) == {k for k, c in counts.items() if c[0] >= 50 and 100 * c[4] <= 50 * c[0]}
        elif name == "ngram_jaccard_join":
            assert set(kept) == {w[2] for w in test_jaccard_join.brute(pairs, 5, 80)}
        elif name == "benchmark_decontamination":
            assert set(kept) == {w[0] for w in test_decontaminate.brute(pairs, benchmark) if not w[-1]}
        else:
            assert set(kept) == set(rows)
            for k, r in kept.items():
                assert ("[SECRET]" in r.text) == (r.text != rows[k].text)
                assert not any(secrets.FORMAT.fullmatch(c[3]) for c in secrets.candidates(r.text))
        if name != "secret_scans":
            assert all(kept[k] == rows[k] for k in kept)
        docs, rows = spark.createDataFrame(list(kept.values()), documents.schema), kept
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder).toPandas()
    assert set(packed.doc_id) == set(rows)
    assert (packed.groupby("doc_id").length.sum() == packed.groupby("doc_id").doc_tokens.first()).all()


def test_run(spark, folder):
    found = corpus_pipeline.run(spark, folder)
    assert found.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert found.count() > 0


@pytest.mark.parametrize("empty", ["documents", "labels", "benchmark"])
def test_empty_tables(spark, folder, tmp_path, empty):
    for name in ("documents", "labels", "benchmark"):
        df = spark.read.parquet(f"{folder}/{name}.parquet")
        (df.limit(0) if name == empty else df.limit(30)).write.parquet(f"{tmp_path}/{name}.parquet")
    assert (corpus_pipeline.run(spark, str(tmp_path)).count() == 0) == (empty == "documents")


def test_cutoffs_are_off_without_labels(spark, folder, documents):
    labels = spark.read.parquet(f"{folder}/labels.parquet").limit(0)
    report = quality_rules.quality_report(documents, labels)
    assert report.where("kept = base_failed").count() == 0
