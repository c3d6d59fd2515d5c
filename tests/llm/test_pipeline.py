"""The pipeline's stages, each on what the one before kept."""

import corpus_pipeline
from tests.llm.test_llm import base_spans, brute_contamination

import pytest

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_columns_and_order(spark, stages):
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert all(d.columns == columns for d in stages[:-1]) and [n for n, _ in corpus_pipeline.STAGES][0] == "quality classifier"
    sizes = [d.count() for d in stages]
    assert sizes == sorted(sizes, reverse=True) and sizes[2] == sizes[3] == sizes[4] > 500


def test_copies_go_and_singles_stay(stages):
    before, after = stages[0].collect(), {r.doc_id for r in stages[1].collect()}
    first = {}
    for r in sorted(before, key=lambda r: r.doc_id):
        assert r.doc_id not in after or r.text not in first
        first.setdefault(r.text, r.doc_id)


def test_decontaminated_exactly(spark, stages):
    before = [(r.doc_id, r.text) for r in stages[1].collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = {d for d, x in brute_contamination(before, items).items() if not x[3]}
    assert {r.doc_id for r in stages[2].collect()} == want


def test_no_secrets_left(stages):
    assert not any(base_spans(r.text) for r in stages[3].collect())
    assert all(r.n_chars == len(r.text) for r in stages[3].collect())


def test_round_trip(stages):
    assert stages[4].where("not exact").count() == 0


def test_run_gives_the_last_stage(spark, stages):
    assert {(r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, SF).collect()} == {(r.doc_id, r.n_tokens) for r in stages[4].collect()}


def test_odd_columns(spark):
    """Columns named as the stages' own, without n_chars; null, empty and repeated rows."""
    rows = [(1, None, 2.5, "a", "b"), (2, "", 2.5, "a", "b"), (3, "password = abcdefgh1 é", 2.5, "a", "b"), (3, "password = abcdefgh1 é", 2.5, "a", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, spans string, redacted string")
    small = "/root/testdata/sf0.001"
    kept = corpus_pipeline.keep_quality(spark, docs, small)
    assert kept.columns == docs.columns and all(r.score == 2.5 for r in kept.collect())
    clean = corpus_pipeline.redact_secrets(spark, docs, small)
    assert clean.columns == docs.columns and sorted((r.doc_id, r.text, r.spans, r.redacted) for r in clean.where("doc_id > 1").collect()) == [(2, "", "a", "b"), (3, "<secret> é", "a", "b"), (3, "<secret> é", "a", "b")]
    assert clean.where("doc_id = 1 and text is null").count() == 1
    left = corpus_pipeline.drop_near_duplicates(spark, docs, small)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [1, 3, 3]
    assert corpus_pipeline.drop_contaminated(spark, docs, small).count() == 4
    assert [(r.n_tokens > 0, r.exact) for r in corpus_pipeline.encode(spark, docs.orderBy("doc_id"), small).collect()] == [(False, True), (False, True), (True, True), (True, True)]
    assert corpus_pipeline.redact_secrets(spark, docs.limit(0), small).count() == 0


def test_run_leaves_no_spent_tables(spark, stages):
    """After run() the shared folder has one more table than before, of those that written() makes: what the last stage reads."""
    import os

    from quaysight.llm import common

    folder = common.shared_dir(spark).removeprefix("file:")
    before, mark = set(os.listdir(folder)), common.standing()
    found = corpus_pipeline.run(spark, SF)
    left = set(os.listdir(folder)) - before
    assert {n.rsplit("-", 1)[0] for n in left} == {"stage3"} and common.standing() == mark + 1
    assert found.count() == stages[-1].count()
    common.release(spark, mark)
    assert set(os.listdir(folder)) == before
