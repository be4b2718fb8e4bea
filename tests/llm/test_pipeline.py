"""The pipeline, stage by stage, against what each stage must do to its own input."""

import os

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from wiremere.llm import bpe, mix, pii
from wiremere.session import shared_dir

from test_near_duplicates import brute_force

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows before and after every stage."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tables = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        tables.append(docs.collect())
    return {name: tables[n : n + 2] for n, name in enumerate(STAGES)}


def test_order_and_columns(stages):
    assert list(STAGES) == ["quality", "near_duplicates", "personal_data", "mix", "bpe"]
    for name in list(STAGES)[:-1]:
        assert list(stages[name][1][0].asDict()) == corpus_pipeline.COLUMNS


def test_quality_drops_labelled_junk_and_keeps_the_rest(stages, spark):
    before, after = stages["quality"]
    kept = {r.doc_id for r in after}
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [r.doc_id in kept for r in before if label.get(r.doc_id) == 1]
    bad = [r.doc_id in kept for r in before if label.get(r.doc_id) == 0]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.2
    assert set(after) <= set(before)


def test_quality_decides_every_row_by_its_own_text(stages, spark):
    before, after = stages["quality"]
    kept = {r.doc_id for r in after}
    good, bad = (next(r for r in before if (r.doc_id in kept) == want) for want in (True, False))
    name = lambda r, i: (i, *r[1:])
    odd = [name(good, None), name(bad, None), name(good, bad.doc_id + 10**6), name(bad, bad.doc_id + 10**6)]
    docs = spark.createDataFrame(before, spark.read.parquet(f"{SF}/documents.parquet").schema)
    rows = corpus_pipeline.keep_quality(spark, docs.union(spark.createDataFrame(odd, docs.schema)), SF).collect()
    found = [(r.doc_id, r.text) for r in rows if r.doc_id is None or r.doc_id >= 10**6]
    assert sorted(found, key=str) == sorted([(None, good.text), (bad.doc_id + 10**6, good.text)], key=str)


def test_one_document_of_each_group_stays(stages):
    before, after = stages["near_duplicates"]
    groups = brute_force([(r.doc_id, r.text) for r in before])
    assert sorted(r.doc_id for r in after) == sorted({c for _, c in groups.values()})
    assert set(after) <= set(before)


def test_different_texts_of_one_doc_id_stay(spark):
    near = "one two three four five six seven eight nine ten"
    other = "totally other words stand here now friends"
    rows = [(5, near, "en", "b", 9), (5, other, "en", "a", 9), (5, near, "en", "a", 9), (7, near, "en", "a", 9), (3, near + " end", "de", "a", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _ in range(2):
        kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()
        assert sorted(map(tuple, kept)) == [rows[4], rows[1]]
    kept = corpus_pipeline.drop_near_duplicates(spark, docs.filter("doc_id > 3"), SF).collect()
    assert sorted(map(tuple, kept)) == [rows[2], rows[1]]


def test_no_strict_personal_data_is_left(stages):
    before, after = stages["personal_data"]
    assert sorted(r.doc_id for r in before) == sorted(r.doc_id for r in after)
    texts = {r.doc_id: r for r in after}
    for r in before:
        new = texts[r.doc_id]
        assert not pii.base_segments(new.text)
        assert new.n_chars == len(new.text)
        assert pii.base_segments(r.text) or "[" in new.text or new.text == r.text


def test_mix_repeats_as_planned(stages, spark):
    before, after = stages["mix"]
    plan = {r.doc_id: r.copies for r in mix.mix(spark.createDataFrame(before)).collect()}
    assert sorted(r.doc_id for r in after) == sorted(i for i, n in plan.items() for _ in range(n))


def test_ids_are_those_of_the_library(stages):
    before, after = stages["bpe"]
    library = Tokenizer.from_file(bpe.vocabulary_path())
    texts = {r.doc_id: r.text for r in before}
    assert len(before) == len(after)
    for r in after[::5]:
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode(texts[r.doc_id], add_special_tokens=False).ids


def test_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "a b", "en", "s", 3), (3, "x y z", None, None, 5)]
    ddl = "doc_id long, text string, lang string, source string, n_chars long"
    for docs in (spark.createDataFrame(rows, ddl), spark.createDataFrame([], ddl)):
        for stage in list(STAGES.values()):
            assert stage(spark, docs, SF).count() >= 0


def test_run_leaves_its_result_only(spark):
    def folders():
        return set(os.listdir(shared_dir(spark)))

    before = folders()
    done = corpus_pipeline.run(spark, SF)
    (left,) = folders() - before
    assert left.startswith("pipeline-bpe-") and done.count() > 0
