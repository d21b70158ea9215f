"""Every stage of the pipeline against a brute-force version on its own input."""

import os
import sys

import numpy as np
import pytest

import test_mixing
import test_packing
import test_simhash
import test_suffix_array
from logbrook.llm import mixing, ordinal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    """The rows before and after each stage, each stage written and read again."""
    base = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    steps = [docs]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, steps[-1], sf_dir).write.parquet(str(base / str(number)))
        steps.append(spark.read.parquet(str(base / str(number))))
    return steps


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_columns_stay_the_same_up_to_the_last_stage(stored):
    assert all(df.columns == stored[0].columns for df in stored[:-1])


def test_classifier_only_removes_what_it_rejects(spark, sf_dir, stored):
    model = ordinal.train(stored[0], spark.read.parquet(f"{sf_dir}/labels.parquet"))
    want = [r for r in rows(stored[0]) if model.tails(ordinal.buckets((r[1] or "").encode()))[1] >= ordinal.KEEP_TAIL]
    assert sorted(rows(stored[1])) == sorted(want) and want


def test_one_document_of_each_group(stored):
    before = rows(stored[1])
    first = {component for _, _, component in test_simhash.expected(before)}
    assert sorted(rows(stored[2])) == sorted(r for r in before if r[0] in first)


def test_repeats_are_cut_out(stored):
    before = rows(stored[2])
    data, gone = test_suffix_array.brute([r[1] for r in before])
    want = {r[0]: np.frombuffer(b, np.uint8)[~m].tobytes().decode(errors="ignore") for r, b, m in zip(before, data, gone)}
    assert {r[0]: r[1] for r in rows(stored[3])} == want
    assert all(r[4] == len(r[1]) for r in rows(stored[3]))


def test_mix_meets_its_targets(stored):
    before = rows(stored[3])
    counts = mixing.mix_counts(stored[3]).collect()
    test_mixing.check(before, counts)
    taken = {}
    for r in rows(stored[4]):
        taken[r[0]] = taken.get(r[0], 0) + len(test_mixing.words(r[1]))
    assert taken == {g["doc_id"]: g["taken"] for g in counts if g["taken"]}


def test_pieces_hold_every_token(stored):
    test_packing.check(rows(stored[4]), stored[5].collect())


def test_run_gives_the_same_rows(spark, sf_dir, stored):
    assert corpus_pipeline.run(spark, sf_dir).count() == stored[5].count()
